"""The pipeline against the brute-force versions of its stages, and on odd tables."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from freshet.llm import minhash, quality
from freshet.llm.common import table
from tests.llm.test_corpus import DOCS, ODD, SF, brute_components, brute_hits, brute_lines, reference_encoding


def test_pipeline_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    kept = {r["id"] for r in quality.judge(docs).filter("kept").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept]
    rows = [(i, t) for i, _, dropped, t in brute_lines(rows) if not dropped or len(re.findall(r"[^ \t-\r]+", t)) >= 10]
    rows = [(i, t) for (i, t), (j, _, c) in zip(sorted(rows), brute_components(rows)) if j == c]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    near = {w for _, t in items for w in re.findall(r"\w+ \w+ \w+", t.lower())}
    rows = [(i, t) for i, t in rows if not (any(w in t.lower() for w in near) and brute_hits(t, items)[1])]
    enc = reference_encoding()
    want = sorted((i, len(ids := enc.encode_ordinary(t)), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and 50 < len(got) < docs.count() and min(n for _, n, _, _ in got) > 0


@pytest.mark.parametrize("rows", [[], ODD, [(None, None), (None, None)]], ids=["empty", "odd", "nulls"])
def test_stages_keep_columns_and_survive_odd_rows(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", None, None if t is None else len(t), 1, "x", "y") for i, t in rows], DOCS)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        out.collect()
    lines = corpus_pipeline.line_deduplication(spark, docs, SF)
    assert lines.filter(F.col("n_chars") != F.length("text")).count() == 0
    assert lines.filter("doc_id = 6 OR text IS NULL").count() == docs.filter("doc_id = 6 OR text IS NULL").count()        # nothing dropped: stays
    corpus_pipeline.quality_rules(spark, docs, SF).collect()


def test_near_copies_from_four_fifths_on_go(spark):
    rows = []
    for k in range(40):
        words = [f"d{k}w{i}" for i in range(104)]        # 100 shingles
        for copy, changed in enumerate([(), (50, 100), (20, 60, 90)]):        # similarities of 0.83 and 0.74 to the first
            rows.append((3 * k + copy, " ".join(f"x{copy}" if i in changed else w for i, w in enumerate(words))))
    docs = spark.createDataFrame([(i, t, "en", None, len(t), 1, "x", "y") for i, t in rows], DOCS)
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == {i for i, _ in rows if i % 3 != 1}


def test_line_stage_leaves_no_rumps_and_no_column_clashes(spark):
    long = "a line of text that several of the documents hold and that is long enough"
    own = " ".join(f"own{i}" for i in range(12))
    rows = [(1, f"{long}\n{own}"), (2, long), (3, f"{long}\nrump"), (4, f"{own} else\n{long}"), (5, "short"), (6, None)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, _empty string, unknown string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_deduplication(spark, docs, SF).collect()}
    assert got == {1: rows[0][1], 4: f"{own} else", 5: "short", 6: None}


def test_null_ids_are_documents_of_their_own(spark):
    words = lambda tag, n=90: " ".join(f"{tag}{i}" for i in range(n))
    rows = [(1, words("a")), (None, words("a") + " more"), (None, words("b")), (None, words("c")), (None, words("c")), (None, words("c") + " more"), (2**63 - 1, words("d")), (5, words("e")), (5, words("f"))]
    docs = spark.createDataFrame([(i, t, "en", None, None, 1, "x", "y") for i, t in rows], DOCS)
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in minhash.near_duplicates(docs).collect())
    last = 2**63 - 1
    assert got == sorted([(1, 1, True), (-1, 1, False), (-1, -1, True), (-1, -1, True), (-1, -1, False), (-1, -1, False), (last, last, True), (5, 5, True), (5, 5, True)])
    kept = sorted((r["doc_id"] or -1, r["text"][0]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert kept == [(-1, "b"), (-1, "c"), (1, "a"), (5, "e"), (5, "f"), (last, "d")]
