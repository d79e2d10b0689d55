"""Merkle manifest, ranked search and exact duplicates against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import exact_dedup, merkle, queries, ranked

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, idx long, size int, hash string, entry string, id string, norm int, row string, tie int"


def docs_of(spark, rows, parts=3):
    """(doc_id, text, source) rows with extra columns whose names the operators use inside."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", 1, 2, "y", "z", "w", 3, "r", 4) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


ODD = [(1, None, "a"), (2, "", "a"), (3, "  \n\t", None), (4, "One two", "a"), (4, "One two", "a"), (None, "one TWO", "b"), (None, None, None), (5, "é ß 中文 Word", "b"),
       (6, "x" * 40_000, "b"), (7, "a b c " * 5000, "ä"), (8, "one two", "a"), (9, "Ä É", ""), (9, "ä é", "")]


# ---- 11 ----

def leaf_of(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root and per leaf its proof: per level slot and the others of its run."""
    ways = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for run in runs:
            for slot, k in enumerate(run):
                for leaf in below[k]:
                    ways[leaf].append((slot, [nodes[j] for j in run if j != k]))
        below = [[leaf for k in run for leaf in below[k]] for run in runs]
        nodes = [sha("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], ways


def brute_manifest(rows):
    groups = defaultdict(list)
    for doc_id, text, source in rows:
        n = None if text is None else len(text)
        lowered = None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        leaf = leaf_of(doc_id, source, "en", n, text)
        groups[source].append((doc_id is not None, doc_id or 0, leaf, leaf_of(doc_id, source, "en", n, lowered) if tampered else leaf, doc_id))
    named = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in named:
        groups[s].sort(key=lambda g: g[:3])
        built[s] = tree([g[2] for g in groups[s]])
    root, above = tree([built[s][0] for s in named])
    out = []
    for k, s in enumerate(named):
        for g, way in zip(groups[s], built[s][1]):
            node, path = g[3], way + above[k]
            for slot, others in path:
                node = sha("".join(others[:slot]) + node + "".join(others[slot:]))
            out.append((g[4], g[2], built[s][0], root, sha("".join("".join(o) for _, o in path)), node, node == root))
    return sorted(out, key=repr)


def audited(docs):
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(5)) == 0
    claim = F.when(tampered, merkle.leaf_digest(*values, queries.ascii_lower(F.col("text"))))
    return merkle.build(merkle.leaves(docs, "source", "doc_id", [*values, F.col("text")], claim))


@pytest.mark.parametrize("size", [1, 2, 16, 17, 256, 257, 4096, 4097, 70_000])
def test_postorder_positions_are_closed_form(size):
    counts, n = [size], size
    while n > 1:
        n = -(-n // 16)
        counts.append(n)
    walk, done = [], [0] * len(counts)
    for leaf in range(1, size + 1):        # nodes in the order in which a reader of the leaves completes them
        for level, total in enumerate(counts):
            if done[level] < total and (leaf == size or leaf % 16 ** level == 0):
                walk.append((level, done[level]))
                done[level] += 1
    where = {node: at for at, node in enumerate(walk)}
    for level, total in enumerate(counts):
        assert merkle.position(level, np.arange(total), size).tolist() == [where[level, i] for i in range(total)]


def test_manifest_against_brute_force(spark):
    rnd = random.Random(3)
    rows = ODD + [(100 + i, rnd.choice(["Same text", f"Text {i}", None]), "hot") for i in range(4500)] + [(9000 + i, f"t{i}", "mid") for i in range(300)]
    rows += [(20_000 + i, "One", f"s{i}") for i in range(20)] + [(20_100, "same row", "twice")] * 40
    manifest = audited(docs_of(spark, rows))
    got = sorted((tuple(r) for r in merkle.audit(manifest).collect()), key=repr)
    assert got == brute_manifest(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
    proofs = merkle.audit(manifest, with_siblings=True).filter("verified").limit(50).collect()
    assert all(merkle.fold(r["leaf"], r["slots"], r["siblings"]) == r["root"] for r in proofs)
    places = manifest.log.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("pos").alias("d"), F.max("pos").alias("m")).collect()
    assert all(p["n"] == p["d"] == p["m"] + 1 for p in places)        # the log has no gaps


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.audit(audited(docs_of(spark, []))).collect() == []
    one = [(5, "Only", None)]
    assert [tuple(r) for r in merkle.audit(audited(docs_of(spark, one))).collect()] == brute_manifest(one)


# ---- 12 ----

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranking(docs, items, k=10):
    counts = [(i, Counter(words(t))) for i, t in docs]
    n_docs, length = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for i, c in counts:
            damp = 25 + (75 * c.total() * n_docs) // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * damp)) for t in words(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def ranking(spark, docs, items, **options):
    asked = spark.createDataFrame([(i, t, 0, "q") for i, t in items], "item_id long, text string, rank int, q string")
    return sorted((tuple(r) for r in ranked.top_documents(docs_of(spark, [(i, t, "s") for i, t in docs]), asked, **options).collect()), key=repr)


def test_ranking_against_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "中文", "a1"]
    pick = lambda n: " ".join(vocabulary[min(int(rnd.expovariate(0.02)), len(vocabulary) - 1)] for _ in range(n))
    docs = [(i, pick(rnd.choice([3, 30, 300]))) for i in range(700)] + [(i, t) for i, t, _ in ODD]
    docs += [(1000 + i, "w5 w9 w250 copied many times") for i in range(400)] + [(2000, "w1 " * 30_000), (2001, pick(20_000))]
    items = [(i, pick(rnd.choice([1, 5, 40]))) for i in range(25)] + [(50, None), (51, ""), (52, "unknownword"), (53, "W5 w9, w250!"), (53, "W5 w9, w250!"), (None, "one two w7"), (55, "w1 " * 500)]
    want = brute_ranking(docs, items)
    monkeypatch.setattr(ranked, "BUCKET", 64)
    assert ranking(spark, docs, items) == want
    assert ranking(spark, docs, items, block_bytes=600) == want        # queries in several blocks


def test_ranking_of_empty_tables(spark):
    assert ranking(spark, [], [(1, "a b")]) == [] and ranking(spark, [(1, "a b")], []) == [] and ranking(spark, [(1, None)], [(1, "a")]) == []


def test_buckets_are_pruned():
    """A query whose threshold no vector of a bucket can reach does not look inside, and bounds let few documents through."""
    weights = np.array([5000, 4000, 10], dtype=np.int64)
    bucket = ranked._Bucket([1, 2, 3], np.array([900.0, 800.0, 700.0]), np.array([2, 2, 2]), np.array([280, 250, 220]), np.array([0, 1, 2, 3]), 3)
    query = ranked._Query(np.array([0, 2]), np.array([1, 1]), weights, 10**9, 10)
    bucket.scores = lambda *a: pytest.fail("scored a document that cannot reach the threshold")
    query.meet(bucket, np.zeros(3, np.int64))
    assert len(query.best[0]) == 0


# ---- 13 ----

def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def check_duplicates(got, rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[sha(lowered(t))].append(i)
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        ids = groups[r["text_sha256"]]
        largest = max((i for i in ids if i is not None), default=None)
        assert r["keep_id"] == largest and r["group_size"] == len(ids)
        assert not r["kept"] or r["doc_id"] == largest
        kept[r["text_sha256"]] += r["kept"]
    assert kept == {g: 1 for g in groups}
    assert Counter((r["doc_id"], r["text_sha256"]) for r in got) == Counter((i, sha(lowered(t))) for i, t, _ in rows)


@pytest.mark.parametrize("options", [{}, {"hash_bits": 3, "bucket_bytes": 300}, {"hash_bits": 14, "bucket_bytes": 2000, "remembered": 200}, {"hash_bits": 1}])
def test_exact_duplicates_against_brute_force(spark, options):
    """Few hash bits force collisions of different texts, small buckets force splits, a short memory forces many entries a task."""
    rnd = random.Random(9)
    rows = ODD + [(100 + i, rnd.choice(["Copied Text", "copied text", f"text {i % 90}", f"TEXT {i % 90}"]), "s") for i in range(900)]
    check_duplicates(exact_dedup.duplicates(docs_of(spark, rows, 5), **options).collect(), rows)


def test_directory_splits_overfull_buckets_only(spark):
    rows = [(h << 56, 10) for h in range(-128, 128)] + [((5 << 56) + i, 10) for i in range(300)] + [(7 << 56, 10)] * 200
    heads = spark.createDataFrame(rows, "hash long, bytes long")
    found = exact_dedup.directory(heads, 500)
    spans = [(p << (64 - d), (p + 1) << (64 - d)) for p, d in found]
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    unsigned = [h % 2**64 for h, _ in rows]
    for low, high in spans:
        inside = [h for h in unsigned if low <= h < high]
        assert len(inside) * 10 <= 500 or len(set(inside)) == 1
    assert sum(low <= h < high for low, high in spans for h in unsigned) == len(rows)
    assert {d for _, d in found} != {max(d for _, d in found)}


def test_exact_duplicates_of_nothing_and_rows_that_stay(spark):
    assert exact_dedup.duplicates(docs_of(spark, [])).collect() == []
    stay = exact_dedup.keep(docs_of(spark, ODD))
    assert stay.columns == docs_of(spark, []).columns
    assert stay.count() == len({lowered(t) for _, t, _ in ODD})
