"""Secret scan: credentials by pattern, weighed by who holds them.

Every whole text is searched for three fixed patterns and for opaque strings: long runs of letters, digits and ``+/_-`` that mix
small letters, capitals and digits.  A candidate's value is hashed, and the corpus is asked in how many repositories and under how
many owners each hash occurs.  A value that many owners or many repositories hold is a copied example, be they all of one owner; one
that is held by at most ``FEW_OWNERS`` in at most ``FEW_REPOSITORIES`` and has enough different characters looks live.  Spans of the fixed patterns always stay; an opaque string becomes a span only if it
looks live, since copied examples, checksums of shared files and the like are spread over owners.

Counts are combined by (value, owner) and then by value, before each shuffle; a value with very many holders is split by salts
when the counts are joined back.

Defined cases: a NULL text is empty; a NULL owner is one owner of its own; rows equal in id and text get equal rows and count
as one repository.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from freshet.llm.common import texts
from freshet.llm.kernels import slices
from freshet.operators.skew import join_counted
from freshet.session import stored_table

FEW_OWNERS = 2
FEW_REPOSITORIES = 10
LEAST_DIFFERENT = 10        # different characters of a value that looks live
KINDS = ["assign", "access", "hex", "opaque"]
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]+")
LEAST = {"assign": 6, "access": 20, "hex": 24, "opaque": 20}

_IS_HEX = np.zeros(256, bool)
_IS_HEX[[*range(48, 58), *range(97, 103)]] = True
_IS_OPAQUE = np.zeros(256, bool)
_IS_OPAQUE[[*range(48, 58), *range(65, 91), *range(97, 123), *map(ord, "+/_-")]] = True


def _texts_with_run(member: np.ndarray, data: np.ndarray, offsets: np.ndarray, least: int) -> set[int]:
    """Texts with a run of at least ``least`` such bytes; a quick look before the pattern itself."""
    outside = np.concatenate([[-1], np.flatnonzero(~member[data]), [len(data)]])
    long = outside[:-1][np.diff(outside) > least]
    first, last = np.searchsorted(offsets, long + 1, "right") - 1, np.searchsorted(offsets, outside[1:][np.diff(outside) > least], "left") - 1
    return {i for a, b in zip(first.tolist(), last.tolist()) for i in range(a, b + 1)}


def base_spans(text: str, maybe_hex: bool = True) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the fixed patterns, in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if maybe_hex:
        found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(found)


def opaque_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Mixed opaque strings that overlap no span of ``taken``."""
    found = []
    for m in OPAQUE.finditer(text):
        v = m[0]
        if len(v) >= LEAST["opaque"] and any(c.isdigit() for c in v) and any("a" <= c <= "z" for c in v) and any("A" <= c <= "Z" for c in v) and not any(
                s < m.end() and m.start() < e for s, _, e, _ in taken):
            found.append((m.start(), 3, m.end(), v))
    return found


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()), ("value", pa.string()), ("varied", pa.bool_())])
_FOUND = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("owner", pa.string()), ("spans", pa.list_(_SPAN))])


def _scan(batches):
    for batch in batches:
        for a, b, data, offsets in slices(batch.column(3)):
            hexes = _texts_with_run(_IS_HEX, data, offsets, LEAST["hex"])
            opaque = _texts_with_run(_IS_OPAQUE, data, offsets, LEAST["opaque"])
            rows = []
            for i, text in enumerate(batch.column(3).slice(a, b - a).to_pylist()):
                spans = base_spans(text, i in hexes)
                if i in opaque:
                    spans = sorted(spans + opaque_spans(text, spans))
                rows.append([{"start": s, "kind": k, "stop": e, "value": hashlib.sha256(v.encode()).hexdigest(), "varied": len(set(v)) >= LEAST_DIFFERENT}
                             for s, k, e, v in spans])
            yield pa.record_batch([*(batch.column(k).slice(a, b - a) for k in range(3)), pa.array(rows, pa.list_(_SPAN))], schema=_FOUND)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """(id, mark, owner, spans) per row: every candidate with the SHA-256 of its value, never the value."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("mark"), F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), text.alias("text"))
    return source.mapInArrow(_scan, "id long, mark long, owner string, spans array<struct<start:long,kind:int,stop:long,value:string,varied:boolean>>")


def ownership(found: DataFrame) -> DataFrame:
    """(value, repositories, owners, rows) of every candidate value."""
    held = found.select("id", "mark", "owner", F.explode_outer("spans.value").alias("value")).filter("value IS NOT NULL")
    by_owner = held.groupBy("value", "owner", "id", "mark").agg(F.count(F.lit(1)).alias("rows")).groupBy("value", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("rows").alias("rows"))
    return by_owner.groupBy("value").agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"), F.sum("rows").alias("rows"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", few: int = FEW_OWNERS,
         few_repositories: int = FEW_REPOSITORIES) -> DataFrame:
    """Per row: doc_id, base (its pattern spans), spans (with the opaque ones that look live), n_live and n_example.

    A span is (start, kind, stop, value, varied, repositories, owners, live).
    """
    found = stored_table(candidates(docs, id_col, text_col, owner_col), "candidates")
    stats = stored_table(ownership(found), "ownership")
    total = stats.agg(F.sum("rows")).first()[0] or 0
    each = found.select("id", "mark", F.explode_outer("spans").alias("span")).filter("span IS NOT NULL").select("id", "mark", "span.*")
    known = join_counted(each, stats, ["value"], ["id", "start"], "rows", total, "inner")
    live = F.col("varied") & (F.col("owners") <= few) & (F.col("repositories") <= few_repositories)
    weighed = known.withColumn("live", live).groupBy("id", "mark").agg(F.array_sort(F.collect_set(F.struct(
        "start", "kind", "stop", "value", "varied", "repositories", "owners", "live"))).alias("weighed"))
    joined = found.select("id", "mark").alias("f").join(weighed.alias("w"), F.col("f.id").eqNullSafe(F.col("w.id")) & (F.col("f.mark") == F.col("w.mark")), "left")
    every = F.coalesce("weighed", F.array().cast("array<struct<start:long,kind:int,stop:long,value:string,varied:boolean,repositories:long,owners:long,live:boolean>>"))
    out = joined.select(F.col("f.id").alias("doc_id"), every.alias("weighed"))
    return out.select("doc_id", F.filter("weighed", lambda s: s["kind"] < 3).alias("base"), F.filter("weighed", lambda s: (s["kind"] < 3) | s["live"]).alias("spans"),
                      F.size(F.filter("weighed", lambda s: s["live"])).cast("long").alias("n_live"),
                      F.size(F.filter("weighed", lambda s: (s["owners"] > few) | (s["repositories"] > few_repositories))).cast("long").alias("n_example"))


def as_text(spans) -> F.Column:
    """kind:start:end of each span, joined by commas."""
    names = F.lit(KINDS).cast("array<string>")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")
