"""The registered queries of the corpus operators, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from freshet.llm import bpe, decontaminate, exact_dedup, langid, line_dedup, merkle, minhash, quality, ranked, secrets, shard, url_rules, warc
from freshet.llm.common import ascii_lower, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def hex_of(text) -> F.Column:
    return F.sha2(text, 256)


# ---- 1: URLs by explicit and mined rules -------------------------------------------------------------------------------------

_REST = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END"


@query("op1_url_association_rules", rf"""
WITH RECURSIVE p AS (SELECT page_id, url, {_REST} AS rest FROM pages),
u AS (SELECT page_id, url, rest, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
l AS (SELECT *, string_split(host, '.') AS hl FROM u WHERE rest IS NOT NULL),
t AS (SELECT DISTINCT page_id, url, token FROM (
  SELECT page_id, url, 's:' || translate(regexp_extract(url, '^(.*?)://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS token FROM l
  UNION ALL SELECT page_id, url, 'h:' || array_to_string(hl[i:], '.') FROM l, unnest(range(1, len(hl) + 1)) AS x(i)
  UNION ALL SELECT page_id, url, 'p:' || regexp_replace(s, '[0-9]+', '#', 'g') FROM (SELECT page_id, url, unnest(string_split(path, '/')) AS s FROM l) WHERE s <> ''
  UNION ALL SELECT page_id, url, 'q:' || regexp_extract(q, '^([^=]*)', 1) FROM (SELECT page_id, url, unnest(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&')) AS q FROM l) WHERE q <> ''
  UNION ALL SELECT page_id, url, 'f:' FROM l WHERE instr(rest, '#') > 0)),
labelled AS (SELECT page_id, coalesce(quality = 0, FALSE) OR coalesce(toxic = 1, FALSE) AS bad FROM pages JOIN labels ON doc_id = page_id WHERE quality IS NOT NULL OR toxic IS NOT NULL),
least_urls AS (SELECT greatest(ceil({url_rules.MIN_SUPPORT} * count(*)), {url_rules.LEAST_URLS}) AS m FROM labelled WHERE bad AND page_id IN (SELECT page_id FROM t)),
lt AS (SELECT page_id, bad, token FROM labelled JOIN t USING (page_id)),
often AS (SELECT token FROM lt WHERE bad GROUP BY token HAVING count(*) >= (SELECT m FROM least_urls)),
ft AS (SELECT lt.* FROM lt JOIN often USING (token)),
sets AS (SELECT page_id, bad, [token] AS rule, token AS last FROM ft
  UNION ALL SELECT s.page_id, s.bad, list_append(s.rule, ft.token), ft.token FROM sets s JOIN ft ON ft.page_id = s.page_id AND ft.token > s.last),
rules AS (SELECT rule, count(*) FILTER (bad) AS support, count(*) FILTER (bad) / count(*)::DOUBLE AS confidence FROM sets GROUP BY rule
          HAVING count(*) FILTER (bad) >= (SELECT m FROM least_urls) AND count(*) FILTER (bad) / count(*)::DOUBLE >= {url_rules.MIN_CONFIDENCE}),
own AS (SELECT page_id, list(token) AS tokens FROM t GROUP BY page_id),
mined AS (SELECT DISTINCT page_id FROM own, rules WHERE list_has_all(tokens, rule)),
ruled AS (SELECT page_id, host, path, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT ruled.page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN mined.page_id IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM ruled LEFT JOIN mined USING (page_id)""")
def op1(spark, d):
    """A page is labelled by the document of the same number: bad if that is of low quality or toxic."""
    pages = table(spark, d, "pages").select("page_id", "url")
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    labels = table(spark, d, "labels").filter("quality IS NOT NULL OR toxic IS NOT NULL").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_rules.judge(pages, pages.join(labels, "page_id")).drop("mined")


# ---- 2: secrets, weighed by their owners ------------------------------------------------------------------------------------

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans_sql(kind: int, pattern: str, value: int, least: str) -> str:
    """Matches with their places: the text is split at the matches, a match starts after the pieces and matches before it."""
    return f"""SELECT doc_id, {kind} AS kind, value, CAST(start AS BIGINT) AS start, CAST(start + length(hits[i]) AS BIGINT) AS stop FROM (
  SELECT doc_id, i, hits, vals[i] AS value, list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS pieces, regexp_extract_all(t, '{pattern}') AS hits, regexp_extract_all(t, '{pattern}', {value}) AS vals FROM d),
       unnest(range(1, len(hits) + 1)) AS u(i)) WHERE {least}"""


@query("op2_secret_ownership", rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
base AS ({_spans_sql(0, _ASSIGN, 2, "length(value) >= 6")}
  UNION ALL {_spans_sql(1, 'AKIA[A-Z0-9]+', 0, "length(value) >= 20")}
  UNION ALL {_spans_sql(2, '[0-9a-f]+', 0, "length(value) >= 24")}),
loose AS ({_spans_sql(3, '[A-Za-z0-9+/_-]+', 0, "length(value) >= 20")}),
opaque AS (SELECT * FROM loose l WHERE regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = l.doc_id AND b.start < l.stop AND l.start < b.stop)),
both_kinds AS (SELECT * FROM base UNION ALL SELECT * FROM opaque),
held AS (SELECT value, count(DISTINCT owner) AS owners FROM both_kinds JOIN d USING (doc_id) GROUP BY value),
spans AS (SELECT b.*, len(list_distinct(string_split(value, ''))) >= {secrets.LEAST_DIFFERENT} AND owners <= {secrets.FEW_OWNERS} AS live,
            ['assign', 'access', 'hex', 'opaque'][kind + 1] || ':' || start || ':' || stop AS s FROM both_kinds b JOIN held USING (value))
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3 OR live), '') AS spans,
       count(*) FILTER (live) AS n_live, count(*) FILTER (owners > {secrets.FEW_OWNERS}) AS n_example
FROM (SELECT d.doc_id, kind, start, s, live, owners FROM d LEFT JOIN (SELECT spans.*, held.owners FROM spans JOIN held USING (value)) x USING (doc_id)) GROUP BY doc_id""")
def op2(spark, d):
    found = secrets.scan(table(spark, d, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")        # noqa: E731
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        hex_of(secrets.as_text(F.col("base"))).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"), "n_live", "n_example")


# ---- 3: windows of ten words shared with the benchmark ----------------------------------------------------------------

WORDS3 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op3_benchmark_decontamination", rf"""
WITH d AS (SELECT doc_id, {WORDS3} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {WORDS3} AS w FROM benchmark),
b_win AS (SELECT item, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win, least(len(w), 10) AS l
          FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT l FROM b_win),
d_win AS (SELECT doc_id, s, l, array_to_string(w[s:s + l - 1], ' ') AS win
          FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, lengths WHERE len(w) >= l)),
hit AS (SELECT doc_id, s, d_win.l, item FROM d_win JOIN b_win USING (win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, s, l FROM hit), unnest(range(s, s + l)) AS t(p) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hw.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(hi.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words hw USING (doc_id) LEFT JOIN hit_items hi USING (doc_id)""")
def op3(spark, d):
    found = decontaminate.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        hex_of(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


# ---- 4: WARC bundles, written and read back ----------------------------------------------------------------------------------

_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((('0x' || substr(h, {5 * i + 1}, 5))::BIGINT >> {15 - 5 * j}) & 31) AS BIGINT), 1)"
                      for i in range(8) for j in range(4))


@query("op4_warc_bundles", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM f""")
def op4(spark, d):
    root = warc.archive_folder(spark)
    index = warc.write_bundles(table(spark, d, "pages"), root)
    return warc.fetch(index, root, with_payload=False).drop("url", "payload")


# ---- 5: forty shards of nearly equal bytes ------------------------------------------------------------------------------

@query("op5_histogram_sharding")
def op5(spark, d):
    placed = shard.assign(table(spark, d, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# ---- 6: byte-level BPE ---------------------------------------------------------------------------------------------------

def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op6_byte_bpe")
def op6(spark, d):
    return bpe.digests(table(spark, d, "documents"), vocabulary_path()).withColumnRenamed("id", "doc_id")


# ---- 7: quality rules ----------------------------------------------------------------------------------------------------

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CLASS_SETS = ["a-z", "A-Z", r"\x{80}-\x{10FFFF}", "0-9", r"\x20\x09-\x0D", r".,;:'\"()?-".replace("'", "''"), r"^"]
_CLASS_COUNTS = ", ".join(f"length(t) - length(regexp_replace(t, '[{c}]', '', 'g')) AS c{i}" for i, c in enumerate(_CLASS_SETS[:-1]))
_JS = "(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END) / 2"


@query("op7_quality_rules", rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, array_to_string(w[s:s + 4], ' ')) AS times FROM d, unnest(range(1, len(w) - 3)) AS u(s)),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM grams, unnest(range(s, s + 5)) AS u(p) WHERE times > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
           coalesce(repeats.n, 0) AS n_repeat_words FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)),
lw AS (SELECT doc_id, lang, unnest(regexp_extract_all({LOWERED.format('t')}, '[a-z\x{{80}}-\x{{10FFFF}}]+')) AS word FROM d),
totals AS (SELECT lang, count(*) AS n FROM lw WHERE lang IS NOT NULL GROUP BY lang),
langs AS (SELECT lang, n FROM totals WHERE n >= {quality.LANGUAGE_SHARE} * (SELECT sum(n) FROM totals)),
top AS (SELECT lang, word, c / n::DOUBLE AS q FROM (SELECT lang, word, count(*) AS c, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rk
          FROM lw WHERE lang IS NOT NULL GROUP BY lang, word) JOIN langs USING (lang) WHERE rk <= {quality.COMMON} AND c >= {quality.WORD_SHARE} * n),
sizes AS (SELECT doc_id, count(*) AS n FROM lw GROUP BY doc_id HAVING count(*) >= {quality.WORD_WORDS}),
counted AS (SELECT doc_id, word, count(*) AS c FROM lw GROUP BY doc_id, word),
cells AS (SELECT s.doc_id, t.lang, t.q, coalesce(c.c, 0) / s.n::DOUBLE AS p FROM sizes s CROSS JOIN top t LEFT JOIN counted c ON c.doc_id = s.doc_id AND c.word = t.word),
bins AS (SELECT doc_id, lang, p, q FROM cells UNION ALL SELECT doc_id, lang, 1 - sum(p), 1 - sum(q) FROM cells GROUP BY doc_id, lang),
word_near AS (SELECT doc_id, min(js) AS js FROM (SELECT doc_id, lang, sqrt(greatest(0, sum({_JS.format(p='p', q='q')}))) AS js FROM bins GROUP BY doc_id, lang) GROUP BY doc_id),
cc AS (SELECT doc_id, lang, length(t) AS n, {_CLASS_COUNTS} FROM d),
cx AS (SELECT *, n - c0 - c1 - c2 - c3 - c4 - c5 AS c6 FROM cc),
ref AS (SELECT lang, {', '.join(f'sum(c{i}) / sum(cx.n)::DOUBLE AS r{i}' for i in range(7))} FROM cx JOIN langs USING (lang) GROUP BY lang),
class_near AS (SELECT doc_id, min(sqrt(greatest(0, {' + '.join('(' + _JS.format(p=f'(c{i} / n::DOUBLE)', q=f'r{i}') + ')' for i in range(7))}))) AS js
               FROM cx, ref WHERE n >= {quality.CLASS_CHARS} GROUP BY doc_id),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT failed.*, NOT base_failed AND NOT coalesce(class_near.js > {quality.CLASS_LIMIT}, FALSE) AND NOT coalesce(word_near.js > {quality.WORD_LIMIT}, FALSE) AS kept
FROM failed LEFT JOIN class_near USING (doc_id) LEFT JOIN word_near USING (doc_id)""")
def op7(spark, d):
    judged = quality.judge(table(spark, d, "documents"))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# ---- 8: near-duplicate groups -------------------------------------------------------------------------------------------

@query("op8_minhash_near_dedup", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + least(len(w), 5) - 1], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(s) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)""")
def op8(spark, d):
    return minhash.near_duplicates(table(spark, d, "documents")).drop("mark")


# ---- 9: lines that an earlier document holds ----------------------------------------------------------------------------

@query("op9_line_dedup", r"""
WITH l AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256 FROM f GROUP BY doc_id""")
def op9(spark, d):
    done = line_dedup.deduplicate_lines(table(spark, d, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", hex_of(F.col("kept_text")).alias("kept_sha256"))


# ---- 10: languages by a conditional random field ---------------------------------------------------------------------------

@query("op10_crf_language_id")
def op10(spark, d):
    """Learns from documents whose crc32(doc_id) mod 3 is not 1; the others are held out."""
    docs = table(spark, d, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(3)) == 1, F.lit(False))
    model = langid.train(docs.filter(~held_out))
    predicted = langid.predict(docs, model)
    held = F.coalesce(F.pmod(F.crc32(F.encode(F.col("id").cast("string"), "utf-8")), F.lit(3)) == 1, F.lit(False))
    return predicted.select(F.col("id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")


# ---- 11: a Merkle manifest of the documents -----------------------------------------------------------------------------

_DEPTH = 5        # levels that the SQL unrolls: 16 ** 5 leaves a source and as many sources


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree_sql(name: str, base: str) -> str:
    """Levels ``name``0.. of the trees in ``base`` (g, i, n, h), with what stands before and after each node in its run."""
    parts = [f"{name}0 AS ({base})"]
    for k in range(_DEPTH):
        parts.append(f"{name}{k + 1} AS (SELECT g, j AS i, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(hs) ELSE hs END AS h FROM "
                     f"(SELECT g, i // 16 AS j, n, string_agg(h, '' ORDER BY i) AS hs FROM {name}{k} GROUP BY 1, 2, 3))")
        parts.append(f"{name}s{k} AS (SELECT x.g, x.i, any_value(x.n) AS n, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS b, "
                     f"coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS a FROM {name}{k} x JOIN {name}{k} y ON x.g = y.g AND x.i // 16 = y.i // 16 GROUP BY 1, 2)")
    return ",\n".join(parts)


def _fold_sql(name: str, first: str, group: str, index: str) -> str:
    """Folds ``f`` and gathers ``p`` up the levels of one tree, from the CTE ``first``."""
    parts, last = [], first
    for k in range(_DEPTH):
        parts.append(f"{name}f{k} AS (SELECT q.* EXCLUDE (f, p), CASE WHEN s.n > 1 THEN sha256(s.b || q.f || s.a) ELSE q.f END AS f, q.p || s.b || s.a AS p "
                     f"FROM {last} q JOIN {name}s{k} s ON s.g = q.{group} AND s.i = q.{index} // {16 ** k})")
        last = f"{name}f{k}"
    return ",\n".join(parts)


_CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))")


@query("op11_merkle_manifest", f"""
WITH d AS (SELECT doc_id, coalesce('s' || source, 'n') AS g, {_leaf_sql('text')} AS leaf, CASE WHEN {_CRC} % 5 = 0 THEN {_leaf_sql(LOWERED.format('text'))} ELSE {_leaf_sql('text')} END AS f FROM documents),
l AS (SELECT *, '' AS p, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
{_tree_sql('x', 'SELECT g, i, n, leaf AS h FROM l')},
{_tree_sql('t', f"SELECT 'all' AS g, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h, g AS source FROM x{_DEPTH}")},
{_fold_sql('x', 'l', 'g', 'i')},
u AS (SELECT q.* EXCLUDE (i, g), 'all' AS g, t0.i, t0.h AS subroot FROM x{'f'}{_DEPTH - 1} q JOIN t0 ON t0.source = q.g),
{_fold_sql('t', 'u', 'g', 'i')}
SELECT doc_id, leaf, subroot, t{_DEPTH}.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = t{_DEPTH}.h AS verified FROM tf{_DEPTH - 1}, t{_DEPTH}""")
def op11(spark, d):
    """Documents by source; where 5 divides crc32(doc_id) the text claims to be in lower case."""
    docs = table(spark, d, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")), F.lit(5)) == 0
    claim = F.when(tampered, merkle.leaf_digest(*values, ascii_lower(F.col("text"))))
    manifest = merkle.build(merkle.leaves(docs, "source", "doc_id", [*values, F.col("text")], claim))
    return merkle.audit(manifest).withColumnRenamed("id", "doc_id")


# ---- 12: the best documents of each benchmark item ----------------------------------------------------------------------

_TERMS = rf"regexp_extract_all({LOWERED.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op12_ranked_search", rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents),
t AS (SELECT r, any_value(doc_id) AS doc_id, any_value(len(w)) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, w, unnest(w) AS term FROM d) GROUP BY r, term),
s AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
i AS (SELECT item_id, row_number() OVER () AS q, unnest({_TERMS}) AS term FROM benchmark),
g AS (SELECT item_id, q, term, count(*) AS times FROM i GROUP BY ALL),
p AS (SELECT g.q, g.item_id, t.doc_id, t.r, CAST(sum(g.times * w.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // l)))) AS BIGINT) AS score
      FROM g JOIN t USING (term) JOIN w USING (term), s GROUP BY 1, 2, 3, 4)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM p WHERE score > 0) WHERE rank <= 10""")
def op12(spark, d):
    return ranked.top_documents(table(spark, d, "documents"), table(spark, d, "benchmark"))


# ---- 13: equal texts ------------------------------------------------------------------------------------------------------

@query("op13_exact_dedup", f"""
WITH d AS (SELECT doc_id, {LOWERED.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256 FROM d WINDOW g AS (PARTITION BY t)""")
def op13(spark, d):
    return exact_dedup.duplicates(table(spark, d, "documents"))
