"""Quality rules: word and line counts, and how far a text's distributions lie from those of known languages.

A text has a histogram of character classes and one of its language's common words (all other words are one more bin).  The same
histograms over all texts of a language are its reference.  A text is rejected when its Jensen-Shannon distance to the nearest
reference is above a limit, for either histogram; texts too short for a histogram are not judged by it, nor are texts whose own
language has no reference: other languages say nothing about them.

References cover every text.  A language has one if it holds at least ``LEAST_WORDS`` words, whatever else is in the table; its
common words are the ``COMMON`` most frequent ones with at least ``WORD_SHARE`` of its words.  They count as a word histogram only
if they hold so large a share of its words that a text with none of them lies beyond the limit (about a third at 0.43); a weaker
list, as of a language whose clauses are one run of letters, would let every text pass.  Texts of such a language are judged by
their character classes alone.  Words are counted in Spark; the driver
sees at most ``COMMON`` words of a language, whatever the size of the corpus.

Defined cases: a NULL or empty text has no words and fails; a NULL language adds to no reference, and its texts are judged by the
nearest one; without any reference only the base rules judge.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from freshet.llm.kernels import IS_SPACE, LOWER, gram_hashes, mix, owners, slices, span_hashes, words
from freshet.session import stored_table

COMMON = 50
WORD_SHARE = 0.001
LEAST_WORDS = 5000        # words of a language from which it has a reference
LANGUAGE_SHARE = 0.001        # only in the SQL, which takes languages by their share of all words
CLASS_LIMIT = 0.33
WORD_LIMIT = 0.43
CLASS_CHARS = 200        # characters from which the class histogram counts
WORD_WORDS = 50        # words from which the word histogram counts

# class of each byte: small letter, capital, other letter (first byte of a longer character), digit, blank, sentence mark, symbol
CLASSES = 7
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[0xC0:], _CLASS[48:58] = 0, 1, 2, 3
_CLASS[IS_SPACE] = 4
_CLASS[[ord(c) for c in ".,;:'\"-()?"]] = 5
_CLASS[0x80:0xC0] = CLASSES        # later bytes of a character count for nothing
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[0x80:] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(flags, dtype=np.int64))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base features of each text of a slice."""
    n = len(offsets) - 1
    starts, ends = words(data, offsets)
    owner = owners(offsets, starts)
    h = span_hashes(data, starts, ends)
    solid = ~IS_SPACE[data]
    # words inside five-word windows that the text has twice
    grams = gram_hashes(h, 5)
    whole = np.flatnonzero(owner[:len(grams)] == owner[4:]) if len(grams) else np.zeros(0, np.int64)
    keys = mix(grams[whole] + mix(owner[whole].astype(np.uint64)))
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = whole[count[which] > 1]
    depth = np.cumsum(np.bincount(again, minlength=len(h) + 5) - np.bincount(again + 5, minlength=len(h) + 5))[:len(h)]
    # lines with a word, less the different ones
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1][offsets[:-1] < offsets[1:]], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    next_break = np.append(breaks, len(data))[np.searchsorted(breaks, line_starts)]
    line_ends = np.minimum(next_break, offsets[owners(offsets, line_starts) + 1])
    seen = np.append(0, np.cumsum(solid, dtype=np.int64))
    worded = seen[line_ends] > seen[line_starts]
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_owner = owners(offsets, line_starts)
    line_keys = mix(span_hashes(data, line_starts, line_ends) + mix(line_owner.astype(np.uint64)))
    _, one = np.unique(line_keys, return_index=True)
    of = lambda who: np.bincount(who, minlength=n).astype(np.int64)        # noqa: E731
    return {"n_words": of(owner), "word_chars": _per_text(solid & ((data & 0xC0) != 0x80), offsets), "n_symbols": _per_text(_SYMBOL[data], offsets),
            "n_dup_lines": of(line_owner) - of(line_owner[one]), "n_repeat_words": of(owner[depth > 0])}


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    who = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(who * (CLASSES + 1) + _CLASS[data], minlength=n * (CLASSES + 1)).reshape(n, CLASSES + 1)[:, :CLASSES]


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(small-letter bytes, starts, ends, text) of the runs of letters."""
    low = LOWER[data]
    spaced = np.where(_LETTER[low], low, np.uint8(32))
    starts, ends = words(spaced, offsets)
    return low, starts, ends, owners(offsets, starts)


def _slices_with_language(batches):
    for batch in batches:
        lang = batch.column(0).to_pylist()
        for a, b, data, offsets in slices(batch.column(1)):
            names = sorted({x for x in lang[a:b] if x is not None})
            number = {x: i for i, x in enumerate(names)}
            yield names, np.array([number.get(x, -1) for x in lang[a:b]]), data, offsets


_COUNTED = pa.schema([("lang", pa.string()), ("word", pa.string()), ("count", pa.int64()), ("classes", pa.list_(pa.int64()))])


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """These pieces of the data, as strings."""
    size = ends - starts
    stops = np.cumsum(size)
    flat = data[np.repeat(starts - (stops - size), size) + np.arange(int(size.sum()))]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(np.append(0, stops).astype(np.int32)), pa.py_buffer(flat))


def _counted(batches):
    """How often a slice has each word of each language; rows without a word hold the number of all its words and its class counts."""
    for names, lang, data, offsets in _slices_with_language(batches):
        low, starts, ends, owner = letter_words(data, offsets)
        classes = class_counts(data, offsets)
        of = lang[owner]
        mine = np.flatnonzero(of >= 0)
        of, starts, ends = of[mine], starts[mine], ends[mine]
        _, one, count = np.unique(mix(span_hashes(low, starts, ends) + mix(of.astype(np.uint64))), return_index=True, return_counts=True)
        sums = np.zeros((len(names), CLASSES), np.int64)
        np.add.at(sums, lang[lang >= 0], classes[lang >= 0])
        named = pa.array(names, pa.string())
        yield pa.record_batch([named, pa.nulls(len(names), pa.string()), pa.array(np.bincount(of, minlength=len(names)).astype(np.int64)),
                               pa.array(sums.tolist(), pa.list_(pa.int64()))], schema=_COUNTED)
        yield pa.record_batch([named.take(pa.array(of[one])), _spans(low, starts[one], ends[one]), pa.array(count.astype(np.int64)),
                               pa.nulls(len(one), pa.list_(pa.int64()))], schema=_COUNTED)


def word_hashes(listed: list[str]) -> np.ndarray:
    """The hashes of these words, by the same kernel."""
    raw = [w.encode() for w in listed]
    ends = np.cumsum([len(w) for w in raw]).astype(np.int64)
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends) if raw else np.zeros(0, np.uint64)


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = COMMON, share: float = WORD_SHARE,
               least: int = LEAST_WORDS) -> list[dict]:
    """Per language: lang, classes (shares of the character classes), words and shares (its common words)."""
    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = stored_table(source.mapInArrow(_counted, "lang string, word string, count long, classes array<long>")
                           .groupBy("lang", "word").agg(F.sum("count").alias("count"), *[F.sum(F.get("classes", i)).alias(f"class_{i}") for i in range(CLASSES)]), "word-counts")
    langs = counted.filter("word IS NULL").filter(F.col("count") >= max(1, least)).drop("word")
    totals = {r["lang"]: r for r in langs.collect()}        # a row for each language
    frequent = counted.filter("word IS NOT NULL").select("lang", "word", "count").join(F.broadcast(langs.select("lang", F.col("count").alias("total"))), "lang").filter(F.col("count") >= share * F.col("total"))
    best = frequent.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))).filter(F.col("at") <= common)
    held: dict[str, list] = {lang: [] for lang in totals}
    for r in sorted(best.collect(), key=lambda r: (r["lang"], r["at"])):
        held[r["lang"]].append((r["word"], r["count"] / r["total"]))
    return [{"lang": lang, "classes": [t[f"class_{i}"] / max(1, sum(t[f"class_{j}"] for j in range(CLASSES))) for i in range(CLASSES)],
             "words": [w for w, _ in held[lang]], "shares": [s for _, s in held[lang]]} for lang, t in sorted(totals.items())]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of ``p`` to ``q``."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.maximum(0, (left + right) / 2))


def tells_apart(ref: dict, limit: float) -> bool:
    """Whether a text with none of the reference's common words lies beyond the limit."""
    held = np.append(ref["shares"], 1 - sum(ref["shares"]))
    return bool(distance(np.eye(len(held))[-1:], held)[0] > limit)


_JUDGED = pa.schema([("id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                     ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("class_distance", pa.float64()), ("word_distance", pa.float64())])


def _judge(refs: list[dict], class_limit: float, word_limit: float, places: tuple[int, int] | None = None):
    """Judgements of (id, text, lang) batches; with ``places``, those of text and language, the kept rows of the batches as they are."""
    text_at, lang_at = places or (1, 2)
    worded = [r for r in refs if tells_apart(r, word_limit)]
    by_class, by_word = ({None, *(r["lang"] for r in some)} for some in (refs, worded))
    vocabulary = sorted({w for r in worded for w in r["words"]})
    hashes = word_hashes(vocabulary)
    order = np.argsort(hashes)
    ranked, number = hashes[order], {w: i for i, w in enumerate(vocabulary)}

    def distances(data, offsets, lang):
        n = len(offsets) - 1
        classes = class_counts(data, offsets).astype(float)
        chars = classes.sum(axis=1)
        low, starts, ends, owner = letter_words(data, offsets)
        total = np.bincount(owner, minlength=n).astype(float)
        near_class, near_word = np.full(n, np.nan), np.full(n, np.nan)
        if vocabulary and len(starts):
            h = span_hashes(low, starts, ends)
            at = np.minimum(np.searchsorted(ranked, h), len(ranked) - 1)
            hit = ranked[at] == h
            counts = np.bincount(owner[hit] * len(ranked) + order[at[hit]], minlength=n * len(ranked)).reshape(n, len(ranked))
            long = np.flatnonzero(np.array([x in by_word for x in lang], bool) & (total >= WORD_WORDS))
            for r in worded:
                own = counts[long][:, [number[w] for w in r["words"]]] / total[long, None]
                p = np.column_stack([own, 1 - own.sum(axis=1)])
                near_word[long] = np.fmin(near_word[long], distance(p, np.append(r["shares"], 1 - sum(r["shares"]))))
        long = np.flatnonzero(np.array([x in by_class for x in lang], bool) & (chars >= CLASS_CHARS))
        for r in refs:
            near_class[long] = np.fmin(near_class[long], distance(classes[long] / chars[long, None], np.array(r["classes"])))
        return near_class, near_word

    def run(batches):
        for batch in batches:
            lang = batch.column(lang_at).cast(pa.string()).to_pylist()
            for a, b, data, offsets in slices(batch.column(text_at)):
                f = base_counts(data, offsets)
                near_class, near_word = distances(data, offsets, lang[a:b])
                failed = (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])
                kept = ~failed & ~(near_class > class_limit) & ~(near_word > word_limit)
                if places is not None:
                    yield batch.slice(a, b - a).filter(pa.array(kept))
                    continue
                yield pa.record_batch([batch.column(0).slice(a, b - a), *(pa.array(v) for v in f.values()), pa.array(failed), pa.array(kept),
                                       pa.array(near_class, from_pandas=True), pa.array(near_word, from_pandas=True)], schema=_JUDGED)
    return run


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """Per row: id, the base counts, base_failed, kept, and both distances to the nearest reference (NULL: too short to judge, or of a language without one)."""
    refs = references(docs, text_col, lang_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).mapInArrow(
        _judge(refs, class_limit, word_limit), "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, class_distance double, word_distance double")


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT) -> DataFrame:
    """The rows of ``docs`` that are kept, all their columns unchanged; nothing is shuffled."""
    refs = references(docs, text_col, lang_col)
    return docs.mapInArrow(_judge(refs, class_limit, word_limit, (docs.columns.index(text_col), docs.columns.index(lang_col))), docs.schema)
