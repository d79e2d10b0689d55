"""Language of texts, word by word: a linear-chain conditional random field.

A word's score for each language comes from hashed features: its n-grams of 2 to 4 bytes with its borders marked, longer ones at the
borders (affixes), and how its share in each language's lexicon compares.  Learned transitions tie neighbouring words, and
forward-backward gives every word's distribution over the languages, so text that switches between languages is labelled word by
word.  A text's language is the one with the largest sum over its words; its score is that language's share of the sum.

The lexicon is counted over all learning texts (see :mod:`freshet.llm.quality`).  Weights are fitted on the driver from a bounded sample:
about ``SAMPLE_TEXTS`` texts a language, chosen by hash, and of each at most ``SEGMENTS`` stretches of ``STRETCH`` words from all over it;
stretches of several languages are put together so that transitions are learned.

Long texts are cut into blocks that are carried through as transfer matrices, which is exact and keeps the array loops short.

Defined cases: a NULL text and one without a letter is ``und`` with score 0; a text without learned languages is ``und`` too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from freshet.llm.bpe import LETTER, character_classes
from freshet.llm.kernels import SLICE_BYTES, mix, span_hashes
from freshet.llm.quality import references, word_hashes

SAMPLE_TEXTS = 300
SEGMENTS = 4
STRETCH = 40
SEQUENCES = 2400        # put together for learning, each of LENGTH words
LENGTH = 64
BUCKETS = 1 << 16
BLOCK = 64        # words carried through as one transfer matrix
LEXICON_WORDS = 2000        # of a language
LEXICON_SHARE = 0.0002
UNKNOWN = 1e-5
ROUNDS, BATCH, RATE = 4, 48, 0.3
UNDETERMINED = "und"


def letter_runs(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, text) of the runs of letters, small letters throughout."""
    raw = [t.lower().encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(data):
        return data, *(np.zeros(0, np.int64),) * 3
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    letter = (character_classes()[points] == LETTER)[np.cumsum((data & 0xC0) != 0x80) - 1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(letter & (edge[:-1] | ~np.append(False, letter[:-1])))
    ends = np.flatnonzero(letter & (edge[1:] | ~np.append(letter[1:], False))) + 1
    return data, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, first feature of each word)."""
    size = ends - starts + 2
    at = np.cumsum(size) - size
    flat = np.full(int(size.sum()), 32, np.uint8)
    inside = np.ones(len(flat), bool)
    inside[at] = inside[at + size - 1] = False
    flat[inside] = data[np.repeat(starts - at - 1, size - 2) + np.flatnonzero(inside)] if len(starts) else 0
    word = np.repeat(np.arange(len(starts)), size)
    left, right = np.arange(len(flat)) - at[word], at[word] + size[word] - np.arange(len(flat))
    buckets, owner = [], []
    for n in (2, 3, 4, 5, 6):
        here = np.flatnonzero(right >= n)
        if n > 4:        # only at the borders
            here = here[(left[here] == 0) | (right[here] == n)]
        h = np.full(len(here), n, np.uint64)
        for j in range(n):
            h = mix(h) + flat[here + j].astype(np.uint64)
        buckets.append((mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64))
        owner.append(word[here])
    bucket, owner = np.concatenate(buckets), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(starts)))


class Model:
    """Weights of hashed features, of the lexicon and of transitions."""

    def __init__(self, langs: list[str], lexicon: list[dict]):
        self.langs, n = langs, len(langs)
        words = sorted({w for r in lexicon for w in r["words"]})
        self.words = word_hashes(words)
        order = np.argsort(self.words)
        number = {w: i for i, w in enumerate(words)}
        share = np.full((len(words) + 1, n), UNKNOWN)
        for r in lexicon:
            for w, s in zip(r["words"], r["shares"]):
                share[number[w], langs.index(r["lang"])] += s
        logs = np.log(share)
        logs -= logs.sum(axis=1, keepdims=True) / max(1, n)
        self.words, self.lexicon = self.words[order], np.concatenate([logs[:-1][order], logs[-1:]]).astype(np.float32)
        self.weights = np.zeros((BUCKETS, n), np.float32)
        self.lexicon_weight = np.zeros(n, np.float32)
        self.transitions = np.zeros((n, n), np.float32)

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Row of the lexicon of each word; the last one for words that it lacks."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, len(self.words))

    def scores(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(words, languages) of the given words; equal words are worked out once."""
        h = span_hashes(data, starts, ends)
        _, one, which = np.unique(h, return_index=True, return_inverse=True)
        bucket, first = features(data, starts[one], ends[one])
        each = np.add.reduceat(self.weights[bucket], first, axis=0) + self.lexicon[self.look_up(h[one])] * self.lexicon_weight
        return each[which]

    def fit(self, stretches: list[tuple[int, list[str]]], seed: int = 0) -> None:
        """Learn from (language, words) stretches by gradient steps on the likelihood of put-together sequences."""
        rng = np.random.default_rng(seed)
        by_lang = [[s for lang, s in stretches if lang == k and s] for k in range(len(self.langs))]
        usable = [k for k, s in enumerate(by_lang) if s]
        if len(usable) < 2:
            return
        sequences, labels = [], []
        for _ in range(SEQUENCES):
            words, tags = [], []
            while len(words) < LENGTH:
                k = usable[rng.integers(len(usable))]
                s = by_lang[k][rng.integers(len(by_lang[k]))]
                a, m = rng.integers(max(1, len(s) - 4)), rng.integers(4, STRETCH)
                words += s[a:a + m]
                tags += [k] * len(s[a:a + m])
            sequences.append(words[:LENGTH])
            labels.append(tags[:LENGTH])
        listed = sorted({w for s in sequences for w in s})
        number = {w: i for i, w in enumerate(listed)}
        ids, tags = np.array([[number[w] for w in s] for s in sequences]), np.array(labels)
        raw = [w.encode() for w in listed]
        ends = np.cumsum([len(r) for r in raw])
        starts, data = ends - [len(r) for r in raw], np.frombuffer(b"".join(raw), np.uint8)
        bucket, first = features(data, starts, ends)
        count = np.diff(np.append(first, len(bucket)))
        lex = self.lexicon[self.look_up(span_hashes(data, starts, ends))]
        n = len(self.langs)
        square = [np.full(x.shape, 1e-6) for x in (self.weights, self.lexicon_weight, self.transitions)]
        for _ in range(ROUNDS):
            order = rng.permutation(len(ids))
            for a in range(0, len(order), BATCH):
                batch = order[a:a + BATCH]
                own, at = np.unique(ids[batch], return_inverse=True)
                at = at.reshape(ids[batch].shape)
                spans = np.concatenate([np.arange(first[w], first[w] + count[w]) for w in own.tolist()])
                mine = np.cumsum(count[own]) - count[own]
                e = np.add.reduceat(self.weights[bucket[spans]], mine, axis=0) + lex[own] * self.lexicon_weight
                e = e[at]
                e = np.exp(e - e.max(axis=2, keepdims=True))
                post, pairs = _marginals(e, np.exp(self.transitions))
                truth = np.zeros_like(post)
                np.put_along_axis(truth, tags[batch][:, :, None], 1, axis=2)
                slope = (truth - post).reshape(-1, n) / len(batch)
                of_word = np.stack([np.bincount(at.ravel(), slope[:, k], len(own)) for k in range(n)], axis=1)
                wide = np.repeat(of_word, count[own], axis=0)
                g_w = np.stack([np.bincount(bucket[spans], wide[:, k], BUCKETS) for k in range(n)], axis=1)
                seen = np.bincount((tags[batch][:, :-1] * n + tags[batch][:, 1:]).ravel(), minlength=n * n).reshape(n, n)
                for x, g, s in zip((self.weights, self.lexicon_weight, self.transitions), (g_w, (of_word * lex[own]).sum(axis=0), (seen - pairs) / len(batch)), square):
                    s += g * g
                    x += RATE * g / np.sqrt(s)


def _marginals(e: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors and expected transition counts of sequences of equal length."""
    n, t, k = e.shape
    forward, backward = np.empty_like(e), np.ones_like(e)
    now = np.full((n, k), 1 / k)
    for i in range(t):
        now = (now @ a) * e[:, i]
        now /= now.sum(axis=1, keepdims=True)
        forward[:, i] = now
    for i in range(t - 1, 0, -1):
        b = (e[:, i] * backward[:, i]) @ a.T
        backward[:, i - 1] = b / b.sum(axis=1, keepdims=True)
    post = forward * backward
    post /= post.sum(axis=2, keepdims=True)
    pairs = np.zeros((k, k))
    for i in range(1, t):
        joint = forward[:, i - 1, :, None] * a * (e[:, i] * backward[:, i])[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return post, pairs


def posteriors(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Distribution of each word, for sequences of the given lengths one after the other.

    Every sequence is cut into blocks.  The transfer matrix of a block is the product of its steps; the matrices give the messages at
    the block borders, and from these all blocks are worked out side by side.
    """
    lengths = lengths[lengths > 0]
    n, k = scores.shape
    if not n:
        return np.zeros((0, k))
    a = np.exp(transitions - transitions.max()).astype(np.float64)
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64) + 1e-12
    blocks = -(-lengths // BLOCK)
    first_block, first_word = np.cumsum(blocks) - blocks, np.cumsum(lengths) - lengths
    sequence = np.repeat(np.arange(len(lengths)), blocks)
    rank = np.arange(len(sequence)) - first_block[sequence]
    begin = first_word[sequence] + rank * BLOCK
    size = np.minimum(BLOCK, lengths[sequence] - rank * BLOCK)
    transfer = np.broadcast_to(np.eye(k), (len(sequence), k, k)).copy()
    for t in range(BLOCK):
        live = np.flatnonzero(size > t)
        step = (transfer[live] @ a) * e[begin[live] + t][:, None, :]
        transfer[live] = step / step.sum(axis=(1, 2), keepdims=True)
    ahead, behind = np.full((len(sequence), k), 1 / k), np.full((len(sequence), k), 1 / k)
    for r in range(1, int(blocks.max())):
        b = np.flatnonzero(rank == r) if r < 4 else first_block[blocks > r] + r
        m = (ahead[b - 1][:, None, :] @ transfer[b - 1])[:, 0]
        ahead[b] = m / m.sum(axis=1, keepdims=True)
    for r in range(int(blocks.max()) - 1, 0, -1):
        b = first_block[blocks > r] + r
        m = (transfer[b] @ behind[b][:, :, None])[:, :, 0]
        behind[b - 1] = m / m.sum(axis=1, keepdims=True)
    out = np.empty((n, k))
    now = ahead
    for t in range(BLOCK):
        live = np.flatnonzero(size > t)
        step = (now[live] @ a) * e[begin[live] + t]
        now[live] = out[begin[live] + t] = step / step.sum(axis=1, keepdims=True)
    now = behind
    for t in range(BLOCK - 1, -1, -1):
        live = np.flatnonzero(size > t)
        at = begin[live] + t
        post = out[at] * now[live]
        out[at] = post / post.sum(axis=1, keepdims=True)
        step = (e[at] * now[live]) @ a.T
        now[live] = step / step.sum(axis=1, keepdims=True)
    return out


def _text_groups(column: pa.Array, limit: int = SLICE_BYTES):
    at, held, size = 0, [], 0
    for i, text in enumerate(column.to_pylist()):
        held.append(text or "")
        size += len(held[-1])
        if size >= limit:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held


_STRETCHES = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string()))])


def _stretches(batches):
    """Up to ``SEGMENTS`` stretches of each text, evenly spread over it."""
    for batch in batches:
        langs, out = batch.column(0).to_pylist(), []
        for at, texts in _text_groups(batch.column(1)):
            for i, text in enumerate(texts):
                data, starts, ends, _ = letter_runs([text])
                parts = min(SEGMENTS, max(1, len(starts) // STRETCH))
                for p in range(parts if len(starts) else 0):
                    a = p * len(starts) // parts
                    some = [(s, e) for s, e in zip(starts[a:a + STRETCH].tolist(), ends[a:a + STRETCH].tolist())]
                    out.append((langs[at + i], [data[s:e].tobytes().decode()[:64] for s, e in some]))
        yield pa.record_batch([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.list_(pa.string()))], schema=_STRETCHES)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_TEXTS) -> Model:
    """A model of the languages in ``docs``; rows without a language teach nothing."""
    source = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = source.filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], [])
    model = Model(langs, references(known, common=LEXICON_WORDS, share=LEXICON_SHARE, least=1))
    lot = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2**31)).cast("double") / 2**31
    chance = F.element_at(F.create_map(*[F.lit(x) for lang, c in counts.items() for x in (lang, min(1.0, sample / c))]), F.col("lang"))
    chosen = known.filter(lot < chance).select("lang", "text").mapInArrow(_stretches, "lang string, words array<string>")
    rows = sorted((r["lang"], list(r["words"])) for r in chosen.collect())
    model.fit([(langs.index(lang), words) for lang, words in rows])
    return model


_PREDICTED = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _predict(model: Model):
    def run(batches):
        n = len(model.langs)
        for batch in batches:
            for at, texts in _text_groups(batch.column(1)):
                data, starts, ends, owner = letter_runs(texts)
                lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if len(starts) and n:
                    post = posteriors(model.scores(data, starts, ends), np.bincount(owner, minlength=len(texts)), model.transitions)
                    total = np.stack([np.bincount(owner, post[:, k], len(texts)) for k in range(n)], axis=1)
                    words = total.sum(axis=1)
                    best = total.argmax(axis=1)
                    some = words > 0
                    score[some] = np.clip(total[some, best[some]] / words[some], 0, 1)
                    lang = [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), some.tolist())]
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), pa.array(lang), pa.array(score)], schema=_PREDICTED)
    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred and score."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _predict(model), "id long, lang_pred string, score double")


def label_words(text: str, model: Model) -> list[tuple[str, str]]:
    """(word, language) of one text, for code-switched text."""
    data, starts, ends, _ = letter_runs([text])
    if not len(starts) or not model.langs:
        return []
    post = posteriors(model.scores(data, starts, ends), np.array([len(starts)]), model.transitions)
    return [(data[s:e].tobytes().decode(), model.langs[k]) for s, e, k in zip(starts.tolist(), ends.tolist(), post.argmax(axis=1).tolist())]
