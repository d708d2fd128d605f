"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text, and the lengths to which they
compress each window of a text.

A window is a word, lower case, written three times: one long match in a dictionary that knows the word then outweighs
a frame's fixed costs. A word under 4 bytes is spelled with hyphens, else its match would save too little. A phrase of
two or three neighbouring words, without the punctuation around them, makes a window of its own in dictionaries of
phrases. Evidence of a window is the length under the ordinary dictionary less that under the toxic one.
Both dictionaries hold the same ordinary text; the toxic one adds windows of toxic text, the other as much further
ordinary text, so that ordinary windows compress alike and their evidence is near 0. Toxic text is in most of its words
ordinary too; the windows that go into the toxic dictionary are all words of toxic training texts that are short or have
a beginning, and all phrases without such a word, in at least MARKED_TEXTS toxic training texts and far more frequent
there than in ordinary ones. No share of the toxic texts is asked for, so a marker of a small language counts as much as
one of a large language in as many texts. Phrases are compressed where all their words occur in marked phrases; others
have no evidence. The dictionaries are content only, without entropy tables, because literals' tables made from
different texts would blur the difference. Words repeat from text to text, so a worker compresses each window once.
Evidence thresholds are calibrated by logistic regression on training texts.

Training takes at most `toxic_rows` and `ordinary_rows` labelled texts of at most `train_chars` characters, chosen by a
hash of doc_id; scoring reads every text whole.

Defined results: a null text scores as the empty text, which has no evidence; repeated rows score alike; labels that
contradict each other count as toxic; without training rows of both classes every score is 0; an empty table gives no
rows.
"""

from __future__ import annotations

import dataclasses
import functools
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import WordMemo, small_batches, text_or_empty
from harvestry.llm.neardup import bands_of, normal

TOXIC_ROWS, ORDINARY_ROWS, TRAIN_CHARS = 2000, 4000, 32_768
LEVEL, ORDINARY_BYTES = 19, 24_000
#: Lengths of word beginnings in bytes (shorter words count whole) and of phrases in words; the least number of toxic texts
#: that hold one; the least ratio of its share of toxic texts to that of ordinary texts, for the strict and the wide
#: dictionary; the least likelihood-ratio statistic.
STEM_BYTES, PHRASE_WORDS, MARKED_TEXTS, STEM_RATIOS, STEM_G = range(4, 9), (2, 3), 4, (20.0, 2.0), 24.0

Pairs = tuple[tuple[bytes, bytes], ...]


@dataclasses.dataclass(frozen=True)
class Phrases:
    """Dictionaries of phrases as in Model, and the words of all marked phrases."""

    pairs: Pairs = ()
    words: frozenset[str] = frozenset()


@dataclasses.dataclass(frozen=True)
class Model:
    """pairs: toxic and ordinary dictionary, strict and wide."""

    pairs: Pairs
    phrases: Phrases
    weights: tuple[float, ...]


def _window(word: bytes) -> bytes:
    if len(word) < STEM_BYTES[0]:
        word = b"-" + b"".join(b"%c-" % c for c in word)
    return b" ".join([word] * 3)


def _phrase_window(phrase: tuple[str, ...]) -> bytes:
    return (_bytes(" ".join(phrase)) + b"|") * 3  # the mark keeps the order of words in the repetition


def _bare(word: str) -> str:
    return word.strip(string.punctuation)


def _phrases(words: list[str]) -> Iterator[tuple[str, ...]]:
    for n in PHRASE_WORDS:
        yield from zip(*(words[i:] for i in range(n)), strict=False)


def _bytes(word: str) -> bytes:
    return word.encode("utf-8", "surrogatepass")


class Evidence:
    """Evidence of words and phrases under pairs of dictionaries."""

    def __init__(self, pairs: Pairs, phrases: Phrases = Phrases()):
        self.words, self.phrases = self._measure(pairs), self._measure(phrases.pairs)
        self.n_words, self.n_phrases = len(pairs), len(phrases.pairs)
        self.bare = ["", *sorted(phrases.words)]
        self.places = {w: i for i, w in enumerate(self.bare) if i}
        self.memo, self.phrase_memo = WordMemo(self._words), WordMemo(lambda ps: self.phrases(map(_phrase_window, ps)))

    @staticmethod
    def _compressor(data: bytes) -> zstandard.ZstdCompressor:
        content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False)

    @classmethod
    def _measure(cls, pairs: Pairs):
        places = [list(dict.fromkeys(pairs)).index(p) for p in pairs]  # equal pairs count twice and run once
        made = [[cls._compressor(d) for d in pair] for pair in dict.fromkeys(pairs)]

        def run(windows: Iterator[bytes]) -> list[tuple[int, ...]]:
            windows = list(windows)
            each = [[len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows] for toxic, ordinary in made]
            return list(zip(*(each[i] for i in places), strict=True))

        return run

    def _words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Evidence of each word, and its place among the words of marked phrases or 0."""
        return [(*e, self.places.get(_bare(w), 0)) for e, w in zip(self.words(_window(_bytes(w)) for w in words), words, strict=True)]

    def _phrases_of(self, places: np.ndarray) -> list[tuple[str, ...]]:
        """The phrases of a text whose words all occur in marked phrases."""
        out = []
        for n in PHRASE_WORDS:
            parts = [places[i : len(places) - n + 1 + i] for i in range(n)] if len(places) >= n else []
            starts = np.flatnonzero(np.all(parts, axis=0)).tolist() if parts else []
            out += [tuple(self.bare[int(places[k])] for k in range(i, i + n)) for i in starts]
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        words = [t.lower().split() for t in texts]
        known = self.memo.ready(words)
        out = np.zeros((len(texts), 1 + 8 * (self.n_words + self.n_phrases)))
        out[:, 0] = 1
        for row, ws in zip(out, words, strict=True):
            if ws:
                *each, places = np.array([known[w] for w in ws], float).T
                row[1 : 1 + 8 * self.n_words] = np.concatenate([self._summary(e, len(ws)) for e in each])
                found = self._phrases_of(places) if places.any() else []
                if found:
                    own = self.phrase_memo.ready([found])
                    row[1 + 8 * self.n_words :] = np.concatenate([self._summary(e, len(ws)) for e in np.array([own[p] for p in found], float).T])
        return out

    @staticmethod
    def _summary(e: np.ndarray, n: int) -> list[float]:
        over = [(e >= t).sum() for t in (3, 4, 6, 8)]
        return [max(e.max(), 0) / 4, *np.log1p(over), *np.log1p(1000 * np.array(over[1:]) / n)]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
    return w


def _apart(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Rows without near copies of earlier ones, whose words would count over and over."""
    seen: set[int] = set()
    out = []
    for text, t in rows:
        keys = bands_of(normal(text), False, 8, 1).tolist()
        if sum(k in seen for k in keys) < 4:
            out.append((text, t))
        seen.update(keys)
    return out


def _marked(toxic: Counter, ordinary: Counter, n1: int, n0: int, ratio: float) -> set:
    """Units in at least MARKED_TEXTS of n1 toxic texts, and far more often there than in n0 ordinary texts."""
    out = set()
    for unit, a in toxic.items():
        b = ordinary[unit]
        if a >= MARKED_TEXTS and a / n1 > ratio * (b + 0.5) / n0:
            g = 2 * (a * np.log(a * (n0 + n1) / ((a + b) * n1)) + (b * np.log(b * (n0 + n1) / ((a + b) * n0)) if b else 0))
            if g > STEM_G:
                out.add(unit)
    return out


def _pair(shared: bytes, more: list[bytes], rest: list[bytes]) -> tuple[bytes, bytes]:
    """Toxic and ordinary dictionary; the last windows are the nearest and cheapest to match."""
    added = b" ".join(more[::-1])
    other = b" ".join(rest[::-1])[-len(added) :] if added else b""
    return shared + b" " + added, other + b" " + shared


def fit(texts: list[str], toxic: list[int]) -> Model | None:
    """Dictionaries and calibration from labelled texts; None unless both classes occur."""
    rows = _apart(sorted(dict(zip(texts, toxic, strict=True)).items()))
    if len({t for _, t in rows}) < 2:
        return None
    stems, counts = (Counter(), Counter()), (Counter(), Counter())  # texts that hold them, ordinary and toxic
    said = Counter()
    for text, t in rows:
        words = text.lower().split()
        ws = {_bytes(w) for w in words}
        stems[t].update({w[:n] for w in ws for n in STEM_BYTES if len(w) >= n} | {w for w in ws if len(w) < STEM_BYTES[0]})
        counts[t].update(ws)
        if t:
            said.update(set(_phrases(list(map(_bare, words)))))
    said = Counter({p: a for p, a in said.items() if a >= MARKED_TEXTS})
    usually = Counter()
    for text, t in rows:
        if not t:
            usually.update(said.keys() & set(_phrases(list(map(_bare, text.lower().split())))))
    n1 = sum(t for _, t in rows)
    n0 = len(rows) - n1
    first = lambda c: sorted(c, key=lambda x: (-c[x], x))
    usual, plain_phrases = first(counts[0]), [p for p in first(usually) if usually[p] * n1 >= said[p] * n0]
    pairs, phrase_pairs, phrase_words = [], [], set()
    for ratio in STEM_RATIOS:
        marked = _marked(stems[1], stems[0], n1, n0, ratio)
        holds = lambda w: w in marked or any(w[:n] in marked for n in STEM_BYTES if len(w) >= n)  # noqa: B023, E731
        found = [w for w in first(counts[1]) if holds(w)]
        known = set(found)
        plain = [w for w in usual if w not in known]
        shared = b" ".join(plain[:4000][::-1])[-ORDINARY_BYTES:]
        pairs.append(_pair(shared, list(map(_window, found)), list(map(_window, plain[: 1500 + 2 * len(found)]))))
        phrases = _marked(said, usually, n1, n0, ratio)
        phrases = {p for p in phrases if not any(holds(_bytes(w)) for w in p)}
        phrases = {p for p in phrases if len(p) == 2 or not {p[:2], p[1:]} & phrases}
        phrase_words.update(w for p in phrases for w in p if w)
        # The words alone are in both: a phrase then saves a match, and each of its words nothing.
        shared = b"|".join(_bytes(w) for w in sorted({w for p in phrases for w in p}))
        shared += b" " + b" ".join(map(_phrase_window, plain_phrases[:1500][::-1]))[-ORDINARY_BYTES:]
        phrase_pairs.append(_pair(shared, [_phrase_window(p) for p in first(said) if p in phrases], list(map(_phrase_window, plain_phrases[1500:]))))
    phrases = Phrases(tuple(phrase_pairs), frozenset(phrase_words))
    x = Evidence(tuple(pairs), phrases).features([text for text, _ in rows])
    return Model(tuple(pairs), phrases, tuple(_logistic(x, np.array([t for _, t in rows], float))))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS, train_chars: int = TRAIN_CHARS) -> Model | None:
    """Fit a model on a bounded sample of docs(doc_id, text) with labels(doc_id, toxic); labels of other rows stay unseen."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = marks.withColumnRenamed("doc_id", "label_id")
    order = [F.xxhash64("label_id"), F.col("label_id")]
    chosen = [marks.where(F.col("toxic") == t).orderBy(*order).limit(n) for t, n in ((1, toxic_rows), (0, ordinary_rows))]
    sample = chosen[0].unionByName(chosen[1])  # at most toxic_rows + ordinary_rows ids: small enough to broadcast
    rows = docs.select("doc_id", text_or_empty().alias("text")).where(F.length("text") <= train_chars)
    rows = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("text", "toxic").dropDuplicates()
    # a total order of different rows: the sample doesn't depend on partitions
    got = rows.orderBy(F.xxhash64("text"), "text", "toxic").limit(2 * (toxic_rows + ordinary_rows)).collect()
    return fit([r.text for r in got], [r.toxic for r in got])


@functools.lru_cache(maxsize=1)
def worker_evidence(pairs: Pairs, phrases: Phrases) -> Evidence:
    """One per Python worker: its memo serves all tasks that the worker runs."""
    return Evidence(pairs, phrases)


def score(model: Model | None, text: Column) -> Column:
    """Score from 0 to 1 of a text column; 0.5 and above means toxic."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        x = worker_evidence(model.pairs, model.phrases).features(texts.tolist())
        return pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30))))

    return scored(F.coalesce(text, F.lit("")))


def held_out() -> Column:
    """Rows whose labels are for evaluation only: crc32 of doc_id's decimal text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    small_batches(docs.sparkSession)
    model = train(docs, labels.where(~held_out()))
    scored = docs.select(F.col("doc_id"), held_out().alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score under 0.5, all columns."""
    small_batches(docs.sparkSession)
    return docs.where(score(train(docs, labels.where(~held_out())), F.col("text")) < 0.5)
