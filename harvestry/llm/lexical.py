"""Ranked lexical search: best-first over document intervals, bounded by range maxima of posting lists.

Items (queries) come in slices. A first pass over all documents counts documents, terms, and the documents of each of a
slice's terms. In a second pass each task indexes its documents block by block: postings of the slice's terms sorted by
term and document, with their impacts (what a posting adds to a score), and sparse tables over the impacts, so that the
maximum of any range of a posting list takes two look-ups. An item's search keeps intervals of documents in a heap. An
interval's bound is the sum of its terms' range maxima; the interval of the greatest bound is split at the document of the
greatest single impact, which is scored in full, and its two sides get bounds of their own. A search ends when no
bound can reach the item's k-th best document so far, counted over all blocks of the task. Intervals are taken from the
heap in waves, which double in size, and a wave's bounds and scores are vectorised.

Nothing is shuffled but counts and k rows per item and task, which merge in two levels.

Defined results: a null text has no terms, and neither takes part in N nor is found; an item without terms finds nothing;
items and documents with equal or null ids are rows of their own, of equal scores the smaller doc_id is first, a
null one last; scores are exact integers; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestry.llm.common import small_batches, staged

#: Items, and characters of their texts, that are searched for in one pass over the documents.
SLICE_ITEMS, SLICE_CHARS = 1000, 2_000_000
#: Documents and postings of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 50_000, 1_000_000
#: Intervals of a wave, and bounds that are computed at once.
WAVE, CELLS = 256, 65_536
#: Groups of tasks whose results merge first.
SALTS = 64
HITS = "item int, item_id long, doc_id long, score long"
_LOWER = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, with A-Z in lower case, as UTF-8. All separators are ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Slice:
    """Some items, as sorted places of their distinct terms with the number of repeats."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        found = [Counter(terms_of(text)) for _, text in rows]
        self.places = {t: i for i, t in enumerate(sorted(set().union(*found)))}
        self.items = []
        for c in found:
            own = sorted((self.places[t], n) for t, n in c.items())
            self.items.append((np.array([p for p, _ in own], np.int64), np.array([n for _, n in own], np.int64)))
        self.ids = [i for i, _ in rows]


def _counts(places: dict[bytes, int]):
    """Partial sums of a task: documents per term, then (-1) documents with terms and (-2) all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                terms = terms_of(text)
                docs, total = docs + bool(terms), total + len(terms)
                df.update(set(map(places.get, terms)))
        df.pop(None, None)
        rows = [*df.items(), (-1, docs), (-2, total)]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.int32()), pa.array([n for _, n in rows], pa.int64())], names=["term", "n"])

    return run


class Block:
    """Postings of some documents, which are sorted by id: keys (term, document), impacts, and sparse tables over these."""

    def __init__(self, ids: list[int | None], m: list[int], term: array, doc: array, tf: array, weights: np.ndarray):
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        self.ids, self.size = [ids[i] for i in order], len(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        t, own, f = np.frombuffer(term, np.int32).astype(np.int64), place[np.frombuffer(doc, np.int32)], np.frombuffer(tf, np.int64)
        lengths = np.array(m, np.int64)[order]
        by = np.lexsort((own, t))
        t, self.doc, f = t[by], own[by], f[by]
        self.keys = t * self.size + self.doc
        self.impact = weights[t] * ((1_000_000_000 * f) // (1000 * f + 12 * lengths[self.doc]))
        ends = np.searchsorted(t, np.arange(len(weights) + 1))
        self.first, self.last = ends[:-1], ends[1:]
        self.tables = [np.arange(len(t), dtype=np.int32)]  # places of the maxima of 1, 2, 4, ... postings
        longest = int((self.last - self.first).max()) if len(t) else 0
        while 2 << (len(self.tables) - 1) <= longest:
            below, half = self.tables[-1], 1 << (len(self.tables) - 1)
            a, b = below[: len(t) - 2 * half + 1], below[half : len(t) - half + 1]
            level = np.zeros(len(t), np.int32)
            level[: len(a)] = np.where(self.impact[a] >= self.impact[b], a, b)
            self.tables.append(level)
        self.tables = np.stack(self.tables)
        self.log = np.zeros(longest + 1, np.int64)
        for k in range(1, len(self.tables)):
            self.log[1 << k :] = k

    def maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the greatest impacts of ranges of postings, the first place of empty ones."""
        length = np.maximum(high - low, 1)
        k = self.log[length]
        low = np.minimum(low, len(self.impact) - 1)
        a, b = self.tables[k, low], self.tables[k, np.maximum(low + length - (1 << k), low)]
        return np.where(self.impact[a] >= self.impact[b], a, b)

    def bounded(self, low: np.ndarray, high: np.ndarray, repeats: np.ndarray) -> tuple[list[int], list[int]]:
        """Of each row of ranges the sum of the maxima, and the document of the greatest."""
        at = self.maxima(low, high)
        value = np.where(high > low, self.impact[at], 0) * repeats
        return value.sum(1).tolist(), self.doc[at[np.arange(len(at)), value.argmax(1)]].tolist()

    def search(self, terms: np.ndarray, repeats: np.ndarray, best: list[tuple], k: int) -> int:
        """Enter the block's documents into best, a sorted list of the k first (-score, no id, id); the number of scored
        documents."""
        low, high = self.first[terms], self.last[terms]
        there = high > low
        terms, repeats, low, high = terms[there], repeats[there], low[there], high[there]
        if not len(terms):
            return 0
        offsets, wave, scored, n = terms * self.size, 1, 0, 0
        bound, split = self.bounded(low[None], high[None], repeats)
        heap = [(-bound[0], 0, 0, split[0], low, high)]  # negated bound, order of entry, first document, split, ranges
        while heap:
            taken = []
            while heap and len(taken) < wave and (len(best) < k or self._key(heap[0][0], heap[0][2]) < best[-1]):
                taken.append(heapq.heappop(heap))
            if not taken:
                break
            wave = min(2 * wave, WAVE, max(1, CELLS // len(terms)))
            scored += len(taken)
            starts = np.array([x[2] for x in taken])
            at = np.array([x[3] for x in taken])
            low, high = np.stack([x[4] for x in taken]), np.stack([x[5] for x in taken])
            wanted = offsets[None] + at[:, None]
            place = np.searchsorted(self.keys, wanted)
            hit = (place < high) & (self.keys[np.minimum(place, len(self.keys) - 1)] == wanted)
            score = (np.where(hit, self.impact[np.minimum(place, len(self.keys) - 1)], 0) * repeats).sum(1)
            for s, d in zip(score.tolist(), at.tolist(), strict=True):
                key = self._key(-s, d)
                if s > 0 and (len(best) < k or key < best[-1]):
                    best.append(key)
                    best.sort()
                    del best[k:]
            for lows, highs, first in ((low, place, starts), (place + hit, high, at + 1)):
                bounds, splits = self.bounded(lows, highs, repeats)
                for i, b in enumerate(bounds):
                    start = int(first[i])
                    if b > 0 and (len(best) < k or self._key(-b, start) < best[-1]):
                        n += 1
                        heapq.heappush(heap, (-b, n, start, splits[i], lows[i], highs[i]))
        return scored

    def _key(self, negated: int, doc: int) -> tuple:
        """How a document of a score sorts among results."""
        i = self.ids[doc]
        return negated, i is None, i or 0


def _search(part: Slice, weights: np.ndarray, docs: int, total: int, k: int, block_docs: int, block_postings: int):
    """The k best documents of a task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in part.items]
        ids, m, term, doc, tf = [], [], array("i"), array("i"), array("q")

        def flush() -> None:
            if len(term):
                block = Block(ids, m, term, doc, tf, weights)
                for (terms, repeats), own in zip(part.items, best, strict=True):
                    block.search(terms, repeats, own, k)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = terms_of(text)
                counts = Counter(map(part.places.get, terms))
                counts.pop(None, None)
                if counts:
                    term.extend(counts.keys())
                    tf.extend(counts.values())
                    doc.extend([len(ids)] * len(counts))
                    ids.append(doc_id)
                    m.append(75 + 25 * len(terms) * docs // total)
                    if len(ids) >= block_docs or len(term) >= block_postings:
                        flush()
                        ids, m, term, doc, tf = [], [], array("i"), array("i"), array("q")
        flush()
        rows = [(i, part.ids[i], None if none else d, -s) for i, own in enumerate(best) for s, none, d in own]
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["item", "item_id", "doc_id", "score"])

    return run


def _slices(items: DataFrame, slice_items: int, slice_chars: int) -> Iterator[Slice]:
    rows, chars = [], 0
    for r in items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():  # a slice at a time
        if rows and (len(rows) >= slice_items or chars + len(r.text) > slice_chars):
            yield Slice(rows)
            rows, chars = [], 0
        rows.append((r.item_id, r.text))
        chars += len(r.text)
    if rows:
        yield Slice(rows)


def rank(docs: DataFrame, items: DataFrame, k: int = 20, slice_items: int = SLICE_ITEMS, slice_chars: int = SLICE_CHARS, block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of docs(doc_id, text) for each row of items(item_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    found = []
    for part in _slices(items, slice_items, slice_chars):
        counted = rows.select("text").mapInArrow(_counts(part.places), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
        df = {r.term: r.n for r in counted.collect()}  # a row for each term of the slice
        n_docs, total = df.get(-1, 0), df.get(-2, 0)
        weights = np.array([weight(n_docs, df[t]) if t in df else 0 for t in range(len(part.places))], np.int64)
        hits = rows.mapInArrow(_search(part, weights, n_docs, total, k, block_docs, block_postings), HITS)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for keys in (["item", "salt"], ["item"]):
            hits = hits.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))) if "salt" in keys else hits
            hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        found.append(staged(hits.select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
d AS (SELECT r, doc_id, len(ts) AS n, ts FROM t WHERE len(ts) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
q AS (SELECT i, item_id, term, count(*) AS c FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
x AS (SELECT i, item_id, r, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY i, item_id, r, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0) WHERE rank <= 20
"""
