"""Duplicate passages across documents, by suffix trees that are split by prefixes.

The suffixes are those that start at a word. A window is a suffix's first `size` words; it is a repeat if its words also
start in a document with a smaller doc_id, and every word that a repeat covers goes.

Which suffixes can be in a repeat at all: of the grams of `size` // 2 words in a window the one with the least hash is its
anchor, so equal windows have equal anchors, and neighbouring windows mostly share theirs. Anchors that occur in one
text only end the matter for their windows; they are about a quarter as many as words and travel as packed hashes.

The other suffixes are split into groups by prefixes of variable length: a prefix reaches to the end of the window's
anchor, so it is the same for equal windows and long enough to be rare. A task sorts the suffixes of its groups word by
word; the lengths of the prefixes that neighbours share describe the suffix tree, whose internal nodes at depth `size` are
the repeated windows (below that depth nothing changes which words go, so trees are cut there). A node's least doc_id is
its source, every other leaf a repeat. Overlapping repeats of a document join into its maximal repeated spans. Where an
anchor occurs in so many texts that its groups wouldn't fit (`hot`), the prefix is the whole window, and the node's source
is a minimum, aggregated before a shuffle.

Equal texts take part once, under their least doc_id. Windows are told apart by 16 bits of a hash of each word and 64 bits
of a hash of all words.

Defined results: a null text has no words; a document with a null doc_id loses no word and is no source; rows with equal
doc_id are no sources for each other, equal rows get equal results; a text under `size` words is kept; texts of any
length are taken whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.llm.common import small_batches, staged, text_or_empty
from harvestry.llm.neardup import hot_join

SIZE = 13
#: Anchors, and suffixes, that a task gathers before it sends them, and that a group of prefixes should have.
GATHERED, GROUP = 2_000_000, 100_000
#: Texts with an anchor from which its windows are hot, and the most anchors that can be: the list goes to all tasks.
HOT, HOT_ANCHORS = 100_000, 100_000
#: Words whose hashes a worker remembers.
MEMO_WORDS = 400_000
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def words_of(text: str) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as many as needed so far."""

    def __init__(self, which: int):
        self.base, self.inverse = _BASES[which], _INVERSES[which]
        self.up = self.down = np.ones(1, np.uint64)

    def ready(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)])) for b in (self.base, self.inverse))


class Known(dict):
    """Hashes of words, of which the first MEMO_WORDS are kept."""

    def __missing__(self, word: bytes) -> int:
        own = xxhash.xxh64_intdigest(word)
        if len(self) < MEMO_WORDS:
            self[word] = own
        return own


class Hasher:
    """Hashes of any run of a text's words in constant time each."""

    known = Known()
    powers = (Powers(0), Powers(1))

    def __init__(self, words: list[bytes]):
        self.words = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        self._sums: dict[int, np.ndarray] = {}

    def _prepared(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        powers = self.powers[which]
        powers.ready(len(self.words) + 1)
        if which not in self._sums:
            self._sums[which] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words * powers.down[: len(self.words)])])
        return self._sums[which], powers.up

    def runs(self, start: np.ndarray, length: np.ndarray | int, which: int = 0) -> np.ndarray:
        sums, up = self._prepared(which)
        return _mixed((sums[start + length] - sums[start]) * up[start])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all runs of a length."""
        sums, up = self._prepared(0)
        n = len(self.words) - length + 1
        return _mixed((sums[length:] - sums[:n]) * up[:n])

    def anchors(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each window the hash of its anchor, and how many words come before the anchor's end."""
        gram = gram_words(size)
        grams, n = self.every(gram), len(self.words) - size + 1
        best, reach = grams[:n].copy(), np.full(n, gram)
        for k in range(1, size - gram + 1):
            less = grams[k : k + n] < best
            best[less], reach[less] = grams[k : k + n][less], gram + k
        return best, reach

    def codes(self, start: np.ndarray, size: int) -> np.ndarray:
        """16 bits of each word of some windows."""
        short = (_mixed(self.words) >> np.uint64(48)).astype(">u2")
        return short[start[:, None] + np.arange(size)]


def gram_words(size: int) -> int:
    return max(1, size // 2)


def _packed(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def _unpacked(blob: bytes, n: int, *kinds: tuple) -> list[np.ndarray]:
    """Columns of n rows each, by type and width."""
    data, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    for kind, width in kinds:
        end = at + n * width * np.dtype(kind).itemsize
        out.append(np.frombuffer(data[at:end], kind).reshape((n, width) if width > 1 else n))
        at = end
    return out


def _split(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each part that has any."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.unique(part).tolist():
        yield p, order[ends[p] : ends[p + 1]]


ANCHORS = (("<u8", 1), ("<u4", 1), ("<u4", 1))
GRAMS = "part int, n int, data binary, digests binary"


def _anchors(size: int, parts: int):
    """Anchors of texts (digest, text), packed by parts of their hashes. Of the texts of a task that share an anchor one
    goes there, with their number; the others are known to share it, and go by the hash of anchor and text."""

    def packed(anchors: list, digests: list) -> Iterator[pa.RecordBatch]:
        own, text = np.concatenate(anchors), np.repeat(np.arange(len(anchors)), [len(a) for a in anchors])
        order = np.argsort(own, kind="stable")
        own, text = own[order], text[order]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        n = np.zeros(len(own), "<u4")
        n[first] = np.diff(np.append(first, len(own)))
        heads = np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64)
        part = np.where(n > 0, _mixed(own), _mixed(own ^ heads[text])) % np.uint64(parts)
        rows = []
        for p, at in _split(part.astype(np.int64), parts):
            used, place = np.unique(text[at], return_inverse=True)
            rows.append((p, len(at), _packed(own[at], place.astype("<u4"), n[at]), b"".join(digests[i] for i in used)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "n", "data", "digests"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, digests, seen, n = [], [], set(), 0
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if digest in seen or len(words) < size:
                    continue
                seen.add(digest)
                own = Hasher(words).anchors(size)[0]
                found.append(np.unique(own[np.concatenate([[True], own[1:] != own[:-1]])]))
                digests.append(digest)
                n += len(found[-1])
                if n >= GATHERED:
                    yield from packed(found, digests)
                    found, digests, seen, n = [], [], set(), 0
        if n:
            yield from packed(found, digests)

    return run


def _shared(hot: int):
    """Of a part's anchors those in at least two texts, by text; without a text those in `hot` texts."""

    def run(rows: pa.Table) -> pa.Table:
        own, text, n, digests = [], [], [], []
        for size, data, names in zip(rows.column("n").to_pylist(), rows.column("data").to_pylist(), rows.column("digests").to_pylist(), strict=True):
            a, t, k = _unpacked(data, size, *ANCHORS)
            own.append(a), n.append(k), text.append(t.astype(np.int64) + len(digests))
            digests += [names[i : i + 16] for i in range(0, len(names), 16)]
        own, text, n = np.concatenate(own), np.concatenate(text), np.concatenate(n)
        known, place = np.unique(np.frombuffer(b"".join(digests), "V16"), return_inverse=True)
        text = place[text]
        order = np.lexsort((text, own, n == 0))
        own, text, n = own[order], text[order], n[order].astype(np.int64)
        sent = int((n > 0).sum())
        out_text, out_own, hots = [text[sent:]], [own[sent:]], np.zeros(0, np.uint64)
        if sent:
            a, t, k = own[:sent], text[:sent], n[:sent]
            first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, sent)))
            several = np.logical_or.reduceat(k > 1, first) | (np.maximum.reduceat(t, first) != np.minimum.reduceat(t, first))
            hots = a[first][np.add.reduceat(k, first) >= hot]
            keep = several[group]
            out_text.append(t[keep]), out_own.append(a[keep])
        text, own = np.concatenate(out_text), np.concatenate(out_own)
        rows = [(bytes(known[t]), np.unique(own[at]).tobytes()) for t, at in _split(text, len(known))]
        if len(hots):
            rows.append((None, hots.tobytes()))
        return pa.table({"digest": pa.array([r[0] for r in rows], pa.binary()), "anchors": pa.array([r[1] for r in rows], pa.binary())})

    return run


SUFFIXES = "bucket int, n int, data binary"


def _suffixes(size: int, buckets: int, hot: frozenset[int]):
    """Suffixes of texts (number, source, text, anchors) whose anchor is shared and not hot, packed by their prefixes."""
    cold = np.array(sorted(hot), np.uint64)

    def packed(parts: list) -> Iterator[pa.RecordBatch]:
        bucket, codes, prints, source, number, start = (np.concatenate(c) for c in zip(*parts, strict=True))
        rows = []
        order = np.lexsort((codes[:, 1 % size], codes[:, 0]))  # neighbours resemble each other, which packs better
        for b, at in _split(bucket[order], buckets):
            at = order[at]
            rows.append((b, len(at), _packed(codes[at], prints[at], source[at], number[at], start[at])))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["bucket", "n", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            for number, source, text, anchors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = Hasher(words_of(text))
                own, reach = hashes.anchors(size)
                shared = np.isin(own, np.concatenate([np.frombuffer(a, "<u8") for a in anchors]))
                if len(cold):
                    shared &= ~np.isin(own, cold)
                every = np.flatnonzero(shared)
                for i in range(0, len(every), GATHERED):
                    at = every[i : i + GATHERED]
                    bucket = (hashes.runs(at, reach[at]) % np.uint64(buckets)).astype(np.int64)
                    same = lambda v: np.full(len(at), v, np.int64)  # noqa: B023, E731
                    parts.append((bucket, hashes.codes(at, size), hashes.runs(at, size), same(source), same(number), at.astype("<i4")))
                    n += len(at)
                    if n >= GATHERED:
                        yield from packed(parts)
                        parts, n = [], 0
        if n:
            yield from packed(parts)

    return run


def shared_prefixes(codes: np.ndarray) -> np.ndarray:
    """How many words each of sorted suffixes, but the first, shares with the one before."""
    equal = codes[1:] == codes[:-1]
    return np.where(equal.all(1), codes.shape[1], equal.argmin(1))


def deep_nodes(shared: np.ndarray, depth: int) -> np.ndarray:
    """Of each sorted suffix the first one that is below the same internal node of at least a depth."""
    starts = np.concatenate([[True], shared < depth])
    return np.flatnonzero(starts)[np.cumsum(starts) - 1]


def _repeats(size: int):
    """number and start of the windows of a bucket that a smaller doc_id has as well."""
    kinds = ((">u2", size), ("<u8", 1), ("<i8", 1), ("<i8", 1), ("<i4", 1))

    def run(rows: pa.Table) -> pa.Table:
        columns = [_unpacked(d, n, *kinds) for n, d in zip(rows.column("n").to_pylist(), rows.column("data").to_pylist(), strict=True)]
        codes, prints, source, number, start = (np.concatenate(c) for c in zip(*columns, strict=True))
        codes = codes.astype(np.uint16)
        order = np.lexsort((prints, *codes.T[::-1]))
        codes, prints, source = codes[order], prints[order], source[order]
        shared = shared_prefixes(codes)
        shared = np.where((shared == size) & (prints[1:] != prints[:-1]), size - 1, shared)  # words of equal codes
        node = deep_nodes(shared, size)
        first = np.unique(node)
        least = np.minimum.reduceat(source, first)[np.searchsorted(first, node)]
        hit = order[source > least]
        return pa.table({"number": pa.array(number[hit]), "start": pa.array(start[hit])})

    return run


def _hot_windows(size: int, hot: frozenset[int]):
    """Windows of texts (number, source, text) with a hot anchor, by two hashes."""
    wanted = np.array(sorted(hot), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, source, text in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                hashes = Hasher(words_of(text))
                at = np.flatnonzero(np.isin(hashes.anchors(size)[0], wanted))
                if len(at):
                    prints = [hashes.runs(at, size, k).view(np.int64) for k in (0, 1)]
                    columns = [*prints, np.full(len(at), source, np.int64), np.full(len(at), number, np.int64), at.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["one", "two", "source", "number", "start"])

    return run


def _digest():
    return F.unhex(F.md5("text"))


def repeats(docs: DataFrame, size: int = SIZE, group: int = GROUP, hot: int = HOT) -> DataFrame:
    """digest (MD5 of a text), source (its least doc_id), starts: the places of the text's words at which a repeat starts,
    or null. One row per distinct text."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("digest", _digest())
    texts = staged(rows.groupBy("digest").agg(F.min("doc_id").alias("source"), F.max(F.length("text")).alias("chars")).withColumn("number", F.monotonically_increasing_id()), "texts")
    chars = texts.agg(F.coalesce(F.sum("chars"), F.lit(0))).head()[0]
    parts = _groups(spark, chars // 20, group)  # an anchor for some twenty characters
    known = rows.where("doc_id is not null")
    grams = known.select("digest", "text").mapInArrow(_anchors(size, parts), GRAMS)
    shared = staged(grams.groupBy("part").applyInArrow(_shared(max(hot, chars // 20 // HOT_ANCHORS)), "digest binary, anchors binary"), "anchors")
    hots = frozenset(int(a) for r in shared.where("digest is null").select("anchors").toLocalIterator() for a in np.frombuffer(r.anchors, "<u8"))
    by_text = shared.where("digest is not null").groupBy("digest").agg(F.collect_list("anchors").alias("anchors"), F.sum(F.length("anchors")).alias("bytes"))
    wanted = staged(by_text.join(texts.select("digest", "source", "number"), "digest"), "wanted")
    # by digest and doc_id: copies of one text don't meet
    asked = known.join(wanted.withColumnRenamed("source", "doc_id"), ["digest", "doc_id"]).select("number", F.col("doc_id").alias("source"), "text", "anchors")
    n = wanted.agg(F.coalesce(F.sum("bytes"), F.lit(0))).head()[0] // 8 * 5
    buckets = _groups(spark, n, group)
    found = asked.mapInArrow(_suffixes(size, buckets, hots), SUFFIXES).groupBy("bucket").applyInArrow(_repeats(size), "number long, start int")
    if hots:
        windows = staged(asked.drop("anchors").mapInArrow(_hot_windows(size, hots), "one long, two long, source long, number long, start int"), "hot")
        windows = windows.withColumn("print", F.struct("one", "two"))
        least = windows.groupBy("print").agg(F.min("source").alias("least"))
        found = found.unionByName(hot_join(windows, least, "print", "number").where("source > least").select("number", "start"))
    starts = found.groupBy("number").agg(F.array_sort(F.collect_set("start")).alias("starts"))  # of one text
    return staged(texts.join(staged(starts, "starts"), "number", "left").select("digest", "source", "starts"), "repeats")


def _groups(spark: SparkSession, rows: int, group: int) -> int:
    """A number of groups with about so many rows each, two for each task at least. Each task that packs rows makes a row for
    each group, so groups follow the rows and not the tasks."""
    return int(max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // group))


def spans(starts: list[int], size: int) -> list[tuple[int, int]]:
    """Maximal spans of words that windows at sorted places cover."""
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], s + size
        else:
            out.append((s, s + size))
    return out


KEPT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"


def _kept(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, source, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                if doc_id is None or len(words) < size:
                    gone = []
                elif source is not None and source < doc_id:
                    gone = [(0, len(words))]
                else:
                    gone = spans(starts or [], size)
                kept, at = [], 0
                for start, end in gone:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                rows.append((doc_id, len(words), len(words) - len(kept), [{"start": a, "end": b} for a, b in gone], b" ".join(kept).decode("utf-8", "surrogatepass")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return run


def deduplicate(docs: DataFrame, size: int = SIZE, group: int = GROUP, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed words, ends exclusive) and kept (the other words, joined by spaces) for
    every row of docs(doc_id, text)."""
    found = repeats(docs, size, group, hot)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("digest", _digest())
    both = hot_join(rows, found, "digest", "doc_id", "left")
    return both.select("doc_id", "text", "source", "starts").mapInArrow(_kept(size), KEPT)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return deduplicate(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS words FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT words, min(doc_id) AS source FROM v GROUP BY words),
g AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS pos FROM v JOIN m USING (words) WHERE doc_id > source),
k AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
t AS (SELECT r, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM k ANTI JOIN g USING (r, pos) GROUP BY r)
SELECT doc_id, len(w) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (r)
"""
