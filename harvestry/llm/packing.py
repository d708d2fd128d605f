"""Best-fit packing of tokenized documents into sequences of a fixed length, by hierarchical residual packing.

Every partition packs its own pieces best-fit and emits the bins that are full or so nearly full that no open item
anywhere fits. Its underfull bins become the items of the next round: groups of partitions merge like a tree, and each
round packs those items best-fit again. Only underfull bins move, as (fill, members) rows without any token ids.

Defined results: a null text packs as the empty text (one piece, the end token); repeated rows and rows without doc_id
are packed one by one; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import WordMemo, small_batches, staged, text_or_empty, tokenizer_file

CAPACITY = 4096
END_ID = 1
#: Partitions that merge into one in a round, and the rows of a group at which merging stops.
FAN_IN, GROUP_ROWS = 16, 200_000
#: Items that a task packs at once; a bound on its memory.
PACK_ITEMS = 400_000
#: Words whose ids a worker remembers.
CACHE_WORDS = 900_000
#: Runs without the tokenizer's white space. str.split() also splits at U+001C to U+001F, which have tokens of their own.
WORDS = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SEPARATORS = "\x1c\x1d\x1e\x1f"
MARK = "\x1e"

MEMBER = np.dtype([("doc_id", "<i8"), ("null", "<i1"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
BINS = "fill int, round int, task int, bin int, members binary"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def words_of(text: str) -> list[str]:
    """The words between the tokenizer's white space; str.split() is the faster way to them in a text without separators."""
    return WORDS.findall(text) if any(c in text for c in SEPARATORS) else text.split()


class WordTokenizer:
    """Ids of whole texts as little-endian bytes. The tokenizer's normaliser and splitter let no token span white space,
    so a text's ids are its words' ids in a row, and a word is tokenized once for many texts."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the executor's cores are busy with other tasks
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), np.uint32(end_id).tobytes()
        # a word of its own whose one id ends another word's ids, if the vocabulary has such a word
        marks = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = marks[0] if len(marks) == 1 else None
        self.memo = WordMemo(self._words, CACHE_WORDS)

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word: many words are one text, with a mark after each, whose ids are cut at the marks."""
        out = []
        for i in range(0, len(words), 2048):
            own = words[i : i + 2048]
            if self.mark is not None and not any(MARK in w for w in own):
                text = f" {MARK} ".join(own) + f" {MARK}"
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                ends = np.flatnonzero(ids == self.mark)
                if len(ends) == len(own):
                    data, cuts = ids.tobytes(), (4 * ends).tolist()
                    out += [data[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], cuts, strict=False)]
                    continue
            out += self._each(own)
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        words = [words_of(t) for t in texts]
        known = self.memo.ready(words)
        return [b"".join(map(known.__getitem__, ws)) + self.end for ws in words]


@functools.lru_cache(maxsize=1)
def worker_tokenizer(path: str, end_id: int) -> WordTokenizer:
    """One per Python worker: its memo serves all tasks that the worker runs."""
    return WordTokenizer(path, end_id)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each item goes to the open bin that it fills most. Returns the items of each bin."""
    bins: list[list[int]] = []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms = 0  # bit r is set while a bin has r left
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        open_bins[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def _packed(fills: np.ndarray, blobs: list[bytes], capacity: int, level: int, first: int) -> pa.RecordBatch:
    order = sorted(range(len(blobs)), key=lambda i: (-int(fills[i]), blobs[i]))  # the same bins in whatever order rows came
    fills, blobs = fills[order], [blobs[i] for i in order]
    bins = best_fit(fills, capacity)
    n, task = len(bins), TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(fills[b].sum()) for b in bins], pa.int32()),
            pa.array([level] * n, pa.int32()),
            pa.array([task] * n, pa.int32()),
            pa.array(range(first, first + n), pa.int32()),
            pa.array([b"".join(blobs[i] for i in b) for b in bins], pa.binary()),
        ],
        names=["fill", "round", "task", "bin", "members"],
    )


def pieces_of(doc_id: int | None, ids: bytes, capacity: int) -> list[tuple]:
    n = len(ids) // 4
    return [
        (doc_id or 0, doc_id is None, k, start, min(capacity, n - start), zlib.crc32(ids[4 * start : 4 * min(start + capacity, n)]))
        for k, start in enumerate(range(0, n, capacity))
    ]


def _first_round(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, members, made = worker_tokenizer(path, end_id), [], 0

        def flush() -> pa.RecordBatch:
            rows = np.array(members, MEMBER)
            return _packed(rows["length"].astype("i8"), [rows[i : i + 1].tobytes() for i in range(len(rows))], capacity, 0, made)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, own in zip(ids, tokenizer.ids(batch.column(1).to_pylist()), strict=True):
                members += pieces_of(doc_id, own, capacity)
            if len(members) >= PACK_ITEMS:
                out = flush()
                made, members = made + out.num_rows, []
                yield out
        if members:
            yield flush()

    return run


def _merge_round(capacity: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fills, blobs, made = [], [], 0
        for batch in batches:
            fills += batch.column(0).to_pylist()
            blobs += batch.column(1).to_pylist()
            if len(fills) >= PACK_ITEMS:
                out = _packed(np.array(fills, "i8"), blobs, capacity, level, made)
                made, fills, blobs = made + out.num_rows, [], []
                yield out
        if fills:
            yield _packed(np.array(fills, "i8"), blobs, capacity, level, made)

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rounds, tasks, bins, members = (batch.column(i).to_pylist() for i in range(4))
        rows = [np.frombuffer(m, MEMBER) for m in members]
        if not rows:
            continue
        every = np.concatenate(rows)
        sequence = np.repeat([(r << 58) | (t << 32) | b for r, t, b in zip(rounds, tasks, bins, strict=True)], [len(r) for r in rows])
        offset = np.concatenate([np.cumsum(r["length"], dtype="i8") - r["length"] for r in rows])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(every["doc_id"].copy(), pa.int64(), mask=every["null"].astype(bool)),
                pa.array(every["piece"].copy(), pa.int32()),
                pa.array(every["start"].copy(), pa.int64()),
                pa.array(every["length"].astype("i8")),
                pa.array(every["crc"].astype("i8")),
                pa.array(sequence.astype("i8")),
                pa.array(offset),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenize docs(doc_id, text) and pack the pieces into sequences of at most `capacity` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or tokenizer_file("word_bpe_49k.json")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    bins = staged(texts.mapInArrow(_first_round(path, end_id, capacity), BINS), "bins0")
    done, tasks, level = [], None, 0
    while True:
        # A bin is done when the smallest item that is still open anywhere, which may be the bin itself, no longer fits it.
        stat = bins.where(F.col("fill") < capacity).agg(F.min("fill"), F.count("*"), F.count_distinct("task")).head()
        least, count, spread = stat
        tasks = tasks or max(1, spread)
        fits = F.col("fill") <= F.lit(capacity - (least or capacity))
        left = bins.where(fits)
        if not count or (level and tasks == 1):
            done.append(bins)
            break
        n_left = left.count()
        groups = max(1, -(-tasks // FAN_IN), -(-n_left // GROUP_ROWS))
        if n_left < 2 or (level and groups >= tasks):
            done.append(bins)
            break
        done.append(bins.where(~fits))
        level += 1
        dealt = left.select("fill", "members").repartition(groups, F.xxhash64("members"))
        bins = staged(dealt.mapInArrow(_merge_round(capacity, level), BINS), f"bins{level}")
        tasks = groups
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return every.select("round", "task", "bin", "members").mapInArrow(_unpack, PIECES)

