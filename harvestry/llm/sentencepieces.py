"""SentencePiece encoding and decoding by Viterbi, with a max-plus parallel scan over giant documents.

A text's best segmentation maximises the sum of its pieces' scores (the unigram model of SentencePiece; a vocabulary
file of another type is read as one, with its pieces and scores). Texts of up to `chunk_chars` are encoded in one go.
Longer ones are split into chunks at fixed places. A chunk's transfer matrix holds, for every offset at which its first
piece may start and every offset past its end at which its last piece may end, the best score between them. Matrices
multiply in the (max, +) semiring, which is associative: blocks of chunks multiply to block matrices, level by level,
and from the top down every block learns where its best path enters and leaves it. With these two places each chunk is
segmented on its own.

Among segmentations of equal score the one with the longest last piece counts, then the longest last but one, and so on:
the plain recurrence's choice, and the scan's as well, so ids don't depend on chunks. A matrix holds, beside each score,
the rank that the entry's preferred path has by this rule among those that leave at the same place. Paths that enter at
different places differ within the chunk, so ranks never tie; in a product the later matrix's rank comes first.

No piece of the vocabulary goes on past a space after other characters, so every path visits the place before a word:
between the first and the last such place of a chunk its matrix is a sum, and only the words at its ends need the
states. A chunk without such a place (one long word) gets the general recurrence. Scores add up exactly, as doubles.

Encoding adds the model's leading space; characters without a piece become byte pieces. decode(encode(x)) is x unless x
holds the space sign U+2581 itself.

Defined results: a null text is the empty text, which has no ids; rows with equal or null doc_id are rows of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import WordMemo, is_empty, small_batches, staged, text_or_empty, tokenizer_file

SPACE = "▁"
#: Characters of a chunk, and matrices that multiply at once.
CHUNK_CHARS, FAN_IN = 16_384, 64
#: Words whose ids a worker remembers.
CACHE_WORDS = 600_000
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Vocabulary:
    """Pieces with scores, and ids of words under them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = model.SentencePiece
        self.pieces = {p.piece: (float(p.score), i) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.bytes_at = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.unknown = min(s for s, _ in self.pieces.values()) - 10.0
        self.longest = max(map(len, self.pieces))
        self.single = {p for p in self.pieces if len(p) == 1}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece goes on past the start of a word")
        # letters to what goes on with them, and the score and id of the piece that ends there
        self.tree: dict = {}
        for p in sorted(self.pieces):
            below = self.tree
            for letter in p[:-1]:
                below = below.setdefault(letter, ({}, None, None))[0]
            below[p[-1]] = ({}, *self.pieces[p])
        self.output = [b""] * len(model.pieces)
        for p, (_, i) in self.pieces.items():
            self.output[i] = p.replace(SPACE, " ").encode()
        for b, i in self.bytes_at.items():
            self.output[i] = bytes([b])
        # scores by id: of the bytes of a character without a piece, the first one bears its cost
        self.scores = np.zeros(len(model.pieces))
        for score, i in self.pieces.values():
            self.scores[i] = score
        for b, i in self.bytes_at.items():
            self.scores[i] = 0.0 if 0x80 <= b < 0xC0 else self.unknown
        self.memo = WordMemo(self._words, CACHE_WORDS)

    def arcs(self, text: str, at: int) -> Iterator[tuple[int, float]]:
        """Ends and scores of the pieces that start at a place."""
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            if (found := self.pieces.get(text[at:end])) is not None:
                yield end, found[0]
        if text[at] not in self.single:
            yield at + 1, self.unknown

    def segment(self, text: str) -> tuple[bytes, float]:
        """Ids (little-endian) and score of the best segmentation of a short text, by the plain recurrence."""
        n, root, unknown = len(text), self.tree, self.unknown
        best, back, ids = [0.0] + [-np.inf] * n, [0] * (n + 1), [0] * (n + 1)
        for at in range(n):
            here, end, below = best[at], at, root
            for letter in text[at:]:
                found = below.get(letter)
                if found is None:
                    break  # no piece goes on like this
                below, score, number = found
                end += 1
                if score is not None and here + score > best[end]:
                    best[end], back[end], ids[end] = here + score, at, number
            if here + unknown > best[at + 1] and text[at] not in self.single:
                best[at + 1], back[at + 1], ids[at + 1] = here + unknown, at, None
        out, end = [], n
        while end:
            if ids[end] is None:
                out += [self.bytes_at[b] for b in reversed(text[back[end] : end].encode("utf-8", "surrogatepass"))]
            else:
                out.append(ids[end])
            end = back[end]
        return array("I", out[::-1]).tobytes(), best[n]

    def _words(self, units: list[str]) -> list[bytes]:
        return [self.segment(u)[0] for u in units]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of escaped texts, unit by unit."""
        units = [_UNITS.findall(t) for t in texts]
        known = self.memo.ready(units)
        return [b"".join(map(known.__getitem__, own)) for own in units]

    def score(self, ids: bytes) -> float:
        return float(self.scores[np.frombuffer(ids, "<u4")].sum())

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.output.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def cuts(self, text: str, size: int) -> tuple[int, int] | None:
        """The first and the last place of a chunk of `size` characters that every path visits."""
        found = [m.start() for m in re.finditer(f"(?<=[^{SPACE}]){SPACE}", text[: size + 1]) if m.start() >= self.longest - 1]
        return (found[0], found[-1]) if found else None

    def preferred(self, text: str) -> tuple[float, tuple[int, ...]]:
        """Score of a text's preferred segmentation, and the starts of its pieces from the last to the first."""
        n = len(text)
        best, back = [0.0] + [-np.inf] * n, [0] * (n + 1)
        for at in range(n):
            if best[at] > -np.inf:
                for end, score in self.arcs(text, at):
                    if end <= n and best[at] + score > best[end]:
                        best[end], back[end] = best[at] + score, at
        starts, end = [], n
        while end and best[n] > -np.inf:
            end = back[end]
            starts.append(end)
        return best[n], tuple(starts)

    def transfer(self, text: str, size: int, cuts: tuple[int, int] | None, middle: bytes) -> np.ndarray:
        """Scores and ranks of a chunk of `size` characters, with the ids between its cuts; text goes on past it as far
        as a piece may reach."""
        n = self.longest
        if cuts:
            first, last = cuts
            heads = [self.preferred(text[e:first]) for e in range(n)]
            # from the last start on, the earlier one is preferred; a path that ends sooner has no start left to lose by
            ways = sorted((tuple(e + s for s in starts), e) for e, (_, starts) in enumerate(heads))
            ranks = np.empty(n)
            for rank, (_, e) in enumerate(ways):
                ranks[e] = rank
            scores = np.array([score for score, _ in heads])[:, None] + self.score(middle) + self._ends(text, last, size, 1)[0]
            return np.stack([scores, np.broadcast_to(ranks[:, None], (n, n))])
        return np.stack(self._ends(text, 0, size, n))

    def _ends(self, text: str, at: int, size: int, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """Best scores, and ranks, at the places from `size` on of paths that start at `at`, or at each of the first `lanes`
        places from there."""
        n = self.longest
        best = np.full((size + n - at, lanes), -np.inf)
        back = np.full(best.shape, -1)
        rank = np.zeros(best.shape)
        for k in range(min(lanes, len(best))):
            best[k, k] = 0.0
        for here in range(size + n - at):
            if lanes > 1:  # by the last start, then by the rank there; a path that begins here comes first
                before = np.where(back[here] < 0, -1, rank[back[here], np.arange(lanes)])
                rank[here, np.lexsort((before, back[here]))] = np.arange(lanes)
            own = best[here]
            if here + at < size and own.max() > -np.inf:
                for end, score in self.arcs(text, here + at):
                    news = own + score
                    better = news > best[end - at]
                    best[end - at][better], back[end - at][better] = news[better], here
        return best[size - at :].T, rank[size - at :].T


@functools.lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker: its memo serves all tasks that the worker runs."""
    return Vocabulary(path)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of matrices of scores and ranks."""
    n = a.shape[1]
    every = a[0][:, :, None] + b[0][None]
    best = every.max(1)
    via = np.where(every == best[:, None], b[1][None], np.inf).argmin(1)
    pair = b[1][via, np.arange(n)[None]] * n + a[1][np.arange(n)[:, None], via]
    return np.stack([best, pair.argsort(0, kind="stable").argsort(0).astype(float)])


def borders(matrices: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """States at the borders of consecutive matrices on the preferred path from `enter` to `leave`, both included."""
    front = [np.where(np.arange(matrices[0].shape[1]) == enter, 0.0, -np.inf)]
    for scores, _ in matrices[:-1]:
        front.append((front[-1][:, None] + scores).max(0))
    states = [leave]
    for f, (scores, ranks) in zip(front[::-1], matrices[::-1], strict=True):
        ways = f + scores[:, states[-1]]
        states.append(int(np.where(ways == ways.max(), ranks[:, states[-1]], np.inf).argmin()))
    return states[::-1]


def _matrix(blob: bytes) -> np.ndarray:
    own = np.frombuffer(blob, float)
    return own.reshape(2, int((len(own) // 2) ** 0.5), -1)


CHUNKS = "row long, doc_id long, no long, piece string, size int"
TRANSFERS = "row long, doc_id long, no long, size int, first int, last int, head string, tail string, middle binary, same boolean, back binary, matrix binary"


def _split(chunk_chars: int, reach: int):
    """The chunks of giant texts (row, doc_id, text), each with the characters that a piece from it may reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = escaped(text)
                starts = range(0, len(text), chunk_chars)
                for i in range(0, len(starts), 256):
                    own = starts[i : i + 256]
                    pieces = [text[a : a + chunk_chars + reach - 1] for a in own]
                    sizes = [min(chunk_chars, len(text) - a) for a in own]
                    columns = [pa.array([row] * len(own), pa.int64()), pa.array([doc_id] * len(own), pa.int64()), pa.array([a // chunk_chars for a in own], pa.int64()), pa.array(pieces), pa.array(sizes, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "no", "piece", "size"])

    return run


def _transfers(path: str):
    """Of each chunk its matrix, the ids between its cuts, and the texts before and after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts, sizes = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            cuts = [v.cuts(t, s) for t, s in zip(texts, sizes, strict=True)]
            between = [t[c[0] : c[1]] if c else "" for t, c in zip(texts, cuts, strict=True)]
            middle = v.encode(between)
            back = [v.decode(m) for m in middle]
            same = [d == plain(t) for d, t in zip(back, between, strict=True)]
            matrices = [v.transfer(t, s, c, m).tobytes() for t, s, c, m in zip(texts, sizes, cuts, middle, strict=True)]
            firsts, lasts = ([c[k] if c else None for c in cuts] for k in (0, 1))
            heads = [t[: c[0]] if c else t for t, c in zip(texts, cuts, strict=True)]
            tails = [t[c[1] :] if c else "" for t, c in zip(texts, cuts, strict=True)]
            columns = [*(batch.column(i) for i in (0, 1, 2, 4)), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32()), pa.array(heads), pa.array(tails)]
            columns += [pa.array(middle, pa.binary()), pa.array(same, pa.bool_()), pa.array(back, pa.binary()), pa.array(matrices, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "no", "size", "first", "last", "head", "tail", "middle", "same", "back", "matrix"])

    return run


def _multiplied(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("no")
    whole = functools.reduce(product, map(_matrix, rows["matrix"]))
    return pd.DataFrame({"row": rows["row"].iloc[:1], "no": rows["no"].iloc[:1] // FAN_IN, "matrix": [whole.tobytes()]})


def _descended(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("no")
    at = borders(list(map(_matrix, rows["matrix"])), int(rows["enter"].iloc[0]), int(rows["leave"].iloc[0]))
    return pd.DataFrame({"row": rows["row"], "no": rows["no"], "enter": at[:-1], "leave": at[1:]})


def scan(transfers: DataFrame) -> DataFrame:
    """row, no, enter, leave of every chunk of transfers(row, no, matrix): where each document's best path crosses."""
    levels = [transfers]
    while not is_empty(levels[-1].where("no > 0")):
        up = levels[-1].groupBy("row", F.floor(F.col("no") / FAN_IN).alias("block")).applyInPandas(_multiplied, "row long, no long, matrix binary")
        levels.append(staged(up, "products"))
    states = levels[-1].select("row", "no", F.lit(0).alias("enter"), F.lit(0).alias("leave"))
    for level in levels[-2::-1]:
        blocks = states.withColumnRenamed("no", "block")
        down = level.withColumn("block", F.floor(F.col("no") / FAN_IN)).join(blocks, ["row", "block"])
        states = staged(down.groupBy("row", "block").applyInPandas(_descended, "row long, no long, enter int, leave int"), "states")
    return states


def escaped(text: str) -> str:
    """With the space sign for spaces, and one in front unless the text is empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def plain(text: str) -> bytes:
    """UTF-8 of an escaped text."""
    return text.replace(SPACE, " ").encode("utf-8", "surrogatepass")


PARTS = "doc_id long, part int, start long, n_ids long, ids_crc32 long, decoded boolean, decoded_sha256 string, ids array<int>"


def _rows(v: Vocabulary, doc_id: pa.Array, part: list, start: list, ids: list[bytes], back: list[bytes], same: list[bool]) -> pa.RecordBatch:
    columns = [
        doc_id,
        pa.array(part, pa.int32()),
        pa.array(start, pa.int64()),
        pa.array([len(i) // 4 for i in ids], pa.int64()),
        pa.array([zlib.crc32(i) for i in ids], pa.int64()),
        pa.array(same, pa.bool_()),
        pa.array([hashlib.sha256(b).hexdigest() for b in back], pa.string()),
        pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(i) // 4 for i in ids)]), pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "start", "n_ids", "ids_crc32", "decoded", "decoded_sha256", "ids"])


def _short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            texts = [escaped(t) for t in batch.column(1).to_pylist()]
            ids = v.encode(texts)
            back = [v.decode(i) for i in ids]
            none = [0] * len(ids)
            yield _rows(v, batch.column(0), none, none, ids, back, [b == plain(t) for b, t in zip(back, texts, strict=True)])

    return run


def _long(path: str, chunk_chars: int):
    """Parts of chunks (doc_id, no, size, first, last, head, tail, middle, same, back, enter, leave): only the words at a
    chunk's ends are left to segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            _, no, size, first, last, head, tail, middle, same, back, enter, leave = (c.to_pylist() for c in batch.columns)
            before = [h[e:] if f is not None else h[e : s + x] for h, f, s, e, x in zip(head, first, size, enter, leave, strict=True)]
            after = [t[: s + x - f] if f is not None else "" for t, f, s, x in zip(tail, last, size, leave, strict=True)]
            ends = [v.encode(before), v.encode(after)]
            there = [[v.decode(i) for i in e] for e in ends]
            ids = [a + m + b for a, m, b in zip(ends[0], middle, ends[1], strict=True)]
            whole = [a + m + b for a, m, b in zip(there[0], back, there[1], strict=True)]
            good = [s and a == plain(x) and b == plain(y) for s, a, b, x, y in zip(same, *there, before, after, strict=True)]
            yield _rows(v, batch.column(0), no, [chunk_chars * k + e for k, e in zip(no, enter, strict=True)], ids, whole, good)

    return run


def encode(docs: DataFrame, model: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Encode docs(doc_id, text), one row per part of a document (giant ones have several): doc_id, part, start (in
    characters, the leading space included), n_ids, ids_crc32, decoded (whether the ids decode to the part),
    decoded_sha256 (of the decoded part in UTF-8), ids."""
    spark = docs.sparkSession
    small_batches(spark)
    path = model or tokenizer_file("piece_bpe_32k.model")
    reach = vocabulary(path).longest
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # with the leading space
    giant = rows.where(F.length("text") >= chunk_chars).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    # chunks of one text are dealt to all tasks, each is split off and encoded once
    chunks = giant.mapInArrow(_split(chunk_chars, reach), CHUNKS).repartition("row", "no")
    transfers = staged(chunks.mapInArrow(_transfers(path), TRANSFERS), "transfers")
    done = rows.where(F.length("text") < chunk_chars).mapInArrow(_short(path), PARTS)
    if is_empty(transfers):
        return done
    placed = transfers.drop("matrix").join(scan(transfers.select("row", "no", "matrix")), ["row", "no"]).where(F.col("size") + F.col("leave") > F.col("enter"))
    long = placed.select("doc_id", "no", "size", "first", "last", "head", "tail", "middle", "same", "back", "enter", "leave")
    return done.unionByName(long.mapInArrow(_long(path, chunk_chars), PARTS))


def _texts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in batches:
            out = []
            for ids, part in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = v.decode(np.array(ids or [], "<u4").tobytes())
                out.append((raw[1:] if part == 0 and raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["doc_id", "part", "text"])

    return run


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, part, text of encoded(doc_id, part, ids); a document's parts in order are its text."""
    path = model or tokenizer_file("piece_bpe_32k.model")
    return encoded.select("doc_id", "part", "ids").mapInArrow(_texts(path), "doc_id long, part int, text string")
