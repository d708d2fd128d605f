"""Near-duplicate documents by DartMinHash signatures, banded joining, exact verification and connected components.

A text is the weighted set of its word 5-shingles. Each element is a strip whose width is its weight; darts fall on the
strips as a Poisson process that depends on the element alone, at ranks that grow from 0, and each dart carries one of
k coordinates. A signature keeps the earliest dart of every coordinate, so two texts agree on a coordinate with the
probability of their weighted Jaccard similarity. Darts are thrown up to the rank at which about k ln k + 2k have
fallen, whatever the size of the text, and further only while a coordinate has none.

Texts of equal words are one node from the start, so copies cost nothing later. Nodes that share a band's key form a
bucket. First, every node of a bucket is verified against the bucket's centre, the text that meets most others, with the
exact similarity; classes are the connected components of these links. That settles groups of near copies at one link
per row. In buckets with several classes, pairs of different classes are compared next, block by block, by sketches of
their signatures, and only pairs that may reach the similarity become rows and are verified. A sketch misses a pair of
just the least similarity with probability below 1e-6, which adds to the bands' 3e-6; a bucket of one class, however
large, costs nothing more. Links inside a class that need not be known for the classes stay unverified.

A key, a centre, a root or a text that a third of all rows share is dealt to several tasks: the rows carry a salt, and
the other side's one row is copied for the salts that occur.

Weights are a shingle's count in the text (weighted Jaccard similarity of the shingle multisets), or 1 for each distinct
shingle with weighted=False (plain Jaccard similarity).

Defined results: a null text is the empty text; texts of fewer than five words are one shingle; empty texts are copies
of each other; words are split at white space, in lower case; rows with equal or null doc_id are rows of their own; an
empty table gives no rows; other columns of docs are ignored or kept as they are. Of rows with the least doc_id and the
same words one stays, in the order of the input's partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import is_empty, small_batches, staged, text_or_empty

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8 ** 6) ** 42 < 3e-6.
BANDS, ROWS = 42, 6

#: Rows of a bucket's block; coordinates of the sketches that its classes are compared by, and of their first part.
BLOCK, SKETCH, FIRST = 2048, 512, 128
#: Characters of a block; shingles that a task keeps of the texts it compares.
BLOCK_CHARS, CACHED_SHINGLES = 32_000_000, 4_000_000
#: Rows up to this number, 24 MB, are broadcast to find their texts.
BROADCAST_ROWS = 1_000_000
#: Tasks that the rows of one key are dealt to.
SALTS = 16

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0xD1342543DE82EF95
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> list[np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def shingles(words: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the word shingles of a normal text, sorted by hash."""
    data = np.frombuffer(words.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.zeros(1, np.uint64), np.ones(1, int)
    up, down = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    cuts = np.flatnonzero(data == 32)
    starts, ends = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(data)]))
    own = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    n = max(1, len(own) - size + 1)
    both = np.zeros(n, np.uint64)
    for k in range(min(size, len(own))):
        both = both * _GOLD + own[k : k + n]
    return np.unique(_mixed(both), return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """DartMinHash: the earliest dart of each of k coordinates, as 64-bit marks. Weights are positive numbers."""
    # strips of width 1, the last of an element narrower: a dart there counts where it falls within the width
    strips = np.ceil(weights).astype(int)
    cells = np.repeat(elements, strips) if strips.max() > 1 else elements
    layer = np.arange(len(cells)) - np.repeat(np.cumsum(strips) - strips, strips)
    width = np.minimum(1.0, np.repeat(np.asarray(weights, float), strips) - layer)
    seeds = _mixed(cells + (layer + 1).astype(np.uint64) * _GOLD)
    limit = (k * np.log(k) + 2 * k) / float(np.sum(weights))
    rank, mark = np.full(k, np.inf), np.zeros(k, np.uint64)
    last, thrown = np.zeros(len(cells)), 0
    alive = np.arange(len(cells))
    while True:
        while len(alive):
            # the next few darts of the strips that may still have some below the limit
            room = limit - float(last[alive].min())
            ahead = int(min(room + 3 * room**0.5 + 2, 400_000 // len(alive) + 1))
            no = np.arange(thrown, thrown + ahead, dtype=np.uint64) + np.uint64(1)
            darts = _mixed(seeds[alive, None] + no[None, :] * _M2)
            gaps = -np.log(((darts >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
            at = last[alive, None] + np.cumsum(gaps, axis=1)
            last[alive] = at[:, -1]
            more = _mixed(darts)
            hit = at <= limit
            if (narrow := width[alive] < 1).any():
                hit &= ~narrow[:, None] | ((_mixed(more + _GOLD) >> np.uint64(11)).astype(float) * 2.0**-53 < width[alive, None])
            ranks, marks = at[hit], more[hit]
            spot = (marks % np.uint64(k)).astype(int)
            before = rank.copy()
            np.minimum.at(rank, spot, ranks)
            first = (ranks == rank[spot]) & (ranks < before[spot])
            mark[spot[first]] = marks[first]
            thrown += ahead
            alive = alive[last[alive] <= limit]
        if np.isfinite(rank).all():
            return mark
        # rare: a coordinate without a dart. Throw again up to twice the rank
        limit, last, thrown, alive = limit * 2, np.zeros(len(cells)), 0, np.arange(len(cells))


def bands_of(words: str, weighted: bool, bands: int, rows: int, size: int = SHINGLE) -> np.ndarray:
    """A text's band keys."""
    elements, counts = shingles(words, size)
    marks = signature(elements, counts if weighted else np.ones(len(elements)), bands * rows).reshape(bands, rows)
    both = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        both = _mixed(both * _GOLD + marks[:, k])
    return both.view(np.int64)


def sketch_of(words: str, weighted: bool, k: int, size: int = SHINGLE) -> bytes:
    """One byte of each coordinate of a signature."""
    elements, counts = shingles(words, size)
    marks = signature(elements, counts if weighted else np.ones(len(elements)), k)
    return (_mixed(marks + _GOLD) >> np.uint64(56)).astype(np.uint8).tobytes()


def similarity(a: tuple, b: tuple, weighted: bool) -> float:
    """Exact (weighted) Jaccard similarity of two sorted (hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if weighted:
        both = np.minimum(a[1][i], b[1][j]).sum()
        return both / (a[1].sum() + b[1].sum() - both)
    return len(i) / (len(a[0]) + len(b[0]) - len(i))


def _identity(words: str) -> bytes:
    return hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def salt_of(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def salts_seen() -> Column:
    """Aggregate: the salts that occur in a group, as bits."""
    return F.expr("bit_or(shiftleft(1, salt))")


def each_salt(mask: str) -> Column:
    """A row for each salt of such bits."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit(F.col(mask), i) == 1))


def hot_join(rows: DataFrame, table: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """rows joined with table, which has one row per key. Rows of one key are dealt by the column `by` to several tasks,
    with a copy of the key's row in each. rows should be a written table: it is read twice."""
    salted = rows.withColumn("salt", salt_of(by))
    copies = salted.select(key, "salt").distinct().join(table, key)
    return salted.join(copies, [key, "salt"], how).drop("salt")


def signature_of(text: Column, weighted: bool, bands: int, rows: int, size: int) -> Column:
    """words, the identity of a text's words, and keys, its band keys."""

    @F.arrow_udf("struct<words:binary,keys:array<bigint>>")
    def signed(texts: pa.Array) -> pa.Array:
        words = [normal(t) for t in texts.to_pylist()]
        flat = np.concatenate([bands_of(w, weighted, bands, rows, size) for w in words]) if words else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * bands, pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array([_identity(w) for w in words], pa.binary()), lists], names=["words", "keys"])

    return signed(text)


def _verify(weighted: bool, size: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple = (None, None)
        for batch in batches:
            near = []
            for centre, text, other in zip(*(batch.column(i).to_pylist() for i in range(1, 4)), strict=True):
                if kept[0] != centre:
                    kept = (centre, shingles(normal(text), size))
                near.append(similarity(kept[1], shingles(normal(other), size), weighted) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.bool_())], names=["node", "centre", "near"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, weighted: bool, size: int, least: float) -> DataFrame:
    """pairs(node, centre), a written table, with their exact decision near."""
    centres = texts.select(F.col("node").alias("centre"), F.col("text").alias("centre_text"))
    dealt = pairs.withColumn("salt", salt_of("node"))
    copies = few(staged(dealt.select("centre", "salt").distinct(), "copies")).join(centres, "centre")
    others = few(dealt).join(texts.select("node", F.col("text").alias("other")), "node")
    both = others.join(copies, ["centre", "salt"]).select("node", "centre", "centre_text", "other")
    return both.mapInArrow(_verify(weighted, size, least), "node long, centre long, near boolean")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges(a, b): node and root, the least node of its component. Each round every node takes
    the least label of its neighbours and then its label's label, so rounds grow with the logarithm of a path's length."""
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")), "labels")
    while True:
        near = hot_join(both, labels.withColumnRenamed("node", "b"), "b", "a").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        better = staged(labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "better")
        jump = better.select(F.col("node").alias("root"), F.col("root").alias("further"))
        moved = staged(hot_join(better, jump, "root", "node").select("node", "old", F.least("root", "further").alias("root")), "labels")
        labels = moved.select("node", "root")
        if is_empty(moved.where("root <> old")):
            return labels


def _margin(least: float, k: int) -> float:
    """The share of k coordinates that a pair of the least similarity misses with probability below 1e-6."""
    return least - 5 * (least * (1 - least) / k) ** 0.5


class _Sets:
    """Shingles of the texts of a group, computed when needed; the last few million stay."""

    def __init__(self, texts: tuple[str, ...], size: int):
        self.texts, self.size, self.known, self.held = texts, size, {}, 0

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.known:
            if self.held > CACHED_SHINGLES:
                self.known, self.held = {}, 0
            self.known[i] = shingles(normal(self.texts[i]), self.size)
            self.held += len(self.known[i][0])
        return self.known[i]


def _grouped(work):
    """For mapInArrow: work(rows) of each run of rows that agree in their first three columns; work returns columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:3] != group[0][:3]:
                    yield work(group)
                    group = []
                group.append(row)
        if group:
            yield work(group)

    return run


def _candidates(least: float):
    """Rows of a group (key, lo, hi, block, node, root, sketch, keys) whose sketch may belong to a text of that similarity
    to one of another class, unless the two meet under a lower key as well. A group with lo = hi is one block, others are
    two to compare."""
    first, whole = FIRST * _margin(least, FIRST), SKETCH * _margin(least, SKETCH)

    def work(rows: list[tuple]) -> pa.RecordBatch:
        key, lo, hi, block, node, root, sketch, keys = zip(*rows, strict=True)
        marks = np.frombuffer(b"".join(sketch), np.uint8).reshape(len(rows), -1)
        head = np.ascontiguousarray(marks[:, :FIRST])
        classes = np.unique(root, return_inverse=True)[1]
        two, blocks, hit = lo[0] != hi[0], np.array(block), np.zeros(len(rows), bool)
        lower = [{k for k in own if k < key[0]} for own in keys]
        for i in range(len(rows) - 1):
            alike = np.flatnonzero(np.count_nonzero(head[i + 1 :] == head[i], axis=1) >= first) + i + 1
            alike = alike[classes[alike] != classes[i]]
            if two:
                alike = alike[blocks[alike] != blocks[i]]
            alike = alike[np.count_nonzero(marks[alike] == marks[i], axis=1) >= whole]
            for k in alike.tolist():
                if not (hit[i] and hit[k]) and lower[i].isdisjoint(lower[k]):
                    hit[i] = hit[k] = True
        at = np.flatnonzero(hit).tolist()
        names = ["key", "lo", "hi", "block", "node", "root"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([c[i] for i in at], t) for c, t in zip((key, lo, hi, block, node, root), kinds, strict=True)], names=names)

    return _grouped(work)


def _cross(weighted: bool, size: int, least: float):
    """Links between different classes in groups of rows (key, lo, hi, block, node, root, text): pairs are verified unless
    links join their classes already, so a group gives fewer links than it has classes."""

    def work(rows: list[tuple]) -> pa.RecordBatch:
        _, lo, hi, block, node, root, texts = zip(*rows, strict=True)
        classes = np.unique(root, return_inverse=True)[1]
        two, block, sets, found = lo[0] != hi[0], np.array(block), _Sets(texts, size), []
        for i in range(len(rows) - 1):
            other = classes[i + 1 :] != classes[i]
            if two:
                other &= block[i + 1 :] != block[i]
            for k in (np.flatnonzero(other) + i + 1).tolist():
                if classes[k] != classes[i] and similarity(sets.of(i), sets.of(k), weighted) >= least:
                    classes[classes == classes[k]] = classes[i]
                    found.append((node[i], node[k], root[i], root[k]))
        columns = zip(*found, strict=True) if found else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "centre", "a", "b"])

    return _grouped(work)


def _sketched(weighted: bool, k: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch_of(normal(t), weighted, k, size) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["node", "sketch"])

    return run


def crossing(members: DataFrame, texts: DataFrame, weighted: bool, size: int, least: float) -> DataFrame:
    """Verified links (node, centre) with their classes' roots (a, b), between classes that meet in a bucket of
    members(key, node, root, chars), a written table. Buckets of one class are left out, and of buckets with the same
    members all but one. Sketches show which rows may have a link at all; only these meet again with their texts."""
    sums = [F.bit_xor(F.xxhash64("node")).alias("x0"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("x1")]
    bucket = members.groupBy("key").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.min("root").alias("r0"), F.max("root").alias("r1"), *sums).where("r0 <> r1")
    bucket = bucket.groupBy("n", "chars", "x0", "x1").agg(F.min("key").alias("key"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("chars") / BLOCK_CHARS)).cast("int").alias("blocks")
    rows = staged(hot_join(members, bucket.select("key", blocks), "key", "node").select("key", "node", "root", "blocks"), "mixed")
    met = staged(rows.groupBy("node").agg(F.collect_set("key").alias("keys")), "meetings")
    some = texts.join(met.select("node"), "node", "left_semi").select("node", "text")
    sketches = staged(some.mapInArrow(_sketched(weighted, SKETCH, size), "node long, sketch binary").join(met, "node"), "sketches")
    rows = rows.join(sketches, "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "root", "sketch", "keys")
    group = ["key", "lo", "hi"]
    together = lambda df: df.repartition(*group).sortWithinPartitions(*group, "node")
    hits = staged(together(rows).mapInArrow(_candidates(least), "key long, lo int, hi int, block int, node long, root long"), "candidates")
    pairs = texts.join(few(hits), "node").select(*group, "block", "node", "root", "text")
    return together(pairs).mapInArrow(_cross(weighted, size, least), "node long, centre long, a long, b long")


def few(rows: DataFrame) -> DataFrame:
    """rows without texts, a written table, for a join with texts: broadcast if they are few, else Spark shuffles."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def links(nodes: DataFrame, signed: DataFrame, weighted: bool, size: int, least: float) -> tuple[DataFrame, DataFrame] | None:
    """Verified links (node, centre) between the distinct texts nodes(node, chars, keys) of signed(node, text), and their
    components (node, root); None without any bucket of two texts."""
    rows = nodes.select("node", salt_of("node").alias("salt"), F.explode("keys").alias("key"))
    crowded = rows.groupBy("key").agg(F.count("*").alias("n"), salts_seen().alias("mask")).where("n > 1").select("key", each_salt("mask").alias("salt"))
    # a shuffle at every size: the crowded keys grow with the documents
    members = staged(rows.join(crowded.hint("merge"), ["key", "salt"]).select("key", "node"), "members")
    if is_empty(members):
        return None
    # texts that meet many others come first: an original before its edited copies
    met = staged(members.groupBy("node").agg(F.count("*").alias("met")).join(nodes.select("node", "chars"), "node"), "met")
    texts = staged(signed.join(few(met.select("node")), "node"), "texts")
    ranked = staged(members.join(met.select("node", "met", "chars"), "node"), "ranked")
    centres = ranked.groupBy("key").agg(F.max(F.struct("met", "node"))["node"].alias("centre"))
    pairs = hot_join(ranked.select("key", "node"), centres, "key", "node").where("node <> centre")
    pairs = staged(pairs.select(F.least("node", "centre").alias("node"), F.greatest("node", "centre").alias("centre")).distinct(), "pairs")
    near = staged(_verified(pairs, texts, weighted, size, least).where("near").select("node", "centre"), "near")
    roots = components(near.toDF("a", "b"))
    classes = ranked.join(roots, "node", "left").select("key", "node", "chars", F.coalesce("root", "node").alias("root"))
    late = staged(crossing(staged(classes, "bucketed"), texts, weighted, size, least), "late")
    if is_empty(late):
        return near, roots
    near = near.unionByName(late.select("node", "centre")).distinct()
    merged = components(late.select("a", "b")).select(F.col("node").alias("root"), F.col("root").alias("last"))
    alone = merged.join(roots.select("root"), "root", "left_anti").select(F.col("root").alias("node"), F.col("last").alias("root"))
    roots = hot_join(roots, merged, "root", "node", "left").select("node", F.coalesce("last", "root").alias("root"))
    return near, staged(roots.unionByName(alone), "roots")


def _classes(docs: DataFrame, weighted: bool, bands: int, rows: int, size: int, least: float) -> tuple[DataFrame, DataFrame]:
    """The rows as (row, doc, words), staged with a number each; and of every distinct text: words, winner (the class's
    first row), class_rows, verified_links. A text is known by the number of its first row."""
    small_batches(docs.sparkSession)
    base = docs.select(F.struct(*docs.columns).alias("doc")).withColumn("s", signature_of(text_or_empty("doc.text"), weighted, bands, rows, size))
    signed = staged(base.select(F.monotonically_increasing_id().alias("row"), "doc", "s.words", "s.keys"), "signed")
    text = text_or_empty("doc.text")
    place = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").cast("long").alias("id"), "row")
    nodes = signed.groupBy("words").agg(F.min(place).alias("first"), F.count("*").alias("copies"), F.min(F.length(text)).alias("chars"), F.first("keys").alias("keys"))
    nodes = staged(nodes.select("words", "first", F.col("first.row").alias("node"), "copies", "chars", "keys"), "nodes")
    linked = links(nodes, signed.select(F.col("row").alias("node"), text.alias("text")), weighted, size, least)
    signed, ids = signed.drop("keys"), nodes.select("words", "node", "first", "copies")
    none = F.lit(0).cast("long").alias("verified_links")
    alone = ids.select("node", "words", F.col("first").alias("winner"), F.col("copies").alias("class_rows"), none)
    if linked is None:
        return signed, alone
    edges, roots = linked
    degree = edges.select("node").unionByName(edges.select(F.col("centre").alias("node"))).groupBy("node").agg(F.count("*").alias("verified_links"))
    rooted = staged(roots.join(degree, "node").join(ids, "node"), "rooted")
    total = rooted.groupBy("root").agg(F.min("first").alias("winner"), F.sum("copies").alias("class_rows"))
    classes = hot_join(rooted, total, "root", "node").select("node", "words", "winner", "class_rows", "verified_links")
    return signed, staged(classes.unionByName(alone.join(rooted.select("node"), "node", "left_anti")), "classes")


def find(docs: DataFrame, weighted: bool = True, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, class_id (the class's least doc_id), class_rows (rows in the
    class), verified_links (links of its text to other texts that were verified; others may exist inside the class), words
    (identity of its words, hexadecimal)."""
    signed, classes = _classes(docs, weighted, bands, rows, size, least)
    named = hot_join(signed.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), "words"), classes, "words", "row")
    return named.select("doc_id", F.col("winner.id").alias("class_id"), "class_rows", "verified_links", F.lower(F.hex("words")).alias("words"))


def keep_first(docs: DataFrame, weighted: bool = True, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """One row of each class of docs, all columns: the one with the least doc_id."""
    signed, classes = _classes(docs, weighted, bands, rows, size, least)
    several = classes.where("class_rows > 1").select("words", F.col("winner.row").alias("winner"))
    losers = staged(hot_join(signed.select("row", "words"), several, "words", "row").where("row <> winner").select("row"), "losers")
    return signed.join(few(losers), "row", "left_anti").select("doc.*")
