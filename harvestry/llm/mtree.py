"""Exact top-k inner-product search by best-first descent of M-trees.

Candidates are dealt by their nearest of at most PIVOTS pivots (rows of the smallest hashes), so that a tree holds rows near
each other; a cell of more than TREE_ROWS rows becomes several trees. Each tree is an M-tree of fixed-size pages. A leaf entry keeps its distance to
its page's pivot, a page its pivot, covering radius and distance to the parent's pivot. For a query q and a page with
pivot p and radius r every member x has <q,x> <= <q,p> + |q| r, and with the parent's pivot P, whose product is known,
<q,x> <= <q,P> + |q| (d(P,p) + r), which needs no product with p. A page or entry whose bound can't reach the k-th best
score so far is skipped without computing anything in it. Products are exact integers; bounds carry a slack for rounding.

The trees' roots, a centre and a radius each, are a table of their own. Query blocks meet the roots in blocks; each query first
searches the tree of its highest bound, then, with its k-th score so far as a floor, only those whose bound reaches it. The
k best of all are merged. Of equal vectors the k + 1 of the smallest ids take part, which loses no result: all score the
same, ties go to smaller ids, and at most one is the query's own.

Defined results: null vectors and vectors that hold null or non-finite components take no part; missing components of
shorter vectors count as 0; repeated equal rows count once; an empty table or query set gives no rows; rows with the
query's own id are no candidates; equal scores rank by smaller vec_id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestry.llm.common import small_batches, staged

#: Rows of a tree, entries of a page, queries of a block. A tree of 8192 vectors of 64 parts takes 4 MB.
TREE_ROWS, PAGE, QUERY_ROWS = 8192, 256, 1024
#: Most pivots that rows are dealt by, roots of a block, and what a query's vector begins with: its k-th score so far (LOWEST
#: if it has none), the tree searched first, its own id.
PIVOTS, ROOT_ROWS, HEAD, LOWEST = 1024, 8192, 3, -(1 << 63)
HITS = "no long, query_id long, vec_id long, score long"
BLOBS = "part long, nth int, n int, blob binary"


def quantized(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id and v array<bigint>: floor(scale * x) of every component, x as double."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    rows = vectors.where(x.isNotNull() & F.col("vec_id").isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double"))).alias("v"))


class MTree:
    """Bulk-loaded: pages of at most `page` entries around pivots chosen by farthest-point sampling, grouped level by level."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, page: int = PAGE):
        self.ids, self.data, self.page = ids, data, page
        self.real = data.astype("f8")
        # node: pivot vector, radius, distance to the parent's pivot, children or None, entries, their distances to the pivot
        self.pivot, self.radius, self.up, self.children, self.entries, self.off = [], [], [], [], [], []
        self.root = self._build(np.arange(len(ids)), None)

    def _node(self, pivot, parent) -> int:
        self.pivot.append(pivot)
        self.up.append(0.0 if parent is None else float(np.linalg.norm(pivot - parent)))
        for part in (self.radius, self.children, self.entries, self.off):
            part.append(None)
        return len(self.pivot) - 1

    def _build(self, rows: np.ndarray, parent) -> int:
        own = self.real[rows]
        pivot = own.mean(0)
        node = self._node(pivot, parent)
        far = np.linalg.norm(own - pivot, axis=1)
        self.radius[node] = float(far.max(initial=0.0))
        if len(rows) <= self.page:
            order = np.argsort(far, kind="stable")
            self.entries[node], self.off[node] = rows[order], far[order]
            return node
        parts = min(16, -(-len(rows) // self.page))
        seeds, near = [int(far.argmax())], np.full(len(rows), np.inf)
        for _ in range(parts - 1):
            near = np.minimum(near, ((own - own[seeds[-1]]) ** 2).sum(1))
            seeds.append(int(near.argmax()))
        centres = own[seeds]
        to = ((centres**2).sum(1) - 2 * own @ centres.T).argmin(1)
        if (counts := np.bincount(to, minlength=parts)).max() > 0.9 * len(rows):  # equal vectors part by position
            to = np.arange(len(rows)) * parts // len(rows)
            counts = np.bincount(to, minlength=parts)
        self.children[node] = [self._build(rows[to == k], pivot) for k in np.flatnonzero(counts)]
        return node

    def search(self, query_id: int, q: np.ndarray, k: int, best: list[tuple[int, int]], floor: int = LOWEST) -> list[tuple[int, int]]:
        """The k best (score, -vec_id) of `best` and this tree, as a heap with the worst first; rows that score under `floor`
        may be left out."""
        real, norm = q.astype("f8"), float(np.linalg.norm(q))
        slack = 1e-6 * (1.0 + norm)
        product = float(real @ self.pivot[self.root])
        todo = [(-(product + norm * self.radius[self.root]), self.root, product)]
        while todo:
            bound, node, product = heapq.heappop(todo)
            worst = max(floor, best[0][0]) if len(best) == k else None if floor == LOWEST else floor
            if worst is not None and -bound + slack * (1 + abs(bound)) < worst:
                break  # best first: no page that is left can reach it either
            if self.children[node] is None:
                rows = self.entries[node]
                if worst is not None:  # entries near the pivot whose own bound falls short
                    rows = rows[product + norm * self.off[node] + slack * (1 + abs(product)) >= worst]
                if not len(rows):
                    continue
                scores = self._exact(rows, q, real)
                if worst is not None:
                    keep = scores >= worst
                    rows, scores = rows[keep], scores[keep]
                elif len(scores) > 4 * k:
                    cut = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                    if (self.ids[rows] != query_id).all():
                        rows, scores = rows[scores >= cut], scores[scores >= cut]
                for vec_id, score in zip(self.ids[rows].tolist(), scores.tolist(), strict=True):
                    item = (score, -vec_id)
                    if vec_id == query_id or item in best:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                continue
            for child in self.children[node]:
                reach = norm * self.radius[child]
                if worst is not None and product + norm * self.up[child] + reach + slack * (1 + abs(product)) < worst:
                    continue  # by the stored distance to the parent alone
                own = float(real @ self.pivot[child])
                if worst is None or own + reach + slack * (1 + abs(own)) >= worst:
                    heapq.heappush(todo, (-(own + reach), child, own))
        return best

    def _exact(self, rows: np.ndarray, q: np.ndarray, real: np.ndarray) -> np.ndarray:
        if not hasattr(self, "top"):
            self.top = float(np.abs(self.real).max(initial=0.0))
        if self.top * float(np.abs(real).max(initial=0.0)) * len(real) < 2**52:
            return (self.real[rows] @ real).astype("i8")
        return (self.data[rows] * q).sum(1)


def _matrix(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    every = np.frombuffer(blob, "<i8")
    return every[:n], every[n:].reshape(n, -1)


def _widened(a: np.ndarray, dim: int) -> np.ndarray:
    return a if a.shape[1] >= dim else np.pad(a, ((0, 0), (0, dim - a.shape[1])))


def _blocks(rows: int):
    """Rows (part, vec_id, v) as blobs of at most `rows` vectors of a part: the ids, then the components, as 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        given: dict[int, int] = {}

        def blob(part: int) -> pa.RecordBatch:
            ids, vectors = held.pop(part)
            given[part] = given.get(part, -1) + 1
            flat = np.zeros((len(ids), max(map(len, vectors))), "<i8")
            for i, v in enumerate(vectors):
                flat[i, : len(v)] = v
            data = np.array(ids, "<i8").tobytes() + flat.tobytes()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([given[part]], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([data], pa.binary())], names=["part", "nth", "n", "blob"])

        for batch in batches:
            for part, vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids, vectors = held.setdefault(part, ([], []))
                ids.append(vec_id)
                vectors.append(v.values.to_numpy())
                if len(ids) == rows:
                    yield blob(part)
        for part in sorted(held):
            yield blob(part)

    return run


def _lists(rows: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype="i4") * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1), pa.int64()))


def _cells(pivots: np.ndarray):
    """The nearest pivot of each row (vec_id, v)."""
    real = pivots.astype("f8")
    squares = (real**2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.zeros((batch.num_rows, max([real.shape[1], *(len(v) for v in batch.column(1))])))
            for i, v in enumerate(batch.column(1)):
                own[i, : len(v)] = v.values.to_numpy()
            near = (squares - 2 * own[:, : real.shape[1]] @ real.T).argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int32()), batch.column(0), batch.column(1)], names=["cell", "vec_id", "v"])

    return run


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A tree as a row: its number, and a radius and a centre of integers, so that no row lies outside."""
    for batch in batches:
        for tree, n, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            _, data = _matrix(blob, n)
            centre = np.rint(data.mean(0)).astype("i8")
            radius = int(np.ceil(np.linalg.norm(data.astype("f8") - centre, axis=1).max() + 1))
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int64()), _lists(np.concatenate([[radius], centre])[None])], names=["vec_id", "v"])


def _bounds(queries: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """For each query and root a bound that no product of the query with a row of the root's tree exceeds."""
    q, c = queries[:, HEAD:].astype("f8"), roots[:, 1:].astype("f8")
    dim = max(q.shape[1], c.shape[1])
    norms = np.linalg.norm(q, axis=1)
    reach = _widened(q, dim) @ _widened(c, dim).T
    wide = norms[:, None] * roots[:, 0].astype("f8")[None]
    return reach + wide + 1e-6 * (1 + np.abs(reach) + wide)


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each query's tree of the highest bound among a block of roots."""
    for batch in batches:
        for m, queries, n, roots in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            (ids, q), (trees, r) = _matrix(queries, m), _matrix(roots, n)
            bound = _bounds(q, r)
            top = bound.argmax(1)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(trees[top]), pa.array(bound[np.arange(m), top])], names=["no", "tree", "bound"])


def _reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries with each tree of a block of roots whose bound reaches their k-th score so far, but for the first tree."""
    for batch in batches:
        for m, queries, n, roots in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            (ids, q), (trees, r) = _matrix(queries, m), _matrix(roots, n)
            at, to = np.nonzero((_bounds(q, r) >= q[:, :1].astype("f8")) & (q[:, 1:2] != trees[None]))
            for k in range(0, len(at), 4096):
                part = slice(k, k + 4096)
                yield pa.RecordBatch.from_arrays([pa.array(trees[to[part]]), pa.array(ids[at[part]]), _lists(q[at[part]])], names=["part", "vec_id", "v"])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple = (None, None)
        for batch in batches:
            for n, blob, m, queries in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if kept[0] != blob:
                    kept = (blob, MTree(*_matrix(blob, n)))
                tree = kept[1]
                numbers, q = _matrix(queries, m)
                dim = max(q.shape[1] - HEAD, tree.data.shape[1])
                if tree.data.shape[1] < dim:
                    tree = MTree(tree.ids, _widened(tree.data, dim))
                found = []
                for no, head, v in zip(numbers.tolist(), q[:, :HEAD].tolist(), _widened(q[:, HEAD:], dim), strict=True):
                    found += [(no, head[2], -h[1], h[0]) for h in tree.search(head[2], v, k, [], head[0])]
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(4)], names=["no", "query_id", "vec_id", "score"])

    return run


def _blobs(rows: DataFrame, size: int, salts: int = 1, parts: int | None = None) -> DataFrame:
    """Rows (part, vec_id, v) as blobs of `size` vectors; a part's rows are dealt to `salts` tasks."""
    keys = ["part", F.pmod(F.xxhash64("vec_id"), F.lit(salts))] if salts > 1 else ["part"]
    dealt = rows.repartition(parts, *keys) if parts else rows.repartition(*keys)
    return dealt.select("part", "vec_id", "v").mapInArrow(_blocks(size), BLOBS)


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    return rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("long").alias("part"), "vec_id", "v")


def _trees(rows: DataFrame, n: int, tree_rows: int) -> DataFrame:
    """tree, n, blob: rows by their nearest pivot; a cell of more than tree_rows rows becomes several trees."""
    wanted = max(1, min(PIVOTS, -(-n // tree_rows)))
    pivots = [r.v for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").select("v").limit(wanted).collect()]  # at most PIVOTS
    dim = max(map(len, pivots), default=1)
    near = _cells(np.array([v + [0] * (dim - len(v)) for v in pivots], "i8").reshape(-1, dim))
    cells = staged(rows.select("vec_id", "v").mapInArrow(near, "cell int, vec_id long, v array<bigint>"), "cells")
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / tree_rows).alias("splits"))  # a row for each pivot
    part = F.col("cell").cast("long") * F.lit(1 << 20) + F.pmod(F.xxhash64("vec_id"), F.col("splits"))
    dealt = cells.join(F.broadcast(sizes), "cell").select(part.cast("long").alias("part"), "vec_id", "v")
    made = _blobs(dealt, tree_rows, parts=max(1, -(-n // tree_rows)))
    return made.select((F.col("part") * F.lit(1 << 20) + F.col("nth")).alias("tree"), "n", "blob")


def _met(queries: DataFrame, roots: DataFrame, query_parts: int, root_parts: int, query_rows: int) -> DataFrame:
    """Blocks of queries with all blocks of roots (a stated query set against a row for each tree, in blocks)."""
    blocks = _blobs(_dealt(queries.withColumnRenamed("no", "vec_id"), query_parts), query_rows, parts=query_parts)
    spread = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(root_parts - 1).cast("long"))).alias("part"), F.col("n").alias("m"), F.col("blob").alias("queries"))
    return spread.join(roots.select("part", "n", "blob"), "part").select("m", "queries", "n", "blob")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, tree_rows: int = TREE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The k rows of vectors(vec_id, embedding) of highest integer inner product with each row that is_query selects:
    query_id, rank, vec_id, score."""
    small_batches(vectors.sparkSession)
    every = staged(quantized(vectors).dropDuplicates(), "vectors")
    # of equal vectors the k + 1 with the smallest ids are all that a query can find: their scores tie, and one may be its own
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    rows = staged(every.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth"), "candidates")
    asked = staged(every.where(is_query).select(F.monotonically_increasing_id().alias("no"), "vec_id", "v"), "asked")
    trees = staged(_trees(rows, rows.count(), tree_rows), "trees")
    query_parts, root_parts = (max(1, -(-n // size)) for n, size in ((asked.count(), query_rows), (trees.count(), ROOT_ROWS)))
    roots = staged(_blobs(_dealt(trees.mapInArrow(_summaries, "vec_id long, v array<bigint>"), root_parts), ROOT_ROWS), "roots")
    headed = lambda floor, first: F.concat(F.array(floor, first, F.col("vec_id")), "v").alias("v")

    def searched(pairs: DataFrame) -> DataFrame:
        blocks = _blobs(pairs, query_rows, query_parts).select(F.col("part").alias("tree"), F.col("n").alias("m"), F.col("blob").alias("queries"))
        return trees.join(blocks, "tree").select("n", "blob", "m", "queries").mapInArrow(_search(k), HITS)

    none = F.lit(LOWEST)
    best = _met(asked.select("no", headed(none, F.lit(-1).cast("long"))), roots, query_parts, root_parts, query_rows).mapInArrow(_nearest, "no long, tree long, bound double")
    first = staged(best.groupBy("no").agg(F.max_by("tree", F.struct("bound", "tree")).alias("tree")), "first")
    hits = staged(searched(asked.join(first, "no").select(F.col("tree").alias("part"), F.col("no").alias("vec_id"), headed(none, F.col("tree")))), "first_hits")
    floors = hits.groupBy("no").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    known = asked.join(first, "no").join(floors, "no", "left").select("no", headed(F.coalesce("floor", none), F.col("tree")))
    more = searched(_met(known, roots, query_parts, root_parts, query_rows).mapInArrow(_reaching, "part long, vec_id long, v array<bigint>"))
    found = hits.unionByName(more).select("query_id", "vec_id", "score").repartition("query_id").dropDuplicates()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


#: Brute force over all pairs of queries (vec_id divisible by 50) and other rows.
ORACLE = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, CAST(list_dot_product(q.v, e.v) AS BIGINT) AS score
  FROM e AS q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
