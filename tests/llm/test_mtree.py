import numpy as np
from pyspark.sql import functions as F

from harvestry.llm import mtree
from harvestry.llm.common import table
from tests.conftest import SF


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    dim = max(len(v) for _, v in rows)
    q = np.array([np.pad(np.floor(256 * np.array(v, "f8")).astype("i8"), (0, dim - len(v))) for _, v in rows])
    out = set()
    for i, v in zip(ids, q):
        if i in queries:
            s = sorted((-int(x), int(j)) for x, j in zip(q @ v, ids) if j != i)[:k]
            out |= {(int(i), n + 1, j, -x) for n, (x, j) in enumerate(s)}
    return out


def test_whole_table(spark):
    vectors = table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    for size in (8192, 97):
        got = {tuple(r) for r in mtree.top_k(vectors, F.col("vec_id") % 50 == 0, 5, tree_rows=size).collect()}
        assert got == brute(rows, {i for i, _ in rows if i % 50 == 0}, 5)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [3.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0])]
    vectors = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = {tuple(r) for r in mtree.top_k(vectors, F.col("vec_id") == 0, 5).collect()}
    good = [(0, [1.0, 2.0]), (5, [1.0, 2.0]), (6, [3.0]), (7, [1.0, 2.0])]
    assert got == brute(good, {0}, 5) and len(got) == 3
    assert mtree.top_k(vectors.limit(0), F.col("vec_id") == 0, 5).collect() == []


def test_pruning_and_equal_vectors():
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (20, 8))
    data = (centres[rng.integers(0, 20, 3000)] + rng.integers(-3, 4, (3000, 8))).astype("i8")
    data[:500] = data[0]
    tree = mtree.MTree(np.arange(3000), data)
    looked = []
    tree._exact = lambda rows, q, real, f=tree._exact: looked.append(len(rows)) or f(rows, q, real)
    for i in range(600, 620):
        got = sorted(tree.search(i, data[i], 5, []), reverse=True)
        s = data @ data[i]
        assert got == sorted(((int(x), -j) for j, x in enumerate(s) if j != i), reverse=True)[:5]
    assert sum(looked) < 0.5 * 20 * 3000


def test_copies_and_blocks(spark, monkeypatch):
    """A third of all rows are one vector; small trees, blocks of roots and of queries; clusters, and vectors of two lengths."""
    monkeypatch.setattr(mtree, "ROOT_ROWS", 3)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 3, (6, 5))
    rows = [(i, [1.5, -2.0, 0.25, 3.0, 1.0] if i % 3 == 0 else (centres[i % 6] + rng.normal(0, 0.1, 5)).tolist()[: 5 - i % 2]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in mtree.top_k(vectors, F.col("vec_id") % 10 == 0, 5, tree_rows=40, query_rows=7).collect()}
    assert got == brute(rows, {i for i, _ in rows if i % 10 == 0}, 5)


def test_bounds_leave_far_trees_out():
    rng = np.random.default_rng(3)
    near, far = rng.integers(90, 110, (50, 4)), rng.integers(-110, -90, (50, 4))
    roots = []
    for data in (near, far):
        centre = np.rint(data.mean(0)).astype("i8")
        roots.append([int(np.ceil(np.linalg.norm(data - centre, axis=1).max() + 1)), *centre])
    query = np.array([[30000, 0, 1, 100, 100, 100, 100]], "i8")
    bound = mtree._bounds(query, np.array(roots, "i8"))[0]
    assert bound[0] >= (near @ query[0, 3:]).max() >= 30000 > bound[1] >= (far @ query[0, 3:]).max()
