import random

import pytest

from pyspark.sql import functions as F

from harvestry.operators import components as comp
from harvestry.operators import resolve


def brute_roots(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def brute_leaders(pairs):
    own = {}
    for i, e, s in pairs:
        own.setdefault(i, []).append((-s, e))
    out = {}
    for i in sorted(own):
        found = [w for w in own[i] if w[1] not in out]
        if found:
            out[i] = min(found)[1]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_components_and_leaders(spark, seed):
    rng = random.Random(seed)
    pairs = sorted({tuple(sorted(rng.sample(range(120), 2), reverse=True)) for _ in range(rng.choice((40, 90, 200)))})
    pairs += [(1000 + i, 999 + i) for i in range(1, 70)]
    pairs = [(i, e, rng.choice((0.6, 0.7, 0.8))) for i, e in pairs]
    frame = spark.createDataFrame(pairs, "id long, earlier long, similarity double")
    got = comp.components(frame.selectExpr("id as a", "earlier as b"))
    assert {r.id: r.root for r in got.collect()} == brute_roots([(i, e) for i, e, _ in pairs])
    want = brute_leaders(pairs)
    for most in (None, 0, 60):
        assert {r.id: r.leader for r in resolve.leaders_of(frame, most).collect()} == want


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    writes = []
    staged = comp.staged
    monkeypatch.setattr(comp, "staged", lambda df, label: writes.append(label) or staged(df, label))
    counts = []
    for n in (8, 64):
        writes.clear()
        chain = spark.createDataFrame([(i, i - 1) for i in range(1, n)], "a long, b long")
        assert {r.root for r in comp.components(chain).collect()} == {0}
        counts.append(len(writes))
    assert counts[1] - counts[0] <= 4  # three more jumps for a chain eight times as long


def test_empty(spark):
    none = spark.createDataFrame([], "id long, earlier long, similarity double")
    assert resolve.leaders_of(none).collect() == [] and comp.components(none.selectExpr("id as a", "earlier as b")).collect() == []


def test_first_rows_need_no_sort_of_a_frequent_key(spark):
    """ten crops' rows were sorted in ten tasks; rows of one place in the order still give one first row."""
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", 3), (None, "c", 3), (None, "d", 1), (2, "e", 7), (2, "f", 7)], "k long, name string, seq long")
    out = resolve.first_seen_each(rows, {"first": ["k"], "new": ["name"]}, "seq")
    got = {r.name: (r.first, r.new) for r in out.collect()}
    assert [n for n in "abcd" if got[n][0]] == ["b", "d"] and got["e"][0] != got["f"][0] and all(new for _, new in got.values())
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_records_are_dealt_over_all_tasks(spark):
    """one task parsed all records of a small file."""
    from harvestry.sources.staging import spread

    one = spark.range(1000).coalesce(1)
    sizes = [r[1] for r in spread(one).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 2 * min(sizes)
