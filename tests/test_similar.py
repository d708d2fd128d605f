import random
import time

import pytest
from pyspark.sql import functions as F

from harvestry.functions.trigram import similarity
from harvestry.operators import similar
from harvestry.sources.staging import staged
from harvestry.sources.versions import Versions


def all_pairs(frame, threshold, blocks):
    a, b = frame.toDF("id_a", "a", "block"), frame.toDF("id_b", "b", "other")
    met = a.join(b, F.col("id_a") < F.col("id_b")).where(F.col("block") == F.col("other") if blocks else F.lit(True))
    return {(r.id_a, r.id_b): round(r.s, 9) for r in met.withColumn("s", similarity(F.col("a"), F.col("b"))).where(F.col("s") > threshold).collect()}


@pytest.mark.parametrize("seed,blocks,hot", [(0, [], 10**9), (1, ["block"], 10**9), (2, [], 3), (3, ["block"], 0)])
def test_increments_equal_the_full_sweep(spark, tmp_path, seed, blocks, hot):
    rng = random.Random(seed)
    parts = ["red", "reds", "blue", "bluish", "gram", "gramm", "grain", "64", "zebra"]
    names = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(0, 4))), rng.choice("xy")) for i in rng.sample(range(1000), 70)]
    frame = spark.createDataFrame(names, "id long, name string, block string")
    want = all_pairs(frame, 0.4, blocks)
    index, got = similar.SweepIndex(Versions(spark, str(tmp_path)), 0.4, blocks, hot), {}
    for k in range(0, 70, 25):
        more = spark.createDataFrame(names[max(0, k - 5) : k + 25], frame.schema)  # five of them are known already
        found = {(r.id_a, r.id_b): round(r.similarity, 9) for r in index.add(more).collect()}
        assert not found.keys() & got.keys()
        got |= found
    assert got == want and want
    full = similar.similar_pairs(frame, frame, 0.4, blocks, once=True, hot=hot)
    assert {(r.l_id, r.r_id): round(r.similarity, 9) for r in full.collect()} == want


def test_names_of_few_frequent_trigrams_meet_rarely(spark):
    """hashes as names have few trigrams, all of them frequent; most pairs must not meet at all."""
    names = spark.range(20_000).select("id", F.concat(F.md5(F.col("id").cast("string")), F.when(F.col("id") % 200 == 0, "s").otherwise("")).alias("name"))
    frame = names.unionByName(names.where("id % 200 = 1").select((F.col("id") + 50_000).alias("id"), F.concat("name", F.lit("s")).alias("name")))
    sets, least = similar._sets(frame, [])
    ranks = sets.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    keys = similar._keys(sets, ranks.where("n > 0"), 0.6, [], least, None)
    met = keys.groupBy("key").count().select(F.sum(F.col("count") * (F.col("count") - 1) / 2)).head()[0]
    assert met < 20_000 * 100  # some 1000 a name under single trigrams
    found = similar.similar_pairs(frame, frame, 0.6, once=True).collect()
    assert {(r.l_id, r.r_id) for r in found} == {(i, i + 50_000) for i in range(1, 20_000, 200)}


def shuffled(spark):
    seen = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(seen.apply(i).totalShuffleWrite() for i in range(seen.size()))


def test_names_are_shuffled_under_first_trigrams_only(spark):
    """hashes went over the network under some 65 pairs of trigrams each, and again for each salt of a frequent one."""
    names = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("name"))
    before = shuffled(spark)
    assert not similar.similar_pairs(names, names, 0.6, once=True).collect()
    assert shuffled(spark) - before < 20_000 * 800  # bytes, of which there were 1241 a name and are 437


@pytest.mark.parametrize("once,threshold,blocks,hot,rare", [(True, 0.3, [], 20, 2), (False, 0.3, ["block"], 20, 2), (False, 0.6, [], 5, 0), (True, 0.2, ["block"], 1000, 64)])
def test_first_and_second_trigrams_lose_no_pair(spark, monkeypatch, once, threshold, blocks, hot, rare):
    monkeypatch.setattr(similar, "RARE", rare)
    monkeypatch.setattr(similar, "CHUNK", 50)
    rng = random.Random(hot)
    rows = [(i, " ".join("".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(1, 3))), rng.choice("xy")) for i in range(300)]
    left = spark.createDataFrame(rows, "id long, name string, block string")
    right = left if once else spark.createDataFrame([(i, n[1:], b) for i, n, b in rows], left.schema)
    a, b = left.toDF("a", "x", "p"), right.toDF("b", "y", "q")
    met = a.join(b, F.col("p") == F.col("q") if blocks else F.lit(True)).where(F.col("a") < F.col("b") if once else F.lit(True))
    want = {(r.a, r.b): round(r.s, 9) for r in met.withColumn("s", similarity(F.col("x"), F.col("y"))).where(F.col("s") > threshold).collect()}
    got = similar.similar_pairs(left, right, threshold, blocks, once=once, hot=hot).collect()
    assert {(r.l_id, r.r_id): round(r.similarity, 9) for r in got} == want and len(got) == len(want) > 50


def test_staged_tables_leave_no_shuffle_files(spark):
    """shuffle files of steps that were written long before stayed until the driver collected garbage."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    known = lambda: {f for f in (files.getAllFiles().apply(i).getName() for i in range(files.getAllFiles().size())) if f.startswith("shuffle_")}
    before = known()
    staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):
        if not known() - before:
            break
        time.sleep(0.2)
    assert not known() - before
