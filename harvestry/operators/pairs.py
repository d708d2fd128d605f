"""Pairs of rows within a key, spread over tasks by blocks where a key has many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.sources.staging import staged

#: Rows of a block: a task compares two blocks at once.
BLOCK = 2_000


def pairs_within(rows: DataFrame, keys: list[str], id_: str, near: Column | None = None, block: int = BLOCK) -> DataFrame:
    """Pairs of rows of one key, as structs a and b with all columns of rows, a's id below b's. The rows of a key with n rows
    go into n / block blocks by a hash of their id; each pair of blocks meets on its own, so a key that half of all rows
    have is spread over as many tasks as it has pairs of blocks. near, over a and b, is a cheap condition to keep a pair."""
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("__blocks"), F.count("*").alias("__n")).where("__n > 1")
    # a number per key, as Spark deals keys that are doubles again before a join
    counts = staged(counts.drop("__n").withColumn("__key", F.monotonically_increasing_id()), "keys")
    dealt = rows.select(F.struct(*rows.columns).alias("r"), *keys).join(counts, keys)
    own = F.pmod(F.xxhash64(F.col("r").getField(id_)), F.col("__blocks")).cast("int")
    dealt = dealt.withColumn("__own", own)
    low = dealt.select(F.col("r").alias("a"), "__key", F.col("__own").alias("__x"), F.explode(F.sequence("__own", F.col("__blocks") - 1)).alias("__y"))
    high = dealt.select(F.col("r").alias("b"), "__key", F.explode(F.sequence(F.lit(0), "__own")).alias("__x"), F.col("__own").alias("__y"))
    # as many tasks as Spark has for a shuffle: the rows are few and their pairs many, so tasks must not be put together by size
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, high = (side.repartition(tasks, "__key", "__x", "__y") for side in (low, high))
    a, b = F.col("a").getField(id_), F.col("b").getField(id_)
    met = low.join(high, ["__key", "__x", "__y"]).where(F.when(F.col("__x") == F.col("__y"), a < b).otherwise(a != b))
    met = met.select(F.when(a < b, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(a < b, F.col("b")).otherwise(F.col("a")).alias("b"))
    return met if near is None else met.where(near)
