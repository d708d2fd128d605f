"""Intermediate results as written tables, and numbers for sorted rows without one task that sorts all."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Spark's option to delete the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows for one task that sorts or hashes them.
TASK_ROWS = 500_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; a temporary one in a local session without it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="harvestry-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: its plan ends there, so plans built on it stay small, and lost
    executors cost no recomputation. Its shuffle files go as soon as it is written, not when the driver happens to collect
    garbage; the written files go when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/harvestry/{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over as many tasks as the session has cores, however few files or bytes it comes from."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df, of some number of rows, dealt by keys over so many tasks that each has about TASK_ROWS, however few partitions
    a shuffle of the session has or is coalesced to: what a task holds doesn't grow with the table."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """staged, and the number of rows, counted as they are written."""
    seen = Observation()
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return out, seen.get["n"]


def numbered(rows: DataFrame, order: list[str], out: str, first: int = 1) -> DataFrame:
    """rows with consecutive numbers in an order, from `first` on: rows are dealt by ranges, numbered within each, and
    shifted by the rows of the ranges before (one row for each range, which Spark broadcasts). Helper columns have a
    fresh name at each call, so rows may have any columns and be numbered again."""
    fresh = uuid.uuid4().hex
    part, other, n, shift = (f"{name}_{fresh}" for name in ("part", "other", "n", "shift"))
    dealt = staged(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "numbered")
    counts = dealt.groupBy(F.col(part).alias(other)).agg(F.count("*").alias(n))
    before = Window.orderBy(other).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(other, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(shift))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    # at most spark.sql.shuffle.partitions rows
    both = dealt.withColumn(out, place.cast("long")).join(F.broadcast(shifts), F.col(part) == F.col(other))
    return both.withColumn(out, F.lit(first).cast("long") + F.col(shift) + F.col(out)).drop(part, other, shift)
