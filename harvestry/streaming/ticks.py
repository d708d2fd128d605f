"""Streams: the feed's ticks, content dedup with first and last sight, daily windows with late data, keyed upserts.

Each function starts a query that takes what is there and stops (availableNow), with its checkpoint and its sink in a
folder, and returns what the sink holds. Run again with the same folder it takes only what is new.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from harvestry.operators.latest import latest
from harvestry.plans import runs
from harvestry.sources.staging import shared_folder, staged
from harvestry.sources.tables import exists
from harvestry.sources.versions import Versions


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/harvestry-stream/{label}-{uuid.uuid4().hex}"


def _source(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder as a stream."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name if name.endswith(".parquet") else "*").parquet(folder)


def source_of(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream; at most so many files in a micro-batch."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getFileStatus(where).isDirectory():
        reader = spark.readStream.schema(spark.read.parquet(path).schema)
        return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)
    return _source(spark, path)


def _stored(spark: SparkSession, out: str, schema, before: int) -> DataFrame:
    """What earlier micro-batches wrote: a folder each, which a repeated batch writes again."""
    if not exists(spark, out):
        return spark.createDataFrame([], schema)
    rows = spark.read.option("basePath", out).schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(out)
    return rows.where(F.col("batch") < before)


def _each(stream: DataFrame, folder: str, work, mode: str = "append") -> None:
    writer = stream.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", f"{folder}/state")
    writer.trigger(availableNow=True).start().awaitTermination()


def tick(feed: DataFrame, store: Versions, checkpoint: str, now: Callable[[], datetime.datetime], source: str = "resource_1") -> list[runs.Run | None]:
    """Take what is new in a feed (stream_feed) into a store of prices, a batch per micro-batch. The micro-batch's number is
    committed with its rows, so one that is run again changes nothing."""
    done: list[runs.Run | None] = []
    writer = feed.writeStream.foreachBatch(lambda batch, no: done.append(runs.tick(store, batch, no, now(), source))).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return done


#: Buckets of keys that a sink of dedup() has: a micro-batch reads and writes those of its keys.
BUCKETS = 64


def dedup(stream: DataFrame, folder: str, keys: list[str], ts: str, buckets: int = BUCKETS, expire: str | None = None) -> DataFrame:
    """keys, first_seen, last_seen, times of a stream's rows. Each micro-batch is aggregated first and meets only the buckets
    of its own keys; it is committed with its number, so a repeated one changes nothing. With expire, such as
    "30 days", keys that weren't seen for so long before the newest row of a micro-batch go when their bucket is written,
    and start anew later."""
    store = Versions(stream.sparkSession, folder)

    def add(batch: DataFrame, no: int) -> None:
        if no <= store.mark("batch", -1):
            return
        seen = batch.groupBy(*keys).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("times"))
        fresh = staged(seen.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "seen")
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        rows = fresh.unionByName(store.read("seen", touched)) if store.has("seen") else fresh
        rows = rows.groupBy(*keys, "bucket").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("times").alias("times"))
        if expire:
            newest = fresh.agg(F.max("last_seen")).head()[0]
            rows = rows.where(F.col("last_seen") >= F.lit(newest) - F.expr(f"interval {expire}"))
        store.commit(parts={"seen": (rows, "bucket")}, marks={"batch": no})
        store.vacuum(keep=2)

    _each(stream, folder, add)
    return store.read("seen").drop("bucket") if store.has("seen") else stream.sparkSession.createDataFrame([], stream.select(*keys, F.col(ts).alias("first_seen"), F.col(ts).alias("last_seen"), F.lit(0).cast("long").alias("times")).schema)


def daily(stream: DataFrame, folder: str, ts: str, keys: list[str], value: str, late: str = "3 days") -> DataFrame:
    """Counts, minima and maxima by day. Rows up to `late` behind the newest one still count in later triggers, which
    write the days that changed again; state of older days goes. The newest writing of a day counts."""
    spark = stream.sparkSession
    stream = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    days = stream.groupBy(F.window(ts, "1 day").alias("w"), *keys).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    rows = days.select(F.to_date("w.start").alias("day"), *keys, "n", "low", "high")
    out = f"{folder}/out"
    _each(rows, folder, lambda batch, no: batch.write.mode("overwrite").parquet(f"{out}/batch={no}"), "update")
    return latest(_stored(spark, out, rows.schema, 2**62), ["day", *keys], ["batch"]).drop("batch")


def precedence_stream(stream: DataFrame, path: str, keys: list[str], rank) -> DataFrame:
    """Per key the row of the highest source rank over all micro-batches, the later one of equal ranks. Each batch writes
    its own winners into a folder of its own, so a crash leaves no half table; reading takes the winners of all."""
    spark, schema, out = stream.sparkSession, stream.schema, f"{path}/rows"
    ranked = lambda rows: rows.withColumn("__rank", rank(F.col("source")))

    def add(batch: DataFrame, no: int) -> None:
        numbered = ranked(batch).withColumn("__place", F.monotonically_increasing_id())
        latest(numbered, keys, ["__rank", "__place"]).select(batch.columns).write.mode("overwrite").parquet(f"{out}/batch={no}")

    _each(stream, path, add)
    return latest(ranked(_stored(spark, out, schema, 2**62)), keys, ["__rank", "batch"]).drop("__rank", "batch")
