"""Helpers that several operators share: reading tables, staging intermediate results, tokenizer files."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that goes to a Python worker. Texts may be long; the default of 10,000 rows may not fit.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the Arrow batch size unless the user has set one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in a local session without it a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="harvestry-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/harvestry/{label}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back. The lineage ends there, lost executors cost no recomputation,
    and the planner knows the table's true size when it chooses between a broadcast and a shuffled join."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def is_empty(df: DataFrame) -> bool:
    return not df.head(1)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file; HARVESTRY_TOKENIZERS overrides the folder."""
    folder = os.environ.get("HARVESTRY_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


class WordMemo:
    """Values of a pure function of single words, kept for later texts. Frequent words come early, so the memo keeps
    the first `limit` words it meets and forgets later ones after the batch that held them."""

    def __init__(self, compute: Callable[[list[str]], Iterable], limit: int = 400_000):
        self.compute, self.limit, self.known, self.surplus = compute, limit, {}, []

    def ready(self, texts: list[list[str]]) -> dict:
        """The memo, with all words of these texts in it until the next call."""
        for w in self.surplus:
            del self.known[w]
        new = list(set().union(*texts).difference(self.known))
        self.known.update(zip(new, self.compute(new), strict=True))
        self.surplus = new if len(self.known) > self.limit else []
        return self.known
