"""Keyed reduction of rows: last-wins upserts, content dedup, precedence of sources, quarantine.

In all of them a null text key is the empty text, and is written so."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.prices import content_hash, source_rank
from harvestry.operators.latest import latest
from harvestry.schema import PRICE_KEY, RAW_KEY


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Null text keys as empty text, so that they group and join like equal values."""
    kinds = dict(df.dtypes)
    return df.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in keys if kinds[k] == "string"})


def matches(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of keys."""
    return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return latest(keyed(rows, keys), keys, order)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """existing with incoming rows in place of those of equal key; of incoming rows with one key the last in order stays.
    Applying it twice changes nothing."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    return latest(keyed(both, keys), keys, ["__new", *order]).drop("__new")


def content_dedup(entries: DataFrame, keys: list[str] = RAW_KEY, batch: str = "batch_id", seq: str = "seq", payload: list[str] | None = None) -> DataFrame:
    """One row per raw identity and content hash: first and last batch that saw it, and the payload as first seen."""
    rows = keyed(entries, keys)
    if "content_hash" not in rows.columns:
        rows = rows.withColumn("content_hash", content_hash(F.col("modal_price"), F.col("min_price"), F.col("max_price")))
    rest = payload if payload is not None else ["modal_price", "min_price", "max_price"]
    return rows.groupBy(*keys, "content_hash").agg(
        *(F.min_by(c, seq).alias(c) for c in rest),
        F.min_by(batch, seq).alias("first_seen_batch_id"),
        F.max_by(batch, seq).alias("last_seen_batch_id"),
        F.count("*").alias("times_seen"),
    )


def merge_raw(stored: DataFrame, fresh: DataFrame, keys: list[str] = RAW_KEY) -> tuple[DataFrame, DataFrame]:
    """(table after the batch, rows of the batch with is_new): known content only moves its last batch."""
    on = [*keys, "content_hash"]
    seen = keyed(stored, keys).select(*on).withColumn("__known", F.lit(True))
    flagged = fresh.join(seen, on, "left").withColumn("is_new", F.col("__known").isNull()).drop("__known")
    both = keyed(stored, keys).withColumn("__new", F.lit(0)).unionByName(fresh.select(stored.columns).withColumn("__new", F.lit(1)))
    rest = [c for c in stored.columns if c not in on and c != "last_seen_batch_id"]
    after = both.groupBy(*on).agg(*(F.min_by(c, "__new").alias(c) for c in rest), F.max_by("last_seen_batch_id", "__new").alias("last_seen_batch_id"))
    return after.select(stored.columns), flagged


def respect_precedence(incoming: DataFrame, existing: DataFrame, keys: list[str] = PRICE_KEY, rank=source_rank) -> DataFrame:
    """incoming without rows whose key is stored from a source of strictly higher rank."""
    ranks = keyed(existing, keys).groupBy(*keys).agg(F.max(rank(F.col("source"))).alias("__rank"))
    rows = keyed(incoming, keys)
    joined = rows.join(ranks, matches(rows, ranks, keys), "left")
    return joined.where(F.coalesce(F.col("__rank"), F.lit(0)) <= rank(rows["source"])).select(*(rows[c] for c in incoming.columns))


def quarantine(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, others with error_code): a row fails at the first check that isn't true, nulls included."""
    code = F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()))
    coded = rows.withColumn("error_code", code)
    return coded.where("error_code is null").drop("error_code"), coded.where("error_code is not null")


def price_checks() -> dict[str, Column]:
    return {
        "23502": F.col("mandi_id").isNotNull() & F.col("crop_id").isNotNull() & F.col("price_date").isNotNull(),
        "23514": F.coalesce(F.col("min_price") <= F.col("max_price"), F.lit(True)),
    }
