"""Tables as Parquet: reading, keyed upserts of the parts of a table, CSV and text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions.text import strip
from harvestry.operators.upsert import upsert
from harvestry.sources.versions import Versions

CONFIG_ROWS = 10_000


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def upsert_partitions(store: Versions, table: str, incoming: DataFrame, keys: list[str], order: list[str], partition: str) -> None:
    """Upsert rows into a table of a store that is kept by the values of a column: only the parts that incoming rows touch
    are read and written again, in one version. The touched parts are few, such as the days of a batch."""
    touched = [r[0] for r in incoming.select(F.col(partition).cast("string")).distinct().collect()]  # a row for each part
    if not touched:
        return
    stored = store.read(table, ["null" if t is None else t for t in touched]).select(incoming.columns) if store.has(table) else incoming.limit(0)
    store.commit(parts={table: (upsert(stored, incoming, keys, order), partition)})


def append(path: str, rows: DataFrame) -> None:
    rows.write.mode("append").parquet(path)


def replace(path: str, rows: DataFrame) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_csv(path: str, rows: DataFrame) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def current(events: DataFrame, key: str, seq: str) -> DataFrame:
    """The latest event of each key of an append-only table."""
    from harvestry.operators.latest import latest

    return latest(events, [key], [seq])


def parse_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejected) of raw feed records with a column `record map<string,string>` of either casing. Commodity,
    market, state and date are required; prices that aren't numbers are null; a date that is none rejects the record."""
    from harvestry.functions.prices import day_first_date, tolerant_double

    lower = F.transform_keys("record", lambda k, v: F.lower(k))
    field = lambda name: strip(F.try_element_at(F.col("__r"), F.lit(name)))
    rows = raw.withColumn("__r", lower)
    names = {"market": "market", "state": "state", "district": "district", "commodity": "commodity", "raw_variety": "variety", "raw_grade": "grade", "__date": "arrival_date"}
    rows = rows.withColumns({out: F.nullif(field(name), F.lit("")) for out, name in names.items()})
    rows = rows.withColumns({f"{p}_price": tolerant_double(field(f"{p}_price")) for p in ("modal", "min", "max")} | {"price_date": day_first_date(F.col("__date"))})
    good = F.col("commodity").isNotNull() & F.col("market").isNotNull() & F.col("state").isNotNull() & F.col("price_date").isNotNull()
    return rows.where(good).drop("__r", "__date", "record"), rows.where(~good).select(raw.columns)


def record_date() -> Column:
    """The date of a raw record of either casing; null if it has none that can be read."""
    from harvestry.functions.prices import day_first_date

    lower = F.transform_keys("record", lambda k, v: F.lower(k))
    return day_first_date(F.nullif(strip(F.try_element_at(lower, F.lit("arrival_date"))), F.lit("")))


def typed_config(rows: DataFrame, spec: dict[str, tuple[type, float, float]], at_least: list[tuple[str, str]] = []) -> dict:  # noqa: B006
    """Typed values of a small key/value table; an error that names all missing and wrong entries, or if it isn't small.
    at_least has pairs of keys of which the first one's value must not be below the second one's."""
    got = rows.select("key", "value").take(CONFIG_ROWS + 1)
    if len(got) > CONFIG_ROWS:
        raise ValueError(f"more than {CONFIG_ROWS} configuration rows")
    found = {r["key"]: r["value"] for r in got}
    out, wrong = {}, []
    for key, (kind, low, high) in spec.items():
        try:
            out[key] = kind(found[key])
            if not low <= out[key] <= high:
                wrong.append(f"{key}: {out[key]} is not between {low} and {high}")
        except KeyError:
            wrong.append(f"{key}: missing")
        except ValueError:
            wrong.append(f"{key}: {found[key]!r} is no {kind.__name__}")
    wrong += [f"{a}: {out[a]} is below {b}, {out[b]}" for a, b in at_least if a in out and b in out and out[a] < out[b]]
    if wrong:
        raise ValueError("; ".join(wrong))
    return out


