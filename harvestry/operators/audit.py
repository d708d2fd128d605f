"""Audit checks with one schema of findings, alert dedup, coverage, integrity, dashboard figures."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestry.operators.pairs import BLOCK, pairs_within

FINDING = ["error_code", "severity", "message", "entity_type", "entity_id"]
# Fixed values.
SEVERITY = {"AUDIT-001": "HIGH", "AUDIT-002": "HIGH", "AUDIT-003": "CRITICAL", "AUDIT-004": "MEDIUM", "AUDIT-005": "MEDIUM", "AUDIT-006": "HIGH", "AUDIT-007": "HIGH"}


def finding(rows: DataFrame, code: str, message: Column, entity_type: str | None = None, entity_id: Column | None = None) -> DataFrame:
    return rows.select(
        F.lit(code).alias("error_code"),
        F.lit(SEVERITY[code]).alias("severity"),
        message.cast("string").alias("message"),
        F.lit(entity_type).cast("string").alias("entity_type"),
        (F.lit(None) if entity_id is None else entity_id).cast("string").alias("entity_id"),
    )


def without_facts(entities: DataFrame, facts: DataFrame, key: str, fact_key: str) -> DataFrame:
    """Entities that no fact refers to."""
    return entities.join(facts.select(F.col(fact_key).alias(key)), key, "left_anti")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def date_bounds(rows: DataFrame, date: str, keys: list[str] | None = None) -> DataFrame:
    return rows.groupBy(*(keys or [])).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.count_distinct(date).alias("distinct_dates"))


def date_gaps(rows: DataFrame, date: str, keys: list[str] | None = None) -> DataFrame:
    """Days between the first and the last date (of each key) that no row has. Gaps lie between neighbouring dates, so no
    list of all days is made."""
    keys = keys or []
    present = rows.select(*keys, F.col(date).cast("date").alias("day")).where("day is not null").distinct()
    after = F.lead("day").over(Window.partitionBy(*keys, *([] if keys else [F.lit(0)])).orderBy("day"))
    holes = present.withColumn("after", after).where(F.date_diff("after", "day") > 1)
    return holes.select(*keys, F.explode(F.sequence(F.date_add("day", 1), F.date_sub("after", 1))).alias("day"))


def date_coverage(rows: DataFrame, date: str, keys: list[str] | None = None) -> DataFrame:
    """expected_count, actual_count, coverage_pct of days (of each key)."""
    bounds = date_bounds(rows.select(*(keys or []), F.col(date).cast("date").alias("day")), "day", keys)
    expected = F.coalesce(F.date_diff("max_date", "min_date") + 1, F.lit(0)).cast("long")
    pct = F.when(expected > 0, F.round(F.col("distinct_dates") / expected * 100, 2)).otherwise(0.0)
    return bounds.select(*(keys or []), expected.alias("expected_count"), F.col("distinct_dates").alias("actual_count"), pct.alias("coverage_pct"))


def stale(rows: DataFrame, at: Column, now: Column, age: str) -> DataFrame:
    """Rows older than an interval, such as "3 days", before now, which is an argument."""
    return rows.where(at < now - F.expr(f"interval {age}"))


def coordinate_collisions(entities: DataFrame, score, least: float = 0.3, block: int = BLOCK, of: Callable[[Column], Column] | None = None) -> DataFrame:
    """id_a < id_b of entities(id, name, lat, lng) at the same place whose names score under `least`. A place that very many
    have is compared block by block. With of, a function of a name, score takes its values, which are made once a name
    instead of once a pair."""
    rows = entities.select("id", "name", "lat", "lng")
    if of is not None:
        rows = rows.withColumn("of", of(F.col("name")))
    met, what = pairs_within(rows, ["lat", "lng"], "id", block=block), "name" if of is None else "of"
    rows = met.select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"), "a.lat", "a.lng", score(F.col(f"a.{what}"), F.col(f"b.{what}")).alias("score"))
    return rows.where(F.col("score") < least)


def union(findings: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def new_alerts(findings: DataFrame, alerts: DataFrame) -> DataFrame:
    """Findings without an open alert of the same code and entity, or without entity the same code and message."""
    key = lambda d: d.select("error_code", F.coalesce(F.concat(F.lit("id:"), "entity_id"), F.concat(F.lit("message:"), "message")).alias("what"), *[c for c in d.columns if c != "error_code"])
    opened = key(alerts.where("status = 'OPEN'")).select("error_code", "what")
    return key(findings).join(opened, ["error_code", "what"], "left_anti").select(FINDING)


def run_audit(markets: DataFrame, crops: DataFrame, prices: DataFrame, issues: DataFrame, pages: DataFrame, alerts: DataFrame, now: Column, score) -> tuple[DataFrame, DataFrame]:
    """(findings that need a new alert, coverage report) of the seven checks."""
    from harvestry.schema import PRICE_KEY

    alive = F.col("status") == "ACTIVE"
    backlog = lambda rows, age, code, text: finding(stale(rows.where("status = 'PENDING'"), F.col("created_at"), now, age).agg(F.count("*").alias("n")).where("n > 0"), code, F.format_string(text, "n"))
    found = union(
        [
            finding(without_facts(markets.where(alive), prices, "id", "mandi_id"), "AUDIT-001", F.concat(F.lit("no prices for market "), "name"), "mandi", F.col("id")),
            finding(without_facts(crops.where(alive), prices, "id", "crop_id"), "AUDIT-002", F.concat(F.lit("no prices for crop "), "name"), "crop", F.col("id")),
            finding(duplicate_keys(prices, PRICE_KEY), "AUDIT-003", F.format_string("%d rows for one key", "row_count"), "price", F.concat_ws("|", *PRICE_KEY)),
            backlog(issues, "3 days", "AUDIT-004", "%d quality issues pending for over 3 days"),
            backlog(pages, "24 hours", "AUDIT-005", "%d failed pages pending for over 24 hours"),
            finding(date_gaps(prices, "price_date"), "AUDIT-006", F.concat(F.lit("no prices on "), F.col("day").cast("string")), "date", F.col("day")),
            finding(
                coordinate_collisions(markets.where(alive).select("id", "name", F.col("latitude").alias("lat"), F.col("longitude").alias("lng")), score),
                "AUDIT-007", F.concat_ws(" / ", "name_a", "name_b"), "mandi", F.concat_ws("-", "id_a", "id_b"),
            ),
        ]
    )
    return new_alerts(found, alerts), date_coverage(prices, "price_date")


def merge_integrity(prices: DataFrame, markets: DataFrame, crops: DataFrame) -> DataFrame:
    """issue, entity_id, rows: facts that refer to merged entities."""
    parts = []
    for name, dim, key in (("mandi", markets, "mandi_id"), ("crop", crops, "crop_id")):
        merged = dim.where("status = 'MERGED'").select(F.col("id").alias(key))
        hit = prices.join(merged, key).groupBy(F.col(key).alias("entity_id")).agg(F.count("*").alias("rows"))
        parts.append(hit.select(F.lit(f"price_on_merged_{name}").alias("issue"), "entity_id", "rows"))
    return union(parts)


def kpis(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row of figures from one pass."""
    return rows.agg(*(c.alias(name) for name, c in measures.items()))


def render(dashboard: DataFrame) -> str:
    """A one-row frame of figures as aligned text."""
    row = dashboard.head().asDict()
    width = max(map(len, row))
    return "\n".join(f"{k.replace('_', ' '):<{width}}  {'-' if v is None else v}" for k, v in row.items())


def dashboard(tables: dict[str, DataFrame], now: Column) -> DataFrame:
    """The figures of a store's tables as one row: the last tick and rewrite, rows of today and of all raw entries, depth of
    the retry queue, pending reviews, open alerts, coverage, success and failure of seven days, and the share of created
    entities. Each table is read once."""
    recent = F.col("started_at") > now - F.expr("interval 7 days")
    last = lambda job: F.max_by(F.struct("started_at", "status"), F.when(F.col("job_name") == job, F.col("started_at")))
    share = lambda ok: F.round(100.0 * F.count_if(recent & ok) / F.nullif(F.count_if(recent), F.lit(0)), 2)
    parts = [
        kpis(tables["batches"], {
            "last_tick": last("live_tick"), "last_rewrite": last("daily_rewrite"), "rows_today": F.coalesce(F.sum(F.when(F.to_date("started_at") == F.to_date(now), F.col("rows_processed"))), F.lit(0)),
            "success_pct_7d": share(F.col("status") == "SUCCESS"), "failure_pct_7d": share(F.col("status") == "FAILED"), "batch_minutes_7d": F.round(F.avg(F.when(recent, (F.unix_timestamp("completed_at") - F.unix_timestamp("started_at")) / 60)), 2),
        }),
        kpis(tables["raw_entries"], {"raw_records": F.count("*")}),
        kpis(tables["failed_pages"], {"retry_queue": F.count_if(F.col("status") == "PENDING")}),
        kpis(tables["issues"], {"pending_reviews": F.count_if(F.col("review_status") == "PENDING")}),
        kpis(tables["alerts"], {"open_alerts": F.count_if(F.col("status") == "OPEN")}),
        kpis(tables["coverage"], {"coverage_pct": F.round(100.0 * F.sum("captured") / F.nullif(F.sum("reported"), F.lit(0)), 2)}),
        kpis(tables["markets"], {"markets": F.count("*"), "created_pct": F.round(100.0 * F.count_if(F.col("ingested_from").isNotNull()) / F.nullif(F.count("*"), F.lit(0)), 2)} if "ingested_from" in tables["markets"].columns else {"markets": F.count("*")}),
    ]
    return reduce(lambda a, b: a.join(b, F.lit(True)), parts)  # rows of figures, one each
