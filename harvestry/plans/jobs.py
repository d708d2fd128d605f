"""Jobs of the price pipeline: one lazy plan from raw records to prices, quarantine and counters."""

from __future__ import annotations

import dataclasses
import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions import prices as p
from harvestry.functions.text import normalize_kind
from harvestry.operators import batches, latest, resolve, upsert
from harvestry.plans import sql
from harvestry.schema import NORMALIZATION_VERSION, PARSER_VERSION, PRICE_KEY, assert_schema
from harvestry.sources.staging import counted, staged
from harvestry.sources.tables import parse_records, typed_config


@dataclasses.dataclass(frozen=True)
class Dimensions:
    markets: DataFrame
    crops: DataFrame
    market_aliases: DataFrame
    crop_aliases: DataFrame
    district_aliases: DataFrame
    varieties: DataFrame | None = None
    grades: DataFrame | None = None
    variety_aliases: DataFrame | None = None


@dataclasses.dataclass(frozen=True)
class Ingested:
    """entries: raw content of the batch; prices: rows to upsert; quarantine: rows that break a check; rejected: raw
    records that could not be parsed; created: records that led to new entities; methods: rows by way of resolution. What
    else changes: markets and crops with new ones and the time they were seen, varieties and grades with new ones (if there
    are such tables), and new aliases that wait for approval."""

    entries: DataFrame
    prices: DataFrame
    quarantine: DataFrame
    rejected: DataFrame
    created: DataFrame
    methods: DataFrame
    markets: DataFrame
    crops: DataFrame
    varieties: DataFrame | None
    grades: DataFrame | None
    market_aliases: DataFrame
    crop_aliases: DataFrame


def ingest(raw: DataFrame, dims: Dimensions, existing: DataFrame, source: str, batch_id: str, seq: str = "seq", now: Column | None = None, split: tuple[DataFrame, DataFrame] | None = None) -> Ingested:
    """raw has `record map<string,string>` and an order column. existing are stored prices, for precedence. With tables of
    varieties and grades, prices get their ids as well. Parsed and resolved records are written once; all outputs read
    them. split is what parse_records gave for raw, if the caller has it."""
    now = F.current_timestamp() if now is None else now
    parsed, rejected = split or parse_records(raw)
    parsed = parsed.withColumn("resource", F.lit(source)).withColumn("batch_id", F.lit(batch_id))
    named = parsed.withColumns({"variety": normalize_kind("raw_variety"), "grade": normalize_kind("raw_grade"), "source_mandi_name": F.col("market"), "raw_district": F.col("district")})
    markets = resolve.markets_of(named, dims.markets, dims.market_aliases, dims.district_aliases, source=source)
    crops = resolve.crops_of(markets.rows, dims.crops, dims.crop_aliases, source=source)
    found, varieties, grades = crops.rows, None, None
    if dims.varieties is not None and dims.grades is not None:
        kinds = resolve.kinds_of(found, dims.varieties, "crop_id", "variety", "variety_id", dims.variety_aliases)
        below = resolve.kinds_of(kinds.rows, dims.grades, "variety_id", "grade", "grade_id")
        found, varieties, grades = below.rows, resolve.with_fresh(dims.varieties, kinds.fresh), resolve.with_fresh(dims.grades, below.fresh)
    found = staged(resolve.first_seen_each(found, {"first_market": ["mandi_id"], "first_crop": ["crop_id"]}, seq), "ingested")
    entries = upsert.content_dedup(found.withColumn("district", F.col("raw_district")), seq=seq)
    new_market = F.col("first_market") & (F.col("mandi_method") == "CREATED")
    new_crop = F.col("first_crop") & (F.col("crop_method") == "CREATED")
    crop = F.col("crop_id")
    rows = found.withColumns({f"{k}_price": p.per_kilo(F.col(f"{k}_price"), crop) for k in ("modal", "min", "max")} | {"unit": p.unit_of(crop), "source": F.lit(source)})
    quality = p.quality(F.col("source"), F.col("modal_price"), F.col("min_price"), F.col("max_price"), F.col("variety"), new_market, new_crop)
    rows = rows.withColumns({"quality": quality, "source_mandi_id": F.lit(None).cast("long"), "parser_version": F.lit(PARSER_VERSION), "normalization_version": F.lit(NORMALIZATION_VERSION)})
    rows = rows.withColumn("quality_score", F.col("quality.score"))
    valid, bad = upsert.quarantine(rows, upsert.price_checks())
    columns = [*PRICE_KEY, "modal_price", "min_price", "max_price", "unit", "source", "source_mandi_name", "batch_id", "quality_score", "parser_version", "normalization_version"]
    columns += [c for c in ("variety_id", "grade_id") if c in valid.columns]
    once = upsert.last_wins(valid.select(*columns, seq), PRICE_KEY, [seq]).drop(seq)
    kept = upsert.respect_precedence(once, existing, PRICE_KEY)
    created = found.where("mandi_method = 'CREATED' or crop_method = 'CREATED'").select("mandi_id", "mandi_method", "crop_id", "crop_method", "market", "commodity").distinct()
    methods = resolve.tally_methods(found, {"mandi": "mandi_method", "crop": "crop_method"})
    seen = lambda entities, r: resolve.touch_last_seen(entities, r.keys, now) if "last_seen_at" in entities.columns else entities
    after = [resolve.with_fresh(seen(entities, r), r.fresh, last_seen_at=now) for entities, r in ((dims.markets, markets), (dims.crops, crops))]
    aliases = [resolve.fuzzy_aliases(r.keys, known) for r, known in ((markets, dims.market_aliases), (crops, dims.crop_aliases))]
    return Ingested(entries, kept, bad, rejected, created, methods, *after, varieties, grades, *aliases)


def counters(done: Ingested) -> DataFrame:
    """rows_processed, rows_failed and the batch's status, counted as the rows are written."""
    _, processed = counted(done.prices, "prices")
    _, failed = counted(done.quarantine.select("error_code").unionByName(done.rejected.select(F.lit("PARSE").alias("error_code"))), "failed")
    row = done.prices.sparkSession.createDataFrame([(processed, failed)], "rows_processed long, rows_failed long")
    return row.withColumn("status", batches.status(F.col("rows_processed"), F.col("rows_failed")))


def rewrite_dates(today: datetime.date, days: int = 3) -> list[datetime.date]:
    """The dates that a daily rewrite takes again: today and the days before."""
    return [today - datetime.timedelta(days=k) for k in range(days)]


def backfill_dates(start: datetime.date, end: datetime.date, today: datetime.date) -> list[datetime.date]:
    if start > end or end >= today:
        raise ValueError("the range must begin before it ends and end before today")
    return [start + datetime.timedelta(days=k) for k in range((end - start).days + 1)]


def market_today(now_utc: datetime.datetime) -> datetime.date:
    """The business day at UTC+5:30."""
    return (now_utc + datetime.timedelta(hours=5, minutes=30)).date()


def daily_winners(prices: DataFrame) -> DataFrame:
    """mandi_id, crop_id, variety, grade, price_date, modal_price: of rows of one date the one of the strongest source, then of
    the smallest market of origin."""
    rows = prices.withColumns({"__rank": p.source_rank(F.col("source")), "__origin": -F.coalesce("source_mandi_id", F.lit(0))})
    keys = ["mandi_id", "crop_id", "variety", "grade", "price_date"]
    return latest.latest(rows.select(*keys, "modal_price", "__rank", "__origin"), keys, ["__rank", "__origin"]).drop("__rank", "__origin")


def refresh_cache(prices: DataFrame) -> DataFrame:
    """The latest-price cache, built from all prices; varieties and grades as text keys."""
    return latest.price_cache(daily_winners(prices), ["mandi_id", "crop_id", "variety", "grade"])


def outage_alert(runs: DataFrame, job_name: str, order: list[Column]) -> bool:
    """Whether the last three runs of a job all failed."""
    own = runs.where(F.col("job_name") == job_name)
    return bool(batches.all_failed(own, ["job_name"], order, F.col("status") == "FAILED").head(1))


@dataclasses.dataclass(frozen=True)
class Refetched:
    """records: (seq, record) of pages that were read in full; pages: the queue afterwards; calls: state, page, rows, error
    of each page that was asked for; counts: pages resolved, pending again and skipped."""

    records: DataFrame
    pages: DataFrame
    calls: DataFrame
    counts: DataFrame


def refetch(pages: DataFrame, runs: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> Refetched:
    """Ask for all pending pages again. fetch takes the plan (id, target_date, state and the page's columns) and returns
    (page_id, error, seq, record): a row per record, or one without a record for a page that is empty or failed again.
    Pages without a known date or state are skipped. Only pages that were read in full are resolved."""
    plan = staged(batches.retry_plan(pages, runs), "retries")
    known = plan.where("target_date is not null and state is not null")
    got = staged(fetch(known), "fetched")
    verdict = got.groupBy(F.col("page_id").alias("id")).agg(F.max("error").isNull().alias("read"), F.max("error").alias("error"), F.count("record").alias("rows"))
    after = pages.join(verdict.select("id", "read"), "id", "left").withColumn("status", F.when(F.col("read"), "RESOLVED").otherwise(F.col("status"))).select(pages.columns)
    good = got.join(verdict.where("read").select(F.col("id").alias("page_id")), "page_id", "left_semi").where("record is not null")
    outcome = pages.where("status = 'PENDING'").join(verdict.select("id", "read"), "id", "left").select(F.when(F.col("read"), "resolved").when(~F.col("read"), "pending").otherwise("skipped").alias("outcome"))
    where = known.select("id", "state", *(["page"] if "page" in known.columns else []))
    return Refetched(good.select("seq", "record"), after, where.join(verdict, "id").drop("id", "read"), batches.tally(outcome, "outcome"))


@dataclasses.dataclass(frozen=True)
class Retried:
    """done: what the pages held; pages: the queue afterwards; counts: pages resolved, pending again and skipped."""

    done: Ingested
    pages: DataFrame
    counts: DataFrame


def retry_failed(pages: DataFrame, runs: DataFrame, fetch: Callable[[DataFrame], DataFrame], dims: Dimensions, existing: DataFrame, source: str, batch_id: str) -> Retried:
    """The records of pages that refetch() could read, as a batch."""
    again = refetch(pages, runs, fetch)
    return Retried(ingest(again.records, dims, existing, source, batch_id), again.pages, again.counts)


def take_dates(read: Callable[[list[datetime.date]], DataFrame], dates: list[datetime.date], dims: Dimensions, existing: DataFrame, source: str, batch_id: str) -> tuple[Ingested, DataFrame]:
    """One batch for several dates, and its rows by date and outcome, STORED or FAILED. read gives the raw records of some
    dates; records of other dates are left out."""
    raw = read(dates)
    parsed, _ = parse_records(raw)
    wanted = parsed.select("seq", "price_date").where(F.col("price_date").isin(dates)).select("seq").distinct()
    done = ingest(raw.join(wanted, "seq", "left_semi"), dims, existing, source, batch_id)
    rows = done.prices.select("price_date", F.lit("STORED").alias("outcome")).unionByName(done.quarantine.select("price_date", F.lit("FAILED").alias("outcome")))
    return done, batches.tally(rows, "price_date", "outcome")


def daily_rewrite(read, today: datetime.date, dims: Dimensions, existing: DataFrame, source: str, batch_id: str, days: int = 3) -> tuple[Ingested, DataFrame]:
    """Today and the days before again, as the source corrects them."""
    return take_dates(read, rewrite_dates(today, days), dims, existing, source, batch_id)


def historical_backfill(read, start: datetime.date, end: datetime.date, today: datetime.date, runs: DataFrame, dims: Dimensions, existing: DataFrame, source: str, batch_id: str) -> tuple[Ingested, DataFrame]:
    """The dates of a range that no successful run of runs(job_name, status, date_range_start) has taken yet. The range has
    at most a few thousand days."""
    wanted = backfill_dates(start, end, today)
    done = runs.where("job_name = 'historical_backfill' and status = 'SUCCESS'").where(F.col("date_range_start").between(F.lit(start), F.lit(end)))
    known = {r[0] for r in done.select("date_range_start").distinct().collect()}
    return take_dates(read, [d for d in wanted if d not in known], dims, existing, source, batch_id)


def startup(config: DataFrame, spec: dict, tables: dict[str, tuple[DataFrame, str]], session: SparkSession | None = None) -> dict:
    """The typed configuration, once all tables, (rows, schema) by name, have the columns they need, and a session, if one
    is given, has the SQL functions in this version; one error for all."""
    wrong = sql.missing(session) if session else []
    for name, (rows, ddl) in tables.items():
        try:
            assert_schema(rows, ddl)
        except ValueError as error:
            wrong.append(f"{name}: {error}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return typed_config(config, spec)


def batch_name(now_utc: datetime.datetime) -> str:
    """An id whose order is that of time: milliseconds in 12 hexadecimal digits, then 20 random ones."""
    return f"{int(now_utc.timestamp() * 1000):012x}{uuid.uuid4().hex[:20]}"
