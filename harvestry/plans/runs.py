"""Jobs with what surrounds them: a lease, an open batch, one commit of all tables that change, counters, alerts. Jobs are
the live tick, the rewrite of the last days, backfills of a range of dates, retries of failed pages, the nightly audit, and
reviews of issues.

A run takes raw records (written already, since reading a feed twice may give two answers) through ingest and commits
prices, raw entries, entities, aliases, issues, pages, coverage, the price cache, the log of batches and its marks
as one version. Prices and raw entries are kept by day; only the days of the batch are read and written. Running a
micro-batch again that was committed before changes nothing.
"""

from __future__ import annotations

import dataclasses
import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestry import schema
from harvestry.functions.text import name_match, state_tag
from harvestry.operators import audit, batches, latest, upsert
from harvestry.plans import jobs
from harvestry.sources.staging import counted, spread, staged
from harvestry.sources.tables import current, parse_records, record_date
from harvestry.sources.versions import Lease, Versions

ISSUES = "batch_id string, error_code string, row_data string, review_status string, created_at timestamp"
PAGES = "batch_id string, resource string, page int, error_message string, status string, created_at timestamp"
BATCHES = f"{schema.BATCHES}, date_range_start date, date_range_end date"
REVIEWS = "issue_id string, review_status string, review_note string, reviewed_at timestamp, turn long"
COVERAGE = "batch_id string, state string, captured long, reported long, missing long"
CACHE_KEYS = ["mandi_id", "crop_id", "variety", "grade"]
_OPTIONAL = ("varieties", "grades", "variety_aliases")


def stored(store: Versions, table: str, ddl: str, parts: list | None = None) -> DataFrame:
    return store.read(table, parts) if store.has(table) else store.spark.createDataFrame([], ddl)


def dimensions(store: Versions) -> jobs.Dimensions:
    names = [f.name for f in dataclasses.fields(jobs.Dimensions)]
    return jobs.Dimensions(**{n: store.read(n) if store.has(n) else None for n in names if store.has(n) or n in _OPTIONAL})


@dataclasses.dataclass(frozen=True)
class Run:
    """What came of a job: started tells whether another one held its lease."""

    started: bool
    status: str | None = None
    processed: int = 0
    failed: int = 0
    error: str | None = None


def _alert(store: Versions, job_name: str, log: DataFrame) -> dict[str, DataFrame]:
    """The alerts with a new one if the last three runs of the job all failed and no such alert is open. A run for several
    dates that failed is tried again in halves, so it doesn't count by itself."""
    known = stored(store, "alerts", schema.ALERTS)
    single = log.where(F.col("date_range_start").eqNullSafe(F.col("date_range_end")))
    if not jobs.outage_alert(single, job_name, [F.desc("started_at"), F.desc("id")]):
        return {}
    row = [("OUTAGE-001", "HIGH", f"the last three runs of {job_name} failed", "job", job_name)]
    found = store.spark.createDataFrame(row, ", ".join(f"{c} string" for c in audit.FINDING))
    return {"alerts": known.unionByName(audit.new_alerts(found, known).withColumn("status", F.lit("OPEN")))}


@dataclasses.dataclass(frozen=True)
class Work:
    """What a job takes: raw(seq, record); pages(state, page, rows, total, error), how reading went; calls like pages, if not
    every page was a call; tables that are replaced with the rest; and whether nothing is known to lack."""

    raw: DataFrame
    pages: DataFrame | None = None
    calls: DataFrame | None = None
    replace: dict[str, DataFrame] = dataclasses.field(default_factory=dict)
    complete: bool = True


def run(store: Versions, job_name: str, batch_id: str, raw: DataFrame | Callable[[], Work], source: str, now: datetime.datetime, pages: DataFrame | None = None, marks: dict | None = None, seq: str = "seq", dates: tuple[datetime.date, datetime.date] | None = None) -> Run:
    """Take raw(seq, record) into the store as one batch, with its pages, or the Work that a function gives: it is called once
    the batch is open, so its failure is the batch's. dates is the range that the batch is for."""
    lease = Lease(store.spark, store.files.folder, job_name, batch_id, schema.STALE_LOCK_MINUTES)
    if not lease.acquire(now):
        return Run(False)
    try:
        stamp = F.lit(now)
        log = stored(store, "batches", BATCHES).where(F.col("id") != batch_id)
        log = staged(batches.opened(log, batch_id, job_name, source, stamp, dates), "batches")
        store.commit({"batches": log})
        try:
            work = raw() if callable(raw) else Work(raw, pages)
            return _take(store, job_name, batch_id, work, source, now, log, marks or {}, seq)
        except Exception:
            ended = staged(batches.closed(log, batch_id, 0, 1, stamp), "batches")
            store.commit({"batches": ended} | _alert(store, job_name, ended))
            raise
    finally:
        lease.release()


def _take(store: Versions, job_name: str, batch_id: str, work: Work, source: str, now: datetime.datetime, log: DataFrame, marks: dict, seq: str) -> Run:
    # records take little room as files, and much time to parse: they are dealt over all tasks and parsed once
    stamp, state, raw, pages = F.lit(now), store.state(), staged(spread(work.raw), "raw"), work.pages
    parsed, rejected = parse_records(raw)
    parsed = staged(parsed, "parsed")
    days = [r[0] for r in parsed.select("price_date").distinct().collect()]  # a row for each day of the batch
    first = not store.has("prices")
    existing = None if first else store.read("prices", days)
    done = jobs.ingest(raw, dimensions(store), store.spark.createDataFrame([], schema.PRICES) if first else existing, source, batch_id, seq, stamp, (parsed, rejected))
    fresh, processed = counted(done.prices, "fresh")
    prices = staged(upsert.last_wins(fresh, schema.PRICE_KEY, ["batch_id"]) if first else upsert.upsert(existing, fresh, schema.PRICE_KEY, ["batch_id"]), "prices")
    entries = done.entries if not store.has("raw_entries") else upsert.merge_raw(store.read("raw_entries", days), done.entries)[0]
    cause = lambda rows, code, data: rows.select(F.lit(batch_id).alias("batch_id"), code.alias("error_code"), F.to_json(data).alias("row_data"), F.lit("PENDING").alias("review_status"), stamp.alias("created_at"))
    bad = done.quarantine.drop("quality", seq)
    issues = cause(bad, F.col("error_code"), F.struct(*bad.columns)).unionByName(cause(done.rejected, F.lit("PARSE"), F.col("record")))
    union = lambda table, rows: store.read(table).unionByName(rows.select(store.read(table).columns))
    replace = {"markets": done.markets, "crops": done.crops, "market_aliases": union("market_aliases", done.market_aliases), "crop_aliases": union("crop_aliases", done.crop_aliases)}
    replace |= {n: rows for n, rows in (("varieties", done.varieties), ("grades", done.grades)) if rows is not None}
    replace |= work.replace
    complete, append = work.complete, {"issues": (issues, "batch_id")}
    calls = pages if work.calls is None else work.calls
    if calls is not None:
        append["api_calls"] = (batches.call_log(batches.page_calls(calls, batch_id, job_name, source, stamp))[0], "batch_id")
    if pages is not None:
        report = staged(batches.coverage_report(pages, batch_id), "coverage")
        append["coverage"] = (report, "batch_id")
        failed = batches.failed_pages(pages.withColumn("resource", F.lit(source)), batch_id, stamp)
        replace["failed_pages"] = stored(store, "failed_pages", PAGES).unionByName(failed.select([c.split()[0] for c in PAGES.split(", ")]))
        complete = complete and not pages.where("error is not null").head(1) and not report.where("missing > 0").head(1)
    if days:
        before = state["marks"].get("newest_date")
        before = before and datetime.date.fromisoformat(before)

        def read(dates: list[datetime.date]) -> DataFrame:
            others = [d for d in dates if d not in set(days)]
            rows = prices if first else prices.unionByName(store.read("prices", others).select(prices.columns))
            return jobs.daily_winners(rows.where(F.col("price_date").isin(dates)))

        cache = store.read("price_cache") if store.has("price_cache") else None
        replace["price_cache"] = latest.maintained(cache, read, CACHE_KEYS, days, before)
        marks = marks | {"newest_date": max([*days, *([before] if before else [])]).isoformat()}

    ended = {}

    def closing(counts: dict[str, int]) -> dict[str, DataFrame]:
        ended["log"] = staged(batches.closed(log, batch_id, processed, counts["issues"], stamp, complete), "batches")
        ended["failed"] = counts["issues"]
        return {"batches": ended["log"]} | _alert(store, job_name, ended["log"])

    store.commit(replace, {"prices": (prices, "price_date"), "raw_entries": (entries, "price_date")}, append, marks, closing)
    status = ended["log"].where(F.col("id") == batch_id).head().status
    return Run(True, status, processed, ended["failed"])


def setup(store: Versions, dims: jobs.Dimensions) -> None:
    """The dimensions as a store's first tables."""
    store.commit({f.name: rows for f in dataclasses.fields(dims) if (rows := getattr(dims, f.name)) is not None})


def tick(store: Versions, rows: DataFrame, number: int, now: datetime.datetime, source: str = "resource_1", job_name: str = "live_tick") -> Run | None:
    """A micro-batch of the feed (state, page, ok, error, total, record, place); None if it was committed before."""
    if number <= store.mark(job_name, -1):
        return None
    rows = staged(rows, "feed")
    raw = rows.where("record is not null").select(F.struct("state", "page", "place").alias("seq"), "record")
    pages = rows.groupBy("state", "page").agg(F.count("record").alias("rows"), F.max("total").alias("total"), F.max("error").alias("error"))
    # a tick has some of a state's pages only, so the feed's total isn't the tick's
    pages = pages.withColumn("total", F.sum("rows").over(Window.partitionBy("state")))
    today = jobs.market_today(now)
    return run(store, job_name, f"{job_name}-{number:08d}", raw, source, now, pages, {job_name: number}, dates=(today, today))


def by_dates(store: Versions, job_name: str, read: Callable[[list[datetime.date]], Work], dates: list[datetime.date], now: datetime.datetime, source: str = "resource_2", span: int = 1) -> list[tuple[list[datetime.date], Run]]:
    """Batches of `span` dates each, in the order of dates. read gives the records of some dates; those that have another date
    are left out, those without one are rejected. A batch that fails is taken again in halves, so a date that can't be read
    fails alone and the others are stored. Returns the dates of each last attempt and what came of it; it ends early if
    another run holds the job's lease."""
    todo, done = [dates[k : k + span] for k in range(0, len(dates), span)], []
    while todo:
        part = todo.pop(0)
        asked = (min(part), max(part))

        def work() -> Work:
            got = read(part)  # noqa: B023
            day = record_date()
            return dataclasses.replace(got, raw=staged(spread(got.raw).where(day.isin(part) | day.isNull()), "records"))  # noqa: B023

        try:
            done.append((part, run(store, job_name, f"{job_name}-{now:%Y%m%d%H%M%S}-{asked[0]:%Y%m%d}-{asked[1]:%Y%m%d}", work, source, now, dates=asked)))
        except Exception as error:
            if len(part) > 1:
                half = len(part) // 2
                todo[:0] = [part[:half], part[half:]]
            else:
                done.append((part, Run(True, "FAILED", 0, 1, f"{type(error).__name__}: {error}"[:500])))
            continue
        if not done[-1][1].started:
            break
    return done


def daily_rewrite(store: Versions, read: Callable[[list[datetime.date]], Work], now: datetime.datetime, source: str = "resource_2", days: int = 3) -> list[tuple[list[datetime.date], Run]]:
    """Today and the days before again, a batch each, as the source corrects them."""
    return by_dates(store, "daily_rewrite", read, jobs.rewrite_dates(jobs.market_today(now), days), now, source)


def historical_backfill(store: Versions, read: Callable[[list[datetime.date]], Work], start: datetime.date, end: datetime.date, now: datetime.datetime, source: str = "resource_2", span: int = 30) -> list[tuple[list[datetime.date], Run]]:
    """The dates of a range that no successful backfill has covered yet, `span` dates to a batch. The range has at most a few
    thousand days."""
    wanted, job = jobs.backfill_dates(start, end, jobs.market_today(now)), "historical_backfill"
    log = stored(store, "batches", BATCHES).where((F.col("job_name") == job) & (F.col("status") == "SUCCESS"))
    days = log.select(F.explode(F.sequence("date_range_start", "date_range_end")).alias("day")).where(F.col("day").between(F.lit(start), F.lit(end)))
    covered = {r.day for r in days.distinct().collect()}
    return by_dates(store, job, read, [d for d in wanted if d not in covered], now, source, span)


def retry_failed_pages(store: Versions, fetch: Callable[[DataFrame], DataFrame], batch_id: str, now: datetime.datetime, source: str = "resource_2") -> Run:
    """Ask for the pending pages of the queue again (jobs.refetch). What could be read is stored as one batch, in one
    version with the queue afterwards; the batch is PARTIAL while pages stay pending."""

    def work() -> Work:
        queue = stored(store, "failed_pages", PAGES)
        named = queue.withColumns({"id": F.sha2(F.concat_ws("|", "batch_id", "resource", "page", "error_message"), 256), "state": state_tag("error_message")})
        again = jobs.refetch(named, store.read("batches"), fetch)
        after, records = staged(again.pages.select(queue.columns), "queue"), staged(again.records, "records")
        return Work(records, calls=again.calls, replace={"failed_pages": after}, complete=not after.where("status = 'PENDING'").head(1))

    return run(store, "retry_failed_pages", batch_id, work, source, now)


def issues_of(store: Versions) -> DataFrame:
    """The issues of all batches with their latest review. Issues are never changed: reviews are rows of their own."""
    rows = stored(store, "issues", ISSUES).withColumn("issue_id", F.sha2(F.concat_ws("|", "batch_id", "error_code", "row_data"), 256))
    last = current(stored(store, "issue_reviews", REVIEWS), "issue_id", "turn").withColumnRenamed("review_status", "reviewed")
    both = rows.join(last, "issue_id", "left")
    return both.withColumn("review_status", F.coalesce("reviewed", "review_status")).drop("reviewed", "turn")


def review_issues(store: Versions, hit: Column, status: str, note: str, now: datetime.datetime) -> int:
    """Review the issues that a condition on issues_of() holds for; the number of them. A review of an issue whose status it
    wouldn't change is left out, so a repeat adds nothing."""
    known = issues_of(store)
    wanted = batches.resolve_where(known, hit, status, note, F.lit(now)).where(hit).join(known.where(F.col("review_status") != status).select("issue_id"), "issue_id", "left_semi")
    rows = staged(wanted.select("issue_id", "review_status", "review_note", "reviewed_at", F.lit(store.state()["version"]).cast("long").alias("turn")).distinct(), "reviews")
    return store.commit(append={"issue_reviews": (rows, None)})["issue_reviews"] if rows.head(1) else 0


def nightly_audit(store: Versions, now: datetime.datetime, score=name_match) -> int | None:
    """The seven checks over the store: a row of the append-only coverage reports, and an open alert for each finding that
    has none, in one version. The number of new alerts; None while another audit runs."""
    lease = Lease(store.spark, store.files.folder, "nightly_audit", f"audit-{now:%Y%m%d%H%M%S}", schema.STALE_LOCK_MINUTES)
    if not lease.acquire(now):
        return None
    try:
        known, stamp = stored(store, "alerts", schema.ALERTS), F.lit(now)
        issues, queue = issues_of(store).withColumnRenamed("review_status", "status"), stored(store, "failed_pages", PAGES)
        found, coverage = audit.run_audit(store.read("markets"), store.read("crops"), store.read("prices"), issues, queue, known, stamp, score)
        fresh, n = counted(found.withColumn("status", F.lit("OPEN")), "findings")
        codes = fresh.agg(*(F.count_if(F.col("error_code") == c).alias(c.lower().replace("-", "_")) for c in sorted(audit.SEVERITY)))
        report = coverage.select(stamp.alias("created_at"), "*").join(codes, F.lit(True))  # a row each
        store.commit({"alerts": staged(known.unionByName(fresh.select(known.columns)), "alerts")}, append={"coverage_reports": (report, None)})
        return n
    finally:
        lease.release()
