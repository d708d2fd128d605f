"""Batches of jobs: status from counters, locks, failure streaks, retries, issue review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestry.functions.text import state_tag
from harvestry.schema import CALL_FAILED, STALE_LOCK_MINUTES


def status(processed: Column, failed: Column, complete: Column | None = None) -> Column:
    """FAILED without any row, PARTIAL with failures or missing pages, else SUCCESS."""
    trouble = (failed > 0) if complete is None else (failed > 0) | ~complete
    return F.when(processed == 0, F.when(trouble, "FAILED").otherwise("SUCCESS")).when(trouble, "PARTIAL").otherwise("SUCCESS")


def reap_stale(batches: DataFrame, now: Column, minutes: int = STALE_LOCK_MINUTES) -> DataFrame:
    """batches in which RUNNING ones of at least that age are FAILED."""
    old = (F.col("status") == "RUNNING") & (F.col("started_at") <= now - F.expr(f"interval {minutes} minutes"))
    return batches.withColumns({"completed_at": F.when(old, now).otherwise(F.col("completed_at")), "status": F.when(old, "FAILED").otherwise(F.col("status"))})


def may_start(batches: DataFrame, job_name: str) -> bool:
    return not batches.where((F.col("job_name") == job_name) & (F.col("status") == "RUNNING")).head(1)


def newest(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The n first rows of each key in an order; Spark prunes to n rows per key before the shuffle."""
    return rows.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__place") <= n).drop("__place")


def all_failed(rows: DataFrame, keys: list[str], order: list[Column], failed: Column, n: int = 3) -> DataFrame:
    """keys whose n newest rows exist and all failed."""
    return newest(rows.withColumn("__failed", failed), keys, order, n).groupBy(*keys).agg(F.count("*").alias("__n"), F.bool_and("__failed").alias("__all")).where((F.col("__n") == n) & F.col("__all")).select(*keys)


def coverage_shortfall(pages: DataFrame, key: str, rows: str, total: str) -> DataFrame:
    """key, captured, reported where a paged scan captured fewer rows than the source reported."""
    return pages.groupBy(key).agg(F.sum(rows).alias("captured"), F.max(total).alias("reported")).where("captured < reported")


def retry_plan(pages: DataFrame, batches: DataFrame) -> DataFrame:
    """Pending failed pages, oldest first, with their batch's date and the state of their message."""
    dates = batches.select(F.col("id").alias("batch_id"), F.col("date_range_start").alias("target_date"))
    return pages.where("status = 'PENDING'").join(dates, "batch_id").withColumn("state", F.coalesce("state", state_tag("error_message"))).orderBy("created_at", "id")


def resolve_where(issues: DataFrame, hit: Column, new_status: str, note: str, now: Column) -> DataFrame:
    """issues with a review of those that a condition holds for; PENDING is not a review."""
    if new_status == "PENDING":
        raise ValueError("an issue can't be resolved as PENDING")
    pick = lambda value, c: F.when(hit, value).otherwise(F.col(c))
    return issues.withColumns({"review_status": pick(F.lit(new_status), "review_status"), "review_note": pick(F.lit(note), "review_note"), "reviewed_at": pick(now, "reviewed_at")})


def resolve_issues(issues: DataFrame, ids: list[int], new_status: str, note: str, now: Column) -> DataFrame:
    """resolve_where for some ids."""
    return resolve_where(issues, F.col("id").isin(*ids), new_status, note, now)


def opened(batches: DataFrame, batch_id: str, job_name: str, resource: str | None, now: Column, dates: tuple | None = None) -> DataFrame:
    """batches with a new RUNNING one, for a range of dates or none; stale ones are failed first. An error while the job
    still runs."""
    reaped = reap_stale(batches, now)
    if not may_start(reaped, job_name):
        raise ValueError(f"{job_name} is running already")
    values = {"id": F.lit(batch_id), "job_name": F.lit(job_name), "resource": F.lit(resource), "started_at": now, "status": F.lit("RUNNING"), "rows_processed": F.lit(0), "rows_failed": F.lit(0)}
    if dates:
        values |= {"date_range_start": F.lit(dates[0]), "date_range_end": F.lit(dates[1])}
    row = batches.sparkSession.range(1).select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in batches.schema))
    return reaped.unionByName(row)


def closed(batches: DataFrame, batch_id: str, processed: int, failed: int, now: Column, complete: bool = True) -> DataFrame:
    """batches in which one has ended, with its counters and the status that follows from them."""
    hit = F.col("id") == batch_id
    news = {"completed_at": now, "status": status(F.lit(processed), F.lit(failed), F.lit(complete)), "rows_processed": F.lit(processed).cast("long"), "rows_failed": F.lit(failed).cast("long")}
    return batches.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in news.items()})


def call_log(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls to log, calls that can't be): a failure needs an error code, and the status is one of the two."""
    fine = F.coalesce((F.col("status") == "SUCCESS") | ((F.col("status") == "FAILURE") & (F.trim("error_code") != "")), F.lit(False))
    return calls.where(fine), calls.where(~fine)


def page_calls(pages: DataFrame, batch_id: str, job_name: str, resource: str, now: Column) -> DataFrame:
    """Rows of the log of calls for pages(state, page, rows, error): a call is a page that was read or failed."""
    fine = F.col("error").isNull()
    ms = F.col("duration_ms") if "duration_ms" in pages.columns else F.lit(None)
    return pages.select(
        F.lit(batch_id).alias("batch_id"), F.lit(job_name).alias("job_name"), F.lit(resource).alias("resource"), "state", F.col("page").cast("int").alias("page"), F.when(fine, "SUCCESS").otherwise("FAILURE").alias("status"),
        F.when(fine, F.col("rows")).cast("long").alias("rows"), F.when(~fine, CALL_FAILED).alias("error_code"), ms.cast("long").alias("duration_ms"), now.alias("created_at"),
    )


def failed_pages(pages: DataFrame, batch_id: str, now: Column) -> DataFrame:
    """Rows of the retry queue for pages(resource, state, page, error) that could not be read."""
    message = F.when(F.col("state").isNotNull(), F.concat(F.lit("[state="), "state", F.lit("] "), "error")).otherwise(F.col("error"))
    return pages.where("error is not null").select(F.lit(batch_id).alias("batch_id"), "resource", "page", message.alias("error_message"), F.lit("PENDING").alias("status"), now.alias("created_at"))


def coverage_report(pages: DataFrame, batch_id: str) -> DataFrame:
    """captured, reported and missing rows of each state of a batch's pages(state, rows, total)."""
    found = pages.groupBy("state").agg(F.sum("rows").alias("captured"), F.max("total").alias("reported"))
    return found.select(F.lit(batch_id).alias("batch_id"), "state", "captured", "reported", F.greatest(F.col("reported") - F.col("captured"), F.lit(0)).alias("missing"))


def tally(rows: DataFrame, *keys: str) -> DataFrame:
    """Number of rows by keys, such as a date and a status."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def issue_list(issues: DataFrame, wanted: str, n: int) -> DataFrame:
    """The n newest issues of a review status."""
    return issues.where(F.col("review_status") == wanted).orderBy(F.desc("created_at"), F.desc("id")).limit(n)


def append_only(stored: DataFrame, news: DataFrame) -> DataFrame:
    """news, if every stored row is still among its rows; an error if one was changed or is gone."""
    if stored.exceptAll(news.select(stored.columns)).head(1):
        raise ValueError("rows of an append-only table were changed or deleted")
    return news
