"""Jobs around a store: rewrites, backfills that fail on some dates, retries, the nightly audit, reviews."""

import datetime

import pytest
from pyspark.sql import functions as F

from harvestry.plans import runs
from harvestry.sources.versions import Lease, Versions
from tests.test_operators import DAY, dims, record

NOW = datetime.datetime(2026, 7, 15, 12)
RECORDS = "seq int, record map<string,string>"


def on(k, **changes):
    return record(arrival_date=(DAY + datetime.timedelta(days=k)).strftime("%d/%m/%Y"), **changes)


def store_of(spark, tmp_path):
    store = Versions(spark, str(tmp_path / "store"))
    runs.setup(store, dims(spark))
    return store


def prices(store):
    return {(r.price_date - DAY).days: r.modal_price for r in store.read("prices").collect()}


def test_rewrite_takes_the_last_days_and_corrections(spark, tmp_path):
    store, price = store_of(spark, tmp_path), {"p": "2500"}
    read = lambda dates: runs.Work(spark.createDataFrame([(k, on(-k, modal_price=price["p"])) for k in range(5)], RECORDS))
    done = runs.daily_rewrite(store, read, NOW)
    assert [(d, r.status, r.processed) for d, r in done] == [([DAY - datetime.timedelta(days=k)], "SUCCESS", 1) for k in range(3)]
    assert prices(store) == {0: 25.0, -1: 25.0, -2: 25.0}
    price["p"] = "2600"
    runs.daily_rewrite(store, read, NOW + datetime.timedelta(days=1))
    assert prices(store) == {0: 26.0, -1: 26.0, -2: 25.0}
    held = Lease(spark, store.files.folder, "daily_rewrite", "another")
    assert held.acquire(NOW) and [r.started for _, r in runs.daily_rewrite(store, read, NOW)] == [False]


def test_backfill_goes_on_behind_a_date_that_fails(spark, tmp_path):
    store, broken, asked = store_of(spark, tmp_path), {DAY - datetime.timedelta(days=3)}, []

    def read(dates):
        asked.append(dates)
        if broken & set(dates):
            raise OSError("down")
        return runs.Work(spark.createDataFrame([(k, on(-k)) for k in range(1, 9)] + [(20, on(-1, commodity=""))], RECORDS))

    first, last = DAY - datetime.timedelta(days=4), DAY - datetime.timedelta(days=1)
    done = runs.historical_backfill(store, read, first, last, NOW, span=4)
    assert [(len(d), r.status) for d, r in done] == [(1, "SUCCESS"), (1, "FAILED"), (2, "PARTIAL")]
    assert "down" in done[1][1].error and sorted(prices(store)) == [-4, -2, -1]
    log = {(str(r.date_range_start)[-2:], str(r.date_range_end)[-2:]): r.status for r in store.read("batches").collect()}
    assert log == {("11", "14"): "FAILED", ("11", "12"): "FAILED", ("11", "11"): "SUCCESS", ("12", "12"): "FAILED", ("13", "14"): "PARTIAL"}
    assert not store.has("alerts")  # attempts for several dates don't count
    broken.clear()
    asked.clear()
    runs.historical_backfill(store, read, first, last, NOW + datetime.timedelta(hours=1), span=4)
    assert [len(d) for d in asked] == [3] and sorted(prices(store)) == [-4, -3, -2, -1]  # what succeeded isn't read again
    with pytest.raises(ValueError, match="range"):
        runs.historical_backfill(store, read, first, DAY, NOW)


def test_retry_takes_what_can_be_read(spark, tmp_path):
    store, today = store_of(spark, tmp_path), (DAY, DAY)
    pages = spark.createDataFrame([("Goa", 0, 0, 0, "down"), ("Bihar", 3, 0, 0, "down"), ("Assam", 1, 1, 1, None)], "state string, page int, rows int, total int, error string")
    one = spark.createDataFrame([(0, on(0))], RECORDS)
    assert runs.run(store, "live_tick", "b0", one, "resource_1", NOW, pages, dates=today).status == "PARTIAL"
    lost = store.read("failed_pages").limit(1).withColumns({"batch_id": F.lit("gone"), "page": F.lit(9)})
    store.commit({"failed_pages": store.read("failed_pages").unionByName(lost)})

    def fetch(plan):
        assert {(r.state, r.page, r.target_date) for r in plan.collect()} == {("Goa", 0, DAY), ("Bihar", 3, DAY)}
        good = plan.where("state = 'Goa'").select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("error"), F.lit(1).alias("seq"), F.create_map(*(F.lit(x) for kv in on(0, modal_price="2700").items() for x in kv)).alias("record"))
        return good.unionByName(plan.where("state = 'Bihar'").select(F.col("id").alias("page_id"), F.lit("down again").alias("error"), F.lit(2).alias("seq"), F.lit(None).cast("map<string,string>").alias("record")))

    got = runs.retry_failed_pages(store, fetch, "b1", NOW)
    assert (got.status, got.processed) == ("PARTIAL", 1) and prices(store) == {0: 27.0}
    assert {r.page: r.status for r in store.read("failed_pages").collect()} == {0: "RESOLVED", 3: "PENDING", 9: "PENDING"}
    calls = {(r.batch_id, r.state): (r.status, r.error_code, r.rows) for r in store.read("api_calls").collect()}
    assert calls["b1", "Goa"] == ("SUCCESS", None, 1) and calls["b1", "Bihar"] == ("FAILURE", "INGEST-001", None) and calls["b0", "Assam"] == ("SUCCESS", None, 1) and len(calls) == 5


def test_audit_alerts_once_and_reviews_leave_issues_alone(spark, tmp_path):
    store = store_of(spark, tmp_path)
    raw = spark.createDataFrame([(0, on(0)), (1, on(-2)), (2, on(0, min_price="4000", variety="bad")), (3, on(0, market=""))], RECORDS)
    runs.run(store, "daily_rewrite", "b0", raw, "resource_2", NOW)
    later = NOW + datetime.timedelta(days=4)
    assert runs.nightly_audit(store, later) == 3  # a crop without prices, a backlog of issues, a missing day
    assert sorted(r.error_code for r in store.read("alerts").collect()) == ["AUDIT-002", "AUDIT-004", "AUDIT-006"]
    assert runs.nightly_audit(store, later) == 0 and store.read("alerts").count() == 3
    reports = [(r.expected_count, r.actual_count, r.audit_004) for r in store.read("coverage_reports").orderBy(F.desc("audit_004")).collect()]
    assert reports == [(3, 2, 1), (3, 2, 0)]
    hit = F.col("error_code") == "PARSE"
    assert runs.review_issues(store, hit, "REJECTED", "no market", later) == 1 and runs.review_issues(store, hit, "REJECTED", "again", later) == 0
    assert {r.error_code: (r.review_status, r.review_note) for r in runs.issues_of(store).collect()} == {"PARSE": ("REJECTED", "no market"), "23514": ("PENDING", None)}
    assert runs.review_issues(store, hit, "APPROVED", "after all", later) == 1 and store.verify("issues") == [] and store.verify("issue_reviews") == []
    assert {r.error_code: r.review_status for r in runs.issues_of(store).collect()} == {"PARSE": "APPROVED", "23514": "PENDING"}
    with pytest.raises(ValueError, match="PENDING"):
        runs.review_issues(store, hit, "PENDING", "", later)
