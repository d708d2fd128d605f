import dataclasses
import datetime
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from harvestry import schema
from harvestry.operators import latest
from harvestry.plans import jobs, runs
from harvestry.sources import feed, staging
from harvestry.sources.versions import Lease, Versions
from harvestry.streaming import ticks
from tests.test_operators import DAY, dims, record

NOW = datetime.datetime(2026, 7, 20, 12)


def page(folder, state, n, records):
    (folder / state).mkdir(exist_ok=True, parents=True)
    (folder / state / f"{n}.json").write_text(json.dumps({"total": 1000, "records": records}))


def snapshot(store):
    """All tables but the log of batches."""
    return {t: sorted(map(repr, store.read(t).collect())) for t in store.state()["tables"] if t not in ("batches",)}


def check_cache(store):
    want = jobs.refresh_cache(store.read("prices"))
    got = store.read("price_cache").select(want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def day(k):
    return (DAY + datetime.timedelta(days=k)).strftime("%d/%m/%Y")


def test_ticks_resume_and_replays_change_nothing(spark, tmp_path):
    store, pages = Versions(spark, str(tmp_path / "store")), tmp_path / "pages"
    known = dims(spark)
    runs.setup(store, dataclasses.replace(known, markets=known.markets.withColumn("last_seen_at", F.lit(None).cast("timestamp"))))
    page(pages, "Andhra Pradesh", 0, [record(), record(commodity="Cow"), record(market="", commodity=""), record(min_price="4000", variety="bad")])
    go = lambda: ticks.tick(feed.stream_feed(spark, path=str(pages), states="Andhra Pradesh\nGoa", retries=0), store, str(tmp_path / "checkpoint"), lambda: NOW)
    first = go()
    assert [(r.status, r.processed, r.failed) for r in first] == [("PARTIAL", 2, 2)] and go() == []
    check_cache(store)
    page(pages, "Andhra Pradesh", 1, [record(modal_price="2900"), record(market="Newtown Mandi", arrival_date=day(3)), record(market="Gunturr APMC", arrival_date=day(-9))])
    page(pages, "Goa", 0, [record(state="Goa", district="North", market="Mapusa")])
    second = go()
    assert [(r.status, r.processed, r.failed) for r in second] == [("SUCCESS", 4, 0)]
    prices = {(r.mandi_id, r.crop_id, r.price_date): r.modal_price for r in store.read("prices").collect()}
    assert prices[42, 10, DAY] == 29.0 and len(prices) == 5
    markets = {r.normalized_name: r for r in store.read("markets").collect()}
    assert {"newtown", "mapusa"} <= markets.keys() and markets["mapusa"].last_seen_at == NOW
    assert [r.normalized_alias for r in store.read("market_aliases").where("match_method = 'FUZZY'").collect()] == ["gunturr"]
    entry = store.read("raw_entries").where("market = 'Guntur APMC' and commodity = 'Tomato' and raw_variety = 'FAQ'").collect()
    assert {(r.modal_price, r.first_seen_batch_id[-1], r.last_seen_batch_id[-1]) for r in entry if r.price_date == DAY} == {(2500.0, "0", "0"), (2900.0, "1", "1")}
    assert sorted((r.id[-1], r.status, r.rows_processed, r.rows_failed) for r in store.read("batches").collect()) == [("0", "PARTIAL", 2, 2), ("1", "SUCCESS", 4, 0)]
    assert store.verify("issues") == [] and store.read("coverage").count() == 3
    check_cache(store)
    before, version = snapshot(store), store.state()["version"]
    # the last micro-batch runs again, as after a crash between its commit and that of the stream's checkpoint
    rows = feed.read_feed(spark, path=str(pages), states="Goa", pagesize=10)
    assert runs.tick(store, rows, 1, NOW) is None and store.state()["version"] == version and snapshot(store) == before


def test_a_failed_page_waits_and_a_failed_job_alerts(spark, tmp_path):
    store, pages = Versions(spark, str(tmp_path / "store")), tmp_path / "pages"
    runs.setup(store, dims(spark))
    page(pages, "Andhra Pradesh", 0, [record()])
    (pages / "Andhra Pradesh" / "1.json").write_text("no json")
    got = ticks.tick(feed.stream_feed(spark, path=str(pages), states="Andhra Pradesh", retries=0), store, str(tmp_path / "checkpoint"), lambda: NOW)
    assert [(r.status, r.processed) for r in got] == [("PARTIAL", 1)]
    waiting = store.read("failed_pages").head()
    assert (waiting.page, waiting.status) == (1, "PENDING") and waiting.error_message.startswith("[state=Andhra Pradesh]")
    broken = spark.range(1).select(F.lit(1).alias("seq"), F.create_map(F.lit("market"), F.raise_error(F.lit("down")).cast("string")).alias("record"))
    for k in range(4):
        with pytest.raises(Exception):
            runs.run(store, "daily_rewrite", f"r{k}", broken, "resource_2", NOW + datetime.timedelta(hours=k))
    assert [(r.error_code, r.entity_id) for r in store.read("alerts").collect()] == [("OUTAGE-001", "daily_rewrite")]
    assert store.read("batches").where("status = 'FAILED'").count() == 4 and store.read("prices").count() == 1
    held = Lease(spark, store.files.folder, "daily_rewrite", "another")
    assert held.acquire(NOW) and not runs.run(store, "daily_rewrite", "r9", broken, "resource_2", NOW).started


@pytest.mark.parametrize("seed", range(2))
def test_cache_by_deltas_equals_rebuilds(spark, seed):
    rng, rows, before, cache, at = random.Random(seed), {}, None, None, 0
    schema_of = "k string, price_date date, modal_price double"
    for step in range(6):
        at += rng.choice((0, 1, 2, 9))
        batch = {(rng.choice("abcdef"), DAY + datetime.timedelta(days=at - rng.choice((0, 0, 1, 3, 5, 8, 27, 34, 60)))): float(rng.randrange(20, 30)) for _ in range(8)}
        rows |= batch
        days, asked = sorted({d for _, d in batch}), []

        def read(dates):
            asked.extend(dates)
            return spark.createDataFrame([(k, d, v) for (k, d), v in rows.items() if d in set(dates)], schema_of)  # noqa: B023

        cache = staging.staged(latest.maintained(cache, read, ["k"], days, before), "cache")
        want = latest.price_cache(spark.createDataFrame([(k, d, v) for (k, d), v in rows.items()], schema_of), ["k"])
        assert sorted(map(repr, cache.select(want.columns).collect())) == sorted(map(repr, want.collect()))
        newest = max([*days, *([before] if before else [])])
        assert step == 0 or all(d in days or (newest - d).days <= 36 or (before and (before - d).days <= 36) for d in asked)
        before = newest


def seen_by_hand(rows):
    out = defaultdict(list)
    for k, t in rows:
        out[k].append(t)
    return sorted((k, min(ts), max(ts), len(ts)) for k, ts in out.items())


def test_first_and_last_sight_over_several_runs(spark, tmp_path):
    rng, rows, source = random.Random(1), [], tmp_path / "in"
    for run in range(3):
        for part in range(2):
            more = [(rng.choice("abcdefgh"), NOW + datetime.timedelta(hours=24 * run + rng.randrange(20))) for _ in range(30)]
            rows += more
            spark.createDataFrame(more, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(str(source))
        stream = ticks.source_of(spark, str(source), files=1)
        got = ticks.dedup(stream, str(tmp_path / "out"), ["k"], "ts", buckets=5)
        assert sorted(map(tuple, got.collect())) == seen_by_hand(rows)
    store = Versions(spark, str(tmp_path / "out"))
    assert store.mark("batch") == 5 and len(store.parts("seen")) <= 5
    spark.createDataFrame([("z", NOW + datetime.timedelta(days=400))], "k string, ts timestamp").coalesce(1).write.mode("append").parquet(str(source))
    left = ticks.dedup(ticks.source_of(spark, str(source), files=1), str(tmp_path / "out"), ["k"], "ts", buckets=1 << 30, expire="30 days")
    assert "z" in [r.k for r in left.collect()]


def test_days_over_two_runs(spark, tmp_path):
    source = tmp_path / "in"
    for run, hours in enumerate(((0, 5, 30), (3, 31, 80))):
        spark.createDataFrame([(NOW + datetime.timedelta(hours=h), "a", float(h)) for h in hours], "ts timestamp, kind string, value double").coalesce(1).write.mode("append").parquet(str(source))
        got = ticks.daily(ticks.source_of(spark, str(source)), str(tmp_path / "out"), "ts", ["kind"], "value")
        counts = {(r.day - NOW.date()).days: (r.n, r.low, r.high) for r in got.collect()}
    assert counts == {0: (3, 0.0, 5.0), 1: (2, 30.0, 31.0), 3: (1, 80.0, 80.0)}


def test_stream_offsets(spark, tmp_path):
    for n in range(3):
        page(tmp_path, "Goa", n, [record()])
    page(tmp_path, "Goa", 5, [record()])
    reader = feed.FeedStreamReader({"path": str(tmp_path), "states": "Goa\nBihar"})
    assert reader.initialOffset() == {"Goa": 0, "Bihar": 0} and reader.latestOffset() == {"Goa": 3, "Bihar": 0}
    assert [(p.state, p.page) for p in reader.partitions({"Goa": 1, "Bihar": 0}, {"Goa": 3, "Bihar": 0})] == [("Goa", 1), ("Goa", 2)]
    pages = spark.createDataFrame([("Goa", 9, '{"records": []}'), ("Bihar", 0, "{}")], "state string, page int, body string")
    assert feed.write_pages(pages, str(tmp_path)) == 2 and (tmp_path / "Bihar" / "0.json").read_text() == "{}"
    assert schema.STATES
