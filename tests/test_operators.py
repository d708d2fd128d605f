import dataclasses
import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from harvestry import schema
from harvestry.functions import geo, terms, text
from harvestry.operators import audit, batches, merge, resolve, serving, similar, upsert
from harvestry.plans import jobs
from harvestry.sources import feed, staging, tables
from harvestry.sources.versions import Versions
from harvestry.streaming import ticks

DAY = datetime.date(2026, 7, 15)
PRICE = "mandi_id long, crop_id long, variety string, grade string, price_date date, source_mandi_id long, source string, modal_price double, seq int"


def price_rows(spark, *rows):
    return spark.createDataFrame([(m, 1, "faq", g, DAY, None, s, p, q) for m, g, s, p, q in rows], PRICE)


def test_precedence(spark):
    existing = price_rows(spark, (1, None, "resource_2", 1.0, 0), (2, "", "manual", 1.0, 0), (3, "a", "resource_1", 1.0, 0))
    incoming = price_rows(spark, (1, "", "resource_1", 2.0, 0), (2, "", "resource_2", 2.0, 0), (3, "a", "resource_1", 2.0, 0), (4, "", "resource_1", 2.0, 0))
    assert sorted(r.mandi_id for r in upsert.respect_precedence(incoming, existing).collect()) == [3, 4]


def test_upsert_is_idempotent_and_last_wins(spark):
    old = price_rows(spark, (1, "", "resource_1", 1.0, 0), (2, "", "resource_1", 1.0, 0))
    new = price_rows(spark, (1, "", "resource_1", 2.0, 1), (1, "", "resource_1", 3.0, 2))
    once = upsert.upsert(old, new, schema.PRICE_KEY, ["seq"])
    assert {(r.mandi_id, r.modal_price) for r in once.collect()} == {(1, 3.0), (2, 1.0)}
    assert once.exceptAll(upsert.upsert(once, new, schema.PRICE_KEY, ["seq"])).count() == 0


def test_raw_dedup(spark):
    ddl = "resource string, market string, state string, district string, commodity string, raw_variety string, raw_grade string, price_date date, modal_price double, min_price double, max_price double, batch_id string, seq int"
    row = lambda price, batch, seq: ("r1", "Badnawar", "MP", None, "Onion", "Local", "FAQ", DAY, price, 800.0, 1000.0, batch, seq)
    first = upsert.content_dedup(spark.createDataFrame([row(900.0, "a", 0), row(900.0, "a", 1)], ddl))
    assert first.head().times_seen == 2
    stored = first.drop("times_seen")
    second = upsert.content_dedup(spark.createDataFrame([row(900.0, "b", 0), row(910.0, "b", 1)], ddl)).drop("times_seen")
    after, flagged = upsert.merge_raw(stored, second)
    assert {(r.modal_price, r.first_seen_batch_id, r.last_seen_batch_id) for r in after.collect()} == {(900.0, "a", "b"), (910.0, "b", "b")}
    assert {(r.modal_price, r.is_new) for r in flagged.collect()} == {(900.0, False), (910.0, True)}


def test_quarantine(spark):
    rows = spark.createDataFrame([(1, 1, DAY, 1.0, 2.0), (1, 1, DAY, 3.0, 2.0), (None, 1, DAY, 1.0, 2.0), (1, 1, DAY, None, 2.0)], "mandi_id long, crop_id long, price_date date, min_price double, max_price double")
    good, bad = upsert.quarantine(rows, upsert.price_checks())
    assert good.count() == 2 and sorted(r.error_code for r in bad.collect()) == ["23502", "23514"]


def test_prefix_filtering_finds_all_pairs(spark):
    names = [f"{a} {b}" for a in ("red", "reds", "blue", "bluish", "") for b in ("gram", "gramm", "grain", "i.r. 64", "64")]
    frame = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    for t in (0.2, 0.4, 0.6):
        got = {(r.id_a, r.id_b): round(r.similarity, 9) for r in similar.duplicate_pairs(frame, t).collect()}
        from harvestry.functions.trigram import similarity

        a, b = frame.toDF("id_a", "a"), frame.toDF("id_b", "b")
        want = a.join(b, F.col("id_a") < F.col("id_b")).withColumn("s", similarity(F.col("a"), F.col("b"))).where(F.col("s") > t).collect()
        assert got == {(r.id_a, r.id_b): round(r.s, 9) for r in want}


def dims(spark):
    markets = spark.createDataFrame([(42, "s", "Guntur APMC", "guntur", "Andhra Pradesh", "Guntur", "ACTIVE", 1.0, 1.0), (43, "s", "Old", "oldtown", "Andhra Pradesh", "Guntur", "MERGED", 1.0, 1.0)], "id long, slug string, name string, normalized_name string, state string, district string, status string, latitude double, longitude double")
    crops = spark.createDataFrame([(10, "Tomato", "tomato", "ACTIVE"), (234, "Cow", "cow", "ACTIVE")], "id long, name string, normalized_name string, status string")
    aliases = "owner_id long, alias_name string, normalized_alias string, match_method string, match_confidence double, approved boolean"
    crop_aliases = spark.createDataFrame([(10, "Tamatar", "tamatar", "MANUAL", 1.0, True), (234, "x", "bovine", "FUZZY", 0.5, False)], aliases)
    districts = spark.createDataFrame([("Andhra Pradesh", "Gunturu", "Guntur")], schema.DISTRICT_ALIASES)
    return jobs.Dimensions(markets, crops, spark.createDataFrame([], aliases), crop_aliases, districts)


def record(**changes):
    base = {"commodity": "Tomato", "market": "Guntur APMC", "state": "Andhra Pradesh", "district": "Guntur", "variety": "FAQ", "grade": "Non-FAQ", "arrival_date": "15/07/2026", "modal_price": "2500", "min_price": "2000", "max_price": "3000"}
    return base | changes


def test_ingest(spark):
    records = [
        record(), {k.title(): v for k, v in record().items()}, record(commodity="Cow"), record(market="", commodity=""), record(commodity="tamatar", district="Gunturu", grade=""),
        record(market="Newtown Mandi"), record(market="Newtownn"), record(min_price="4000", variety="bad"), record(arrival_date="99/99/2026"), record(commodity="Bovine"),
    ]
    raw = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "seq int, record map<string,string>")
    empty = spark.createDataFrame([], schema.PRICES)
    done = jobs.ingest(raw, dims(spark), empty, "resource_2", "b1")
    got = {(r.mandi_id, r.crop_id, r.grade): r for r in done.prices.collect()}
    first = got[42, 10, "non-faq"]
    assert (first.price_date, first.modal_price, first.min_price, first.max_price, first.unit, first.quality_score) == (DAY, 25.0, 20.0, 30.0, "kg", 0.975)
    assert got[42, 234, "non-faq"].modal_price == 2500.0 and got[42, 234, "non-faq"].unit == "animal"
    assert (42, 10, "other") in got and (44, 10, "non-faq") in got and (42, 235, "non-faq") in got and len(got) == 5
    assert done.quarantine.count() == 1 and done.rejected.count() == 2
    assert jobs.counters(done).head().status == "PARTIAL"
    again = jobs.ingest(raw, dims(spark), done.prices.withColumn("source", F.lit("manual")), "resource_2", "b2")
    assert again.prices.count() == 0
    assert done.entries.count() == 7 and done.created.count() >= 2


def test_cache_of_merged_rows(spark):
    rows = [(1, 1, "a", "b", DAY - datetime.timedelta(days=k), float(p), s, o) for k, p, s, o in ((0, 10, "resource_2", None), (0, 99, "resource_1", 7), (2, 8, "resource_1", None), (8, 5, "resource_1", None))]
    got = jobs.refresh_cache(spark.createDataFrame(rows, "mandi_id long, crop_id long, variety string, grade string, price_date date, modal_price double, source string, source_mandi_id long")).head()
    assert (got.modal_price, got.change_1d, got.change_1d_pct, got.change_7d, got.change_1m) == (10.0, 2.0, 25.0, 5.0, None)


def test_merge_and_revert(spark):
    facts = spark.createDataFrame([(1, "x", 1.0, None), (2, "x", 1.0, None), (1, "y", 1.0, None), (2, "y", 2.0, None), (2, "z", 3.0, None), (3, "x", 1.0, None)], "mandi_id long, variety string, modal_price double, source_mandi_id long")
    pairs = spark.createDataFrame([(2, 1)], "loser long, survivor long")
    after, counts = merge.merge_markets(facts, pairs, ["mandi_id", "variety", "source_mandi_id"], ["modal_price"])
    n = counts.head()
    assert (n.deduped, n.kept_both, n.moved) == (1, 1, 1) and after.count() + n.deduped == facts.count()
    assert after.where("mandi_id = 2").count() == 0
    assert {(r.variety, r.modal_price) for r in merge.revert_market(after, 2).where("mandi_id = 2").collect()} == {("y", 2.0), ("z", 3.0)}
    chain = spark.createDataFrame([(4, 3), (3, 2), (2, 1)], "loser long, survivor long")
    assert {(r.loser, r.survivor) for r in merge.final_targets(chain).collect()} == {(4, 1), (3, 1), (2, 1)}


def test_mark_merged_is_idempotent_and_needs_an_active_target(spark):
    entities = spark.createDataFrame([(1, "a", "ACTIVE", None), (2, "b", "ACTIVE", None), (3, "c", "INACTIVE", None)], "id long, name string, status string, merged_into_id long")
    pairs = spark.createDataFrame([(2, 1), (1, 3)], "loser long, survivor long")
    once = merge.mark_merged(entities, pairs, "dup", "manual", 1.0)
    assert {r.id: (r.status, r.merged_into_id) for r in once.collect()} == {1: ("ACTIVE", None), 2: ("MERGED", 1), 3: ("INACTIVE", None)}
    assert once.exceptAll(merge.mark_merged(once, pairs, "dup", "manual", 1.0)).count() == 0
    aliases = spark.createDataFrame([(2, "bb", "bb", "X", 1.0, True)], schema.ALIASES)
    moved = merge.move_aliases(aliases, pairs.limit(1), entities.select("id", "name", F.col("name").alias("normalized_name")))
    assert {(r.owner_id, r.normalized_alias) for r in moved.collect()} == {(1, "bb"), (1, "b")}
    assert json.loads(merge.audit_events(pairs.limit(1), "mandi", "dup").head().details)["survivor"] == 1


def test_audit(spark):
    d = dims(spark)
    prices = spark.createDataFrame([(42, 10, "f", "g", DAY, None), (42, 10, "f", "g", DAY + datetime.timedelta(days=2), None)], "mandi_id long, crop_id long, variety string, grade string, price_date date, source_mandi_id long")
    now = F.lit(datetime.datetime(2026, 7, 20))
    backlog = spark.createDataFrame([("PENDING", datetime.datetime(2026, 7, 1)), ("PENDING", datetime.datetime(2026, 7, 19, 20))], "status string, created_at timestamp")
    alerts = spark.createDataFrame([], schema.ALERTS)
    found, coverage = audit.run_audit(d.markets, d.crops, prices, backlog, backlog, alerts, now, text.name_match)
    assert sorted(r.error_code for r in found.collect()) == ["AUDIT-002", "AUDIT-004", "AUDIT-005", "AUDIT-006"]
    assert tuple(coverage.head()) == (3, 2, 66.67)
    opened = found.withColumn("status", F.lit("OPEN"))
    assert audit.run_audit(d.markets, d.crops, prices, backlog, backlog, opened, now, text.name_match)[0].count() == 0
    assert "rows" in audit.render(spark.createDataFrame([(1, None)], "rows int, last string"))


def test_batches(spark):
    ts = lambda h: datetime.datetime(2026, 7, 20, h)
    runs = spark.createDataFrame([("a", "j", ts(1), None, "RUNNING"), ("b", "j", ts(9), None, "RUNNING"), ("c", "k", ts(1), ts(2), "FAILED")], "id string, job_name string, started_at timestamp, completed_at timestamp, status string")
    reaped = batches.reap_stale(runs, F.lit(ts(10)))
    assert {r.id: r.status for r in reaped.collect()} == {"a": "FAILED", "b": "RUNNING", "c": "FAILED"}
    assert not batches.may_start(reaped, "j") and batches.may_start(reaped, "k")
    assert not jobs.outage_alert(runs, "k", [F.desc("started_at")])
    assert jobs.market_today(datetime.datetime(2026, 7, 20, 19)) == datetime.date(2026, 7, 21)
    assert len(jobs.backfill_dates(DAY, DAY + datetime.timedelta(days=2), DAY + datetime.timedelta(days=3))) == 3 and len(jobs.rewrite_dates(DAY)) == 3
    with pytest.raises(ValueError):
        jobs.backfill_dates(DAY, DAY, DAY)


def test_feed_pages_until_a_short_one(spark, tmp_path):
    for state, pages in {"Goa": [2, 1], "Bihar": [2, 2], "Punjab": []}.items():
        (tmp_path / state).mkdir()
        for k, n in enumerate(pages):
            (tmp_path / state / f"{k}.json").write_text(json.dumps({"total": sum(pages) + (state == "Bihar"), "records": [record(market=f"{state}{k}{i}") for i in range(n)]}))
    rows = feed.read_feed(spark, path=str(tmp_path), pagesize=2, states="Goa\nBihar\nPunjab")
    report = {r.state: (r.captured, r.complete) for r in feed.page_report(rows).collect()}
    assert report == {"Goa": (3, True), "Bihar": (4, False)}
    calls = []

    def failing(state, page):
        calls.append(page)
        raise OSError("down")

    assert feed.fetch(failing, "Goa", 0, 2, 0.0) == (None, "OSError: down") and len(calls) == 3


def test_tables(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    rows = lambda *r: spark.createDataFrame([(k, d, v, 0) for k, d, v in r], "k long, d string, v double, seq int").select("k", "v", "seq", "d")
    for _ in range(2):
        tables.upsert_partitions(store, "prices", rows((1, "a", 1.0), (2, "b", 1.0)), ["k", "d"], ["seq"], "d")
        tables.upsert_partitions(store, "prices", rows((1, "a", 2.0), (3, "a", 3.0)), ["k", "d"], ["seq"], "d")
        assert sorted((r.k, r.v) for r in store.read("prices").collect()) == [(1, 2.0), (2, 1.0), (3, 3.0)]
    config = spark.createDataFrame([("page_size", "500"), ("ratio", "x")], "key string, value string")
    with pytest.raises(ValueError, match="ratio.*gone"):
        tables.typed_config(config, {"page_size": (int, 1, 1000), "ratio": (float, 0, 1), "gone": (int, 0, 1)})
    with pytest.raises(ValueError, match="x: int instead of bigint; y: missing"):
        schema.assert_schema(spark.createDataFrame([(1,)], "x int"), "x long, y string")


def test_serving_and_locations(spark):
    found = spark.createDataFrame([(1, 1.00001, 2.0, "HIGH", 1), (2, 1.00002, 2.0, "HIGH", 2), (3, None, None, "UNRESOLVED", 3)], "id long, lat double, lng double, confidence string, seq int")
    assert [r.confidence for r in serving.downgrade_collisions(found, "seq").orderBy("id").collect()] == ["HIGH", "REVIEW", "UNRESOLVED"]
    wanted = spark.createDataFrame([("g", "a"), ("g", "a"), ("g", "b")], "provider string, query string")
    assert [r.query for r in serving.cache_misses(wanted, wanted.limit(1)).collect()] == ["b"]


def test_precedence_stream(spark, tmp_path):
    for k, (source, price) in enumerate([("resource_2", 1.0), ("resource_1", 2.0), ("manual", 3.0)]):
        spark.createDataFrame([(1, source, price)], "k long, source string, price double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        from harvestry.functions.prices import source_rank

        stream = spark.readStream.schema("k long, source string, price double").parquet(str(tmp_path / "in"))
        got = ticks.precedence_stream(stream, str(tmp_path / "out"), ["k"], source_rank)
        assert [r.price for r in got.collect()] == [(1.0, 1.0, 3.0)[k]]


def test_resolve_creates_one_entity_for_names_alike(spark):
    keys = spark.createDataFrame([("newtown",), ("newtowns",), ("zzz",)], "key string")
    none = spark.createDataFrame([], "id long, key string")
    found = resolve.create_missing(resolve.resolve(keys, none, spark.createDataFrame([], schema.ALIASES), [], 0.5), [], 0.5, 100)
    got = {r.key: r.entity_id for r in found.collect()}
    assert got["newtown"] == got["newtowns"] == 100 and got["zzz"] == 101


def one_by_one(keys, threshold, score):
    """Entities of keys that come one after the other: the most similar earlier one above the threshold, or a new one."""
    made, owner = [], {}
    for key in sorted(keys):
        best = max(((score(key, m), -i) for i, m in enumerate(made)), default=(0, 0))
        if best[0] > threshold:
            owner[key] = -best[1]
        else:
            owner[key] = len(made)
            made.append(key)
    return owner


def test_creation_follows_the_order_of_keys(spark):
    from harvestry.functions.trigram import similarity

    rng = random.Random(4)
    words = ["carol", "echos", "fable", "gizmo", "delta", "bravo"]
    keys = sorted({" ".join(rng.sample(words, rng.randrange(2, 5))) for _ in range(40)} | {"carol echos fable gizmo", "delta bravo fable gizmo"})
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    pairs = frame.toDF("a").join(frame.toDF("b")).select("a", "b", similarity(F.col("a"), F.col("b")).alias("s")).collect()
    scores = {(r.a, r.b): r.s for r in pairs}
    none = spark.createDataFrame([], "id long, key string")
    found = resolve.create_missing(resolve.resolve(frame, none, spark.createDataFrame([], schema.ALIASES), [], 0.5), [], 0.5, 100)
    assert {r.key: r.entity_id - 100 for r in found.collect()} == one_by_one(keys, 0.5, lambda x, y: scores[x, y])
    made = resolve.created_entities(found, [], "s").collect()
    assert len(made) == len({r.entity_id for r in found.collect()}) == len({r.slug for r in made})


def test_side_outputs_of_resolution(spark):
    found = spark.createDataFrame([("aa", 1, "FUZZY", 0.7), ("bb", 2, "FUZZY", 0.6), ("cc", 3, "EXACT", None)], "key string, entity_id long, method string, similarity double")
    known = spark.createDataFrame([(9, "bb", "bb", "X", 1.0, True)], schema.ALIASES)
    assert [tuple(r) for r in resolve.fuzzy_aliases(found, known).collect()] == [(1, "aa", "aa", "FUZZY", 0.7, False)]
    entities = spark.createDataFrame([(1, None), (7, DAY)], "id long, last_seen_at date")
    later = DAY + datetime.timedelta(days=1)
    assert {r.id: r.last_seen_at for r in resolve.touch_last_seen(entities, found, F.lit(later)).collect()} == {1: later, 7: DAY}
    assert {(r.method, r.n) for r in resolve.method_counts(found).collect()} == {("FUZZY", 2), ("EXACT", 1)}
    aliases = spark.createDataFrame([("S", "Old", "New"), ("S", " Old", "New"), ("S", "Old", "Newer")], schema.DISTRICT_ALIASES)
    rows = spark.createDataFrame([("S", " Old "), ("T", "Old")], "state string, district string")
    assert sorted(tuple(r) for r in resolve.canonical_districts(rows, aliases).collect()) == [("S", "New"), ("T", "Old")]


def test_numbers_of_rows_with_any_columns(spark):
    rows = spark.createDataFrame([(k,) for k in "cab"], "__p string").withColumn("__part", F.lit(1)).withColumn("__n", F.lit(2))
    twice = staging.numbered(staging.numbered(rows, ["__p"], "x"), ["x"], "y", 10)
    assert sorted((r["__p"], r.x, r.y) for r in twice.collect()) == [("a", 1, 10), ("b", 2, 11), ("c", 3, 12)]


def test_losers_merge_one_after_the_other(spark):
    rng = random.Random(8)
    rows = sorted({(rng.randrange(6), rng.choice("xyz"), float(rng.randrange(3))) for _ in range(40)})
    rows = list({(m, v): (m, v, p) for m, v, p in rows}.values())
    pairs = [(1, 0), (2, 0), (4, 3)]
    want, counts = [(m, v, p, m if m in (0, 3) else None) for m, v, p in rows if m not in (1, 2, 4)], {}
    for loser, survivor in pairs:
        own = [(v, p) for m, v, p in rows if m == loser]
        there = [(v, p) for m, v, p, _ in want if m == survivor]
        counts[loser] = (sum(r in there for r in own), sum(r not in there and r[0] in {v for v, _ in there} for r in own))
        want += [(survivor, v, p, loser) for v, p in own if (v, p) not in there]
    facts = spark.createDataFrame([(m, v, p, None, None) for m, v, p in rows], "mandi_id long, variety string, modal_price double, source_mandi_id long, source_mandi_name string")
    names = spark.createDataFrame([(m, f"n{m}") for m in range(6)], "id long, name string")
    after, got = merge.merge_markets(facts, spark.createDataFrame(pairs, "loser long, survivor long"), ["mandi_id", "variety", "source_mandi_id"], ["modal_price"], names=names)
    assert sorted(map(str, want)) == sorted(str((r.mandi_id, r.variety, r.modal_price, r.source_mandi_id)) for r in after.collect())
    assert all((r.source_mandi_name == f"n{r.source_mandi_id}") == (r.source_mandi_id is not None) for r in after.collect())
    assert {r.loser: (r.deduped, r.kept_both) for r in got.collect() if r.loser in counts} == {k: v for k, v in counts.items() if any(m == k for m, _, _ in rows)}
    keyed = merge.rekey(spark.createDataFrame([(1, "x", 1), (2, "x", 2), (2, "y", 3), (0, "z", 4), (1, "z", 5)], "e long, k string, n int"), spark.createDataFrame(pairs, "loser long, survivor long"), "e", ["e", "k"])
    assert sorted((r.e, r.k, r.n) for r in keyed.collect()) == [(0, "x", 1), (0, "y", 3), (0, "z", 4)]


def test_rows_of_a_merge_are_dealt_by_their_number_and_sorted_once(spark, monkeypatch):
    monkeypatch.setattr(staging, "TASK_ROWS", 40, raising=False)
    rows = [(m, f"v{k}", float(k % 3 if m else 1), None) for m in range(4) for k in range(100)]  # market 3 stays aside
    facts = spark.createDataFrame(rows, "mandi_id long, variety string, modal_price double, source_mandi_id long")
    pairs = spark.createDataFrame([(1, 0), (2, 0)], "loser long, survivor long")
    after, counts = merge.merge_markets(facts, pairs, ["mandi_id", "variety", "source_mandi_id"], ["modal_price"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 2 and plan.count(" Sort [") == 1
    assert re.search(r"hashpartitioning\(survivor#\w+, variety#\w+, 8\)", plan)  # 300 rows, whatever the session's 4 partitions are
    assert sorted(tuple(r) for r in counts.collect()) == [(1, 0, 33, 67, 0), (2, 0, 100, 0, 0)]
    assert after.count() == 400 - 133 and after.where("mandi_id = 3 and source_mandi_id is null").count() == 100
    none = merge.merge_markets(facts.limit(0), pairs.limit(0), ["mandi_id", "variety", "source_mandi_id"], ["modal_price"])
    assert [d.count() for d in none] == [0, 0]


def test_merge_entity_cascades(spark):
    entity = "id long, {}normalized_name string, status string, merged_into_id long"
    crops = spark.createDataFrame([(1, "a", "ACTIVE", None), (2, "b", "ACTIVE", None)], entity.format(""))
    varieties = spark.createDataFrame([(10, 1, "v", "ACTIVE", None), (20, 2, "v", "ACTIVE", None), (21, 2, "w", "ACTIVE", None)], entity.format("crop_id long, "))
    grades = spark.createDataFrame([(100, 10, "g", "ACTIVE", None), (200, 20, "g", "ACTIVE", None), (201, 20, "h", "ACTIVE", None)], entity.format("variety_id long, "))
    prices = spark.createDataFrame([(1, 10, 100, 5.0), (2, 20, 200, 6.0), (2, 20, 201, 7.0), (2, 21, None, 8.0)], "crop_id long, variety_id long, grade_id long, modal_price double")
    pairs = spark.createDataFrame([(2, 1)], "loser long, survivor long")
    tables = {"crops": crops, "varieties": varieties, "grades": grades, "prices": prices}
    out = merge.merge_entity("crop", pairs, tables, ["crop_id", "variety_id", "grade_id"], "dup")
    assert {(r.id, r.status, r.merged_into_id) for r in out["crops"].collect()} == {(1, "ACTIVE", None), (2, "MERGED", 1)}
    assert {(r.id, r.crop_id, r.status) for r in out["varieties"].collect()} == {(10, 1, "ACTIVE"), (20, 2, "MERGED"), (21, 1, "ACTIVE")}
    assert {(r.id, r.variety_id, r.status) for r in out["grades"].collect()} == {(100, 10, "ACTIVE"), (200, 20, "MERGED"), (201, 10, "ACTIVE")}
    assert sorted(map(str, (tuple(r) for r in out["prices"].collect()))) == sorted(map(str, [(1, 10, 100, 5.0), (1, 10, 201, 7.0), (1, 21, None, 8.0)]))
    assert out["audit_log"].count() == 1
    again = merge.merge_entity("crop", pairs, tables | {k: out[k] for k in ("crops", "varieties", "grades", "prices")}, ["crop_id", "variety_id", "grade_id"], "dup")
    assert again["prices"].exceptAll(out["prices"]).count() == 0 and again["audit_log"].count() == 0


def test_batches_open_and_close(spark):
    now = F.lit(datetime.datetime(2026, 7, 20, 10))
    none = spark.createDataFrame([], schema.BATCHES)
    runs = batches.opened(none, "b1", "j", "r", now)
    with pytest.raises(ValueError, match="running"):
        batches.opened(runs, "b2", "j", "r", now)
    assert batches.closed(runs, "b1", 5, 1, now).head().status == "PARTIAL" and batches.closed(runs, "b1", 5, 0, now).head().status == "SUCCESS"
    calls = spark.createDataFrame([("SUCCESS", None), ("FAILURE", "X"), ("FAILURE", " "), ("FAILURE", None), ("odd", "X")], "status string, error_code string")
    assert [d.count() for d in batches.call_log(calls)] == [2, 3]
    pages = spark.createDataFrame([("r", "Goa", 2, "down", 3, 9), ("r", "Goa", 1, None, 5, 9)], "resource string, state string, page int, error string, rows int, total int")
    assert batches.failed_pages(pages, "b1", now).head().error_message == "[state=Goa] down"
    assert tuple(batches.coverage_report(pages, "b1").head())[1:] == ("Goa", 8, 9, 1)
    log = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    assert batches.append_only(log, log.unionByName(log.limit(1))).count() == 3
    with pytest.raises(ValueError, match="append-only"):
        batches.append_only(log, log.withColumn("x", F.lit("a")))
    ids = [jobs.batch_name(datetime.datetime(2026, 7, 20, h)) for h in (1, 2)]
    assert ids == sorted(ids) and len(ids[0]) == 32


def test_retry_rewrite_and_backfill(spark):
    at = datetime.datetime(2026, 7, 16)
    pages = spark.createDataFrame([(1, "b1", "PENDING", None, "[state=Goa] down", at), (2, "b1", "PENDING", None, "[state=Goa] down", at), (3, "b9", "PENDING", None, "[state=Goa] x", at), (4, "b1", "PENDING", None, "no tag", at)], "id long, batch_id string, status string, state string, error_message string, created_at timestamp")
    runs = spark.createDataFrame([("b1", "historical_backfill", "SUCCESS", DAY)], "id string, job_name string, status string, date_range_start date")

    def fetch(plan):
        assert [r.id for r in plan.orderBy("id").collect()] == [1, 2] and plan.head().target_date == DAY
        return spark.createDataFrame([(1, None, 0, record()), (1, None, 1, record(market="Newtown")), (2, "down", 2, None)], "page_id long, error string, seq int, record map<string,string>")

    empty = spark.createDataFrame([], schema.PRICES)
    got = jobs.retry_failed(pages, runs, fetch, dims(spark), empty, "resource_2", "b2")
    assert got.done.prices.count() == 2 and {r.id: r.status for r in got.pages.collect()} == {1: "RESOLVED", 2: "PENDING", 3: "PENDING", 4: "PENDING"}
    assert {r.outcome: r.n for r in got.counts.collect()} == {"resolved": 1, "pending": 1, "skipped": 2}
    asked = []

    def read(dates):
        asked.append(dates)
        records = [record(), record(arrival_date="14/07/2026"), record(arrival_date="13/07/2026", min_price="9999"), record(arrival_date="01/07/2026")]
        return spark.createDataFrame(list(enumerate(records)), "seq int, record map<string,string>")

    done, tally = jobs.daily_rewrite(read, DAY, dims(spark), empty, "resource_2", "b3")
    assert {(str(r.price_date), r.outcome, r.n) for r in tally.collect()} == {("2026-07-15", "STORED", 1), ("2026-07-14", "STORED", 1), ("2026-07-13", "FAILED", 1)}
    kinds = "id long, {} long, normalized_name string, status string"
    full = dataclasses.replace(dims(spark), varieties=spark.createDataFrame([(5, 10, "faq", "ACTIVE")], kinds.format("crop_id")), grades=spark.createDataFrame([], kinds.format("variety_id")))
    done, _ = jobs.historical_backfill(read, DAY - datetime.timedelta(days=1), DAY, DAY + datetime.timedelta(days=1), runs, full, empty, "resource_2", "b4")
    assert asked[-1] == [DAY - datetime.timedelta(days=1)]
    assert [(r.variety_id, r.grade_id, r.parser_version) for r in done.prices.collect()] == [(5, 1, 1)]
    with pytest.raises(ValueError, match="x: missing"):
        jobs.startup(spark.createDataFrame([], "key string, value string"), {}, {"t": (pages, "x long")})


def test_sync_and_caches(spark, tmp_path):
    rows = lambda ddl, *r: spark.createDataFrame(list(r), ddl)
    tables = {
        "crops": rows("id long, status string", (1, "ACTIVE"), (2, "MERGED")), "markets": rows("id long, status string", (7, "ACTIVE")), "varieties": rows("id long, crop_id long", (3, 1), (4, 2)),
        "grades": rows("id long, variety_id long", (5, 3), (6, 4)), "price_cache": rows("mandi_id long, crop_id long, variety_id long", (7, 1, 3), (7, 2, 4), (8, 1, 3)),
    }
    store = Versions(spark, str(tmp_path))
    for _ in range(2):
        drops = serving.sync(store, tables)
        assert {r.table: (r.kept, r.dropped) for r in drops.collect()} == {"crops": (1, 1), "markets": (1, 0), "varieties": (1, 1), "grades": (1, 1), "price_cache": (1, 2)}
        assert store.read("price_cache").count() == 1
    serving.sync(store, tables | {"crops": rows("id long, status string", (9, "ACTIVE"))})
    assert sorted(r.id for r in store.read("crops").collect()) == [1, 9] and store.read("price_cache").count() == 0
    cache = rows("provider string, query string, response string", ("g", "a", "old"))
    searched = rows("provider string, query string, status string, response string", ("g", "a", "OK", "new"), ("g", "b", "ZERO_RESULTS", None), ("g", "c", "OVER_LIMIT", "x"))
    assert {(r.query, r.response) for r in serving.write_through(cache, searched).collect()} == {("a", "new"), ("b", "[]")}
    markets = rows("id long, name string, ref_lat double, ref_lng double", (1, "Lakeside Market", 10.0, 70.0), (2, "Plain", 10.0, 70.0), (3, "Farville Mandi", 10.0, 70.0))
    towns = rows("market_id long, ord int, name string, lat double, lng double, place_types array<string>", (1, 0, "Lakeside", 10.1, 70.0, ["market"]), (1, 1, "Lakeside", 10.1, 70.1, ["locality"]), (2, 0, "Plain", 10.0, 70.0, ["locality"]), (3, 0, "Farville", 20.0, 70.0, ["locality"]))
    assert [(r.market_id, r.lng, r.confidence) for r in serving.town_fallback(markets, towns).collect()] == [(1, 70.1, "REVIEW")]
    parts = rows("c array<struct<long_name:string,short_name:string,types:array<string>>>", ([("Lake Side", "L.S.", ["locality"]), ("District", "D", ["country"])],))
    got = parts.select(geo.query_tokens(F.lit("Lake Side APMC of X, Far, India")), geo.locality_tokens(F.col("c")), geo.locality_names(F.col("c")), geo.village_precise(F.lit(False), F.col("c")[0]["types"])).head()
    assert tuple(got) == (["lake", "side"], ["lakeside", "ls"], ["Lake Side"], True)
    asked = parts.select(terms.geocoder_queries(F.lit("Lakeside Sub Yard"), F.lit("Far"), F.lit("Goa"))).head()[0]
    assert asked == ["Lakeside Sub Yard, Far, Goa, India", "Lakeside Sub Yard mandi, Far, Goa, India", "Lakeside Sub Yard market, Far, Goa, India", "Lakeside Sub Yard, Goa, India", "Lakeside, Far, Goa, India", "Lakeside, Goa, India"]


def test_archive_drops_only_what_it_has_verified(spark, tmp_path, monkeypatch):
    store, cold = Versions(spark, str(tmp_path / "hot")), Versions(spark, str(tmp_path / "cold"))
    rows = spark.range(60).select("id", (F.col("id") / 2).alias("price"), F.date_add(F.lit(DAY), (F.col("id") % 6).cast("int")).alias("price_date"))
    store.commit(parts={"prices": (rows, "price_date")})
    write = Versions._written

    def damaged(self, table, frame, part):
        return write(self, table, frame.withColumn("price", F.when(F.col("id") == 1, 0.0).otherwise(F.col("price"))) if self is cold and table == "prices" else frame, part)

    monkeypatch.setattr(Versions, "_written", damaged)
    log = {r.part: (r.n, r.verified) for r in serving.archive(store, "prices", "price_date", 3, cold, "r1").collect()}
    days = [str(DAY + datetime.timedelta(days=k)) for k in range(6)]
    assert log == {days[0]: (10, True), days[1]: (10, False), days[2]: (10, True)} and store.parts("prices") == [days[1], *days[3:]]
    monkeypatch.undo()
    assert {r.part: r.verified for r in serving.archive(store, "prices", "price_date", 3, cold, "r2").collect()} == {days[1]: True}
    both = cold.read("prices").unionByName(store.read("prices"))
    assert store.parts("prices") == days[3:] and both.exceptAll(rows).count() == rows.exceptAll(both).count() == 0
    assert sorted((r.run_id, r.verified) for r in cold.read("archive_log").collect()) == [("r1", False), ("r1", True), ("r1", True), ("r2", True)]
