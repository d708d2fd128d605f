import datetime

from pyspark.sql import functions as F

from harvestry import schema
from harvestry.functions.trigram import gram_codes, overlap, similarity
from harvestry.operators import audit, pairs, serving
from harvestry.plans import runs
from harvestry.sources import tables

NOW = datetime.datetime(2026, 7, 20, 12)


def test_pairs_by_blocks(spark):
    rows = [(i, f"n{i % 7}", 0.0 if i % 2 else float(i % 5), 0.0) for i in range(60)]
    frame = spark.createDataFrame(rows, "id long, name string, lat double, lng double")
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[2:] == b[2:])
    for block in (1, 3, 7, 1000):
        got = pairs.pairs_within(frame, ["lat", "lng"], "id", block=block)
        assert sorted((r.a.id, r.b.id) for r in got.collect()) == want
    found = audit.coordinate_collisions(frame, similarity, 0.3, block=5).collect()
    assert sorted((r.id_a, r.id_b) for r in found) == [(a, b) for a, b in want if a % 7 != b % 7]


def test_a_hot_place_is_spread(spark):
    rows = spark.range(4000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("lat"), F.lit(0.0).alias("lng"))
    met = pairs.pairs_within(rows, ["lat", "lng"], "id", block=125)
    assert met.count() == 2000 * 1999 // 2
    # the pairs of the hot place by pairs of blocks: 16 blocks, none with much more than its share
    own = F.pmod(F.xxhash64("id"), F.lit(16))
    sizes = [r["count"] for r in rows.where("lat = 0").groupBy(own).count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * 125


def test_names_are_taken_apart_once_and_few_rows_spread(spark):
    """trigrams were made for every pair, all in one task."""
    rows = spark.range(300).select("id", F.concat(F.lit("Näme 𝒳"), F.pmod(F.xxhash64("id"), F.lit(97))).alias("name"), (F.col("id") % 12).cast("double").alias("lat"), F.lit(0.0).alias("lng"))
    plain = audit.coordinate_collisions(rows, similarity, 0.8)
    once = audit.coordinate_collisions(rows, overlap, 0.8, of=gram_codes)
    key = lambda d: sorted((r.id_a, r.id_b, r.score) for r in d.collect())
    assert key(once) == key(plain) and key(once)
    assert once.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_geocoder_run(spark):
    markets = spark.createDataFrame(
        [(1, "Lakeside Market", "Far", "Goa", "ACTIVE", None, None, None, 10.0, 70.0), (2, "Known", "Far", "Goa", "ACTIVE", 1.0, 1.0, "HIGH", None, None), (3, "Plain Mandi", "Far", "Goa", "ACTIVE", None, None, None, 10.0, 70.0)],
        "id long, name string, district string, state string, status string, latitude double, longitude double, location_confidence string, ref_lat double, ref_lng double",
    )
    cache = spark.createDataFrame([], "provider string, query string, response string")
    asked = []

    def search(wanted):
        rows = sorted(tuple(r) for r in wanted.collect())
        asked.append(len(rows))
        answer = lambda q: '[{"ord":0,"name":"Lakeside Market","lat":10.01,"lng":70.01,"place_types":["market"],"formatted_address":"Lakeside, Far, Goa"}]' if "Lakeside" in q else None
        return spark.createDataFrame([(p, q, "OK" if answer(q) else "ZERO_RESULTS", answer(q)) for p, q in rows], "provider string, query string, status string, response string")

    makers = {"g": lambda n, d, s: F.array(F.concat(n, F.lit(", "), d)), "o": lambda n, d, s: F.array(n, F.concat(n, F.lit(", "), s))}
    out = serving.geocode(markets, cache, search, makers, "places", F.lit(NOW), match=similarity)
    got = {r.id: (r.latitude, r.location_confidence) for r in out["markets"].collect()}
    assert got[1][0] == 10.01 and got[1][1] in ("HIGH", "MEDIUM") and got[2] == (1.0, "HIGH") and got[3] == (None, None)
    assert [(r.entity_id, r.event_type) for r in out["audit_log"].collect()] == [(1, "location_geocoded")] and out["search_cache"].count() == 6
    again = serving.geocode(out["markets"], out["search_cache"], search, makers, "places", F.lit(NOW), match=similarity)
    assert asked == [6, 0] and again["audit_log"].count() == 0


def test_config_rules_and_dashboard(spark):
    config = spark.createDataFrame([("merge", "0.5"), ("fuzzy", "0.6")], "key string, value string")
    spec = {"merge": (float, 0, 1), "fuzzy": (float, 0, 1)}
    assert tables.typed_config(config, spec) == {"merge": 0.5, "fuzzy": 0.6}
    try:
        tables.typed_config(config, spec, [("merge", "fuzzy")])
        raise AssertionError
    except ValueError as e:
        assert "merge: 0.5 is below fuzzy" in str(e)
    at = lambda h: NOW - datetime.timedelta(hours=h)
    batches = spark.createDataFrame([("a", "live_tick", "r", at(1), at(0), "SUCCESS", 5, 0), ("b", "live_tick", "r", at(30), at(29), "FAILED", 0, 1), ("c", "daily_rewrite", "r", at(300), at(299), "FAILED", 0, 1)], schema.BATCHES)
    none = lambda ddl: spark.createDataFrame([], ddl)
    coverage = spark.createDataFrame([("a", "Goa", 3, 4, 1)], runs.COVERAGE)
    row = audit.dashboard({"batches": batches, "raw_entries": none("x int"), "failed_pages": none(runs.PAGES), "issues": none(runs.ISSUES), "alerts": none(schema.ALERTS), "coverage": coverage, "markets": none("id long")}, F.lit(NOW)).head()
    assert (row.last_tick.status, row.last_rewrite.status, row.rows_today, row.success_pct_7d, row.failure_pct_7d, row.coverage_pct, row.retry_queue) == ("SUCCESS", "FAILED", 5, 50.0, 50.0, 75.0, 0)
