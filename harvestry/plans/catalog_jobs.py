"""Further queries over the driver's tables: jobs, streams, kept-up tables and functions, each with DuckDB SQL."""

from __future__ import annotations

import dataclasses
import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry import schema
from harvestry.functions import geo, prices, terms, text
from harvestry.operators import latest, merge, resolve, serving, similar
from harvestry.plans import jobs, runs
from harvestry.plans.catalog import _CACHE_SQL, _FACTS_SQL, _NAMES_SQL, _merged, _names, _similar, observations, query
from harvestry.sources import feed
from harvestry.sources.staging import numbered, spread, staged
from harvestry.sources.tables import load, parse_records
from harvestry.sources.versions import Versions
from harvestry.streaming import ticks

NOW = datetime.datetime(2026, 1, 1)
#: Records of a page of the feed made of events.
PAGE = 500


def _event_dims(events: DataFrame) -> jobs.Dimensions:
    """A market per user and type of event (its state), a crop per remainder of k."""
    spark = events.sparkSession
    markets = events.select("user_id", "event_type").distinct().select(
        (F.col("user_id") * 1000 + F.ascii("event_type")).alias("id"), F.concat(F.lit("user "), "user_id").alias("name"), F.concat(F.lit("user "), "user_id").alias("normalized_name"),
        F.col("event_type").alias("state"), F.lit("").alias("district"), F.lit("ACTIVE").alias("status"), F.lit(None).cast("timestamp").alias("last_seen_at"),
    )
    crops = spark.range(1, 11).select("id", F.concat(F.lit("crop "), "id").alias("name"), F.concat(F.lit("crop "), "id").alias("normalized_name"), F.lit("ACTIVE").alias("status"))
    none = spark.createDataFrame([], schema.ALIASES)
    return jobs.Dimensions(markets, crops, none, none, spark.createDataFrame([], schema.DISTRICT_ALIASES))


def _event_record() -> Column:
    return F.struct(
        F.concat(F.lit("User "), "user_id").alias("market"), F.col("event_type").alias("state"), F.lit("").alias("district"), F.concat(F.lit("Crop "), F.get_json_object("props", "$.k").cast("long") % 10 + 1).alias("commodity"),
        F.concat(F.lit("v"), F.col("event_id") % 3).alias("variety"), F.lit("").alias("grade"), F.date_format("ts", "dd/MM/yyyy").alias("arrival_date"), F.col("value").cast("string").alias("modal_price"),
    )


def _event_rows(events: DataFrame) -> DataFrame:
    """seq, event_type, page, record: events as records of a feed, each on a page of its type's."""
    record = F.from_json(F.to_json(_event_record()), "map<string,string>")
    return spread(events).select(F.col("event_id").alias("seq"), "event_type", F.floor(F.col("event_id") / PAGE).cast("int").alias("page"), "ts", record.alias("record"))


def _event_pages(events: DataFrame) -> DataFrame:
    """state, page, body: events as records of a paged feed, in the order of their ids."""
    placed = staged(numbered(events, ["event_type", "event_id"], "no"), "placed")  # types are few, so none is numbered in one task
    starts = placed.groupBy(F.col("event_type").alias("type")).agg(F.min("no").alias("start"))
    placed = placed.join(starts, F.col("event_type").eqNullSafe(F.col("type"))).withColumn("place", F.col("no") - F.col("start")).withColumn("record", _event_record())
    pages = placed.groupBy(F.col("event_type").alias("state"), F.floor(F.col("place") / PAGE).cast("int").alias("page"))
    rows = pages.agg(F.array_sort(F.collect_list(F.struct("place", "record"))).alias("rows"))  # a page has PAGE records
    return rows.select("state", "page", F.to_json(F.struct(F.size("rows").alias("total"), F.col("rows.record").alias("records"))).alias("body"))


@query("""SELECT user_id * 1000 + ascii(event_type) AS mandi_id, k AS crop_id, variety, price_date, value / 100 AS modal_price FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, k, variety, price_date ORDER BY event_id DESC) AS n FROM (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS k, 'v' || CAST(event_id % 3 AS VARCHAR) AS variety, CAST(ts AS DATE) AS price_date FROM events)) WHERE n = 1""")
def q61_feed_ticks(spark, sf_dir):
    """Two ticks over a feed of pages: those of its first half, then what has come since."""
    events = load(spark, sf_dir, "events")
    folder = ticks.new_folder(spark, "ticks")
    store, pages = Versions(spark, f"{folder}/store"), staged(_event_pages(events), "pages")
    runs.setup(store, _event_dims(events))
    states = "\n".join(r[0] for r in pages.select("state").distinct().orderBy("state").collect())  # the feed's states, as many as types of events
    half = pages.agg(F.max("page")).head()[0] // 2
    for part in (pages.where(F.col("page") <= half), pages.where(F.col("page") > half)):
        feed.write_pages(part, f"{folder}/pages")
        ticks.tick(feed.stream_feed(spark, path=f"{folder}/pages", states=states, delay=0), store, f"{folder}/checkpoint", lambda: NOW)
    return store.read("prices").select("mandi_id", "crop_id", "variety", "price_date", "modal_price")


@query("""SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS times FROM events GROUP BY ALL""")
def q62_first_last_seen(spark, sf_dir):
    folder = ticks.new_folder(spark, "seen")
    load(spark, sf_dir, "events").select("user_id", "event_type", "ts").repartition(4, "event_type").write.parquet(f"{folder}/in")
    return ticks.dedup(ticks.source_of(spark, f"{folder}/in", files=1), f"{folder}/sink", ["user_id", "event_type"], "ts")


@query(_CACHE_SQL)
def q63_cache_by_deltas(spark, sf_dir):
    """The cache of q01 kept up over the last forty days, ten days at a time."""
    keys, rows = ["item", "variety", "grade"], staged(observations(spark, sf_dir), "observations")
    newest = latest.newest_date(rows)
    before = newest - datetime.timedelta(days=40)
    cache = staged(latest.price_cache(rows.where(F.col("price_date") <= before), keys), "cache")
    before = latest.newest_date(rows.where(F.col("price_date") <= before))
    for step in range(30, -1, -10):
        upto = newest - datetime.timedelta(days=step)
        so_far = rows.where(F.col("price_date") <= upto)
        days = [r[0] for r in so_far.where(F.col("price_date") > before).select("price_date").distinct().collect()]  # ten at most
        if days:
            cache = staged(latest.maintained(cache, lambda dates: so_far.where(F.col("price_date").isin(dates)), keys, days, before), "cache")  # noqa: B023
            before = max(days)
    return cache


@query(f"""WITH {_NAMES_SQL} SELECT a.id AS id_a, b.id AS id_b, round({_similar('a.name', 'b.name')}, 4) AS similarity FROM names a JOIN names b ON a.id < b.id WHERE {_similar('a.name', 'b.name')} > 0.5""")
def q64_sweep_increments(spark, sf_dir):
    """Names come in three lots; each is compared with those before and in itself."""
    names = _names(spark, sf_dir)
    index = similar.SweepIndex(Versions(spark, ticks.new_folder(spark, "sweep")), 0.5)
    found = [index.add(names.where(F.col("id") % 3 == k)) for k in range(3)]
    return found[0].unionByName(found[1]).unionByName(found[2]).withColumn("similarity", F.round("similarity", 4))


@query("""WITH b AS (SELECT DISTINCT p_partkey AS id, md5(CAST(p_partkey AS VARCHAR)) AS base FROM part),
asked AS (SELECT base AS key, base, id FROM b UNION ALL SELECT base || 's', base, id FROM b WHERE id % 3 = 0),
made AS (SELECT base, (SELECT max(id) FROM b WHERE id % 5 = 0) + row_number() OVER (ORDER BY base) AS new_id FROM b WHERE id % 5 <> 0)
SELECT key, CASE WHEN a.id % 5 = 0 THEN a.id ELSE new_id END AS entity_id, CASE WHEN a.id % 5 <> 0 THEN 'CREATED' WHEN key = a.base THEN 'EXACT' ELSE 'FUZZY' END AS method FROM asked a LEFT JOIN made m ON m.base = a.base""")
def q65_create_missing(spark, sf_dir):
    """Hashes as names: a third also with an s, which joins the name it resembles, known or created before."""
    base = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")).distinct().withColumn("base", F.md5(F.col("id").cast("string")))
    asked = base.select(F.col("base").alias("key")).unionByName(base.where("id % 3 = 0").select(F.concat("base", F.lit("s")).alias("key")))
    known = base.where("id % 5 = 0").select("id", F.col("base").alias("key"))
    found = resolve.resolve(asked, known, spark.createDataFrame([], schema.ALIASES), [], 0.6)
    made = resolve.create_missing(found, [], 0.6, known.agg(F.coalesce(F.max("id"), F.lit(0))).head()[0] + 1)
    return made.select("key", "entity_id", "method")


_RAW = "CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN '  ' || p_type || '   ' || p_brand ELSE upper(p_name) || '  Kg ' END"


@query(f"""WITH r AS (SELECT p_partkey, p_name, {_RAW} AS raw FROM part)
SELECT p_partkey, CASE WHEN trim(coalesce(raw, '')) = '' THEN 'other' ELSE regexp_replace(trim(lower(raw)), '\\s+', ' ', 'g') END AS kind, lower(trim(coalesce(raw, ''))) AS unit,
  trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 6) AS slug FROM r""")
def q66_kinds_units_slugs(spark, sf_dir):
    rows = load(spark, sf_dir, "part").withColumn("raw", F.expr(_RAW))
    return rows.select("p_partkey", text.normalize_kind("raw").alias("kind"), text.normalize_unit("raw").alias("unit"), text.slug_with_suffix("p_name", "p_partkey").alias("slug"))


@query("""SELECT DISTINCT l_partkey, l_suppkey, sha256('{"max_price":' || p(l_extendedprice) || ',"min_price":' || p(l_quantity) || ',"modal_price":' || p(CASE WHEN l_quantity <= 45 THEN l_tax END) || '}') AS content_hash FROM lineitem"""
       .replace("p(l_extendedprice)", "CAST(CAST(l_extendedprice AS DECIMAL(18,4)) AS VARCHAR)").replace("p(l_quantity)", "CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR)")
       .replace("p(CASE WHEN l_quantity <= 45 THEN l_tax END)", "coalesce(CAST(CAST(CASE WHEN l_quantity <= 45 THEN l_tax END AS DECIMAL(18,4)) AS VARCHAR), 'null')"))
def q67_content_hash(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem")
    digest = prices.content_hash(F.when(F.col("l_quantity") <= 45, F.col("l_tax")), F.col("l_quantity"), F.col("l_extendedprice"))
    return rows.select("l_partkey", "l_suppkey", digest.alias("content_hash")).distinct()


_SUFFIXES = ", ".join("'" + s.replace("'", "''") + "'" for s in text.PLACE_SUFFIXES)
_MARKET_NAME = f"n_name || list_extract([{_SUFFIXES}], CAST(s_suppkey % {len(text.PLACE_SUFFIXES)} AS INT) + 1) || CASE WHEN s_suppkey % 3 = 0 THEN ' (Old)' ELSE '' END"
_PLACE = f"trim(split_part(list_reduce(list_concat([trim(name)], [{_SUFFIXES}]), lambda x, s: CASE WHEN ends_with(lower(x), s) THEN trim(left(x, length(x) - length(s))) ELSE x END), '(', 1))"


def _market_names(spark, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    suffix = F.get(F.array(*map(F.lit, text.PLACE_SUFFIXES)), (F.col("s_suppkey") % len(text.PLACE_SUFFIXES)).cast("int"))
    name = F.concat("n_name", suffix, F.when(F.col("s_suppkey") % 3 == 0, " (Old)").otherwise(""))
    return rows.select("s_suppkey", name.alias("name"), F.when(F.col("s_suppkey") % 4 != 0, F.concat(F.lit("D"), "s_nationkey")).alias("district"), F.col("n_name").alias("state"))


@query(f"""SELECT s_suppkey, {_PLACE} AS place FROM (SELECT s_suppkey, {_MARKET_NAME} AS name FROM supplier JOIN nation ON n_nationkey = s_nationkey)""")
def q68_place_names(spark, sf_dir):
    return _market_names(spark, sf_dir).select("s_suppkey", text.place_name(F.col("name")).alias("place"))


@query(f"""WITH m AS (SELECT s_suppkey, {_MARKET_NAME} AS name, CASE WHEN s_suppkey % 4 <> 0 THEN 'D' || CAST(s_nationkey AS VARCHAR) END AS district, n_name AS state FROM supplier JOIN nation ON n_nationkey = s_nationkey),
p AS (SELECT *, {_PLACE} AS place, ', ' || coalesce(district, '') || ', ' || state || ', India' AS near, ', ' || state || ', India' AS wide, NOT contains(lower(name), 'mandi') AND NOT contains(lower(name), 'market') AS bare FROM m),
q AS (SELECT s_suppkey, list_filter([name || near, CASE WHEN bare THEN name || ' mandi' || near END, CASE WHEN bare THEN name || ' market' || near END, CASE WHEN coalesce(district, '') <> '' THEN name || wide END,
  CASE WHEN place <> '' AND lower(place) <> lower(name) THEN place || near END, CASE WHEN place <> '' AND lower(place) <> lower(name) THEN place || wide END], lambda x: x IS NOT NULL) AS qs FROM p)
SELECT s_suppkey, CAST(unnest(range(len(qs))) AS INT) AS ord, unnest(qs) AS query FROM q""")
def q69_geocoder_queries(spark, sf_dir):
    found = terms.geocoder_queries(F.col("name"), F.col("district"), F.col("state"))
    return _market_names(spark, sf_dir).select("s_suppkey", F.posexplode(found).alias("ord", "query"))


@query("""WITH c AS (SELECT p_partkey, p_name, p_size, CASE p_size % 3 WHEN 0 THEN ['locality', 'political'] WHEN 1 THEN ['country', 'political'] ELSE ['village'] END AS types, p_size % 5 = 0 AS partial, (p_size % 10) / 10.0 AS score FROM part)
SELECT p_partkey, NOT partial AND list_has_any(types, ['locality', 'village']) AND score >= 0.3 AS precise, NOT partial AND list_has_any(types, ['locality', 'village']) AS village_precise,
  CASE WHEN list_has_any(types, ['locality', 'village']) THEN list_distinct([regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g'), regexp_replace(lower(left(p_name, 4)), '[^a-z0-9]', '', 'g')]) ELSE [] END AS tokens_found FROM c""".replace("AS tokens_found", "AS t")
       .replace("SELECT p_partkey, NOT", "SELECT p_partkey, array_to_string(list_sort(t), ' ') AS tokens, precise, village_precise FROM (SELECT p_partkey, NOT") + ")")
def q70_precise_results(spark, sf_dir):
    size = F.col("p_size") % 3
    types = F.when(size == 0, F.array(F.lit("locality"), F.lit("political"))).when(size == 1, F.array(F.lit("country"), F.lit("political"))).otherwise(F.array(F.lit("village")))
    rows = load(spark, sf_dir, "part").withColumns({"types": types, "partial": F.col("p_size") % 5 == 0})
    names = F.array(F.struct(F.col("p_name").alias("long_name"), F.left("p_name", F.lit(4)).alias("short_name"), F.col("types").alias("types")))
    return rows.select(
        "p_partkey", F.array_join(F.array_sort(geo.locality_tokens(names)), " ").alias("tokens"),
        geo.precise_enough(F.col("partial"), F.col("types"), F.col("p_size") % 10 / 10.0).alias("precise"), geo.village_precise(F.col("partial"), F.col("types")).alias("village_precise"),
    )


@query("""WITH cache AS (SELECT 'p' || CAST(s_suppkey % 2 AS VARCHAR) AS provider, CAST(s_suppkey AS VARCHAR) AS query, 'old' AS response FROM supplier WHERE s_suppkey % 3 = 0),
searched AS (SELECT 'p' || CAST(s_suppkey % 2 AS VARCHAR) AS provider, CAST(s_suppkey AS VARCHAR) AS query, CASE WHEN s_suppkey % 5 > 1 THEN 'new' END AS response, CASE s_suppkey % 5 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'ZERO_RESULTS' ELSE 'OK' END AS status FROM supplier WHERE s_suppkey % 2 = 0),
kept AS (SELECT provider, query, coalesce(response, '[]') AS response FROM searched WHERE status <> 'ERROR'),
after AS (SELECT * FROM kept UNION ALL SELECT * FROM cache WHERE query NOT IN (SELECT query FROM kept))
SELECT 'p' || CAST(s_suppkey % 2 AS VARCHAR) AS provider, CAST(s_suppkey AS VARCHAR) AS query, 'MISS' AS response FROM supplier WHERE CAST(s_suppkey AS VARCHAR) NOT IN (SELECT query FROM after) UNION ALL SELECT * FROM after""")
def q71_search_cache(spark, sf_dir):
    rows = load(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("p"), F.col("s_suppkey") % 2).alias("provider"), F.col("s_suppkey").cast("string").alias("query"))
    kind = F.col("s_suppkey") % 5
    cache = rows.where("s_suppkey % 3 = 0").select("provider", "query", F.lit("old").alias("response"))
    searched = rows.where("s_suppkey % 2 = 0").select("provider", "query", F.when(kind > 1, "new").alias("response"), F.when(kind == 0, "ERROR").when(kind == 1, "ZERO_RESULTS").otherwise("OK").alias("status"))
    after = serving.write_through(cache, searched)
    return serving.cache_misses(rows, after).withColumn("response", F.lit("MISS")).unionByName(after)


@query("""WITH s AS (SELECT s_suppkey, s_nationkey * 1.00004 AS lat, CASE WHEN s_suppkey % 7 <> 0 THEN 1.5 END AS lng FROM supplier)
SELECT s_suppkey, CASE WHEN row_number() OVER (PARTITION BY round(lat, 4), round(lng, 4) ORDER BY s_suppkey) > 1 THEN 'REVIEW' ELSE 'HIGH' END AS confidence FROM s""")
def q72_repeated_places(spark, sf_dir):
    rows = load(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") * 1.00004).alias("lat"), F.when(F.col("s_suppkey") % 7 != 0, 1.5).alias("lng"), F.lit("HIGH").alias("confidence"))
    return serving.downgrade_collisions(rows, "s_suppkey").select("s_suppkey", "confidence")


@query(f"""WITH {_FACTS_SQL}, after AS (
  SELECT mandi_id, variety, grade, year, modal_price, CASE WHEN mandi_id + 1 IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 1) THEN mandi_id END AS source_mandi_id FROM f WHERE NOT (mandi_id % 2 = 1 AND mandi_id IN (SELECT s_suppkey FROM supplier))
  UNION ALL SELECT survivor, variety, grade, year, modal_price, mandi_id FROM c WHERE NOT same)
SELECT CASE WHEN source_mandi_id = 3 THEN 3 ELSE mandi_id END AS mandi_id, variety, grade, year, modal_price, CASE WHEN source_mandi_id = 3 THEN NULL ELSE source_mandi_id END AS source_mandi_id FROM after""")
def q73_merge_reverted(spark, sf_dir):
    """All pairs of suppliers merge, then one merge is taken back."""
    return merge.revert_market(_merged(spark, sf_dir)[0], 3)


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 1 AND (s_suppkey - 1) % 2 = 0 THEN 'MERGED' WHEN s_suppkey % 2 = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
  CASE WHEN s_suppkey % 3 = 1 AND (s_suppkey - 1) % 2 = 0 THEN s_suppkey - 1 END AS merged_into_id FROM supplier""")
def q74_mark_merged(spark, sf_dir):
    """Suppliers 3k + 1 merge into 3k, where that is active; a repeat changes nothing."""
    rows = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 2 == 0, "ACTIVE").otherwise("INACTIVE").alias("status"), F.lit(None).cast("long").alias("merged_into_id"))
    pairs = rows.where("id % 3 = 1").select(F.col("id").alias("loser"), (F.col("id") - 1).alias("survivor"))
    once = merge.mark_merged(rows, pairs, "duplicate", "manual", 1.0)
    return merge.mark_merged(once, pairs, "duplicate", "manual", 1.0)


@query("""WITH r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN '' ELSE 'm' || CAST(l_suppkey AS VARCHAR) END AS market, CASE WHEN l_quantity > 48 THEN '31/02/2026' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS day,
  CASE WHEN l_tax > 0.07 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS price, l_quantity, l_tax, l_shipdate FROM lineitem),
good AS (SELECT * FROM r WHERE market <> '' AND l_quantity <= 48)
SELECT market, CAST(l_shipdate AS DATE) AS price_date, count(*) AS n, sum(CASE WHEN l_tax <= 0.07 THEN l_quantity END) AS total FROM good GROUP BY ALL
UNION ALL SELECT 'rejected', NULL, count(*), NULL FROM r WHERE market = '' OR l_quantity > 48""")
def q75_parse_records(spark, sf_dir):
    """Line items as records of either casing; some without market, with an impossible date, or without a number."""
    lines = load(spark, sf_dir, "lineitem")
    values = {
        "market": F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("m"), "l_suppkey")), "state": F.lit(" s "), "commodity": F.col("l_partkey").cast("string"),
        "arrival_date": F.when(F.col("l_quantity") > 48, "31/02/2026").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")), "modal_price": F.when(F.col("l_tax") > 0.07, "n/a").otherwise(F.col("l_quantity").cast("string")),
    }
    cased = lambda f: F.create_map(*(x for k, v in values.items() for x in (F.lit(f(k)), v)))
    raw = lines.select(F.when(F.col("l_orderkey") % 2 == 0, cased(str)).otherwise(cased(lambda k: "_".join(w.title() for w in k.split("_")))).alias("record"))
    good, bad = parse_records(raw)
    counts = good.groupBy("market", "price_date").agg(F.count("*").alias("n"), F.sum("modal_price").alias("total"))
    return counts.unionByName(bad.agg(F.count("*").alias("n")).select(F.lit("rejected").alias("market"), F.lit(None).cast("date").alias("price_date"), "n", F.lit(None).cast("double").alias("total")))


@query("""WITH s AS (SELECT s_suppkey AS id, s_acctbal AS latitude, list_extract(['HIGH', 'MEDIUM', 'LOW', 'REVIEW', NULL], CAST(s_suppkey % 5 + 1 AS BIGINT)) AS old, list_extract(['LOW', 'HIGH', 'REVIEW', 'MEDIUM'], CAST(s_suppkey % 4 + 1 AS BIGINT)) AS new, s_suppkey % 3 = 0 AS gone FROM supplier),
r AS (SELECT *, CASE old WHEN 'HIGH' THEN 4 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 2 WHEN 'REVIEW' THEN 1 ELSE 0 END AS a, CASE new WHEN 'HIGH' THEN 4 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 2 WHEN 'REVIEW' THEN 1 ELSE 0 END AS b FROM s)
SELECT id AS entity_id, 'location_geocoded' AS event_type, old AS old_confidence, new AS new_confidence, latitude AS old_latitude FROM r WHERE b >= a AND NOT gone""")
def q76_location_events(spark, sf_dir):
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), (F.col("s_suppkey") % n).cast("int"))
    rows = load(spark, sf_dir, "supplier")
    markets = rows.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("latitude"), F.lit(0.0).alias("longitude"), pick(["HIGH", "MEDIUM", "LOW", "REVIEW", None], 5).alias("location_confidence"), F.when(F.col("s_suppkey") % 3 == 0, "MERGED").otherwise("ACTIVE").alias("status"))
    updates = rows.select(F.col("s_suppkey").alias("id"), F.lit(1.5).alias("new_latitude"), F.lit(2.5).alias("new_longitude"), pick(["LOW", "HIGH", "REVIEW", "MEDIUM"], 4).alias("new_confidence"))
    _, events = serving.update_locations(markets, updates, "geocoder", F.lit(NOW))
    said = F.from_json("details", "old_confidence string, new_confidence string, old_latitude double")
    return events.select("entity_id", "event_type", said.alias("d")).select("entity_id", "event_type", "d.*")


_EVENT_FACTS = """e AS (SELECT *, user_id * 1000 + ascii(event_type) AS mandi_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS crop_id, 'v' || CAST(event_id % 3 AS VARCHAR) AS variety, CAST(ts AS DATE) AS price_date, event_id // 500 AS page FROM events)"""


def _event_store(spark, events: DataFrame, label: str) -> Versions:
    store = Versions(spark, ticks.new_folder(spark, label))
    runs.setup(store, _event_dims(events))
    return store


@query(f"""WITH {_EVENT_FACTS}, d AS (SELECT *, date_diff('day', (SELECT min(price_date) FROM e), price_date) // 15 AS part FROM e)
SELECT CAST(min(price_date) AS DATE) AS first_date, CAST(max(price_date) AS DATE) AS last_date, 'SUCCESS' AS status, count(DISTINCT (mandi_id, crop_id, variety, price_date)) AS rows_processed FROM d GROUP BY part""")
def q77_backfill_log(spark, sf_dir):
    """All days of the events, fifteen to a batch; asked for again, nothing is left to do."""
    events = load(spark, sf_dir, "events")
    store, rows = _event_store(spark, events, "backfill"), staged(_event_rows(events), "rows")
    first, last = rows.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).head()
    go = lambda: runs.historical_backfill(store, lambda days: runs.Work(rows.where(F.to_date("ts").isin(days)).select("seq", "record")), first, last, NOW, span=15)
    go()
    if go():
        raise RuntimeError("a backfill took dates again")
    return store.read("batches").select(F.col("date_range_start").alias("first_date"), F.col("date_range_end").alias("last_date"), "status", "rows_processed")


@query(f"""WITH {_EVENT_FACTS}, w AS (SELECT *, row_number() OVER (PARTITION BY mandi_id, crop_id, variety, price_date ORDER BY page % 3 = 1 DESC, event_id DESC) AS n FROM e)
SELECT mandi_id, crop_id, variety, price_date, value / 100 AS modal_price FROM w WHERE n = 1""")
def q78_retry_pages(spark, sf_dir):
    """A third of the pages fail in a tick and are read later, so their records come last."""
    events = load(spark, sf_dir, "events")
    store, rows = _event_store(spark, events, "retry"), staged(_event_rows(events).withColumn("resource", F.lit("resource_1")), "rows")
    late = F.col("page") % 3 == 1
    asked = rows.groupBy(F.col("event_type").alias("state"), "page").agg(F.count("*").alias("n"))
    pages = asked.select("state", "page", F.when(late, 0).otherwise(F.col("n")).alias("rows"), F.col("n").alias("total"), F.when(late, "down").alias("error"))
    today = jobs.market_today(NOW)
    runs.run(store, "live_tick", "tick", rows.where(~late).select("seq", "record"), "resource_1", NOW, pages, dates=(today, today))

    def fetch(plan: DataFrame) -> DataFrame:
        found = rows.withColumnRenamed("event_type", "state").drop("resource")
        return plan.select(F.col("id").alias("page_id"), "state", "page").join(found, ["state", "page"]).select("page_id", F.lit(None).cast("string").alias("error"), "seq", "record")

    runs.retry_failed_pages(store, fetch, "retry", NOW, "resource_1")
    return store.read("prices").select("mandi_id", "crop_id", "variety", "price_date", "modal_price")


@query(f"""WITH {_EVENT_FACTS}, even AS (SELECT * FROM e WHERE user_id % 2 = 0 AND day(price_date) % 7 <> 3),
b AS (SELECT min(price_date) AS lo, max(price_date) AS hi FROM even),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT 'AUDIT-001' AS error_code, CAST(mandi_id AS VARCHAR) AS entity_id FROM (SELECT DISTINCT mandi_id FROM e) WHERE mandi_id NOT IN (SELECT mandi_id FROM even)
UNION ALL SELECT 'AUDIT-002', CAST(c AS VARCHAR) FROM (SELECT unnest(range(1, 11)) AS c) WHERE c NOT IN (SELECT crop_id FROM even)
UNION ALL SELECT 'AUDIT-006', CAST(d AS VARCHAR) FROM days WHERE d NOT IN (SELECT price_date FROM even)""")
def q79_nightly_audit(spark, sf_dir):
    """Events of even users without some days: markets without prices and missing days give an alert each, once."""
    events = load(spark, sf_dir, "events")
    dims = _event_dims(events)
    store = Versions(spark, ticks.new_folder(spark, "audit"))
    runs.setup(store, dataclasses.replace(dims, markets=dims.markets.withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")})))
    some = events.where((F.col("user_id") % 2 == 0) & (F.dayofmonth("ts") % 7 != 3))
    runs.run(store, "daily_rewrite", "rewrite", _event_rows(some).select("seq", "record"), "resource_2", NOW)
    if not runs.nightly_audit(store, NOW) or runs.nightly_audit(store, NOW):
        raise RuntimeError("an audit raises its alerts once")
    return store.read("alerts").select("error_code", "entity_id")
