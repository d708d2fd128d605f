"""Serving copies, retention, weekly aggregates, and updates of locations."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.geo import AGREEMENT_KM, AGREEMENT_POINTS, REJECT_KM, TOWN_NAME_SCORE, admin_only, candidate_score, confidence, haversine_km, location_rank
from harvestry.functions.terms import words
from harvestry.functions.text import name_match, place_name
from harvestry.operators.upsert import upsert
from harvestry.sources.staging import staged
from harvestry.sources.versions import Versions, fingerprints


def serving_copies(crops: DataFrame, markets: DataFrame, varieties: DataFrame, grades: DataFrame, cache: DataFrame) -> dict[str, DataFrame]:
    """What the serving layer gets: active parents, children of kept parents only, cache rows of kept entities."""
    crops, markets = crops.where("status = 'ACTIVE'"), markets.where("status = 'ACTIVE'")
    semi = lambda rows, dim, key: rows.join(dim.select(F.col("id").alias(key)), key, "left_semi")
    varieties = semi(varieties, crops, "crop_id")
    grades = semi(grades, varieties, "variety_id")
    cache = semi(semi(semi(cache, markets, "mandi_id"), crops, "crop_id"), varieties, "variety_id")
    return {"crops": crops, "markets": markets, "varieties": varieties, "grades": grades, "price_cache": cache}


def serving_drops(tables: dict[str, DataFrame], copies: dict[str, DataFrame]) -> DataFrame:
    """table, kept, dropped: how many rows of each table the serving layer doesn't get."""
    counts = None
    for name, kept in copies.items():
        both = tables[name].agg(F.count("*").alias("every")).join(kept.agg(F.count("*").alias("kept")), F.lit(True))
        row = both.select(F.lit(name).alias("table"), "kept", (F.col("every") - F.col("kept")).alias("dropped"))
        counts = row if counts is None else counts.unionByName(row)
    return counts


def sync(store: Versions, tables: dict[str, DataFrame]) -> DataFrame:
    """Publish the serving layer as one version of a store: entities by id over what is there, the price cache as a whole.
    Readers see all tables of a version; a job that dies leaves the last one. Returns the counts of serving_drops."""
    copies = {name: staged(rows, name) for name, rows in serving_copies(tables["crops"], tables["markets"], tables["varieties"], tables["grades"], tables["price_cache"]).items()}
    news = {}
    for name, rows in copies.items():
        if name != "price_cache" and store.has(name):
            rows = store.read(name).join(rows.select("id"), "id", "left_anti").select(rows.columns).unionByName(rows)
        news[name] = rows
    store.commit(news)
    return serving_drops(tables, copies)


def band_counts(located: DataFrame) -> DataFrame:
    """Markets by confidence; UNRESOLVED where there is none."""
    return located.groupBy(F.coalesce("confidence", F.lit("UNRESOLVED")).alias("confidence")).agg(F.count("*").alias("n"))


def without_location(markets: DataFrame, n: int | None = None) -> DataFrame:
    """Active markets without coordinates, by id; at most n of them for one run of a geocoder."""
    found = markets.where("status = 'ACTIVE' and (latitude is null or longitude is null)").orderBy("id")
    return found if n is None else found.limit(n)


def town_fallback(markets: DataFrame, candidates: DataFrame, match=name_match) -> DataFrame:
    """For markets(id, name, ref_lat, ref_lng) without a market of their own on the map: the town they are named after,
    for review only. Of candidates(market_id, ord, name, lat, lng, place_types) the first counts that is an administrative
    place, is named nearly like the market's place (TOWN_NAME_SCORE) and lies within REJECT_KM of the reference point.
    market_id, lat, lng, matched, score, confidence."""
    place = place_name(F.col("name"))
    asked = markets.select(F.col("id").alias("market_id"), place.alias("place"), "ref_lat", "ref_lng").where((place != "") & (F.lower(place) != F.lower("name")))
    both = candidates.join(asked, "market_id").where(admin_only(F.col("place_types"))).withColumn("score", match(F.col("place"), F.col("name")))
    near = F.coalesce(haversine_km(F.col("ref_lat"), F.col("ref_lng"), F.col("lat"), F.col("lng")) <= REJECT_KM, F.lit(True))
    good = both.where((F.col("score") >= TOWN_NAME_SCORE) & near)
    first = good.groupBy("market_id").agg(F.min_by(F.struct("lat", "lng", F.col("name").alias("matched"), "score"), "ord").alias("t"))
    return first.select("market_id", "t.*", F.lit("REVIEW").alias("confidence"))


def guard_locations(entities: DataFrame, updates: DataFrame) -> DataFrame:
    """entities(id, latitude, longitude, location_confidence) with updates(id, new_latitude, new_longitude,
    new_confidence) applied where they don't lower the confidence; `updated` tells which."""
    joined = entities.join(updates, "id", "left")
    better = F.coalesce(location_rank(F.col("new_confidence")) >= location_rank(F.col("location_confidence")), F.lit(False)) & F.col("new_confidence").isNotNull()
    pick = lambda new, old: F.when(better, F.col(new)).otherwise(F.col(old))
    out = joined.withColumns({"latitude": pick("new_latitude", "latitude"), "longitude": pick("new_longitude", "longitude"), "location_confidence": pick("new_confidence", "location_confidence"), "updated": better})
    return out.select(*entities.columns, "updated")


def update_locations(markets: DataFrame, updates: DataFrame, source: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(markets after guard_locations for active ones, an audit event for each that changed, with old and new values)."""
    active = markets.where("status = 'ACTIVE'").select("id")
    wanted = updates.join(active, "id", "left_semi")
    after = guard_locations(markets, wanted)
    hit = after.where("updated").select("id").join(markets.select("id", "latitude", "longitude", "location_confidence"), "id").join(wanted, "id")
    details = F.struct(
        F.col("latitude").alias("old_latitude"), F.col("longitude").alias("old_longitude"), F.col("location_confidence").alias("old_confidence"), "new_latitude", "new_longitude", "new_confidence", F.lit(source).alias("source")
    )
    events = hit.select(F.lit("mandi").alias("entity_type"), F.col("id").alias("entity_id"), F.lit("location_geocoded").alias("event_type"), F.to_json(details, {"ignoreNullFields": "false"}).alias("details"), now.alias("created_at"))
    return after.drop("updated"), events


def geocode(markets: DataFrame, cache: DataFrame, search: Callable[[DataFrame], DataFrame], providers: dict[str, Callable], source: str, now: Column, n: int | None = None, match=None) -> dict[str, DataFrame]:
    """One run of the geocoder over active markets without a location: their queries by provider (functions of name, district
    and state), the search of those that the cache lacks, the best candidates, towns as a fallback, repeated places for
    review, and the update of the markets. search takes (provider, query) and returns them with status and response.
    markets has ref_lat and ref_lng, reference points or null. Returns markets, audit_log, search_cache and located."""
    todo = staged(without_location(markets, n), "without")
    asked = [todo.select(F.col("id").alias("market_id"), F.lit(p).alias("provider"), F.posexplode(make(F.col("name"), F.col("district"), F.col("state"))).alias("turn", "query")) for p, make in providers.items()]
    queries = staged(reduce(DataFrame.unionByName, asked), "queries")
    known = staged(write_through(cache, search(cache_misses(queries, cache))), "searched")
    # candidates in the order of the queries that found them
    found = queries.join(decoded_candidates(known), ["provider", "query"]).withColumn("ord", (F.col("turn") * 1000 + F.col("ord")).cast("int"))
    found = staged(found.select("market_id", "ord", "name", "lat", "lng", "place_types", "formatted_address", "provider"), "candidates")
    located = locate(todo.select("id", "name", "district", "state", "ref_lat", "ref_lng"), found, match)
    nowhere = located.where("confidence = 'UNRESOLVED'").select(F.col("market_id").alias("id"))
    towns = town_fallback(todo.join(nowhere, "id", "left_semi"), found, *([match] if match else []))
    best = located.where("confidence <> 'UNRESOLVED'").select("market_id", "lat", "lng", "matched", "score", "confidence").unionByName(towns)
    best = staged(downgrade_collisions(best, "market_id"), "located")
    updates = best.select(F.col("market_id").alias("id"), F.col("lat").alias("new_latitude"), F.col("lng").alias("new_longitude"), F.col("confidence").alias("new_confidence"))
    after, events = update_locations(markets, updates, source, now)
    return {"markets": after, "audit_log": events, "search_cache": known, "located": best}


def locate(markets: DataFrame, candidates: DataFrame, match=None) -> DataFrame:
    """Best location of each of markets(id, name, district, state, ref_lat, ref_lng) among candidates(market_id, ord,
    name, lat, lng, place_types, formatted_address, provider): market_id, lat, lng, matched, provider, score, confidence,
    agreed. Per provider the first best candidate counts; two providers within 3 km of each other add to the score."""
    both = candidates.withColumnRenamed("name", "candidate").join(markets.withColumnRenamed("id", "market_id"), "market_id")
    km = haversine_km(F.col("lat"), F.col("lng"), F.col("ref_lat"), F.col("ref_lng"))
    scored = both.withColumn("s", candidate_score(F.col("candidate"), F.col("place_types"), F.col("formatted_address"), F.col("name"), F.col("district"), F.col("state"), words(), km, match and match(F.col("name"), F.col("candidate"))))
    scored = scored.where("s.reject_reason is null and s.score > 0 and lat is not null")
    place = F.struct("candidate", "lat", "lng", F.col("s.score").alias("score"), "provider")
    best = scored.groupBy("market_id", "provider").agg(F.max_by(place, F.struct(F.col("s.score"), -F.col("ord"))).alias("p"))
    sides = best.groupBy("market_id").agg(F.max_by("p", F.struct(F.col("p.score"), F.col("provider"))).alias("top"), F.min_by("p", "provider").alias("a"), F.max_by("p", "provider").alias("b"))
    agreed = (F.col("a.provider") != F.col("b.provider")) & (haversine_km(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")) <= AGREEMENT_KM)
    total = F.col("top.score") + F.when(agreed, AGREEMENT_POINTS).otherwise(0)
    found = sides.select("market_id", "top.lat", "top.lng", F.col("top.candidate").alias("matched"), "top.provider", total.alias("score"), confidence(total, agreed).alias("confidence"), agreed.alias("agreed"))
    return markets.select(F.col("id").alias("market_id")).join(found, "market_id", "left").withColumns(
        {"score": F.coalesce("score", F.lit(0.0)), "confidence": F.coalesce("confidence", F.lit("UNRESOLVED")), "agreed": F.coalesce("agreed", F.lit(False))}
    )


def downgrade_collisions(located: DataFrame, seq: str) -> DataFrame:
    """Later rows at a place (four decimals) that an earlier one has are for review."""
    from pyspark.sql.window import Window

    at = Window.partitionBy(F.round("lat", 4), F.round("lng", 4)).orderBy(seq)
    again = F.col("lat").isNotNull() & (F.row_number().over(at) > 1)
    return located.withColumn("confidence", F.when(again, "REVIEW").otherwise(F.col("confidence")))


def cache_misses(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """(provider, query) pairs that must be searched for."""
    return wanted.select("provider", "query").distinct().join(cache, ["provider", "query"], "left_anti")


def encoded_candidates(candidates: DataFrame) -> DataFrame:
    """provider, query, response: the candidates of each search in order, as JSON with sorted place types."""
    one = F.struct("ord", "name", "lat", "lng", F.array_sort("place_types").alias("place_types"), "formatted_address", "provider")
    return candidates.groupBy("provider", "query").agg(F.to_json(F.array_sort(F.collect_list(one))).alias("response"))


def decoded_candidates(cache: DataFrame) -> DataFrame:
    """provider, query and the candidates of a search cache's responses."""
    one = "array<struct<ord:int,name:string,lat:double,lng:double,place_types:array<string>,formatted_address:string>>"
    return cache.select("provider", "query", F.explode(F.from_json("response", one)).alias("c")).select("provider", "query", "c.*")


def write_through(cache: DataFrame, searched: DataFrame) -> DataFrame:
    """cache(provider, query, response) with the responses of searched(provider, query, status, response). Only answers are
    kept, also empty ones; errors will be searched for again."""
    fresh = searched.where("status in ('OK', 'ZERO_RESULTS')").select("provider", "query", F.coalesce("response", F.lit("[]")).alias("response"))
    return upsert(cache, fresh, ["provider", "query"], ["response"])


def retained(prices: DataFrame, days: int, date: str = "price_date") -> DataFrame:
    """Rows of the last `days` days before the newest date."""
    newest = prices.agg(F.max(date)).head()[0]
    return prices.where(F.col(date) > F.date_sub(F.lit(newest), days))


def weekly(prices: DataFrame, keys: list[str], value: str = "modal_price", date: str = "price_date") -> DataFrame:
    """Weekly aggregates with a hash over the week's values, independent of their order."""
    row = F.concat_ws("|", F.col(date).cast("string"), F.coalesce(F.col(value).cast("decimal(18,4)").cast("string"), F.lit("")))
    digest = F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(row))), 256)  # a key has few rows in a week
    return prices.groupBy(*keys, F.date_trunc("week", date).cast("date").alias("week")).agg(
        F.count("*").alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"), digest.alias("verification_hash")
    )


def archive(store: Versions, table: str, date: str, keep_days: int, archive_store: Versions, run_id: str) -> DataFrame:
    """Move the parts of a table (by its part column, a date) that are older than keep_days before its newest one into an
    archive: write them, read them again, compare the fingerprints of each part, and drop only parts that are equal.
    Returns and logs run_id, part, n, verified; a second run takes up what the first has left."""
    parts = sorted(p for p in store.parts(table) if p != "null")
    if not parts:
        return store.spark.createDataFrame([], "run_id string, part string, n long, verified boolean")
    bound = (datetime.date.fromisoformat(parts[-1]) - datetime.timedelta(days=keep_days)).isoformat()
    old = [p for p in parts if p <= bound]
    rows = store.read(table, old)
    if old:
        archive_store.commit(parts={table: (rows, date)})
    there = fingerprints(archive_store.read(table, old), date) if old else fingerprints(rows, date)
    named = there.select("part", *(F.col(c).alias(f"a_{c}") for c in ("n", "total", "mix")))
    log = fingerprints(rows, date).join(named, "part", "left").select(F.lit(run_id).alias("run_id"), "part", "n", F.coalesce((F.col("n") == F.col("a_n")) & (F.col("total") == F.col("a_total")) & (F.col("mix") == F.col("a_mix")), F.lit(False)).alias("verified"))
    log = staged(log, "archived")
    good = [r.part for r in log.where("verified").select("part").collect()]  # a row for each old day
    if good:
        store.drop_parts(table, good)
    archive_store.commit(append={"archive_log": (log, None)})
    return log
