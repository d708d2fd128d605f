"""Resolution of names to entities: canonical districts, exact, alias and fuzzy tiers, creation.

Distinct keys are resolved once by joins; what stays unresolved is created, with names that resemble each other within
a block sharing one new entity. All tiers are set operations; Spark broadcasts dimensions when they are small. Tables of
distinct keys are written between the tiers: each tier reads its keys several times, and the plans stay small.
"""

from __future__ import annotations

import dataclasses
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import crop_key, display_name, market_key, normalize_kind, slug_with_suffix
from harvestry.operators.components import components
from harvestry.operators.similar import best_match, similar_pairs
from harvestry.schema import CROP_FUZZY, MARKET_FUZZY
from harvestry.sources.staging import numbered, staged


def canonical_districts(rows: DataFrame, aliases: DataFrame, district: str = "district") -> DataFrame:
    """rows with the district's canonical name, the first one if its aliases disagree, or its trimmed own."""
    known = aliases.groupBy(F.col("state").alias("__s"), F.trim("alias_district").alias("__d")).agg(F.min("canonical_district").alias("__c"))
    joined = rows.join(known, (F.col("state") == F.col("__s")) & (F.trim(F.col(district)) == F.col("__d")), "left")
    return joined.withColumn(district, F.coalesce("__c", F.trim(F.col(district)))).drop("__s", "__d", "__c")


def resolve(keys: DataFrame, entities: DataFrame, aliases: DataFrame, blocks: list[str], threshold: float) -> DataFrame:
    """keys(key, blocks) with entity_id and method EXACT, ALIAS, FUZZY or null. entities(id, key, blocks) are the active
    ones, aliases(owner_id, normalized_alias) the approved ones, which count in any block."""
    keys = staged(keys, "keys")
    exact = keys.join(entities.groupBy("key", *blocks).agg(F.min("id").alias("exact_id")), ["key", *blocks], "left")
    known = aliases.groupBy(F.col("normalized_alias").alias("key")).agg(F.min("owner_id").alias("alias_id"))
    tiers = staged(exact.join(known, "key", "left"), "tiers")
    todo = tiers.where("exact_id is null and alias_id is null")
    ask = todo.select(F.struct("key", *blocks).alias("id"), F.col("key").alias("name"), *blocks)
    near = best_match(ask, entities.select("id", F.col("key").alias("name"), *blocks), threshold, blocks)
    near = near.select("l_id.*", F.col("r_id").alias("fuzzy_id"), "similarity")
    out = tiers.join(near, ["key", *blocks], "left")
    method = F.when(F.col("exact_id").isNotNull(), "EXACT").when(F.col("alias_id").isNotNull(), "ALIAS").when(F.col("fuzzy_id").isNotNull(), "FUZZY")
    return out.select("key", *blocks, F.coalesce("exact_id", "alias_id", "fuzzy_id").alias("entity_id"), method.alias("method"), "similarity")


#: Pairs of a component up to which one task goes through it; larger ones go level by level. Pairs of components that are gone
#: through together.
COMPONENT_PAIRS, TOGETHER = 500_000, 50_000


def _in_order(pairs: pa.Table) -> pa.Table:
    """The rule of leaders_of, one id after the other."""
    rows = pairs.sort_by([("id", "ascending"), ("earlier", "ascending")]).to_pydict()
    own, out = {}, []
    for i, earlier, similarity in zip(rows["id"], rows["earlier"], rows["similarity"], strict=True):
        own.setdefault(i, []).append((-similarity, earlier))
    follows = set()
    for i, ways in own.items():
        found = min((w for w in ways if w[1] not in follows), default=None)
        if found:
            follows.add(i)
            out.append((i, found[1]))
    return pa.table({"id": pa.array([i for i, _ in out], pa.int64()), "leader": pa.array([e for _, e in out], pa.int64())})


def _by_levels(pairs: DataFrame) -> DataFrame:
    """The rule of leaders_of for components that one task can't hold: a round settles all ids with an earlier leader, and
    all whose earlier ones have none of their own."""
    every = pairs.select("id").distinct()
    heads = pairs.select(F.col("earlier").alias("id")).distinct().join(every, "id", "left_anti")
    state = staged(heads.withColumn("leads", F.lit(True)).unionByName(every.withColumn("leads", F.lit(None).cast("boolean"))), "leads")
    while not state.where("leads is null").isEmpty():
        earlier = pairs.join(state.withColumnRenamed("id", "earlier"), "earlier").groupBy("id").agg(F.bool_or("leads").alias("some"), F.count_if(F.col("leads").isNull()).alias("open"))
        news = F.when(F.col("some"), False).when(F.col("open") == 0, True)
        state = staged(state.join(earlier, "id", "left").select("id", F.coalesce("leads", F.when(F.col("open").isNotNull(), news)).alias("leads")), "leads")
    first = pairs.join(state.where("leads").select(F.col("id").alias("earlier")), "earlier").join(state.where("not leads").select("id"), "id")
    return first.groupBy("id").agg(F.min_by("earlier", F.struct(-F.col("similarity"), "earlier")).alias("leader"))


def leaders_of(pairs: DataFrame, most: int | None = None) -> DataFrame:
    """id, leader of every id of pairs(id, earlier, similarity) that doesn't get an entity of its own when ids (numbers) come
    in order: each joins the most similar earlier one that has (of ties the first), and only without any it gets its own.
    Ids of different components don't matter to each other, so each component is gone through in one task, small ones
    together; the rounds that find the components grow with the logarithm of a chain's length."""
    pairs = staged(pairs.select("id", "earlier", "similarity"), "alike")
    n = pairs.count()
    if n == 0:
        return pairs.select("id", F.col("earlier").alias("leader"))
    roots = components(pairs.select(F.col("id").alias("a"), F.col("earlier").alias("b")))
    placed = staged(pairs.join(roots, "id"), "components")
    large = placed.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > (COMPONENT_PAIRS if most is None else most)).select("root")
    large = staged(large, "large")
    lot = F.pmod(F.xxhash64("root"), F.lit(n // TOGETHER + 1)).alias("lot")
    small = placed.join(large, "root", "left_anti").groupBy(lot).applyInArrow(_in_order, "id long, leader long")
    if large.isEmpty():
        return small
    return small.unionByName(_by_levels(staged(placed.join(large, "root", "left_semi"), "large")))


def create_missing(resolved: DataFrame, blocks: list[str], threshold: float, first_id: int) -> DataFrame:
    """resolved with new ids, method CREATED, for the rest, as when keys come one after the other in their order: a key
    joins the created key of its block that it resembles most, if any. Ids follow the order of keys."""
    resolved = staged(resolved, "resolved")
    rest = resolved.where("entity_id is null").select("key", *blocks)
    if rest.isEmpty():
        return resolved
    rest = staged(numbered(rest, ["key", *blocks], "id"), "rest")
    pair = rest.withColumnRenamed("key", "name")
    earlier = similar_pairs(pair, pair, threshold, blocks, once=True).select(F.col("r_id").alias("id"), F.col("l_id").alias("earlier"), "similarity")
    owner = rest.join(leaders_of(earlier), "id", "left").select("key", *blocks, F.coalesce("leader", "id").alias("leader"))
    owner = staged(owner, "owners")
    ids = numbered(owner.select("leader").distinct(), ["leader"], "new_id", first_id)
    made = owner.join(ids, "leader").select("key", *blocks, "new_id")
    out = resolved.join(made, ["key", *blocks], "left")
    out = out.select("key", *blocks, F.coalesce("entity_id", "new_id").alias("entity_id"), F.when(F.col("entity_id").isNull(), "CREATED").otherwise(F.col("method")).alias("method"), "similarity")
    return staged(out, "created")


def fuzzy_aliases(resolved: DataFrame, aliases: DataFrame) -> DataFrame:
    """New aliases, not yet approved, of the keys that resembled an entity; one per key, none that is known already."""
    fresh = resolved.where("method = 'FUZZY'").groupBy("key").agg(F.min_by("entity_id", F.struct(-F.col("similarity"), "entity_id")).alias("owner_id"), F.max("similarity").alias("match_confidence"))
    fresh = fresh.join(aliases.select(F.col("normalized_alias").alias("key")), "key", "left_anti")
    return fresh.select("owner_id", F.col("key").alias("alias_name"), F.col("key").alias("normalized_alias"), F.lit("FUZZY").alias("match_method"), F.round("match_confidence", 4).alias("match_confidence"), F.lit(False).alias("approved"))


def created_entities(resolved: DataFrame, blocks: list[str], source: str) -> DataFrame:
    """A row for every new entity, named by its first key."""
    made = resolved.where("method = 'CREATED'").groupBy("entity_id", *blocks).agg(F.min("key").alias("key"))
    name = display_name("key")
    return made.select(F.col("entity_id").alias("id"), name.alias("name"), F.col("key").alias("normalized_name"), slug_with_suffix(name, F.concat_ws("|", "key", *blocks)).alias("slug"), *blocks, F.lit("ACTIVE").alias("status"), F.lit(source).alias("source"))


def touch_last_seen(entities: DataFrame, resolved: DataFrame, now: Column) -> DataFrame:
    """entities whose last_seen_at is `now` if a key resolved to them."""
    seen = resolved.where("entity_id is not null").select(F.col("entity_id").alias("id")).distinct().withColumn("__seen", F.lit(True))
    return entities.join(seen, "id", "left").withColumn("last_seen_at", F.when(F.col("__seen"), now).otherwise(F.col("last_seen_at"))).select(entities.columns)


def method_counts(resolved: DataFrame, *keys: str) -> DataFrame:
    """How many rows each way of resolution settled."""
    return resolved.groupBy(*keys, F.coalesce("method", F.lit("NONE")).alias("method")).agg(F.count("*").alias("n"))


def tally_methods(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """entity_type, method, n for several method columns of rows, in one pass."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("entity_type"), F.coalesce(F.col(c), F.lit("NONE")).alias("method")) for k, c in kinds.items())))
    return rows.select(each.alias("m")).groupBy("m.entity_type", "m.method").agg(F.count("*").alias("n"))


@dataclasses.dataclass(frozen=True)
class Resolution:
    """rows: the records with ids and methods; keys: their distinct keys, with entity_id, method and similarity; fresh: rows of
    new entities."""

    rows: DataFrame
    keys: DataFrame
    fresh: DataFrame


def _last_id(entities: DataFrame) -> int:
    return entities.agg(F.coalesce(F.max("id"), F.lit(0))).head()[0]


def markets_of(records: DataFrame, markets: DataFrame, aliases: DataFrame, district_aliases: DataFrame, threshold: float = MARKET_FUZZY, source: str | None = None) -> Resolution:
    """records(market, state, district) with mandi_id and mandi_method."""
    rows = canonical_districts(records, district_aliases).withColumn("__key", market_key("market"))
    keys = rows.select(F.col("__key").alias("key"), "state", F.coalesce("district", F.lit("")).alias("district")).distinct()
    known = markets.where("status = 'ACTIVE'").select("id", F.col("normalized_name").alias("key"), "state", F.coalesce("district", F.lit("")).alias("district"))
    found = resolve(keys, known, aliases.where("approved"), ["state", "district"], threshold)
    found = create_missing(found, ["state", "district"], threshold, _last_id(markets) + 1)
    ids = found.select(F.col("key").alias("__key"), F.col("state").alias("__s"), F.col("district").alias("__d"), F.col("entity_id").alias("mandi_id"), F.col("method").alias("mandi_method"))
    on = (rows["__key"] == ids["__key"]) & (rows["state"] == ids["__s"]) & (F.coalesce(rows["district"], F.lit("")) == ids["__d"])
    return Resolution(rows.join(ids, on, "left").drop("__key", "__s", "__d"), found, created_entities(found, ["state", "district"], source))


def crops_of(records: DataFrame, crops: DataFrame, aliases: DataFrame, threshold: float = CROP_FUZZY, source: str | None = None) -> Resolution:
    """records(commodity) with crop_id and crop_method."""
    rows = records.withColumn("__key", crop_key("commodity"))
    keys = rows.select(F.col("__key").alias("key")).distinct()
    known = crops.where("status = 'ACTIVE'").select("id", F.col("normalized_name").alias("key"))
    found = resolve(keys, known, aliases.where("approved"), [], threshold)
    found = create_missing(found, [], threshold, _last_id(crops) + 1)
    ids = found.select(F.col("key").alias("__key"), F.col("entity_id").alias("crop_id"), F.col("method").alias("crop_method"))
    return Resolution(rows.join(ids, "__key", "left").drop("__key"), found, created_entities(found, [], source))


def kinds_of(rows: DataFrame, kinds: DataFrame, parent: str, text: str, out: str, aliases: DataFrame | None = None) -> Resolution:
    """rows with the id of a variety (parent crop_id) or grade (parent variety_id): exact, then alias of the same parent,
    then a new id; null for blank text. kinds(id, parent, normalized_name, status)."""
    name = normalize_kind(text)
    keyed = rows.withColumn("__name", F.when(F.trim(F.col(text)) != "", name))
    active = kinds.where("status = 'ACTIVE'")
    exact = active.groupBy(F.col(parent).alias("__p"), F.col("normalized_name").alias("__n")).agg(F.min("id").alias("__exact"))
    known = keyed.select(F.col(parent).alias("__p"), F.col("__name").alias("__n")).where("__n is not null").distinct().join(exact, ["__p", "__n"], "left")
    if aliases is None:
        known = known.withColumn("__alias", F.lit(None).cast("long"))
    else:
        owned = aliases.where("approved").join(active.select(F.col("id").alias("owner_id"), F.col(parent).alias("__p")), "owner_id")
        known = known.join(owned.groupBy("__p", F.col("normalized_alias").alias("__n")).agg(F.min("owner_id").alias("__alias")), ["__p", "__n"], "left")
    known = staged(known, "kinds")
    fresh = numbered(known.where("__exact is null and __alias is null").select("__p", "__n"), ["__p", "__n"], "__new", _last_id(kinds) + 1)
    method = F.when(F.col("__exact").isNotNull(), "EXACT").when(F.col("__alias").isNotNull(), "ALIAS").otherwise("CREATED")
    found = known.join(fresh.select("__p", "__n", "__new"), ["__p", "__n"], "left").select("__p", "__n", F.coalesce("__exact", "__alias", "__new").alias(out), method.alias("method"))
    joined = keyed.join(found.drop("method"), (F.col(parent) == F.col("__p")) & (F.col("__name") == F.col("__n")), "left").drop("__p", "__n", "__name")
    made = fresh.select(F.col("__new").alias("id"), F.col("__p").alias(parent), display_name("__n").alias("name"), F.col("__n").alias("normalized_name"), F.lit("ACTIVE").alias("status"))
    return Resolution(joined, found.select(F.col("__p").alias(parent), F.col("__n").alias("key"), F.col(out).alias("entity_id"), "method"), made)


def resolve_markets(*args, **options) -> DataFrame:
    return markets_of(*args, **options).rows


def resolve_crops(*args, **options) -> DataFrame:
    return crops_of(*args, **options).rows


def resolve_kinds(*args, **options) -> DataFrame:
    return kinds_of(*args, **options).rows


def with_fresh(entities: DataFrame, fresh: DataFrame, **values: Column) -> DataFrame:
    """entities and new ones, with some values for their other columns; null in the rest."""
    rows = fresh.withColumns({c: v for c, v in values.items() if c in entities.columns})
    return entities.unionByName(rows.select(*(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in entities.schema)))


def first_seen(rows: DataFrame, keys: list[str], seq: str, flag: str = "first_seen_this_run") -> DataFrame:
    """rows with a flag for the first row of each key."""
    return first_seen_each(rows, {flag: keys}, seq)


def first_seen_each(rows: DataFrame, flags: dict[str, list[str]], seq: str) -> DataFrame:
    """rows with several such flags. The first rows are aggregated, so a key that very many rows have isn't sorted in one
    task; rows are written once, with a number each, so that of rows of one place in the order only one is first."""
    columns = rows.columns
    place, first = (f"{name}_{uuid.uuid4().hex}" for name in ("place", "first"))
    rows = staged(rows.withColumn(place, F.monotonically_increasing_id()), "seen")
    for n, (flag, keys) in enumerate(flags.items()):
        own = rows.groupBy(*(F.col(k).alias(f"{first}_{n}_{i}") for i, k in enumerate(keys))).agg(F.min(F.struct(seq, place)).getField(place).alias(first))
        same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"{first}_{n}_{i}")) for i, k in enumerate(keys)))
        rows = rows.join(own, same, "left").withColumn(flag, F.col(place).eqNullSafe(F.col(first))).select(*rows.columns, flag)
    return rows.select(*columns, *flags)
