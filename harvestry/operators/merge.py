"""Merging of duplicate entities: facts move to the survivor, dimensions keep a pointer, aliases follow.

Every function returns new DataFrames; nothing is updated in place. Pairs are frames of (loser, survivor).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestry.operators.upsert import keyed
from harvestry.sources.staging import dealt, staged

#: Markets that merge, up to this number (three ids each), are broadcast to their prices; beyond it Spark shuffles both.
BROADCAST_ROWS = 1_000_000


def final_targets(pairs: DataFrame, rounds: int = 30) -> DataFrame:
    """pairs with chains followed to their end. Each round follows a pointer's pointer, so a chain halves."""
    pairs = staged(pairs.select("loser", "survivor"), "pairs")
    for _ in range(rounds):
        step = pairs.select(F.col("loser").alias("survivor"), F.col("survivor").alias("further"))
        jumped = staged(pairs.join(step, "survivor", "left").select("loser", F.coalesce("further", "survivor").alias("survivor"), F.col("further").isNotNull().alias("moved")), "pairs")
        if not jumped.where("moved").head(1):
            return pairs
        pairs = jumped.drop("moved")
    raise ValueError("the pointers form a cycle")


def merge_markets(prices: DataFrame, pairs: DataFrame, keys: list[str], values: list[str], entity: str = "mandi_id", source: str = "source_mandi_id", names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(prices after the merge, counts per pair), as if the losers of a survivor merged one after the other, by id. A
    loser's row with the key of a row that is there and equal values is dropped; one with other values stays beside it; the
    rest move. All rows of both sides keep the market they came from in `source`, and with
    names(id, name) its name in source_mandi_name."""
    roles = pairs.select(F.col("loser").alias("__of"), "loser", "survivor")
    ends = pairs.select("survivor").distinct().join(pairs.select(F.col("loser").alias("survivor")), "survivor", "left_anti")  # survivors that don't move on
    roles = staged(roles.unionByName(ends.select(F.col("survivor").alias("__of"), F.lit(None).alias("loser"), "survivor")), "roles")
    roles = F.broadcast(roles) if roles.count() <= BROADCAST_ROWS else roles
    rows = staged(keyed(prices, keys).join(roles, F.col(entity) == F.col("__of"), "left"), "prices")
    aside = rows.where("__of is null").select(prices.columns)
    other = ["survivor", *(k for k in keys if k not in (entity, source))]
    turn = F.struct(F.col("loser").isNotNull(), "loser")  # the survivor's rows, then each loser's
    both = rows.where("__of is not null").select(*prices.columns, "loser", "survivor")
    both = dealt(both, both.count(), *other)
    # the second window takes its first turns from the first one, so one order of the rows serves both
    met = both.withColumn("__equal", F.min(turn).over(Window.partitionBy(*other, *values))).withColumn("__key", F.min("__equal").over(Window.partitionBy(*other)))
    met = met.withColumns({"equal": F.col("__equal") < turn, "collides": F.col("__key") < turn})
    moved = F.col("loser").isNotNull()
    stays = met.where(~moved | ~F.col("equal"))
    if names is not None:
        own = names.select(F.col("id").alias(entity), F.col("name").alias("own_name"))
        stays = stays.join(own, entity, "left").withColumn("source_mandi_name", F.coalesce("source_mandi_name", F.when(F.col(source).isNull(), F.col("own_name"))))
    placed = stays.withColumns({source: F.coalesce(F.col(source), F.col(entity)), entity: F.col("survivor")})
    counts = met.where(moved).groupBy("loser", "survivor").agg(
        F.count_if("equal").alias("deduped"), F.count_if(F.col("collides") & ~F.col("equal")).alias("kept_both"), F.count_if(~F.col("collides")).alias("moved")
    )
    return aside.unionByName(placed.select(prices.columns)), counts


def revert_market(prices: DataFrame, loser: int, entity: str = "mandi_id", source: str = "source_mandi_id") -> DataFrame:
    """prices with the rows that came from a merged market back under it."""
    came = F.col(source) == loser
    return prices.withColumns({entity: F.when(came, F.col(source)).otherwise(F.col(entity)), source: F.when(~F.coalesce(came, F.lit(False)), F.col(source))})


def rekey(rows: DataFrame, pairs: DataFrame, entity: str, keys: list[str]) -> DataFrame:
    """rows under the survivors; of rows with one key the survivor's stays, else that of the loser with the least id."""
    mapped = rows.join(pairs, F.col(entity) == F.col("loser"), "left").withColumn(entity, F.coalesce("survivor", entity))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("loser").asc_nulls_first()))
    return mapped.withColumn("place", place).where("loser is null or place = 1").select(rows.columns)


def mark_merged(entities: DataFrame, pairs: DataFrame, reason: str, method: str, merge_confidence: float) -> DataFrame:
    """entities in which losers are MERGED into their survivors, if these are active; a repeat changes nothing."""
    active = entities.where("status = 'ACTIVE'").select(F.col("id").alias("survivor"))
    valid = pairs.join(active, "survivor", "left_semi")
    joined = entities.join(valid.withColumnRenamed("loser", "id"), "id", "left")
    hit = F.col("survivor").isNotNull() & (F.col("status") != "MERGED")
    news = {"merged_into_id": F.col("survivor"), "merge_reason": F.lit(reason), "merge_method": F.lit(method), "merge_confidence": F.lit(merge_confidence)}
    out = joined.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in news.items() if c in entities.columns} | {"status": F.when(hit, "MERGED").otherwise(F.col("status"))})
    return out.select(entities.columns)


def move_aliases(aliases: DataFrame, pairs: DataFrame, names: DataFrame) -> DataFrame:
    """aliases under the survivors, and each loser's own name (names(id, name, normalized_name)) as a new approved alias;
    one alias per normalized name."""
    moved = aliases.join(pairs, F.col("owner_id") == F.col("loser"), "left").withColumn("owner_id", F.coalesce("survivor", "owner_id")).select(aliases.columns)
    own = pairs.join(names, F.col("id") == F.col("loser")).select(
        F.col("survivor").alias("owner_id"), F.col("name").alias("alias_name"), F.col("normalized_name").alias("normalized_alias"), F.lit("MERGE").alias("match_method"), F.lit(1.0).alias("match_confidence"), F.lit(True).alias("approved")
    )
    fresh = own.join(aliases.select("normalized_alias"), "normalized_alias", "left_anti").dropDuplicates(["normalized_alias"])
    return moved.unionByName(fresh.select(aliases.columns))


def child_pairs(children: DataFrame, pairs: DataFrame, parent: str) -> tuple[DataFrame, DataFrame]:
    """(pairs of the losers' children with the survivors' children of equal name, children with the others re-parented).
    Only active children take part. Losers' children of one name meet in the survivor's child, or in the first of them."""
    active = children.where("status = 'ACTIVE'") if "status" in children.columns else children
    own = active.join(pairs, F.col(parent) == F.col("loser")).select("id", "normalized_name", "survivor")
    theirs = active.groupBy(F.col(parent).alias("survivor"), "normalized_name").agg(F.min("id").alias("survivor_child"))
    theirs = theirs.unionByName(own.groupBy("survivor", "normalized_name").agg(F.min("id").alias("survivor_child")).join(theirs, ["survivor", "normalized_name"], "left_anti"))
    met = own.join(theirs, ["survivor", "normalized_name"], "left")
    matched = met.where("survivor_child <> id").select(F.col("id").alias("loser"), F.col("survivor_child").alias("survivor"))
    orphans = met.where("survivor_child = id").select("id", F.col("survivor").alias("__parent"))
    moved = children.join(orphans, "id", "left").withColumn(parent, F.coalesce("__parent", parent)).select(children.columns)
    return matched, moved


def merge_crops(crops: DataFrame, varieties: DataFrame, grades: DataFrame, prices: DataFrame, pairs: DataFrame, price_keys: list[str], reason: str = "duplicate", method: str = "manual", merge_confidence: float = 1.0) -> dict[str, DataFrame]:
    """Merge crops with a cascade: varieties of equal name merge, and their grades of equal name; others move along."""
    v_pairs, varieties = child_pairs(varieties, pairs, "crop_id")
    g_pairs, grades = child_pairs(grades, v_pairs, "variety_id")
    prices = rekey(prices, pairs, "crop_id", price_keys)
    mark = lambda d, p: mark_merged(d, p, reason, method, merge_confidence)
    return {"crops": mark(crops, pairs), "varieties": mark(varieties, v_pairs), "grades": mark(grades, g_pairs), "prices": prices}


def common_keys(rows: DataFrame, pair: str, side: str, keys: list[str]) -> DataFrame:
    """pair, keys, n: rows of the keys that occur on both sides (two values) of a pair of markets."""
    found = rows.groupBy(pair, *keys).agg(F.count("*").alias("n"), F.min(side).alias("__a"), F.max(side).alias("__b"))
    return found.where("__a <> __b").drop("__a", "__b")


def audit_events(pairs: DataFrame, entity_type: str, reason: str, batch_id: str | None = None) -> DataFrame:
    details = F.to_json(F.struct("survivor", F.lit(reason).alias("reason")))
    return pairs.select(F.lit(batch_id).cast("string").alias("batch_id"), F.lit(entity_type).alias("entity_type"), F.col("loser").alias("entity_id"), F.lit("MERGED").alias("event_type"), details.alias("details"))


def field_changes(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field_name, old_value, new_value of all fields that differ between two versions of a table."""
    pair = old.select(key, *(F.col(f).cast("string").alias(f"o_{f}") for f in fields)).join(new.select(key, *(F.col(f).cast("string").alias(f"n_{f}") for f in fields)), key)
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"o_{f}").alias("old_value"), F.col(f"n_{f}").alias("new_value")) for f in fields)))
    return pair.select(key, each.alias("c")).select(key, "c.*").where("not (old_value <=> new_value)")


def merge_entity(kind: str, pairs: DataFrame, tables: dict[str, DataFrame], keys: list[str], reason: str, method: str = "manual", merge_confidence: float = 1.0, batch_id: str | None = None) -> dict[str, DataFrame]:
    """Merge entities of a kind, "crop", "variety", "grade" or "mandi": the tables that change, by name, and audit_log.
    tables has the kind's own table, its children and prices. Prices name varieties and grades by id columns if there are
    any. Losers whose survivor isn't active are left alone."""
    own = {"crop": "crops", "variety": "varieties", "grade": "grades", "mandi": "markets"}[kind]
    active = tables[own].where("status = 'ACTIVE'").select("id")
    pairs = final_targets(pairs).join(active.withColumnRenamed("id", "survivor"), "survivor", "left_semi").join(tables[own].where("status <> 'MERGED'").select(F.col("id").alias("loser")), "loser", "left_semi")
    pairs = staged(pairs, "pairs")
    out: dict[str, DataFrame] = {}
    prices = tables["prices"]
    if kind == "mandi":
        prices, out["counts"] = merge_markets(prices, pairs, keys, [c for c in ("modal_price", "min_price", "max_price") if c in prices.columns], names=tables[own].select("id", "name") if "source_mandi_name" in prices.columns else None)
        out["aliases"] = move_aliases(tables["aliases"], pairs, tables[own].select("id", "name", "normalized_name"))
    chain, moving = [("crop", "crops", "crop_id"), ("variety", "varieties", "variety_id"), ("grade", "grades", "grade_id")], pairs
    if kind != "mandi":
        chain = chain[[k for k, _, _ in chain].index(kind) :]
        for level, (_, name, column) in enumerate(chain):
            out[name] = mark_merged(out.get(name, tables[name]), moving, reason, method, merge_confidence)
            if column in prices.columns:
                prices = rekey(prices, moving, column, keys)
            if level + 1 < len(chain):
                below = chain[level + 1][1]
                moving, out[below] = child_pairs(tables[below], moving, column)
                moving = staged(moving, "pairs")
    else:
        out[own] = mark_merged(tables[own], pairs, reason, method, merge_confidence)
    return out | {"prices": prices, "audit_log": audit_events(pairs, kind, reason, batch_id)}
