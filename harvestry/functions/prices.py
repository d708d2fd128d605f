"""Prices, hashes and dates of price records, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestry.schema import OTHER_SOURCE_CONFIDENCE, PER_ANIMAL_CROPS, SOURCE_CONFIDENCE, SOURCE_RANK


def tolerant_double(c: Column) -> Column:
    """A number, or null for anything else; not-a-number is null."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def day_first_date(c: Column) -> Column:
    """DD/MM/YYYY as a date; null for text with other than three parts or without such a day."""
    parts = F.split(c, "/")
    text = F.concat_ws("-", F.get(parts, 2), F.get(parts, 1), F.get(parts, 0))
    return F.when(F.size(parts) == 3, text.try_cast("date"))


def per_kilo(price: Column, crop_id: Column) -> Column:
    """A price per 100 kg as one per kg; animals are sold by head and stay."""
    return F.when(crop_id.isin(*PER_ANIMAL_CROPS), price).otherwise(price / 100)


def unit_of(crop_id: Column) -> Column:
    return F.when(crop_id.isin(*PER_ANIMAL_CROPS), "animal").otherwise("kg")


def lookup(c: Column, values: dict, default) -> Column:
    table = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return F.coalesce(F.try_element_at(table, c), F.lit(default))


def source_rank(c: Column) -> Column:
    return lookup(c, SOURCE_RANK, 0)


def percent_change(now: Column, before: Column) -> Column:
    return F.round(F.when(before > 0, 100.0 * (now - before) / before), 2)


def quality(source: Column, modal: Column, low: Column, high: Column, variety: Column, new_market: Column, new_crop: Column) -> Column:
    """Struct of the four components and their mean, score."""
    has_prices = modal.isNotNull() & low.isNotNull() & high.isNotNull()
    has_variety = F.coalesce(F.trim(variety) != "", F.lit(False))
    confidence = lookup(source, SOURCE_CONFIDENCE, OTHER_SOURCE_CONFIDENCE)
    completeness = F.when(has_prices, 0.75).otherwise(0.0) + F.when(has_variety, 0.25).otherwise(0.0)
    verified = F.lit(1.0) - F.when(new_market, 0.5).otherwise(0.0) - F.when(new_crop, 0.5).otherwise(0.0)
    positive = has_prices & (low >= 0) & (high >= 0) & (modal >= 0)
    sanity = F.when(positive & (low <= modal) & (modal <= high), 1.0).when(positive, 0.3).otherwise(0.0)
    score = F.round((confidence + completeness + verified + sanity) / 4, 4)
    return F.struct(confidence.alias("source_confidence"), completeness.alias("completeness"), verified.alias("entity_verified"), sanity.alias("price_sanity"), score.alias("score"))


def content_hash(modal: Column, low: Column, high: Column) -> Column:
    """SHA-256 of the three prices as canonical JSON: sorted keys, four decimals, nulls kept."""
    part = lambda name, c: F.concat(F.lit(f'"{name}":'), F.coalesce(c.cast("decimal(18,4)").cast("string"), F.lit("null")))
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", part("max_price", high), part("min_price", low), part("modal_price", modal)), F.lit("}")), 256)
