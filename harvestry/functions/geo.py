"""Distances and the scoring of location candidates, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestry.functions.text import core_name, core_words, name_match, place_name, token
from harvestry.schema import LOCATION_RANK

# Fixed values.
EARTH_KM = 6371.0
ADMIN_TYPES = [
    "locality", "political", "administrative_area_level_1", "administrative_area_level_2", "administrative_area_level_3",
    "administrative_area_level_4", "administrative_area_level_5", "country", "postal_code", "postal_town", "sublocality", "sublocality_level_1",
    "neighborhood",
]
OFFICE_TYPES = ["government_office", "local_government_office"]
MARKET_TYPES = [
    "market", "grocery_or_supermarket", "supermarket", "food", "grocery_store", "wholesaler", "farm",
]
NAME_POINTS, WORD_POINTS, DISTRICT_POINTS, STATE_POINTS, TYPE_POINTS, AGREEMENT_POINTS = 35, 20, 15, 10, 10, 15
AGREEMENT_KM, REJECT_KM = 3.0, 60.0
FINE_GRAINED_TYPES = [
    "locality", "sublocality", "sublocality_level_1", "neighborhood", "postal_town", "village",
]
PRECISE_NAME_SCORE, TOWN_NAME_SCORE = 0.3, 0.75


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def _any_of(types: Column, names: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(types, F.array(*map(F.lit, names))), F.lit(False))


def admin_only(types: Column) -> Column:
    """No types at all, or administrative ones only."""
    return F.coalesce(F.size(F.array_except(types, F.array(*map(F.lit, ADMIN_TYPES)))) == 0, F.lit(True))


def _contains(text: Column, part: Column) -> Column:
    return F.coalesce((F.trim(part) != "") & F.contains(F.lower(text), F.lower(F.trim(part))), F.lit(False))


def reject_reason(name: Column, types: Column, market: Column, distance_km: Column) -> Column:
    """Why no score can save a candidate, or null."""
    place, core = core_name(place_name(market)), core_name(name)
    office = _any_of(types, OFFICE_TYPES) & ((place == "") | ~F.contains(core, place))
    return F.when(admin_only(types), "admin_only_type").when(office, "institutional_office_mismatch").when(distance_km > REJECT_KM, "distance_out_of_bound")


def candidate_score(name: Column, types: Column, address: Column, market: Column, district: Column, state: Column, words: Column, distance_km: Column, match: Column | None = None) -> Column:
    """Struct of score and reject_reason of a candidate; words: array of market words; match: the name score, if known."""
    reason = reject_reason(name, types, market, distance_km)
    has_word = F.exists(words, lambda w: F.contains(F.lower(name), w))
    points = (
        (name_match(market, name) if match is None else match) * NAME_POINTS
        + F.when(has_word, WORD_POINTS).otherwise(0)
        + F.when(_contains(address, district), DISTRICT_POINTS).otherwise(0)
        + F.when(_contains(address, state), STATE_POINTS).otherwise(0)
        + F.when(_any_of(types, MARKET_TYPES), TYPE_POINTS).otherwise(0)
    )
    return F.struct(F.when(reason.isNotNull(), 0.0).otherwise(F.round(points, 1)).alias("score"), reason.alias("reject_reason"))


def confidence(score: Column, agreed: Column) -> Column:
    return F.when(score >= 90, "HIGH").when(score >= 70, "MEDIUM").when(score >= 50, F.when(agreed, "MEDIUM").otherwise("LOW")).when(score > 0, "REVIEW").otherwise("UNRESOLVED")


def location_rank(c: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in LOCATION_RANK.items() for x in pair))
    return F.coalesce(F.try_element_at(table, c), F.lit(0))


def precise_enough(partial_match: Column, component_types: Column, best_name_score: Column) -> Column:
    """Whether a geocoder's result names a place rather than an area, and the place that was asked for."""
    return ~F.coalesce(partial_match, F.lit(False)) & _any_of(component_types, FINE_GRAINED_TYPES) & F.coalesce(best_name_score >= PRECISE_NAME_SCORE, F.lit(True))


def query_tokens(query: Column) -> Column:
    """Tokens of at least three characters of the place that a query asks for, its part before the first comma."""
    words = F.transform(core_words(F.split_part(query, F.lit(","), F.lit(1))), token)
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= 3))


def locality_tokens(components: Column) -> Column:
    """Tokens of the names of fine-grained address components, an array of (long_name, short_name, types)."""
    fine = F.filter(components, lambda c: _any_of(c["types"], FINE_GRAINED_TYPES))
    names = F.flatten(F.transform(fine, lambda c: F.array(token(c["long_name"]), token(c["short_name"]))))
    return F.array_distinct(F.filter(names, lambda w: F.coalesce(w, F.lit("")) != ""))


def locality_names(components: Column) -> Column:
    """Long names of the fine-grained components, in order."""
    fine = F.filter(components, lambda c: _any_of(c["types"], FINE_GRAINED_TYPES) & (F.coalesce(c["long_name"], F.lit("")) != ""))
    return F.transform(fine, lambda c: c["long_name"])


def village_precise(partial_match: Column, component_types: Column) -> Column:
    """The check for villages, without a name: no partial match and a fine-grained component."""
    return precise_enough(partial_match, component_types, F.lit(None).cast("double"))
