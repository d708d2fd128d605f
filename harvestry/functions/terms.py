"""Words for markets by state, and search queries made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvestry.functions.text import place_name

# Fixed values, by lower-case state.
STATE_TERMS = {
    "kerala": ["VFPCK", "farmers market", "wholesale market", "agricultural market", "regulated market", "market"],
    "tamil nadu": ["Uzhavar Sandhai", "regulated market", "agricultural market", "market yard", "farmers market"],
    "andhra pradesh": ["Rythu Bazar", "market yard", "Agricultural Market Committee", "AMC", "agricultural market"],
    "telangana": ["Rythu Bazar", "market yard", "Agricultural Market Committee", "AMC", "agricultural market"],
    "haryana": ["APMC", "New Grain Market", "Anaj Mandi", "Mandi", "Market Committee", "Market Yard"],
    "punjab": ["Mandi Board", "Grain Market", "Anaj Mandi", "Market Committee", "Mandi"],
    "rajasthan": ["Krishi Upaj Mandi", "Mandi Samiti", "Anaj Mandi", "Agricultural Market"],
    "uttar pradesh": ["Krishi Utpadan Mandi Samiti", "Mandi Samiti", "Mandi", "Agricultural Market"],
    "madhya pradesh": ["Krishi Upaj Mandi", "Mandi Samiti", "Mandi", "Market Yard"],
    "maharashtra": ["APMC", "Agricultural Produce Market Committee", "Market Yard", "Krushi Utpanna Bazar Samiti", "Mandi"],
    "karnataka": ["APMC", "Agricultural Produce Market", "Regulated Market", "Market Yard"],
    "gujarat": ["APMC", "Agricultural Market", "Market Yard"],
    "west bengal": ["Regulated Market Committee", "wholesale market", "agricultural market"],
    "odisha": ["Regulated Market Committee", "Market Yard", "agricultural market"],
    "chhattisgarh": ["Krishi Upaj Mandi", "Mandi Samiti", "Mandi"],
    "bihar": ["agricultural market", "market yard", "regulated market"],
    "jammu and kashmir": ["fruit and vegetable market", "F&V mandi", "wholesale market", "agricultural market"],
}
DEFAULT_TERMS = ["APMC", "agricultural market", "mandi", "market yard", "wholesale market", "regulated market"]
INDICATOR_WORDS = [
    "apmc", "mandi", "market", "bazar", "bazaar", "sandhai", "santhai", "sandha", "rythu", "vfpck", "krishi", "upaj", "samiti", "yard", "committee",
    "anaj", "grain", "wholesale", "regulated", "amc", "produce", "utpanna", "utpadan", "krushi",
]
#: Spellings of the feed for states that the terms know by another name.
STATE_SPELLINGS = {"keralam": "kerala", "chattisgarh": "chhattisgarh"}


def words() -> Column:
    return F.array(*map(F.lit, INDICATOR_WORDS))


def terms_for(state: Column, respell: bool = False) -> Column:
    """Market terms of a state, in order; the default ones for others."""
    key = F.lower(F.trim(F.coalesce(state, F.lit(""))))
    if respell:
        for spelling, name in STATE_SPELLINGS.items():
            key = F.when(key == spelling, name).otherwise(key)
    array = lambda terms: F.array(*map(F.lit, terms))
    table = F.create_map(*(x for name, terms in STATE_TERMS.items() for x in (F.lit(name), array(terms))))
    return F.coalesce(F.try_element_at(table, key), array(DEFAULT_TERMS))


def _location(district: Column, state: Column) -> Column:
    return F.concat_ws(", ", F.nullif(district, F.lit("")), F.nullif(state, F.lit("")), F.lit("India"))


def places_queries(name: Column, district: Column, state: Column) -> Column:
    """At most two searches: the name with the state's first two terms."""
    where = _location(district, state)
    return F.transform(F.slice(terms_for(state), 1, 2), lambda t: F.concat(name, F.lit(" "), t, F.lit(", "), where))


def osm_queries(name: Column, district: Column, state: Column) -> Column:
    """The bare name, three terms, and the place's name where it differs."""
    where, place = _location(district, state), place_name(name)
    more = F.transform(F.slice(terms_for(state), 1, 3), lambda t: F.concat(name, F.lit(" "), t, F.lit(", "), where))
    last = F.array(F.concat(place, F.lit(" market, "), where), F.concat(place, F.lit(", "), where))
    none = F.array().cast("array<string>")
    return F.concat(F.array(F.concat(name, F.lit(", "), where)), more, F.when(F.lower(place) != F.lower(name), last).otherwise(none))


def geocoder_queries(name: Column, district: Column, state: Column) -> Column:
    """Queries of a geocoder, best first: the name with its district, as a mandi and as a market if it names neither,
    without the district, and the place it is named after, where that differs."""
    low, place = F.lower(name), place_name(name)
    wide, near = F.concat(F.lit(", "), state, F.lit(", India")), F.concat(F.lit(", "), F.coalesce(district, F.lit("")), F.lit(", "), state, F.lit(", India"))
    bare = ~F.contains(low, F.lit("mandi")) & ~F.contains(low, F.lit("market"))
    named = F.coalesce(district, F.lit("")) != ""
    other = (place != "") & (F.lower(place) != low)
    return F.array_compact(
        F.array(
            F.concat(name, near),
            F.when(bare, F.concat(name, F.lit(" mandi"), near)),
            F.when(bare, F.concat(name, F.lit(" market"), near)),
            F.when(named, F.concat(name, wide)),
            F.when(other, F.concat(place, near)),
            F.when(other, F.concat(place, wide)),
        )
    )
