"""Normalisation of names, as expressions on columns."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing of a place.
MARKET_WORDS = r"(?:apmc|mandi|market|f\s*&?\s*v|grain|sandhai|committee)"
FILLER_WORDS = [
    "apmc", "mandi", "market", "committee", "sub-yard", "sub", "yard", "vfpck", "grain", "veg", "new", "old", "north", "south", "main", "tal",
    "taluka", "dist", "district", "agriculture", "produce", "uzhavar", "sandhai", "sandha", "board", "society", "samiti", "office", "department",
    "govt", "government", "corporation", "union", "sangh", "seva", "cooperative", "co-operative", "state", "krishi", "upaj",
]
PLACE_SUFFIXES = ["vfpck market", "vfpck  market", "market", "apmc", "sub-yard", "sub yard", "mandi", "vfpck"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def collapse(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), r"\s+", " "))


def normalize_name(c: Column | str) -> Column:
    """Market and crop names: lower case, "&" as "and", dots and commas as spaces; null is empty."""
    text = F.replace(F.lower(strip(F.coalesce(_col(c), F.lit("")))), F.lit("&"), F.lit(" and "))
    return collapse(F.regexp_replace(text, "[.,]", " "))


def normalize_kind(c: Column | str) -> Column:
    """Varieties and grades: null or blank is "other"."""
    text = collapse(F.lower(F.coalesce(_col(c), F.lit(""))))
    return F.when(text == "", "other").otherwise(text)


def normalize_unit(c: Column | str) -> Column:
    return F.lower(F.trim(F.coalesce(_col(c), F.lit(""))))


def market_key(c: Column | str) -> Column:
    """Match key of a market: its name without brackets and generic market words. Inner double spaces stay."""
    text = F.lower(F.regexp_replace(_col(c), r"[()]", " "))
    return F.trim(F.regexp_replace(text, rf"\s*\b{MARKET_WORDS}\b\s*", " "))


def crop_key(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(_col(c)), r"\s+", " "))


def display_name(c: Column | str) -> Column:
    """Words with a capital first letter, also after signs: the part after a hyphen or bracket starts a word."""
    parts = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"([^\p{L}\p{N}]*[\p{L}\p{N}]*)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.regexp_extract(p, r"^[^\p{L}\p{N}]*", 0), F.initcap(F.regexp_extract(p, r"[\p{L}\p{N}]+", 0)))), "")


def slug(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def slug_with_suffix(c: Column | str, key: Column | str) -> Column:
    """A slug made unique by six digits of its key's hash."""
    return F.concat(slug(c), F.lit("-"), F.substring(F.md5(_col(key).cast("string")), 1, 6))


def token(c: Column | str) -> Column:
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "")


def core_words(c: Column | str) -> Column:
    """Words of a name that identify a place: no brackets, no filler words."""
    words = F.split(F.regexp_replace(F.lower(_col(c)), r"\([^)]*\)", " "), "[^a-z0-9]+")
    filler = F.array(*map(F.lit, FILLER_WORDS))
    return F.filter(words, lambda w: (w != "") & ~F.array_contains(filler, w))


def core_name(c: Column | str) -> Column:
    return F.array_join(core_words(c), " ")


def place_name(c: Column | str) -> Column:
    """A market's name without the suffixes of markets and organisations, in order, and what follows a bracket."""
    cut = lambda name, suffix: F.when(F.endswith(F.lower(name), suffix), strip(F.left(name, F.length(name) - F.length(suffix)))).otherwise(name)
    name = F.aggregate(F.array(*map(F.lit, PLACE_SUFFIXES)), strip(c), cut)
    return strip(F.split_part(name, F.lit("("), F.lit(1)))


def ratio(a: Column | str, b: Column | str) -> Column:
    """Ratcliff-Obershelp similarity of two strings: longest common blocks, recursively. The one Python function here."""

    @F.pandas_udf("double")
    def matched(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, p, q).ratio() if p is not None and q is not None else None for p, q in zip(x, y, strict=True)], dtype="float64")

    return matched(_col(a), _col(b))


def name_match(a: Column | str, b: Column | str, bonus: float = 0.35) -> Column:
    """Score of two names from 0 to 1: ratio of their core names plus a bonus for a shared word; 0 if either has none."""
    x, y = core_words(a), core_words(b)
    shared = F.when(F.arrays_overlap(x, y), bonus).otherwise(0.0)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.least(F.lit(1.0), ratio(F.array_join(x, " "), F.array_join(y, " ")) + shared))


def name_match_or_shared(a: Column | str, b: Column | str) -> Column:
    """The older score: 1 for a shared core word, else the ratio."""
    x, y = core_words(a), core_words(b)
    none = (F.size(x) == 0) | (F.size(y) == 0)
    return F.when(none, 0.0).when(F.arrays_overlap(x, y), 1.0).otherwise(ratio(F.array_join(x, " "), F.array_join(y, " ")))


def state_tag(c: Column | str) -> Column:
    """X of a message that begins with [state=X]; null if it doesn't."""
    return F.nullif(F.regexp_extract(_col(c), r"^\[state=([^\]]*)\]", 1), F.lit(""))


def is_row_error(code: Column | str) -> Column:
    from harvestry.schema import ROW_ERROR_CLASS, ROW_ERROR_CODES

    return _col(code).isin(*ROW_ERROR_CODES) | F.startswith(_col(code), F.lit(ROW_ERROR_CLASS))
