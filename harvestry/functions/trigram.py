"""Trigram similarity of strings: distinct trigrams of padded words, shared over all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(c: Column) -> Column:
    """Distinct trigrams of a string's words, each padded with two spaces before and one after."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    parts = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(parts))


def gram_codes(c: Column) -> Column:
    """The trigrams of a string as numbers, the code points of each side by side: as distinct, and faster to compare."""
    point = lambda g, i: F.ascii(F.substring(g, i, 1)).cast("long")
    return F.transform(trigrams(c), lambda g: point(g, 1) * (1 << 42) + point(g, 2) * (1 << 21) + point(g, 3))


def overlap(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct trigrams; 0 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b)
    return F.when(both == 0, 0.0).otherwise(shared.cast("double") / (both - shared))


def similarity(a: Column, b: Column) -> Column:
    return overlap(trigrams(a), trigrams(b))
