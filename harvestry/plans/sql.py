"""The library's functions for SQL: temporary scalar and table functions, and a check of what a session has.

register() defines them in a session; table functions read the views markets, crops and prices, which views() makes of a
store. Bodies are SQL, so Catalyst inlines them.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from harvestry.functions.text import MARKET_WORDS
from harvestry.schema import PER_ANIMAL_CROPS
from harvestry.sources.versions import Versions

_ANIMALS = ", ".join(map(str, PER_ANIMAL_CROPS))
_GRAMS = r"array_distinct(flatten(transform(filter(split(lower({0}), r'[^\p{{L}}\p{{N}}]+'), w -> w <> ''), w -> transform(sequence(1, length(w) + 1), i -> substring(concat('  ', w, ' '), i, 3)))))"
#: name: (parameters, result, body); a version of each, to be raised when a body's results change.
SCALARS = {
    "normalize_unit": ("unit string", "string", "lower(trim(coalesce(unit, '')))"),
    "normalize_kind": ("name string", "string", r"coalesce(nullif(trim(regexp_replace(lower(coalesce(name, '')), r'\s+', ' ')), ''), 'other')"),
    "normalize_market": ("name string", "string", rf"trim(regexp_replace(lower(regexp_replace(name, r'[()]', ' ')), r'\s*\b{MARKET_WORDS}\b\s*', ' '))"),
    "normalize_crop": ("name string", "string", r"trim(regexp_replace(lower(name), r'\s+', ' '))"),
    "trigrams": ("name string", "array<string>", _GRAMS.format("name")),
    "similarity": ("a string", "double", ""),
    "price_per_kilo": ("price double, crop_id bigint", "double", f"case when crop_id in ({_ANIMALS}) then price else price / 100 end"),
    "content_hash": (
        "modal double, low double, high double", "string",
        """sha2(concat('{"max_price":', coalesce(cast(cast(high as decimal(18,4)) as string), 'null'), ',"min_price":', coalesce(cast(cast(low as decimal(18,4)) as string), 'null'),
            ',"modal_price":', coalesce(cast(cast(modal as decimal(18,4)) as string), 'null'), '}'), 256)""",
    ),
}
SCALARS["similarity"] = (
    "a string, b string", "double",
    "coalesce(cast(size(array_intersect(trigrams(a), trigrams(b))) as double) / nullif(size(array_union(trigrams(a), trigrams(b))), 0), 0D)",
)
TABLES = {
    "merge_integrity": (
        "", "issue string, entity_id bigint, n bigint",
        """select 'price_on_merged_mandi', p.mandi_id, count(*) from prices p join markets m on m.id = p.mandi_id where m.status = 'MERGED' group by p.mandi_id
           union all select 'price_on_merged_crop', p.crop_id, count(*) from prices p join crops c on c.id = p.crop_id where c.status = 'MERGED' group by p.crop_id""",
    ),
    "prices_of_market": ("market bigint, since date", "crop_id bigint, variety string, grade string, price_date date, modal_price double", "select crop_id, variety, grade, price_date, modal_price from prices where mandi_id = market and price_date >= since"),
    "markets_like": ("wanted string, least double", "id bigint, name string, score double", "select id, name, similarity(normalized_name, wanted) from markets where status = 'ACTIVE' and similarity(normalized_name, wanted) > least"),
}
VERSION = 1


def register(spark: SparkSession) -> None:
    for name, (parameters, result, body) in SCALARS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {result} comment 'version {VERSION}' return {body}")


def views(store: Versions) -> None:
    """Views of a store's tables, and the table functions that read them."""
    register(store.spark)
    for table in ("markets", "crops", "prices"):
        store.read(table).createOrReplaceTempView(table)
    for name, (parameters, result, body) in TABLES.items():
        store.spark.sql(f"create or replace temporary function {name}({parameters}) returns table({result}) comment 'version {VERSION}' return {body}")


def described(spark: SparkSession, name: str) -> str | None:
    """What the session knows about a function; None if it doesn't know it."""
    if not spark.catalog.functionExists(name):
        return None
    return "\n".join(r[0] for r in spark.sql(f"describe function extended {name}").collect())


def missing(spark: SparkSession, tables: bool = True) -> list[str]:
    """Functions that a session lacks or has with other parameters or another version, with what is wrong."""
    wrong = []
    for name, (parameters, _, _) in (SCALARS | (TABLES if tables else {})).items():
        text = described(spark, name)
        if text is None:
            wrong.append(f"function {name}: missing")
            continue
        wanted = [p.split() for p in parameters.split(", ") if p]
        if any(not re.search(rf"\b{p}\s+{kind}\b", text, re.IGNORECASE) for p, kind in wanted):
            wrong.append(f"function {name}: other parameters than ({parameters})")
        elif f"version {VERSION}" not in text:
            wrong.append(f"function {name}: not version {VERSION}")
    return wrong
