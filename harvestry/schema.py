"""Schemas, closed vocabularies and rank tables of the price pipeline, and schema checks for jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed values.
SOURCE_RANK = {"manual": 3, "resource_2": 2, "resource_1": 1}
SOURCE_CONFIDENCE = {"manual": 1.0, "resource_2": 0.9, "resource_1": 0.7}
OTHER_SOURCE_CONFIDENCE = 0.5
LOCATION_RANK = {"HIGH": 4, "MEDIUM": 3, "LOW": 2, "REVIEW": 1}
BATCH_STATUS = ("RUNNING", "SUCCESS", "PARTIAL", "FAILED")
ENTITY_STATUS = ("ACTIVE", "MERGED", "INACTIVE", "UNKNOWN")
PER_ANIMAL_CROPS = (210, 211, 214, 234, 257, 260, 273, 274)
STALE_LOCK_MINUTES = 90
CALL_FAILED = "INGEST-001"
MARKET_FUZZY, CROP_FUZZY = 0.5, 0.6
MARKET_SWEEP, CROP_SWEEP = 0.4, 0.5
NORMALIZATION_VERSION = RPC_VERSION = PARSER_VERSION = 1
STATES = [
    "Andhra Pradesh", "Arunachal Pradesh", "Assam", "Bihar", "Chattisgarh", "Goa", "Gujarat", "Haryana", "Himachal Pradesh", "Jharkhand", "Karnataka",
    "Keralam", "Madhya Pradesh", "Maharashtra", "Manipur", "Meghalaya", "Mizoram", "Nagaland", "Odisha", "Punjab", "Rajasthan", "Sikkim",
    "Tamil Nadu", "Telangana", "Tripura", "Uttar Pradesh", "Uttarakhand", "West Bengal", "NCT of Delhi", "Jammu and Kashmir", "Puducherry",
    "Chandigarh", "Andaman and Nicobar",
]
#: Windows of days before the newest date in which a prior price is looked for.
PRIOR_WINDOWS = {"1d": (3, 1), "7d": (10, 4), "1m": (35, 25)}
#: SQLSTATE prefixes of errors that concern a single row.
ROW_ERROR_CODES, ROW_ERROR_CLASS = ("23514", "23502"), "22"

PRICE_KEY = ["mandi_id", "crop_id", "variety", "grade", "price_date", "source_mandi_id"]
RAW_KEY = ["resource", "market", "state", "district", "commodity", "raw_variety", "raw_grade", "price_date"]

MARKETS = "id long, slug string, name string, normalized_name string, state string, district string, latitude double, longitude double, location_confidence string, status string, merged_into_id long, last_seen_at timestamp"
CROPS = "id long, name string, normalized_name string, unit string, status string, merged_into_id long"
ALIASES = "owner_id long, alias_name string, normalized_alias string, match_method string, match_confidence double, approved boolean"
DISTRICT_ALIASES = "state string, alias_district string, canonical_district string"
PRICES = (
    "mandi_id long, crop_id long, variety string, grade string, price_date date, modal_price double, min_price double, max_price double, unit string, "
    "source string, source_mandi_id long, source_mandi_name string, batch_id string, quality_score double"
)
RAW_ENTRIES = (
    "resource string, market string, state string, district string, commodity string, raw_variety string, raw_grade string, price_date date, "
    "modal_price double, min_price double, max_price double, content_hash string, first_seen_batch_id string, last_seen_batch_id string"
)
BATCHES = "id string, job_name string, resource string, started_at timestamp, completed_at timestamp, status string, rows_processed long, rows_failed long"
ALERTS = "error_code string, severity string, message string, entity_type string, entity_id string, status string"
CANDIDATES = "market_id long, ord int, name string, lat double, lng double, place_types array<string>, formatted_address string, provider string"


def typed(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema


def assert_schema(df: DataFrame, ddl: str) -> DataFrame:
    """df, if it has at least the columns of a DDL string with their types; an error that names all differences otherwise."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in typed(df.sparkSession, ddl)}
    wrong = [f"{c}: {have.get(c, 'missing')} instead of {t}" for c, t in want.items() if have.get(c) != t]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df


def difference(expected: list[str], found: list[str]) -> dict[str, list[str]]:
    """Names that are missing from or extra in what was found."""
    return {"missing": sorted(set(expected) - set(found)), "extra": sorted(set(found) - set(expected))}
