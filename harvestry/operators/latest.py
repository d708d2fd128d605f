"""Latest rows per key, as-of values, and the price cache made of them."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harvestry.functions.prices import percent_change
from harvestry.schema import PRIOR_WINDOWS
from harvestry.sources.staging import staged


def latest(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The row of each key with the greatest order (columns from most to least significant, nulls the least). Spark keeps one
    row per key and partition before the shuffle; the order should be total."""
    place = f"place_{uuid.uuid4().hex}"
    by = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    return df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col(place) == 1).drop(place)


def newest_date(df: DataFrame, date: str = "price_date"):
    """The newest date of all rows: one value, so that filters on it prune partitions."""
    return df.agg(F.max(date)).head()[0]


def prior_values(df: DataFrame, keys: list[str], value: str, date: str = "price_date", anchor=None, windows: dict[str, tuple[int, int]] = PRIOR_WINDOWS) -> DataFrame:
    """One row per key: for each window of days before the anchor (by default the newest date of all rows) the latest
    value in it. All windows come from one pass over the rows within them."""
    anchor = anchor or newest_date(df, date)
    day = lambda n: F.date_sub(F.lit(anchor), n)
    inside = {name: F.col(date).between(day(far), day(near)) for name, (far, near) in windows.items()}
    recent = df.where(F.col(date).between(day(max(f for f, _ in windows.values())), day(min(n for _, n in windows.values()))))
    return recent.groupBy(*keys).agg(*(F.max_by(value, F.when(c, F.col(date))).alias(f"prior_{name}") for name, c in inside.items()))


def _with_changes(rows: DataFrame, keys: list[str], value: str, newest: str) -> DataFrame:
    now, changes = F.col(value), {}
    for name in PRIOR_WINDOWS:
        before = F.col(f"prior_{name}")
        changes |= {f"change_{name}": F.round(now - before, 4), f"change_{name}_pct": percent_change(now, before)}
    return rows.select(*keys, F.col(newest).alias("latest_price_date"), value, *(c.alias(n) for n, c in changes.items()))


def price_cache(prices: DataFrame, keys: list[str], value: str = "modal_price", date: str = "price_date", order: list | None = None) -> DataFrame:
    """keys, latest_price_date, value, and for each window the change against the prior value, absolute and in percent;
    null where there is none. prices has one row per key and date, or `order` breaks ties. The rows are written once; one
    aggregation takes the newest and all prior values."""
    order = [c for c in order or [] if c not in (date, value)]
    rows = staged(prices.select(*keys, date, value, *order), "observations")
    anchor = newest_date(rows, date)
    day = lambda n: F.date_sub(F.lit(anchor), n)
    rank = F.struct(date, *order) if order else F.col(date)
    priors = {name: F.max_by(value, F.when(F.col(date).between(day(far), day(near)), rank)) for name, (far, near) in PRIOR_WINDOWS.items()}
    both = rows.groupBy(*keys).agg(F.max(date).alias(f"latest_{date}"), F.max_by(value, rank).alias(value), *(c.alias(f"prior_{n}") for n, c in priors.items()))
    return _with_changes(both, keys, value, f"latest_{date}")


def _window_days(anchor: datetime.date) -> dict[str, set[datetime.date]]:
    return {n: {anchor - datetime.timedelta(days=k) for k in range(near, far + 1)} for n, (far, near) in PRIOR_WINDOWS.items()}


def maintained(cache: DataFrame | None, read: Callable[[list[datetime.date]], DataFrame], keys: list[str], days: list[datetime.date], before: datetime.date | None, value: str = "modal_price", date: str = "price_date") -> DataFrame:
    """A price cache after a batch that added or changed rows of some days, equal to one built from all rows.

    before is the newest date that the cache was made for. read gives the rows after the batch, one per key and date, of
    some dates: only the batch's days, the three windows, and the days that entered or left a window because the newest date
    moved. Keys without a row on the batch's or those edge days keep their row; a key that was touched on an edge
    only keeps its latest price. Batches don't delete rows."""
    after = max([*days, *([before] if before else [])])
    now = _window_days(after)
    was = _window_days(before) if before else {n: set() for n in now}
    edges = set().union(*(now[n] ^ was[n] for n in now)) if after != before else set()
    rows = staged(read(sorted(set(days) | edges | set().union(*now.values()))).select(*keys, date, value), "touched")
    on_days, on_edges = F.col(date).isin(sorted(days)), F.col(date).isin(sorted(edges)) if edges else F.lit(False)
    inside = {n: F.max_by(value, F.when(F.col(date).isin(sorted(own)), F.col(date))) for n, own in now.items()}
    newest = {"day": F.max(F.when(on_days, F.col(date))), "price": F.max_by(value, F.when(on_days, F.col(date)))}
    found = rows.groupBy(*keys).agg(F.bool_or(on_days | on_edges).alias("hit"), *(c.alias(n) for n, c in newest.items()), *(c.alias(f"prior_{n}") for n, c in inside.items())).where("hit")
    if cache is None:
        return _with_changes(found.withColumnRenamed("price", value), keys, value, "day")
    both = found.join(cache.select(*keys, "latest_price_date", F.col(value).alias("old")), keys, "left")
    later = F.col("day").isNotNull() & F.coalesce(F.col("day") >= F.col("latest_price_date"), F.lit(True))
    both = both.withColumns({"newest": F.when(later, F.col("day")).otherwise(F.col("latest_price_date")), value: F.when(later, F.col("price")).otherwise(F.col("old"))})
    return cache.join(found.select(*keys), keys, "left_anti").unionByName(_with_changes(both, keys, value, "newest"))
