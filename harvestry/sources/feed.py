"""A paged feed as a Spark data source: one partition per state, pages until a short one, retries with linear back-off.

Pages come from files <folder>/<state>/<page>.json, each {"total": n, "records": [...]}, or from any function that an
option names as module:function and that takes (state, page) and returns such a dict. Each row carries its page, so that
missing pages show in the rows: columns state, page, ok, error, total, record map<string,string>, place (in its page). A
page that fails after all retries gives one row with ok = false and without record, and ends its state.

As a stream the feed has an offset per state, the number of its pages so far: each page is read once, in the micro-batch
whose offsets hold it, also when that batch is planned again. A failed page gives its row and doesn't hold up others. How
many pages a state has is counted in the folder, or told by a function of the state that the option `pages` names.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from harvestry.schema import STATES

SCHEMA = "state string, page int, ok boolean, error string, total long, record map<string,string>, place int"


def fetch(get: Callable[[str, int], dict], state: str, page: int, retries: int, delay: float) -> tuple[dict | None, str | None]:
    """(page, None) or (None, error): at most retries + 1 attempts, waiting delay, 2 delay, ... in between."""
    error = None
    for attempt in range(1, max(retries, 0) + 2):
        try:
            return get(state, page), None
        except Exception as e:  # noqa: BLE001  whatever a feed raises counts as a failed attempt
            error = f"{type(e).__name__}: {e}"
            if attempt <= max(retries, 0):
                time.sleep(delay * attempt)
    return None, error


class StatePartition(InputPartition):
    def __init__(self, state: str):
        self.state = state


class PagePartition(InputPartition):
    def __init__(self, state: str, page: int):
        self.state, self.page = state, page


def _named(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class Pages:
    """Pages of a folder, or of a function that an option names."""

    def __init__(self, options: dict):
        self.folder, self.function, self.counter = options.get("path"), options.get("function"), options.get("pages")
        self.size, self.retries, self.delay = int(options.get("pagesize", 500)), int(options.get("retries", 2)), float(options.get("delay", 1.0))
        self.states = [s.strip() for s in options.get("states", "\n".join(STATES)).split("\n")]

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.folder if "://" in self.folder else f"file://{self.folder}")

    def get(self) -> Callable[[str, int], dict]:
        if self.function:
            return _named(self.function)

        def from_file(state: str, page: int) -> dict:
            from pyarrow import fs

            system, root = self._files()
            name = f"{root}/{state}/{page}.json"
            if system.get_file_info(name).type == fs.FileType.NotFound:
                return {"total": 0, "records": []}
            with system.open_input_stream(name) as file:
                return json.loads(file.read())

        return from_file

    def count(self, state: str) -> int:
        """Pages 0, 1, ... that a state has without a gap."""
        if self.counter:
            return int(_named(self.counter)(state))
        from pyarrow import fs

        system, root = self._files()
        found = system.get_file_info(fs.FileSelector(f"{root}/{state}", allow_not_found=True))
        numbers = {f.base_name for f in found}
        n = 0
        while f"{n}.json" in numbers:
            n += 1
        return n

    def rows(self, state: str, page: int, found: dict | None, error: str | None) -> Iterator[tuple]:
        if found is None:
            yield state, page, False, error, None, None, None
            return
        for place, r in enumerate(found["records"]):
            yield state, page, True, None, int(found.get("total") or 0), {str(k): None if v is None else str(v) for k, v in r.items()}, place


class FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.pages = Pages(options)

    def partitions(self) -> list[InputPartition]:
        return [StatePartition(s) for s in self.pages.states]

    def read(self, partition: StatePartition) -> Iterator[tuple]:
        own, page = self.pages, 0
        get = own.get()
        while True:
            found, error = fetch(get, partition.state, page, own.retries, own.delay)
            yield from own.rows(partition.state, page, found, error)
            if found is None or len(found["records"]) < own.size:
                return
            page += 1


class FeedStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.pages = Pages(options)

    def initialOffset(self) -> dict:
        return dict.fromkeys(self.pages.states, 0)

    def latestOffset(self) -> dict:
        return {s: self.pages.count(s) for s in self.pages.states}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [PagePartition(s, page) for s, n in end.items() for page in range(start.get(s, 0), n)]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        own = self.pages
        yield from own.rows(partition.state, partition.page, *fetch(own.get(), partition.state, partition.page, own.retries, own.delay))


class Feed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "price_feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(self.options)


    def streamReader(self, schema) -> DataSourceStreamReader:
        return FeedStreamReader(self.options)


def read_feed(spark: SparkSession, **options) -> DataFrame:
    spark.dataSource.register(Feed)
    return spark.read.format("price_feed").options(**{k: str(v) for k, v in options.items()}).load()


def stream_feed(spark: SparkSession, **options) -> DataFrame:
    spark.dataSource.register(Feed)
    return spark.readStream.format("price_feed").options(**{k: str(v) for k, v in options.items()}).load()


def write_pages(pages: DataFrame, folder: str) -> int:
    """Write pages(state, page, body) as <folder>/<state>/<page>.json from the tasks that hold them; the number of pages."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            for state, page, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system.create_dir(f"{root}/{state}", recursive=True)
                with system.open_output_stream(f"{root}/{state}/{page}.json") as file:
                    file.write(body.encode())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return pages.select(F.col("state").cast("string"), F.col("page").cast("int"), "body").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]


def page_report(rows: DataFrame) -> DataFrame:
    """Per state: captured rows, reported total, failed pages, and whether the scan is complete."""
    stats = rows.groupBy("state").agg(F.count_if(F.col("record").isNotNull()).alias("captured"), F.coalesce(F.max("total"), F.lit(0)).alias("reported"), F.count_if(~F.col("ok")).alias("failed_pages"))
    return stats.withColumn("complete", (F.col("failed_pages") == 0) & (F.col("captured") >= F.col("reported")))
