"""Sharded tables with size-tiered compaction and versioned manifests.

A store is a folder with immutable shards (Parquet files under data/) and one manifest per version under manifest/. An
append writes its rows as new small shards. Compaction sorts shards into tiers by size, each `ratio` times the one below.
A tier with a run of at least `min_run` shards is read and written again in files of the next tier's size, or of the
target size where that is less, by tasks that read several shards each, without a shuffle. Merged files enter a larger
tier and may merge again; a row is thus rewritten once per tier at most. Shards from half the target size on stay. A
manifest says which shards a compaction merged into which.

A version becomes visible by one rename that fails if its name is taken, so of two writers one wins and the other must
start again from the new version; readers see whole versions only. Files of a job that failed belong to no version.
An append that loses commits the files it has written on top of the new version; a compaction that loses does so if the
files it merged are all there still, and starts again otherwise. expire() deletes what only older versions name; vacuum() deletes
also what no version names, unless it is so young that a writer may be about to commit it.

Defined results: rows are kept exactly as they are, with nulls, repeated rows and all columns; an append without rows
makes a version without new shards; a store without versions reads as None.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harvestry.llm.common import scratch_path

TARGET_BYTES, SMALL_BYTES, RATIO, MIN_RUN = 64 << 20, 1 << 20, 8, 4
#: Age in seconds below which files without a version stay; times that a writer commits anew.
GRACE, COMMITS = 86_400, 20


class CommitConflict(RuntimeError):
    """Another writer has committed the version meanwhile."""


class ShardStore:
    def __init__(self, spark: SparkSession, path: str, small_bytes: int = SMALL_BYTES, target_bytes: int = TARGET_BYTES, ratio: int = RATIO, min_run: int = MIN_RUN):
        self.spark, self.path = spark, path.rstrip("/")
        self.small, self.target, self.ratio, self.min_run = small_bytes, target_bytes, ratio, min_run
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # manifests

    def _list(self, folder: str) -> list[tuple[str, int]]:
        where = self._hadoop.Path(f"{self.path}/{folder}")
        if not self._files.exists(where):
            return []
        return sorted((s.getPath().getName(), s.getLen()) for s in self._files.listStatus(where))

    def versions(self) -> list[int]:
        return [int(name[1:-5]) for name, _ in self._list("manifest") if name.endswith(".json") and name.startswith("v")]

    def manifest(self, version: int | None = None) -> dict | None:
        """A version's manifest, by default the latest one's."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        stream = self._files.open(self._hadoop.Path(f"{self.path}/manifest/v{version:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, parent: dict | None, schema: str, shards: list[dict], what: str, merged: list[dict] | None = None) -> dict:
        version = parent["version"] + 1 if parent else 1
        made = {"version": version, "parent": parent and parent["version"], "operation": what, "schema": schema, "merged": merged or [], "shards": sorted(shards, key=lambda s: s["file"])}
        draft = self._hadoop.Path(f"{self.path}/manifest/.{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        stream.write(bytearray(json.dumps(made).encode()))
        stream.close()
        final = self._hadoop.Path(f"{self.path}/manifest/v{version:08d}.json")
        context = self._hadoop.FileContext.getFileContext(final.toUri() if "://" in self.path else self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(draft, final, no_overwrite)
        except Exception as e:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise CommitConflict(f"version {version} exists") from e
            raise
        return made

    # shards

    def tier(self, size: int) -> int:
        t, bound = 0, self.small
        while size > bound:
            t, bound = t + 1, bound * self.ratio
        return t

    def _found(self, folder: str) -> list[tuple[str, int]]:
        """Names and sizes of the Parquet files of a folder and its folders."""
        out = []
        for s in self._files.listStatus(self._hadoop.Path(f"{self.path}/{folder}")):
            name = s.getPath().getName()
            if s.isDirectory():
                out += [(f"{name}/{below}", size) for below, size in self._found(f"{folder}/{name}")]
            elif name.endswith(".parquet"):
                out.append((name, s.getLen()))
        return out

    def _write(self, rows: DataFrame, max_rows: int = 0, by: str | None = None) -> list[dict]:
        """Rows as new files, one per task (and value of a column, which isn't stored) or more; what the manifest says of each."""
        folder = f"data/{uuid.uuid4().hex}"
        writer = rows.write.option("compression", "zstd").option("maxRecordsPerFile", max_rows)
        (writer.partitionBy(by) if by else writer).parquet(f"{self.path}/{folder}")
        found = self._found(folder)
        if not found:
            return []
        counts = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}").groupBy(F.input_file_name().alias("file")).count().collect()  # a row per file
        n = {r["file"].rsplit(f"{folder}/", 1)[1]: r["count"] for r in counts}
        out = []
        for file, size in found:
            if file in n:
                out.append({"file": f"{folder}/{file}", "bytes": size, "rows": n[file], "tier": self.tier(size), "merges": 0, "sources": 0})
            else:
                self._files.delete(self._hadoop.Path(f"{self.path}/{folder}/{file}"), False)
        return out

    def _append(self, schema: str, made: list[dict]) -> dict:
        parent = self.manifest()
        for _ in range(COMMITS):
            if parent and [(f.name, f.dataType) for f in StructType.fromJson(json.loads(schema))] != [(f.name, f.dataType) for f in StructType.fromJson(json.loads(parent["schema"]))]:
                raise ValueError("the rows' columns differ from the store's")
            try:
                return self._commit(parent, parent["schema"] if parent else schema, (parent["shards"] if parent else []) + made, "append")
            except CommitConflict:
                parent = self.manifest()
        raise CommitConflict(f"{COMMITS} commits lost")

    def append(self, rows: DataFrame, max_rows: int = 0) -> dict:
        """Add rows as small shards and commit them as a new version."""
        parent = self.manifest()
        if parent and [(f.name, f.dataType) for f in rows.schema] != [(f.name, f.dataType) for f in StructType.fromJson(json.loads(parent["schema"]))]:
            raise ValueError("the rows' columns differ from the store's")
        return self._append(rows.schema.json(), self._write(rows, max_rows))

    def dealt(self, rows: DataFrame, by: Column, n: int) -> list[list[dict]]:
        """Shards of n arrivals, written in one pass: rows go to the arrival of a number from 0 to n - 1. arrive() commits them."""
        column = f"arrival_{uuid.uuid4().hex}"
        out: list[list[dict]] = [[] for _ in range(n)]
        for s in self._write(rows.withColumn(column, by), by=column):
            out[int(s["file"].split("=")[1].split("/")[0])].append(s)
        return out

    def arrive(self, schema: StructType, shards: list[dict]) -> dict:
        """Commit one arrival as a new version."""
        return self._append(schema.json(), [s | {"tier": self.tier(s["bytes"])} for s in shards])

    def _frame(self, manifest: dict, shards: list[dict]) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        if not shards:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{s['file']}" for s in shards))

    def read(self, version: int | None = None) -> DataFrame | None:
        manifest = self.manifest(version)
        return manifest and self._frame(manifest, manifest["shards"])

    def runs(self, manifest: dict) -> list[list[dict]]:
        """Runs of similarly sized shards that are due for merging, smallest tier first. Shards from half the target on stay."""
        tiers: dict[int, list[dict]] = {}
        for s in manifest["shards"]:
            if s["bytes"] < self.target // 2:
                tiers.setdefault(s["tier"], []).append(s)
        return [sorted(run, key=lambda s: (-s["bytes"], s["file"])) for _, run in sorted(tiers.items()) if len(run) >= self.min_run]

    def compact(self) -> dict | None:
        """Merge the runs of all tiers until none is due; a version per pass. Returns the latest manifest."""
        manifest = self.manifest()
        while manifest and (due := self.runs(manifest)):
            old, made, merged = {s["file"] for run in due for s in run}, [], []
            for run in due:
                size = min(self.target, self.small * self.ratio ** (run[0]["tier"] + 1))
                files = min(max(1, round(sum(s["bytes"] for s in run) / size)), len(run) // 2)
                into = self._write(self._frame(manifest, run).coalesce(files))
                into = [s | {"merges": 1 + max(r["merges"] for r in run), "sources": len(run)} for s in into]
                made += into
                merged.append({"tier": run[0]["tier"], "from": [s["file"] for s in run], "into": [s["file"] for s in into]})
            for _ in range(COMMITS):
                if not old <= {s["file"] for s in manifest["shards"]}:
                    break  # another compaction took some of them
                try:
                    manifest = self._commit(manifest, manifest["schema"], [s for s in manifest["shards"] if s["file"] not in old] + made, "compact", merged)
                    break
                except CommitConflict:
                    manifest = self.manifest()
        return manifest

    def lineage(self) -> DataFrame:
        """version, tier, shard, source: which shards each compaction merged into which, a row per pair of a run."""
        rows = [(v, m["tier"], new, old) for v in self.versions() for m in self.manifest(v)["merged"] for new in m["into"] for old in m["from"]]
        return self.spark.createDataFrame(rows, "version int, tier int, shard string, source string")

    def expire(self, keep: int = 1) -> int:
        """Delete shards that older versions name and none of the last `keep`; the number of deleted files. Files that no
        version names yet stay."""
        versions = self.versions()
        named = {s["file"] for v in versions[-keep:] for s in self.manifest(v)["shards"]}
        gone = {s["file"] for v in versions[:-keep] for s in self.manifest(v)["shards"]} - named
        return sum(self._files.delete(self._hadoop.Path(f"{self.path}/{file}"), False) for file in gone)

    def _age(self, file: str) -> float:
        return time.time() - self._files.getFileStatus(self._hadoop.Path(f"{self.path}/{file}")).getModificationTime() / 1000

    def vacuum(self, keep: int = 1, grace: float = GRACE) -> int:
        """Delete shards that none of the last `keep` versions names and that are at least `grace` seconds old; the number
        of deleted files."""
        named = {s["file"] for v in self.versions()[-keep:] for s in self.manifest(v)["shards"]}
        gone = 0
        for name, _ in self._found("data") if self._list("data") else []:
            if f"data/{name}" not in named and self._age(f"data/{name}") >= grace:
                gone += self._files.delete(self._hadoop.Path(f"{self.path}/data/{name}"), False)
        return gone


#: Arrivals of the query, and after how many of them the store is compacted.
ARRIVALS, WAVE = 40, 8


def filled(docs: DataFrame, arrivals: int = ARRIVALS, wave: int = WAVE) -> tuple[ShardStore, Column]:
    """A new store to which docs came in arrivals, dealt by a hash of doc_id, with a compaction after each wave of them;
    and the arrival of a row. The smallest tier is that of all arrivals' shards, and the target at least twice the second
    tier's size, so that runs of two tiers merge whatever the arrivals' size."""
    spark = docs.sparkSession
    store = ShardStore(spark, scratch_path(spark, "shards"))
    arrival = F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)).cast("int")
    dealt = store.dealt(docs, arrival, arrivals)
    store.small = max((s["bytes"] for shards in dealt for s in shards), default=SMALL_BYTES)
    store.target = max(store.target, 2 * store.small * store.ratio)
    for k, shards in enumerate(dealt):
        store.arrive(docs.schema, shards)
        if k % wave == wave - 1:
            store.compact()
            store.expire()
    return store, arrival


def appended_and_compacted(docs: DataFrame, arrivals: int = ARRIVALS, wave: int = WAVE) -> DataFrame:
    """The latest version of a filled store: doc_id, arrival, text_sha256, shard (its file), shard_tier, shard_rows,
    shard_merges (how often its rows were merged at most), shard_sources (shards of the run that it was merged from),
    version; one row per row of docs. lineage() of the store names the sources."""
    store, arrival = filled(docs, arrivals, wave)
    manifest = store.manifest()
    rows = store.read(manifest["version"])
    shards = docs.sparkSession.createDataFrame(
        [(s["file"], s["tier"], s["rows"], s["merges"], s["sources"]) for s in manifest["shards"]], "file string, shard_tier int, shard_rows long, shard_merges int, shard_sources int"
    )
    rows = rows.select("doc_id", arrival.alias("arrival"), F.sha2("text", 256).alias("text_sha256"), F.regexp_extract(F.input_file_name(), "data/.+$", 0).alias("shard"))
    # the manifest's shards are metadata, some hundred bytes for each file of the target size
    return rows.join(F.broadcast(shards), F.col("shard") == F.col("file")).drop("file").withColumn("version", F.lit(manifest["version"]))
