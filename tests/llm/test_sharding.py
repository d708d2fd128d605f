import hashlib
from collections import Counter

import pytest

from harvestry.llm import sharding
from harvestry.llm.common import scratch_path, table
from tests.conftest import SF


def rows(df):
    return Counter(map(repr, map(tuple, df.collect())))


def store_of(spark, **options):
    return sharding.ShardStore(spark, scratch_path(spark, "shard-test"), **({"small_bytes": 20_000, "target_bytes": 400_000, "ratio": 4} | options))


def test_appends_compact_and_keep_every_row(spark):
    docs = table(spark, SF, "documents").repartition(12)
    store = store_of(spark)
    for k in range(3):
        store.append(docs.where(f"doc_id % 3 = {k}"))
    before = store.manifest()
    assert before["version"] == 3 and len(before["shards"]) == 36 and sum(s["rows"] for s in before["shards"]) == docs.count()
    after = store.compact()
    assert len(after["shards"]) <= 4 and max(s["bytes"] for s in after["shards"]) < 2 * store.target
    assert rows(store.read()) == rows(docs) == rows(store.read(3))
    assert store.runs(after) == [] and store.compact()["version"] == after["version"]
    assert store.vacuum() == 0 and store.vacuum(grace=0) >= 36 and rows(store.read()) == rows(docs)


def test_only_similar_sizes_merge(spark):
    store = store_of(spark)
    size = iter(range(10**6))
    manifest = {"shards": [{"file": f"f{next(size)}", "bytes": b, "tier": store.tier(b), "rows": 1} for b in [10_000] * 3 + [50_000] * 4 + [300_000] * 9]}
    assert [len(r) for r in store.runs(manifest)] == [4]
    assert [store.tier(b) for b in (1, 20_000, 20_001, 80_000, 80_001)] == [0, 0, 1, 1, 2]


def test_of_two_writers_one_wins(spark):
    store = store_of(spark)
    store.append(spark.range(5))
    parent = store.manifest()
    made = store._commit(parent, parent["schema"], parent["shards"], "append")
    with pytest.raises(sharding.CommitConflict):
        store._commit(parent, parent["schema"], [], "append")
    assert store.manifest() == made and store.versions() == [1, 2] and store.read().count() == 5


def test_interleaved_writers_lose_nothing(spark, monkeypatch):
    store, other = store_of(spark), None
    other = sharding.ShardStore(spark, store.path, 20_000, 400_000)
    for k in range(4):
        store.append(spark.range(10 * k, 10 * k + 10).coalesce(1))
    write = sharding.ShardStore._write

    def meanwhile(self, rows, max_rows=0):
        made = write(self, rows, max_rows)
        if self is store:
            other.append(spark.range(1000, 1005).coalesce(1))
            other.vacuum()
        return made

    monkeypatch.setattr(sharding.ShardStore, "_write", meanwhile)
    store.append(spark.range(40, 50).coalesce(1))
    store.compact()
    assert sorted(r.id for r in store.read().collect()) == sorted([*range(50), *(2 * list(range(1000, 1005)))])


def test_edges(spark):
    store = store_of(spark)
    assert store.read() is None and store.compact() is None
    docs = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, "x" * 100_000, None)], "doc_id long, text string, shard int")
    store.append(docs.limit(0))
    store.append(docs)
    assert rows(store.read()) == rows(docs)
    with pytest.raises(ValueError):
        store.append(spark.range(3))
    got = sharding.appended_and_compacted(docs).collect()
    want = [(r.doc_id, None if r.text is None else hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect()]
    assert sorted(((r.doc_id, r.text_sha256) for r in got), key=str) == sorted(want, key=str)
    assert sharding.appended_and_compacted(docs.limit(0)).collect() == []


def replayed(store):
    """Check every version against its parent in plain Python; the tiers that merged."""
    tiers, shards = [], {}
    for v in store.versions():
        m = store.manifest(v)
        now = {s["file"]: s for s in m["shards"]}
        if m["operation"] == "append":
            assert shards.items() <= now.items() and all(s["merges"] == 0 for f, s in now.items() if f not in shards)
        else:
            due = {}
            for s in shards.values():
                if s["bytes"] < store.target // 2:
                    due.setdefault(s["tier"], set()).add(s["file"])
            due = {t: files for t, files in due.items() if len(files) >= store.min_run}
            assert {x["tier"]: set(x["from"]) for x in m["merged"]} == due and due
            for x in m["merged"]:
                old, new = [shards[f] for f in x["from"]], [now[f] for f in x["into"]]
                assert sum(s["rows"] for s in old) == sum(s["rows"] for s in new) and len(new) <= len(old) // 2
                assert {s["sources"] for s in new} == {len(old)} and {s["merges"] for s in new} == {1 + max(s["merges"] for s in old)}
            gone, fresh = {f for x in m["merged"] for f in x["from"]}, {f for x in m["merged"] for f in x["into"]}
            assert now.keys() == (shards.keys() - gone) | fresh
            tiers += sorted(due)
        assert all(s["tier"] == next(t for t in range(99) if s["bytes"] <= store.small * store.ratio**t) for s in now.values())
        shards = now
    assert store.runs(store.manifest()) == []
    return tiers


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    store, _ = sharding.filled(docs)
    tiers = replayed(store)
    assert len(set(tiers)) >= 2 and len(tiers) >= 6  # runs of two tiers merged
    assert store.manifest()["version"] > sharding.ARRIVALS + 4 and len(store.manifest()["shards"]) <= 4
    assert rows(store.read()) == rows(docs)
    lineage = store.lineage().collect()
    assert {r.tier for r in lineage} == set(tiers) and all(r.source != r.shard for r in lineage)
    made = {s["file"] for s in store.manifest()["shards"] if s["merges"]}
    assert made and made <= {r.shard for r in lineage}


def test_query(spark):
    docs = table(spark, SF, "documents")
    got = sharding.appended_and_compacted(docs).collect()
    assert sorted((r.doc_id, r.text_sha256) for r in got) == sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect())
    per = Counter(r.shard for r in got)
    assert all(per[r.shard] == r.shard_rows for r in got)
    assert {r.version for r in got} == {46} and max(r.shard_merges for r in got) == 2 and max(r.shard_sources for r in got) in (4, 8)
    assert len({r.arrival for r in got}) == sharding.ARRIVALS
