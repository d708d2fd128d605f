"""Every query with SQL gives DuckDB's rows."""

import difflib
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from harvestry.functions.text import FILLER_WORDS
from harvestry.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return str(v)[:10] + "|" + str(v)[11:] if hasattr(v, "year") and str(v)[10:] not in ("", " 00:00:00") else str(v)[:10] if hasattr(v, "year") else float(v) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    frame = catalog.QUERIES[name](spark, SF)
    got = frame.collect()
    if name not in catalog.ORACLES:
        assert got
        return
    result = duck.execute(catalog.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    want = sorted(repr([plain(r[columns.index(c)]) for c in sorted(columns)]) for r in result.fetchall())
    assert sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in got) == want


def test_name_match_against_brute_force(spark, duck):
    """q37 has no SQL: all pairs of names, their trigrams and the ratio of their words, in plain Python."""
    names = sorted(r[0] for r in duck.execute("select distinct p_name from part").fetchall())
    words = {n: [w for w in re.split("[^a-z0-9]+", n.lower()) if w] for n in names}
    grams = {n: {f"  {w} "[i : i + 3] for w in ws for i in range(len(w) + 1)} for n, ws in words.items()}
    core = {n: [w for w in ws if w not in FILLER_WORDS] for n, ws in words.items()}
    want = {}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) > 0.2:
                ratio = difflib.SequenceMatcher(None, " ".join(core[a]), " ".join(core[b])).ratio()
                want[a, b] = round(min(1.0, ratio + 0.35 * bool(set(core[a]) & set(core[b]))), 4) if core[a] and core[b] else 0.0
    got = {(r.name_a, r.name_b): r.score for r in catalog.QUERIES["q37_name_match_ratio"](spark, SF).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
