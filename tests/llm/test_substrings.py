import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from harvestry.llm import substrings
from harvestry.llm.common import table
from tests.conftest import SF

WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, size=13):
    docs = [(i, WORDS.findall(t or "")) for i, t in rows]
    least = {}
    for i, ws in docs:
        for k in range(len(ws) - size + 1):
            if i is not None:
                w = tuple(ws[k : k + size])
                least[w] = min(i, least.get(w, i))
    out = []
    for i, ws in docs:
        gone = set()
        for k in range(len(ws) - size + 1):
            if i is not None and least[tuple(ws[k : k + size])] < i:
                gone.update(range(k, k + size))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(map(repr, out))


def result(docs, **options):
    rows = substrings.deduplicate(docs, **options).collect()
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    return sorted(repr((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())) for r in rows)


@pytest.mark.parametrize("options", [{}, {"hot": 2, "group": 500}, {"size": 5}, {"size": 40}])
def test_whole_table(spark, options):
    docs = table(spark, SF, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], options.get("size", 13))
    assert result(docs, **options) == want
    if not options:
        assert sorted(map(repr, map(tuple, substrings.digest(docs).collect()))) == want
        con = duckdb.connect()
        con.register("documents", docs.toArrow())
        assert sorted(map(repr, con.execute(substrings.ORACLE).fetchall())) == want


def test_edges(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(13))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, a), (4, a), (9, a), (None, a), (None, b), (5, b), (7, f"x {b} y"), (8, f"x\n{b}\ty z"), (8, b), (11, b.rsplit(" ", 1)[0])]
    rows += [(12, "ja " * 400), (13, "ja " * 30_000), (14, "\x1c \x85   " * 20), (15, "\x1c\x0b\x85   " * 20), (-3, "z " + a[5:]), (6, a.replace(" ", "\r\n"))]
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, digest string, number int")
    assert result(docs) == brute(rows) == result(docs, hot=1)
    assert substrings.deduplicate(docs.limit(0)).collect() == []
    assert result(docs.where("doc_id is null")) == brute([r for r in rows if r[0] is None])


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "GATHERED", 500)
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(5, 60))] for _ in range(12)]
    rows = []
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(0, 6)):
            words += rng.choice(passages)[rng.randrange(4) :] if rng.random() < 0.5 else [rng.choice("abcdefgh") for _ in range(rng.randrange(30))]
        rows.append((rng.randrange(80), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(docs, size=8) == brute(rows, 8) == result(docs, size=8, hot=6)


def test_hashes_of_runs_and_trees():
    words = [b"a", b"b", b"c"] * 20
    h = substrings.Hasher(words)
    at = np.arange(50)
    for k in (0, 1):
        got = h.runs(at, 7, k)
        assert len(set(got.tolist())) == 3 and (got[3:] == got[:-3]).all()
        other = substrings.Hasher([b"x"] + words).runs(at + 1, 7, k)
        assert (got == other).all()
    codes = np.array([[1, 1, 1], [1, 1, 2], [1, 1, 2], [1, 3, 0], [2, 0, 0], [2, 0, 0]])
    shared = substrings.shared_prefixes(codes)
    assert shared.tolist() == [2, 3, 1, 0, 3]
    assert substrings.deep_nodes(shared, 3).tolist() == [0, 1, 1, 3, 4, 4] and substrings.deep_nodes(shared, 2).tolist() == [0, 0, 0, 3, 4, 4]
