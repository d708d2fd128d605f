import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import neardup
from harvestry.llm.common import table
from tests.conftest import SF


def sets(text):
    w = neardup.normal(text or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """Classes by exact weighted similarity of all pairs."""
    own = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = (own[i] & own[j]).total()
            if n / (own[i].total() + own[j].total() - n) >= 0.8:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted(sorted(g, key=str) for g in groups.values())


def classes(got):
    groups = {}
    for r in got:
        groups.setdefault((r.class_id, r.class_rows) if r.class_id is not None else r.words, []).append(r.doc_id)
    return sorted(sorted(g, key=str) for g in groups.values())


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    got = neardup.find(docs).collect()
    assert classes(got) == want and len(got) == len(rows)
    kept = sorted(r.doc_id for r in neardup.keep_first(docs).collect())
    assert kept == sorted(min(g) for g in want)


def test_chains_and_hot_buckets(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(200)]
    rows = []
    for i in range(60):  # near copies of one text, and a chain whose ends are far apart
        own = base[:]
        own[rng.randrange(200)] = "x"
        rows.append((i, " ".join(own)))
    chain = base[:]
    for i in range(60, 90):
        chain = chain[4:] + [rng.choice(words) for _ in range(4)]
        rows.append((i, " ".join(chain)))
    hub = [rng.choice(words) for _ in range(250)]
    rows.append((500, " ".join(hub)))
    for i in range(501, 541):  # near the hub, not near each other
        own = hub[:]
        for k in rng.sample(range(0, 250, 6), 5):
            own[k] = rng.choice(words)
        rows.append((i, " ".join(own)))
    passage = " ".join(rng.choice(words) for _ in range(80))
    rows += [(i, passage + " " + " ".join(rng.choice(words) for _ in range(60))) for i in range(90, 150)]
    frame = [rng.choice(words) for _ in range(200)]
    for i in range(200, 240):  # pairs of near copies among texts that nearly are; their centre is near few of them
        own = frame + [rng.choice(words) for _ in range(45)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(own[:-9] + ["y"] * 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(neardup.find(docs).collect()) == brute(rows)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "BROADCAST_ROWS", 0)
    assert classes(neardup.find(docs).collect()) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " a  B\n"), (4, "a b"), (5, "a b c"), (5, "a b c"), (None, "x y z"), (None, "other"), (6, "ü" * 70_000), (7, "\U0001f600 é")]
    docs = spark.createDataFrame([(i, t, "n", 3, "r", "d", "w") for i, t in rows], "doc_id long, text string, node string, class_id int, row string, doc string, words string")
    got = {}
    for r in neardup.find(docs).collect():
        got.setdefault(r.words, []).append(r)
    assert sorted(len(g) for g in got.values()) == [1, 1, 1, 1, 2, 2, 2]
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, None), (3, " a  B\n"), (5, "a b c"), (None, "x y z"), (None, "other"), (6, "ü" * 70_000), (7, "\U0001f600 é")], key=str)
    assert neardup.find(docs.limit(0)).collect() == []
    assert neardup.keep_first(docs.limit(0)).collect() == []


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    for weighted in (False, True):
        for _ in range(5):
            ids = rng.integers(1, 2**63, 300, dtype=np.uint64)
            a, b = rng.integers(1, 6, 300), rng.integers(1, 6, 300)
            if not weighted:
                a, b = np.ones(200), np.ones(200)
                x, y = ids[:200], ids[60:260]
                want = 140 / 260
            else:
                x = y = ids
                want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
            k = 2000
            same = (neardup.signature(x, a, k) == neardup.signature(y, b, k)).mean()
            assert abs(same - want) < 4 * (want * (1 - want) / k) ** 0.5


def test_fractional_weights():
    ids = np.arange(1, 401, dtype=np.uint64) * np.uint64(7919)
    a, b = np.linspace(0.2, 2.7, 400), np.linspace(2.7, 0.2, 400)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    same = (neardup.signature(ids, a, 3000) == neardup.signature(ids, b, 3000)).mean()
    assert abs(same - want) < 0.04


@given(st.lists(st.sampled_from("a b c d e".split()), max_size=40))
@settings(max_examples=60, deadline=None)
def test_shingles_match_tuples(words):
    text = " ".join(words)
    elements, counts = neardup.shingles(text)
    assert len(elements) == len(sets(text)) and counts.sum() == max(1, len(words) - 4)
    again = neardup.shingles(text)[0]
    assert (elements == again).all()
