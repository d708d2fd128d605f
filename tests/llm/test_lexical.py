import math
import random
import re
from array import array
from collections import Counter

import duckdb
import numpy as np
import pytest

from harvestry.llm import lexical
from harvestry.llm.common import table
from tests.conftest import SF

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=20):
    found = [(i, plain_terms(t)) for i, t in docs]
    found = [(i, Counter(ts), len(ts)) for i, ts in found if ts]
    total, df = sum(n for _, _, n in found), Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, counts, n in found:
            m = 75 + 25 * n * len(found) // total
            s = sum(math.floor(1000 * math.log((2 * len(found) + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in plain_terms(text) if t in counts)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(map(repr, out))


def result(frame):
    return sorted(repr((r.item_id, r["rank"], r.doc_id, r.score)) for r in frame.collect())


@pytest.mark.parametrize("options", [{}, {"block_docs": 7, "slice_items": 9, "k": 3}, {"block_postings": 300, "slice_chars": 3000}])
def test_whole_table(spark, options):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], options.get("k", 20))
    assert result(lexical.rank(docs, items, **options)) == want
    if not options:
        con = duckdb.connect()
        con.register("documents", docs.toArrow())
        con.register("benchmark", items.toArrow())
        assert sorted(map(repr, con.execute(lexical.ORACLE).fetchall())) == want


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "Abc ABC abc_x É é"), (None, "abc é"), (4, "Abc ABC abc_x É é"), (9, "abc é"), (7, "abc é"), (-1, "abc é"), (5, "rare " * 9000), (6, "0 z\x00q\x7f\x1c日本語 z"), (8, "K ſ İ")]
    items = [(1, "abc"), (1, "ABC é é"), (None, "rare q 日本語"), (3, None), (4, "nowhere"), (5, "x z 0 K k ſ")]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, item int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for k in (1, 2, 20):
        assert result(lexical.rank(d, q, k)) == brute(docs, items, k)
    assert result(lexical.rank(d.limit(0), q)) == [] and result(lexical.rank(d, q.limit(0))) == []


def test_ties_and_random_texts(spark):
    rng = random.Random(11)
    docs = [(rng.randrange(300), " ".join(rng.choice("abcdefgh") * rng.choice((1, 1, 2)) for _ in range(rng.randrange(1, 12)))) for _ in range(600)]
    items = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6)))) for i in range(30)]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert result(lexical.rank(d, q, block_docs=50)) == brute(docs, items)


def test_bounds_leave_documents_unscored():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    part = lexical.Slice([(0, "w1 w7 w300 w301 w302")])
    ids, m, term, doc, tf = [], [], array("i"), array("i"), array("q")
    for i in range(4000):
        counts = Counter(rng.choices(words, weights=[1 / (k + 1) for k in range(400)], k=60))
        for w, n in counts.items():
            if w.encode() in part.places:
                term.append(part.places[w.encode()]), doc.append(len(ids)), tf.append(n)
        ids.append(i), m.append(100)
    df = Counter(term)
    block = lexical.Block(ids, m, term, doc, tf, np.array([lexical.weight(4000, df[t]) for t in range(5)]))
    best = []
    scored = block.search(*part.items[0], best, 20)
    assert len(best) == 20 and scored < 1200
