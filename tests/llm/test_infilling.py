import hashlib
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harvestry.llm import infilling
from harvestry.llm.common import table
from tests.conftest import SF

UNIT = {"line": r"[^\n]*\n|[^\n]+", "sentence": r"[^\n.!?]*[\n.!?]|[^\n.!?]+", "word": r"[^\t-\r ]*[\t-\r ]|[^\t-\r ]+", "char": r"(?s:.)"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, unit="line"):
    text = text or ""
    units = re.findall(UNIT[unit], text)
    digest = sha(f"7:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(units), out[0], len(p), len(m), sha(out[1]), sha(text)


@given(st.text(alphabet="a.\n é\U0001f600", max_size=1500), st.sampled_from(sorted(UNIT)))
@settings(max_examples=150, deadline=None)
def test_units_match_the_expression(text, unit):
    want = re.findall(UNIT[unit], text)
    got = infilling.Units(infilling.classes(text), infilling.UNITS[unit])
    assert got.n == len(want)
    assert [got.cut(k) for k in range(got.n + 1)] == [0, *np.cumsum([len(w) for w in want]).tolist()]


@given(st.lists(st.integers(0, 7), max_size=1200))
@settings(max_examples=50, deadline=None)
def test_ranks(codes):
    matrix = infilling.WaveletMatrix(np.array(codes, np.uint8), 3)
    for at in {0, len(codes) // 3, len(codes) // 2, len(codes)}:
        assert [matrix.rank(c, at) for c in range(8)] == [codes[:at].count(c) for c in range(8)]


HARD = ["", None, "\n", "\n\n", "a", "a\nb", "é\n\U0001f600\r\nx\n", "has <M> inside\nx", "<", "<P\n<S\n<M\n>", "P>\nS>\nM>\n<<", "x\0y\n" * 5, "line\n" * 30_000, "w" * 200_000]


def test_edges(spark):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "a\nb\nc"), (3, "\n\n"), (3, "\n\n"), (-5, "a\nb\nc\nd")]
    frame = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, cut int, form string, h string")
    assert sorted(map(repr, map(tuple, infilling.digest(frame).collect()))) == sorted(repr(brute(i, t)) for i, t in rows)
    assert infilling.digest(frame.limit(0)).collect() == []


def test_other_units_and_shares(spark):
    docs = table(spark, SF, "documents")
    for unit in ("sentence", "word", "char"):
        made = infilling.transform(docs, unit, percent=60)
        assert made.where(infilling.restored() != F.col("text")).count() == 0
        plain = made.where("form = 'plain'").count()
        assert 0.25 * 200 < plain < 0.55 * 200


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    got = sorted(map(repr, map(tuple, infilling.digest(docs).collect())))
    assert got == sorted(repr(brute(r.doc_id, r.text)) for r in docs.collect())
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got == sorted(map(repr, con.execute(infilling.ORACLE).fetchall()))
