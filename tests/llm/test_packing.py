import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from harvestry.llm import packing
from harvestry.llm.common import table, tokenizer_file
from tests.conftest import SF


def brute(rows, capacity):
    tok = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    out = []
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = ids[s : s + capacity]
            out.append((doc_id, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def pieces(got):
    return sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str)


def valid(got, capacity):
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    got = packing.pack(docs).collect()
    assert pieces(got) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()], 4096), key=str)
    total = sum(r.length for r in got)
    assert valid(got, 4096) <= -(-total // 4096) + 1


def test_edges(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "word " * 50), (2, "word " * 50), (3, "é́ <|endoftext|>x y")]
    docs = spark.createDataFrame([(a, b, 7) for a, b in rows], "doc_id long, text string, fill int")
    got = packing.pack(docs, capacity=16).collect()
    assert pieces(got) == sorted(brute(rows, 16), key=str)
    valid(got, 16)
    assert packing.pack(docs.limit(0)).collect() == []


def test_underfull_bins_merge(spark):
    docs = spark.createDataFrame([(i, "a " * (i % 7 + 2)) for i in range(400)], "doc_id long, text string").repartition(16)
    got = packing.pack(docs, capacity=64).collect()
    total = sum(r.length for r in got)
    assert valid(got, 64) <= 1.05 * total / 64 + 1


@given(st.lists(st.integers(1, 50), max_size=200))
@settings(max_examples=50, deadline=None)
def test_best_fit(sizes):
    bins = packing.best_fit(np.array(sizes, "i8"), 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    fills = [sum(sizes[i] for i in b) for b in bins]
    assert all(f <= 50 for f in fills)
    assert len(bins) <= 11 / 9 * -(-sum(sizes) // 50) + 20


def test_words_give_the_whole_texts_ids(spark):
    path = tokenizer_file("word_bpe_49k.json")
    own, whole = packing.WordTokenizer(path, 1), Tokenizer.from_file(path)
    kinds = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + ["\x1c\x1d", " \x1e ", "\x1f\n"]
    texts = [f"{a}{c}{b}" for c in kinds for a, b in (("a", "b"), ("", ""), ("", "b"), ("a\x1f ", "　b"))]
    ids = [np.array([*e.ids, 1], "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]
    wrong = [t for t, x, y in zip(texts, own.ids(texts), ids, strict=True) if x != y]
    assert not wrong, wrong[:5]
    rows = [(1, "a\x1cb"), (2, "\x1e"), (3, "a\x1d b\x1f" * 20)]
    assert pieces(packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), capacity=16).collect()) == sorted(brute(rows, 16), key=str)
