import functools
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestry.llm import sentencepieces as sp
from harvestry.llm.common import table, tokenizer_file
from tests.conftest import SF


@pytest.fixture(scope="module")
def vocabulary():
    return sp.vocabulary(tokenizer_file("piece_bpe_32k.model"))


def escaped(text):
    return sp.SPACE + text.replace(" ", sp.SPACE) if text else ""


def scores(v, ids):
    names = {i: s for s, i in v.pieces.values()}
    return sum(names.get(i, 0.0) for i in ids)


def whole(got):
    """Ids and decoded flags by document."""
    out = {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.part)):
        ids, good = out.setdefault(r.doc_id, ([], []))
        ids += r.ids
        good.append(r.decoded)
    return out


def test_words_match_the_recurrence(vocabulary):
    rng = random.Random(3)
    words = ["representations", "the", "  x", "ação", "Straße,", "a" * 40, "=" * 30, "don't", "日本語", "\n\t", "x\U0001f600y"]
    for _ in range(300):
        text = escaped("".join(rng.choice(words) + rng.choice(["", " ", "  "]) for _ in range(6)))
        ids = vocabulary.encode([text])[0]
        assert (ids, vocabulary.score(ids)) == vocabulary.segment(text)


def test_scores_match_the_library(vocabulary):
    """The library's lattice finds segmentations of the same best score under the same pieces and scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    rng = random.Random(5)
    for _ in range(200):
        text = " ".join("".join(rng.choice(["the", "ra", "nd", "ing", "x", "über"]) for _ in range(rng.randrange(1, 4))) for _ in range(4))
        best = library.nbest_encode_as_ids(text, 2)[0]
        assert scores(vocabulary, best) == vocabulary.score(vocabulary.encode([escaped(text)])[0])


@pytest.mark.parametrize("chunk", [16_384, 700, 33])
def test_whole_table_with_chunks(spark, vocabulary, chunk):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    encoded = sp.encode(docs, chunk_chars=chunk)
    got = whole(encoded.collect())
    for i, text in rows.items():
        want = np.frombuffer(vocabulary.encode([escaped(text)])[0], "<u4").tolist()
        ids, good = got[i]
        assert ids == want and all(good)
    back = {}
    for r in sorted(sp.decode(encoded).collect(), key=lambda r: r.part):
        back[r.doc_id] = back.get(r.doc_id, "") + r.text
    assert back == rows


def test_transfer_matrices_are_associative_and_agree_with_the_recurrence(vocabulary):
    rng = random.Random(9)
    for spaces in (0.15, 0.0):  # with and without places that all paths visit
        text = escaped("".join(" " if rng.random() < spaces else rng.choice("therandingx") for _ in range(400)))
        size, n = 57, vocabulary.longest
        parts = []
        for k in range(0, len(text), size):
            own, length = text[k : k + size + n - 1], min(size, len(text) - k)
            cuts = vocabulary.cuts(own, length)
            parts.append(vocabulary.transfer(own, length, cuts, vocabulary.encode([own[cuts[0] : cuts[1]] if cuts else ""])[0]))
        left = parts[0]
        for p in parts[1:]:
            left = sp.product(left, p)
        right = parts[-1]
        for p in parts[-2::-1]:
            right = sp.product(p, right)
        assert left[0, 0, 0] == right[0, 0, 0] == vocabulary.segment(text)[1]
        states = sp.borders(parts, 0, 0)
        assert sum(p[0, a, b] for p, a, b in zip(parts, states, states[1:])) == left[0, 0, 0]


@pytest.mark.parametrize("seed", range(6))
def test_ties_are_the_same_at_every_size(spark, vocabulary, seed):
    """Texts with many segmentations of equal score, whole and in chunks down to less than a piece."""
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice(["  ", " ", "a", "aa", "ss", "ab", "\n", "==", "é", "the", "0", "00"]) for _ in range(rng.randrange(1, 300)))) for i in range(40)]
    rows += [(90, " " * 500), (91, "=" * 300), (92, "0" * 77 + " " * 77)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: np.frombuffer(vocabulary.segment(escaped(t))[0], "<u4").tolist() for i, t in rows}
    for chunk in (3, 17, 64, 100_000):
        assert {i: ids for i, (ids, _) in whole(sp.encode(docs, chunk_chars=chunk).collect()).items()} == want


def test_products_keep_the_preferred_path(vocabulary):
    """The path through products, in any order, is the plain recurrence's."""
    rng = random.Random(4)
    for _ in range(40):
        text = escaped("".join(rng.choice(["a", "aa", "s", "  ", " ", "0"]) for _ in range(120)))
        size, n = 9, vocabulary.longest
        parts = [vocabulary.transfer(text[k : k + size + n - 1], min(size, len(text) - k), None, b"") for k in range(0, len(text), size)]
        starts = {0, *vocabulary.preferred(text)[1], len(text)}
        want = [min(s for s in starts if s >= min(k, len(text))) - min(k, len(text)) for k in range(0, len(text) + size, size)][: len(parts) + 1]
        assert sp.borders(parts, 0, 0)[:-1] == want[:-1]
        third = len(parts) // 3
        blocks = [parts[:third], parts[third : 2 * third], parts[2 * third :]]
        joined = [functools.reduce(sp.product, b) for b in blocks]
        assert sp.borders(joined, 0, 0)[:-1] == [want[0], want[third], want[2 * third]]


def test_edges(spark, vocabulary):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "\U0001f600" * 50), (3, " lead  and trail "), (4, "x" * 300), (5, "x" * 300), (6, "word " * 40)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int")
    got = sp.encode(docs, chunk_chars=64).collect()
    assert all(r.decoded for r in got) and sum(r.n_ids for r in got if r.doc_id in (1, 2)) == 0
    n = sum(r.n_ids for r in got)
    assert n == sum(r.n_ids for r in sp.encode(docs).collect())
    assert {r.decoded_sha256 for r in got if r.doc_id is None} == {hashlib.sha256(b" a b").hexdigest()}
    assert sp.encode(docs.limit(0)).collect() == []
    assert sp.decode(sp.encode(docs.where("doc_id = 6"), chunk_chars=64)).agg(F.sum(F.length("text"))).head()[0] == 200
