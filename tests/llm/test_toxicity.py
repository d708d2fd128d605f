import math
import random
import string
import zlib

import zstandard
from pyspark.sql import functions as F

from harvestry.llm import toxicity
from harvestry.llm.common import table
from tests.conftest import SF


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    got = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(got[i], t) for i, t in truth.items() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held) and not any(got[i].held_out for i in truth if zlib.crc32(str(i).encode()) % 5)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    right = sum(r.predicted == t for r, t in held)
    caught = sum(r.predicted for r, t in held if t) / sum(t for _, t in held)
    assert right / len(held) > 0.97 and caught > 0.85


def test_edges(spark):
    rows = [(1, "you idiot " * 3), (2, "good day " * 3), (3, None), (4, ""), (None, "x"), (5, "w " * 60_000)]
    docs = spark.createDataFrame([(i, t, 0.7) for i, t in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (1, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in toxicity.classify(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), labels).collect() == []
    assert toxicity.drop_toxic(docs, labels.limit(0)).columns == docs.columns


def test_dictionaries_tell_windows_apart():
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("river", "bridge", "mill", "stone", "field") for b in ("", "s", "side", "man", "bed")]
    ordinary, more = ([" ".join(rng.choice(words) for _ in range(30)) for _ in range(60)] for _ in range(2))
    toxic = [f"{t} you wretchedfool" for t in more]
    model = toxicity.fit(ordinary + toxic, [0] * 60 + [1] * 60)
    e = toxicity.Evidence(model.pairs)
    words = {w: v[0] for w, v in e.memo.ready([["wretchedfool", "bridge", "river"]]).items()}
    assert words["wretchedfool"] >= 4 and abs(words["bridge"]) <= 2 and abs(words["river"]) <= 2
    assert toxicity.fit(ordinary, [0] * 60) is None


def test_small_groups_keep_their_markers():
    """A marker in 2.5% of the toxic texts, a word of three bytes and an order of ordinary words are evidence of their own."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abdefgiklmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(400)] + ["you", "home", "go"]
    say = lambda *more: " ".join(rng.choices(words, k=25)) + "".join(f" {m}" for m in more) + " " + " ".join(rng.choices(words, k=25))
    others = [("home", "you", "go"), ("go", "you", "home"), ("you", "home", "go"), ("home", "go", "you")]
    ordinary = lambda n: [say(*rng.choice(others)) for _ in range(n)]
    marks = {"large": [("wretchedfool",)], "small": [("ketterhund",)], "short": [("zqx",)], "order": [("go", "home", "you")]}
    sizes = {"large": 640, "small": 20, "short": 60, "order": 80}
    toxic = [say(*marks[k][0]) for k, n in sizes.items() for _ in range(n)]
    plain = ordinary(1600)
    model = toxicity.fit(plain + toxic, [0] * len(plain) + [1] * len(toxic))
    e = toxicity.Evidence(model.pairs, model.phrases)
    flagged = lambda texts: (e.features(texts) @ model.weights >= 0).mean()
    caught = {k: flagged([say(*m[0]) for _ in range(40)]) for k, m in marks.items()}
    assert min(caught.values()) >= 0.9, caught
    assert flagged(ordinary(200)) <= 0.03


def test_recall_per_language(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    truth = labels.where("toxic = 1").join(docs.select("doc_id", "lang"), "doc_id").join(toxicity.classify(docs, labels), "doc_id").where("held_out")
    got = {r.lang: (r.caught, r.n) for r in truth.groupBy("lang").agg(F.sum("predicted").alias("caught"), F.count("*").alias("n")).collect()}
    assert len(got) == 4 and all(caught >= 0.8 * n for caught, n in got.values()), got


def test_scores_against_brute_force(spark):
    """The query's scores, from every word and phrase of each text compressed anew by both dictionaries of every pair."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))

    def lengths(pair, window):
        made = []
        for data in pair:
            content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.append(len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=content, write_content_size=False, write_dict_id=False).compress(window)))
        return made[1] - made[0]

    def summary(e, n):
        over = [sum(x >= t for x in e) for t in (3, 4, 6, 8)]
        return [max(*e, 0) / 4, *(math.log1p(c) for c in over), *(math.log1p(1000 * c / n) for c in over[1:])] if e else [0.0] * 8

    def brute(text):
        words = text.lower().split()
        windows = []
        for w in (w.encode() for w in words):
            windows.append(b" ".join([w if len(w) >= 4 else b"-" + b"".join(bytes([c]) + b"-" for c in w)] * 3))
        bare = [w.strip(string.punctuation) for w in words]
        said = [p for n in (2, 3) for p in zip(*(bare[i:] for i in range(n))) if all(w in model.phrases.words for w in p)]
        x = [1.0]
        for pair in model.pairs:
            x += summary([lengths(pair, w) for w in windows], len(words))
        for pair in model.phrases.pairs:
            x += summary([lengths(pair, (" ".join(p).encode() + b"|") * 3) for p in said], len(words))
        return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.weights, strict=True))))

    some = docs.where("length(text) < 400").orderBy("doc_id").limit(12)
    got = {r.doc_id: r.score for r in toxicity.classify(docs, labels).join(some.select("doc_id"), "doc_id", "left_semi").collect()}
    for r in some.collect():
        assert abs(got[r.doc_id] - brute(r.text)) < 1e-9
