import corpus_pipeline
from harvestry.llm import toxicity
from harvestry.llm.common import table
from tests.llm.test_neardup import brute as classes
from tests.llm.test_packing import brute as pieces
from tests.llm.test_packing import pieces as rows_of
from tests.llm.test_packing import valid
from tests.llm.test_pii import brute as spans

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "personal_data", "packing"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns
    start, calm, single, clean = ({r.doc_id: r.text for r in d.collect()} for d in kept)
    toxic = {r.doc_id for r in table(spark, SF, "labels").collect() if r.toxic}
    gone = set(start) - set(calm)
    labelled = {r.doc_id for r in table(spark, SF, "labels").collect()}
    assert not (gone & labelled) - toxic
    assert gone == {r.doc_id for r in toxicity.classify(docs, table(spark, SF, "labels")).collect() if r.predicted}
    assert set(single) == {min(g) for g in classes(sorted(calm.items()))}
    assert set(clean) == set(single)
    for i, text in clean.items():
        assert not spans(text)
        if not spans(single[i]):
            assert text == single[i]
    got = corpus_pipeline.run(spark, SF).collect()
    assert rows_of(got) == sorted(pieces(sorted(clean.items()), 4096), key=str)
    valid(got, 4096)


def test_edges(spark):
    long = "word by word the text goes on and on " * 12_000 + "to joe@mail.org"
    rows = [(1, None), (2, ""), (2, ""), (None, "a b c d e f"), (None, "A b  c d e f"), (3, long), (3, long), (4, "call +1 743 555 3824 now"), (5, "4111111111111111@q.r")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "r", "k", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, key string, base int")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF))
        assert kept[-1].columns == docs.columns
    assert kept[1].count() == len(rows)
    got = sorted(((r.doc_id, (r.text or "")[-30:].lower(), r.n_chars) for r in kept[-1].collect()), key=str)
    tail = long.replace("joe@mail.org", "[email]")
    assert [(i, t) for i, t, _ in got] == sorted([(1, ""), (None, "a b c d e f"), (3, tail[-30:]), (4, "call [phone] now"), (5, "[email]")], key=str)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF).collect()
    assert {r.doc_id for r in packed} == {1, 3, 4, 5, None} and sum(r.length for r in packed if r.doc_id == 1) == 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
