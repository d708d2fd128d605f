import duckdb

from harvestry.llm import chat
from harvestry.llm.common import table
from tests.conftest import SF


def check(spark, frame, arrow, block):
    got = sorted(map(repr, (tuple(r) for r in chat.rotate(frame, block_turns=block).collect())))
    con = duckdb.connect()
    con.register("conversations", arrow)
    want = con.execute(chat.ORACLE).fetchall()
    assert got == sorted(map(repr, want))
    return got


def test_whole_table(spark):
    frame = table(spark, SF, "conversations")
    assert check(spark, frame, frame.toArrow(), 256) == check(spark, frame, frame.toArrow(), 2)


def test_edges(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "anna", "hi"), (1, 1, "anna", "hi"), (1, 1, "bo", None), (1, None, "bo", "ü" * 9000), (None, 0, None, "x"), (2, 0, "system", "alone"), (3, 5, "anna", "")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, seq int")
    check(spark, frame, frame.toArrow(), 2)
    assert chat.rotate(frame.limit(0)).collect() == []


def test_masks_cover_the_speakers_words(spark):
    frame = spark.createDataFrame([(1, 0, "anna", "good day"), (1, 1, "bo", "yes"), (1, 2, "cy", "no")], "conv_id long, turn long, role string, text string")
    for who, words in (("anna", "good day"), ("bo", "yes"), ("cy", "no")):
        rows = sorted(chat.rotate(frame).where(f"perspective = '{who}'").collect(), key=lambda r: r.seq)
        whole = "".join(r.segment for r in rows)
        assert [whole[r.mask_start : r.mask_end] for r in rows if r.mask_end > r.mask_start] == [words + chat.END]
        assert all(whole[r.seg_start : r.seg_end] == r.segment for r in rows)
