import pytest
from pyspark.sql import functions as F

from harvestry.functions import prices, text, trigram
from harvestry.plans import jobs, runs, sql
from harvestry.sources.versions import Versions
from tests.test_operators import DAY, dims

NAMES = ["  Guntur (APMC) Market ", "Bengal  Gram (Whole)", "", None, "FAQ", "Ärger & Co.", "red reds", "kg "]


def test_scalars_equal_the_column_functions(spark):
    sql.register(spark)
    rows = spark.createDataFrame([(i, n, m) for i, n in enumerate(NAMES) for m in NAMES], "i long, a string, b string").withColumn("p", F.when(F.col("i") != 2, F.col("i") * 1.25))
    rows.createOrReplaceTempView("rows")
    got = spark.sql("select normalize_unit(a), normalize_kind(a), normalize_market(a), normalize_crop(a), trigrams(a), similarity(a, b), price_per_kilo(p, 208 + i), content_hash(p, i, null) from rows").collect()
    columns = [text.normalize_unit("a"), text.normalize_kind("a"), text.market_key("a"), text.crop_key("a"), trigram.trigrams(F.col("a")), trigram.similarity(F.col("a"), F.col("b")), prices.per_kilo(F.col("p"), F.col("i") + 208), prices.content_hash(F.col("p"), F.col("i").cast("double"), F.lit(None).cast("double"))]
    want = rows.select(*columns).collect()
    same = lambda r: [v if k != 5 else v or 0.0 for k, v in enumerate(r)]
    assert [same(r) for r in got] == [same(r) for r in want]


def test_table_functions_and_the_check_of_a_session(spark, tmp_path):
    session = spark.newSession()
    assert len(sql.missing(session)) == len(sql.SCALARS) + len(sql.TABLES)
    with pytest.raises(ValueError, match="function similarity: missing"):
        jobs.startup(spark.createDataFrame([], "key string, value string"), {}, {}, session)
    store = Versions(session, str(tmp_path))
    runs.setup(store, dims(session))
    facts = session.createDataFrame([(43, 10, "f", "g", DAY, 1.0), (42, 10, "f", "g", DAY, 2.0)], "mandi_id long, crop_id long, variety string, grade string, price_date date, modal_price double")
    store.commit({"prices": facts})
    sql.views(store)
    assert sql.missing(session) == [] and jobs.startup(session.createDataFrame([], "key string, value string"), {}, {}, session) == {}
    assert [tuple(r) for r in session.sql("select * from merge_integrity()").collect()] == [("price_on_merged_mandi", 43, 1)]
    assert [r.modal_price for r in session.sql(f"select * from prices_of_market(42, date'{DAY}')").collect()] == [2.0]
    assert [r.id for r in session.sql("select * from markets_like('gunturr', 0.4D)").collect()] == [42]
    session.sql("create or replace temporary function normalize_unit(other string) returns string return other")
    assert sql.missing(session) == ["function normalize_unit: other parameters than (unit string)"]
