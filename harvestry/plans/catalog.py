"""Queries over the driver's tables, each with DuckDB SQL for the same rows.

Suppliers stand for markets (their nation for the state), parts for crops (brand for variety, type for grade), line items
for price observations, orders for batches, events for call logs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions import geo, prices, text
from harvestry.functions.trigram import gram_codes, overlap, similarity
from harvestry.operators import audit, batches, latest, merge, resolve, serving, similar, upsert
from harvestry.sources.staging import dealt, numbered
from harvestry.sources.tables import load
from harvestry.streaming import ticks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: SQL macro text: trigram arrays and their similarity, as in functions.trigram.
_GRAMS = (
    "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''), "
    "lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', CAST(i AS BIGINT), 3)))))"
)


def _similar(a: str, b: str) -> str:
    x, y = _GRAMS.format(a), _GRAMS.format(b)
    return f"coalesce(CAST(len(list_intersect({x}, {y})) AS DOUBLE) / nullif(CAST(len(list_distinct(list_concat({x}, {y}))) AS DOUBLE), 0), 0.0)"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def _date(c: str) -> Column:
    return F.to_date(c)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item, variety, grade, price_date, modal_price: one row per key and day."""
    lines, parts = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "part")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    keys = [F.col("p_brand").alias("item"), F.col("l_returnflag").alias("variety"), F.col("l_linestatus").alias("grade"), _date("l_shipdate").alias("price_date")]
    return rows.groupBy(*keys).agg(F.max("l_extendedprice").alias("modal_price"))


_OBS = """obs AS (
  SELECT p_brand AS item, l_returnflag AS variety, l_linestatus AS grade, CAST(l_shipdate AS DATE) AS price_date, max(l_extendedprice) AS modal_price
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)"""


def _prior(name: str, far: int, near: int) -> str:
    return f"""p{name} AS (
  SELECT item, variety, grade, max_by(modal_price, price_date) AS v FROM obs, d
  WHERE price_date BETWEEN d.d - INTERVAL {far} DAY AND d.d - INTERVAL {near} DAY GROUP BY ALL)"""


_WINDOWS = ",\n".join(_prior(n, *w) for n, w in {"1d": (3, 1), "7d": (10, 4), "1m": (35, 25)}.items())
_CHANGES = ",\n  ".join(
    f"round(l.modal_price - p{n}.v, 4) AS change_{n}, CAST(round(CASE WHEN p{n}.v > 0 THEN 100.0 * (l.modal_price - p{n}.v) / p{n}.v END, 2) AS DOUBLE) AS change_{n}_pct" for n in ("1d", "7d", "1m")
)
_PRIOR_JOINS = " ".join(f"LEFT JOIN p{n} ON p{n}.item = l.item AND p{n}.variety = l.variety AND p{n}.grade = l.grade" for n in ("1d", "7d", "1m"))
_CACHE_SQL = f"""WITH {_OBS}, d AS (SELECT max(price_date) AS d FROM obs), {_WINDOWS},
l AS (SELECT item, variety, grade, max(price_date) AS latest_price_date, max_by(modal_price, price_date) AS modal_price FROM obs GROUP BY ALL)
SELECT l.item, l.variety, l.grade, l.latest_price_date, l.modal_price, {_CHANGES} FROM l {_PRIOR_JOINS}"""


@query(_CACHE_SQL)
def q01_price_cache(spark, sf_dir):
    return latest.price_cache(observations(spark, sf_dir), ["item", "variety", "grade"])


_LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]
_LINE_DESC = ", ".join(f"{c} DESC" for c in _LINE_ORDER)


@query(f"""SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS price_date, l_extendedprice AS modal_price FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_LINE_DESC}) AS n FROM lineitem) WHERE n = 1""")
def q02_latest_per_key(spark, sf_dir):
    rows = latest.latest(load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", *_LINE_ORDER), ["l_partkey", "l_suppkey"], _LINE_ORDER)
    return rows.select("l_partkey", "l_suppkey", _date("l_shipdate").alias("price_date"), F.col("l_extendedprice").alias("modal_price"))


@query(f"""WITH {_OBS}, d AS (SELECT max(price_date) AS d FROM obs), {_WINDOWS}
SELECT item AS item, variety AS variety, grade AS grade,
  p1d.v AS prior_1d, p7d.v AS prior_7d, p1m.v AS prior_1m
FROM p1d FULL JOIN p7d USING (item, variety, grade) FULL JOIN p1m USING (item, variety, grade)""")
def q03_asof_prior(spark, sf_dir):
    found = latest.prior_values(observations(spark, sf_dir), ["item", "variety", "grade"], "modal_price")
    return found.where("prior_1d is not null or prior_7d is not null or prior_1m is not null")


_FLAG_SQL = "CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END"


def _flag_rank(c: Column) -> Column:
    return prices.lookup(c, {"R": 3, "A": 2, "N": 1}, 0)


@query(f"""WITH x AS (SELECT l_partkey, l_suppkey, max({_FLAG_SQL}) AS top FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT i.l_orderkey, i.l_partkey, i.l_suppkey, i.l_linenumber, i.l_returnflag AS source FROM lineitem i LEFT JOIN x ON x.l_partkey = i.l_partkey AND x.l_suppkey = i.l_suppkey
WHERE i.l_linestatus = 'O' AND coalesce(x.top, 0) <= CASE i.l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END""")
def q04_precedence_filter(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", F.col("l_returnflag").alias("source"))
    incoming, existing = (rows.where(F.col("l_linestatus") == s).drop("l_linestatus") for s in ("O", "F"))
    return upsert.respect_precedence(incoming, existing, ["l_partkey", "l_suppkey"], _flag_rank)


@query(f"""SELECT l_partkey, l_suppkey, l_linestatus, CAST(l_shipdate AS DATE) AS price_date, l_extendedprice AS modal_price FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_linestatus = 'O' DESC, {_LINE_DESC}) AS n FROM lineitem) WHERE n = 1""")
def q05_upsert_last_wins(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus", *_LINE_ORDER)
    merged = upsert.upsert(rows.where("l_linestatus = 'F'"), rows.where("l_linestatus = 'O'"), ["l_partkey", "l_suppkey"], _LINE_ORDER)
    return merged.select("l_partkey", "l_suppkey", "l_linestatus", _date("l_shipdate").alias("price_date"), F.col("l_extendedprice").alias("modal_price"))


@query("""SELECT code AS error_code, l_returnflag, count(*) AS n FROM (SELECT l_returnflag,
  CASE WHEN l_quantity IS NULL OR l_quantity > 48 THEN '22003' WHEN NOT (l_extendedprice * (1 - l_discount) <= l_extendedprice * (1 - l_tax)) THEN '23514' ELSE 'OK' END AS code FROM lineitem) GROUP BY ALL""")
def q06_quarantine_split(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("low"), (F.col("l_extendedprice") * (1 - F.col("l_tax"))).alias("high"))
    good, bad = upsert.quarantine(rows, {"22003": F.col("l_quantity") <= 48, "23514": F.col("low") <= F.col("high")})
    count = lambda d: d.groupBy("error_code", "l_returnflag").agg(F.count("*").alias("n"))
    return count(good.withColumn("error_code", F.lit("OK"))).unionByName(count(bad))


@query("""SELECT source, sha256(text) AS content_hash, min(doc_id) AS first_seen, max(doc_id) AS last_seen, count(*) AS times_seen FROM documents GROUP BY source, sha256(text)""")
def q07_content_dedup(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select("source", "doc_id", F.sha2("text", 256).alias("content_hash"))
    found = upsert.content_dedup(rows, ["source"], "doc_id", "doc_id", payload=[])
    return found.withColumnsRenamed({"first_seen_batch_id": "first_seen", "last_seen_batch_id": "last_seen"})


@query("""WITH d AS (SELECT sha256(text) AS content_hash, doc_id % 2 AS half FROM documents), old AS (SELECT DISTINCT content_hash FROM d WHERE half = 0)
SELECT n.content_hash, count(*) AS rows_written, n.content_hash NOT IN (SELECT content_hash FROM old) AS is_new FROM d n WHERE half = 1 GROUP BY n.content_hash""")
def q08_is_new_flag(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("content_hash"), (F.col("doc_id") % 2).alias("half"))
    batch = lambda half: upsert.content_dedup(rows.where(F.col("half") == half).withColumn("seq", F.lit(0)), [], "half", "seq", payload=[])
    _, flagged = upsert.merge_raw(batch(0), batch(1), [])
    return flagged.select("content_hash", F.col("times_seen").alias("rows_written"), "is_new")


@query("""WITH k AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN upper(n_name) WHEN s_suppkey % 3 = 1 THEN 'land of ' || lower(n_name) ELSE 'nowhere' END AS state FROM supplier JOIN nation ON n_nationkey = s_nationkey),
e AS (SELECT lower(n_name) AS key, CAST(n_nationkey AS BIGINT) AS id FROM nation), a AS (SELECT 'land of ' || lower(n_name) AS key, CAST(n_nationkey AS BIGINT) AS id FROM nation WHERE n_nationkey % 2 = 0)
SELECT s_suppkey, coalesce(e.id, a.id) AS entity_id, CASE WHEN e.id IS NOT NULL THEN 'EXACT' WHEN a.id IS NOT NULL THEN 'ALIAS' ELSE 'NONE' END AS method FROM k LEFT JOIN e ON e.key = lower(k.state) LEFT JOIN a ON a.key = lower(k.state)""")
def q09_resolve_exact_alias(spark, sf_dir):
    nations = load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), text.crop_key("n_name").alias("key"))
    aliases = nations.where("id % 2 = 0").select(F.col("id").alias("owner_id"), F.concat(F.lit("land of "), "key").alias("normalized_alias"))
    rows = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    kind = F.col("s_suppkey") % 3
    rows = rows.select("s_suppkey", text.crop_key(F.when(kind == 0, F.upper("n_name")).when(kind == 1, F.concat(F.lit("land of "), F.lower("n_name"))).otherwise("nowhere")).alias("key"))
    # a threshold of 1 switches the fuzzy tier off
    found = resolve.resolve(rows.select("key").distinct(), nations, aliases, [], 1.0)
    return rows.join(found, "key").select("s_suppkey", "entity_id", F.coalesce("method", F.lit("NONE")).alias("method"))


_NAMES_SQL = "names AS (SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY p_name)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))


@query(f"""WITH {_NAMES_SQL},
known AS (SELECT lower(name) AS key, id FROM names WHERE id % 4 <> 3),
asked AS (SELECT DISTINCT CASE WHEN id % 4 = 0 THEN lower(name) WHEN id % 4 = 1 THEN 'alias ' || lower(name) WHEN id % 4 = 2 THEN lower(name) || 's' ELSE 'zq' || CAST(id AS VARCHAR) END AS key FROM names),
al AS (SELECT 'alias ' || lower(name) AS key, id FROM names WHERE id % 8 = 1),
s AS (SELECT a.key, k.id, {_similar('a.key', 'k.key')} AS sim FROM asked a, known k WHERE a.key NOT IN (SELECT key FROM known) AND a.key NOT IN (SELECT key FROM al)),
f AS (SELECT key, id, sim FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY sim DESC, id) AS n FROM s WHERE sim > 0.6) WHERE n = 1)
SELECT a.key, coalesce(k.id, al.id, f.id) AS entity_id, CASE WHEN k.id IS NOT NULL THEN 'EXACT' WHEN al.id IS NOT NULL THEN 'ALIAS' WHEN f.id IS NOT NULL THEN 'FUZZY' ELSE 'CREATED' END AS method
FROM asked a LEFT JOIN known k ON k.key = a.key LEFT JOIN al ON al.key = a.key LEFT JOIN f ON f.key = a.key""")
def q10_resolve_cascade(spark, sf_dir):
    names = _names(spark, sf_dir).withColumn("key", text.crop_key("name"))
    kind = F.col("id") % 4
    asked = names.select(F.when(kind == 0, F.col("key")).when(kind == 1, F.concat(F.lit("alias "), "key")).when(kind == 2, F.concat("key", F.lit("s"))).otherwise(F.concat(F.lit("zq"), F.col("id").cast("string"))).alias("key")).distinct()
    aliases = names.where("id % 8 = 1").select(F.col("id").alias("owner_id"), F.concat(F.lit("alias "), "key").alias("normalized_alias"))
    found = resolve.resolve(asked, names.where("id % 4 <> 3").select("id", "key"), aliases, [], 0.6)
    return found.select("key", "entity_id", F.coalesce("method", F.lit("CREATED")).alias("method"))


@query(f"""WITH {_NAMES_SQL}, s AS (SELECT a.name, b.name AS best, b.id, {_similar('a.name', 'b.name')} AS sim FROM names a JOIN names b ON a.id <> b.id)
SELECT name, best, round(sim, 4) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY sim DESC, id) AS n FROM s WHERE sim > 0.3) WHERE n = 1""")
def q11_fuzzy_top1(spark, sf_dir):
    names = _names(spark, sf_dir)
    found = similar.similar_pairs(names, names, 0.3).where("l_id <> r_id")
    best = latest.latest(found.withColumn("least", -F.col("r_id")), ["l_id"], ["similarity", "least"])
    named = lambda c, out: names.select(F.col("id").alias(c), F.col("name").alias(out))
    return best.join(named("l_id", "name"), "l_id").join(named("r_id", "best"), "r_id").select("name", "best", F.round("similarity", 4).alias("similarity"))


@query(f"""WITH n AS (SELECT DISTINCT p_name AS name, CAST(p_size // 10 AS INT) AS band FROM part)
SELECT a.name AS name_a, b.name AS name_b, a.band, round({_similar('a.name', 'b.name')}, 4) AS similarity FROM n a JOIN n b ON a.band = b.band AND a.name < b.name WHERE {_similar('a.name', 'b.name')} > 0.4""")
def q12_dup_sweep_blocked(spark, sf_dir):
    names = load(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.floor(F.col("p_size") / 10).cast("int").alias("band")).distinct()
    keyed = names.withColumn("id", F.struct("band", "name"))
    pairs = similar.similar_pairs(keyed, keyed, 0.4, ["band"]).where("l_id.name < r_id.name")
    return pairs.select(F.col("l_id.name").alias("name_a"), F.col("r_id.name").alias("name_b"), F.col("l_id.band").alias("band"), F.round("similarity", 4).alias("similarity"))


@query(f"""WITH {_NAMES_SQL} SELECT a.id AS id_a, b.id AS id_b, round({_similar('a.name', 'b.name')}, 4) AS similarity FROM names a JOIN names b ON a.id < b.id
WHERE {_similar('a.name', 'b.name')} > 0.5 AND NOT (a.id % 5 = 0 AND b.id % 5 = 0)""")
def q13_dup_sweep_unblocked(spark, sf_dir):
    names = _names(spark, sf_dir)
    # pairs that wait for review already, whichever way round: those of ids divisible by 5
    queue = similar.duplicate_pairs(names, 0.5).where("id_a % 5 = 0 and id_b % 5 = 0").select(F.col("id_b").alias("id_a"), F.col("id_a").alias("id_b"))
    return similar.duplicate_pairs(names, 0.5, queue=queue).withColumn("similarity", F.round("similarity", 4))


@query("""SELECT 'supplier' AS kind, s_suppkey AS entity_id FROM supplier WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 45)
UNION ALL SELECT 'part', p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)""")
def q14_ghost_entities(spark, sf_dir):
    facts = load(spark, sf_dir, "lineitem").where("l_quantity > 45")
    ghosts = lambda t, key, fact, kind: audit.without_facts(load(spark, sf_dir, t), facts, key, fact).select(F.lit(kind).alias("kind"), F.col(key).alias("entity_id"))
    return ghosts("supplier", "s_suppkey", "l_suppkey", "supplier").unionByName(ghosts("part", "p_partkey", "l_partkey", "part"))


_LINE_KEY = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "price_date"]


def _keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").withColumn("price_date", _date("l_shipdate"))


@query("""SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS price_date, count(*) AS row_count FROM lineitem GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1""")
def q15_duplicate_keys(spark, sf_dir):
    return audit.duplicate_keys(_keyed_lines(spark, sf_dir), _LINE_KEY)


@query("""WITH p AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS day FROM lineitem), b AS (SELECT l_suppkey, min(day) AS a, max(day) AS z FROM p GROUP BY l_suppkey)
SELECT b.l_suppkey, CAST(d AS DATE) AS day FROM b, unnest(generate_series(b.a, b.z, INTERVAL 1 DAY)) AS t(d) WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.l_suppkey = b.l_suppkey AND p.day = CAST(d AS DATE))""")
def q16_date_gaps(spark, sf_dir):
    return audit.date_gaps(load(spark, sf_dir, "lineitem"), "l_shipdate", ["l_suppkey"])


@query("""WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT l_suppkey, CAST(max(day) - min(day) + 1 AS BIGINT) AS expected_count, count(DISTINCT day) AS actual_count, round(count(DISTINCT day) / CAST(max(day) - min(day) + 1 AS DOUBLE) * 100, 2) AS coverage_pct FROM d GROUP BY l_suppkey""")
def q17_date_bounds(spark, sf_dir):
    return audit.date_coverage(load(spark, sf_dir, "lineitem"), "l_shipdate", ["l_suppkey"])


@query("""SELECT user_id, count(*) AS pending, min(ts) AS oldest FROM events WHERE event_type = 'error' AND ts < (SELECT max(ts) FROM events) - INTERVAL 3 DAY GROUP BY user_id""")
def q18_stale_backlog(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    now = F.lit(events.agg(F.max("ts")).head()[0])
    return audit.stale(events.where("event_type = 'error'"), F.col("ts"), now, "3 days").groupBy("user_id").agg(F.count("*").alias("pending"), F.min("ts").alias("oldest"))


@query(f"""WITH s AS (SELECT s_suppkey AS id, s_name AS name, round(s_acctbal / 1000) + 0.0 AS lat, CAST(s_nationkey % 5 AS DOUBLE) AS lng FROM supplier)
SELECT a.id AS id_a, b.id AS id_b, a.lat, a.lng, round({_similar('a.name', 'b.name')}, 4) AS score FROM s a JOIN s b ON a.lat = b.lat AND a.lng = b.lng AND a.id < b.id WHERE {_similar('a.name', 'b.name')} < 0.8""")
def q19_coord_collision(spark, sf_dir):
    places = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (F.round(F.col("s_acctbal") / 1000) + 0.0).alias("lat"), (F.col("s_nationkey") % 5).cast("double").alias("lng"))
    return audit.coordinate_collisions(places, overlap, 0.8, of=gram_codes).select("id_a", "id_b", "lat", "lng", F.round("score", 4).alias("score"))


@query("""WITH f AS (
  SELECT 'AUDIT-001' AS error_code, 'HIGH' AS severity, 'no prices for ' || s_name AS message, 'mandi' AS entity_type, CAST(s_suppkey AS VARCHAR) AS entity_id FROM supplier
    WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 45)
  UNION ALL SELECT 'AUDIT-003', 'CRITICAL', CAST(n AS VARCHAR) || ' rows for one key', 'price', k FROM (SELECT concat_ws('|', l_partkey, l_suppkey, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE)) AS k, count(*) AS n FROM lineitem GROUP BY 1) WHERE n > 1
  UNION ALL SELECT 'AUDIT-005', 'MEDIUM', CAST(count(*) AS VARCHAR) || ' failed pages pending for over 24 hours', NULL, NULL FROM events WHERE event_type = 'error' AND ts < (SELECT max(ts) FROM events) - INTERVAL 24 HOUR HAVING count(*) > 0)
SELECT * FROM f WHERE NOT (error_code = 'AUDIT-001' AND coalesce(TRY_CAST(entity_id AS BIGINT), 1) % 2 = 0)""")
def q20_findings_union(spark, sf_dir):
    suppliers, lines, events = (load(spark, sf_dir, t) for t in ("supplier", "lineitem", "events"))
    ghosts = audit.without_facts(suppliers, lines.where("l_quantity > 45"), "s_suppkey", "l_suppkey")
    repeated = audit.duplicate_keys(_keyed_lines(spark, sf_dir), _LINE_KEY)
    now = F.lit(events.agg(F.max("ts")).head()[0])
    old = audit.stale(events.where("event_type = 'error'"), F.col("ts"), now, "24 hours").agg(F.count("*").alias("n")).where("n > 0")
    found = audit.union(
        [
            audit.finding(ghosts, "AUDIT-001", F.concat(F.lit("no prices for "), "s_name"), "mandi", F.col("s_suppkey")),
            audit.finding(repeated, "AUDIT-003", F.format_string("%d rows for one key", "row_count"), "price", F.concat_ws("|", *_LINE_KEY)),
            audit.finding(old, "AUDIT-005", F.format_string("%d failed pages pending for over 24 hours", "n")),
        ]
    )
    alerts = suppliers.where("s_suppkey % 2 = 0").select(F.lit("AUDIT-001").alias("error_code"), F.lit("mandi").alias("entity_type"), F.col("s_suppkey").cast("string").alias("entity_id"), F.lit("").alias("message"), F.lit("OPEN").alias("status"))
    return audit.new_alerts(found, alerts)


@query("""WITH p AS (SELECT s_nationkey, count(*) AS n, sum(CASE WHEN l_quantity > 2 THEN 1 ELSE 0 END) AS got FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY s_nationkey)
SELECT s_nationkey AS state, CAST(got AS BIGINT) AS captured, n AS reported FROM p WHERE got < n""")
def q21_coverage_reconcile(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    pages = lines.groupBy(F.col("s_nationkey").alias("state")).agg(F.count_if(F.col("l_quantity") > 2).alias("rows"), F.count("*").alias("total"))
    return batches.coverage_shortfall(pages, "state", "rows", "total")


@query()
def q22_merge_counts(spark, sf_dir):
    return _merged(spark, sf_dir)[1]


def _merged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers 2k + 1 merge into 2k; the price of a brand, flag and year is the greatest quantity."""
    lines = load(spark, sf_dir, "lineitem")
    keys = {"mandi_id": F.col("l_suppkey"), "variety": F.col("p_brand"), "grade": F.col("l_returnflag"), "year": F.year("l_shipdate")}
    rows = lines.join(load(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).select(*(v.alias(k) for k, v in keys.items()), "l_quantity")
    facts = dealt(rows, lines.count(), *keys).groupBy(*keys).agg(F.max("l_quantity").alias("modal_price")).withColumn("source_mandi_id", F.lit(None).cast("long"))
    pairs = load(spark, sf_dir, "supplier").where("s_suppkey % 2 = 1").select(F.col("s_suppkey").alias("loser"), (F.col("s_suppkey") - 1).alias("survivor"))
    return merge.merge_markets(facts, pairs, ["mandi_id", "variety", "grade", "year", "source_mandi_id"], ["modal_price"])


_FACTS_SQL = """f AS (SELECT l_suppkey AS mandi_id, p_brand AS variety, l_returnflag AS grade, CAST(year(l_shipdate) AS INT) AS year, max(l_quantity) AS modal_price
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
m AS (SELECT f.*, mandi_id - 1 AS survivor FROM f WHERE mandi_id % 2 = 1 AND mandi_id IN (SELECT s_suppkey FROM supplier)),
c AS (SELECT m.*, k.mandi_id IS NOT NULL AS hit, k.modal_price IS NOT NULL AND k.modal_price = m.modal_price AS same
  FROM m LEFT JOIN f k ON k.mandi_id = m.survivor AND k.variety = m.variety AND k.grade = m.grade AND k.year = m.year)"""
ORACLES["q22_merge_counts"] = f"""WITH {_FACTS_SQL} SELECT mandi_id AS loser, survivor, count(*) FILTER (WHERE same) AS deduped,
  count(*) FILTER (WHERE hit AND NOT same) AS kept_both, count(*) FILTER (WHERE NOT hit) AS moved FROM c GROUP BY ALL"""


@query(f"""WITH {_FACTS_SQL} SELECT mandi_id, variety, grade, year, modal_price, CASE WHEN mandi_id + 1 IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 1) THEN mandi_id END AS source_mandi_id FROM f WHERE NOT (mandi_id % 2 = 1 AND mandi_id IN (SELECT s_suppkey FROM supplier))
UNION ALL SELECT survivor, variety, grade, year, modal_price, mandi_id FROM c WHERE NOT same""")
def q22_merge_union(spark, sf_dir):
    return _merged(spark, sf_dir)[0]


_TREE_SQL = """f AS (SELECT DISTINCT CAST(p_size % 10 AS BIGINT) AS crop_id, p_brand AS variety, p_type AS grade FROM part),
pairs AS (SELECT unnest([1, 3, 5]) AS loser, unnest([0, 2, 4]) AS survivor)"""


@query(f"""WITH {_TREE_SQL}, m AS (SELECT coalesce(survivor, crop_id) AS crop_id, variety, grade FROM f LEFT JOIN pairs ON loser = crop_id) SELECT DISTINCT CAST(crop_id AS BIGINT) AS crop_id, variety, grade FROM m""")
def q23_merge_cascade(spark, sf_dir):
    facts = load(spark, sf_dir, "part").select((F.col("p_size") % 10).cast("long").alias("crop_id"), F.col("p_brand").alias("variety"), F.col("p_type").alias("grade")).distinct()
    pairs = spark.createDataFrame([(1, 0), (3, 2), (5, 4)], "loser long, survivor long")
    key = lambda *c: F.xxhash64(*c)
    crops = facts.select(F.col("crop_id").alias("id")).distinct().withColumns({"status": F.lit("ACTIVE"), "merged_into_id": F.lit(None).cast("long")})
    status = {"status": F.lit("ACTIVE"), "merged_into_id": F.lit(None).cast("long")}
    varieties = facts.select(key("crop_id", "variety").alias("id"), "crop_id", F.col("variety").alias("normalized_name")).distinct().withColumns(status)
    grades = facts.select(key("crop_id", "variety", "grade").alias("id"), key("crop_id", "variety").alias("variety_id"), F.col("grade").alias("normalized_name")).withColumns(status)
    out = merge.merge_crops(crops, varieties, grades, facts, pairs, ["crop_id", "variety", "grade"])
    tree = lambda d, p: d.where("status = 'ACTIVE'").select(F.col("id").alias(p), *[c for c in d.columns if c.endswith("_id") and c != "merged_into_id"], F.col("normalized_name").alias(p.removesuffix("_id")))
    kept = tree(out["varieties"], "variety_id").join(tree(out["grades"], "grade_id"), "variety_id")
    return kept.select("crop_id", "variety", "grade").join(out["prices"], ["crop_id", "variety", "grade"], "left_semi").distinct()


@query("""SELECT 'price_on_merged_mandi' AS issue, l_suppkey AS entity_id, count(*) AS rows FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal < 0 GROUP BY l_suppkey
UNION ALL SELECT 'price_on_merged_crop', l_partkey, count(*) FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size = 1 GROUP BY l_partkey""")
def q24_merge_integrity(spark, sf_dir):
    facts = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("mandi_id"), F.col("l_partkey").alias("crop_id"))
    status = lambda merged: F.when(merged, "MERGED").otherwise("ACTIVE").alias("status")
    markets = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), status(F.col("s_acctbal") < 0))
    crops = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), status(F.col("p_size") == 1))
    return audit.merge_integrity(facts, markets, crops)


@query("""WITH s AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0), p AS (SELECT p_partkey FROM part WHERE p_size > 5)
SELECT l_returnflag, l_linestatus, count(*) AS kept FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM s) AND l_partkey IN (SELECT p_partkey FROM p) GROUP BY ALL""")
def q25_sync_semijoin(spark, sf_dir):
    status = lambda active: F.when(active, "ACTIVE").otherwise("INACTIVE").alias("status")
    crops = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), status(F.col("p_size") > 5))
    markets = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), status(F.col("s_acctbal") > 0))
    varieties = crops.select("id", F.col("id").alias("crop_id"))
    grades = varieties.select("id", F.col("id").alias("variety_id"))
    cache = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("mandi_id"), F.col("l_partkey").alias("crop_id"), F.col("l_partkey").alias("variety_id"), "l_returnflag", "l_linestatus")
    return serving.serving_copies(crops, markets, varieties, grades, cache)["price_cache"].groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("kept"))


@query("""WITH n AS (SELECT max(ts) AS now FROM events) SELECT count(*) AS calls, count(*) FILTER (WHERE event_type = 'error') AS failures,
  count(*) FILTER (WHERE ts > now - INTERVAL 7 DAY) AS calls_7d, count(*) FILTER (WHERE event_type = 'error' AND ts > now - INTERVAL 7 DAY) AS failures_7d,
  CAST(round(100.0 * count(*) FILTER (WHERE event_type = 'error' AND ts > now - INTERVAL 7 DAY) / count(*) FILTER (WHERE ts > now - INTERVAL 7 DAY), 2) AS DOUBLE) AS failure_pct_7d,
  max(value) FILTER (WHERE ts > now - INTERVAL 7 DAY) AS slowest_7d, count(DISTINCT user_id) AS users, max(ts) AS last_call FROM events, n""")
def q26_dashboard_kpis(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    now = F.lit(events.agg(F.max("ts")).head()[0])
    recent, failed = F.col("ts") > now - F.expr("interval 7 days"), F.col("event_type") == "error"
    return audit.kpis(
        events,
        {
            "calls": F.count("*"), "failures": F.count_if(failed), "calls_7d": F.count_if(recent), "failures_7d": F.count_if(recent & failed),
            "failure_pct_7d": F.round(100.0 * F.count_if(recent & failed) / F.count_if(recent), 2), "slowest_7d": F.max(F.when(recent, F.col("value"))),
            "users": F.count_distinct("user_id"), "last_call": F.max("ts"),
        },
    )


@query("""WITH r AS (SELECT o_custkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
SELECT o_custkey FROM r WHERE n <= 3 GROUP BY o_custkey HAVING count(*) = 3 AND bool_and(o_orderstatus = 'F')""")
def q27_last3_failed(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")
    return batches.all_failed(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], F.col("o_orderstatus") == "F")


@query("""WITH b AS (SELECT o_orderkey, count(l_orderkey) AS n, count(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS bad FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
s AS (SELECT CASE WHEN n - bad = 0 THEN CASE WHEN bad > 0 THEN 'FAILED' ELSE 'SUCCESS' END WHEN bad > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, n, bad FROM b)
SELECT status, count(*) AS batches, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(bad) AS BIGINT) AS failed FROM s GROUP BY status""")
def q28_status_rollup(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("bad"))
    rows = load(spark, sf_dir, "orders").select("o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").fillna(0, ["n", "bad"])
    rows = rows.withColumn("status", batches.status(F.col("n") - F.col("bad"), F.col("bad")))
    return rows.groupBy("status").agg(F.count("*").alias("batches"), F.sum("n").alias("rows"), F.sum("bad").alias("failed"))


@query("""WITH q AS (SELECT l_returnflag, CASE l_returnflag WHEN 'R' THEN 1.0 WHEN 'A' THEN 0.9 WHEN 'N' THEN 0.7 ELSE 0.5 END AS c1, 0.75 + CASE WHEN l_linestatus = 'F' THEN 0.25 ELSE 0 END AS c2,
  1.0 - CASE WHEN l_linenumber = 1 THEN 0.5 ELSE 0 END - CASE WHEN l_quantity < 10 THEN 0.5 ELSE 0 END AS c3, CASE WHEN l_discount <= 0.05 THEN 1.0 ELSE 0.3 END AS c4 FROM lineitem)
SELECT CAST(round((CAST(c1 AS DOUBLE) + CAST(c2 AS DOUBLE) + CAST(c3 AS DOUBLE) + CAST(c4 AS DOUBLE)) / 4, 4) AS DOUBLE) AS score, l_returnflag, count(*) AS n FROM q GROUP BY ALL""")
def q29_quality_score(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    source = F.when(F.col("l_returnflag") == "R", "manual").when(F.col("l_returnflag") == "A", "resource_2").when(F.col("l_returnflag") == "N", "resource_1")
    high = F.when(F.col("l_discount") <= 0.05, F.col("l_extendedprice")).otherwise(F.col("l_extendedprice") - 1)
    score = prices.quality(source, F.col("l_extendedprice"), F.lit(0.0), high, F.when(F.col("l_linestatus") == "F", "x").otherwise(" "), F.col("l_linenumber") == 1, F.col("l_quantity") < 10)
    return lines.select("l_returnflag", score["score"].alias("score")).groupBy("score", "l_returnflag").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey IN (210, 211, 214, 234, 257, 260, 273, 274) THEN l_extendedprice ELSE l_extendedprice / 100 END AS price,
  CASE WHEN l_partkey IN (210, 211, 214, 234, 257, 260, 273, 274) THEN 'animal' ELSE 'kg' END AS unit FROM lineitem""")
def q30_unit_convert(spark, sf_dir):
    crop = F.col("l_partkey")
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", prices.per_kilo(F.col("l_extendedprice"), crop).alias("price"), prices.unit_of(crop).alias("unit"))


_NORMAL_SQL = "trim(regexp_replace(regexp_replace(replace(lower(trim({0})), '&', ' and '), '[.,]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH n AS (SELECT 'part' AS kind, p_name || ', No. ' || p_size || ' & Co' AS raw FROM part UNION SELECT 'customer', '  ' || c_name || '  (A)  ' FROM customer UNION SELECT 'supplier', s_name FROM supplier)
SELECT kind, raw, {_NORMAL_SQL.format('raw')} AS normalized, regexp_replace(lower(raw), '[^a-z0-9]', '', 'g') AS token, trim(regexp_replace(lower(raw), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM n""")
def q31_normalize_text(spark, sf_dir):
    parts = load(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.concat("p_name", F.lit(", No. "), F.col("p_size").cast("string"), F.lit(" & Co")).alias("raw"))
    customers = load(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.concat(F.lit("  "), "c_name", F.lit("  (A)  ")).alias("raw"))
    names = parts.union(customers).union(load(spark, sf_dir, "supplier").select(F.lit("supplier"), "s_name")).distinct()
    return names.select("kind", "raw", text.normalize_name("raw").alias("normalized"), text.token("raw").alias("token"), text.slug("raw").alias("slug"))


_MARKET_SUFFIXES = [" APMC", "(F V)", " Mandi", " Grain Market", "(Uzhavar Sandhai )", ""]


@query(f"""WITH m AS (SELECT s_suppkey, s_name || list_extract({_MARKET_SUFFIXES!r}, CAST(s_suppkey % 6 + 1 AS BIGINT)) AS market FROM supplier)
SELECT s_suppkey, market, trim(regexp_replace(lower(regexp_replace(market, '[()]', ' ', 'g')), '\\s*\\b(?:apmc|mandi|market|f\\s*&?\\s*v|grain|sandhai|committee)\\b\\s*', ' ', 'g')) AS match_key FROM m""")
def q32_match_key(spark, sf_dir):
    suffix = F.get(F.array(*map(F.lit, _MARKET_SUFFIXES)), (F.col("s_suppkey") % 6).cast("int"))
    rows = load(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", suffix).alias("market"))
    return rows.withColumn("match_key", text.market_key("market"))


@query("""SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL""")
def q33_json_extract(spark, sf_dir):
    return load(spark, sf_dir, "events").groupBy("event_type", F.get_json_object("props", "$.k").try_cast("long").alias("k")).agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT user_id, tag, count(*) AS n FROM (SELECT user_id, unnest([event_type, 'k' || CAST(k % 3 AS VARCHAR)]) AS tag FROM e) GROUP BY ALL""")
def q34_json_explode(spark, sf_dir):
    k = F.from_json("props", "k long")["k"]
    items = F.array(F.struct(F.col("event_type").alias("tag")), F.struct(F.concat(F.lit("k"), (k % 3).cast("string")).alias("tag")))
    return load(spark, sf_dir, "events").select("user_id", F.inline(items)).groupBy("user_id", "tag").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT n_nationkey AS id, n_nationkey * 7.0 - 80 AS lat, n_nationkey * 13.0 - 160 AS lng FROM nation), r AS (SELECT a.id AS id_a, b.id AS id_b, radians(b.lat - a.lat) AS dlat, radians(b.lng - a.lng) AS dlng, radians(a.lat) AS la, radians(b.lat) AS lb FROM p a JOIN p b ON a.id < b.id)
SELECT id_a, id_b, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(dlat / 2), 2) + cos(la) * cos(lb) * pow(sin(dlng / 2), 2)))), 3) AS km FROM r""")
def q35_haversine(spark, sf_dir):
    places = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), (F.col("n_nationkey") * 7.0 - 80).alias("lat"), (F.col("n_nationkey") * 13.0 - 160).alias("lng"))
    a, b = places.toDF("id_a", "lat_a", "lng_a"), places.toDF("id_b", "lat_b", "lng_b")
    km = geo.haversine_km(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"))
    return a.join(b, F.col("id_a") < F.col("id_b")).select("id_a", "id_b", F.round(km, 3).alias("km"))


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Markets from suppliers, and three candidates for each: the market itself, its town, an office far away."""
    rows = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    lat, lng = (F.col("s_suppkey") % 40).cast("double"), (F.col("s_suppkey") % 70).cast("double")
    markets = rows.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("D"), (F.col("s_suppkey") % 9).cast("string")).alias("district"), F.col("n_name").alias("state"), lat.alias("ref_lat"), lng.alias("ref_lng"))
    make = lambda no, name, d, types, provider: markets.select(
        F.col("id").alias("market_id"), F.lit(no).alias("ord"), name.alias("name"), (F.col("ref_lat") + d).alias("lat"), F.col("ref_lng").alias("lng"), F.array(*map(F.lit, types)).alias("place_types"),
        F.when(F.col("id") % 3 == 0, F.concat_ws(", ", "district", "state")).otherwise(F.col("state")).alias("formatted_address"), F.lit(provider).alias("provider"),
    )
    found = make(0, F.concat("name", F.lit(" Mandi")), 0.01, ["market", "point_of_interest"], "google").union(make(1, F.col("name"), 0.02, ["locality", "political"], "google"))
    found = found.union(make(0, F.concat("name", F.lit(" yard")), F.when(F.col("id") % 2 == 0, 0.02).otherwise(0.4), ["establishment"], "osm")).union(make(1, F.lit("Board"), 2.0, ["government_office"], "osm"))
    return markets, found


@query("""WITH m AS (SELECT s_suppkey AS id, s_suppkey % 3 = 0 AS in_district, s_suppkey % 2 = 0 AS near FROM supplier),
s AS (SELECT id, near, 35 + 20 + CASE WHEN in_district THEN 15 ELSE 0 END + 10 + 10 + CASE WHEN near THEN 15 ELSE 0 END AS score FROM m)
SELECT id AS market_id, 'google' AS provider, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 90 THEN 'HIGH' WHEN score >= 70 THEN 'MEDIUM' ELSE 'LOW' END AS confidence, near AS agreed FROM s""")
def q36_location_score(spark, sf_dir):
    markets, found = _candidates(spark, sf_dir)
    shared = lambda a, b: F.when(F.arrays_overlap(text.core_words(a), text.core_words(b)), 1.0).otherwise(0.0)
    return serving.locate(markets, found, shared).select("market_id", "provider", "score", "confidence", "agreed")


@query()
def q37_name_match_ratio(spark, sf_dir):
    names = load(spark, sf_dir, "part").select("p_name").distinct()
    pairs = similar.similar_pairs(names.select(F.col("p_name").alias("id"), F.col("p_name").alias("name")), names.select(F.col("p_name").alias("id"), F.col("p_name").alias("name")), 0.2).where("l_id < r_id")
    return pairs.select(F.col("l_id").alias("name_a"), F.col("r_id").alias("name_b"), F.round(text.name_match(F.col("l_id"), F.col("r_id")), 4).alias("score"))


@query("""WITH s AS (SELECT s_suppkey AS id, s_acctbal AS latitude, list_extract(['HIGH', 'MEDIUM', 'LOW', 'REVIEW', NULL], CAST(s_suppkey % 5 + 1 AS BIGINT)) AS old, list_extract(['LOW', 'HIGH', 'REVIEW', 'MEDIUM'], CAST(s_suppkey % 4 + 1 AS BIGINT)) AS new FROM supplier),
r AS (SELECT *, CASE old WHEN 'HIGH' THEN 4 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 2 WHEN 'REVIEW' THEN 1 ELSE 0 END AS a, CASE new WHEN 'HIGH' THEN 4 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 2 WHEN 'REVIEW' THEN 1 ELSE 0 END AS b FROM s)
SELECT id, CASE WHEN b >= a THEN CAST(1.5 AS DOUBLE) ELSE latitude END AS latitude, CASE WHEN b >= a THEN new ELSE old END AS location_confidence, b >= a AS updated FROM r""")
def q38_confidence_guard(spark, sf_dir):
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), (F.col("s_suppkey") % n).cast("int"))
    rows = load(spark, sf_dir, "supplier")
    entities = rows.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("latitude"), F.lit(0.0).alias("longitude"), pick(["HIGH", "MEDIUM", "LOW", "REVIEW", None], 5).alias("location_confidence"))
    updates = rows.select(F.col("s_suppkey").alias("id"), F.lit(1.5).alias("new_latitude"), F.lit(2.5).alias("new_longitude"), pick(["LOW", "HIGH", "REVIEW", "MEDIUM"], 4).alias("new_confidence"))
    return serving.guard_locations(entities, updates).drop("longitude")


@query("""WITH r AS (SELECT l_suppkey // 2 AS pair, l_suppkey % 2 AS side, p_brand, p_type, l_returnflag FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT CAST(pair AS BIGINT) AS pair, p_brand, p_type, l_returnflag, count(*) AS n FROM r GROUP BY ALL HAVING count(DISTINCT side) = 2""")
def q39_combo_intersect(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    rows = rows.select(F.floor(F.col("l_suppkey") / 2).cast("long").alias("pair"), (F.col("l_suppkey") % 2).alias("side"), "p_brand", "p_type", "l_returnflag")
    return merge.common_keys(rows, "pair", "side", ["p_brand", "p_type", "l_returnflag"])


@query("""WITH b AS (SELECT user_id, min(CAST(ts AS DATE)) AS target_date FROM events GROUP BY user_id)
SELECT event_id AS id, CAST(user_id AS VARCHAR) AS batch_id, b.target_date, nullif(event_type || CAST(event_id % 4 AS VARCHAR), 'error0') AS state FROM events JOIN b USING (user_id) WHERE event_type = 'error'""")
def q40_retry_join(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    known = events.groupBy(F.col("user_id").cast("string").alias("id")).agg(F.min(_date("ts")).alias("date_range_start"))
    tag = F.when(F.col("event_id") % 4 == 0, "[state=]").otherwise(F.concat(F.lit("[state="), "event_type", (F.col("event_id") % 4).cast("string"), F.lit("] page failed")))
    pages = events.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("batch_id"), F.when(F.col("event_type") == "error", "PENDING").otherwise("RESOLVED").alias("status"), F.lit(None).cast("string").alias("state"), tag.alias("error_message"), F.col("ts").alias("created_at"))
    return batches.retry_plan(pages, known).select("id", "batch_id", "target_date", "state")


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def q41_first_seen(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.struct("ts", "event_id").alias("seq"))
    return resolve.first_seen(rows, ["user_id", "event_type"], "seq").where("first_seen_this_run").select("event_id", "user_id", "event_type")


@query("""SELECT lang, quality, toxic, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL""")
def q42_review_queue_groups(spark, sf_dir):
    return load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").groupBy("lang", "quality", "toxic").agg(F.count("*").alias("n"))


@query("""WITH v AS (SELECT DISTINCT p_size AS crop_id, lower(p_brand) AS name FROM part), known AS (SELECT crop_id, name, row_number() OVER (ORDER BY crop_id, name) AS id FROM v WHERE crop_id % 2 = 0),
fresh AS (SELECT crop_id, name, (SELECT count(*) FROM known) + row_number() OVER (ORDER BY crop_id, name) AS id FROM v WHERE crop_id % 2 = 1)
SELECT CAST(crop_id AS BIGINT) AS crop_id, name, CAST(id AS BIGINT) AS variety_id FROM known UNION ALL SELECT CAST(crop_id AS BIGINT), name, CAST(id AS BIGINT) FROM fresh""")
def q43_backfill_ids(spark, sf_dir):
    rows = load(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("crop_id"), F.col("p_brand").alias("variety")).distinct()
    known = rows.where("crop_id % 2 = 0").select("crop_id", text.normalize_kind("variety").alias("normalized_name"), F.lit("ACTIVE").alias("status"))
    known = numbered(known, ["crop_id", "normalized_name"], "id")
    return resolve.resolve_kinds(rows, known, "crop_id", "variety", "variety_id").select("crop_id", text.normalize_kind("variety").alias("name"), F.col("variety_id").cast("long"))


@query("""SELECT s_suppkey, CASE WHEN n_nationkey % 3 = 0 THEN 'Canon ' || n_name ELSE n_name END AS district FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def q44_district_canonical(spark, sf_dir):
    nations = load(spark, sf_dir, "nation")
    aliases = nations.where("n_nationkey % 3 = 0").select(F.col("n_regionkey").cast("string").alias("state"), F.col("n_name").alias("alias_district"), F.concat(F.lit("Canon "), "n_name").alias("canonical_district"))
    rows = load(spark, sf_dir, "supplier").join(nations, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", F.col("n_regionkey").cast("string").alias("state"), F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("district"))
    return resolve.canonical_districts(rows, aliases).select("s_suppkey", "district")


@query("""WITH n AS (SELECT max(o_orderdate) AS now FROM orders) SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' AND o_orderdate <= now - INTERVAL 90 MINUTE THEN 'FAILED' WHEN o_orderstatus = 'O' THEN 'RUNNING' WHEN o_orderstatus = 'P' THEN 'PARTIAL' ELSE 'SUCCESS' END AS status,
  CASE WHEN o_orderstatus = 'O' AND o_orderdate <= now - INTERVAL 90 MINUTE THEN now END AS completed_at FROM orders, n""")
def q45_stale_lock_reap(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    now = F.lit(orders.agg(F.max("o_orderdate")).head()[0])
    state = F.when(F.col("o_orderstatus") == "O", "RUNNING").when(F.col("o_orderstatus") == "P", "PARTIAL").otherwise("SUCCESS")
    rows = orders.select(F.col("o_orderkey").alias("id"), state.alias("status"), F.col("o_orderdate").alias("started_at"), F.lit(None).cast(dict(orders.dtypes)["o_orderdate"]).alias("completed_at"))
    return batches.reap_stale(rows, now).select("id", "status", "completed_at")


@query("""SELECT user_id, event_type, props, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS times_seen FROM events GROUP BY ALL""")
def q46_dedup_min_max_seen(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("user_id", "event_type", F.col("props").alias("content_hash"), "ts")
    found = upsert.content_dedup(rows, ["user_id", "event_type"], "ts", "ts", payload=[])
    return found.withColumnsRenamed({"content_hash": "props", "first_seen_batch_id": "first_seen", "last_seen_batch_id": "last_seen"})


@query("""SELECT DISTINCT user_id, event_type, props FROM events""")
def q47_stream_dedup(spark, sf_dir):
    stream = ticks.source_of(spark, f"{sf_dir}/events.parquet")
    return ticks.dedup(stream, ticks.new_folder(spark, "dedup"), ["user_id", "event_type", "props"], "ts").select("user_id", "event_type", "props")


@query("""SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n, min(value) AS low, max(value) AS high FROM events GROUP BY ALL""")
def q48_stream_late_window(spark, sf_dir):
    return ticks.daily(ticks.source_of(spark, f"{sf_dir}/events.parquet"), ticks.new_folder(spark, "daily"), "ts", ["event_type"], "value", late="3 days")


def _weekly_sql() -> str:
    row = "CAST(price_date AS VARCHAR) || '|' || CAST(CAST(modal_price AS DECIMAL(18,4)) AS VARCHAR)"
    return f"""WITH {_OBS} SELECT item, variety, grade, CAST(date_trunc('week', price_date) AS DATE) AS week, count(*) AS rows, min(modal_price) AS low, max(modal_price) AS high,
  sha256(string_agg({row}, ',' ORDER BY {row})) AS verification_hash FROM obs GROUP BY 1, 2, 3, 4"""


@query(_weekly_sql())
def q49_weekly_archive(spark, sf_dir):
    return serving.weekly(observations(spark, sf_dir), ["item", "variety", "grade"]).drop("mean")


@query("""WITH a AS (SELECT c_custkey AS id, c_name, c_mktsegment FROM customer), b AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN c_name || '!' ELSE c_name END AS c_name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)
SELECT id, 'c_name' AS field_name, a.c_name AS old_value, b.c_name AS new_value FROM a JOIN b USING (id) WHERE a.c_name IS DISTINCT FROM b.c_name
UNION ALL SELECT id, 'c_mktsegment', a.c_mktsegment, b.c_mktsegment FROM a JOIN b USING (id) WHERE a.c_mktsegment IS DISTINCT FROM b.c_mktsegment""")
def q50_field_changes(spark, sf_dir):
    old = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment")
    new = old.withColumns({"c_name": F.when(F.col("id") % 7 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")), "c_mktsegment": F.when(F.col("id") % 11 != 0, F.col("c_mktsegment"))})
    return merge.field_changes(old, new, "id", ["c_name", "c_mktsegment"])


@query(f"""WITH {_OBS} SELECT item, variety, grade, price_date, modal_price FROM obs WHERE price_date > (SELECT max(price_date) FROM obs) - INTERVAL 30 DAY""")
def q51_retention(spark, sf_dir):
    return serving.retained(observations(spark, sf_dir), 30)


@query("""SELECT confidence, count(*) AS n FROM (SELECT CASE WHEN s_acctbal < 0 THEN 'UNRESOLVED' WHEN s_acctbal < 3000 THEN 'LOW' WHEN s_acctbal < 6000 THEN 'MEDIUM' ELSE 'HIGH' END AS confidence FROM supplier) GROUP BY confidence""")
def q52_band_counts(spark, sf_dir):
    band = F.when(F.col("s_acctbal") >= 6000, "HIGH").when(F.col("s_acctbal") >= 3000, "MEDIUM").when(F.col("s_acctbal") >= 0, "LOW")
    return serving.band_counts(load(spark, sf_dir, "supplier").select(band.alias("confidence")))


@query("""SELECT CAST(o_orderdate AS DATE) AS day, CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, count(*) AS n FROM orders GROUP BY ALL""")
def q53_date_tally(spark, sf_dir):
    state = F.when(F.col("o_orderstatus") == "O", "RUNNING").when(F.col("o_orderstatus") == "P", "PARTIAL").otherwise("SUCCESS")
    return batches.tally(load(spark, sf_dir, "orders").select(_date("o_orderdate").alias("day"), state.alias("status")), "day", "status")


@query(f"""WITH {_NAMES_SQL}, known AS (SELECT lower(name) AS key, id FROM names WHERE id % 2 = 0), asked AS (SELECT DISTINCT lower(name) || 's' AS key FROM names WHERE id % 2 = 0),
s AS (SELECT a.key, k.id, {_similar('a.key', 'k.key')} AS sim FROM asked a, known k WHERE a.key NOT IN (SELECT key FROM known))
SELECT id AS owner_id, key AS normalized_alias, 'FUZZY' AS match_method, round(sim, 4) AS match_confidence, false AS approved
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY sim DESC, id) AS n FROM s WHERE sim > 0.6) WHERE n = 1 AND id % 3 <> 0""")
def q54_fuzzy_aliases(spark, sf_dir):
    names = _names(spark, sf_dir).where("id % 2 = 0").withColumn("key", text.crop_key("name"))
    none = spark.createDataFrame([], "owner_id long, normalized_alias string")
    found = resolve.resolve(names.select(F.concat("key", F.lit("s")).alias("key")).distinct(), names.select("id", "key"), none, [], 0.6)
    known = found.where("entity_id % 3 = 0").select(F.col("key").alias("normalized_alias"))
    return resolve.fuzzy_aliases(found, known).drop("alias_name")


@query("""WITH u AS (SELECT event_type, user_id, CASE WHEN user_id % 3 = 0 THEN 'EXACT' WHEN user_id % 3 = 1 THEN 'FUZZY' ELSE 'NONE' END AS a, CASE WHEN event_type = 'error' THEN 'CREATED' ELSE 'ALIAS' END AS b FROM events)
SELECT 'mandi' AS entity_type, a AS method, count(*) AS n FROM u GROUP BY ALL UNION ALL SELECT 'crop', b, count(*) FROM u GROUP BY ALL""")
def q55_method_counts(spark, sf_dir):
    kind = F.col("user_id") % 3
    rows = load(spark, sf_dir, "events").select(F.when(kind == 0, "EXACT").when(kind == 1, "FUZZY").alias("a"), F.when(F.col("event_type") == "error", "CREATED").otherwise("ALIAS").alias("b"))
    return resolve.tally_methods(rows, {"mandi": "a", "crop": "b"})


@query("""WITH c AS (SELECT p_size AS id FROM part WHERE p_size % 4 <> 0 GROUP BY p_size), v AS (SELECT DISTINCT p_size * 1000 + CAST(substr(p_brand, 7) AS INT) AS id, p_size AS crop_id FROM part),
l AS (SELECT l_suppkey AS mandi_id, p_size AS crop_id, p_size * 1000 + CAST(substr(p_brand, 7) AS INT) AS variety_id FROM lineitem JOIN part ON p_partkey = l_partkey),
m AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 5 <> 0), kv AS (SELECT id FROM v WHERE crop_id IN (SELECT id FROM c))
SELECT 'crops' AS "table", (SELECT count(*) FROM c) AS kept, (SELECT count(DISTINCT p_size) FROM part) - (SELECT count(*) FROM c) AS dropped
UNION ALL SELECT 'markets', (SELECT count(*) FROM m), (SELECT count(*) FROM supplier) - (SELECT count(*) FROM m)
UNION ALL SELECT 'varieties', (SELECT count(*) FROM kv), (SELECT count(*) FROM v) - (SELECT count(*) FROM kv)
UNION ALL SELECT 'grades', (SELECT count(*) FROM kv), (SELECT count(*) FROM v) - (SELECT count(*) FROM kv)
UNION ALL SELECT 'price_cache', count(*) FILTER (WHERE k), count(*) FILTER (WHERE NOT k) FROM (SELECT mandi_id IN (SELECT id FROM m) AND crop_id IN (SELECT id FROM c) AND variety_id IN (SELECT id FROM kv) AS k FROM l)""")
def q56_sync_drops(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("crop_id"), (F.col("p_size") * 1000 + F.substring("p_brand", 7, 10).cast("int")).alias("variety_id"))
    state = lambda id_, n: F.when(F.col(id_) % n != 0, "ACTIVE").otherwise("INACTIVE").alias("status")
    crops = part.select(F.col("crop_id").alias("id"), state("crop_id", 4)).distinct()
    markets = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), state("s_suppkey", 5))
    varieties = part.select(F.col("variety_id").alias("id"), "crop_id").distinct()
    grades = varieties.select(F.col("id"), F.col("id").alias("variety_id"))
    cache = load(spark, sf_dir, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey")).select(F.col("l_suppkey").alias("mandi_id"), "crop_id", "variety_id")
    tables = {"crops": crops, "markets": markets, "varieties": varieties, "grades": grades, "price_cache": cache}
    return serving.serving_drops(tables, serving.serving_copies(*tables.values()))


@query("""WITH f AS (SELECT l_suppkey AS mandi_id, p_brand AS variety, l_returnflag AS grade, max(l_quantity) AS modal_price FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
r AS (SELECT mandi_id // 3 * 3 AS survivor, CASE WHEN mandi_id % 3 = 0 THEN -1 ELSE mandi_id END AS turn, * FROM f),
m AS (SELECT *, min(turn) OVER (PARTITION BY survivor, variety, grade, modal_price) < turn AS equal FROM r)
SELECT survivor AS mandi_id, variety, grade, modal_price, mandi_id AS source_mandi_id FROM m WHERE NOT equal""")
def q57_merge_three(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").join(load(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    facts = lines.groupBy(F.col("l_suppkey").alias("mandi_id"), F.col("p_brand").alias("variety"), F.col("l_returnflag").alias("grade")).agg(F.max("l_quantity").alias("modal_price"))
    facts = facts.withColumn("source_mandi_id", F.lit(None).cast("long"))
    head = (F.floor(F.col("mandi_id") / 3) * 3).cast("long")
    pairs = facts.select(F.col("mandi_id").alias("loser"), head.alias("survivor")).where("loser <> survivor").distinct()
    extra = facts.select(head.alias("survivor")).distinct()
    after = merge.merge_markets(facts, pairs, ["mandi_id", "variety", "grade", "source_mandi_id"], ["modal_price"])[0]
    # groups of one market have no pair and keep no source yet
    alone = extra.join(pairs.select("survivor"), "survivor", "left_anti").select(F.col("survivor").alias("mandi_id"), F.lit(True).alias("alone"))
    return after.join(alone, "mandi_id", "left").withColumn("source_mandi_id", F.when(F.col("alone"), F.col("mandi_id")).otherwise(F.col("source_mandi_id"))).drop("alone")


@query("""SELECT s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS latitude FROM supplier WHERE s_suppkey % 4 <> 0 AND s_acctbal < 0""")
def q58_without_location(spark, sf_dir):
    rows = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("latitude"), F.lit(1.0).alias("longitude"), F.when(F.col("s_suppkey") % 4 != 0, "ACTIVE").otherwise("MERGED").alias("status"))
    return serving.without_location(rows).select("id", "latitude")


@query("""SELECT CASE WHEN event_type = 'error' THEN 'RESOLVED' ELSE 'PENDING' END AS review_status, count(*) AS n FROM events GROUP BY 1""")
def q59_issue_review(spark, sf_dir):
    issues = load(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "event_type", F.lit("PENDING").alias("review_status"), F.lit(None).cast("string").alias("review_note"), F.lit(None).cast("timestamp").alias("reviewed_at"))
    return batches.tally(batches.resolve_where(issues, F.col("event_type") == "error", "RESOLVED", "seen", F.lit("2026-01-01").cast("timestamp")), "review_status")


@query("""SELECT provider, query, ord, name FROM (SELECT 'p' || CAST(s_nationkey % 2 AS VARCHAR) AS provider, CAST(s_nationkey AS VARCHAR) AS query, CAST(s_suppkey AS INT) AS ord, s_name AS name FROM supplier)""")
def q60_candidate_round_trip(spark, sf_dir):
    found = load(spark, sf_dir, "supplier").select(
        F.concat(F.lit("p"), (F.col("s_nationkey") % 2).cast("string")).alias("provider"), F.col("s_nationkey").cast("string").alias("query"), F.col("s_suppkey").cast("int").alias("ord"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("lat"), F.lit(1.0).alias("lng"), F.array(F.lit("market"), F.lit("food")).alias("place_types"), F.lit("x").alias("formatted_address"),
    )
    return serving.decoded_candidates(serving.encoded_candidates(found)).select("provider", "query", "ord", "name")
