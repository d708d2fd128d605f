"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Seeds are the entities that fixed rules find: e-mail and IP addresses, card numbers (Luhn) and phone numbers. Every
mention that looks like an identifier (a seed, or another token with a digit or "@") induces a lexical pattern, the two
whole words before it, of any length. Patterns and instances form a graph, whose edges are counted over all texts, and Spark scores it in
rounds: a pattern's score is the trusted share of all its occurrences in the corpus, ordinary words included; an
instance's trust is 1 for seeds and 1 - prod(1 - score) over the accepted patterns that it fills. Patterns of at least
`min_instances` trusted instances and a score of `accept` are accepted, and tokens that fill them are added as spans
of the pattern's kind unless they overlap a seed. Seeds themselves always stay.

Positions are code points, ends exclusive. The regular expressions are possessive and anchored to starts of runs, so
that they take linear time on very long texts and find the same leftmost, non-overlapping matches as the plain ones.

Defined results: a null text reads as empty and has no spans; equal texts have equal spans; rows with equal or null
doc_id are rows of their own; an empty table gives no rows; other columns are ignored (find) or kept (redact).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import is_empty, staged, text_or_empty

KINDS = ("email", "ip", "card", "phone")
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What a text must contain for the expression to have a match: a cheap test before it.
RULES = {"email": (_EMAIL, r"@"), "ip": (_IP, r"[0-9]\.[0-9]"), "card": (_CARD, r"[0-9][0-9\x20-]{13}"), "phone": (_PHONE, r"\+[0-9]")}
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_MENTION = "|".join([*(rule for rule, _ in RULES.values()), _TOKEN])
SPAN = "struct<start:int,kind:int,end:int>"
MIN_INSTANCES, ACCEPT, ROUNDS = 3, 0.5, 3
#: Elements of an array that one fold goes over.
BLOCK = 128
#: Patterns up to this number are broadcast for counting, about 20 MB; beyond it their counts are shuffled.
BROADCAST_PATTERNS = 200_000


def _valid(kind: str, hit: str) -> str:
    """SQL condition under which a match of a kind's expression counts."""
    if kind == "ip":
        return rf"{hit} rlike r'^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){{4}}$'"
    digits = f"regexp_replace({hit}, '[^0-9]', '')"
    if kind == "phone":
        return f"length({digits}) between 10 and 15"
    if kind == "card":  # every second digit from the right counts double, less 9 from 10 on
        number = f"cast(substring({digits}, i, 1) as int)"
        part = f"if((length({digits}) - i) % 2 = 1, {number} * 2 - if({number} > 4, 9, 0), {number})"
        return f"length({digits}) between 14 and 19 and aggregate(transform(sequence(1, length({digits})), i -> {part}), 0, (s, x) -> s + x) % 10 = 0"
    return "true"


def _before(items: str, kind: str, value: str, op: str) -> str:
    """SQL: array of (before, x) for the elements x of an array of a type: what op makes of the values of all elements
    before x, from 0 on. A fold that appends copies its array at every step, so it runs over blocks of BLOCK elements,
    and over the blocks. value is an expression of x, op a format of two values."""
    pair, block = f"struct<before:int,x:{kind}>", f"struct<base:int,items:array<struct<before:int,x:{kind}>>>"
    blocks = f"transform(sequence(0, (size(p) - 1) div {BLOCK}), b -> slice(p, b * {BLOCK} + 1, {BLOCK}))"
    step = f"named_struct('at', {op.format('acc.at', value)}, 'out', concat(acc.out, array(named_struct('before', acc.at, 'x', x))))"
    inner = f"transform({blocks}, own -> aggregate(own, named_struct('at', 0, 'out', cast(array() as array<{pair}>)), (acc, x) -> {step}))"
    jump = f"named_struct('at', {op.format('done.at', 'next.at')}, 'out', concat(done.out, array(named_struct('base', done.at, 'items', next.out))))"
    shifted = f"transform(o.items, i -> named_struct('before', {op.format('o.base', 'i.before')}, 'x', i.x))"
    outer = f"aggregate({inner}, named_struct('at', 0, 'out', cast(array() as array<{block}>)), (done, next) -> {jump}, done -> flatten(transform(done.out, o -> {shifted})))"
    return f"element_at(transform(array({items}), p -> {outer}), 1)"


def _positions(text: str, expression: str) -> str:
    """SQL: array of (start, end, hit, before) for all matches of an expression, by splitting there."""
    hits = f"regexp_extract_all({text}, r'{expression}', 0)"
    gaps = f"split({text}, r'{expression}', -1)"
    pairs = f"element_at(transform(array(named_struct('h', {hits}, 'g', {gaps})), q -> zip_with(slice(q.g, 1, size(q.h)), q.h, (gap, hit) -> named_struct('gap', gap, 'hit', hit))), 1)"
    placed = _before(pairs, "struct<gap:string,hit:string>", "length(x.gap) + length(x.hit)", "{} + {}")
    start = "y.before + length(y.x.gap)"
    return f"transform({placed}, y -> named_struct('start', {start}, 'end', {start} + length(y.x.hit), 'hit', y.x.hit, 'before', y.x.gap))"


def base_spans(text: str) -> Column:
    """The seeds of a text column: array of (start, kind, end), sorted."""
    parts = []
    for no, (kind, (rule, needs)) in enumerate(RULES.items()):
        found = f"filter({_positions(text, rule)}, f -> {_valid(kind, 'f.hit')})"
        spans = f"transform({found}, f -> named_struct('start', f.start, 'kind', {no}, 'end', f.end))"
        test = f"contains({text}, '@')" if kind == "email" else f"{text} rlike r'{needs}'"
        parts.append(f"if({test}, {spans}, cast(array() as array<{SPAN}>))")
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def mentions(text: str) -> Column:
    """Seeds and other identifier-like tokens with their patterns: array of (start, end, kind or null, hit, pattern or null)."""
    kind = "case " + " ".join(f"when m.hit rlike r'^(?:{rule})$' and {_valid(k, 'm.hit')} then {no}" for no, (k, (rule, _)) in enumerate(RULES.items())) + " end"
    # the last two words of the whole gap, looked for from its end
    words = r"regexp_extract(m.before, r'(?s)^(?:.*\s)?(\S++\s++\S++)\s++$', 1)"
    pattern = rf"nullif(regexp_replace(lower({words}), r'\s+', ' '), '')"
    each = f"transform({_positions(text, _MENTION)}, m -> named_struct('start', m.start, 'end', m.end, 'kind', {kind}, 'hit', lower(m.hit), 'pattern', {pattern}))"
    empty = "cast(array() as array<struct<start:int,end:int,kind:int,hit:string,pattern:string>>)"
    return F.expr(f"if({text} rlike '[0-9@]', {each}, {empty})")


def _marked(docs: DataFrame) -> DataFrame:
    """doc (all columns), text, its key (none without mentions), base (its seeds) and mentions."""
    rows = docs.select(F.struct(*docs.columns).alias("doc")).withColumn("text", text_or_empty("doc.text"))
    rows = rows.withColumns({"base": base_spans("text"), "mentions": mentions("text")})
    return rows.withColumn("key", F.when(F.size("mentions") > 0, F.unhex(F.md5("text"))))


def occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """pattern, total: how often the two words of each of patterns(pattern) follow each other in all texts."""
    words = docs.select(F.split(F.lower(text_or_empty()), r"\s+").alias("w"))
    pairs = words.select(F.explode(F.expr("zip_with(slice(w, 1, greatest(size(w) - 1, 0)), slice(w, 2, greatest(size(w) - 1, 0)), (a, b) -> concat(a, ' ', b))")).alias("pattern"))
    if patterns.count() <= BROADCAST_PATTERNS:
        return pairs.join(F.broadcast(patterns), "pattern").groupBy("pattern").agg(F.count("*").alias("total"))
    return pairs.groupBy("pattern").agg(F.count("*").alias("total")).join(patterns, "pattern")


def score_graph(edges: DataFrame, totals: DataFrame, rounds: int = ROUNDS, min_instances: int = MIN_INSTANCES, accept: float = ACCEPT) -> DataFrame:
    """Accepted patterns (pattern, kind, score) of edges(pattern, hit, kind or null, n) after some rounds."""
    graph = staged(edges.join(totals, "pattern"), "graph")
    trusted = graph.where("kind is not null").groupBy("hit").agg(F.min("kind").alias("as"), F.lit(1.0).alias("trust"))
    accepted = None
    for _ in range(rounds):
        known = graph.drop("kind").join(trusted, "hit")
        by_kind = known.groupBy("pattern", "total", "as").agg(F.sum(F.col("n") * F.col("trust")).alias("mass"), F.count_if(F.col("trust") >= accept).alias("instances"))
        scored = by_kind.groupBy("pattern", "total").agg(F.sum("mass").alias("mass"), F.sum("instances").alias("instances"), F.max_by("as", F.struct("mass", "as")).alias("kind"))
        scored = scored.withColumn("score", F.least(F.col("mass") / F.col("total"), F.lit(1.0)))
        accepted = staged(scored.where((F.col("score") >= accept) & (F.col("instances") >= min_instances)).select("pattern", "kind", "score"), "accepted")
        if is_empty(accepted):
            break
        filled = graph.select("pattern", "hit", F.col("kind").alias("seed")).join(accepted, "pattern")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        found = filled.groupBy("hit").agg(F.max_by("kind", F.struct("score", "kind")).alias("as"), (1 - doubt).alias("trust"), F.min("seed").alias("seed"))
        seeds = graph.where("kind is not null").groupBy("hit").agg(F.min("kind").alias("as"), F.lit(1.0).alias("trust"))
        trusted = staged(seeds.unionByName(found.where("seed is null").select("hit", "as", "trust")), "trusted")
    return accepted


def discovered(docs: DataFrame, min_instances: int = MIN_INSTANCES, accept: float = ACCEPT, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame | None]:
    """The staged seeds of docs, (doc, key, base), where doc has all columns, and the spans that accepted patterns add to
    texts, (key, added array of spans); None instead of the latter if there are none."""
    marked = staged(_marked(docs).drop("text"), "mentions")
    docs = marked.select("doc.text")
    texts = marked.where("key is not null").groupBy("key").agg(F.count("*").alias("copies"), F.first("base").alias("base"), F.first("mentions").alias("mentions"))
    texts = staged(texts, "texts")
    edges = texts.select("copies", F.explode("mentions").alias("m")).where("m.pattern is not null").select("copies", "m.*")
    edges = staged(edges.groupBy("pattern", "hit").agg(F.min("kind").alias("kind"), F.sum("copies").alias("n")), "edges")
    patterns = edges.groupBy("pattern").agg(F.count("*").alias("instances")).where(F.col("instances") >= min_instances).select("pattern")
    patterns = staged(patterns, "patterns")
    if is_empty(patterns):
        return marked, None
    # occurrences in texts with mentions bound a pattern's score from above; most patterns end here
    edges = edges.join(patterns, "pattern", "left_semi")
    least = occurrences(docs.where(F.col("text").rlike("[0-9@]")), patterns).withColumnRenamed("total", "least")
    mass = edges.groupBy("pattern").agg(F.sum("n").alias("mass"))
    patterns = staged(mass.join(least, "pattern").where(F.col("mass") >= accept * F.col("least")).select("pattern"), "patterns")
    if is_empty(patterns):
        return marked, None
    accepted = score_graph(edges, occurrences(docs, patterns), rounds, min_instances, accept)
    if is_empty(accepted):
        return marked, None
    fresh = texts.select("key", "base", F.explode("mentions").alias("m")).where("m.kind is null")
    fresh = fresh.join(accepted.select(F.col("pattern").alias("p"), F.col("kind").alias("as")), F.col("m.pattern") == F.col("p"))
    clear = F.expr("not exists(base, b -> b.start < m.end and m.start < b.end)")
    span = F.struct(F.col("m.start").alias("start"), F.col("as").alias("kind"), F.col("m.end").alias("end"))
    return marked, staged(fresh.where(clear).groupBy("key").agg(F.sort_array(F.collect_set(span)).alias("added")), "added")


def _joined(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"concat_ws(',', transform({spans}, s -> concat_ws(':', element_at(array({names}), s.kind + 1), cast(s.start as string), cast(s.end as string))))")


def find(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the seeds), spans (seeds and added ones), n_added."""
    marked, added = discovered(docs.select("doc_id", "text"), **options)
    rows = marked.select("doc.doc_id", "key", "base")
    if added is None:
        rows = rows.withColumn("added", F.expr(f"cast(array() as array<{SPAN}>)"))
    else:
        rows = rows.join(added, "key", "left").withColumn("added", F.coalesce("added", F.expr(f"cast(array() as array<{SPAN}>)")))
    rows = rows.withColumn("every", F.array_sort(F.concat("base", "added")))
    return rows.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(base, s -> s.kind = {no})) as long)").alias(f"n_{kind}") for no, kind in enumerate(KINDS)),
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("every").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, **options) -> DataFrame:
    """docs with every span of its text replaced by its kind in brackets, overlapping spans by the first one's; all
    columns stay."""
    marked, added = discovered(docs, **options)
    rows = marked.select("doc", "key", "base")
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    rows = rows.withColumn("added", none) if added is None else rows.join(added, "key", "left").withColumn("added", F.coalesce("added", none))
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    cuts = _before("array_sort(concat(base, added))", SPAN, "x.end", "greatest({}, {})")  # before: where the last cut ends
    pieces = f"transform(filter({cuts}, c -> c.x.start >= c.before), c -> concat(substring(doc.text, c.before + 1, c.x.start - c.before), element_at(array({names}), c.x.kind + 1)))"
    last = "array_max(transform(concat(base, added), s -> s.end))"
    text = F.expr(f"concat(array_join({pieces}, ''), substring(doc.text, {last} + 1))")
    clean = F.when(F.size("base") + F.size("added") > 0, text).otherwise(F.col("doc.text"))
    return rows.select(*(clean.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns))
