import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import pii
from harvestry.llm.common import table
from tests.conftest import SF

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    own = [int(d) for d in reversed(digits)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(own)) % 10 == 0


def brute(text):
    spans = []
    for no, (kind, rule) in enumerate(PLAIN.items()):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), no, m.end()))
    return sorted(spans)


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(rows, got):
    want = sorted(((i, hashlib.sha256(joined(brute(t)).encode()).hexdigest(), *(sum(k == n for _, k, _ in brute(t)) for n in range(4))) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got), key=str) == want


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    got = pii.find(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)


HARD = [
    "a@b.c_d@e.f x@y a@b..c @b.c a@b. .a@b.c.d-e",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1.2.3 99999999999999999999.1.1.1 255.255.255.255",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 4111111111111111 12-4111111111111111",
    "4465758382889437 4465758382889437 1 -4465758382889437",
    "+1 (743) 555-3824 +1(((2 ++44 20 7946 0958. +123456789 +1234567890123456 +1",
    "é\U0001f600 u@x.yz \U0001f600 +1 743 555 3824",
    "",
    None,
    "9" * 5000 + " " + "a" * 100_000 + "@" + " 1 2" * 3000,
    "a@b.c " * 2000,
]


def test_edges(spark):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, HARD[0]), (0, HARD[0])]
    docs = spark.createDataFrame([(i, t, "k", 1, "d", "m") for i, t in rows], "doc_id long, text string, key string, base int, doc string, mentions string")
    check(rows, pii.find(docs).collect())
    assert pii.find(docs.limit(0)).collect() == []
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert not any(brute(r.text) for r in clean.where("doc_id in (0, 5, 9)").collect())
    assert pii.redact(docs.limit(0)).collect() == []


@given(st.lists(st.text(alphabet="a1.@+-() 49_%", max_size=60), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_random_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", pii.base_spans("text").alias("s")).collect()
    assert {r.doc_id: [(x.start, x.kind, x.end) for x in r.s] for r in got} == dict(enumerate(map(brute, texts)))


OVERLAPS = ["4111 1111 1111 1111abc@x.org, then", "+1 (743) 555-3824.joe@mail.org", "1.2.3.4@a.b +1.2.3.4567890@c.d", "é 4111111111111111@q.r é"]


@given(st.lists(st.text(alphabet="a1.@+- é", max_size=80), min_size=1, max_size=30))
@settings(max_examples=10, deadline=None)
def test_redaction_leaves_no_span(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts + OVERLAPS)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert not any(brute(t) for t in got.values())
    assert [got[len(texts) + i] for i in range(2)] == ["[CARD], then", "[PHONE]"]


def test_many_matches_take_linear_time(spark):
    docs = spark.createDataFrame([(1, "é a@b.c " * 20_000)], "doc_id long, text string")
    began = time.perf_counter()
    spans = docs.select(pii.base_spans("text").alias("s")).head()[0]
    assert [(x.start, x.end) for x in spans] == [(8 * i + 2, 8 * i + 7) for i in range(20_000)]
    assert pii.redact(docs).head().text == "é [EMAIL] " * 20_000
    assert time.perf_counter() - began < 60


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"filler words here number {i} reach me at user{i}@mail.example.com today") for i in range(10)]
    rows += [(100, "reach me at user77(at)mail today"), (101, "say it at 12 today"), (102, "reach me at noon")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert got[100].spans == "email:12:26" and got[100].n_added == 1 and got[100].n_email == 0
    assert got[101].spans == "" and got[102].spans == "" and got[1].n_email == 1
    text = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert text[100] == "reach me at [EMAIL] today" and text[101] == rows[11][1]


def tokens_of(text):
    """Places, tokens and kinds of texts whose identifiers are whole tokens."""
    for m in re.finditer(r"[^ \t\n]+", text):
        own = [k for s, k, e in brute(m[0]) if (s, e) == (0, len(m[0]))]
        yield m.start(), m[0], own[0] if own else None


def plain_discovery(texts, least=3, accept=0.5, rounds=3):
    """The spans of every text by the same scores, one mention after the other."""
    edges, kinds, totals, found = Counter(), {}, Counter(), []
    for t in texts:
        gap, mentions = [], []
        for at, token, kind in tokens_of(t):
            if re.search("[0-9@]", token):
                pattern = " ".join(gap[-2:]).lower() if len(gap) > 1 else None
                mentions.append((at, at + len(token), kind, token.lower(), pattern))
                if pattern:
                    edges[pattern, token.lower()] += 1
                    kinds.setdefault((pattern, token.lower()), set()).update({kind} - {None})
                gap = []
            else:
                gap.append(token)
        words = re.split(r"\s+", t.lower())
        totals.update(f"{a} {b}" for a, b in zip(words, words[1:]))
        found.append(mentions)
    instances = Counter(p for p, _ in edges)
    graph = {e: n for e, n in edges.items() if instances[e[0]] >= least}
    seeds = {}
    for p, hit in graph:
        for k in kinds[p, hit]:
            seeds[hit] = min(k, seeds.get(hit, 9))
    trusted, accepted = {hit: (k, 1.0) for hit, k in seeds.items()}, {}
    for _ in range(rounds):
        mass, count = defaultdict(float), Counter()
        for (p, hit), n in graph.items():
            if hit in trusted:
                kind, trust = trusted[hit]
                mass[p, kind] += n * trust
                count[p] += trust >= accept
        accepted = {}
        for p in {p for p, _ in mass}:
            own = {k: m for (q, k), m in mass.items() if q == p}
            score = min(sum(own.values()) / totals[p], 1.0)
            if score >= accept and count[p] >= least:
                accepted[p] = max((m, k) for k, m in own.items())[1], score
        filled = defaultdict(list)
        for p, hit in graph:
            if p in accepted:
                filled[hit].append((accepted[p][1], accepted[p][0]))
        trusted = {hit: (k, 1.0) for hit, k in seeds.items()}
        for hit, own in filled.items():
            if hit not in seeds:
                trusted[hit] = max(own)[1], 1 - math.exp(sum(math.log(max(1 - s, 1e-9)) for s, _ in own))
    out = []
    for t, mentions in zip(texts, found, strict=True):
        added = [(a, accepted[p][0], b) for a, b, kind, _, p in mentions if kind is None and p in accepted]
        out.append(joined(sorted(brute(t) + added)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_scores_match_plain_python(spark, seed):
    rng = random.Random(seed)
    long = ["w" * 90, "Ä" * 200, "v" * 81]
    words = ["mail", "key", "Call", "an", *long, "ruft", "no", "zu"]
    leads = [f"{rng.choice(words)} {rng.choice(words)}" for _ in range(5)]
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            lead, n = rng.choice(leads), rng.randrange(12)
            sure = [f"u{n}@m.org", f"10.0.{n}.4", f"+1743555{1000 + n}"]
            kind = rng.choice([sure[leads.index(lead) % 3], *[sure[leads.index(lead) % 3]] * 3, rng.choice(sure), f"x{n}(at)q", f"ab{n}", ""])
            parts.append(rng.choice([" ", "\n"]).join([rng.choice(words), *(lead + rng.choice([" ", " \t"]) + kind).split(" ", 2), rng.choice(words)]))
        texts.append(" ".join(parts))
    texts += texts[:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.spans for r in sorted(pii.find(docs).collect(), key=lambda r: r.doc_id)]
    want = plain_discovery(texts)
    assert got == want and sum(map(len, want)) > sum(len(joined(brute(t))) for t in texts)


def test_patterns_of_long_words(spark):
    for word in ("short", "w" * 90, "\u00fc" * 300):
        rows = [(i, f"{i % 2} a b {word} key id{i}@m.org c") for i in range(6)] + [(10 + i, f"a b {word} key x{i}(at)m c") for i in range(6)]
        got = {r.doc_id: r.n_added for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert [got[10 + i] for i in range(6)] == [1] * 6
