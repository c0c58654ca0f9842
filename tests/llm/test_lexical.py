"""Ranked lexical search against brute force and against its SQL."""

import math
import random
import re
from collections import Counter

import duckdb

from surveyprep.llm import registry
from surveyprep.llm.lexical import OP11_SQL, ranked_search, terms_of

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    total, terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        best = []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * total) // terms
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                best.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(best)[:k], 1)]
    return sorted(out, key=str)


def test_terms():
    assert terms_of("Ünder-WORLD İ don't x_1\x7f\x00é9 ".encode()) == [w.encode() for w in words("Ünder-WORLD İ don't x_1\x7f\x00é9 ")]
    assert terms_of(None) == [] == terms_of(b" .,")


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"t{int(rng.paretovariate(0.6))}" for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocab).upper() if rng.random() < 0.1 else rng.choice(vocab) for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 30, 300]))) for i in range(300)]
    docs += [(400 + i, docs[3][1]) for i in range(150)]  # a third are copies
    docs += [(900, None), (901, ""), (902, " .. "), (None, docs[5][1]), (None, "only here"), (7, docs[7][1]), (7, docs[7][1]), (903, "long " * 30000)]
    items = [(i, text(rng.randrange(1, 30))) for i in range(25)] + [(50, None), (51, "?!"), (52, "nowhere"), (None, "only long"), (53, docs[3][1]), (53, docs[3][1])]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, rank int").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    for how in ({}, {"block_terms": 40}, {"head": 0.3}):
        got = sorted((tuple(r) for r in ranked_search(d, q, k=7, **how).collect()), key=str)
        assert got == brute(docs, items, 7)
    assert ranked_search(d.limit(0), q).count() == 0 and ranked_search(d, q.limit(0)).count() == 0


def test_registered_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = registry.QUERIES["op11_lexical"](spark, SF)
    want = con.execute(OP11_SQL).fetchall()
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) == 800
