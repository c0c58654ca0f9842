"""Periodic runs against brute force: every run by comparing all shifts."""

import hashlib
import random
import zlib

from surveyprep.llm import registry
from surveyprep.llm.run_finder import collapse, document_runs, find_runs, periodic_tails, run_digests


def all_runs(words, least):
    n, out = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            size = j + p - i
            if j > i and size >= max(least, 2 * p):
                smaller = [d for d in range(1, p) if all(words[x] == words[x + d] for x in range(i, i + size - d))]
                if not smaller:
                    out.append((i, size, p))
            i = j + 1
    return sorted(out)


def dropped(words, runs):
    gone = {x for s, n, p in runs for x in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_runs_of_random_words():
    rng = random.Random(7)
    for _ in range(1500):
        n, kinds, least = rng.randint(0, 90), rng.choice([1, 2, 3, 9]), rng.choice([4, 5, 7, 12])
        words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
        if n > 4 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange((n - a) // 2 + 1)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            for _ in range(rng.randrange(3)):
                words[rng.randrange(n)] = b"x"
        runs = all_runs(words, least)
        assert document_runs(words, least) == runs
        assert collapse(words, runs) == dropped(words, runs)


def digest(doc_id, text):
    words = [w.encode() for w in (text or "").split(" ") if w]
    runs = all_runs(words, 12)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    own = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *own, hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(dropped(words, runs))).hexdigest())


def tailed(doc_id, text):
    words = [w for w in (text or "").split(" ") if w]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i if i < a else a + (i - a) % p] for i in range(n))


def test_query_against_brute_force(spark):
    rng = random.Random(3)
    prose = lambda n, kinds: " ".join(f"w{rng.randrange(kinds)}é" for _ in range(n))
    rows = [(i, prose(rng.randrange(1, 120), rng.choice([2, 40, 1000])), 1, "x") for i in range(120)]
    rows += [(500, None, 1, "x"), (501, "", 1, "x"), (502, "   ", 1, "x"), (None, "a b " * 30, 1, "x"), (503, "one two three " * 4, 1, "x"),
             (503, "one two three " * 4, 1, "x"), (504, "long " * 5000, 1, "x"), (None, None, 2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int, start string")
    got = [tuple(r) for r in run_digests(find_runs(periodic_tails(df))).collect()]
    key = lambda r: tuple(str(x) for x in r)
    small = [(i, tailed(i, t)) for i, t, *_ in rows if i != 504]
    assert sorted((g for g in got if g[0] != 504), key=key) == sorted((digest(i, t) for i, t in small), key=key)
    assert [g[1:6] for g in got if g[0] == 504] == [(1, 0, 5000, 1, 5000000)]
    assert find_runs(df.limit(0)).count() == 0
    assert sum(1 for i, t, *_ in rows if tailed(i, t) != t) > 5


def test_words_end_at_ascii_blanks_only(spark):
    df = spark.createDataFrame([(1, "a b c\tx\x0by\x0cz\x1cq\r\nend")], "doc_id long, text string")
    assert find_runs(df).select("n_words", "collapsed").first() == (5, "a b c x y z\x1cq end")


def test_registered_query(spark):
    got = registry.QUERIES["op12_runs"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for i, t in docs:
        words = (t or "").encode().split()
        if len(words) < 400:
            want[i] = digest(i, tailed(i, " ".join(w.decode() for w in words)))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(docs) and all(want.get(r[0], r) == r for r in rows)
