"""Packing, exact repeats, near duplicates, line dedup and the pipeline against brute force on small tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from surveyprep.llm import dartminhash, fuzzy_lines, lpf, packing
from surveyprep.llm.registry import bpe_50k

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [words(rng, 120) for _ in range(12)]
    out = base + base[:3]  # exact copies
    for b in base[:4]:  # near copies: one or two words changed
        for k in (1, 2):
            w = b.split()
            for at in rng.sample(range(len(w)), k):
                w[at] = "changed" + str(rng.random())[2:8]
            out.append(" ".join(w))
    out += ["", None, " \n\t ", "two words", "two words", "ab" * 400, "x" * 5000, base[5] + "\n" + base[6], "é" * 300 + " 日本語 " + "\U0001f600" * 60]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}", None) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a repeated row
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """Extra columns with names that the operators use inside."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(None).cast("string") for c in
                           ("key", "worker", "start", "length", "offset", "row", "own_id", "head", "rep", "th", "pos", "word", "n_lines", "carry_doc_id")})


def test_packing_against_the_tokenizer(spark, docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe_50k()["json_path"])
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in enumerate(texts)}
    got = packing.harmonic_pack(clashing(docs), bpe_50k(), with_ids=True).toPandas()
    assert got.length.sum() == sum(map(len, ids.values())) + len(ids[0])
    for r in got.itertuples():
        own = ids[r.doc_id][r.start:r.start + r.length]
        assert list(r.ids) == own and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    for i, g in got[got.doc_id != 0].groupby("doc_id"):
        g = g.sort_values("start")
        assert list(g.start) == [0, *g.length.cumsum()[:-1]] and g.length.sum() == len(ids[i])
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 2048
    used = got.groupby("sequence_id").length.sum()
    assert (2048 - used).sum() < 2048 + 0.02 * used.sum()


def test_packing_parts(spark, docs):
    for n in [1, 2, 45, 63, 64, 65, 1023, 1024, 1025, 2047, 2048, 2049, 5000]:
        plan = packing.cut_plan(n)
        assert sum(x[1] for x in plan) == n and all(k * size <= 2048 for _, size, k in plan)
    special = "a <|endoftext|> b " + "y" * 3000 + "\u2028\x00 'll  \r\n"
    e = packing.Encoder(**bpe_50k())
    rng = random.Random(1)
    for text in [special, "", *("".join(rng.choices(" ab'1.\n\té日\U0001f600<|>", k=200)) for _ in range(50))]:
        assert list(e(text)) == e.slow.encode(text, add_special_tokens=False).ids
    assert packing.harmonic_pack(docs.limit(0), bpe_50k()).count() == 0


def repeats(texts, depth):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + depth] for d in data for i in range(len(d) - depth + 1))
    out = []
    for d in data:
        mark = bytearray(len(d))
        for i in range(len(d) - depth + 1):
            if seen[d[i:i + depth]] > 1:
                mark[i:i + depth] = b"\1" * depth
        kept = bytes(b for b, m in zip(d, mark) if not m)
        out.append((len(d), sum(mark), sum(m and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark)), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("options", [{}, {"depth": 30, "gram": 8}, {"depth": 30, "gram": 8, "task_contents": 1}])
def test_repeats_against_brute_force(docs, texts, options):
    want = repeats([*texts, texts[0]], options.get("depth", 200))
    got = lpf.remove_repeats(clashing(docs), **options).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (i, *x) for i, x in zip([*range(len(texts)), 0], want))


def test_repeats_edges(spark):
    d = spark.createDataFrame([(None, "q" * 250), (1, None), (2, ""), (3, "z" * 199)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in lpf.remove_repeats(d).collect()}
    assert got == {None: (250, 250, 1), 1: (0, 0, 0), 2: (0, 0, 0), 3: (199, 0, 0)}
    assert lpf.remove_repeats(d.limit(0)).count() == 0


def multiset(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def weighted_jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def groups(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_near_duplicates_against_brute_force(docs, texts):
    sets = [multiset(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and weighted_jaccard(sets[i], sets[j]) >= 0.8]
    want = groups(len(texts), links)
    got = dartminhash.near_duplicates(clashing(docs)).collect()
    assert len(got) == len(texts) + 1
    assert {r.doc_id: r.class_id for r in got} == dict(enumerate(want))
    assert all(r.is_kept == (r.doc_id == r.class_id) for r in got)
    kept = dartminhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def test_near_duplicates_unlike_heads(spark):
    """A chain: the bucket's head is like none of two texts that are like each other."""
    rng = random.Random(9)
    w = words(rng, 300).split()
    far = w[:]
    for at in range(0, 60, 4):
        far[at] = "far" + str(at)
    near = far[:]
    near[200] = "other"
    rows = [(1, " ".join(w)), (2, " ".join(far)), (3, " ".join(near)), (None, " ".join(w))]
    got = {r.doc_id: r.class_id for r in dartminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [multiset(t) for _, t in rows[:3]]
    want = groups(3, [(i, j) for i in range(3) for j in range(i) if weighted_jaccard(sets[i], sets[j]) >= 0.8])
    assert got == {None: None, **{i + 1: x + 1 for i, x in enumerate(want)}}
    assert dartminhash.near_duplicates(docs := spark.createDataFrame([], "doc_id long, text string")).count() == 0 and docs.count() == 0


def test_darts_estimate_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
    one, two = dartminhash.signatures([dartminhash.unit_seeds(a), dartminhash.unit_seeds(b)], 2000)
    assert abs((one == two).mean() - 300 / 500) < 0.05
    assert (dartminhash.signatures([dartminhash.unit_seeds(a[:1])], 125) != 0).all()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines_against_brute_force(spark):
    rng = random.Random(11)
    pool = [words(rng, rng.randint(1, 40)) for _ in range(25)]
    near = []
    for p in pool[:12]:
        w = p.split()
        for _ in range(3):
            at = rng.randrange(len(w))
            near.append(" ".join([*w[:at], w[at][:-1] + rng.choice("xyz"), *w[at + 1:]]))
    near += ["  " + p.upper().replace(" ", "\t ") for p in pool[:5]] + ["}", "}", " ", "\r"]
    rows = [(i, "\n".join(rng.choices(pool + near, k=rng.randint(1, 6)))) for i in range(30)] + [(90, None), (91, ""), (92, "\n\n"), (93, "one"), (93, "one\ntwo"), (93, "one")]
    spots = [(d, xxhash.xxh64_intdigest(t.encode(), seed=42), p, x) for d, t in rows if t is not None for p, x in enumerate(t.split("\n"))]
    spots = sorted(set((d, h - (1 << 64) * (h >> 63), p, x) for d, h, p, x in spots))
    norm = [" ".join(x.lower().split()) for *_, x in spots]
    links = [(i, j) for i in range(len(spots)) for j in range(i)
             if norm[i] and norm[j] and edit_distance(norm[i], norm[j]) <= int(0.1 * max(len(norm[i]), len(norm[j])) + 1e-9)]
    root = groups(len(spots), links)
    want = {}
    for i, (d, h, p, _) in enumerate(spots):
        if root[i] != i:
            want.setdefault((d, h), set()).add(p)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.th): set(r.removed) for r in fuzzy_lines.similar_lines(clashing(df)).collect()}
    assert got == want and links
    out = Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in fuzzy_lines.dedup_lines(clashing(df)).collect())
    expected = Counter()
    for d, t in rows:
        lines = [] if t is None else t.split("\n")
        h = 0 if t is None else xxhash.xxh64_intdigest(t.encode(), seed=42)
        gone = want.get((d, h - (1 << 64) * (h >> 63)), set())
        expected[(d, len(lines), len(gone), None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in gone))] += 1
    assert out == expected
    assert fuzzy_lines.dedup_lines(df.limit(0)).count() == 0


def test_lines_of_many_words_and_null_ids(spark):
    rng = random.Random(2)
    long = words(rng, 2000)
    df = spark.createDataFrame([(1, long), (2, long + " more"), (None, long), (3, long)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in fuzzy_lines.dedup_lines(df).collect())
    assert got == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_pipeline_stages(spark, tmp_path, texts):
    import corpus_pipeline

    rng = random.Random(4)
    rows = [(i, ("\n".join(words(rng, 30) for _ in range(4)) if t is None or len(t) < 400 else t), "en", None if i % 4 == 0 else f"s{i % 4}", 5) for i, t in enumerate(texts)]
    rows += [(100, None, None, None, None), (101, "", "en", "s1", 0), rows[0]]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.Scratch(spark, "t").cut(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == [c.split()[0] for c in DOCS.split(", ")], name
        assert docs.where("doc_id in (100, 101)").count() == 0 and docs.count() > 0
    assert docs.groupBy("doc_id").count().where("count > 2").count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
