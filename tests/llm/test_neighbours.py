"""Vantage-point trees against brute force: exact at factor one, recall of the registered query."""

import numpy as np
import pytest

from surveyprep.llm import registry
from surveyprep.llm.vantage import Tree, nearest

SF = "/root/testdata/sf0.01"


def plain_score(v, w):
    s = 0.0
    for a, b in zip(v, w):
        s += a * b
    return s


def brute(rows, k, every):
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    queries = {}
    for i, v in ok:
        if i % every == 0:
            key = (len(v), np.array(v, "<f8").tobytes())
            queries[i] = min(queries.get(i, (key, v)), (key, v), key=lambda t: t[0])
    out = set()
    for q, (_, v) in queries.items():
        best = sorted((-plain_score(v, w), i) for i, w in ok if i != q and len(w) == len(v))[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("norms", ["unit", "mixed"])
def test_factor_one_is_exact(spark, norms):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(6, 5))
    points = [centre[i % 6] + 0.2 * rng.normal(size=5) for i in range(400)]
    points = [p / np.linalg.norm(p) if norms == "unit" else p * 10 ** rng.uniform(-2, 2) for p in points]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(1000 + i, rows[40][1]) for i in range(150)]  # a third of the rows are one vector
    rows += [(2000, None), (2020, [1.0, None, 0.0, 0.0, 0.0]), (2040, [float("nan")] * 5), (2060, [float("inf")] * 5), (None, rows[0][1]), (2080, [0.0] * 5),
             (2100, []), (2120, [1.0, 2.0]), (2121, [3.0, 1.0]), (40, rows[41][1]), (7, rows[7][1]), (7, rows[7][1])]
    df = spark.createDataFrame([(i, v, 3, 1.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    want = brute(rows, 6, 20)
    for how in ({}, {"shard_rows": 40, "leaf": 4}, {"shard_rows": 64, "leaf": 8, "sample": 50, "query_block": 3}):
        got = [tuple(r) for r in nearest(df, k=6, relax=1.0, **how).collect()]
        assert set(got) == want and len(got) == len(want)
    assert nearest(df.limit(0)).count() == 0


def test_components_at_the_ends_of_double(spark):
    rows = [(i, [x, y]) for i, (x, y) in enumerate([(1e200, 1.0), (2e200, 0.0), (-1e200, 5.0), (3e200, 1e200)])]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, relax=1.0).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 3, float("inf")), (2, 1, float("inf")), (3, 2, float("-inf"))]


def test_tree_survives_its_bytes():
    x = np.random.default_rng(0).normal(size=(300, 4))
    tree = Tree.build(x, 40.0, 8)
    back = Tree.from_bytes(tree.to_bytes())
    assert all((getattr(tree, f) == getattr(back, f)).all() for f, _ in Tree.FIELDS)
    assert sorted(tree.order) == list(range(300))


def test_registered_query_recall(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = brute(rows, 20, 20), {tuple(r) for r in registry.QUERIES["op13_neighbours"](spark, SF).collect()}
    assert len(got) == len(want) and {(q, r) for q, r, *_ in got} == {(q, r) for q, r, *_ in want}
    pairs = {(q, i): s for q, _, i, s in want}
    assert all(pairs.get((q, i), s) == s for q, _, i, s in got)
    assert sum((q, i) in pairs for q, _, i, _ in got) >= 0.9 * len(want)
    # in many shards, with the registered factor
    many = {tuple(r) for r in nearest(spark.read.parquet(f"{SF}/embeddings.parquet"), shard_rows=64, leaf=8).collect()}
    assert sum((q, i) in pairs for q, _, i, _ in many) >= 0.9 * len(want)
