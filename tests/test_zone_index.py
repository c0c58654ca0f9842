"""The adaptive zone index against a plain even-odd test of every zone."""

import math
import random

from pyspark.sql import functions as F

from surveyprep.operators.zone_index import build_index
from surveyprep.operators.zones import attach_zones


def holds(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def wkt(parts):
    text = ", ".join("(" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + ")" for ring in part) + ")" for part in parts)
    return f"MULTIPOLYGON ({text})"


def square(x, y, w):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


def check(spark, zones, points, **how):
    z = spark.createDataFrame([(i, wkt(p)) for i, p in zones], "zone_id int, wkt string")
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    got = {r["id"]: r["z"] for r in attach_zones(p, [("x", "y", "z")], z, **how).collect()}
    for i, (x, y) in enumerate(points):
        want = min((k for k, parts in zones if holds([r for part in parts for r in part], x, y)), default=None)
        assert got[i] == want, (x, y, got[i], want)


def test_small_squares_beside_a_large_circle(spark):
    rng = random.Random(4)
    ring = [(100 * math.cos(2 * math.pi * i / 2000), 100 * math.sin(2 * math.pi * i / 2000)) for i in range(2000)]
    zones = [(300, [[ring + ring[:1]]])] + [(i, [[square(float(i % 20), float(i // 20), 1.0)]]) for i in range(200)]
    points = [(rng.uniform(-110, 110), rng.uniform(-110, 110)) for _ in range(1500)] + [(rng.uniform(0, 21), rng.uniform(0, 11)) for _ in range(500)]
    points += [(a / 2, b / 2) for a in range(0, 42, 3) for b in range(0, 24, 3)] + ring[::50] + [(0.0, 0.0), (1e300, 1e300), (-1e300, 0.0)]
    check(spark, zones, points)
    z = spark.createDataFrame([(i, wkt(p)) for i, p in zones], "zone_id int, wkt string")
    index, _, size = build_index(z, "zone_id", "wkt")
    assert index.count() < 1500 and size < 2 << 20  # follows the 2,800 edges; the circle's cells alone would be 31,400 of side one


def test_stars_with_holes_and_parts_cut_to_depth(spark):
    rng = random.Random(9)

    def star(cx, cy, r, n):
        ring = [(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
        return ring + ring[:1]

    zones = []
    for i in range(25):
        cx, cy = rng.uniform(0, 20), rng.uniform(0, 20)
        parts = [[star(cx, cy, rng.uniform(1, 6), 40), star(cx, cy, 0.2, 7)]]
        zones.append((i, parts + [[star(cx + 9, cy, 1.5, 5)]] * (i % 3 == 0)))
    zones += [(40 + i, [[square(4.0 * i, 4.0, 4.0), square(4.0 * i + 1, 5.0, 2.0)]]) for i in range(4)]  # shared edges, holes
    points = [(rng.uniform(-6, 32), rng.uniform(-6, 28)) for _ in range(1500)]
    points += [(a / 2, b / 2) for a in range(0, 36) for b in range(6, 20)] + [v for _, parts in zones[:8] for part in parts for r in part for v in r[:5]]
    check(spark, zones, points)
    check(spark, zones, points, cell=8.0, part_edges=4)  # parts down to the largest depth
    check(spark, zones, points, cell=50.0, part_edges=10 ** 6, force_shuffle=True)  # one cell, never cut


def test_no_zone_and_odd_zones(spark):
    p = spark.createDataFrame([(1, 0.5, 0.5), (2, None, 1.0)], "id int, x double, y double")
    z = spark.createDataFrame([(1, "POLYGON EMPTY"), (None, "POLYGON ((0 0, 1 0, 1 1, 0 0))"), (2, None)], "zone_id int, wkt string")
    assert [r["z"] for r in attach_zones(p, [("x", "y", "z")], z).orderBy("id").collect()] == [None, None]
    flat = spark.createDataFrame([(1, "POLYGON ((0 0.5, 1 0.5, 0 0.5))")], "zone_id int, wkt string")
    assert [r["z"] for r in attach_zones(p, [("x", "y", "z")], flat).orderBy("id").collect()] == [1, None]


def test_joins_pass_a_wide_row_on_as_one_column(spark):
    z = spark.createDataFrame([(1, wkt([[square(0.0, 0.0, 1.0)]])), (2, wkt([[square(1.0, 0.0, 1.0)]]))], "zone_id int, wkt string")
    p = spark.createDataFrame([(0.5, 0.5, 1.5, 0.5), (1.0, 1.0, None, 0.5), (3.0, 0.0, 0.25, 0.75)], "x double, y double, u double, v double")
    wide = p.select("*", *[F.concat_ws("-", F.lit(i), "x").alias(f"c{i}") for i in range(60)])
    out = attach_zones(wide, [("x", "y", "a"), ("u", "v", "b")], z)

    def nodes(n):
        yield n
        for i in range(n.children().size()):
            yield from nodes(n.children().apply(i))

    joins = [n.output().size() for n in nodes(out._jdf.queryExecution().optimizedPlan()) if n.nodeName() == "Join"]
    assert len(joins) == 2 and max(joins) < 30
    assert out.columns == [*wide.columns, "a", "b"]
    want = {(0.5, 1, 2, "59-0.5"), (1.0, 1, None, "59-1.0"), (3.0, None, 1, "59-3.0")}
    assert {(r["x"], r["a"], r["b"], r["c59"]) for r in out.collect()} == want
    # a filter above stops there, and still finds its rows
    assert out.where("c7 = '7-1.0' and a = 1").count() == 1
