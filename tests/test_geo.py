import math

from pyspark.sql import functions as F

from surveyprep.functions.geo import point_wkt, project_xy, wkt_rings
from surveyprep.operators.paths import path_lines
from surveyprep.operators.zones import attach_zones, zone_lookup


def test_projection_reference_points(spark):
    df = spark.createDataFrame([(-116.25, 32 + 10 / 60), (-117.1611, 32.7157), (None, 1.0), (float("nan"), 2.0)],
                               "lng double, lat double")
    x, y = project_xy("lng", "lat")
    rows = df.select(x.alias("x"), y.alias("y"), point_wkt("lng", "lat").alias("w")).collect()
    assert abs(rows[0]["x"] - 6561666.667) < 1e-3 and abs(rows[0]["y"] - 1640416.667) < 1e-3
    assert abs(rows[1]["x"] - 6281427.138) < 1e-3 and abs(rows[1]["y"] - 1841409.641) < 1e-3
    assert rows[1]["w"] == "POINT (6281427.138 1841409.641)"
    assert rows[2]["w"] is None and rows[3]["w"] is None


def _inside(rings, x, y):
    """Brute force: on an edge, or odd crossings over all rings."""
    cross = 0
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, r[1:]):
            if abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) < 1e-12 and min(ax, bx) <= x <= max(ax, bx) \
                    and min(ay, by) <= y <= max(ay, by):
                return True
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                cross += 1
    return cross % 2 == 1


ZONES = [
    (1, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))", [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)],
                                                                       [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]),
    (2, "POLYGON ((4 0, 8 0, 8 4, 4 4, 4 0))", [[(4, 0), (8, 0), (8, 4), (4, 4), (4, 0)]]),
    (3, "MULTIPOLYGON (((1 1, 2 1, 2 2, 1 2, 1 1)), ((10 10, 12 10, 11 12, 10 10)))",
     [[(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)], [(10, 10), (12, 10), (11, 12), (10, 10)]]),
    (4, "POLYGON ((0 4, 3 7, 0 7, 0 4))", [[(0, 4), (3, 7), (0, 7), (0, 4)]]),
]


def _points():
    pts = [(x / 2, y / 2) for x in range(-2, 26) for y in range(-2, 26)]
    pts += [(1.5, 1.5), (4.0, 2.0), (11.0, 11.0), (1.5, 5.5), (None, 1.0), (float("nan"), 1.0)]
    return pts


def _brute():
    out = {}
    for i, (x, y) in enumerate(_points()):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            out[i] = None
            continue
        hits = [zid for zid, _, rings in ZONES if _inside(rings, x, y)]
        out[i] = min(hits) if hits else None
    return out


def test_zone_lookup_matches_brute_force_both_forms(spark):
    zones = spark.createDataFrame([(z, w) for z, w, _ in ZONES], "zone_id short, wkt string")
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(_points())], "id int, x double, y double")
    exp = _brute()
    for cell in (1.0, 3.0, None):
        got = {r["id"]: r["z"] for r in zone_lookup(pts, "x", "y", zones, "z", cell=cell).collect()}
        assert got == exp
    got = {r["id"]: r["z"] for r in zone_lookup(pts, "x", "y", zones, "z", cell=2.0, broadcast=False).collect()}
    assert got == exp
    got = {r["id"]: r["z"] for r in attach_zones(pts, [("x", "y", "z")], zones, force_shuffle=True).collect()}
    assert got == exp


def test_wkt_rings_parse(spark):
    df = spark.createDataFrame([(ZONES[2][1],)], "w string")
    rings = df.select(wkt_rings("w").alias("r")).first()["r"]
    assert len(rings) == 2 and rings[1][2]["y"] == 12.0


def _pings(spark):
    rows = [  # trip, t, seq, lng, lat
        (1, 1, 0, -117.0, 32.7),                     # one ping
        (2, 1, 0, -117.0, 32.7), (2, 2, 0, -117.0, 32.7),  # two equal pings -> POINT
        (3, 3, 0, -117.2, 32.9), (3, 1, 0, -117.0, 32.7), (3, 2, 0, -117.1, 32.8), (3, 4, 0, -117.0, 32.7),  # revisit
        (4, 1, 1, -117.1, 32.8), (4, 1, 0, -117.0, 32.7),  # equal times, tie broken by seq
        (5, 1, 0, None, 32.7), (5, 2, 0, -117.0, 32.7),    # invalid vertex -> null
    ]
    return spark.createDataFrame(rows, "trip int, t int, seq int, lng double, lat double")


def test_path_lines_semantics(spark):
    df = _pings(spark)
    got = {r["trip"]: r["shape"] for r in path_lines(df, "trip", ["t", "seq"], "lng", "lat").collect()}
    cut = {r["trip"]: r["shape"] for r in path_lines(df, "trip", ["t", "seq"], "lng", "lat", stretch=1).collect()}
    assert got == cut
    assert got[1].startswith("POINT (") and got[2].startswith("POINT (")
    assert got[3].startswith("LINESTRING (") and got[3].count(",") == 2
    v = df.select(point_wkt(F.lit(-117.0), F.lit(32.7)).alias("a"), point_wkt(F.lit(-117.1), F.lit(32.8)).alias("b")).first()
    assert got[4] == "LINESTRING (" + v["a"][7:-1] + ", " + v["b"][7:-1] + ")"
    assert got[5] is None


def test_path_of_many_pings_against_brute_force(spark):
    # one trip of 60,000 pings among small ones, two pings a second, vertices met again
    df = spark.range(60000).select(F.lit(7).alias("trip"), F.timestamp_seconds(F.lit(1.7e9) + F.floor(F.col("id") / 2)).alias("t"), F.col("id").alias("seq"),
                                   (F.lit(-117.0) + (F.col("id") * 7919 % 5003) / 10000.0).alias("lng"), (F.lit(32.5) + (F.col("id") % 3) / 10.0).alias("lat"))
    df = df.union(df.where("seq % 2 = 1").withColumn("trip", F.lit(8)).withColumn("t", F.lit(None).cast("timestamp")))
    got = {r["trip"]: r["shape"] for r in path_lines(df.repartition(5), "trip", ["t", "seq"], "lng", "lat").collect()}
    text = {(r["lng"], r["lat"]): r["p"][7:-1] for r in df.select("lng", "lat", point_wkt("lng", "lat").alias("p")).distinct().collect()}
    rows = sorted((r["trip"], r["seq"], r["lng"], r["lat"]) for r in df.collect())
    for trip in (7, 8):
        assert got[trip] == "LINESTRING (" + ", ".join(text[v] for v in dict.fromkeys((x, y) for t, _, x, y in rows if t == trip)) + ")"
    plan = path_lines(df, "trip", ["t", "seq"], "lng", "lat")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
