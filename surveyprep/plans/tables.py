"""Loading the driver's test tables and the derivations shared by the
operator queries and their SQL oracles.

Every derivation here is written twice, once as DataFrame expressions and
once as SQL text, with the same arithmetic in the same order, so Spark and
the oracle engine compute bit-identical inputs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- simulated GPS coordinates and trip ids on the events table -------------

def ev_lng() -> Column:
    return F.lit(-117.3) + F.lit(0.01) * (F.col("user_id") % 50).cast("double")


def ev_lat() -> Column:
    return F.lit(32.55) + F.lit(0.01) * (F.col("event_id") % 60).cast("double")


def ev_trip() -> Column:
    return (F.col("user_id") * 100 + F.dayofmonth("ts")).cast("bigint")


EV_LNG_SQL = "(CAST(-117.3 AS DOUBLE) + CAST(0.01 AS DOUBLE) * CAST(user_id % 50 AS DOUBLE))"
EV_LAT_SQL = "(CAST(32.55 AS DOUBLE) + CAST(0.01 AS DOUBLE) * CAST(event_id % 60 AS DOUBLE))"
EV_TRIP_SQL = "CAST(user_id * 100 + day(ts) AS BIGINT)"


def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


# Fixed values of EPSG:2230 for the oracle, worked out from the published parameters by way of the isometric latitude: the ellipsoid's
# eccentricity, the cone constant, the scaled radius a * F and the radius of the false origin in metres, the central
# meridian in radians, false easting and northing in metres, and the US survey foot in metres.
_ECCENTRICITY, _CONE, _RADIUS, _ORIGIN = 0.08181919104281579, 0.5495175757628218, 13602026.713297728, 9836091.789648417
_MERIDIAN, _EASTING, _NORTHING, _FOOT = -2.028945255443408, 2000000.0, 500000.0, 0.3048006096012192


def project_sql(lng: str, lat: str) -> tuple[str, str]:
    """The projection as SQL text, with typed-in constants (oracle side)."""
    sine = f"({_d(_ECCENTRICITY)} * sin(radians({lat})))"
    t = f"(tan({_d(math.pi / 4)} - radians({lat}) / 2) / pow((1.0 - {sine}) / (1.0 + {sine}), {_d(_ECCENTRICITY / 2)}))"
    rho = f"({_d(_RADIUS)} * pow({t}, {_d(_CONE)}))"
    theta = f"({_d(_CONE)} * (radians({lng}) - {_d(_MERIDIAN)}))"
    x = f"(({_d(_EASTING)} + {rho} * sin({theta})) / {_d(_FOOT)})"
    y = f"(({_d(_NORTHING)} + {_d(_ORIGIN)} - {rho} * cos({theta})) / {_d(_FOOT)})"
    return x, y


# --- the wide "mode" table of lineitem: a slot per line number ---------------

SLOTS = range(1, 8)


def modes_wide(lineitem: DataFrame) -> DataFrame:
    """(l_orderkey, copy, mode_1, ext_1, ...): lines that repeat an order's line number go to further copies of the order."""
    line = [F.col(c) for c in ("l_orderkey", "l_linenumber")]
    order = [F.col(c).asc_nulls_first() for c in ("l_quantity", "l_extendedprice", "l_partkey", "l_suppkey")]
    rows = lineitem.select(*line, F.col("l_quantity").cast("int").alias("q"), "l_extendedprice",
                           F.row_number().over(Window.partitionBy(*line).orderBy(*order)).alias("copy"))
    aggs = []
    for k in SLOTS:
        own = F.col("l_linenumber") == k
        aggs += [F.max(F.when(own, F.col("q") % 10)).alias(f"mode_{k}"), F.max(F.when(own, F.col("l_extendedprice"))).alias(f"ext_{k}")]
    return rows.groupBy("l_orderkey", "copy").agg(*aggs)


MODES_WIDE_SQL = "SELECT l_orderkey, copy, " + ", ".join(
    f"max(CASE WHEN l_linenumber = {k} THEN q % 10 END) AS mode_{k}, max(CASE WHEN l_linenumber = {k} THEN l_extendedprice END) AS ext_{k}" for k in SLOTS
) + (" FROM (SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS q, l_extendedprice, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber"
     " ORDER BY l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST) AS INTEGER) AS copy FROM lineitem) GROUP BY l_orderkey, copy")


# --- 25 square zones from the nation keys ----------------------------------

def square_zones(nation: DataFrame) -> DataFrame:
    x0 = (F.col("n_nationkey") % 5)
    y0 = F.floor(F.col("n_nationkey") / 5).cast("int")
    wkt = F.format_string("POLYGON ((%d %d, %d %d, %d %d, %d %d, %d %d))",
                          x0, y0, x0 + 1, y0, x0 + 1, y0 + 1, x0, y0 + 1, x0, y0)
    return nation.select(F.col("n_nationkey").cast("short").alias("zone_id"), wkt.alias("wkt"),
                         F.col("n_regionkey"))


def zone_points(events: DataFrame) -> DataFrame:
    return events.select("event_id",
                         ((F.col("user_id") % 13).cast("double") * F.lit(0.5) - F.lit(0.5)).alias("px"),
                         ((F.col("event_id") % 13).cast("double") * F.lit(0.5) - F.lit(0.5)).alias("py"))


ZONE_POINTS_SQL = ("SELECT event_id, CAST(user_id % 13 AS DOUBLE) * 0.5::DOUBLE - 0.5::DOUBLE AS px, "
                   "CAST(event_id % 13 AS DOUBLE) * 0.5::DOUBLE - 0.5::DOUBLE AS py FROM events")


# --- 25 zones with a hole each; the island in it belongs to another zone ------

def island_zones(nation: DataFrame) -> DataFrame:
    """Zone k: a square of side 3 with a hole, and the island in the hole of zone (k + 1) mod 25. Neighbours share edges."""
    def ring(x, y, w):
        corners = [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
        return F.concat(F.lit("("), F.concat_ws(", ", *[F.concat_ws(" ", a.cast("string"), b.cast("string")) for a, b in corners]), F.lit(")"))
    k = F.col("n_nationkey")
    x, y = (k % 5 * 3).cast("double"), (F.floor(k / 5) * 3).cast("double")
    u, v = ((k + 1) % 25 % 5 * 3).cast("double"), (F.floor((k + 1) % 25 / 5) * 3).cast("double")
    wkt = F.concat(F.lit("MULTIPOLYGON (("), ring(x, y, 3), F.lit(", "), ring(x + 1, y + 1, 1), F.lit("), ("), ring(u + 1.25, v + 1.25, 0.5), F.lit("))"))
    return nation.select(k.cast("short").alias("zone_id"), wkt.alias("wkt"))


def island_points(events: DataFrame) -> DataFrame:
    return events.select("event_id", ((F.col("user_id") % 131).cast("double") * F.lit(0.125) - F.lit(0.5)).alias("px"),
                         ((F.col("event_id") % 131).cast("double") * F.lit(0.125) - F.lit(0.5)).alias("py"))


ISLAND_ZONE_SQL = """
WITH p AS (SELECT event_id, CAST(user_id % 131 AS DOUBLE) * 0.125::DOUBLE - 0.5::DOUBLE AS px,
                  CAST(event_id % 131 AS DOUBLE) * 0.125::DOUBLE - 0.5::DOUBLE AS py FROM events),
z AS (SELECT n_nationkey AS k, CAST(n_nationkey % 5 * 3 AS DOUBLE) AS x, CAST(n_nationkey // 5 * 3 AS DOUBLE) AS y,
             CAST((n_nationkey + 1) % 25 % 5 * 3 AS DOUBLE) AS u, CAST((n_nationkey + 1) % 25 // 5 * 3 AS DOUBLE) AS v FROM nation),
hit AS (SELECT p.event_id, min(z.k) AS k FROM p JOIN z
        ON (px BETWEEN x AND x + 3 AND py BETWEEN y AND y + 3 AND NOT (px > x + 1 AND px < x + 2 AND py > y + 1 AND py < y + 2))
        OR (px BETWEEN u + 1.25::DOUBLE AND u + 1.75::DOUBLE AND py BETWEEN v + 1.25::DOUBLE AND v + 1.75::DOUBLE)
        GROUP BY p.event_id)
SELECT p.event_id, p.px, p.py, CAST(hit.k AS SMALLINT) AS zone FROM p LEFT JOIN hit ON p.event_id = hit.event_id"""
