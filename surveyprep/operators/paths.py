"""AGG4 / GEO2 / GEO3: ordered GPS pings -> path WKT per trip.

Semantics: pings of a trip in (time, tie-break) order; a repeated
vertex is dropped, keeping its first occurrence; 2+ distinct vertices give
``LINESTRING (...)``, one gives ``POINT (...)``; a trip with a
non-finite coordinate gets a null shape.

Scale design: no numbering of the pings, no sort of the table, no checkpoint.
1. first occurrences: the least (time, tie-break) per (trip, lng, lat),
   partially aggregated map-side, so a device parked on one spot costs one row;
2. segments: the first occurrences of a trip in one stretch of time, sorted
   and joined to a text, per (trip, stretch);
3. a trip's segments, of which no vertex is in two, joined in the order of
   their stretches.
A segment holds what one stretch holds; only the final text of a trip, which
*is* the output value, sits in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyprep.functions.geo import CA_ZONE6_FT, LambertConic, finite, vertex_text

#: Length of a stretch: seconds for times, units for numbers.
STRETCH = 3600


def stretch_of(df: DataFrame, first: str, length: float) -> Column:
    """The stretch of a row by its first order column: rises with it; one stretch if it is neither time nor number."""
    kind = df.schema[first].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.floor(F.unix_timestamp(F.col(first).cast("timestamp")) / F.lit(length))
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(first).cast("double") / F.lit(length))
    return F.lit(0).cast("long")


def path_lines(points: DataFrame, trip: str, order: list[str], lng: str, lat: str,
               out: str = "shape", decimals: int = 3, crs: LambertConic = CA_ZONE6_FT, stretch: float = STRETCH) -> DataFrame:
    """(trip, out) for every trip in ``points``; ``order`` puts a trip's pings in order."""
    p = points.select(F.col(trip).alias("__trip"), F.col(lng).alias("__lng"), F.col(lat).alias("__lat"),
                      F.struct(*[F.col(c) for c in order]).alias("__at"), stretch_of(points, order[0], stretch).alias("__stretch"))
    # the first occurrence has the least stretch, as stretches rise with the order
    first = p.groupBy("__trip", "__lng", "__lat").agg(F.min(F.struct("__stretch", "__at")).alias("__first"))
    vertices = first.select("__trip", F.col("__first.__stretch").alias("__stretch"), F.struct(
        F.col("__first.__at").alias("at"), F.col("__lng").alias("lng"), F.col("__lat").alias("lat"), vertex_text("__lng", "__lat", decimals, crs).alias("text")).alias("__v"),
        (~(finite("__lng") & finite("__lat"))).alias("__bad"))

    def joined(parts: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(parts)), lambda s: s["text"]), ", ")

    segments = vertices.groupBy("__trip", "__stretch").agg(joined("__v").alias("text"), F.count("*").alias("n"), F.max("__bad").alias("bad"))
    lines = segments.withColumn("part", F.struct("__stretch", "text")).groupBy("__trip").agg(
        joined("part").alias("text"), F.sum("n").alias("n"), F.max("bad").alias("bad"))
    shape = (F.when(F.col("bad"), F.lit(None).cast("string"))
             .when(F.col("n") >= 2, F.concat(F.lit("LINESTRING ("), F.col("text"), F.lit(")")))
             .otherwise(F.concat(F.lit("POINT ("), F.col("text"), F.lit(")"))))
    return lines.select(F.col("__trip").alias(trip), shape.alias(out))
