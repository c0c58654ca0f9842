"""GEO4 / JON1-4: point-in-zone lookup by the adaptive zone index.

Each point computes its one cell (no explode on the big side) and meets the
cell's index row by an equi-join; ``zone_index.lowest_zone`` then looks at the
edges of the point's part of the cell alone. Boundaries belong to their zones,
the lowest id wins, null and non-finite coordinates have no zone.

The index is broadcast if what would be broadcast, measured on the written
index, is under ``BROADCAST_BYTES``: no shuffle of the points, hot coordinates
cost nothing, one output row per input row. Beyond that the distinct coordinate
pairs are joined to it by their cell (AQE splits a hot cell) and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyprep.functions.geo import finite
from surveyprep.operators.zone_index import Grid, build_index, lowest_zone, point_part
from surveyprep.session import whole, widen

#: Largest index, in bytes, that is sent to every executor.
BROADCAST_BYTES = 128 << 20


def _with_zones(df: DataFrame, points: list, index: DataFrame, g: Grid, zone_type: str, small: bool) -> DataFrame:
    """``df`` with the zone of each (x, y, out): one join per point on its cell, then one projection for all zones."""
    cells, keys, parts, found, temp = {}, {}, {}, {}, []
    for i, (x, y, out) in enumerate(points):
        ok, px, py = finite(x) & finite(y), f"__x{i}", f"__y{i}"
        xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
        cells |= {px: F.when(ok, xc), py: F.when(ok, yc)}
        keys |= {f"__c{axis}{i}": F.expr(g.cell(f"__{axis}{i}", axis)) for axis in "xy"}
        parts[f"__part{i}"] = point_part(g, f"__cx{i}", f"__cy{i}", f"__depth{i}", f"__parts{i}", px, py)
        found[out] = lowest_zone(g, f"__part{i}", px, py).cast(zone_type)
        temp += [f"__{n}{i}" for n in ("x", "y", "part")]
    own = list(dict.fromkeys(c for x, y, _ in points for c in (x, y)))
    rest = [c for c in df.columns if c not in own]
    out = df.select(whole(rest).alias("__row"), *own) if rest else df
    out = out.withColumns(cells).withColumns(keys)
    for i in range(len(points)):
        side = index.select(*[F.col(n).alias(f"__{n}{i}") for n in ("cx", "cy", "depth", "parts")])
        # of a cell's parts, only the point's goes on
        out = out.join(F.broadcast(side) if small else side, [f"__cx{i}", f"__cy{i}"], "left")
        out = out.withColumn(f"__part{i}", parts[f"__part{i}"]).drop(f"__cx{i}", f"__cy{i}", f"__depth{i}", f"__parts{i}")
    out = out.select(*[F.col(c) if c in own else F.col(f"__row.`{c}`").alias(c) for c in df.columns], *temp)
    return out.withColumns(found).drop(*temp)


def attach_zones(df: DataFrame, points: list, zones: DataFrame, id_col: str = "zone_id", wkt_col: str = "wkt",
                 cell: float | None = None, zone_type: str = "short", eps: float = 1e-9,
                 force_shuffle: bool = False, widen_input: bool = False, part_edges: int | None = None) -> DataFrame:
    """Attach the lowest zone that holds the point for each ``(x, y, out)`` in ``points``.

    The index is built once. ``cell`` sets the side of its cells; by default
    it follows from the number of edges. ``force_shuffle`` takes the shuffled
    form at any size.
    """
    index, g, size = build_index(zones, id_col, wkt_col, cell, eps, **({"part_edges": part_edges} if part_edges else {}))
    small = size <= BROADCAST_BYTES and not force_shuffle
    if small:
        # the exact test is CPU-bound per row: spread a small input over the cores
        return _with_zones(widen(df) if widen_input else df, points, index, g, zone_type, True)
    out = df
    for x, y, name in points:
        pairs = out.where(finite(x) & finite(y)).select(F.col(x).cast("double").alias("__px"), F.col(y).cast("double").alias("__py")).distinct()
        found = _with_zones(pairs, [("__px", "__py", "__zone")], index, g, zone_type, False).where(F.col("__zone").isNotNull())
        out = out.join(found, (F.col(x).cast("double") == F.col("__px")) & (F.col(y).cast("double") == F.col("__py")), "left")
        out = out.withColumn(name, F.col("__zone")).drop("__px", "__py", "__zone")
    return out


def zone_lookup(df: DataFrame, x: str, y: str, zones: DataFrame, out: str,
                id_col: str = "zone_id", wkt_col: str = "wkt", cell: float | None = None,
                zone_type: str = "short", eps: float = 1e-9, broadcast: bool | None = None) -> DataFrame:
    """Attach the lowest zone that holds point (x, y) as ``out`` (JON1-4).

    ``broadcast=False`` forces the shuffled form over distinct pairs.
    """
    return attach_zones(df, [(x, y, out)], zones, id_col, wkt_col, cell, zone_type, eps, force_shuffle=broadcast is False, widen_input=True)
