"""JON1 / GEO4: an adaptive index of zone polygons.

The extent is laid out in square cells, about one for every ``EDGES_PER_CELL``
edges, so that the number of cells follows the zones' edges and not their
area. A cell lists, for each zone whose boundary passes through it, the edges
that do, and whether the cell's reference point lies inside the zone (the
parity base). A zone without an edge in the cell covers it whole or not at
all, and of those that cover it only the lowest id matters. A cell with many
edges is cut into 4**d parts, each with a list and a reference point of its
own, found by position. The size is bounded by edges x cells crossed.

A point needs the edges of its part alone: it lies inside a zone if the line
to the part's reference point crosses an odd number of them and the reference
point is outside, or an even number and it is inside. Even-odd parity over all
rings covers holes and zones of several parts. Whether a vertex lies left of
that line is decided once per vertex, by the same arithmetic for both edges
that share it, so lines through vertices need no special case; edges and
points keep their own coordinates, nothing is rounded to the cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyprep.functions.geo import wkt_rings
from surveyprep.session import ensure_checkpoint_dir

EDGES_PER_CELL = 8
#: A cell with more edges than this is cut into parts, up to 4**MAX_DEPTH.
PART_EDGES = 24
#: With few cells, those with edges are cut into 4 or 16 parts, about this many in all: points of parts without edges need no test.
FEW_PARTS = 4096
MAX_DEPTH = 5
#: Most cells along one side of the extent.
MAX_SIDE = 4096
#: Where a reference point lies in its cell; off the round fractions on which boundaries like to lie.
REF_X, REF_Y = 0.4871193, 0.5213467


@dataclass(frozen=True)
class Grid:
    """The layout of the cells; its methods give SQL text, which costs the driver one call where columns cost hundreds."""

    x0: float
    y0: float
    side: float
    eps: float
    least_depth: int = 0

    @property
    def margin(self) -> float:
        """Edges this near to a cell count as passing through it."""
        return 4 * self.eps + 1e-6 * self.side

    def cell(self, v: str, axis: str) -> str:
        return f"floor(({v} - {self.origin(axis)}) / {_d(self.side)})"

    def origin(self, axis: str) -> str:
        return _d(self.x0 if axis == "x" else self.y0)

    def ref(self, axis: str, cell: str, part: str = "0", parts: str = "1") -> str:
        """Coordinate of a part's reference point."""
        return f"({self.origin(axis)} + ({cell} + ({part} + {_d(REF_X if axis == 'x' else REF_Y)}) / {parts}) * {_d(self.side)})"


def _d(v: float) -> str:
    return f"{float(v)!r}D"


def zone_edges(zones: DataFrame, id_col: str, wkt_col: str) -> DataFrame:
    """(zone_id, edge<ax, ay, bx, by>): every ring edge of every zone; zones without an id or a ring have none."""
    rings = zones.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("zone_id"), F.explode(wkt_rings(F.col(wkt_col))).alias("r"))
    edges = "transform(sequence(0, size(r) - 2), i -> struct(r[i].x as ax, r[i].y as ay, r[i + 1].x as bx, r[i + 1].y as by))"
    return rings.where("size(r) >= 2").select("zone_id", F.explode(F.expr(edges)).alias("edge"))


def lay_grid(edges: DataFrame, cell: float | None, eps: float) -> Grid:
    """Origin and cell side, from one aggregate over the edges, and the least depth of a cell with edges."""
    r = edges.selectExpr("count(*) as n", "min(least(edge.ax, edge.bx)) as x0", "max(greatest(edge.ax, edge.bx)) as x1",
                         "min(least(edge.ay, edge.by)) as y0", "max(greatest(edge.ay, edge.by)) as y1").first()
    if not r["n"]:
        return Grid(0.0, 0.0, 1.0, eps)
    w, h = r["x1"] - r["x0"], r["y1"] - r["y0"]
    cells = max(256, r["n"] / EDGES_PER_CELL)
    side = cell or max(math.sqrt(w * h / cells), max(w, h) / MAX_SIDE) or 1.0
    least = max(0, min(2, int(math.log(FEW_PARTS / max(1.0, w * h / side / side), 4))))
    return Grid(r["x0"] - side / 2, r["y0"] - side / 2, side, eps, least)


def _left(ax: str, ay: str, bx: str, by: str, x: str, y: str) -> str:
    """(x, y) lies left of the directed line a -> b."""
    return f"(({bx} - {ax}) * ({y} - {ay}) - ({by} - {ay}) * ({x} - {ax}) > 0)"


def _odd(edges: str, px: str, py: str, rx: str, ry: str) -> str:
    """The line from p to r crosses an odd number of the edges."""
    sides = f"{_left(px, py, rx, ry, 'e.ax', 'e.ay')} != {_left(px, py, rx, ry, 'e.bx', 'e.by')}"
    apart = f"{_left('e.ax', 'e.ay', 'e.bx', 'e.by', px, py)} != {_left('e.ax', 'e.ay', 'e.bx', 'e.by', rx, ry)}"
    return f"(size(filter({edges}, e -> {sides} and {apart})) % 2 = 1)"


def _on_edge(edges: str, x: str, y: str, eps: float) -> str:
    t = _d(eps)
    line = f"abs((e.bx - e.ax) * ({y} - e.ay) - (e.by - e.ay) * ({x} - e.ax)) <= {t} * (abs(e.bx - e.ax) + abs(e.by - e.ay) + 1)"
    box = " and ".join(f"{v} >= least(e.a{k}, e.b{k}) - {t} and {v} <= greatest(e.a{k}, e.b{k}) + {t}" for v, k in ((x, "x"), (y, "y")))
    return f"exists({edges}, e -> {box} and {line})"


def cells_inside(edges: DataFrame, g: Grid) -> DataFrame:
    """(zone_id, cx, cy) of the cells whose reference point lies inside the zone, by scan lines through these points."""
    first, last = (g.cell(f"{f}(edge.ay, edge.by)", "y") for f in ("least", "greatest"))
    rows = edges.selectExpr("zone_id", "edge", f"explode(sequence({first} - 1, {last} + 1)) as cy")
    rows = rows.withColumn("y", F.expr(g.ref("y", "cy"))).where("(edge.ay > y) != (edge.by > y)")

    def met(cx: str) -> str:  # the ray to the right from the reference point of column cx meets the edge
        return f"if({_left('edge.ax', 'edge.ay', 'edge.bx', 'edge.by', g.ref('x', cx), 'y')} = (edge.by > edge.ay), 1, 0)"

    at = "((edge.bx - edge.ax) * (y - edge.ay) / (edge.by - edge.ay) + edge.ax)"
    rows = rows.withColumn("near", F.expr(f"floor(({at} - {g.origin('x')}) / {_d(g.side)} - {_d(REF_X)})"))
    # columns below `near` - 1 meet it; the three about the crossing are decided by the exact test
    rows = rows.withColumn("past", F.expr(f"near - 1 + {met('(near - 1)')} + {met('near')} + {met('(near + 1)')}"))
    spans = rows.groupBy("zone_id", "cy").agg(F.array_sort(F.collect_list("past")).alias("k")).where("size(k) >= 2")
    inside = "flatten(transform(sequence(0, size(k) - 2, 2), i -> if(k[i] < k[i + 1], sequence(k[i], k[i + 1] - 1), cast(array() as array<bigint>))))"
    return spans.select("zone_id", "cy", F.explode(F.expr(inside)).alias("cx"))


def cells_crossed(edges: DataFrame, g: Grid) -> DataFrame:
    """(zone_id, cx, cy, edge): the cells that each edge passes through, row by row."""
    m = _d(g.margin)
    first, last = g.cell(f"(least(edge.ay, edge.by) - {m})", "y"), g.cell(f"(greatest(edge.ay, edge.by) + {m})", "y")
    rows = edges.selectExpr("zone_id", "edge", f"explode(sequence({first}, {last})) as cy")

    def x_at(y: str) -> str:  # the edge's x at height y, or at its end if it doesn't get there
        t = f"if(edge.by = edge.ay, 0D, ({y} - edge.ay) / (edge.by - edge.ay))"
        return f"(edge.ax + least(1D, greatest(0D, {t})) * (edge.bx - edge.ax))"

    low = f"({g.origin('y')} + cy * {_d(g.side)} - {m})"
    flat = f"abs(edge.by - edge.ay) <= {m}"
    a, b = f"if({flat}, edge.ax, {x_at(low)})", f"if({flat}, edge.bx, {x_at(f'({low} + {_d(g.side + 2 * g.margin)})')})"
    rows = rows.selectExpr("zone_id", "cy", "edge", f"{a} as a", f"{b} as b")
    return rows.selectExpr("zone_id", "cy", "edge", f"explode(sequence({g.cell(f'(least(a, b) - {m})', 'x')}, {g.cell(f'(greatest(a, b) + {m})', 'x')})) as cx")


def _cut(g: Grid) -> str:
    """The parts of a cell (columns cx, cy, base, cands, along): array<struct<base, cands>>."""
    m, side = _d(g.margin), _d(g.side)
    box = (f"struct({g.origin('x')} + cx * {side} + p % along * ({side} / along) - {m} as x, {g.origin('y')} + cy * {side} + floor(p / along) * ({side} / along) - {m} as y, "
           f"{side} / along + 2 * {m} as w, {g.ref('x', 'cx', 'p % along', 'along')} as rx, {g.ref('y', 'cy', 'floor(p / along)', 'along')} as ry, "
           f"{g.ref('x', 'cx')} as ox, {g.ref('y', 'cy')} as oy)")
    corner = "signum((e.bx - e.ax) * ({y} - e.ay) - (e.by - e.ay) * ({x} - e.ax))"
    corners = " + ".join(corner.format(x=x, y=y) for x in ("q.x", "(q.x + q.w)") for y in ("q.y", "(q.y + q.w)"))
    # an edge passes through a part if its box meets the part's and the part's corners don't all lie on one side of it
    passes = (f"greatest(e.ax, e.bx) >= q.x and least(e.ax, e.bx) <= q.x + q.w and greatest(e.ay, e.by) >= q.y and least(e.ay, e.by) <= q.y + q.w "
              f"and abs({corners}) < 4")
    own = (f"transform(cands, c -> struct(c.zone_id as zone_id, c.inside != {_odd('c.edges', 'q.rx', 'q.ry', 'q.ox', 'q.oy')} as inside, "
           f"filter(c.edges, e -> {passes}) as edges))")
    boxes = f"transform(sequence(0, along * along - 1), p -> {box})"
    whole = "array_min(transform(filter(o, c -> c.inside and size(c.edges) = 0), c -> c.zone_id))"
    return f"transform(transform({boxes}, q -> {own}), o -> struct(least(base, {whole}) as base, filter(o, c -> size(c.edges) > 0) as cands))"


def build_index(zones: DataFrame, id_col: str, wkt_col: str, cell: float | None = None, eps: float = 1e-9,
                part_edges: int = PART_EDGES) -> tuple[DataFrame, Grid, int]:
    """((cx, cy, depth, parts), the grid, bytes): the index, written to the shared folder, and its size."""
    ensure_checkpoint_dir(zones.sparkSession)
    edges = zone_edges(zones, id_col, wkt_col).checkpoint()
    g = lay_grid(edges, cell, eps)
    inside, crossed = cells_inside(edges, g), cells_crossed(edges, g)
    pieces = inside.select("cx", "cy", "zone_id", F.lit(True).alias("inside"), F.lit(None).cast(edges.schema["edge"].dataType).alias("edge")).union(
        crossed.select("cx", "cy", "zone_id", F.lit(False).alias("inside"), "edge"))
    zoned = pieces.groupBy("cx", "cy", "zone_id").agg(F.max("inside").alias("inside"), F.collect_list("edge").alias("edges"))
    cells = zoned.groupBy("cx", "cy").agg(F.expr("min(if(size(edges) = 0, zone_id, null))").alias("base"),
                                          F.expr("collect_list(if(size(edges) > 0, struct(zone_id, inside, edges), null))").alias("cands"))
    # a zone above the lowest one that covers the cell is never the answer
    cells = cells.withColumn("cands", F.expr("filter(cands, c -> base is null or c.zone_id < base)"))
    n = "aggregate(cands, 0, (s, c) -> s + size(c.edges))"
    cells = cells.withColumn("depth", F.expr(f"cast(least({MAX_DEPTH}, if({n} = 0, 0, greatest({g.least_depth}, ceil(log2({n} / {_d(part_edges)}) / 2)))) as int)"))
    cells = cells.withColumn("along", F.expr("shiftleft(1, depth)"))
    index = cells.select("cx", "cy", "depth", F.expr(f"if(depth = 0, array(struct(base, cands)), {_cut(g)})").alias("parts")).checkpoint()
    held = "aggregate(parts, 96L, (s, p) -> s + 48 + aggregate(p.cands, 0L, (t, c) -> t + 48 + 72 * size(c.edges)))"
    return index, g, int(index.selectExpr(f"sum({held})").first()[0] or 0)


def point_part(g: Grid, cx: str, cy: str, depth: str, parts: str, x: str, y: str) -> Column:
    """struct<base, cands, rx, ry>: the part of the cell that holds (x, y), and its reference point; null without a cell."""
    along = f"shiftleft(1, {depth})"

    def place(v: str, axis: str, cell: str) -> str:
        return f"least(greatest(floor((({v} - {g.origin(axis)}) / {_d(g.side)} - {cell}) * {along}), 0), {along} - 1)"

    fx, fy = place(x, "x", cx), place(y, "y", cy)
    part = f"{parts}[cast({fy} * {along} + {fx} as int)]"
    return F.expr(f"if({depth} is null, null, struct({part}.base as base, {part}.cands as cands, {g.ref('x', cx, fx, along)} as rx, {g.ref('y', cy, fy, along)} as ry))")


def lowest_zone(g: Grid, part: str, x: str, y: str) -> Column:
    """The lowest zone at (x, y), by its part of the index; null if there is none.

    ``part``, ``x`` and ``y`` are names of columns: the test of each edge reads them.
    """
    # what a part lists lies below the cell's base already
    hit = f"filter({part}.cands, c -> {_on_edge('c.edges', x, y, g.eps)} or c.inside != {_odd('c.edges', x, y, f'{part}.rx', f'{part}.ry')})"
    return F.expr(f"least({part}.base, array_min(transform({hit}, c -> c.zone_id)))")
