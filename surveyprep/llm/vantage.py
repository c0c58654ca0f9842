"""Approximate nearest neighbours by inner product: vantage-point trees per shard.

Inner products become distances: with M the largest norm of a stored vector,
x is lengthened by sqrt(M^2 - |x|^2) and a query q by 0, so that
|q - x|^2 = |q|^2 + M^2 - 2 q.x, and the largest inner product is the nearest
point. A top tree, fitted on a bounded sample, sends every vector to a region;
regions are cut into shards of bounded size, and each shard has a tree of its
own. A node holds a vantage point and a radius; its points lie inside or
outside. By the triangle inequality a side can hold a point nearer than t only
if the query's distance to the vantage point is within t of the radius. The
search divides t, the distance to the k-th best so far, by ``relax``: 1 keeps
the search exact, larger values visit fewer nodes. A query searches its home
region first and then, with the k-th distance found there, the regions that
the top tree doesn't rule out.

Many queries go down a tree together, as numpy arrays. Scores are summed from
the first component to the last in double precision, so equal vectors have
equal scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from surveyprep.llm.common import Scratch, sized

#: Rounding slack of a distance, as a share of the norms it is made of.
SLACK = 1e-6
#: Nodes below this depth aren't split further; only runs of equal distances reach it.
DEEPEST = 48


def pair_products(q: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Inner products of q[row] and x[col], pair by pair, summed in the order of the components."""
    out = np.zeros(len(row))
    for a in range(0, len(row), 16384):
        left, right = q[row[a:a + 16384]], x[col[a:a + 16384]]
        for j in range(q.shape[1]):
            out[a:a + 16384] += left[:, j] * right[:, j]
    return out


def spans(sq: np.ndarray, norm2: float, prod: np.ndarray) -> np.ndarray:
    """Distances of points with squared norms ``sq`` and ``norm2`` by their inner products."""
    return np.sqrt(np.maximum(sq + norm2 - 2 * prod, 0))


class Tree:
    """A vantage-point tree over the rows of ``x`` (lengthened to norm ``sqrt(norm2)``).

    ``order`` holds the rows leaf by leaf. Of node i, ``vantage`` is a row
    (-1: leaf), ``radius`` its radius, ``inside`` and ``outside`` its children,
    ``start`` and ``end`` its rows in ``order``.
    """

    FIELDS = [("order", "<i4"), ("vantage", "<i4"), ("radius", "<f8"), ("inside", "<i4"), ("outside", "<i4"), ("start", "<i4"), ("end", "<i4")]

    @classmethod
    def build(cls, x: np.ndarray, norm2: float, leaf: int, seed: int = 1) -> Tree:
        self, rng = cls(), np.random.default_rng(seed)
        extra = np.sqrt(np.maximum(norm2 - np.einsum("ij,ij->i", x, x), 0))
        nodes: list[list] = []
        self.order = np.arange(len(x), dtype=np.int32)

        def grow(start: int, end: int, depth: int) -> int:
            rows, me = self.order[start:end], len(nodes)
            nodes.append([-1, 0.0, -1, -1, start, end])
            if end - start <= leaf or depth >= DEEPEST:
                return me
            v = int(rows[rng.integers(len(rows))])
            d = spans(norm2, norm2, x[rows] @ x[v] + extra[rows] * extra[v])
            radius = float(np.partition(d, len(d) // 2)[len(d) // 2])
            if radius >= d.max():  # half of the points or more are at the largest distance
                below = d[d < d.max()]
                if not len(below):
                    return me
                radius = float(below.max())
            far = d > radius
            self.order[start:end] = np.concatenate([rows[~far], rows[far]])
            cut = end - int(far.sum())
            nodes[me][:4] = v, radius, grow(start, cut, depth + 1), grow(cut, end, depth + 1)
            return me

        grow(0, len(x), 0)
        for (name, kind), column in zip(cls.FIELDS[1:], zip(*nodes)):
            setattr(self, name, np.array(column, kind))
        return self

    def to_bytes(self) -> bytes:
        parts = [getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS]
        return np.array([len(self.order), len(self.vantage)], "<i4").tobytes() + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        self, at = cls(), 8
        rows, nodes = (int(n) for n in np.frombuffer(data, "<i4", 2))
        for name, kind in cls.FIELDS:
            n = rows if name == "order" else nodes
            setattr(self, name, np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return self

    def place(self, x: np.ndarray, points: np.ndarray, norm2: float) -> np.ndarray:
        """The leaf (its ``start``) of each row of x; ``points`` are the vantage points by their number in ``vantage``."""
        extra, far = (np.sqrt(np.maximum(norm2 - np.einsum("ij,ij->i", m, m), 0)) for m in (x, points))
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        while todo:
            node, who = todo.pop()
            v = int(self.vantage[node])
            if v < 0:
                out[who] = self.start[node]
            elif len(who):
                d = spans(norm2, norm2, x[who] @ points[v] + extra[who] * far[v])
                todo += [(int(self.inside[node]), who[d <= self.radius[node]]), (int(self.outside[node]), who[d > self.radius[node]])]
        return out

    def walk(self, q: np.ndarray, x: np.ndarray, norm2: float, reach: Callable[[np.ndarray], np.ndarray], leaf: Callable[[np.ndarray, int, int], None]) -> None:
        """``leaf(queries, start, end)`` for each leaf, with the rows of q that must see it.

        A row sees a side if it lies there, or within ``reach(rows)`` of the radius.
        """
        sq = np.einsum("ij,ij->i", q, q)

        def visit(node: int, who: np.ndarray) -> None:
            if not len(who):
                return
            v, radius = int(self.vantage[node]), self.radius[node]
            if v < 0:
                leaf(who, int(self.start[node]), int(self.end[node]))
                return
            d = spans(sq[who], norm2, q[who] @ x[v]) - radius
            slack = SLACK * (np.sqrt(sq[who]) + np.sqrt(norm2))
            visit(int(self.inside[node]), who[d <= np.maximum(reach(who), 0) + slack])
            # by now the inside may have brought the k-th best nearer
            visit(int(self.outside[node]), who[d >= -np.maximum(reach(who), 0) - slack])

        visit(0, np.arange(len(q)))


def reach_of(sq: np.ndarray, norm2: float, worst: np.ndarray, relax: float) -> np.ndarray:
    """The distance to the k-th best score, relaxed."""
    return spans(sq, norm2, worst) / relax


class Best:
    """The k best (score, id) of each query so far; ``floor`` is a k-th score known from elsewhere."""

    def __init__(self, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
        self.q, self.own, self.floor, self.k = q, own, floor, k
        self.score, self.id = np.full((len(own), k), -np.inf), np.full((len(own), k), np.iinfo(np.int64).max)

    def worst(self, who: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[who, -1], self.floor[who])

    def add(self, who: np.ndarray, x: np.ndarray, ids: np.ndarray) -> None:
        about, least = self.q[who] @ x.T, self.worst(who)
        slack = 1e-12 * np.sqrt(np.einsum("ij,ij->i", self.q[who], self.q[who]) * np.einsum("ij,ij->i", x, x).max())
        row, col = np.nonzero((about >= (least - slack)[:, None]) & (ids[None, :] != self.own[who, None]))
        if not len(row):
            return
        exact = pair_products(self.q, x, who[row], col)
        some, at = np.unique(row, return_inverse=True)
        s = np.full((len(some), len(ids)), -np.inf)
        s[at, col] = np.where(exact >= least[row], exact, -np.inf)
        who = who[some]
        s = np.concatenate([self.score[who], s], axis=1)
        i = np.concatenate([self.id[who], np.broadcast_to(ids, (len(some), len(ids)))], axis=1)
        i = np.where(s == -np.inf, np.iinfo(np.int64).max, i)
        top = np.lexsort((i, -s), axis=-1)[:, :self.k]
        self.score[who], self.id[who] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)


def search(tree: Tree, x: np.ndarray, ids: np.ndarray, q: np.ndarray, own: np.ndarray, floor: np.ndarray, norm2: float, k: int, relax: float) -> Best:
    """The k best rows of a shard for each query, none below its ``floor``.

    A first walk sees only the leaf where a query lies; the second one all
    leaves within the relaxed distance of what is then the k-th best.
    """
    best, sq = Best(q, own, floor, k), np.einsum("ij,ij->i", q, q)
    home: dict[int, np.ndarray] = {}

    def first(who: np.ndarray, start: int, end: int) -> None:
        home[start] = who
        look(who, start, end)

    def then(who: np.ndarray, start: int, end: int) -> None:
        look(np.setdiff1d(who, home.get(start, who[:0]), assume_unique=True), start, end)

    def look(who: np.ndarray, start: int, end: int) -> None:
        rows = tree.order[start:end]
        for at in range(0, len(who), 1024):
            for a in range(0, len(rows), 256):
                best.add(who[at:at + 1024], x[rows[a:a + 256]], ids[rows[a:a + 256]])

    tree.walk(q, x, norm2, lambda who: np.zeros(len(who)), first)
    tree.walk(q, x, norm2, lambda who: reach_of(sq[who], norm2, best.worst(who), relax), then)
    return best


# --- on Spark ---

def matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(-1, dim)


def usable_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, v, peak, rel): little-endian doubles, the largest magnitude, the squared norm over its square."""
    x = F.col(vec_col).cast("array<double>")
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and x is not null").where(
        ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("x", lambda c: c != 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = [np.asarray(v, "<f8") for v in batch.column(1).to_numpy(zero_copy_only=False)]
            peak = [float(np.abs(v).max()) for v in vecs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(v) for v in vecs], pa.int32()), pa.array([v.tobytes() for v in vecs], pa.binary()),
                 pa.array(peak, pa.float64()), pa.array([float(np.square(v / p).sum()) for v, p in zip(vecs, peak)], pa.float64())],
                names=["vec_id", "dim", "v", "peak", "rel"])

    return good.mapInArrow(pack, "vec_id long, dim int, v binary, peak double, rel double")


class Regions:
    """The top trees, one for each length of vectors in the sample; what they don't know is region 0."""

    def __init__(self, sample: list, norm2: float, scale: float, leaf: int):
        self.norm2, self.scale, self.trees = norm2, scale, {}
        for dim in {r.dim for r in sample}:
            x = matrix([r.v for r in sample if r.dim == dim], dim) * scale
            tree = Tree.build(x, norm2, leaf)
            inner = np.flatnonzero(tree.vantage >= 0)
            points = x[tree.vantage[inner]]
            tree.vantage[inner] = np.arange(len(inner))
            if len(inner):
                self.trees[dim] = tree, points

    def place(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            region = np.zeros(len(rows), np.int32)
            for dim in set(rows["dim"]) & set(self.trees):
                own, (tree, points) = (rows["dim"] == dim).to_numpy(), self.trees[dim]
                region[own] = tree.place(matrix(rows["v"][own], dim) * self.scale, points, self.norm2)
            yield rows.assign(region=region)[["vec_id", "dim", "v", "region"]]

    def others(self, relax: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        """Queries with each region, but their own, that the k-th score doesn't rule out."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                for dim in set(rows["dim"]) & set(self.trees):
                    some, (tree, points) = rows[rows["dim"] == dim], self.trees[dim]
                    q, home, floor = matrix(some["v"], dim) * self.scale, some["region"].to_numpy(), some["floor"].to_numpy()
                    sq, seen = np.einsum("ij,ij->i", q, q), []
                    tree.walk(q, points, self.norm2, lambda who: reach_of(sq[who], self.norm2, floor[who], relax),
                              lambda who, start, end: seen.append((who[home[who] != start], start)))
                    for who, region in seen:
                        if len(who):
                            yield some.iloc[who].assign(region=np.int32(region))[["vec_id", "dim", "v", "region", "floor"]]
        return run


KEY = ["dim", "region", "sub"]


def shard_tree(norm2: float, scale: float, leaf: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["vec_id", "v"])
        x = matrix(rows["v"], int(rows["dim"].iloc[0])) * scale
        return rows.iloc[:1][KEY].assign(tree=Tree.build(x, norm2, leaf).to_bytes(), ids=rows["vec_id"].to_numpy("<i8").tobytes(), x=x.astype("<f8").tobytes())
    return run


def shard_search(norm2: float, scale: float, k: int, relax: float) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        if not len(queries) or not len(shard):
            return out
        s, own = shard.iloc[0], queries["vec_id"].to_numpy()
        best = search(Tree.from_bytes(s["tree"]), np.frombuffer(s["x"], "<f8").reshape(-1, s["dim"]), np.frombuffer(s["ids"], "<i8"),
                      matrix(queries["v"], s["dim"]) * scale, own, queries["floor"].to_numpy(), norm2, k, relax)
        row, col = np.nonzero(best.score > -np.inf)
        return pd.DataFrame({"query_id": own[row], "vec_id": best.id[row, col], "score": best.score[row, col]})
    return run


def nearest(rows: DataFrame, is_query: str = "vec_id % 20 = 0", k: int = 20, relax: float = 5.0, id_col: str = "vec_id", vec_col: str = "embedding",
            shard_rows: int = 4096, leaf: int = 64, sample: int = 4096, query_block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products found for each query, by (score descending, vec_id).

    ``is_query`` is a condition on vec_id. All usable rows are indexed; the top
    tree alone is fitted on at most ``sample`` rows (those of smallest hash),
    which bounds the regions. A shard holds about ``shard_rows`` rows, fewer if
    vectors are long; a region of many rows, or of many equal ones, is dealt
    out to several. ``relax`` = 1 is exact. Null ids, null, empty and zero
    vectors and those with a null or non-finite component take no part;
    vectors meet only those of equal length. A row with the query's own id is
    no candidate; other repeated rows are candidates each. Of a query id's
    different vectors the smallest by length and bytes is the query. Scores
    beyond the range of double are infinite. Other columns aren't read. No
    usable row gives an empty result.
    """
    if relax < 1:
        raise ValueError("relax is 1 or more")
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "vp")
    plain = scratch.cut(usable_vectors(rows, id_col, vec_col), "plain")
    peak, n, dim = plain.agg(F.max("peak"), F.count("*"), F.max("dim")).first()
    peak, dim = peak or 1.0, dim or 1
    up = int(np.frexp(peak)[1])
    up = up if abs(up) > 300 else 0  # squares of such components leave the range of double
    scale = float(np.ldexp(1.0, -up)) if up < 1023 else float(np.ldexp(1.0, -1022))
    rel = plain.agg(F.max(F.col("rel") * F.pow(F.col("peak") / F.lit(peak), F.lit(2.0)))).first()[0] or 1.0
    norm2 = float(rel * (peak * scale) ** 2 * (1 + 1e-9))
    size = max(1, min(shard_rows, (32 << 20) // (8 * dim)))

    order = F.xxhash64("vec_id", "v")
    picked = plain.select("dim", "v", order.alias("h"), "vec_id").orderBy("h", "vec_id", "v").limit(sample).collect() if n > size else []
    regions = Regions(picked, norm2, scale, max(1, len(picked) * size // max(n, 1)))
    placed = scratch.cut(plain.select("vec_id", "dim", "v").mapInPandas(regions.place, "vec_id long, dim int, v binary, region int")
                         .withColumn("spread", F.monotonically_increasing_id()), "placed")
    scratch.drop("plain")
    subs = scratch.cut(placed.groupBy("dim", "region").agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("subs")), "subs")
    dealt = placed.join(sized(subs, 64), ["dim", "region"]).withColumn("sub", F.expr("cast(pmod(xxhash64(spread), subs) as int)"))
    trees = scratch.cut(dealt.groupBy(*KEY).applyInPandas(shard_tree(norm2, scale, leaf), "dim int, region int, sub int, tree binary, ids binary, x binary"), "trees")
    queries = scratch.cut(placed.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "v", "region")).alias("q")).select(
        "vec_id", "q.*", F.lit(float("-inf")).alias("floor")), "queries")
    scratch.drop("placed")

    def found(visits: DataFrame, name: str) -> DataFrame:
        """What the visits (queries with a region each) find in the regions' shards."""
        plan = scratch.cut(visits.groupBy("dim", "region").agg(F.ceil(F.count("*") / F.lit(query_block)).cast("int").alias("blocks")).join(subs, ["dim", "region"]), f"{name}-plan")
        small = sized(plan, 64)
        asks = visits.join(small, ["dim", "region"]).withColumn("block", F.expr("cast(pmod(xxhash64(vec_id), blocks) as int)")).withColumn(
            "sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).select(*KEY, "block", "vec_id", "v", "floor")
        shards = trees.join(small, ["dim", "region"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*KEY, "block", "tree", "ids", "x")
        hits = asks.groupBy(*KEY, "block").cogroup(shards.groupBy(*KEY, "block")).applyInPandas(
            shard_search(norm2, scale, k, relax), "query_id long, vec_id long, score double")
        return scratch.cut(hits, name)

    def best(hits: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        return hits.withColumn("rank", rank).where(F.col("rank") <= k)

    hits = found(queries, "home")
    if regions.trees:
        floors = best(hits).groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
        known = queries.drop("floor").join(floors, F.col("vec_id") == F.col("query_id"), "left").select(
            "vec_id", "dim", "v", "region", F.coalesce("kth", F.lit(float("-inf"))).alias("floor"))
        visits = scratch.cut(known.mapInPandas(regions.others(relax), "vec_id long, dim int, v binary, region int, floor double"), "visits")
        hits = hits.union(found(visits, "others"))
    scratch.drop("subs", "trees", "queries", "visits", "home-plan", "others-plan")
    return best(hits).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", (F.col("score") / F.lit(scale) / F.lit(scale)).alias("score"))
