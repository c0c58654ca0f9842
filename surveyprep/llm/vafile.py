"""Exact top-k inner products by vector-approximation files.

Vectors are whole numbers per component. A cell file keeps each component's
cell, its leading bits; cells give an upper and a lower bound of every inner
product. Queries and vectors meet in blocks: in each block the cells are
scanned, then exact vectors are read in the order of their upper bound until
the k-th score is above all bounds that are left. The blocks' k best are
merged per query. Blocks have a fixed number of queries and vectors, so
memory doesn't grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from surveyprep.llm.common import Scratch

#: Largest magnitude of a component; larger ones stop there.
LIMIT = float(1 << 62)


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, dim, v): floor(scale * x) as little-endian 64-bit numbers; unusable vectors are left out."""
    x = F.col("x").cast("array<double>")
    usable = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("x")).where(
        "vec_id is not null and x is not null").withColumn("x", x) \
        .where(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = [np.clip(np.floor(scale * np.asarray(v, float)), -LIMIT, LIMIT).astype("<i8") for v in batch.column(1).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(v) for v in vecs], pa.int32()), pa.array([v.tobytes() for v in vecs], pa.binary())],
                                             names=["vec_id", "dim", "v"])

    return usable.mapInArrow(run, "vec_id long, dim int, v binary")


def block_top_k(k: int, cell_bits: int):
    """Top k of a block's vectors for each of its queries."""
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(queries) and len(vectors):
            q, v = (np.frombuffer(b"".join(d["v"]), "<i8").reshape(len(d), -1) for d in (queries, vectors))
            ids, own = vectors["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            big = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(v.astype(float)).max(initial=0) + (1 << cell_bits)) * max(1, q.shape[1])
            kind = np.float64 if big < 2 ** 52 else object  # sums are exact: whole doubles, or Python's numbers
            low, width = ((v >> cell_bits) << cell_bits).astype(kind), (1 << cell_bits) - 1
            wide = v.astype(kind)
            for at in range(0, len(q), 64):
                part = q[at:at + 64].astype(kind)
                base = part @ low.T
                upper = base + width * np.maximum(part, 0).sum(axis=1, keepdims=True)
                lower = base + width * np.minimum(part, 0).sum(axis=1, keepdims=True)
                if kind is object:  # bounds and scores stop at the range of long before they are ranked
                    upper, lower = (np.minimum(np.maximum(x, -(1 << 63)), (1 << 63) - 1) for x in (upper, lower))
                for i in range(len(part)):
                    other = np.flatnonzero(ids != own[at + i])
                    up = upper[i, other]
                    if len(other) > k:
                        sure = np.sort(lower[i, other])[-k]
                        other, up = other[up >= sure], up[up >= sure]
                    order = np.argsort(-up, kind="stable")
                    other, up = other[order], up[order]
                    best: list[tuple] = []
                    for c in range(0, len(other), 64):
                        if len(best) >= k and best[k - 1][0] < -up[c]:
                            break
                        read = other[c:c + 64]
                        exact = (min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in wide[read] @ part[i])
                        best = sorted(best + [(-s, int(ids[j])) for s, j in zip(exact, read)])[:k]
                    out += [(int(own[at + i]), j, -s) for s, j in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return run


def top_k(rows: DataFrame, is_query: str = "vec_id % 50 = 0", k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0, cell_bits: int = 3, query_block: int = 1024, vector_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best by (score descending, vec_id), fewer if there are no more.

    ``is_query`` is a condition on vec_id. A row with the query's own id is no
    candidate; other repeated rows are candidates each. Null ids, null
    vectors and vectors with a null or non-finite component take no part;
    vectors meet only those of equal length. Components stop at 2**62 and
    scores at the range of long. Other columns are not read. No usable row
    gives an empty result.
    """
    scratch = Scratch(rows.sparkSession, "va")
    v = scratch.cut(whole_vectors(rows, id_col, vec_col, scale), "vectors")
    q = v.where(is_query).dropDuplicates(["vec_id"])
    n, nq = v.count(), q.count()
    vb, qb = max(1, -(-n // vector_block)), max(1, -(-nq // query_block))
    # each block of queries meets each block of vectors, by an equal key
    queries = q.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(qb)).cast("int")).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(vb - 1))))
    vectors = v.withColumn("vb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(vb)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1))))
    found = queries.groupBy("qb", "vb", "dim").cogroup(vectors.groupBy("qb", "vb", "dim")).applyInPandas(
        block_top_k(k, cell_bits), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP3_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 5
"""
