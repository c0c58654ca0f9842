"""Ledgers of a load: codes that the codebook doesn't list, labels too wide for their column."""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyprep.operators.codebook import Codebook, sql_literal
from surveyprep.operators.contract import TableContract

#: Counters that a summary keeps per field; a code's count is under-estimated by 3.5 / TRACKED of the field's unlisted cells at most.
TRACKED = 10000


def unlisted_codes(df: DataFrame, codebook: Codebook, share: float = 0.01) -> DataFrame:
    """MAP1: (field, code, n, unlisted) of the codes outside the codebook that make up ``share`` or more of a field's unlisted cells.

    One scan keeps, for every coded field, the number of unlisted cells and a
    summary of their frequent values (counters that are lowered together when
    they run out, and merge across tasks), so its memory doesn't follow the
    number of different values. Every code of that share is among the 1 / (share - error)
    largest counters. A second scan counts these candidates exactly, and the
    count decides. Nulls are not codes. ``code`` is text.
    """
    fields = [f for f in codebook if f in df.columns]
    if not fields:
        return df.sparkSession.createDataFrame([], "field string, code string, n bigint, unlisted bigint")
    if not 2 * 3.5 / TRACKED <= share <= 1:
        raise ValueError(f"share lies between {2 * 3.5 / TRACKED} and 1")
    k = math.ceil(1 / (share - 3.5 / TRACKED))
    cells = []
    for f in fields:
        kind = codebook[f].key_type
        col = f"`{f}`"
        listed = ", ".join(f"CAST({sql_literal(c)} AS {kind})" for c, _ in codebook[f].codes)
        code = col if kind == "string" else f"CASE WHEN TRY_CAST({col} AS int) = {col} THEN TRY_CAST({col} AS int) END"
        known = f"coalesce({code} IN ({listed}), false)" if listed else "false"
        cells.append(f"CASE WHEN {col} IS NOT NULL AND NOT {known} THEN CAST({col} AS string) END")
    marked = df.selectExpr(*[f"{c} AS c{i}" for i, c in enumerate(cells)])
    summary = marked.selectExpr(*[f"count(c{i}) AS n{i}" for i in range(len(fields))],
                                *[f"approx_top_k(c{i}, {k}, {TRACKED}) AS top{i}" for i in range(len(fields))])
    found = summary.selectExpr("inline(array(" + ", ".join(
        f"struct({i} AS no, n{i} AS unlisted, transform(top{i}, t -> t.item) AS codes)" for i in range(len(fields))) + "))")
    # k codes per field at most
    candidates = found.select("no", "unlisted", F.explode("codes").alias("code")).where("code is not null")
    cells = marked.selectExpr("inline(filter(array(" + ", ".join(f"struct({i} AS no, c{i} AS code)" for i in range(len(fields))) + "), x -> x.code IS NOT NULL))")
    counted = cells.join(F.broadcast(candidates), ["no", "code"]).groupBy("no", "code", "unlisted").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(f) for f in fields])
    return counted.where(F.col("n") >= F.col("unlisted") * F.lit(float(share))).select(names[F.col("no")].alias("field"), "code", "n", "unlisted")


def width_offenders(df: DataFrame, contract: TableContract, k: int = 5) -> DataFrame:
    """SNK10: (field, limit, rank, length, label, n): each column's ``k`` longest different texts wider than it, with their counts.

    One pass over all columns: only the cells that are too wide leave a row,
    equal ones are counted where they are found, and the k longest per column
    are kept by each task before they meet. Ties go by text.
    """
    wide = [c for c in contract.columns if c.width is not None and c.name in df.columns]
    if not wide:
        return df.sparkSession.createDataFrame([], "field string, `limit` int, rank int, length int, label string, n bigint")
    cells = ", ".join(f"struct('{c.name}' AS field, {c.width} AS `limit`, CAST(`{c.name}` AS string) AS label)" for c in wide)
    rows = df.selectExpr(f"inline(filter(array({cells}), x -> length(x.label) > x.`limit`))")
    counted = rows.groupBy("field", "limit", "label").agg(F.count("*").alias("n")).withColumn("length", F.length("label"))
    w = Window.partitionBy("field").orderBy(F.col("length").desc(), "label")
    return counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("field", "limit", "rank", "length", "label", "n")



#: Largest key filter, in bytes, that is sent to every executor.
FILTER_BYTES = 64 << 20
#: Bits of a filter page; what one row of the filter holds.
PAGE_BITS = 32768


def orphans(child: DataFrame, keys: list[str], parent: DataFrame, parent_keys: list[str], bits_per_key: int = 16) -> DataFrame:
    """SNK5 / JON6: the rows of ``child`` whose key no row of ``parent`` has; rows with a null key part are none.

    A Bloom filter of the parent's keys, made by one bitmap aggregate, tells
    most orphans without a shuffle of the child: a key whose bits aren't set
    is in no parent row. Keys whose bits are set may still be orphans; of
    these, the different ones alone go through the exact anti-join. The filter
    has ``bits_per_key`` bits a parent row and is broadcast below FILTER_BYTES,
    else left to the planner.
    """
    n = parent.count()
    pages = max(1, -(-n * bits_per_key // PAGE_BITS))

    def bit(columns: list[str], seed: int):
        return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(pages * PAGE_BITS)).cast("long")

    whole = [F.col(k).isNotNull() for k in parent_keys]
    own = parent.where(functools.reduce(operator.and_, whole)).select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(parent_keys)])
    names = [f"__{i}" for i in range(len(keys))]
    bits = own.select(F.explode(F.array(bit(names, 1), bit(names, 2))).alias("b"))
    filter_pages = bits.groupBy(F.floor(F.col("b") / PAGE_BITS).alias("page")).agg(F.bitmap_construct_agg(F.col("b") % PAGE_BITS).alias("map"))
    small = pages * PAGE_BITS // 8 <= FILTER_BYTES
    out = child.where(functools.reduce(operator.and_, [F.col(k).isNotNull() for k in keys]))
    for seed in (1, 2):
        side = filter_pages.select(F.col("page").alias(f"__page{seed}"), F.col("map").alias(f"__map{seed}"))
        at = bit(keys, seed)
        out = out.withColumn(f"__bit{seed}", at % PAGE_BITS).withColumn(f"__page{seed}", F.floor(at / PAGE_BITS))
        out = out.join(F.broadcast(side) if small else side, f"__page{seed}", "left")
    # bit b of a page is bit b % 8 of its byte b / 8
    isset = [F.expr(f"coalesce(conv(hex(substring(__map{s}, cast(__bit{s} div 8 as int) + 1, 1)), 16, 10) & shiftleft(1, cast(__bit{s} % 8 as int)), 0) <> 0") for s in (1, 2)]
    out = out.withColumn("__maybe", functools.reduce(operator.and_, isset))
    sure = out.where(~F.col("__maybe")).select(*child.columns)
    maybe = out.where("__maybe").select(*child.columns)
    same = functools.reduce(operator.and_, [F.col(k) == F.col(n) for k, n in zip(keys, names)])
    false = maybe.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct().join(own.select(*[F.col(n).alias(f"{n}p") for n in names]), functools.reduce(
        operator.and_, [F.col(n) == F.col(f"{n}p") for n in names]), "left_anti")
    return sure.union(maybe.join(false, same, "left_semi"))
