"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order that is a pure
function of (seed, doc_id); after the first pass over the source a second
one follows. A document's virtual finish time is the cumulative number of
the source's words up to its end, divided by the source's target. Served in
order of virtual time over all sources, the mix holds every source in
proportion to its target at any moment; it is truncated where the total
budget is spent, which is virtual time 1 as the targets sum to the budget.
The document being served at that moment is taken in part.

Running sums are formed in two steps, so that no task holds a source: sums
per (source, leading digits of the shuffle key), a running sum over these
few rows, then a running sum inside each such slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from surveyprep.llm.common import WORD, Scratch, sized

#: Leading hex digits of the shuffle key that name a slice: 4,096 slices a source.
SLICE_DIGITS = 3


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, repeats: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code-point order, null last, take the weights in turn. The
    targets share ``share`` times all sizes by weight; a target stops at
    ``repeats`` times its source's size and what is over is shared again by
    weight. In ascending order of limit / weight, once a source isn't full
    none after it is, so the common level follows from running sums.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", repeats * F.col("source_size"))
    fill = W.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    all_ = W.partitionBy()
    level = (share * F.sum("source_size").over(all_) - (F.sum("cap").over(fill) - F.col("cap"))) / (
        F.sum("w").over(all_) - F.sum("w").over(fill) + F.col("w"))
    s = s.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") <= F.col("cap"))
    # the level of the first source that isn't full holds for all after it
    first = F.min(F.when(F.col("open"), F.struct((F.col("cap") / F.col("w")).alias("r"), F.col("source").isNull().alias("z"), "source", "level"))).over(all_)
    s = s.withColumn("final", first["level"])
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("final") * F.col("w"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix-1",
        carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, virtual_finish[, carried columns].

    size counts words (null text: 0); taken counts the words that the mix
    takes, repeats included, at most ``repeats`` times the size. Documents of
    no word are taken 0 times. A null source is a source of its own. Equal
    rows are separate documents; ties of the shuffle order go by size. An
    empty table gives an empty result. Columns of ``docs`` other than the
    named ones are not read, so their names can't clash.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                    key.alias("shuffle_key"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    d = scratch.cut(d.withColumn("slice", F.substring("shuffle_key", 1, SLICE_DIGITS)), "sizes")

    slices = d.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    goal = targets(slices.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, repeats)
    starts = slices.withColumn("start", F.sum("n").over(W.partitionBy("source").orderBy("slice")) - F.col("n"))
    starts = starts.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))) \
        .select(F.col("source").alias("s"), F.col("slice").alias("sl"), "start", "source_size", "target")
    starts = scratch.cut(starts, "starts")

    d = d.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("sl"))).drop("s", "sl")
    run = W.partitionBy("source", "slice").orderBy("shuffle_key", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    d = d.withColumn("finish", F.col("start") + F.sum("size").over(run)).withColumn("begin", F.col("finish") - F.col("size"))
    quota = F.floor("target")
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), quota - F.col("begin") - i * F.col("source_size"))) for i in range(repeats)), F.lit(0))
    return d.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
                    F.try_divide(F.col("finish").cast("double"), F.col("target")).alias("virtual_finish"), *[f"carry_{c}" for c in carry])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix's rows with the columns of ``docs``: a document occurs as often as the mix takes it whole.

    A document that the truncation cuts is kept whole if at least half of it
    is taken. Rows that repeat an id and a text share their copies evenly.
    The result is range-sorted by virtual finish time; what is planned are
    narrow rows, and only the mix itself is sorted with its texts.
    """
    scratch = Scratch(docs.sparkSession, "mix-rows")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_text"))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("th"))
    m = mix(narrow, id_col="id", carry=("th",), **options)
    copies = F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size")))
    plan = m.where("taken > 0").groupBy(F.col("doc_id").alias("plan_id"), F.col("carry_th").alias("plan_text")).agg(
        F.round(F.avg(copies)).cast("int").alias("copies"), F.min("virtual_finish").alias("finish"),
        F.min(F.col("source_size") / F.col("target")).alias("turn")).where("copies > 0")
    plan = scratch.cut(plan, "plan")
    out = rows.join(sized(plan, 56), F.col("own_id").eqNullSafe(F.col("plan_id")) & (F.col("own_text") == F.col("plan_text")))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return out.orderBy(F.col("finish") + F.col("copy") * F.col("turn"), "own_id").select("row.*")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w,
             2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / w AS r,
             (1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER f - cap)) / (sum(w) OVER () - sum(w) OVER f + w) AS level
      FROM w WINDOW f AS (ORDER BY cap / w ASC, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o AS (SELECT level AS final FROM l WHERE level * w <= cap ORDER BY r, source ASC NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT final FROM o) * w, cap)) AS target FROM l),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS quota,
             (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS b
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, quota - b)) + greatest(0, least(size, quota - b - source_size)))::BIGINT AS taken
FROM q
"""
