"""AGG1-3, JON5, WIN4: column profiles.

``profile_n``: for every column, non-missing count ``n``, missing count
``m`` and ``round_half_even(100 * m / (n + m), 1)``. For coded
(categorical) columns the user-missing labels count as missing.
All columns are measured in one aggregate (one pass, partial aggregation
map-side), then unpivoted.

``profile_freq``: per coded column, count of every category in codebook
order, zero counts kept (codebook left join), and the percentage over the
non-null rows (window sum per field over the already-aggregated counts).
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile_n(df: DataFrame, categorical: Iterable[str] = (), user_missing: Sequence[str] = ()) -> DataFrame:
    """(field, position, n, missing, pct_missing) for every column of ``df``."""
    cat = set(categorical)
    um = list(user_missing)
    aggs = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        miss_user = F.sum(F.when(col.isin(um), 1).otherwise(0)) if (c in cat and um) else F.lit(0)
        aggs.append(F.struct(
            (F.count(col) - miss_user).cast("bigint").alias("n"),
            (F.sum(F.when(col.isNull(), 1).otherwise(0)) + miss_user).cast("bigint").alias("missing")).alias(f"__{len(aggs)}"))
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.lit(i).alias("position"), F.col(f"__{i}")["n"].alias("n"),
                              F.col(f"__{i}")["missing"].alias("missing")) for i, c in enumerate(df.columns)])
    long = wide.select(F.inline(rows))
    pct = F.bround(F.try_divide(F.lit(100.0) * F.col("missing"), (F.col("n") + F.col("missing")).cast("double")), 1)
    return long.withColumn("pct_missing", pct)


def category_frame(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """(field, label, ordinal) rows of the category domains (small, driver-defined)."""
    rows = [(f, lab, i) for f, labs in categories.items() for i, lab in enumerate(labs)]
    schema = T.StructType([T.StructField("field", T.StringType(), False),
                           T.StructField("label", T.StringType(), True),
                           T.StructField("ordinal", T.IntegerType(), False)])
    return df.sparkSession.createDataFrame(rows, schema)


def profile_freq(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """(field, label, ordinal, count, pct) for every category of every coded column.

    ``categories`` gives each column's category order (codebook labels,
    then added labels such as Missing / Not Applicable). Values outside the
    domain are not reported (as in a categorical reindex).
    """
    fields = [f for f in categories if f in df.columns]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("label"))
                                         for f in fields])).alias("__r")).select("__r.*")
    counts = long.where(F.col("label").isNotNull()).groupBy("field", "label").agg(F.count(F.lit(1)).alias("count"))
    dom = category_frame(df, {f: categories[f] for f in fields})
    # the domain is driver data of a known, small size: broadcast it
    joined = F.broadcast(dom).join(counts, ["field", "label"], "left") \
        .withColumn("count", F.coalesce(F.col("count"), F.lit(0)).cast("bigint"))
    # denominator: all non-null rows of the field, in or out of the domain
    nonnull = counts.groupBy("field").agg(F.sum("count").alias("__nn"))
    out = joined.join(F.broadcast(nonnull), "field", "left")
    pct = F.bround(F.try_divide(F.lit(100.0) * F.col("count"), F.col("__nn").cast("double")), 1)
    return out.select("field", "label", "ordinal", "count", F.coalesce(pct, F.lit(None).cast("double")).alias("pct"))
