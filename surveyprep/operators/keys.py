"""WIN1-3, SNK5: surrogate keys.

Two forms of each numbering:

* ``method="window"`` — ``row_number`` / ``dense_rank`` over an
  unpartitioned window. Simple and the oracle form, but Spark moves every
  row into one task: fine for small tables, wrong at scale.
* ``method="ranged"`` (default) — range-partition on the order keys,
  sort within partitions, write the ranged frame to the shared checkpoint
  folder (range bounds come from sampling, so the layout must not be
  recomputed differently after an executor loss), count rows per
  partition, turn the counts (one row per partition: bounded by the
  partition count) into offsets, and number rows locally. No task ever
  holds more than its own range partition.

Dense rank = each range numbers the keys it meets as its sorted rows stream
past, and ranges that share a key at their border are stitched by a scan over
one row per range. A row whose key has a null part gets 0 (pandas
``ngroup() + 1`` of a null group). Comparing a row with the one before it in
its partition is what built-in functions can't do without another exchange, so
that step takes Arrow batches.

Load order = the place of a row in its file and of the file among the sources.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyprep.session import ensure_checkpoint_dir


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ranged_row_number(df: DataFrame, order: Sequence[str], name: str, start: int = 0,
                      num_partitions: int | None = None) -> DataFrame:
    """Global 0/1-based row number in ``order`` without a single-task window.

    Ties of ``order`` are broken by the remaining columns (those of a type
    that can be ordered), so only fully equal rows are interchangeable.
    """
    order = _cols(order)
    order = order + [f.name for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _num_partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in order])
                .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]))
    # reliable checkpoint: fixes the sampled range layout for recomputation
    ranged = ranged.withColumn("__pid", F.spark_partition_id()) \
                   .withColumn("__local", F.monotonically_increasing_id()).checkpoint(eager=True)
    # local index = monotonically_increasing_id minus the partition's base (pid << 33)
    ranged = ranged.withColumn("__local", F.col("__local") - F.shiftleft(F.col("__pid").cast("bigint"), 33))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: broadcast is bounded by the partition count
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    out = ranged.join(F.broadcast(offsets), "__pid")
    return out.withColumn(name, (F.col("__off") + F.col("__local") + F.lit(start)).cast("bigint")) \
              .drop("__pid", "__local", "__off")


def row_key(df: DataFrame, order: Sequence[str] | str, name: str, start: int = 0,
            method: str = "ranged", num_partitions: int | None = None) -> DataFrame:
    """WIN2/WIN3: row number in a defined order (``start`` = 0 or 1)."""
    order = _cols(order)
    if method == "window":
        w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
        return df.withColumn(name, (F.row_number().over(w) - 1 + start).cast("bigint"))
    return ranged_row_number(df, order, name, start, num_partitions)


def dense_key(df: DataFrame, keys: Sequence[str] | str, name: str, method: str = "ranged",
              num_partitions: int | None = None, null_key: int = 0) -> DataFrame:
    """WIN1: 1-based dense group number over the sorted composite key.

    Rows with any null key part get ``null_key`` (0); they are not ranked.
    """
    keys = _cols(keys)
    if method != "window":
        return carried_dense_key(df, keys, name, num_partitions, null_key)
    anynull = _any_null(keys)
    w = Window.partitionBy(anynull).orderBy(*keys)
    return df.withColumn(name, F.when(anynull, F.lit(null_key).cast("bigint")).otherwise(F.dense_rank().over(w).cast("bigint")))


def _any_null(keys: Sequence[str]) -> Column:
    return functools.reduce(operator.or_, (F.col(k).isNull() for k in keys))


def _number_keys(n_keys: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Dense numbers of one sorted range, from its rows in order: 0 with a null key part, else from 1.

    The last ``n_keys`` columns are the keys; ``width`` columns go on, with the range's
    number (the column before the keys) among them, and the dense number is added.
    """
    def differs(column: pa.Array, last) -> np.ndarray:
        if not len(column):
            return np.zeros(0, bool)
        inner = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).fill_null(True).to_numpy(zero_copy_only=False)
        return np.concatenate([[last is None or not last.equals(column[0])], inner])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = 0, [None] * n_keys
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.columns[-n_keys:]
            known = np.logical_and.reduce([np.asarray(c.is_valid()) for c in keys])
            rows = np.flatnonzero(known)
            out = np.zeros(batch.num_rows, np.int64)
            if len(rows):
                keys = [c.take(pa.array(rows)) for c in keys]
                out[rows] = number + np.cumsum(np.logical_or.reduce([differs(c, v) for c, v in zip(keys, last)]))
                number, last = int(out[rows[-1]]), [c[len(c) - 1] for c in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(out)], names=[*batch.schema.names[:width], "__dense"])
    return run


def carried_dense_key(df: DataFrame, keys: Sequence[str], name: str, num_partitions: int | None = None, null_key: int = 0) -> DataFrame:
    """Dense group numbers with one range exchange: no distinct copy of the keys, no join back.

    Rows are ranged by (keys, a hash of the row), so the rows of a frequent
    key spread over several ranges. Each range numbers the keys it meets, in
    order, as the rows stream past. What crosses to one task is one row per
    range: how many keys it met, its first and its last one. A running sum of
    the counts, less one for each range that begins with the key the range
    before it ended with, is what a range adds to its own numbers.
    """
    keys, fields = _cols(keys), df.columns
    ensure_checkpoint_dir(df.sparkSession)
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("__tie")]
    ranged = df.withColumn("__tie", F.xxhash64(*hashable)).repartitionByRange(_num_partitions(df, num_partitions), *order).sortWithinPartitions(*order)
    # a range's first and last keys are read again from the key copies, so they come last
    # (floats as text of one zero and one NaN, as grouping sees them)
    copies = [(F.col(k) + F.lit(0.0)).cast("string") if isinstance(df.schema[k].dataType, (T.FloatType, T.DoubleType)) else F.col(k) for k in keys]
    ranged = ranged.select(*fields, F.spark_partition_id().alias("__range"), *[c.alias(f"__k{i}") for i, c in enumerate(copies)])
    schema = T.StructType([*df.schema.fields, T.StructField("__range", T.IntegerType()), T.StructField("__dense", T.LongType())])
    # written once: the sampled ranges must not be drawn anew after the loss of an executor
    numbered = ranged.mapInArrow(_number_keys(len(keys), len(fields) + 1), schema).checkpoint()
    met = numbered.where(F.col("__dense") > 0).groupBy("__range").agg(
        F.max("__dense").alias("n"), F.min(F.struct(*keys)).alias("head"), F.max(F.struct(*keys)).alias("tail"))
    w = Window.orderBy("__range")
    shared = F.coalesce((F.lag("tail").over(w) == F.col("head")).cast("long"), F.lit(0))
    before = met.select("__range", "n", shared.alias("shared")).select(
        "__range", (F.sum("n").over(w) - F.col("n") - F.sum("shared").over(w)).alias("__before"))
    out = numbered.join(F.broadcast(before), "__range", "left")  # a row for each range
    return out.select(*fields, F.when(F.col("__dense") > 0, F.col("__dense") + F.col("__before")).otherwise(F.lit(null_key)).cast("bigint").alias(name))


PLACE = ["__source", "__file", "__block", "__place"]


def with_place(source: DataFrame, number: int) -> DataFrame:
    """A frame straight from a file read with where its rows come from: source, file, block start, place.

    Places count up in a block; Parquet files know a row's place in the file.
    """
    known = source.select("_metadata").schema["_metadata"].dataType.names
    block, at = ("0L", F.col("_metadata.row_index")) if "row_index" in known else ("_metadata.file_block_start", F.monotonically_increasing_id())
    return source.select("*", F.lit(number).alias("__source"), F.col("_metadata.file_path").alias("__file"), F.expr(block).alias("__block"), at.alias("__place"))


def number_places(rows: DataFrame, name: str, per_file: bool = False, start: int = 0) -> DataFrame:
    """``rows``, a written frame with places, numbered in load order (or within each file): a prefix sum over the counts per block."""
    block = PLACE[:3]
    counts = rows.groupBy(*block).agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
    w = (Window.partitionBy(*block[:2]) if per_file else Window).orderBy(*block)
    before = counts.select(*block, "__first", (F.sum("__n").over(w) - F.col("__n")).alias("__before"))  # a row for each block
    return rows.join(before, block).withColumn(name, (F.col("__before") + F.col("__place") - F.col("__first") + start).cast("bigint")).drop("__first", "__before")


def load_order_key(sources: Sequence[DataFrame], name: str, start: int = 0) -> DataFrame:
    """WIN3: the rows of ``sources`` (frames straight from a file read), numbered in load order.

    The order is that of the sources, then of the files by path, then of the
    rows in a file: no sort and no sampling. The file, the start of the block
    a row was read from and the row's place in its block come from the read
    itself; the counts per block, summed up in order, are all that crosses to
    one task. Sources are put together by column name; a column that one lacks
    is null there.
    """
    ensure_checkpoint_dir(sources[0].sparkSession)
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [with_place(s, i) for i, s in enumerate(sources)])
    # written once, so that places and counts come from the same read
    return number_places(rows.checkpoint(), name, start=start).drop(*PLACE)


def add_sentinel(df: DataFrame, values: dict) -> DataFrame:
    """SNK5: append one row for non-matching keys (other columns null)."""
    spark = df.sparkSession
    row = spark.range(1).select(*[
        (F.lit(values[f.name]) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in df.schema.fields])
    return df.unionByName(row)


def natural_key(df: DataFrame, order: Sequence[str] | str, name: str, start: int = 0,
                num_partitions: int | None = None) -> DataFrame:
    """WIN3: number the rows of a frame in natural-key order.

    Every row gets a number of its own; rows that share a natural key follow
    each other, ordered by their other columns. One pass: the frame is ranged
    and numbered as it is, not joined back.
    """
    return ranged_row_number(df, order, name, start, num_partitions)
