"""RSH1, FLT9, FLT10, PRJ3: reshape and fill."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyprep.functions.predicates import is_in, ne


def wide_to_long(df: DataFrame, stubs: Sequence[str], i: Sequence[str] | str, j: str,
                 suffixes: Iterable, sep: str = "_", validate: bool = False) -> DataFrame:
    """Multi-stub wide -> long (RSH1).

    ``stub{sep}{k}`` columns for every suffix ``k`` become one row per
    (``i``, ``j`` = k) carrying one column per stub. Row-local: an
    ``inline`` of an array of structs inside the scan's projection, no
    shuffle. ``validate`` first counts the rows per ``i`` and raises a
    ValueError if one repeats; without it, rows that share ``i`` are kept
    apart by nothing but their values.
    """
    ids = [i] if isinstance(i, str) else list(i)
    if validate and df.groupBy(*ids).count().where("count > 1").select(*ids).take(1):
        raise ValueError(f"the rows of {', '.join(ids)} are not unique")
    suffixes = list(suffixes)
    items = [F.struct(F.lit(k).alias(j), *[F.col(f"{s}{sep}{k}").alias(s) for s in stubs])
             for k in suffixes]
    return df.select(*[F.col(c) for c in ids], F.inline(F.array(*items)))


def drop_all_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """FLT9: drop rows whose ``subset`` columns are all null (keys excluded)."""
    return df.dropna(how="all", subset=list(subset))


def fill_missing(df: DataFrame, value: str = "Missing", subset: Sequence[str] | None = None) -> DataFrame:
    """FLT10: fill nulls of text columns with a label."""
    cols = list(subset) if subset is not None else [f.name for f in df.schema.fields
                                                    if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols}) if cols else df


def merge_alternates(first, second, unusable: Iterable[str] = ("Missing", "Not Applicable"),
                     second_missing: str = "Missing") -> Column:
    """PRJ3: prefer ``first`` unless it is unusable and ``second`` is not Missing."""
    a = F.col(first) if isinstance(first, str) else first
    b = F.col(second) if isinstance(second, str) else second
    return F.when(is_in(a, list(unusable)) & ne(b, second_missing), b).otherwise(a)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), list(frames))
