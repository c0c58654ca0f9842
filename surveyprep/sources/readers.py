"""SRC1-4 and SET1.

Raw survey files are read as text and bound *by header name*; a user
schema on CSV binds by position, and the raw files' column order is not
known. Types are applied afterwards with ``try_cast`` so a stray token
becomes null instead of failing a 100 TB job on one bad cell.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The default missing-value tokens of the pandas CSV reader,
# which the survey files were written for. Matched exactly (no trimming).
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                    "n/a", "nan", "null")

# Read types named in the survey readers -> Spark SQL types. Nullable small
# ints are widened to int: several code maps list -9998 / -9999 for fields
# declared Int8, which would not fit a byte.
READ_TYPES = {
    "Int8": "int", "Int16": "int", "Int32": "int", "Int64": "bigint",
    "int": "int", "bigint": "bigint", "double": "double", "float": "double",
    "string": "string", "date": "date", "timestamp": "timestamp_ntz",
    "timestamp_ntz": "timestamp_ntz", "short": "int", "byte": "int",
}


def read_text_csv(spark: SparkSession, paths, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """All-text read of header CSV file(s); ``paths`` may be a list (SRC3).

    A quote inside a quoted cell is doubled. ``multi_line`` reads newlines
    inside quoted cells; a file is then read by one task.
    """
    return (spark.read.option("header", True).option("sep", sep)
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("inferSchema", False).option("nullValue", None)
            .option("emptyValue", "").csv(paths))


def typed_select(df: DataFrame, columns: Iterable[str], types: Mapping[str, str] | None = None,
                 na_tokens: Iterable[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """Select ``columns`` by name from a text frame and type them.

    ``types`` maps a column to a read type (``Int8``, ``double``, ...);
    unlisted columns stay text. A cell equal to one of ``na_tokens``
    becomes null before the cast.
    """
    types = dict(types or {})
    tokens = list(na_tokens)
    exprs = []
    for name in columns:
        t = READ_TYPES.get(types.get(name, "string"), types.get(name, "string"))
        c = F.col(f"`{name}`")
        txt = F.when(c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
        exprs.append(typed_cell(txt, t).alias(name))
    return df.select(*exprs)


def typed_cell(txt, t: str):
    """A text cell as ``t``, null if it can't be read; whole numbers may be written with a fraction of zeros."""
    if t == "string":
        return txt
    if t not in ("int", "bigint"):
        return F.trim(txt).try_cast(t)
    number = F.trim(txt).try_cast("decimal(38,10)")
    return F.coalesce(F.trim(txt).try_cast(t), F.when(number == F.floor(number), number.cast("string").try_cast("decimal(38,0)").try_cast(t)))


def rejected_cells(df: DataFrame, columns: Iterable[str], types: Mapping[str, str] | None = None,
                   na_tokens: Iterable[str] = PANDAS_NA_TOKENS) -> DataFrame:
    """(field, rejected): cells per typed column that hold text but no value of the type, in one pass."""
    types, tokens = dict(types or {}), list(na_tokens)
    counts = []
    for name in columns:
        t = READ_TYPES.get(types.get(name, "string"), types.get(name, "string"))
        c = F.col(f"`{name}`")
        bad = c.isNotNull() & ~c.isin(tokens) & typed_cell(c, t).isNull()
        counts.append(F.struct(F.lit(name).alias("field"), F.count_if(bad).alias("rejected")))
    return df.agg(F.array(*counts).alias("a")).select(F.inline("a"))


def read_typed_csv(spark: SparkSession, paths, columns: Iterable[str],
                   types: Mapping[str, str] | None = None, sep: str = ",",
                   na_tokens: Iterable[str] = PANDAS_NA_TOKENS, multi_line: bool = False) -> DataFrame:
    """SRC1/SRC2: column-pruned, typed read bound by header name."""
    return typed_select(read_text_csv(spark, paths, sep, multi_line), columns, types, na_tokens)


def add_defaults(df: DataFrame, constants: Mapping[str, object] | None = None,
                 copies: Mapping[str, str] | None = None) -> DataFrame:
    """SRC4: inject constant columns and copies for a source lacking fields."""
    cols = {k: F.lit(v) for k, v in (constants or {}).items()}
    cols.update({k: F.col(v) for k, v in (copies or {}).items()})
    return df.withColumns(cols) if cols else df


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """SET1: UNION ALL by name; columns missing from a source become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames))
