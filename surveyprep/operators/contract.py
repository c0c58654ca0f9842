"""SNK6-11: target contracts, store-assignment casts and data-quality checks.

A ``TableContract`` carries the target table's columns (declared type,
text width, nullability), primary key and further unique keys. Checks
*report*; they never truncate or drop rows (labels wider than their
column exist in the codebook itself).

* ``dq_columns``: not-null and width violations of *all* columns in one
  aggregate (one pass, partial aggregation).
* ``dq_key``: duplicate and null key values; one ``groupBy`` per key,
  pre-aggregated map-side, so a hot key costs one row per partition.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA_DIR = Path(__file__).resolve().parent.parent / "data"

# declared SQL type -> Spark type used on load
SQL_TO_SPARK = {
    "int": "int", "integer": "int", "bigint": "bigint", "tinyint": "smallint", "smallint": "smallint",
    "float": "double", "real": "float", "nvarchar": "string", "varchar": "string",
    "date": "date", "smalldatetime": "timestamp_ntz", "datetime": "timestamp_ntz",
    "geometry": "string",
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    sql_type: str
    width: int | None
    nullable: bool

    @property
    def spark_type(self) -> str:
        return SQL_TO_SPARK[self.sql_type]


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple
    primary_key: tuple
    unique: tuple = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.spark_type), c.nullable)
                             for c in self.columns])


def load_contracts() -> dict:
    with open(DATA_DIR / "contracts.json", encoding="utf-8") as fh:
        raw = json.load(fh)
    out = {}
    for name, t in raw.items():
        if name.startswith("_"):
            continue
        cols = tuple(ColumnSpec(c[0], c[1], c[2], c[3]) for c in t["columns"])
        out[name] = TableContract(name, cols, tuple(t["primary_key"] or ()), tuple(tuple(u) for u in t["unique"]))
    return out


def contract_for(name: str) -> TableContract:
    return load_contracts()[name]


def round_minute(c) -> Column:
    """smalldatetime store assignment: round to the nearest minute (30 s up)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("minute", col.cast("timestamp_ntz") + F.expr("INTERVAL 30 SECONDS")).cast("timestamp_ntz")


def store_assign(c, spec: ColumnSpec) -> Column:
    """SNK6: value conversion as the target column's type would store it."""
    col = F.col(c) if isinstance(c, str) else c
    if spec.sql_type == "smalldatetime":
        return round_minute(col)
    if spec.sql_type == "date":
        return F.to_date(col)
    if spec.sql_type in ("int", "integer", "bigint", "tinyint", "smallint"):
        # fractions are dropped (truncation toward zero) in the source's own type; text goes through decimal
        kind = F.typeof(col)
        text = F.regexp_replace(col.cast("string").try_cast("decimal(38,10)").cast("string"), r"\..*$", "")
        whole = F.when(kind == "string", text.cast(spec.spark_type)).otherwise(col.cast(spec.spark_type))
        if spec.sql_type != "tinyint":
            return whole
        # the target's tinyint is 0..255; its server refuses other values, and so does the load
        refused = F.raise_error(F.concat(F.lit("tinyint out of range: "), whole.cast("string"))).cast(spec.spark_type)
        return F.when(whole.isNull() | whole.between(0, 255), whole).otherwise(refused)
    return col.cast(spec.spark_type)


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Project ``df`` onto the contract's columns and types (one projection)."""
    return df.select(*[store_assign(F.col(f"`{c.name}`"), c).alias(c.name) for c in contract.columns])


def dq_columns(df: DataFrame, contract: TableContract) -> DataFrame:
    """(field, check, limit, violations, max_length) for NOT NULL and width checks, one pass."""
    checks = []
    for c in contract.columns:
        if c.name not in df.columns:
            continue
        col = F.col(f"`{c.name}`")
        if not c.nullable:
            checks.append((c.name, "not_null", None, F.sum(F.when(col.isNull(), 1).otherwise(0)), F.lit(None).cast("int")))
        if c.width is not None:
            ln = F.length(col.cast("string"))
            checks.append((c.name, "width", c.width, F.sum(F.when(ln > c.width, 1).otherwise(0)), F.max(ln)))
    if not checks:
        return df.sparkSession.createDataFrame([], "field string, check string, limit int, violations bigint, max_length int")
    wide = df.agg(*[F.struct(v.cast("bigint").alias("v"), m.cast("int").alias("m")).alias(f"__{i}")
                    for i, (_, _, _, v, m) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(k).alias("check"), F.lit(lim).cast("int").alias("limit"),
                              F.col(f"__{i}")["v"].alias("violations"), F.col(f"__{i}")["m"].alias("max_length"))
                     for i, (n, k, lim, _, _) in enumerate(checks)])
    return wide.select(F.inline(rows))


def dq_key(df: DataFrame, keys: Sequence[str], check: str = "unique") -> DataFrame:
    """Key values that repeat or hold a null part: (key..., rows, check)."""
    keys = list(keys)
    anynull = None
    for k in keys:
        anynull = F.col(k).isNull() if anynull is None else (anynull | F.col(k).isNull())
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return g.where((F.col("rows") > 1) | anynull).withColumn("check", F.lit(check))


def dq_summary(df: DataFrame, contract: TableContract) -> list[DataFrame]:
    """All checks of a contract as a list of report frames."""
    out = [dq_columns(df, contract)]
    if contract.primary_key:
        out.append(dq_key(df, contract.primary_key, "primary_key"))
    for u in contract.unique:
        out.append(dq_key(df, u, "unique"))
    return out
