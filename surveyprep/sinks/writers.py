"""SNK1-4, SNK12.

Hand-off files are written by all tasks in parallel (one part file per
partition) into a fresh folder under the shared checkpoint folder; the
typed load reads them back with the *known* staged column order, which is
where a positional schema is safe, in FAILFAST mode (a malformed row
fails the load, as a bulk insert with no allowed errors would).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyprep.operators.contract import TableContract, store_assign
from surveyprep.session import shared_dir


#: What an unquoted empty cell is read as before it becomes null, so that a quoted empty one stays an empty text.
NO_CELL = "\x01null\x01"


def write_delimited(df: DataFrame, path: str, sep: str = "|", mode: str = "overwrite") -> str:
    """SNK1: header + ``sep``-delimited text; nulls as empty fields, empty texts as quoted ones."""
    (df.write.mode(mode).option("sep", sep).option("header", True)
       .option("nullValue", "").option("emptyValue", '""').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))
    return path


def read_staged(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "|", keep_empty: bool = False) -> DataFrame:
    """SNK2: typed read of our own staged file (known column order), FAILFAST.

    Blank cells load as null, as a bulk load has it; with ``keep_empty`` a
    quoted one is an empty text, so that text comes back exactly.
    """
    return (spark.read.schema(schema).option("sep", sep).option("header", True)
            .option("mode", "FAILFAST").option("nullValue", NO_CELL if keep_empty else "").option("emptyValue", "").option("escape", '"').option("multiLine", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """SNK4: append a frame to a table folder (parallel, one file per task)."""
    df.write.mode("append").format(fmt).save(path)
    return path


def stage_insert(df: DataFrame, contract: TableContract | None, target: str,
                 shapes: dict | None = None, srid: int = 2230, view: str | None = None) -> DataFrame:
    """SNK3/SNK12: stage -> transform -> insert, re-runnable.

    The frame is staged as pipe text in a fresh shared folder, read back
    typed, exposed as a temporary view, transformed with SQL (WKT shape
    columns get a constant SRID column, GEO6), conformed to the contract
    and written (overwrite: re-running replaces the target). The view and
    the staged files go afterwards, also on failure. Returns the target read back.
    """
    spark = df.sparkSession
    stage = shared_dir(spark, "stage")
    write_delimited(df, stage)
    staged = read_staged(spark, stage, df.schema, keep_empty=True)
    view = view or f"stage_{uuid.uuid4().hex}"
    staged.createOrReplaceTempView(view)
    try:
        _insert(spark, view, contract, target, shapes, srid)
    finally:
        spark.catalog.dropTempView(view)
        folder = spark._jvm.org.apache.hadoop.fs.Path(stage)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.parquet(target)


def _insert(spark: SparkSession, view: str, contract: TableContract | None, target: str, shapes: dict | None, srid: int) -> None:
    extra = ", ".join(f"{srid} AS {s}_srid" for s in (shapes or {}))
    sql = f"SELECT *{', ' + extra if extra else ''} FROM {view}"
    out = spark.sql(sql)
    if contract is not None:
        srid_cols = [F.col(c) for c in out.columns if c.endswith("_srid")]
        out = out.select(*[store_assign(F.col(f"`{c.name}`"), c).alias(c.name) for c in contract.columns],
                         *srid_cols)
    out.write.mode("overwrite").parquet(target)
