"""SNK2-4, SNK11-12: loads with a bound on errors, published by a manifest; appends that can be run again.

A load writes its rows to a folder of its own under the target and counts, in
the same pass, the rows that the target's contract refuses (a null in a NOT
NULL column, a text wider than its column, a value that the column's type
can't hold). If these are more than allowed, the folder goes and the target
stays as it was. Otherwise a manifest entry, one small file that appears whole
or not at all, makes the folder part of the table. Refused rows are kept
beside the table with the reasons.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveyprep.operators.contract import TableContract, store_assign


class LoadRefused(RuntimeError):
    """More rows in error than the load allows."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def reasons(df: DataFrame, contract: TableContract):
    """array<string>: why the contract refuses a row, by column; empty if it doesn't."""
    found = []
    for c in contract.columns:
        col = F.col(f"`{c.name}`")
        if c.sql_type in ("int", "integer", "bigint", "tinyint", "smallint"):
            number = col.cast("string").try_cast("decimal(38,10)")
            low, high = {"tinyint": (0, 255), "smallint": (-(1 << 15), (1 << 15) - 1), "bigint": (-(1 << 63), (1 << 63) - 1)}.get(c.sql_type, (-(1 << 31), (1 << 31) - 1))
            whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
            holds = F.coalesce(whole.between(low, high), F.lit(False))
        elif c.width is not None:
            holds = F.length(col.cast("string")) <= c.width
        else:
            holds = F.lit(True)
        found.append(F.when(col.isNotNull() & ~holds, f"{c.name}: does not fit"))
        if not c.nullable:
            found.append(F.when(col.isNull(), f"{c.name}: null"))
    return F.array_compact(F.array(*found))


def load_table(df: DataFrame, contract: TableContract, target: str, allowed_errors: int = 0, batch: str | None = None) -> dict:
    """Load ``df`` into the table folder ``target``; returns {"batch", "rows", "errors"}.

    With more than ``allowed_errors`` refused rows a LoadRefused is raised and
    the target holds what it held. A batch that is published already isn't
    loaded again: its entry is returned.
    """
    spark, batch = df.sparkSession, batch or uuid.uuid4().hex
    done = {e["batch"]: e for e in manifest(spark, target)}
    if batch in done:
        return done[batch]
    staged, seen = f"{target}/_staged/{batch}-{uuid.uuid4().hex[:8]}", Observation()
    marked = df.select(*[F.col(f"`{c}`") for c in contract.names]).withColumn("__why", reasons(df, contract))
    fine = F.size("__why") == 0
    out = marked.select(
        *[F.when(fine, store_assign(F.col(f"`{c.name}`"), c)).alias(c.name) for c in contract.columns],
        F.when(~fine, F.to_json(F.struct(*[F.col(f"`{c}`") for c in contract.names]))).alias("__refused"), F.col("__why"),
        F.when(fine, "rows").otherwise("refused").alias("__part"))
    try:
        counted = out.observe(seen, F.count("*").alias("rows"), F.count_if(F.col("__part") == "refused").alias("errors"))
        counted.write.partitionBy("__part").parquet(staged)
        n = seen.get
        rows, errors = n.get("rows") or 0, n.get("errors") or 0
        if errors > allowed_errors:
            raise LoadRefused(f"{contract.name}: {errors} rows in error, {allowed_errors} allowed; nothing was loaded")
    except BaseException:
        _delete(spark, staged)
        raise
    entry = {"batch": batch, "rows": rows - errors, "errors": errors, "folder": staged.rsplit("/", 1)[1]}
    _publish(spark, target, entry)
    return entry


def _publish(spark: SparkSession, target: str, entry: dict) -> None:
    fs, new = _fs(spark, f"{target}/_manifest/.{entry['folder']}")
    stream = fs.create(new, True)
    stream.write(bytearray(json.dumps(entry).encode()))
    stream.close()
    if not fs.rename(new, _fs(spark, f"{target}/_manifest/{entry['folder']}.json")[1]):
        raise OSError(f"the manifest entry of {entry['folder']} could not be published")


def manifest(spark: SparkSession, target: str) -> list[dict]:
    """The published loads of a table, a row for each."""
    fs, p = _fs(spark, f"{target}/_manifest")
    if not fs.exists(p):
        return []
    names = [s.getPath().toString() for s in fs.listStatus(p) if not s.getPath().getName().startswith(".")]
    return sorted((json.loads(r.value) for r in spark.read.text(names).collect()), key=lambda e: e["folder"]) if names else []


def _parts(spark: SparkSession, target: str, part: str, wanted) -> list[DataFrame]:
    folders = [f"{target}/_staged/{e['folder']}/__part={part}" for e in manifest(spark, target) if wanted(e)]
    return [spark.read.parquet(f) for f in folders]


def read_table(spark: SparkSession, contract: TableContract, target: str) -> DataFrame:
    """The rows of all published loads."""
    parts = _parts(spark, target, "rows", lambda e: e["rows"])
    if not parts:
        return spark.createDataFrame([], contract.schema())
    return reduce(DataFrame.union, [p.select(*contract.names) for p in parts])


def read_refused(spark: SparkSession, target: str) -> DataFrame:
    """(row, why) of the refused rows of all published loads, the row as JSON."""
    parts = _parts(spark, target, "refused", lambda e: e["errors"])
    if not parts:
        return spark.createDataFrame([], "row string, why array<string>")
    return reduce(DataFrame.union, [p.select(F.col("__refused").alias("row"), F.col("__why").alias("why")) for p in parts])


def append_batch(df: DataFrame, table: str, batch: str, keys: Sequence[str]) -> DataFrame:
    """SNK4: append a batch to the named table ``table`` so that a rerun adds nothing; returns the table.

    The table is partitioned by ``load_batch``, which is the ledger of what
    has been added: rows whose key the batch's partition holds already are
    left out by an anti-join. A run that stopped half-way adds the rest. Keys
    are unique in a batch; null key parts are equal to each other.
    """
    spark, marked = df.sparkSession, df.withColumn("load_batch", F.lit(batch))
    if spark.catalog.tableExists(table):
        names = spark.table(table).columns
        there = spark.table(table).where(F.col("load_batch") == batch).select(*[F.col(k).alias(f"__{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
        # written first: a table can't be appended to while it is read
        marked = marked.join(there, same, "left_anti").select(*names).checkpoint()
        marked.write.mode("append").insertInto(table)
    else:
        marked.write.partitionBy("load_batch").format("parquet").saveAsTable(table)
    return spark.table(table)
