"""SRC1 / DOM6: the survey's raw files, bound by their own headers, with a ledger of rejected cells.

The files of one source may list their columns in different orders. The
header of every file is read first (one line each, like the listing of the
files a matter of metadata); files with equal headers are one scan, and the
scans are put together by name.

One pass types the cells and keeps those that hold text but no value of their
type, with file, row and field. The pass is written to the shared folder; the
typed rows and the ledger are both read from there.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyprep.operators.keys import PLACE, number_places, with_place
from surveyprep.session import shared_dir
from surveyprep.sources.readers import PANDAS_NA_TOKENS, READ_TYPES, typed_cell


def list_files(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The data files under files, folders or patterns, by path."""
    jvm, conf, out = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for path in [paths] if isinstance(paths, str) else paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        fs = pattern.getFileSystem(conf)
        for status in fs.globStatus(pattern) or []:
            found = fs.listFiles(status.getPath(), True)
            while found.hasNext():
                f = found.next().getPath()
                if not f.getName().startswith(("_", ".")):
                    out.append(f.toString())
    return sorted(out)


def file_header(spark: SparkSession, path: str, sep: str) -> tuple[str, ...]:
    """The column names in a file's first line; none in an empty file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))) if line else ()


def read_by_header(spark: SparkSession, paths: Iterable[str], columns: Iterable[str], number: int = 0, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """``columns`` as text, by name, from files of any column order, with the place of each row.

    A column that a file lacks is null in its rows; other columns aren't read.
    """
    columns, groups = list(columns), defaultdict(list)
    files = list_files(spark, paths)
    with ThreadPoolExecutor(16) as pool:
        for path, header in zip(files, pool.map(lambda f: file_header(spark, f, sep), files)):
            if header:
                groups[header].append(path)
    if not groups:
        empty = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
        return empty.select("*", F.lit(number).alias("__source"), F.lit("").alias("__file"), F.lit(0).cast("long").alias("__block"), F.lit(0).cast("long").alias("__place"))
    scans = []
    for header, group in groups.items():
        schema = ", ".join(f"`{c}` string" for c in header)
        text = (spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
                .option("multiLine", multi_line).option("emptyValue", "").csv(group))
        scan = with_place(text, number)
        scans.append(scan.select(*[F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns], *PLACE))
    return reduce(DataFrame.union, scans)


def read_survey(spark: SparkSession, sources: Mapping[str, Iterable[str]], specs: Mapping[str, Mapping], sep: str = ",",
                na_tokens: Iterable[str] = PANDAS_NA_TOKENS, multi_line: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """({source: typed rows}, ledger) of the sources' files, in one pass over each.

    ``specs`` has the ``columns`` and ``types`` of each source; a column
    without a type stays text. The ledger has (source, file, row, load_id,
    field, text) of every cell that was rejected and read as null: row is the
    data row in its file from 1, load_id the row in load order over all
    sources from 0.
    """
    tokens, base, typed, marked = list(na_tokens), shared_dir(spark, "survey-files"), {}, []
    for i, (role, paths) in enumerate(sources.items()):
        columns, types = specs[role]["columns"], specs[role].get("types", {})
        rows, cells, bad = read_by_header(spark, paths, columns, i, sep, multi_line), [], []
        for c in columns:
            kind = READ_TYPES.get(types.get(c, "string"), types.get(c, "string"))
            given = F.when(F.col(f"`{c}`").isin(tokens), F.lit(None).cast("string")).otherwise(F.col(f"`{c}`"))
            cells.append(typed_cell(given, kind).alias(c))
            if kind != "string":
                bad.append(F.when(given.isNotNull() & typed_cell(given, kind).isNull(), F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("text"))))
        rejected = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<struct<field: string, text: string>>")
        path = f"{base}/{role}"
        rows.select(*cells, rejected.alias("__rejected"), *PLACE).write.parquet(path)
        kept = spark.read.parquet(path)
        typed[role] = kept.select(*columns)
        marked.append(kept.select(F.lit(role).alias("source"), "__rejected", *PLACE))
    rows = number_places(number_places(reduce(DataFrame.union, marked), "load_id"), "row", per_file=True, start=1)
    ledger = rows.where(F.size("__rejected") > 0).select("source", F.col("__file").alias("file"), "row", "load_id", F.inline("__rejected"))
    return typed, ledger
