"""Raw CSV files in any column order through the builders, the reject ledger, loads bounded in errors, appends that can be repeated."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from surveyprep.operators.contract import ColumnSpec, TableContract
from surveyprep.plans.datasets import build_dataset, build_from_files, build_location, raw_types, read_raw
from surveyprep.plans.raw_inputs import raw_sources, survey_zones
from surveyprep.sinks.loads import LoadRefused, append_batch, load_table, manifest, read_refused, read_table
from surveyprep.sources.survey_files import read_survey

SF = "/root/testdata/sf0.001"


def as_files(df, path, seed):
    """Two folders of CSV files, each with its columns in an order of its own."""
    rng, half = random.Random(seed), F.pmod(F.xxhash64(*df.columns[:2]), F.lit(2))
    for i in (0, 1):
        columns = df.columns[:]
        rng.shuffle(columns)
        df.where(half == i).select(*columns).repartition(2).write.option("header", True).option("escape", '"').option("emptyValue", "").option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{path}/{i}")
    return [f"{path}/*"]


def texts(df):
    return sorted(str(tuple(r)) for r in df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns]).collect())


@pytest.mark.parametrize("name", ["vehicles", "day", "border_trips", "intercept", "households"])
def test_files_of_shuffled_columns_through_the_builders(spark, tmp_path, name):
    raw = raw_sources(spark, SF, name)
    if name == "day":  # a whole number in the survey's files
        raw["main"] = raw["main"].withColumn("diary_duration", F.floor("diary_duration"))
    zones = survey_zones(spark, SF) if name in ("intercept", "households") else None
    files = {role: as_files(df, str(tmp_path / role), i) for i, (role, df) in enumerate(raw.items())}
    got, ledger = build_from_files(spark, name, files, zones)
    want = build_dataset(name, {role: df.select(*[F.col(c).cast("bigint") if t == "int" else F.col(c) for c, t in df.dtypes]) for role, df in raw.items()}, zones)
    assert got.columns == want.columns and texts(got) == texts(want)
    assert ledger.count() == 0


def test_location_files(spark, tmp_path):
    raw = raw_sources(spark, SF, "location")
    files = {role: as_files(df, str(tmp_path / role), 5) for role, df in raw.items()}
    got, want = build_location(read_raw(spark, "location", files)[0]), build_location(raw)
    assert all(texts(got[part]) == texts(want[part]) for part in ("points", "lines"))


def test_ledger_of_rejected_cells(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text('﻿id,n,d,t\n1,5,2016-01-02,x\n2,five,2016-13-40,"y, ""z"""\n3,NA,,\n')
    with gzip.open(tmp_path / "a" / "2.csv.gz", "wt") as f:
        f.write("t,extra,d,id\nq,1,bad day,4\nr,2,2017-01-01,4.5\n")
    (tmp_path / "a" / "3.csv").write_text("")
    (tmp_path / "b.csv").write_text("n,id\n7.0,9\n1e400,10\n")
    spec = {"columns": ["id", "n", "d", "t"], "types": {"id": "bigint", "n": "int", "d": "date"}}
    typed, ledger = read_survey(spark, {"a": str(tmp_path / "a"), "b": [str(tmp_path / "b.csv")]}, {"a": spec, "b": spec})
    assert texts(typed["a"]) == sorted(str(r) for r in [("1", "5", "2016-01-02", "x"), ("2", None, None, 'y, "z"'), ("3", None, None, None), ("4", None, None, "q"),
                                                         (None, None, "2017-01-01", "r")])
    assert texts(typed["b"]) == sorted(str(r) for r in [("9", "7", None, None), ("10", None, None, None)])
    got = sorted((r["source"], r["file"].rsplit("/", 1)[1], r["row"], r["load_id"], r["field"], r["text"]) for r in ledger.collect())
    assert got == [("a", "1.csv", 2, 1, "d", "2016-13-40"), ("a", "1.csv", 2, 1, "n", "five"), ("a", "2.csv.gz", 1, 3, "d", "bad day"),
                   ("a", "2.csv.gz", 2, 4, "id", "4.5"), ("b", "b.csv", 2, 6, "n", "1e400")]
    typed, ledger = read_survey(spark, {"a": str(tmp_path / "a" / "3.csv")}, {"a": spec})
    assert typed["a"].count() == 0 and ledger.count() == 0
    assert raw_types("vehicles", "main")["hhid"] == "bigint"


CONTRACT = TableContract("t", (ColumnSpec("k", "int", None, False), ColumnSpec("v", "nvarchar", 3, True), ColumnSpec("s", "tinyint", None, True)), ("k",))


def test_load_with_a_bound_on_errors(spark, tmp_path):
    target = str(tmp_path / "t")
    assert read_table(spark, CONTRACT, target).count() == 0
    good = spark.createDataFrame([(1, "abc", 5), (2, None, None)], "k bigint, v string, s int")
    assert load_table(good, CONTRACT, target, batch="first")["rows"] == 2
    before = [(str(p), p.stat().st_size) for p in sorted(tmp_path.rglob("*"))]
    bad = spark.createDataFrame([(3, "abc", 5), (None, "abc", 0), (4, "abcd", 300)], "k bigint, v string, s int")
    with pytest.raises(LoadRefused):
        load_table(bad, CONTRACT, target, allowed_errors=1, batch="second")
    assert [(str(p), p.stat().st_size) for p in sorted(tmp_path.rglob("*"))] == before
    assert load_table(bad, CONTRACT, target, allowed_errors=2, batch="second")["errors"] == 2
    assert load_table(bad, CONTRACT, target, allowed_errors=2, batch="second")["errors"] == 2  # again: nothing is added
    assert sorted(tuple(r) for r in read_table(spark, CONTRACT, target).collect()) == [(1, "abc", 5), (2, None, None), (3, "abc", 5)]
    assert read_table(spark, CONTRACT, target).dtypes == [("k", "int"), ("v", "string"), ("s", "smallint")]
    why = {tuple(r["why"]) for r in read_refused(spark, target).collect()}
    assert why == {("k: null",), ("v: does not fit", "s: does not fit")} and len(manifest(spark, target)) == 2


def test_a_load_that_breaks_off_leaves_no_trace(spark, tmp_path):
    df = spark.range(10).select(F.col("id").alias("k"), F.when(F.col("id") == 9, F.raise_error(F.lit("lost"))).otherwise("a").alias("v"), F.lit(1).alias("s"))
    with pytest.raises(Exception, match="lost"):
        load_table(df, CONTRACT, str(tmp_path / "t"))
    assert not [p for p in tmp_path.rglob("*") if p.is_file()] and manifest(spark, str(tmp_path / "t")) == []


def test_append_of_a_batch_can_be_repeated(spark):
    table = "append_twice"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    try:
        one = spark.createDataFrame([(1, None, "a"), (2, "x", "b")], "k int, part string, v string")
        append_batch(one, table, "b1", ["k", "part"])
        append_batch(one, table, "b1", ["k", "part"])
        more = one.union(spark.createDataFrame([(3, "x", "c")], one.schema))
        append_batch(more, table, "b1", ["k", "part"])  # a run that stopped half-way
        append_batch(one, table, "b2", ["k", "part"])
        got = sorted((r["load_batch"], r["k"], r["v"]) for r in spark.table(table).collect())
        assert got == [("b1", 1, "a"), ("b1", 2, "b"), ("b1", 3, "c"), ("b2", 1, "a"), ("b2", 2, "b")]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
