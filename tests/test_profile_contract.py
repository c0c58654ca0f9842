import datetime as dt

from pyspark.sql import functions as F

from surveyprep.operators.contract import (ColumnSpec, TableContract, contract_for, dq_columns, dq_key, round_minute,
                                           store_assign)
from surveyprep.operators.profile import profile_freq, profile_n
from surveyprep.operators.weights import person_trip_weight, trip_weight


def test_profile_n_user_missing(spark):
    df = spark.createDataFrame([("Yes", 1.0), ("No", None), ("Missing", 2.0), (None, 3.0)], "a string, b double")
    got = {r["field"]: (r["n"], r["missing"], r["pct_missing"]) for r in
           profile_n(df, categorical=["a"], user_missing=["Missing"]).collect()}
    assert got == {"a": (2, 2, 50.0), "b": (3, 1, 25.0)}


def test_profile_freq_zero_counts_and_half_even(spark):
    df = spark.createDataFrame([("Yes",)] * 1 + [("No",)] * 7 + [(None,)] * 2, "a string")
    rows = profile_freq(df, {"a": ["Yes", "No", "Missing"]}).orderBy("ordinal").collect()
    assert [(r["label"], r["count"], r["pct"]) for r in rows] == [("Yes", 1, 12.5), ("No", 7, 87.5), ("Missing", 0, 0.0)]


def test_round_minute_and_store_assign(spark):
    ts = [dt.datetime(2017, 1, 1, 10, 0, 29), dt.datetime(2017, 1, 1, 10, 0, 30), dt.datetime(2017, 1, 1, 23, 59, 59)]
    df = spark.createDataFrame([(t, 2.9, -2.9) for t in ts], "t timestamp_ntz, f double, g double")
    rows = df.select(round_minute("t").alias("m"),
                     store_assign("f", ColumnSpec("f", "int", None, True)).alias("fi"),
                     store_assign("g", ColumnSpec("g", "int", None, True)).alias("gi")).collect()
    assert [r["m"] for r in rows] == [dt.datetime(2017, 1, 1, 10, 0), dt.datetime(2017, 1, 1, 10, 1),
                                      dt.datetime(2017, 1, 2, 0, 0)]
    assert rows[0]["fi"] == 2 and rows[0]["gi"] == -2


def test_dq_reports_never_drop_rows(spark):
    c = TableContract("t", (ColumnSpec("k", "int", None, False), ColumnSpec("s", "nvarchar", 5, False)), ("k",),
                      (("k", "s"),))
    df = spark.createDataFrame([(1, "Missing"), (1, "Yes"), (None, None)], "k int, s string")
    rep = {(r["field"], r["check"]): (r["violations"], r["max_length"]) for r in dq_columns(df, c).collect()}
    assert rep[("k", "not_null")][0] == 1 and rep[("s", "not_null")][0] == 1
    assert rep[("s", "width")] == (1, 7)
    keys = {(r["k"], r["rows"]) for r in dq_key(df, ["k"]).collect()}
    assert keys == {(1, 2), (None, 1)}
    assert df.count() == 3


def test_contracts_loaded():
    assert contract_for("trips").primary_key == ("trip_id",)
    assert contract_for("vehicles").unique == (("household_id", "vehicle_number"),)
    assert len(contract_for("persons").columns) == 92


def test_weights(spark):
    rows = [(None, 1), (0, 1), (1, 1), (1, 10), (1, 11), (1, -9998), (1, None)]
    df = spark.createDataFrame(rows, "w int, t int")
    got = [(r[0], r[1]) for r in df.select(person_trip_weight("w"), trip_weight("w", "t")).collect()]
    assert got == [(None, None), (None, None), (1.0, 1.0), (1.0, 0.1), (1.0, 1.0), (1.0, 1.0), (1.0, 1.0)]
