import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from surveyprep.operators.contract import contract_for
from surveyprep.plans.datasets import VEHICLE_SENTINEL, build_dataset, build_location, load_dataset
from surveyprep.plans.raw_inputs import raw_sources, survey_zones

TABLE = {"vehicles": "vehicles", "day": "day", "households": "households", "border_trips": "border_trips",
         "intercept": "intercept", "persons": "persons", "trips": "trips"}


@pytest.mark.parametrize("name", list(TABLE))
def test_builder_matches_contract_columns(spark, name):
    df = build_dataset(name, raw_sources(spark, SF_SMALL, name), survey_zones(spark, SF_SMALL))
    assert df.columns == contract_for(TABLE[name]).names
    loaded, reports = load_dataset(df, TABLE[name])
    assert loaded.count() == df.count() > 0
    for r in reports:
        r.collect()


def test_person_rules_hold(spark):
    p = build_dataset("persons", raw_sources(spark, SF_SMALL, "persons"), survey_zones(spark, SF_SMALL))
    young = p.where(F.col("age_category").isin("Under 5 years old", "5-15 years"))
    assert young.where(F.col("employment_status") != "Not Applicable").count() == 0
    assert p.where(F.col("second_work_address").isNull()).count() == 0


def test_trip_rules_and_weights(spark):
    t = build_dataset("trips", raw_sources(spark, SF_SMALL, "trips"), survey_zones(spark, SF_SMALL))
    assert t.where((F.col("data_source") == "rMove") & (F.col("origin_name") != "Not Applicable")).count() == 0
    assert t.where((F.col("data_source") == "Online") & (F.col("trip_id_location") != 0)).count() == 0
    assert t.where(F.col("origin_address").contains("|")).count() == 0
    w = t.where(F.col("weight_trip").isNotNull()).select(F.min("weight_trip"), F.max("weight_trip")).first()
    assert 0.1 <= w[0] <= w[1] <= 1.0
    assert t.where(F.col("origin_mgra_13").isNotNull()).count() > 0


def test_trip_compat_quirks_change_results(spark):
    src = raw_sources(spark, SF_SMALL, "trips")
    a = build_dataset("trips", src, None, compat=False)
    b = build_dataset("trips", src, None, compat=True)
    na = lambda df, c: df.where(F.col(c) == "Not Applicable").count()
    assert na(b, "airplane_cost_dk") >= na(a, "airplane_cost_dk")


def test_border_keys_dense_unique(spark):
    b = build_dataset("border_trips", raw_sources(spark, SF_SMALL, "border_trips"))
    ids = sorted(r[0] for r in b.select("border_trip_id").collect())
    assert ids == list(range(len(ids)))
    assert b.where(F.col("mode").isNull()).count() == 0


def test_vehicles_sentinel_and_location(spark):
    v = build_dataset("vehicles", raw_sources(spark, SF_SMALL, "vehicles"))
    loaded, _ = load_dataset(v, "vehicles", VEHICLE_SENTINEL)
    assert loaded.where(F.col("vehicle_id") == 0).count() == 1
    loc = build_location(raw_sources(spark, SF_SMALL, "location"))
    pts = loc["points"]
    ids = sorted(r[0] for r in pts.select("point_id").collect())
    assert ids == list(range(len(ids)))
    assert loc["lines"].count() == pts.select("trip_id_location").distinct().count()


def test_dataset_frequencies(spark):
    from surveyprep.operators.profile import profile_freq, profile_n
    from surveyprep.plans.datasets import dataset_categories

    h = build_dataset("households", raw_sources(spark, SF_SMALL, "households"), survey_zones(spark, SF_SMALL)).cache()
    cats = dataset_categories("households")
    rows = h.count()
    n = profile_n(h, categorical=list(cats), user_missing=["Missing", "Not Applicable"]).collect()
    assert len(n) == len(h.columns) and all(r["n"] + r["missing"] == rows for r in n)
    freq = profile_freq(h, cats).collect()
    got = {}
    for r in freq:
        got[r["field"]] = got.get(r["field"], 0) + r["count"]
    for f, labels in cats.items():
        assert got[f] == h.where(h[f].isin(labels)).count()
