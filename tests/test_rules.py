import random

from pyspark.sql import functions as F

from surveyprep.functions import predicates as P
from surveyprep.operators.rules import apply_rules, count_stages, early_stages, when
from surveyprep.plans import survey_rules as R


def _sequential(df, rules):
    for r in rules:
        for t, v in r.set:
            df = df.withColumn(t, F.when(r.when, F.lit(v)).otherwise(F.col(t)) if r.when is not None else F.lit(v))
    return df


def test_staged_equals_sequential(spark):
    rnd = random.Random(7)
    vals = ["Other reason", "Was sick", None]
    rows = [(rnd.choice([0, 1, 2, None]), rnd.choice(["Yes", "No", None]), rnd.choice(vals), rnd.choice(vals),
             rnd.choice(["text", None]), rnd.choice(["rMove", "Online", None]), rnd.choice(["Home", "Other", None]),
             rnd.choice(["x", None]), rnd.choice(["Home", "Other", None]), rnd.choice(["y", None]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "num_trips int, trips_yesno string, notravel string, notravel_secondary string, "
                                     "notravel_other string, data_source string, loc_start string, "
                                     "loc_start_other string, loc_end string, loc_end_other string")
    rules = R.day_rules()
    assert count_stages(rules) < len(rules)
    a = sorted((tuple(r) for r in apply_rules(df, rules).collect()), key=repr)
    b = sorted((tuple(r) for r in _sequential(df, rules).collect()), key=repr)
    assert a == b


def test_later_rule_wins_within_stage(spark):
    df = spark.createDataFrame([(1, "a"), (0, "a"), (None, "a")], "n int, t string")
    rules = [when(lambda c: P.ge(c("n"), 0), "t", "first"), when(lambda c: P.eq(c("n"), 1), "t", "second")]
    assert count_stages(rules) == 1
    assert [r["t"] for r in apply_rules(df, rules).orderBy(F.col("n").asc_nulls_last()).collect()] == \
        ["first", "second", "a"]


def test_all_survey_rule_tables_stage(spark):
    for fn in (R.day_rules, R.household_rules, R.person_rules, R.trip_rules):
        rules = fn()
        assert 1 <= count_stages(rules) <= len(rules)
    # compat switches change only the quirk rules
    assert len(R.trip_rules(True)) == len(R.trip_rules(False))


def test_rules_move_to_the_first_stage_that_their_order_allows(spark):
    rnd = random.Random(11)
    names, values = list("pqrstu"), ["a", "b", None]
    df = spark.createDataFrame([tuple(rnd.choice(values) for _ in names) for _ in range(60)], ", ".join(f"{c} string" for c in names))
    for _ in range(4):
        rules = [when(lambda c, n=rnd.choice(names), v=rnd.choice("abc"): P.eq(c(n), v), rnd.sample(names, rnd.choice([1, 2])), rnd.choice("abc")) for _ in range(9)]
        assert len(early_stages(rules)) <= count_stages(rules)
        assert sorted(map(str, (tuple(r) for r in apply_rules(df, rules).collect()))) == sorted(map(str, (tuple(r) for r in _sequential(df, rules).collect())))
    assert len(early_stages(R.trip_rules())) < count_stages(R.trip_rules())
