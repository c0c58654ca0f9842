"""Unlisted codes, width offenders and rule coverage against plain Python."""

import random
from collections import Counter

from pyspark.sql import functions as F

from surveyprep.functions import predicates as P
from surveyprep.operators.codebook import Codebook, field_map
from surveyprep.operators.contract import ColumnSpec, TableContract
from surveyprep.operators.provenance import dead_rules, impossible_values, rule_coverage
from surveyprep.operators.quality import orphans, unlisted_codes, width_offenders
from surveyprep.operators.rules import apply_rules, rule, when
from surveyprep.plans.datasets import dataset_categories
from surveyprep.operators.codebook import load_codebook
from surveyprep.plans.survey_rules import person_rules, trip_rules


def test_unlisted_codes_among_many_rare_ones(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, 3, None, 7, 7, 8]), rng.choice(["A", "B", "x", "y y", None]), float(rng.choice([1, 1.5, 2]))) for _ in range(4000)]
    rows += [(100 + i, f"rare {i}", 1.0) for i in range(30000)]  # different values each
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(7)
    book = Codebook({"a": field_map([[1, "one"], [2, "two"]]), "b": field_map([["A", "la"], ["B", "lb"]]), "c": field_map([[1, "one"]]), "absent": field_map([[1, "x"]])})
    want = set()
    for no, (field, listed) in enumerate((("a", {1, 2}), ("b", {"A", "B"}), ("c", {1.0}))):
        seen = Counter(str(r[no]) for r in rows if r[no] is not None and r[no] not in listed)
        want |= {(field, code, n, sum(seen.values())) for code, n in seen.items() if n >= 0.01 * sum(seen.values())}
    got = [tuple(r) for r in unlisted_codes(df, book, share=0.01).collect()]
    assert set(got) == want and len(got) == len(want) and {g[1] for g in got} >= {"7", "x", "1.5"}
    assert unlisted_codes(df.limit(0), book).count() == 0


def test_width_offenders(spark):
    rows = [("abcd", "x"), ("abcd", "yy"), ("abcde", None), ("zz", "yyy"), ("zzzz", "yyy"), (None, "é" * 9)]
    spec = TableContract("t", (ColumnSpec("u", "nvarchar", 3, True), ColumnSpec("v", "nvarchar", 2, True), ColumnSpec("n", "int", None, True)), ())
    got = sorted(tuple(r) for r in width_offenders(spark.createDataFrame(rows, "u string, v string"), spec, 2).collect())
    assert got == [("u", 3, 1, 5, "abcde", 1), ("u", 3, 2, 4, "abcd", 2), ("v", 2, 1, 9, "é" * 9, 1), ("v", 2, 2, 3, "yyy", 2)]


def test_rule_coverage_against_row_by_row(spark):
    rng = random.Random(5)
    names, values = ["p", "q", "r"], ["a", "b", "c", None]
    spec = []
    for _ in range(25):  # (column asked, value asked or None for always, targets, value)
        spec.append((rng.choice(names), rng.choice(["a", "b", "c", "d", None]), rng.sample(names, rng.choice([1, 2])), rng.choice(["a", "b", "c"])))
    rows = [tuple(rng.choice(values) for _ in names) for _ in range(200)]
    fired, stood, end = Counter(), Counter(), []
    for row in rows:
        state, by = dict(zip(names, row)), {}
        for i, (col, asked, targets, value) in enumerate(spec, 1):
            if asked is None or state[col] == asked:
                fired[i] += 1
                for t in targets:
                    state[t], by[t] = value, i
        for t, i in by.items():
            stood[(i, t)] += 1
        end.append(tuple(state.values()))
    rules = [rule(None if asked is None else P.eq(col, asked), targets, value, reads=[] if asked is None else [col]) for col, asked, targets, value in spec]
    df = spark.createDataFrame(rows, "p string, q string, r string")
    got = {(r["rule"], r["target"]): (r["fired"], r["stood"]) for r in rule_coverage(df, rules).collect()}
    assert got == {(i, t): (fired[i], stood[(i, t)]) for i, (_, _, targets, _) in enumerate(spec, 1) for t in targets}
    assert sorted(map(str, (tuple(r) for r in apply_rules(df, rules).collect()))) == sorted(map(str, end))
    for i in dead_rules(rules):
        assert all(stood[(i, t)] == 0 for t in spec[i - 1][2])


def test_what_the_rules_text_shows(spark):
    rules = [when(lambda c: P.eq(c("p"), "a"), "q", "x"), rule(None, ["q"], "y"), when(lambda c: P.is_in(c("q"), ["x", "y", "z"]), "r", "w")]
    assert dead_rules(rules) == [1]
    assert impossible_values(rules, {"q": ["z"], "p": ["b"]}) == [(1, "p", "a")]
    assert impossible_values(rules[1:], {"q": []}) == [(2, "q", "x"), (2, "q", "z")]
    assert not dead_rules([rule(F.lit(True), ["q"], "y"), rule(F.lit(True), ["q"], "z")])

    def labels(name):
        return {f: m.categories() for f, m in load_codebook(name).fields.items()}

    # two quirks of the survey's text: airfare asked of the taxi field, and a school type that nothing assigns
    asked = impossible_values(trip_rules(compat=True), labels("trips"))
    assert {v for _, c, v in asked if c == "taxitype"} == {"Personally paid the airfare cost", "Employer paid 100%"}
    assert not [v for _, c, v in impossible_values(trip_rules(), labels("trips")) if c in ("taxitype", "airtype")]
    assert "Not Applicable" in {v for _, c, v in impossible_values(person_rules(), labels("persons")) if c == "schooltype"}
    assert dataset_categories("trips")


def test_orphans_against_sets(spark):
    rng = random.Random(11)
    parents = [(i, rng.choice("ab")) for i in range(3000)] + [(None, "a"), (5, None)]
    children = [(rng.randrange(6000), rng.choice("abc"), i) for i in range(4000)] + [(None, "a", -1), (3, None, -2)] + [(9999, "z", -3)] * 500
    c, p = spark.createDataFrame(children, "k int, t string, n int"), spark.createDataFrame(parents, "k int, t string")
    known = set(parents)
    want = sorted(r for r in children if r[0] is not None and r[1] is not None and r[:2] not in known)
    for bits in (16, 1):  # one bit a key lets many pass; the exact join sorts these out
        assert sorted(tuple(r) for r in orphans(c, ["k", "t"], p, ["k", "t"], bits).collect()) == want
    assert orphans(c, ["k", "t"], p.limit(0), ["k", "t"]).count() == len(children) - 2
    assert orphans(c.limit(0), ["k", "t"], p, ["k", "t"]).count() == 0
