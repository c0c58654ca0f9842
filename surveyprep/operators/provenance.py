"""FLT1-2 / DOM2: which rule of a cascade wrote what.

The rules run as they always do, stage by stage; beside every target goes the
number of the rule that wrote it last, and beside every rule whether its
condition held. One aggregate over all rows then tells, for each rule and
target, how often it fired and how often its value stood at the end.

What the rules' text alone shows is told too: a rule whose targets are all
written again, without a condition, by later rules before anything reads them
can never matter, and a rule that asks for a value which no code list and no
earlier rule can give never fires.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyprep.operators.rules import Rule, plan_stages, stage_exprs


def rule_coverage(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """(rule, name, target, fired, stood): per rule (from 1) and target, in one pass over ``df``.

    ``fired`` counts the rows where the condition held when the rule's turn
    came, ``stood`` those where the rule's value is the target's last one. A
    rule that fired and never stood was overruled on every row.
    """
    rules = list(rules)
    pairs = [(i, t) for i, r in enumerate(rules, 1) for t in r.targets]
    by = {t: f"__by{j}" for j, t in enumerate(dict.fromkeys(t for _, t in pairs))}
    out, done = df.withColumns({c: F.lit(0) for c in by.values()}), 0
    for stage in plan_stages(rules):
        new = stage_exprs(stage, out.columns)
        size = stage_size(rules, done, stage)
        for i in range(done + 1, done + size + 1):
            held = rules[i - 1].when
            new[f"__fired{i}"] = F.lit(True) if held is None else F.coalesce(held, F.lit(False))
        for target in stage.branches:
            last = F.col(by[target])
            for i in range(done + 1, done + size + 1):
                if target in rules[i - 1].targets:
                    last = F.when(new[f"__fired{i}"], F.lit(i)).otherwise(last)
            new[by[target]] = last
        out, done = out.withColumns(new), done + size
    counts = out.agg(*[F.count_if(F.col(f"__fired{i}")).alias(f"f{i}") for i in range(1, len(rules) + 1)],
                     *[F.count_if(F.col(by[t]) == i).alias(f"s{n}") for n, (i, t) in enumerate(pairs)])
    rows = [F.struct(F.lit(i).alias("rule"), F.lit(rules[i - 1].name).alias("name"), F.lit(t).alias("target"), F.col(f"f{i}").alias("fired"),
                     F.col(f"s{n}").alias("stood")) for n, (i, t) in enumerate(pairs)]
    return counts.select(F.inline(F.array(*rows)))


def stage_size(rules: list[Rule], done: int, stage) -> int:
    """How many of the rules from ``done`` on the stage holds."""
    left, n = sum(len(b) for b in stage.branches.values()), 0
    while left:
        left -= len(rules[done + n].set)
        n += 1
    return n


def dead_rules(rules: Iterable[Rule]) -> list[int]:
    """Rules (from 1) of which nothing can be left: every target is set again without a condition before a rule reads it."""
    rules, dead = list(rules), []
    for i, r in enumerate(rules):
        def lost(target: str) -> bool:
            for later in rules[i + 1:]:
                if target in later.reads:
                    return False
                if target in later.targets and later.when is None:
                    return True
            return False
        if all(lost(t) for t in r.targets):
            dead.append(i + 1)
    return dead


def impossible_values(rules: Iterable[Rule], categories: Mapping[str, Iterable]) -> list[tuple[int, str, object]]:
    """(rule from 1, column, value) of the tests that no row can pass: values that their column can't hold at that point.

    ``categories`` lists the labels that the code maps give a column. A value
    comes from these or from an earlier rule that sets the column to it; a
    column without categories can hold anything, and so can one that an
    earlier rule fills with an expression.
    """
    rules, out = list(rules), []
    for no, r in enumerate(rules, 1):
        for column, values in r.tests:
            if column not in categories:
                continue
            given = [v for earlier in rules[:no - 1] for t, v in earlier.set if t == column]
            if any(isinstance(v, Column) for v in given):
                continue
            out += [(no, column, v) for v in values if v not in {*categories[column], *given}]
    return out
