"""FLT1-2, DOM2-5: ordered conditional recodes.

A rule is "where <condition>, set <targets> to <value>". Rules depend on
the results of earlier rules, so order matters. Emitting one
``withColumn`` per rule grows the plan linearly with hundreds of
projections; folding everything into one nested CASE duplicates
expressions exponentially. Instead rules are grouped into
*stages* (``early_stages``; ``plan_stages`` groups consecutive rules only): a
rule joins the first stage after those that write a column its condition (or
value) reads, if the order of writes stays the same. Inside a stage every target is
one ``CASE WHEN`` whose branches are the stage's rules for that target,
latest rule first, so the later rule wins exactly as in sequential
assignment. Each stage is one ``withColumns`` projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyprep.functions.predicates import recorded
from surveyprep.session import whole


@dataclass(frozen=True)
class Rule:
    when: Column | None          # None means "always"
    set: tuple                   # ((target, value), ...); value is a literal or a Column
    reads: frozenset = frozenset()
    name: str = ""
    tests: tuple = ()            # ((column, (value, ...)), ...): the values that the condition asks for

    @property
    def targets(self) -> list[str]:
        return [t for t, _ in self.set]


def rule(when: Column | None, targets, value, reads: Iterable[str] = (), name: str = "") -> Rule:
    """Set every column in ``targets`` to ``value`` where ``when`` holds.

    ``reads`` lists the columns the condition (and a Column value) read;
    it drives the staging.
    """
    if isinstance(targets, str):
        targets = [targets]
    return Rule(when, tuple((t, value) for t in targets), frozenset(reads), name)


def rule_multi(when: Column | None, assignments: Mapping[str, object], reads: Iterable[str] = (),
               name: str = "") -> Rule:
    """One condition, different values per target."""
    return Rule(when, tuple(assignments.items()), frozenset(reads), name)


@dataclass
class Stage:
    branches: dict = field(default_factory=dict)  # target -> [(cond, value), ...] in rule order
    reads: set = field(default_factory=set)

    @property
    def writes(self) -> set:
        return set(self.branches)


def plan_stages(rules: Iterable[Rule]) -> list[Stage]:
    stages: list[Stage] = []
    cur = Stage()
    for r in rules:
        if cur.branches and (r.reads & cur.writes):
            stages.append(cur)
            cur = Stage()
        for t, v in r.set:
            cur.branches.setdefault(t, []).append((r.when, v))
        cur.reads |= set(r.reads)
    if cur.branches:
        stages.append(cur)
    return stages


def early_stages(rules: Iterable[Rule]) -> list[Stage]:
    """The rules in few stages, not all of consecutive rules.

    A rule goes to the first stage after all earlier rules that write what it
    reads, and not before an earlier rule that reads or writes what it writes:
    a stage's conditions see the row as it was before the stage, and its
    branches for a target keep the rules' order.
    """
    stages: list[Stage] = []
    written, read = {}, {}  # column -> last stage that writes it, reads it
    for r in rules:
        at = max([0, *[written[c] + 1 for c in r.reads if c in written], *[m[t] for t in r.targets for m in (written, read) if t in m]])
        stages += [Stage() for _ in range(at + 1 - len(stages))]
        for t, v in r.set:
            stages[at].branches.setdefault(t, []).append((r.when, v))
            written[t] = max(at, written.get(t, 0))
        for c in r.reads:
            read[c] = max(at, read.get(c, 0))
        stages[at].reads |= set(r.reads)
    return [st for st in stages if st.branches]


def _value(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def stage_exprs(stage: Stage, columns: Iterable[str], cond_cols: dict | None = None) -> dict:
    """One CASE per target; ``cond_cols`` maps a condition's text to a
    precomputed boolean column so a condition shared by many targets is
    evaluated (and code-generated) once."""
    present = set(columns)
    cond_cols = cond_cols or {}
    out = {}
    for target, branches in stage.branches.items():
        fallback = F.col(target) if target in present else F.lit(None).cast("string")
        expr = None
        # latest rule first: it must win over earlier ones; an unconditional
        # rule makes everything before it irrelevant
        for cond, v in reversed(branches):
            if cond is None:
                fallback = _value(v)
                break
            c = F.col(cond_cols[str(cond)]) if str(cond) in cond_cols else cond
            expr = F.when(c, _value(v)) if expr is None else expr.when(c, _value(v))
        out[target] = expr.otherwise(fallback) if expr is not None else fallback
    return out


def apply_rules(df: DataFrame, rules: Iterable[Rule], pack: bool = False) -> DataFrame:
    """Apply the ordered rule list, one projection per stage.

    A condition shared by many targets appears in each target's CASE;
    subexpression elimination evaluates it once per row, and no extra
    projection of the wide row is materialised for it. With ``pack``, for wide
    rows and rules that list all they read, a column goes through the stages
    before the first that uses it in a struct, which is copied at once.
    """
    stages, names = early_stages(rules), df.columns
    if not pack or len(stages) < 2:
        for st in stages:
            df = df.withColumns(stage_exprs(st, df.columns))
        return df
    uses = [{u.lower() for u in st.reads | st.writes} for st in stages]
    later = {}  # number of the first stage that uses them (their count: none) -> columns
    for c in names:
        later.setdefault(next((i for i, u in enumerate(uses) if c.lower() in u), len(stages)), []).append(c)
    flat = later.pop(0, [])
    df = df.select(*[whole(v).alias(f"__from{i}") for i, v in later.items()], *[F.col(f"`{c}`") for c in flat])
    for i, st in enumerate(stages):
        if i in later:
            df = df.select(*[F.col(f"`{c}`") for c in df.columns if c != f"__from{i}"], *[F.col(f"__from{i}.`{c}`").alias(c) for c in later.pop(i)])
        df = df.withColumns(stage_exprs(st, df.columns))
    idle = {c: F.col(f"__from{i}.`{c}`").alias(c) for i, v in later.items() for c in v}
    made = [c for c in df.columns if c not in names and not c.startswith("__from")]
    return df.select(*[idle.get(c, F.col(f"`{c}`")) for c in names], *[F.col(f"`{c}`") for c in made])


def count_stages(rules: Iterable[Rule]) -> int:
    return len(plan_stages(rules))


def when(cond_fn, targets, value, name: str = "") -> Rule:
    """Rule whose condition is built by ``cond_fn(c)``; every ``c("name")`` call
    is recorded as a read, so the staging needs no hand-kept read list."""
    names: list[str] = []

    def c(n: str) -> Column:
        names.append(n)
        return F.col(n)

    with recorded() as tests:
        cond = cond_fn(c) if cond_fn is not None else None
    if isinstance(value, Column):
        raise TypeError("use rule(..., reads=...) for column values")
    return replace(rule(cond, targets, value, reads=names, name=name), tests=tuple(tests))
