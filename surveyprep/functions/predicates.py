"""FLT3-8: two-valued predicates over three-valued SQL logic.

The survey rules were written for pandas masks, where a comparison with a
missing value is simply ``False`` (and ``!=`` is ``True``). Spark's plain
``=``, ``!=``, ``IN`` and ``>`` return null for a null operand, and a
``when(null, ...)`` silently takes the ``otherwise`` branch, so every rule
condition goes through these helpers and is never null.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_heard: list | None = None


@contextmanager
def recorded() -> Iterator[list]:
    """The tests for values that are built meanwhile: (column's name, values)."""
    global _heard
    before, _heard = _heard, []
    try:
        yield _heard
    finally:
        _heard = before


def _note(c, values: Iterable) -> None:
    if _heard is not None:
        _heard.append((c if isinstance(c, str) else c._jc.toString(), tuple(values)))


def eq(c, value) -> Column:
    """``c == value``; null is *not equal*."""
    _note(c, [value])
    return _c(c).eqNullSafe(F.lit(value))


def ne(c, value) -> Column:
    """``c != value``; null counts as *not equal* (true)."""
    _note(c, [value])
    return ~_c(c).eqNullSafe(F.lit(value))


def is_in(c, values: Iterable) -> Column:
    """Membership; null is not a member."""
    values = list(values)
    _note(c, values)
    return F.coalesce(_c(c).isin(values), F.lit(False))


def not_in(c, values: Iterable) -> Column:
    """Negated membership; null is not a member, so this is true for null."""
    return ~is_in(c, values)


def gt(c, value) -> Column:
    return F.coalesce(_c(c) > F.lit(value), F.lit(False))


def ge(c, value) -> Column:
    return F.coalesce(_c(c) >= F.lit(value), F.lit(False))


def lt(c, value) -> Column:
    return F.coalesce(_c(c) < F.lit(value), F.lit(False))


def le(c, value) -> Column:
    return F.coalesce(_c(c) <= F.lit(value), F.lit(False))


def is_null(c) -> Column:
    return _c(c).isNull()


def any_in(cols: Iterable, values: Iterable) -> Column:
    """Multi-response: at least one of ``cols`` holds a value in ``values``."""
    vals = list(values)
    return reduce(lambda a, b: a | b, [is_in(c, vals) for c in cols])


def none_in(cols: Iterable, values: Iterable) -> Column:
    """FLT8: no one of ``cols`` is in ``values`` (null slots are ignored)."""
    return ~any_in(cols, values)
