"""DOM1: trip weights from numeric codes (computed before labelling)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveyprep.functions.predicates import ge


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def person_trip_weight(weekdays) -> Column:
    """1 when the household completed at least one weekday, else null."""
    return F.when(ge(weekdays, 1), F.lit(1.0))


def trip_weight(weekdays, travelers_hh, max_travelers: int = 10) -> Column:
    """1 / household travellers when 1..max_travelers, else 1; null without a weekday."""
    t = _c(travelers_hh)
    share = F.when(F.coalesce(t.between(1, max_travelers), F.lit(False)), F.lit(1.0) / t.cast("double")) \
             .otherwise(F.lit(1.0))
    return F.when(ge(weekdays, 1), share)
