"""surveyprep — survey preparation on Spark DataFrames.

Turns raw survey exports into clean, labelled, analysis-ready tables:
typed header-bound reads, union of sources with differing columns,
codebook recoding (null / unlisted / Missing / Not Applicable kept apart),
ordered null-safe recode rules, wide-to-long reshape, GPS paths, map
projection, point-in-zone lookup, weights, surrogate keys, frequency
profiles and contract-checked typed loading. Everything is expressed as
DataFrame / SQL column expressions so the plans stay inside Catalyst and
whole-stage codegen, with no Python workers.
"""

from surveyprep.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
