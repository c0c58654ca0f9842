"""Sources: typed header-bound CSV reads, NA tokens, constant defaults, union by name."""

from surveyprep.sources.readers import (
    PANDAS_NA_TOKENS,
    add_defaults,
    read_text_csv,
    read_typed_csv,
    typed_select,
    union_sources,
)

__all__ = ["PANDAS_NA_TOKENS", "add_defaults", "read_text_csv", "read_typed_csv",
           "typed_select", "union_sources"]
