"""Sinks: pipe-delimited hand-off files, typed staged loads, stage-insert, append."""

from surveyprep.sinks.writers import (
    append_table,
    read_staged,
    stage_insert,
    write_delimited,
)

__all__ = ["append_table", "read_staged", "stage_insert", "write_delimited"]
