"""Streaming.

The survey preparation works on finished exports: every input is a
complete file, there is no late data, watermark, window or state to keep.
Nothing here needs Structured Streaming, so no streaming operator is
built. All row-local operators of the library (typed reads, code maps,
recode rules, projections, point WKT, broadcast zone probes) are plain
column expressions and would run unchanged on a streaming DataFrame; the
keyed ones (surrogate keys, paths, profiles, key checks) need the whole
table and stay batch jobs.
"""
