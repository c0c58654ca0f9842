"""Raw survey-shaped inputs derived from the driver's test tables.

The survey's own raw files are not available, so each dataset's two raw
sources are derived row by row from a test table (one output row per
input row, so the work grows with the tables). Column names and read
types come from the dataset's fixed-value spec; coded fields draw a listed
code, one unlisted code or null by a number drawn from (row key, field name)
in plain arithmetic, so that SQL elsewhere makes the same rows;
other columns get values of their kind (text with the hand-off delimiter
now and then, coordinates around the survey region, timestamps from the
table's own time column). Everything is one projection over the scan.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyprep.operators.codebook import Codebook, load_spec, sql_literal
from surveyprep.plans.tables import EV_LAT_SQL, EV_LNG_SQL, EV_TRIP_SQL, table

UNLISTED_CODE = 555


def _h(seed: str, name: str) -> str:
    """A number below 2**31 - 1 for a row key and a field: two linear steps modulo a prime, the same in both engines."""
    field = zlib.crc32(name.encode())
    return f"abs((CAST({seed} AS BIGINT) % 2147483647 * {field % 1000003 + 1} + {field % 2147483629}) % 2147483647 * 48271 % 2147483647)"


def _coded(seed: str, name: str, fmap) -> str:
    text = fmap.key_type == "string"
    t = "STRING" if text else "INT"
    choices = [f"CAST({sql_literal(c)} AS {t})" for c, _ in fmap.codes]
    choices.append(f"CAST({sql_literal('not a listed code' if text else UNLISTED_CODE)} AS {t})")
    n = len(choices) + 1  # last slot: past the end -> null
    return f"PICK({', '.join(choices)})AT({_h(seed, name)} % {n})"


def _kind(col: str) -> str:
    if col.endswith("lat") or col.endswith("_lat_1"):
        return "lat"
    if col.endswith("lng") or col.endswith("_lng_1"):
        return "lng"
    if col in ("traveldate", "traveldate_start", "survey_day"):
        return "date"
    if (col.endswith("_at") or col.endswith("_pt") or col.endswith("_pdt")
            or col in ("departure_time", "arrival_time", "activated_rmove")):
        return "ts"
    if any(s in col for s in ("address", "name", "_other", "specify", "make", "model", "google_mode")) \
            or col in ("year",):
        return "text"
    if col in ("numdays_complete", "num_trips", "num_answer", "daynum", "pernum", "height", "weight_lbs",
               "work_park_cost", "h_complete_weekdays", "revised_count", "num_rmove_participants",
               "age_groups_1_1", "age_groups_1_2", "age_groups_1_3", "vehnum"):
        return "int"
    return "double"


def _value(seed: str, col: str, base_ts: str) -> str:
    h = _h(seed, col)
    k = _kind(col)
    if k == "lat":
        return f"CASE WHEN {h} % 17 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST('32.55' AS DOUBLE) + CAST('0.01' AS DOUBLE) * CAST({h} % 60 AS DOUBLE) END"
    if k == "lng":
        return f"CASE WHEN {h} % 19 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST('-117.3' AS DOUBLE) + CAST('0.01' AS DOUBLE) * CAST({h} % 50 AS DOUBLE) END"
    if k == "date":
        return f"CAST({base_ts} AS DATE)"
    if k == "ts":
        return f"CASE WHEN {h} % 23 = 0 THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE CAST(CAST({base_ts} AS TIMESTAMP_NTZ) + SECONDS({h} % 86400) AS TIMESTAMP_NTZ) END"
    if k == "text":
        return (f"CASE WHEN {h} % 7 = 0 THEN CAST(NULL AS STRING) ELSE concat('{col} ', CAST({h} % 100000 AS STRING), "
                f"CASE WHEN {h} % 10 = 0 THEN ' | unit 2' ELSE '' END) END")
    if k == "int":
        return f"CASE WHEN {h} % 11 = 0 THEN CAST(NULL AS INT) ELSE CAST({h} % 4 AS INT) END"
    return f"CASE WHEN {h} % 13 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST({h} % 100000 AS DOUBLE) / CAST('100' AS DOUBLE) END"


_DIALECTS = {
    "spark": [(r"PICK\((.*)\)AT\((.*)\)$", r"try_element_at(array(\1), CAST(\2 AS INT) + 1)"), (r"SECONDS\((.*?) % 86400\)", r"make_interval(0, 0, 0, 0, 0, 0, CAST(\1 % 86400 AS INT))")],
    "duckdb": [(r"PICK\((.*)\)AT\((.*)\)$", r"list_extract([\1], CAST(\2 AS BIGINT) + 1)"), (r"SECONDS\((.*?) % 86400\)", r"to_seconds(CAST(\1 % 86400 AS BIGINT))"),
               (r"TIMESTAMP_NTZ", "TIMESTAMP"), (r"make_timestamp_ntz", "make_timestamp"), (r"8, 0, 0\)", "8, 0, 0.0)")],
}


def _said(expr: str, dialect: str) -> str:
    for pattern, text in _DIALECTS[dialect]:
        expr = re.sub(pattern, text, expr)
    return expr


def _expressions(seed: str, base_ts: str, columns: list[str], fixed: dict, cb: Codebook, dialect: str) -> list[str]:
    exprs = []
    for c in columns:
        e = fixed[c] if c in fixed else _coded(seed, c, cb[c]) if c in cb else _value(seed, c, base_ts)
        exprs.append(f"{_said(e, dialect)} AS {c}")
    return exprs


def _border_codebook(cb: Codebook) -> Codebook:
    out = dict(cb.fields)
    for stub in list(cb.fields):
        for k in range(1, 5):
            out[f"{stub}_{k}"] = cb[stub]
    return Codebook(out)


# Row key, base time and the columns that aren't drawn, by dataset; the table, and which of its rows are the second source's.
_ORDER_KEYS = {"hhid": "o_orderkey"}
_PERSON_KEYS = _ORDER_KEYS | {"personid": "CAST(o_orderkey * 100 + 1 AS BIGINT)", "pernum": "1"}
_TIME = "CAST(ts AS TIMESTAMP_NTZ)"
_SHAPES = {
    "households": ("orders", "o_orderkey", "o_orderdate", _ORDER_KEYS, "o_orderstatus = 'P'"),
    "border_trips": ("orders", "o_orderkey", "o_orderdate", _ORDER_KEYS, "o_orderstatus = 'P'"),
    "persons": ("orders", "o_orderkey", "o_orderdate", _PERSON_KEYS, "o_orderstatus = 'P'"),
    "day": ("orders", "o_orderkey", "o_orderdate", _PERSON_KEYS | {"traveldate": "CAST(o_orderdate AS DATE)", "daynum": "CAST(o_orderkey % 7 + 1 AS INT)"}, "o_orderstatus = 'P'"),
    "vehicles": ("lineitem", "(l_orderkey * 10 + l_linenumber)", "l_shipdate", {"hhid": "l_orderkey", "vehnum": "l_linenumber"}, "l_returnflag = 'R'"),
    "intercept": ("customer", "c_custkey", "make_timestamp_ntz(2017, 4, CAST(c_custkey % 28 + 1 AS INT), 8, 0, 0)", {"hhid": "c_custkey"}, "true"),
    "trips": ("events", "event_id", "ts", {
        "tripid": "event_id", "tripid_linked": "event_id", "location_tripid": EV_TRIP_SQL, "personid": "CAST(user_id * 100 + 1 AS BIGINT)", "hhid": "user_id",
        "traveldate": "CAST(ts AS DATE)", "daynum": "CAST(day(ts) AS INT)", "departure_time": _TIME, "arrival_time": f"CAST({_TIME} + INTERVAL 20 MINUTES AS TIMESTAMP_NTZ)",
        "h_complete_weekdays": "CASE WHEN event_id % 9 = 0 THEN CAST(NULL AS INT) ELSE CAST(event_id % 3 AS INT) END"}, "event_type = 'error'"),
    "location": ("events", "event_id", "ts", {
        "tripid": EV_TRIP_SQL, "collected_at": _TIME, "accuracy": "value", "heading": "CAST(event_id % 360 AS DOUBLE)", "speed": "value / CAST('3' AS DOUBLE)",
        "lat": EV_LAT_SQL, "lng": EV_LNG_SQL}, "event_type = 'error'"),
}


def raw_selects(dataset: str, dialect: str) -> dict:
    """{role: (table, condition, expressions)} of a dataset's raw sources; a null in the condition belongs to the main one."""
    spec = load_spec(dataset)
    cb = Codebook.from_spec(spec["codebook"])
    if dataset == "border_trips":
        cb = _border_codebook(cb)
    base, seed, ts, fixed, second = _SHAPES[dataset]
    return {role: (base, f"{'' if role == 'at' else 'NOT '}coalesce({second}, false)", _expressions(seed, ts, src["columns"], fixed, cb, dialect))
            for role, src in spec["sources"].items()}


def raw_sources(spark: SparkSession, sf_dir: str, dataset: str) -> dict:
    """{"main": DataFrame, "at": DataFrame} (intercept: only "at")."""
    return {role: table(spark, sf_dir, base).where(condition).selectExpr(*exprs) for role, (base, condition, exprs) in raw_selects(dataset, "spark").items()}


def survey_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 square zones (EPSG:2230 feet, 40,000 ft side) over the survey region, one per nation key."""
    n = table(spark, sf_dir, "nation")
    side = 40000
    x0 = F.lit(6220000) + (F.col("n_nationkey") % 5) * side
    y0 = F.lit(1770000) + F.floor(F.col("n_nationkey") / 5).cast("int") * side
    wkt = F.format_string("POLYGON ((%d %d, %d %d, %d %d, %d %d, %d %d))",
                          x0, y0, x0 + side, y0, x0 + side, y0 + side, x0, y0 + side, x0, y0)
    return n.select((F.col("n_nationkey") + 1).cast("short").alias("mgra_13"), wkt.alias("wkt"))
