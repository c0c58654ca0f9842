"""One query per operator of the inventory, run on the driver's test tables.

Each ``q_*`` takes ``(spark, sf_dir)`` and returns a DataFrame built with
the library's operators; ``ORACLE`` holds the equivalent SQL over the same
tables (pre-registered views) for the side-by-side check. Columns are
aliased identically on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyprep.functions import predicates as P
from surveyprep.functions.geo import point_wkt
from surveyprep.operators.codebook import Codebook, apply_codebook, field_map, map_expr, topcode_map
from surveyprep.operators.contract import ColumnSpec, TableContract, conform, dq_columns, dq_key
from surveyprep.operators.keys import add_sentinel, dense_key, row_key
from surveyprep.operators.paths import path_lines
from surveyprep.operators.profile import profile_freq, profile_n
from surveyprep.operators.reshape import drop_all_null, fill_missing, merge_alternates, wide_to_long
from surveyprep.operators.rules import apply_rules, rule
from surveyprep.operators.weights import person_trip_weight, trip_weight
from surveyprep.operators.zones import zone_lookup
from surveyprep.plans.tables import (EV_LAT_SQL, EV_LNG_SQL, EV_TRIP_SQL, MODES_WIDE_SQL, SLOTS, ZONE_POINTS_SQL,
                                     ev_lat, ev_lng, ev_trip, modes_wide, project_sql, square_zones,
                                     table, zone_points)
from surveyprep.session import shared_dir
from surveyprep.sinks.writers import append_table, read_staged, stage_insert, write_delimited
from surveyprep.sources.readers import PANDAS_NA_TOKENS, add_defaults, read_text_csv, read_typed_csv, union_sources

ORACLE: dict[str, str] = {}
QUERIES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- sources

@register("src_csv_typed", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority
FROM orders""")
def q_src_csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1: typed, header-bound read of a CSV hand-off (columns asked in another order)."""
    path = shared_dir(spark, "src_csv_typed")
    o = table(spark, sf, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey",
                                          F.to_date("o_orderdate").alias("o_orderdate"),
                                          "o_custkey", "o_orderstatus")
    o.write.option("header", True).csv(path)
    return read_typed_csv(spark, path,
                          ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
                          {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
                           "o_orderdate": "date"})


@register("src_na_tokens", """
SELECT event_id, CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL
                      ELSE CAST(user_id AS INTEGER) END AS user_code
FROM events""")
def q_src_na_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """SRC2: custom and default NA tokens (" ", "NA", "null") become null before the cast."""
    path = shared_dir(spark, "src_na_tokens")
    ev = table(spark, sf, "events")
    tok = (F.when(F.col("event_type") == "error", F.lit(" "))
           .when(F.col("event_type") == "view", F.lit("NA"))
           .when(F.col("event_type") == "click", F.lit("null"))
           .otherwise(F.col("user_id").cast("string")))
    (ev.select("event_id", tok.alias("user_code")).write.option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_typed_csv(spark, path, ["event_id", "user_code"], {"event_id": "bigint", "user_code": "Int16"},
                          na_tokens=list(PANDAS_NA_TOKENS) + [" "])


@register("src_defaults", """
SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nation_key, s_acctbal AS balance,
       'Not Applicable' AS segment, 99 AS segment_code, s_suppkey AS account_key
FROM supplier""")
def q_src_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """SRC4: constants and a copied column for a source lacking the fields."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nation_key"), F.col("s_acctbal").alias("balance"))
    return add_defaults(s, {"segment": "Not Applicable", "segment_code": 99}, {"account_key": "party_key"})


@register("union_by_name", """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation_key, c_acctbal AS balance,
       c_mktsegment AS segment, CAST(NULL AS INTEGER) AS data_source
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 2 FROM supplier""")
def q_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """SET1: union by name; a main-only column and a default-only column null-fill."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                                            F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation_key"))
    return union_sources([c, add_defaults(s, {"data_source": 2})])


# ---------------------------------------------------------------- sinks

@register("sink_csv_roundtrip", """
SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status, o_totalprice, o_orderdate,
       o_orderpriority || '|' || CAST(o_custkey AS VARCHAR) AS note
FROM orders""")
def q_sink_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK1 + SNK2: pipe-delimited write with blank nulls, typed read back."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), "o_totalprice", "o_orderdate",
        F.concat(F.col("o_orderpriority"), F.lit("|"), F.col("o_custkey").cast("string")).alias("note"))
    path = write_delimited(o, shared_dir(spark, "sink_csv"))
    return read_staged(spark, path, o.schema)


LOAD_CONTRACT = TableContract("events_load", (
    ColumnSpec("event_id", "bigint", None, False),
    ColumnSpec("ts", "smalldatetime", None, False),
    ColumnSpec("event_date", "date", None, False),
    ColumnSpec("value_int", "int", None, True),
    ColumnSpec("value", "float", None, True),
    ColumnSpec("event_type", "nvarchar", 10, False),
), ("event_id",))


@register("load_typed", """
SELECT event_id, date_trunc('minute', ts + INTERVAL 30 SECOND) AS ts, CAST(ts AS DATE) AS event_date,
       CAST(trunc(value) AS INTEGER) AS value_int, value, event_type
FROM events""")
def q_load_typed(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2 + SNK6: staged text -> typed FAILFAST read -> store-assignment casts -> Parquet."""
    ev = table(spark, sf, "events").select("event_id", "ts", F.col("ts").cast("string").alias("event_date"),
                                           F.col("value").alias("value_int"), "value", "event_type")
    stage = write_delimited(ev, shared_dir(spark, "load_typed_stage"))
    staged = read_staged(spark, stage, "event_id bigint, ts timestamp_ntz, event_date string, value_int double, "
                                       "value double, event_type string")
    target = shared_dir(spark, "load_typed_target")
    conform(staged, LOAD_CONTRACT).write.parquet(target)
    return spark.read.parquet(target)


_PX, _PY = project_sql(EV_LNG_SQL, EV_LAT_SQL)


@register("load_stage_insert", f"""
SELECT event_id, printf('POINT (%.3f %.3f)', {_PX}, {_PY}) AS shape, 2230 AS shape_srid,
       date_trunc('minute', ts + INTERVAL 30 SECOND) AS collected_at
FROM events""")
def q_load_stage_insert(spark: SparkSession, sf: str) -> DataFrame:
    """SNK3 / SNK12 / GEO6: stage, SQL transform over a temp view, conformed insert."""
    ev = table(spark, sf, "events").select("event_id", point_wkt(ev_lng(), ev_lat()).alias("shape"),
                                           F.col("ts").alias("collected_at"))
    contract = TableContract("points_stage", (ColumnSpec("event_id", "bigint", None, False),
                                              ColumnSpec("shape", "geometry", None, False),
                                              ColumnSpec("collected_at", "smalldatetime", None, False)), ("event_id",))
    return stage_insert(ev, contract, shared_dir(spark, "stage_insert_target"), shapes={"shape": True})


@register("sink_append", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders""")
def q_sink_append(spark: SparkSession, sf: str) -> DataFrame:
    """SNK4: two appends to one table folder, read back."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    target = shared_dir(spark, "sink_append")
    append_table(o, target)
    append_table(o, target)
    return spark.read.parquet(target)


# ---------------------------------------------------------------- projections / scalars

@register("prj_rename", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
       c_acctbal AS account_balance, c_mktsegment AS market_segment
FROM customer""")
def q_prj_rename(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ1/PRJ2: bulk rename then ordered projection."""
    c = table(spark, sf, "customer").withColumnsRenamed({
        "c_custkey": "customer_id", "c_name": "customer_name", "c_nationkey": "nation_id",
        "c_acctbal": "account_balance", "c_mktsegment": "market_segment"})
    return c.select("customer_id", "customer_name", "nation_id", "account_balance", "market_segment")


@register("strip_delim", "SELECT page_id, replace(html, '|', '') AS html FROM pages")
def q_strip_delim(spark: SparkSession, sf: str) -> DataFrame:
    """SCL1: remove the hand-off delimiter from whole texts."""
    p = table(spark, sf, "pages")
    return p.select("page_id", F.regexp_replace("html", r"\|", "").alias("html"))


@register("fill_missing", """
SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'P'), 'Missing') AS status,
       COALESCE(NULLIF(o_orderpriority, '5-LOW'), 'Missing') AS priority, o_totalprice
FROM orders""")
def q_fill_missing(spark: SparkSession, sf: str) -> DataFrame:
    """FLT10: fill nulls of text columns with "Missing"."""
    o = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                                          F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
                                          "o_totalprice")
    return fill_missing(o, "Missing")


_VISIT_A_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'Missing' ELSE 'Not Applicable' END"
_VISIT_B_SQL = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'No' WHEN '2-HIGH' THEN 'Missing' "
                "WHEN '3-MEDIUM' THEN NULL ELSE 'Yes' END")


@register("merge_alternates", f"""
SELECT o_orderkey, visit_a, visit_b,
       CASE WHEN COALESCE(visit_a IN ('Missing', 'Not Applicable'), false)
                 AND visit_b IS DISTINCT FROM 'Missing' THEN visit_b ELSE visit_a END AS visit
FROM (SELECT o_orderkey, {_VISIT_A_SQL} AS visit_a, {_VISIT_B_SQL} AS visit_b FROM orders)""")
def q_merge_alternates(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ3: prefer the first alternative unless unusable and the second is not Missing."""
    o = table(spark, sf, "orders")
    a = F.when(F.col("o_orderstatus") == "F", "Yes").when(F.col("o_orderstatus") == "O", "Missing") \
         .otherwise("Not Applicable")
    b = (F.when(F.col("o_orderpriority") == "1-URGENT", "No").when(F.col("o_orderpriority") == "2-HIGH", "Missing")
         .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(None).cast("string")).otherwise("Yes"))
    o = o.select("o_orderkey", a.alias("visit_a"), b.alias("visit_b"))
    return o.withColumn("visit", merge_alternates("visit_a", "visit_b"))


# ---------------------------------------------------------------- code maps

LINE_MAP = field_map([(1, "One"), (2, "Two"), (3, "Three"), (4, "Four"), (5, "Five"), (97, "Other")])
TOLL_MAP = field_map([(0, "Yes"), (1, "No")])


@register("map_codes", """
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber WHEN 1 THEN 'One' WHEN 2 THEN 'Two' WHEN 3 THEN 'Three' WHEN 4 THEN 'Four'
                         WHEN 5 THEN 'Five' WHEN 97 THEN 'Other' END AS line_label,
       CASE CAST(l_orderkey % 2 AS INTEGER) WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS toll_label
FROM lineitem""")
def q_map_codes(spark: SparkSession, sf: str) -> DataFrame:
    """MAP1 + MAP6: exhaustive map (unlisted -> null) and a reversed boolean map."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             (F.col("l_orderkey") % 2).cast("int").alias("toll"))
    cb = Codebook({"l_linenumber": LINE_MAP, "toll": TOLL_MAP})
    return li.select("l_orderkey", "l_linenumber", map_expr("l_linenumber", cb["l_linenumber"]).alias("line_label"),
                     map_expr("toll", cb["toll"]).alias("toll_label"))


STATUS_MAP = field_map([(1, "Finished"), (2, "Open")], null_label="Missing")


@register("map_null_label", """
SELECT o_orderkey, status_code,
       CASE WHEN status_code IS NULL THEN 'Missing' WHEN status_code = 1 THEN 'Finished'
            WHEN status_code = 2 THEN 'Open' END AS status
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 3 END AS status_code FROM orders)""")
def q_map_null_label(spark: SparkSession, sf: str) -> DataFrame:
    """MAP2: null code -> null label; unlisted code (3) -> null."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 3).alias("status_code"))
    return o.withColumn("status", map_expr("status_code", STATUS_MAP))


QTY_MAP = topcode_map(0, 12, null_label="Missing")


@register("map_topcode", """
SELECT l_orderkey, l_linenumber, qty_code,
       CASE WHEN qty_code IS NULL THEN 'Missing' WHEN qty_code BETWEEN 0 AND 11 THEN CAST(qty_code AS VARCHAR)
            WHEN qty_code = 12 THEN '12+' END AS qty_label
FROM (SELECT l_orderkey, l_linenumber, CAST(NULLIF(l_quantity, 50.0) AS INTEGER) AS qty_code FROM lineitem)""")
def q_map_topcode(spark: SparkSession, sf: str) -> DataFrame:
    """MAP3/MAP4 + SCL2: generated count labels with a top code; above-top -> null."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             F.nullif("l_quantity", F.lit(50.0)).cast("int").alias("qty_code"))
    return li.withColumn("qty_label", map_expr("qty_code", QTY_MAP))


SEGMENT_MAP = field_map([("AUTOMOBILE", "AUTOMOBILE"), ("BUILDING", "BUILDING"), ("MACHINERY", "MACHINERY")])


@register("map_whitelist", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN c_mktsegment END AS segment
FROM customer""")
def q_map_whitelist(spark: SparkSession, sf: str) -> DataFrame:
    """MAP5: text -> text whitelist."""
    c = table(spark, sf, "customer")
    return c.select("c_custkey", map_expr("c_mktsegment", SEGMENT_MAP).alias("segment"))


# ---------------------------------------------------------------- predicates and rules

@register("pred_null_safe", """
SELECT o_orderkey, status,
       status IS NOT DISTINCT FROM 'F' AS is_f,
       status IS DISTINCT FROM 'F' AS not_f,
       COALESCE(status IN ('F', 'O'), false) AS in_fo,
       NOT COALESCE(status IN ('F'), false) AS not_in_f,
       COALESCE(price > 200000.0, false) AS price_gt,
       status IS NULL AS status_null
FROM (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status,
             CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS price FROM orders)""")
def q_pred_null_safe(spark: SparkSession, sf: str) -> DataFrame:
    """FLT3-6: pandas-style two-valued predicates on nullable columns."""
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_totalprice")).alias("price"))
    return o.select("o_orderkey", "status", P.eq("status", "F").alias("is_f"), P.ne("status", "F").alias("not_f"),
                    P.is_in("status", ["F", "O"]).alias("in_fo"), P.not_in("status", ["F"]).alias("not_in_f"),
                    P.gt("price", 200000.0).alias("price_gt"), P.is_null("status").alias("status_null"))


# A cascade over the orders: (condition, its columns, targets, value, the condition in SQL, the value in SQL).
# Later rules read what earlier ones set, overwrite them, set two columns at once, copy a column and clear one.

_TOTAL, _STATUS, _URGENCY = "o_totalprice", "o_orderstatus", "o_orderpriority"
_TRIAGE = [
    (lambda: P.gt(_TOTAL, 300000.0), [_TOTAL], ["lane"], "Review", "o_totalprice > 300000.0", "'Review'"),
    (lambda: P.eq(_STATUS, "F"), [_STATUS], ["lane", "due"], "Closed", "o_orderstatus IS NOT DISTINCT FROM 'F'", "'Closed'"),
    (lambda: P.ne(_STATUS, "F") & P.is_in(_URGENCY, ["1-URGENT", "2-HIGH"]), [_STATUS, _URGENCY], ["due"], "Today",
     "o_orderstatus IS DISTINCT FROM 'F' AND COALESCE(o_orderpriority IN ('1-URGENT', '2-HIGH'), false)", "'Today'"),
    (lambda: P.is_null("due") & P.ge(_TOTAL, 100000.0), ["due", _TOTAL], ["due"], "This week", "due IS NULL AND o_totalprice >= 100000.0", "'This week'"),
    (lambda: P.is_null("lane"), ["lane", _URGENCY], ["lane"], lambda: F.col(_URGENCY), "lane IS NULL", "o_orderpriority"),
    (lambda: P.eq("lane", "Review") & P.eq("due", "Today"), ["lane", "due"], ["lane"], "Escalated", "lane = 'Review' AND due = 'Today'", "'Escalated'"),
    (lambda: P.not_in("lane", ["Review", "Escalated"]), ["lane"], ["checker"], None, "NOT COALESCE(lane IN ('Review', 'Escalated'), false)", "NULL"),
    (lambda: P.is_null("due"), ["due"], ["due", "checker"], "None", "due IS NULL", "'None'"),
]


TRIAGE_COLUMNS = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "lane", "due", "checker"]
TRIAGE_BASE_SQL = """SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority,
        CASE WHEN o_custkey % 6 <> 0 THEN o_totalprice END AS o_totalprice, CAST(NULL AS VARCHAR) AS lane, CAST(NULL AS VARCHAR) AS due,
        'Team ' || CAST(o_custkey % 4 AS VARCHAR) AS checker FROM orders"""


def triage_steps() -> list[tuple]:
    """(number, targets, condition, value) of the cascade in SQL."""
    return [(i, targets, cond, value) for i, (_, _, targets, _, cond, value) in enumerate(_TRIAGE, 1)]


def triage_rules() -> list:
    return [rule(cond(), targets, value() if callable(value) else value, reads=reads) for cond, reads, targets, value, *_ in _TRIAGE]


def triage_base(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_custkey") % 6 != 0, F.col("o_totalprice")).alias("o_totalprice"), F.lit(None).cast("string").alias("lane"),
        F.lit(None).cast("string").alias("due"), F.concat(F.lit("Team "), (F.col("o_custkey") % 4).cast("string")).alias("checker"))


def _triage_oracle() -> str:
    ctes = [f"s0 AS ({TRIAGE_BASE_SQL})"]
    for i, targets, cond, value in triage_steps():
        sel = ", ".join(f"CASE WHEN COALESCE({cond}, false) THEN {value} ELSE {c} END AS {c}" if c in targets else c for c in TRIAGE_COLUMNS)
        ctes.append(f"s{i} AS (SELECT {sel} FROM s{i - 1})")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT * FROM s{len(ctes) - 1}"


@register("recode_rules", _triage_oracle())
def q_recode_rules(spark: SparkSession, sf: str) -> DataFrame:
    """FLT1/FLT2/FLT6/FLT7: ordered cascade, staged into few projections."""
    return apply_rules(triage_base(spark, sf), triage_rules())


_TRANSIT, _AUTO, _AIR = [1, 2, 3], [4, 5], [9]


def _in_any_sql(values) -> str:
    vals = ", ".join(str(v) for v in values)
    return "(" + " OR ".join(f"COALESCE(mode_{k} IN ({vals}), false)" for k in SLOTS) + ")"


@register("multi_response_all", f"""
SELECT l_orderkey, copy, {', '.join(f'mode_{k}' for k in SLOTS)},
       NOT {_in_any_sql(_TRANSIT)} AS no_transit,
       NOT {_in_any_sql(_AUTO)} AS no_auto,
       CASE WHEN NOT {_in_any_sql(_AIR)} THEN 'Not Applicable' ELSE 'Asked' END AS airtype
FROM ({MODES_WIDE_SQL})""")
def q_multi_response(spark: SparkSession, sf: str) -> DataFrame:
    """FLT8 / DOM7: "no one of the mode slots is in the set", nulls ignored; every line of every order."""
    w = modes_wide(table(spark, sf, "lineitem"))
    modes = [f"mode_{k}" for k in SLOTS]
    return w.select("l_orderkey", "copy", *modes, P.none_in(modes, _TRANSIT).alias("no_transit"),
                    P.none_in(modes, _AUTO).alias("no_auto"),
                    F.when(P.none_in(modes, _AIR), "Not Applicable").otherwise("Asked").alias("airtype"))


@register("wide_to_long_all", " UNION ALL ".join(
    f"SELECT l_orderkey, copy, {k} AS slot, mode_{k} AS mode, ext_{k} AS ext FROM ({MODES_WIDE_SQL}) "
    f"WHERE NOT (mode_{k} IS NULL AND ext_{k} IS NULL)" for k in SLOTS))
def q_wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    """RSH1 + FLT9: two stubs x seven slots to rows; all-null rows dropped; one row for each line of the table."""
    w = modes_wide(table(spark, sf, "lineitem"))
    long = wide_to_long(w, ["mode", "ext"], ["l_orderkey", "copy"], "slot", SLOTS, validate=True)
    return drop_all_null(long, ["mode", "ext"])


# ---------------------------------------------------------------- keys

@register("key_dense_rank", """
SELECT l_orderkey, line, CASE WHEN l_orderkey IS NULL OR line IS NULL THEN 0
       ELSE dense_rank() OVER (PARTITION BY (l_orderkey IS NULL OR line IS NULL) ORDER BY l_orderkey, line) END
       AS line_key
FROM (SELECT l_orderkey, NULLIF(l_linenumber, 7) AS line FROM lineitem)""")
def q_key_dense_rank(spark: SparkSession, sf: str) -> DataFrame:
    """WIN1: 1-based dense key over (orderkey, line); null key part -> 0 (ranged scale form)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", F.nullif("l_linenumber", F.lit(7)).alias("line"))
    return dense_key(li, ["l_orderkey", "line"], "line_key")


@register("key_row_number", """
SELECT event_id, user_id, ts, row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS point_id FROM events""")
def q_key_row_number(spark: SparkSession, sf: str) -> DataFrame:
    """WIN2/SRT1: 0-based row number in (user, time, id) order (ranged scale form)."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return row_key(ev, ["user_id", "ts", "event_id"], "point_id", start=0)


@register("sentinel_row", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT 0, 'Not Applicable', NULL""")
def q_sentinel_row(spark: SparkSession, sf: str) -> DataFrame:
    """SNK5: one sentinel row (key 0) for non-matching keys."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return add_sentinel(o, {"o_orderkey": 0, "o_orderstatus": "Not Applicable"})


# ---------------------------------------------------------------- profiles

_EVENT_TYPES = ["signup", "view", "purchase", "error"]


def _profile_base(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select("event_id", "user_id", F.nullif("event_type", F.lit("click")).alias("event_type"),
                     F.when(F.col("value") > 40, F.lit(None)).otherwise(F.col("value")).alias("value"))


@register("profile_n", """
WITH b AS (SELECT event_id, user_id, NULLIF(event_type, 'click') AS event_type,
                  CASE WHEN value > 40 THEN NULL ELSE value END AS value FROM events),
c AS (
  SELECT 'event_id' AS field, 0 AS position, count(event_id) AS n, count(*) - count(event_id) AS missing FROM b
  UNION ALL SELECT 'user_id', 1, count(user_id), count(*) - count(user_id) FROM b
  UNION ALL SELECT 'event_type', 2, count(event_type) - count(*) FILTER (WHERE event_type = 'error'),
                   count(*) - count(event_type) + count(*) FILTER (WHERE event_type = 'error') FROM b
  UNION ALL SELECT 'value', 3, count(value), count(*) - count(value) FROM b)
SELECT field, position, n, missing,
       round_even(100.0::DOUBLE * missing / CAST(n + missing AS DOUBLE), 1) AS pct_missing FROM c""")
def q_profile_n(spark: SparkSession, sf: str) -> DataFrame:
    """AGG1/AGG3/AGG6/SCL5: valid / missing per column; user-missing labels count for coded columns."""
    return profile_n(_profile_base(spark, sf), categorical=["event_type"], user_missing=["error"])


def _freq_oracle() -> str:
    dom = " UNION ALL ".join(f"SELECT 'event_type' AS field, '{lab}' AS label, {i} AS ordinal"
                             for i, lab in enumerate(_EVENT_TYPES))
    dom += " UNION ALL " + " UNION ALL ".join(f"SELECT 'status', '{lab}', {i}"
                                              for i, lab in enumerate(["Finished", "Open", "Missing"]))
    return f"""
WITH b AS (SELECT NULLIF(event_type, 'click') AS event_type FROM events),
s AS (SELECT CASE WHEN c IS NULL THEN 'Missing' WHEN c = 1 THEN 'Finished' WHEN c = 2 THEN 'Open' END AS status
      FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 3 END AS c FROM orders)),
cnt AS (SELECT 'event_type' AS field, event_type AS label, count(*) AS n FROM b WHERE event_type IS NOT NULL GROUP BY 2
        UNION ALL SELECT 'status', status, count(*) FROM s WHERE status IS NOT NULL GROUP BY 2),
tot AS (SELECT field, sum(n) AS nn FROM cnt GROUP BY field),
dom AS ({dom})
SELECT d.field, d.label, d.ordinal, CAST(COALESCE(c.n, 0) AS BIGINT) AS count,
       round_even(100.0::DOUBLE * COALESCE(c.n, 0) / CAST(t.nn AS DOUBLE), 1) AS pct
FROM dom d LEFT JOIN cnt c ON d.field = c.field AND d.label = c.label LEFT JOIN tot t ON d.field = t.field"""


@register("profile_freq", _freq_oracle())
def q_profile_freq(spark: SparkSession, sf: str) -> DataFrame:
    """AGG2/AGG3/JON5/WIN4/MAP7: category counts in codebook order, zero counts kept.

    Two coded columns of different lengths are profiled together, so they
    are placed side by side in one frame by unioning single-column frames.
    """
    ev = table(spark, sf, "events").select(F.nullif("event_type", F.lit("click")).alias("event_type"))
    o = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 3).alias("c"))
    st = o.select(map_expr("c", STATUS_MAP).alias("status"))
    both = union_sources([ev, st])
    return profile_freq(both, {"event_type": _EVENT_TYPES, "status": STATUS_MAP.categories()})


# ---------------------------------------------------------------- geo

@register("project_points", f"""
SELECT event_id, {EV_LNG_SQL} AS longitude, {EV_LAT_SQL} AS latitude,
       printf('POINT (%.3f %.3f)', {_PX}, {_PY}) AS shape
FROM events""")
def q_project_points(spark: SparkSession, sf: str) -> DataFrame:
    """GEO1/SCL8: lng/lat -> EPSG:2230 feet as POINT WKT (Column math, no UDF)."""
    ev = table(spark, sf, "events").select("event_id", ev_lng().alias("longitude"), ev_lat().alias("latitude"))
    return ev.withColumn("shape", point_wkt("longitude", "latitude"))


def _lines_oracle() -> str:
    x, y = project_sql("lng", "lat")
    return f"""
WITH p AS (SELECT {EV_TRIP_SQL} AS trip_id_location, ts, event_id, {EV_LNG_SQL} AS lng, {EV_LAT_SQL} AS lat
           FROM events),
f AS (SELECT *, row_number() OVER (PARTITION BY trip_id_location, lng, lat ORDER BY ts, event_id) AS k FROM p),
v AS (SELECT trip_id_location, ts, event_id, printf('%.3f %.3f', {x}, {y}) AS txt FROM f WHERE k = 1)
SELECT trip_id_location,
       CASE WHEN count(*) >= 2 THEN 'LINESTRING (' || string_agg(txt, ', ' ORDER BY ts, event_id) || ')'
            ELSE 'POINT (' || string_agg(txt, ', ' ORDER BY ts, event_id) || ')' END AS shape
FROM v GROUP BY trip_id_location"""


def _event_pings(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select(ev_trip().alias("trip_id_location"), "ts", "event_id", ev_lng().alias("lng"), ev_lat().alias("lat"))


@register("path_lines", _lines_oracle())
def q_path_lines(spark: SparkSession, sf: str) -> DataFrame:
    """AGG4/GEO2/GEO3/SRT2: ordered pings -> de-duplicated LINESTRING / POINT per trip."""
    return path_lines(_event_pings(spark, sf), "trip_id_location", ["ts", "event_id"], "lng", "lat")


@register("trip_path_join", f"""
WITH t AS (SELECT {EV_TRIP_SQL} AS trip_id_location, count(*) AS n_pings, min(ts) AS departure_time
           FROM events GROUP BY 1),
l AS ({_lines_oracle()})
SELECT t.trip_id_location, t.n_pings, t.departure_time, l.shape FROM t LEFT JOIN l USING (trip_id_location)""")
def q_trip_path_join(spark: SparkSession, sf: str) -> DataFrame:
    """JON6: trips joined to their path by ``trip_id_location``."""
    pings = _event_pings(spark, sf)
    trips = pings.groupBy("trip_id_location").agg(F.count(F.lit(1)).alias("n_pings"),
                                                  F.min("ts").alias("departure_time"))
    lines = path_lines(pings, "trip_id_location", ["ts", "event_id"], "lng", "lat")
    return trips.join(lines, "trip_id_location", "left")


@register("zone_lookup", f"""
WITH p AS ({ZONE_POINTS_SQL})
SELECT p.event_id, p.px, p.py, CAST(min(n.n_nationkey) AS SMALLINT) AS zone
FROM p LEFT JOIN nation n
  ON p.px BETWEEN CAST(n.n_nationkey % 5 AS DOUBLE) AND CAST(n.n_nationkey % 5 + 1 AS DOUBLE)
 AND p.py BETWEEN CAST(n.n_nationkey // 5 AS DOUBLE) AND CAST(n.n_nationkey // 5 + 1 AS DOUBLE)
GROUP BY p.event_id, p.px, p.py""")
def q_zone_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """SRC3 + GEO4/GEO5 + JON1-5: zone polygons read from two CSV parts; grid join, exact
    boundary-inclusive refine, lowest zone on shared edges."""
    zones = square_zones(table(spark, sf, "nation"))
    base = shared_dir(spark, "zones")
    parts = [f"{base}/part_1", f"{base}/part_2"]
    zones.where(F.col("n_regionkey") < 2).select("zone_id", "wkt").write.option("header", True).csv(parts[0])
    zones.where(F.col("n_regionkey") >= 2).select("zone_id", "wkt").write.option("header", True).csv(parts[1])
    z = read_typed_csv(spark, parts, ["zone_id", "wkt"], {"zone_id": "Int16"})
    pts = zone_points(table(spark, sf, "events"))
    return zone_lookup(pts, "px", "py", z, "zone", cell=1.0).select("event_id", "px", "py", "zone")


# ---------------------------------------------------------------- weights and store assignment

@register("trip_weights", """
SELECT l_orderkey, l_linenumber, weekdays, travelers_hh,
       CASE WHEN COALESCE(weekdays >= 1, false) THEN 1.0::DOUBLE END AS weight_person_trip,
       CASE WHEN COALESCE(weekdays >= 1, false) THEN
            CASE WHEN COALESCE(travelers_hh BETWEEN 1 AND 10, false) THEN 1.0::DOUBLE / CAST(travelers_hh AS DOUBLE)
                 ELSE 1.0::DOUBLE END END AS weight_trip
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_quantity > 45 THEN NULL ELSE CAST(l_quantity AS INTEGER) % 3 END AS weekdays,
             CASE WHEN l_linenumber = 7 THEN -9998 ELSE l_linenumber * 2 - 1 END AS travelers_hh FROM lineitem)""")
def q_trip_weights(spark: SparkSession, sf: str) -> DataFrame:
    """DOM1/FLT5/SCL3/SCL4: trip weights on numeric codes."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_quantity") > 45, F.lit(None)).otherwise(F.col("l_quantity").cast("int") % 3).alias("weekdays"),
        F.when(F.col("l_linenumber") == 7, F.lit(-9998)).otherwise(F.col("l_linenumber") * 2 - 1).alias("travelers_hh"))
    return li.withColumns({"weight_person_trip": person_trip_weight("weekdays"),
                           "weight_trip": trip_weight("weekdays", "travelers_hh")})


@register("store_assign", """
SELECT event_id, date_trunc('minute', ts + INTERVAL 30 SECOND) AS ts_minute,
       CAST(trunc(value) AS INTEGER) AS value_int, CAST(ts AS DATE) AS event_date
FROM events""")
def q_store_assign(spark: SparkSession, sf: str) -> DataFrame:
    """SNK6/SCL7: smalldatetime minute rounding, float -> int truncation, text/timestamp -> date."""
    ev = table(spark, sf, "events").select("event_id", F.col("ts").alias("ts_minute"), F.col("value").alias("value_int"), F.col("ts").alias("event_date"))
    return conform(ev, TableContract("stored", (ColumnSpec("event_id", "bigint", None, False), ColumnSpec("ts_minute", "smalldatetime", None, True),
                                                ColumnSpec("value_int", "int", None, True), ColumnSpec("event_date", "date", None, True)), ("event_id",)))


@register("store_assign_kinds", """
SELECT l_orderkey, l_linenumber, CAST(l_linenumber * 30 AS SMALLINT) AS small, CAST(trunc(-l_extendedprice) AS BIGINT) AS whole,
       CAST(trunc(l_extendedprice) AS INTEGER) AS from_text, CAST(l_discount AS DOUBLE) AS share, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS shipped
FROM lineitem""")
def q_store_assign_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """SNK6: tinyint, bigint from a negative fraction, int from text, float, text and date as the target stores them."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") * 30).alias("small"), (-F.col("l_extendedprice")).alias("whole"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("from_text"), F.col("l_discount").alias("share"), F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").alias("shipped"))
    kinds = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("small", "tinyint"), ("whole", "bigint"), ("from_text", "int"), ("share", "float"), ("flag", "nvarchar"), ("shipped", "date")]
    return conform(li, TableContract("kinds", tuple(ColumnSpec(n, k, None, True) for n, k in kinds), ()))


# ---------------------------------------------------------------- data-quality checks

ORDERS_CONTRACT = TableContract("orders_clean", (
    ColumnSpec("o_orderkey", "bigint", None, False),
    ColumnSpec("status", "nvarchar", 1, False),
    ColumnSpec("o_orderpriority", "nvarchar", 8, False),
    ColumnSpec("o_totalprice", "float", None, True),
), ("o_orderkey",), (("o_custkey", "o_orderdate"),))


def _orders_clean(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority",
                    "o_totalprice", "o_custkey", "o_orderdate")


_ORDERS_CLEAN_SQL = ("SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status, o_orderpriority, o_totalprice, "
                     "o_custkey, o_orderdate FROM orders")


def _dq_renamed(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"check": "check_name", "limit": "width_limit"})


@register("dq_not_null", f"""
WITH b AS ({_ORDERS_CLEAN_SQL})
SELECT 'o_orderkey' AS field, 'not_null' AS check_name, CAST(NULL AS INTEGER) AS width_limit,
       count(*) FILTER (WHERE o_orderkey IS NULL) AS violations, CAST(NULL AS INTEGER) AS max_length FROM b
UNION ALL SELECT 'status', 'not_null', NULL, count(*) FILTER (WHERE status IS NULL), NULL FROM b
UNION ALL SELECT 'o_orderpriority', 'not_null', NULL, count(*) FILTER (WHERE o_orderpriority IS NULL), NULL FROM b""")
def q_dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    """SNK7: NOT NULL violations per column (same single pass as the width check)."""
    r = _dq_renamed(dq_columns(_orders_clean(spark, sf), ORDERS_CONTRACT))
    return r.where(F.col("check_name") == "not_null")


@register("dq_width", f"""
WITH b AS ({_ORDERS_CLEAN_SQL})
SELECT 'status' AS field, 'width' AS check_name, 1 AS width_limit,
       count(*) FILTER (WHERE length(status) > 1) AS violations, CAST(max(length(status)) AS INTEGER) AS max_length
FROM b
UNION ALL SELECT 'o_orderpriority', 'width', 8, count(*) FILTER (WHERE length(o_orderpriority) > 8),
                 CAST(max(length(o_orderpriority)) AS INTEGER) FROM b""")
def q_dq_width(spark: SparkSession, sf: str) -> DataFrame:
    """SNK10: text width report (never truncates)."""
    r = _dq_renamed(dq_columns(_orders_clean(spark, sf), ORDERS_CONTRACT))
    return r.where(F.col("check_name") == "width")


@register("dq_primary_key", """
SELECT l_orderkey, l_linenumber, count(*) AS rows, 'primary_key' AS check_name
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def q_dq_primary_key(spark: SparkSession, sf: str) -> DataFrame:
    """SNK8: duplicate / null primary-key values."""
    li = table(spark, sf, "lineitem")
    return dq_key(li, ["l_orderkey", "l_linenumber"], "primary_key").withColumnRenamed("check", "check_name")


@register("dq_unique", """
SELECT o_custkey, o_orderdate, count(*) AS rows, 'unique' AS check_name
FROM orders GROUP BY o_custkey, o_orderdate
HAVING count(*) > 1 OR o_custkey IS NULL OR o_orderdate IS NULL""")
def q_dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    """SNK9: composite unique-key violations."""
    o = table(spark, sf, "orders")
    return dq_key(o, ["o_custkey", "o_orderdate"], "unique").withColumnRenamed("check", "check_name")
