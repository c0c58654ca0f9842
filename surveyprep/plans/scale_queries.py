"""Queries of the operators built for scale, on the driver's test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyprep.operators.codebook import Codebook, field_map
from surveyprep.operators.contract import ColumnSpec, TableContract
from surveyprep.operators.keys import dense_key, load_order_key
from surveyprep.operators.provenance import rule_coverage
from surveyprep.operators.quality import orphans, unlisted_codes, width_offenders
from surveyprep.operators.zones import zone_lookup
from surveyprep.plans.operator_queries import ORACLE, QUERIES, TRIAGE_BASE_SQL, TRIAGE_COLUMNS, register, triage_base, triage_rules, triage_steps
from surveyprep.plans.tables import ISLAND_ZONE_SQL, island_points, island_zones, table
from surveyprep.session import shared_dir
from surveyprep.sinks.loads import load_table, read_refused, read_table
from surveyprep.sources.survey_files import read_survey

__all__ = ["ORACLE", "QUERIES"]


@register("zone_polygons", ISLAND_ZONE_SQL)
def q_zone_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """JON1 / GEO4 / GEO5: zones with holes, of two parts and with shared edges; points on edges and corners too."""
    zones = island_zones(table(spark, sf, "nation"))
    return zone_lookup(island_points(table(spark, sf, "events")), "px", "py", zones, "zone").select("event_id", "px", "py", "zone")


#: Sources of the load, in load order.
LOADS = ["P", "F", "O"]


@register("key_load_order", f"""
SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY list_position({LOADS!r}, o_orderstatus), o_custkey, o_orderkey) - 1 AS load_id
FROM orders WHERE o_orderstatus IN ('P', 'F', 'O')""")
def q_key_load_order(spark: SparkSession, sf: str) -> DataFrame:
    """WIN3: three CSV sources of several files each, numbered in load order without a sort."""
    base, orders, sources = shared_dir(spark, "load-order"), table(spark, sf, "orders"), []
    for status in LOADS:
        path = f"{base}/{status}"
        orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey", "o_orderstatus").repartitionByRange(
            3, "o_custkey", "o_orderkey").sortWithinPartitions("o_custkey", "o_orderkey").write.option("header", True).csv(path)
        sources.append(spark.read.option("header", True).schema("o_orderkey bigint, o_custkey bigint, o_orderstatus string").csv(path))
    return load_order_key(sources, "load_id").select("o_orderkey", "o_orderstatus", "load_id")


@register("key_dense_carry", """
SELECT event_id, event_type, half, CASE WHEN event_type IS NULL OR half IS NULL THEN 0
       ELSE dense_rank() OVER (PARTITION BY (event_type IS NULL OR half IS NULL) ORDER BY event_type, half) END AS type_key
FROM (SELECT event_id, NULLIF(event_type, 'signup') AS event_type, CASE WHEN user_id % 9 <> 0 THEN floor(value / 2) END AS half FROM events)""")
def q_key_dense_carry(spark: SparkSession, sf: str) -> DataFrame:
    """WIN1: few frequent keys, so that most span several ranges; null key part -> 0."""
    e = table(spark, sf, "events").select("event_id", F.nullif("event_type", F.lit("signup")).alias("event_type"),
                                          F.when(F.col("user_id") % 9 != 0, F.floor(F.col("value") / 2).cast("double")).alias("half"))
    return dense_key(e, ["event_type", "half"], "type_key")


# A cell is spoilt by the order's key: text where a number or a date should be, or a missing-value token.
_SPOILT = {"o_custkey": ("o_orderkey % 17 = 0", "n/k"), "o_totalprice": ("o_orderkey % 23 = 0", "12,5O"), "o_orderdate": ("o_orderkey % 29 = 0", "2016-02-31")}


@register("src_reject_ledger", f"""
WITH numbered AS (SELECT *, row_number() OVER (ORDER BY list_position({LOADS!r}, o_orderstatus), o_orderkey % 2, o_orderkey) - 1 AS load_id
                  FROM orders WHERE o_orderstatus IN ('P', 'F', 'O'))
""" + " UNION ALL ".join(f"SELECT o_orderstatus AS source, load_id, '{c}' AS field, '{text}' AS text FROM numbered WHERE {when} AND o_orderkey % 31 <> 0"
                         for c, (when, text) in _SPOILT.items()))
def q_src_reject_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1 / DOM6: CSV files in two column orders, read by their own headers; every cell that isn't of its type, with its place."""
    base, orders = shared_dir(spark, "ledger"), table(spark, sf, "orders")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    text = [F.when(F.col("o_orderkey") % 31 == 0, "NA").when(F.expr(_SPOILT[c][0]), _SPOILT[c][1]).otherwise(F.col(c).cast("string")).alias(c) if c in _SPOILT
            else F.col(c) for c in columns]
    for status in LOADS:
        for odd, order in ((0, columns), (1, columns[::-1])):
            rows = orders.where((F.col("o_orderstatus") == status) & (F.col("o_orderkey") % 2 == odd))
            rows.repartitionByRange(2, "o_orderkey").sortWithinPartitions("o_orderkey").select(*text).select(*order).write.option("header", True).csv(f"{base}/{status}/{odd}")
    spec = {"columns": columns, "types": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "date"}}
    _, ledger = read_survey(spark, {s: f"{base}/{s}" for s in LOADS}, {s: spec for s in LOADS})
    return ledger.select("source", "load_id", "field", "text")


_LINE_CODES = {"l_returnflag": ["A", "N"], "l_linenumber": [1, 2, 3, 4], "l_quantity": list(range(1, 11)), "l_linestatus": ["O", "F"]}


@register("map_unlisted", "\nUNION ALL\n".join(f"""
SELECT '{f}' AS field, CAST(code AS VARCHAR) AS code, n, unlisted FROM (
  SELECT code, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS unlisted
  FROM (SELECT {f if isinstance(codes[0], str) else f'CAST(CAST({f} AS INTEGER) AS VARCHAR)'} AS code FROM lineitem
        WHERE {f} IS NOT NULL AND {f} NOT IN ({', '.join(repr(c) for c in codes)})) GROUP BY code)
WHERE n >= unlisted * 0.024::DOUBLE""" for f, codes in _LINE_CODES.items()))
def q_map_unlisted(spark: SparkSession, sf: str) -> DataFrame:
    """MAP1 / Q5: the frequent codes outside the code lists, for all fields in one scan and one recount."""
    rows = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("int"))
    return unlisted_codes(rows, Codebook({f: field_map([[c, str(c)] for c in codes]) for f, codes in _LINE_CODES.items()}), share=0.024)


_NARROW = TableContract("narrow", (ColumnSpec("p_name", "nvarchar", 9, True), ColumnSpec("p_type", "nvarchar", 5, True), ColumnSpec("p_brand", "nvarchar", 7, True)), ())


@register("dq_width_offenders", "\nUNION ALL\n".join(f"""
SELECT field, "limit", CAST(row_number() OVER (ORDER BY length DESC, label) AS INTEGER) AS rank, length, label, n FROM (
  SELECT '{c.name}' AS field, {c.width} AS "limit", CAST(length({c.name}) AS INTEGER) AS length, {c.name} AS label, count(*) AS n
  FROM part WHERE length({c.name}) > {c.width} GROUP BY {c.name}) QUALIFY rank <= 5""" for c in _NARROW.columns))
def q_dq_width_offenders(spark: SparkSession, sf: str) -> DataFrame:
    """SNK10 / Q6: the longest texts that don't fit their columns, with counts, for all columns in one pass."""
    return width_offenders(table(spark, sf, "part"), _NARROW, 5)


def _coverage_oracle() -> str:
    steps = triage_steps()
    by = {t: f"by_{t}" for _, targets, _, _ in steps for t in targets}
    ctes = [f"s0 AS (SELECT *, {', '.join(f'0 AS {c}' for c in by.values())} FROM ({TRIAGE_BASE_SQL}))"]
    for i, targets, cond, value in steps:
        held = f"COALESCE({cond}, false)"
        new = {t: f"CASE WHEN {held} THEN {value} ELSE {t} END" for t in targets} | {by[t]: f"CASE WHEN {held} THEN {i} ELSE {by[t]} END" for t in targets}
        kept = [*TRIAGE_COLUMNS, *by.values(), *[f"fired_{j}" for j in range(1, i)]]
        ctes.append(f"s{i} AS (SELECT {', '.join(f'{new[c]} AS {c}' if c in new else c for c in kept)}, {held} AS fired_{i} FROM s{i - 1})")
    parts = [f"SELECT {i} AS rule, '{t}' AS target, count(*) FILTER (WHERE fired_{i}) AS fired, count(*) FILTER (WHERE {by[t]} = {i}) AS stood FROM s{len(steps)}"
             for i, targets, _, _ in steps for t in targets]
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(parts)


@register("rule_coverage", _coverage_oracle())
def q_rule_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """FLT1-2 / DOM2: how often each rule of a cascade fired, and how often its value was the last one, in one aggregate."""
    return rule_coverage(triage_base(spark, sf), triage_rules()).select("rule", "target", "fired", "stood")


_ORDER_CONTRACT = TableContract("orders", (ColumnSpec("o_orderkey", "bigint", None, False), ColumnSpec("o_orderpriority", "nvarchar", 10, False),
                                           ColumnSpec("o_totalprice", "int", None, True), ColumnSpec("units", "tinyint", None, True)), ("o_orderkey",))


def _loaded(spark: SparkSession, sf: str) -> str:
    target, o = f"{shared_dir(spark, 'bounded')}/orders", table(spark, sf, "orders").withColumn("units", (F.col("o_custkey") % 300).cast("int"))
    for batch in ("o", "rest", "rest"):  # the last one is a rerun, which adds nothing
        load_table(o.where((F.col("o_orderstatus") == "O") == (batch == "o")), _ORDER_CONTRACT, target, allowed_errors=1 << 40, batch=batch)
    return target


_REFUSED_SQL = "(length(o_orderpriority) > 10 OR o_custkey % 300 > 255)"


@register("load_bounded", f"""
SELECT o_orderkey, o_orderpriority, CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice, CAST(o_custkey % 300 AS SMALLINT) AS units
FROM orders WHERE NOT {_REFUSED_SQL}""")
def q_load_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2 / SNK11 / SNK12: two loads published by manifest, one of them run twice; the rows that the contract takes."""
    return read_table(spark, _ORDER_CONTRACT, _loaded(spark, sf))


@register("load_refused", f"""
SELECT o_orderkey, length(o_orderpriority) > 10 AS too_wide, o_custkey % 300 > 255 AS too_large FROM orders WHERE {_REFUSED_SQL}""")
def q_load_refused(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2 / SNK11: the rows that the loads refused, and why."""
    rows = read_refused(spark, _loaded(spark, sf))
    return rows.select(F.get_json_object("row", "$.o_orderkey").cast("bigint").alias("o_orderkey"), F.array_contains("why", "o_orderpriority: does not fit").alias("too_wide"),
                       F.array_contains("why", "units: does not fit").alias("too_large"))


@register("dq_orphans", """
SELECT l.l_orderkey, l.l_partkey, l.l_linenumber FROM lineitem l
WHERE l.l_orderkey IS NOT NULL AND l.l_partkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_returnflag <> 'R' AND p.l_orderkey = l.l_orderkey AND p.l_partkey = l.l_partkey)""")
def q_dq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """SNK5 / JON6: lines whose (order, part) no line outside the returned ones has; filter first, exact anti-join for what it lets pass."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
    kept = lines.where("l_returnflag <> 'R'").select("l_orderkey", "l_partkey")
    return orphans(lines.drop("l_returnflag"), ["l_orderkey", "l_partkey"], kept, ["l_orderkey", "l_partkey"])
