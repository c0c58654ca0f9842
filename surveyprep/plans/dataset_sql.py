"""The survey datasets in SQL: what the builders' results are held against.

Written from the survey's code lists and column lists (fixed values, read from
``data/*.json``) and its rules, one SQL step per rule; nothing of the builders'
operators is used. ``*`` and ``REPLACE`` are the oracle engine's.
"""

from __future__ import annotations

from surveyprep.operators.codebook import load_spec
from surveyprep.operators.contract import load_contracts
from surveyprep.plans import survey_rules as R
from surveyprep.plans.raw_inputs import raw_selects
from surveyprep.plans.tables import project_sql

NA, MS = "'Not Applicable'", "'Missing'"


def q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else str(value)


def eq(c: str, v) -> str:
    return f"{c} IS NOT DISTINCT FROM {q(v)}"


def ne(c: str, v) -> str:
    return f"{c} IS DISTINCT FROM {q(v)}"


def among(c: str, values) -> str:
    return f"COALESCE({c} IN ({', '.join(q(v) for v in values)}), false)"


def not_among(c: str, values) -> str:
    return f"NOT {among(c, values)}"


def no_mode(values) -> str:
    return "NOT (" + " OR ".join(among(m, values) for m in R.MODES) + ")"


# (condition, targets, value) in order. Column groups and labels are the survey's fixed values.
DAY = [
    ("num_trips > 0", ["trips_yesno"], "'Yes'"),
    ("num_trips = 0", ["trips_yesno"], "'No'"),
    ("num_trips = 0 AND notravel IS NULL", ["notravel"], MS),
    ("num_trips > 0 AND notravel IS NULL", ["notravel"], NA),
    (f"{ne('notravel', 'Other reason')} AND {ne('notravel_secondary', 'Other reason')}", ["notravel_other"], NA),
    (f"({eq('notravel', 'Other reason')} OR {eq('notravel_secondary', 'Other reason')}) AND notravel_other IS NULL", ["notravel_other"], MS),
    (eq("data_source", "rMove"), ["loc_start", "loc_start_other", "loc_end", "loc_end_other"], NA),
    (f"{eq('data_source', 'Online')} AND loc_start IS NULL", ["loc_start"], MS),
    (f"{eq('data_source', 'Online')} AND loc_end IS NULL", ["loc_end"], MS),
    (f"{eq('data_source', 'Online')} AND {ne('loc_start', 'Other')}", ["loc_start_other"], NA),
    (f"{eq('data_source', 'Online')} AND {ne('loc_end', 'Other')}", ["loc_end_other"], NA),
]
HOUSEHOLDS = [
    (eq("hhgroup", "Group 3: Online diary only"), ["num_rmove_participants"], NA),
    (ne("language_pref", "Other"), ["language_pref_other"], NA),
    (eq("tool_other", "No"), ["tool_other_specify"], NA),
]
_CHILD = ["Under 5 years old", "5-15 years"]
_COMMUTE = ["commute_mode", "work_flex", "work_park_pay", "work_park_cost_dk", "work_park_ease"]
PERSONS = [
    (among("age", _CHILD), R.PERSON_AGE16_COLUMNS, NA),
    (ne("age", "16-17 years"), ["child_smartphone"], NA),
    (among("age", [*_CHILD, "16-17 years"]), ["student", "education", "physical_activity"], NA),
    (eq("employment", "Not currently employed"), R.NOT_EMPLOYED_COLUMNS, NA),
    ("secondwork_address IS NULL", ["secondwork_address"], NA),
    (eq("ethnicity_prefernot", "Yes"), R.ETHNICITY_COLUMNS, NA),
    (among("transit_freq", ["1-3 days per month", "Less than monthly", "Never"]), ["transitpass"], NA),
    ("secondschool_address IS NULL", ["secondschool_address"], NA),
    (among("schooltype", R.HOME_SCHOOL_TYPES), ["mainschool_address", "secondschool_address", "school_freq", "other_school", "school_mode"], NA),
    (eq("school_freq", "Never, only takes online classes"), ["school_mode"], NA),
    (ne("schooltype", "Daycare outside home"), ["daycare_early", "daycare_late"], NA),
    (among("military", R.ACTIVE_DUTY), R.WORK_DETAIL_COLUMNS, NA),
    (eq("job_type", R.WORK_AT_HOME), ["telecommute_freq"], NA),
    (among("job_type", [R.WORK_AT_HOME, R.TRAVEL_FOR_LIVING]), ["commute_freq"], NA),
    (among("commute_freq", ["Never", "Not Applicable"]), [*_COMMUTE, *R.COMMUTE_SUBSIDY_COLUMNS], NA),
    (among("commute_subsidy_other", ["No", "Not Applicable"]), ["commute_subsidy_specify"], NA),
    (not_among("commute_mode", R.PRIVATE_VEHICLE_COMMUTE), ["work_park_pay", "work_park_cost_dk", "work_park_ease"], NA),
    (ne("secondhome", "Yes"), ["secondhome_address"], NA),
    (eq("rmove_participant", "Yes"), ["callcenter_diary", "mobile_diary"], NA),
    (among("smartphone_type", R.NO_SMARTPHONE_AGE), ["smartphone_age"], NA),
    ("mainschool_address IS NULL", ["mainschool_address"], MS),
    ("work_address IS NULL", ["work_address"], MS),
]
TRIPS = [(f"{c} IS NULL", [c], MS) for c in R.TRIP_MISSING_COLUMNS] + [
    (eq("data_source", "rMove"), R.TRIP_ONLINE_ONLY, NA),
    (eq("data_source", "Online"), R.TRIP_RMOVE_ONLY, NA),
    (eq("data_source", "Online"), ["location_tripid"], "0"),
    (not_among("o_purpose", ["Other", "Other purpose"]), ["o_purpose_other"], NA),
    (not_among("d_purpose", ["Other", "Other purpose"]), ["d_purpose_other"], NA),
    (no_mode(["Vanpool", "Bus", *R.TRANSIT_MODES_TAIL]), ["transit_access", "transit_egress"], NA),
    (no_mode([*R.AUTO_NONTAXI_MODES, *R.TAXI_MODES]), ["toll_no", "toll_express"], NA),
    (no_mode(R.AUTO_NONTAXI_MODES), ["driver", "parklocation"], NA),
    (not_among("parklocation", R.PARKED_LOCATIONS), ["parktype"], NA),
    (not_among("parktype", R.PAID_PARKING), ["park_cost_dk"], NA),
    (ne("parklocation", "Park & Ride lot"), ["parkride_lot", "parkride_city"], NA),
    (no_mode(R.TAXI_MODES), ["taxitype"], NA),
    (not_among("taxitype", R.PAID_TAXI), ["taxi_cost_dk"], NA),
    (no_mode(["Airplane"]), ["airtype"], NA),
    (not_among("airtype", R.PAID_AIR), ["airfare_cost_dk"], NA),
    (no_mode(R.BUS_MODES), ["bustype"], NA),
    (ne("bustype", R.CASH_FARE), ["bus_cost_dk"], NA),
    (no_mode(R.RAIL_MODES), ["railtype"], NA),
    (ne("railtype", R.CASH_FARE), ["rail_cost_dk"], NA),
    (no_mode(["Ferry or water taxi"]), ["ferrytype"], NA),
    (ne("ferrytype", R.CASH_FARE), ["ferry_cost_dk"], NA),
]
RULES = {"day": DAY, "households": HOUSEHOLDS, "persons": PERSONS, "trips": TRIPS}


def labels(field: dict) -> list[tuple]:
    """[(code, label as text)] of a code list; a count range is its own numbers."""
    out = []
    for e in field["codes"]:
        if isinstance(e, dict):
            out += [(k, str(k)) for k in range(*e["count_range"])]
        else:
            out.append((e[0], None if e[1] is None else str(e[1])))
    return out


def label_case(column: str, field: dict) -> str:
    known = {code: label for code, label in labels(field)}
    cases = " ".join(f"WHEN {column} = {q(code)} THEN {q(label)}" for code, label in known.items())
    missing = f"WHEN {column} IS NULL THEN {q(field['null_label'])} " if "null_label" in field else ""
    return f"CAST(CASE {missing}{cases} END AS VARCHAR)" if missing or cases else "CAST(NULL AS VARCHAR)"


def raw_union(name: str, constants: dict, copies: dict) -> tuple[str, list[str]]:
    """(SQL, columns) of both raw sources, the second with its constants and copies, put together by name."""
    spec, raw = load_spec(name)["sources"], raw_selects(name, "duckdb")
    columns, parts = [], []
    for role in ("main", "at"):
        if role not in raw:
            continue
        base, condition, exprs = raw[role]
        own, text = list(spec[role]["columns"]), ", ".join(exprs)
        inner = f"SELECT {text} FROM {base} WHERE {condition}"
        if role == "at" and (constants or copies):
            extra = {**{c: q(v) for c, v in constants.items()}, **copies}
            kept = [c for c in own if c not in extra]
            inner = f"SELECT {', '.join(kept + [f'{v} AS {c}' for c, v in extra.items()])} FROM ({inner})"
            own = kept + list(extra)
        columns += [c for c in own if c not in columns]
        parts.append(inner)
    return " UNION ALL BY NAME ".join(f"({p})" for p in parts), columns


def zone(x: str, y: str) -> str:
    """The lowest of the 25 square zones of side 40,000 that holds (x, y)."""
    west, south = "(6220000 + n_nationkey % 5 * 40000)", "(1770000 + n_nationkey // 5 * 40000)"
    return (f"(SELECT CAST(min(n_nationkey + 1) AS SMALLINT) FROM nation WHERE {x} >= {west} AND {x} <= {west} + 40000 AND {y} >= {south} AND {y} <= {south} + 40000)")


def point_columns(points: list) -> tuple[list[str], list[str]]:
    """(expressions for projected coordinates, expressions for shapes and zones)."""
    coords, out = [], []
    for i, (lng, lat, shape, zone_col) in enumerate(points):
        x, y = project_sql(lng, lat)
        coords += [f"{x} AS px{i}", f"{y} AS py{i}"]
        out.append(f"CASE WHEN px{i} IS NOT NULL AND py{i} IS NOT NULL THEN printf('POINT (%.3f %.3f)', px{i}, py{i}) END AS {shape}")
        if zone_col:
            out.append(f"{zone(f'px{i}', f'py{i}')} AS {zone_col}")
    return coords, out


def dataset_sql(name: str, plan, stubs: list[str]) -> str:
    """SQL of a built dataset; ``plan`` has its constants, copies and points (fixed values)."""
    spec = load_spec(name)
    union, columns = raw_union(name, plan.at_constants, plan.at_copies)
    ctes = [f"r AS ({union})"]
    last = "r"
    if name == "border_trips":
        slots = [f"SELECT hhid, {k} AS trip_id, {', '.join(f'{s}_{k} AS {s}' for s in stubs)} FROM r" for k in range(1, 5)]
        ctes.append(f"s AS ({' UNION ALL '.join(slots)})")
        last, columns = "s", ["hhid", "trip_id", *stubs]
    if name == "trips":
        worked = "COALESCE(h_complete_weekdays >= 1, false)"
        ctes.append(f"w AS (SELECT *, CASE WHEN {worked} THEN 1.0::DOUBLE END AS weight_person_trip, CASE WHEN {worked} THEN "
                    f"CASE WHEN COALESCE(travelers_hh BETWEEN 1 AND 10, false) THEN 1.0::DOUBLE / travelers_hh::DOUBLE ELSE 1.0::DOUBLE END END AS weight_trip FROM {last})")
        last, columns = "w", [*columns, "weight_person_trip", "weight_trip"]
    if plan.points:
        coords, shapes = point_columns(plan.points)
        ctes += [f"x AS (SELECT *, {', '.join(coords)} FROM {last})", f"p AS (SELECT *, {', '.join(shapes)} FROM x)"]
        last, columns = "p", columns + [c for p in plan.points for c in p[2:] if c]
    mapped = [f"{label_case(c, f)} AS {c}" for c, f in spec["codebook"].items() if c in columns]
    if mapped:
        ctes.append(f"m AS (SELECT * REPLACE ({', '.join(mapped)}) FROM {last})")
        last = "m"
    if name == "border_trips":
        kept = " OR ".join(f"{s} IS NOT NULL" for s in stubs)
        ctes.append(f"b AS (SELECT * REPLACE ({', '.join(f'COALESCE({s}, {MS}) AS {s}' for s in stubs)}), row_number() OVER (ORDER BY hhid, trip_id) - 1 AS border_trip_id "
                    f"FROM {last} WHERE {kept})")
        last = "b"
    if name == "intercept":
        pick = "CASE WHEN {a}_1 IN ('Missing', 'Not Applicable') AND {a}_2 IS DISTINCT FROM 'Missing' THEN {a}_2 ELSE {a}_1 END AS {out}"
        ctes.append(f"i AS (SELECT *, {pick.format(a='work_int_1', out='visit_work')}, {pick.format(a='school_int_1', out='visit_school')} FROM {last})")
        last = "i"
    rules = RULES.get(name, [])
    targets = list(dict.fromkeys(t for _, ts, v in rules for t in ts if v.startswith("'")))
    if targets:
        there = [t for t in targets if t in columns]
        new = [t for t in targets if t not in columns]
        ctes.append(f"t AS (SELECT * REPLACE ({', '.join(f'CAST({t} AS VARCHAR) AS {t}' for t in there)})" + "".join(f", CAST(NULL AS VARCHAR) AS {t}" for t in new) + f" FROM {last})")
        last = "t"
    for i, (cond, ts, value) in enumerate(rules):
        ctes.append(f"c{i} AS MATERIALIZED (SELECT * REPLACE ({', '.join(f'CASE WHEN COALESCE({cond}, false) THEN {value} ELSE {t} END AS {t}' for t in dict.fromkeys(ts))}) FROM {last})")
        last = f"c{i}"
    changed, extra = {}, {"day": "row_number() OVER (ORDER BY personid, traveldate) - 1 AS day_id", "vehicles": "dense_rank() OVER (ORDER BY hhid, vehnum) AS vehicle_id"}
    if name == "trips":
        changed = {c: f"replace({c}, '|', '')" for c in ("origin_address", "destination_address")}
    back = {new: old for old, new in spec["rename"].items()}
    inner = f"SELECT *{', ' + extra[name] if name in extra else ''} FROM {last}"
    out = [f"{changed.get(back.get(c, c), back.get(c, c))} AS {c}" for c in spec["output"]]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(out)} FROM ({inner})"


def location_points_sql() -> str:
    union, _ = raw_union("location", {}, {})
    x, y = project_sql("lng", "lat")
    return (f"SELECT row_number() OVER (ORDER BY tripid, collected_at, lng, lat, accuracy, heading, speed) - 1 AS point_id, tripid AS trip_id_location, collected_at, accuracy, "
            f"heading, speed, lat AS latitude, lng AS longitude, printf('POINT (%.3f %.3f)', {x}, {y}) AS shape FROM ({union})")


def location_lines_sql() -> str:
    union, _ = raw_union("location", {}, {})
    x, y = project_sql("lng", "lat")
    order = "collected_at, lng, lat, accuracy"
    return (f"WITH f AS (SELECT *, row_number() OVER (PARTITION BY tripid, lng, lat ORDER BY {order}) AS k FROM ({union})), "
            f"v AS (SELECT *, printf('%.3f %.3f', {x}, {y}) AS text FROM f WHERE k = 1), "
            f"g AS (SELECT tripid, count(*) AS n, string_agg(text, ', ' ORDER BY {order}) AS line FROM v GROUP BY tripid) "
            "SELECT tripid AS trip_id_location, CASE WHEN n >= 2 THEN 'LINESTRING (' ELSE 'POINT (' END || line || ')' AS shape FROM g")


def loaded_sql(table: str, built: str, sentinel: dict | None = None) -> str:
    """A built table as its contract stores it, with the sentinel row if there is one."""
    kinds = {"int": "INTEGER", "integer": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "SMALLINT", "float": "DOUBLE", "real": "FLOAT",
             "nvarchar": "VARCHAR", "varchar": "VARCHAR", "geometry": "VARCHAR", "date": "DATE", "smalldatetime": "TIMESTAMP", "datetime": "TIMESTAMP"}

    def stored(c) -> str:
        kind = kinds[c.sql_type]
        if c.sql_type == "smalldatetime":
            return f"date_trunc('minute', {c.name}::TIMESTAMP + INTERVAL 30 SECOND)"
        return f"CAST({f'trunc(CAST({c.name} AS DOUBLE))' if 'int' in c.sql_type else c.name} AS {kind})"

    columns = load_contracts()[table].columns
    rows = f"SELECT {', '.join(f'{stored(c)} AS {c.name}' for c in columns)} FROM ({built})"
    if not sentinel:
        return rows
    return rows + " UNION ALL SELECT " + ", ".join(f"CAST({q(sentinel.get(c.name))} AS {kinds[c.sql_type]})" for c in columns)


def profile_n_sql(built: str, columns: list[str], categories: dict) -> str:
    parts = []
    for i, c in enumerate(columns):
        user = f"count(*) FILTER (WHERE {c} IN ('Missing', 'Not Applicable'))" if c in categories else "0"
        parts.append(f"SELECT '{c}' AS field, {i} AS position, count({c}) - {user} AS n, count(*) - count({c}) + {user} AS missing FROM b")
    return (f"WITH b AS MATERIALIZED ({built}), c AS ({' UNION ALL '.join(parts)}) SELECT field, position, n, missing, "
            "CASE WHEN n + missing > 0 THEN round_even(100.0::DOUBLE * missing / CAST(n + missing AS DOUBLE), 1) END AS pct_missing FROM c")


def profile_freq_sql(built: str, categories: dict) -> str:
    counts = " UNION ALL ".join(f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS label, count(*) AS n FROM b WHERE {c} IS NOT NULL GROUP BY 2" for c in categories)
    domain = ", ".join(f"({q(c)}, {q(label)}, {i})" for c, labs in categories.items() for i, label in enumerate(labs))
    return (f"WITH b AS MATERIALIZED ({built}), k AS ({counts}), t AS (SELECT field, sum(n) AS nn FROM k GROUP BY field), d(field, label, ordinal) AS (VALUES {domain}) "
            "SELECT d.field, d.label, d.ordinal, CAST(COALESCE(k.n, 0) AS BIGINT) AS count, round_even(100.0::DOUBLE * COALESCE(k.n, 0) / CAST(t.nn AS DOUBLE), 1) AS pct "
            "FROM d LEFT JOIN k ON d.field = k.field AND d.label = k.label LEFT JOIN t ON d.field = t.field")
