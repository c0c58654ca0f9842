"""DOM6: the eight survey dataset builders.

Each builder is one lazy plan: union the two typed raw sources (main
first, the second source given its constant defaults), map every coded
field in one projection, apply the ordered recode rules in a few staged
projections, add geometry / zones / keys, rename and project onto the
target column order. ``load_dataset`` then conforms the frame to the
target contract (store-assignment casts) and reports data-quality
violations without touching the rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyprep.functions.geo import point_wkt, project_xy
from surveyprep.operators.codebook import Codebook, apply_codebook, load_spec
from surveyprep.operators.contract import conform, contract_for, dq_summary
from surveyprep.operators.keys import add_sentinel, dense_key, natural_key, row_key
from surveyprep.operators.paths import path_lines
from surveyprep.operators.reshape import drop_all_null, fill_missing, merge_alternates, wide_to_long
from surveyprep.operators.rules import apply_rules
from surveyprep.operators.weights import person_trip_weight, trip_weight
from surveyprep.operators.zones import attach_zones
from surveyprep.plans import dataset_sql as S
from surveyprep.plans import survey_rules as R
from surveyprep.plans.raw_inputs import raw_sources, survey_zones
from surveyprep.session import whole, widen
from surveyprep.sources.readers import add_defaults, union_sources
from surveyprep.sources.survey_files import read_survey

NA = "Not Applicable"


@dataclass
class DatasetPlan:
    name: str
    at_constants: dict = field(default_factory=dict)
    at_copies: dict = field(default_factory=dict)
    rules: Callable | None = None
    # (lng column, lat column, shape output, zone output or None), before renaming
    points: list = field(default_factory=list)


# Constants given to the second (active-transport) source for
# fields it lacks; 99 is the code added for "Not Applicable".
PLANS = {
    "day": DatasetPlan("day", {"data_source": 1, "day_hhcomplete": 99, "notravel_other": NA, "loc_start": 99,
                               "loc_start_other": NA, "loc_end": 99, "loc_end_other": NA}, rules=R.day_rules),
    "households": DatasetPlan("households", {"sample_segment": "AT segment", "callcenter_recruit": 99},
                              rules=R.household_rules,
                              points=[("home_lng", "home_lat", "shape", "mgra_13")]),
    "persons": DatasetPlan("persons", {"smartphone_type": 99, "smartphone_age": 99, "child_smartphone": 99,
                                       "callcenter_diary": 99, "mobile_diary": 99}, rules=R.person_rules,
                           points=[("secondhome_lng", "secondhome_lat", "second_home_shape", "second_home_mgra_13"),
                                   ("mainschool_lng", "mainschool_lat", "school_shape", "school_mgra_13"),
                                   ("secondschool_lng", "secondschool_lat", "second_school_shape",
                                    "second_school_mgra_13"),
                                   ("work_lng", "work_lat", "work_shape", "work_mgra_13"),
                                   ("secondwork_lng", "secondwork_lat", "second_work_shape", "second_work_mgra_13")]),
    "trips": DatasetPlan("trips", {"data_source": 1, "day_hhcomplete": 99, "pday_complete": 99,
                                   "nonproxy_derived_trip": 99, "proxy_added_trip": 99, "origin_name": NA,
                                   "origin_address": NA, "destination_name": NA, "destination_address": NA,
                                   "transit_access": 99, "transit_egress": 99, "toll_no": 99, "toll_express": 99},
                         {"location_tripid": "tripid_linked"}, rules=R.trip_rules,
                         points=[("origin_lng", "origin_lat", "origin_shape", "origin_mgra_13"),
                                 ("destination_lng", "destination_lat", "destination_shape", "destination_mgra_13")]),
    "intercept": DatasetPlan("intercept",
                             points=[("origin_loc_lng_1", "origin_loc_lat_1", "origin_shape", "origin_mgra_13"),
                                     ("dest_loc_lng_1", "dest_loc_lat_1", "destination_shape", "destination_mgra_13")]),
    "vehicles": DatasetPlan("vehicles"),
    "border_trips": DatasetPlan("border_trips"),
}

BORDER_STUBS = ["border_mode", "border_poe", "border_purpose", "border_duration", "border_party"]


def _string_targets(rules) -> set:
    return {t for r in rules for t, v in r.set if isinstance(v, str)}


def add_points(df: DataFrame, points: list, zones: DataFrame | None, cell: float | None = None) -> DataFrame:
    """Point WKT for every (lng, lat) pair and, with zones, the lowest containing zone.

    The zone index is built once and probed by every point column (a
    broadcast hash join per column when the zones are small enough; see
    ``attach_zones``), so the wide frame is never shuffled for it.
    """
    own = list(dict.fromkeys(c for lng, lat, _, _ in points for c in (lng, lat)))
    rest = [c for c in df.columns if c not in own]
    out = df.select(whole(rest).alias("__rest"), *own) if rest else df
    xy = []
    for lng, lat, shape, zone in points:
        x, y = project_xy(lng, lat)
        cols = {shape: point_wkt(lng, lat)}
        if zone:
            cols.update({f"__{shape}_x": x, f"__{shape}_y": y})
            xy.append((f"__{shape}_x", f"__{shape}_y", zone))
        out = out.withColumns(cols)
    if zones is None or not xy:
        # no zone layer given: the zone columns exist but stay null
        out = out.withColumns({z: F.lit(None).cast("short") for _, _, z in xy})
    else:
        out = attach_zones(out, xy, zones, "mgra_13", "wkt", cell=cell)
    made = [c for c in out.columns if c not in own and c not in ("__rest", *[c for x, y, _ in xy for c in (x, y)])]
    back = [F.col(c) if c in own else F.col(f"__rest.`{c}`").alias(c) for c in df.columns if c not in made]
    return out.select(*back, *made)


def build_dataset(name: str, sources: dict, zones: DataFrame | None = None, compat: bool = False,
                  key_method: str = "ranged") -> DataFrame:
    """Build one survey dataset from its typed raw sources ({"main", "at"})."""
    spec = load_spec(name)
    cb = Codebook.from_spec(spec["codebook"])
    plan = PLANS[name]
    frames = []
    if "main" in sources:
        frames.append(sources["main"])
    if "at" in sources:
        frames.append(add_defaults(sources["at"], plan.at_constants, plan.at_copies))
    df = widen(union_sources(frames))

    if name == "border_trips":
        df = wide_to_long(df, BORDER_STUBS, "hhid", "trip_id", range(1, 5))
    if name == "trips":
        # weights come from the numeric codes, before labelling
        df = df.withColumns({"weight_person_trip": person_trip_weight("h_complete_weekdays"),
                             "weight_trip": trip_weight("h_complete_weekdays", "travelers_hh")})

    if plan.points:
        df = add_points(df, plan.points, zones)

    df = apply_codebook(df, cb)

    if name == "border_trips":
        df = drop_all_null(df, BORDER_STUBS)
        df = fill_missing(df, "Missing", BORDER_STUBS)
        df = natural_key(df, ["hhid", "trip_id"], "border_trip_id", start=0) if key_method == "ranged" \
            else row_key(df, ["hhid", "trip_id"], "border_trip_id", start=0, method=key_method)
    if name == "intercept":
        df = df.withColumns({"visit_work": merge_alternates("work_int_1_1", "work_int_1_2"),
                             "visit_school": merge_alternates("school_int_1_1", "school_int_1_2")})
    if plan.rules is not None:
        rules = plan.rules(compat)
        casts = {t: F.col(t).cast("string") for t in _string_targets(rules)
                 if t in df.columns and df.schema[t].dataType.simpleString() != "string"}
        if casts:
            df = df.withColumns(casts)
        df = apply_rules(df, rules, pack=True)
    if name == "trips":
        df = df.withColumns({c: F.regexp_replace(c, r"\|", "") for c in ("origin_address", "destination_address")})
    if name == "day":
        df = natural_key(df, ["personid", "traveldate"], "day_id", start=0) if key_method == "ranged" \
            else row_key(df, ["personid", "traveldate"], "day_id", start=0, method=key_method)
    if name == "vehicles":
        df = dense_key(df, ["hhid", "vehnum"], "vehicle_id", method=key_method)
    df = df.withColumnsRenamed({k: v for k, v in spec["rename"].items() if k != v and k in df.columns})
    return df.select(*spec["output"])


def build_location(sources: dict, key_method: str = "ranged") -> dict:
    """Location points (one per ping, with ``point_id``) and per-trip path lines."""
    spec = load_spec("location")
    pts = union_sources([sources["main"], sources["at"]])
    # global order (trip, collected_at, lng, lat, accuracy) makes point_id deterministic
    lines = path_lines(pts, "tripid", ["collected_at", "lng", "lat", "accuracy"], "lng", "lat")
    pts = row_key(pts, ["tripid", "collected_at", "lng", "lat", "accuracy"], "point_id", start=0, method=key_method)
    pts = pts.withColumn("shape", point_wkt("lng", "lat"))
    pts = pts.withColumnsRenamed({"tripid": "trip_id_location", "lat": "latitude", "lng": "longitude"})
    lines = lines.withColumnRenamed("tripid", "trip_id_location")
    return {"points": pts.select(*spec["output"]["points"]), "lines": lines.select(*spec["output"]["lines"])}


# Spark types of raw columns by the type of the target column that they become
_TARGET_TYPES = {"int": "bigint", "integer": "bigint", "bigint": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double",
                 "real": "double", "date": "date", "smalldatetime": "timestamp_ntz", "datetime": "timestamp_ntz"}


def raw_types(name: str, role: str) -> dict:
    """Read types of a raw source's columns: those listed, else by the target column, coordinates as double; the rest is text."""
    spec, types = load_spec(name), {}
    target = {} if name == "location" else {c.name: c.sql_type for c in contract_for(name).columns}
    points = {c for lng, lat, _, _ in (PLANS[name].points if name in PLANS else []) for c in (lng, lat)} | {"lng", "lat", "accuracy", "heading", "speed"}
    for c in spec["sources"][role]["columns"]:
        own = spec["sources"][role]["types"].get(c)
        kind = own or _TARGET_TYPES.get(target.get(spec["rename"].get(c, c)))
        types[c] = own or ("double" if c in points else None if c in spec["codebook"] and spec["codebook"][c].get("key_type") == "string" else kind) or "string"
    types |= {c: k for c, k in {"tripid": "bigint", "collected_at": "timestamp_ntz", "h_complete_weekdays": "int"}.items() if c in types}
    return types


def read_raw(spark: SparkSession, name: str, files: dict, multi_line: bool = False) -> tuple[dict, DataFrame]:
    """({role: typed raw source}, reject ledger) of a dataset's raw CSV files, ``files`` by role."""
    spec = load_spec(name)["sources"]
    return read_survey(spark, files, {role: {"columns": spec[role]["columns"], "types": raw_types(name, role)} for role in files}, multi_line=multi_line)


def build_from_files(spark: SparkSession, name: str, files: dict, zones: DataFrame | None = None, compat: bool = False,
                     multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(the dataset, the reject ledger) from raw CSV files: {"main": paths, "at": paths}."""
    sources, ledger = read_raw(spark, name, files, multi_line)
    return build_dataset(name, sources, zones, compat), ledger


def load_dataset(df: DataFrame, table_name: str, sentinel: dict | None = None) -> tuple[DataFrame, list]:
    """Conform to the target contract (+ optional sentinel row) and build its DQ reports."""
    contract = contract_for(table_name)
    out = conform(df, contract)
    if sentinel:
        out = add_sentinel(out, sentinel)
    return out, dq_summary(out, contract)


# The sentinel vehicle row for non-matching keys.
VEHICLE_SENTINEL = {"vehicle_id": 0, "household_id": 0, "vehicle_number": 0, "year": NA, "make": NA, "model": NA,
                    "fuel_type": NA, "how_obtained": NA, "toll_transponder": NA, "residence_parking_pass": NA,
                    "residence_parking_cost_unknown": NA}


def _builder(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zones = survey_zones(spark, sf_dir) if PLANS[name].points else None
        return build_dataset(name, raw_sources(spark, sf_dir, name), zones)
    run.__name__ = f"build_{name}"
    run.__doc__ = f"DOM6: the {name} dataset from raw sources derived from the test tables."
    return run


def _location(part: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_location(raw_sources(spark, sf_dir, "location"))[part]
    run.__name__ = f"build_location_{part}"
    return run


def _vehicles_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK5 + SNK6: the vehicles table as loaded (contract types plus sentinel row)."""
    df = build_dataset("vehicles", raw_sources(spark, sf_dir, "vehicles"))
    return load_dataset(df, "vehicles", VEHICLE_SENTINEL)[0]


QUERIES = {f"build_{n}": _builder(n) for n in ("vehicles", "day", "households", "border_trips", "intercept",
                                               "persons", "trips")}
QUERIES["build_location_points"] = _location("points")
QUERIES["build_location_lines"] = _location("lines")
QUERIES["load_vehicles"] = _vehicles_loaded


def _loaded(query: str, table_name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return load_dataset(QUERIES[query](spark, sf_dir), table_name)[0]
    run.__name__ = query.replace("build", "load")
    run.__doc__ = f"SNK6 / SNK11: {table_name} as its contract's types store it."
    return run


#: The other tables' contracts by builder.
LOADED = {f"build_{n}": n for n in ("day", "households", "border_trips", "intercept", "persons", "trips")} | {
    "build_location_points": "location_points", "build_location_lines": "location_lines"}
QUERIES |= {q.replace("build", "load"): _loaded(q, t) for q, t in LOADED.items()}


def dataset_categories(name: str) -> dict:
    """Output column -> category order for every coded field of a dataset.

    Codebook labels in order, then the added "Missing" / "Not Applicable"
    categories the recodes may assign (as the survey program adds them).
    """
    spec = load_spec(name)
    cb = Codebook.from_spec(spec["codebook"])
    out = {}
    for f in cb:
        col = spec["rename"].get(f, f)
        if col in spec["output"]:
            cats = cb[f].categories()
            out[col] = cats + [lab for lab in ("Missing", NA) if lab not in cats]
    return out


def _profile(name: str, part: str):
    from surveyprep.operators.profile import profile_freq, profile_n

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zones = survey_zones(spark, sf_dir) if PLANS[name].points else None
        df = build_dataset(name, raw_sources(spark, sf_dir, name), zones)
        cats = dataset_categories(name)
        if part == "n":
            return profile_n(df, categorical=list(cats), user_missing=["Missing", NA])
        return profile_freq(df, cats)
    run.__name__ = f"profile_{name}_{part}"
    run.__doc__ = f"AGG1/AGG2 on the built {name} table (frequencies with Missing / Not Applicable as user-missing)."
    return run


QUERIES["profile_households_n"] = _profile("households", "n")
QUERIES["profile_households_freq"] = _profile("households", "freq")
QUERIES["profile_trips_freq"] = _profile("trips", "freq")


def _oracles() -> dict:
    built = {n: S.dataset_sql(n, plan, BORDER_STUBS) for n, plan in PLANS.items()}
    out = {f"build_{n}": sql for n, sql in built.items()}
    out |= {"build_location_points": S.location_points_sql(), "build_location_lines": S.location_lines_sql(),
            "load_vehicles": S.loaded_sql("vehicles", built["vehicles"], VEHICLE_SENTINEL)}
    out |= {q.replace("build", "load"): S.loaded_sql(t, out[q]) for q, t in LOADED.items()}
    households, trips = dataset_categories("households"), dataset_categories("trips")
    return out | {"profile_households_n": S.profile_n_sql(built["households"], load_spec("households")["output"], households),
                  "profile_households_freq": S.profile_freq_sql(built["households"], households), "profile_trips_freq": S.profile_freq_sql(built["trips"], trips)}


ORACLE = _oracles()
