"""Dataset builders against brute force: plain Python, row by row, on the
same raw rows (sf0.001), compared as multisets of output rows."""

import math

from conftest import SF_SMALL
from surveyprep.operators.codebook import load_codebook, load_spec
from surveyprep.plans.datasets import PLANS, build_dataset
from surveyprep.plans.raw_inputs import raw_sources

NA, MS = "Not Applicable", "Missing"


def _rows(df):
    return [r.asDict() for r in df.collect()]


def _label(fmap, v):
    if v is None:
        return fmap.null_label if fmap.has_null_label else None
    for code, lab in fmap.codes:
        if code == v:
            return lab
    return None


def _norm(rows, cols):
    def n(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        return v
    return sorted((tuple(n(r.get(c)) for c in cols) for r in rows), key=repr)


def _union(spark, name):
    src = raw_sources(spark, SF_SMALL, name)
    plan = PLANS[name]
    rows = _rows(src["main"]) if "main" in src else []
    for r in _rows(src["at"]):
        r = dict(r)
        r.update(plan.at_constants)
        for k, v in plan.at_copies.items():
            r[k] = r[v]
        rows.append(r)
    return src, rows


def test_day_brute_force(spark):
    src, rows = _union(spark, "day")
    spec, cb = load_spec("day"), load_codebook("day")
    out = []
    for r in rows:
        r = dict(r)
        for f in cb:
            r[f] = _label(cb[f], r.get(f))
        n = r["num_trips"]
        if n is not None and n > 0:
            r["trips_yesno"] = "Yes"
        if n == 0:
            r["trips_yesno"] = "No"
        if n == 0 and r["notravel"] is None:
            r["notravel"] = MS
        if n is not None and n > 0 and r["notravel"] is None:
            r["notravel"] = NA
        if r["notravel"] != "Other reason" and r["notravel_secondary"] != "Other reason":
            r["notravel_other"] = NA
        if (r["notravel"] == "Other reason" or r["notravel_secondary"] == "Other reason") and r["notravel_other"] is None:
            r["notravel_other"] = MS
        if r["data_source"] == "rMove":
            r["loc_start"] = r["loc_start_other"] = r["loc_end"] = r["loc_end_other"] = NA
        if r["data_source"] == "Online" and r["loc_start"] is None:
            r["loc_start"] = MS
        if r["data_source"] == "Online" and r["loc_end"] is None:
            r["loc_end"] = MS
        if r["data_source"] == "Online" and r["loc_start"] != "Other":
            r["loc_start_other"] = NA
        if r["data_source"] == "Online" and r["loc_end"] != "Other":
            r["loc_end_other"] = NA
        out.append(r)
    out.sort(key=lambda r: (r["personid"], r["traveldate"]))
    for i, r in enumerate(out):
        r["day_id"] = i
    ren = spec["rename"]
    exp = [{ren.get(k, k): v for k, v in r.items()} for r in out]
    got = _rows(build_dataset("day", src))
    cols = spec["output"]
    assert _norm(got, cols) == _norm(exp, cols)


def test_vehicles_brute_force(spark):
    src, rows = _union(spark, "vehicles")
    spec, cb = load_spec("vehicles"), load_codebook("vehicles")
    keys = sorted({(r["hhid"], r["vehnum"]) for r in rows if r["hhid"] is not None and r["vehnum"] is not None})
    kid = {k: i + 1 for i, k in enumerate(keys)}
    exp = []
    for r in rows:
        r = dict(r)
        for f in cb:
            r[f] = _label(cb[f], r.get(f))
        r["vehicle_id"] = kid.get((r["hhid"], r["vehnum"]), 0)
        exp.append({spec["rename"].get(k, k): v for k, v in r.items()})
    got = _rows(build_dataset("vehicles", src))
    assert _norm(got, spec["output"]) == _norm(exp, spec["output"])


def test_border_brute_force(spark):
    src, rows = _union(spark, "border_trips")
    spec, cb = load_spec("border_trips"), load_codebook("border_trips")
    stubs = list(cb)
    long = []
    for r in rows:
        for k in range(1, 5):
            o = {"hhid": r["hhid"], "trip_id": k}
            for s in stubs:
                o[s] = _label(cb[s], r[f"{s}_{k}"])
            if all(o[s] is None for s in stubs):
                continue
            for s in stubs:
                o[s] = MS if o[s] is None else o[s]
            long.append(o)
    long.sort(key=lambda o: (o["hhid"], o["trip_id"]))
    for i, o in enumerate(long):
        o["border_trip_id"] = i
    exp = [{spec["rename"].get(k, k): v for k, v in o.items()} for o in long]
    got = _rows(build_dataset("border_trips", src))
    assert _norm(got, spec["output"]) == _norm(exp, spec["output"])


def test_persons_brute_force(spark):
    from surveyprep.plans import survey_rules as R
    src, rows = _union(spark, "persons")
    spec, cb = load_spec("persons"), load_codebook("persons")
    out = []
    for r in rows:
        r = dict(r)
        for f in cb:
            r[f] = _label(cb[f], r.get(f))

        def setna(cols, v=NA):
            for c in ([cols] if isinstance(cols, str) else cols):
                r[c] = v
        if r["age"] in ("Under 5 years old", "5-15 years"):
            setna(R.PERSON_AGE16_COLUMNS)
        if r["age"] != "16-17 years":
            setna("child_smartphone")
        if r["age"] in ("Under 5 years old", "5-15 years", "16-17 years"):
            setna(["student", "education", "physical_activity"])
        if r["employment"] == "Not currently employed":
            setna(R.NOT_EMPLOYED_COLUMNS)
        if r["secondwork_address"] is None:
            setna("secondwork_address")
        if r["ethnicity_prefernot"] == "Yes":
            setna(R.ETHNICITY_COLUMNS)
        if r["transit_freq"] in ("1-3 days per month", "Less than monthly", "Never"):
            setna("transitpass")
        if r["secondschool_address"] is None:
            setna("secondschool_address")
        if r["schooltype"] in R.HOME_SCHOOL_TYPES:
            setna(["mainschool_address", "secondschool_address", "school_freq", "other_school", "school_mode"])
        if r["school_freq"] == "Never, only takes online classes":
            setna("school_mode")
        if r["schooltype"] != "Daycare outside home":
            setna(["daycare_early", "daycare_late"])
        if r["military"] in R.ACTIVE_DUTY:
            setna(R.WORK_DETAIL_COLUMNS)
        if r["job_type"] == R.WORK_AT_HOME:
            setna("telecommute_freq")
        if r["job_type"] in (R.WORK_AT_HOME, R.TRAVEL_FOR_LIVING):
            setna("commute_freq")
        if r["commute_freq"] in ("Never", NA):
            setna(["commute_mode", "work_flex", "work_park_pay", "work_park_cost_dk", "work_park_ease"]
                  + R.COMMUTE_SUBSIDY_COLUMNS)
        if r["commute_subsidy_other"] in ("No", NA):
            setna("commute_subsidy_specify")
        if r["commute_mode"] not in R.PRIVATE_VEHICLE_COMMUTE:
            setna(["work_park_pay", "work_park_cost_dk", "work_park_ease"])
        if r["secondhome"] != "Yes":
            setna("secondhome_address")
        if r["rmove_participant"] == "Yes":
            setna(["callcenter_diary", "mobile_diary"])
        if r["smartphone_type"] in R.NO_SMARTPHONE_AGE:
            setna("smartphone_age")
        if r["mainschool_address"] is None:
            setna("mainschool_address", MS)
        if r["work_address"] is None:
            setna("work_address", MS)
        out.append({spec["rename"].get(k, k): v for k, v in r.items()})
    got = _rows(build_dataset("persons", src, None))
    cols = [c for c in spec["output"] if not c.endswith("_shape") and not c.endswith("_mgra_13")]
    assert _norm(got, cols) == _norm(out, cols)


def test_trips_brute_force(spark):
    from surveyprep.plans import survey_rules as R
    src, rows = _union(spark, "trips")
    spec, cb = load_spec("trips"), load_codebook("trips")
    transit = ["Vanpool", "Bus"] + R.TRANSIT_MODES_TAIL
    out = []
    allcols = set().union(*[set(r) for r in rows]) | set(cb)
    for r in rows:
        r = {c: r.get(c) for c in allcols}
        w, t = r.get("h_complete_weekdays"), r.get("travelers_hh")
        r["weight_person_trip"] = 1.0 if (w is not None and w >= 1) else None
        r["weight_trip"] = (1.0 / t if (t is not None and 1 <= t <= 10) else 1.0) if (w is not None and w >= 1) else None
        for f in cb:
            r[f] = _label(cb[f], r.get(f))
        r["revised_count"] = None if r.get("revised_count") is None else str(r["revised_count"])

        def setna(cols, v=NA):
            for c in ([cols] if isinstance(cols, str) else cols):
                r[c] = v
        modes = [r.get("mode1"), r.get("mode2"), r.get("mode3"), r.get("mode4")]
        for c in R.TRIP_MISSING_COLUMNS:
            if r.get(c) is None:
                r[c] = MS
        if r["data_source"] == "rMove":
            setna(R.TRIP_ONLINE_ONLY)
        if r["data_source"] == "Online":
            setna(R.TRIP_RMOVE_ONLY)
            r["location_tripid"] = 0
        if r["o_purpose"] not in ("Other", "Other purpose"):
            setna("o_purpose_other")
        if r["d_purpose"] not in ("Other", "Other purpose"):
            setna("d_purpose_other")
        if not any(m in transit for m in modes):
            setna(["transit_access", "transit_egress"])
        if not any(m in R.AUTO_MODES for m in modes):
            setna(["toll_no", "toll_express"])
        if not any(m in R.AUTO_NONTAXI_MODES for m in modes):
            setna(["driver", "parklocation"])
        if r["parklocation"] not in R.PARKED_LOCATIONS:
            setna("parktype")
        if r["parktype"] not in R.PAID_PARKING:
            setna("park_cost_dk")
        if r["parklocation"] != "Park & Ride lot":
            setna(["parkride_lot", "parkride_city"])
        if not any(m in R.TAXI_MODES for m in modes):
            setna("taxitype")
        if r["taxitype"] not in R.PAID_TAXI:
            setna("taxi_cost_dk")
        if "Airplane" not in modes:
            setna("airtype")
        if r["airtype"] not in R.PAID_AIR:
            setna("airfare_cost_dk")
        if not any(m in R.BUS_MODES for m in modes):
            setna("bustype")
        if r["bustype"] != R.CASH_FARE:
            setna("bus_cost_dk")
        if not any(m in R.RAIL_MODES for m in modes):
            setna("railtype")
        if r["railtype"] != R.CASH_FARE:
            setna("rail_cost_dk")
        if "Ferry or water taxi" not in modes:
            setna("ferrytype")
        if r["ferrytype"] != R.CASH_FARE:
            setna("ferry_cost_dk")
        for c in ("origin_address", "destination_address"):
            r[c] = r[c].replace("|", "") if r[c] is not None else None
        out.append({spec["rename"].get(k, k): v for k, v in r.items()})
    got = _rows(build_dataset("trips", src, None))
    cols = [c for c in spec["output"] if not c.endswith("_shape") and not c.endswith("_mgra_13")]
    assert _norm(got, cols) == _norm(out, cols)
