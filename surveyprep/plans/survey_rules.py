"""Recode rule tables of the survey datasets, in order (Appendix B).

Labels and column lists are fixed values of the survey codebook. Each
entry reads "where <condition>, set <targets> to <value>"; conditions use
the two-valued predicates (null is never equal, never a member).

``compat=True`` reproduces three rules as the original program text
behaves (a missing comma that glues "Vanpool" and "Bus" into one
label; the rail list being a copy of the bus list; the airfare rule
testing the taxi field). The default is the intended behaviour.
"""

from __future__ import annotations

from surveyprep.functions import predicates as P
from surveyprep.operators.rules import Rule, when

NA, MS = "Not Applicable", "Missing"


def day_rules(compat: bool = False) -> list[Rule]:
    return [
        when(lambda c: P.gt(c("num_trips"), 0), "trips_yesno", "Yes"),
        when(lambda c: P.eq(c("num_trips"), 0), "trips_yesno", "No"),
        when(lambda c: P.eq(c("num_trips"), 0) & c("notravel").isNull(), "notravel", MS),
        when(lambda c: P.gt(c("num_trips"), 0) & c("notravel").isNull(), "notravel", NA),
        when(lambda c: P.ne(c("notravel"), "Other reason") & P.ne(c("notravel_secondary"), "Other reason"),
             "notravel_other", NA),
        when(lambda c: (P.eq(c("notravel"), "Other reason") | P.eq(c("notravel_secondary"), "Other reason"))
             & c("notravel_other").isNull(), "notravel_other", MS),
        when(lambda c: P.eq(c("data_source"), "rMove"),
             ["loc_start", "loc_start_other", "loc_end", "loc_end_other"], NA),
        when(lambda c: P.eq(c("data_source"), "Online") & c("loc_start").isNull(), "loc_start", MS),
        when(lambda c: P.eq(c("data_source"), "Online") & c("loc_end").isNull(), "loc_end", MS),
        when(lambda c: P.eq(c("data_source"), "Online") & P.ne(c("loc_start"), "Other"), "loc_start_other", NA),
        when(lambda c: P.eq(c("data_source"), "Online") & P.ne(c("loc_end"), "Other"), "loc_end_other", NA),
    ]


def household_rules(compat: bool = False) -> list[Rule]:
    return [
        when(lambda c: P.eq(c("hhgroup"), "Group 3: Online diary only"), "num_rmove_participants", NA),
        when(lambda c: P.ne(c("language_pref"), "Other"), "language_pref_other", NA),
        when(lambda c: P.eq(c("tool_other"), "No"), "tool_other_specify", NA),
    ]


# Column groups of the person recodes.
PERSON_AGE16_COLUMNS = [
    "employment", "jobs_count", "license", "military", "ethnicity_amindian_alaska", "ethnicity_asian",
    "ethnicity_black", "ethnicity_hispanic", "ethnicity_hawaiian_pacific", "ethnicity_white", "ethnicity_other",
    "ethnicity_prefernot", "disability", "transit_freq", "transitpass", "job_type", "occupation", "industry",
    "hours_work", "commute_freq", "commute_mode", "work_flex", "work_park_pay", "work_park_cost_dk",
    "work_park_ease", "telecommute_freq", "commute_subsidy_none", "commute_subsidy_parking",
    "commute_subsidy_transit", "commute_subsidy_vanpool", "commute_subsidy_cash", "commute_subsidy_other",
    "commute_subsidy_specify", "work_address", "secondwork_address", "smartphone_type", "smartphone_age"]
COMMUTE_SUBSIDY_COLUMNS = [
    "commute_subsidy_none", "commute_subsidy_parking", "commute_subsidy_transit", "commute_subsidy_vanpool",
    "commute_subsidy_cash", "commute_subsidy_other", "commute_subsidy_specify"]
WORK_DETAIL_COLUMNS = [
    "job_type", "occupation", "industry", "hours_work", "commute_freq", "commute_mode", "work_flex",
    "work_park_pay", "work_park_cost_dk", "work_park_ease", "telecommute_freq"] + COMMUTE_SUBSIDY_COLUMNS
NOT_EMPLOYED_COLUMNS = ["jobs_count", "military"] + WORK_DETAIL_COLUMNS + ["work_address", "secondwork_address"]
ETHNICITY_COLUMNS = [
    "ethnicity_amindian_alaska", "ethnicity_asian", "ethnicity_black", "ethnicity_hispanic",
    "ethnicity_hawaiian_pacific", "ethnicity_white", "ethnicity_other"]
HOME_SCHOOL_TYPES = [
    "Cared for at home", "Kindergarten-Grade 5 (home school)", "Grade 6-Grade 8 (home school)",
    "Grade 9-Grade 12 (home school)", MS, NA]
ACTIVE_DUTY = ["Active duty within the San Diego region", "Active duty outside of the San Diego region"]
WORK_AT_HOME = "Work at home only (only telework or self-employed)"
TRAVEL_FOR_LIVING = "Drive/Travel for a living (e.g., bus/truck driver, salesman)"
PRIVATE_VEHICLE_COMMUTE = [
    "Drive alone", "Carpool with only family/household member(s)",
    "Carpool with at least one person not in household", "Motorcycle/moped/scooter"]
NO_SMARTPHONE_AGE = [
    "Yes, has a Windows Phone", "Yes, has other type of smartphone", "Yes, has a Blackberry",
    "No, does not have a smartphone", NA]


def person_rules(compat: bool = False) -> list[Rule]:
    return [
        when(lambda c: P.is_in(c("age"), ["Under 5 years old", "5-15 years"]), PERSON_AGE16_COLUMNS, NA),
        when(lambda c: P.ne(c("age"), "16-17 years"), "child_smartphone", NA),
        when(lambda c: P.is_in(c("age"), ["Under 5 years old", "5-15 years", "16-17 years"]),
             ["student", "education", "physical_activity"], NA),
        when(lambda c: P.eq(c("employment"), "Not currently employed"), NOT_EMPLOYED_COLUMNS, NA),
        when(lambda c: c("secondwork_address").isNull(), "secondwork_address", NA),
        when(lambda c: P.eq(c("ethnicity_prefernot"), "Yes"), ETHNICITY_COLUMNS, NA),
        when(lambda c: P.is_in(c("transit_freq"), ["1-3 days per month", "Less than monthly", "Never"]),
             "transitpass", NA),
        when(lambda c: c("secondschool_address").isNull(), "secondschool_address", NA),
        when(lambda c: P.is_in(c("schooltype"), HOME_SCHOOL_TYPES),
             ["mainschool_address", "secondschool_address", "school_freq", "other_school", "school_mode"], NA),
        when(lambda c: P.eq(c("school_freq"), "Never, only takes online classes"), "school_mode", NA),
        when(lambda c: P.ne(c("schooltype"), "Daycare outside home"), ["daycare_early", "daycare_late"], NA),
        when(lambda c: P.is_in(c("military"), ACTIVE_DUTY), WORK_DETAIL_COLUMNS, NA),
        when(lambda c: P.eq(c("job_type"), WORK_AT_HOME), "telecommute_freq", NA),
        when(lambda c: P.is_in(c("job_type"), [WORK_AT_HOME, TRAVEL_FOR_LIVING]), "commute_freq", NA),
        when(lambda c: P.is_in(c("commute_freq"), ["Never", NA]),
             ["commute_mode", "work_flex", "work_park_pay", "work_park_cost_dk", "work_park_ease"]
             + COMMUTE_SUBSIDY_COLUMNS, NA),
        when(lambda c: P.is_in(c("commute_subsidy_other"), ["No", NA]), "commute_subsidy_specify", NA),
        when(lambda c: P.not_in(c("commute_mode"), PRIVATE_VEHICLE_COMMUTE),
             ["work_park_pay", "work_park_cost_dk", "work_park_ease"], NA),
        when(lambda c: P.ne(c("secondhome"), "Yes"), "secondhome_address", NA),
        when(lambda c: P.eq(c("rmove_participant"), "Yes"), ["callcenter_diary", "mobile_diary"], NA),
        when(lambda c: P.is_in(c("smartphone_type"), NO_SMARTPHONE_AGE), "smartphone_age", NA),
        when(lambda c: c("mainschool_address").isNull(), "mainschool_address", MS),
        when(lambda c: c("work_address").isNull(), "work_address", MS),
    ]


# Mode groups of the trip recodes.
TRANSIT_MODES_TAIL = [
    "School bus", "Intercity bus", "Shuttle bus", "Paratransit", "Other bus", "Subway", "Ferry or water taxi",
    "University bus or shuttle", "Rail - Light", "Rail - Intercity", "Rail - Other", "Express bus/Rapid",
    "San Diego Coaster Line"]
AUTO_NONTAXI_MODES = [
    "Household vehicle 1", "Household vehicle 2", "Household vehicle 3", "Household vehicle 4",
    "Household vehicle 5", "Household vehicle 6", "Household vehicle 7", "Other household vehicle",
    "Rental car", "Carshare", "Other auto", "Work car", "Friends car"]
TAXI_MODES = ["Taxi - Regular", "Taxi - Rideshare"]
AUTO_MODES = AUTO_NONTAXI_MODES + TAXI_MODES
BUS_MODES = ["Bus", "Intercity bus", "Express bus/Rapid"]
RAIL_MODES = ["Rail - Light", "Rail - Intercity", "Rail - Other", "Subway", "San Diego Coaster Line"]
PARKED_LOCATIONS = ["Someone elses driveway", "Parking lot/garage", "On street parking", "Park & Ride lot"]
PAID_PARKING = ["Paid via cash, credit card, or ticket(s)", "Reserved parking service (e.g., ParkingPanda)",
                "Another person paid"]
PAID_TAXI = ["I paid the fare myself (no reimbursement)", "Employer paid (I am reimbursed)",
             "Split/shared fare with other(s)"]
PAID_AIR = ["Personally paid the airfare cost", "Employer paid 100%"]
CASH_FARE = "Cash, credit card, or ticket(s)"
TRIP_MISSING_COLUMNS = ["revised_count", "origin_name", "destination_name", "origin_address",
                        "destination_address", "o_purpose_other", "d_purpose_other"]
TRIP_ONLINE_ONLY = ["origin_name", "origin_address", "destination_name", "destination_address", "toll_no",
                    "toll_express", "transit_access", "transit_egress", "parkride_lot", "parkride_city"]
TRIP_RMOVE_ONLY = ["revised_count", "error", "flag_teleport", "copied_trip", "analyst_merged", "analyst_split",
                   "user_merged", "user_split", "added_trip", "nonproxy_derived_trip", "proxy_added_trip",
                   "o_purpose_inferred", "d_purpose_inferred"]
MODES = ["mode1", "mode2", "mode3", "mode4"]


def trip_rules(compat: bool = False) -> list[Rule]:
    transit = (["VanpoolBus"] if compat else ["Vanpool", "Bus"]) + TRANSIT_MODES_TAIL
    rail = BUS_MODES if compat else RAIL_MODES
    air_field = "taxitype" if compat else "airtype"

    def modes(c):
        return [c(m) for m in MODES]

    rules = [when(lambda c, t=t: c(t).isNull(), t, MS) for t in TRIP_MISSING_COLUMNS]
    rules += [
        when(lambda c: P.eq(c("data_source"), "rMove"), TRIP_ONLINE_ONLY, NA),
        when(lambda c: P.eq(c("data_source"), "Online"), TRIP_RMOVE_ONLY, NA),
        when(lambda c: P.eq(c("data_source"), "Online"), "location_tripid", 0),
        when(lambda c: P.not_in(c("o_purpose"), ["Other", "Other purpose"]), "o_purpose_other", NA),
        when(lambda c: P.not_in(c("d_purpose"), ["Other", "Other purpose"]), "d_purpose_other", NA),
        when(lambda c: P.none_in(modes(c), transit), ["transit_access", "transit_egress"], NA),
        when(lambda c: P.none_in(modes(c), AUTO_MODES), ["toll_no", "toll_express"], NA),
        when(lambda c: P.none_in(modes(c), AUTO_NONTAXI_MODES), ["driver", "parklocation"], NA),
        when(lambda c: P.not_in(c("parklocation"), PARKED_LOCATIONS), "parktype", NA),
        when(lambda c: P.not_in(c("parktype"), PAID_PARKING), "park_cost_dk", NA),
        when(lambda c: P.ne(c("parklocation"), "Park & Ride lot"), ["parkride_lot", "parkride_city"], NA),
        when(lambda c: P.none_in(modes(c), TAXI_MODES), "taxitype", NA),
        when(lambda c: P.not_in(c("taxitype"), PAID_TAXI), "taxi_cost_dk", NA),
        when(lambda c: P.none_in(modes(c), ["Airplane"]), "airtype", NA),
        when(lambda c: P.not_in(c(air_field), PAID_AIR), "airfare_cost_dk", NA),
        when(lambda c: P.none_in(modes(c), BUS_MODES), "bustype", NA),
        when(lambda c: P.ne(c("bustype"), CASH_FARE), "bus_cost_dk", NA),
        when(lambda c: P.none_in(modes(c), rail), "railtype", NA),
        when(lambda c: P.ne(c("railtype"), CASH_FARE), "rail_cost_dk", NA),
        when(lambda c: P.none_in(modes(c), ["Ferry or water taxi"]), "ferrytype", NA),
        when(lambda c: P.ne(c("ferrytype"), CASH_FARE), "ferry_cost_dk", NA),
    ]
    return rules
