"""The 218 features of dispatches, each as the operator that makes it and its parameters."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import banding, event_features
from ..sources import io

#: Events of a task that joins them to their outcomes, about.
TASK_EVENTS = 250_000
EPSILON = "0.00001D"
HOUR, DAY = 3600, 86400
# Spans, radii, columns, shares and tests of the features, and their names.
#: Seconds of trailing windows, by how feature names spell them.
SPANS = {"1Minute": 60, "15Minutes": 900, "30Minutes": 1800, "1Hour": HOUR, "3Hours": 3 * HOUR, "6Hours": 6 * HOUR, "12Hours": 12 * HOUR, "24Hours": DAY, "48Hours": 2 * DAY, "Week": 7 * DAY}
#: Degrees of radii; each name keeps its own radius, the 1 km features of responders at 24 and 48 hours too.
RADII = {"1km": 0.009, "500m": 0.0045, "100m": 0.0009}
#: (months, days) of the responders' past.
PAST = {"3Years": (36, 0), "Year": (12, 0), "6Months": (6, 0), "1Month": (1, 0)}
COUNTS = {
    "UnjustifiedIncidents": "number_of_unjustified_allegations", "JustifiedIncidents": "number_of_justified_allegations", "PreventableIncidents": "number_of_preventable_allegations",
    "NonPreventableIncidents": "number_of_non_preventable_allegations", "SustainedAllegations": "number_of_sustained_allegations", "UnsustainedAllegations": "number_of_unsustained_allegations",
}
MEANS = {"Average": "avg", "Minimum": "min", "Maximum": "max"}


def _share(table: str, parts: str, whole: str = "001", epsilon: str = EPSILON) -> str:
    """SQL of the sum of a census table's columns over one of them."""
    return f"({' + '.join(table + p for p in parts.split())}) / ({table}{whole} + {epsilon})"


_SCHOOLED = " + ".join(f"b150030{k}" for k in range(17, 26))
#: SQL by feature of the census tract.
CENSUS = {
    "MedianAgeInCT": "b01002001", "MedianAgeOfMenInCT": "b01002002", "MedianAgeOfWomenInCT": "b01002003", "UnweightedSampleCountOfPopulationInCT": "b00001001", "UnweightedSampleCountOfHousingUnitsInCT": "b00002001",
    "PercentageMenInCT": _share("b01001", "002"), "PercentageWomenInCT": _share("b01001", "026"), "PercentageWhiteInCT": _share("b02001", "002"), "PercentageBlackInCT": _share("b02001", "003"),
    "PercentageAsianInCT": _share("b02001", "005"), "PercentageHispanicInCT": _share("b03001", "003"), "PercentageForeignBornInCT": _share("b05002", "009"),
    "ProportionOfPopulationUnderAge18InCT": _share("b01001", "003 004 005 006 027 028 029 030"),
    "ProportionOfPopulationEnrolledInSchoolInCT": _share("b14001", "002", epsilon="0.0001D"),
    "ProportionOfPopulationOver25WithLessThanHighSchoolEducationInCT": f"(b15003001 - ({_SCHOOLED})) / (b15003001 + {EPSILON})",
    "ProportionOfPopulationVeteransInCT": _share("b21001", "002"), "ProportionOfPopulationWithIncomeBelowPovertyLevelInPastYearInCT": _share("b17001", "002"),
    "ProportionOfPopulationWithIncomeInPast12MonthsBelow45000DollarsInCT": _share("b19001", "002 003 004 005 006 007 008 009"),
    "MedianIncomeInPast12MonthsInCT": "b06011001", "MedianHouseholdIncomeInPast12MonthsInCT": "b19013001", "ProportionOfHouseholdsReceivingAssistanceOrFoodStampsInCT": _share("b19058", "002"),
    "ProportionOfHousingUnitsVacantInCT": _share("b25002", "003"), "ProportionOfHousingUnitsOccupiedByOwnerInCT": _share("b25003", "002"), "MedianYearStructureBuildInCT": "b25035001",
    "MedianYearRenterMovedIntoHousingUnitInCT": "b25039003", "MedianYearOwnerMovedIntoHousingUnitInCT": "b25039002", "MedianGrossRentInCT": "b25064001", "MedianPropertyValueInCT": "b25077001",
    "LowerQuartilePropertyValueInCT": "b25076001", "UpperQuartilePropertyValueInCT": "b25078001", "AverageHouseholdSizeInCT": "b25010001",
    "ProportionOfChildrenUnder18LivingWithSingleParentInCT": _share("b23008", "008 021"), "ProportionOfChildrenUnder18LivingWithMotherInCT": _share("b23008", "012 025"),
    "ProportionOfPopulationNeverMarriedInCT": _share("b12001", "003 012"), "ProportionOfPopulationDivorcedOrSeparatedInCT": _share("b12001", "007 010 016 019"),
    "ProportionOfPopulationWithoutHealthInsuranceInCT": _share("b27020", "006 017"), "ProportionOfWomenWhoGaveBirthInPast12MonthsInCT": _share("b13002", "002", "011", "0.0001D"),
}
#: By feature: the column of responders, and the test; parentheses are where the surveyed share of the divorced lacks them.
PROPORTIONS = {
    "WithFourYearCollegeDegreeOrHigher": ("education_level_code", "education_level_code >= 4"), "Male": ("gender_code", "gender_code = 1"), "Black": ("race_code", "race_code = 1"), "Hispanic": ("ethnicity_code", "ethnicity_code = 2"),
    "Asian": ("race_code", "race_code = 4"), "OtherRace": ("race_code", "race_code in (3, 5, 6, 7)"), "DivorcedOrSeparated": ("marital_status_code", "marital_status_code in (3, 4)"), "Married": ("marital_status_code", "marital_status_code = 2"),
}


def catalogue() -> dict[str, tuple[str, dict]]:
    """By feature: the function of event_features or banding that makes it, and what tells it from its family."""
    out: dict[str, tuple[str, dict]] = {}
    for name in ("Sustained", "Unjustified", "Preventable"):
        out[f"Label{name}"] = "outcome_label", {"value": f"number_of_{name.lower()}_allegations"}
    for name, part in (("Minute", "minute"), ("Hour", "hour"), ("DayOfWeek", "day_of_week"), ("YearQuarter", "quarter"), ("Month", "month"), ("Year", "year")):
        out[f"Dispatch{name}"] = "calendar_parts", {"part": part}
    for name, column in (("OriginalPriority", "dispatch_original_priority_code"), ("DispatchType", "dispatch_original_type"), ("DispatchSubType", "dispatch_original_subtype"), ("NumberOfUnitsAssigned", "units_assigned")):
        out[name] = "attribute", {"value": f"max({column})"}
    for name, f in MEANS.items():
        out[f"{name}OfficerTravelTime"] = "attribute", {"value": f"{f}(travel_time_minutes)", "only": "travel_time_minutes < 60"}
    out["DispatchCategory"] = "attribute", {"value": "min(dispatch_category)"}
    arrests = ("1Hour", "6Hours", "12Hours", "24Hours", "48Hours", "Week")
    for kind, flag in (("", None), ("Felony", "felony_flag"), ("Drugs", "drugs_flag"), ("StolenVehicle", "stolen_vehicle_flag")):
        for span in arrests:
            out[f"{kind}ArrestsInPast{span}"] = "band_counts", {"events": "arrests", "flag": flag, "seconds": SPANS[span]}
    for span in ("1Minute", "15Minutes", "30Minutes", "1Hour"):
        out[f"OfficersDispatchedInPast{span}"] = "band_counts", {"events": "dispatches", "flag": None, "seconds": SPANS[span]}
    for (mean, f), (past, step), (count, column) in product(MEANS.items(), PAST.items(), COUNTS.items()):
        out[f"OfficersDispatched{mean}{count}InPast{past}"] = "responder_history", {"function": f, "value": column, "window": step}
    for name, f in (("Average", "avg"), ("Maximum", "max"), ("Minimum", "min")):
        out[f"{name}AgeOfRespondingOfficers"] = "responder_age", {"function": f}
    for name, f in (("Highest", "max"), ("Lowest", "min")):
        out[f"{name}EducationLevelAmongRespondingOfficers"] = "responder_level", {"function": f}
    for name, (column, test) in PROPORTIONS.items():
        out[f"ProportionOfRespondingOfficers{name}"] = "responder_proportion", {"column": column, "test": test}
    for name, value in CENSUS.items():
        out[name] = "area_attributes", {"value": value}
    for family, events, spans in (("Arrests", "arrests", ("1Hour", "6Hours", "12Hours", "24Hours")), ("Dispatches", "dispatches", ("15Minutes", "30Minutes", "1Hour"))):
        for (radius, degrees), span in product(RADII.items(), spans):
            out[f"{family}Within{radius}RadiusInPast{span}"] = "radius_counts", {"events": events, "seconds": SPANS[span], "radius": degrees}
    for mean, radius, span in product(("Average", "Maximum"), ("100m", "500m", "1km"), ("1Hour", "3Hours", "6Hours", "24Hours", "48Hours")):
        out[f"{mean}OfficerDispatchesWithin{radius}RadiusInPast{span}"] = "entity_radius_counts", {"function": MEANS[mean], "seconds": SPANS[span], "radius": RADII[radius]}
    return out


#: The staging tables that each family reads, after dispatches.
FAMILIES = {
    "outcome_label": ("incidents",), "calendar_parts": (), "attribute": (), "band_counts": ("arrests", "dispatches"), "responder_history": ("responders", "past_incidents"), "responder_age": ("responders", "responding_officers"),
    "responder_level": ("responders", "responding_officers"), "responder_proportion": ("responders", "responding_officers"), "area_attributes": ("addresses", "tracts"), "radius_counts": ("arrests", "dispatches"), "entity_radius_counts": ("responders",),
}


def build(names: Sequence[str], tables: Mapping[str, DataFrame]) -> DataFrame:
    """event_id and these features of all dispatches, in one table (D16): each family's features come from one pass.

    tables: dispatches and those that FAMILIES names. Events that a family has no value for have null there.
    """
    known = catalogue()
    hub = tables["dispatches"].filter("event_id is not null")
    made = [part for family in FAMILIES if (chosen := {n: known[n][1] for n in names if known[n][0] == family}) for part in _family(family, chosen, hub, tables)]
    return event_features.event_table(hub, made, "event_id").select("event_id", *names)


def _responder_parts(tables: Mapping[str, DataFrame]) -> int:
    return max(4, -(-tables["responders"].count() // TASK_EVENTS))


def _responders(hub: DataFrame, tables: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """Events and their responders, once each; dealt by event into parts of some TASK_EVENTS, so that one shuffle serves the distinct rows and the join."""
    parts = _responder_parts(tables)
    return tables["responders"].select("event_id", "officer_id").repartition(parts, "event_id").distinct().join(hub.select("event_id", *columns).repartition(parts, "event_id"), "event_id")


def _family(family: str, chosen: Mapping[str, dict], hub: DataFrame, tables: Mapping[str, DataFrame]) -> Iterator[DataFrame]:
    """Tables of event_id and features, one for each pass that the chosen features of a family need."""
    renamed = lambda t, columns: t.select("event_id", *[F.col(old).alias(new) for new, old in columns.items()])
    groups = lambda key: {k: {n: p for n, p in chosen.items() if p.get(key) == k} for k in dict.fromkeys(p.get(key) for p in chosen.values())}
    time = "event_datetime"
    match family:
        case "outcome_label":
            parts = max(4, -(-hub.count() // TASK_EVENTS))
            dealt = [t.repartition(parts, "event_id") for t in (hub.select("event_id"), tables["incidents"])]
            yield event_features.outcome_labels(*dealt, "event_id", "event_id", {n: p["value"] for n, p in chosen.items()})
        case "calendar_parts":
            yield renamed(event_features.calendar_parts(hub, "event_id", time, [p["part"] for p in chosen.values()]), {n: p["part"] for n, p in chosen.items()})
        case "attribute":
            for only, some in groups("only").items():
                rows = hub.filter(only) if only else hub
                yield rows.groupBy("event_id").agg(*[F.expr(p["value"]).alias(n) for n, p in some.items()])
        case "band_counts":
            for events, some in groups("events").items():
                yield banding.flagged_band_counts(hub, tables[events].withColumn("_past", F.col(time)), "event_id", time, "_past", {n: (p["flag"], p["seconds"]) for n, p in some.items()})
        case "responder_history":
            windows = {f"{m}m": (m, d) for m, d in dict.fromkeys(p["window"] for p in chosen.values())}
            values = dict.fromkeys(p["value"] for p in chosen.values())
            functions = list(dict.fromkeys(p["function"] for p in chosen.values()))
            made = event_features.responder_history(_responders(hub, tables, time), tables["past_incidents"], "event_id", "officer_id", time, "report_date", {v: v for v in values}, windows, functions)
            yield renamed(made, {n: f"{p['function']}_{p['value']}_{p['window'][0]}m" for n, p in chosen.items()})
        case "responder_age":
            yield renamed(event_features.responder_age(_responders(hub, tables, time), tables["responding_officers"], "event_id", "officer_id", time, "date_of_birth", parts=_responder_parts(tables)), {n: f"{p['function']}_age" for n, p in chosen.items()})
        case "responder_level":
            made = event_features.responder_level(_responders(hub, tables), tables["responding_officers"], "event_id", "officer_id", "education_level_code", _responder_parts(tables))
            yield renamed(made, {n: f"{'highest' if p['function'] == 'max' else 'lowest'}_education_level_code" for n, p in chosen.items()})
        case "responder_proportion":
            for column, some in groups("column").items():
                yield event_features.responder_proportion(_responders(hub, tables), tables["responding_officers"], "event_id", "officer_id", column, {n: p["test"] for n, p in some.items()}, _responder_parts(tables))
        case "area_attributes":
            yield event_features.area_attributes(hub, tables["addresses"], tables["tracts"], "event_id", "address_id", "tract_id", {n: p["value"] for n, p in chosen.items()})
        case "radius_counts":
            for events, some in groups("events").items():
                yield banding.radius_counts(hub, tables[events], "event_id", time, time, {n: (p["seconds"], p["radius"]) for n, p in some.items()})
        case "entity_radius_counts":
            sites = io.stored(_responders(hub, tables, time, "lon", "lat"), "sites")
            bands = dict.fromkeys((p["seconds"], p["radius"]) for p in chosen.values())
            labels = {b: f"b{k}" for k, b in enumerate(bands)}
            functions = {f: f for f in dict.fromkeys(p["function"] for p in chosen.values())}
            made = banding.entity_radius_counts(sites, sites, "event_id", "officer_id", time, time, {labels[b]: b for b in bands}, functions)
            yield renamed(made, {n: f"{p['function']}_{labels[p['seconds'], p['radius']]}" for n, p in chosen.items()})
