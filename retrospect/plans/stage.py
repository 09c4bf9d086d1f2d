"""The test tables in the columns of the surveyed staging tables, for the feature catalogues.

Each staged table is a selection from one test table, by expressions that Spark and DuckDB read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..sources import io
from ..sources.schemas import STAGING, conform
from . import dispatches
from .tables import table

_ORDER = {"officer_id": "o_custkey", "event_id": "o_orderkey", "event_datetime": "o_orderdate"}
_TIMED = {**_ORDER, "event_datetime": "o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 1440)"}
_COUNTS = {
    "number_of_allegations": "o_orderkey % 4", "number_of_unjustified_allegations": "o_orderkey % 3 - 1", "number_of_justified_allegations": "o_orderkey % 2", "number_of_preventable_allegations": "o_orderkey % 5",
    "number_of_non_preventable_allegations": "o_orderkey % 7", "number_of_sustained_allegations": "CASE WHEN o_orderkey % 11 > 2 THEN o_orderkey % 3 END", "number_of_unsustained_allegations": "o_orderkey % 6",
}
_PLACE = {"lon": "cast((o_custkey * 37) % 1000 as double) / 5000", "lat": "cast((o_custkey * 91) % 1000 as double) / 5000"}
_AREAS = (
    "311_calls 311_requests population_density age_of_residents black_population household_income employment_rate vacant_land_area voter_participation age_of_death housing_density "
    "nuisance_violations violent_crime_rate property_crime_rate sidewalk_availability foreclosures disorder_call_rate"
).split()
#: Columns of census tables that the tract features read.
CENSUS_COLUMNS = sorted({c for value in dispatches.CENSUS.values() for c in re.findall(r"b\d{8}", value)})

#: By staged table: the test table and the expression of each column.
STAGED: dict[str, tuple[str, dict[str, str]]] = {
    "incidents": ("orders", {
        **_ORDER, "report_date": "o_orderdate", "date_of_judgment": "o_orderdate + INTERVAL 30 DAY", "grouped_incident_type_code": "o_orderkey % 4", "department_defined_policy_type": "o_orderpriority",
        "origination_type_code": "CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 3 END", "intervention_type_code": "o_orderkey % 3", "hours_active_suspension": "o_orderkey % 7 - 3", "hours_inactive_suspension": "o_orderkey % 9 - 4",
        "final_ruling_code": "o_orderkey % 8", **_COUNTS}),
    "officer_shifts": ("orders", {"officer_id": "o_custkey", "stop_datetime": "o_orderdate", "shift_type_code": "o_orderkey % 3", "shift_length": "(o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 30)) - o_orderdate"}),
    "arrests": ("orders", {
        **_TIMED, "arrest_type_code": "o_orderkey % 4", "arrest_day_of_week": "o_orderkey % 7", "suspect_race_code": "o_orderkey % 5", "suspect_ethnicity_code": "o_orderkey % 2", "ucr4_grouped_code": "o_orderkey % 6",
        "npa": "o_custkey % 20", "felony_flag": "o_orderkey % 2 = 0", "drugs_flag": "o_orderkey % 3 = 0", "stolen_vehicle_flag": "o_orderkey % 5 = 0", **_PLACE}),
    "demographics_npa": ("orders", {"npa": "o_custkey % 20", "year": "cast(year(o_orderdate) as int)", **{c: f"cast(o_orderkey % {k + 11} as double)" for k, c in enumerate(_AREAS)}}),
    "traffic_stops": ("orders", {
        **_ORDER, "searched_flag": "o_orderkey % 2 = 0", "use_of_force_flag": "o_orderkey % 9 = 0", "arrest_flag": "o_orderkey % 4 = 0", "injuries_flag": "o_orderkey % 8 = 0", "officer_injury_flag": "o_orderkey % 16 = 0",
        "search_consent_request_flag": "CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 3 = 1 END", "stopped_person_race_code": "o_orderkey % 5", "stop_type_code": "o_orderkey % 4", "stop_outcome_code": "o_orderkey % 3", "search_justification_code": "o_orderkey % 6"}),
    "field_interviews": ("events", {
        "officer_id": "user_id", "event_id": "event_id", "event_datetime": "ts", "interviewed_person_race": "event_id % 5", "field_interview_outcome_code": "event_id % 3", "searched_flag": "event_type = 'error'", "drugs_found_flag": "event_type = 'click'",
        "weapons_found_flag": "value > 50", "field_interview_type_code": "event_id % 4"}),
    "use_of_force": ("orders", {**_ORDER, "use_of_force_type_code": "o_orderkey % 4", "suspect_injury": "o_orderkey % 3 = 0"}),
    "dispatches": ("orders", {
        "dispatch_id": "o_orderkey", **_TIMED, "dispatch_final_type_code": "o_orderkey % 4", "dispatch_category": "o_orderpriority", "travel_time_minutes": "cast(o_orderkey % 90 as double)", "response_time_minutes": "cast(o_orderkey % 50 as double)",
        "time_on_scene_minutes": "CASE WHEN o_orderkey % 7 > 0 THEN cast(o_orderkey % 70 as double) END", "dispatch_original_priority_code": "o_orderkey % 6", "dispatch_original_type": "o_orderstatus", "dispatch_original_subtype": "o_orderpriority", "units_assigned": "o_orderkey % 8", "address_id": "o_custkey", **_PLACE}),
    "dispatch_geo_time_officer": ("orders", {"dispatch_id": "o_orderkey", "officer_id": "o_custkey", "division_id": "o_custkey % 4"}),
    "officer_outside_employment": ("orders", {"officer_id": "o_custkey", "date_time": "o_orderdate", "hours_on_shift": "cast(o_orderkey % 12 as double)", "hourly_rate": "CASE WHEN o_orderkey % 5 > 0 THEN cast(o_orderkey % 40 as double) END"}),
    "department_eis_alerts": ("orders", {"officer_id": "o_custkey", "date_created": "o_orderdate", "intervention_type": "o_orderkey % 3", "event_type": "o_orderkey % 5"}),
    "officers_hub": ("customer", {"officer_id": "c_custkey", "date_of_birth": "TIMESTAMP '1970-01-01 00:00:00' + INTERVAL 1 DAY * (c_custkey % 9000)", "gender_code": "c_custkey % 3", "race_code": "c_custkey % 8", "ethnicity_code": "c_custkey % 3", "military_service_flag": "CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 4 = 1 END"}),
    "officer_characteristics": ("customer", {"officer_id": "c_custkey", "education_level_code": "c_custkey % 7"}),
    "officer_trainings": ("customer", {"officer_id": "c_custkey + 5", "score": "cast(c_custkey % 100 as double)"}),
    "officer_roles": ("orders", {"officer_id": "o_custkey", "job_start_date": "o_orderdate", "rank_code": "o_orderkey % 4", "bid_transfer": "o_orderkey % 2", "no_pay_no_bid_change_transfer": "o_orderkey % 3", "paygrade_raw": "o_orderkey % 9", "police_area_id": "o_orderkey % 5"}),
    "officer_marital": ("customer", {"officer_id": "c_custkey", "marital_status_code": "c_custkey % 5"}),
    "officer_compliments": ("orders", dict(_ORDER)),
    "responders": ("lineitem", {"event_id": "l_orderkey", "officer_id": "l_suppkey"}),
    "past_incidents": ("orders", {"officer_id": "o_custkey % 50 + 1", "report_date": "o_orderdate", **_COUNTS}),
    "responding_officers": ("supplier", {
        "officer_id": "s_suppkey", "date_of_birth": "TIMESTAMP '1960-01-01 00:00:00' + INTERVAL 1 DAY * ((s_suppkey * 97) % 9000)", "gender_code": "s_suppkey % 3", "race_code": "s_suppkey % 8", "ethnicity_code": "s_suppkey % 3", "education_level_code": "CASE WHEN s_suppkey % 6 > 0 THEN s_suppkey % 7 END", "marital_status_code": "s_suppkey % 5"}),
    "addresses": ("customer", {"address_id": "c_custkey", "tract_id": "c_nationkey"}),
    "tracts": ("nation", {"tract_id": "n_nationkey", **{c: f"cast((n_nationkey * {k + 3}) % 17 + {k % 5} as double)" for k, c in enumerate(CENSUS_COLUMNS)}}),
}
#: Codes of every staged lookup; a value is named after its code.
CODES = range(5)
LOOKUP = [(k, f"Kind {k}") for k in CODES]


def lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LOOKUP, "code int, value string")


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, columns = STAGED[name]
    return conform(table(spark, sf_dir, base).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()]), name)


def staged_sql(name: str) -> str:
    base, columns = STAGED[name]
    return "(SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {base})"


def staging_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staged table in its schema, and what each of its constraints finds."""
    tables = {name: staged(spark, sf_dir, name) for name in STAGED}
    specs = {name: STAGING[name] for name in STAGED}
    return io.audit_all([io.Audited(tables[n], n, s.primary, s.unique, s.required, {c: (tables[o], k) for c, (o, k) in s.foreign.items()}, s.checks) for n, s in specs.items()])


def _audit_sql() -> str:
    def line(name: str, label: str, sql: str) -> str:
        return f"SELECT '{name}' AS table_name, '{label}' AS \"constraint\", ({sql})::BIGINT AS violations"

    out = []
    for name in STAGED:
        spec, rows = STAGING[name], staged_sql(name)
        out += [line(name, f"{kind} ({', '.join(key)})", f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {rows} GROUP BY {', '.join(key)})") for kind, key in [*([("primary key", spec.primary)] if spec.primary else []), *[("unique", u) for u in spec.unique]]]
        out += [line(name, f"not null ({c})", f"SELECT count(*) FROM {rows} WHERE {c} IS NULL") for c in [*spec.required, *spec.primary]]
        out += [line(name, f"check ({label})", f"SELECT count(*) FROM {rows} WHERE NOT ({check})") for label, check in spec.checks.items()]
        out += [line(name, f"foreign key ({c})", f"SELECT count(*) FROM {rows} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {staged_sql(o)} WHERE {k} IS NOT NULL)") for c, (o, k) in spec.foreign.items()]
    return " UNION ALL ".join(out)


QUERIES = {"staging_audit": staging_audit}
SQL = {"staging_audit": _audit_sql()}
