"""Schemas of the staging tables that features are made from, with their keys and checks; tables are held to them as they are read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types that a column may have instead of the declared one, since all their values are values of it.
NARROWER = {"bigint": {"int", "smallint", "tinyint"}, "int": {"smallint", "tinyint"}, "double": {"float", "int", "smallint", "tinyint"}, "timestamp_ntz": {"date"}}


@dataclass(frozen=True)
class Staging:
    """Columns of a table by type, and what holds of its rows. foreign: by column, the table and column that have its values."""

    columns: Mapping[str, str]
    primary: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    required: Sequence[str] = ()
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for kind, names in self.columns.items() for name in names.split()))


_OFFICER = {"officer_id": ("officers_hub", "officer_id")}
_ALLEGED = " ".join(f"number_of_{kind}allegations" for kind in ("", "unjustified_", "justified_", "preventable_", "non_preventable_", "sustained_", "unsustained_"))


def _hub(ids: str, **columns: str) -> Staging:
    """A table of events, one row for each."""
    return Staging({"bigint": f"officer_id event_id {ids}", "timestamp_ntz": "event_datetime", **columns}, ["event_id"], foreign=_OFFICER, required=["event_datetime"])


def _of_officers(columns: Mapping[str, str], **more) -> Staging:
    """A table of what befell officers, with any number of rows for each."""
    return Staging(columns, foreign=_OFFICER, **more)


STAGING: dict[str, Staging] = {
    "incidents": Staging(
        {"bigint": f"officer_id event_id grouped_incident_type_code origination_type_code intervention_type_code hours_active_suspension hours_inactive_suspension final_ruling_code {_ALLEGED}",
         "timestamp_ntz": "event_datetime report_date date_of_judgment", "string": "department_defined_policy_type"},
        ["event_id"], foreign=_OFFICER, checks={"judged after the report": "date_of_judgment >= report_date", "allegations": "number_of_allegations >= 0"}),
    "officer_shifts": _of_officers({"bigint": "officer_id shift_type_code", "timestamp_ntz": "stop_datetime", "interval day to second": "shift_length"}, checks={"length": "shift_length >= INTERVAL '0' DAY"}),
    "arrests": _hub("arrest_type_code arrest_day_of_week suspect_race_code suspect_ethnicity_code ucr4_grouped_code npa", boolean="felony_flag drugs_flag stolen_vehicle_flag", double="lon lat"),
    "demographics_npa": Staging({
        "bigint": "npa", "int": "year",
        "double": "311_calls 311_requests population_density age_of_residents black_population household_income employment_rate vacant_land_area voter_participation age_of_death housing_density "
        "nuisance_violations violent_crime_rate property_crime_rate sidewalk_availability foreclosures disorder_call_rate"}, unique=[["npa", "year"]]),
    "traffic_stops": _hub("stopped_person_race_code stop_type_code stop_outcome_code search_justification_code", boolean="searched_flag use_of_force_flag arrest_flag injuries_flag officer_injury_flag search_consent_request_flag"),
    "field_interviews": _hub("interviewed_person_race field_interview_outcome_code field_interview_type_code", boolean="searched_flag drugs_found_flag weapons_found_flag"),
    "use_of_force": _hub("use_of_force_type_code", boolean="suspect_injury"),
    "dispatches": Staging(
        {"bigint": "dispatch_id officer_id event_id dispatch_final_type_code dispatch_original_priority_code units_assigned address_id", "timestamp_ntz": "event_datetime", "string": "dispatch_category dispatch_original_type dispatch_original_subtype",
         "double": "travel_time_minutes response_time_minutes time_on_scene_minutes lon lat"},
        required=["event_id", "time_on_scene_minutes"], foreign={**_OFFICER, "address_id": ("addresses", "address_id")}, checks={"travel time": "travel_time_minutes >= 0", "travel within the response": "travel_time_minutes <= response_time_minutes"}),
    "dispatch_geo_time_officer": _of_officers({"bigint": "dispatch_id officer_id division_id"}, unique=[["dispatch_id", "officer_id"]]),
    "officer_outside_employment": _of_officers({"bigint": "officer_id", "timestamp_ntz": "date_time", "double": "hours_on_shift hourly_rate"}, required=["hourly_rate"]),
    "department_eis_alerts": _of_officers({"bigint": "officer_id intervention_type event_type", "timestamp_ntz": "date_created"}),
    "officers_hub": Staging({"bigint": "officer_id gender_code race_code ethnicity_code", "timestamp": "date_of_birth", "boolean": "military_service_flag"}, ["officer_id"], required=["military_service_flag"]),
    "officer_characteristics": _of_officers({"bigint": "officer_id education_level_code"}, unique=[["officer_id"]]),
    "officer_trainings": _of_officers({"bigint": "officer_id", "double": "score"}, checks={"score": "score BETWEEN 1 AND 100"}),
    "officer_roles": _of_officers({"bigint": "officer_id rank_code bid_transfer no_pay_no_bid_change_transfer paygrade_raw police_area_id", "timestamp_ntz": "job_start_date"}, unique=[["officer_id", "job_start_date"]]),
    "officer_marital": _of_officers({"bigint": "officer_id marital_status_code"}),
    "officer_compliments": _hub(""),
    "responders": Staging({"bigint": "event_id officer_id"}, ["event_id", "officer_id"], foreign={"officer_id": ("responding_officers", "officer_id"), "event_id": ("dispatches", "event_id")}),
    "past_incidents": Staging({"bigint": f"officer_id {_ALLEGED}", "timestamp_ntz": "report_date"}, required=["number_of_sustained_allegations"], foreign={"officer_id": ("responding_officers", "officer_id")}),
    "responding_officers": Staging({"bigint": "officer_id gender_code race_code ethnicity_code education_level_code marital_status_code", "timestamp": "date_of_birth"}, ["officer_id"], required=["education_level_code"]),
    "addresses": Staging({"bigint": "address_id", "int": "tract_id"}, ["address_id"], foreign={"tract_id": ("tracts", "tract_id")}),
    "tracts": Staging({"int": "tract_id"}, ["tract_id"]),
}


def conform(table: DataFrame, name: str, spec: Staging | None = None) -> DataFrame:
    """The table in its schema's types, its columns first and in order; further columns (those of census tables) stay behind them.

    A column that is missing, or of a type that may hold what the declared one can't, is an error that names all such columns. Only
    the schema is looked at: no row is read.
    """
    declared = (spec or STAGING[name]).schema()
    has = {f.name: f.dataType.simpleString() for f in table.schema}
    wants = {f.name: f.dataType.simpleString() for f in declared}
    wrong = [f"{c}: {has.get(c, 'missing')} instead of {t}" for c, t in wants.items() if has.get(c) != t and has.get(c) not in NARROWER.get(t, ())]
    if wrong:
        raise ValueError(f"{name} has not its schema: {'; '.join(wrong)}")
    return table.select(*[F.col(f"`{c}`") if has[c] == t else F.col(f"`{c}`").cast(t).alias(c) for c, t in wants.items()], *[f"`{c}`" for c in has if c not in wants])


def staging(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A staging table of Parquet files, held to its schema (S3)."""
    return conform(spark.read.parquet(path), name)
