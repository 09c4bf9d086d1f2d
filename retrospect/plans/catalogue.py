"""A query for each block of officer features and each family of dispatch features, on the staged test tables, and its SQL.

Numbers are doubles of six digits in queries and SQL, whatever their type.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import Quantity, column_name, lookup_quantities
from . import dispatches, officers
from .stage import LOOKUP, lookup, staged, staged_sql
from .tables import DATES, EVENT_DATES, dates

MONTHS = {"P1M": (1, 0), "P1Y": (12, 0)}
DAYS = {"P1D": (0, 1), "P7D": (0, 7)}
DIGITS = 6


class Staged(Mapping):
    """The staged tables by name, each made when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return staged(self.spark, self.sf_dir, name)

    def __iter__(self):
        return iter(())

    def __len__(self) -> int:
        return 0


def _numbers(df: DataFrame, keys: set[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keys or t == "string" else F.round(F.col(c).cast("double"), DIGITS).alias(c) for c, t in df.dtypes])


def _number(sql: str, name: str) -> str:
    return f'round(({sql})::DOUBLE, {DIGITS}) AS "{name}"'


# --- officers ---------------------------------------------------------------------------------------


def _when(name: str) -> tuple[tuple[str, ...], dict[str, tuple[int, int]]]:
    return (EVENT_DATES, DAYS) if name == "FieldInterviews" else (DATES, MONTHS)


def officer_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        days, windows = _when(name)
        lookups = dict.fromkeys({f.lookup for f in officers.BLOCKS[name].features if f.lookup}, lookup(spark))
        return _numbers(officers.features(name, Staged(spark, sf_dir), lookups, dates(spark, days), windows), {"officer_id", "as_of_date"})

    return run


#: The values that columns of one column for each value have in the test tables.
VALUES = {"department_defined_policy_type": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "dispatch_category": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "division_id": [0, 1, 2, 3]}

_LEFT_JOINS = " LEFT JOIN ".join(["{hub}", "(SELECT DISTINCT officer_id, education_level_code FROM {a}) USING (officer_id)", "(SELECT DISTINCT officer_id, score FROM {b}) USING (officer_id)", "(SELECT DISTINCT officer_id, rank_code FROM {c}) USING (officer_id)", "(SELECT DISTINCT officer_id, marital_status_code FROM {d}) USING (officer_id)"])


def _source_sql(name: str, span: str) -> str:
    own = staged_sql(officers.JOINED[name][0] if name in officers.JOINED else officers.BLOCKS[name].source)
    if span == "monthly":
        counts = ", ".join(f"{v} AS {k}" for k, v in officers.MONTHLY[name].items())
        return f"(SELECT officer_id, date_trunc('month', {officers.BLOCKS[name].date})::TIMESTAMP AS month, {counts} FROM {own} GROUP BY ALL)"
    if name == "UseOfForce":
        return f"(SELECT * FROM {own} LEFT JOIN (SELECT event_id, event_datetime, officer_id, number_of_unjustified_allegations, intervention_type_code FROM {staged_sql('incidents')}) USING (event_id, event_datetime, officer_id))"
    if name == "Dispatches":
        return f"(SELECT * FROM {own} LEFT JOIN {staged_sql('dispatch_geo_time_officer')} USING (dispatch_id, officer_id))"
    if name == "DemographicNpaArrests":
        return f'(SELECT * FROM {own} a JOIN {staged_sql("demographics_npa")} d ON a.npa = d.npa AND year(a.event_datetime) = d."year" + 1)'
    if name == "OfficerCharacteristics" and span == "static":
        return "(SELECT * FROM " + _LEFT_JOINS.format(hub=own, a=staged_sql("officer_characteristics"), b=staged_sql("officer_trainings"), c=staged_sql("officer_roles"), d=staged_sql("officer_marital")) + ")"
    return own


def _quantities(name: str, span: str) -> list[Quantity]:
    out: list[Quantity] = []
    for f in (f for f in officers.BLOCKS[name].features if f.span == span):
        if f.kind == "plain":
            out.append(Quantity(column_name(f.name), f.column, f.functions))
        else:
            rows = LOOKUP if f.kind == "lookup" else [(v, v) for v in VALUES[f.column]]
            out += lookup_quantities(column_name(f.name), f.column, rows, f.functions, f.condition, f.weight)
    return out


def _duck(value: str) -> str:
    return re.sub(r"datediff\(as_of_date, (\w+)\)", r"date_diff('day', \1, as_of_date)", value).replace("`", '"')


_MODE = "list_extract(list_sort(list_transform(map_entries(histogram({x})), lambda e: {{'a': -e.value::BIGINT, 'b': e.key}})), 1).b"
_SQL_OF = {"variance": "var_samp({x})", "cv": "stddev_samp({x}) / nullif(avg({x}), 0)", "mode": _MODE}


def _aggregate_sql(f: str, value: str) -> str:
    return _SQL_OF[f].format(x=value) if f in _SQL_OF else f"{f}({value})"


def officer_sql(name: str) -> str:
    days, windows = _when(name)
    spec, dated, undated = officers.BLOCKS[name], [], []
    as_of = "(SELECT unnest([" + ", ".join(f"TIMESTAMP '{d}'" for d in days) + "]) AS as_of_date)"
    bound = lambda step: f"as_of_date - INTERVAL {step[0]} MONTH - INTERVAL {step[1]} DAY"
    for span in dict.fromkeys(f.span for f in spec.features):
        source, found = _source_sql(name, span), _quantities(name, span)
        prefix = {"lookback": spec.prefix, "static": spec.prefix, "history": spec.history_prefix, "monthly": spec.monthly_prefix}[span]
        label = lambda *parts: "_".join(x for x in parts if x).lower()
        date = "month" if span == "monthly" else spec.date
        if span == "static":
            undated.append(f"(SELECT officer_id, {', '.join(_number(_aggregate_sql(f, _duck(q.value)), label(prefix, 'id', q.name, f)) for q in found for f in q.functions)} FROM {source} GROUP BY 1)")
        elif span == "history":
            dated.append(f"(SELECT officer_id, as_of_date, {', '.join(_number(_aggregate_sql(f, _duck(q.value)), label(prefix, 'id', 'all', q.name, f)) for q in found for f in q.functions)} FROM {source} JOIN {as_of} ON {date} < as_of_date GROUP BY 1, 2)")
        else:
            inside = lambda w, v: f"CASE WHEN {date} >= {bound(windows[w])} THEN {_duck(v)} END"
            columns = [_number(_aggregate_sql(f, inside(w, q.value)), label(prefix, "id", w, q.name, f)) for w in windows for q in found for f in q.functions]
            widest = max(windows.values(), key=lambda s: s[0] * 31 + s[1])
            dated.append(f"(SELECT officer_id, as_of_date, {', '.join(columns)} FROM {source} JOIN {as_of} ON {date} < as_of_date AND {date} >= {bound(widest)} GROUP BY 1, 2)")
    out = "SELECT * FROM " + " FULL JOIN ".join([*dated[:1], *(f"{d} USING (officer_id, as_of_date)" for d in dated[1:])]) if dated else f"SELECT * FROM {undated[0]}"
    return out + "".join(f" FULL JOIN {u} USING (officer_id)" for u in undated) if dated else out


# --- dispatches -------------------------------------------------------------------------------------

_HUB = staged_sql("dispatches")
_RESPONDERS = f"(SELECT DISTINCT d.event_id, r.officer_id, d.event_datetime, d.lon, d.lat FROM {staged_sql('responders')} r JOIN {_HUB} d USING (event_id))"


def chosen(family: str, test: Callable[[str], bool] = lambda name: True) -> dict[str, dict]:
    return {n: p for n, (f, p) in dispatches.catalogue().items() if f == family and test(n)}


def _labels_sql(some: dict[str, dict]) -> str:
    return f"SELECT d.event_id, {', '.join(_number('coalesce(sum(' + p['value'] + '), 0) > 0', n) for n, p in some.items())} FROM {_HUB} d LEFT JOIN {staged_sql('incidents')} i USING (event_id) GROUP BY 1"


def _calendar_sql(some: dict[str, dict]) -> str:
    part = {"day_of_week": "dayofweek"}
    return f"SELECT event_id, {', '.join(_number(f'max({part.get(p["part"], p["part"])}(event_datetime))', n) for n, p in some.items())} FROM {_HUB} GROUP BY 1"


_TEXTS = {"DispatchType", "DispatchSubType", "DispatchCategory"}


def _attribute_sql(some: dict[str, dict]) -> str:
    value = lambda p: p["value"] + (f" FILTER (WHERE {p['only']})" if "only" in p else "")
    return f"SELECT event_id, {', '.join(f'{value(p)} AS "{n}"' if n in _TEXTS else _number(value(p), n) for n, p in some.items())} FROM {_HUB} GROUP BY 1"


def _bands_sql(some: dict[str, dict]) -> str:
    parts = []
    for events, flag in dict.fromkeys((p["events"], p["flag"]) for p in some.values()):
        own = {n: p for n, p in some.items() if (p["events"], p["flag"]) == (events, flag)}
        counts = ", ".join(_number(f"count(*) FILTER (WHERE b.event_datetime >= a.event_datetime - INTERVAL {p['seconds']} SECOND)", n) for n, p in own.items())
        parts.append(f"(SELECT a.event_id, {counts} FROM {_HUB} a JOIN (SELECT * FROM {staged_sql(events)} WHERE {flag or 'true'}) b ON b.event_datetime <= a.event_datetime AND b.event_datetime >= a.event_datetime - INTERVAL {max(p['seconds'] for p in own.values())} SECOND GROUP BY 1)")
    return f"SELECT * FROM {' FULL JOIN '.join([parts[0], *(f'{x} USING (event_id)' for x in parts[1:])])}"


def _history_sql(some: dict[str, dict]) -> str:
    each = {(p["value"], p["window"][0]) for p in some.values()}
    sums = ", ".join(f"sum(coalesce({v}, 0)) FILTER (WHERE report_date >= event_datetime - INTERVAL {m} MONTH) AS {v}_{m}" for v, m in sorted(each))
    widest = max(m for _, m in each)
    inner = f"(SELECT r.event_id, officer_id, {sums} FROM {_RESPONDERS} r JOIN {staged_sql('past_incidents')} USING (officer_id) WHERE report_date < event_datetime AND report_date >= event_datetime - INTERVAL {widest} MONTH GROUP BY 1, 2)"
    return f"SELECT event_id, {', '.join(_number(f'{p["function"]}({p["value"]}_{p["window"][0]})', n) for n, p in some.items())} FROM {inner} GROUP BY 1"


def _people_sql(some: dict[str, dict]) -> str:
    def value(n: str, p: dict) -> str:
        if "test" in p:
            return f"sum(CASE WHEN {p['test']} THEN 1 ELSE 0 END) / (count({p['column']}) + 0.00001::DOUBLE)"
        return f"{p['function']}(" + ("round_even(date_diff('day', date_of_birth, event_datetime) / 365, 0)" if "Age" in n else "education_level_code") + ")"

    return f"SELECT event_id, {', '.join(_number(value(n, p), n) for n, p in some.items())} FROM {_RESPONDERS} JOIN {staged_sql('responding_officers')} USING (officer_id) GROUP BY 1"


def _areas_sql(some: dict[str, dict]) -> str:
    duck = lambda v: re.sub(r"(0\.0+1)D", r"\1::DOUBLE", v)
    return f"SELECT event_id, {', '.join(_number(duck(p['value']), n) for n, p in some.items())} FROM {_HUB} JOIN {staged_sql('addresses')} USING (address_id) JOIN {staged_sql('tracts')} USING (tract_id)"


def _near(p: dict) -> str:
    return f"b.event_datetime >= a.event_datetime - INTERVAL {p['seconds']} SECOND AND (a.lon - b.lon) * (a.lon - b.lon) + (a.lat - b.lat) * (a.lat - b.lat) <= {p['radius'] * p['radius']!r}::DOUBLE"


def _widest(some: dict[str, dict]) -> dict:
    return {k: max(p[k] for p in some.values()) for k in ("seconds", "radius")}


def _radius_sql(some: dict[str, dict]) -> str:
    parts = []
    for events in dict.fromkeys(p["events"] for p in some.values()):
        own = {n: p for n, p in some.items() if p["events"] == events}
        parts.append(f"(SELECT a.event_id, {', '.join(_number(f'count(*) FILTER (WHERE {_near(p)})', n) for n, p in own.items())} FROM {_HUB} a JOIN {staged_sql(events)} b ON b.event_datetime < a.event_datetime AND {_near(_widest(own))} GROUP BY 1)")
    return f"SELECT * FROM {' FULL JOIN '.join([parts[0], *(f'{x} USING (event_id)' for x in parts[1:])])}"


def _own_radius_sql(some: dict[str, dict]) -> str:
    bands = dict.fromkeys((p["seconds"], p["radius"]) for p in some.values())
    label = {b: f"b{k}" for k, b in enumerate(bands)}
    counts = ", ".join(f"count(*) FILTER (WHERE {_near({'seconds': s, 'radius': r})}) AS {label[s, r]}" for s, r in bands)
    inner = f"(SELECT a.event_id, a.officer_id, {counts} FROM {_RESPONDERS} a JOIN {_RESPONDERS} b ON a.officer_id = b.officer_id AND b.event_datetime < a.event_datetime AND {_near(_widest(some))} GROUP BY 1, 2)"
    return f"SELECT event_id, {', '.join(_number(f'{p["function"]}(nullif({label[p["seconds"], p["radius"]]}, 0))', n) for n, p in some.items())} FROM {inner} GROUP BY 1"


#: By query: its features and their SQL. A family of many features with several kinds of events has a query for each kind.
DISPATCHES: dict[str, tuple[dict[str, dict], Callable[[dict[str, dict]], str]]] = {
    "dispatch_labels": (chosen("outcome_label"), _labels_sql),
    "dispatch_calendar": (chosen("calendar_parts"), _calendar_sql),
    "dispatch_attributes": (chosen("attribute", lambda n: "Travel" not in n and n != "DispatchCategory"), _attribute_sql),
    "dispatch_travel_times": (chosen("attribute", lambda n: "Travel" in n), _attribute_sql),
    "dispatch_category": (chosen("attribute", lambda n: n == "DispatchCategory"), _attribute_sql),
    "dispatch_arrests_in_band": (chosen("band_counts", lambda n: "Arrests" in n), _bands_sql),
    "dispatch_officers_in_band": (chosen("band_counts", lambda n: "Arrests" not in n), _bands_sql),
    "dispatch_responder_history": (chosen("responder_history"), _history_sql),
    "dispatch_responder_ages": (chosen("responder_age"), _people_sql),
    "dispatch_responder_education": (chosen("responder_level"), _people_sql),
    "dispatch_responder_shares": (chosen("responder_proportion"), _people_sql),
    "dispatch_census": (chosen("area_attributes"), _areas_sql),
    "dispatch_arrests_nearby": (chosen("radius_counts", lambda n: n.startswith("Arrests")), _radius_sql),
    "dispatch_dispatches_nearby": (chosen("radius_counts", lambda n: n.startswith("Dispatches")), _radius_sql),
    "dispatch_own_dispatches_nearby": (chosen("entity_radius_counts"), _own_radius_sql),
}


def dispatch_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _numbers(dispatches.build(list(DISPATCHES[name][0]), Staged(spark, sf_dir)), {"event_id"})


def dispatch_sql(name: str) -> str:
    some, sql = DISPATCHES[name]
    return f"SELECT event_id, {', '.join(chr(34) + n + chr(34) for n in some)} FROM (SELECT DISTINCT event_id FROM {_HUB}) LEFT JOIN ({sql(some)}) USING (event_id)"


_OFFICERS = {f"officer_{re.sub(r'(?<=[a-z])(?=[A-Z])', '_', name.removeprefix('Officer')).lower()}": name for name in officers.BLOCKS}
QUERIES = {**{q: officer_query(name) for q, name in _OFFICERS.items()}, **{q: dispatch_query(q) for q in DISPATCHES}}
SQL = {**{q: officer_sql(name) for q, name in _OFFICERS.items()}, **{q: dispatch_sql(q) for q in DISPATCHES}}
