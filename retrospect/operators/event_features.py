"""Features of single events (dispatches): outcome labels, calendar parts, attributes and their responders' history."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import io
from .banding import trailing_sums

#: Added to the count of a proportion, as the surveyed definition has it.
EPSILON = 0.00001
#: Rows or past events of a responder up to which its windows are summed in one task; seconds of a bucket of the others.
BUSY, DAY = 100_000, 86_400


def in_period(events: DataFrame, time: str, start: str, end: str) -> DataFrame:
    return events.filter(F.col(time).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def outcome_label(events: DataFrame, outcomes: DataFrame, event: str, key: str, value: str, name: str) -> DataFrame:
    """event, name: 1 if the values of the event's outcomes sum to more than 0, else 0; no outcome counts as 0."""
    return outcome_labels(events, outcomes, event, key, {name: value})


def outcome_labels(events: DataFrame, outcomes: DataFrame, event: str, key: str, values: Mapping[str, str]) -> DataFrame:
    """event and a label as that of `outcome_label` for each name and value, all by one join."""
    joined = events.filter(F.col(event).isNotNull()).join(outcomes.select(key, *dict.fromkeys(values.values())), key, "left")
    return joined.groupBy(event).agg(*[(F.sum(F.coalesce(F.col(v), F.lit(0))) > 0).cast("int").alias(k) for k, v in values.items()])


#: Parts of a time; Sunday is day 0 of the week.
CALENDAR: dict[str, object] = {"minute": F.minute, "hour": F.hour, "day_of_week": lambda c: F.dayofweek(c) - 1, "quarter": F.quarter, "month": F.month, "year": F.year}


def calendar_parts(events: DataFrame, event: str, time: str, parts: Sequence[str] = tuple(CALENDAR)) -> DataFrame:
    """event and the greatest value of each part of its times."""
    return events.groupBy(event).agg(*[F.max(CALENDAR[p](F.col(time))).alias(p) for p in parts])


def attribute(events: DataFrame, details: DataFrame, event: str, key: str, columns: Mapping[str, str], only: Column | None = None) -> DataFrame:
    """event and SQL aggregates of its details, by name, over details that pass `only`."""
    joined = events.select(event, *([key] if key != event else [])).distinct().join(details, key)
    joined = joined.filter(only) if only is not None else joined
    return joined.groupBy(event).agg(*[F.expr(v).alias(k) for k, v in columns.items()])


def responder_history(responders: DataFrame, past: DataFrame, event: str, entity: str, time: str, past_time: str, quantities: Mapping[str, str], windows: Mapping[str, tuple[int, int]], functions: Sequence[str] = ("avg", "min", "max"), parts: int | None = None) -> DataFrame:
    """event and {function}_{quantity}_{window}: sums over each responder's past events, then a function over responders.

    Past events lie in [time - window, time). A responder counts for a window just if a past event lies in it. All
    windows and quantities (whole numbers) come from the running sums of each responder's past; responders without any
    past event go before their windows are laid out. Those of up to BUSY rows and past events each are summed in one task
    that lays their windows out, so that responders, past events and sums are dealt once each; others go by buckets of time. parts: tasks
    that the windows are dealt into.
    """
    ours = past.withColumnRenamed(past_time, "_past") if past_time == time else past
    known_to = io.stored(ours.select(entity).dropna().groupBy(entity).agg(F.count(F.lit(1)).alias("_n")), "entities")
    responders = io.stored(responders.select(event, entity, time).join(known_to, entity, "left_semi"), "responders")
    over = lambda counts: counts.filter(F.col("_n") > BUSY).select(entity)
    busy = io.stored(over(known_to).unionByName(over(responders.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")))).distinct(), "busy")
    sums = lambda rows, events, bucket: trailing_sums(rows, events, [event, entity], [entity], time, "_past" if past_time == time else past_time, windows, quantities, False, bucket, parts)
    if busy.isEmpty():
        each = sums(responders, ours, None)
    else:
        few, many = ([rows.join(busy, entity, how) for rows in (responders, ours)] for how in ("left_anti", "left_semi"))
        each = sums(*few, None).unionByName(sums(*many, DAY))
    names = {f"{q}_{k}": F.when(F.col(k) > 0, F.col(f"{q}_{k}")) for k in windows for q in quantities}
    each = each.select(event, *[v.alias(k) for k, v in names.items()])
    each = each.repartition(parts, event) if parts else each
    return each.groupBy(event).agg(*[getattr(F, f)(k).alias(f"{f}_{k}") for f in functions for k in names])


def _by_event(responders: DataFrame, entities: DataFrame, event: str, entity: str, values: Mapping[str, Column], made: Mapping[str, Column], parts: int | None) -> DataFrame:
    """event and aggregates (made) of the values of its responders, of which a responder has one row. parts: tasks that responders are dealt into, by
    entity for the join and by event for the groups, so that a task's rows stay as tables grow."""
    dealt = lambda rows, key: rows.repartition(parts, key) if parts else rows
    joined = dealt(responders, entity).join(dealt(entities, entity), entity).select(event, *[v.alias(k) for k, v in values.items()])
    return dealt(joined, event).groupBy(event).agg(*[v.alias(k) for k, v in made.items()])


def _ages(time: str, born: str) -> tuple[dict[str, Column], dict[str, Column]]:
    return {"_age": F.rint(F.datediff(F.col(time), F.col(born)) / 365)}, {f"{f}_age": getattr(F, f)("_age") for f in ("avg", "max", "min")}


def _levels(level: str) -> tuple[dict[str, Column], dict[str, Column]]:
    return {level: F.col(level)}, {f"highest_{level}": F.max(level), f"lowest_{level}": F.min(level)}


def responder_age(responders: DataFrame, entities: DataFrame, event: str, entity: str, time: str, born: str, level: str | None = None, parts: int | None = None) -> DataFrame:
    """event and avg_age, max_age, min_age of its responders, in days over 365, rounded half to even (D9); with a level those of
    `responder_level` too, from the same rows."""
    (values, made), (others, more) = _ages(time, born), _levels(level) if level else ({}, {})
    return _by_event(responders.select(event, entity, time), entities.select(entity, born, *others), event, entity, values | others, made | more, parts)


def responder_level(responders: DataFrame, entities: DataFrame, event: str, entity: str, level: str, parts: int | None = None) -> DataFrame:
    """event and the greatest and least level of its responders."""
    return _by_event(responders.select(event, entity), entities.select(entity, level), event, entity, *_levels(level), parts)


def responder_proportion(responders: DataFrame, entities: DataFrame, event: str, entity: str, column: str, tests: Mapping[str, str], parts: int | None = None) -> DataFrame:
    """event and the share of its responders that pass each test: passes / (known values + EPSILON)."""
    shares = {k: F.sum(F.when(F.expr(v), 1).otherwise(0)) / (F.count(column) + EPSILON) for k, v in tests.items()}
    return _by_event(responders.select(event, entity), entities.select(entity, column), event, entity, {column: F.col(column)}, shares, parts)


def area_attributes(events: DataFrame, places: DataFrame, areas: DataFrame, event: str, place: str, area: str, values: Mapping[str, str]) -> DataFrame:
    """event and SQL values of the area (census tract) it lies in, by two equi-joins."""
    return events.select(event, place).join(places.select(place, area), place).join(areas, area).select(event, *[F.expr(v).alias(k) for k, v in values.items()])


def event_table(events: DataFrame, features: Sequence[DataFrame], event: str) -> DataFrame:
    """All features of each event: one chain of left joins."""
    return reduce(lambda a, b: a.join(b, event, "left"), features, events.select(event).distinct())
