"""Labels from nested conditions on events in a forward window, and the population that they are for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = tuple[int, int]


def shifted(date: Column, step: Step) -> Column:
    return date + F.make_interval(F.lit(0), F.lit(step[0]), F.lit(0), F.lit(step[1]))


def unpivot_attributes(events: DataFrame, entity: str, event: str, dates: Mapping[str, str]) -> DataFrame:
    """entity, event, event_datetime, event_type, value: a row for each column of `dates` with its own date column (L2).

    Null values, dates and entities are left out; equal rows are one.
    """
    each = [F.struct(F.col(d).cast("timestamp_ntz").alias("event_datetime"), F.lit(c).alias("event_type"), F.col(c).cast("string").alias("value")) for c, d in dates.items()]
    rows = events.filter(F.col(entity).isNotNull()).select(entity, event, F.inline(F.array(*each)))
    return rows.dropna(subset=["event_datetime", "value"]).distinct()


def collapse_events(attributes: DataFrame, entity: str, event: str, outcomes: Sequence[str]) -> DataFrame:
    """entity, event, the sorted set of its type:value pairs, its first date, and the last date of its outcomes."""
    pair = F.concat_ws(":", "event_type", "value")
    last = F.max(F.when(F.col("event_type").isin(*outcomes), F.col("event_datetime")))
    return attributes.groupBy(entity, event).agg(F.array_sort(F.collect_set(pair)).alias("pairs"), F.min("event_datetime").alias("min_date"), last.alias("max_date"))


def forward_window(events: DataFrame, dates: DataFrame, step: Step, closed: bool = False) -> DataFrame:
    """Events by the as-of dates whose window (d, d + step) holds all of them (L6); (d, d + step] if closed.

    dates are few and broadcast.
    """
    d = dates.select(F.col("as_of_date").cast("timestamp_ntz").alias("as_of_date")).distinct()
    end = shifted(F.col("as_of_date"), step)
    return events.join(F.broadcast(d), (F.col("min_date") > F.col("as_of_date")) & ((F.col("max_date") <= end) if closed else (F.col("max_date") < end)))


def matches(pairs: Column, conditions: Sequence[Sequence[Sequence[str]]]) -> Column:
    """True if every outer condition holds: one of its inner ones has all its pairs among the event's."""
    has = lambda need: reduce(lambda a, b: a & b, [F.array_contains(pairs, x) for x in need])
    return reduce(lambda a, b: a & b, [reduce(lambda a, b: a | b, [has(need) for need in inner]) for inner in conditions])


def positive_labels(events: DataFrame, entity: str, conditions: Sequence[Sequence[Sequence[str]]]) -> DataFrame:
    """entity, as_of_date, outcome 1, once each, of events that match."""
    return events.filter(matches(F.col("pairs"), conditions)).select(entity, "as_of_date").distinct().withColumn("outcome", F.lit(1))


def active_population(dates: DataFrame, entities: DataFrame, events: DataFrame, entity: str, time: str, step: Step) -> DataFrame:
    """entity, as_of_date of known entities with an event in (as_of_date - step, as_of_date]."""
    d = F.broadcast(dates.select(F.col("as_of_date").cast("timestamp_ntz").alias("as_of_date")).distinct())
    active = events.select(entity, F.col(time).alias("_t")).join(d, (F.col("_t") <= F.col("as_of_date")) & (shifted(F.col("_t"), step) > F.col("as_of_date")))
    return active.select(entity, "as_of_date").distinct().join(entities.select(entity), entity, "left_semi")


def sworn_population(population: DataFrame, roles: DataFrame, entity: str, start: str, flag: str) -> DataFrame:
    """Those of the population with a sworn role begun by the date."""
    first = roles.filter(F.col(flag) == 1).groupBy(entity).agg(F.min(start).alias("_start"))
    return population.join(first, entity).filter(F.col("_start") <= F.col("as_of_date")).drop("_start")


def master_labels(population: DataFrame, labels: DataFrame, entity: str) -> DataFrame:
    """entity, as_of_date, outcome: 0 where no label is positive."""
    return population.join(labels, [entity, "as_of_date"], "left").withColumn("outcome", F.coalesce("outcome", F.lit(0)))


def flagged_baseline(alerts: DataFrame, entity: str, time: str, start: str, end: str) -> DataFrame:
    """Distinct known entities with an alert between the dates, both inclusive."""
    between = F.col(time).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    return alerts.filter(between).select(entity).distinct().dropna()


def interventions(alerts: DataFrame, ids: DataFrame, entity: str, time: str, column: str, none: str, start: str, end: str, how: str = "right") -> DataFrame:
    """entity, intervention 1 or 0 in a period.

    The right join keeps just entities with a `none` alert, as surveyed; how="outer" has those with an intervention too.
    """
    between = F.col(time).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    known = alerts.filter(between).join(ids.select(entity), entity, "left_semi")
    some = known.filter(F.col(column) != none).select(entity).distinct().withColumn("intervention", F.lit(1))
    return some.join(known.filter(F.col(column) == none).select(entity).distinct(), entity, how).na.fill(0, ["intervention"])
