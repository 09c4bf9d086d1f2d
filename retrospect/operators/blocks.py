"""Entity-level aggregation over trailing windows as of many dates.

Windows are [as_of - window, as_of); history is everything before as_of. All windows of a block come from one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGGREGATES = {
    "sum": F.sum,
    "avg": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "variance": F.var_samp,
    "mode": lambda c: F.mode(c, True),
    "cv": lambda c: F.try_divide(F.stddev_samp(c), F.avg(c)),
}


@dataclass(frozen=True)
class Quantity:
    """A number of each event, and the functions that aggregate it (O1). Its columns are named {name}_{function}."""

    name: str
    value: str
    functions: Sequence[str] = ("sum", "avg")


def column_name(text: str) -> str:
    """Trimmed, lower case, spaces and dashes as underscores."""
    return text.strip().lower().replace(" ", "_").replace("-", "_")


def lookup_quantities(prefix: str, column: str, lookup: Sequence[tuple], functions: Sequence[str] = ("sum", "avg"), condition: str | None = None, weight: str | None = None) -> list[Quantity]:
    """A 0/1 quantity for each (code, value) of a lookup (O2), times a weight if there is one (O3)."""
    out = []
    for code, value in lookup:
        literal = f"'{code}'" if isinstance(code, str) else str(code)
        test = f"cast(({column} = {literal}{f' and {condition}' if condition else ''}) as int)"
        out.append(Quantity(f"{prefix}_{column_name(str(value))}", f"{test} * {weight}" if weight else test, functions))
    return out


#: Values of a column that may become columns of a table; `lookback_long` has no such bound.
LEVELS = 10_000


def levels(source: DataFrame, column: str, most: int = LEVELS) -> list:
    """The distinct values of a column in order, null aside: the dictionary that columns are named after.

    It is an error if there are more than `most`: no more than one beyond that is ever collected.
    """
    found = [r[0] for r in source.select(column).dropna().distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values to make columns of; lookback_long keeps them as rows")
    return sorted(found)


def distinct_quantities(prefix: str, source: DataFrame, column: str, functions: Sequence[str] = ("sum", "avg"), condition: str | None = None) -> list[Quantity]:
    """A 0/1 quantity for each distinct value of a categorical column (O4); null is no category."""
    values = levels(source, column)
    return lookup_quantities(prefix, column, [(v, v) for v in values], functions, condition)


@dataclass(frozen=True)
class Block:
    """Quantities of one source. Columns are {prefix}_id_{window}_{quantity}_{function}."""

    prefix: str
    entity: str
    date: str
    quantities: Sequence[Quantity]
    #: By label: (months, days) of trailing windows.
    windows: Mapping[str, tuple[int, int]] = field(default_factory=dict)


def _aggregates(block: Block, window: str | None, inside: Column | None) -> list[Column]:
    out = []
    for q in block.quantities:
        value = F.expr(q.value)
        for f in q.functions:
            name = "_".join(x for x in (block.prefix, "id", window, q.name, f) if x).lower()
            out.append(AGGREGATES[f](F.when(inside, value) if inside is not None else value).alias(name))
    return out


def _bound(as_of: Column, step: tuple[int, int]) -> Column:
    return as_of - F.make_interval(F.lit(0), F.lit(step[0]), F.lit(0), F.lit(step[1]))


def _states(quantity: Quantity, k: int) -> dict[str, Column]:
    """What must be known of a quantity's values to have its functions for any set of days, by name: count, sum, least, greatest, and the
    sums of squares within the days and between them."""
    value, needs = F.expr(quantity.value), set(quantity.functions)
    number = value.cast("double")
    out = {f"_n{k}": F.count(value), f"_s{k}": F.sum(value)} if needs & {"sum", "avg", "count", "variance", "cv"} else {}
    if needs & {"variance", "cv"}:
        n = F.count(number)
        out |= {f"_w{k}": F.coalesce(F.var_pop(number) * n, F.lit(0.0)), f"_b{k}": F.coalesce(F.avg(number) * F.avg(number) * n, F.lit(0.0))}
    return out | {f"_{f}{k}": AGGREGATES[f](value) for f in ("min", "max") if f in needs}


def _merged(function: str, k: int, inside: Column) -> Column:
    """A function of a quantity from the states of the days inside a window."""
    part = lambda state: F.when(inside, F.col(f"_{state}{k}"))
    if function in ("min", "max"):
        return AGGREGATES[function](part(function))
    n, total = F.sum(part("n")), F.sum(part("s"))
    if function == "sum":
        return total
    if function == "count":
        return F.coalesce(n, F.lit(0))
    if function == "avg":
        return F.try_divide(total.cast("double"), n)
    mean, squares = F.try_divide(total.cast("double"), n), F.sum(part("b"))
    between = squares - mean * mean * n
    apart = F.sum(part("w")) + F.when(between > squares * 1e-13, between).otherwise(0.0)  # what rounding leaves of nothing
    variance = F.when(n > 1, apart / (n - 1))
    return variance if function == "variance" else F.try_divide(F.sqrt(variance), mean)


def day_of(when: Column, bounds: Sequence) -> Column:
    """The start of the day of a time, or the last of the bounds up to it if that is later: a time is on the same side of every
    bound as this is. bounds are those that aren't midnights."""
    day = when.cast("date").cast("timestamp_ntz")
    if not bounds:
        return day
    later = F.array_max(F.filter(F.array(*[F.lit(str(b)).cast("timestamp_ntz") for b in bounds]), lambda b: b <= when.cast("timestamp_ntz")))
    return F.greatest(day, later)


def _day_states(source: DataFrame, entity: str, day: Column, states: Mapping[str, Column]) -> DataFrame:
    return source.groupBy(entity, day.alias("_day")).agg(*[state.alias(name) for name, state in states.items()] or [F.lit(0).alias("_none")])


def _met_states(source: DataFrame, entity: str, day: Column, states: Mapping[str, Column], met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The states of all pairs of an event and a row of met, without the pairs: those of met's rows of each key, times the events of the
    entity, day and key."""
    times = source.dropna(subset=list(keys)).groupBy(entity, day.alias("_day"), *keys).agg(F.count(F.lit(1)).alias("_times"))
    rows = met.groupBy(*keys).agg(*[state.alias(name) for name, state in states.items()])
    own = lambda name: F.col(name) if name.startswith(("_min", "_max")) else F.col(name) * F.col("_times")
    return times.join(rows, list(keys)).select(entity, "_day", *[own(name).alias(name) for name in states])


def lookback(source: DataFrame, dates: DataFrame, block: Block, met: tuple[DataFrame, Sequence[str]] | None = None) -> DataFrame:
    """entity, as_of_date and each quantity over each window.

    dates (as_of_date) are few: it is their number that is broadcast. Events are aggregated by entity and day first, into states
    that can be merged, so that a busy entity is as many rows as it has days; each of these meets just the dates whose widest
    window holds it. Only modes are taken from the events themselves. Entities without an event in any window of a date have no row for it.

    met: a table and the columns by which events meet its rows. The quantities are then of its columns, over all pairs of an event and a
    row, modes aside; the pairs aren't made (_met_states), of which there are as many as events times rows of a key.
    """
    dates = dates.select(F.col("as_of_date").cast("timestamp_ntz").alias("as_of_date")).distinct()
    starts = {label: f"_from{k}" for k, label in enumerate(block.windows)}
    # the windows' starts are columns of the dates, so that they aren't computed anew for each row and quantity
    dates = dates.select("as_of_date", *[_bound(F.col("as_of_date"), block.windows[label]).alias(c) for label, c in starts.items()])
    odd = sorted({b for r in dates.collect() for b in r if b is not None and (b.hour, b.minute, b.second, b.microsecond) != (0, 0, 0, 0)})
    dates = dates.withColumn("_widest", F.least(*starts.values()) if len(starts) > 1 else F.col(next(iter(starts.values()))))
    when = F.col(block.date)
    merged = [Quantity(q.name, q.value, [f for f in q.functions if f != "mode"]) for q in block.quantities]
    states = {name: state for k, q in enumerate(merged) for name, state in _states(q, k).items()}
    if met is not None and any("mode" in q.functions for q in block.quantities):
        raise ValueError("modes need the events' own values")
    days = _day_states(source, block.entity, day_of(when, odd), states) if met is None else _met_states(source, block.entity, day_of(when, odd), states, *met)
    seen = days.join(F.broadcast(dates), (F.col("_day") < F.col("as_of_date")) & (F.col("_day") >= F.col("_widest")))
    seen = seen.withColumns({f"_in{k}": F.col("_day") >= F.col(c) for k, c in enumerate(starts.values())})
    name = lambda label, q, f: "_".join(x for x in (block.prefix, "id", label, q.name, f) if x).lower()
    columns = [_merged(f, k, F.col(f"_in{w}")).alias(name(label, q, f)) for w, label in enumerate(block.windows) for k, q in enumerate(merged) for f in q.functions]
    out = seen.groupBy(block.entity, "as_of_date").agg(*columns or [F.lit(0).alias("_none")])
    modes = Block(block.prefix, block.entity, block.date, [Quantity(q.name, q.value, ["mode"]) for q in block.quantities if "mode" in q.functions], block.windows)
    if modes.quantities:
        joined = source.join(F.broadcast(dates), (when < F.col("as_of_date")) & (when >= F.col("_widest")))
        of_events = joined.groupBy(block.entity, "as_of_date").agg(*[c for label, start in starts.items() for c in _aggregates(modes, label, when >= F.col(start))])
        left, right = (t.withColumnRenamed(block.entity, "_entity") for t in (out, of_events))
        out = left.join(right.withColumnRenamed("as_of_date", "_date").withColumnRenamed("_entity", "_other"), F.col("_entity").eqNullSafe(F.col("_other")) & (F.col("as_of_date") == F.col("_date"))).withColumnRenamed("_entity", block.entity)
    return out.select(block.entity, "as_of_date", *[name(label, q, f) for label in block.windows for q in block.quantities for f in q.functions])


def _level_states(source: DataFrame, dates: DataFrame, entity: str, date: str, column: str, windows: Mapping[str, tuple[int, int]], weight: str | None) -> DataFrame:
    """entity, as_of_date, _level (null too) and for each window the rows that have a level and a weight, _n{k}, and their sum, _s{k}."""
    dates = dates.select(F.col("as_of_date").cast("timestamp_ntz").alias("as_of_date")).distinct()
    starts = [f"_from{k}" for k in range(len(windows))]
    dates = dates.select("as_of_date", *[_bound(F.col("as_of_date"), w).alias(c) for c, w in zip(starts, windows.values(), strict=True)])
    odd = sorted({b for r in dates.collect() for b in r if b is not None and (b.hour, b.minute, b.second, b.microsecond) != (0, 0, 0, 0)})
    dates = dates.withColumn("_widest", F.least(*starts) if len(starts) > 1 else F.col(starts[0]))
    value = F.expr(weight) if weight else F.lit(1)
    counted = F.when(F.col(column).isNotNull(), value)
    days = source.groupBy(entity, day_of(F.col(date), odd).alias("_day"), F.col(column).alias("_level")).agg(F.count(counted).alias("_n"), F.sum(counted).alias("_s"))
    seen = days.join(F.broadcast(dates), (F.col("_day") < F.col("as_of_date")) & (F.col("_day") >= F.col("_widest")))
    inside = lambda k, c: F.sum(F.when(F.col("_day") >= F.col(starts[k]), F.col(c)))
    return seen.groupBy(entity, "as_of_date", "_level").agg(*[a for k in range(len(windows)) for a in (F.coalesce(inside(k, "_n"), F.lit(0)).alias(f"_n{k}"), inside(k, "_s").alias(f"_s{k}"))])


def lookback_long(source: DataFrame, dates: DataFrame, entity: str, date: str, column: str, windows: Mapping[str, tuple[int, int]], weight: str | None = None) -> DataFrame:
    """entity, as_of_date, window, level, sum, avg: the quantities of `distinct_quantities` (O2-O4) as rows, for any number of values.

    A row for each value that an entity has in a window; sum and avg of a value's 0/1 (times the weight) over the window's rows with
    a value. A column's values are never collected: rows are merged by entity, day and value, then by entity, date and value.
    """
    states = _level_states(source, dates, entity, date, column, windows, weight)
    each = F.explode(F.array(*[F.struct(F.lit(label).alias("window"), F.col(f"_n{k}").alias("n"), F.col(f"_s{k}").alias("sum")) for k, label in enumerate(windows)]))
    rows = states.filter(F.col("_level").isNotNull()).select(entity, "as_of_date", F.col("_level").alias("level"), each.alias("_w")).select(entity, "as_of_date", "_w.window", "level", "_w.n", "_w.sum").filter("n > 0")
    # totals by aggregation and a join, not by a window over an entity's rows: a busy entity has many values
    totals = rows.groupBy(entity, "as_of_date", "window").agg(F.sum("n").alias("_total"))
    return rows.join(totals, [entity, "as_of_date", "window"]).select(entity, "as_of_date", "window", "level", "sum", F.try_divide(F.col("sum").cast("double"), F.col("_total")).alias("avg"))


def lookback_levels(source: DataFrame, dates: DataFrame, prefix: str, entity: str, date: str, name: str, column: str, windows: Mapping[str, tuple[int, int]], weight: str | None = None, values: Sequence | None = None) -> DataFrame:
    """entity, as_of_date and {prefix}_id_{window}_{name}_{value}_sum and _avg for each value: what `lookback` makes of
    `distinct_quantities`, for a column of up to LEVELS values.

    Only the values that an entity has are aggregated, as rows, and they become columns in the last step, so the work grows with the
    rows and not with rows times values. values: those that become columns, all that there are if it isn't given.
    """
    values = levels(source, column) if values is None else values
    states = _level_states(source, dates, entity, date, column, windows, weight)
    sums = F.map_from_entries(F.collect_list(F.when(F.col("_level").isNotNull(), F.struct("_level", F.array(*[f"_s{k}" for k in range(len(windows))])))))
    wide = states.groupBy(entity, "as_of_date").agg(sums.alias("_sums"), *[F.sum(f"_n{k}").alias(f"_n{k}") for k in range(len(windows))])
    # for each window the sums in the dictionary's order, of which each column takes its own
    known = F.lit(list(values)) if values else F.array()
    of = lambda k: F.transform(known, lambda v: F.when(F.col(f"_n{k}") > 0, F.coalesce(F.get(F.try_element_at("_sums", v), F.lit(k)), F.lit(0))))
    placed = wide.select(entity, "as_of_date", *[c for k in range(len(windows)) for c in (F.col(f"_n{k}"), of(k).alias(f"_v{k}"))])
    out = []
    for k, label in enumerate(windows):
        for i, v in enumerate(values):
            stem = f"{prefix}_id_{label}_{name}_{column_name(str(v))}".lower()
            out += [f"_v{k}[{i}] AS `{stem}_sum`", f"try_divide(cast(_v{k}[{i}] AS double), _n{k}) AS `{stem}_avg`"]
    return placed.selectExpr(f"`{entity}`", "as_of_date", *out)


def history(source: DataFrame, dates: DataFrame, block: Block) -> DataFrame:
    """entity, as_of_date and each quantity over all events before the date (O6); quantities may refer to as_of_date."""
    dates = dates.select(F.col("as_of_date").cast("timestamp_ntz").alias("as_of_date")).distinct()
    return source.join(F.broadcast(dates), F.col(block.date) < F.col("as_of_date")).groupBy(block.entity, "as_of_date").agg(*_aggregates(block, "all", None))


def static(source: DataFrame, block: Block) -> DataFrame:
    """entity and each quantity over all rows, without dates."""
    return source.groupBy(block.entity).agg(*_aggregates(block, None, None))


def monthly(source: DataFrame, entity: str, date: str, counts: Mapping[str, str]) -> DataFrame:
    """entity, month and counts by month, as the source of a second aggregation (O8). counts: SQL aggregates by name."""
    month = F.date_trunc("month", date).cast("timestamp_ntz").alias("month")
    return source.groupBy(entity, month).agg(*[F.expr(v).alias(k) for k, v in counts.items()])


def movement_rate(features: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The sum of the columns less the greatest, over the greatest, to three digits; 0 where there is none."""
    total, top = reduce(lambda a, b: a + b, map(F.col, columns)), F.greatest(*columns)
    return features.withColumn(name, F.coalesce(F.round(F.try_divide(total - top, top), 3), F.lit(0.0)))
