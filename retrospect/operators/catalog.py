"""Wide feature tables and the catalogue of their columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: {block}_id_{window}_{feature}_{type}_{function}; the window is an ISO period or `all`; many features have no type.
NAME = r"^([A-Za-z]+)_id_(?:(P[0-9][0-9A-Z]*|p[0-9][0-9a-z]*|all)_)?([^_]+)(?:_(.*))?_([A-Za-z]+)$"


def _side_by_side(blocks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Blocks with a row for each key at most, as one table: their rows are shuffled once and put together by key."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), blocks)
    return rows.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c not in keys])


def wide_join(dated: Sequence[DataFrame], undated: Sequence[DataFrame], entity: str) -> DataFrame:
    """All features of each entity and date (O11): dated blocks by entity and date, then undated ones by entity.

    Entities that have just undated features have one row, without a date. However many blocks there are, rows are
    shuffled for each kind of block once and for one full outer join.
    """
    table = _side_by_side(dated, [entity, "as_of_date"])
    return table.join(_side_by_side(undated, [entity]), entity, "outer") if undated else table


def parse_names(columns: DataFrame) -> DataFrame:
    """column_name split into block, window, feature, type and metric (O13, O14); windows are in upper case but for `all`."""
    part = lambda k: F.regexp_extract("column_name", NAME, k)
    window = F.when(F.lower(part(2)) == "all", F.lit("all")).otherwise(F.upper(part(2)))
    return columns.select("column_name", part(1).alias("block"), window.alias("window"), part(3).alias("feature"), part(4).alias("type"), part(5).alias("metric"))


def resolve(requested: DataFrame, windows: DataFrame, columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns at hand that serve the requested features, and the requests that none serves.

    requested: feature (a prefix of the feature); windows: window. Both are small. A requested feature needs a
    column for each window, unless the columns that it has are without a window or of all history.
    """
    parsed = parse_names(columns)
    wanted = requested.crossJoin(windows)  # of request rows
    serves = F.lower(parsed["feature"]).startswith(F.lower(wanted["feature"]))
    fits = (F.upper(parsed["window"]) == F.upper(wanted["window"])) | parsed["window"].isin("", "all")
    available = parsed.join(F.broadcast(wanted), serves & fits, "left_semi").select("column_name")
    missing = wanted.join(parsed, serves & fits, "left_anti")
    return available, missing


def by_window(columns: DataFrame) -> DataFrame:
    """window, columns: the feature columns of each window, in order."""
    return parse_names(columns).groupBy("window").agg(F.array_sort(F.collect_list("column_name")).alias("columns"))


def describe(columns: DataFrame, blocks: DataFrame, features: DataFrame, metrics: DataFrame) -> DataFrame:
    """column_name and a sentence from three dictionaries (name, description), joined without regard to case.

    A part that its dictionary lacks stands for itself.
    """
    out = parse_names(columns)
    for key, names in (("block", blocks), ("feature", features), ("metric", metrics)):
        named = names.select(F.upper("name").alias("_name"), F.col("description").alias(f"{key}_description"))
        out = out.join(F.broadcast(named), F.upper(out[key]) == named["_name"], "left").drop("_name")
    said = [F.coalesce(f"{k}_description", k) for k in ("metric", "feature", "block")]
    window = F.when(F.col("window") == "", F.lit("")).otherwise(F.concat(F.lit(" over "), F.col("window")))
    return out.withColumn("description", F.concat(said[0], F.lit(" of "), F.trim(F.concat_ws(" ", said[1], F.col("type"))), F.lit(" ("), said[2], F.lit(")"), window))
