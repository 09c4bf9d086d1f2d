"""Training and test matrices: assembly, imputation, alignment, sampling and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import blocks

def assemble(labels: DataFrame, dated: Sequence[DataFrame], undated: Sequence[DataFrame], entity: str) -> DataFrame:
    """Features of each labelled entity and date, missing ones 0, the outcome last (M1, M2)."""
    table = reduce(lambda a, b: a.join(b, [entity, "as_of_date"], "left"), dated, labels)
    table = reduce(lambda a, b: a.join(b, entity, "left"), undated, table)
    features = [c for c in table.columns if c not in (entity, "as_of_date", "outcome")]
    return table.na.fill(0, features).select(entity, "as_of_date", *features, "outcome")


def single_table(features: DataFrame, labels: DataFrame, active: DataFrame, entity: str) -> DataFrame:
    """One feature table with its labels (0 if none), for active entities alone (M3)."""
    joined = features.join(labels, [entity, "as_of_date"], "left").join(active.select(entity, "as_of_date"), [entity, "as_of_date"], "left_semi")
    return joined.withColumn("outcome", F.coalesce("outcome", F.lit(0)))


def impute_mean(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the column's mean, and imputation_{column} tells where (M4). The means are one row."""
    means = table.agg(*[F.avg(c).alias(f"_{c}") for c in columns])
    joined = table.crossJoin(F.broadcast(means))
    flags = {f"imputation_{c}": F.col(c).isNull().cast("int") for c in columns}
    return joined.withColumns(flags).withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def impute_zero(table: DataFrame, ids: DataFrame, entity: str, column: str) -> DataFrame:
    """A row for each id, with both sides' values of the column added up, nulls 0 (M5)."""
    own = table.select(entity, F.col(column).alias("_x"))
    return own.join(ids.select(entity, F.col(column).alias("_y")), entity, "right").select(entity, (F.coalesce("_x", F.lit(0)) + F.coalesce("_y", F.lit(0))).alias(column))


def align(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both with the same columns in one order: what one side lacks is 0 there (M6)."""
    columns = [*keys, *sorted(({*train.columns} | {*test.columns}) - {*keys})]
    fill = lambda t: t.select(*[F.col(c) if c in t.columns else F.lit(0).alias(c) for c in columns])
    return fill(train), fill(test)


def undersample(table: DataFrame, label: str, share: float, keys: Sequence[str]) -> DataFrame:
    """All positives, and just so many negatives that positives are `share` of the rows (M7): those of the least hashes of their keys.

    Negatives are counted by the first digits of their hash; whole counts are taken until the next would be too many, and of
    that one the least hashes. So no sort over all rows is needed, and the choice is the same every time.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    positives, negatives = table.filter(F.col(label) == 1), table.filter(F.col(label) == 0).withColumn("_hash", digest).withColumn("_head", F.substring("_hash", 1, 4))
    wanted = int(positives.count() * (1 - share) / share + 1e-9)
    sizes = negatives.groupBy("_head").agg(F.count(F.lit(1)).alias("_n"))  # 65,536 rows at most
    so_far = sizes.withColumn("_upto", F.sum("_n").over(Window.orderBy("_head")))
    placed = negatives.join(F.broadcast(so_far.filter(F.col("_upto") - F.col("_n") < wanted)), "_head")
    whole = placed.filter(F.col("_upto") <= wanted)
    rest = placed.filter(F.col("_upto") > wanted).withColumn("_k", F.row_number().over(Window.partitionBy("_head").orderBy("_hash", *keys))).filter(F.col("_k") <= wanted - (F.col("_upto") - F.col("_n")))
    return positives.unionByName(whole.select(*table.columns)).unionByName(rest.select(*table.columns))


def scale(train: DataFrame, others: Sequence[DataFrame], columns: Sequence[str]) -> list[DataFrame]:
    """Columns less their mean over their standard deviation, both of the training rows (population form); constants become 0 (M8)."""
    stats = train.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    scaled = {c: F.coalesce(F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")), F.lit(0.0)) for c in columns}
    return [t.crossJoin(F.broadcast(stats)).withColumns(scaled).drop(*[f"_{k}_{c}" for k in "ms" for c in columns]) for t in (train, *others)]


def dummies(table: DataFrame, column: str, levels: Sequence[str] | None = None) -> DataFrame:
    """is_{level} 0/1 for each level of a categorical column (M9), of up to blocks.LEVELS; a null is no level."""
    if levels is None:
        levels = blocks.levels(table, column)
    return table.withColumns({f"is_{level}": F.coalesce((F.col(column) == level).cast("int"), F.lit(0)) for level in levels}).drop(column)


def temporal_split(events: DataFrame, time: str, today: str, train: Column, predict: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of [today - train, today] and of [today, today + predict]."""
    t = F.lit(today).cast("timestamp_ntz")
    return events.filter(F.col(time).between(t - train, t)), events.filter(F.col(time).between(t, t + predict))


def has_both_classes(table: DataFrame, label: str) -> bool:
    """False if there is nothing to tell apart."""
    return table.agg(F.count_distinct(label)).first()[0] > 1
