"""Reading and writing of staging tables, features, matrices and results, and the audit of their constraints."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of the tables of results, as Spark types.
RESULT_SCHEMAS = {
    "models": "model_id int, model_group_id int, run_time timestamp_ntz, experiment_hash string, model_type string, model_parameters string, features array<string>, prediction_window string, config string",
    "predictions": "model_id int, as_of_date timestamp_ntz, entity_id bigint, score double, label_value int, rank_abs int, rank_pct double",
    "evaluations": "model_id int, as_of_date timestamp_ntz, metric string, parameter string, comment string, value double",
    "feature_importances": "model_id int, feature string, feature_importance double",
    "individual_importances": "model_id int, as_of_date timestamp_ntz, entity_id bigint, risk_1 string, risk_2 string, risk_3 string, risk_4 string, risk_5 string",
}


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None, time: str | None = None, start: str | None = None, end: str | None = None, schema: str | T.StructType | None = None) -> DataFrame:
    """A staging table with its date predicate, start <= time < end (S1, S3); both reach the Parquet scan."""
    table = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    for bound, test in ((start, lambda c, b: c >= b), (end, lambda c, b: c < b)):
        if time and bound:
            table = table.filter(test(F.col(time), F.lit(bound).cast(table.schema[time].dataType)))
    return table.select(*columns) if columns else table


def write_lookup(spark: SparkSession, path: str, columns: Sequence[str], rows: Sequence[Sequence]) -> None:
    """Replaces a lookup by its seed rows."""
    spark.createDataFrame([tuple(r) for r in rows], list(columns)).write.mode("overwrite").parquet(path)


def write_features(table: DataFrame, path: str, dated: bool = True) -> None:
    """A feature table, in a folder for each date (S4); undated ones as they are."""
    writer = table.write.mode("overwrite")
    (writer.partitionBy("as_of_date") if dated else writer).parquet(path)


def write_labels(table: DataFrame, path: str) -> None:
    """Replaces the label table."""
    table.write.mode("overwrite").parquet(path)


def matrix_key(metadata: Mapping) -> str:
    """The hash of a matrix's metadata, whatever the order of its keys."""
    return hashlib.sha256(json.dumps(metadata, sort_keys=True, default=str).encode()).hexdigest()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is there, in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def archived(spark: SparkSession, root: str, metadata: Mapping, build: Callable[[], DataFrame]) -> DataFrame:
    """The matrix of this metadata: read if it was built before, else built and written.

    It is written aside and renamed when it is whole. Of two that build it at once the later one throws its copy away.
    """
    path = f"{root}/{matrix_key(metadata)}"
    if not exists(spark, path):
        aside = f"{path}-{uuid.uuid4().hex}"
        build().write.parquet(aside)
        Path = spark._jvm.org.apache.hadoop.fs.Path
        source, target = Path(aside), Path(path)
        store = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if exists(spark, path) or not store.rename(source, target):
            store.delete(source, True)
        store.delete(Path(target, source.getName()), True)  # where a store moves a folder into one that is there
    return spark.read.parquet(path)


def there(spark: SparkSession, path: str) -> bool:
    """Whether anything was written to a path; tables whose partitions are replaced one by one have no mark of being finished."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share (spark.checkpoint.dir); on one machine, without one, a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(table: DataFrame, name: str) -> DataFrame:
    """The table, written to a new path of the shared folder and read again, where several plans need it."""
    path = scratch(table.sparkSession, name)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def registry_row(spark: SparkSession, model_id: int, kind: str, parameters: Mapping, features: Sequence[str], window: str, config: Mapping, group: int | None = None) -> DataFrame:
    """A row of the table of models (S14); its experiment is the hash of the configuration."""
    row = (model_id, group, None, matrix_key(config), kind, json.dumps(parameters, sort_keys=True), list(features), window, json.dumps(config, sort_keys=True, default=str))
    return spark.createDataFrame([row], RESULT_SCHEMAS["models"]).withColumn("run_time", F.current_timestamp().cast("timestamp_ntz"))


def append(table: DataFrame, path: str, keys: Sequence[str] = ("model_id", "as_of_date")) -> None:
    """Predictions (S8), global importances (S11) and registry rows (S14) are added to what is there."""
    (table.write.mode("append").partitionBy(*keys) if keys else table.write.mode("append")).parquet(path)


def replace(table: DataFrame, path: str, keys: Sequence[str] = ("model_id", "as_of_date"), of: Sequence[Mapping] = ()) -> None:
    """Evaluations (S9) and individual importances (S10): rows of the keys in the table replace those of the same keys.

    Keys of `of`, as {key: value}, lose their old rows also if the table has none for them.
    """
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    if not of:
        return
    spark, known = table.sparkSession, table.select(*keys).distinct()
    asked = spark.createDataFrame([tuple(x[k] for k in keys) for x in of], table.select(*keys).schema)
    empty = asked.join(known, list(keys), "left_anti")
    # as text, since a partition's column may be read as another type
    same = lambda t: t.select(*[F.col(k).cast("string").alias(k) for k in keys])
    old = spark.read.parquet(path)
    folders = old.select(*[F.col(k).cast("string").alias(k) for k in keys], F.input_file_name().alias("_file")).join(F.broadcast(same(empty)), list(keys), "left_semi").select("_file").distinct().collect()
    for folder in {r["_file"].rpartition("/")[0] for r in folders}:  # one for each key of `of` at most
        where = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def export_mapping(table: DataFrame, path: str) -> None:
    """A feature mapping as CSV, quoted by bars."""
    table.write.mode("overwrite").option("header", True).option("quote", "|").csv(path)


def read_narratives(spark: SparkSession, path: str, text: str = "narrative") -> DataFrame:
    """Texts of a CSV or Parquet table."""
    table = spark.read.option("header", True).option("multiLine", True).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    return table.filter(F.col(text).isNotNull())


def write_narratives(table: DataFrame, path: str, text: str = "narrative") -> None:
    table.select(text).write.mode("overwrite").option("header", True).csv(path)


@dataclass(frozen=True)
class Audited:
    """A table and what should hold of its rows. foreign: by column, the table and column that have its values."""

    table: DataFrame
    name: str
    primary: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    required: Sequence[str] = ()
    foreign: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)


def _key(columns: Sequence[Column]) -> Column:
    """A key as 128 bits of hash, nulls apart from all values."""
    nulls = [c.isNull() for c in columns]
    return F.struct(*[F.xxhash64(F.lit(k), *nulls, *columns).alias(f"h{k}") for k in (0, 1)])


def audit_all(tables: Sequence[Audited]) -> DataFrame:
    """table_name, constraint, violations for each constraint of each table, those that hold with 0.

    Keys count the rows beyond one of each key (nulls are one value), NOT NULL and CHECK the rows that fail (a null passes a CHECK),
    foreign keys the rows whose value isn't there (a null passes).

    Each table is scanned once: a row becomes one (constraint, hash of its key) for each key and foreign key and for what it
    violates itself. All are counted by one shuffle after partial counts, so a frequent key is a few rows; values that
    foreign keys refer to join them there as rows of their own.
    """
    labels, parts = [], []
    for t in tables:
        entries = []

        def entry(label: str, key: Column, when: Column | None = None, kind: str = "rows", t: Audited = t, entries: list = entries) -> int:
            labels.append((len(labels), t.name, label, kind))
            row = F.struct(F.lit(len(labels) - 1).alias("c"), key.alias("key"))
            entries.append(row if when is None else F.when(when, row))
            return len(labels) - 1

        def refer(k: int, other: DataFrame, key: Column) -> None:
            parts.append(other.select(F.lit(k).alias("c"), key.alias("key"), F.lit(0).alias("own"), F.lit(1).alias("known")).select("c", "key.*", "own", "known"))

        nothing = _key([F.lit(0)])
        for kind, key in [*((("primary key", t.primary),) if t.primary else ()), *(("unique", u) for u in t.unique)]:
            entry(f"{kind} ({', '.join(key)})", _key([F.col(c) for c in key]), kind="key")
        for c in dict.fromkeys([*t.required, *t.primary]):
            entry(f"not null ({c})", nothing, F.col(c).isNull())
        for label, check in t.checks.items():
            entry(f"check ({label})", nothing, ~F.expr(check))
        for c, (other, key) in t.foreign.items():
            # both sides in the type that holds the values of both
            common = lambda mine, table, name: F.coalesce(F.col(mine), F.lit(None).cast(table.schema[name].dataType))
            k = entry(f"foreign key ({c})", _key([common(c, other, key)]), F.col(c).isNotNull(), "foreign")
            refer(k, other.filter(F.col(key).isNotNull()), _key([common(key, t.table, c)]))
        if entries:
            parts.append(t.table.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.c", "e.key.*", F.lit(1).alias("own"), F.lit(0).alias("known")))
    spark = tables[0].table.sparkSession
    named = spark.createDataFrame(labels, "c int, table_name string, constraint string, kind string")
    if not labels:
        return named.select("table_name", "constraint", F.lit(0).cast("long").alias("violations"))
    keys = reduce(lambda a, b: a.unionByName(b), parts).groupBy("c", "h0", "h1").agg(F.sum("own").alias("own"), F.max("known").alias("known"))
    counts = keys.groupBy("c").agg(F.sum("own").alias("rows"), F.sum(F.greatest(F.col("own") - 1, F.lit(0))).alias("beyond"), F.sum(F.when(F.col("known") == 0, F.col("own")).otherwise(0)).alias("unknown"))
    violations = F.when(F.col("kind") == "key", F.col("beyond")).when(F.col("kind") == "foreign", F.col("unknown")).otherwise(F.col("rows"))
    return named.join(F.broadcast(counts), "c", "left").select("table_name", "constraint", F.coalesce(violations, F.lit(0)).cast("long").alias("violations"))


def audit(table: DataFrame, name: str, primary: Sequence[str] = (), unique: Sequence[Sequence[str]] = (), required: Sequence[str] = (), foreign: Mapping[str, tuple[DataFrame, str]] | None = None, checks: Mapping[str, str] | None = None) -> DataFrame:
    """The audit of one table."""
    return audit_all([Audited(table, name, primary, unique, required, foreign or {}, checks or {})])
