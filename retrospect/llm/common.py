"""Helpers that the operators of this folder share."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. ValueError if there is none, unless Spark runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: df is written to the shared folder and read again, so a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes the files of materialised tables that nothing reads any more."""
    for table in tables:
        for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
            where = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def same_row(a: DataFrame, b: DataFrame):
    """Rows of equal doc_id (null equals null) and text hash."""
    return (a["text_sha256"] == b["text_sha256"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def keep_one(docs: DataFrame, keepers: DataFrame) -> DataFrame:
    """One row of docs, with its columns, for each row of keepers: doc_id, text_sha256, n (how many rows of docs it names).

    Rows that docs repeats are few as a rule: they are found by a join of their own, so that the others needn't be grouped.
    """
    names = [f"_{k}" for k in range(len(docs.columns))]
    doc_id, text = (f"_{docs.columns.index(c)}" for c in ("doc_id", "text"))
    rows = docs.toDF(*names)
    rows = rows.withColumn("text_sha256", F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)).withColumn("doc_id", F.col(doc_id).cast("long"))
    once, again = (materialise(keepers.filter(test).select("doc_id", "text_sha256"), "keepers") for test in ("n = 1", "n > 1"))
    repeated = rows.join(again, same_row(rows, again), "left_semi").dropDuplicates(["doc_id", "text_sha256"])
    return rows.join(once, same_row(rows, once), "left_semi").union(repeated).select(*names).toDF(*docs.columns)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def raw_texts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string or binary array and its offsets, without a copy."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), ends


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)
