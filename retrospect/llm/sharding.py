"""Size-tiered compaction of a sharded table, with versioned manifests."""

from __future__ import annotations

import math
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, table_path

#: Bytes of a finished file, rows of an arriving one, and runs of like size that are merged.
TARGET_BYTES = 64 << 20
ARRIVAL_ROWS = 4_000
FAN_IN = 4
#: Bytes of the least tier; each other tier holds runs of up to FAN_IN times the size.
LEAST_BYTES = 1 << 20
MANIFEST = "version long, run string, bytes long"


class ShardedTable:
    """Immutable runs of Parquet files below root/runs, and one manifest folder for each version below root/manifests.

    A version holds once its manifest has been renamed into place, which one writer of each version can do; readers
    take the latest, so they see all of a change or none of it. Runs that no version names are garbage of failed
    attempts and are never read.
    """

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN):
        self.spark, self.root, self.target_bytes, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._store = self._path(self.root).getFileSystem(self._conf)

    def _bytes(self, path: str) -> int:
        return self._store.getContentSummary(self._path(path)).getLength()

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifests")
        if not self._store.exists(folder):
            return []
        names = [x.getPath().getName() for x in self._store.listStatus(folder)]
        return sorted(int(x) for x in names if x.isdigit())

    def manifest(self, version: int | None = None) -> list[dict]:
        """run and bytes of each run of a version (the latest): as many rows as runs, less than FAN_IN for each tier."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return []
        return [r.asDict() for r in self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{version:020d}").collect()]

    def commit(self, runs: list[dict], base: int) -> int:
        """Makes version base + 1 of these runs; fails if another writer has made it."""
        version = base + 1
        rows = [(version, r["run"], r["bytes"]) for r in runs]
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(draft)
        final = self._path(f"{self.root}/manifests/{version:020d}")
        self._store.mkdirs(final.getParent())
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        none = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
        try:  # without the option to overwrite, renaming fails if the version is there
            hadoop.FileContext.getFileContext(final.toUri(), self._conf).rename(self._path(draft), final, none)
        except Py4JJavaError as e:
            raise RuntimeError(f"version {version} can't be committed") from e
        return version

    def _write(self, rows: DataFrame, max_rows: int | None = None) -> dict:
        run = uuid.uuid4().hex
        path = f"{self.root}/runs/{run}"
        writer = rows.write.option("compression", "zstd")
        (writer.option("maxRecordsPerFile", max_rows) if max_rows else writer).parquet(path)
        return {"run": run, "bytes": self._bytes(path)}

    def append(self, rows: DataFrame, max_rows: int = ARRIVAL_ROWS) -> int:
        """Rows become a new run of small files, as they are dealt: nothing is shuffled."""
        base = max(self.versions(), default=0)
        return self.commit([*self.manifest(base), self._write(rows, max_rows)], base)

    def tier(self, run: dict) -> int:
        return max(0, math.floor(math.log(max(run["bytes"], 1) / LEAST_BYTES, self.fan_in)) + 1)

    def compact(self) -> int:
        """Merges fan_in or more runs of one size tier into one run, as often as a tier has so many.

        A merge is a scan: Spark packs small files up to the target size into each of its tasks, and every task writes
        one file. No rows are shuffled or sorted, and none are lost: the new manifest names the merged run in place of its sources.
        """
        base = max(self.versions(), default=0)
        while True:
            runs = self.manifest(base)
            tiers: dict[int, list[dict]] = {}
            for r in runs:
                tiers.setdefault(self.tier(r), []).append(r)
            full = next((t for t in sorted(tiers) if len(tiers[t]) >= self.fan_in), None)
            if full is None:
                return base
            merged = self._merge(tiers[full])
            base = self.commit([r for r in runs if r not in tiers[full]] + [merged], base)

    def _merge(self, sources: list[dict]) -> dict:
        packed = {"spark.sql.files.maxPartitionBytes": str(self.target_bytes), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
        before = {k: self.spark.conf.get(k, None) for k in packed}
        try:
            for k, v in packed.items():
                self.spark.conf.set(k, v)
            return self._write(self._read(sources))
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def _read(self, runs: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*(f"{self.root}/runs/{r['run']}" for r in runs))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the latest); ValueError if there is none."""
        if not (runs := self.manifest(version)):
            raise ValueError("no version")
        return self._read(runs)

    def vacuum(self) -> None:
        """Removes runs that the latest version doesn't name, and with them the older versions."""
        last = max(self.versions(), default=0)
        named = {r["run"] for r in self.manifest(last)}
        for x in self._store.listStatus(self._path(f"{self.root}/runs")):
            if x.getPath().getName() not in named:
                self._store.delete(x.getPath(), True)
        for v in self.versions():
            if v < last:
                self._store.delete(self._path(f"{self.root}/manifests/{v:020d}"), True)


def shard_arrivals(docs: DataFrame, arrivals: int = 5) -> DataFrame:
    """doc_id, n_bytes, shard, version: where each row of docs lies after its arrivals are appended and compacted.

    Rows arrive in `arrivals` parts by a hash of doc_id (null ids in one of them); texts, null texts, repeated rows and
    other columns are kept as they are. An empty table gives one empty run. The shard is the path of the file below the table's root.
    """
    spark = docs.sparkSession
    table = ShardedTable(spark, table_path(spark, "sharded"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(arrivals))
    for k in range(arrivals):
        table.append(docs.filter(part == k))
        table.compact()
    table.vacuum()
    version = table.versions()[-1]
    rows = table.read(version)
    return rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.regexp_extract(F.input_file_name(), "runs/(.*)$", 1).alias("shard"), F.lit(version).cast("long").alias("version"))


def op7(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return shard_arrivals(documents(spark, sf_dir))
