"""A table as a list of parquet files: keyed replace rewrites only the files that hold a key, and a load is one switch.

Every version of the table is a manifest: the live files with their rows, bytes and bounds of the first key. A load writes new files beside the old ones
and then a new manifest; the manifest with the highest number that was finished is the table. A write that breaks leaves files that nobody lists, and readers of
an earlier version keep their files until ``vacuum``.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

# Most rows and bytes of one file.
ROWS_PER_FILE = 2_000_000
BYTES_PER_FILE = 500_000_000
#: Rows that weigh more than this part of a file have one of their own.
HEAVY_PART = 0.125
#: One task writes one file up to this many files; of more and small ones it writes several, up to ``TASK_PART`` of a file of the usual size.
MANY_FILES, TASK_PART = 64, 0.125
_MANIFEST = "file string, rows long, bytes long, low string, high string"


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as plain values, before encoding and compression."""

    def of(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 4
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 4
        return F.lit(16 if isinstance(kind, T.DecimalType) else 8)

    total = F.lit(0)
    for field in df.schema.fields:
        total = total + of(F.col(f"`{field.name}`"), field.dataType)
    return total.cast("long")


def deal_by_size(df: DataFrame, rows: int = ROWS_PER_FILE, size: int = BYTES_PER_FILE) -> DataFrame:
    """``df`` dealt to partitions of at most ``rows`` rows and ``size`` plain bytes, in about the order they come.

    A row weighs the larger of its shares of both limits. Every task sums the weights of its rows, the tasks' totals (one number each) are summed
    in order, and the sum before a row says which file it belongs to; files are filled to 1 less the largest light weight, so none exceeds a limit.
    A row that weighs more than ``HEAVY_PART`` has a file of its own, also if it alone exceeds ``size``.
    """
    placed, files = place_by_size(df, rows, size)
    return placed.repartitionById(files, "_file").select(*df.columns)


def place_by_size(df: DataFrame, rows: int, size: int) -> tuple[DataFrame, int]:
    """``df`` with the file of ``deal_by_size`` as ``_file``, not yet dealt, and the number of files."""
    weight = F.greatest(F.lit(1.0 / rows), row_bytes(df) / size)
    kept = df.schema.fields
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *T.StructType.fromDDL("_task int, _ahead double, _weight double, _heavy long").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        light, heavy = 0.0, 0
        for frame in batches:
            big = frame["_weight"] > HEAVY_PART
            own = frame["_weight"].where(~big, 0.0)
            yield frame.assign(_ahead=light + own.cumsum() - own, _heavy=(heavy + big.cumsum()).where(big, 0))
            light, heavy = light + own.sum(), heavy + int(big.sum())

    summed = df.withColumns({"_task": F.spark_partition_id(), "_ahead": F.lit(0.0), "_weight": weight, "_heavy": F.lit(0).cast("long")})
    summed = materialize(summed.select(*names, "_task", "_ahead", "_weight", "_heavy").mapInPandas(run, schema), "weighed")
    is_light = F.col("_weight") <= HEAVY_PART
    totals = summed.groupBy("_task").agg(F.sum(F.when(is_light, F.col("_weight")).otherwise(0.0)).alias("light"), F.max("_heavy").alias("heavy"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    starts = totals.select(
        "_task", F.coalesce(F.sum("light").over(before), F.lit(0.0)).alias("_from"), F.coalesce(F.sum("heavy").over(before), F.lit(0)).alias("_own")
    )
    most, total, heavy = summed.agg(
        F.max(F.when(is_light, F.col("_weight"))), F.sum(F.when(is_light, F.col("_weight"))), F.count(F.when(~is_light, 1))
    ).first()
    fill = 1.0 - (most or 0.0)
    files = int((total or 0.0) / fill) + 1
    at = F.least(F.floor((F.col("_from") + F.col("_ahead")) / fill), F.lit(files - 1))
    place = F.when(is_light, at).otherwise(F.lit(files) + F.col("_own") + F.col("_heavy") - 1).cast("int")
    dealt = summed.join(F.broadcast(starts), "_task").withColumn("_file", place)
    return dealt.select(*names, "_file"), files + heavy


def _name() -> Column:
    """A file's path below the table's ``data``, as manifests list it."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"/data/(b[0-9a-f]{32}/.*)$", 1)


def _opened(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    """The rows under ``paths``. Listing them is done at once, by ``MANY_FILES`` tasks and not by one for each path."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(min(MANY_FILES, int(usual))))
    try:
        return spark.read.schema(schema).parquet(*paths)
    finally:
        spark.conf.set(name, usual)


@dataclass(frozen=True)
class FileTable:
    """A table in the folder ``path``; ``key`` is the column whose bounds are kept for each file."""

    spark: SparkSession
    path: str
    key: str
    rows_per_file: int = ROWS_PER_FILE
    bytes_per_file: int = BYTES_PER_FILE

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def version(self) -> int:
        """Number of the last finished manifest, 0 if there is none."""
        fs, path = self._fs()
        folder = path(f"{self.path}/manifests")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        finished = [int(n[1:]) for n in names if n.startswith("v") and fs.exists(path(f"{self.path}/manifests/{n}/_SUCCESS"))]
        return max(finished, default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(file, rows, bytes, low, high) of the live files; bounds are the key's least and largest value as text."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests/v{version}")

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows, at its last version or an earlier one."""
        files = [f"{self.path}/data/{r['file']}" for r in self.manifest(version).select("file").toLocalIterator()]
        return _opened(self.spark, self._schema(), files) if files else self.spark.createDataFrame([], self._schema())

    def _schema(self) -> T.StructType:
        fs, path = self._fs()
        if not fs.exists(path(f"{self.path}/schema")):
            raise ValueError(f"no table in {self.path}")
        return T.StructType.fromJson(json.loads(self.spark.read.text(f"{self.path}/schema").first()[0]))

    def _write(self, df: DataFrame) -> DataFrame:
        """New files of ``df`` under both limits, and their manifest rows."""
        batch = f"b{uuid.uuid4().hex}"
        placed, number = place_by_size(df, self.rows_per_file, self.bytes_per_file)
        if number <= MANY_FILES:
            placed.repartitionById(number, "_file").select(*df.columns).write.parquet(f"{self.path}/data/{batch}")
        else:
            load = F.sum(F.greatest(F.lit(1.0 / ROWS_PER_FILE), row_bytes(df) / BYTES_PER_FILE))
            tasks = min(number, max(MANY_FILES, math.ceil(placed.agg(load).first()[0] / TASK_PART)))
            task = F.floor(F.col("_file") * tasks / number).cast("int")
            dealt = placed.withColumn("_task", task).repartitionById(tasks, "_task").drop("_task")
            dealt.write.partitionBy("_file").parquet(f"{self.path}/data/{batch}")
        files = _opened(self.spark, df.schema, [f"{self.path}/data/{batch}"])
        return files.groupBy(_name().alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.col("_metadata.file_size")).alias("bytes"),
            F.min(self.key).cast("string").alias("low"), F.max(self.key).cast("string").alias("high"),
        )

    def _commit(self, live: DataFrame, base: int) -> None:
        """Finish version ``base`` + 1. Folder and success mark are made once, so of two loads onto one version the second fails."""
        fs, path = self._fs()
        staged, final = f"{self.path}/staged/{uuid.uuid4().hex}", f"{self.path}/manifests/v{base + 1}"
        live.select("file", "rows", "bytes", "low", "high").write.parquet(staged)
        fs.mkdirs(path(f"{self.path}/manifests"))
        if fs.exists(path(final)) or not fs.rename(path(staged), path(final)):
            raise RuntimeError(f"another load has finished version {base + 1} of {self.path}")

    def create(self, df: DataFrame) -> FileTable:
        """Replace all rows; the first call also fixes the schema."""
        base = self.version()
        if not base:
            self.spark.createDataFrame([(df.schema.json(),)], "s string").coalesce(1).write.mode("overwrite").text(f"{self.path}/schema")
        self._commit(self._write(df), base)
        return self

    def append(self, df: DataFrame) -> FileTable:
        base = self.version()
        self._commit(self.manifest(base).unionByName(self._write(df.select(*self._schema().names))), base)
        return self

    def holding(self, keys: DataFrame, columns: Sequence[str], version: int | None = None) -> DataFrame:
        """(file) of the live files with a row whose ``columns`` are among ``keys``.

        Files whose bounds miss the least and largest key are not opened; of the others only the key columns are read.
        """
        kind = self._schema()[self.key].dataType
        live = self.manifest(version)
        if self.key in columns:
            low, high = keys.agg(F.min(self.key), F.max(self.key)).first()
            live = live.where((F.col("low").cast(kind) <= F.lit(high)) & (F.col("high").cast(kind) >= F.lit(low)))
        names = [r["file"] for r in live.select("file").toLocalIterator()]
        if not names:
            return self.spark.createDataFrame([], "file string")
        rows = _opened(self.spark, self._schema(), [f"{self.path}/data/{n}" for n in names])
        found = rows.select(*columns, _name().alias("file"))
        return found.join(keys.select(*columns).distinct(), list(columns), "left_semi").select("file").distinct()

    def replace_keys(self, df: DataFrame, columns: Sequence[str]) -> FileTable:
        """Drop the stored rows whose ``columns`` occur in ``df`` and add its rows; NULL keys match nothing.

        Only the files that hold such a row are rewritten. Loading the same rows again changes nothing.
        """
        base, columns = self.version(), list(columns)
        rows = materialize(df.select(*self._schema().names), "incoming")
        keys = rows.select(*columns).distinct()
        touched = materialize(self.holding(keys, columns, base), "touched")
        names = [r["file"] for r in touched.toLocalIterator()]
        new = rows
        if names:
            old = _opened(self.spark, self._schema(), [f"{self.path}/data/{n}" for n in names])
            new = old.join(keys, columns, "left_anti").select(*rows.columns).unionByName(rows)
        live = self.manifest(base).join(touched, "file", "left_anti")
        self._commit(live.unionByName(self._write(new)), base)
        return self

    def vacuum(self) -> int:
        """Delete the files that the last version does not list, and earlier manifests; how many files went."""
        fs, path = self._fs()
        last = self.version()
        live, gone = {r["file"] for r in self.manifest(last).select("file").toLocalIterator()}, 0
        for batch in fs.listStatus(path(f"{self.path}/data")):
            top = batch.getPath().toString()
            files, listed = [], fs.listFiles(batch.getPath(), True)
            while listed.hasNext():
                files.append(listed.next().getPath())
            dead = [f for f in files if f"{batch.getPath().getName()}{f.toString()[len(top):]}" not in live]
            gone += sum(f.getName().endswith(".parquet") for f in dead)
            if len(dead) == len(files):
                fs.delete(batch.getPath(), True)
            else:
                for f in dead:
                    fs.delete(f, False)
        for status in fs.listStatus(path(f"{self.path}/manifests")):
            if status.getPath().getName() != f"v{last}":
                fs.delete(status.getPath(), True)
        return gone
