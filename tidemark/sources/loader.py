"""Loading frames into tables: create, replace, append, and keyed replace."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import join_same
from tidemark.session import materialize, scratch_path

MODES = ("CREATE", "REPLACE", "APPEND")
# Rows per output file, and the name of the load-time column.
ROWS_PER_FILE = 2_000_000
LOADED_AT = "uploadTimestampUTC"
DRY_RUN_ROWS = 5
MAX_LISTED_PARTITIONS = 1000
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def create_or_replace(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Table from a query result. Row order is not kept, so sort when reading."""
    writer = df.write.mode("overwrite").format("parquet").option("maxRecordsPerFile", ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def conform(df: DataFrame, target: DataFrame) -> DataFrame:
    """Only the target's columns, in its order and types; missing ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def upload(
    df: DataFrame,
    table: str,
    mode: str = "APPEND",
    keys: Sequence[str] = (),
    add_timestamp: bool = True,
    dry_run: bool = False,
    loaded_at: dt.datetime | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame | None:
    """Load ``df`` into ``table`` and return the table; nothing happens for an empty frame.

    CREATE and REPLACE write the whole table (CREATE takes the frame's schema, REPLACE keeps
    the table's). APPEND adds rows; with ``keys`` it first drops the stored rows whose keys
    occur in ``df``, so loading the same rows again changes nothing. NULL keys match nothing.
    """
    mode = mode.upper()
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    # evaluated once: the keys that are dropped are those of the rows that are added, also of random columns
    df = materialize(df, "incoming")
    if df.isEmpty():
        return None
    spark = df.sparkSession
    if add_timestamp:
        stamp = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        df = df.withColumn(LOADED_AT, F.lit(stamp.isoformat(sep=" ")).cast("timestamp_ntz"))
    if dry_run:
        df = df.orderBy(*(keys or [c for c in df.columns if c != LOADED_AT])).limit(DRY_RUN_ROWS)
    if mode == "CREATE":
        return create_or_replace(df, table, partition_by)
    target = spark.table(table)
    rows = conform(df, target)
    if mode == "REPLACE":
        _overwrite(rows, table)
    elif keys:
        _replace_keys(rows, table, list(keys))
    else:
        rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).insertInto(table)
    return spark.table(table)


def _replace_keys(rows: DataFrame, table: str, keys: list[str]) -> None:
    """Stored rows without the incoming keys, plus the incoming rows.

    When the keys include the partition columns, only the partitions the new rows fall in are
    read and written; the others cannot hold a match.
    """
    spark = rows.sparkSession
    target = spark.table(table)
    incoming = rows.select(*keys).distinct()
    partitions = _partition_columns(spark, table)
    touched = target
    partial = bool(partitions) and set(partitions) <= set(keys)
    if partial:
        wanted = rows.select(*partitions).distinct()
        for column in partitions:
            touched = touched.where(_among(column, wanted))
        touched = join_same(touched, wanted, partitions, "left_semi")
    kept = touched.join(incoming, keys, "left_anti")
    _overwrite(kept.select(*target.columns).unionByName(rows), table, dynamic=partial)


def _among(column: str, wanted: DataFrame) -> Column:
    """A filter by listed values, or by their bounds if the list is long; both prune partitions while planning."""
    found = wanted.select(column).distinct().limit(MAX_LISTED_PARTITIONS + 1).collect()
    values = [r[0] for r in found]
    if len(values) > MAX_LISTED_PARTITIONS:
        low, high = wanted.agg(F.min(column), F.max(column)).first()
        return F.col(column).between(F.lit(low), F.lit(high)) | F.col(column).isNull()
    listed = F.col(column).isin([v for v in values if v is not None])
    return listed | F.col(column).isNull() if None in values else listed


def _overwrite(rows: DataFrame, table: str, dynamic: bool = False) -> None:
    """All rows of the table, or with ``dynamic`` those of the partitions that ``rows`` fall in.

    A table without partitions gets a new folder beside the old one and is then pointed to it, so a write that breaks leaves it
    as it was. Partitions are written to a staging folder and then replaced one by one, since each has an entry of its own.
    """
    spark = rows.sparkSession
    partitions = _partition_columns(spark, table)
    if not partitions:
        found = spark.catalog.getTable(table)
        root = spark.catalog.getDatabase(found.namespace[-1]).locationUri.rstrip("/")
        folder = f"{root}/{found.name}-{uuid.uuid4().hex}"
        rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(folder)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return
    staging = scratch_path(spark, "staging")
    rows.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(staging)
    staged = spark.read.schema(rows.schema).parquet(staging)
    # insertInto follows the session setting, not a writer option.
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic" if dynamic else "static")
    try:
        staged.write.option("maxRecordsPerFile", ROWS_PER_FILE).insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)
    spark.catalog.refreshTable(table)


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
