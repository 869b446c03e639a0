"""Reading tables, files, year shards and query results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.reshape import union_by_name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def preview(df: DataFrame, rows: int, *order: Column | str) -> DataFrame:
    """The first rows, in a stated order where one is given."""
    return (df.orderBy(*order) if order else df).limit(rows)


def random_rows(df: DataFrame, rows: int = 1, seed: int = 0, key: str | None = None) -> DataFrame:
    """``rows`` rows picked by a hash of seed and ``key`` (the whole row if not given): the same under any partitioning.

    Each task keeps its least hashes only. Keys that occur several times go together, ordered by the whole row.
    """
    whole = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    own = F.coalesce(F.col(key).cast("string"), F.lit("")) if key else whole
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), own).cast("binary")), own, whole).limit(rows)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row. Without a schema the types are guessed in an extra pass."""
    reader = spark.read.option("header", True).option("multiLine", False)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_year_shards(
    spark: SparkSession, template: str, first: int, last: int, year: str = "source_year"
) -> DataFrame:
    """Same-schema parquet datasets named by year, e.g. ``/data/views_{year}``.

    ``year`` is a literal per shard, so a filter on it drops whole shards while planning.
    """
    shards = [
        spark.read.parquet(template.format(year=y)).withColumn(year, F.lit(y)) for y in range(first, last + 1)
    ]
    return union_by_name(*shards)


def write_year_shards(df: DataFrame, root: str, year: str) -> None:
    """One folder per year under ``root``; readers prune by ``year``."""
    df.write.partitionBy(year).mode("overwrite").parquet(root)


def year_range(spark: SparkSession, first: int, last: int, name: str = "year") -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per file: uri, size and time. The contents are not read unless asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    listed = files.option("recursiveFileLookup", True).load(folder)
    return listed.select(
        F.col("path").alias("uri"), "length", F.col("modificationTime").alias("modification_time")
    )


def file_contents(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return files.option("recursiveFileLookup", True).load(folder).select(F.col("path").alias("uri"), "content")


def table_schema(spark: SparkSession, table: str) -> T.StructType:
    return spark.table(table).schema


def run_query(
    spark: SparkSession, text: str, params: Mapping[str, object] | None = None, **tables: DataFrame
) -> DataFrame:
    """SQL text with named parameters (``:start_date``) over the given frames (``{sales}``)."""
    return spark.sql(text, args=dict(params or {}), **tables)
