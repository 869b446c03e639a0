"""Readers, loaders, profiles and sampling on the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.scalars import file_name, month_key, month_start, null_if_text
from tidemark.operators.grouping import profile_by
from tidemark.operators.ranking import ONE_TASK_ROWS, group_slices
from tidemark.operators.reshape import columns_first, union_by_name
from tidemark.operators.similarity import unit_vectors
from tidemark.session import scratch_path
from tidemark.sources import loader
from tidemark.sources.filetable import FileTable
from tidemark.sources.readers import (
    list_files, preview, random_rows, read_csv, read_table, read_year_shards, run_query, write_year_shards,
)

LOADED = dt.datetime(2024, 5, 1, 12, 0, 0)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _database(spark) -> str:
    """A database of its own in the shared folder, so runs do not meet."""
    path = scratch_path(spark, "db")
    name = "tidemark_" + path.rsplit("-", 1)[1]
    loader.ensure_database(spark, name, path)
    return name


def table_preview(spark, sf):
    return preview(read_table(spark, sf, "part"), 10, "p_partkey")


def pruned_scan(spark, sf):
    """Three columns and a filter, both left to the scan."""
    orders = read_table(spark, sf, "orders").where(F.col("o_orderdate") >= F.lit(dt.date(1997, 1, 1)))
    return orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


def csv_round_trip(spark, sf):
    """Customers written as CSV with a header and read back with a schema."""
    rows = read_table(spark, sf, "customer")
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).csv(path)
    return read_csv(spark, path, rows.schema)


def year_shard_union(spark, sf):
    """Orders kept in one dataset per year; some years read back by name and put together."""
    orders = read_table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    root = scratch_path(spark, "shards")
    write_year_shards(orders, root, "year")
    shards = read_year_shards(spark, root + "/year={year}", 1996, 1999)
    return shards.groupBy("source_year", "o_orderstatus").agg(F.count(F.lit(1)).alias("num_orders"))


def year_partition_scan(spark, sf):
    """The same rows through one partitioned dataset; other years are not opened."""
    orders = read_table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    root = scratch_path(spark, "by-year")
    write_year_shards(orders, root, "year")
    kept = spark.read.parquet(root).where(F.col("year").between(1996, 1999))
    return kept.groupBy(F.col("year").alias("source_year"), "o_orderstatus").agg(F.count(F.lit(1)).alias("num_orders"))


def file_listing(spark, sf):
    return list_files(spark, sf, "*.parquet")


def file_row_counts(spark, sf):
    """Every listed file with the number of rows that reading its table finds in it."""
    def below(path):  # parts of different tables may have one name
        return F.regexp_extract(path, r"/([^/]+\.parquet(?:/.*)?)$", 1).alias("file")

    counts = [read_table(spark, sf, name).groupBy(below("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n")) for name in TABLES]
    listed = list_files(spark, sf, "*.parquet").select(below("uri"))
    return listed.join(union_by_name(*counts), "file", "left").select("file", F.coalesce("n", F.lit(0)).alias("num_rows"))


def sql_with_parameters(spark, sf):
    text = """
        SELECT date_format(o_orderdate, 'yyyy-MM') AS month, count(*) AS num_orders
        FROM {orders} WHERE o_orderdate >= :start_date AND o_totalprice > :min_price
        GROUP BY date_format(o_orderdate, 'yyyy-MM')"""
    params = {"start_date": dt.date(1998, 1, 1), "min_price": 100_000.0}
    return run_query(spark, text, params, orders=read_table(spark, sf, "orders"))


def segment_profile(spark, sf):
    customers = read_table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    averages = profile_by(
        customers, "c_mktsegment", F.count(F.lit(1)).alias("num_customers"), F.avg("c_acctbal").alias("avg_balance")
    )
    return averages.withColumn("avg_balance", F.round("avg_balance", 4))


def nation_profile(spark, sf):
    """The same profile by another column, sorted by it."""
    customers = read_table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    averages = profile_by(
        customers, "c_nationkey", F.count(F.lit(1)).alias("num_customers"), F.avg("c_acctbal").alias("avg_balance"),
        F.count_distinct("c_mktsegment").alias("num_segments"),
    )
    return averages.withColumn("avg_balance", F.round("avg_balance", 4)).orderBy("c_nationkey")


def random_order(spark, sf):
    return random_rows(read_table(spark, sf, "orders"), 1, seed=7, key="o_orderkey")


def columns_in_front(spark, sf):
    """Suppliers with balance and nation in front and a file name made of three parts, the name itself left out."""
    suppliers = read_table(spark, sf, "supplier").withColumn("file", file_name(F.lit("balance of"), "s_name", "s_nationkey", extension="csv"))
    return columns_first(suppliers, ["s_acctbal", "s_nationkey"], ["s_name"])


def month_starts(spark, sf):
    """Orders per month, the month as text and as the date it begins with; urgent priorities count as unknown."""
    orders = read_table(spark, sf, "orders").withColumn("month", month_key("o_orderdate"))
    known = orders.withColumn("priority", null_if_text(F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")), "1-URGENT"))
    counted = known.groupBy("month").agg(F.count(F.lit(1)).alias("num_orders"), F.count("priority").alias("known"))
    return counted.withColumn("starts", month_start("month"))


def vectors_with_direction(spark, sf):
    """Vectors of every tenth row emptied and of every eleventh set to zero: these have no direction and go."""
    row, vector = F.col("vec_id"), F.col("embedding")
    zero = F.transform(vector, lambda x: (x * 0).cast("float"))
    changed = read_table(spark, sf, "embeddings").withColumn("embedding", F.when(row % 10 == 0, F.array().cast("array<float>")).when(row % 11 == 0, zero).otherwise(vector))
    units = unit_vectors(changed, "vec_id", "embedding")
    return units.select("key", F.size("unit").alias("dims"), F.round(F.col("unit")[0], 6).alias("first"))


def upload_slices_split(spark, sf):
    """The same with the table counted as too large for one task."""
    return upload_slices(spark, sf, 100)


def upload_slices(spark, sf, one_task_rows=ONE_TASK_ROWS):
    """Rows per slice when a load is split evenly in key order."""
    sliced = group_slices(read_table(spark, sf, "orders"), 8, "o_orderkey", one_task_rows)
    return sliced.groupBy("upload_group").agg(
        F.count(F.lit(1)).alias("num_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key")
    )


def _order_rows(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def upload_append(spark, sf):
    """Customers loaded by segment halves; the later load has a column too many and one missing."""
    table = _database(spark) + ".customers"
    rows = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    early = F.col("c_mktsegment") < "G"
    loader.upload(rows.where(early), table, "create", loaded_at=LOADED)
    later = rows.where(~early).drop("c_acctbal").withColumn("note", F.lit("x"))
    return loader.upload(later, table, "append", loaded_at=LOADED)


def upload_keyed_replace(spark, sf):
    """Orders before 2000, then orders from 1999 on with new prices; 1999 is in both."""
    table = _database(spark) + ".orders"
    rows = _order_rows(spark, sf)
    loader.upload(rows.where(F.col("o_orderdate") < F.lit(dt.date(2000, 1, 1))), table, "CREATE", loaded_at=LOADED)
    newer = rows.where(F.col("o_orderdate") >= F.lit(dt.date(1999, 1, 1))).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    out = loader.upload(newer, table, "APPEND", keys=["o_orderkey"], loaded_at=LOADED)
    return out.drop(loader.LOADED_AT).withColumn("o_totalprice", F.round("o_totalprice", 2))


def upload_keyed_partitions(spark, sf):
    """The same load into a table by year; only the years of the new rows are rewritten."""
    table = _database(spark) + ".orders"
    rows = _order_rows(spark, sf).withColumn("order_year", F.year("o_orderdate"))
    old = rows.where(F.col("order_year") < 2000)
    loader.upload(old, table, "CREATE", add_timestamp=False, partition_by=["order_year"])
    newer = rows.where(F.col("order_year") >= 1999).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    out = loader.upload(newer, table, "APPEND", keys=["o_orderkey", "order_year"], add_timestamp=False)
    return out.drop("order_year").withColumn("o_totalprice", F.round("o_totalprice", 2))


def upload_replace(spark, sf):
    table = _database(spark) + ".suppliers"
    rows = read_table(spark, sf, "supplier")
    loader.upload(rows, table, "CREATE", add_timestamp=False)
    loader.upload(rows.where(F.col("s_acctbal") > 1000), table, "REPLACE", add_timestamp=False)
    return spark.table(table)


def upload_dry_run(spark, sf):
    """A trial load: the first rows by key, in a table of their own."""
    table = _database(spark) + ".trial"
    return loader.upload(read_table(spark, sf, "customer"), table, "CREATE", keys=["c_custkey"], add_timestamp=False, dry_run=True)


def upload_empty(spark, sf):
    """Loading no rows leaves the table as it is."""
    table = _database(spark) + ".suppliers"
    rows = read_table(spark, sf, "supplier")
    loader.upload(rows, table, "CREATE", add_timestamp=False)
    loader.upload(rows.where(F.col("s_suppkey").isNull()), table, "REPLACE", add_timestamp=False)
    return spark.table(table)


def _order_files(spark, sf) -> FileTable:
    """Orders in files of at most 1,000 rows, dealt in key order."""
    table = FileTable(spark, scratch_path(spark, "orders"), "o_orderkey", rows_per_file=1000)
    return table.create(_order_rows(spark, sf).repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey"))


def file_table_keyed_replace(spark, sf):
    """Orders from 1999 on again with new prices, into a table kept as a list of files."""
    newer = _order_rows(spark, sf).where(F.col("o_orderdate") >= F.lit(dt.date(1999, 1, 1)))
    table = _order_files(spark, sf).replace_keys(newer.withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_orderkey"])
    return table.read().withColumn("o_totalprice", F.round("o_totalprice", 2))


def file_table_files(spark, sf):
    """Ten keys replaced: the table's files are within their limits, and only those that held one of the keys are new."""
    table = _order_files(spark, sf)
    new = _order_rows(spark, sf).orderBy("o_orderkey").limit(10).withColumn("o_totalprice", F.lit(0.0))
    held, before = table.holding(new, ["o_orderkey"]), table.manifest()
    after = table.replace_keys(new, ["o_orderkey"]).manifest()
    kept = after.join(before.select("file"), "file", "left_semi").agg(F.count(F.lit(1)).alias("kept"))
    gone = before.agg(F.count(F.lit(1)).alias("had")).crossJoin(held.agg(F.count(F.lit(1)).alias("held")))  # one row each
    sizes = after.agg(
        F.sum("rows").alias("num_rows"), (F.max("rows") <= table.rows_per_file).alias("rows_within"), (F.max("bytes") <= table.bytes_per_file).alias("bytes_within"),
        (F.count(F.lit(1)) >= F.ceil(F.sum("rows") / table.rows_per_file)).alias("enough_files"),
    )
    zero = table.read().where("o_totalprice = 0").agg(F.count(F.lit(1)).alias("replaced"))
    row = sizes.crossJoin(zero).crossJoin(kept).crossJoin(gone)
    return row.select("num_rows", "rows_within", "bytes_within", "enough_files", "replaced", (F.col("kept") == F.col("had") - F.col("held")).alias("others_kept"))


def table_from_query(spark, sf):
    table = _database(spark) + ".order_totals"
    totals = read_table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("num_orders"))
    return loader.create_or_replace(totals, table)


QUERIES = {
    f.__name__: f
    for f in (
        table_preview, pruned_scan, columns_in_front, month_starts, vectors_with_direction, csv_round_trip, year_shard_union, year_partition_scan, file_listing, file_row_counts,
        sql_with_parameters, segment_profile, nation_profile, random_order, upload_slices, upload_slices_split, upload_append,
        upload_keyed_replace, upload_keyed_partitions, upload_replace, upload_dry_run, upload_empty, table_from_query,
        file_table_keyed_replace, file_table_files,
    )
}

_SHARDS = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS source_year, o_orderstatus, count(*) AS num_orders
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY ALL"""
_SLICES = """
SELECT CAST(ceil(rn / n * 8) AS INTEGER) AS upload_group, count(*) AS num_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders) GROUP BY ALL"""
_REPLACED = """
SELECT o_orderkey, o_orderstatus, o_orderdate,
       round(CASE WHEN year(o_orderdate) >= 1999 THEN o_totalprice + 1 ELSE o_totalprice END, 2) AS o_totalprice FROM orders"""


def _profile(column: str, more: str = "") -> str:
    return f"""
SELECT {column}, count(*) AS num_customers, round(avg(c_acctbal), 4) AS avg_balance{more}
FROM customer WHERE c_acctbal > 0 GROUP BY {column}"""


SQL = {
    "table_preview": "SELECT * FROM part ORDER BY p_partkey LIMIT 10",
    "pruned_scan": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate >= DATE '1997-01-01'",
    "csv_round_trip": "SELECT * FROM customer",
    "random_order": "SELECT * FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 1",
    "columns_in_front": """
SELECT * EXCLUDE (s_name), replace('balance of_' || s_name || '_' || s_nationkey, ' ', '_') || '.csv' AS file FROM supplier""",
    "month_starts": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS num_orders, count(*) FILTER (o_orderpriority <> '1-URGENT') AS known,
       CAST(min(date_trunc('month', o_orderdate)) AS DATE) AS starts FROM orders GROUP BY ALL""",
    "vectors_with_direction": """
SELECT vec_id AS key, len(embedding)::INTEGER AS dims,
       round(embedding[1]::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS "first"
FROM embeddings WHERE vec_id % 10 <> 0 AND vec_id % 11 <> 0""",
    "year_shard_union": _SHARDS,
    "year_partition_scan": _SHARDS,
    "sql_with_parameters": """
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS num_orders FROM orders
WHERE o_orderdate >= DATE '1998-01-01' AND o_totalprice > 100000 GROUP BY ALL""",
    "segment_profile": _profile("c_mktsegment"),
    "nation_profile": _profile("c_nationkey", ", count(DISTINCT c_mktsegment) AS num_segments"),
    "upload_slices": _SLICES,
    "upload_slices_split": _SLICES,
    "file_row_counts": " UNION ALL ".join(f"SELECT '{name}.parquet' AS file, count(*) AS num_rows FROM {name}" for name in TABLES),
    "upload_append": """
SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment < 'G' THEN c_acctbal END AS c_acctbal,
       TIMESTAMP '2024-05-01 12:00:00' AS "uploadTimestampUTC" FROM customer""",
    "upload_keyed_replace": _REPLACED,
    "upload_keyed_partitions": _REPLACED,
    "file_table_keyed_replace": _REPLACED,
    "file_table_files": """
SELECT count(*) AS num_rows, TRUE AS rows_within, TRUE AS bytes_within, TRUE AS enough_files, 10::BIGINT AS replaced, TRUE AS others_kept FROM orders""",
    "upload_replace": "SELECT * FROM supplier WHERE s_acctbal > 1000",
    "upload_dry_run": f"SELECT * FROM customer ORDER BY c_custkey LIMIT {loader.DRY_RUN_ROWS}",
    "upload_empty": "SELECT * FROM supplier",
    "table_from_query": "SELECT o_orderstatus, count(*) AS num_orders FROM orders GROUP BY o_orderstatus",
}
