import datetime as dt
import os
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.registry import core
from tidemark.session import discard, materialize, shared_dir
from tidemark.sources import loader, readers

AT = dt.datetime(2024, 1, 1)


@pytest.fixture
def database(spark, tmp_path):
    name = "t_" + uuid.uuid4().hex
    loader.ensure_database(spark, name, str(tmp_path / "db"))
    loader.ensure_database(spark, name)
    return name


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v string")


def test_shared_dir_comes_from_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert materialize(spark.range(3), "x").count() == 3


def test_discard_removes_scratch_only(spark, tmp_path):
    kept = materialize(spark.range(5), "y")
    folder = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    spark.range(3).write.parquet(str(tmp_path / "own"))
    own = spark.read.parquet(str(tmp_path / "own"))
    discard(kept, own, materialize(spark.range(0), "none"))
    assert not os.path.exists(folder) and own.count() == 3


def test_create_append_replace(spark, rows, database):
    table = f"{database}.t"
    loader.upload(frame(spark, [(1, "a")]), table, "create", loaded_at=AT)
    out = loader.upload(frame(spark, [(2, "b")]).drop("v").withColumn("more", F.lit(1)), table, loaded_at=AT)
    assert rows(out) == [(1, "a", AT), (2, None, AT)]
    assert readers.table_schema(spark, table).names == ["k", "v", loader.LOADED_AT]
    out = loader.upload(frame(spark, [(3, "c")]), table, "Replace", add_timestamp=False)
    assert rows(out, "k", "v") == [(3, "c")]


def test_empty_and_bad_mode(spark, database):
    assert loader.upload(frame(spark, []), f"{database}.none", "CREATE") is None
    assert not spark.catalog.tableExists(f"{database}.none")
    with pytest.raises(ValueError):
        loader.upload(frame(spark, [(1, "a")]), "t", "UPSERT")


def test_dry_run_loads_five(spark, database):
    out = loader.upload(frame(spark, [(i, "x") for i in range(9)]), f"{database}.dry", "CREATE", dry_run=True)
    assert out.count() == 5


def test_keyed_replace_is_idempotent(spark, rows, database):
    table = f"{database}.u"
    loader.upload(frame(spark, [(1, "a"), (2, "b"), (None, "n")]), table, "CREATE", add_timestamp=False)
    new = frame(spark, [(2, "B"), (2, "BB"), (3, "C")])
    for _ in range(2):
        out = loader.upload(new, table, "APPEND", keys=["k"], add_timestamp=False)
    assert rows(out) == [(None, "n"), (1, "a"), (2, "B"), (2, "BB"), (3, "C")]
    out = loader.upload(frame(spark, [(None, "m")]), table, keys=["k"], add_timestamp=False)
    assert rows(out)[:2] == [(None, "m"), (None, "n")]


def test_keyed_replace_leaves_other_partitions(spark, rows, database, tmp_path):
    table = f"{database}.p"
    old = spark.createDataFrame([(1, "a", 2000), (2, "b", 2001)], "k int, v string, y int")
    loader.upload(old, table, "CREATE", add_timestamp=False, partition_by=["y"])
    before = {f.name for f in (tmp_path / "db" / "p" / "y=2000").iterdir()}
    new = spark.createDataFrame([(2, "B", 2001), (3, "c", 2002)], "k int, v string, y int")
    out = loader.upload(new, table, "APPEND", keys=["k", "y"], add_timestamp=False)
    assert rows(out) == [(1, "a", 2000), (2, "B", 2001), (3, "c", 2002)]
    assert {f.name for f in (tmp_path / "db" / "p" / "y=2000").iterdir()} == before
    # Without the partition column among the keys every partition may hold a match.
    out = loader.upload(spark.createDataFrame([(1, "z", 2002)], "k int, v string, y int"), table, keys=["k"], add_timestamp=False)
    assert rows(out) == [(1, "z", 2002), (2, "B", 2001), (3, "c", 2002)]


def test_keyed_replace_keeps_rows_of_a_null_partition(spark, rows, database):
    table = f"{database}.n"
    schema = "k int, v string, y int"
    loader.upload(spark.createDataFrame([(1, "a", None), (2, "b", 2001)], schema), table, "CREATE", add_timestamp=False, partition_by=["y"])
    out = loader.upload(spark.createDataFrame([(9, "c", None), (2, "B", 2001)], schema), table, keys=["k", "y"], add_timestamp=False)
    assert rows(out) == [(1, "a", None), (2, "B", 2001), (9, "c", None)]


def test_a_broken_replace_leaves_the_table(spark, rows, database):
    table = f"{database}.b"
    loader.upload(frame(spark, [(1, "a")]), table, "CREATE", add_timestamp=False)
    failing = F.udf(lambda k: 1 // 0, "int")
    with pytest.raises(Exception):
        loader._overwrite(frame(spark, [(2, "b")]).withColumn("k", failing("k")), table)
    assert rows(spark.table(table)) == [(1, "a")]
    loader.upload(frame(spark, [(3, "c")]), table, "REPLACE", add_timestamp=False)
    loader.upload(frame(spark, [(4, "d")]), table, "APPEND", add_timestamp=False)
    assert rows(spark.table(table)) == [(3, "c"), (4, "d")]


def test_csv_crlf_and_blanks(spark, rows, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes(b"rk,name,extra\r\n1,Ann Lee,\r\n2,Bo,(x)")
    assert rows(readers.read_csv(spark, str(path), "rk int, name string, extra string")) == [
        (1, "Ann Lee", None), (2, "Bo", "(x)"),
    ]
    assert dict(readers.read_csv(spark, str(path)).dtypes)["rk"] == "int"


def test_year_shards(spark, rows, tmp_path):
    for year in (2017, 2018):
        spark.createDataFrame([(year * 10,)], "v int").write.parquet(f"{tmp_path}/views_{year}")
    got = readers.read_year_shards(spark, f"{tmp_path}/views_{{year}}", 2017, 2018)
    assert rows(got) == [(20170, 2017), (20180, 2018)]
    assert rows(readers.year_range(spark, 2017, 2019)) == [(2017,), (2018,), (2019,)]


def test_files(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"123")
    (tmp_path / "b.txt").write_bytes(b"1")
    listed = readers.list_files(spark, str(tmp_path), "*.png").collect()
    assert [(r["uri"].rsplit("/", 1)[1], r["length"]) for r in listed] == [("a.png", 3)]
    assert bytes(readers.file_contents(spark, str(tmp_path), "*.png").first()["content"]) == b"123"


def test_query_with_parameters(spark, rows):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2021, 1, 1),)], "d date")
    got = readers.run_query(spark, "SELECT d FROM {t} WHERE d >= :start", {"start": dt.date(2020, 6, 1)}, t=df)
    assert rows(got) == [(dt.date(2021, 1, 1),)]
    assert readers.preview(df, 1, F.desc("d")).first()["d"] == dt.date(2021, 1, 1)
    assert readers.random_rows(df, 1, seed=1).count() == 1


def test_random_rows_do_not_depend_on_partitioning(spark, rows):
    df = spark.range(200).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    first = rows(readers.random_rows(df, 5, seed=3))
    for parts in (1, 7):
        assert rows(readers.random_rows(df.repartition(parts), 5, seed=3)) == first
        assert rows(readers.random_rows(df.repartition(parts), 5, seed=3, key="k")) == rows(readers.random_rows(df, 5, seed=3, key="k"))
    assert rows(readers.random_rows(df, 5, seed=4)) != first
    assert readers.random_rows(df.where("k < 0"), 2).count() == 0


def test_row_counts_of_tables_whose_parts_share_names(spark, tmp_path):
    for i, name in enumerate(core.TABLES):
        (tmp_path / f"{name}.parquet").mkdir()
        pd.DataFrame({"x": range(i + 1)}).to_parquet(tmp_path / f"{name}.parquet" / "part-0.parquet")
    got = {r.file: r.num_rows for r in core.file_row_counts(spark, str(tmp_path)).collect()}
    assert got == {f"{name}.parquet/part-0.parquet": i + 1 for i, name in enumerate(core.TABLES)}
    assert core.file_row_counts(spark, str(tmp_path)).count() == len(core.TABLES)
