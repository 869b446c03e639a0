import pytest
from pyspark.sql import functions as F

from tidemark.sources import filetable
from tidemark.sources.filetable import FileTable, deal_by_size


@pytest.fixture
def table(spark, tmp_path):
    return FileTable(spark, str(tmp_path / "t"), "k", rows_per_file=100)


def numbered(spark, low, high, tag="a"):
    return spark.range(low, high).select(F.col("id").alias("k"), F.concat(F.lit(tag), F.col("id").cast("string")).alias("v"))


def test_files_keep_both_limits(spark):
    texts = spark.range(1000).select("id", F.repeat(F.lit("x"), F.when(F.col("id") % 97 == 0, 900).otherwise(10).cast("int")).alias("t")).repartition(7)
    dealt = deal_by_size(texts, rows=200, size=4000)
    each = dealt.withColumn("b", filetable.row_bytes(dealt)).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("b").alias("b")).collect()
    assert sum(r.n for r in each) == 1000
    assert all(r.n <= 200 and r.b <= 4000 for r in each)
    assert len(each) <= 2 * (1000 * 25 / 4000) + 11 + 2  # 11 rows are heavy and have their own
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
    alone = deal_by_size(spark.createDataFrame([("y" * 9000,), ("z",)], "t string"), size=4000)
    assert alone.rdd.getNumPartitions() >= 2 and alone.count() == 2
    assert deal_by_size(texts.where("id < 0")).count() == 0


def test_only_files_that_hold_a_key_are_rewritten(spark, table):
    table.create(numbered(spark, 0, 1000).repartitionByRange(5, "k"))
    before = {r.file: (r.low, r.high) for r in table.manifest().collect()}
    assert len(before) >= 10
    new = numbered(spark, 205, 210, "b").unionByName(numbered(spark, 5000, 5001, "b"))
    held = {r.file for r in table.holding(new, ["k"]).collect()}
    assert 1 <= len(held) <= 2
    table.replace_keys(new, ["k"])
    after = {r.file for r in table.manifest().collect()}
    assert set(before) - after == held
    assert sorted(r.v for r in table.read().where("v LIKE 'b%'").collect()) == ["b205", "b206", "b207", "b208", "b209", "b5000"]
    assert table.read().count() == 1001
    again = table.replace_keys(new, ["k"]).read()
    assert again.count() == 1001
    assert table.read(1).count() == 1000  # an earlier version stays readable


def test_null_keys_match_nothing(spark, rows, table):
    table.create(spark.createDataFrame([(None, "n"), (1, "a")], "k long, v string"))
    got = table.replace_keys(spark.createDataFrame([(None, "m"), (1, "b")], "k long, v string"), ["k"]).read()
    assert rows(got, "k", "v") == [(None, "m"), (None, "n"), (1, "b")]


def test_a_broken_write_leaves_the_table(spark, table, monkeypatch):
    table.create(numbered(spark, 0, 10))
    failing = F.udf(lambda k: 1 // 0 if k == 7 else k, "long")
    with pytest.raises(Exception):
        table.replace_keys(numbered(spark, 5, 9, "b").withColumn("k", failing("k")), ["k"])
    monkeypatch.setattr(FileTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.replace_keys(numbered(spark, 5, 9, "b"), ["k"])
    assert table.version() == 1 and table.read().where("v LIKE 'a%'").count() == 10


def test_of_two_loads_onto_one_version_the_second_fails(spark, table):
    table.create(numbered(spark, 0, 10))
    with pytest.raises(RuntimeError):
        table._commit(table.manifest(), 0)
    assert table.read().count() == 10


def test_append_and_vacuum(spark, table):
    table.create(numbered(spark, 0, 10)).append(numbered(spark, 10, 20).withColumn("more", F.lit(1)))
    table.replace_keys(numbered(spark, 0, 20, "c"), ["k"])
    assert table.vacuum() >= 2
    assert table.read().count() == 20 and table.read().where("v LIKE 'c%'").count() == 20
    assert table.create(numbered(spark, 0, 0)).read().count() == 0


def test_many_small_files_take_few_tasks(spark, tmp_path):
    table = FileTable(spark, str(tmp_path / "t"), "k", rows_per_file=5).create(numbered(spark, 0, 1000))
    files = table.manifest().collect()
    assert len(files) >= 200 and max(r.rows for r in files) <= 5 and sum(r.rows for r in files) == 1000
    assert len({r.file.rsplit("/", 1)[1].split("-")[1] for r in files}) <= 64
    table.replace_keys(numbered(spark, 500, 505, "b"), ["k"])
    assert table.vacuum() >= 1
    assert sorted(r.k for r in table.read().collect()) == list(range(1000))
    assert table.read().where("v LIKE 'b%'").count() == 5 and table.read().columns == ["k", "v"]
