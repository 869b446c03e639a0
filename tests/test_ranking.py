import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import grouping, ranking, skew
from tidemark.session import materialize


def sample(spark, seed=3, n=600):
    """A third of the rows in one group, a third of those with one value, some NULLs."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        value = 7.0 if i % 9 == 0 else rng.choice([None, *[float(v) for v in range(-40, 40)]])
        data.append((i, group, value))
    return spark.createDataFrame(data, "id int, g string, v double")


def test_tie_ranks(spark, rows):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", None)], "n string, v int").withColumn("g", F.lit(1))
    assert rows(df.withColumns(ranking.tie_ranks("v", ["g"], "v")), "n", "v_rk", "v_num_at_rk") == [
        ("a", 1, 2), ("b", 1, 2), ("c", 3, 1), ("d", None, None),
    ]
    mean = df.withColumns(ranking.tie_ranks("v", ["g"], "v", "average"))
    assert rows(mean, "n", "v_rk") == [("a", 1.5), ("b", 1.5), ("c", 3.0), ("d", None)]
    unique = df.withColumn("u", ranking.unique_rank("v", ["n"], ["g"]))
    assert rows(unique, "n", "u") == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


@pytest.mark.parametrize("keys", [["g"], []])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("limit", [0, 10_000])
def test_scaled_rank_equals_window(spark, rows, monkeypatch, keys, descending, limit):
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    df = sample(spark)
    got = ranking.scaled_rank(df, keys, "v", "rk", descending, num_at_rank="ties", one_task_rows=limit)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    plain = df.withColumn("rk", F.when(F.col("v").isNotNull(), F.rank().over(Window.partitionBy(*keys).orderBy(order))))
    plain = plain.withColumn("ties", F.when(F.col("v").isNotNull(), F.count("*").over(Window.partitionBy(*keys, "v"))))
    assert rows(got, "id", "rk", "ties") == rows(plain, "id", "rk", "ties")


def test_scaled_rank_uses_many_ranges(spark):
    df = spark.range(1000).withColumn("g", F.lit("x"))
    assert ranking.range_buckets(df, ["g"], "id", one_task_rows=0)[0].select("_bucket").distinct().count() > 20
    assert ranking.range_buckets(df, [], "id", one_task_rows=0)[0].select("_bucket").distinct().count() > 20


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(9,2)"])
def test_ranks_of_other_types(spark, rows, kind):
    days = spark.range(90).select("id", F.expr("date_add(date'2020-01-01', cast(id % 40 as int))").alias("d"))
    df = days.select("id", (F.col("id") % 40).cast(kind).alias("v") if kind.startswith("decimal") else F.col("d").cast(kind).alias("v"))
    got = ranking.scaled_rank(df, [], "v", "rk", one_task_rows=0)
    plain = df.withColumn("rk", F.rank().over(Window.orderBy("v")))
    assert rows(got, "id", "rk") == rows(plain, "id", "rk")


def test_lookup_join_with_hot_keys(spark, rows):
    df = sample(spark).drop("v")
    lookup = df.groupBy("g").agg(F.count("*").alias("w")).withColumn("label", F.concat(F.lit("L"), F.coalesce("g", F.lit("?"))))
    got = skew.lookup_join(df, lookup, ["g"], "w", hot_rows=50)
    assert got.count() == df.count()
    assert rows(got.select("g", "label").distinct()) == rows(lookup, "g", "label")


def test_five_numbers(spark):
    df = sample(spark)
    got = {r["g"]: r for r in ranking.five_numbers(df, ["g"], "v").collect()}
    for group, r in got.items():
        values = sorted(x["v"] for x in df.where(F.col("g").eqNullSafe(F.lit(group))).collect() if x["v"] is not None)
        q = statistics.quantiles(values, n=4, method="inclusive")
        assert [r["min"], r["q1"], r["median"], r["q3"], r["max"]] == pytest.approx([values[0], *q, values[-1]])
        assert r["n"] == len(values)


@pytest.mark.parametrize("limit", [0, 10_000])
def test_group_slices(spark, limit):
    got = ranking.group_slices(spark.range(1, 11), 4, "id", one_task_rows=limit)
    import math

    assert {r["id"]: r["upload_group"] for r in got.collect()} == {i: math.ceil(i / 10 * 4) for i in range(1, 11)}
    odd = spark.range(12).select(F.when(F.col("id") < 9, F.lit("same")).alias("v"))
    slices = [r["upload_group"] for r in ranking.group_slices(odd, 4, "v", one_task_rows=limit).collect()]
    assert sorted(slices) == sorted([1, 2, 3, 4] * 3)


def test_text_positions_and_many_large_groups(spark, rows):
    df = spark.range(3000).select("id", (F.col("id") % 100).alias("g"), F.concat(F.lit("t"), (F.col("id") * 7 % 50)).alias("v"))
    got = ranking.scaled_rank(df, ["g"], "v", "rk", one_task_rows=5)
    plain = df.withColumn("rk", F.rank().over(Window.partitionBy("g").orderBy("v")))
    assert rows(got, "id", "rk") == rows(plain, "id", "rk")


@pytest.mark.parametrize("limit", [0, 10_000])
def test_digest_parts_make_up_the_whole(spark, limit):
    data = [("k", i // 2, f"t{i:03d}") for i in range(50)] + [("z", 1, "x"), ("z", 0, None)]
    df = spark.createDataFrame(data, "k string, o int, t string")
    got = grouping.text_digest(
        df, ["k"], F.col("t"), "o", 6, "d", "|", descending=True, tie_break=[("t", False)], one_task_rows=limit
    )
    parts = sorted((r for r in got.collect() if r["k"] == "k"), key=lambda r: r["part"])
    whole = "|".join(p["d"] for p in parts)
    wanted = [t for _, _, t in sorted(data[:50], key=lambda r: (-r[1], r[2]))]
    assert whole == "|".join(wanted) and len(parts) > 5 and max(p["num_texts"] for p in parts) <= 7
    assert [r["d"] for r in got.collect() if r["k"] == "z"] == ["x"]


def test_equal_order_values_are_split(spark):
    df = spark.range(200).select(F.lit("k").alias("k"), F.lit(1).alias("o"), "id")
    got = grouping.nested_parts(df, ["k"], "o", 20, ["id"], one_task_rows=0).collect()
    assert sorted(x["id"] for r in got for x in r["rows"]) == list(range(200))
    assert len(got) >= 8


@pytest.mark.parametrize("limit", [0, 10_000])
def test_scaled_unique_rank_equals_window(spark, rows, limit):
    named = materialize(sample(spark).withColumn("n", F.monotonically_increasing_id()), "named")
    wanted = named.withColumn("u", ranking.unique_rank("v", ["n"], ["g"]))
    got = ranking.scaled_unique_rank(named, "v", ["n"], ["g"], "u", limit)
    assert rows(got, "g", "n", "u") == rows(wanted, "g", "n", "u")


def test_a_small_limit_does_not_make_ever_more_ranges(spark):
    df = spark.range(20_000).withColumn("g", F.lit(1))
    placed, split = ranking.range_buckets(df, ["g"], "id", 1)
    assert split and placed.agg(F.count_distinct("_bucket")).first()[0] <= 256
    numbered = ranking.row_positions(df, ["g"], [F.asc("id")], "at", 1)
    assert numbered.where("at <> id").count() == 0 and numbered.count() == 20_000
