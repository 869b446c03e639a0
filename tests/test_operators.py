import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import grouping, joins, reshape
from tidemark.operators.similarity import nearest, pair_table, score_pairs
from tidemark.plans import sales, standings, views


def brute_asof(left, right, strict):
    out = []
    for k, t, i in left:
        earlier = [r for r in right if k is not None and r[0] == k and (r[1] < t if strict else r[1] <= t)]
        best = max((r[1] for r in earlier), default=None)
        hits = [r for r in earlier if r[1] == best] or [(None, None, None)]
        out += [(i, r[1], r[2]) for r in hits]
    return sorted(out, key=lambda x: [(v is not None, v) for v in x])


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("limit", [0, 10_000])
def test_latest_before_equals_brute_force(spark, rows, strict, limit):
    import random

    rng = random.Random(5)
    left = [(rng.choice(["a", "hot", "hot", None]), rng.randrange(200), i) for i in range(300)] + [("none", 5, 999)]
    right = [(rng.choice(["a", "hot", "hot", None]), rng.randrange(200), f"r{i}") for i in range(120)]
    got = joins.latest_before(
        spark.createDataFrame(left, "k string, t int, i int"), spark.createDataFrame(right, "k string, rt int, p string"),
        ["k"], "t", "rt", strict, one_task_rows=limit,
    )
    assert rows(got, "i", "rt", "p") == brute_asof(left, right, strict)


def test_outer_by_key_coalesces(spark, rows):
    a = spark.createDataFrame([("1", "x", 10), ("2", None, 20)], "key string, n string, a int")
    b = spark.createDataFrame([("2", "y", 5), ("3", "z", 6)], "key string, n string, b int")
    assert rows(joins.outer_by_key(a, b, "key", ["n"])) == [("1", "x", 10, None), ("2", "y", 20, 5), ("3", "z", None, 6)]


def test_group_totals_keep_null_group(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    assert rows(grouping.with_group_totals(df, ["g"], F.sum("v").alias("s")), "g", "v", "s") == [
        (None, 1, 3), (None, 2, 3), ("a", 3, 3),
    ]
    assert rows(grouping.with_group_totals(df, [], F.sum("v").alias("s")), "s") == [(6,), (6,), (6,)]


def test_standardize_constant_group(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (2, 5.0)], "g int, v double")
    got = rows(grouping.standardize(df, ["v"], ["g"]), "g", "v_scaled")
    assert got[0] == (1, pytest.approx(-0.70710678)) or got[0] == (2, None)
    assert sorted(r[0] for r in got if r[1] is None) == [2, 2]


def test_lists(spark, rows):
    df = spark.createDataFrame(
        [("g", "b", 1), ("g", "a", 3), ("g", "a", 2), ("g", None, 9), ("h", "c", 1)], "g string, i string, v int"
    )
    assert rows(grouping.top_list(df, ["g"], "i", [F.desc("v")], 2, "t")) == [("g", "a, a"), ("h", "c")]
    assert rows(grouping.distinct_list(df, ["g"], "i", "d")) == [("g", "a, b"), ("h", "c")]
    assert rows(grouping.joined_text(df.dropna(), ["g"], "v", F.col("i"), "t", "-")) == [("g", "b-a-a"), ("h", "c")]
    assert rows(grouping.top_groups(df, ["i"], F.sum("v"), "s", 2)) == [(None, 9), ("a", 5)]
    assert rows(grouping.top_groups(df, ["i"], F.sum("v"), "s", 1, drop_null_keys=True)) == [("a", 5)]


def test_profile_by_checks_column(spark):
    with pytest.raises(ValueError):
        grouping.profile_by(spark.range(1), "id; DROP", F.count("*"))


def test_densify_and_fill(spark, rows):
    df = spark.createDataFrame([(1, "a", True), (2, "b", None), (2, "b", True)], "year int, g string, h boolean")
    assert rows(reshape.densify(df, "year", "g", {"h": False}), "year", "g", "h") == [
        (1, "a", True), (1, "b", False), (2, "a", False), (2, "b", False), (2, "b", True),
    ]


def test_reshape_round_trip(spark, rows):
    df = spark.createDataFrame([(1, 2, 3.0), (2, None, 4.0)], "id int, a int, b double")
    long = reshape.to_long(df, ["id"], ["a", "b"], "n", "v")
    assert rows(long) == [(1, "a", 2.0), (1, "b", 3.0), (2, "a", None), (2, "b", 4.0)]
    assert rows(reshape.to_wide(long, ["id"], "n", F.col("v"), ["a", "b"], "x_")) == [(1, 2.0, 3.0), (2, None, 4.0)]
    assert rows(reshape.zero_where(df, ["a"], F.col("id") > 5), "a") == [(None,), (2,)]
    assert rows(reshape.zero_where(df, ["a"]), "a") == [(0,), (2,)]
    assert reshape.numeric_columns(df, ["id"]) == ["a", "b"]
    assert reshape.columns_first(df, ["b"], ["a"]).columns == ["b", "id"]
    both = reshape.union_by_name(df, reshape.literal_row(df, id=9))
    assert rows(both) == [(1, 2, 3.0), (2, None, 4.0), (9, None, None)]


def test_split_and_ordinal(spark, rows):
    df = spark.createDataFrame([(y,) for y in (1990, 1992, 2016, 2024, 2030)], "year int")
    split = reshape.split_by_range(df, "year", [("Train", 1992), ("Test", 2016), ("Prediction", 2024)], 2024)
    assert rows(split) == [(1990, None, None), (1992, "Train", 0), (2016, "Test", 1), (2024, "Prediction", 2), (2030, None, None)]
    levels = spark.createDataFrame([("b",), ("x",)], "v string").select("v", reshape.ordinal_of("v", ["a", "b"]))
    assert rows(levels) == [("b", 2), ("x", None)]


def test_corr_matrix_skips_rows_pair_by_pair(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(500, 4)) * [1, 1e3, 1e-3, 1] + [1e6, 0, 5, 0]
    data[:, 3] += data[:, 1] / 1e3
    held = rng.random((500, 4)) < 0.8
    rows = [(*[float(v) if k else None for v, k in zip(r, h, strict=True)], 0.1, None) for r, h in zip(data, held, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, same double, none double").repartition(5)
    got = {(r["column_1"], r["column_2"]): r["corr"] for r in reshape.corr_matrix(df, df.columns).collect()}
    assert len(got) == 36
    for i, x in enumerate("abcd"):
        for j, y in enumerate("abcd"):
            both = held[:, i] & held[:, j]
            assert got[x, y] == pytest.approx(np.corrcoef(data[both, i], data[both, j])[0, 1], abs=1e-9)
        assert got[x, "same"] is None and got["none", x] is None
    assert got["same", "same"] is None
    empty = reshape.corr_matrix(df.where("a > 1e9"), ["a", "b"]).collect()
    assert len(empty) == 4 and all(r["corr"] is None for r in empty)


def test_corr_matrix_is_symmetric(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, 7.0, 5.0), (4.0, None, 5.0)], "a double, b double, c double")
    cells = {(r["column_1"], r["column_2"]): r["corr"] for r in reshape.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(cells) == 9 and cells["a", "b"] == cells["b", "a"] and cells["c", "a"] is None
    assert cells["a", "a"] == pytest.approx(1.0)


def make_vectors(spark, n=300, dim=8):
    import numpy as np

    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, dim)) * 3
    data = [(i, (centres[0 if i % 3 == 0 else i % 6] + rng.normal(size=dim) * 0.3).tolist()) for i in range(n)]
    data[5] = (5, data[4][1])
    return spark.createDataFrame(data + [(900, []), (901, None), (902, [0.0] * dim)], "id long, v array<double>"), data


@pytest.mark.parametrize("block", [16, 64, 10_000])
@pytest.mark.parametrize("keep", [True, False])
def test_nearest_is_exact(spark, block, keep):
    import numpy as np

    df, data = make_vectors(spark)
    got = {}
    for r in nearest(df, df, "id", "v", 4, keep_self=keep, block_rows=block).collect():
        got.setdefault(r["query_key"], {})[r["neighbor_rk"]] = (r["distance"], r["base_key"])
    units = np.array([v for _, v in data])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    gaps = np.round(1 - units @ units.T, 9).clip(0)
    np.fill_diagonal(gaps, 0.0 if keep else np.inf)
    assert len(got) == len(data)
    for q in range(len(data)):
        wanted = sorted((gaps[q, b], b) for b in range(len(data)))[:4]
        assert [got[q][i + 1] for i in range(4)] == [(pytest.approx(d, abs=1e-9), b) for d, b in wanted]


def test_nearest_of_other_frame_and_probes(spark):
    df, _ = make_vectors(spark)
    some = df.where("id < 20")
    exact = nearest(df, some, "id", "v", 3, block_rows=32)
    assert exact.select("query_key").distinct().count() == 20 and exact.count() == 60
    probed = nearest(df, some, "id", "v", 3, block_rows=32, probes=2)
    assert probed.join(exact, ["query_key", "base_key"]).count() >= 40


def test_score_pairs_and_table(spark, rows):
    pairs = spark.createDataFrame(
        [("a", "a", 0.0), ("a", "b", 0.2), ("a", "c", 0.2), ("b", "b", 0.0), ("b", "a", None)], "query_key string, base_key string, distance double"
    )
    for limit in (0, 100):
        scored = score_pairs(pairs, "d", one_task_rows=limit)
        assert rows(scored, "query_key", "base_key", "d_ovr_rk", "d_ovr_num", "d_score", "d_query_rk") == [
            ("a", "a", 1, 4, 87.5, None), ("a", "b", 3, 4, 37.5, 1), ("a", "c", 3, 4, 37.5, 1),
            ("b", "a", None, 4, None, None), ("b", "b", 1, 4, 87.5, None),
        ]
    items = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "key string, name string")
    other = score_pairs(pairs.where("base_key = 'c'"), "e")
    table = pair_table(items, "key", [scored, other])
    assert rows(table, "key_1", "key_2", "name_1", "name_2", "same_item", "e_ovr_num")[2] == ("a", "c", "A", "C", False, 1)


def test_views_ties_share_no_first_place(spark, rows):
    hour = dt.datetime(2020, 1, 2, 12)
    hits = spark.createDataFrame(
        [(hour, "A", 3), (hour, "b", 3), (hour, "c", 1), (hour + dt.timedelta(days=1), "a", 2)], "ts timestamp_ntz, title string, n int"
    )
    daily = views.daily_views(hits, "ts", F.lower("title"), F.sum("n"), dt.date(2020, 1, 1), dt.date(2020, 1, 9))
    ranked = views.daily_ranks(daily)
    assert [r[2:] for r in rows(ranked)] == [(3, 1.5), (3, 1.5), (1, 3.0), (2, 1.0)]
    assert rows(views.days_at_top(ranked, ["page_title"])) == [("a", 1), ("b", 0), ("c", 0)]


def test_correlation_prefilter_changes_nothing(spark, rows):
    import random

    rng = random.Random(1)
    data = [
        (f"20{10 + m // 12}-{m % 12 + 1:02d}", c, f"c{c}", rng.random() * (30 if c < 4 else 0.4))
        for m in range(36) for c in range(12) if c != 2 or m > 14
    ]
    monthly = spark.createDataFrame(data, "month string, category int, category_name string, category_monthly_volume double")
    shares = sales.month_shares(monthly).cache()
    got = sales.category_correlation(shares)
    a, b = shares.alias("a"), shares.alias("b")
    plain = a.join(b, F.col("a.month") == F.col("b.month")).groupBy("a.category_name", "b.category_name").agg(
        F.count("*").alias("n"), F.avg("a.pct").alias("p"), F.avg("b.pct").alias("q")
    ).where("n >= 24 AND p >= 1 AND q >= 1")
    assert got.count() == plain.count() and 0 < got.count() < 100


def test_panel(spark):
    data = [
        (2000, "A", "A", "GA", 3, 1, 0), (2000, "A", "B", "GB", 1, 0, 0), (2004, "B", "A", "GA", 1, 0, 0),
        (2008, "A", "B", "GB", 1, 1, 0), (2008, "A", "A2", "GA", 1, 0, 1), (2012, "A", "A2", "GA", None, None, None),
        (2012, "A", "B", "GB", 2, 2, 2),
    ]
    results = spark.createDataFrame(
        data, "year int, host_country string, country string, country_group string, gold long, silver long, bronze long"
    )
    got = {(r["year"], r["country_group"]): r for r in standings.panel(results, 2012).collect()}
    missing = got[2004, "GB"]
    assert (missing["country"], missing["medals"], missing["is_host"]) == ("B", 0, False)
    assert got[2000, "GA"]["is_host"] and got[2000, "GA"]["medals_rk"] == 1
    assert (got[2008, "GA"]["medals_rk"], got[2008, "GA"]["medals_num_at_rk"]) == (1, 2)
    assert got[2012, "GB"]["yr_tot_medals"] is None and got[2012, "GB"]["medal_share"] is None
    assert got[2012, "GA"]["medals"] is None and got[2012, "GA"]["medals_rk"] is None
    assert got[2008, "GB"]["medal_share_prev"] == 0.0 and got[2008, "GB"]["medal_share_2_ago"] == pytest.approx(0.2)


def test_entrants_and_hosts(spark, rows):
    entrants = spark.createDataFrame([("A",), ("B",)], "country string")
    medals = spark.createDataFrame([("A", 1, None, 2)], "country string, gold int, silver int, bronze int")
    made = standings.entrants_as_results(entrants, medals, 2024, "A")
    assert rows(made, "year", "host_country", "country", "gold", "silver", "bronze") == [
        (2024, "A", "A", 1, 0, 2), (2024, "A", "B", 0, 0, 0),
    ]
    assert rows(standings.year_hosts(made, 2028, "C")) == [(2024, "A"), (2028, "C")]
    assert rows(standings.year_hosts(made, 2024, "A")) == [(2024, "A")]
