import math
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.prompts import NO_DESCRIPTION
from tidemark.operators import attribution, enrich, learning
from tidemark.operators.attribution import attribute, attribution_text, attribution_wide
from tidemark.plans import catalog, standings


@pytest.fixture(scope="module")
def boosted(spark):
    df = spark.range(80).select(
        "id",
        ((F.col("id") * 37 % 80) / 10).alias("a"),
        (F.col("id") % 2 == 0).alias("b"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * 11 % 13).cast("double")).alias("c"),
    ).withColumn("y", F.col("a") * 2 + F.when(F.col("b"), F.coalesce("c", F.lit(3.0))).otherwise(0.0)).cache()
    model = learning.fit_boosted_trees(df, "y", ["a", "b", "c"], trees=8, depth=3, rate=0.3)
    return df, model


def test_attribution_adds_up_to_prediction(boosted):
    df, model = boosted
    names = ["a", "b", "c"]
    long = attribute(df, model, names, ["id"]).cache()
    pred = learning.predict(model, df, names, "pred")
    sums = long.groupBy("id").agg((F.sum("value") + F.first("base_value")).alias("s")).join(pred, "id")
    worst = sums.agg(F.max(F.abs(F.col("s") - F.col("pred")))).first()[0]
    assert worst < 1e-9 and long.count() == 240
    wide = attribution_wide(long, ["id"], names)
    assert wide.columns == ["id", "shap_value_a", "shap_value_b", "shap_value_c"] and wide.count() == 80
    text = attribution_text(long, ["id"]).first()["shap_values_text"].split("\n")
    assert [t.split(" ")[0] for t in text] == names


def test_model_learns_and_reports(spark, boosted):
    df, model = boosted
    scored = learning.predict(model, df, ["a", "b", "c"], "pred")
    assert learning.regression_metrics(scored, "y", "pred").first()["rsq"] > 0.8
    weights = {r["variable"]: r["importance"] for r in learning.importance(spark, model, ["a", "b", "c"]).collect()}
    assert sum(weights.values()) == pytest.approx(1.0) and weights["a"] == max(weights.values())


def test_scale_to_total(spark, rows):
    df = spark.createDataFrame([(1, 0.3, 10.0), (1, 0.1, 10.0), (2, 0.5, None)], "y int, p double, t double")
    got = learning.scale_to_total(df, "p", "t", ["y"], "n", "m")
    assert rows(got, "y", "n", "m") == [(1, pytest.approx(0.25), pytest.approx(2.5)), (1, pytest.approx(0.75), pytest.approx(7.5)), (2, 1.0, None)]


def test_gaussian_drops_incomplete_rows(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i + 1 + (i % 2) * 0.1) for i in range(20)] + [(None, 5.0), (4.0, None)], "x double, y double")
    terms = learning.gaussian_coefficients(spark, learning.fit_gaussian(df, "y", ["x"]), ["x"])
    got = {r["term"]: r for r in terms.collect()}
    assert got["x"]["estimate"] == pytest.approx(3.0, abs=0.01) and got["x"]["p_value"] < 1e-6
    assert set(got) == {"x", "(Intercept)"}


def test_clusters(spark):
    data = [("red wine", "cat a", float(i % 3), 10.0) for i in range(15)] + [("dry gin", "cat b", 50.0 + i % 3, 90.0) for i in range(15)]
    df = spark.createDataFrame(data, "i string, c string, p double, q double").withColumns(
        {"ct": F.split("c", " "), "it": F.split("i", " "), "w": F.col("p") + 1}
    )
    model = learning.fit_clusters(df, ["ct", "it"], ["p", "q"], k=2)
    scored = learning.assign_clusters(model, df)
    assert scored.columns == [*df.columns, "cluster"]
    assert scored.groupBy("c").agg(F.count_distinct("cluster").alias("n")).agg(F.max("n")).first()[0] == 1
    found = {(r["row"], r["cluster"]): r["squared"] for r in learning.centre_distances(model, df).collect()}
    points = [r["features"].toArray() for r in model.transform(df).collect()]
    wanted = sorted(float(((p - c) ** 2).sum()) for p in points for c in model.stages[-1].clusterCenters())
    assert sorted(found.values()) == pytest.approx(wanted, abs=1e-9)
    figures = learning.evaluate_clusters(model, df).first()
    assert figures["silhouette"] > 0.9 and 0 < figures["davies_bouldin_index"] < 0.2 and figures["num_rows"] == 30
    centres = learning.centroids(spark, model).where("feature = 'q'").collect()
    assert sorted(round(r["value"], 6) for r in centres) == [10.0, 90.0]
    profile = learning.cluster_profile(scored, "cluster", "w", ["p"], "i", "c", top=2).collect()
    assert sorted(r["categories"] for r in profile) == ["cat a", "cat b"]
    assert sorted(r["top_items"] for r in profile) == ["dry gin, dry gin", "red wine, red wine"]


@pytest.fixture
def failing():
    class Failing:
        def generate(self, prompts, files, options):
            raise RuntimeError("down")

        def embed(self, texts, task):
            raise RuntimeError("down")

    return Failing


def test_generation_status_per_row(spark, rows, failing):
    df = spark.createDataFrame([(1, "ab\ncd"), (2, None)], "id int, p string")
    good = enrich.generate(df, F.col("p"), enrich.OfflineText, "x")
    assert rows(good, "id", "x_status", "x_result") == [(1, "", "5 characters in 2 lines"), (2, "no prompt", None)]
    bad = enrich.generate(df, F.col("p"), failing, "x")
    assert rows(bad, "id", "x_status", "x_result") == [(1, "error: down", None), (2, "no prompt", None)]


def test_embedding_of_missing_text_is_empty(spark, rows, failing):
    df = spark.createDataFrame([(1, "Abba"), (2, None), (3, "123")], "id int, t string")
    got = enrich.embed(df, F.col("t"), enrich.OfflineEmbedding, "e")
    assert rows(got, "id", "e_embedding_length", "e_embedding_token_count") == [(1, 26, 1), (2, 0, None), (3, 0, 1)]
    assert got.where("id = 1").first()["e_embedding"][0] == pytest.approx(1 / math.sqrt(2))
    assert rows(enrich.embed(df, F.col("t"), failing, "e"), "e_embedding_length") == [(0,), (0,), (0,)]


def test_catalog_end_to_end(spark):
    products = spark.createDataFrame(
        [("p1", "bj", "Mint", None, "Cool", "milk"), ("p2", "hd", "Rum", "Sub", None, None)],
        "key string, brand string, name string, subhead string, description string, ingredients string",
    )
    reviews = spark.createDataFrame(
        [("p1", "ann", "2020-01-01", 5, "Good", 3, 0, "Yes"), ("p1", "bob", "2020-02-01", 1, None, 9, 0, "No"), ("p1", "cy", "2020-03-01", 3, "Ok", 3, 0, "Hm")],
        "key string, author string, date string, stars int, title string, helpful_yes long, helpful_no long, text string",
    ).withColumn("date", F.to_date("date"))
    linked = catalog.with_links(products, "https://x", "s://x", "img", {"bj": "B&J"})
    images = linked.where("key = 'p1'").select(F.col("image_uri").alias("uri"))
    summaries = catalog.with_review_summaries(catalog.review_digests(reviews), enrich.OfflineText)
    made = catalog.assemble(
        catalog.with_short_descriptions(linked, enrich.OfflineText), catalog.image_alt_texts(images, enrich.OfflineText),
        catalog.review_stats(reviews), summaries,
    )
    got = {r["key"]: r for r in made.collect()}
    one = got["p1"]
    assert one["avg_rating"] == 3.0 and one["num_ratings"] == 3
    assert one["all_reviews_concat"].startswith('"Ok"\nStars: 3\nAuthor: cy\nDate: Mar 01, 2020\n\nHm\n\n\n"Good"') and "bob" not in one["all_reviews_concat"]
    assert one["product_all_provided_info"].startswith("B&J Mint\n\nCool\n\nIngredients: milk\n\nAll 3 Reviews:\n\n")
    assert got["p2"]["brand_and_product_name"] is None and got["p2"]["product_all_provided_info"] is None
    assert one["alt_text_result"].endswith("1 files") and got["p2"]["alt_text_result"] is None
    left = made.select("key", "brand_and_product_name", F.when(F.col("key") == "p2", NO_DESCRIPTION).otherwise("abc").alias("short_description_result"))
    right = spark.createDataFrame([("p1", None, "zz"), ("p9", "X", "zz")], "key string, brand_and_product_name string, review_summary_result string")
    both = {r["key"]: r for r in catalog.product_embeddings(left, right, enrich.OfflineEmbedding).collect()}
    assert both["p2"]["short_description"] is None and both["p2"]["short_description_embedding_length"] == 0
    assert both["p9"]["brand_and_product_name"] == "X" and both["p9"]["short_description_embedding_length"] is None


def test_group_request_takes_all_files(spark):
    df = spark.range(25).select(F.lit("g").alias("g"), "id", F.concat(F.lit("u"), "id").alias("uri"))
    asked = enrich.generate_per_group(df, ["g"], "uri", "id", F.lit("look"), enrich.OfflineText, "r", files_per_request=10)
    (row,) = asked.collect()
    parts = ["4 characters in 1 lines, 10 files"] * 2 + ["4 characters in 1 lines, 5 files"]
    text = "look\n\n" + "\n\n".join(parts)
    assert row["r_result"] == f"{len(text)} characters in 7 lines"


def test_long_digests_give_one_summary(spark):
    reviews = spark.range(50).select(
        F.concat(F.lit("p"), (F.col("id") % 7 == 0).cast("int")).alias("key"), F.lit("a").alias("author"), F.lit("2020-01-01").cast("date").alias("date"),
        F.lit(5).alias("stars"), F.lit("T").alias("title"), F.lit(1).cast("long").alias("helpful_yes"), F.lit(0).cast("long").alias("helpful_no"), F.lit("x").alias("text"),
    )
    digests = catalog.review_digests(reviews, per_part=3)
    assert digests.groupBy("key").count().where("count > 2").count() == 2
    got = {r["key"]: r for r in catalog.with_review_summaries(digests, enrich.OfflineText).collect()}
    assert len(got) == 2 and got["p1"]["num_texts"] == 8 and got["p0"]["num_texts"] == 42


def test_one_bad_prompt_fails_alone(spark):
    class Picky(enrich.OfflineText):
        def generate(self, prompts, files, options):
            if "bad" in prompts:
                raise ValueError("no")
            return super().generate(prompts, files, options)

    df = spark.createDataFrame([(i, "bad" if i == 3 else "good") for i in range(10)], "id int, p string").coalesce(1)
    got = {r["id"]: r for r in enrich.generate(df, F.col("p"), Picky, "r").collect()}
    assert [i for i, r in got.items() if r["r_status"]] == [3] and got[4]["r_result"]


def test_forecast_text_and_long(spark):
    rows_in = spark.createDataFrame(
        [(2024, "A", 1, 0, 0, 1, 0.25, 2.0), (2024, "B", 1, 0, 0, 1, 0.75, 2.0), (2024, "C", 0, 0, 0, None, 0.1, None)],
        "year int, country string, gold long, silver long, bronze long, medals long, pred_medal_share double, pred_medals double",
    ).withColumns(standings.tie_ranks("pred_medals", ["year"], "pred_medals"))
    texts = {r["country"]: r["t"] for r in rows_in.select("country", standings.forecast_text().alias("t")).collect()}
    assert texts["A"] == "2024 A\nPredicted Medal Share: 25.00%\nPredicted Medals: 2.0\nPredicted Medals Rank: 1 (2 tied)"
    assert texts["C"].endswith("Predicted Medals: NA\nPredicted Medals Rank: NA")
    long = {(r["country"], r["medals_field"]): r for r in standings.long_standings(rows_in).collect()}
    assert long["A", "total_vs_predicted"]["medals_value_rk_text"] == "-1.0\n1st (tied)"
    assert long["B", "gold"]["medals_value_rk_text"] == "1\n1st (tied)" and long["B", "gold"]["medals_value_unique_rk"] == 2
    assert long["C", "total"]["medals_value_rk_text"] is None


def _random_leaves(rng, predictors, depth, trees):
    """Leaves of random trees as (value, predictor -> (low, high, share))."""
    leaves = []

    def grow(held, left):
        if not left or rng.random() < 0.15:
            leaves.append((float(rng.normal()), held))
            return
        j, cut, part = int(rng.integers(predictors)), float(rng.normal()), float(rng.uniform(0.1, 0.9))
        low, high, share = held.get(j, (-np.inf, np.inf, 1.0))
        grow(held | {j: (low, min(high, cut), share * part)}, left - 1)
        grow(held | {j: (max(low, cut), high, share * (1 - part))}, left - 1)

    for _ in range(trees):
        grow({}, depth)
    return leaves


def _by_subsets(row, leaves, width):
    def expected(known):
        return sum(
            v * np.prod([(float(lo < row[j] <= hi) if j in known else share) for j, (lo, hi, share) in held.items()]) for v, held in leaves
        )

    out = [0.0] * width
    for j in range(width):
        rest = [i for i in range(width) if i != j]
        for size in range(width):
            weight = factorial(size) * factorial(width - size - 1) / factorial(width)
            out[j] += sum(weight * (expected({*s, j}) - expected(set(s))) for s in combinations(rest, size))
    return [*out, expected(set())]


@pytest.mark.parametrize("predictors,depth", [(5, 4), (2, 2), (7, 3)])
def test_shapley_values_equal_subset_enumeration(predictors, depth, monkeypatch):
    rng = np.random.default_rng(predictors)
    leaves = _random_leaves(rng, predictors, depth, 3)
    x = rng.normal(size=(12, predictors))
    monkeypatch.setattr(attribution, "CELLS_AT_ONCE", 60)
    got = attribution.shapley_of(x, attribution.slotted(leaves))
    assert got == pytest.approx(np.array([_by_subsets(r, leaves, predictors) for r in x]), abs=1e-12)


def test_shapley_values_of_many_predictors():
    rng = np.random.default_rng(9)
    leaves = _random_leaves(rng, 60, 6, 20)
    x = rng.normal(size=(5, 60))
    got = attribution.shapley_of(x, attribution.slotted(leaves))
    predicted = [sum(v for v, held in leaves if all(lo < r[j] <= hi for j, (lo, hi, _) in held.items())) for r in x]
    assert got.sum(axis=1) == pytest.approx(predicted)
    assert attribution.shapley_of(x, attribution.slotted([(2.0, {})])).tolist() == [[0.0] * 60 + [2.0]] * 5
