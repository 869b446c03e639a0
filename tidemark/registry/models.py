"""Models on the item features and on the standings panel. A model is fitted once per session and data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.prompts import forecast_prompt
from tidemark.functions.scalars import file_name
from tidemark.operators import learning
from tidemark.operators.attribution import attribute, attribution_text, attribution_wide
from tidemark.operators.enrich import GenerateOptions, OfflineText, generate
from tidemark.operators.joins import left_lookup
from tidemark.operators.reshape import to_long
from tidemark.plans import sales as sales_plan
from tidemark.plans import standings as plan
from tidemark.registry import sales, standings
from tidemark.registry.common import rounded
from tidemark.session import materialize

TRAIN, TEST = 1996, 1999
TOKENS = ["cat_tokens", "item_tokens"]
NUMBERS = ["avg_dollars_per_unit", "pct_item_volume_q4"]
_kept: dict = {}


def _once(name, spark, sf, make):
    """A fitted model is shared by the queries over the same files: their newest time and size are part of the key."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf}/*.parquet")
    state = tuple(files.agg(F.max("modificationTime").cast("string"), F.sum("length"), F.count(F.lit(1))).first())
    key = (name, spark.sparkContext.applicationId, sf, state)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def _clustered(spark, sf):
    def make():
        items = materialize(sales_plan.item_features(sales._facts(spark, sf, by="p_type")), "items")
        return items, learning.fit_clusters(items, TOKENS, NUMBERS)

    return _once("clusters", spark, sf, make)


def cluster_profile(spark, sf):
    items, model = _clustered(spark, sf)
    scored = learning.assign_clusters(model, items)
    return learning.cluster_profile(
        scored, "cluster", "total_item_volume", NUMBERS, "item_description", "category_name"
    ).orderBy(F.desc("total_volume"))


def cluster_eval(spark, sf):
    items, model = _clustered(spark, sf)
    return learning.evaluate_clusters(model, items)


def cluster_nearest_centre(spark, sf):
    """Items, and how many of them lie nearer to another centre than to their own: none."""
    items, model = _clustered(spark, sf)
    each = learning.centre_distances(model, items).groupBy("row").agg(F.min("squared").alias("least"), F.max(F.when(F.col("own"), F.col("squared"))).alias("mine"))
    return each.agg(F.count(F.lit(1)).alias("num_rows"), F.count_if(F.col("mine") > F.col("least") + 1e-6).alias("misplaced"))


def cluster_centroids(spark, sf):
    return learning.centroids(spark, _clustered(spark, sf)[1])


def brand_profile(spark, sf):
    """The cluster report for given groups: brands by the first digit of their number."""
    items = sales_plan.item_features(sales._facts(spark, sf))
    grouped = materialize(items.withColumn("cluster", F.regexp_extract("category_name", "([0-9])", 1)), "items")
    report = learning.cluster_profile(
        grouped, "cluster", "total_item_volume", NUMBERS, "item_description", "category_name"
    )
    return rounded(report, {"total_volume": 2, "avg_dollars_per_unit": 6, "pct_item_volume_q4": 6})


def _rows(spark, sf) -> DataFrame:
    def make():
        rows = standings.panel_with_indicators(spark, sf)
        return materialize(plan.model_rows(rows, TRAIN, TEST, standings.OPEN_YEAR, standings.TOTAL), "model-rows")

    return _once("rows", spark, sf, make)


def glm_coefficients(spark, sf):
    rows = standings._analysed(spark, sf)
    model = learning.fit_gaussian(rows, "medal_share", plan.PREDICTORS)
    return learning.gaussian_coefficients(spark, model, plan.PREDICTORS)


def glm_normal_equations(spark, sf):
    """At the least-squares solution the residuals have no part along any predictor."""
    rows = standings._analysed(spark, sf).select(
        F.col("medal_share").cast("double"), *[F.col(c).cast("double").alias(c) for c in plan.PREDICTORS]
    ).dropna()
    rows = materialize(rows, "complete-rows")
    model = learning.fit_gaussian(rows, "medal_share", plan.PREDICTORS)
    fitted = F.lit(float(model.intercept))
    for name, weight in zip(plan.PREDICTORS, model.coefficients):
        fitted = fitted + F.col(name) * float(weight)
    rest = rows.withColumns({"rest": F.col("medal_share") - fitted, "one": F.lit(1.0)})
    moments = rest.agg(*[F.sum(F.col("rest") * F.col(c)).alias(c) for c in [*plan.PREDICTORS, "one"]])
    return rounded(to_long(moments, [], [*plan.PREDICTORS, "one"], "term", "moment"), {"moment": 7})


def glm_single_predictor(spark, sf):
    """With one predictor the table is that of the least-squares line, errors and fit figures included."""
    rows = standings._analysed(spark, sf)
    model = learning.fit_gaussian(rows, "medal_share", ["population_scaled"])
    terms = learning.gaussian_coefficients(spark, model, ["population_scaled"])
    terms = terms.select("term", "estimate", "std_error", "t_value", "aic", "deviance")
    return rounded(terms, {"estimate": 8, "std_error": 8, "t_value": 6, "aic": 6, "deviance": 8})


def _boosted(spark, sf):
    def make():
        train = _rows(spark, sf).where(F.col("split") == "Train")
        return learning.fit_boosted_trees(train, "medal_share", plan.PREDICTORS)

    return _once("trees", spark, sf, make)


def _stump(spark, sf):
    """One tree of one split on whether the country is host, and its training rows."""
    train = _rows(spark, sf).where(F.col("split") == "Train")
    return train, learning.fit_boosted_trees(train, "medal_share", ["is_host"], trees=1, depth=1, rate=1.0)


def gbt_single_split(spark, sf):
    """A tree with one split on a flag predicts the mean of each side."""
    train, model = _stump(spark, sf)
    scored = learning.predict(model, train, ["is_host"], "pred_medal_share")
    return rounded(scored.select("year", "country", "pred_medal_share"), {"pred_medal_share": 9})


def gbt_single_split_attribution(spark, sf):
    """With one predictor its value is the prediction less the mean of all training rows."""
    train, model = _stump(spark, sf)
    long = attribute(train, model, ["is_host"], ["year", "country"])
    return rounded(long.select("year", "country", "value", "base_value"), {"value": 9, "base_value": 9})


def _forecast(spark, sf) -> DataFrame:
    return plan.forecast(_rows(spark, sf), _boosted(spark, sf))


def gbt_predictions(spark, sf):
    return _forecast(spark, sf).select(
        "year", "country", "split", "medals", "pred_medal_share", "norm_pred_medal_share", "pred_medals",
        "pred_medals_rk", "pred_medals_num_at_rk", "pred_medals_text",
    )


def gbt_metrics(spark, sf):
    test = _forecast(spark, sf).where(F.col("split") == "Test")
    shares = learning.regression_metrics(test, "medal_share", "pred_medal_share").withColumn("target", F.lit("share"))
    return shares.unionByName(
        learning.regression_metrics(test, "medals", "pred_medals").withColumn("target", F.lit("medals"))
    )


def gbt_importance(spark, sf):
    return learning.importance(spark, _boosted(spark, sf), plan.PREDICTORS).orderBy(F.desc("importance"))


def _attribution(spark, sf) -> DataFrame:
    def make():
        long = attribute(_rows(spark, sf), _boosted(spark, sf), plan.PREDICTORS, ["year", "country"])
        return materialize(long, "attribution")

    return _once("attribution", spark, sf, make)


def gbt_attribution(spark, sf):
    return _attribution(spark, sf).drop("_order")


def gbt_attribution_adds_up(spark, sf):
    """Base value and attributions of a row add up to its prediction."""
    parts = _attribution(spark, sf).groupBy("year", "country").agg(
        (F.sum("value") + F.first("base_value")).alias("total"), F.count(F.lit(1)).alias("num_predictors")
    )
    both = _forecast(spark, sf).select("year", "country", "pred_medal_share").join(parts, ["year", "country"])
    gap = (F.col("total") - F.col("pred_medal_share")).alias("gap")
    return rounded(both.select("year", "country", "num_predictors", gap), {"gap": 9})


def gbt_attribution_wide(spark, sf):
    long = _attribution(spark, sf)
    ids = ["year", "country"]
    both = attribution_wide(long, ids, plan.PREDICTORS).join(attribution_text(long, ids), ids)
    return left_lookup(_forecast(spark, sf), both, ids).drop("pred_medals_text")


def forecast_explanations(spark, sf):
    """One request per country of the forecast year with its texts and the file of its plot."""
    ids = ["year", "country"]
    texts = attribution_text(_attribution(spark, sf), ids)
    rows = _forecast(spark, sf).where(F.col("split") == "Prediction").join(texts, ids)
    plot = F.concat(F.lit("store://plots/"), file_name("year", "country", F.lit("shap"), extension="png"))
    prompt = forecast_prompt(
        F.col("year"), F.col("country"), F.col("is_host"), F.col("pred_medals_text"), F.col("shap_values_text"),
        F.when(F.col("is_host"), "French"),
    )
    asked = generate(rows, prompt, OfflineText, "explanation", GenerateOptions(max_output_tokens=500), F.array(plot))
    return asked.select("year", "country", plot.alias("plot_uri"), "explanation_status", "explanation_result")


def forecast_standings_long(spark, sf):
    return plan.long_standings(_forecast(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        cluster_profile, brand_profile, cluster_eval, cluster_nearest_centre, cluster_centroids, glm_coefficients, glm_single_predictor, glm_normal_equations, gbt_single_split, gbt_single_split_attribution, gbt_predictions,
        gbt_metrics, gbt_importance, gbt_attribution, gbt_attribution_adds_up, gbt_attribution_wide, forecast_explanations, forecast_standings_long,
    )
}

_FEATURES = f"""{sales._FACTS},
items AS (
  SELECT p_brand AS category_name, p_name AS item_description, sum(volume) AS w,
         sum(dollars) / nullif(sum(volume), 0) AS price,
         sum(CASE WHEN month(l_shipdate) IN (10, 11, 12) THEN volume ELSE 0 END) / nullif(sum(volume), 0) * 100 AS q4,
         regexp_extract(p_brand, '([0-9])', 1) AS cluster
  FROM facts WHERE p_brand IS NOT NULL AND p_name IS NOT NULL GROUP BY p_brand, p_name HAVING sum(volume) > 0
),
top AS (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY w DESC, item_description, category_name) AS n FROM items
)"""

SQL = {
    "brand_profile": f"""WITH {_FEATURES}
SELECT cluster, round(sum(w), 2) AS total_volume, round(sum(w * price) / nullif(sum(w), 0), 6) AS avg_dollars_per_unit,
       round(sum(w * q4) / nullif(sum(w), 0), 6) AS pct_item_volume_q4,
       string_agg(item_description, ', ' ORDER BY n) FILTER (n <= 10) AS top_items,
       string_agg(DISTINCT category_name, ', ' ORDER BY category_name) AS categories
FROM top GROUP BY cluster""",
    "cluster_nearest_centre": f"""WITH {sales._FACTS}
SELECT count(*) AS num_rows, 0::BIGINT AS misplaced FROM (
  SELECT p_type, p_name FROM facts WHERE p_type IS NOT NULL AND p_name IS NOT NULL GROUP BY ALL HAVING sum(volume) > 0
)""",
    "glm_normal_equations": "SELECT unnest(["
    + ", ".join(f"'{c}'" for c in [*plan.PREDICTORS, "one"])
    + "]) AS term, CAST(0 AS DOUBLE) AS moment",
    "gbt_single_split": f"""WITH {standings._ASOF}
SELECT year, country, round(avg(medal_share) OVER (PARTITION BY is_host), 9) + 0.0 AS pred_medal_share
FROM joined WHERE year BETWEEN 1996 AND 1998""",
    "gbt_single_split_attribution": f"""WITH {standings._ASOF}
SELECT year, country, round(avg(medal_share) OVER (PARTITION BY is_host) - avg(medal_share) OVER (), 9) + 0.0 AS value,
       round(avg(medal_share) OVER (), 9) + 0.0 AS base_value FROM joined WHERE year BETWEEN 1996 AND 1998""",
    "gbt_attribution_adds_up": f"""WITH {standings._ASOF}
SELECT year, country, CAST(5 AS BIGINT) AS num_predictors, CAST(0 AS DOUBLE) AS gap FROM joined WHERE year BETWEEN 1996 AND 2001""",
    "glm_single_predictor": f"""WITH {standings._ASOF},
line AS (
  SELECT regr_slope(medal_share, population_scaled) AS slope, regr_intercept(medal_share, population_scaled) AS start,
         regr_count(medal_share, population_scaled) AS n, regr_avgx(medal_share, population_scaled) AS mean,
         regr_sxx(medal_share, population_scaled) AS sxx, regr_syy(medal_share, population_scaled) AS syy FROM analysed
),
fit AS (SELECT *, syy - slope * slope * sxx AS rest FROM line),
terms AS (
  SELECT 'population_scaled' AS term, slope AS e, sqrt(rest / (n - 2) / sxx) AS se, n, rest FROM fit
  UNION ALL SELECT '(Intercept)', start, sqrt(rest / (n - 2) * (1 / n + mean * mean / sxx)), n, rest FROM fit
)
SELECT term, round(e, 8) + 0.0 AS estimate, round(se, 8) + 0.0 AS std_error, round(e / se, 6) + 0.0 AS t_value,
       round(n * (ln(2 * pi() * rest / n) + 1) + 2 + 2 * 2, 6) + 0.0 AS aic, round(rest, 8) + 0.0 AS deviance FROM terms""",
}
