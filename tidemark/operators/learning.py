"""Clustering, linear and boosted-tree models on Spark ML."""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import CountVectorizer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.stats import mae, rmse, safe_ratio, squared_corr, strict_sum, weighted_mean
from tidemark.operators.grouping import distinct_list, top_list, with_group_totals
from tidemark.operators.skew import join_same
from tidemark.session import materialize, use_checkpoint_dir

# Stands for a missing predictor: below every standardised value, so a tree can split it off.
MISSING = -1e6
TRAINING_ROWS_PER_TASK = 50_000
# Different tokens of a column that k-means takes; more raise an error.
MAX_TOKENS = 1_000_000


# -- clusters ------------------------------------------------------------------


def fit_clusters(
    df: DataFrame, tokens: Sequence[str], numbers: Sequence[str], k: int = 10, seed: int = 1
) -> PipelineModel:
    """k-means on token presence and standardised numbers."""
    df = df.dropna(subset=list(numbers))
    # every token is a feature: Spark would keep the commonest 2^18 and drop others in silence
    sizes = {c: df.select(F.explode(c).alias("t")).where("t IS NOT NULL").distinct().count() for c in tokens}
    if max(sizes.values(), default=0) > MAX_TOKENS:
        raise ValueError(f"more than {MAX_TOKENS} different tokens: {sizes}")
    words = [CountVectorizer(inputCol=c, outputCol=f"_{c}", binary=True, vocabSize=max(sizes[c], 1)) for c in tokens]
    stages = [
        *words,
        VectorAssembler(inputCols=list(numbers), outputCol="_numbers", handleInvalid="error"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=[*[f"_{c}" for c in tokens], "_scaled"], outputCol="features"),
        KMeans(k=k, seed=seed, initMode="k-means||", featuresCol="features"),
    ]
    return Pipeline(stages=stages).fit(df)


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``cluster``, numbered from 1; NULL for rows with a NULL number."""
    numbers = model.stages[-4].getInputCols()
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in numbers])
    out = model.transform(df.where(whole)).withColumn("cluster", F.col("prediction") + 1).select(*df.columns, "cluster")
    return out.unionByName(df.where(~whole).withColumn("cluster", F.lit(None).cast("int")))


def centroids(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Cluster centres, one row per feature; numbers in their own units."""
    centres = model.stages[-1].clusterCenters()
    names, undo = [], []
    for stage in model.stages:
        if hasattr(stage, "vocabulary"):
            names += [(stage.getInputCol(), w) for w in stage.vocabulary]
            undo += [(0.0, 1.0)] * len(stage.vocabulary)
    scaler = model.stages[-3]
    names += [(c, None) for c in model.stages[-4].getInputCols()]
    undo += list(zip(scaler.mean.toArray().tolist(), scaler.std.toArray().tolist()))
    rows = [
        (i + 1, feature, token, float(centre[j]) * undo[j][1] + undo[j][0])
        for i, centre in enumerate(centres)
        for j, (feature, token) in enumerate(names)
    ]
    return spark.createDataFrame(rows, "cluster int, feature string, token string, value double")


def centre_distances(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(row, cluster, own, squared): the squared distance of every row with whole numbers to every centre; own marks its cluster.

    A row is its different tokens and its scaled numbers, so the distance is |x|² - 2 x·c + |c|² with sums over the tokens it has: tokens are
    joined to the centres' values that are not 0, and no row becomes a vector of all tokens.
    """
    spark, words = df.sparkSession, [s for s in model.stages if hasattr(s, "vocabulary")]
    numbers, scaler = model.stages[-4].getInputCols(), model.stages[-3]
    centres = np.array(model.stages[-1].clusterCenters())
    rows = materialize(assign_clusters(model, df.dropna(subset=list(numbers))).withColumn("row", F.monotonically_increasing_id()), "assigned")
    first, parts, counts = 0, [], F.lit(0)
    for stage in words:
        known = np.array(stage.vocabulary, dtype=object)
        at, token = np.nonzero(centres[:, first : first + len(known)])
        values = centres[at, first + token]
        parts.append(pd.DataFrame({"feature": stage.getInputCol(), "token": known[token], "cluster": (at + 1).astype("int32"), "value": values}))
        counts = counts + F.size(F.array_distinct(F.array_compact(F.coalesce(stage.getInputCol(), F.array()))))
        first += len(known)
    squares = (centres[:, :first] ** 2).sum(axis=1)
    places = [(i + 1, float(squares[i]), [float(x) for x in centres[i, first:]]) for i in range(len(centres))]
    grid = F.broadcast(spark.createDataFrame(places, "cluster int, square double, place array<double>"))
    table = spark.createDataFrame(pd.concat(parts), "feature string, token string, cluster int, value double")
    held = [
        rows.select("row", F.lit(s.getInputCol()).alias("feature"), F.explode(F.array_distinct(s.getInputCol())).alias("token")) for s in words
    ]
    products = reduce(DataFrame.union, held).join(table, ["feature", "token"]).groupBy("row", "cluster").agg(F.sum("value").alias("product"))
    scaled = [(F.col(c).cast("double") - float(m)) / float(d) if d else F.lit(0.0) for c, m, d in zip(numbers, scaler.mean, scaler.std)]
    z = rows.select("row", F.col("cluster").alias("mine"), counts.alias("n"), F.array(*scaled).alias("z"))
    gap = F.aggregate(F.zip_with("z", "place", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)
    every = z.crossJoin(grid).join(products, ["row", "cluster"], "left")  # a row for each of the few clusters
    squared = F.col("n") - 2 * F.coalesce("product", F.lit(0.0)) + F.col("square") + gap
    return every.select("row", "cluster", (F.col("cluster") == F.col("mine")).alias("own"), F.greatest(squared, F.lit(0.0)).alias("squared"))


def evaluate_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Mean squared distance, Davies-Bouldin index (1979) and silhouette."""
    centres = np.array(model.stages[-1].clusterCenters())
    df = df.dropna(subset=list(model.stages[-4].getInputCols()))
    own = materialize(centre_distances(model, df).where("own"), "own-distances")
    per_cluster = own.groupBy((F.col("cluster") - 1).alias("prediction")).agg(
        F.avg(F.sqrt("squared")).alias("spread"), F.sum("squared").alias("squares"), F.count(F.lit(1)).alias("n")
    )
    apart = np.sqrt(((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
    links = [(i, j, float(apart[i, j])) for i in range(len(centres)) for j in range(len(centres)) if i != j]
    pairs = df.sparkSession.createDataFrame(links, "i int, j int, apart double")
    a = per_cluster.select(F.col("prediction").alias("i"), F.col("spread").alias("si"))
    b = per_cluster.select(F.col("prediction").alias("j"), F.col("spread").alias("sj"))
    worst = pairs.join(a, "i").join(b, "j").groupBy("i").agg(
        F.max(F.try_divide(F.col("si") + F.col("sj"), F.col("apart"))).alias("ratio")
    )
    scored = materialize(model.transform(df).select("features", "prediction"), "clustered")
    silhouette = ClusteringEvaluator(featuresCol="features").evaluate(scored)
    return per_cluster.agg(
        (F.sum("squares") / F.sum("n")).alias("mean_squared_distance"), F.sum("n").alias("num_rows")
    ).select(
        worst.agg(F.avg("ratio")).scalar().alias("davies_bouldin_index"),
        "mean_squared_distance",
        F.lit(silhouette).alias("silhouette"),
        "num_rows",
    )


def cluster_profile(
    df: DataFrame, cluster: str, weight: str, means: Sequence[str], item: str, category: str, top: int = 10
) -> DataFrame:
    """Volume, weighted means, the items with most volume and the categories of each cluster."""
    sums = df.groupBy(cluster).agg(
        F.sum(weight).alias("total_volume"), *[weighted_mean(c, weight).alias(c) for c in means]
    )
    tops = top_list(df, [cluster], item, [F.desc(weight), F.asc(item), F.asc(category)], top, "top_items")
    kinds = distinct_list(df, [cluster], category, "categories")
    for part in (tops, kinds):
        sums = join_same(sums, part, [cluster])
    return sums


# -- linear model --------------------------------------------------------------


def fit_gaussian(df: DataFrame, label: str, predictors: Sequence[str]):
    """Least-squares linear model; rows with a missing value are left out."""
    columns = [F.col(c).cast("double").alias(c) for c in (label, *predictors)]
    rows = materialize(df.select(*columns).dropna(), "linear-rows")
    assembled = VectorAssembler(inputCols=list(predictors), outputCol="features").transform(rows)
    return GeneralizedLinearRegression(family="gaussian", labelCol=label).fit(assembled)


def gaussian_coefficients(spark: SparkSession, model, predictors: Sequence[str]) -> DataFrame:
    """One row per term: estimate, standard error, t and p value, with fit figures of the model."""
    s = model.summary
    terms = [*predictors, "(Intercept)"]
    estimates = [*model.coefficients.toArray().tolist(), model.intercept]
    parts = zip(terms, estimates, s.coefficientStandardErrors, s.tValues, s.pValues)
    rows = [(t, float(e), float(se), float(tv), float(p), float(s.aic), float(s.deviance)) for t, e, se, tv, p in parts]
    return spark.createDataFrame(
        rows,
        "term string, estimate double, std_error double, t_value double, p_value double, aic double, deviance double",
    )


# -- boosted trees -------------------------------------------------------------


def predictor(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(MISSING))


def fit_boosted_trees(
    df: DataFrame,
    label: str,
    predictors: Sequence[str],
    trees: int = 200,
    depth: int = 5,
    rate: float = 0.05,
    seed: int = 1,
):
    """Boosted regression trees; booleans count as 0/1 and missing predictors are kept as such."""
    use_checkpoint_dir(df.sparkSession)
    known = df.where(F.col(label).isNotNull())
    rows = known.select(F.col(label).cast("double").alias(label), *[predictor(c).alias(c) for c in predictors])
    assembled = VectorAssembler(inputCols=list(predictors), outputCol="features").transform(rows)
    learner = GBTRegressor(
        labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed, checkpointInterval=20
    )
    training = materialize(assembled.select(label, "features"), "training")
    # Each tree level is a job over all partitions, so small training sets use few of them.
    return learner.fit(training.coalesce(max(1, training.count() // TRAINING_ROWS_PER_TASK)))


def predict(model, df: DataFrame, predictors: Sequence[str], name: str) -> DataFrame:
    """``df`` with the model's prediction appended."""
    held = df.withColumns({f"_p_{c}": predictor(c) for c in predictors})
    ready = VectorAssembler(inputCols=[f"_p_{c}" for c in predictors], outputCol="features").transform(held)
    return model.transform(ready).select(*df.columns, F.col("prediction").alias(name))


def importance(spark: SparkSession, model, predictors: Sequence[str]) -> DataFrame:
    weights = model.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(predictors, weights)), "variable string, importance double")


def regression_metrics(df: DataFrame, truth: str, estimate: str) -> DataFrame:
    both = df.where(F.col(truth).isNotNull() & F.col(estimate).isNotNull())
    return both.agg(
        rmse(truth, estimate).alias("rmse"),
        mae(truth, estimate).alias("mae"),
        squared_corr(truth, estimate).alias("rsq"),
        F.count(F.lit(1)).alias("num_rows"),
    )


def scale_to_total(df: DataFrame, share: str, total: str, within: Sequence[str], norm: str, scaled: str) -> DataFrame:
    """Predicted shares made to add up to one per group, and the amounts they stand for."""
    sums = with_group_totals(df, within, strict_sum(share).alias("_sum"))
    normed = sums.withColumn(norm, safe_ratio(share, "_sum"))
    return normed.withColumn(scaled, F.col(norm) * F.col(total)).drop("_sum")
