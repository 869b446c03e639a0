"""Per-row Shapley values of a boosted-tree model."""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import text_or_na
from tidemark.operators.grouping import joined_text
from tidemark.operators.learning import predictor
from tidemark.operators.reshape import to_wide
from tidemark.session import scratch_path

#: Rows x leaves that are worked on at a time.
CELLS_AT_ONCE = 1 << 19


def leaf_paths(spark: SparkSession, model) -> dict[str, np.ndarray]:
    """Leaves of all trees with the different predictors on their paths, read from the saved model.

    Each leaf has as many slots as the longest path has predictors; a slot holds a predictor (-1: none), the range its values must
    lie in, and ``share``, the part of the training rows that the splits on it let through, which stands in for the
    predictor when its value is not known. The size is bounded by trees x 2^depth x depth.
    """
    path = scratch_path(spark, "trees")
    model.write().save(path)
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    nodes: dict[tuple[int, int], object] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        nodes[(row["treeID"], row["nodeData"]["id"])] = row["nodeData"]
    leaves: list[tuple[float, dict[int, tuple[float, float, float]]]] = []
    for tree, weight in weights.items():
        open_nodes: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
        while open_nodes:
            at, held = open_nodes.pop()
            node = nodes[(tree, at)]
            if node["leftChild"] < 0:
                leaves.append((weight * node["prediction"], held))
                continue
            j, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
            low, high, share = held.get(j, (-np.inf, np.inf, 1.0))
            for child, bounds in ((node["leftChild"], (low, min(high, cut))), (node["rightChild"], (max(low, cut), high))):
                open_nodes.append((child, held | {j: (*bounds, share * nodes[(tree, child)]["rawCount"] / node["rawCount"])}))
    return slotted(leaves)


def slotted(leaves: Sequence[tuple[float, dict[int, tuple[float, float, float]]]]) -> dict[str, np.ndarray]:
    """Arrays of leaves given as (value, predictor -> (low, high, share)); empty slots let everything through."""
    slots = max((len(held) for _, held in leaves), default=0)
    shape = (len(leaves), max(slots, 1))
    out = {"feature": np.full(shape, -1), "low": np.full(shape, -np.inf), "high": np.full(shape, np.inf), "share": np.ones(shape)}
    for i, (_, held) in enumerate(leaves):
        for k, (j, (low, high, share)) in enumerate(held.items()):
            out["feature"][i, k], out["low"][i, k], out["high"][i, k], out["share"][i, k] = j, low, high, share
    return out | {"value": np.array([v for v, _ in leaves])}


def shapley_of(x: np.ndarray, leaves: dict[str, np.ndarray]) -> np.ndarray:
    """Rows x (predictors + base value); each row adds up to the prediction.

    A leaf is a game of the predictors on its path alone: with the set S known it pays its value times the product of inside (0 or 1) over S and
    share over the others. The products over all sets of one size are a coefficient of the polynomial with factors share + inside t, so
    a predictor's value is a weighted sum of the coefficients of the factors without its own (Lundberg et al. 2018, path-dependent): work
    grows with the square of the depth and not with the number of predictors. Empty slots are players that change nothing.
    """
    feature, share, value = leaves["feature"], leaves["share"], leaves["value"]
    slots, width = feature.shape[1], x.shape[1]
    weights = np.array([1.0 / (slots * comb(slots - 1, k)) for k in range(slots)])
    out = np.zeros((len(x), width + 1))
    out[:, width] = (share.prod(axis=1) * value).sum()
    used = feature.reshape(-1)
    order = np.argsort(used, kind="stable")
    kinds, firsts = np.unique(used[order], return_index=True)
    step = max(1, CELLS_AT_ONCE // max(len(value), 1))
    for start in range(0, len(x), step):
        rows = x[start : start + step]
        held = rows[:, np.maximum(feature, 0)]
        inside = (((held > leaves["low"]) & (held <= leaves["high"])) | (feature < 0)).astype(float)
        moved = np.empty(inside.shape)
        for own in range(slots):
            terms = np.zeros((slots, *inside.shape[:2]))
            terms[0] = 1.0
            size = 0
            for other in range(slots):
                if other != own:
                    known, through = inside[:, :, other], share[None, :, other]
                    for k in range(size + 1, 0, -1):
                        terms[k] = terms[k] * through + terms[k - 1] * known
                    terms[0] = terms[0] * through
                    size += 1
            moved[:, :, own] = np.tensordot(weights, terms, 1) * (inside[:, :, own] - share[None, :, own]) * value
        if kinds.size:
            summed = np.add.reduceat(moved.reshape(len(rows), -1)[:, order], firsts, axis=1)
            real = kinds >= 0
            out[start : start + step, kinds[real]] += summed[:, real]
    return out


def attribute(df: DataFrame, model, predictors: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """One row per (id, predictor) with its share in moving the prediction off the base value.

    Exact over all predictor subsets (Shapley 1953; Lundberg & Lee 2017) for any number of predictors; the cost per row
    follows from the trees alone.
    """
    width = len(predictors)
    leaves = leaf_paths(df.sparkSession, model)

    @F.pandas_udf("array<double>")
    def values(row: pd.Series) -> pd.Series:
        return pd.Series(shapley_of(np.stack(row.to_numpy()), leaves).tolist() if len(row) else [], dtype=object)

    scored = df.select(*ids, values(F.array(*[predictor(c) for c in predictors])).alias("_v"))
    cells = F.array(
        *[F.struct(F.lit(i).alias("o"), F.lit(c).alias("n"), F.col("_v")[i].alias("v")) for i, c in enumerate(predictors)]
    )
    long = scored.select(*ids, F.col("_v")[width].alias("base_value"), F.explode(cells).alias("_c"))
    return long.select(
        *ids, F.col("_c.n").alias("variable"), F.col("_c.v").alias("value"), "base_value", F.col("_c.o").alias("_order")
    )


def attribution_wide(long: DataFrame, ids: Sequence[str], predictors: Sequence[str]) -> DataFrame:
    return to_wide(long, ids, "variable", F.col("value"), predictors, "shap_value_")


def attribution_text(long: DataFrame, ids: Sequence[str], name: str = "shap_values_text") -> DataFrame:
    line = F.concat(F.col("variable"), F.lit(" Shap Value: "), text_or_na("value"))
    return joined_text(long, ids, "_order", line, name)
