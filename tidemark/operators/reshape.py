"""Union, pivot, unpivot, densify, fill and split."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import join_same


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def literal_row(df: DataFrame, **values: object) -> DataFrame:
    """One literal row typed like the columns of ``df`` it names."""
    fields = [df.schema[name] for name in values]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    return df.sparkSession.createDataFrame([tuple(values.values())], schema)


def over_columns(
    df: DataFrame, columns: Sequence[str], make: Callable[[Column], Column], name: str = "{col}"
) -> DataFrame:
    """The same expression over many columns, in place or under a name pattern."""
    return df.withColumns({name.format(col=c): make(F.col(c)) for c in columns})


def columns_first(df: DataFrame, first: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    rest = [c for c in df.columns if c not in first and c not in drop]
    return df.select(*first, *rest)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def with_years(df: DataFrame, first: int, last: int, name: str = "year") -> DataFrame:
    """Each row once per year of the range."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(first), F.lit(last))))


def densify(df: DataFrame, across: str, within: str, fill: Mapping[str, object] | None = None) -> DataFrame:
    """Rows for every (``across``, ``within``) combination, absent ones NULL or filled.

    ``across`` is the short axis (years): its values travel as one array to the distinct
    ``within`` keys, which are exploded from it. Existing NULLs of ``fill`` columns are filled
    too; several rows of one combination all stay.
    """
    axis = df.select(across).distinct().agg(F.sort_array(F.collect_list(across))).scalar()
    grid = df.select(within).distinct().select(within, F.explode(axis).alias(across))
    out = join_same(grid.select(across, within), df, [across, within])
    for column, value in (fill or {}).items():
        out = out.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
    return out


def zero_where(df: DataFrame, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    """NULLs to zero, optionally only in rows that meet ``condition``."""

    def fill(c: Column) -> Column:
        missing = c.isNull() if condition is None else condition & c.isNull()
        return F.when(missing, 0).otherwise(c)

    return over_columns(df, columns, fill)


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    as_double = df.select(*ids, *[F.col(c).cast("double") for c in columns])
    return as_double.unpivot(list(ids), list(columns), name, value)


def to_wide(
    df: DataFrame, ids: Sequence[str], name: str, value: Column, values: Sequence[str], prefix: str = ""
) -> DataFrame:
    """One column per listed value; listing them spares a pass over the data to find them."""
    picks = [
        F.first(F.when(F.col(name) == v, value), ignorenulls=True).alias(f"{prefix}{v}") for v in values
    ]
    return df.groupBy(*ids).agg(*picks)


def mean_matrix(df: DataFrame, row: str, column: str, value: str, values: Sequence[str]) -> DataFrame:
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(value))


def split_by_range(
    df: DataFrame, column: str, starts: Sequence[tuple[str, int]], end: int, name: str = "split"
) -> DataFrame:
    """Label rows by consecutive ranges; each starts at its bound, the last ends at ``end``.

    Adds ``<name>_order`` with the position of the label, for sorting.
    """
    bounds = [b for _, b in starts] + [end + 1]
    label = order = None
    for i, (text, low) in enumerate(starts):
        inside = (F.col(column) >= low) & (F.col(column) < bounds[i + 1])
        label = F.when(inside, text) if label is None else label.when(inside, text)
        order = F.when(inside, i) if order is None else order.when(inside, i)
    return df.withColumns({name: label, f"{name}_order": order})


def ordinal_of(column: str, levels: Sequence[str]) -> Column:
    """Position of an ordered category's value."""
    found = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(column))
    return F.when(found > 0, found.cast("int"))


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, n, si, sj, sii, sjj, sij) for every two columns i <= j, over the rows that have both.

    Sums are of the values less the column's minimum. A batch adds to all pairs by products of its matrix with its mask of known values;
    a task returns one row a pair, and the parts add up.
    """
    least = df.agg(*[F.min(F.col(c).cast("double")) for c in columns]).first()
    shift = np.array([x if x is not None and np.isfinite(x) else 0.0 for x in least])
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, width, width))
        for batch in batches:
            x = np.stack([column.to_numpy(zero_copy_only=False) for column in batch.columns], axis=1)
            known = np.stack([column.is_valid().to_numpy(zero_copy_only=False) for column in batch.columns], axis=1).astype(float)
            x = np.where(known > 0, x - shift, 0.0)
            first, second = x.T @ known, (x * x).T @ known
            sums += np.stack((known.T @ known, first, first.T, second, second.T, x.T @ x))
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *(pa.array(s[i, j]) for s in sums)], names=["i", "j", *names])

    names = ["n", "si", "sj", "sii", "sjj", "sij"]
    rows = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    parts = rows.mapInArrow(run, "i long, j long, " + ", ".join(f"{c} double" for c in names))
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations in long form, from one pass; NULL where a side is constant or nothing is known.

    Each pair is computed once; the mirror and the diagonal come from it. NaN counts as a value and makes its pairs NaN.
    """

    def spread(square: str, total: str) -> Column:
        rest = F.col(square) - F.col(total) * F.col(total) / F.col("n")
        # what rounding leaves of a constant is none
        return F.when(F.isnan(rest) | (rest > 1e-13 * F.col(square)), rest)

    together = F.col("sij") - F.col("si") * F.col("sj") / F.col("n")
    known = co_moments(df, columns).where("n > 0")
    corr = F.try_divide(together, F.sqrt(spread("sii", "si")) * F.sqrt(spread("sjj", "sj")))
    names = F.array(*[F.lit(c) for c in columns])
    pairs = df.sparkSession.range(len(columns)).select(F.col("id").alias("i"), F.explode(F.sequence(F.col("id"), F.lit(len(columns) - 1))).alias("j"))
    cells = pairs.join(known.select("i", "j", F.when(F.col("i") == F.col("j"), corr * 0 + 1).otherwise(corr).alias("corr")), ["i", "j"], "left")
    at = lambda c: F.element_at(names, F.col(c).cast("int") + 1)
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct(at("i"), at("j")))).otherwise(F.array(F.struct(at("i"), at("j")), F.struct(at("j"), at("i"))))
    cells = cells.select(F.explode(both).alias("x"), "corr")
    return cells.select(F.col("x.col1").alias("column_1"), F.col("x.col2").alias("column_2"), "corr")
