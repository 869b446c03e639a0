"""Ranks with the tie rules of statistics packages, at any group size.

``tie_ranks`` uses a plain window and suits aggregated frames whose groups are small by
nature. ``with_positions`` and what builds on it use a window only if no group is counted to
be large, and otherwise never put a whole group in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import join_same, lookup_join
from tidemark.session import materialize

# A group of this many rows may be sorted by one task.
ONE_TASK_ROWS = 1_000_000
# Ranges of fewer rows are not worth a task, and more ranges than these only if each holds ``ONE_TASK_ROWS``.
LEAST_RANGE, MANY_RANGES = 32, 256


def tie_ranks(value: str, partition: Sequence[str], prefix: str, method: str = "min") -> dict[str, Column]:
    """Descending rank and number of rows sharing it; NULL values keep a NULL rank.

    ``method`` is ``min`` (1, 1, 3) or ``average`` (1.5, 1.5, 3).
    """
    v = F.col(value)
    ordered = Window.partitionBy(*partition).orderBy(v.desc_nulls_last())
    ties = F.count(F.lit(1)).over(Window.partitionBy(*partition, value))
    rank = F.rank().over(ordered).cast("long")
    if method == "average":
        rank = rank + (ties - 1) / F.lit(2.0)
    return {
        f"{prefix}_rk": F.when(v.isNotNull(), rank),
        f"{prefix}_num_at_rk": F.when(v.isNotNull(), ties),
    }


def unique_rank(value: str, tie_break: Sequence[str], partition: Sequence[str]) -> Column:
    order = [F.col(value).desc_nulls_last(), *[F.col(c) for c in tie_break]]
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order)).cast("long")


def scaled_unique_rank(
    df: DataFrame, value: str, tie_break: Sequence[str], keys: Sequence[str], name: str, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """``unique_rank`` as a column ``name``, for groups of any size."""
    order = [F.col(value).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tie_break]]
    return row_positions(df, keys, order, name, one_task_rows).withColumn(name, F.col(name) + 1)


def has_large_group(df: DataFrame, keys: Sequence[str], above: int) -> bool:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return bool(sizes.where(F.col("_n") > above).take(1))


def range_count(rows: int, one_task_rows: int) -> int:
    """How many ranges ``rows`` are dealt to: about ``one_task_rows`` to each, but not ever more of small ones as the table grows."""
    fine = math.ceil(rows / max(one_task_rows, LEAST_RANGE))
    return max(1, min(fine, max(MANY_RANGES, math.ceil(rows / ONE_TASK_ROWS))))


def range_buckets(
    df: DataFrame, keys: Sequence[str], value: str, one_task_rows: int = ONE_TASK_ROWS
) -> tuple[DataFrame, bool]:
    """Adds ``_bucket``: consecutive ranges of group and value that hold about ``one_task_rows`` rows each.

    Also tells whether rows were dealt out; if no group is large all share one bucket. The number of ranges follows the
    counted rows, and equal values of a group share a bucket. The result is written once, so all readers agree on it.
    """
    if not has_large_group(df, keys, one_task_rows):
        return df.withColumn("_bucket", F.lit(0)), False
    ranges = range_count(df.count(), one_task_rows)
    spread = df.repartitionByRange(ranges, *[F.col(k).asc_nulls_first() for k in keys], F.col(value).asc_nulls_first())
    return materialize(spread.withColumn("_bucket", F.spark_partition_id()), "ranges"), True


def _running(
    df: DataFrame, keys: list[str], order: list[Column], weight: Column, name: str, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Adds what the rows of its group before a row weigh; a group may cover any number of tasks.

    Rows are dealt by ranges of group and order, as many as the counted rows ask for, so values of any type that sorts will do. Each range
    sums its own piece of a group and adds what the group's pieces in earlier ranges hold.
    """
    ranges = range_count(df.count(), one_task_rows)
    spread = df.repartitionByRange(ranges, *[F.col(k).asc_nulls_first() for k in keys], *order)
    placed = materialize(spread.withColumn("_range", F.spark_partition_id()), "ranges")
    pieces = placed.groupBy("_range", *keys).agg(F.sum(weight).alias("_own"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = pieces.select("_range", *keys, F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_carry"))
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn(name, F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return join_same(summed, carry, ["_range", *keys]).withColumn(name, F.col(name) + F.col("_carry")).drop("_range", "_carry")


def value_positions(
    df: DataFrame, keys: Sequence[str], value: str, descending: bool = False, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Distinct values per group with ``_ties`` (rows holding it) and ``_before`` (rows ahead).

    Rows are first counted per distinct value, with a map-side combine.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_ties"))
    order = F.desc(value) if descending else F.asc(value)
    placed = _running(counts, keys, [order], F.col("_ties"), "_before", one_task_rows)
    return materialize(placed.select(*keys, value, "_ties", "_before"), "positions")


def row_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Adds a number from 0 for every row of a group in ``order``; rows that are level are numbered in any order."""
    keys = list(keys)
    if not has_large_group(df, keys, one_task_rows):
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)
    marked = df.withColumn("_row", F.monotonically_increasing_id())
    return _running(marked, keys, [*order, F.col("_row").asc()], F.lit(1), name, one_task_rows).drop("_row")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, v: total + v)


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    descending: bool = False,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Each row with ``_before`` (rows of its group ahead of it) and ``_ties`` (rows level with it).

    Groups of up to ``one_task_rows`` rows are sorted by a window, larger ones are counted in
    value ranges. Rows with a NULL value have NULLs. ``df`` is read several times: pass a table
    or a materialised frame.
    """
    keys = list(keys)
    if has_large_group(df, keys, one_task_rows):
        positions = value_positions(df, keys, value, descending, one_task_rows)
        return lookup_join(df, positions, [*keys, value], "_ties", keep_weight=True)
    v = F.col(value)
    ordered = Window.partitionBy(*keys).orderBy(v.desc_nulls_last() if descending else v.asc_nulls_last())
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, value))
    return df.withColumns(
        {
            "_ties": F.when(v.isNotNull(), ties),
            "_before": F.when(v.isNotNull(), F.rank().over(ordered).cast("long") - 1),
        }
    )


def scaled_rank(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rank: str,
    descending: bool = False,
    method: str = "min",
    num_at_rank: str | None = None,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """``tie_ranks`` for groups of any size, down to one group that is the whole table."""
    placed = with_positions(df, keys, value, descending, one_task_rows)
    number = F.col("_before") + 1
    if method == "average":
        number = number + (F.col("_ties") - 1) / F.lit(2.0)
    ranked = placed.withColumn(rank, number)
    if num_at_rank:
        ranked = ranked.withColumn(num_at_rank, F.col("_ties"))
    return ranked.drop("_before", "_ties")


def group_slices(df: DataFrame, groups: int, order_by: str, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Adds ``upload_group``: 1 to ``groups``, rows split evenly in ``order_by`` order.

    Every row gets a slice: NULLs are last, and rows with equal values may fall into two slices.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    placed = row_positions(df, [], [F.col(order_by).asc_nulls_last()], "_before", one_task_rows)
    slice_no = F.ceil((F.col("_before") + 1) / total * groups).cast("int")
    return placed.withColumn("upload_group", slice_no).drop("_before")


def five_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Minimum, quartiles and maximum per group, exact, with linear interpolation.

    Only the values at the wanted positions are kept, so a group is never gathered.
    """
    keys = list(keys)
    positions = value_positions(df, keys, value)
    totals = positions.groupBy(*keys).agg(F.sum("_ties").alias("_total"))
    if keys:
        placed = join_same(positions, totals, keys, "inner")
    else:
        placed = positions.withColumn("_total", totals.scalar())
    names = ["min", "q1", "median", "q3", "max"]
    picks = []
    for i, name in enumerate(names):
        at = (F.col("_total") - 1) * F.lit(i / 4)
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("_before") <= pos) & (pos < F.col("_before") + F.col("_ties"))
            picks.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
    found = placed.groupBy(*keys).agg(F.max("_total").alias("n"), *picks)
    outs = []
    for i, name in enumerate(names):
        at = (F.col("n") - 1) * F.lit(i / 4)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        outs.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return found.select(*keys, "n", *outs)
