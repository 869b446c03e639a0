"""Group totals, top lists, ordered text and nested rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import ONE_TASK_ROWS, row_positions
from tidemark.operators.skew import join_same
from tidemark.session import materialize


def profile_by(df: DataFrame, column: str, *aggregates: Column) -> DataFrame:
    """Aggregates by a column chosen at run time."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; have {df.columns}")
    return df.groupBy(column).agg(*aggregates)


def with_group_totals(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Each row with aggregates of its group.

    Partial sums and a join with the (small) group table instead of a window, which would
    sort every group in one task. NULL group keys form a group. ``df`` is read twice: pass a
    table or a materialised frame.
    """
    keys = list(keys)
    totals = df.groupBy(*keys).agg(*aggregates)
    if not keys:
        return df.withColumns({c: totals.select(c).scalar() for c in totals.columns})
    return join_same(df, totals, keys)


def standardize(df: DataFrame, columns: Sequence[str], within: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Distance from the group mean in sample standard deviations; NULL if the group is constant."""
    stats = [f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("avg", F.avg), ("sd", F.stddev_samp))]
    wide = with_group_totals(df, within, *stats)
    scaled = {
        f"{c}{suffix}": F.try_divide(F.col(c) - F.col(f"_avg_{c}"), F.col(f"_sd_{c}")) for c in columns
    }
    return wide.withColumns(scaled).drop(*[f"_{n}_{c}" for c in columns for n in ("avg", "sd")])


def top_groups(
    df: DataFrame, keys: Sequence[str], total: Column, name: str, n: int, drop_null_keys: bool = False
) -> DataFrame:
    """The ``n`` groups with the largest total, ties broken by key."""
    if drop_null_keys:
        df = df.dropna(subset=list(keys))
    ranked = df.groupBy(*keys).agg(total.alias(name))
    return ranked.orderBy(F.desc_nulls_last(name), *keys).limit(n)


def top_list(
    df: DataFrame, keys: Sequence[str], item: str, order: Sequence[Column], n: int, name: str, sep: str = ", "
) -> DataFrame:
    """The first ``n`` items per group joined into one text.

    The row-number limit is applied before the shuffle as well, so a group sends at most ``n``
    rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    first = df.where(F.col(item).isNotNull()).withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= n)
    listed = F.array_sort(F.collect_list(F.struct("_n", item)))
    return first.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda p: p[item]), sep).alias(name))


def distinct_list(df: DataFrame, keys: Sequence[str], item: str, name: str, sep: str = ", ") -> DataFrame:
    """Distinct items per group in order, for vocabularies such as category names."""
    kept = df.where(F.col(item).isNotNull()).select(*keys, item).distinct()
    return kept.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(item)), sep).alias(name))


def last_by(value: str, *order: str) -> Column:
    """Value of the row that is last in ``order``."""
    return F.max_by(value, F.struct(*order))


def numbered_parts(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    size: int,
    descending: bool = False,
    tie_break: Sequence[tuple[str, bool]] = (),
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Adds ``part``, so that parts of ``size`` rows follow the order within the group, and ``part_place`` in it.

    The order is ``order_by``, NULLs last, then ``tie_break`` as (column, descending); rows that are level stand in any order.
    """
    order = [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in ((order_by, descending), *tie_break)]
    placed = row_positions(df, keys, order, "_place", one_task_rows)
    return placed.withColumns({"part": F.floor(F.col("_place") / size), "part_place": F.col("_place") % size}).drop("_place")


def nested_parts(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    size: int,
    columns: Sequence[str],
    name: str = "rows",
    descending: bool = False,
    tie_break: Sequence[tuple[str, bool]] = (),
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """Rows nested into ordered lists of ``size``, as many lists per group as it takes; see ``numbered_parts``."""
    needed = dict.fromkeys([*keys, order_by, *[c for c, _ in tie_break], *columns])
    parts = numbered_parts(df.select(*needed), keys, order_by, size, descending, tie_break, one_task_rows)
    entry = F.struct("part_place", F.struct(*columns).alias("row"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["row"])
    return parts.groupBy(*keys, "part").agg(ordered.alias(name))


def text_digest(
    df: DataFrame,
    keys: Sequence[str],
    text: Column,
    order_by: str,
    size: int,
    name: str,
    sep: str,
    descending: bool = False,
    tie_break: Sequence[tuple[str, bool]] = (),
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """All texts of a group joined in order, NULL texts left out.

    One row per group while it has up to ``size`` texts; a larger group continues in further
    parts, which read in order make up the whole.
    """
    ties = [c for c, _ in tie_break if c not in keys]
    kept = df.select(*dict.fromkeys([*keys, order_by, *ties]), text.alias("_text")).where(F.col("_text").isNotNull())
    kept = materialize(kept, "texts")
    nested = nested_parts(kept, keys, order_by, size, ["_text"], "_rows", descending, tie_break, one_task_rows)
    joined = F.array_join(F.transform("_rows", lambda r: r["_text"]), sep)
    return nested.select(*keys, "part", F.size("_rows").alias("num_texts"), joined.alias(name))


def joined_text(df: DataFrame, keys: Sequence[str], order_by: str, text: Column, name: str, sep: str = "\n") -> DataFrame:
    """Texts of a short, fixed set of rows per key (one per model predictor) as one text."""
    pair = F.struct(F.col(order_by).alias("o"), text.alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list(pair)), lambda p: p["t"])
    return df.groupBy(*keys).agg(F.array_join(ordered, sep).alias(name))
