"""Joins beyond plain equality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import ONE_TASK_ROWS, range_buckets
from tidemark.operators.skew import HOT_ROWS, join_same, lookup_join
from tidemark.session import materialize


def in_frame(df: DataFrame, members: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``members``; ``members`` goes out whole when it is small enough."""
    return df.join(members.select(*on).distinct(), list(on), "left_semi")


def outer_by_key(left: DataFrame, right: DataFrame, key: str, shared: Sequence[str] = ()) -> DataFrame:
    """Full outer join; ``key`` and ``shared`` take the left value, or the right if it is missing."""
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    both = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in (key, *shared)]
    rest = [F.col(f"a.{c}") for c in left.columns if c != key and c not in shared]
    rest += [F.col(f"b.{c}") for c in right.columns if c != key and c not in shared]
    return joined.select(*both, *rest)


def latest_before(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    strict: bool = True,
    one_task_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """For each left row the right rows with the latest time before it, per key.

    Every left row is kept. Right rows that tie at the chosen time are all returned. A NULL
    key matches nothing. With ``strict=False`` an equal time counts as before.

    The match depends on key and time only, so it is found once per distinct pair. If any key has more
    than ``one_task_rows`` pairs, they are dealt by ranges of key and time, and the last right time of earlier
    ranges is carried over, whatever the number of such keys; the way back to the left rows is a salted join.
    """
    keys = list(keys)
    if left_time in right.columns:
        raise ValueError(f"rename {left_time!r}: it is a column of both sides")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    asked = left.where(known).groupBy(*keys, F.col(left_time).alias("_t")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    given = right.where(known).select(*keys, F.col(right_time).alias("_t")).distinct()
    side = 0 if strict else 2
    both = asked.withColumn("_side", F.lit(side)).unionByName(
        given.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    both = materialize(both, "asof-times")
    right_t = F.when(F.col("_side") == 1, F.col("_t"))
    both, split = range_buckets(both, keys, "_t", one_task_rows)
    if split:
        # a range adds what the key's earlier ranges last held
        pieces = both.groupBy("_bucket", *keys).agg(F.max(right_t).alias("_last"))
        before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        both = join_same(both, pieces.select("_bucket", *keys, F.max("_last").over(before).alias("_earlier")), ["_bucket", *keys])
    else:
        both = both.withColumn("_earlier", F.lit(None))
    upto = Window.partitionBy("_bucket", *keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    matched = (
        both.withColumn("_match", F.coalesce(F.max(right_t).over(upto), "_earlier"))
        .where(F.col("_side") == side)
        .select(*keys, "_t", "_rows", "_match")
    )
    found = matched.join(right.withColumn("_match", F.col(right_time)), [*keys, "_match"], "left")
    found = found.drop("_match").withColumnRenamed("_t", left_time)
    heaviest = both.agg(F.max("_rows")).first()[0]
    if (heaviest or 0) < HOT_ROWS:
        return join_same(left, found.drop("_rows"), [*keys, left_time])
    return lookup_join(left, materialize(found, "asof-match"), [*keys, left_time], "_rows")


def left_lookup(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which a NULL key matches nothing; the planner sizes up the right side."""
    return df.join(table, list(on), "left")

