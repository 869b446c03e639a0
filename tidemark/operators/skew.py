"""Joining rows to a lookup when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that are spread at most, which bounds the broadcast; rows a salt of a spread key stands for.
HOT_KEYS = 10_000
HOT_ROWS = 1_000_000


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys, NULL matching NULL; the left columns, then the right ones beyond the keys."""
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    extra = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    joined = left.alias("l").join(right.alias("r"), same, how)
    return joined.select(*[F.col(f"l.{c}") for c in left.columns], *extra)


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    hot_rows: int | None = None,
    keep_weight: bool = False,
) -> DataFrame:
    """Left join ``df`` to ``lookup`` on ``keys``; NULL keys match each other.

    ``weight`` is the lookup column counting the rows of ``df`` per key. Rows of the
    heaviest keys are spread by row over one salt per ``hot_rows`` rows, and the matching lookup
    rows are repeated once per salt, so no key is one task. At most ``HOT_KEYS`` keys are heavy, which
    bounds the broadcast; any other key has less than one part in ``HOT_KEYS`` of the rows.
    Without a heavy key it is a plain join. ``lookup`` is read several times: pass a
    materialised one.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    heaviest = lookup.agg(F.max(weight)).first()[0]
    if heaviest is None or heaviest < hot_rows:
        return join_same(df, lookup if keep_weight else lookup.drop(weight), keys)
    hot = (
        lookup.where(F.col(weight) >= hot_rows)
        .select(*keys, weight)
        .distinct()
        .orderBy(F.desc(weight), *keys)
        .limit(HOT_KEYS)
        .select(*keys, (F.ceil(F.col(weight) / F.lit(max(hot_rows, 1))) + 1).cast("long").alias("_salts"))
    )
    # by row number, not content: rows that are alike spread too, and any salt joins to the same lookup row
    left = _flag(df, hot, keys).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.col("_salts")))
    copies = F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)
    right = _flag(lookup, hot, keys).withColumn("_salt", F.explode(copies)).drop("_salts")
    right = right if keep_weight else right.drop(weight)
    return join_same(left, right, [*keys, "_salt"]).drop("_salts", "_salt")


def _flag(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    return join_same(df, F.broadcast(hot), keys).withColumn("_salts", F.coalesce("_salts", F.lit(1).cast("long")))
