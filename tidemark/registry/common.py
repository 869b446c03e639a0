"""Helpers shared by the query bindings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, places: Mapping[str, int]) -> DataFrame:
    """Sums of doubles depend on their order in the last digits; compare without those.

    Adding zero turns a negative zero into a plain one.
    """
    return df.withColumns({c: F.round(c, n) + F.lit(0.0) for c, n in places.items()})
