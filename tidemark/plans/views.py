"""Page views by local day: totals, daily ranks, days at the top."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import in_local_days, local_day
from tidemark.functions.stats import sum_if
from tidemark.operators.ranking import ONE_TASK_ROWS, scaled_rank
from tidemark.operators.reshape import with_years
from tidemark.session import materialize

ZONE = "America/Los_Angeles"


def daily_views(
    hits: DataFrame, stamp: str, title: Column, views: Column, first: dt.date, last: dt.date, zone: str = ZONE
) -> DataFrame:
    """Views per local day and title within a range of local days."""
    kept = hits.where(in_local_days(stamp, zone, first, last))
    return kept.groupBy(local_day(stamp, zone).alias("date"), title.alias("page_title")).agg(views.alias("views"))


def views_of_titles(daily: DataFrame, titles: DataFrame, first: int, last: int) -> DataFrame:
    """Daily views of the listed titles in each year of the range, as one join.

    ``titles`` has ``page_title`` and any columns to keep. Titles without views drop out.
    """
    wanted = with_years(titles, first, last)
    return wanted.join(daily.withColumn("year", F.year("date")), ["page_title", "year"], "inner")


def daily_ranks(daily: DataFrame, name: str = "page_title", one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Rank by views within each day, best first; tied titles share the mean of their ranks."""
    daily = materialize(daily, "daily-views")
    ranked = scaled_rank(
        daily, ["date"], "views", "date_view_rank", descending=True, method="average", one_task_rows=one_task_rows
    )
    return ranked.select("date", name, "views", "date_view_rank")


def days_at_top(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days on which a title alone had the most views (a shared top rank is 1.5)."""
    return ranked.groupBy(*keys).agg(
        sum_if(F.col("date_view_rank") == 1, F.lit(1)).alias("num_days_no1")
    )
