"""Sales by month, category and item: roll-ups, category correlation, item features.

Facts: day, item_id, category, category_name, item_description, volume, dollars.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import before_month_of, month_key, word_tokens
from tidemark.functions.stats import percent, safe_corr, safe_ratio, sum_if
from tidemark.operators.grouping import top_groups, with_group_totals
from tidemark.operators.joins import in_frame
from tidemark.session import materialize

CATEGORY = ["category", "category_name"]
ITEM = ["category_name", "item_description"]


def sales_facts(
    sales: DataFrame,
    items: DataFrame,
    day: str,
    item: str,
    volume: str,
    dollars: str,
    as_of: dt.date,
    start: dt.date | None = None,
) -> DataFrame:
    """Sales of complete months by the month's first day and item, with the item's columns.

    Sales are summed per month and item before the join, so no single sale meets the item table, and a best-selling
    item has one row a month. The planner sends the item table out whole if its size allows.
    """
    kept = sales.where(before_month_of(day, as_of))
    if start is not None:
        kept = kept.where(F.col(day) >= F.lit(start))
    facts = kept.groupBy(F.trunc(F.to_date(day), "MM").alias("month_start"), F.col(item).alias("item_id")).agg(
        F.sum(volume).alias("volume"), F.sum(dollars).alias("dollars")
    )
    return facts.join(items, "item_id", "left")


def monthly_by_category(facts: DataFrame) -> DataFrame:
    """Sums by month and category; the month is turned into text after the rows are summed."""
    sums = facts.groupBy("month_start", *CATEGORY).agg(
        F.sum("volume").alias("category_monthly_volume"), F.sum("dollars").alias("category_monthly_dollars")
    )
    return sums.withColumn("month", month_key("month_start")).select("month", *CATEGORY, *sums.columns[3:])


def top_categories(monthly: DataFrame, n: int = 20, drop_null_keys: bool = False) -> DataFrame:
    total = F.sum("category_monthly_volume")
    return top_groups(monthly, CATEGORY, total, "total_volume", n, drop_null_keys)


def top_series(monthly: DataFrame, n: int) -> DataFrame:
    """Monthly rows of the top categories."""
    monthly = materialize(monthly, "monthly")
    return in_frame(monthly, top_categories(monthly, n), ["category_name"])


def series_of_names(monthly: DataFrame, names: list[str], first_month: str) -> DataFrame:
    return monthly.where((F.col("month") >= first_month) & F.col("category_name").isin(names))


def month_shares(monthly: DataFrame) -> DataFrame:
    """Each category's percentage of its month; the month total comes from the same sums."""
    monthly = materialize(monthly, "monthly")
    totals = with_group_totals(monthly, ["month"], F.sum("category_monthly_volume").alias("total_monthly_volume"))
    return totals.withColumn("pct", percent("category_monthly_volume", "total_monthly_volume"))


def category_correlation(shares: DataFrame, min_months: int = 24, min_pct: float = 1.0) -> DataFrame:
    """Correlation of every ordered pair of categories over the months both were sold in.

    ``shares`` has one row per month and category, so the rows of a pair are its shared months.
    A pair counts when both average ``min_pct`` over at least ``min_months`` of them.
    Such a category has percentages adding up to ``min_months * min_pct`` or more, so others
    leave before the self-join. As a month's percentages add up to 100, at most
    ``100 * months / (min_months * min_pct)`` categories stay, however many there are.
    """
    weight = with_group_totals(shares, CATEGORY, F.sum(F.greatest("pct", F.lit(0.0))).alias("_weight"))
    # The margin covers rounding of the sum; the exact test follows on each pair.
    strong = weight.where(F.col("_weight") >= min_months * min_pct * (1 - 1e-9)).select("month", *CATEGORY, "pct")
    strong = materialize(strong, "strong-categories")
    a = strong.select("month", *[F.col(c).alias(f"{c}1") for c in CATEGORY], F.col("pct").alias("pct1"))
    b = strong.select("month", *[F.col(c).alias(f"{c}2") for c in CATEGORY], F.col("pct").alias("pct2"))
    names = [f"{c}{i}" for i in (1, 2) for c in CATEGORY]
    pairs = a.join(b, "month").groupBy(*names).agg(
        F.count(F.lit(1)).alias("num_months"),
        safe_corr("pct1", "pct2").alias("category_corr_across_months"),
        F.avg("pct1").alias("category1_avg_pct_of_month_volume"),
        F.avg("pct2").alias("category2_avg_pct_of_month_volume"),
    )
    return pairs.where(
        (F.col("num_months") >= min_months)
        & (F.col("category1_avg_pct_of_month_volume") >= min_pct)
        & (F.col("category2_avg_pct_of_month_volume") >= min_pct)
    )


def described(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("category_name").isNotNull() & F.col("item_description").isNotNull())


def item_features(facts: DataFrame) -> DataFrame:
    """Tokens, volume, unit price and fourth-quarter share per described item."""
    fourth = F.month("month_start").isin(10, 11, 12)
    sums = described(facts).groupBy(*ITEM).agg(
        F.sum("volume").alias("total_item_volume"),
        safe_ratio(F.sum("dollars"), F.sum("volume")).alias("avg_dollars_per_unit"),
        percent(sum_if(fourth, "volume"), F.sum("volume")).alias("pct_item_volume_q4"),
    )
    return sums.where(F.col("total_item_volume") > 0).withColumns(
        {"cat_tokens": word_tokens("category_name"), "item_tokens": word_tokens("item_description")}
    )


def dearest_items(facts: DataFrame, n: int = 10, tokens: bool = False) -> DataFrame:
    """The items with the highest unit price, ordered by a figure that is not returned."""
    price = safe_ratio(F.sum("dollars"), F.sum("volume"))
    ranked = described(facts).groupBy(*ITEM).agg(price.alias("_price"))
    top = ranked.orderBy(F.desc_nulls_last("_price"), *ITEM).limit(n).drop("_price")
    if tokens:
        top = top.withColumns(
            {"cat_tokens": word_tokens("category_name"), "item_tokens": word_tokens("item_description")}
        )
    return top
