"""Medal standings by country and year: panel, ranks, indicators, model, display.

Results: year, host_country, country, country_group, gold, silver, bronze.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import ordinal, text_or_na, tied_note
from tidemark.functions.stats import safe_ratio, strict_sum
from tidemark.operators.grouping import last_by, standardize
from tidemark.operators.joins import latest_before, left_lookup
from tidemark.operators.learning import predict, scale_to_total
from tidemark.operators.ranking import ONE_TASK_ROWS, has_large_group, scaled_rank, scaled_unique_rank, tie_ranks, unique_rank
from tidemark.operators.reshape import (
    densify, literal_row, numeric_columns, ordinal_of, over_columns, split_by_range, to_long, union_by_name, zero_where,
)
from tidemark.session import materialize

MEDALS = ["gold", "silver", "bronze"]
LAGS = ["medal_share_prev", "medal_share_2_ago"]
PREDICTORS = ["is_host", *LAGS, "population_scaled", "gdp_scaled"]
DISPLAY_FIELDS = ["gold", "silver", "bronze", "total", "predicted", "total_vs_predicted"]


def entrants_as_results(entrants: DataFrame, medals: DataFrame, year: int, host: str) -> DataFrame:
    """Results of one year for all entrants; those without medals get zeros."""
    rows = left_lookup(entrants, medals.select("country", *MEDALS), ["country"])
    zeros = over_columns(rows, MEDALS, lambda c: F.coalesce(c.cast("long"), F.lit(0)))
    return zeros.withColumns({"year": F.lit(year), "host_country": F.lit(host)})


def year_hosts(results: DataFrame, year: int, host: str) -> DataFrame:
    """Distinct (year, host), with a given year's host added if it is not there."""
    hosts = results.select("year", "host_country")
    return union_by_name(hosts, literal_row(hosts, year=year, host_country=host)).distinct()


def group_spans(results: DataFrame) -> DataFrame:
    """First and last year of each country group and the country it was last."""
    return results.groupBy("country_group").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), last_by("country", "year", "country").alias("last_country")
    )


def panel(results: DataFrame, open_year: int) -> DataFrame:
    """One row per group and year of its span, with medals, ranks, shares and earlier shares.

    Missing medals count as zero before ``open_year`` and stay missing from it on. A year with
    a missing total has no shares.
    """
    results = materialize(results, "results")
    hosted = results.withColumn("is_host", F.col("host_country") == F.col("country")).drop("host_country")
    dense = densify(hosted, "year", "country_group", {"is_host": False})
    filled = zero_where(dense, MEDALS, F.col("year") < open_year)
    spans = group_spans(results)
    placed = left_lookup(filled, spans, ["country_group"]).where(F.col("year").between(F.col("first_year"), F.col("last_year")))
    named = placed.withColumn("country", F.coalesce("country", "last_country"))
    totals = named.select(
        "year", "country", "country_group", "is_host", *MEDALS, (F.col("gold") + F.col("silver") + F.col("bronze")).alias("medals")
    )
    return with_shares(totals)


def with_shares(totals: DataFrame) -> DataFrame:
    """Ranks, year totals, shares and earlier shares; a year has one row per country."""
    year_total = strict_sum("medals", Window.partitionBy("year"))
    ranked = totals.withColumns({**tie_ranks("medals", ["year"], "medals"), "yr_tot_medals": year_total})
    shared = ranked.withColumn("medal_share", safe_ratio("medals", "yr_tot_medals"))
    history = Window.partitionBy("country_group").orderBy("year", "country")
    return shared.withColumns({name: F.lag("medal_share", n + 1).over(history) for n, name in enumerate(LAGS)})


def scaled_indicators(indicators: DataFrame) -> DataFrame:
    """Indicators in standard deviations from the mean of their year."""
    return standardize(materialize(indicators, "indicators"), ["gdp", "population", "gdp_per_capita"], ["indicator_year"])


def with_latest_indicators(rows: DataFrame, indicators: DataFrame) -> DataFrame:
    """The last indicators before each year, so a forecast uses only what was known."""
    return latest_before(rows, indicators, ["country_code"], "year", "indicator_year")


def analysis_rows(rows: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of the analysed years; a missing earlier share means no medals then."""
    return zero_where(rows.where(F.col("year").between(first, last)), LAGS)


def correlated_columns(rows: DataFrame) -> list[str]:
    return numeric_columns(rows, exclude=["year", "indicator_year"])


def model_rows(rows: DataFrame, train: int, test: int, target: int, target_total: float) -> DataFrame:
    """Train, test and forecast rows, the forecast year with its assumed medal total if unknown."""
    kept = analysis_rows(rows, train, target)
    assumed = F.when(F.col("year") == target, F.lit(float(target_total)))
    known = kept.withColumn("yr_tot_medals", F.coalesce(F.col("yr_tot_medals").cast("double"), assumed))
    return split_by_range(known, "year", [("Train", train), ("Test", test), ("Prediction", target)], target)


def forecast(rows: DataFrame, model, predictors: Sequence[str] = PREDICTORS) -> DataFrame:
    """Predicted shares scaled to each year's medals, ranked, with a text for display."""
    scored = materialize(predict(model, rows, predictors, "pred_medal_share"), "predictions")
    scored = scale_to_total(scored, "pred_medal_share", "yr_tot_medals", ["year"], "norm_pred_medal_share", "pred_medals")
    ranked = scored.withColumns(tie_ranks("pred_medals", ["year"], "pred_medals"))
    return ranked.withColumn("pred_medals_text", forecast_text())


def forecast_text():
    shown = F.col("pred_medal_share").isNotNull()
    share = F.when(shown, F.format_string("%.2f%%", F.col("pred_medal_share") * 100)).otherwise("NA%")
    known = F.col("pred_medals").isNotNull()
    amount = F.when(known, F.format_string("%.1f", F.col("pred_medals"))).otherwise("NA")
    return F.concat(
        F.col("year").cast("string"), F.lit(" "), F.col("country"),
        F.lit("\nPredicted Medal Share: "), share,
        F.lit("\nPredicted Medals: "), amount,
        F.lit("\nPredicted Medals Rank: "), text_or_na("pred_medals_rk"),
        F.coalesce(tied_note("pred_medals_num_at_rk", counted=True), F.lit("")),
    )


def long_standings(rows: DataFrame, one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """One row per country, year and figure, with ranks per year and figure and a label.

    If a year has more than ``one_task_rows`` countries its ranks are counted in ranges.
    """
    named = rows.withColumnsRenamed({"medals": "total", "pred_medals": "predicted"})
    compared = named.withColumn("total_vs_predicted", F.col("total") - F.col("predicted"))
    long = to_long(compared, ["year", "country"], DISPLAY_FIELDS, "medals_field", "medals_value")
    group = ["year", "medals_field"]
    if has_large_group(rows, ["year"], one_task_rows):
        long = materialize(long, "long-standings")
        ranked = scaled_rank(long, group, "medals_value", "medals_value_rk", True, num_at_rank="medals_value_num_at_rk", one_task_rows=one_task_rows)
        ranked = scaled_unique_rank(ranked, "medals_value", ["country"], group, "medals_value_unique_rk", one_task_rows)
    else:
        ranks = tie_ranks("medals_value", group, "medals_value")
        ranked = long.withColumns(ranks | {"medals_value_unique_rk": unique_rank("medals_value", ["country"], group)})
    ranked = ranked.withColumn("medals_field_order", ordinal_of("medals_field", DISPLAY_FIELDS))
    v = F.col("medals_value")
    amount = F.when(F.col("medals_field") == "predicted", F.format_string("%.1f", v)).when(
        F.col("medals_field") == "total_vs_predicted", F.format_string("%+.1f", v)
    ).otherwise(F.format_string("%d", v.cast("long")))
    label = F.concat(amount, F.lit("\n"), ordinal("medals_value_rk"), tied_note("medals_value_num_at_rk", counted=False))
    return ranked.withColumn("medals_value_rk_text", F.when(v.isNotNull(), label))
