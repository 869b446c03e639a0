"""Prompt texts as column functions, usable from DataFrames and from SQL."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import _col

# Answers the prompts ask for when there is nothing to work on.
NO_DESCRIPTION = "No valid product description to summarize."
NO_IMAGE = "No valid product image or name to create alt text from."
NO_REVIEWS = "No valid reviews to summarize."

DESCRIPTION_PROMPT = (
    "Write one short product line of at most 20 words from the fields below. Use nothing "
    "that is not in them, and leave out brand and product name. If they do not describe a "
    "product, answer '" + NO_DESCRIPTION + "'\n\n"
    "Name: %s\nSubhead: %s\nDescription: %s\n"
)
ALT_TEXT_PROMPT = (
    "Write alt text of at most 15 words that says what the picture shows and no more. If "
    "it shows no product, answer '" + NO_IMAGE + "'\n"
)
REVIEW_PROMPT = (
    "Sum up these product reviews in short bullet points, at most 75 words, keeping to what "
    "they say and stressing what several of them mention. If there are none, answer "
    "'" + NO_REVIEWS + "'\n\nReviews:\n%s\n"
)
FORECAST_PROMPT = (
    "Explain the %s medal forecast for %s to a general reader in %s, in 100 words or "
    "fewer.\n\n%s\n\nImpact of each predictor:\n%s\n"
)
REPORT_PROMPT = (
    "Each file shows one country's results and forecast. Name the countries worth a report "
    "and why, in 500 words or fewer.\n"
)


def description_prompt(name: Column | str, subhead: Column | str, description: Column | str) -> Column:
    """Missing fields are left empty, so the prompt is never NULL."""
    fields = [F.coalesce(_col(c), F.lit("")) for c in (name, subhead, description)]
    return F.format_string(DESCRIPTION_PROMPT, *fields)


def alt_text_prompt() -> Column:
    return F.lit(ALT_TEXT_PROMPT)


def review_prompt(reviews: Column | str) -> Column:
    """NULL in, NULL out: a product without reviews asks nothing."""
    text = _col(reviews)
    return F.when(text.isNotNull(), F.format_string(REVIEW_PROMPT, text))


def forecast_prompt(
    year: Column, country: Column, is_host: Column, forecast: Column, impacts: Column, language: Column
) -> Column:
    """Explanation request; hosts get an extra line, an unknown language means English."""
    spoken = F.coalesce(language, F.lit("English"))
    body = F.format_string(FORECAST_PROMPT, year.cast("string"), country, spoken, forecast, impacts)
    host = F.concat(F.lit("Mention what hosting means for "), country, F.lit(".\n"))
    return F.concat(body, F.when(is_host, host).otherwise(""))


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def register_sql_functions(spark: SparkSession) -> None:
    """The prompt builders as SQL functions of the session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION description_prompt(name STRING, subhead STRING, "
        "description STRING) RETURNS STRING RETURN format_string("
        f"{_sql_text(DESCRIPTION_PROMPT)}, coalesce(name, ''), coalesce(subhead, ''), "
        "coalesce(description, ''))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION alt_text_prompt() RETURNS STRING "
        f"RETURN {_sql_text(ALT_TEXT_PROMPT)}"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION review_prompt(reviews STRING) RETURNS STRING "
        f"RETURN if(reviews IS NULL, NULL, format_string({_sql_text(REVIEW_PROMPT)}, reviews))"
    )
