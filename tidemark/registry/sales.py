"""Sales plans on ``lineitem`` and ``part``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import DRINK_CATEGORY_RULES, first_match_label
from tidemark.operators.reshape import mean_matrix
from tidemark.plans import sales as plan
from tidemark.registry.common import rounded
from tidemark.sources.readers import read_table

AS_OF = dt.date(2001, 11, 1)
START = dt.date(1997, 6, 15)
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
TYPE_RULES = [("^small|^medium", "Compact"), ("large", "Big"), ("promo|economy", "Value"), ("a", "Other")]


def _facts(spark: SparkSession, sf: str, start: dt.date | None = None, by: str = "p_brand") -> DataFrame:
    items = read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("category"),
        F.col(by).alias("category_name"),
        F.col("p_name").alias("item_description"),
    )
    lines = read_table(spark, sf, "lineitem")
    return plan.sales_facts(lines, items, "l_shipdate", "l_partkey", "l_quantity", "l_extendedprice", AS_OF, start)


def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return plan.monthly_by_category(_facts(spark, sf))


def sales_monthly_by_category(spark, sf):
    return rounded(_monthly(spark, sf), {"category_monthly_volume": 2, "category_monthly_dollars": 2})


def sales_top_categories(spark, sf):
    return rounded(plan.top_categories(_monthly(spark, sf)), {"total_volume": 2})


def sales_top_category_series(spark, sf):
    series = plan.top_series(_monthly(spark, sf), 5).select("month", "category_name", "category_monthly_volume")
    return rounded(series.orderBy("month", "category_name"), {"category_monthly_volume": 2})


def sales_chosen_category_series(spark, sf):
    chosen = plan.series_of_names(_monthly(spark, sf), ["Brand#1", "Brand#7", "Brand#12", "Brand#25"], "1998-09")
    out = chosen.select("month", "category_name", "category_monthly_volume").orderBy("category_name", "month")
    return rounded(out, {"category_monthly_volume": 2})


def _correlation(spark, sf, by="p_brand"):
    monthly = plan.monthly_by_category(_facts(spark, sf, START, by))
    return plan.category_correlation(plan.month_shares(monthly))


def sales_category_correlation(spark, sf):
    return rounded(
        _correlation(spark, sf),
        {
            "category_corr_across_months": 6,
            "category1_avg_pct_of_month_volume": 6,
            "category2_avg_pct_of_month_volume": 6,
        },
    ).orderBy("category_corr_across_months")


def sales_correlation_matrix(spark, sf):
    facts = _facts(spark, sf, START, "p_type").withColumn("category", F.lit(0))
    corr = plan.category_correlation(plan.month_shares(plan.monthly_by_category(facts)))
    matrix = mean_matrix(corr, "category_name1", "category_name2", "category_corr_across_months", TYPES)
    return rounded(matrix, {c: 6 for c in TYPES})


def sales_item_features(spark, sf):
    features = plan.item_features(_facts(spark, sf, by="p_type"))
    joined = features.withColumns(
        {"cat_tokens": F.array_join("cat_tokens", " "), "item_tokens": F.array_join("item_tokens", " ")}
    )
    return rounded(joined, {"total_item_volume": 2, "avg_dollars_per_unit": 6, "pct_item_volume_q4": 6})


def sales_item_price_top10(spark, sf):
    return plan.dearest_items(_facts(spark, sf, by="p_type"))


def sales_item_tokens_top10(spark, sf):
    top = plan.dearest_items(_facts(spark, sf, by="p_type"), tokens=True)
    return top.withColumns(
        {"cat_tokens": F.array_join("cat_tokens", " "), "item_tokens": F.array_join("item_tokens", " ")}
    )


def category_rule_label(spark, sf):
    parts = read_table(spark, sf, "part")
    labels = parts.select(
        "p_partkey",
        first_match_label("p_type", TYPE_RULES).alias("size_label"),
        first_match_label("p_name", DRINK_CATEGORY_RULES, "None").alias("drink_label"),
    )
    return labels


QUERIES = {
    f.__name__: f
    for f in (
        sales_monthly_by_category,
        sales_top_categories,
        sales_top_category_series,
        sales_chosen_category_series,
        sales_category_correlation,
        sales_correlation_matrix,
        sales_item_features,
        sales_item_price_top10,
        sales_item_tokens_top10,
        category_rule_label,
    )
}

_FACTS = """
facts AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS month, l_shipdate,
         CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS category,
         p_brand, p_type, p_name, l_quantity AS volume, l_extendedprice AS dollars
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  WHERE strftime(l_shipdate, '%Y-%m') < '2001-11'
)"""
_MONTHLY = (
    _FACTS
    + """,
monthly AS (
  SELECT month, category, p_brand AS category_name, sum(volume) AS category_monthly_volume,
         sum(dollars) AS category_monthly_dollars
  FROM facts GROUP BY ALL
)"""
)
_TOP = """SELECT category, category_name, sum(category_monthly_volume) AS total_volume
  FROM monthly GROUP BY ALL ORDER BY total_volume DESC, category, category_name LIMIT """
_ITEM_KEYS = "p_type IS NOT NULL AND p_name IS NOT NULL"
_DEAREST = f"""SELECT p_type AS category_name, p_name AS item_description
  FROM facts WHERE {_ITEM_KEYS} GROUP BY ALL
  ORDER BY sum(dollars) / nullif(sum(volume), 0) DESC NULLS LAST, p_type, p_name LIMIT 10"""


def _corr_sql(category: str, name: str) -> str:
    return (
        _FACTS
        + f""",
mc AS (
  SELECT month, {category} AS category, {name} AS category_name, sum(volume) AS v
  FROM facts WHERE l_shipdate >= DATE '1997-06-15' GROUP BY ALL
),
pct AS (SELECT *, v / nullif(sum(v) OVER (PARTITION BY month), 0) * 100 AS p FROM mc),
pairs AS (
  SELECT a.category AS category1, a.category_name AS category_name1,
         b.category AS category2, b.category_name AS category_name2,
         count(DISTINCT a.month) AS num_months,
         CASE WHEN isnan(corr(a.p, b.p)) THEN NULL ELSE corr(a.p, b.p) END AS c,
         avg(a.p) AS p1, avg(b.p) AS p2
  FROM pct a JOIN pct b USING (month) GROUP BY ALL
  HAVING count(DISTINCT a.month) >= 24 AND avg(a.p) >= 1 AND avg(b.p) >= 1
)"""
    )


SQL = {
    "sales_monthly_by_category": f"""WITH {_MONTHLY}
SELECT month, category, category_name, round(category_monthly_volume, 2) AS category_monthly_volume,
       round(category_monthly_dollars, 2) AS category_monthly_dollars FROM monthly""",
    "sales_top_categories": f"""WITH {_MONTHLY}
SELECT category, category_name, round(total_volume, 2) AS total_volume FROM ({_TOP} 20)""",
    "sales_top_category_series": f"""WITH {_MONTHLY}
SELECT month, category_name, round(category_monthly_volume, 2) AS category_monthly_volume FROM monthly
WHERE category_name IN (SELECT category_name FROM ({_TOP} 5))""",
    "sales_chosen_category_series": f"""WITH {_MONTHLY}
SELECT month, category_name, round(category_monthly_volume, 2) AS category_monthly_volume FROM monthly
WHERE month >= '1998-09' AND category_name IN ('Brand#1', 'Brand#7', 'Brand#12', 'Brand#25')""",
    "sales_category_correlation": f"""WITH {_corr_sql("category", "p_brand")}
SELECT category1, category_name1, category2, category_name2, num_months,
       round(c, 6) + 0.0 AS category_corr_across_months, round(p1, 6) AS category1_avg_pct_of_month_volume,
       round(p2, 6) AS category2_avg_pct_of_month_volume FROM pairs""",
    "sales_correlation_matrix": f"""WITH {_corr_sql("0", "p_type")}
SELECT category_name1, """
    + ", ".join(f"round(avg(c) FILTER (category_name2 = '{t}'), 6) + 0.0 AS \"{t}\"" for t in TYPES)
    + " FROM pairs GROUP BY category_name1",
    "sales_item_features": f"""WITH {_FACTS}
SELECT p_type AS category_name, p_name AS item_description, round(sum(volume), 2) AS total_item_volume,
       round(sum(dollars) / nullif(sum(volume), 0), 6) AS avg_dollars_per_unit,
       round(sum(CASE WHEN month(l_shipdate) IN (10, 11, 12) THEN volume ELSE 0 END)
             / nullif(sum(volume), 0) * 100, 6) AS pct_item_volume_q4,
       array_to_string(regexp_extract_all(lower(p_type), '[a-z]+'), ' ') AS cat_tokens,
       array_to_string(regexp_extract_all(lower(p_name), '[a-z]+'), ' ') AS item_tokens
FROM facts WHERE {_ITEM_KEYS} GROUP BY p_type, p_name HAVING sum(volume) > 0""",
    "sales_item_price_top10": f"WITH {_FACTS} {_DEAREST}",
    "sales_item_tokens_top10": f"""WITH {_FACTS}
SELECT *, array_to_string(regexp_extract_all(lower(category_name), '[a-z]+'), ' ') AS cat_tokens,
       array_to_string(regexp_extract_all(lower(item_description), '[a-z]+'), ' ') AS item_tokens
FROM ({_DEAREST})""",
    "category_rule_label": """
SELECT p_partkey,
       CASE WHEN regexp_matches(lower(p_type), '^small|^medium') THEN 'Compact'
            WHEN regexp_matches(lower(p_type), 'large') THEN 'Big'
            WHEN regexp_matches(lower(p_type), 'promo|economy') THEN 'Value'
            WHEN regexp_matches(lower(p_type), 'a') THEN 'Other' END AS size_label,
       CASE """
    + " ".join(f"WHEN regexp_matches(lower(p_name), '{p}') THEN '{label}'" for p, label in DRINK_CATEGORY_RULES)
    + " ELSE 'None' END AS drink_label FROM part",
}
