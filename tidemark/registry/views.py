"""Page-view plans on ``events`` (kinds of event or users as pages)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.scalars import page_key
from tidemark.plans import views as plan
from tidemark.registry.common import rounded
from tidemark.sources.readers import read_table, year_range

FIRST, LAST = dt.date(2024, 1, 2), dt.date(2024, 1, 28)
KINDS = ["view", "click", "purchase"]


def _user_days(spark, sf):
    events = read_table(spark, sf, "events").where(F.col("event_type").isin(KINDS))
    return plan.daily_views(events, "ts", F.col("user_id").cast("string"), F.count(F.lit(1)), FIRST, LAST)


def views_daily_local(spark, sf):
    events = read_table(spark, sf, "events").where(F.lower("event_type").isin(KINDS))
    daily = plan.daily_views(events, "ts", F.lower("event_type"), F.sum("value"), FIRST, LAST)
    return rounded(daily.orderBy(F.desc("date"), F.desc("views")), {"views": 4})


def views_daily_rank(spark, sf):
    return plan.daily_ranks(_user_days(spark, sf))


def views_daily_rank_split(spark, sf):
    """The same with every day counted as a large group."""
    return plan.daily_ranks(_user_days(spark, sf), one_task_rows=2)


def views_days_at_no1(spark, sf):
    days = plan.days_at_top(plan.daily_ranks(_user_days(spark, sf)), ["page_title"])
    return days.withColumn("num_days_no1", F.col("num_days_no1").cast("long"))


def views_by_title_and_year(spark, sf):
    """Titles from the customers' segments, views from their orders, one join for all years."""
    customers = read_table(spark, sf, "customer")
    wanted = (F.col("o_orderdate") >= F.lit(dt.date(1996, 1, 1))) & (F.col("o_orderdate") < F.lit(dt.date(2000, 1, 1)))
    orders = read_table(spark, sf, "orders").where(wanted).groupBy(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("date")
    ).agg(F.count(F.lit(1)).alias("n"))
    daily = orders.join(customers, "c_custkey").groupBy("date", F.lower("c_mktsegment").alias("page_title")).agg(
        F.sum("n").alias("views")
    )
    titles = customers.select(page_key("c_mktsegment").alias("page_title")).distinct()
    found = plan.views_of_titles(daily, titles, 1996, 1999)
    return found.select("year", "page_title", "date", "views")


def yearly_event_counts(spark, sf):
    """Order counts for each year of a generated range, years without orders included."""
    years = year_range(spark, 1994, 2002)
    counts = read_table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return years.join(counts, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("num_orders"))


def page_title_keys(spark, sf):
    parts = read_table(spark, sf, "part")
    name = F.concat("p_type", F.lit(" "), "p_name")
    suffix = F.when(F.col("p_size") > 25, F.lower("p_brand"))
    return parts.select("p_partkey", page_key(name, suffix).alias("page_title"))


QUERIES = {
    f.__name__: f
    for f in (
        views_daily_local,
        views_daily_rank,
        views_daily_rank_split,
        views_days_at_no1,
        views_by_title_and_year,
        yearly_event_counts,
        page_title_keys,
    )
}

_LOCAL = "CAST(timezone('America/Los_Angeles', timezone('UTC', ts)) AS DATE)"
_DAYS = f"""days AS (
  SELECT {_LOCAL} AS date, CAST(user_id AS VARCHAR) AS page_title, count(*) AS views
  FROM events WHERE event_type IN ('view', 'click', 'purchase')
    AND {_LOCAL} BETWEEN DATE '2024-01-02' AND DATE '2024-01-28'
  GROUP BY ALL
),
ranked AS (
  SELECT date, page_title, views,
         rank() OVER (PARTITION BY date ORDER BY views DESC)
         + (count(*) OVER (PARTITION BY date, views) - 1) / 2.0 AS date_view_rank
  FROM days
)"""

SQL = {
    "views_daily_local": f"""
SELECT {_LOCAL} AS date, lower(event_type) AS page_title, round(sum(value), 4) AS views
FROM events WHERE lower(event_type) IN ('view', 'click', 'purchase')
  AND {_LOCAL} BETWEEN DATE '2024-01-02' AND DATE '2024-01-28' GROUP BY ALL""",
    "views_daily_rank": f"WITH {_DAYS} SELECT * FROM ranked",
    "views_daily_rank_split": f"WITH {_DAYS} SELECT * FROM ranked",
    "views_days_at_no1": f"""WITH {_DAYS}
SELECT page_title, CAST(sum(CASE WHEN date_view_rank = 1 THEN 1 ELSE 0 END) AS BIGINT) AS num_days_no1
FROM ranked GROUP BY page_title""",
    "views_by_title_and_year": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, lower(c_mktsegment) AS page_title,
       CAST(o_orderdate AS DATE) AS date, count(*) AS views
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY ALL""",
    "yearly_event_counts": """
SELECT CAST(y.range AS INTEGER) AS year, count(o_orderkey) AS num_orders
FROM range(1994, 2003) y LEFT JOIN orders ON year(o_orderdate) = y.range GROUP BY ALL""",
    "page_title_keys": """
SELECT p_partkey, regexp_replace(lower(p_type || ' ' || p_name), ' ', '_')
       || CASE WHEN p_size > 25 THEN '_' || lower(p_brand) ELSE '' END AS page_title FROM part""",
}
