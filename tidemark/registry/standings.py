"""Standings plans: nations' orders by priority stand for medals, sales for indicators.

Years run from 1995 to 2001; the host of a year is a fixed nation, 2001 is the open year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.prompts import FORECAST_PROMPT, forecast_prompt
from tidemark.functions.scalars import text_or_na
from tidemark.functions.stats import line_intercept, line_slope
from tidemark.operators.grouping import joined_text, with_group_totals
from tidemark.operators.joins import latest_before
from tidemark.operators.learning import regression_metrics, scale_to_total
from tidemark.operators.ranking import ONE_TASK_ROWS, five_numbers, scaled_rank, tie_ranks
from tidemark.operators.reshape import corr_matrix, densify, to_long, to_wide
from tidemark.plans import standings as plan
from tidemark.registry.common import rounded
from tidemark.session import materialize
from tidemark.sources.readers import read_table

OPEN_YEAR = 2001
TOTAL = 10_000.0
#: Rows one task may sort in the queries that force the split plans of large groups.
SPLIT_ROWS = 50


def _medal_counts() -> list:
    kinds = zip(plan.MEDALS, ("1-URGENT", "2-HIGH", "3-MEDIUM"))
    return [F.count_if(F.col("o_orderpriority") == kind).alias(medal) for medal, kind in kinds]


def _orders(spark, sf) -> DataFrame:
    return read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"), "o_orderpriority"
    )


def _customer_years(spark, sf) -> DataFrame:
    return _orders(spark, sf).groupBy("c_custkey", "year").agg(*_medal_counts())


def results(spark, sf) -> DataFrame:
    """A nation appears in a year if it won something; neighbouring nations share a group."""
    customers = read_table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = read_table(spark, sf, "nation")
    won = _orders(spark, sf).join(customers, "c_custkey").groupBy("n_nationkey", "year").agg(*_medal_counts())
    named = won.join(nations, "n_nationkey").where(F.col("gold") + F.col("silver") + F.col("bronze") > 0)
    return named.select(
        "year",
        F.concat(F.lit("NATION_"), F.col("year") - 1995).alias("host_country"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("G"), F.floor(F.col("n_nationkey") / 2).cast("string")).alias("country_group"),
        *plan.MEDALS,
    )


def _panel(spark, sf) -> DataFrame:
    return plan.panel(results(spark, sf), OPEN_YEAR)


def indicators(spark, sf) -> DataFrame:
    """Yearly sales, suppliers' lines and sales per line of each nation; few lines count as missing."""
    suppliers = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    sold = read_table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("indicator_year")).agg(
        F.sum("l_extendedprice").alias("gdp"), F.count(F.lit(1)).alias("population")
    )
    by_nation = sold.join(suppliers, "l_suppkey").groupBy("s_nationkey", "indicator_year").agg(
        F.sum("gdp").alias("gdp"), F.sum("population").alias("population")
    )
    return by_nation.select(
        F.concat(F.lit("NATION_"), "s_nationkey").alias("country_code"),
        "indicator_year",
        "gdp",
        F.when(F.col("population") >= 10, F.col("population")).alias("population"),
        (F.col("gdp") / F.col("population")).alias("gdp_per_capita"),
    )


def panel_with_indicators(spark, sf) -> DataFrame:
    rows = _panel(spark, sf).withColumn("country_code", F.col("country"))
    return plan.with_latest_indicators(materialize(rows, "panel"), plan.scaled_indicators(indicators(spark, sf)))


def medals_by_year(spark, sf):
    return _panel(spark, sf).select("year", "country", "country_group", "is_host", *plan.MEDALS, "medals")


def medals_of_one_country(spark, sf):
    """One row looked up by country and year."""
    found = _panel(spark, sf).where((F.col("country") == "NATION_3") & (F.col("year") == 1998))
    return found.select("country", "year", "medals", "medals_rk")


def medals_year_hosts(spark, sf):
    return plan.year_hosts(results(spark, sf), 2002, "NATION_7").orderBy(F.desc("year"))


def medals_group_span(spark, sf):
    return plan.group_spans(results(spark, sf))


def medals_rank_share_lag(spark, sf):
    out = _panel(spark, sf).drop(*plan.MEDALS, "is_host")
    return rounded(out, {"medal_share": 9, "medal_share_prev": 9, "medal_share_2_ago": 9})


def medals_entrants_zero_filled(spark, sf):
    """All nations as entrants of one year with those of a region missing from the medal table."""
    entrants = read_table(spark, sf, "nation").select(F.col("n_name").alias("country"), "n_regionkey")
    won = results(spark, sf).where(F.col("year") == OPEN_YEAR)
    listed = won.join(entrants.where(F.col("n_regionkey") != 3), "country", "left_semi")
    return plan.entrants_as_results(entrants.drop("n_regionkey"), listed, OPEN_YEAR, "NATION_6")


def medals_long_ranked_split(spark, sf):
    """The same with every year counted as too large for one task."""
    return medals_long_ranked(spark, sf, 5)


def medals_long_ranked(spark, sf, one_task_rows=ONE_TASK_ROWS):
    """Forecast stand-in: each year's total shared out by the previous share."""
    rows = _panel(spark, sf).withColumn("pred_medals", F.round(F.col("medal_share_prev") * F.col("yr_tot_medals"), 6))
    long = plan.long_standings(rows, one_task_rows)
    return rounded(
        long.select(
            "year", "country", "medals_field", "medals_field_order", "medals_value", "medals_value_rk",
            "medals_value_num_at_rk", "medals_value_unique_rk",
            F.regexp_extract("medals_value_rk_text", r"\n(.*)$", 1).alias("rank_text"),
        ),
        {"medals_value": 6},
    )


def forecast_labels(spark, sf):
    """The labels with their numbers, and the request about each; shares and amounts have one digit less than is shown."""
    rows = _panel(spark, sf).select(
        "year", "country", "is_host", F.round("medal_share_prev", 3).alias("pred_medal_share"),
        F.round(F.col("medal_share_prev") * F.col("yr_tot_medals"), 0).alias("pred_medals"),
    )
    ranked = rows.withColumns(tie_ranks("pred_medals", ["year"], "pred_medals")).withColumn("label", plan.forecast_text())
    prompt = forecast_prompt(F.col("year"), F.col("country"), F.col("is_host"), F.col("label"), F.lit("none"), F.when(F.col("is_host"), "French"))
    return ranked.select("year", "country", "label", F.sha2(F.encode(prompt, "UTF-8"), 256).alias("prompt_sha256"))


def medals_wide_with_text(spark, sf):
    """The long medal rows turned back to columns, and as one text per country and year."""
    ids = ["year", "country"]
    kinds = ["gold", "silver", "bronze", "medals"]
    long = materialize(to_long(_panel(spark, sf), ids, kinds, "variable", "value"), "long")
    wide = to_wide(long, ids, "variable", F.col("value"), kinds, "num_")
    line = F.concat("variable", F.lit(": "), text_or_na(F.col("value").cast("long")))
    return wide.join(joined_text(long, ids, "variable", line, "medals_text"), ids)


def persistence_forecast(spark, sf):
    """Earlier shares taken as the forecast, made to add up to each year's medals, and ranked."""
    rows = materialize(_panel(spark, sf).withColumn("share", F.coalesce("medal_share_prev", F.lit(0.0))), "persistence")
    scaled = scale_to_total(rows, "share", "yr_tot_medals", ["year"], "norm_share", "pred_medals")
    scaled = rounded(scaled, {"norm_share": 9, "pred_medals": 6})
    ranked = scaled.withColumns(tie_ranks("pred_medals", ["year"], "pred_medals"))
    return ranked.select("year", "country", "norm_share", "pred_medals", "pred_medals_rk", "pred_medals_num_at_rk")


def persistence_metrics(spark, sf):
    rows = _panel(spark, sf).where(F.col("year") >= 1997)
    return rounded(regression_metrics(rows, "medal_share", "medal_share_prev"), {"rmse": 9, "mae": 9, "rsq": 9})


def customer_year_grid(spark, sf):
    """Every customer in every year, with zeros for years without orders."""
    years = materialize(_customer_years(spark, sf).withColumnRenamed("c_custkey", "customer"), "customer-years")
    return densify(years, "year", "customer", {m: 0 for m in plan.MEDALS})


def customer_year_rank(spark, sf, one_task_rows=ONE_TASK_ROWS):
    """Customers ranked within each year by all their orders; the groups grow with the data."""
    counted = _orders(spark, sf).groupBy("c_custkey", "year").agg(F.count(F.lit(1)).alias("orders"))
    years = materialize(counted, "customer-years")
    shared = with_group_totals(years, ["year"], F.sum("orders").alias("year_orders"))
    ranked = scaled_rank(
        shared, ["year"], "orders", "order_rk", descending=True, num_at_rank="num_at_rk", one_task_rows=one_task_rows
    )
    return ranked.select("c_custkey", "year", "orders", "order_rk", "num_at_rk", "year_orders")


def customer_year_rank_split(spark, sf):
    """The same with every year counted as a large group."""
    return customer_year_rank(spark, sf, SPLIT_ROWS)


def indicators_scaled(spark, sf):
    out = plan.scaled_indicators(indicators(spark, sf)).drop("gdp", "gdp_per_capita")
    return rounded(out, {"gdp_scaled": 6, "population_scaled": 6, "gdp_per_capita_scaled": 6})


def indicators_asof(spark, sf):
    out = panel_with_indicators(spark, sf).select(
        "year", "country", "country_group", "indicator_year", "population", "gdp_scaled", "population_scaled"
    )
    return rounded(out, {"gdp_scaled": 6, "population_scaled": 6})


def events_latest_error_split(spark, sf):
    """The same with most users counted as large groups."""
    return events_latest_error(spark, sf, 2)


def events_latest_error(spark, sf, one_task_rows=ONE_TASK_ROWS):
    """Each purchase with the user's latest error strictly before it."""
    events = read_table(spark, sf, "events")
    purchases = events.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("bought_at"), "event_id")
    errors = events.where(F.col("event_type") == "error").select(
        "user_id", F.col("ts").alias("failed_at"), F.col("value").alias("error_value")
    )
    return latest_before(purchases, errors, ["user_id"], "bought_at", "failed_at", one_task_rows=one_task_rows)


def _analysed(spark, sf) -> DataFrame:
    return plan.analysis_rows(panel_with_indicators(spark, sf), 1996, 2000)


def numeric_corr_matrix(spark, sf):
    rows = _analysed(spark, sf)
    return rounded(corr_matrix(rows, plan.correlated_columns(rows)), {"corr": 6})


def share_change_quartiles(spark, sf):
    rows = _analysed(spark, sf).withColumn("share_change", F.col("medal_share") - F.col("medal_share_prev"))
    boxes = five_numbers(rows, ["is_host"], "share_change")
    return rounded(boxes, {c: 9 for c in ("min", "q1", "median", "q3", "max")})


def order_price_quartiles(spark, sf):
    """Quartiles of order totals per priority over the whole table."""
    boxes = five_numbers(read_table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice")
    return rounded(boxes, {c: 4 for c in ("min", "q1", "median", "q3", "max")})


def share_trend_line(spark, sf):
    inliers = _analysed(spark, sf).where(F.abs("population_scaled") <= 4)
    line = inliers.agg(
        line_slope("medal_share", "population_scaled").alias("slope"),
        line_intercept("medal_share", "population_scaled").alias("intercept"),
        F.count("population_scaled").alias("num_rows"),
    )
    return rounded(line, {"slope": 8, "intercept": 8})


def model_split_counts(spark, sf):
    rows = plan.model_rows(panel_with_indicators(spark, sf), 1996, 1999, OPEN_YEAR, TOTAL)
    return rows.groupBy("split", "split_order").agg(
        F.count(F.lit(1)).alias("num_rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year")
    )


QUERIES = {
    f.__name__: f
    for f in (
        medals_by_year, medals_of_one_country, medals_year_hosts, medals_group_span, medals_rank_share_lag, medals_entrants_zero_filled,
        medals_long_ranked, medals_long_ranked_split, forecast_labels, medals_wide_with_text, persistence_forecast, persistence_metrics, customer_year_grid, customer_year_rank, customer_year_rank_split,
        indicators_scaled, indicators_asof, events_latest_error, events_latest_error_split, numeric_corr_matrix, share_change_quartiles, order_price_quartiles, share_trend_line,
        model_split_counts,
    )
}

_RESULTS = """
cy AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         count(*) FILTER (o_orderpriority = '1-URGENT') AS gold,
         count(*) FILTER (o_orderpriority = '2-HIGH') AS silver,
         count(*) FILTER (o_orderpriority = '3-MEDIUM') AS bronze
  FROM orders GROUP BY ALL
),
results AS (
  SELECT year, 'NATION_' || (year - 1995) AS host_country, n_name AS country,
         'G' || (n_nationkey // 2) AS country_group,
         CAST(sum(gold) AS BIGINT) AS gold, CAST(sum(silver) AS BIGINT) AS silver, CAST(sum(bronze) AS BIGINT) AS bronze
  FROM cy JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY year, n_name, n_nationkey HAVING sum(gold) + sum(silver) + sum(bronze) > 0
),
spans AS (
  SELECT country_group, min(year) AS first_year, max(year) AS last_year,
         arg_max(country, year::VARCHAR || country) AS last_country
  FROM results GROUP BY country_group
)"""
_PANEL = (
    _RESULTS
    + """,
grid AS (
  SELECT y.year, g.country_group FROM (SELECT DISTINCT year FROM results) y, (SELECT DISTINCT country_group FROM results) g
),
dense AS (
  SELECT grid.year, grid.country_group, coalesce(r.country, last_country) AS country,
         coalesce(r.host_country = r.country, FALSE) AS is_host,
         CASE WHEN r.gold IS NULL AND grid.year < 2001 THEN 0 ELSE r.gold END AS gold,
         CASE WHEN r.silver IS NULL AND grid.year < 2001 THEN 0 ELSE r.silver END AS silver,
         CASE WHEN r.bronze IS NULL AND grid.year < 2001 THEN 0 ELSE r.bronze END AS bronze
  FROM grid LEFT JOIN results r ON r.year = grid.year AND r.country_group = grid.country_group
  JOIN spans ON spans.country_group = grid.country_group
  WHERE grid.year BETWEEN first_year AND last_year
),
totals AS (SELECT *, gold + silver + bronze AS medals FROM dense),
shares AS (
  SELECT *,
    CASE WHEN medals IS NOT NULL THEN rank() OVER (PARTITION BY year ORDER BY medals DESC NULLS LAST) END AS medals_rk,
    CASE WHEN medals IS NOT NULL THEN count(*) OVER (PARTITION BY year, medals) END AS medals_num_at_rk,
    CASE WHEN count(*) OVER (PARTITION BY year) = count(medals) OVER (PARTITION BY year)
         THEN CAST(sum(medals) OVER (PARTITION BY year) AS BIGINT) END AS yr_tot_medals
  FROM totals
),
panel0 AS (SELECT *, medals / nullif(yr_tot_medals, 0) AS medal_share FROM shares),
panel AS (
  SELECT *, lag(medal_share, 1) OVER w AS medal_share_prev, lag(medal_share, 2) OVER w AS medal_share_2_ago
  FROM panel0 WINDOW w AS (PARTITION BY country_group ORDER BY year, country)
)"""
)
_INDICATORS = """
ind0 AS (
  SELECT 'NATION_' || s_nationkey AS country_code, CAST(year(l_shipdate) AS INTEGER) AS indicator_year,
         sum(l_extendedprice) AS gdp, count(*) AS n
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL
),
ind AS (
  SELECT country_code, indicator_year, gdp, CASE WHEN n >= 10 THEN n END AS population, gdp / n AS gdp_per_capita FROM ind0
),
scaled AS (
  SELECT *,
    (gdp - avg(gdp) OVER w) / nullif(stddev_samp(gdp) OVER w, 0) AS gdp_scaled,
    (population - avg(population) OVER w) / nullif(stddev_samp(population) OVER w, 0) AS population_scaled,
    (gdp_per_capita - avg(gdp_per_capita) OVER w) / nullif(stddev_samp(gdp_per_capita) OVER w, 0) AS gdp_per_capita_scaled
  FROM ind WINDOW w AS (PARTITION BY indicator_year)
)"""
_ASOF = (
    _PANEL
    + ","
    + _INDICATORS
    + """,
joined AS (
  SELECT p.*, s.indicator_year, s.gdp, s.population, s.gdp_per_capita, s.gdp_scaled, s.population_scaled,
         s.gdp_per_capita_scaled
  FROM panel p ASOF LEFT JOIN scaled s ON p.country = s.country_code AND p.year > s.indicator_year
),
analysed AS (
  SELECT * REPLACE (coalesce(medal_share_prev, 0) AS medal_share_prev, coalesce(medal_share_2_ago, 0) AS medal_share_2_ago)
  FROM joined WHERE year BETWEEN 1996 AND 2000
)"""
)


def _box(keys: str, value: str, table: str, places: int) -> str:
    picks = ", ".join(
        f"round(quantile_cont({value}, {q}), {places}) + 0.0 AS {name}"
        for q, name in ((0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1, "max"))
    )
    return f"SELECT {keys}, count({value}) AS n, {picks} FROM {table} GROUP BY {keys}"


_LONG_FIELDS = {
    "gold": "gold", "silver": "silver", "bronze": "bronze", "total": "medals", "predicted": "pred", "total_vs_predicted": "medals - pred",
}

_YEAR_RANK = """
WITH s AS (
  SELECT o_custkey AS c_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders GROUP BY ALL
)
SELECT c_custkey, year, orders, rank() OVER (PARTITION BY year ORDER BY orders DESC) AS order_rk,
       count(*) OVER (PARTITION BY year, orders) AS num_at_rk,
       CAST(sum(orders) OVER (PARTITION BY year) AS BIGINT) AS year_orders FROM s"""
_LATEST_ERROR = """
SELECT p.user_id, p.ts AS bought_at, p.event_id, e.ts AS failed_at, e.value AS error_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e ON p.user_id = e.user_id AND p.ts > e.ts"""
_NUMBERS = """gold silver bronze medals medals_rk medals_num_at_rk yr_tot_medals medal_share medal_share_prev
    medal_share_2_ago gdp population gdp_per_capita gdp_scaled population_scaled gdp_per_capita_scaled""".split()
_PAIRS = [(a, b) for a in _NUMBERS for b in _NUMBERS]


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


_LONG_RANKED = (
    f"""WITH {_PANEL},
pred AS (SELECT *, round(medal_share_prev * yr_tot_medals, 6) AS pred FROM panel),
long AS ("""
    + " UNION ALL ".join(
        f"SELECT year, country, '{name}' AS medals_field, {i} AS medals_field_order, CAST({expr} AS DOUBLE) AS v FROM pred"
        for i, (name, expr) in enumerate(_LONG_FIELDS.items(), 1)
    )
    + """),
ranked AS (
  SELECT *, CASE WHEN v IS NOT NULL THEN rank() OVER (PARTITION BY year, medals_field ORDER BY v DESC NULLS LAST) END AS rk,
    CASE WHEN v IS NOT NULL THEN count(*) OVER (PARTITION BY year, medals_field, v) END AS num,
    row_number() OVER (PARTITION BY year, medals_field ORDER BY v DESC NULLS LAST, country) AS urk
  FROM long
)
SELECT year, country, medals_field, medals_field_order, round(v, 6) + 0.0 AS medals_value, rk AS medals_value_rk,
       num AS medals_value_num_at_rk, urk AS medals_value_unique_rk,
       CASE WHEN v IS NOT NULL THEN rk || CASE WHEN rk % 100 BETWEEN 11 AND 13 THEN 'th' WHEN rk % 10 = 1 THEN 'st'
            WHEN rk % 10 = 2 THEN 'nd' WHEN rk % 10 = 3 THEN 'rd' ELSE 'th' END
            || CASE WHEN num > 1 THEN ' (tied)' ELSE '' END END AS rank_text
FROM ranked"""
)

SQL = {
    "medals_by_year": f"""WITH {_PANEL}
SELECT year, country, country_group, is_host, gold, silver, bronze, medals FROM panel""",
    "medals_of_one_country": f"""WITH {_PANEL}
SELECT country, year, medals, medals_rk FROM panel WHERE country = 'NATION_3' AND year = 1998""",
    "medals_year_hosts": f"""WITH {_RESULTS}
SELECT DISTINCT year, host_country FROM results UNION SELECT 2002, 'NATION_7'""",
    "medals_group_span": f"WITH {_RESULTS} SELECT * FROM spans",
    "medals_rank_share_lag": f"""WITH {_PANEL}
SELECT year, country, country_group, medals, medals_rk, medals_num_at_rk, yr_tot_medals,
       round(medal_share, 9) AS medal_share, round(medal_share_prev, 9) AS medal_share_prev,
       round(medal_share_2_ago, 9) AS medal_share_2_ago FROM panel""",
    "medals_entrants_zero_filled": f"""WITH {_RESULTS}
SELECT n_name AS country, coalesce(gold, 0) AS gold, coalesce(silver, 0) AS silver, coalesce(bronze, 0) AS bronze,
       2001 AS year, 'NATION_6' AS host_country
FROM nation LEFT JOIN results ON n_name = country AND year = 2001 AND n_regionkey <> 3""",
    "medals_long_ranked": _LONG_RANKED,
    "medals_long_ranked_split": _LONG_RANKED,
    "forecast_labels": f"""WITH {_PANEL},
p AS (SELECT year, country, is_host, round(medal_share_prev, 3) AS s, round(medal_share_prev * yr_tot_medals, 0) AS m FROM panel),
r AS (SELECT *, rank() OVER (PARTITION BY year ORDER BY m DESC NULLS LAST) AS rk, count(*) OVER (PARTITION BY year, m) AS num FROM p),
t AS (
  SELECT year, country, is_host, year || ' ' || country || chr(10) || 'Predicted Medal Share: ' || coalesce(printf('%.2f', s * 100), 'NA') || '%' || chr(10)
    || 'Predicted Medals: ' || coalesce(printf('%.1f', m), 'NA') || chr(10) || 'Predicted Medals Rank: '
    || CASE WHEN m IS NULL THEN 'NA' ELSE rk || CASE WHEN num > 1 THEN ' (' || num || ' tied)' ELSE '' END END AS label FROM r
)
SELECT year, country, label, sha256(printf({_quoted(FORECAST_PROMPT)}, CAST(year AS VARCHAR), country,
  CASE WHEN is_host THEN 'French' ELSE 'English' END, label, 'none')
  || CASE WHEN is_host THEN 'Mention what hosting means for ' || country || '.' || chr(10) ELSE '' END) AS prompt_sha256 FROM t""",
    "medals_wide_with_text": f"""WITH {_PANEL}
SELECT year, country, CAST(gold AS DOUBLE) AS num_gold, CAST(silver AS DOUBLE) AS num_silver,
       CAST(bronze AS DOUBLE) AS num_bronze, CAST(medals AS DOUBLE) AS num_medals,
       'bronze: ' || coalesce(CAST(bronze AS VARCHAR), 'NA') || chr(10) || 'gold: ' || coalesce(CAST(gold AS VARCHAR), 'NA') || chr(10)
       || 'medals: ' || coalesce(CAST(medals AS VARCHAR), 'NA') || chr(10) || 'silver: ' || coalesce(CAST(silver AS VARCHAR), 'NA')
       AS medals_text FROM panel""",
    "persistence_forecast": f"""WITH {_PANEL},
s AS (SELECT *, coalesce(medal_share_prev, 0) AS share FROM panel),
n AS (SELECT *, share / nullif(sum(share) OVER (PARTITION BY year), 0) AS ns FROM s),
p AS (SELECT *, round(ns, 9) AS norm_share, round(ns * yr_tot_medals, 6) AS pred_medals FROM n)
SELECT year, country, norm_share, pred_medals,
       CASE WHEN pred_medals IS NOT NULL THEN rank() OVER (PARTITION BY year ORDER BY pred_medals DESC NULLS LAST) END AS pred_medals_rk,
       CASE WHEN pred_medals IS NOT NULL THEN count(*) OVER (PARTITION BY year, pred_medals) END AS pred_medals_num_at_rk FROM p""",
    "persistence_metrics": f"""WITH {_PANEL},
r AS (SELECT medal_share AS t, medal_share_prev AS e FROM panel
      WHERE year >= 1997 AND medal_share IS NOT NULL AND medal_share_prev IS NOT NULL)
SELECT round(sqrt(avg((t - e) * (t - e))), 9) AS rmse, round(avg(abs(t - e)), 9) AS mae,
       round(corr(t, e) * corr(t, e), 9) AS rsq, count(*) AS num_rows FROM r""",
    "customer_year_grid": f"""WITH {_RESULTS}
SELECT y.year, c.o_custkey AS customer, coalesce(gold, 0) AS gold, coalesce(silver, 0) AS silver, coalesce(bronze, 0) AS bronze
FROM (SELECT DISTINCT year FROM cy) y CROSS JOIN (SELECT DISTINCT o_custkey FROM cy) c
LEFT JOIN cy ON cy.year = y.year AND cy.o_custkey = c.o_custkey""",
    "customer_year_rank": _YEAR_RANK,
    "customer_year_rank_split": _YEAR_RANK,
    "indicators_scaled": f"""WITH {_INDICATORS}
SELECT country_code, indicator_year, population, round(gdp_scaled, 6) + 0.0 AS gdp_scaled,
       round(population_scaled, 6) + 0.0 AS population_scaled,
       round(gdp_per_capita_scaled, 6) + 0.0 AS gdp_per_capita_scaled FROM scaled""",
    "indicators_asof": f"""WITH {_ASOF}
SELECT year, country, country_group, indicator_year, population, round(gdp_scaled, 6) + 0.0 AS gdp_scaled,
       round(population_scaled, 6) + 0.0 AS population_scaled FROM joined""",
    "events_latest_error": _LATEST_ERROR,
    "events_latest_error_split": _LATEST_ERROR,
    "numeric_corr_matrix": f"""WITH {_ASOF},
lists AS (
  SELECT [{", ".join(f"'{a}'" for a, _ in _PAIRS)}] AS a, [{", ".join(f"'{b}'" for _, b in _PAIRS)}] AS b,
         [{", ".join(f"corr({a}, {b})" for a, b in _PAIRS)}] AS c FROM analysed
),
cells AS (SELECT unnest(a) AS column_1, unnest(b) AS column_2, unnest(c) AS c FROM lists)
SELECT column_1, column_2, CASE WHEN NOT isnan(c) THEN round(c, 6) + 0.0 END AS corr FROM cells""",
    "share_change_quartiles": f"""WITH {_ASOF}, c AS (SELECT *, medal_share - medal_share_prev AS share_change FROM analysed)
{_box("is_host", "share_change", "c", 9)}""",
    "order_price_quartiles": _box("o_orderpriority", "o_totalprice", "orders", 4),
    "share_trend_line": f"""WITH {_ASOF}
SELECT round(regr_slope(medal_share, population_scaled), 8) + 0.0 AS slope,
       round(regr_intercept(medal_share, population_scaled), 8) + 0.0 AS intercept, count(population_scaled) AS num_rows
FROM analysed WHERE abs(population_scaled) <= 4""",
    "model_split_counts": f"""WITH {_ASOF}
SELECT CASE WHEN year < 1999 THEN 'Train' WHEN year < 2001 THEN 'Test' ELSE 'Prediction' END AS split,
       CASE WHEN year < 1999 THEN 0 WHEN year < 2001 THEN 1 ELSE 2 END AS split_order,
       count(*) AS num_rows, min(year) AS first_year, max(year) AS last_year
FROM joined WHERE year BETWEEN 1996 AND 2001 GROUP BY ALL""",
}
