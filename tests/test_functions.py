import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import prompts, scalars, stats


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    data = [tuple(v for _, v in values.values())] if values else [(1,)]
    return spark.createDataFrame(data, schema).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "name, suffix, wanted",
    [
        ("Ola Brandt", None, "ola_brandt"),
        ("Tomas Vel Jr.", None, "tomas_vel jr."),
        ("Mira Stone", "(pitcher)", "mira_stone_(pitcher)"),
        ("Zuno", None, "zuno"),
    ],
)
def test_page_key_replaces_first_space_only(spark, name, suffix, wanted):
    assert one(spark, scalars.page_key("n", "s"), n=("string", name), s=("string", suffix)) == wanted


@pytest.mark.parametrize(
    "rank, wanted",
    [(1, "1st"), (2, "2nd"), (3, "3rd"), (4, "4th"), (11, "11th"), (12, "12th"), (13, "13th"), (21, "21st"), (111, "111th")],
)
def test_ordinal(spark, rank, wanted):
    assert one(spark, scalars.ordinal("r"), r=("long", rank)) == wanted


def test_local_day_crosses_midnight(spark):
    stamp = dt.datetime(2020, 1, 1, 7, 59)
    assert one(spark, scalars.local_day("t", "America/Los_Angeles"), t=("timestamp_ntz", stamp)) == dt.date(2019, 12, 31)
    inside = scalars.in_local_days("t", "America/Los_Angeles", dt.date(2019, 12, 31), dt.date(2019, 12, 31))
    assert one(spark, inside, t=("timestamp_ntz", stamp)) is True
    assert one(spark, inside, t=("timestamp_ntz", dt.datetime(2020, 1, 1, 8, 0))) is False


def test_complete_months_only(spark):
    keep = scalars.before_month_of("d", dt.date(2020, 5, 17))
    assert one(spark, keep, d=("date", dt.date(2020, 4, 30))) is True
    assert one(spark, keep, d=("date", dt.date(2020, 5, 1))) is False


def test_month_texts(spark):
    day = dt.date(2021, 3, 9)
    assert one(spark, scalars.month_key("d"), d=("date", day)) == "2021-03"
    assert one(spark, scalars.day_label("d"), d=("date", day)) == "Mar 09, 2021"
    assert one(spark, scalars.month_start("m"), m=("string", "2021-03")) == dt.date(2021, 3, 1)


@pytest.mark.parametrize("text, wanted", [("..", None), (" .. ", None), ("12.5", 12.5), ("x", None), (None, None)])
def test_parse_number(spark, text, wanted):
    assert one(spark, scalars.parse_number("t", "double"), t=("string", text)) == wanted


def test_json_scalar_gives_no_objects(spark):
    text = '{"candidates": [{"content": {"parts": [{"text": "hi"}]}}]}'
    assert one(spark, scalars.json_scalar("j", "$.candidates[0].content.parts[0].text"), j=("string", text)) == "hi"
    assert one(spark, scalars.json_scalar("j", "$.candidates"), j=("string", text)) is None
    for answer in ("[Note] hi", "{x} hi"):
        assert one(spark, scalars.json_scalar("j", "$.a"), j=("string", '{"a": "%s"}' % answer)) == answer


def test_first_match_label_takes_first(spark):
    label = scalars.first_match_label("t", scalars.DRINK_CATEGORY_RULES)
    assert one(spark, label, t=("string", "Straight Bourbon Whiskies")) == "Whiskey"
    assert one(spark, label, t=("string", "Imported Gin")) is None


def test_labels_and_texts(spark):
    assert one(spark, scalars.code_label("c", {"a": "Alpha"}), c=("string", "a")) == "Alpha"
    assert one(spark, scalars.code_label("c", {"a": "Alpha"}), c=("string", "b")) is None
    assert one(spark, scalars.null_if_text("t", "none."), t=("string", " none. ")) is None
    assert one(spark, scalars.word_tokens("t"), t=("string", "80 Proof Rum-Punch")) == ["proof", "rum", "punch"]
    assert one(spark, scalars.suffix_if_present("\n", "t"), t=("string", None)) == ""
    assert one(spark, scalars.tied_note("n", True), n=("long", 3)) == " (3 tied)"
    assert one(spark, scalars.tied_note("n", False), n=("long", 1)) == ""
    assert one(spark, scalars.file_name("y", "c", extension="png"), y=("int", 2024), c=("string", "New Land")) == "2024_New_Land.png"
    assert one(spark, scalars.text_or_na("v"), v=("double", None)) == "NA"


def test_prompts_handle_missing_fields(spark):
    spark.createDataFrame([("n", None, "d", None)], "n string, s string, d string, r string").createOrReplaceTempView("p")
    prompts.register_sql_functions(spark)
    made = spark.table("p").select(
        prompts.description_prompt("n", "s", "d"), F.expr("description_prompt(n, s, d)"), prompts.review_prompt("r"), F.expr("review_prompt(r)"),
        F.expr("review_prompt('good')"), prompts.review_prompt(F.lit("good")), prompts.alt_text_prompt(), F.expr("alt_text_prompt()"),
    ).first()
    assert made[0] == made[1] and "Name: n\nSubhead: \nDescription: d" in made[0]
    assert made[2] is None and made[3] is None
    assert made[4] == made[5] and made[6] == made[7]


def test_forecast_prompt_language_and_host(spark):
    text = prompts.forecast_prompt(F.lit(2024), F.lit("A"), F.lit(True), F.lit("f"), F.lit("i"), F.lit(None).cast("string"))
    made = one(spark, text)
    assert "in English" in made and "hosting means for A" in made


def test_safe_corr_masks_and_constant(spark):
    data = [(1, 1.0, 2.0), (1, 2.0, 4.5), (1, 3.0, 5.0), (1, 100.0, None), (1, None, 50.0), (2, 1.0, 7.0), (2, 2.0, 7.0)]
    df = spark.createDataFrame(data, "g int, x double, y double")
    got = {r["g"]: r["c"] for r in df.groupBy("g").agg(stats.safe_corr("x", "y").alias("c")).collect()}
    xs, ys = [1.0, 2.0, 3.0], [2.0, 4.5, 5.0]
    mx, my = sum(xs) / 3, sum(ys) / 3
    top = sum((a - mx) * (b - my) for a, b in zip(xs, ys))
    low = math.sqrt(sum((a - mx) ** 2 for a in xs) * sum((b - my) ** 2 for b in ys))
    assert got[1] == pytest.approx(top / low) and got[2] is None


def test_sums_and_ratios(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, 3.0), ("b", 4.0, 0.0)], "g string, x double, w double")
    got = {
        r["g"]: r
        for r in df.groupBy("g").agg(
            stats.strict_sum("x").alias("s"), stats.weighted_mean("x", "w").alias("m"), stats.sum_if(F.col("w") > 2, "w").alias("i")
        ).collect()
    }
    assert got["a"]["s"] is None and got["b"]["s"] == 4.0
    assert got["a"]["m"] == pytest.approx(2.0 / 5.0) and got["b"]["m"] is None
    assert got["a"]["i"] == 3.0


def test_regression_figures(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (4.0, 5.0)], "t double, e double")
    r = df.agg(stats.rmse("t", "e").alias("r"), stats.mae("t", "e").alias("m"), stats.squared_corr("t", "e").alias("q")).first()
    assert r["r"] == pytest.approx(math.sqrt((0.25 + 0.25 + 1) / 3)) and r["m"] == pytest.approx(2 / 3)
    assert 0 < r["q"] < 1
