import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from salescope.functions import chain, items, seasons, times


def column(df, name):
    return [row[name] for row in df.collect()]


def test_meal_bins_are_right_closed(spark):
    hours = [0, 11, 12, 14, 15, 17, 18, 21, 22, 23]
    df = spark.createDataFrame([(h,) for h in hours], "hour int")
    got = column(df.select(times.meal_period(F.col("hour")).alias("m")), "m")
    assert got == ["Morning", "Morning", "Lunch", "Lunch", "Afternoon", "Afternoon", "Dinner", "Dinner", "Late Night", "Late Night"]


def test_bad_time_becomes_null(spark):
    df = spark.createDataFrame([("09:05:07",), ("9:5:7",), ("25:00:00",), ("noon",), (None,)], "t string")
    assert column(df.select(times.clock_hour(F.col("t")).alias("h")), "h") == [9, 9, None, None, None]
    moment = df.select(times.moment(F.lit("2024-02-29").cast("date"), F.col("t")).alias("m"))
    assert column(moment, "m")[:3] == [dt.datetime(2024, 2, 29, 9, 5, 7)] * 2 + [None]


def test_date_parts_at_the_edges(spark):
    days = ["2024-02-29", "2024-12-30", "2023-01-01", "2024-01-31"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d), "10:00:00") for d in days], "order_date date, order_time string")
    rows = times.add_time_parts(df).collect()
    assert [r["week"] for r in rows] == [9, 1, 52, 5]
    assert [r["dayofweek"] for r in rows] == [3, 0, 6, 2]
    assert [r["is_month_end"] for r in rows] == [1, 0, 0, 1]
    assert [r["is_month_start"] for r in rows] == [0, 0, 1, 0]
    assert [r["days_from_payday"] for r in rows] == [1, 0, 0, 1]
    assert rows[2]["day_name"] == "Sunday" and rows[2]["is_weekend"] == 1


def test_cycles(spark):
    df = spark.createDataFrame([(6, 3)], "hour int, day int")
    row = times.add_cycles(df, {"hour": 24, "day": 31}).first()
    assert row["hour_sin"] == pytest.approx(1) and row["hour_cos"] == pytest.approx(0, abs=1e-12)
    assert row["day_cos"] == pytest.approx(math.cos(2 * math.pi * 3 / 31))


def test_holidays_and_distance(spark):
    cases = {
        "2024-07-04": (1, "Independence Day", 0),
        "2024-11-27": (0, "None", 1),
        "2024-12-26": (0, "None", 30),
        "2021-12-31": (1, "New Year's Day (observed)", 0),
        "2021-07-05": (1, "Independence Day (observed)", 0),
        # 4 July 2020 is a Saturday, so the day before is observed
        "2020-06-19": (0, "None", 14),
        "2021-06-18": (1, "Juneteenth National Independence Day (observed)", 0),
        "2024-05-27": (1, "Memorial Day", 0),
        "1965-12-20": (0, "None", 4),
    }
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in cases], "order_date date")
    # the last date lies outside the broadcast calendar and is computed in place
    got = {str(r["order_date"]): (r["is_holiday"], r["holiday_name"], r["days_to_holiday"]) for r in seasons.add_holidays(df).collect()}
    assert got == cases


def test_spring_break_is_always_zero(spark):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(730)]
    df = spark.createDataFrame([(d, "10:00:00") for d in days], "order_date date, order_time string")
    out = seasons.add_seasons(times.add_time_parts(df))
    assert out.agg(F.max("is_spring_break")).first()[0] == 0
    assert out.where("month = 7").agg(F.min("is_too_hot"), F.min("avg_temp_estimate")).first() == (1, 106)


def test_ingredients(spark):
    rows = [("Chicken, Tomatoes, Garlic, Bacon, Red Onions",), ("chicken wings",), (None,), ("Feta, Tuna",), ("Tomatoes",)]
    df = spark.createDataFrame(rows, "ingredients string")
    out = items.add_ingredient_features(df.withColumn("n", items.ingredient_count(F.col("ingredients")))).collect()
    assert [r["n"] for r in out] == [5, 1, 0, 2, 1]
    assert [r["has_chicken"] for r in out] == [1, 0, 0, 0, 0]
    assert [r["has_meat"] for r in out] == [1, 1, 0, 0, 0]
    assert [r["is_vegetarian"] for r in out] == [0, 0, 1, 1, 1]
    assert [r["has_seafood"] for r in out] == [0, 0, 0, 1, 0]
    assert [r["has_cheese"] for r in out] == [0, 0, 0, 1, 0]
    words = sorted(column(items.vocabulary(df), "ingredient"))
    assert words == ["Bacon", "Chicken", "Feta", "Garlic", "Red Onions", "Tomatoes", "Tuna", "chicken wings"]


def test_price_quartiles_and_repeated_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8]], "unit_price double")
    got = {r["unit_price"]: r["price_bucket"] for r in items.add_price_bucket(df).collect()}
    assert [got[float(v)] for v in range(1, 9)] == ["Budget"] * 2 + ["Standard"] * 2 + ["Premium"] * 2 + ["Luxury"] * 2
    same = spark.createDataFrame([(1.0,)] * 10 + [(2.0,)], "unit_price double")
    with pytest.raises(Exception, match="bin edges must be unique"):
        items.add_price_bucket(same).collect()


def test_value_bins_and_sizes(spark):
    df = spark.createDataFrame([(0.0, "S"), (15.0, "XXL"), (15.01, "?"), (1000.0, None), (1000.5, "M")], "v double, s string")
    out = df.select(items.order_value(F.col("v")).alias("o"), items.size_rank(F.col("s")).alias("r")).collect()
    assert [r["o"] for r in out] == [None, "Small", "Medium", "Bulk", None]
    assert [r["r"] for r in out] == [1, 5, None, None, 2]


def test_one_hot_refuses_wide_columns(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert items.one_hot(df, "k", "k").columns == ["k", "k_a", "k_b", "k_c"]
    with pytest.raises(ValueError):
        items.levels(df, "k", limit=2)


def test_chain_summary_and_prefixes(spark):
    row = (1, "7", 2, dt.date(2015, 3, 4), "12:30:00", 10.0, 20.0, "M", "Veggie", "Tomatoes, Garlic", "The Green")
    other = (1, "8", 3, dt.date(2015, 3, 4), "18:30:00", 11.0, 33.0, "L", "Classic", None, "The Hawaiian")
    third = (2, "8", 1, dt.date(2015, 3, 5), "18:30:00", 12.0, 12.0, "L", "Classic", None, "The Big")
    names = ["order_id", "item_id", "quantity", "order_date", "order_time", "unit_price", "total_price", "item_size",
             "category", "ingredients", "item_name"]
    df = spark.createDataFrame([row, other, third], names)
    full = chain.add_all_features(df, ["Classic", "Veggie"])
    assert {r["feature_group"]: r["count"] for r in chain.feature_summary(full).collect()}["time_features"] == 7
    assert full.count() == 3
    assert chain.by_prefix(full.columns, ["category_", "has_meat"], ["hour", "zzz"]) == ["hour", "category_Classic", "category_Veggie", "has_meat"]
