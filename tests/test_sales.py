import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescope.operators import outlook, totals
from salescope.operators.ordered import one_row
from salescope.sources import files


def daily(spark, values, start="2024-01-01"):
    first = dt.date.fromisoformat(start)
    rows = [(first + dt.timedelta(days=i), float(v), float(v) / 2) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "order_date date, revenue double, units double")


def test_mode_ties_take_the_smallest(spark):
    rows = [("x", "M", "c", 1.0, "i1"), ("x", "L", "c", 3.0, "i1"), ("x", "M", "d", 2.0, "i0"), ("x", "L", "d", 2.0, "i0")]
    df = spark.createDataFrame(rows, "item_name string, item_size string, category string, unit_price double, ingredients string")
    got = totals.product_identity(df).first()
    assert (got["item_size"], got["category"], got["unit_price"], got["ingredients"]) == ("L", "c", 2.0, "i0")


def test_growth_and_default(spark):
    long = outlook.weekly_growth(daily(spark, [10] * 28 + [20] * 28)).first()
    assert (long["weeks"], long["growth"]) == (8, 1.0)
    short = outlook.weekly_growth(daily(spark, [10] * 42)).first()
    assert (short["weeks"], short["growth"]) == (6, 0.05)
    over_new_year = outlook.weekly_growth(daily(spark, [10] * 28 + [30] * 28, "2023-12-04")).first()
    assert over_new_year["growth"] == 2.0


def test_forecast(spark):
    days = daily(spark, [100 + 10 * (i % 7) for i in range(28)])
    got = outlook.weekday_forecast(days, 7).orderBy("order_date").collect()
    assert [r["predicted_revenue"] for r in got] == pytest.approx([100 + 10 * i for i in range(7)])
    assert got[0]["day_name"] == "Monday" and got[0]["predicted_units"] == pytest.approx(50)
    summary = outlook.forecast_summary(days, outlook.weekday_forecast(days, 7)).first()
    assert summary["trend_pct"] == 0 and summary["next_week"] == pytest.approx(910)


def test_staffing(spark):
    cells = spark.createDataFrame(
        [("Monday", 9, 100.0, 1.0), ("Monday", 10, 140.0, 1.0), ("Tuesday", 9, 60.0, 1.0)], "day_name string, hour int, revenue double, units double"
    )
    growth = F.lit(0.5)
    plan = outlook.staffing_plan(cells, growth)
    assert sorted(r["predicted_staff"] for r in plan.collect()) == [3, 5, 8]
    budget = outlook.staffing_budget(plan, growth, 14).first()
    assert (budget["period_hours"], budget["labor_cost"], budget["busiest_day"]) == (32, 480, "Monday")
    assert budget["advice"] == "hire" and budget["extra_people"] == 0
    levels = {r["hour"]: r["staff_level"] for r in outlook.staffing_by_hour(plan).collect()}
    assert levels == {9: "Normal Staffing", 10: "High Staffing"}


def test_advice(spark):
    df = spark.createDataFrame([(4.0,), (26.0,), (100.0,)], "prediction double")
    got = [tuple(r)[1:] for r in outlook.demand_advice(df).collect()]
    assert got == [(3, 4, 60.0, "Low"), (5, 31, 390.0, "Moderate"), (10, 120, 1500.0, "High")]


def test_pareto_and_quadrants(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 30.0), ("c", 10.0), ("d", 10.0)], "item_name string, revenue double")
    ranked = outlook.pareto(df)
    assert [r["item_name"] for r in ranked.orderBy("rank").collect()] == ["a", "b", "c", "d"]
    head = outlook.pareto_head(ranked).first()
    assert (head["head_products"], head["head_share"]) == (2, 0.5)
    four = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 9.0), ("c", 9.0, 1.0), ("d", 9.0, 9.0)], "item_name string, unit_price double, units double")
    assert {r["item_name"]: r["quadrant"] for r in outlook.quadrants(four).collect()} == {
        "a": "Underperformer", "b": "Value Star", "c": "Premium Niche", "d": "Premium Star"
    }


def test_segments_and_histogram(spark):
    rows = [(f"p{i}", i % 2, 10.0 + 10 * (i % 2), 5.0 + i, 1.0, 7) for i in range(12)]
    df = spark.createDataFrame(rows, "item_name string, cluster int, unit_price double, units double, revenue double, ingredient_count int")
    names = {r["cluster"]: r["segment"] for r in totals.name_segments(totals.segment_summary(df)).collect()}
    assert names == {0: "Value Gourmet (Specialty)", 1: "Premium Gourmet (High-Volume)"}
    shown = {r["cluster"]: r["items"] for r in totals.cluster_overview(df).collect()}
    assert shown[0] == "p0, p10, p2, p4, p6..."
    bins = {r["bin"]: r["rows"] for r in totals.histogram(spark.createDataFrame([(float(i),) for i in range(41)], "v double"), "v", 20).collect()}
    assert sum(bins.values()) == 41 and bins[19] == 3 and bins[0] == 2


def test_heatmap_fills_and_orders(spark):
    cells = spark.createDataFrame([("Sunday", 9, 1.0), ("Monday", 10, 2.0)], "day_name string, hour int, revenue double")
    rows = totals.heatmap(cells, "revenue", [9, 10]).orderBy("day_order").collect()
    assert [tuple(r) for r in rows] == [(0, "Monday", 0.0, 2.0), (6, "Sunday", 1.0, 0.0)]


def test_keep_filters(spark):
    df = spark.createDataFrame([("a", "S"), ("b", "S")], "category string, item_size string")
    assert totals.keep(df, category="All", item_size="S").count() == 2
    assert totals.keep(df, category="a").count() == 1


def test_csv_source(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        "oid,item,qty,order_date,order_time,unit_price,total_price,size,category,ingredients,name\n"
        '1,7,2,2015-01-02,11:38:36,10.5,21,M,Classic,"Ham, Cheese",The Hawaiian\n'
        '2,8,x,2015-13-02,99:00:00,bad,12,L,Veggie,,The Green\n'
    )
    rows = files.load_csv(spark, str(path)).orderBy("order_id").collect()
    assert rows[0]["order_date"] == dt.date(2015, 1, 2) and rows[0]["order_time"] == "11:38:36"
    assert (rows[1]["quantity"], rows[1]["order_date"], rows[1]["order_time"], rows[1]["unit_price"]) == (None, None, None, None)


def test_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "order_id int, item_name string")
    assert files.missing_columns(df, ["order_id", "quantity"]) == ["quantity"]
    with pytest.raises(ValueError, match="quantity"):
        files.missing_columns(df, ["quantity"], strict=True)
    assert [tuple(r) for r in files.null_counts(df).collect()] == [("item_name", 1)]
    assert files.duplicates(df, ["order_id"]).first()["copies"] == 2


def test_database_options():
    plain = files.jdbc_options("jdbc:x", "SELECT 1", user="u")
    assert plain == {"url": "jdbc:x", "user": "u", "query": "SELECT 1"}
    parted = files.jdbc_options("jdbc:x", "SELECT 1", "id", 0, 100, 8)
    assert parted["dbtable"] == "(SELECT 1) q" and parted["numPartitions"] == "8"
    with pytest.raises(ValueError):
        files.jdbc_options("jdbc:x", "SELECT 1", "id")


def test_scalar_growth_column(spark):
    days = daily(spark, [1] * 56)
    assert days.limit(1).select(one_row(outlook.weekly_growth(days))["growth"].alias("g")).first()["g"] == 0


def test_identity_reads_the_items_once(spark, tmp_path):
    from salescope.plans.totals import identity

    rows = [("a", "S", "x", "p, q", 2, 10.0), ("a", "L", "x", "p, q", 3, 30.0), ("b", "S", "y", "r", 1, 7.0)]
    spark.createDataFrame(rows, "item_name string, item_size string, category string, ingredients string, lines long, unit_price_sum double").write.parquet(
        f"{tmp_path}/items")
    got = identity(spark.read.parquet(f"{tmp_path}/items"))
    assert not got.inputFiles()  # all is made from the fixed cells
    assert sorted(tuple(r) for r in got.collect()) == [("a", 8.0, "L", "x", "p, q"), ("b", 7.0, "S", "y", "r")]
