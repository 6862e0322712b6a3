"""Loading, checking and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions.times import clock_hour
from salescope.operators.series import random_split
from salescope.operators.totals import value_counts
from salescope.plans.registry import R, SALES, query, r, rounded, row_spread_sql, sql
from salescope.session import scratch_path
from salescope.sources import files
from salescope.sources.views import sales, table

SPLIT_KEYS = ("order_id", "line_no", "item_id")
UNIT = f"({row_spread_sql(*SPLIT_KEYS)} / 4294967296.0::DOUBLE)"
SPLIT_CASE = f"CASE WHEN {UNIT} < 0.8::DOUBLE THEN 'train' WHEN {UNIT} < (0.8::DOUBLE + 0.1::DOUBLE) THEN 'val' ELSE 'test' END"


@query(
    "csv_round_trip",
    sql(SALES, select=f"""
        SELECT item_size, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units, {R('sum(total_price)', 2)} AS revenue,
               CAST(min(order_date) AS VARCHAR) AS first_date, count(order_time) AS timed,
               CAST(sum(hour) AS BIGINT) AS hour_sum
        FROM sales GROUP BY item_size"""),
)
def csv_round_trip(spark, d):
    path = scratch_path(spark, "csv")
    lines = sales(spark, d, *files.REQUIRED_COLUMNS)
    files.save_csv(lines.withColumns({"quantity": F.col("quantity").cast("int"), "item_id": F.col("item_id").cast("string")}), path)
    back = files.load_csv(spark, path)
    return back.groupBy("item_size").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"), r(F.sum("total_price"), 2).alias("revenue"),
        F.min("order_date").cast("string").alias("first_date"), F.count("order_time").alias("timed"),
        F.sum(clock_hour(F.col("order_time"))).alias("hour_sum"),
    )


@query(
    "split_parquet_round_trip",
    sql(SALES, select=f"""
        SELECT {SPLIT_CASE} AS split, count(*) AS lines, {R('sum(total_price)', 2)} AS revenue FROM sales GROUP BY 1"""),
)
def split_parquet_round_trip(spark, d):
    path = scratch_path(spark, "splits")
    files.save_splits(random_split(sales(spark, d, *SPLIT_KEYS, "total_price"), SPLIT_KEYS), path)
    return files.load_parquet(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("lines"), r(F.sum("total_price"), 2).alias("revenue")
    )


@query(
    "sheet_round_trip",
    sql(SALES, select="SELECT category, count(*) AS lines, CAST(max(order_date) AS VARCHAR) AS last_date FROM sales GROUP BY category"),
)
def sheet_round_trip(spark, d):
    folder = scratch_path(spark, "workbook")
    files.export_tables({"sales": sales(spark, d, "order_id", "order_date", "category")}, folder)
    return files.load_sheet(spark, folder, "sales", "parquet").groupBy("category").agg(
        F.count(F.lit(1)).alias("lines"), F.max("order_date").cast("string").alias("last_date")
    )


@query(
    "feature_record_json",
    sql(SALES, f"t AS (SELECT {SPLIT_CASE} AS split FROM sales)", select="""
        SELECT 'total_price' AS target, 2 AS n_features, count(*) FILTER (split = 'train') AS train_samples,
               count(*) FILTER (split = 'val') AS val_samples, count(*) FILTER (split = 'test') AS test_samples FROM t"""),
)
def feature_record_json(spark, d):
    path = scratch_path(spark, "record")
    data = random_split(sales(spark, d, *SPLIT_KEYS), SPLIT_KEYS)
    files.save_json(files.feature_record(data, ["unit_price", "hour"], "total_price"), path)
    return spark.read.json(path).select("target", "n_features", "train_samples", "val_samples", "test_samples")


@query(
    "task_tables_export",
    sql(SALES, select="""
        SELECT 'category' AS task, category AS value, count(*) AS lines FROM sales GROUP BY 2
        UNION ALL SELECT 'item_size', item_size, count(*) FROM sales GROUP BY 2"""),
)
def task_tables_export(spark, d):
    folder = scratch_path(spark, "tasks")
    lines = sales(spark, d, "category", "item_size")
    tasks = ["category", "item_size"]
    files.export_tables({t: value_counts(lines, t) for t in tasks}, folder)
    first, second = (
        spark.read.parquet(f"{folder}/{t}").select(F.lit(t).alias("task"), F.col(t).alias("value"), F.col("rows").alias("lines"))
        for t in tasks
    )
    return first.unionByName(second)




@query(
    "required_column_report",
    sql(
        "t AS (SELECT l_orderkey AS order_id, l_partkey AS item_id, CASE WHEN l_tax > 0 THEN l_quantity END AS quantity, "
        "l_extendedprice AS total_price FROM lineitem)",
        select="""
        SELECT 'item_id' AS column_name, true AS present, count(*) FILTER (item_id IS NULL) AS nulls FROM t
        UNION ALL SELECT 'order_id', true, count(*) FILTER (order_id IS NULL) FROM t
        UNION ALL SELECT 'quantity', true, count(*) FILTER (quantity IS NULL) FROM t
        UNION ALL SELECT 'total_price', true, count(*) FILTER (total_price IS NULL) FROM t
        UNION ALL SELECT 'promotion', false, count(*) FROM t"""),
)
def required_column_report(spark, d):
    lines = sales(spark, d, "order_id", "item_id", "quantity", "total_price")
    taxed = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("quantity"), F.col("l_extendedprice").alias("total_price"),
    )
    found = files.null_counts(taxed, only_found=False).select("column_name", F.lit(True).alias("present"), "nulls")
    for name in files.missing_columns(lines, [*lines.columns, "promotion"]):
        found = found.unionByName(
            taxed.agg(F.count(F.lit(1)).alias("nulls")).select(F.lit(name).alias("column_name"), F.lit(False).alias("present"), "nulls")
        )
    return found


@query(
    "null_columns",
    """SELECT 'quantity' AS column_name, count(*) FILTER (l_tax <= 0) AS nulls FROM lineitem
       UNION ALL SELECT 'price', count(*) FILTER (l_discount >= 0.05) FROM lineitem""",
)
def null_columns(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_discount") < 0.05, F.col("l_extendedprice")).alias("price"),
    )
    return files.null_counts(lines)


@query(
    "sales_profile",
    sql(SALES, select=f"""
        SELECT count(*) AS total_records, count(DISTINCT order_id) AS unique_orders, count(DISTINCT item_name) AS unique_items,
               CAST(min(order_date) AS VARCHAR) AS first_date, CAST(max(order_date) AS VARCHAR) AS last_date,
               {R('sum(total_price)', 2)} AS total_revenue FROM sales"""),
)
def sales_profile(spark, d):
    return rounded(files.profile(sales(spark, d, "order_id", "item_name", "order_date", "total_price")), 2)


@query("category_counts", sql(SALES, select="SELECT category, count(*) AS rows FROM sales GROUP BY category"))
def category_counts(spark, d):
    return value_counts(sales(spark, d, "category"), "category")


@query("size_counts", sql(SALES, select="SELECT item_size, count(*) AS rows FROM sales GROUP BY item_size"))
def size_counts(spark, d):
    return value_counts(sales(spark, d, "item_size"), "item_size")


@query(
    "value_ranges",
    sql(SALES, select=f"""
        SELECT 'quantity' AS column_name, min(quantity) AS low, max(quantity) AS high FROM sales
        UNION ALL SELECT 'total_price', min(total_price), max(total_price) FROM sales
        UNION ALL SELECT 'unit_price', {R('min(unit_price)')}, {R('max(unit_price)')} FROM sales"""),
)
def value_ranges(spark, d):
    columns = ["quantity", "total_price", "unit_price"]
    return rounded(files.ranges(sales(spark, d, *columns), columns))


@query(
    "duplicate_lines",
    "SELECT l_orderkey AS order_id, l_linenumber AS line_no, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_lines(spark, d):
    return files.duplicates(sales(spark, d, "order_id", "line_no"), ["order_id", "line_no"])


@query(
    "parsed_times",
    """WITH t AS (SELECT CASE WHEN event_id % 7 = 0 THEN '25:61:00' ELSE strftime(ts, '%H:%M:%S') END AS order_time FROM events)
       SELECT CAST(CASE WHEN order_time = '25:61:00' THEN -1 ELSE CAST(substr(order_time, 1, 2) AS INTEGER) END AS INTEGER) AS hour,
              count(*) AS lines FROM t GROUP BY 1""",
)
def parsed_times(spark, d):
    raw = table(spark, d, "events").select(
        F.when(F.col("event_id") % 7 == 0, "25:61:00").otherwise(F.date_format("ts", "HH:mm:ss")).alias("order_time"),
    )
    return files.parse_dates(raw).groupBy(F.coalesce(clock_hour(F.col("order_time")), F.lit(-1)).alias("hour")).agg(
        F.count(F.lit(1)).alias("lines")
    )
