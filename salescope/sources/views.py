"""Sales views over the order tables (one row per order line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _clock() -> Column:
    """The order tables keep no time of day; one is derived from the order key."""
    key = F.col("l_orderkey")
    parts = [9 + key % 14, key % 60, (key * 7) % 60]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def _size() -> Column:
    s = F.col("p_size")
    return (
        F.when(s <= 10, "S").when(s <= 20, "M").when(s <= 30, "L").when(s <= 40, "XL").otherwise("XXL")
    )


LINE = {
    "order_id": lambda: F.col("l_orderkey"),
    "item_id": lambda: F.col("l_partkey"),
    "line_no": lambda: F.col("l_linenumber"),
    "quantity": lambda: F.col("l_quantity"),
    "total_price": lambda: F.col("l_extendedprice"),
    "unit_price": lambda: F.try_divide("l_extendedprice", "l_quantity"),
    "order_time": _clock,
}
ORDER = {
    "order_date": lambda: F.to_date("o_orderdate"),
    "customer_id": lambda: F.col("o_custkey"),
}
ITEM = {
    "item_name": lambda: F.col("p_name"),
    "brand": lambda: F.col("p_brand"),
    "category": lambda: F.col("p_type"),
    "item_size": _size,
    "ingredients": lambda: F.replace(F.col("p_name"), F.lit(" "), F.lit(", ")),
}
ALL_COLUMNS = [*LINE, *ORDER, *ITEM]


def sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Sales lines with the asked columns; a dimension is joined only when one of its columns is used."""
    wanted = list(columns) or ALL_COLUMNS
    df = table(spark, folder, "lineitem")
    if any(c in ORDER for c in wanted):
        df = df.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if any(c in ITEM for c in wanted):
        df = df.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    known = {**LINE, **ORDER, **ITEM}
    return df.select(*[known[c]().alias(c) for c in wanted])


def item_sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Per item id: quantity, total_price, lines and unit_price_sum, with item columns attached.

    Lines collapse to one row per item id before the item table is joined.
    """
    per_item = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.sum("l_extendedprice").alias("total_price"),
            F.count(F.lit(1)).alias("lines"),
            F.sum(F.try_divide("l_extendedprice", "l_quantity")).alias("unit_price_sum"),
        )
    )
    joined = per_item.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("l_partkey").alias("item_id"), "quantity", "total_price", "lines", "unit_price_sum",
        *[ITEM[c]().alias(c) for c in columns],
    )


def order_sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Per order: revenue, units and lines, with order columns attached.

    Lines collapse to one row per order on the key the join needs anyway, so the line table is shuffled
    once and distinct orders become plain row counts.
    """
    per_order = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_extendedprice").alias("revenue"), F.sum("l_quantity").alias("units"), F.count(F.lit(1)).alias("lines")
        )
    )
    joined = per_order.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    known = {**LINE, **ORDER}
    return joined.select("revenue", "units", "lines", *[known[c]().alias(c) for c in columns])


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The event log read as sales lines with a real time of day."""
    return table(spark, folder, "events").select(
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.col("user_id").alias("order_id"),
        F.lit(1).cast("long").alias("quantity"),
        F.col("value").alias("total_price"),
        F.col("event_type").alias("item_name"),
    )
