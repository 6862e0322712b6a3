"""Grouped and global sales totals, heatmaps, profiles and product summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salescope.operators.ordered import one_row, quantiles
from salescope.session import cut_lineage

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def keep(df: DataFrame, **choices: str) -> DataFrame:
    """Equality filters by column; the value ``All`` leaves the column unfiltered."""
    for column, value in choices.items():
        if value != "All":
            df = df.where(F.col(column) == F.lit(value))
    return df


def hourly_demand(lines: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units, distinct orders and revenue by date and hour (and ``keys``)."""
    return lines.groupBy(*keys, "date", "hour").agg(
        F.sum("quantity").alias("units"),
        F.count_distinct("order_id").alias("num_orders"),
        F.sum("total_price").alias("revenue"),
    )


def daily_sales(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_date").agg(
        F.sum("total_price").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count_distinct("order_id").alias("num_orders"),
    )


def daily_sales_of_orders(orders: DataFrame) -> DataFrame:
    """The same series from order subtotals, where every order is one row of one date."""
    return orders.groupBy("order_date").agg(
        F.sum("revenue").alias("revenue"), F.sum("units").alias("units"), F.count(F.lit(1)).alias("num_orders")
    )


def product_sales(per_item: DataFrame, key: str = "item_name") -> DataFrame:
    """Revenue and units by product, from lines or from item subtotals."""
    return per_item.groupBy(key).agg(F.sum("total_price").alias("revenue"), F.sum("quantity").alias("units"))


def weekday_hour_means(lines: DataFrame) -> DataFrame:
    """Mean revenue and units per line and the line count, by weekday and hour."""
    return lines.groupBy("day_name", "hour").agg(
        F.avg("total_price").alias("revenue"), F.avg("quantity").alias("units"), F.count(F.lit(1)).alias("lines")
    )


def weekday_hour_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("day_name", "hour").agg(
        F.sum("total_price").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count_distinct("order_id").alias("num_orders"),
    )


def hour_means(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    return cells.groupBy("hour").agg(*[F.avg(c).alias(c) for c in columns])


def headline(lines: DataFrame, item_key: str = "item_id") -> DataFrame:
    """Revenue, units, orders, revenue per order and number of items sold."""
    return lines.agg(
        F.sum("total_price").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count_distinct("order_id").alias("num_orders"),
        F.count_distinct(item_key).alias("items"),
    ).withColumn("order_value", F.try_divide("revenue", "num_orders"))


def heatmap(cells: DataFrame, value: str, hours: Sequence[int], row: str = "day_name") -> DataFrame:
    """Weekday by hour grid: one row per weekday in week order, missing cells 0."""
    days = F.array(*[F.lit(d) for d in DAY_NAMES])
    wide = cells.groupBy(row).pivot("hour", list(hours)).agg(F.first(value)).fillna(0)
    order = (F.array_position(days, F.col(row)) - 1).cast("int")
    return wide.select(order.alias("day_order"), row, *[F.col(str(h)).alias(f"h{h}") for h in hours])


def share_of_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum by key and its share of the whole; the groups are fixed once and give both."""
    groups = cut_lineage(df.groupBy(key).agg(F.sum(value).alias(value)))
    whole = groups.agg(F.sum(value).alias("t")).scalar()
    return groups.withColumn("share", F.try_divide(F.col(value), whole))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal-width bins between the minimum and maximum; the last bin is closed."""
    ends = one_row(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
    width = (ends["hi"] - ends["lo"]) / F.lit(bins)
    place = F.floor((F.col(column) - ends["lo"]) / width)
    index = F.when(ends["hi"] == ends["lo"], F.lit(0)).otherwise(F.least(place, F.lit(bins - 1)))
    filled = df.where(F.col(column).isNotNull()).groupBy(index.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return filled.select("bin", (ends["lo"] + width * F.col("bin")).alias("bin_start"), "rows")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def split_statistics(df: DataFrame, target: str, by: str = "split") -> DataFrame:
    """Rows, mean, sample deviation, minimum, maximum and exact median of the target in each split."""
    t = F.col(target)
    stats = df.groupBy(by).agg(
        F.count(t).alias("rows"), F.avg(t).alias("mean"), F.stddev_samp(t).alias("std"),
        F.min(t).alias("min"), F.max(t).alias("max"),
    )
    middle = quantiles(df, target, [0.5], keys=[by])
    return stats.join(middle, by).select(*stats.columns, F.col("q")[0].alias("median"))


def median(df: DataFrame, column: str) -> Column:
    """Exact median as a scalar subquery."""
    return quantiles(df, column, [0.5]).scalar()[0]


def date_hour_cells(lines: DataFrame) -> DataFrame:
    """Revenue, units and lines by date and hour: at most 24 rows a day, enough for every staffing figure."""
    return lines.groupBy("order_date", "hour").agg(
        F.sum("total_price").alias("revenue"), F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("lines")
    )


def date_hour_cells_of_orders(orders: DataFrame) -> DataFrame:
    """The same cells from order subtotals."""
    return orders.groupBy("order_date", "hour").agg(*[F.sum(c).alias(c) for c in ("revenue", "units", "lines")])


def weekday_hour_means_of_cells(cells: DataFrame) -> DataFrame:
    """The same means per line as ``weekday_hour_means``, from date and hour cells."""
    lines = F.sum("lines")
    return cells.groupBy(F.date_format("order_date", "EEEE").alias("day_name"), "hour").agg(
        (F.sum("revenue") / lines).alias("revenue"), (F.sum("units") / lines).alias("units"), lines.alias("lines")
    )


def product_identity(lines: DataFrame, key: str = "item_name") -> DataFrame:
    """Mean unit price, most frequent size and category (ties: smallest) and ingredients of each product.

    Lines collapse to (product, size, category) counts first; the modes are read off those.
    """
    cells = lines.groupBy(key, "item_size", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_n"),
        F.min("ingredients").alias("ingredients"),
    )
    return identity_from_cells(cells, key)


def identity_from_cells(cells: DataFrame, key: str) -> DataFrame:
    """The product identity from per (product, size, category) subtotals."""

    def most_frequent(column: str) -> DataFrame:
        counted = cells.groupBy(key, column).agg(F.sum("n").alias("n"))
        return counted.where(F.col(column).isNotNull()).groupBy(key).agg(
            F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(column)
        )

    base = cells.groupBy(key).agg(
        F.sum("price_sum").alias("_price"), F.sum("price_n").alias("_n"), F.min("ingredients").alias("ingredients")
    )
    return (
        base.join(most_frequent("item_size"), key, "left")
        .join(most_frequent("category"), key, "left")
        .select(key, F.try_divide("_price", "_n").alias("unit_price"), "item_size", "category", "ingredients")
    )


def segment_summary(products: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Products, mean price, units, revenue and mean ingredient count of each cluster, rounded to cents."""
    return products.groupBy(cluster).agg(
        F.count("item_name").alias("products"),
        F.round(F.avg("unit_price"), 2).alias("avg_price"),
        F.round(F.sum("units"), 2).alias("total_units"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.round(F.avg("ingredient_count"), 2).alias("avg_ingredients"),
    )


def name_segments(segments: DataFrame, premium: float = 18, mid: float = 14, gourmet: float = 6) -> DataFrame:
    """Readable segment names from price tier, complexity and volume against the median segment."""
    price = F.col("avg_price")
    tier = F.when(price > premium, "Premium").when(price > mid, "Mid-Range").otherwise("Value")
    style = F.when(F.col("avg_ingredients") > gourmet, "Gourmet").otherwise("Classic")
    volume = F.when(F.col("total_units") > median(segments, "total_units"), "High-Volume").otherwise("Specialty")
    return segments.withColumn("segment", F.concat(tier, F.lit(" "), style, F.lit(" ("), volume, F.lit(")")))


def cluster_overview(products: DataFrame, cluster: str = "cluster", names: int = 5) -> DataFrame:
    """First names of each cluster, mean price and units; only ``names`` names per cluster are gathered."""
    order = W.partitionBy(cluster).orderBy("item_name")
    leading = (
        products.select(cluster, "item_name", F.row_number().over(order).alias("r"))
        .where(F.col("r") <= names)
        .groupBy(cluster)
        .agg(F.array_join(F.sort_array(F.collect_list("item_name")), ", ").alias("shown"))
    )
    totals = products.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("products"),
        F.round(F.avg("unit_price"), 2).alias("avg_price"),
        F.round(F.sum("units"), 2).alias("units"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
    )
    more = F.when(F.col("products") > names, "...").otherwise("")
    return totals.join(leading, cluster).select(
        cluster, F.concat("shown", more).alias("items"), "products", "avg_price", "units", "revenue"
    )
