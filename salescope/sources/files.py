"""Readers and writers with a fixed schema, and data checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from salescope.functions.times import clock

SALES_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("order_time", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_price", T.DoubleType()),
        T.StructField("item_size", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("ingredients", T.StringType()),
        T.StructField("item_name", T.StringType()),
    ]
)
REQUIRED_COLUMNS = SALES_SCHEMA.fieldNames()


def _ready(df: DataFrame, names: Mapping[str, str] | None) -> DataFrame:
    return parse_dates(df.withColumnsRenamed(dict(names or {})))


def load_csv(spark: SparkSession, path: str, schema: T.StructType = SALES_SCHEMA, names: Mapping[str, str] | None = None,
             **options) -> DataFrame:
    """CSV lines with an explicit schema; ``names`` maps source columns to ours. Bad values become null."""
    reader = spark.read.schema(schema).options(**{"header": True, "mode": "PERMISSIVE", **options})
    return _ready(reader.csv(path), names)


def load_parquet(spark: SparkSession, path: str, names: Mapping[str, str] | None = None) -> DataFrame:
    return _ready(spark.read.parquet(path), names)


def jdbc_options(url: str, query: str, partition_column: str | None = None, lower: int | None = None,
                 upper: int | None = None, partitions: int = 64, **properties: str) -> dict[str, str]:
    """Reader options; with a partition column the query is read in parallel key ranges."""
    options = {"url": url, **properties}
    if partition_column is None:
        return options | {"query": query}
    if lower is None or upper is None:
        raise ValueError("a partitioned read needs the lower and upper bound of its column")
    return options | {
        "dbtable": f"({query}) q", "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def load_database(spark: SparkSession, url: str, query: str, names: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Result of a database query through JDBC (the driver's jar must be on the classpath)."""
    return _ready(spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load(), names)


def load_sheet(spark: SparkSession, folder: str, sheet: str = "sales", kind: str = "csv", **options) -> DataFrame:
    """A workbook sheet exported to ``<folder>/<sheet>`` as CSV or parquet."""
    path = f"{folder.rstrip('/')}/{sheet}"
    return load_parquet(spark, path) if kind == "parquet" else load_csv(spark, path, **options)


def parse_dates(df: DataFrame) -> DataFrame:
    """``order_date`` as a date and ``order_time`` as ``HH:mm:ss`` text, null where it does not parse."""
    out = df
    if "order_date" in df.columns:
        day = F.col("order_date")
        parsed = F.try_to_date(day) if dict(df.dtypes)["order_date"] == "string" else F.to_date(day)
        out = out.withColumn("order_date", parsed)
    if "order_time" in df.columns and dict(df.dtypes)["order_time"] == "string":
        out = out.withColumn("order_time", F.date_format(clock(F.col("order_time")), "HH:mm:ss"))
    return out


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS, strict: bool = False) -> list[str]:
    """Required columns the table lacks; ``strict`` turns a gap into an error."""
    missing = sorted(set(required) - set(df.columns))
    if missing and strict:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return missing


def null_counts(df: DataFrame, only_found: bool = True) -> DataFrame:
    """(column, nulls) from one pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    out = counted.select(F.inline(pairs))
    return out.where(F.col("nulls") > 0) if only_found else out


def profile(df: DataFrame, order: str = "order_id", item: str = "item_name", date: str = "order_date",
            revenue: str = "total_price") -> DataFrame:
    """Rows, distinct orders and items, date range and revenue."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_distinct(order).alias("unique_orders"),
        F.count_distinct(item).alias("unique_items"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.sum(revenue).alias("total_revenue"),
    )


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum and maximum of numeric columns, one row each, from one pass."""
    ends = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"min_{c}").alias("low"), F.col(f"max_{c}").alias("high")) for c in columns]
    return ends.select(F.inline(F.array(*rows)))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def save_splits(df: DataFrame, path: str) -> None:
    """One parquet folder per split, features and label together."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def feature_record(data: DataFrame, features: Sequence[str], target: str, note: str = "") -> DataFrame:
    """One-row description of a split feature table, ready for ``save_json``."""
    return data.agg(
        F.array(*[F.lit(f) for f in features]).alias("feature_columns"), F.lit(len(features)).alias("n_features"),
        F.lit(target).alias("target"),
        *[F.count_if(F.col("split") == s).alias(f"{s}_samples") for s in ("train", "val", "test")],
        F.lit(note).alias("note"),
    )


def export_tables(tables: Mapping[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    """One folder per task under ``folder``."""
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        save_csv(df, path) if kind == "csv" else df.write.mode("overwrite").parquet(path)
