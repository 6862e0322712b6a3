"""Query registry and shared SQL pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def r(value: Column | str, digits: int = 6) -> Column:
    """Rounded double for output."""
    return F.round((F.col(value) if isinstance(value, str) else value).cast("double"), digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All double columns rounded, dates as text."""
    out = {}
    for name, kind in df.dtypes:
        if kind == "double":
            out[name] = F.round(F.col(name), digits)
        elif kind == "date":
            out[name] = F.col(name).cast("string")
    return df.withColumns(out) if out else df


def R(expr: str, digits: int = 6) -> str:
    """The same rounding in SQL, without negative zeros."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"


def sql(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(c.strip() for c in ctes)} {select.strip()}"


SALES = """
sales AS (
  SELECT l_orderkey AS order_id, l_partkey AS item_id, l_linenumber AS line_no, l_quantity AS quantity,
         l_extendedprice AS total_price, l_extendedprice / l_quantity AS unit_price,
         CAST(9 + l_orderkey % 14 AS INTEGER) AS hour,
         lpad(CAST(9 + l_orderkey % 14 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0')
           || ':' || lpad(CAST((l_orderkey * 7) % 60 AS VARCHAR), 2, '0') AS order_time,
         CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
         p_name AS item_name, p_brand AS brand, p_type AS category,
         CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 20 THEN 'M' WHEN p_size <= 30 THEN 'L'
              WHEN p_size <= 40 THEN 'XL' ELSE 'XXL' END AS item_size,
         replace(p_name, ' ', ', ') AS ingredients
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

DAILY = """
daily AS (
  SELECT order_date, sum(total_price) AS revenue, sum(quantity) AS units, count(DISTINCT order_id) AS num_orders
  FROM sales GROUP BY order_date)"""

PRODUCTS = """
products AS (
  SELECT item_name, sum(total_price) AS revenue, sum(quantity) AS units, count(*) AS lines, sum(unit_price) AS unit_price_sum
  FROM sales GROUP BY item_name)"""

# the identity of a product: mean price, most frequent size and category (ties: smallest), ingredients
IDENTITY = """
sized AS (SELECT item_name, item_size, row_number() OVER (PARTITION BY item_name ORDER BY count(*) DESC, item_size) AS k
          FROM sales GROUP BY item_name, item_size),
kinds AS (SELECT item_name, category, row_number() OVER (PARTITION BY item_name ORDER BY count(*) DESC, category) AS k
          FROM sales GROUP BY item_name, category),
identity AS (
  SELECT p.item_name, p.unit_price, sized.item_size, kinds.category, p.ingredients
  FROM (SELECT item_name, avg(unit_price) AS unit_price, min(ingredients) AS ingredients FROM sales GROUP BY item_name) p
  JOIN sized ON sized.item_name = p.item_name AND sized.k = 1
  JOIN kinds ON kinds.item_name = p.item_name AND kinds.k = 1)"""

HOURLY = """
hourly AS (
  SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS units,
         count(DISTINCT user_id) AS num_orders, sum(value) AS revenue
  FROM events GROUP BY 1, 2)"""

CELLS = """
cells AS (
  SELECT dayname(order_date) AS day_name, hour, avg(total_price) AS revenue, avg(quantity) AS units, count(*) AS lines
  FROM sales GROUP BY 1, 2)"""

MEAL = """CASE WHEN hour <= 11 THEN 'Morning' WHEN hour <= 14 THEN 'Lunch' WHEN hour <= 17 THEN 'Afternoon'
  WHEN hour <= 21 THEN 'Dinner' ELSE 'Late Night' END"""


def spread_sql(key: str, seed: int = 0) -> str:
    return f"((({key} + {seed}) % 2147483648) * 2654435761 % 4294967296)"


def row_spread_sql(*columns: str, seed: int = 42) -> str:
    out = spread_sql(f"CAST({seed} AS BIGINT)")
    for column in columns:
        out = spread_sql(f"({out} + {column})")
    return out
