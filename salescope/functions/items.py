"""Price, size, category and ingredient features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from salescope.functions.times import flag
from salescope.operators.ordered import quantiles

# Fixed values.
SIZE_RANK = {"S": 1, "M": 2, "L": 3, "XL": 4, "XXL": 5}
PRICE_LABELS = ["Budget", "Standard", "Premium", "Luxury"]
ORDER_VALUE_BINS = [(15, "Small"), (30, "Medium"), (50, "Large"), (100, "XLarge"), (1000, "Bulk")]
TOP_INGREDIENTS = [
    "Mozzarella Cheese", "Tomatoes", "Red Onions", "Red Peppers", "Mushrooms",
    "Pepperoni", "Chicken", "Bacon", "Garlic", "Green Peppers",
]
MEAT = "Chicken|Pepperoni|Bacon|Ham|Beef|Salami|Prosciutto|Anchovies"
SEAFOOD = "Anchovies|Shrimp|Salmon|Tuna"
CHEESE = "Cheese|Mozzarella|Provolone|Romano|Feta|Asiago|Ricotta"

MAX_DENSE_LEVELS = 1000


def price_per_unit(total: Column, quantity: Column) -> Column:
    return F.try_divide(total, quantity)


def size_rank(size: Column) -> Column:
    ranks = F.create_map(*[F.lit(v) for pair in SIZE_RANK.items() for v in pair])
    return F.try_element_at(ranks, size)


def order_value(total: Column) -> Column:
    """Right-closed bins above 0; null outside."""
    out = F.when(total <= 0, None)
    for top, label in ORDER_VALUE_BINS:
        out = out.when(total <= top, label)
    return out


def ingredient_count(text: Column) -> Column:
    """Comma-separated parts; 0 for a missing text."""
    return F.coalesce(F.size(F.split(text, ",")) * F.when(text.isNotNull(), 1), F.lit(0))


def quantile_label(value: Column, edges: Column, labels: Sequence[str] = PRICE_LABELS) -> Column:
    """Label of a right-closed quantile bin; ``edges`` is an array of all edges, lowest included."""
    out = F.when(value.isNull(), None)
    for i, label in enumerate(labels[:-1]):
        out = out.when(value <= edges[i + 1], label)
    return out.otherwise(labels[-1])


def add_price_bucket(df: DataFrame, price: str = "unit_price", labels: Sequence[str] = PRICE_LABELS,
                     name: str = "price_bucket", priced: DataFrame | None = None) -> DataFrame:
    """Equal-frequency price labels from exact quantiles of the whole table; equal edges are an error.

    ``priced`` holds the same prices without the joins of ``df``; the passes over the prices then read only that.
    """
    steps = [i / len(labels) for i in range(len(labels) + 1)]
    edges = quantiles(df if priced is None else priced, price, steps)
    repeated = F.size(F.array_distinct("q")) < len(steps)
    checked = edges.select(F.when(repeated, F.raise_error(F.lit("bin edges must be unique"))).otherwise(F.col("q")))
    return df.withColumn(name, quantile_label(F.col(price), checked.scalar(), labels))


def levels(df: DataFrame, column: str, limit: int = MAX_DENSE_LEVELS) -> list[str]:
    """Sorted distinct values for a dense encoding; refuses a domain too wide to become columns."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} values; encode it sparsely instead")
    return sorted(found)


def one_hot(df: DataFrame, column: str, prefix: str, values: Sequence[str] | None = None) -> DataFrame:
    """One 0/1 column per value, named ``<prefix>_<value>``."""
    values = levels(df, column) if values is None else values
    return df.withColumns({f"{prefix}_{v}": flag(F.col(column) == F.lit(v)) for v in values})


def label_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values with their alphabetical code from 0."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    return values.select(column, (F.row_number().over(W.orderBy(column)) - 1).alias(name))


def add_label_code(df: DataFrame, column: str, name: str) -> DataFrame:
    """Attach alphabetical codes of a category column (a closed vocabulary)."""
    return df.join(label_codes(df, column, name), column, "left")


def add_item_features(df: DataFrame, categories: Sequence[str] | None = None, priced: DataFrame | None = None) -> DataFrame:
    """Unit price, bulk flag, size rank, category one-hot, price and order-value buckets, complexity."""
    out = df.withColumns(
        {
            "price_per_unit": price_per_unit(F.col("total_price"), F.col("quantity")),
            "is_bulk_order": flag(F.col("quantity") >= 3),
            "size_numeric": size_rank(F.col("item_size")),
            "order_value_category": order_value(F.col("total_price")),
            "ingredient_count": ingredient_count(F.col("ingredients")),
            "is_complex_item": flag(ingredient_count(F.col("ingredients")) >= 5),
        }
    )
    return add_price_bucket(one_hot(out, "category", "category", categories), priced=priced)


def vocabulary(df: DataFrame, text: str = "ingredients") -> DataFrame:
    """Distinct trimmed parts of a comma-separated column.

    Distinct texts are taken first, so a text repeated on a third of all lines is split once.
    """
    distinct_texts = df.select(text).where(F.col(text).isNotNull()).distinct()
    parts = distinct_texts.select(F.explode(F.split(text, ",")).alias("part"))
    return parts.select(F.trim("part").alias("ingredient")).distinct()


def contains_flag(text: Column, word: str) -> Column:
    """Case-sensitive substring test, 0 for a missing text."""
    return flag(text.contains(word))


def matches_flag(text: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression test, 0 for a missing text."""
    return flag(text.rlike(f"(?i){pattern}"))


def add_ingredient_features(df: DataFrame, words: Sequence[str] = TOP_INGREDIENTS, meat: str = MEAT,
                            seafood: str = SEAFOOD, cheese: str = CHEESE) -> DataFrame:
    """``has_<word>`` flags and dietary flags; a missing text counts as vegetarian."""
    text = F.col("ingredients")
    out = {f"has_{w.lower().replace(' ', '_')}": contains_flag(text, w) for w in words}
    out |= {
        "is_vegetarian": 1 - matches_flag(text, meat),
        "has_meat": matches_flag(text, meat),
        "has_seafood": matches_flag(text, seafood),
        "has_cheese": matches_flag(text, cheese),
    }
    return df.withColumns(out)


def short_name(name: Column, article: str = "The ") -> Column:
    return F.replace(name, F.lit(article), F.lit(""))


def clipped(text: Column, width: int = 20) -> Column:
    return F.concat(F.substring(text, 1, width), F.lit("..."))
