"""Market-basket queries: one basket per order, brands as items."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions.times import clock_hour, flag, meal_period
from salescope.learn.runs import rule_champion
from salescope.operators import baskets
from salescope.plans.registry import MEAL, R, SALES, query, r, rounded, sql
from salescope.sources.views import sales

SUPPORT = 0.01

PAIRS = """
pairs AS (SELECT l_orderkey AS order_id, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 HAVING sum(l_quantity) > 0),
total AS (SELECT count(DISTINCT order_id) AS orders FROM pairs)"""


def itemsets_sql(support: float) -> str:
    """Frequent sets of one to three items; no larger set reaches the supports used here."""
    floor = f"HAVING count(*) >= (SELECT orders FROM total) * {support}::DOUBLE"
    return f"""
one AS (SELECT item AS a, count(*) AS freq FROM pairs GROUP BY 1 {floor}),
two AS (SELECT x.item AS a, y.item AS b, count(*) AS freq FROM pairs x JOIN pairs y ON x.order_id = y.order_id AND x.item < y.item GROUP BY 1, 2 {floor}),
three AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS freq FROM pairs x JOIN pairs y ON x.order_id = y.order_id AND x.item < y.item
          JOIN pairs z ON x.order_id = z.order_id AND y.item < z.item GROUP BY 1, 2, 3 {floor}),
sets AS (SELECT [a] AS items, freq, freq / orders AS support FROM one, total UNION ALL SELECT [a, b], freq, freq / orders FROM two, total
         UNION ALL SELECT [a, b, c], freq, freq / orders FROM three, total)"""


RULES = """
cut AS (
  SELECT items, support, [items[1]] AS l, items[2:] AS r FROM sets WHERE len(items) > 1
  UNION ALL SELECT items, support, [items[2]], list_filter(items, lambda x: x <> items[2]) FROM sets WHERE len(items) > 1
  UNION ALL SELECT items, support, [items[3]], items[1:2] FROM sets WHERE len(items) = 3
  UNION ALL SELECT items, support, items[1:2], [items[3]] FROM sets WHERE len(items) = 3
  UNION ALL SELECT items, support, items[2:3], [items[1]] FROM sets WHERE len(items) = 3
  UNION ALL SELECT items, support, [items[1], items[3]], [items[2]] FROM sets WHERE len(items) = 3),
rules AS (
  SELECT c.l AS antecedents, c.r AS consequents, ls.support AS antecedent_support, rs.support AS consequent_support, c.support,
         c.support / ls.support AS confidence, c.support / ls.support / rs.support AS lift, c.support - ls.support * rs.support AS leverage
  FROM cut c JOIN sets ls ON ls.items = c.l JOIN sets rs ON rs.items = c.r)"""


def pairs(spark, d):
    return baskets.order_items(sales(spark, d, "order_id", "brand", "quantity"), item="brand")


def joined(df, *columns):
    return df.withColumns({c: F.array_join(c, ",") for c in columns})


@query(
    "basket_sizes",
    sql(PAIRS, "b AS (SELECT order_id, count(*) AS items FROM pairs GROUP BY 1)", select="SELECT items, count(*) AS orders FROM b GROUP BY 1"),
)
def basket_sizes(spark, d):
    return baskets.basket_sizes(pairs(spark, d))


SETS_SELECT = f"SELECT array_to_string(items, ',') AS items, freq, {R('support', 8)} AS support FROM sets"


@query("itemsets_fpgrowth", sql(PAIRS, itemsets_sql(SUPPORT), select=SETS_SELECT))
def itemsets_fpgrowth(spark, d):
    found = baskets.itemsets_fpgrowth(pairs(spark, d), SUPPORT)
    return joined(found, "items").select("items", "freq", r("support", 8).alias("support"))


@query("itemsets_apriori", sql(PAIRS, itemsets_sql(0.005), select=SETS_SELECT))
def itemsets_apriori(spark, d):
    found = baskets.itemsets_apriori(pairs(spark, d), 0.005)
    return joined(found, "items").select("items", "freq", r("support", 8).alias("support"))


def mined(spark, d, support=SUPPORT):
    return baskets.itemsets_apriori(pairs(spark, d), support)


RULE_COLUMNS = ["antecedent_support", "consequent_support", "support", "confidence", "lift", "leverage"]
RULES_SELECT = (
    "SELECT array_to_string(antecedents, ',') AS antecedents, array_to_string(consequents, ',') AS consequents, "
    + ", ".join(f"{R(c, 8)} AS {c}" for c in RULE_COLUMNS)
    + " FROM rules"
)


@query("basket_rules", sql(PAIRS, itemsets_sql(0.005), RULES, select=RULES_SELECT + " WHERE lift >= 0.3"))
def basket_rules(spark, d):
    return rounded(joined(baskets.rules(mined(spark, d, 0.005), "lift", 0.3), "antecedents", "consequents"), 8)


@query("strongest_rules", sql(PAIRS, itemsets_sql(SUPPORT), RULES, select=RULES_SELECT + " WHERE confidence >= 0.1 AND lift >= 1.02"))
def strongest_rules(spark, d):
    found = baskets.rules(mined(spark, d), "confidence", 0.1)
    return rounded(joined(baskets.strongest(found, 1.02), "antecedents", "consequents"), 8)


@query(
    "rule_summary",
    sql(PAIRS, itemsets_sql(SUPPORT), RULES, select=f"""
        SELECT count(*) AS association_rules, {R('avg(lift)', 8)} AS avg_lift, {R('max(lift)', 8)} AS max_lift, {R('avg(confidence)', 8)} AS avg_confidence,
               {R('max(confidence)', 8)} AS max_confidence, {R('avg(leverage)', 8)} AS avg_leverage FROM rules WHERE lift >= 0.5"""),
)
def rule_summary(spark, d):
    return rounded(baskets.rule_summary(baskets.rules(mined(spark, d), "lift", 0.5)), 8)


GRID_SUPPORTS, GRID_THRESHOLDS = (0.005, 0.01), (0.3, 0.5)


def grid_sql() -> str:
    """Rules of the lower support hold those of the higher one."""
    parts = []
    for algorithm in ("Apriori", "FP-Growth"):
        for support in GRID_SUPPORTS:
            for metric in ("lift", "confidence"):
                for threshold in GRID_THRESHOLDS:
                    parts.append(
                        f"SELECT '{algorithm}' AS algorithm, {support}::DOUBLE AS min_support, '{metric}' AS metric, {threshold}::DOUBLE AS min_threshold, "
                        f"count(*) AS association_rules, {R('coalesce(avg(lift), 0)', 8)} AS avg_lift, {R('coalesce(avg(confidence), 0)', 8)} AS avg_confidence, "
                        f"{R('coalesce(avg(leverage), 0)', 8)} AS avg_leverage FROM rules, total "
                        f"WHERE {metric} >= {threshold} AND round(support * orders) >= orders * {support}::DOUBLE"
                    )
    return " UNION ALL ".join(parts)


def grid(spark, d):
    return baskets.rule_grid(pairs(spark, d), GRID_SUPPORTS, thresholds=GRID_THRESHOLDS)


@query("rule_grid", sql(PAIRS, itemsets_sql(min(GRID_SUPPORTS)), RULES, select=grid_sql()))
def rule_grid(spark, d):
    return rounded(grid(spark, d), 8)


@query(
    "rule_champion",
    sql(PAIRS, itemsets_sql(min(GRID_SUPPORTS)), RULES, f"grid AS ({grid_sql()})", select="""
        SELECT * FROM grid WHERE association_rules > 0
        ORDER BY avg_lift DESC, association_rules DESC, algorithm, min_support, metric, min_threshold LIMIT 1"""),
)
def rule_champion_query(spark, d):
    return rule_champion(rounded(grid(spark, d), 8))


@query(
    "bundle_records",
    sql(PAIRS, itemsets_sql(SUPPORT), RULES,
        "best AS (SELECT *, array_to_string(antecedents, ',') AS l, array_to_string(consequents, ',') AS c FROM rules ORDER BY round(lift, 10) DESC, l, c LIMIT 10)",
        select="""
        SELECT row_number() OVER (ORDER BY round(lift, 10) DESC, l, c) AS bundle_id, l || ',' || c AS bundle_items, l AS if_customer_buys, c AS recommend, round(support * 100, 2) AS support_pct,
          round(confidence * 100, 2) AS confidence_pct, round(lift, 2) AS lift, round((lift - 1) * 100, 2) AS expected_uplift,
          printf('Baskets with %s hold %s %.1f times as often as others do (%.1f%% of baskets have all of it, %.1f%% of those with the first). %s',
            replace(l, ',', ', '), replace(c, ',', ', '), round(lift, 1), round(support * 100, 1), round(confidence * 100, 1),
            CASE WHEN lift > 2 THEN 'Verdict: STRONG link, bundle first.' WHEN lift > 1.5 THEN 'Verdict: good link, worth a promotion.'
              ELSE 'Verdict: moderate link, try it out.' END) AS reasoning FROM best"""),
)
def bundle_records(spark, d):
    found = baskets.rules(mined(spark, d), "lift", 0.3).withColumn("lift", F.round("lift", 10))
    return joined(baskets.bundle_records(found, 10), "bundle_items", "if_customer_buys", "recommend")


@query(
    "copurchases",
    sql(PAIRS, itemsets_sql(SUPPORT), RULES,
        "best AS (SELECT *, array_to_string(antecedents, ',') AS l, array_to_string(consequents, ',') AS c FROM rules ORDER BY round(lift, 10) DESC, l, c LIMIT 10)",
        select="""
        SELECT l AS antecedents, c AS consequents, CAST(round(support * orders, 0) AS BIGINT) AS copurchase_count,
               round(support * 100, 2) AS copurchase_pct, round(lift, 2) AS lift FROM best, total"""),
)
def copurchases(spark, d):
    found = baskets.rules(mined(spark, d), "lift", 0.3).withColumn("lift", F.round("lift", 10))
    orders = baskets.order_count(sales(spark, d, "order_id")).scalar()
    return baskets.copurchases(found, orders, 10)


@query(
    "slot_bundles",
    sql(SALES, f"""
        t AS (SELECT item_name, {MEAL} AS meal, isodow(order_date) >= 6 AS weekend FROM sales),
        c AS (SELECT 'Lunch Special' AS period, item_name, count(*) AS n, 3 AS k FROM t WHERE meal = 'Lunch' GROUP BY 2
              UNION ALL SELECT 'Dinner Deal', item_name, count(*), 3 FROM t WHERE meal = 'Dinner' GROUP BY 2
              UNION ALL SELECT 'Weekend Party Pack', item_name, count(*), 4 FROM t WHERE weekend GROUP BY 2),
        s AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY period ORDER BY n DESC, item_name) <= k)""",
        select=f"""SELECT period, string_agg(item_name, ',' ORDER BY n DESC, item_name) AS bundle, any_value(reasoning) AS reasoning, any_value(offer) AS suggested_discount
          FROM s JOIN (VALUES {', '.join(f"('{slot}', '{why}', '{offer}')" for slot, _, why, offer in baskets.SLOTS)}) o(period, reasoning, offer) USING (period) GROUP BY 1"""),
)
def slot_bundles(spark, d):
    lines = sales(spark, d, "order_date", "order_time", "item_name").select(
        "item_name", meal_period(clock_hour(F.col("order_time"))).alias("meal_period"),
        flag(F.weekday("order_date") >= 5).alias("is_weekend"),
    )
    return joined(baskets.slot_bundles(lines), "bundle")


@query(
    "miner_comparison",
    sql(PAIRS, itemsets_sql(SUPPORT), RULES, "s AS (SELECT count(*) AS n, round(avg(lift), 2) AS a, round(max(lift), 2) AS m FROM rules WHERE confidence >= 0.05 AND lift >= 1.0)",
        select="SELECT unnest(['Apriori', 'FP-Growth']) AS algorithm, n AS rules_found, a AS avg_lift, m AS max_lift FROM s"),
)
def miner_comparison(spark, d):
    return baskets.compare_algorithms(pairs(spark, d), SUPPORT, 0.05, 1.0).drop("seconds")
