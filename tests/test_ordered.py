import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.operators import ordered, series


@pytest.mark.parametrize("values", [
    [0.0, -3.5, 2.0, 2.0, 1e9, -1e-9, 7.25, None, 0.3],
    [5.0] * 20,
    [1.0],
])
def test_running_equals_a_plain_window(spark, values):
    df = spark.createDataFrame([(i, v, 1.0 + i) for i, v in enumerate(values)], "id int, v double, w double")
    got = ordered.running(df, "v", ["w"], descending=True, tie=["id"]).orderBy("position").collect()
    order = sorted(range(len(values)), key=lambda i: (-(values[i]) if values[i] is not None else float("inf"), i))
    assert [r["id"] for r in got] == order
    assert [r["position"] for r in got] == list(range(1, len(values) + 1))
    assert [r["running_w"] for r in got] == pytest.approx(list(np.cumsum([1.0 + i for i in order])))


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(3, 2, 500), -rng.random(50), np.zeros(100)])
    df = spark.createDataFrame([(float(v), int(i % 3)) for i, v in enumerate(values)], "v double, g int")
    ps = [0, 0.1, 0.25, 0.5, 0.9, 1]
    assert ordered.quantiles(df, "v", ps).first()["q"] == pytest.approx(list(np.quantile(values, ps)))
    keyed = {r["g"]: r["q"] for r in ordered.quantiles(df, "v", [0.5], keys=["g"]).collect()}
    for g in range(3):
        assert keyed[g][0] == pytest.approx(np.median(values[np.arange(len(values)) % 3 == g]))


def test_running_cuts_crowded_and_equal_values(spark):
    """1e5 values of one old logarithmic bucket, and 1e5 equal values: both are cut into ranges of about one size."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for value, tie in ((1000 + F.col("id") / 1e9, ["id"]), (F.lit(5.0), ["id"]), (F.lit(5.0), [])):
            df = spark.range(100_000).select("id", value.cast("double").alias("v"), F.lit(2).alias("w"))
            assert df.select(ordered.value_bucket(F.col("v"))).distinct().count() == 1
            order = [F.col("v").desc(), *[F.col(c) for c in tie]]
            got = ordered.running(df, "v", ["w"], descending=True, tie=tie)
            assert got.where("running_w <> 2 * position").count() == 0
            assert got.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()[:] == (1, 100_000, 100_000)
            if tie:
                sizes = ordered.sorted_ranges(df, order).groupBy("_range").count().toPandas()["count"]
                assert len(sizes) >= 3 and sizes.max() < 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_quantiles_split_crowded_buckets(spark, monkeypatch):
    """Hit buckets above the limit are cut again and again, down to single values; nulls, infinities and equal values included."""
    monkeypatch.setattr(ordered, "ENOUGH", 20)
    monkeypatch.setattr(ordered, "PIECES", 4)
    rng = np.random.default_rng(5)
    values = np.concatenate([1000 + rng.random(3000) / 1e6, np.full(500, 1000.0), 2.0 ** -rng.integers(0, 300, 400), -rng.random(300)])
    ps = [0, 0.01, 0.2, 0.5, 0.77, 1]
    df = spark.createDataFrame([(float(v), f"g{i % 2}") for i, v in enumerate(values)] + [(None, "g0")], "v double, g string")
    assert ordered.quantiles(df, "v", ps).first()["q"] == pytest.approx(list(np.quantile(values, ps)), rel=1e-12)
    keyed = {r["g"]: r["q"] for r in ordered.quantiles(df, "v", ps, keys=["g"]).collect()}
    for g in range(2):
        assert keyed[f"g{g}"] == pytest.approx(list(np.quantile(values[g::2], ps)), rel=1e-12)
    ends = spark.createDataFrame([(x,) for x in (float("-inf"), 1.0, float("inf"))], "v double")
    assert ordered.quantiles(ends, "v", [0, 0.5, 1]).first()["q"] == [float("-inf"), 1.0, float("inf")]
    assert ordered.quantiles(df.limit(0), "v", [0.5], keys=["g"]).count() == 0
    assert ordered.quantiles(df.limit(0), "v", [0.5]).first()["q"] == [None]
    wide = df.withColumn("u", -F.col("v"))
    assert ordered.medians(wide, ["v", "u"]).first()[:] == pytest.approx((np.median(values), -np.median(values)))


def test_quantiles_shuffle_no_distinct_values(spark, capsys):
    """Values reach a shuffle only from the intervals that hold a rank."""
    df = spark.range(200_000).select((F.col("id") * 1.0).alias("v"))
    got = ordered.quantiles(df, "v", [0.5])
    assert got.first()["q"] == [99_999.5]
    got.explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(lo" in plan and "hashpartitioning(v" not in plan


def test_number_rows_counts_through_partitions(spark):
    df = spark.range(1000).repartition(7).withColumn("k", F.col("id") % 13)
    got = ordered.number_rows(df, [F.col("k"), F.col("id")]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1000))
    assert [(r["k"], r["id"]) for r in got] == sorted((i % 13, i) for i in range(1000))


def hours(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), h, u) for d, h, u in rows], "date date, hour int, units long")


def test_lags_follow_rows_not_the_clock(spark):
    df = hours(spark, [("2024-01-01", 9, 1), ("2024-01-01", 12, 2), ("2024-01-03", 9, 4), ("2024-01-03", 13, 8)])
    rows = series.add_lags(df).orderBy("date", "hour").collect()
    assert [r["prev_hour_units"] for r in rows] == [None, 1, 2, 4]
    assert [r["same_hour_yesterday"] for r in rows] == [None, None, 1, None]
    assert [r["rolling_3h_avg"] for r in rows] == pytest.approx([1, 1.5, 7 / 3, 14 / 3])
    assert series.demand_features(df).count() == 1
    without = series.add_lags(df, include_current=False).orderBy("date", "hour").collect()
    assert [r["rolling_3h_avg"] for r in without] == [None, 1, 1.5, pytest.approx(7 / 3)]


def test_centred_mean_needs_a_full_window(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(9)], "d int, v double")
    got = [r["m"] for r in df.select("d", series.centred_mean("d", "v").alias("m")).orderBy("d").collect()]
    assert got == [None] * 3 + [3.0, 4.0, 5.0] + [None] * 3


def test_forecast_baselines(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "t int, v double")
    got = df.limit(1).select(
        series.last_value_forecast(df, ["t"], "v").alias("a"), series.moving_average_forecast(df, ["t"], "v").alias("b"),
        series.moving_average_forecast(df.where("t < 3"), ["t"], "v").alias("c"),
    ).first()
    assert (got["a"], got["b"], got["c"]) == (9.0, 6.0, None)


def test_chronological_split_floors(spark):
    df = spark.createDataFrame([(i,) for i in range(21)], "t int")
    counts = {r["split"]: r["count"] for r in series.chronological_split(df, ["t"]).groupBy("split").count().collect()}
    assert counts == {"train": 14, "val": 3, "test": 4}


def test_ordered_split_is_exact(spark):
    df = spark.range(103).repartition(5)
    got = series.ordered_split(df, [F.col("id")])
    assert sorted(r["id"] for r in got.where("split = 'test'").collect()) == list(range(82, 103))


def test_random_split_is_stable_and_disjoint(spark):
    df = spark.range(20000).withColumn("line", F.col("id") % 7)
    one = {r["id"]: r["split"] for r in series.random_split(df, ["id", "line"]).collect()}
    two = {r["id"]: r["split"] for r in series.random_split(df.repartition(9), ["id", "line"]).collect()}
    assert one == two
    share = sum(v == "train" for v in one.values()) / len(one)
    assert share == pytest.approx(0.8, abs=0.01)
    assert series.shared_keys(series.random_split(df, ["id", "line"]), ["id"]).isEmpty()


def test_stratified_split_with_one_dominant_label(spark):
    df = spark.range(3000).withColumn("label", F.when(F.col("id") < 2900, "a").when(F.col("id") < 2999, "b").otherwise(None))
    got = series.stratified_split(df, "label", ["id"])
    assert got.count() == 3000
    counts = {(r["label"], r["split"]): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert counts == {("a", "train"): 2320, ("a", "test"): 580, ("b", "train"): 79, ("b", "test"): 20, (None, "train"): 1}


def test_stratified_split_takes_one_exact_total(spark, monkeypatch):
    monkeypatch.setattr(series, "SLICE_ROWS", 50)  # many slices a label
    df = spark.range(1003).withColumn("label", (F.col("id") * F.col("id")) % 17)
    for test in (0.2, 0.33):
        got = series.stratified_split(df, "label", ["id"], test=test).toPandas()
        sizes, taken = got.groupby("label").size(), got[got["split"] == "test"].groupby("label").size()
        assert len(got) == 1003 and taken.sum() == np.ceil(test * 1003)
        assert all(np.floor(test * n) <= taken.get(k, 0) <= np.floor(test * n) + 1 for k, n in sizes.items())
    again = series.stratified_split(df.repartition(7), "label", ["id"], test=0.33).toPandas()
    assert set(zip(again["id"], again["split"])) == set(zip(got["id"], got["split"]))


def test_best_rows_and_forbidden_columns(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("b", 3, 1.0)], "k string, id int, v double")
    best = {r["k"]: r["id"] for r in series.best_rows(df, ["k"], F.col("v").desc(), F.col("id")).collect()}
    same = {r["k"]: r["id"] for r in series.best_value(df, ["k"], ["id", "v"], -F.col("v"), F.col("id")).collect()}
    assert best == same == {"a": 1, "b": 3}
    assert series.forbidden_columns(df, ["V", "total"]) == ["v"]
