from functools import partial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salescope.learn.runs import cluster_champion
from salescope.operators import cells, clusters, density, neighbours, tiles


def frame(spark, x, **more):
    data = pd.DataFrame(np.asarray(x, float), columns=[f"f{i}" for i in range(np.shape(x)[1])])
    return spark.createDataFrame(data.assign(id=range(len(data)), **more))


def names(x):
    return [f"f{i}" for i in range(np.shape(x)[1])]


def brute_dbscan(x, eps, min_samples, metric):
    gaps = np.abs(x[:, None] - x[None])
    near = (gaps.sum(2) if metric == "manhattan" else np.sqrt((gaps**2).sum(2))) <= eps
    core = near.sum(1) >= min_samples
    label = -np.ones(len(x), int)
    found = 0
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        label[i], todo = found, [i]
        while todo:
            u = todo.pop()
            for v in np.flatnonzero(near[u]) if core[u] else ():
                if label[v] == -1:
                    label[v] = found
                    todo.append(v)
        found += 1
    return label


def labels_of(df):
    return df.toPandas().sort_values("id")["cluster"].to_numpy()


def test_dbscan_border_noise_and_blobs(spark):
    x = np.array([[0, 0], [0, 0.1], [0.1, 0], [0.45, 0], [5, 5], [5, 5.1], [5.1, 5], [9, 0]])
    got = labels_of(density.dbscan(frame(spark, x), "id", names(x), 0.4, 3))
    assert list(got) == [0, 0, 0, 0, 1, 1, 1, -1]


@pytest.mark.parametrize("n, d, eps, min_samples, metric, leaf", [
    (250, 2, 0.15, 4, "euclidean", 512),
    (250, 3, 0.4, 5, "manhattan", 16),
    # tiny leaves: most pairs are decided by boxes; a third of all points is one crowded spot
    (600, 2, 0.08, 6, "euclidean", 4),
    (400, 8, 1.2, 5, "euclidean", 20),
])
def test_dbscan_equals_brute_force(spark, n, d, eps, min_samples, metric, leaf):
    rng = np.random.default_rng(n + d)
    x = np.round(rng.normal(size=(n, d)) * (rng.random((n, 1)) + 0.2), 2)
    x[: n // 3] = np.round(x[: n // 3] * 0.03 + 1, 3)
    got = labels_of(density.dbscan(frame(spark, x), "id", names(x), eps, min_samples, metric, leaf))
    assert np.array_equal(got, brute_dbscan(x, eps, min_samples, metric))


def test_dbscan_of_a_crowd_next_to_thin_places(spark):
    """1e5 points in one spot of eight dimensions, a thin chain that starts in it, and noise: decided by boxes, not by pairs."""
    rng = np.random.default_rng(0)
    crowd = rng.normal(size=(100_000, 8)) * 0.01
    chain = np.zeros((20, 8))
    chain[:, 0] = 0.2 + 0.3 * np.arange(20)
    x = np.concatenate([crowd, chain, np.eye(8) * 50])
    df = spark.createDataFrame(pd.DataFrame(x, columns=names(x)).assign(id=range(len(x))))
    got = labels_of(density.dbscan(df, "id", names(x), 0.5, 3))
    assert (got[:100_020] == 0).all() and (got[100_020:] == -1).all()


def test_pairs_of_cells_stay_few_in_a_crowd(spark):
    rng = np.random.default_rng(1)
    counts = []
    for n in (1000, 4000):
        x = rng.normal(size=(n, 2)) * 0.01
        points = frame(spark, x).select(F.array(*names(x)).alias("x"), F.col("id").alias("node"), F.lit(1).alias("w"))
        tree = cells.build(points, 2, 50, weight="w")
        assert tree.depth > 0 and tree.points.count() == n
        counts.append(density.close_pairs(tree, 0.5, "euclidean").count())
    assert counts == [1, 1]


def test_all_noise_has_no_score(spark):
    x = np.array([[0.0, 0.0], [10.0, 10.0], [20.0, 20.0]])
    df = frame(spark, x)
    labelled = df.join(density.dbscan(df, "id", names(x), 0.5, 2), "id")
    counts = clusters.cluster_counts(labelled).first()
    assert (counts["clusters"], counts["noise"]) == (0, 3)
    assert clusters.scores(labelled, "id", names(x)) == (-1.0, -1.0)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (103, 102)], "u long, v long")
    got = {r["node"]: r["root"] for r in density.components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and got[101] == 100 and got[103] == 102


@pytest.mark.parametrize("tile", [7, 4096])
def test_quality_scores_match_direct_formulas(spark, tile):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    c = np.arange(60) % 4
    c[:3] = -1
    df = frame(spark, x, cluster=c).withColumn("cluster", F.col("cluster").cast("int"))
    keep = c != -1
    y, k = x[keep], c[keep]
    dist = np.sqrt(((y[:, None] - y[None]) ** 2).sum(2))
    widths = []
    for i in range(len(y)):
        a = dist[i, k == k[i]].sum() / ((k == k[i]).sum() - 1)
        b = min(dist[i, k == j].mean() for j in set(k) - {k[i]})
        widths.append((b - a) / max(a, b))
    got = clusters.silhouette(df, "id", names(x), tile).first()[0]
    assert got == pytest.approx(np.mean(widths)) and -1 <= got <= 1
    mid = np.array([y[k == j].mean(0) for j in range(4)])
    scatter = np.array([np.sqrt(((y[k == j] - mid[j]) ** 2).sum(1)).mean() for j in range(4)])
    apart = np.sqrt(((mid[:, None] - mid[None]) ** 2).sum(2))
    worst = [max((scatter[i] + scatter[j]) / apart[i, j] for j in range(4) if j != i) for i in range(4)]
    assert clusters.davies_bouldin(df, names(x), tile=max(2, tile // 4)).first()[0] == pytest.approx(np.mean(worst))
    within = sum(((y[k == j] - mid[j]) ** 2).sum() for j in range(4))
    between = sum((k == j).sum() * ((mid[j] - y.mean(0)) ** 2).sum() for j in range(4))
    want = (between / 3) / (within / (len(y) - 4))
    assert clusters.calinski_harabasz(df, names(x)).first()[0] == pytest.approx(want)


def test_standardise_uses_population_deviation(spark):
    x = np.array([[1.0, 5.0], [2.0, 5.0], [6.0, 5.0]])
    got = clusters.standardise(frame(spark, x), ["f0", "f1"]).toPandas().sort_values("id")
    assert got["f0"].to_numpy() == pytest.approx((x[:, 0] - 3) / x[:, 0].std())
    assert list(got["f1"]) == [0, 0, 0]


def test_centroid_and_split_models_find_the_blobs(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(m, 0.1, size=(30, 2)) for m in (-3, 0, 3)])
    df = frame(spark, x)
    truth = np.repeat([0, 1, 2], 30)
    for labels in (clusters.kmeans(df, "id", names(x), 3, n_init=2), clusters.divisive(df, "id", names(x), 3), clusters.mixture(df, "id", names(x), 3)):
        got = labels_of(labels)
        assert len(set(zip(got, truth))) == 3
    runs = clusters.cluster_grid(df, "id", names(x), {"Hierarchical": {"n_clusters": [2, 3]}})
    assert cluster_champion(runs).first()["params"] == {"n_clusters": "3"}


def test_bundles_need_two_items(spark):
    products = spark.createDataFrame([("a", 2, 20.0), ("b", 2, 20.0), ("c", 1, 30.0)], "item_name string, lines long, unit_price_sum double")
    labels = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "item_name string, cluster int")
    got = clusters.cluster_bundles(products, labels).collect()
    assert len(got) == 1 and got[0]["bundle_type"] == "Budget Friendly" and got[0]["popularity"] == 4
    assert got[0]["recommendation"] == "Offer 2 of its items together"


@pytest.mark.parametrize("p, weights, leaf", [(2, "uniform", 4096), (1, "distance", 6), (2, "distance", 6)])
def test_neighbours_match_brute_force(spark, monkeypatch, p, weights, leaf):
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, size=(80, 3)).astype(float)
    df = frame(spark, x, y=rng.random(80))
    train, test = df.where("id < 60"), df.where("id >= 60")
    y = df.toPandas().sort_values("id")["y"].to_numpy()
    got = neighbours.knn_regression(train, test, names(x), "y", "id", 5, weights, p).toPandas().sort_values("id")["prediction"].to_numpy()
    want = []
    for i in range(60, 80):
        gap = np.abs(x[:60] - x[i])
        dist = gap.sum(1) if p == 1 else np.sqrt((gap**2).sum(1))
        best = np.lexsort((np.arange(60), dist))[:5]
        if weights == "uniform":
            want.append(y[best].mean())
        elif (dist[best] == 0).any():
            want.append(y[best][dist[best] == 0].mean())
        else:
            want.append(np.average(y[best], weights=1 / dist[best]))
    assert got == pytest.approx(np.array(want))


@pytest.mark.parametrize("p", [1, 2])
def test_rows_of_a_neighbour_search_grow_with_the_rows(spark, p):
    """Each row visits about as many cells whatever the number of rows."""
    rng, visits = np.random.default_rng(7), []
    metric = "manhattan" if p == 1 else "euclidean"
    for n in (1500, 3000, 6000):
        x = rng.random((n, 2))
        points = frame(spark, x).select(F.array(*names(x)).alias("x"), F.col("id").alias("train_key"), F.lit(0.0).alias("value"))
        tree = cells.build(points, 2, 60)
        test = tree.home(frame(spark, x).select(F.col("id").alias("key"), F.array(*names(x)).alias("x")), metric, 3)
        more = neighbours.further(test, neighbours.search(test, tree.points, 3, p), tree, 3, metric)
        visits.append(1 + more.count() / n)
    assert max(visits) < 6 and visits[2] <= 1.1 * visits[0]


def test_rows_of_one_partition_go_down_the_tree_in_parts(spark, monkeypatch):
    x = np.random.default_rng(8).random((2000, 2))
    points = frame(spark, x).select(F.array(*names(x)).alias("x"), F.col("id").alias("train_key"), F.lit(0.0).alias("value"))
    tree = cells.build(points, 2, 60)
    rows = frame(spark, x).select(F.col("id").alias("key"), F.array(*names(x)).alias("x")).coalesce(1)
    monkeypatch.setattr(cells, "meet", partial(cells.meet, task_rows=100))
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        found = tree.home(rows, "euclidean", 3)
        assert found.count() == 2000 and found.select(F.spark_partition_id()).distinct().count() > 1
        assert found.join(tree.leaves(), "cell").count() == 2000
    finally:
        spark.conf.unset(merged)


def test_training_rows_with_missing_numbers_are_no_neighbours(spark):
    train = spark.createDataFrame([(i, float(i), None if i % 2 else 0.0, float(i)) for i in range(8)], "id long, f0 double, f1 double, y double")
    test = spark.createDataFrame([(10, 0.0, 0.0)], "id long, f0 double, f1 double")
    got = neighbours.nearest(train, test, ["f0", "f1"], "y", "id", 6).orderBy("rank").collect()
    assert [r["train_key"] for r in got] == [0, 2, 4, 6]


def test_far_and_crowded_neighbours(spark):
    """Rows far outside, equal points (lowest keys win) and cells with fewer points than asked for."""
    x = np.concatenate([np.zeros((300, 2)), np.random.default_rng(2).random((200, 2)), [[50.0, 50.0]]])
    df = frame(spark, x, y=np.arange(501.0))
    test = spark.createDataFrame([(1000, 0.0, 0.0), (1001, 60.0, 60.0), (1002, -30.0, 0.5)], "id long, f0 double, f1 double")
    got = neighbours.nearest(df, test, names(x), "y", "id", 4, leaf=20)
    found = got.toPandas().sort_values("rank").groupby("key")["train_key"].apply(list)
    for key, point in ((1000, [0, 0]), (1001, [60, 60]), (1002, [-30, 0.5])):
        dist = np.sqrt(((x - np.array(point)) ** 2).sum(1))
        assert found[key] == np.lexsort((np.arange(len(x)), dist))[:4].tolist()


def test_squared_silhouette_from_moments(spark):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(80, 3)), np.arange(80) % 5 - 1
    c[5] = 7  # a cluster of one point
    df = frame(spark, x, cluster=c).withColumn("cluster", F.col("cluster").cast("int"))
    y, k = x[c != -1], c[c != -1]
    dist = ((y[:, None] - y[None]) ** 2).sum(2)
    widths = []
    for i in range(len(y)):
        if (k == k[i]).sum() == 1:
            widths.append(0.0)
            continue
        a = dist[i, k == k[i]].sum() / ((k == k[i]).sum() - 1)
        b = min(dist[i, k == j].mean() for j in set(k) - {k[i]})
        widths.append((b - a) / max(a, b))
    assert clusters.silhouette_squared(df, names(x)).first()[0] == pytest.approx(np.mean(widths))
    assert clusters.silhouette_squared(df.where("cluster <= 0"), names(x)).first()[0] == -1.0
    assert clusters.scores(df, "id", names(x))[0] != clusters.scores(df, "id", names(x), exact=True)[0]


def test_tiles_cover_every_pair_once(spark):
    left = spark.range(23).withColumnRenamed("id", "a")
    right = spark.range(31).withColumnRenamed("id", "b")
    out = tiles.tiled(left, right, "a", "b", lambda x, y: pd.DataFrame({"a": x["a"], "n": len(y), "s": y["b"].sum()}), "a long, n long, s long", tile=5)
    got = out.groupBy("a").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    assert len(got) == 23 and all((r["n"], r["s"]) == (31, 465) for r in got)


def test_blocks_of_a_set_meet_once_for_both_sides(spark):
    rows = spark.range(23).withColumn("block", F.floor(F.col("id") / 5))

    def each(a, b):
        whole = a if b is None else pd.concat([a, b])
        return pd.DataFrame({"low": [whole["id"].min()], "high": [whole["id"].max()], "n": [len(whole)]})

    got = sorted(tuple(r) for r in tiles.tiled_self(rows, "block", 5, each, "low long, high long, n long").collect())
    blocks = [list(range(i, min(i + 5, 23))) for i in range(0, 23, 5)]
    assert got == sorted((a[0], b[-1], len(a) if a is b else len(a) + len(b)) for i, a in enumerate(blocks) for b in blocks[i:])


def test_silhouette_forms_each_distance_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x, c = rng.normal(size=(40, 3)), np.sort(np.arange(40) % 3)
    side = [clusters._Side(pd.DataFrame({"key": range(20), "cluster": k, **dict(zip(names(x), y.T))}), names(x)) for y, k in ((x[::2], c[::2]), (x[1::2], c[1::2]))]
    monkeypatch.setattr(clusters, "CHUNK_ROWS", 3)
    monkeypatch.setattr(clusters, "CHUNK_COLUMNS", 7)
    apart = np.sqrt(((x[::2, None] - x[None, 1::2]) ** 2).sum(2))
    to_b, to_a = clusters._summed_distances(*side, True)
    assert to_b == pytest.approx(np.stack([apart[:, c[1::2] == k].sum(1) for k in range(3)], 1))
    assert to_a == pytest.approx(np.stack([apart[c[::2] == k].sum(0) for k in range(3)], 1))


def test_points_of_one_small_file_are_dealt_to_all_cores(spark, tmp_path):
    rows = spark.range(40_000).select("id", F.col("id").cast("double").alias("x"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    data = clusters.points(spark.read.parquet(str(tmp_path / "one")), "id", ["x"])
    assert data.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)
    assert data.agg(F.count("id"), F.sum("x")).first()[:] == (40_000, 40_000 * 39_999 / 2)


def test_joins_on_rows_are_not_broadcast_by_a_guess(spark, monkeypatch):
    from salescope import session

    points = spark.range(60).select("id", (F.col("id") % 20 + F.floor(F.col("id") / 20) * 100).cast("double").alias("x"), F.lit(0.0).alias("y"))
    usual = {tuple(r) for r in density.dbscan(points, "id", ["x", "y"], 1.0, 2).collect()}
    monkeypatch.setattr(session, "SENT_ROWS", 10)
    found = density.dbscan(points, "id", ["x", "y"], 1.0, 2)
    assert found._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") >= 3
    assert {tuple(r) for r in found.collect()} == usual == {(i, i // 20) for i in range(60)}
