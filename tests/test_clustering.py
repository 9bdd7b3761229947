"""Clustering, scores, projection and isolation forest against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import (
    anomaly, cluster_scores, clustering, disruption, kmeans, pairs, spatial)
from shelfwise.operators.anomaly import expected_depth, isolation_forest


def frame(spark, x):
    return spark.createDataFrame([(f"e{i:03d}", [float(v) for v in row])
                                  for i, row in enumerate(x)], "entity string, vec array<double>")


def labels_of(df, run=None):
    rows = df.collect() if run is None else df.where(F.col("run") == run).collect()
    return [r.label for r in sorted(rows, key=lambda r: r.entity)]


def apart(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of five rows, so that clusters are spread over several of them."""
    monkeypatch.setattr(pairs, "BLOCK", 5)
    monkeypatch.setattr(clustering, "BLOCK", 5)
    monkeypatch.setattr(cluster_scores, "BLOCK", 5)
    monkeypatch.setattr(clustering, "LAST", 4)
    whole = clustering.spatial_blocks
    monkeypatch.setattr(clustering, "spatial_blocks", lambda df: whole(df, 5))


def greedy(x, linkage, k):
    """Merge the closest two clusters until k are left."""
    groups = [[i] for i in range(len(x))]
    d = apart(x)

    def between(a, b):
        if linkage == "ward":
            gap = np.linalg.norm(x[a].mean(axis=0) - x[b].mean(axis=0))
            return np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * gap
        part = d[np.ix_(a, b)]
        return part.max() if linkage == "complete" else part.mean()

    while len(groups) > k:
        i, j = min(((i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))),
                   key=lambda p: between(groups[p[0]], groups[p[1]]))
        groups[i] += groups.pop(j)
    label = np.zeros(len(x), dtype=int)
    for n, members in enumerate(sorted(groups, key=min)):
        label[members] = n
    return label.tolist()


def test_agglomerative_matches_greedy(spark, small_blocks):
    x = np.random.default_rng(2).normal(size=(26, 3))
    got = clustering.hierarchical_clusters(frame(spark, x), k=4)
    for linkage in clustering.LINKAGES:
        assert labels_of(got, linkage) == greedy(x, linkage, 4), linkage


def test_agglomerative_with_copies(spark):
    x = np.repeat([[0.0, 0.0], [5.0, 0.0], [0.0, 9.0]], [6, 3, 1], axis=0)
    got = clustering.hierarchical_clusters(frame(spark, x), k=3)
    for linkage in clustering.LINKAGES:
        assert labels_of(got, linkage) == [0] * 6 + [1] * 3 + [2]


def test_many_copies_merge_in_few_rounds(spark, monkeypatch):
    rounds = []
    mutual = clustering._mutual
    monkeypatch.setattr(clustering, "_mutual", lambda near: rounds.append(1) or mutual(near))
    x = np.vstack([np.zeros((50, 2)), np.random.default_rng(1).normal(8, 1, (5, 2))])
    got = clustering.hierarchical_clusters(frame(spark, x), ("complete",), k=2)
    assert labels_of(got) == [0] * 50 + [1] * 5
    assert len(rounds) < 20


def dense(x, eps, m):
    """Density clusters in row order."""
    near = apart(x) <= eps
    core = near.sum(axis=1) >= m
    label, n = np.full(len(x), -1), 0
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if label[j] == -1:
                label[j] = n
                if core[j]:
                    todo += np.flatnonzero(near[j] & (label == -1)).tolist()
        n += 1
    return label.tolist()


def test_density_clusters_match(spark, small_blocks):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 0.3, (14, 2)), rng.normal(2, 0.3, (14, 2)),
                   [[1.0, 1.0], [9.0, 9.0]], np.zeros((4, 2))])
    got = clustering.dbscan_clusters(frame(spark, x), (0.3, 0.5, 0.9), 4)
    for eps in (0.3, 0.5, 0.9):
        assert labels_of(got, f"eps={eps}") == dense(x, eps, 4), eps
    assert labels_of(clustering.dbscan_clusters(frame(spark, x), (0.0001,), 9)) == [-1] * len(x)


def chain_links(spark, small_blocks=None):
    return np.column_stack([np.arange(40) * 0.9, np.zeros(40)])


def test_long_chain_is_one_cluster(spark, small_blocks):
    x = chain_links(spark)[np.random.default_rng(0).permutation(40)]
    assert set(labels_of(clustering.dbscan_clusters(frame(spark, x), (1.0,), 3))) == {0}


def scores(x, label):
    keep = label != -1
    x, label = x[keep], label[keep]
    d, ks = apart(x), np.unique(label)
    s = []
    for i in range(len(x)):
        mates = (label == label[i])
        if mates.sum() == 1:
            s.append(0.0)
            continue
        a = d[i][mates].sum() / (mates.sum() - 1)
        b = min(d[i][label == k].mean() for k in ks if k != label[i])
        s.append((b - a) / max(a, b))
    centers = np.array([x[label == k].mean(axis=0) for k in ks])
    spread = np.array([np.linalg.norm(x[label == k] - c, axis=1).mean()
                       for k, c in zip(ks, centers)])
    gap = apart(centers)
    db = np.mean([max((spread[i] + spread[j]) / gap[i, j] for j in range(len(ks)) if j != i)
                  for i in range(len(ks))])
    between = sum((label == k).sum() * ((c - x.mean(axis=0)) ** 2).sum()
                  for k, c in zip(ks, centers))
    within = sum(((x[label == k] - c) ** 2).sum() for k, c in zip(ks, centers))
    return np.mean(s), db, between * (len(x) - len(ks)) / (within * (len(ks) - 1))


def test_scores_match_and_skip_noise(spark, small_blocks):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(23, 3))
    label = rng.integers(0, 3, 23)
    label[:2], label[2] = -1, 7  # two noise rows, one alone
    labelled = frame(spark, x).withColumn(
        "label", F.array(*[F.lit(int(v)) for v in label])[
            F.substring("entity", 2, 3).cast("int")]).withColumn("run", F.lit("r"))
    one = labelled.withColumns({"run": F.lit("one"), "label": F.lit(0)})
    got = {r.run: r for r in cluster_scores.cluster_scores(labelled.unionByName(one)).collect()}
    r = got["r"]
    assert (r.silhouette, r.davies_bouldin, r.calinski_harabasz) == pytest.approx(scores(x, label))
    assert got["one"].silhouette is None and got["one"].calinski_harabasz is None


def test_kmeans_finds_planted_groups(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.1, (12, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    got = clustering.kmeans_sweep(frame(spark, x), [2, 3], n_init=4)
    label = np.array(labels_of(got, "k=3")).reshape(3, 12)
    assert all(len(set(group)) == 1 for group in label) and len(set(label[:, 0])) == 3
    again = clustering.kmeans_sweep(frame(spark, x), [2, 3], n_init=4)
    assert labels_of(again, "k=3") == labels_of(got, "k=3")


def test_kmeans_centers_are_means(spark):
    x = np.random.default_rng(6).normal(size=(30, 2))
    centers = kmeans.fit_centers(frame(spark, x), [3], 5, 1)[3]
    label = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    for k in range(3):
        assert np.allclose(centers[k], x[label == k].mean(axis=0), atol=0.05)


def test_choice_orders_and_fallback(spark):
    rows = [("K-Means", "k=2", 2, 0.9, 0.1, 90.0), ("DBSCAN", "eps=0.75", 3, 0.1, 0.9, 10.0),
            ("Hierarchical", "linkage=ward,k=4", 4, 0.5, 0.5, 50.0),
            ("DBSCAN", "eps=0.5", 0, None, None, None)]
    table = spark.createDataFrame(rows, "model string, parameters string, clusters int, "
                                        "silhouette double, davies_bouldin double, "
                                        "calinski_harabasz double")
    best = clustering.choose_best(table).first()
    assert (best.model, best.parameter, best.rank_score) == ("K-Means", 2.0, 1.0)
    worst = clustering.choose_best(table, "reference").first()
    assert (worst.model, worst.parameter, worst.rank_score) == ("DBSCAN", 0.75, 3.0)
    none = clustering.choose_best(table.where("silhouette is null")).first()
    assert (none.model, none.parameter) == ("K-Means", 4.0)


def test_projection_matches_eigenvectors(spark):
    x = np.random.default_rng(9).normal(size=(40, 4)) * [3, 2, 1, 0.5]
    x -= x.mean(axis=0)
    got = sorted(disruption.pca_2d(frame(spark, x)).collect(), key=lambda r: r.entity)
    values, vectors = np.linalg.eigh(x.T @ x)
    for n, name in ((1, "pc1"), (2, "pc2")):
        v = vectors[:, -n] * np.sign(vectors[np.abs(vectors[:, -n]).argmax(), -n])
        assert np.allclose([r[name] for r in got], x @ v)
        assert got[0][f"explained_variance_{name}"] == pytest.approx(values[-n] / values.sum())


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([("a", 1.0, 0.1), ("b", 3.0, 0.1), ("c", None, 0.1)],
                               "supplier string, x double, same double")
    got = sorted(disruption.scale_features(df, ["x", "same"]).collect())
    x = np.array([1.0, 3.0, 0.0])
    assert [r.x for r in got] == pytest.approx(((x - x.mean()) / x.std()).tolist())
    assert [r.same for r in got] == [0.0, 0.0, 0.0]


def test_forest_finds_a_planted_outlier(spark):
    x = np.vstack([np.random.default_rng(1).normal(0, 1, (400, 3)), [[12.0, -12.0, 12.0]]])
    got = isolation_forest(frame(spark, x), 100).collect()
    assert all(0 < r.anomaly_score < 1 for r in got)
    top = max(got, key=lambda r: r.anomaly_score)
    assert (top.entity, top.anomaly_status) == ("e400", "ANOMALY")
    assert all((r.anomaly_status == "ANOMALY") == (r.anomaly_score > 0.5) for r in got)
    again = {r.entity: r.anomaly_score for r in isolation_forest(frame(spark, x), 100).collect()}
    assert again == {r.entity: r.anomaly_score for r in got}


def test_expected_depth():
    assert [expected_depth(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert expected_depth(256) == pytest.approx(10.24, abs=0.01)


def test_a_k_alone_is_what_the_sweep_scored(spark):
    x = np.random.default_rng(12).normal(size=(60, 3))
    points = frame(spark, x)
    sweep = clustering.kmeans_sweep(points, [2, 3, 4, 5], n_init=3)
    for k in (3, 5):
        alone = clustering.kmeans_sweep(points, [k], n_init=3)
        assert labels_of(alone, f"k={k}") == labels_of(sweep, f"k={k}")


def test_unsettled_kmeans_raises(spark):
    x = np.random.default_rng(2).normal(size=(50, 2))
    with pytest.raises(RuntimeError, match="still move"):
        kmeans.fit_centers(frame(spark, x), [6], 2, 1, max_steps=1)


def test_chosen_labels_are_those_that_were_scored(spark):
    x = np.random.default_rng(7).normal(size=(40, 3))
    labelled = clustering.label_runs(frame(spark, x), n_init=2)
    compared = clustering.compare_clustering(frame(spark, x), 2, labelled)
    assert {r.parameters for r in compared.collect() if r.model == "Hierarchical"} == {
        f"linkage={name},k=4" for name in clustering.LINKAGES}
    for model, parameter, run in (("K-Means", 4.0, "K-Means|k=4"), ("DBSCAN", 1.25, "DBSCAN|eps=1.25"),
                                  ("Hierarchical", 4.0, "Hierarchical|linkage=ward,k=4")):
        got = clustering.labels_of_choice(labelled, model, parameter)
        want = labelled.where(F.col("run") == run)
        assert {tuple(r) for r in got.collect()} == {(r.entity, r.label) for r in want.collect()}
        assert got.count() == 40
    assert clustering.labels_of_choice(labelled, "K-Means", 99.0).isEmpty()


def test_all_merges_in_one_task_match_greedy(spark):
    x = np.random.default_rng(5).normal(size=(30, 3))
    got = clustering.hierarchical_clusters(frame(spark, x), k=5)
    for linkage in clustering.LINKAGES:
        assert labels_of(got, linkage) == greedy(x, linkage, 5), linkage


def test_only_clusters_beside_merges_are_compared_again(spark, small_blocks, monkeypatch):
    compared = []
    pairs_of = clustering._cluster_pairs

    def counted(left, right, blocks, every):
        if not every:
            compared.append((left.select("run", "cluster").distinct().count(),
                             right.select("run", "cluster").distinct().count()))
        return pairs_of(left, right, blocks, every)

    monkeypatch.setattr(clustering, "_cluster_pairs", counted)
    x = np.random.default_rng(2).normal(size=(16, 3))
    got = clustering.hierarchical_clusters(frame(spark, x), ("complete",), k=4)
    assert labels_of(got) == greedy(x, "complete", 4)
    assert compared[0] == (16, 16) and len(compared) > 1
    assert all(left < right for left, right in compared[1:])


def test_far_blocks_are_never_paired(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(c, 0.1, (40, 2)) for c in ((0, 0), (9, 0), (0, 9), (9, 9))]
                  + [np.full((30, 2), 4.5)])
    placed = spatial.spatial_blocks(frame(spark, x), 10)
    sizes = [r["count"] for r in placed.groupBy("block").count().collect()]
    assert sum(sizes) == len(x) and len(sizes) >= 16
    links = spatial.near_pairs(placed, 0.5)
    found = {(r.a, r.b) for r in links.collect()}
    vec = {}
    for row in placed.collect():
        vec.setdefault(row.block, []).append(row.vec)
    near = {(a, b) for a in vec for b in vec if a <= b
            and min(np.linalg.norm(np.subtract(p, q)) for p in vec[a] for q in vec[b]) <= 0.5}
    assert near <= found
    assert len(found) < len(vec) * (len(vec) + 1) / 4
    assert all(a <= b for a, b in found)


def test_splits_part_a_sample_and_keep_copies_together():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(4000, 3))
    cells = spatial.range_splits(x[:500], 16).cells(x)
    assert np.bincount(cells, minlength=16).min() > 100
    same = np.zeros((50, 2))
    assert set(spatial.range_splits(same, 8).cells(same)) == {0}
    assert spatial.range_splits(x, 1).cells(x).max() == 0


def test_dbscan_of_no_rows(spark):
    none = frame(spark, np.zeros((1, 2))).limit(0)
    assert clustering.dbscan_clusters(none).count() == 0
    assert clustering.hierarchical_clusters(none).count() == 0


def test_samples_are_the_smallest_draws_of_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "DRAWN_AT_ONCE", 7)
    x = np.random.default_rng(4).normal(size=(90, 2))
    points = frame(spark, x).repartition(5)
    got = {}
    for row in anomaly._samples(points, 12, 9, 3).collect():
        got.setdefault(row.tree, []).append((row._n, tuple(row.vec)))
    seeds = {tuple(r.vec): r.seed for r in points.select(
        "vec", F.xxhash64(F.lit(3), "entity").alias("seed")).collect()}
    vecs = list(seeds)
    every = anomaly.draws(np.array([seeds[v] for v in vecs]), np.arange(9))
    assert len(got) == 9
    for tree, sample in got.items():
        want = [vecs[i] for i in every[tree].argsort()[:12]]
        assert [v for _, v in sorted(sample)] == want
    few = anomaly._samples(points.limit(4), 12, 2, 3).groupBy("tree").count().collect()
    assert [r["count"] for r in few] == [4, 4]
