"""The additive model: held-out accuracy, interactions, tables as the sum of a score."""

from __future__ import annotations

import edge_tables
import numpy as np

from shelfwise.llm import quality_gam as Q

FOLDER = "/root/testdata/sf0.01"
SMALL = Q.Rule(bags=3, rounds=80)


def test_held_out_accuracy_and_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{x}.parquet") for x in ("documents", "labels"))
    rows = Q.score_documents(docs, labels).join(labels, "doc_id").toPandas()
    held = rows[rows.held_out]
    assert len(held) > 50
    assert (held.predicted == held.quality).mean() >= 0.95
    assert held.predicted[held.quality == 1].mean() >= 0.98
    good, bad = held.score[held.quality == 1], held.score[held.quality == 0]
    assert (good.to_numpy()[:, None] > bad.to_numpy()[None]).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = (spark.read.parquet("/root/testdata/sf0.001/%s.parquet" % x)
                    for x in ("documents", "labels"))
    turned = labels.withColumn("quality", Q.F.when(Q.training_rows(Q.F.col("doc_id")), Q.F.col(
        "quality")).otherwise(1 - Q.F.col("quality")).cast("int"))
    a, b = (sorted(map(tuple, Q.score_documents(docs, x, rule=SMALL).collect()))
            for x in (labels, turned))
    assert a == b and len(a) == docs.count()


def test_pairs_learn_what_no_single_feature_shows(spark):
    draw = np.random.default_rng(0)
    rows = draw.uniform(-1, 1, (4000, 4))
    good = (rows[:, 1] * rows[:, 3] > 0).astype(int)
    rule = SMALL._replace(pairs=2)
    model = Q.fit(spark, rows, good, {0: 2000, 1: 2000}, rule)
    assert (1, 3) in model.pairs
    test = draw.uniform(-1, 1, (2000, 4))
    truth = test[:, 1] * test[:, 3] > 0
    assert ((model.scores(test) > 0.5) == truth).mean() > 0.9
    alone = model._replace(pairs=[], pair_tables=[])
    assert ((alone.scores(test) > 0.5) == truth).mean() < 0.65
    binned = Q.binned_rows(test, model.edges)
    total = model.intercept + sum(model.tables[j][binned[:, j]] for j in range(4)) + sum(
        t[Q.coarse(binned[:, i], model), Q.coarse(binned[:, j], model)]
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
    assert np.allclose(model.scores(test), 1 / (1 + np.exp(-total)))


def test_tree_is_the_best_of_all_cuts():
    draw = np.random.default_rng(3)
    for _ in range(50):
        g, h = draw.normal(size=9), draw.uniform(0.5, 2, 9)
        gain, at = Q.best_cut(g, h, 1.0)
        every = [(g[:i].sum() ** 2 / (h[:i].sum() + 1) + g[i:].sum() ** 2 / (h[i:].sum() + 1)
                  - g.sum() ** 2 / (h.sum() + 1), i) for i in range(1, 9)
                 if h[:i].sum() >= 1 and h[i:].sum() >= 1]
        assert np.isclose(gain, max(every)[0]) and at == max(every)[1]
        assert len(set(Q.grown(g, h, 1.0).tolist())) <= 3


def test_features_read_whole_texts(monkeypatch):
    long = edge_tables.words(1, 5000)
    whole = Q.features(long)
    real = Q.word_blocks
    monkeypatch.setattr(Q, "word_blocks", lambda data: real(data, 100))
    assert Q.features(long) == whole
    assert Q.features(long + " zzz") != whole
    assert Q.features(None) == Q.features(" \n\t") == [0.0] * len(Q.FEATURES)
    assert len(Q.features("a")) == len(Q.FEATURES)


def test_edge_rows_and_missing_labels(spark):
    docs = edge_tables.table(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (7, 1), (8, 0), (None, 0), (9, None)],
                                   "doc_id long, quality int")
    got = Q.score_documents(docs, labels, rule=SMALL).collect()
    assert len(got) == len(edge_tables.rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (4, 5, 6)}
    assert len(empty) == 1
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    one = Q.score_documents(docs, labels.where("quality = 1"), rule=SMALL).collect()
    assert {r["score"] for r in one} == {1.0}
    assert {r["score"] for r in Q.score_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert Q.score_documents(edge_tables.empty(spark), labels, rule=SMALL).count() == 0
