"""Features, metrics, tree export, recursion and attribution."""

import threading
from datetime import date, timedelta
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import attribution, disruption, features, forecast
from shelfwise.operators.trees import TreeArrays, export_trees
from shelfwise.plans.pipeline import run_pipeline


def series(spark, demands, store="s", start=date(2024, 1, 1), skip=()):
    days = [start + timedelta(days=i) for i in range(len(demands) + len(skip)) if i not in skip]
    return spark.createDataFrame(
        [(store, "p", "c", d, v, i % 2, float(i % 5), 9.5)
         for i, (d, v) in enumerate(zip(days, demands))],
        "store string, product string, category string, date date, demand long, "
        "promo_event long, discount_pct double, unit_price double")


def test_lags_count_rows_not_days(spark):
    rows = features.demand_lags(series(spark, list(range(10)), skip=(3,))).orderBy("date").collect()
    assert [r.lag_1 for r in rows[:5]] == [None, 0, 1, 2, 3]
    assert (rows[7].lag_7, rows[9].lag_14) == (0, None)


def test_rolling_waits_for_a_full_window(spark):
    rows = features.demand_rolling(series(spark, [4, 8] * 20)).orderBy("date").collect()
    assert rows[6].rolling_mean_7 is None
    assert rows[7].rolling_mean_7 == pytest.approx(np.mean([4, 8, 4, 8, 4, 8, 4]))
    assert rows[7].rolling_std_7 == pytest.approx(np.std([4, 8, 4, 8, 4, 8, 4], ddof=1))
    assert rows[29].rolling_mean_30 is None and rows[30].rolling_mean_30 == 6.0


def test_training_set_drops_short_series(spark):
    daily = series(spark, [3] * 61, "long").unionByName(series(spark, [3] * 60, "short"))
    got = features.forecast_training_set(daily)
    assert {r.store for r in got.collect()} == {"long"} and got.count() == 31


def test_split_boundary_and_empty_side(spark):
    daily = series(spark, [1] * 100)
    train, test = features.train_and_test(daily)
    assert (train.count(), test.count()) == (40, 60)
    with pytest.raises(ValueError, match="empty"):
        features.train_and_test(daily, days=200)


def test_metrics_leave_out_zero_actuals(spark):
    df = spark.createDataFrame([(0, 3.0), (4, 5.0), (10, 8.0)], "y long, p double")
    row = forecast.forecast_metrics(df, "y", "p", "m").first()
    assert (row.MAE, row.MAPE) == (2.0, pytest.approx(100 * (0.25 + 0.2) / 2))
    assert row.RMSE == pytest.approx(np.sqrt(14 / 3))
    zeros = forecast.forecast_metrics(df.where("y = 0"), "y", "p", "m").first()
    assert zeros.MAPE == 0


def test_folds_expand(spark):
    data = series(spark, [1] * 43)
    got = {(r.fold, r.role): r["n"] for r in features.walk_forward_folds(data).groupBy(
        "fold", "role").agg(F.count("*").alias("n")).collect()}
    start, size = 25, 4
    assert got == {(f, role): n for f in range(1, 5)
                   for role, n in (("train", start + (f - 1) * size), ("test", size))}


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(5)
    daily = None
    for s in range(4):
        demand = [int(v) for v in 20 + 5 * s + 6 * np.sin(np.arange(120)) + rng.normal(0, 2, 120)]
        one = series(spark, demand, f"s{s}")
        daily = one if daily is None else daily.unionByName(one)
    daily = daily.persist()
    train, test = features.train_and_test(features.forecast_training_set(daily))
    model = forecast.fit_boosted(train, forecast.BoostParams(trees=4, depth=3))
    return daily, train.persist(), test.persist(), model, export_trees(spark, model)


def test_exported_trees_predict_like_the_model(fitted):
    _, _, test, model, trees = fitted
    rows = forecast.predict_demand(model, test).select(
        *features.FEATURES, "predicted_demand").toPandas()
    ours = np.maximum(trees.predict(rows[features.FEATURES].to_numpy(float)), 0)
    assert np.allclose(ours, rows["predicted_demand"])


def test_hold_out_row(fitted):
    _, train, test, model, _ = fitted
    row = forecast.boosted_forecast(model, train, test).first()
    got = forecast.test_predictions(model, test).toPandas()
    error = got["demand"] - got["predicted_demand"]
    assert (row.train_rows, row.test_rows, row.sku_store_pairs) == (120, 240, 4)
    assert row.MAE == pytest.approx(error.abs().mean())
    assert row.RMSE == pytest.approx(np.sqrt((error ** 2).mean()))


def test_recursion_feeds_predictions_back(fitted):
    daily, _, _, _, trees = fitted
    got = forecast.recursive_forecast(trees, daily).where("store = 's1'").orderBy("date").toPandas()
    history = [float(r.demand) for r in daily.where("store = 's1'").orderBy("date").collect()]
    last = daily.where("store = 's1'").agg(F.max("date")).first()[0]
    assert len(got) == 30 and set(got["unit_price"]) == {9.5}
    for i, row in got.iterrows():
        day = last + timedelta(days=i + 1)
        h = history
        x = np.array([[h[-1], h[-7], h[-14], h[-30], np.mean(h[-7:]), np.mean(h[-30:]),
                       np.std(h[-7:], ddof=1), day.weekday(), day.month, day.day,
                       day.weekday() >= 5, 0, 0]], dtype=float)
        value = max(float(trees.predict(x)[0]), 0.0)
        assert row["date"] == day and row["forecast_demand"] == pytest.approx(value, abs=0.006)
        history.append(value)


def test_short_series_are_not_forecast(spark):
    daily = series(spark, [5] * 29)
    assert forecast.recursive_forecast(forecast.SeasonalNaive(), daily).isEmpty()


def brute_force(trees, row):
    """Shapley values by enumerating all coalitions with the path-dependent value function."""
    names = features.FEATURES

    def expect(t, node, known):
        f = trees.feature[t, node]
        if f < 0:
            return trees.value[t, node]
        left, right = trees.left[t, node], trees.right[t, node]
        if f in known:
            return expect(t, left if row[f] <= trees.threshold[t, node] else right, known)
        share = trees.cover[t, left] / trees.cover[t, node]
        return share * expect(t, left, known) + (1 - share) * expect(t, right, known)

    used = sorted(set(trees.feature[trees.feature >= 0].tolist()))
    value = lambda known: sum(expect(t, 0, known) for t in range(trees.feature.shape[0]))
    out, m = np.zeros(len(names)), len(used)
    for f in used:
        others = [o for o in used if o != f]
        for size in range(m):
            weight = factorial(size) * factorial(m - size - 1) / factorial(m)
            for group in combinations(others, size):
                out[f] += weight * (value({*group, f}) - value(set(group)))
    return out


def test_attribution_matches_brute_force_and_adds_up(fitted):
    _, train, _, _, trees = fitted
    x = train.select(*features.FEATURES).toPandas().to_numpy(float)
    values = attribution.Attributor(trees).values(x)
    assert np.allclose(values.sum(axis=1) + attribution.base_value(trees), trees.predict(x))
    assert np.allclose(values[7], brute_force(trees, x[7]))


def full_trees(depth, trees=3):
    """Complete trees with random cuts, some of them on features cut before."""
    rng = np.random.default_rng(8)
    many = 2 ** (depth + 1) - 1
    node, inner = np.arange(many), np.arange(many) < 2 ** depth - 1
    grid = lambda row: np.tile(row, (trees, 1))
    feature = np.where(inner, rng.integers(0, 13, (trees, many)), -1)
    cover = np.zeros((trees, many))
    cover[:, ~inner] = rng.integers(1, 9, (trees, 2 ** depth))
    for n in node[inner][::-1]:
        cover[:, n] = cover[:, 2 * n + 1] + cover[:, 2 * n + 2]
    return TreeArrays(feature, rng.normal(size=(trees, many)), grid(np.where(inner, 2 * node + 1, -1)),
                      grid(np.where(inner, 2 * node + 2, -1)), rng.normal(size=(trees, many)), cover)


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 6])
def test_subtrees_pay_what_their_leaves_pay(depth):
    """Each leaf on its own, by its bounds; a tree of 64 leaves is looked up 16 times a row."""
    trees = full_trees(depth)
    x = np.random.default_rng(9).normal(size=(200, 13))
    x[:50] = trees.threshold[0, 0]  # on a cut
    want = np.zeros_like(x)
    for value, names, bounds in attribution.leaf_games(trees):
        if names:
            fits = (x[:, names] > bounds[:, 0]) & (x[:, names] <= bounds[:, 1])
            table = attribution.outcome_tables(np.array([value]), bounds[None, :, 2])[0]
            want[:, names] += table[fits @ (1 << np.arange(len(names)))]
    made = attribution.Attributor(trees)
    assert np.allclose(made.values(x), want, atol=1e-12)
    assert all(len(game.pays) <= 2 ** max(0, depth - 2) for game in made.games)


def test_chain_fits_trees_beside_what_needs_none(spark, monkeypatch, tmp_path):
    """The fit waits here until the clusterings and the other tables of the fact have begun."""
    begun = {name: threading.Event() for name in ("disruption", "finance")}

    def fitting(*_):
        assert all(event.wait(60) for event in begun.values())
        raise InterruptedError("fit was reached")

    def starting(name):
        def start(*_):
            begun[name].set()
            raise InterruptedError("begun")
        return start

    monkeypatch.setattr(forecast, "fit_boosted", fitting)
    monkeypatch.setattr(disruption, "disruption_detection", starting("disruption"))
    monkeypatch.setattr(forecast, "naive_baselines", starting("finance"))
    daily = series(spark, [5 + i % 7 for i in range(200)])
    monkeypatch.setattr(features, "daily_demand_drivers", lambda fact: daily)
    with pytest.raises(InterruptedError, match="fit was reached"):
        run_pipeline(daily, str(tmp_path / "out"))


def test_attribution_table(fitted):
    _, train, _, _, trees = fitted
    sample = train.limit(50)
    got = attribution.feature_attribution(trees, sample).collect()
    x = sample.select(*features.FEATURES).toPandas().to_numpy(float)
    want = np.abs(attribution.Attributor(trees).values(x)).mean(axis=0)
    assert {r.feature: pytest.approx(r.mean_abs_shap) for r in got} == dict(
        zip(features.FEATURES, want))
    assert [r.mean_abs_shap for r in got] == sorted((r.mean_abs_shap for r in got), reverse=True)


def test_walk_forward_rows(spark):
    rng = np.random.default_rng(1)
    daily = series(spark, [int(v) for v in rng.integers(5, 40, 110)]).withColumnRenamed(
        "discount_pct", "average_discount")
    data = features.demand_features(daily, keys=()).dropna()
    got = forecast.walk_forward_validation(data, forecast.BoostParams(trees=2, depth=2)).collect()
    folds = {r.fold: r for r in got}
    assert list(folds) == ["1", "2", "3", "4", "mean"]
    assert [(folds[str(f)].train_rows, folds[str(f)].test_rows) for f in range(1, 5)] == [
        (48, 8), (56, 8), (64, 8), (72, 8)]
    assert folds["mean"].MAE == pytest.approx(np.mean([folds[str(f)].MAE for f in range(1, 5)]))
