"""Boosted trees against a plain version, and the search against its promises."""

import numpy as np
import pytest

from shelfwise.operators import boosting
from shelfwise.operators.boosting import Booster, BoostParams, Fit, fit_boosted, search_boosted

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=200), rng.integers(0, 5, 200).astype(float), rng.exponential(size=200)])
    y = 100 * np.sin(x[:, 0]) + 30 * (x[:, 1] > 2) * x[:, 2] + rng.normal(0, 5, 200)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    made = [(f"p{i}", *map(float, v), float(t), i % 4) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(made, "key string, a double, b double, c double, target double, fold int").repartition(5)


def plain_boost(bins, y, params):
    """Every cut of every node is tried, by loops."""
    found, trees = np.full(len(y), y.mean()), []

    def grow(at, depth, gradient):
        g, h = gradient[at].sum(), len(at)
        best = (1e-9, None, None)
        for f in range(bins.shape[1]):
            for cut in range(bins[:, f].max()):
                left, right = at[bins[at, f] <= cut], at[bins[at, f] > cut]
                if len(left) and len(right):
                    part = lambda s: gradient[s].sum() ** 2 / (len(s) + params.reg_lambda)
                    gain = part(left) + part(right) - g**2 / (h + params.reg_lambda)
                    if gain > best[0] + 1e-7:
                        best = (gain, left, right)
        if depth and best[1] is not None:
            grow(best[1], depth - 1, gradient)
            grow(best[2], depth - 1, gradient)
        else:
            step[at] = -params.learning_rate * g / (h + params.reg_lambda)

    for _ in range(params.n_estimators):
        step = np.zeros(len(y))
        grow(np.arange(len(y)), params.max_depth, found - y)
        found = found + step
        trees.append(found)
    return trees


@pytest.mark.parametrize("penalty", [0.0, 1.0, 10.0])
def test_equals_a_plain_version(spark, data, rows, penalty):
    x, y = data
    params = BoostParams(n_estimators=6, max_depth=3, learning_rate=0.3, reg_lambda=penalty)
    model = fit_boosted(rows, FEATURES, [params], "key")[0]
    edges = boosting.bin_edges(rows, FEATURES)
    bins = np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)])
    assert np.allclose(model.predict(x), plain_boost(bins, y, params)[-1], atol=1e-4)
    scored = {r.key: r.prediction for r in model.transform(rows).collect()}
    assert np.allclose([scored[f"p{i}"] for i in range(200)], model.predict(x))


def test_penalty_shrinks_leaves(rows):
    strong, weak = fit_boosted(rows, FEATURES, [BoostParams(3, 2, reg_lambda=1000.0), BoostParams(3, 2, reg_lambda=0.1)], "key")
    assert max(np.abs(t.value).max() for t in strong.trees) < max(np.abs(t.value).max() for t in weak.trees) / 3


def test_same_model_however_rows_are_dealt(rows, data, monkeypatch):
    """Sums are exact, whatever the tasks and the steps of adding them up, and whether sums are stored on the way."""
    params = [BoostParams(7, 3, subsample=0.8, colsample=0.7), BoostParams(3, 2)]
    one = fit_boosted(rows.coalesce(1), FEATURES, params, "key")  # a copy for each core
    monkeypatch.setattr(boosting, "FAN_IN", 3)
    monkeypatch.setattr(Booster.grow, "__defaults__", (3,))
    monkeypatch.setattr(boosting, "stage", lambda df, name, even=False: df.repartition(9).cache())
    many = fit_boosted(rows, FEATURES, params, "key")
    for a, b in zip(one, many):
        assert len(a.trees) == len(b.trees) and a.predict(data[0]).tolist() == b.predict(data[0]).tolist()
    assert [len(m.trees) for m in one] == [7, 3]


def test_saved_model(spark, rows, data, tmp_path):
    model = fit_boosted(rows, FEATURES, [BoostParams(4, 3)], "key")[0]
    model.save(spark, str(tmp_path / "model"))
    loaded = boosting.BoostedModel.load(spark, str(tmp_path / "model"))
    assert loaded.features == FEATURES and loaded.predict(data[0]).tolist() == model.predict(data[0]).tolist()


@pytest.mark.parametrize("tasks", [1, 3])
def test_fold_errors_are_those_of_the_models(rows, data, tasks, monkeypatch):
    """A fold's error after each tree is that of predicting it with so many trees; its rows train nothing."""
    x, y = data
    monkeypatch.setattr(boosting, "stage", lambda df, name, even=False: df.repartition(tasks).cache())
    booster = Booster(rows, FEATURES, "key")
    fits = booster.start([Fit(BoostParams(4, 2), fold) for fold in range(4)])
    booster.grow(fits, 4, every=2)
    booster.errors(fits)
    for fit in fits:
        held = np.arange(200) % 4 == fit.fold
        assert fit.base == pytest.approx(y[~held].mean()) and len(fit.errors) == 5
        for t in (0, 3, 4):
            out = booster.model(fit, t).predict(x)[held]
            assert fit.errors[t] == pytest.approx(np.sqrt(((out - y[held]) ** 2).mean()))


def test_search_halves(rows):
    drawn = [BoostParams(30, 2, 0.3), BoostParams(30, 2, 1e-6), BoostParams(30, 2, 1e-7), BoostParams(12, 3, 0.3), BoostParams(30, 1, 1e-5), BoostParams(30, 2, 0.1)]
    trials, best = search_boosted(rows, FEATURES, drawn, "key", first=4, finalists=2, patience=6)
    grown = [len(t.fits[0].trees) for t in trials]
    assert grown[1] == grown[2] == grown[4] == 4  # weak ones left after the first trees
    assert sum(g > 4 for g in grown) == 2 and best.number in (0, 3, 5)
    assert best.best() == min(t.best() for t in trials)
    assert all(len(f.errors) == len(f.trees) + 1 for t in trials for f in t.fits)


@pytest.mark.parametrize("most", [1 << 21, 0])
def test_search_grows_every_set_whole(rows, data, most, monkeypatch):
    """No set leaves early or is judged by fewer trees than it asks for, whatever its error."""
    monkeypatch.setattr(boosting, "COPIED_ROWS", most)
    drawn = [BoostParams(14, 2, 0.3, 0.8), BoostParams(16, 2, 1e-6), BoostParams(9, 3, 0.9), BoostParams(12, 1, 1e-5)]
    trials, best = search_boosted(rows, FEATURES, drawn, "key")
    assert [[len(f.trees) for f in t.fits] for t in trials] == [[p.n_estimators] * 4 for p in drawn]
    assert all(len(f.errors) == len(f.trees) + 1 for t in trials for f in t.fits)
    assert best.best() == min(t.best() for t in trials)


def test_features_counted_together():
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, n, 900) for n in (64, 3, 40, 2, 7)]).astype(np.uint8)
    gradient, node, seen = np.rint(rng.normal(0, 1e6, 900)), rng.integers(3, 6, 900).astype(np.uint8), rng.random(900) < 0.8
    for most in (64, 1 << 12):
        groups = boosting.joint_groups([64, 3, 40, 2, 7], most)
        assert sorted(f for g in groups for f in g) == [0, 1, 2, 3, 4]
        assert all(np.prod([(64, 3, 40, 2, 7)[f] for f in g]) <= most for g in groups)
        counted = boosting.Counted(x, 64)
        for place, n in enumerate((3, 5, 6)):  # no row is at 6
            at = np.flatnonzero((node == n) & seen)
            plain = boosting.histograms(x, at, np.zeros(len(at), np.int64), gradient[at], 1, 64)
            assert (counted.sums([3, 5, 6], node, seen, gradient)[:, place] == plain[:, 0]).all()


def test_empty_columns_and_gaps(spark):
    rows = spark.createDataFrame([(f"k{i}", float(i % 3), None, float(i), i % 2) for i in range(12)], "key string, a double, b double, target double, fold int")
    model = fit_boosted(rows, ["a", "b"], [BoostParams(3, 2)], "key")[0]
    assert model.transform(rows).where("prediction IS NULL OR isnan(prediction)").count() == 0


def test_a_table_of_several_partitions_grows_as_one_of_blocks(rows, data, monkeypatch):
    monkeypatch.setattr(boosting, "stage", lambda df, name, even=False: df.repartition(5).cache())
    grown = []
    for most in (1 << 21, 0):  # copied for each core, or level by level
        monkeypatch.setattr(boosting, "COPIED_ROWS", most)
        booster = Booster(rows, FEATURES, "key")
        assert bool(booster.copies) == bool(most)
        fits = booster.start([Fit(BoostParams(3, 3, subsample=0.8), fold) for fold in range(2)])
        booster.grow(fits, 3, every=2)
        booster.errors(fits)
        booster.close()
        grown.append([(t.feature.tolist(), t.cut.tolist(), t.value.tolist()) for f in fits for t in f.trees])
        grown[-1].append([round(e, 9) for f in fits for e in f.errors])
    assert grown[0] == grown[1]
