import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import features, logit, models, summary


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        x, y = rng.random(), rng.random()
        rows.append(("A", i, x, y, int(x + 0.1 * y > 0.5)))
    return spark.createDataFrame(rows, "pair string, i int, x double, y double, target int").select(
        "pair", F.date_add(F.lit("2020-01-01").cast("date"), "i").alias("date"), "x", "y", "target"
    ).cache()


def test_split_by_time(table):
    split = features.time_split(table)
    edge = split.groupBy("is_train").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))
    got = {r.is_train: r for r in edge.collect()}
    assert got[True].n == 240 and got[False].n == 60 and got[True].b < got[False].a


def test_feature_columns(table):
    assert features.feature_columns(table) == ["x", "y"]


def test_models_vote_and_compare(table):
    split = features.time_split(table)
    train = split.filter("is_train").drop("is_train")
    test = split.filter(~F.col("is_train")).drop("is_train")
    fitted = models.fit_models(train, rounds=3)
    scored = models.score(fitted, test).cache()
    names = [*fitted, "voting"]
    accuracy = {r.model: r.accuracy for r in models.compare(scored, names).collect()}
    assert set(accuracy) == set(names) and min(accuracy.values()) > 0.8
    rows = scored.collect()
    assert all(r.voting == int(r.random_forest + r.boosted_trees + r.logistic_regression >= 2) for r in rows)
    report = summary.classification_report(scored, "target", "voting").collect()
    assert sum(r.support for r in report) == 60


def test_models_are_fitted_side_by_side(table, monkeypatch):
    """Every fit waits until all have begun."""
    import threading

    all_here, fit = threading.Barrier(4), models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, rows: all_here.wait(30) is not None and fit(self, rows))
    assert list(models.fit_models(table, rounds=1)) == ["random_forest", "boosted_trees", "boosted_trees_deep", "logistic_regression"]


def test_grid_search_and_folds(table):
    best, scores = models.grid_search(table, ["x", "y"], 300, grid=(0.01, 100.0), folds=2)
    assert best in scores and len(scores) == 2
    pipeline = models.logistic(["x", "y"], 300, c=100.0)
    assert models.cross_val_score(table, pipeline, folds=2) > 0.8


def test_saved_model_scores_alike(table, tmp_path):
    model = models.logistic(["x", "y"], 300).fit(table)
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    a = model.transform(table).agg(F.sum("prediction")).first()
    assert a == again.transform(table).agg(F.sum("prediction")).first()


def test_ordered_folds(table):
    folds = models.ordered_folds(table, 5)
    sizes = {(r.target, r._fold): (r.n, r.a, r.b) for r in folds.groupBy("target", "_fold").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b")).collect()}
    for target in (0, 1):
        mine = [sizes[target, k] for k in range(5)]
        assert max(n for n, _, _ in mine) - min(n for n, _, _ in mine) <= 1
        assert all(one[2] < two[1] for one, two in zip(mine, mine[1:]))


def plain_newton(x, y, c, steps=60):
    """Gradient descent to the minimum of the summed losses and |w|^2 / (2 c), by plain Newton steps in numpy."""
    import numpy as np

    z = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / x.std(0, ddof=1)])
    w, ridge = np.zeros(z.shape[1]), np.r_[0.0, np.full(x.shape[1], 1 / c)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-z @ w))
        w = w - np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
    return w, z


def test_grid_of_exact_logistic_models(table, spark):
    import numpy as np

    grid = (0.01, 1.0, 100.0)
    found = logit.fit_grid(table, ["x", "y"], grid=grid, folds=3)
    data = models.ordered_folds(table, 3).toPandas()
    for (fold, c), w, accuracy in zip(found.sets, found.weights, found.accuracy):
        used = data if fold is None else data[data._fold != fold]
        held = data if fold is None else data[data._fold == fold]
        x = used[["x", "y"]].to_numpy()
        want, _ = plain_newton(x, used.target.to_numpy(), c)
        assert w == pytest.approx(want, rel=1e-6, abs=1e-8)
        z = np.column_stack([np.ones(len(held)), (held[["x", "y"]].to_numpy() - x.mean(0)) / x.std(0, ddof=1)])
        assert accuracy == pytest.approx(((z @ want > 0) == (held.target == 1)).mean())
    assert found.best() == max(sorted(found.scores()), key=found.scores().get) and set(found.scores()) == set(grid)
    intercept, slopes = found.plain(100.0)
    raw = data.apply(lambda r: intercept + slopes["x"] * r.x + slopes["y"] * r.y > 0, axis=1)
    assert (raw == (data.target == 1)).mean() == found.accuracy[found.sets.index((None, 100.0))]
    assert found.table(spark).count() == 12 and found.steps < 30


def test_logistic_models_of_odd_features(table):
    """A constant feature has no weight; a feature that settles the label gives finite ones."""
    rows = table.withColumn("one", F.lit(3.0)).withColumn("sure", F.col("target") * 2.0 - 1)
    found = logit.fit_grid(rows, ["one", "sure"], grid=(1.0, 1000.0), folds=2)
    assert abs(found.weights[:, 1]).max() < 1e-9 and (found.weights[:, 2] > 1).all()
    assert found.accuracy.min() == 1.0


def test_features_of_new_bars(make_bars):
    """New bars from the last bars and the state, against the whole history."""
    from tests.test_indicators import walk
    from tickloom.operators import resume, select
    from tickloom.session import stored

    bars, _ = stored(make_bars(A=walk(120, 1), B=walk(60, 2), C=walk(10, 3)), "bars")
    cut = F.lit("2020-02-15").cast("date")
    old, new = bars.filter(F.col("date") < cut), bars.filter(F.col("date") >= cut)
    state, _ = stored(resume.state_after(resume.recursive_indicators(old)), "state")
    tail, _ = stored(select.last_n(old, features.TAIL), "tail")
    got = features.features_of_new(new, tail, state).toPandas().sort_values(["pair", "date"], ignore_index=True)
    whole = features.ml_features(bars).filter(F.col("date") >= cut).drop("target").toPandas().sort_values(["pair", "date"], ignore_index=True)
    import pandas as pd

    pd.testing.assert_frame_equal(got[sorted(whole.columns)], whole[sorted(whole.columns)], check_dtype=False, rtol=1e-9, atol=1e-9)
    assert len(got) > 80
