"""Distributed training against plain NumPy on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfit import session
from loomfit.functions import metrics as m
from loomfit.operators import linear, logistic, sums, table
from loomfit.operators.ensemble import ClusterEnsemble, EnsembleModel
from loomfit.operators.linear import ElasticNet, GradientDescent, Lasso, LeastSquares, Ridge
from loomfit.operators.logistic import ImbalancedLogistic, Logistic
from loomfit.operators.sampling import batches, repeat_rows
from loomfit.operators.table import TrainingTable
from loomfit.plans.polynomial import Polynomial

XS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.RandomState(7)
    x = rng.normal(size=(240, 3))
    y = np.where(x @ [1.0, -2.0, 0.5] + rng.normal(size=240) > 0.4, 1, -1)
    return x, y


@pytest.fixture(scope="module")
def df(spark, data):
    x, y = data
    rows = [(i, *map(float, row), int(v), int(i % 4)) for i, (row, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, n int").repartition(5)


def sigma(z):
    return 1 / (1 + np.exp(-z))


def descend(x, y, steps, gamma, slope, w=None):
    w = np.zeros(x.shape[1]) if w is None else w
    for _ in range(steps):
        w = w - gamma * slope(w)
    return w


def test_closed_forms(df, data):
    x, y = data
    assert np.allclose(LeastSquares().fit(df, XS, "y").weights, np.linalg.lstsq(x, y, rcond=None)[0])
    want = np.linalg.solve(x.T @ x + 2 * len(x) * 0.3 * np.eye(3), x.T @ y)
    assert np.allclose(Ridge(0.3).fit(df, XS, "y").weights, want)


def test_gd_without_room_for_the_gram(df, data, monkeypatch):
    x, y = data
    monkeypatch.setattr(session, "TASK_STATE_BYTES", 100)
    want = descend(x, y, 6, 0.1, lambda w: -x.T @ (y - x @ w) / len(x))
    assert np.allclose(GradientDescent(0.1, 6).fit(df, XS, "y").weights, want, atol=1e-12)


def test_singular_gram_gives_the_shortest_solution(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 4.0)], "a double, b double, y double")
    assert np.allclose(LeastSquares().fit(df, ["a", "b"], "y").weights, [1.0, 1.0])


def test_gd_on_sums_equals_gd_on_rows(df, data):
    x, y = data
    want = descend(x, y, 30, 0.1, lambda w: -x.T @ (y - x @ w) / len(x))
    assert np.allclose(GradientDescent(0.1, 30).fit(df, XS, "y").weights, want, atol=1e-12)
    want = descend(x, y, 9, 0.1, lambda w: -x.T @ np.sign(y - x @ w) / len(x))
    assert np.allclose(GradientDescent(0.1, 9, "mae").fit(df, XS, "y").weights, want, atol=1e-12)


@pytest.mark.parametrize("norm, lam", [("l2", 0.0), ("l2", 0.05), ("l1", 0.05)])
def test_logistic(df, data, norm, lam):
    x, y = data
    t = (y + 1) / 2

    def slope(w):
        return x.T @ (sigma(x @ w) - t) / len(x) + lam * (2 * w if norm == "l2" else np.sign(w))

    got = Logistic(0.5, 12, lam, reg_norm=norm).fit(df, XS, "y").weights
    assert np.allclose(got, descend(x, y, 12, 0.5, slope), atol=1e-12)


def test_newton(df, data):
    x, y = data
    t = (y + 1) / 2

    def slope(w):
        s = sigma(x @ w)
        g = x.T @ (s - t) / len(x) + 2 * 0.01 * w
        return np.linalg.solve(x.T @ (x * (s * (1 - s))[:, None]) / len(x), g)

    got = Logistic(0.8, 5, 0.01, learning="newton").fit(df, XS, "y").weights
    assert np.allclose(got, descend(x, y, 5, 0.8, slope), atol=1e-10)


def test_labels_may_be_01(df):
    zero_one = df.withColumn("y", F.when(F.col("y") == -1, 0).otherwise(1))
    a, b = (Logistic(0.5, 4).fit(d, XS, "y") for d in (df, zero_one))
    assert np.allclose(a.weights, b.weights)
    assert a.log_loss(df, "y") == pytest.approx(b.log_loss(zero_one, "y"))


def batch_positions(df, size, steps):
    rows = batches(df.select("id"), "id", size, steps).collect()
    return [sorted(r["id"] for r in rows if r["batch"] == b) for b in range(steps)]


@pytest.mark.parametrize("local", [True, False])
def test_mini_batches(df, data, monkeypatch, local):
    """Batches fetched to the driver and batches left on the cluster train the same model."""
    if not local:
        monkeypatch.setattr(table, "BATCH_ROWS_BYTES", 0)
    x, y = data
    parts = batch_positions(df, 50, 7)
    t = (y + 1) / 2
    w, v, u = np.zeros(3), np.zeros(3), np.zeros(4)
    losses = []
    for ids in parts:
        xb, yb, tb = x[ids], y[ids], t[ids]
        w = w - 0.1 * (xb.T @ (xb @ w - yb) / len(ids))
        v = v - 0.5 * (xb.T @ (sigma(xb @ v) - tb) / len(ids))
        x1 = np.column_stack([np.ones(len(ids)), xb])
        u = u - 0.1 * (x1.T @ (x1 @ u - yb) / len(ids) + 0.05 * np.sign(u))
        losses.append(((x1 @ u - yb) ** 2).sum() / (2 * len(ids)) + 0.05 * np.abs(u).sum())
    got = GradientDescent(0.1, 7, batch_size=50).fit(df, XS, "y", id_col="id")
    assert np.allclose(got.weights, w, atol=1e-12)
    got = Logistic(0.5, 7, batch_size=50).fit(df, XS, "y", id_col="id")
    assert np.allclose(got.weights, v, atol=1e-12)
    got = Lasso(0.05, 0.1, max_iters=7, batch_size=50).fit(df, XS, "y", id_col="id")
    assert np.allclose(got.weights, u, atol=1e-12)
    assert np.allclose(got.losses, losses)


def test_mini_batches_need_an_id(df):
    with pytest.raises(ValueError, match="id"):
        Logistic(0.5, 3, batch_size=5).fit(df, XS, "y")


def test_elastic_net_and_losses(df, data):
    x, y = data
    x1 = np.column_stack([np.ones(len(x)), x])
    lam, ratio = 0.1, 0.4

    def slope(w):
        return x1.T @ (x1 @ w - y) / len(x) + lam * (ratio * np.sign(w) + (1 - ratio) * w)

    model = ElasticNet(ratio, lam, 0.2, max_iters=10).fit(df, XS, "y")
    want = descend(x1, y, 10, 0.2, slope)
    assert np.allclose(model.weights, want, atol=1e-12)
    loss = ((x1 @ want - y) ** 2).sum() / (2 * len(x)) + lam * (
        ratio * np.abs(want).sum() + 0.5 * (1 - ratio) * want @ want
    )
    assert model.losses[-1] == pytest.approx(loss) and len(model.losses) == 10


def test_coordinate_descent_without_penalty_is_least_squares(df, data):
    x, y = data
    model = Lasso(0.0, path=True, intercept=False, max_iters=200).fit(df, XS, "y")
    assert np.allclose(model.weights, np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-9)


def test_intercept_is_part_of_the_prediction(df, data):
    x, y = data
    model = Lasso(0.0, 0.3, max_iters=300).fit(df, XS, "y")
    want = np.column_stack([np.ones(len(x)), x]) @ model.weights
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want)


def imbalanced(x, y, steps, gamma, alpha):
    t, w, p = (y + 1) / 2, np.zeros(x.shape[1]), np.ones(len(x))
    for _ in range(steps):
        s = sigma(x @ w)
        w = w - gamma * x.T @ (s - t * (p + s * (1 - p))) / len(x)
        p = p + alpha * t * np.log(1 + np.exp(x @ w))
    return w


@pytest.mark.parametrize("refresh", [50, 3])
def test_imbalanced(df, data, monkeypatch, refresh):
    """Rewards recomputed from past weights equal rewards stored every few steps."""
    monkeypatch.setattr(logistic, "REFRESH_STEPS", refresh)
    got = ImbalancedLogistic(0.4, 0.06, 8).fit(df, XS, "y").weights
    assert np.allclose(got, imbalanced(*data, 8, 0.4, 0.06), atol=1e-12)


def test_imbalanced_models_together(df, data):
    models = [ImbalancedLogistic(0.4, 0.06, 5), ImbalancedLogistic(0.2, 0.5, 3)]
    w, _ = ImbalancedLogistic.train(models, TrainingTable.build(df, XS, "y"), [0, 0])
    for i, model in enumerate(models):
        want = imbalanced(*data, model.max_iters, model.gamma, model.alpha)
        assert np.allclose(w[:, i], want, atol=1e-12)


def test_weight_equals_repeated_rows(df):
    repeated = repeat_rows(df, "n")
    for model in (Logistic(0.5, 6, 0.01), Ridge(0.1), GradientDescent(0.1, 5, "mae"), Lasso(0.1, 0.1), ImbalancedLogistic(0.4, 0.1, 4)):
        a = model.fit(df, XS, "y", weight="n").weights
        b = model.fit(repeated, XS, "y").weights
        assert np.allclose(a, b, atol=1e-10), model


def test_weighted_mini_batches_repeat_rows(df):
    model = Logistic(0.5, 4, batch_size=40)
    a = model.fit(df, XS, "y", id_col="id", weight="n").weights
    repeated = repeat_rows(df, "n").withColumn("id", F.concat_ws(":", "id", "copy"))
    assert np.allclose(a, model.fit(repeated, XS, "y", id_col="id").weights, atol=1e-12)


def test_many_models_equal_single_models(df):
    models = [Logistic(0.5, 6, 0.01), Logistic(0.1, 3), Logistic(0.9, 4, 0.02, "newton"), Logistic(0.3, 5, batch_size=30)]
    w, _ = Logistic.train(models, TrainingTable.build(df, XS, "y", id_col="id"), [0] * 4)
    for i, model in enumerate(models):
        assert np.allclose(w[:, i], model.fit(df, XS, "y", id_col="id").weights, atol=1e-12)


def test_sums_by_shuffle_and_by_driver_agree(df, monkeypatch):
    monkeypatch.setattr(sums, "SLOT_WIDTH", 7)
    t = TrainingTable.build(df, XS, "y")
    kernel, size = sums.gram_kernel(3)
    rows = t.df.select("f", "y")
    assert np.allclose(sums.sum_rows(rows, kernel, size), sums.sum_rows(rows, kernel, size, tasks=5))
    assert np.array_equal(sums.sum_rows(rows.filter("y > 5"), kernel, size), np.zeros(size))


def test_partitioning_does_not_matter(df):
    a = Logistic(0.5, 5).fit(df.repartition(1), XS, "y").weights
    b = Logistic(0.5, 5).fit(df.repartition(8), XS, "y").weights
    assert np.allclose(a, b, atol=1e-12)


def test_table_is_spread_over_idle_cores(df, monkeypatch):
    monkeypatch.setattr(table, "SPREAD_ROWS", 1)
    t = TrainingTable.build(df.coalesce(1), XS, "y")
    with t.kept(10) as kept:
        assert kept.tasks == 4
        assert kept.df.count() == 240
    assert t.df.count() == 240


def test_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0)], "a double, y double")
    with pytest.raises(Exception, match="missing value"):
        LeastSquares().fit(df, ["a"], "y")


def test_without_room_for_products_all_models_are_the_same(df, monkeypatch):
    """With no room for D x D sums, models come from passes with D sums each."""
    models = [
        LeastSquares(),
        Ridge(0.3),
        Lasso(0.2, 0.1, max_iters=3),
        Lasso(0.2, path=True, max_iters=2),
        ElasticNet(0.4, 0.2, 0.1, max_iters=3),
        Logistic(1.0, 2, 0.05, learning="newton"),
        ImbalancedLogistic(0.3, 0.2, 4),
    ]
    weighted = df.withColumn("w", F.col("n") + 1).coalesce(2)
    want = [model.fit(weighted, XS, "y", weight="w") for model in models]
    monkeypatch.setattr(session, "TASK_STATE_BYTES", 8)
    monkeypatch.setattr(session, "DRIVER_SUM_BYTES", 0)
    monkeypatch.setattr(session, "BLOCK_COLUMNS", 2)
    got = [model.fit(weighted, XS, "y", weight="w") for model in models]
    for a, b in zip(got, want):
        assert np.allclose(a.weights, b.weights, atol=1e-8)
        assert np.allclose(a.losses, b.losses)


def test_gram_in_blocks(df, data, monkeypatch):
    x, y = data
    z = np.column_stack([x, y, np.ones(len(x))])
    monkeypatch.setattr(session, "BLOCK_COLUMNS", 2)
    monkeypatch.setattr(session, "TASK_STATE_BYTES", 2000)
    monkeypatch.setattr(session, "DRIVER_SUM_BYTES", 0)
    t = TrainingTable.build(df.withColumn("w", F.col("n") + 1), XS, "y", weight="w")
    w = np.arange(240) % 4 + 1
    (g,) = t.grams()
    assert np.allclose(g.xtx, x.T @ (x * w[:, None])) and np.allclose(g.xty, x.T @ (y * w)) and g.n == w.sum()
    monkeypatch.setattr(session, "TASK_STATE_BYTES", 100)
    t = TrainingTable.build(df, XS, "y")
    assert len(t.block_passes()[1]) > 1
    cells = {(r["a"], r["b"]): r["total"] for r in t.gram_table().collect()}
    want = z.T @ z
    assert cells.keys() == {(a, b) for a in range(5) for b in range(a, 5)}
    assert all(np.isclose(v, want[at]) for at, v in cells.items())


def test_a_sum_is_added_in_groups_of_about_the_root_of_its_tasks(spark):
    df = spark.range(0, 1000, 1, 50).select(F.array(F.col("id").cast("double")).alias("f"))
    parts = sums.partial_sums(df, lambda b: sums.vectors(b.column("f"), 1).sum(axis=0), 1, 8)
    tasks = parts.groupBy(F.floor(F.sqrt(F.spark_partition_id())).alias("g")).count().collect()
    assert len(tasks) <= 8 and max(r["count"] for r in tasks) <= 2 * 8
    assert [r["part"] for r in sums.added_up(parts).collect()] == [[499500.0]]


def test_singular_normal_equations_give_the_shortest_solution(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_STATE_BYTES", 8)
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0 * i) for i in range(5)], "a double, b double, y double")
    assert np.allclose(LeastSquares().fit(df, ["a", "b"], "y").weights, [0.6, 1.2])


def test_bad_settings():
    for make in (
        lambda: GradientDescent(0.1, loss="huber"),
        lambda: Logistic(learning="adam"),
        lambda: Logistic(reg_norm="l3"),
    ):
        with pytest.raises(ValueError):
            make()


def test_many_terms_make_a_shallow_score(spark):
    names = [f"c{i}" for i in range(600)]
    df = spark.range(2).select(*[F.lit(1.0).alias(n) for n in names])
    model = linear.LinearModel(tuple(names), np.arange(600.0))
    assert model.transform(df).select("prediction").first()[0] == 600 * 599 / 2


def test_vector_column(df):
    vectors = df.withColumn("v", F.array(*XS))
    a, b = Logistic(0.5, 4).fit(vectors, "v", "y"), Logistic(0.5, 4).fit(df, XS, "y")
    assert np.allclose(a.weights, b.weights)
    both = b.transform(a.transform(vectors, "p"), "q")
    assert both.filter("p <> q").count() == 0


def test_polynomial(df, data):
    x, y = data
    model = Polynomial(3, ("a", "c"), LeastSquares()).fit(df, XS, "y")
    z = np.column_stack([x[:, 1], x[:, [0, 2]], x[:, [0, 2]] ** 2, x[:, [0, 2]] ** 3])
    want = np.linalg.lstsq(z, y, rcond=None)[0]
    assert model.inner.features == ("b", "a", "c", "a__^2", "c__^2", "a__^3", "c__^3")
    assert np.allclose(model.inner.weights, want, atol=1e-8)
    got = {r["id"]: r["prediction"] for r in model.transform(df.drop("y")).collect()}
    assert np.allclose([got[i] for i in range(len(x))], z @ want)
    with pytest.raises(ValueError, match="absent"):
        model.transform(df.drop("b"))


def test_scores_of_a_model(df, data):
    x, y = data
    model = Logistic(0.5, 10).fit(df, XS, "y")
    p = np.sign(x @ model.weights)
    tp, fp, fn = ((p == 1) & (y == 1)).sum(), ((p == 1) & (y == -1)).sum(), ((p == -1) & (y == 1)).sum()
    assert model.f1(df, "y") == pytest.approx(tp / (tp + 0.5 * (fp + fn)))
    assert model.mae(df, "y") == pytest.approx(np.abs(p - y).mean())
    assert model.rmse(df, "y") == pytest.approx(np.sqrt(2 * model.mse(df, "y")))
    pair = model.evaluate(df, "y", both=m.accuracy_f1).first()["both"]
    assert pair["accuracy"] == pytest.approx((p == y).mean())


# Ensemble ---------------------------------------------------------------------------------------


def test_vote_at_the_threshold(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    weights = np.array([[1.0] * 3 + [-1.0] * 7])
    model = EnsembleModel(("a",), weights, tuple(range(10)), (0.5,) * 10, (0.6,) * 10)

    def one(**how):
        return model.transform(df, **how).first()["prediction"]

    assert one(percentage=0.3) == -1
    assert one(percentage=0.29) == 1
    assert one(method="weight_voting") == -1
    with pytest.raises(ValueError):
        one(method="median")


def test_ensemble_equals_separate_models(df):
    clustered = df.withColumn("g", F.when(F.col("y") == -1, F.col("id") % 2).cast("int"))
    ensemble = ClusterEnsemble([0.01, 0.02, 0.03], [0.5, 0.3, 0.1], [4, 6, 9])
    model = ensemble.fit(clustered, XS, "y", "g", "id")
    assert model.clusters == (0, 1)
    weighted, _ = ensemble.training_weights(clustered, "y", "g", "id")
    for i in range(2):
        alone = weighted.withColumn("w", F.col("wt")[i])
        size = clustered.filter(F.col("g") == i).count()
        assert alone.agg(F.sum("w")).first()[0] == 2 * size
        single = Logistic(ensemble.gammas[i], ensemble.max_iters[i], ensemble.lambdas[i], reg_norm="l1")
        fitted = single.fit(alone, XS, "y", weight="w")
        assert np.allclose(model.weights[:, i], fitted.weights, atol=1e-10)
        held = clustered.filter(~F.col("g").eqNullSafe(F.lit(i)))
        assert model.scores[i] == pytest.approx(fitted.f1(held, "y"))
        assert model.voting_weights[i] == pytest.approx(sigma(model.scores[i]))


def test_small_clusters_get_no_model(df):
    clustered = df.withColumn("g", F.when(F.col("y") == -1, (F.col("id") == 4).cast("int")))
    clustered = clustered.withColumn("g", F.when(F.col("y") == -1, F.coalesce("g", F.lit(0))))
    first = clustered.filter("y = -1").orderBy("id").first()["id"]
    clustered = clustered.withColumn("g", F.when(F.col("y") == -1, (F.col("id") == first).cast("int")))
    ensemble = ClusterEnsemble([0.01] * 2, [0.5] * 2, [2] * 2, threshold_quantile=0.5)
    assert ensemble.fit(clustered, XS, "y", "g", "id").clusters == (0,)
