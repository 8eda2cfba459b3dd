"""Cross-validation and grid search against fits on the physical folds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfit import session
from loomfit.functions import metrics as m
from loomfit.operators.linear import GradientDescent, Lasso, LeastSquares, Ridge
from loomfit.operators.logistic import ImbalancedLogistic, Logistic
from loomfit.operators.sampling import kfold, split, stratified_upsampled_folds
from loomfit.plans.polynomial import Polynomial
from loomfit.plans.tuning import CrossValidation, GridSearch, Scores, grid_combinations, grid_table

XS = ["a", "b"]


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.RandomState(11)
    x = rng.normal(size=(150, 2))
    y = np.where(x @ [1.5, -1.0] + rng.normal(size=150) > 0.9, 1, -1)
    rows = [(i, *map(float, row), int(v)) for i, (row, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, y int")


def fold_scores(folds, model, metric, k, ids="id"):
    out = {}
    for i in range(k):
        fitted = model.fit(folds.train(i), XS, "y", id_col=ids)
        for name, part in (("test", folds.test(i)), ("train", folds.train(i))):
            out[i, name] = fitted.evaluate(part, "y", s=metric).first()["s"]
    return out


@pytest.mark.parametrize(
    "model, metric",
    [
        (Ridge(0.05), m.mse),
        (LeastSquares(), m.f1_continuous),
        (GradientDescent(0.1, 5, "mae"), m.rmse),
        (Lasso(0.05, 0.1, max_iters=5), m.mae),
        (Logistic(0.5, 5), m.f1),
        (Logistic(0.5, 5, batch_size=20), m.accuracy),
        (ImbalancedLogistic(0.4, 0.1, 4), m.misclassification),
        (Logistic(0.5, 3), lambda p, y: F.max(F.abs(p - y))),
    ],
)
def test_cross_validation(spark, df, model, metric):
    scores = CrossValidation(model, 4, metric).evaluate(df, XS, "y", "id")
    want = fold_scores(kfold(df, "id", 4), model, metric, 4)
    assert {(r[1], r[2]): r[3] for r in scores.rows} == pytest.approx(want)
    means = {r["split"]: r["score"] for r in scores.averages(spark).collect()}
    assert means["test"] == pytest.approx(np.mean([want[i, "test"] for i in range(4)]))


@pytest.mark.parametrize("metric", [m.accuracy, lambda p, y: F.avg((p != y).cast("double"))])
def test_stratified_grid(spark, df, metric):
    search = GridSearch(Logistic, {"gamma": [0.3, 0.9]}, metric, {"max_iters": 4}, k_folds=3, stratified=True)
    scores = search.fit(df, XS, "y", "id")
    folds = stratified_upsampled_folds(df, "id", "y", 3)
    for combo, gamma in enumerate((0.3, 0.9)):
        want = fold_scores(folds, Logistic(gamma, 4), metric, 3)
        got = {(f, s): v for c, f, s, v in scores.rows if c == combo}
        assert got == pytest.approx(want)


@pytest.mark.parametrize(
    "inner, metric",
    [(GradientDescent(0.05, 4, batch_size=20), m.mse), (Ridge(0.1), lambda p, y: F.max(F.abs(p - y)))],
)
def test_search_over_powers(spark, df, inner, metric):
    grid = {"degree": [1, 3], "continuous": [("a",), ("a", "b")]}
    search = GridSearch(Polynomial, grid, metric, {"estimator": inner}, "min", k_folds=2)
    scores = search.fit(df, XS, "y", "id")
    folds = kfold(df, "id", 2)
    for combo, params in enumerate(grid_combinations(grid)):
        for i in range(2):
            fitted = Polynomial(**params, estimator=inner).fit(folds.train(i), XS, "y", id_col="id")
            for name, part in (("test", folds.test(i)), ("train", folds.train(i))):
                want = fitted.transform(part).agg(metric(F.col("prediction"), F.col("y")).alias("s")).first()["s"]
                assert {(c, f, s): v for c, f, s, v in scores.rows}[combo, i, name] == pytest.approx(want)
    assert set(scores.table(spark).columns) == {"combo", "degree", "continuous", "fold", "split", "score"}


class Centre:
    """A user's model that wants the id."""

    def __init__(self, shift):
        self.shift = shift

    def fit(self, df, features, label, id_col):
        self.value = df.agg(F.avg(label), F.count(id_col)).first()[0] + self.shift
        return self

    def transform(self, df):
        return df.withColumn("prediction", F.lit(self.value))


def test_user_models_read_kept_rows(spark, df):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = df.mapInArrow(counted, df.schema)
    search = GridSearch(Centre, {"shift": [0.0, 0.5, 1.0]}, m.mae, eval_criteria="min", k_folds=3)
    rows = {r[:3]: r[3] for r in search.fit(source, XS, "y", "id").rows}
    folds = kfold(df, "id", 3)
    for c, shift in enumerate((0.0, 0.5, 1.0)):
        for i in range(3):
            model = Centre(shift).fit(folds.train(i), XS, "y", "id")
            want = model.transform(folds.test(i)).agg(m.mae(F.col("prediction"), F.col("y")).alias("s")).first()["s"]
            assert rows[c, i, "test"] == pytest.approx(want)
    assert reads.value <= 4 * df.count()  # the folds count and cut, then all models share one reading


@pytest.mark.parametrize(
    "kind, grid, metric",
    [
        (Logistic, {"gamma": [0.1, 0.2, 0.4], "max_iters": [2]}, m.f1_continuous),
        (Logistic, {"gamma": [0.5, 1.0], "max_iters": [1], "learning": ["newton"]}, m.accuracy),
        (ImbalancedLogistic, {"gamma": [0.1, 0.2], "alpha": [0.1], "max_iters": [2]}, m.f1),
        (GradientDescent, {"gamma": [0.01, 0.1], "max_iters": [2], "loss": ["mae"]}, lambda p, y: F.avg(F.abs(p - y))),
    ],
)
def test_groups_of_models_score_alike(df, kind, grid, metric):
    search = GridSearch(kind, grid, metric, k_folds=2)
    want = search.fit(df, XS, "y", "id").rows
    with session.limits(TASK_STATE_BYTES=32 * len(XS) * 3, SCORED_MODELS=2):
        got = search.fit(df, XS, "y", "id").rows
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_holdout(df):
    search = GridSearch(Logistic, {"lambda_": [0.0, 0.5], "max_iters": [2, 6]}, m.f1, ratio=0.7)
    scores = search.fit(df, XS, "y", "id")
    train, test = split(df, "id", 0.7)
    combos = grid_combinations(search.parameter_grid)
    assert len(combos) == 4 and combos[1] == {"lambda_": 0.0, "max_iters": 6}
    for combo, params in enumerate(combos):
        fitted = Logistic(**params).fit(train, XS, "y")
        got = {s: v for c, _, s, v in scores.rows if c == combo}
        assert got["test"] == pytest.approx(fitted.f1(test, "y"))
        assert got["train"] == pytest.approx(fitted.f1(train, "y"))


def test_grid_over_the_intercept(df):
    search = GridSearch(Lasso, {"intercept": [True, False]}, m.mse, {"lambda_": 0.01, "gamma": 0.1}, k_folds=2)
    rows = search.fit(df, XS, "y", "id").rows
    assert [r[0] for r in rows] == [0] * 4 + [1] * 4
    assert rows[0][3] != rows[4][3]


def test_best_prefers_the_first_and_puts_missing_last(spark):
    combos = tuple({"g": float(i)} for i in range(4))
    rows = tuple((i, 0, "test", s) for i, s in enumerate([None, 0.5, 0.9, 0.9]))
    params, table = Scores(combos, {"k": 3}, rows).best(spark)
    assert params == {"g": 2.0, "k": 3} and table.count() == 4
    assert Scores(combos, {}, rows, "min").best(spark)[0] == {"g": 1.0}


def test_grid_table(spark):
    grid = {"a": [1.0, 2.0], "b": [0.1, 0.2, 0.3]}
    rows = grid_table(spark, grid).orderBy("combo").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(c["a"], c["b"]) for c in grid_combinations(grid)]
    assert [r["combo"] for r in rows] == list(range(6))


def test_bad_settings():
    with pytest.raises(ValueError):
        GridSearch(Ridge, {}, m.mse, eval_criteria="median")
    with pytest.raises(ValueError):
        GridSearch(Ridge, {}, m.mse, stratified=True)
