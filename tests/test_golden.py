"""Known values on tiny tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfit.functions import metrics as m
from loomfit.operators.linear import GradientDescent
from loomfit.operators.sampling import split
from loomfit.plans import functional
from loomfit.plans.preparation import OneHot
from loomfit.sources.dictionary import ColumnSpec


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame([(2.3, 3.2, 0.1), (1.0, 0.1, 0.2)], "a double, b double, y double")


@pytest.fixture(scope="module")
def triple(spark):
    rows = [(2.3, 3.2, 0.1), (1.0, 0.1, 0.3), (1.4, 2.3, 0.5)]
    return spark.createDataFrame(rows, "a double, b double, y double")


def test_least_squares(pair):
    w, loss = functional.least_squares(pair, ["a", "b"], "y")
    assert np.allclose(w, [0.21212121, -0.12121212], atol=1e-8)
    assert loss == pytest.approx(0, abs=1e-25)


def test_ridge(pair):
    w, _ = functional.ridge_regression(pair, ["a", "b"], "y", 0.0)
    assert np.allclose(w, [0.21212121, -0.12121212], atol=1e-8)
    w, _ = functional.ridge_regression(pair, ["a", "b"], "y", 1.0)
    assert np.allclose(w, [0.03947092, 0.00319628], atol=1e-8)


def test_descent_without_steps_returns_the_start(triple):
    w, loss = functional.mean_squared_error_gd(triple, ["a", "b"], "y", (0.413044, 0.875757), 0, 0.1)
    assert np.allclose(w, [0.413044, 0.875757])
    assert loss == pytest.approx(2.9598357, abs=1e-6)


@pytest.mark.parametrize(
    "steps, weights, loss",
    [
        (0, (0.5, 1.0), 4.0670833),
        (1, (0.0475, 0.354), 0.24939052),
        (2, (-0.0505865, 0.203718), 0.05153391),
    ],
)
def test_descent(triple, steps, weights, loss):
    w, got = functional.mean_squared_error_gd(triple, ["a", "b"], "y", (0.5, 1.0), steps, 0.1)
    assert np.allclose(w, weights)
    assert got == pytest.approx(loss, abs=1e-7)


def test_errors_of_seeded_vectors(spark):
    rng = np.random.RandomState(1)
    p, y = rng.uniform(size=100), rng.uniform(size=100)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(p, y)], "p double, y double")
    row = df.agg(
        m.mse(F.col("p"), F.col("y")).alias("mse"),
        m.rmse(F.col("p"), F.col("y")).alias("rmse"),
        m.mae(F.col("p"), F.col("y")).alias("mae"),
    ).first()
    assert row["mse"] == pytest.approx(0.0956541466988608)
    assert row["rmse"] == pytest.approx(0.4373880352704239)
    assert row["mae"] == pytest.approx(0.3601070155483342)


def test_f1(spark):
    cells = [((1, 1), 25), ((1, -1), 30), ((-1, 1), 21), ((-1, -1), 24)]
    df = spark.createDataFrame([c for c, n in cells for _ in range(n)], "p int, y int")
    assert df.agg(m.f1(F.col("p"), F.col("y"))).first()[0] == pytest.approx(0.49504950495049505)


def test_f1_without_positives(spark):
    df = spark.createDataFrame([(-1, -1)] * 3, "p int, y int")
    assert df.agg(m.f1(F.col("p"), F.col("y"))).first()[0] == 0.0
    zeros = spark.createDataFrame([(0, 1), (0, -1)], "p int, y int")
    assert zeros.agg(m.f1(F.col("p"), F.col("y"))).first()[0] == 0.0


def test_split_sizes(spark):
    train, test = split(spark.range(13), "id", 0.8)
    assert (train.count(), test.count()) == (10, 3)


def test_one_hot_toy(spark):
    rows = list(zip([0, 1, 2, 0, 0], [0, 1, 2, 3, 4], [0, 0, 0, 1, 1]))
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "col1 double, col2 double, col3 double")
    out = OneHot(drop_last=True).fit_transform(df, ColumnSpec())
    assert out.columns == [
        "col1__0.0",
        "col1__1.0",
        "col2__0.0",
        "col2__1.0",
        "col2__2.0",
        "col2__3.0",
        "col3__0.0",
    ]
    assert [r["col1__0.0"] for r in out.collect()] == [1, 0, 0, 1, 1]


def test_zero_score_predicts_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 1.0)], "a double, y double")
    model = GradientDescent(0.1, 0, initial_w=(1.0,)).fit(df, ["a"], "y")
    assert [r["prediction"] for r in model.transform(df).collect()] == [0.0, 1.0]
