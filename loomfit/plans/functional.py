"""Fit-and-report functions: each returns the weights and the unpenalised loss."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from ..operators.linear import GradientDescent, LeastSquares, LinearModel, Ridge
from ..operators.logistic import Logistic


def _with_mse(model: LinearModel, df: DataFrame, label: str) -> tuple[np.ndarray, float]:
    return model.weights, model.mse(df, label)


def _with_log_loss(model: LinearModel, df: DataFrame, label: str) -> tuple[np.ndarray, float]:
    return model.weights, model.log_loss(df, label)


def least_squares(df: DataFrame, features: Sequence[str], label: str):
    return _with_mse(LeastSquares().fit(df, features, label), df, label)


def ridge_regression(df: DataFrame, features: Sequence[str], label: str, lambda_: float):
    return _with_mse(Ridge(lambda_).fit(df, features, label), df, label)


def mean_squared_error_gd(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    initial_w: Sequence[float] | None,
    max_iters: int,
    gamma: float,
):
    """Full-batch descent on the squared error."""
    model = GradientDescent(gamma, max_iters, "mse", initial_w).fit(df, features, label)
    return _with_mse(model, df, label)


def mean_squared_error_sgd(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    initial_w: Sequence[float] | None,
    max_iters: int,
    gamma: float,
    id_col: str,
):
    """Descent on the squared error of one row per step, in seeded order."""
    model = GradientDescent(gamma, max_iters, "mse", initial_w, batch_size=1)
    return _with_mse(model.fit(df, features, label, id_col=id_col), df, label)


def logistic_regression(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    initial_w: Sequence[float] | None,
    max_iters: int,
    gamma: float,
):
    model = Logistic(gamma, max_iters, initial_w=initial_w).fit(df, features, label)
    return _with_log_loss(model, df, label)


def reg_logistic_regression(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    lambda_: float,
    initial_w: Sequence[float] | None,
    max_iters: int,
    gamma: float,
):
    """L2-penalised logistic regression; the reported loss leaves the penalty out."""
    model = Logistic(gamma, max_iters, lambda_, initial_w=initial_w).fit(df, features, label)
    return _with_log_loss(model, df, label)
