"""Logistic models trained by a fixed number of full-table, mini-batch or Newton steps."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import ClassVar

import numpy as np
from pyspark.sql import functions as F

from .. import session
from ..session import work_folder
from . import sums
from .linear import Estimator, descend, models_per_pass, start
from .table import TrainingTable

# Steps after which the per-row rewards of the imbalanced loss are stored, or earlier where their weights
# would take more than a quarter of what a task may hold.
REFRESH_STEPS = 50


@dataclass(frozen=True)
class Logistic(Estimator):
    """Logistic regression; labels are -1/+1 (or 0/1), predictions are the sign of the score."""

    gamma: float = 0.5
    max_iters: int = 300
    lambda_: float = 0.0
    learning: str = "gradient_descent"
    reg_norm: str = "l2"
    initial_w: tuple[float, ...] | None = None
    batch_size: int | None = None
    seed: int = 1
    classifies: ClassVar[bool] = True

    def __post_init__(self):
        if self.learning not in ("gradient_descent", "newton"):
            raise ValueError("learning is either `gradient_descent` or `newton`")
        if self.reg_norm not in ("l1", "l2"):
            raise ValueError("reg_norm is either `l1` or `l2`")

    def penalty_slope(self, w: np.ndarray) -> np.ndarray:
        return self.lambda_ * (2 * w if self.reg_norm == "l2" else np.sign(w))

    @classmethod
    def train(cls, models, table, columns):
        w = np.column_stack([start(model, table.dim) for model in models])

        def plain(ms, w, gradient, n):
            gradient = gradient / n
            for i, m in enumerate(ms):
                gradient[:, i] += models[m].penalty_slope(w[:, i])
            return w - np.array([models[m].gamma for m in ms]) * gradient

        def newton(ms, w, gradient, n, solved):
            slopes = gradient / n
            for i, m in enumerate(ms):
                slopes[:, i] += models[m].penalty_slope(w[:, i])
            return w - np.array([models[m].gamma for m in ms]) * solved(slopes)

        for kind, learning, step in (
            ("logistic", "gradient_descent", plain),
            ("newton", "newton", newton),
        ):
            picked = [m for m, x in enumerate(models) if x.learning == learning]
            descend(models, picked, table, columns, w, kind, step)
        return w, [()] * len(models)


@dataclass(frozen=True)
class ImbalancedLogistic(Estimator):
    """Logistic regression whose positive rows carry a reward that grows while they score high.

    The reward of a positive row is ``1 + alpha * sum_s ln(1 + e^(x . w_s))`` over the steps so far.
    It is recomputed inside each pass from the past weights. Every ``REFRESH_STEPS`` steps, and whenever the
    past weights fill their share of a task's memory, the positive rows are written to the shared folder with
    their rewards and the past is dropped.
    """

    gamma: float
    alpha: float
    max_iters: int = 100
    initial_w: tuple[float, ...] | None = None
    classifies: ClassVar[bool] = True

    @classmethod
    def train(cls, models, table, columns):
        group = models_per_pass(table.dim)
        if len(models) > group:
            with table.kept(max(m.max_iters for m in models)):
                parts = [slice(i, i + group) for i in range(0, len(models), group)]
                return np.hstack([cls.train(models[ms], table, columns[ms])[0] for ms in parts]), [()] * len(models)
        w = np.column_stack([start(model, table.dim) for model in models])
        gammas = np.array([m.gamma for m in models])
        alphas = np.array([m.alpha for m in models])
        iters = np.array([m.max_iters for m in models])
        picked = np.array(columns) if table.n_weights else None
        names = [c for c in table.df.columns if c != "id"]
        ones = F.array(*[F.lit(1.0)] * len(models))
        with table.kept(iters.max(initial=0)):
            negatives = table.df.select(*names).filter(F.col("y") <= 0).withColumn("p", ones)
            positives = table.df.select(*names).filter(F.col("y") > 0).withColumn("p", ones)
            history: list[np.ndarray] = []
            current = TrainingTable(
                table.df.select(*names).withColumn("p", ones), table.dim, table.n_weights, tasks=table.tasks
            )
            for t in range(iters.max(initial=0)):
                room = max(1, session.TASK_STATE_BYTES // (4 * 8 * w.size))
                if len(history) >= min(REFRESH_STEPS, room):
                    positives = cls._store_rewards(positives, np.array(history), alphas, table.dim)
                    current = replace(current, df=negatives.unionByName(positives), tasks=None)
                    history = []
                past = np.array(history).reshape(-1, *w.shape)
                kernel, size = sums.imbalanced_kernel(w, past, alphas, picked, table.n_weights)
                flat = current.sum(kernel, size)
                gradient, n = flat[: w.size].reshape(w.shape), flat[w.size :]
                w = np.where(iters > t, w - gammas * gradient / n, w)
                history.append(w)
        return w, [()] * len(models)

    @staticmethod
    def _store_rewards(positives, history, alphas, dim):
        spark, path = positives.sparkSession, work_folder(positives.sparkSession)
        refresh = sums.reward_batches(history, alphas, dim, positives.columns)
        positives.mapInArrow(refresh, positives.schema).write.parquet(path)
        return spark.read.parquet(path)
