"""Linear models with a quadratic or absolute loss.

A quadratic loss needs only the Gram sums: one pass over the table serves closed forms, any number
of descent steps, any grid of step sizes and penalties, and all folds. With more features than the driver
can hold D x D sums of, the same solutions come from passes over the table that need D sums each: systems are
solved by conjugate gradients, steps take their slope from a pass, and coordinates are updated block by block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any, ClassVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import metrics
from ..functions.scalars import dot, linear_score, quoted, real_array, sign
from . import sums
from .table import Gram, TrainingTable


@dataclass(frozen=True)
class LinearModel:
    """Fitted weights; predictions are plain column expressions and work on streams as well."""

    features: tuple[str, ...] | None
    weights: np.ndarray
    intercept: bool = False
    classifies: bool = False
    vector: str | None = None
    losses: tuple[float, ...] = ()

    def score(self) -> Column:
        """The linear score of a row."""
        w = self.weights[1:] if self.intercept else self.weights
        if self.vector is not None:
            z = dot(quoted(self.vector).cast("array<double>"), real_array(w))
        else:
            z = linear_score(self.features, w)
        return z + F.lit(float(self.weights[0])) if self.intercept else z

    def prediction(self) -> Column:
        return sign(self.score()) if self.classifies else self.score()

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.prediction())

    def weight_table(self, spark: SparkSession) -> DataFrame:
        """``(feature, weight)`` rows; the intercept comes first."""
        names = list(self.features or [f"{self.vector}[{i}]" for i in range(len(self.weights) - self.intercept)])
        names = ["intercept", *names] if self.intercept else names
        rows = [(n, float(w)) for n, w in zip(names, self.weights, strict=True)]
        return spark.createDataFrame(rows, "feature string, weight double")

    def loss_table(self, spark: SparkSession) -> DataFrame:
        """``(iter, loss)`` after every step, for models that track it."""
        rows = [(i + 1, float(v)) for i, v in enumerate(self.losses)]
        return spark.createDataFrame(rows, "iter int, loss double")

    def evaluate(self, df: DataFrame, label: str, **scores) -> DataFrame:
        """One row of scores of this model's predictions, in one aggregate."""
        scored = df.select(self.prediction().alias("p"), quoted(label).alias("y"))
        return scored.agg(*[f(F.col("p"), F.col("y")).alias(n) for n, f in scores.items()])

    def mse(self, df: DataFrame, label: str) -> float:
        return self.evaluate(df, label, v=metrics.mse).first()["v"]

    def rmse(self, df: DataFrame, label: str) -> float:
        return self.evaluate(df, label, v=metrics.rmse).first()["v"]

    def mae(self, df: DataFrame, label: str) -> float:
        return self.evaluate(df, label, v=metrics.mae).first()["v"]

    def f1(self, df: DataFrame, label: str) -> float:
        return self.evaluate(df, label, v=metrics.f1).first()["v"]

    def log_loss(self, df: DataFrame, label: str) -> float:
        """Mean negative log likelihood; labels are 0/1 or -1/+1."""
        from ..functions.scalars import label_to_01

        y01 = label_to_01(quoted(label))
        return df.agg(metrics.log_loss(self.score(), y01).alias("v")).first()["v"]


class Estimator:
    """What cross-validation and grid search need: train many settings on one table at once."""

    classifies: ClassVar[bool] = False
    needs_id: ClassVar[bool] = False

    @property
    def wants_intercept(self) -> bool:
        return getattr(self, "intercept", False)

    @property
    def wants_id(self) -> bool:
        return getattr(self, "batch_size", None) is not None

    @classmethod
    def train(
        cls, models: Sequence[Any], table: TrainingTable, columns: Sequence[int]
    ) -> tuple[np.ndarray, list[tuple[float, ...]]]:
        """Weights (D, models) and loss histories; model m trains with weighting ``columns[m]``."""
        raise NotImplementedError

    def fit(
        self,
        df: DataFrame,
        features: Sequence[str] | str,
        label: str,
        *,
        id_col: str | None = None,
        weight: str | None = None,
        dim: int | None = None,
    ) -> LinearModel:
        """Train on a DataFrame; ``weight`` counts a row that many times.

        ``features`` are column names, or the name of one vector column.
        """
        table = TrainingTable.build(
            df,
            features,
            label,
            dim=dim,
            intercept=self.wants_intercept,
            id_col=id_col if self.wants_id else None,
            weight=weight,
        )
        w, losses = self.train([self], table, [0])
        names, vector = (None, features) if isinstance(features, str) else (tuple(features), None)
        return LinearModel(
            names, w[:, 0], self.wants_intercept, self.classifies, vector, losses[0]
        )


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-norm solution of a square system."""
    return np.linalg.lstsq(a, b, rcond=None)[0]


def conjugate(apply, b: np.ndarray, tolerance: float = 1e-11) -> np.ndarray:
    """Solves A x = b for each column of ``b`` at once, where ``apply(p, columns)`` gives A p for some of them.

    Conjugate gradients from zero: with a singular A they lead to the least-norm solution. A column is
    done when its residual is small, or does not shrink any more.
    """
    x, r, p = np.zeros_like(b), b.copy(), b.copy()
    size = (r * r).sum(axis=0)
    goal, best, stale = tolerance**2 * size, size.copy(), np.zeros(len(size), int)
    best_x = x.copy()
    patience = min(len(b), 50) + 2
    for _ in range(20 * len(b) + 20):
        open_ = np.flatnonzero((size > goal) & (stale < patience))
        if not len(open_):
            break
        ap = apply(p[:, open_], open_)
        bend = (p[:, open_] * ap).sum(axis=0)
        flat = bend <= 0  # nothing left but rounding
        step = np.where(flat, 0.0, size[open_] / np.where(flat, 1.0, bend))
        x[:, open_] += step * p[:, open_]
        r[:, open_] -= step * ap
        left = (r[:, open_] ** 2).sum(axis=0)
        p[:, open_] = r[:, open_] + left / size[open_] * p[:, open_]
        size[open_] = np.where(flat, 0.0, left)
        better = left < best[open_]
        best_x[:, open_[better]] = x[:, open_[better]]
        stale[open_] = np.where(better, 0, stale[open_] + 1)
        best[open_] = np.minimum(best[open_], left)
    return best_x


def normal_equations(models, table: TrainingTable, columns: Sequence[int]) -> np.ndarray:
    """Weights of (X'X + 2 n lambda) w = X'y, by passes with D sums per model and iteration."""
    shape = (table.dim, len(models))
    ridge = np.array([getattr(model, "lambda_", 0.0) for model in models])
    columns = np.array(columns)
    with table.kept(table.dim):
        slope, n, _ = table.gradients("mse", np.zeros(shape), columns)

        def apply(p, ms):
            return table.gradients("product", p, columns[ms])[0] + 2 * n[ms] * ridge[ms] * p

        return conjugate(apply, -slope)


def models_per_pass(dim: int) -> int:
    """How many models of this size a task holds weights and sums of."""
    return max(1, session.TASK_STATE_BYTES // (32 * max(dim, 1)))


def start(model: Any, dim: int) -> np.ndarray:
    w = getattr(model, "initial_w", None)
    return np.zeros(dim) if w is None else np.array(w, dtype=float)


def weighting(table: TrainingTable, columns: Sequence[int], m: int) -> int:
    return columns[m] if table.n_weights else 0


@dataclass(frozen=True)
class LeastSquares(Estimator):
    """Least-norm solution of the normal equations."""

    @classmethod
    def train(cls, models, table, columns):
        if not table.gram_fits():
            return normal_equations(models, table, columns), [()] * len(models)
        grams = table.grams()
        w = [solve(g.xtx, g.xty) for g in (grams[weighting(table, columns, m)] for m in range(len(models)))]
        return np.column_stack(w), [()] * len(models)


@dataclass(frozen=True)
class Ridge(Estimator):
    """Least squares with ``2 N lambda`` added to the diagonal."""

    lambda_: float = 0.0

    @classmethod
    def train(cls, models, table, columns):
        if not table.gram_fits():
            return normal_equations(models, table, columns), [()] * len(models)
        grams = table.grams()
        out = []
        for m, model in enumerate(models):
            g = grams[weighting(table, columns, m)]
            out.append(solve(g.xtx + 2 * g.n * model.lambda_ * np.eye(table.dim), g.xty))
        return np.column_stack(out), [()] * len(models)


@dataclass(frozen=True)
class GradientDescent(Estimator):
    """Fixed-step descent on the squared (``mse``) or absolute (``mae``) error."""

    gamma: float
    max_iters: int = 100
    loss: str = "mse"
    initial_w: tuple[float, ...] | None = None
    batch_size: int | None = None
    seed: int = 1

    def __post_init__(self):
        if self.loss not in ("mse", "mae"):
            raise ValueError("loss is either `mse` or `mae`")

    @classmethod
    def train(cls, models, table, columns):
        w = np.column_stack([start(model, table.dim) for model in models])
        on_gram = [m for m, x in enumerate(models) if x.loss == "mse" and x.batch_size is None]
        if on_gram and not table.gram_fits():
            on_gram = []  # too many features for D x D sums: one pass per step instead
        if on_gram:
            grams = table.grams()
            for m in on_gram:
                g = grams[weighting(table, columns, m)]
                for _ in range(models[m].max_iters):
                    w[:, m] -= models[m].gamma * g.gradient(w[:, m]) / g.n
        for kind in ("mse", "mae"):
            rest = [m for m, x in enumerate(models) if x.loss == kind and m not in on_gram]
            gammas = np.array([models[m].gamma for m in rest])

            def step(ms, w, gradient, n, rest=rest, gammas=gammas):
                at = [rest.index(m) for m in ms]
                return w - gammas[at] * gradient / n

            descend(models, rest, table, columns, w, kind, step)
        return w, [()] * len(models)


def descend(models, picked, table, columns, w, kind, step) -> None:
    """Run the passes of all ``picked`` models together, updating their columns of ``w``.

    Models that share a batching share its batches; models that have had all their steps drop out.
    """
    groups: dict[Any, list[int]] = {}
    for m in picked:
        b = models[m].batch_size
        key = None if b is None else (b, models[m].seed, weighting(table, columns, m))
        groups.setdefault(key, []).append(m)
    for key, members in groups.items():
        steps = max(models[m].max_iters for m in members)
        if not steps:
            continue
        if key is None:
            with table.kept(steps):
                _run(models, members, lambda t: table, columns, w, kind, step, steps)
        else:
            batch_size, seed, column = key
            at = table.mini_batches(column, batch_size, steps, seed)
            _run(models, members, at, columns, w, kind, step, steps)


def _run(models, members, source_at, columns, w, kind, step, steps) -> None:
    for t in range(steps):
        source = source_at(t)
        ms = [m for m in members if models[m].max_iters > t]
        of = np.array([columns[m] for m in ms])
        if kind == "newton":
            _newton(source, w, ms, of, step)
        else:
            w[:, ms] = step(ms, w[:, ms], *source.gradients(kind, w[:, ms], of)[:2])


def _newton(source, w, ms, of, step) -> None:
    """One Newton step of the models ``ms``; ``step`` gets what solves their Hessians.

    Hessians are summed for as many models as a task can hold D x D sums of. If that is none, they are never
    formed: conjugate gradients need their products with vectors only, a pass with D sums per model each.
    """
    dim = len(w)
    room = session.TASK_STATE_BYTES // (8 * dim * dim)
    for begin in range(0, len(ms), room or len(ms)):
        part, picked = ms[begin : begin + (room or len(ms))], of[begin : begin + (room or len(ms))]
        at = w[:, part]
        if room:
            flat = source.sum(*sums.newton_kernel(at, picked if source.n_weights else None, source.n_weights))
            gradient, n = flat[: at.size].reshape(at.shape), flat[at.size : at.size + len(part)]
            hessians = flat[at.size + 2 * len(part) :].reshape(len(part), dim, dim)

            def solved(slopes, hessians=hessians, n=n):
                return np.column_stack([solve(h / k, slope) for h, k, slope in zip(hessians, n, slopes.T)])
        else:
            gradient, n, _ = source.gradients("logistic", at, picked)

            def solved(slopes, at=at, n=n, picked=picked):
                return conjugate(
                    lambda p, k: source.gradients("curvature", p, picked[k], at[:, k])[0] / n[k], slopes
                )

        w[:, part] = step(part, at, gradient, n, solved)


# Penalised descent -----------------------------------------------------------------------------


@dataclass(frozen=True)
class L1Penalty:
    lambda_: float

    def value(self, w: np.ndarray) -> float:
        return float(self.lambda_ * np.abs(w).sum())

    def slope(self, w: np.ndarray) -> np.ndarray:
        return self.lambda_ * np.sign(w)


@dataclass(frozen=True)
class MixedPenalty:
    """``l_ratio`` of the L1 penalty plus the rest of half the squared L2 norm."""

    lambda_: float
    l_ratio: float

    def value(self, w: np.ndarray) -> float:
        r = self.l_ratio
        return float(self.lambda_ * (r * np.abs(w).sum() + 0.5 * (1 - r) * (w @ w)))

    def slope(self, w: np.ndarray) -> np.ndarray:
        return self.lambda_ * (self.l_ratio * np.sign(w) + (1 - self.l_ratio) * w)


class PenalisedEstimator(Estimator):
    """Descent on ``|Xw - y|^2 / 2N + penalty``, tracking that objective after each step."""

    @property
    def penalty(self):
        raise NotImplementedError

    def one_step(self, g: Gram, w: np.ndarray) -> np.ndarray:
        if not self.path:
            return w - self.gamma * (g.gradient(w) / g.n + self.penalty.slope(w))
        return self.updated(w, 0, g.xtx, g.gradient(w))

    def updated(self, w: np.ndarray, first: int, xtx: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """The weights after the coordinates from ``first`` on were updated in turn.

        ``xtx`` are their cross products, and ``gradient`` the sums of X'(Xw - y) for them.
        """
        w, gradient = w.copy(), gradient.copy()
        for i, own in enumerate(np.diag(xtx)):
            before = w[first + i]
            rho = own * before - gradient[i]
            shrunk = np.sign(rho) * max(abs(rho) - self.lambda_, 0.0)
            w[first + i] = shrunk / own if own > 0 else 0.0
            gradient += xtx[:, i] * (w[first + i] - before)
        return w

    def objective(self, g: Gram, w: np.ndarray) -> float:
        return g.squared_error(w) / (2 * g.n) + self.penalty.value(w)

    @classmethod
    def train(cls, models, table, columns):
        out, losses = [], []
        batched: dict[Any, Any] = {}
        whole = [m for m, model in enumerate(models) if model.batch_size is None]
        passed = {} if not whole or table.gram_fits() else _by_passes(models, whole, table, columns)
        for m, model in enumerate(models):
            if m in passed:
                out.append(passed[m][0])
                losses.append(passed[m][1])
                continue
            column = weighting(table, columns, m)
            w, history = start(model, table.dim), []
            if model.batch_size is None:
                gram_at = lambda t, g=table.grams()[column]: g
            else:
                key = (model.batch_size, model.seed, column)
                if key not in batched:
                    same = [
                        x.max_iters
                        for i, x in enumerate(models)
                        if (x.batch_size, x.seed, weighting(table, columns, i)) == key
                    ]
                    batched[key] = _batch_grams(
                        table.mini_batches(column, model.batch_size, max(same), model.seed), table.dim
                    )
                gram_at = batched[key]
            for t in range(model.max_iters):
                g = gram_at(t)
                w = model.one_step(g, w)
                history.append(model.objective(g, w))
            out.append(w)
            losses.append(tuple(history))
        return np.column_stack(out), losses


def _by_passes(models, picked, table: TrainingTable, columns) -> dict[int, tuple[np.ndarray, tuple[float, ...]]]:
    """Weights and losses of the models ``picked`` without D x D sums, by one pass per step for all of them.

    Coordinate descent takes a pass per block of coordinates, with the sums of that block.
    """
    w = np.column_stack([start(models[m], table.dim) for m in picked])
    of = np.array([columns[m] for m in picked])
    iters = [models[m].max_iters for m in picked]
    losses: list[list[float]] = [[] for _ in picked]
    with table.kept(max(iters) + 1):
        slopes, n, _ = table.gradients("mse", w, of)
        for t in range(max(iters)):
            now = np.array([i for i, steps in enumerate(iters) if steps > t])
            for i in now:
                model = models[picked[i]]
                if not model.path:
                    w[:, i] -= model.gamma * (slopes[:, i] / n[i] + model.penalty.slope(w[:, i]))
                    continue
                for begin, end in sums.column_blocks(table.dim, session.BLOCK_COLUMNS):
                    column = of[i] if table.n_weights else None
                    flat = table.sum(*sums.coordinate_kernel(w[:, i], begin, end, column, table.n_weights))
                    size = end - begin
                    w[:, i] = model.updated(w[:, i], begin, flat[size:].reshape(size, size), flat[:size])
            slopes[:, now], n[now], squares = table.gradients("mse", w[:, now], of[now])
            for i, square in zip(now, squares):
                losses[i].append(square / (2 * n[i]) + models[picked[i]].penalty.value(w[:, i]))
    return {m: (w[:, i], tuple(losses[i])) for i, m in enumerate(picked)}


def _batch_grams(batch_at, dim: int):
    known: dict[int, Gram] = {}

    def at(t: int) -> Gram:
        if t not in known:
            known[t] = batch_at(t).grams()[0]
        return known[t]

    return at


@dataclass(frozen=True)
class Lasso(PenalisedEstimator):
    """L1-penalised regression by subgradient steps, or by coordinate descent with ``path``."""

    lambda_: float
    gamma: float = 0.1
    path: bool = False
    intercept: bool = True
    max_iters: int = 100
    initial_w: tuple[float, ...] | None = None
    batch_size: int | None = None
    seed: int = 1

    @property
    def penalty(self):
        return L1Penalty(self.lambda_)


@dataclass(frozen=True)
class ElasticNet(PenalisedEstimator):
    """Regression with a mix of L1 and L2 penalties."""

    l_ratio: float
    lambda_: float
    gamma: float
    path: bool = False
    intercept: bool = True
    max_iters: int = 100
    initial_w: tuple[float, ...] | None = None
    batch_size: int | None = None
    seed: int = 1

    @property
    def penalty(self):
        return MixedPenalty(self.lambda_, self.l_ratio)
