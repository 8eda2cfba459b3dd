"""Cross-validation, hold-out scoring and grid search.

All settings and folds are trained side by side: a fold is a weighting of the rows, so a grid costs as
many passes as its longest run has steps (one pass for quadratic losses), plus one to score. Settings that
see different features, such as powers of different degree, share a pass where their features agree; the rows
and folds are kept once for all of them. More models than a task can hold take more passes.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Hashable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from itertools import product
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import session
from ..functions import metrics
from ..functions.scalars import quoted
from ..operators import sums
from ..operators.ensemble import f1_of
from ..operators.linear import Estimator, models_per_pass
from ..operators.sampling import kfold, stratified_upsampled_folds, train_flag
from ..operators.table import TrainingTable

TEST, TRAIN = "test", "train"
Metric = Callable[[Column, Column], Column]

# Metrics known by their sums n, tp, fp, fn, wrong, absolute and squared error.
_FROM_SUMS: dict[Any, Callable[..., float]] = {
    metrics.mse: lambda n, tp, fp, fn, wrong, a, s: 0.5 * s / n,
    metrics.rmse: lambda n, tp, fp, fn, wrong, a, s: (s / n) ** 0.5,
    metrics.mae: lambda n, tp, fp, fn, wrong, a, s: a / n,
    metrics.misclassification: lambda n, tp, fp, fn, wrong, a, s: wrong / n,
    metrics.accuracy: lambda n, tp, fp, fn, wrong, a, s: 1 - wrong / n,
    metrics.f1: lambda n, tp, fp, fn, wrong, a, s: f1_of(tp, fp, fn),
    metrics.f1_continuous: lambda n, tp, fp, fn, wrong, a, s: f1_of(tp, fp, fn),
}


def grid_combinations(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All settings, the last parameter varying fastest."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def grid_table(spark: SparkSession, grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """All settings of a numeric grid as a table, numbered in order of ``grid_combinations``."""
    out = spark.range(1).select(F.lit(0).alias("combo"))
    for name, values in grid.items():
        axis = spark.createDataFrame(
            [(i, float(v)) for i, v in enumerate(values)], f"__i int, `{name}` double"
        )
        out = (
            out.crossJoin(F.broadcast(axis))
            .withColumn("combo", F.col("combo") * len(values) + F.col("__i"))
            .drop("__i")
        )
    return out


def score_models(
    table: TrainingTable, w: np.ndarray, columns: Sequence[int], classifies: bool, metric: Metric
) -> np.ndarray:
    """(models, 2) scores on test and training rows, in one pass for as many models as a task can hold."""
    picked = np.array(columns)
    score = _score_by_sums if metric in _FROM_SUMS else _score_by_column
    group = models_per_pass(table.dim)
    if score is _score_by_column:
        group = min(group, session.SCORED_MODELS)
    parts = [slice(begin, begin + group) for begin in range(0, w.shape[1], group)]
    return np.concatenate([score(table, w[:, ms], picked[ms], classifies, metric) for ms in parts])


def _score_by_sums(table, w, columns, classifies, metric) -> np.ndarray:
    """Scores by metrics of known sums, which every task adds up for itself."""
    use_sign = classifies or metric is metrics.f1_continuous
    kernel, size = sums.evaluation_kernel(w, columns if table.n_weights else None, table.n_weights, use_sign)
    facts = table.sum(kernel, size).reshape(2, 7, w.shape[1])
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.array(
            [[_FROM_SUMS[metric](*facts[side, :, m]) for side in (0, 1)] for m in range(w.shape[1])]
        )


def _score_by_column(table, w, columns, classifies, metric) -> np.ndarray:
    """Scores by any aggregate of (prediction, label) columns.

    Such an aggregate may count rows, so a row that trains several times is repeated for it.
    """
    dim = table.dim

    @F.arrow_udf("array<double>")
    def predict(v: pa.Array) -> pa.Array:
        p = sums.vectors(v, dim) @ w
        return sums.list_array(np.sign(p) if classifies else p)

    weights = ["wt", "wv"] if table.n_weights else []
    rows = table.df.select(F.posexplode(predict("f")).alias("m", "p"), "y", *weights)
    if table.n_weights:
        column = F.element_at(F.array(*[F.lit(int(c)) for c in columns]), F.col("m") + 1)
        sides = F.array(
            F.struct(F.lit(0).alias("side"), F.get("wv", column).alias("n")),
            F.struct(F.lit(1).alias("side"), F.get("wt", column).alias("n")),
        )
        rows = rows.select("m", "p", "y", F.inline(sides)).filter(F.col("n") > 0)
        if table.repeated:
            rows = rows.select("m", "p", "y", "side", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    else:
        rows = rows.select("m", "p", "y", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    scored = rows.groupBy("m", "side").agg(metric(F.col("p"), F.col("y")).alias("score")).collect()
    out = np.full((w.shape[1], 2), np.nan)
    for r in scored:
        out[r["m"], r["side"]] = np.nan if r["score"] is None else r["score"]
    return out


@dataclass(frozen=True)
class Scores:
    """Tidy scores: one row per setting, fold and split."""

    combos: tuple[dict[str, Any], ...]
    constants: dict[str, Any]
    rows: tuple[tuple[int, int, str, float | None], ...]
    eval_criteria: str = "max"

    def table(self, spark: SparkSession) -> DataFrame:
        """``(combo, <parameters>, fold, split, score)``."""
        names = list(self.combos[0]) if self.combos else []
        kinds = {n: _spark_type([c[n] for c in self.combos]) for n in names}
        schema = T.StructType(
            [T.StructField("combo", T.IntegerType())]
            + [T.StructField(n, kinds[n]) for n in names]
            + [
                T.StructField("fold", T.IntegerType()),
                T.StructField("split", T.StringType()),
                T.StructField("score", T.DoubleType()),
            ]
        )
        data = [
            (i, *[_plain(self.combos[i][n], kinds[n]) for n in names], fold, split, score)
            for i, fold, split, score in self.rows
        ]
        return spark.createDataFrame(data, schema)

    def averages(self, spark: SparkSession) -> DataFrame:
        """Mean score over folds per setting and split; missing if any fold has none, so it ranks last."""
        scored = F.when(~F.isnan("score"), F.col("score"))
        names = list(self.combos[0]) if self.combos else []
        return (
            self.table(spark)
            .groupBy("combo", *[quoted(n) for n in names], "split")
            .agg(F.when(F.count(scored) == F.count("*"), F.avg(scored)).alias("score"))
        )

    def ranking(self, spark: SparkSession) -> DataFrame:
        """Settings by mean test score, best first; ties by position, missing scores last."""
        by = F.col("score").desc_nulls_last() if self.eval_criteria == "max" else F.col("score").asc_nulls_last()
        return self.averages(spark).filter(F.col("split") == TEST).orderBy(by, "combo")

    def best(self, spark: SparkSession) -> tuple[dict[str, Any], DataFrame]:
        """The best setting together with the constants, and all scores."""
        top = self.ranking(spark).limit(1).first()
        return {**self.combos[top["combo"]], **self.constants}, self.table(spark)


def _spark_type(values: Sequence[Any]) -> T.DataType:
    if all(isinstance(v, bool) for v in values):
        return T.BooleanType()
    if all(isinstance(v, (int, np.integer)) and not isinstance(v, bool) for v in values):
        return T.LongType()
    if all(isinstance(v, (int, float, np.number)) for v in values):
        return T.DoubleType()
    return T.StringType()


def _plain(value: Any, kind: T.DataType) -> Any:
    if isinstance(kind, T.DoubleType):
        return float(value)
    if isinstance(kind, T.LongType):
        return int(value)
    return value if isinstance(kind, T.BooleanType) else str(value)


def _finite(score: float) -> float | None:
    return None if score is None or np.isnan(score) else float(score)


@dataclass(frozen=True)
class GridSearch:
    """Scores every setting by k-fold cross-validation, or by one hold-out split without ``k_folds``.

    ``model_class`` is an ``Estimator``; a class whose objects have an ``estimator`` and prepare its features by
    ``expanded(df, features)``, such as ``Polynomial``; or any class whose objects have
    ``fit(df, features, label)`` returning a model with ``transform(df)`` that adds ``prediction``. Where that
    ``fit`` has a parameter ``id_col``, it gets the id. With ``stratified`` the folds
    are drawn per class and their training sides up-sampled.
    """

    model_class: Any
    parameter_grid: Mapping[str, Sequence[Any]]
    metric: Metric
    constant_params: Mapping[str, Any] | None = None
    eval_criteria: str = "max"
    k_folds: int | None = None
    ratio: float = 0.8
    seed: int = 1
    stratified: bool = False

    def __post_init__(self):
        if self.eval_criteria not in ("max", "min"):
            raise ValueError("eval_criteria is either `max` or `min`")
        if self.stratified and not self.k_folds:
            raise ValueError("stratified folds need k_folds")

    def fit(self, df: DataFrame, features: Sequence[str], label: str, id_col: str) -> Scores:
        constants = dict(self.constant_params or {})
        combos = grid_combinations(self.parameter_grid)
        models = [self.model_class(**c, **constants) for c in combos]
        folds = flag = None
        if self.k_folds and self.stratified:
            folds = stratified_upsampled_folds(df, id_col, label, self.k_folds, self.seed)
        elif self.k_folds:
            folds = kfold(df, id_col, self.k_folds, self.seed)
        else:
            flag = train_flag(df, id_col, self.ratio, self.seed)
        n_folds = folds.k if folds else 1
        source = folds.df if folds else df
        if all(_trains_together(model) for model in models):
            kept = [*([features] if isinstance(features, str) else features), label, id_col]
            kept += [folds.fold, folds.copies] if folds else []
            source = source.select(*[quoted(c) for c in dict.fromkeys(kept) if c])
            rows = self._together(models, source, features, label, id_col, folds, flag, n_folds)
        else:
            rows = self._one_by_one(models, source, features, label, id_col, folds, flag, n_folds)
        return Scores(tuple(combos), constants, tuple(rows), self.eval_criteria)

    def _together(self, models, source, features, label, id_col, folds, flag, n_folds):
        groups: dict[Hashable, list[int]] = {}
        for i, model in enumerate(models):
            groups.setdefault(_shared_by(model), []).append(i)
        rows = []
        with _kept(source, len(groups) > 1) as stored:
            for members in groups.values():
                df, names = stored, features
                inner = {i: models[i] for i in members}
                if not isinstance(models[members[0]], Estimator):
                    df, names = models[members[0]].expanded(stored, features)
                    inner = {i: models[i].estimator for i in members}
                kind = inner[members[0]]
                table = TrainingTable.build(
                    df,
                    names,
                    label,
                    intercept=kind.wants_intercept,
                    id_col=id_col if any(m.wants_id for m in inner.values()) else None,
                    folds=folds,
                    train=flag,
                )
                every = [(i, fold) for i in members for fold in range(n_folds)]
                columns = [fold for _, fold in every]
                with table.kept(max(getattr(m, "max_iters", 1) for m in inner.values())):
                    w, _ = type(kind).train([inner[i] for i, _ in every], table, columns)
                    scores = score_models(table, w, columns, kind.classifies, self.metric)
                for (i, fold), (test, train) in zip(every, scores):
                    rows += [(i, fold, TEST, _finite(test)), (i, fold, TRAIN, _finite(train))]
        return sorted(rows, key=lambda r: r[:2])

    def _one_by_one(self, models, source, features, label, id_col, folds, flag, n_folds):
        rows = []
        with _kept(source, len(models) * n_folds > 1) as stored:
            parts = replace(folds, df=stored) if folds else None
            for i, model in enumerate(models):
                named = {"id_col": id_col} if "id_col" in inspect.signature(model.fit).parameters else {}
                for fold in range(n_folds):
                    train = parts.train(fold) if folds else stored.filter(flag)
                    test = parts.test(fold) if folds else stored.filter(~flag)
                    fitted = model.fit(train, features, label, **named)
                    sides = [
                        fitted.transform(part).select(
                            F.lit(name).alias("side"), F.col("prediction").alias("p"), quoted(label).cast("double").alias("y")
                        )
                        for name, part in ((TEST, test), (TRAIN, train))
                    ]
                    scored = sides[0].unionByName(sides[1]).groupBy("side")
                    found = dict(scored.agg(self.metric(F.col("p"), F.col("y")).alias("s")).collect())
                    rows += [(i, fold, name, _finite(found.get(name))) for name in (TEST, TRAIN)]
        return rows


def _trains_together(model: Any) -> bool:
    return isinstance(model, Estimator) or (
        hasattr(model, "expanded") and isinstance(getattr(model, "estimator", None), Estimator)
    )


def _shared_by(model: Any) -> Hashable:
    """What models have in common that train on one table: their features, intercept and way of training."""
    if isinstance(model, Estimator):
        return None, type(model), model.wants_intercept
    return model.features_key, type(model.estimator), model.estimator.wants_intercept


@contextmanager
def _kept(df: DataFrame, several: bool) -> Iterator[DataFrame]:
    """The table, kept near the executors where several models read it; lost blocks are recomputed."""
    if not several:
        yield df
        return
    stored = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield stored
    finally:
        stored.unpersist()


@dataclass(frozen=True)
class CrossValidation:
    """k-fold scores of one estimator."""

    model: Any
    k_folds: int
    metric: Metric
    seed: int = 1

    def evaluate(self, df: DataFrame, features: Sequence[str], label: str, id_col: str) -> Scores:
        """``table`` holds the scores per fold, ``averages`` their means."""
        model = self.model
        search = GridSearch(type(model), {}, self.metric, vars(model), "max", self.k_folds, seed=self.seed)
        return search.fit(df, features, label, id_col)
