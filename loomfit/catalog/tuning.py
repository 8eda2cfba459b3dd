"""Queries over cross-validation and grid search."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from ..functions import metrics as m
from ..functions import statistics as st
from ..functions.scalars import quoted
from ..operators.linear import GradientDescent, Lasso, Ridge
from ..operators.logistic import Logistic
from ..plans.polynomial import Polynomial
from ..plans.tuning import CrossValidation, GridSearch, Scores, grid_table
from .common import (
    EVENT_FEATURES,
    EVENT_SQL,
    LOGISTIC,
    SQUARED,
    descent_ctes,
    purchases,
    query,
    r,
    rank_sql,
    rs,
    score_sql,
    solve_ctes,
    table,
)
from .sampling import stratified_ctes

XS = EVENT_FEATURES
_BIG = f"SELECT * REPLACE (CASE WHEN x1 > 0.4 THEN 1 ELSE -1 END AS y) FROM ({EVENT_SQL})"
_FOLDED = (
    "ev AS (SELECT * FROM (SELECT *, (k // (n // 3))::INT AS fold FROM (SELECT *, "
    f"{rank_sql(1, 'event_id')} - 1 AS k, count(*) OVER () AS n FROM ({{src}}))) WHERE fold < 3)"
)
_SPLIT = (
    f"ev AS (SELECT *, (rank <= floor(n * 0.8))::INT AS train FROM (SELECT *, {rank_sql(1, 'event_id')} AS rank, "
    "count(*) OVER () AS n FROM ({src})))"
)


def _large(spark, sf):
    """Events labelled by whether their value is large: an easy, nearly balanced target."""
    return purchases(spark, sf).withColumn("y", F.when(F.col("x1") > 0.4, 1).otherwise(-1))


def _rounded(scores: Scores, spark) -> DataFrame:
    return scores.table(spark).withColumn("score", r(F.col("score")))


def _f1(p: str, weight: str = "1") -> str:
    tp = f"sum({weight} * ({p} = 1 AND d.y = 1)::INT)"
    fp = f"sum({weight} * ({p} = 1 AND d.y = -1)::INT)"
    fn = f"sum({weight} * ({p} = -1 AND d.y = 1)::INT)"
    return f"coalesce({tp} / nullif({tp} + 0.5 * ({fp} + {fn}), 0), 0)"


def _scores_sql(source: str, runs) -> str:
    """``runs`` are (ctes, last relation, columns, test filter, train filter, fold, score formula)."""
    ctes = ", ".join(run[0] for run in runs)
    selects = []
    for _, last, columns, test, train, fold, score in runs:
        for split, where in (("test", test), ("train", train)):
            selects.append(
                f"SELECT {columns}{fold} AS fold, '{split}' AS split, {rs(score)} AS score "
                f"FROM ev d, {last} w WHERE {where}"
            )
    return f"WITH {source}, {ctes} " + " UNION ALL ".join(selects)


_Z = score_sql(XS)


def _ridge_runs(lambdas, score: str, prefix="r", combo=True):
    out = []
    for i, lam in enumerate(lambdas):
        for fold in range(3):
            ctes, last = solve_ctes("ev", XS, lam, f"{prefix}{i}_{fold}_", f"d.fold <> {fold}")
            columns = f"{i} AS combo, {lam}::DOUBLE AS lambda_, " if combo else "0 AS combo, "
            out.append((ctes, last, columns, f"d.fold = {fold}", f"d.fold <> {fold}", fold, score))
    return out


_MSE = f"0.5 * avg(pow({_Z} - d.y, 2))"


@query("tune_cross_validation", _scores_sql(_FOLDED.format(src=_BIG), _ridge_runs([0.01], _MSE, combo=False)))
def cross_validation(spark, sf):
    scores = CrossValidation(Ridge(0.01), 3, m.mse).evaluate(_large(spark, sf), XS, "y", "event_id")
    return _rounded(scores, spark)


def _logistic_runs(gammas, steps, source_fold=True):
    out = []
    for i, g in enumerate(gammas):
        for fold in range(3):
            ctes, last = descent_ctes(
                "ev", XS, steps, g, LOGISTIC, prefix=f"l{i}_{fold}_", where=f"d.fold <> {fold}"
            )
            out.append(
                (
                    ctes,
                    last,
                    f"{i} AS combo, {g}::DOUBLE AS gamma, ",
                    f"d.fold = {fold}",
                    f"d.fold <> {fold}",
                    fold,
                    _f1(f"sign({_Z})"),
                )
            )
    return out


@query("tune_grid_logistic", _scores_sql(_FOLDED.format(src=_BIG), _logistic_runs([0.5, 2.0], 5)))
def grid_logistic(spark, sf):
    search = GridSearch(Logistic, {"gamma": [0.5, 2.0]}, m.f1, {"max_iters": 5}, k_folds=3)
    return _rounded(search.fit(_large(spark, sf), XS, "y", "event_id"), spark)


_RIDGE_GRID = _scores_sql(_FOLDED.format(src=_BIG), _ridge_runs([0.001, 0.01, 0.1], _MSE))


def _ridge_search(spark, sf) -> Scores:
    search = GridSearch(Ridge, {"lambda_": [0.001, 0.01, 0.1]}, m.mse, eval_criteria="min", k_folds=3)
    return search.fit(_large(spark, sf), XS, "y", "event_id")


@query("tune_grid_ridge", _RIDGE_GRID)
def grid_ridge(spark, sf):
    return _rounded(_ridge_search(spark, sf), spark)


@query(
    "tune_fold_means",
    f"SELECT combo, lambda_, split, {rs('avg(score)')} AS score FROM "
    f"({_RIDGE_GRID}) "
    "GROUP BY combo, lambda_, split",
)
def fold_means(spark, sf):
    scores = _rounded(_ridge_search(spark, sf), spark)
    return scores.groupBy("combo", "lambda_", "split").agg(r(F.avg("score")).alias("score"))


@query(
    "tune_best",
    f"SELECT combo, lambda_ FROM (SELECT combo, lambda_, avg(score) AS score FROM ({_RIDGE_GRID}) "
    "WHERE split = 'test' GROUP BY ALL) ORDER BY score, combo LIMIT 1",
)
def best(spark, sf):
    return _ridge_search(spark, sf).ranking(spark).limit(1).select("combo", "lambda_")


def _holdout_runs(grid, score):
    out = []
    for i, (lam, g) in enumerate(grid):
        ctes, last = descent_ctes(
            "ev", XS, 4, g, LOGISTIC, f"2 * {lam} * {{b}}", prefix=f"o{i}_", where="d.train = 1"
        )
        columns = f"{i} AS combo, {lam}::DOUBLE AS lambda_, {g}::DOUBLE AS gamma, "
        out.append((ctes, last, columns, "d.train = 0", "d.train = 1", 0, score))
    return out


_GRID = [(lam, g) for lam in (0.0, 0.05) for g in (0.5, 1.5)]


@query(
    "tune_grid_holdout",
    _scores_sql(_SPLIT.format(src=_BIG), _holdout_runs(_GRID, f"1 - avg((sign({_Z}) <> d.y)::INT)")),
)
def grid_holdout(spark, sf):
    search = GridSearch(Logistic, {"lambda_": [0.0, 0.05], "gamma": [0.5, 1.5]}, m.accuracy, {"max_iters": 4})
    return _rounded(search.fit(_large(spark, sf), XS, "y", "event_id"), spark)


def _custom_error(p, y):
    """A user-defined score: the median absolute error."""
    return F.percentile(F.abs(p - y), F.lit(0.5))


@query(
    "tune_custom_metric",
    _scores_sql(
        _FOLDED.format(src=_BIG), _ridge_runs([0.01, 0.1], f"quantile_cont(abs({_Z} - d.y), 0.5)", "u")
    ),
)
def custom_metric(spark, sf):
    search = GridSearch(Ridge, {"lambda_": [0.01, 0.1]}, _custom_error, eval_criteria="min", k_folds=3)
    return _rounded(search.fit(_large(spark, sf), XS, "y", "event_id"), spark)


@dataclass(frozen=True)
class ScaledMean:
    """A user-defined model: predicts the mean label of the training rows times a factor."""

    factor: float

    def fit(self, df, features, label):
        mean = df.agg(F.avg(quoted(label)).alias("v")).first()["v"]
        return _Constant(self.factor * mean)


@dataclass(frozen=True)
class _Constant:
    value: float

    def transform(self, df, name="prediction"):
        return df.withColumn(name, F.lit(self.value))


@query(
    "tune_custom_model",
    f"WITH {_SPLIT.format(src=_BIG)}, t AS (SELECT avg(y) AS mean FROM ev WHERE train = 1) "
    + " UNION ALL ".join(
        f"SELECT {i} AS combo, {f}::DOUBLE AS factor, 0 AS fold, '{split}' AS split, "
        f"{rs(f'avg(abs({f} * mean - y))')} AS score FROM ev, t WHERE train = {flag}"
        for i, f in enumerate((0.5, 1.0))
        for split, flag in (("test", 0), ("train", 1))
    ),
)
def custom_model(spark, sf):
    search = GridSearch(ScaledMean, {"factor": [0.5, 1.0]}, m.mae, eval_criteria="min")
    return _rounded(search.fit(_large(spark, sf), XS, "y", "event_id"), spark)


_POLY = {1: ("x1", "x2"), 2: ("x1", "x2", "x1__^2", "x2__^2")}


def _polynomial_runs():
    out = []
    for i, degree in enumerate(_POLY):
        xs = _POLY[degree]
        ctes, last = solve_ctes("ev", xs, 1e-3, f"p{degree}_", "d.train = 1")
        z = " + ".join(f'd."{x}" * w.b{j}' for j, x in enumerate(xs))
        columns = f"{i} AS combo, {degree}::BIGINT AS degree, "
        out.append((ctes, last, columns, "d.train = 0", "d.train = 1", 0, f"0.5 * avg(pow({z} - d.y, 2))"))
    return out


_POWERS = f'SELECT *, x1 * x1 AS "x1__^2", x2 * x2 AS "x2__^2" FROM ({_BIG})'


@query("tune_polynomial_degree", _scores_sql(_SPLIT.format(src=_POWERS), _polynomial_runs()))
def polynomial_degree(spark, sf):
    constants = {"continuous": ("x1", "x2"), "estimator": Ridge(1e-3)}
    search = GridSearch(Polynomial, {"degree": [1, 2]}, m.mse, constants, "min")
    return _rounded(search.fit(_large(spark, sf), ("x1", "x2"), "y", "event_id"), spark)


def _polynomial_batch_runs(steps, gamma, size):
    out = []
    n = "floor(d.n * 0.8)::BIGINT"
    in_batch = lambda t: f"d.train = 1 AND ((d.rank - 1 - {t * size}) % {n} + {n}) % {n} < {size}"
    for i, degree in enumerate(_POLY):
        xs = [f'"{x}"' for x in _POLY[degree]]
        ctes, last = descent_ctes("ev", xs, steps, gamma, SQUARED, prefix=f"q{degree}_", where=in_batch)
        columns = f"{i} AS combo, {degree}::BIGINT AS degree, "
        out.append((ctes, last, columns, "d.train = 0", "d.train = 1", 0, f"0.5 * avg(pow({score_sql(xs)} - d.y, 2))"))
    return out


@query("tune_polynomial_mini_batch", _scores_sql(_SPLIT.format(src=_POWERS), _polynomial_batch_runs(6, 0.1, 64)))
def polynomial_mini_batch(spark, sf):
    constants = {"continuous": ("x1", "x2"), "estimator": GradientDescent(0.1, 6, batch_size=64)}
    search = GridSearch(Polynomial, {"degree": [1, 2]}, m.mse, constants, "min")
    return _rounded(search.fit(_large(spark, sf), ("x1", "x2"), "y", "event_id"), spark)


_MANY = [round(0.1 * (i + 1), 1) for i in range(8)]


@query("tune_grid_in_groups", _scores_sql(_FOLDED.format(src=_BIG), _logistic_runs(_MANY, 3)))
def grid_in_groups(spark, sf):
    """A grid of more models than a task may hold takes more passes, with equal scores."""
    search = GridSearch(Logistic, {"gamma": _MANY}, m.f1, {"max_iters": 3}, k_folds=3)
    with session.limits(TASK_STATE_BYTES=32 * len(XS) * 7):
        return _rounded(search.fit(_large(spark, sf), XS, "y", "event_id"), spark)


_LASSO_RUNS = []
for _fold in range(3):
    _ctes, _last = descent_ctes(
        "ev", XS, 6, 0.3, SQUARED, "0.05 * sign({b})", prefix=f"a{_fold}_", where=f"d.fold <> {_fold}"
    )
    _LASSO_RUNS.append(
        (_ctes, _last, "0 AS combo, ", f"d.fold = {_fold}", f"d.fold <> {_fold}", _fold, _f1(f"sign({_Z})"))
    )


@query("tune_cross_validation_lasso", _scores_sql(_FOLDED.format(src=_BIG), _LASSO_RUNS))
def cross_validation_lasso(spark, sf):
    model = Lasso(0.05, 0.3, max_iters=6)
    scores = CrossValidation(model, 3, m.f1_continuous).evaluate(_large(spark, sf), XS[1:], "y", "event_id")
    return _rounded(scores, spark)


# Stratified, up-sampled folds -------------------------------------------------------------------

_COPIES = (
    f"src AS ({EVENT_SQL}), {stratified_ctes(3, 'src', 'event_id')}, ev AS (SELECT f.*, "
    + ", ".join(
        f"coalesce((SELECT c.copies FROM copied c WHERE c.event_id = f.event_id AND c.i = {i}), 0) AS c{i}"
        for i in range(3)
    )
    + " FROM folded f)"
)


def _stratified_sql(gammas, steps) -> str:
    ctes, selects = [], []
    for i, g in enumerate(gammas):
        for fold in range(3):
            chain, last = descent_ctes(
                "ev", XS, steps, g, LOGISTIC, prefix=f"t{i}_{fold}_", weight=f"d.c{fold}"
            )
            ctes.append(chain)
            wrong = f"(sign({_Z}) <> d.y)::INT"
            for split, weight in (("test", f"(d.fold = {fold})::INT"), ("train", f"d.c{fold}")):
                selects.append(
                    f"SELECT {i} AS combo, {g}::DOUBLE AS gamma, {fold} AS fold, '{split}' AS split, "
                    + rs(f"1 - sum({weight} * {wrong}) / sum({weight})")
                    + f" AS score FROM ev d, {last} w"
                )
    return f"WITH {_COPIES}, {', '.join(ctes)} " + " UNION ALL ".join(selects)


@query("tune_grid_stratified", _stratified_sql([0.324742, 1.0], 3))
def grid_stratified(spark, sf):
    search = GridSearch(
        Logistic, {"gamma": [0.324742, 1.0]}, m.accuracy, {"max_iters": 3}, k_folds=3, stratified=True
    )
    return _rounded(search.fit(purchases(spark, sf), XS, "y", "event_id"), spark)


@query(
    "tune_combinations",
    "WITH a AS (SELECT l_discount, row_number() OVER (ORDER BY l_discount) - 1 AS i FROM (SELECT DISTINCT l_discount FROM lineitem)), "
    "b AS (SELECT l_tax, row_number() OVER (ORDER BY l_tax) - 1 AS j, count(*) OVER () AS n FROM (SELECT DISTINCT l_tax FROM lineitem)) "
    "SELECT (i * n + j)::INT AS combo, l_discount, l_tax FROM a, b",
)
def combinations(spark, sf):
    """All pairs of the discounts and taxes that occur among the line items."""
    df, columns = table(spark, sf, "lineitem"), ["l_discount", "l_tax"]
    found = st.class_counts_of(df, columns, st.profile(df, columns))
    return grid_table(spark, {c: [v for v, _ in found[c]] for c in columns}).withColumn("combo", F.col("combo").cast("int"))
