"""Queries over linear and logistic models."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import session
from ..functions import metrics as m
from ..operators.linear import (
    ElasticNet,
    GradientDescent,
    L1Penalty,
    Lasso,
    LeastSquares,
    LinearModel,
    MixedPenalty,
    Ridge,
)
from ..operators.logistic import ImbalancedLogistic, Logistic
from ..operators.sampling import upsample_copies
from ..operators.table import TrainingTable
from ..plans import functional
from ..plans.polynomial import Polynomial
from .common import (
    ABSOLUTE,
    EVENT_FEATURES,
    EVENT_SQL,
    ITEM_FEATURES,
    ITEM_SQL,
    LOGISTIC,
    SQUARED,
    descent_ctes,
    items,
    purchases,
    query,
    r,
    rank_sql,
    rs,
    score_sql,
    solve_ctes,
    table,
    weight_rows,
    weights_sql,
)

XS, IX = EVENT_FEATURES, ITEM_FEATURES
EVENTS = f"ev AS ({EVENT_SQL})"
ITEMS = f"it AS ({ITEM_SQL})"
EV_RANKED = f"ev AS (SELECT *, {rank_sql(1, 'event_id')} - 1 AS k, count(*) OVER () AS n FROM ({EVENT_SQL}))"


def _in_batch(size: int):
    return lambda t: f"((d.k - {t * size}) % d.n + d.n) % d.n < {size}"


def _fit_sql(source: str, ctes: str, last: str, xs, rename=None, places: int = 6) -> str:
    names = rename or xs
    selects = " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {rs(f'b{i}', places)} AS weight FROM {last}" for i, x in enumerate(names)
    )
    return f"WITH {source}, {ctes} {selects}"


# Closed forms and squared error -----------------------------------------------------------------


@query("fit_least_squares", _fit_sql(ITEMS, *solve_ctes("it", IX), IX))
def least_squares(spark, sf):
    return weight_rows(LeastSquares().fit(items(spark, sf), IX, "y"), spark)


@query("fit_ridge", _fit_sql(ITEMS, *solve_ctes("it", IX, ridge=0.05), IX))
def ridge(spark, sf):
    return weight_rows(Ridge(0.05).fit(items(spark, sf), IX, "y"), spark)


_GRAM = [(a, b) for a in (*IX, "y") for b in (*IX, "y")]


@query(
    "agg_gram",
    f"WITH {ITEMS} " + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {rs(f'sum({a} * {b})', 4)} AS total, count(*)::DOUBLE AS n FROM it"
        for a, b in _GRAM
    ),
)
def gram(spark, sf):
    (g,) = TrainingTable.build(items(spark, sf), IX, "y").grams()
    names = [*IX, "y"]

    def cell(i, j):
        if i == len(IX) and j == len(IX):
            return g.yty
        if i == len(IX) or j == len(IX):
            return g.xty[min(i, j)]
        return g.xtx[i, j]

    rows = [
        (a, b, float(cell(i, j)), float(g.n)) for i, a in enumerate(names) for j, b in enumerate(names)
    ]
    return spark.createDataFrame(rows, "a string, b string, total double, n double").withColumn(
        "total", r(F.col("total"), 4)
    )


_COLUMNS = (*IX, "y", "1.0")


@query(
    "agg_gram_blocks",
    f"WITH {ITEMS} " + " UNION ALL ".join(
        f"SELECT {i} AS a, {j} AS b, {rs(f'sum({a} * {b})', 4)} AS total FROM it"
        for i, a in enumerate(_COLUMNS)
        for j, b in enumerate(_COLUMNS)
        if i <= j
    ),
)
def gram_blocks(spark, sf):
    """The same sums in blocks of two columns, two pairs of blocks in a pass, never on the driver."""
    with session.limits(BLOCK_COLUMNS=2, TASK_STATE_BYTES=256):
        cells = TrainingTable.build(items(spark, sf), IX, "y").gram_table()
    return cells.select("a", "b", r(F.col("total"), 4).alias("total"))


def without_products(fit):
    """Fits a model as if D x D sums had no room: by passes over the table with D sums each."""
    with session.limits(BLOCK_COLUMNS=2, TASK_STATE_BYTES=8, DRIVER_SUM_BYTES=0):
        return fit()


@query("fit_least_squares_by_passes", _fit_sql(ITEMS, *solve_ctes("it", IX), IX))
def least_squares_by_passes(spark, sf):
    return weight_rows(without_products(lambda: LeastSquares().fit(items(spark, sf), IX, "y")), spark)


@query("fit_ridge_by_passes", _fit_sql(ITEMS, *solve_ctes("it", IX, ridge=0.05), IX))
def ridge_by_passes(spark, sf):
    return weight_rows(without_products(lambda: Ridge(0.05).fit(items(spark, sf), IX, "y")), spark)


_GD = descent_ctes("it", IX, 12, 0.2, SQUARED)


@query("fit_gd_mse", _fit_sql(ITEMS, *_GD, IX))
def gd_mse(spark, sf):
    return weight_rows(GradientDescent(0.2, 12).fit(items(spark, sf), IX, "y"), spark)


# The steps are sums of round numbers here, so a weight may lie exactly between two 6-place values.
@query("fit_gd_mae", _fit_sql(ITEMS, *descent_ctes("it", IX, 5, 0.1, ABSOLUTE), IX, places=9))
def gd_mae(spark, sf):
    return weight_rows(GradientDescent(0.1, 5, "mae").fit(items(spark, sf), IX, "y"), spark, places=9)


@query(
    "fit_gd_from_given_weights",
    _fit_sql(ITEMS, *descent_ctes("it", IX, 3, 0.1, SQUARED, initial=(0.5, -0.25, 1.0, 2.0)), IX),
)
def gd_given(spark, sf):
    model = GradientDescent(0.1, 3, initial_w=(0.5, -0.25, 1.0, 2.0)).fit(items(spark, sf), IX, "y")
    return weight_rows(model, spark)


@query(
    "fit_gd_mini_batch",
    _fit_sql(EV_RANKED, *descent_ctes("ev", XS, 6, 0.1, SQUARED, where=_in_batch(64)), XS),
)
def gd_mini_batch(spark, sf):
    model = GradientDescent(0.1, 6, batch_size=64)
    return weight_rows(model.fit(purchases(spark, sf), XS, "y", id_col="event_id"), spark)


@query(
    "fit_gd_mini_batch_mae",
    _fit_sql(EV_RANKED, *descent_ctes("ev", XS, 4, 0.03, ABSOLUTE, where=_in_batch(700)), XS),
)
def gd_mini_batch_mae(spark, sf):
    model = GradientDescent(0.03, 4, "mae", batch_size=700)
    return weight_rows(model.fit(purchases(spark, sf), XS, "y", id_col="event_id"), spark)


@query("model_weights", _fit_sql(ITEMS, *descent_ctes("it", IX, 1, 0.2, SQUARED), IX))
def model_weights(spark, sf):
    return weight_rows(GradientDescent(0.2, 1).fit(items(spark, sf), IX, "y"), spark)


_EV_GD = descent_ctes("ev", XS, 5, 0.2, SQUARED)


@query(
    "predict_linear",
    f"WITH {EVENTS}, {_EV_GD[0]} SELECT event_id, {rs(score_sql(XS))} AS prediction FROM ev d, {_EV_GD[1]} w",
)
def predict_linear(spark, sf):
    df = purchases(spark, sf)
    model = GradientDescent(0.2, 5).fit(df, XS, "y")
    return model.transform(df).select("event_id", r(F.col("prediction")).alias("prediction"))


@query(
    "metric_of_model",
    f"WITH {EVENTS}, {_EV_GD[0]}, p AS (SELECT {score_sql(XS)} AS p, y FROM ev d, {_EV_GD[1]} w) "
    f"SELECT {rs('0.5 * avg(pow(p - y, 2))')} AS mse, {rs('sqrt(avg(pow(p - y, 2)))')} AS rmse, "
    f"{rs('avg(abs(p - y))')} AS mae FROM p",
)
def metric_of_model(spark, sf):
    df = purchases(spark, sf)
    model = GradientDescent(0.2, 5).fit(df, XS, "y")
    scores = model.evaluate(df, "y", mse=m.mse, rmse=m.rmse, mae=m.mae)
    return scores.select(*[r(F.col(c)).alias(c) for c in scores.columns])


# Penalised --------------------------------------------------------------------------------------

_NAMES = ("intercept", *XS[1:])
_L1 = "0.02 * sign({b})"
_MIXED = "0.1 * (0.3 * sign({b}) + 0.7 * {b})"


def _lasso(**more):
    return Lasso(0.02, 0.2, max_iters=8, **more)


_LASSO = descent_ctes("ev", XS, 8, 0.2, SQUARED, _L1)


@query("fit_lasso", _fit_sql(EVENTS, *_LASSO, XS, _NAMES))
def lasso(spark, sf):
    return weight_rows(_lasso().fit(purchases(spark, sf), XS[1:], "y"), spark)


@query(
    "fit_lasso_losses",
    f"WITH {EVENTS}, {_LASSO[0]} "
    + " UNION ALL ".join(
        f"SELECT {t} AS iter, "
        + rs(
            f"sum(pow({score_sql(XS)} - d.y, 2)) / (2 * count(*)) + 0.02 * max("
            + " + ".join(f"abs(b{i})" for i in range(len(XS)))
            + ")"
        )
        + f" AS loss FROM ev d, w{t} w"
        for t in range(1, 9)
    ),
)
def lasso_losses(spark, sf):
    model = _lasso().fit(purchases(spark, sf), XS[1:], "y")
    return model.loss_table(spark).select("iter", r(F.col("loss")).alias("loss"))


@query(
    "fit_lasso_mini_batch",
    _fit_sql(EV_RANKED, *descent_ctes("ev", XS, 5, 0.2, SQUARED, _L1, where=_in_batch(128)), XS, _NAMES),
)
def lasso_mini_batch(spark, sf):
    model = Lasso(0.02, 0.2, max_iters=5, batch_size=128)
    return weight_rows(model.fit(purchases(spark, sf), XS[1:], "y", id_col="event_id"), spark)


@query("fit_elastic_net", _fit_sql(EVENTS, *descent_ctes("ev", XS, 8, 0.2, SQUARED, _MIXED), XS, _NAMES))
def elastic_net(spark, sf):
    model = ElasticNet(0.3, 0.1, 0.2, max_iters=8)
    return weight_rows(model.fit(purchases(spark, sf), XS[1:], "y"), spark)


def _coordinate_ctes(sweeps: int, lam: float) -> tuple[str, str]:
    n = len(XS)
    cells = [f"sum({a} * {b}) AS g{i}_{j}" for i, a in enumerate(XS) for j, b in enumerate(XS)]
    cells += [f"sum({a} * y) AS c{i}" for i, a in enumerate(XS)]
    ctes = [
        f"g AS (SELECT {', '.join(cells)} FROM ev)",
        "v0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in range(n)) + ")",
    ]
    at = 0
    for _ in range(sweeps):
        for j in range(n):
            rho = f"(c{j} - ({' + '.join(f'g{j}_{i} * b{i}' for i in range(n))}) + g{j}_{j} * b{j})"
            new = f"sign({rho}) * greatest(abs({rho}) - {lam}, 0) / g{j}_{j}"
            cols = [f"{new} AS b{i}" if i == j else f"b{i}" for i in range(n)]
            ctes.append(f"v{at + 1} AS (SELECT {', '.join(cols)} FROM g, v{at})")
            at += 1
    return ", ".join(ctes), f"v{at}"


@query("fit_lasso_coordinates", _fit_sql(EVENTS, *_coordinate_ctes(3, 5.0), XS, _NAMES))
def lasso_coordinates(spark, sf):
    model = Lasso(5.0, path=True, max_iters=3).fit(purchases(spark, sf), XS[1:], "y")
    return weight_rows(model, spark)


@query("fit_lasso_by_passes", _fit_sql(EVENTS, *_LASSO, XS, _NAMES))
def lasso_by_passes(spark, sf):
    return weight_rows(without_products(lambda: _lasso().fit(purchases(spark, sf), XS[1:], "y")), spark)


@query("fit_lasso_coordinates_by_passes", _fit_sql(EVENTS, *_coordinate_ctes(3, 5.0), XS, _NAMES))
def lasso_coordinates_by_passes(spark, sf):
    model = Lasso(5.0, path=True, max_iters=3)
    return weight_rows(without_products(lambda: model.fit(purchases(spark, sf), XS[1:], "y")), spark)


_ABS = " + ".join(f"abs(b{i})" for i in range(len(XS)))
_SQ = " + ".join(f"b{i} * b{i}" for i in range(len(XS)))


@query(
    "model_penalties",
    f"WITH {EVENTS}, {_EV_GD[0]} SELECT {rs(f'0.5 * ({_ABS})')} AS l1, "
    f"{rs(f'0.5 * (0.25 * ({_ABS}) + 0.5 * 0.75 * ({_SQ}))')} AS mixed, "
    f"{rs('0.5 * sign(b0)')} AS l1_slope, {rs('0.5 * (0.25 * sign(b0) + 0.75 * b0)')} AS mixed_slope "
    f"FROM {_EV_GD[1]}",
)
def penalties(spark, sf):
    w = GradientDescent(0.2, 5).fit(purchases(spark, sf), XS, "y").weights
    l1, mixed = L1Penalty(0.5), MixedPenalty(0.5, 0.25)
    row = (l1.value(w), mixed.value(w), float(l1.slope(w)[0]), float(mixed.slope(w)[0]))
    df = spark.createDataFrame([row], "l1 double, mixed double, l1_slope double, mixed_slope double")
    return df.select(*[r(F.col(c)).alias(c) for c in df.columns])


# Polynomial -------------------------------------------------------------------------------------

_POLY = ("bias", "x1", "x2", "x1__^2", "x2__^2")
_POLY_EV = 'ev AS (SELECT *, x1 * x1 AS "x1__^2", x2 * x2 AS "x2__^2" FROM (' + EVENT_SQL + "))"
_POLY_SOLVED = solve_ctes("ev", _POLY, ridge=1e-3)


def _polynomial(spark, sf):
    df = purchases(spark, sf)
    return df, Polynomial(2, ("x1", "x2"), Ridge(1e-3)).fit(df, ("bias", "x1", "x2"), "y")


@query("fit_polynomial", _fit_sql(_POLY_EV, *_POLY_SOLVED, _POLY))
def polynomial(spark, sf):
    return weight_rows(_polynomial(spark, sf)[1].inner, spark)


@query(
    "predict_polynomial",
    f"WITH {_POLY_EV}, {_POLY_SOLVED[0]} SELECT event_id, "
    + rs(" + ".join(f'd."{x}" * w.b{i}' for i, x in enumerate(_POLY)))
    + f" AS prediction FROM ev d, {_POLY_SOLVED[1]} w",
)
def predict_polynomial(spark, sf):
    df, model = _polynomial(spark, sf)
    return model.transform(df).select("event_id", r(F.col("prediction")).alias("prediction"))


# Logistic ---------------------------------------------------------------------------------------

_LOGIT = descent_ctes("ev", XS, 6, 0.5, LOGISTIC)


@query("fit_logistic", _fit_sql(EVENTS, *_LOGIT, XS))
def logistic(spark, sf):
    return weight_rows(Logistic(0.5, 6).fit(purchases(spark, sf), XS, "y"), spark)


@query("fit_logistic_l2", _fit_sql(EVENTS, *descent_ctes("ev", XS, 5, 0.5, LOGISTIC, "2 * 0.1 * {b}"), XS))
def logistic_l2(spark, sf):
    return weight_rows(Logistic(0.5, 5, 0.1).fit(purchases(spark, sf), XS, "y"), spark)


@query("fit_logistic_l1", _fit_sql(EVENTS, *descent_ctes("ev", XS, 5, 0.5, LOGISTIC, "0.01 * sign({b})"), XS))
def logistic_l1(spark, sf):
    return weight_rows(Logistic(0.5, 5, 0.01, reg_norm="l1").fit(purchases(spark, sf), XS, "y"), spark)


@query(
    "fit_logistic_mini_batch",
    _fit_sql(EV_RANKED, *descent_ctes("ev", XS, 5, 0.5, LOGISTIC, where=_in_batch(256)), XS),
)
def logistic_mini_batch(spark, sf):
    model = Logistic(0.5, 5, batch_size=256)
    return weight_rows(model.fit(purchases(spark, sf), XS, "y", id_col="event_id"), spark)


def _newton_ctes(steps: int, gamma: float, lam: float) -> tuple[str, str]:
    """Newton steps for the two features bias and x1."""
    z = "d.bias * w.b0 + d.x1 * w.b1"
    s = f"(1 / (1 + exp(-({z}))))"
    ctes = ["n0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1)"]
    for t in range(steps):
        res = f"({s} - (CASE WHEN d.y = 1 THEN 1 ELSE 0 END))"
        ctes.append(
            f"h{t} AS (SELECT max(w.b0) AS b0, max(w.b1) AS b1, avg({res} * d.bias) + 2 * {lam} * max(w.b0) AS g0, "
            f"avg({res} * d.x1) + 2 * {lam} * max(w.b1) AS g1, avg({s} * (1 - {s}) * d.bias) AS h00, "
            f"avg({s} * (1 - {s}) * d.x1) AS h01, avg({s} * (1 - {s}) * d.x1 * d.x1) AS h11 FROM ev d, n{t} w)"
        )
        det = "(h00 * h11 - h01 * h01)"
        ctes.append(
            f"n{t + 1} AS (SELECT b0 - {gamma} * (h11 * g0 - h01 * g1) / {det} AS b0, "
            f"b1 - {gamma} * (h00 * g1 - h01 * g0) / {det} AS b1 FROM h{t})"
        )
    return ", ".join(ctes), f"n{steps}"


@query("fit_logistic_newton", _fit_sql(EVENTS, *_newton_ctes(3, 0.9, 0.01), XS[:2]))
def logistic_newton(spark, sf):
    model = Logistic(0.9, 3, 0.01, learning="newton").fit(purchases(spark, sf), XS[:2], "y")
    return weight_rows(model, spark)


@query("fit_logistic_newton_by_products", _fit_sql(EVENTS, *_newton_ctes(3, 0.9, 0.01), XS[:2]))
def logistic_newton_by_products(spark, sf):
    """Newton steps whose Hessians are never formed, only multiplied with vectors."""
    model = Logistic(0.9, 3, 0.01, learning="newton")
    return weight_rows(without_products(lambda: model.fit(purchases(spark, sf), XS[:2], "y")), spark)


_MANY = [(0.5, 0.0), (0.25, 0.05), (1.0, 0.01)]
_MANY_CTES = [
    descent_ctes("ev", XS, 4, g, LOGISTIC, f"2 * {lam} * {{b}}", prefix=f"m{i}_")
    for i, (g, lam) in enumerate(_MANY)
]


@query(
    "fit_many_at_once",
    f"WITH {EVENTS}, " + ", ".join(c for c, _ in _MANY_CTES) + " " + " UNION ALL ".join(
        f"SELECT {i} AS model, feature, weight FROM ({weights_sql(XS, last)})"
        for i, (_, last) in enumerate(_MANY_CTES)
    ),
)
def many_at_once(spark, sf):
    models = [Logistic(g, 4, lam) for g, lam in _MANY]
    w, _ = Logistic.train(models, TrainingTable.build(purchases(spark, sf), XS, "y"), [0] * len(models))
    rows = [(i, x, float(w[j, i])) for i in range(len(models)) for j, x in enumerate(XS)]
    return spark.createDataFrame(rows, "model int, feature string, weight double").withColumn(
        "weight", r(F.col("weight"))
    )


_UP = (
    f"k AS (SELECT *, {rank_sql(1, 'event_id', 'y')} AS rank FROM ({EVENT_SQL})), "
    "s AS (SELECT count_if(y = -1) AS t, count_if(y = 1) AS m FROM k), "
    "ev AS (SELECT k.*, CASE WHEN y = 1 THEN t // m + (rank <= t % m)::INT ELSE 1 END AS c FROM k, s)"
)


@query("fit_logistic_upsampled", _fit_sql(_UP, *descent_ctes("ev", XS, 4, 0.324742, LOGISTIC, weight="d.c"), XS))
def logistic_upsampled(spark, sf):
    df = upsample_copies(purchases(spark, sf), "event_id", "y")
    return weight_rows(Logistic(0.324742, 4).fit(df, XS, "y", weight="copies"), spark)


@query(
    "predict_logistic",
    f"WITH {_UP}, {descent_ctes('ev', XS, 4, 0.324742, LOGISTIC, weight='d.c')[0]} "
    f"SELECT event_id, sign({score_sql(XS)})::DOUBLE AS prediction FROM ev d, w4 w",
)
def predict_logistic(spark, sf):
    df = upsample_copies(purchases(spark, sf), "event_id", "y")
    model = Logistic(0.324742, 4).fit(df, XS, "y", weight="copies")
    return model.transform(df).select("event_id", "prediction")


_P = "sign(" + score_sql(XS) + ")"
_CELLS = {
    "tp": f"count_if({_P} = 1 AND d.y = 1)",
    "fp": f"count_if({_P} = 1 AND d.y = -1)",
    "fn": f"count_if({_P} = -1 AND d.y = 1)",
}


@query(
    "metric_of_logistic",
    f"WITH {_UP}, {descent_ctes('ev', XS, 4, 0.324742, LOGISTIC, weight='d.c')[0]} SELECT "
    + rs("{tp} / ({tp} + 0.5 * ({fp} + {fn}))".format(**_CELLS))
    + " AS f1 FROM ev d, w4 w",
)
def metric_of_logistic(spark, sf):
    df = upsample_copies(purchases(spark, sf), "event_id", "y")
    model = Logistic(0.324742, 4).fit(df, XS, "y", weight="copies")
    return model.evaluate(df, "y", f1=m.f1).select(r(F.col("f1")).alias("f1"))


def _log_loss_sql(w: str) -> str:
    z = score_sql(XS)
    return (
        rs(f"avg(greatest({z}, 0) + ln(1 + exp(-abs({z}))) - (CASE WHEN d.y = 1 THEN 1 ELSE 0 END) * ({z}))")
        + f" AS loss FROM ev d, {w} w"
    )


@query("metric_log_loss", f"WITH {EVENTS}, {_LOGIT[0]} SELECT {_log_loss_sql(_LOGIT[1])}")
def log_loss(spark, sf):
    df = purchases(spark, sf)
    model = Logistic(0.5, 6).fit(df, XS, "y")
    return spark.createDataFrame([(model.log_loss(df, "y"),)], "loss double").select(r(F.col("loss")).alias("loss"))


def _imbalanced_ctes(steps: int, gamma: float, alpha: float) -> tuple[str, str]:
    def residual(t):
        s = "(1 / (1 + exp(-({z}))))"
        gain = " + ".join(f"ln(1 + exp({score_sql(XS, f'h{u}')}))" for u in range(1, t + 1)) or "0"
        reward = f"(1 + {alpha} * ({gain}))"
        return f"CASE WHEN d.y = 1 THEN {s} - ({reward} + {s} * (1 - {reward})) ELSE {s} END"

    def joins(t):
        return " ".join(f"CROSS JOIN w{u} h{u}" for u in range(1, t + 1))

    return descent_ctes("ev", XS, steps, gamma, residual, joins=joins)


@query("fit_imbalanced_logistic", _fit_sql(EVENTS, *_imbalanced_ctes(5, 0.4, 0.06), XS))
def imbalanced_logistic(spark, sf):
    return weight_rows(ImbalancedLogistic(0.4, 0.06, 5).fit(purchases(spark, sf), XS, "y"), spark)


@query("fit_imbalanced_logistic_stored_rewards", _fit_sql(EVENTS, *_imbalanced_ctes(5, 0.4, 0.06), XS))
def imbalanced_logistic_stored_rewards(spark, sf):
    """The same steps where past weights have room for two steps, so rewards are stored after every second."""
    with session.limits(TASK_STATE_BYTES=2 * 4 * 8 * len(XS)):
        model = ImbalancedLogistic(0.4, 0.06, 5).fit(purchases(spark, sf), XS, "y")
    return weight_rows(model, spark)


# Fit-and-report functions -----------------------------------------------------------------------


def _report(spark, names, result):
    w, loss = result
    rows = [(n, float(v), float(loss)) for n, v in zip(names, w, strict=True)]
    df = spark.createDataFrame(rows, "feature string, weight double, loss double")
    return df.select("feature", r(F.col("weight")).alias("weight"), r(F.col("loss")).alias("loss"))


def _report_sql(source: str, relation: str, ctes: str, last: str, xs, loss: str) -> str:
    return (
        f"WITH {source}, {ctes}, loss AS (SELECT {loss.format(z=score_sql(xs), d=relation, w=last)}) "
        + " UNION ALL ".join(
            f"SELECT '{x}' AS feature, {rs(f'b{i}')} AS weight, loss FROM {last}, loss" for i, x in enumerate(xs)
        )
    )


_MSE = rs("0.5 * avg(pow({z} - d.y, 2))") + " AS loss FROM {d} d, {w} w"
_LL = (
    rs("avg(greatest({z}, 0) + ln(1 + exp(-abs({z}))) - (CASE WHEN d.y = 1 THEN 1 ELSE 0 END) * ({z}))")
    + " AS loss FROM {d} d, {w} w"
)


@query("function_least_squares", _report_sql(ITEMS, "it", *solve_ctes("it", IX), IX, _MSE))
def function_least_squares(spark, sf):
    return _report(spark, IX, functional.least_squares(items(spark, sf), IX, "y"))


@query("function_ridge_regression", _report_sql(ITEMS, "it", *solve_ctes("it", IX, ridge=0.01), IX, _MSE))
def function_ridge(spark, sf):
    return _report(spark, IX, functional.ridge_regression(items(spark, sf), IX, "y", 0.01))


@query("function_mean_squared_error_gd", _report_sql(ITEMS, "it", *descent_ctes("it", IX, 7, 0.1, SQUARED), IX, _MSE))
def function_gd(spark, sf):
    return _report(spark, IX, functional.mean_squared_error_gd(items(spark, sf), IX, "y", None, 7, 0.1))


@query(
    "function_mean_squared_error_sgd",
    _report_sql(EV_RANKED, "ev", *descent_ctes("ev", XS, 8, 0.05, SQUARED, where=_in_batch(1)), XS, _MSE),
)
def function_sgd(spark, sf):
    df = purchases(spark, sf)
    return _report(spark, XS, functional.mean_squared_error_sgd(df, XS, "y", None, 8, 0.05, "event_id"))


@query(
    "function_logistic_regression",
    _report_sql(EVENTS, "ev", *descent_ctes("ev", XS, 4, 0.3, LOGISTIC), XS, _LL),
)
def function_logistic(spark, sf):
    return _report(spark, XS, functional.logistic_regression(purchases(spark, sf), XS, "y", None, 4, 0.3))


@query(
    "function_reg_logistic_regression",
    _report_sql(EVENTS, "ev", *descent_ctes("ev", XS, 4, 0.3, LOGISTIC, "2 * 0.05 * {b}"), XS, _LL),
)
def function_reg_logistic(spark, sf):
    return _report(
        spark, XS, functional.reg_logistic_regression(purchases(spark, sf), XS, "y", 0.05, None, 4, 0.3)
    )


# Vectors as features ----------------------------------------------------------------------------


@query(
    "fit_on_vectors",
    "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS f, CASE WHEN label = 0 THEN 1 ELSE -1 END AS y FROM embeddings), "
    "w1 AS (SELECT pos, 0.5 * avg(v * y) AS w FROM (SELECT y, unnest(f) AS v, unnest(range(64)) AS pos FROM e) GROUP BY pos), "
    "l1 AS (SELECT list(w ORDER BY pos) AS w FROM w1) "
    f"SELECT vec_id, {rs('list_inner_product(f, w)')} AS score FROM e, l1",
)
def on_vectors(spark, sf):
    df = table(spark, sf, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("label") == 0, 1).otherwise(-1).alias("y")
    )
    model: LinearModel = GradientDescent(0.5, 1).fit(df, "embedding", "y")
    return df.select("vec_id", r(model.score()).alias("score"))
