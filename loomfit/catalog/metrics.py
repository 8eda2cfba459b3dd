"""Queries over scores and scalar formulas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics as m
from ..functions import scalars as sc
from .common import EVENT_SQL, purchases, query, r, rs, table

_RULE = f"SELECT x1 AS s, x1 - 0.5 AS c, CASE WHEN x1 > 0.5 THEN 1 ELSE -1 END AS p, y FROM ({EVENT_SQL})"


def _rule(spark, sf):
    """A score, its centred form and a class prediction beside the label."""
    return purchases(spark, sf).select(
        F.col("x1").alias("s"),
        (F.col("x1") - 0.5).alias("c"),
        F.when(F.col("x1") > 0.5, 1).otherwise(-1).alias("p"),
        "y",
    )


def _f1_sql(p: str) -> str:
    tp = f"count_if({p} = 1 AND y = 1)"
    fp = f"count_if({p} = 1 AND y = -1)"
    fn = f"count_if({p} = -1 AND y = 1)"
    return f"coalesce({tp} / nullif({tp} + 0.5 * ({fp} + {fn}), 0), 0)::DOUBLE"


def _metric(name, value, sql):
    @query(f"metric_{name}", f"SELECT {rs(sql)} AS score FROM ({_RULE})")
    def run(spark, sf):
        return _rule(spark, sf).agg(r(value()).alias("score"))

    return run


_metric("mse", lambda: m.mse(F.col("s"), F.col("y")), "avg(pow(s - y, 2)) * 0.5")
_metric("rmse", lambda: m.rmse(F.col("s"), F.col("y")), "sqrt(avg(pow(s - y, 2)))")
_metric("mae", lambda: m.mae(F.col("s"), F.col("y")), "avg(abs(s - y))")
_metric("misclassification", lambda: m.misclassification(F.col("p"), F.col("y")), "avg((p <> y)::INT)")
_metric("accuracy", lambda: m.accuracy(F.col("p"), F.col("y")), "1 - avg((p <> y)::INT)")
_metric("f1", lambda: m.f1(F.col("p"), F.col("y")), _f1_sql("p"))
_metric("f1_continuous", lambda: m.f1_continuous(F.col("c"), F.col("y")), _f1_sql("sign(c)"))
_metric("f1_no_positives", lambda: m.f1(-F.abs(F.col("p")), -F.abs(F.col("y"))), "count_if(abs(p) = 2)::DOUBLE")


@query(
    "metric_accuracy_f1",
    f"SELECT {rs('1 - avg((sign(c) <> y)::INT)')} AS accuracy, {rs(_f1_sql('sign(c)'))} AS f1 FROM ({_RULE})",
)
def accuracy_f1(spark, sf):
    pair = _rule(spark, sf).agg(m.accuracy_f1(F.col("c"), F.col("y")).alias("m"))
    return pair.select(r(F.col("m.accuracy")).alias("accuracy"), r(F.col("m.f1")).alias("f1"))


@query(
    "metric_weighted",
    f"SELECT {rs('sum(n * abs(s - y)) / sum(n)')} AS mae, "
    + rs("sum(n * (p = 1 AND y = 1)::INT) / (sum(n * (p = 1 AND y = 1)::INT) + 0.5 * sum(n * (p <> y)::INT))")
    + f" AS f1 FROM (SELECT *, CASE WHEN y = 1 THEN 4 ELSE 1 END AS n FROM ({_RULE}))",
)
def weighted(spark, sf):
    n = F.when(F.col("y") == 1, 4).otherwise(1)
    return _rule(spark, sf).agg(
        r(m.mae(F.col("s"), F.col("y"), n)).alias("mae"), r(m.f1(F.col("p"), F.col("y"), n)).alias("f1")
    )


# Scalar formulas --------------------------------------------------------------------------------


@query(
    "scalar_link_functions",
    f"SELECT event_id, {rs('1 / (1 + exp(-(x1 - x2)))')} AS sigmoid, "
    f"{rs('ln(1 + exp(x1 - x2))')} AS softplus, {rs('ln(1 + exp(x1)) - x1')} AS tail FROM ({EVENT_SQL})",
)
def link_functions(spark, sf):
    z = F.col("x1") - F.col("x2")
    return purchases(spark, sf).select(
        "event_id",
        r(sc.sigmoid(z)).alias("sigmoid"),
        r(sc.softplus(z)).alias("softplus"),
        r(sc.softplus(F.col("x1")) - F.col("x1")).alias("tail"),
    )


@query(
    "scalar_sign_threshold",
    f"SELECT event_id, sign(x1 - 0.5)::DOUBLE AS s, {rs('sign(x1 - 0.5) * greatest(abs(x1 - 0.5) - 0.2, 0)')} "
    f"AS shrunk FROM ({EVENT_SQL})",
)
def sign_threshold(spark, sf):
    z = F.col("x1") - 0.5
    return purchases(spark, sf).select(
        "event_id", sc.sign(z).alias("s"), r(sc.soft_threshold(z, 0.2)).alias("shrunk")
    )


@query(
    "scalar_vectors",
    "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS f FROM embeddings), "
    "c AS (SELECT arg_min(f, vec_id) AS c FROM e) SELECT vec_id, "
    f"{rs('list_inner_product(f, c)')} AS dot, {rs('sqrt(list_inner_product(f, f))')} AS norm, "
    f"{rs('list_distance(f, c)')} AS distance FROM e, c",
)
def vectors(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("f"))
    c = sc.real_array(e.agg(F.min_by("f", "vec_id")).first()[0])
    return e.select(
        "vec_id",
        r(sc.dot(F.col("f"), c)).alias("dot"),
        r(sc.norm(F.col("f"))).alias("norm"),
        r(sc.distance(F.col("f"), c)).alias("distance"),
    )


@query(
    "scalar_linear_score",
    f"SELECT event_id, {rs('0.25 * bias - 1.5 * x1 + 2 * x2 + 0.125 * x3')} AS score FROM ({EVENT_SQL})",
)
def linear_score(spark, sf):
    z = sc.linear_score(["bias", "x1", "x2", "x3"], [0.25, -1.5, 2.0, 0.125])
    return purchases(spark, sf).select("event_id", r(z).alias("score"))


@query(
    "scalar_arithmetic",
    "SELECT o_orderkey, " + ", ".join(
        f"{rs(f'{e}')} AS {n}"
        for e, n in (
            ("pow(o_totalprice / 1000, 2)", "square"),
            ("abs(o_totalprice / 1000 - 250)", "gap"),
            ("sqrt(o_totalprice)", "root"),
            ("ln(o_totalprice)", "log"),
            ("exp(-o_totalprice / 100000)", "decay"),
        )
    ) + " FROM orders",
)
def arithmetic(spark, sf):
    x = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        r(F.pow(x / 1000, 2)).alias("square"),
        r(F.abs(x / 1000 - 250)).alias("gap"),
        r(F.sqrt(x)).alias("root"),
        r(F.ln(x)).alias("log"),
        r(F.exp(-x / 100000)).alias("decay"),
    )


@query(
    "scalar_missing",
    "SELECT p_partkey, (p_size IN (7, 9, 11))::INT AS was_missing, "
    "CASE WHEN p_size IN (7, 9, 11) THEN -1 ELSE p_size END AS size_or_default FROM part",
)
def missing(spark, sf):
    from .common import parts

    return parts(spark, sf).select(
        "p_partkey",
        F.isnull("p_size").cast("int").alias("was_missing"),
        F.coalesce("p_size", F.lit(-1)).alias("size_or_default"),
    )


@query(
    "scalar_labels",
    f"SELECT event_id, CASE WHEN y = -1 THEN 0 ELSE y END::DOUBLE AS y01, y::DOUBLE AS y_again FROM ({EVENT_SQL})",
)
def labels(spark, sf):
    y01 = sc.label_to_01(F.col("y"))
    return purchases(spark, sf).select(
        "event_id", y01.alias("y01"), sc.label_to_pm1(y01).alias("y_again")
    )
