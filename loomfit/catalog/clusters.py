"""Queries over k-means and the cluster-wise ensemble."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators.ensemble import ClusterEnsemble
from ..operators.kmeans import KMeans, cluster_means, cluster_sizes, nearest_centre
from .common import EVENT_FEATURES, EVENT_SQL, LOGISTIC, descent_ctes, purchases, query, r, rs, score_sql, table, uniform_sql
from .sampling import bootstrap_sql, lloyd_ctes, spread_ctes

XS = EVENT_FEATURES
_POINTS = "pts AS (SELECT vec_id AS id, embedding::DOUBLE[] AS f, label FROM embeddings)"
_FIRST = "SELECT row_number() OVER (ORDER BY label) - 1 AS j, arg_min(f, id) AS c FROM pts GROUP BY label"
_LLOYD, _DONE = lloyd_ctes("pts", _FIRST, 3, 64, "c")


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings")


def _first_of_each_label(df) -> np.ndarray:
    """Starting centres: the first vector of every label."""
    rows = df.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("c")).orderBy("label").collect()
    return np.array([row["c"] for row in rows], dtype=float)


def _fitted(spark, sf):
    df = _embeddings(spark, sf)
    first = _first_of_each_label(df)
    return df, KMeans(len(first), 3, init=first).fit(df, "embedding")


@query(
    "cluster_fit",
    f"WITH {_POINTS}, {_LLOYD} SELECT j::INT AS cluster, pos::VARCHAR AS feature, {rs('v')} AS value FROM "
    f"(SELECT j, unnest(c) AS v, unnest(range(64)) AS pos FROM {_DONE})",
)
def cluster_fit(spark, sf):
    _, model = _fitted(spark, sf)
    return model.centre_table(spark).withColumn("value", r(F.col("value")))


_NEAREST = (
    "SELECT p.id AS vec_id, c.j::INT AS cluster FROM pts p CROSS JOIN {c} c QUALIFY row_number() OVER "
    "(PARTITION BY p.id ORDER BY list_distance(p.f, c.c), c.j) = 1"
)


@query("cluster_assign", f"WITH {_POINTS}, {_LLOYD} {_NEAREST.format(c=_DONE)}")
def cluster_assign(spark, sf):
    df, model = _fitted(spark, sf)
    return model.assign(df).select("vec_id", "cluster")


@query("cluster_training_index", f"WITH {_POINTS}, {_LLOYD} {_NEAREST.format(c='c2')}")
def cluster_training_index(spark, sf):
    df, model = _fitted(spark, sf)
    return model.training_clusters(df).select("vec_id", "cluster")


@query(
    "cluster_sizes",
    f"WITH {_POINTS}, {_LLOYD} SELECT cluster, count(*) AS n FROM ({_NEAREST.format(c='c2')}) GROUP BY cluster",
)
def sizes(spark, sf):
    df, model = _fitted(spark, sf)
    return cluster_sizes(model.training_clusters(df))


@query(
    "cluster_centre_distances",
    f"WITH {_POINTS}, {_LLOYD} SELECT a.j::INT AS a, b.j::INT AS b, {rs('list_distance(a.c, b.c)')} AS distance "
    f"FROM {_DONE} a, {_DONE} b",
)
def centre_distances(spark, sf):
    _, model = _fitted(spark, sf)
    return model.centre_distances(spark).withColumn("distance", r(F.col("distance")))


@query(
    "cluster_nearest_given",
    f"WITH {_POINTS}, c0 AS ({_FIRST}) {_NEAREST.format(c='c0')}",
)
def nearest_given(spark, sf):
    df = _embeddings(spark, sf)
    return df.select("vec_id", nearest_centre(F.col("embedding"), _first_of_each_label(df)).alias("cluster"))


@query(
    "cluster_means",
    "SELECT label AS cluster, pos::INT AS pos, " + rs("avg(v)")
    + " AS value FROM (SELECT label, unnest(embedding::DOUBLE[]) AS v, unnest(range(64)) AS pos FROM embeddings) "
    "GROUP BY label, pos UNION ALL SELECT -1, pos::INT, pos::DOUBLE FROM range(64) t(pos)",
)
def means(spark, sf):
    df = _embeddings(spark, sf).withColumn("v", F.col("embedding").cast("array<double>"))
    known = df.select(F.col("label").alias("cluster")).distinct().unionByName(
        spark.range(1).select(F.lit(-1).alias("cluster"))
    )
    old = known.select("cluster", F.posexplode(F.array(*[F.lit(float(i)) for i in range(64)])).alias("pos", "value"))
    return cluster_means(df, "v", "label", old).withColumn("value", r(F.col("value")))


_START = [
    f"s0 AS (SELECT f FROM pts ORDER BY {uniform_sql('1:0', 'id')}, id LIMIT 1)",
    f"s1 AS (SELECT f FROM (SELECT p.f, p.id, list_distance(p.f, s0.f) AS w FROM pts p, s0) WHERE w > 0 "
    f"ORDER BY -ln({uniform_sql('1:1', 'id')}) / w, id LIMIT 1)",
    "s2 AS (SELECT f FROM (SELECT p.f, p.id, list_distance(p.f, s0.f) + list_distance(p.f, s1.f) AS w "
    f"FROM pts p, s0, s1) WHERE w > 0 ORDER BY -ln({uniform_sql('1:2', 'id')}) / w, id LIMIT 1)",
]


@query(
    "cluster_start",
    f"WITH {_POINTS}, {', '.join(_START)} "
    + " UNION ALL ".join(
        f"SELECT {j} AS cluster, pos::INT AS pos, {rs('v')} AS value FROM "
        f"(SELECT unnest(f) AS v, unnest(range(64)) AS pos FROM s{j})"
        for j in range(3)
    ),
)
def start(spark, sf):
    df = _embeddings(spark, sf).select(
        F.col("embedding").cast("array<double>").alias("f"), F.col("vec_id").alias("id")
    )
    chosen = KMeans(3).start(df)
    rows = [(j, pos, float(v)) for j, c in enumerate(chosen) for pos, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, pos int, value double").withColumn("value", r(F.col("value")))


_SPREAD, _SPREAD_LAST = lloyd_ctes("pts", "SELECT * FROM spread", 3, 64, "c")
_SPREAD = f"{spread_ctes('pts', '10')},\n{_SPREAD}"
_SPREAD_SIZES = "SELECT cluster, count(*) AS n FROM ({nearest}) GROUP BY cluster"


@query("cluster_start_spread", f"WITH RECURSIVE {_POINTS}, {spread_ctes('pts', '40')} "
       f"SELECT j::INT AS cluster, pos::INT AS pos, {rs('v')} AS value FROM "
       "(SELECT j, unnest(c) AS v, unnest(range(64)) AS pos FROM spread)")
def start_spread(spark, sf):
    """Forty seeded starting centres: more than the rows' distances are summed up for between two writes."""
    df = _embeddings(spark, sf).select(F.col("embedding").cast("array<double>").alias("f"), F.col("vec_id").alias("id"))
    rows = [(j, pos, float(v)) for j, c in enumerate(KMeans(40).start(df)) for pos, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, pos int, value double").withColumn("value", r(F.col("value")))


@query(
    "cluster_fit_spread",
    f"WITH RECURSIVE {_POINTS}, {_SPREAD} " + _SPREAD_SIZES.format(nearest=_NEAREST.format(c=_SPREAD_LAST)),
)
def fit_spread(spark, sf):
    """k-means from seeded starting centres."""
    df = _embeddings(spark, sf)
    model = KMeans(10, 3).fit(df, "embedding", "vec_id")
    return cluster_sizes(model.assign(df))


# Ensemble ---------------------------------------------------------------------------------------

_SETTINGS = {"lambdas": (0.01, 0.02, 0.005), "gammas": (0.5, 0.4, 0.3), "max_iters": (4, 3, 2)}


def _clustered(spark, sf):
    df = purchases(spark, sf)
    return df.withColumn("cluster", F.when(F.col("y") == -1, F.floor(F.col("x2") * 3).cast("int")))


def _ensemble(spark, sf):
    df = _clustered(spark, sf)
    return df, ClusterEnsemble(**_SETTINGS).fit(df, XS, "y", "cluster", "event_id")


_ENSEMBLE_DATA = (
    f"src AS (SELECT *, CASE WHEN y = -1 THEN floor(x2 * 3)::INT END AS cluster FROM ({EVENT_SQL})), "
    "mino AS (SELECT event_id FROM src WHERE y = 1), "
    "sz AS (SELECT cluster AS grp, count(*) AS n FROM src WHERE y = -1 GROUP BY ALL), "
    f"boot AS ({bootstrap_sql('sz', 'mino', 'event_id')}), "
    "ev AS (SELECT s.event_id, s.bias, s.x1, s.x2, s.x3, s.y, s.cluster, "
    + ", ".join(
        f"coalesce((s.cluster = {c})::INT, (SELECT b.copies FROM boot b WHERE b.event_id = s.event_id AND b.grp = {c}), 0) AS c{c}"
        for c in range(3)
    )
    + " FROM src s)"
)
_FITS = [
    descent_ctes(
        "ev", XS, _SETTINGS["max_iters"][c], _SETTINGS["gammas"][c], LOGISTIC,
        f"{_SETTINGS['lambdas'][c]} * sign({{b}})", prefix=f"e{c}_", weight=f"d.c{c}",
    )
    for c in range(3)
]
_ENSEMBLE_CTES = f"WITH {_ENSEMBLE_DATA}, " + ", ".join(ctes for ctes, _ in _FITS)


@query(
    "ensemble_fit",
    f"{_ENSEMBLE_CTES} " + " UNION ALL ".join(
        f"SELECT {c} AS model, '{x}' AS feature, {rs(f'b{i}')} AS weight FROM {_FITS[c][1]}"
        for c in range(3)
        for i, x in enumerate(XS)
    ),
)
def ensemble_fit(spark, sf):
    _, model = _ensemble(spark, sf)
    rows = [
        (c, x, float(model.weights[i, c])) for c in range(len(model.clusters)) for i, x in enumerate(XS)
    ]
    return spark.createDataFrame(rows, "model int, feature string, weight double").withColumn(
        "weight", r(F.col("weight"))
    )


def _held_out(c: int) -> str:
    p = f"sign({score_sql(XS)})"
    tp, fp, fn = (
        f"count_if({p} = 1 AND d.y = 1)",
        f"count_if({p} = 1 AND d.y = -1)",
        f"count_if({p} = -1 AND d.y = 1)",
    )
    f1 = f"coalesce({tp} / nullif({tp} + 0.5 * ({fp} + {fn}), 0), 0)"
    return (
        f"SELECT {c} AS model, {f1} AS f1 FROM ev d, {_FITS[c][1]} w WHERE d.cluster IS DISTINCT FROM {c}"
    )


_VOTES = "votes AS (" + " UNION ALL ".join(_held_out(c) for c in range(3)) + ")"


@query(
    "ensemble_voting_weights",
    f"{_ENSEMBLE_CTES}, {_VOTES} SELECT model, {rs('f1')} AS f1, {rs('1 / (1 + exp(-f1))')} AS voting_weight FROM votes",
)
def voting_weights(spark, sf):
    _, model = _ensemble(spark, sf)
    rows = [(i, s, v) for i, (s, v) in enumerate(zip(model.scores, model.voting_weights))]
    return spark.createDataFrame(rows, "model int, f1 double, voting_weight double").select(
        "model", r(F.col("f1")).alias("f1"), r(F.col("voting_weight")).alias("voting_weight")
    )


_SIGNS = "signs AS (SELECT d.event_id, " + ", ".join(
    f"sign({score_sql(XS, f'e{c}')})::INT AS v{c}" for c in range(3)
) + " FROM ev d, " + ", ".join(f"{_FITS[c][1]} e{c}" for c in range(3)) + ")"


@query(
    "ensemble_percentage",
    f"{_ENSEMBLE_CTES}, {_SIGNS} SELECT event_id, CASE WHEN (v0 = 1)::INT + (v1 = 1)::INT + (v2 = 1)::INT > 0.3 * 3 "
    "THEN 1 ELSE -1 END::DOUBLE AS prediction FROM signs",
)
def percentage(spark, sf):
    df, model = _ensemble(spark, sf)
    return model.transform(df, percentage=0.3).select("event_id", "prediction")


@query(
    "ensemble_weight_voting",
    f"{_ENSEMBLE_CTES}, {_SIGNS}, {_VOTES}, vw AS (SELECT "
    + ", ".join(f"max(1 / (1 + exp(-f1))) FILTER (model = {c}) AS u{c}" for c in range(3))
    + " FROM votes) SELECT event_id, sign(v0 * u0 + v1 * u1 + v2 * u2)::DOUBLE AS prediction FROM signs, vw",
)
def weight_voting(spark, sf):
    df, model = _ensemble(spark, sf)
    return model.transform(df, method="weight_voting").select("event_id", "prediction")
