"""Queries over whole workflows: prepare, rebalance, fit, predict."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators.ensemble import ClusterEnsemble
from ..operators.kmeans import KMeans
from ..operators.linear import LeastSquares
from ..operators.logistic import Logistic
from ..operators.sampling import split, upsample_copies
from ..plans import preparation as prep
from ..plans.tuning import GridSearch
from ..session import work_folder
from ..sources import tables
from ..sources.dictionary import ColumnSpec
from .common import LOGISTIC, PART_SPEC, PART_SQL, descent_ctes, query, r, rank_sql, rs, score_sql, solve_ctes, table
from .preparation import TYPES, _indicators
from .sampling import stratified_ctes

# Parts: prepare, then least squares -------------------------------------------------------------

_PARTS_X = ("bias", "p_size", *[f"p_type__{t}" for t in TYPES[:-1]])
_PARTS = (
    f"q AS ({PART_SQL}), f AS (SELECT p_partkey, p_type, p_retailprice / 1000 AS y, coalesce(p_size::DOUBLE, "
    "(SELECT quantile_cont(p_size::DOUBLE, 0.5) FROM q)) AS p_size FROM q), "
    "ev AS (SELECT y, 1.0::DOUBLE AS bias, (p_size - (SELECT avg(p_size) FROM f)) / (SELECT stddev_pop(p_size) FROM f) "
    f"AS p_size, {_indicators('p_type', TYPES[:-1])} FROM f)"
)
_SOLVED, _W = solve_ctes("ev", _PARTS_X)
_FITTED = " + ".join(f'd."{x}" * w.b{i}' for i, x in enumerate(_PARTS_X))


@query(
    "workflow_prepare_and_fit",
    f"WITH {_PARTS}, {_SOLVED}, loss AS (SELECT {rs(f'0.5 * avg(pow({_FITTED} - d.y, 2))')} AS mse FROM ev d, {_W} w) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {rs(f'b{i}')} AS weight, mse FROM {_W}, loss" for i, x in enumerate(_PARTS_X)
    ),
)
def prepare_and_fit(spark, sf):
    """Recode, impute, standardise and one-hot encode parts, then explain the price by the rest."""
    df = table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", (F.col("p_retailprice") / 1000).alias("y")
    )
    spec = ColumnSpec(("p_size",), PART_SPEC.useless, PART_SPEC.signification, ("p_partkey", "y"))
    steps = prep.Pipeline([*prep.survey_pipeline().steps, prep.AddBias()])
    fitted = steps.fit(df, spec)
    ready = fitted.transform(df)
    model = LeastSquares().fit(ready, fitted.columns, "y")
    mse = model.mse(ready, "y")
    return model.weight_table(spark).select(
        "feature", r(F.col("weight")).alias("weight"), r(F.lit(mse)).alias("mse")
    )


# Documents: prepare, up-sample, logistic model, predictions -------------------------------------

LANGS = ("de", "en", "es", "fr")  # fixed values: the languages of the documents
_DOC_X = ("chars", "lines", *[f"lang__{v}" for v in LANGS[:-1]])
_DOC_SRC = (
    "src AS (SELECT d.doc_id, d.n_chars / 1000 AS chars, len(string_split(d.text, chr(10))) / 10 AS lines, d.lang, "
    "CASE WHEN l.toxic = 1 THEN 1 ELSE -1 END AS y FROM documents d JOIN labels l USING (doc_id))"
)


def _doc_ready(train: str) -> str:
    scaled = ", ".join(
        f"(s.{c} - (SELECT avg({c}) FROM {train})) / (SELECT stddev_pop({c}) FROM {train}) AS {c}"
        for c in ("chars", "lines")
    )
    return f"SELECT s.doc_id, s.y, {scaled}, {_indicators('s.lang', LANGS[:-1]).replace('s.lang__', 'lang__')} FROM {{rows}} s"


_DOC_SPLIT = (
    f"{_DOC_SRC}, pos AS (SELECT *, {rank_sql(1, 'doc_id')} <= floor(count(*) OVER () * 0.8) AS tr FROM src), "
    "train AS (SELECT * FROM pos WHERE tr), test AS (SELECT * FROM pos WHERE NOT tr), "
    f"k AS (SELECT *, {rank_sql(1, 'doc_id', 'y')} AS rank FROM ({_doc_ready('train').format(rows='train')})), "
    "s AS (SELECT count_if(y = -1) AS t, count_if(y = 1) AS m FROM k), "
    "ev AS (SELECT k.*, CASE WHEN y = 1 THEN t // m + (rank <= t % m)::INT ELSE 1 END AS c FROM k, s), "
    f"ready AS ({_doc_ready('train').format(rows='test')})"
)
_DOC_FIT, _DOC_W = descent_ctes("ev", _DOC_X, 5, 0.324742, LOGISTIC, weight="d.c")


def _documents(spark, sf):
    """Features and labels of documents, extracted once: the workflow reads them many times."""
    return tables.load_once(_extracted(spark, sf), work_folder(spark))


def _extracted(spark, sf):
    return tables.join_labels(
        table(spark, sf, "documents").select(
            "doc_id",
            (F.col("n_chars") / 1000).alias("chars"),
            (F.size(F.split("text", "\n")) / 10).alias("lines"),
            "lang",
        ),
        table(spark, sf, "labels").select("doc_id", F.when(F.col("toxic") == 1, 1).otherwise(-1).alias("y")),
        "doc_id",
    )


DOC_SPEC = ColumnSpec(continuous=("chars", "lines"), keys=("doc_id", "y"))


@query(
    "workflow_train_predict",
    f"WITH {_DOC_SPLIT}, {_DOC_FIT} SELECT doc_id AS \"Id\", sign({score_sql(_DOC_X)})::INT AS \"Prediction\" "
    f"FROM ready d, {_DOC_W} w",
)
def train_predict(spark, sf):
    """Prepare on training rows, up-sample the minority, train, and predict the held-out rows."""
    train, test = split(_documents(spark, sf), "doc_id", 0.8)
    fitted = prep.survey_pipeline().fit(train, DOC_SPEC)
    weighted = upsample_copies(fitted.transform(train), "doc_id", "y")
    model = Logistic(0.324742, 5).fit(weighted, fitted.columns, "y", weight="copies")
    return tables.predictions(model.transform(fitted.transform(test)), "doc_id", "prediction")


# Documents: prepare, then a stratified grid -----------------------------------------------------

_GRID_SQL = (
    f"{_DOC_SRC}, prepared AS ({_doc_ready('src').format(rows='src')}), "
    f"{stratified_ctes(3, 'prepared', 'doc_id')}, ev AS (SELECT f.*, "
    + ", ".join(
        f"coalesce((SELECT c.copies FROM copied c WHERE c.doc_id = f.doc_id AND c.i = {i}), 0) AS c{i}"
        for i in range(3)
    )
    + " FROM folded f)"
)


def _grid_sql(gammas, steps) -> str:
    ctes, selects = [], []
    z = score_sql(_DOC_X)
    for i, g in enumerate(gammas):
        for fold in range(3):
            chain, last = descent_ctes("ev", _DOC_X, steps, g, LOGISTIC, prefix=f"t{i}_{fold}_", weight=f"d.c{fold}")
            ctes.append(chain)
            for part, n in (("test", f"(d.fold = {fold})::INT"), ("train", f"d.c{fold}")):
                tp = f"sum({n} * (sign({z}) = 1 AND d.y = 1)::INT)"
                off = f"sum({n} * (sign({z}) <> d.y)::INT)"
                selects.append(
                    f"SELECT {i} AS combo, {g}::DOUBLE AS gamma, {fold} AS fold, '{part}' AS split, "
                    f"{rs(f'coalesce({tp} / nullif({tp} + 0.5 * {off}, 0), 0)')} AS score FROM ev d, {last} w"
                )
    return f"WITH {_GRID_SQL}, {', '.join(ctes)} " + " UNION ALL ".join(selects)


@query("workflow_grid_search", _grid_sql([0.3, 1.0], 3))
def grid_search(spark, sf):
    """Prepare all rows, then compare step sizes on stratified, up-sampled folds."""
    df = _documents(spark, sf)
    fitted = prep.survey_pipeline().fit(df, DOC_SPEC)
    search = GridSearch(Logistic, {"gamma": [0.3, 1.0]}, m.f1, {"max_iters": 3}, k_folds=3, stratified=True)
    scores = search.fit(fitted.transform(df), fitted.columns, "y", "doc_id")
    return scores.table(spark).withColumn("score", r(F.col("score")))


@query("workflow_cluster_ensemble")
def cluster_ensemble(spark, sf):
    """Prepare, cluster the majority, train one model per cluster, vote on every row."""
    df = _documents(spark, sf)
    fitted = prep.survey_pipeline().fit(df, DOC_SPEC)
    ready = fitted.transform(df)
    model = KMeans(4, 100).fit(ready.filter("y = -1"), fitted.columns, "doc_id")
    tagged = model.training_clusters(ready)
    ensemble = ClusterEnsemble([0.01] * 4, [0.5] * 4, [20, 15, 10, 5]).fit(
        tagged, fitted.columns, "y", "cluster", "doc_id"
    )
    return tables.predictions(ensemble.transform(ready, percentage=0.3), "doc_id", "prediction")
