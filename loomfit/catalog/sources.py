"""Queries over sources, sinks and joins."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .. import session
from ..functions import statistics as st
from ..operators import sampling
from ..operators.ensemble import tag_clusters
from ..session import work_folder
from ..sources import dictionary, tables
from .common import (
    EVENT_SQL,
    PART_SPEC,
    PART_SQL,
    documents,
    DOC_SQL,
    parts,
    purchases,
    query,
    r,
    rs,
    rank_sql,
    table,
)


def _as_csv(df, spark) -> str:
    path = work_folder(spark)
    df.write.csv(path, header=True)
    return path


@query(
    "source_features_csv",
    f"SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM ({PART_SQL})",
)
def features_csv(spark, sf):
    path = _as_csv(parts(spark, sf).select("p_partkey", "p_size", "p_retailprice"), spark)
    return tables.read_features(spark, path)


@query("source_labels_csv", "SELECT doc_id, CASE WHEN toxic = 1 THEN 1 ELSE -1 END AS label FROM labels")
def labels_csv(spark, sf):
    toxic = F.when(F.col("toxic") == 1, 1).otherwise(-1).alias("toxic")
    return tables.read_labels(spark, _as_csv(table(spark, sf, "labels").select("doc_id", toxic), spark))


@query(
    "source_stride",
    "SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS k "
    "FROM orders) WHERE k % 50 = 0",
)
def stride(spark, sf):
    return sampling.stride(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


@query(
    "source_column_names",
    f"WITH p AS ({PART_SQL}) SELECT 'p_size' AS name, count(p_size) AS n FROM p "
    "UNION ALL SELECT 'p_retailprice', count(p_retailprice) FROM p",
)
def column_names(spark, sf):
    path = _as_csv(parts(spark, sf).select("p_partkey", "p_size", "p_retailprice"), spark)
    names = tables.column_names(spark, path)
    return (
        tables.read_features(spark, path)
        .unpivot([], names, "name", "value")
        .groupBy("name")
        .agg(F.count("value").alias("n"))
    )


_DICTIONARY_SQL = (
    "SELECT 'p_size' AS col, p_size::VARCHAR AS answer, min(CASE WHEN p_size IN (7, 11) THEN 'Refused' "
    "WHEN p_size = 9 THEN 'Don’t know/Not sure' ELSE p_type END) AS meaning FROM part GROUP BY p_size"
)


def _write_dictionary(spark, sf) -> str:
    """A dictionary file whose answers are the sizes of all parts; of several meanings the least one counts."""
    meaning = (
        F.when(F.col("p_size").isin(7, 11), "Refused")
        .when(F.col("p_size") == 9, "Don’t know/Not sure")
        .otherwise(F.col("p_type"))
    )
    answers = (
        table(spark, sf, "part")
        .groupBy(F.col("p_size").cast("string").alias("answer"))
        .agg(F.min(meaning).alias("meaning"))
    )
    one = answers.agg(F.map_from_entries(F.collect_list(F.struct("answer", "meaning"))).alias("Values"))
    record = one.select(
        F.to_json(
            F.struct(
                F.array(F.lit("p_size"), F.lit("p_retailprice")).alias("continuous_predictors"),
                F.array(F.lit("p_name")).alias("useless_predictors"),
                F.create_map(F.lit("p_size"), F.struct("Values")).alias("signification"),
            )
        ).alias("value")
    )
    path = work_folder(spark)
    record.write.text(path)
    return path


@query("source_dictionary", _DICTIONARY_SQL)
def dictionary_table(spark, sf):
    return dictionary.read_answer_table(spark, _write_dictionary(spark, sf))


@query(
    "source_dictionary_spec",
    f"SELECT p_partkey, CASE WHEN p_size NOT IN (SELECT answer::INT FROM ({_DICTIONARY_SQL}) "
    "WHERE meaning IN ('Refused', 'Don’t know/Not sure')) THEN p_size END AS p_size FROM part",
)
def dictionary_spec(spark, sf):
    from ..plans.preparation import RecodeMissing

    spec = dictionary.ColumnSpec.from_json(spark, _write_dictionary(spark, sf), keys=("p_partkey",))
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    return RecodeMissing().fit_transform(part, spec)


@query(
    "source_load_once",
    "SELECT d.doc_id, d.n_chars::DOUBLE AS n_chars, l.toxic AS label "
    "FROM documents d JOIN labels l USING (doc_id)",
)
def load_once(spark, sf):
    features = tables.read_features(
        spark, _as_csv(table(spark, sf, "documents").select("doc_id", "n_chars"), spark)
    )
    labels = tables.read_labels(spark, _as_csv(table(spark, sf, "labels").select("doc_id", "toxic"), spark))
    joined = tables.join_labels(features, labels, "doc_id")
    path = work_folder(spark)
    tables.load_once(joined, path)
    return tables.load_once(joined, path)


@query(
    "sink_predictions",
    f"SELECT event_id AS \"Id\", CASE WHEN x1 > 0.5 THEN 1 ELSE -1 END AS \"Prediction\" FROM ({EVENT_SQL})",
)
def sink(spark, sf):
    scored = purchases(spark, sf).withColumn("p", F.when(F.col("x1") > 0.5, 1).otherwise(-1))
    path = work_folder(spark)
    tables.write_predictions(scored, "event_id", "p", path)
    return spark.read.csv(path, header=True, schema="Id long, Prediction int")


# Joins ------------------------------------------------------------------------------------------


@query(
    "join_features_labels",
    "SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)",
)
def join_features_labels(spark, sf):
    features = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return tables.join_labels(features, table(spark, sf, "labels"), "doc_id")


@query(
    "join_gather",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def join_gather(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return sampling.gather(docs, table(spark, sf, "labels"), "doc_id")


@query(
    "join_gather_repeats",
    "SELECT d.doc_id, d.n_chars, unnest(range(1, l.quality + l.toxic + 1))::INT AS copy "
    "FROM documents d JOIN labels l USING (doc_id)",
)
def join_gather_repeats(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    copies = table(spark, sf, "labels").withColumn("copies", F.col("quality") + F.col("toxic"))
    return sampling.gather(docs, copies, "doc_id", "copies").select("doc_id", "n_chars", "copy")


@query(
    "join_remove",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def join_remove(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return sampling.remove(docs, table(spark, sf, "labels"), "doc_id")


@query(
    "join_cluster_tags",
    f"WITH d AS ({DOC_SQL}) SELECT doc_id, y, CASE WHEN y = 1 THEN -1 ELSE least(floor(chars), 9)::INT END "
    "AS cluster FROM d",
)
def join_cluster_tags(spark, sf):
    docs = documents(spark, sf)
    clusters = docs.filter("y = -1").select(
        "doc_id", F.least(F.floor("chars"), F.lit(9)).cast("int").alias("cluster")
    )
    return tag_clusters(docs, clusters, "doc_id", "y", -1).select("doc_id", "y", "cluster")


@query(
    "join_dictionary",
    "SELECT p_partkey, CASE WHEN p_size NOT IN (7, 9, 11) THEN p_size END AS p_size FROM part",
)
def join_dictionary(spark, sf):
    codes = dictionary.codes_from_answers(PART_SPEC.answer_table(spark)).filter(F.col("col") == "p_size")
    return dictionary.recode_by_dictionary(table(spark, sf, "part").select("p_partkey", "p_size"), ["p_size"], codes)


# Aggregations -----------------------------------------------------------------------------------


@query(
    "agg_missing_counts",
    f"WITH p AS ({PART_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(*) AS n, count(*) - count({c}) AS n_missing FROM p"
        for c in ("p_brand", "p_type", "p_size", "p_retailprice")
    ),
)
def missing_counts(spark, sf):
    df = parts(spark, sf)
    found = st.profile(df, PART_SPEC.features(df.columns))
    rows = [(c, p.n, p.n_missing) for c, p in found.items()]
    return spark.createDataFrame(rows, "name string, n long, n_missing long")


def _moments_sql(relation: str, columns) -> str:
    return f"WITH p AS ({relation}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS name, {rs(f'avg({c})', 9)} AS mean, {rs(f'stddev_pop({c})', 9)} AS std FROM p"
        for c in columns
    )


def _moments(spark, df, columns):
    rows = [(c, p.mean, p.std) for c, p in st.profile(df, columns).items()]
    return spark.createDataFrame(rows, "name string, mean double, std double").select(
        "name", r(F.col("mean"), 9).alias("mean"), r(F.col("std"), 9).alias("std")
    )


@query("agg_mean_std_skipping_missing", _moments_sql(PART_SQL, ("p_size", "p_retailprice")))
def mean_std_missing(spark, sf):
    return _moments(spark, parts(spark, sf), ["p_size", "p_retailprice"])


@query("agg_mean_std", _moments_sql("FROM lineitem", ("l_quantity", "l_discount", "l_tax")))
def mean_std(spark, sf):
    return _moments(spark, table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])


def _medians_sql(relation: str, columns) -> str:
    return f"WITH p AS ({relation}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS name, {rs(f'quantile_cont({c}::DOUBLE, 0.5)')} AS median FROM p" for c in columns
    )


def _medians(spark, df, columns):
    found = st.medians(df, columns, st.profile(df, columns))
    return spark.createDataFrame(list(found.items()), "name string, median double").select(
        "name", r(F.col("median")).alias("median")
    )


@query("agg_median", _medians_sql(PART_SQL, ("p_size", "p_retailprice")))
def median(spark, sf):
    return _medians(spark, parts(spark, sf), ["p_size", "p_retailprice"])


@query("agg_median_many_values", _medians_sql("FROM lineitem", ("l_extendedprice", "l_quantity")))
def median_many(spark, sf):
    return _medians(spark, table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])


_ODD_SQL = (
    "SELECT CASE WHEN l_partkey % 11 = 0 THEN 'infinity'::DOUBLE WHEN l_partkey % 13 = 0 THEN '-infinity'::DOUBLE "
    "WHEN l_partkey % 17 = 0 THEN NULL ELSE l_extendedprice END AS a, "
    "CASE WHEN l_partkey % 3 = 0 THEN l_extendedprice WHEN l_partkey % 19 = 0 THEN NULL ELSE 7.0 END AS b, "
    "CASE WHEN l_partkey % 5 < 4 THEN 'infinity'::DOUBLE ELSE l_tax END AS c FROM lineitem"
)


@query(
    "agg_median_infinities",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, {rs(f'quantile_cont({c}, 0.5)')} AS median FROM ({_ODD_SQL}) WHERE {c} IS NOT NULL"
        for c in ("a", "b", "c")
    ),
)
def median_infinities(spark, sf):
    """Medians among infinities, missing values as null or as not a number, and many repetitions."""
    part, price = F.col("l_partkey"), F.col("l_extendedprice").cast("double")
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    df = table(spark, sf, "lineitem").select(
        F.when(part % 11 == 0, inf).when(part % 13 == 0, -inf).when(part % 17 == 0, nan).otherwise(price).alias("a"),
        F.when(part % 3 == 0, price).when(part % 19 == 0, None).otherwise(7.0).alias("b"),
        F.when(part % 5 < 4, inf).otherwise(F.col("l_tax").cast("double")).alias("c"),
    )
    return _medians(spark, df, ["a", "b", "c"])


@query(
    "agg_value_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS name, {c} AS value, count(*) AS n FROM orders GROUP BY {c}"
        for c in ("o_orderstatus", "o_orderpriority")
    ),
)
def value_counts(spark, sf):
    df = table(spark, sf, "orders")
    columns = ["o_orderstatus", "o_orderpriority"]
    found = st.class_counts_of(df, columns, st.profile(df, columns))
    rows = [(c, v, n) for c, classes in found.items() for v, n in classes]
    return spark.createDataFrame(rows, "name string, value string, n long")


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query(
    "agg_correlation",
    "WITH s AS (SELECT * FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {rs(f'covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))')} AS r FROM s"
        for a in _CORR
        for b in _CORR
    ),
)
def correlation(spark, sf):
    df = table(spark, sf, "lineitem").select(*_CORR)
    found = st.correlations(df, list(_CORR), st.profile(df, _CORR))
    rows = [(a, b, float(found[i, j])) for i, a in enumerate(_CORR) for j, b in enumerate(_CORR)]
    return spark.createDataFrame(rows, "a string, b string, r double").select(
        "a", "b", r(F.col("r")).alias("r")
    )


@query(
    "agg_correlation_table",
    "WITH s AS (SELECT * FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {rs(f'covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))')} AS r FROM s"
        for i, a in enumerate(_CORR)
        for b in _CORR[i:]
    ),
)
def correlation_table(spark, sf):
    """Correlations as a table, summed in blocks of two columns."""
    df = table(spark, sf, "lineitem").select(*_CORR)
    with session.limits(BLOCK_COLUMNS=2, TASK_STATE_BYTES=256):
        cells = st.correlation_table(df, list(_CORR), st.profile(df, _CORR))
    return cells.select("a", "b", r(F.col("r")).alias("r"))


@query("agg_class_counts", f"SELECT y, count(*) AS n FROM ({EVENT_SQL}) GROUP BY y")
def class_counts(spark, sf):
    found = sampling.class_counts(purchases(spark, sf), "y")
    return spark.createDataFrame(list(found.items()), "y int, n long")


@query(
    "filter_label",
    f"SELECT event_id, x1, x2, x3 FROM ({EVENT_SQL}) WHERE y = 1",
)
def filter_label(spark, sf):
    return purchases(spark, sf).filter(F.col("y") == 1).select("event_id", "x1", "x2", "x3")


# Set operations ---------------------------------------------------------------------------------


@query(
    "set_concat_parts",
    f"WITH k AS (SELECT o_orderkey, {rank_sql(1, 'o_orderkey')} AS k, count(*) OVER () AS n FROM orders) "
    "SELECT o_orderkey, CASE WHEN k <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM k",
)
def concat_parts(spark, sf):
    train, test = sampling.split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.8)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "set_add_copies",
    "SELECT doc_id, sum(n)::BIGINT AS copies FROM (SELECT doc_id, 1 AS n FROM documents "
    "UNION ALL SELECT doc_id, quality + toxic AS n FROM labels) GROUP BY doc_id",
)
def add_copies(spark, sf):
    more = table(spark, sf, "labels").select("doc_id", (F.col("quality") + F.col("toxic")).alias("copies"))
    return sampling.add_copies([table(spark, sf, "documents"), more], "doc_id")
