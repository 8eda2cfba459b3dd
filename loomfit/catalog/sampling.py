"""Queries over seeded order, splits, folds, batches and resampling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import sampling
from ..operators.kmeans import downsample_to_centres
from ..operators.ordering import id_rank, seeded_rank
from .common import DOC_SQL, EVENT_SQL, documents, key_sql, purchases, query, r, rank_sql, rs, table

ORDER_RANK = f"SELECT o_orderkey, {rank_sql(1, 'o_orderkey')} AS rank, count(*) OVER () AS n FROM orders"
EVENT_RANK = f"SELECT *, {rank_sql(1, 'event_id', 'y')} AS rank FROM ({EVENT_SQL})"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey")


@query("order_rank", f"SELECT o_orderkey, rank FROM ({ORDER_RANK})")
def order_rank(spark, sf):
    return seeded_rank(_orders(spark, sf), "o_orderkey")


@query("order_rank_by_class", f"SELECT event_id, y, rank FROM ({EVENT_RANK})")
def order_rank_by_class(spark, sf):
    return seeded_rank(purchases(spark, sf).select("event_id", "y"), "event_id", by="y")


@query("order_rank_by_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rank FROM orders")
def order_rank_by_id(spark, sf):
    return id_rank(_orders(spark, sf), "o_orderkey")


@query("sample_split", f"SELECT o_orderkey FROM ({ORDER_RANK}) WHERE rank <= floor(n * 0.8)")
def split_train(spark, sf):
    return sampling.split(_orders(spark, sf), "o_orderkey", 0.8)[0]


@query("sample_split_test", f"SELECT o_orderkey FROM ({ORDER_RANK}) WHERE rank > floor(n * 0.8)")
def split_test(spark, sf):
    return sampling.split(_orders(spark, sf), "o_orderkey", 0.8)[1]


@query("sample_exact", f"SELECT o_orderkey FROM ({ORDER_RANK}) WHERE rank <= 777")
def sample_exact(spark, sf):
    return sampling.sample(_orders(spark, sf), "o_orderkey", 777)


@query(
    "sample_kfold",
    f"SELECT o_orderkey, floor((rank - 1) / (n // 7))::INT AS fold FROM ({ORDER_RANK}) WHERE rank <= n // 7 * 7",
)
def kfold(spark, sf):
    return sampling.kfold(_orders(spark, sf), "o_orderkey", 7).df


@query(
    "sample_fold_masks",
    f"SELECT fold, part, count(*) AS n, sum(o_orderkey)::BIGINT AS ids FROM ("
    f"SELECT o_orderkey, f AS fold, CASE WHEN (rank - 1) // (n // 3) = f THEN 'test' ELSE 'train' END AS part "
    f"FROM ({ORDER_RANK}), range(3) t(f) WHERE rank <= n // 3 * 3) GROUP BY fold, part",
)
def fold_masks(spark, sf):
    folds = sampling.kfold(_orders(spark, sf), "o_orderkey", 3)
    flagged = folds.df.select(
        "o_orderkey",
        F.posexplode(folds.test_weights()).alias("fold", "held"),
    ).withColumn("part", F.when(F.col("held") == 1, "test").otherwise("train"))
    return flagged.groupBy(F.col("fold").cast("long").alias("fold"), "part").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("ids")
    )


def stratified_ctes(k: int, relation: str, id_col: str, seed: int = 1) -> str:
    """``folded(..., fold)`` and ``copied(id, i, copies)``: training copies per row and fold."""
    return (
        f"ranked AS (SELECT *, {rank_sql(seed, id_col, 'y')} - 1 AS k, count(*) OVER (PARTITION BY y) // {k} "
        f"AS size FROM {relation}), "
        f"folded AS (SELECT *, (k // size)::INT AS fold FROM ranked WHERE k < size * {k}), "
        f"sizes AS (SELECT max(size) FILTER (y = -1) * {k - 1} AS keep, max(size) FILTER (y = 1) * {k - 1} AS have "
        f"FROM folded), "
        f"dup AS (SELECT {id_col}, i, c FROM folded, range({k}) a(i), sizes, "
        f"range(1, (SELECT ceil(keep / have)::INT + 1 FROM sizes)) b(c) WHERE y = 1 AND fold <> i), "
        f"kept AS (SELECT {id_col}, i, row_number() OVER (PARTITION BY i ORDER BY "
        f"{key_sql(seed, 'i', id_col, 'c')}, {id_col}) AS pos FROM dup), "
        f"copied AS (SELECT {id_col}, i, count(*) AS copies FROM kept, sizes WHERE pos <= keep GROUP BY {id_col}, i "
        f"UNION ALL SELECT {id_col}, i, 1 FROM folded, range({k}) a(i) WHERE y = -1 AND fold <> i)"
    )


def even_ctes(k: int, relation: str, id_col: str, seed: int = 1) -> str:
    """As ``stratified_ctes``, with the copies dealt evenly."""
    return (
        f"ranked AS (SELECT *, {rank_sql(seed, id_col, 'y')} - 1 AS k, count(*) OVER (PARTITION BY y) // {k} "
        f"AS size FROM {relation}), "
        f"folded AS (SELECT *, (k // size)::INT AS fold FROM ranked WHERE k < size * {k}), "
        f"sizes AS (SELECT max(size) FILTER (y = -1) AS a, max(size) FILTER (y = 1) AS b FROM folded), "
        f"copied AS (SELECT {id_col}, i, CASE WHEN y = -1 THEN 1 ELSE a // b + (k % size < a % b)::INT END AS copies "
        f"FROM folded, sizes, range({k}) f(i) WHERE fold <> i)"
    )


def _stratified(k: int, ctes=stratified_ctes) -> str:
    return (
        f"WITH src AS ({EVENT_SQL}), {ctes(k, 'src', 'event_id')} "
        "SELECT f.event_id, f.y, f.fold, a.i::INT AS i, coalesce(c.copies, 0)::INT AS copies FROM folded f "
        f"CROSS JOIN range({k}) a(i) LEFT JOIN copied c ON c.event_id = f.event_id AND c.i = a.i"
    )


def _stratified_rows(spark, sf, k: int, even: bool = False):
    df = purchases(spark, sf).select("event_id", "y")
    folds = sampling.stratified_upsampled_folds(df, "event_id", "y", k, even=even)
    return folds.df.select("event_id", "y", "fold", F.posexplode("copies").alias("i", "copies"))


@query("sample_stratified_upsampled", _stratified(3))
def stratified_upsampled(spark, sf):
    return _stratified_rows(spark, sf, 3)


@query("sample_stratified_upsampled_100_folds", _stratified(100, even_ctes))
def stratified_upsampled_100(spark, sf):
    return _stratified_rows(spark, sf, 100, even=True)


@query(
    "sample_stratified_200_strata",
    f"SELECT o_orderkey, stratum, ((rank - 1) // (n // 4))::INT AS fold FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY stratum ORDER BY {key_sql(1, 'o_orderkey')}, o_orderkey) AS rank, "
    "count(*) OVER (PARTITION BY stratum) AS n FROM (SELECT o_orderkey, "
    "CASE WHEN o_custkey % 200 > 0 THEN o_custkey % 200 END AS stratum FROM orders)) "
    "WHERE n >= 4 AND rank <= n // 4 * 4",
)
def stratified_200(spark, sf):
    """Four folds with equally many orders of each of 200 strata; one of them is null."""
    stratum = F.col("o_custkey") % 200
    df = table(spark, sf, "orders").select("o_orderkey", F.when(stratum > 0, stratum).alias("stratum"))
    return sampling.stratified_folds(df, "o_orderkey", "stratum", 4).df


_BATCHES = (
    "SELECT o_orderkey, b::INT AS batch FROM ({rows}), range({steps}) t(b) "
    "WHERE ((rank - 1 - b * {size}) % n + n) % n < {size}"
)


@query("sample_batches", _BATCHES.format(rows=ORDER_RANK, steps=5, size=64))
def batches(spark, sf):
    return sampling.batches(_orders(spark, sf), "o_orderkey", 64, 5)


@query(
    "sample_batches_over_the_end",
    _BATCHES.format(
        rows=f"SELECT o_orderkey, {rank_sql(3, 'o_orderkey')} AS rank, count(*) OVER () AS n FROM orders",
        steps=4,
        size=1000,
    ),
)
def batches_over_the_end(spark, sf):
    return sampling.batches(_orders(spark, sf), "o_orderkey", 1000, 4, seed=3)


@query(
    "sample_batches_unshuffled",
    _BATCHES.format(
        rows="SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rank, count(*) OVER () AS n FROM orders",
        steps=3,
        size=700,
    ),
)
def batches_unshuffled(spark, sf):
    return sampling.batches(_orders(spark, sf), "o_orderkey", 700, 3, shuffle=False)


# Resampling -------------------------------------------------------------------------------------


@query(
    "resample_downsample",
    f"SELECT event_id, y FROM ({EVENT_RANK}) WHERE y = 1 OR rank <= "
    f"(SELECT count(*) FROM events WHERE event_type = 'purchase')",
)
def downsample(spark, sf):
    return sampling.downsample(purchases(spark, sf).select("event_id", "y"), "event_id", "y")


_UPSAMPLE = (
    "WITH k AS ({ranked}), s AS (SELECT floor({ratio} * count_if(y = -1))::BIGINT AS t, count_if(y = 1) AS m FROM k) "
    "SELECT event_id, y, CASE WHEN y = 1 THEN t // m + (rank <= t % m)::INT ELSE 1 END::INT AS copies FROM k, s"
)


@query("resample_upsample", _UPSAMPLE.format(ranked=EVENT_RANK, ratio=1))
def upsample(spark, sf):
    return sampling.upsample_copies(purchases(spark, sf).select("event_id", "y"), "event_id", "y")


@query(
    "resample_upsample_rows",
    "SELECT event_id, y FROM (" + _UPSAMPLE.format(ranked=EVENT_RANK, ratio=0.6)
    + "), range((SELECT count(*) FROM events)) t(c) WHERE c < copies AND copies > 0",
)
def upsample_rows(spark, sf):
    return sampling.upsample(purchases(spark, sf).select("event_id", "y"), "event_id", "y", ratio=0.6)


def bootstrap_sql(sizes: str, minority: str, id_col: str, seed: int = 1) -> str:
    """``(grp, id, copies)`` of draws with replacement; ``sizes`` has (grp, n)."""
    draw = f"(('0x' || substr({key_sql(seed, 'grp', 'j')}, 1, 13))::BIGINT)"
    return (
        f"SELECT grp, m.{id_col}, count(*)::INT AS copies FROM (SELECT grp, {draw} % (SELECT count(*) FROM {minority}) "
        f"+ 1 AS pos FROM (SELECT grp, unnest(range(n)) AS j FROM {sizes})) d JOIN "
        f"(SELECT {id_col}, {rank_sql(seed, id_col)} AS pos FROM {minority}) m USING (pos) GROUP BY grp, m.{id_col}"
    )


@query(
    "resample_bootstrap",
    f"WITH src AS ({EVENT_SQL}), mino AS (SELECT event_id FROM src WHERE y = 1), "
    "sz AS (SELECT floor(x2 * 3)::INT AS grp, count(*) AS n FROM src WHERE y = -1 GROUP BY ALL) "
    f"SELECT grp AS \"group\", event_id, copies FROM ({bootstrap_sql('sz', 'mino', 'event_id')})",
)
def bootstrap(spark, sf):
    df = purchases(spark, sf)
    group = F.floor(F.col("x2") * 3).cast("int")
    sizes = {
        row["g"]: row["count"] for row in df.filter("y = -1").groupBy(group.alias("g")).count().collect()
    }
    return sampling.bootstrap_copies(df.filter("y = 1").select("event_id"), "event_id", sizes)


def lloyd_ctes(points: str, centres: str, steps: int, dims: int, prefix: str) -> tuple[str, str]:
    """Lloyd steps over ``points(id, f)`` from ``centres(j, c)``; returns CTEs and the last name."""
    ctes = [f"{prefix}0 AS ({centres})"]
    for t in range(steps):
        ctes.append(
            f"{prefix}a{t} AS (SELECT p.id, p.f, c.j FROM {points} p CROSS JOIN {prefix}{t} c QUALIFY "
            f"row_number() OVER (PARTITION BY p.id ORDER BY list_distance(p.f, c.c), c.j) = 1)"
        )
        ctes.append(
            f"{prefix}m{t} AS (SELECT j, list(v ORDER BY pos) AS c FROM (SELECT j, pos, avg(v) AS v FROM "
            f"(SELECT j, unnest(f) AS v, unnest(range({dims})) AS pos FROM {prefix}a{t}) GROUP BY j, pos) GROUP BY j)"
        )
        ctes.append(
            f"{prefix}{t + 1} AS (SELECT o.j, coalesce(m.c, o.c) AS c FROM {prefix}{t} o LEFT JOIN {prefix}m{t} m USING (j))"
        )
    return ",\n".join(ctes), f"{prefix}{steps}"


def spread_ctes(points: str, k: str, seed: int = 1) -> str:
    """``spread(j, c)``: ``k`` seeded starting centres from ``points(id, f)``; needs WITH RECURSIVE."""

    def drawn(step: str, weight: str, where: str) -> str:
        race = f"{{'r': {weight}, 'id': id}}"
        return f"arg_min(f, {race}) FILTER ({where}) OVER ()"

    number = lambda step: (
        f"((('0x' || substr(md5(concat_ws(':', concat('{seed}:', {step}), id)), 1, 13))::BIGINT)::DOUBLE + 0.5) "
        "/ 4503599627370496.0::DOUBLE"
    )
    return (
        f"walk AS (SELECT 0 AS j, id, f, list_distance(f, c) AS w, c FROM (SELECT id, f, "
        f"{drawn('0', number('0'), 'TRUE')} AS c FROM {points}) UNION ALL "
        f"SELECT j + 1, id, f, w + list_distance(f, c), c FROM (SELECT j, id, f, w, "
        f"{drawn('j + 1', f'-ln({number("j + 1")}) / w', 'w > 0')} AS c FROM walk WHERE j + 1 < {k})), "
        "spread AS (SELECT j, any_value(c) AS c FROM walk GROUP BY j)"
    )


_centres, _last = lloyd_ctes(
    "pts",
    f"SELECT j, f AS c FROM (SELECT f, {rank_sql(1, 'id')} - 1 AS j FROM pts) "
    "WHERE j < (SELECT count(*) FROM src WHERE y = 1)",
    2,
    2,
    "c",
)


@query(
    "resample_downsample_to_centres",
    f"WITH src AS ({DOC_SQL}), pts AS (SELECT doc_id AS id, [chars, lines]::DOUBLE[] AS f FROM src WHERE y = -1), "
    f"{_centres} SELECT doc_id, {rs('chars', 9)} AS chars, {rs('lines', 9)} AS lines, y FROM src WHERE y = 1 "
    f"UNION ALL SELECT NULL, {rs('c[1]', 9)}, {rs('c[2]', 9)}, -1 FROM {_last}",
)
def to_centres(spark, sf):
    docs = documents(spark, sf)
    n = sampling.class_counts(docs, "y")[sampling.MINORITY]
    ranked = seeded_rank(docs.filter("y = -1").select("doc_id", "chars", "lines"), "doc_id")
    first = ranked.filter(F.col("rank") <= n).orderBy("rank").select("chars", "lines").collect()
    out = downsample_to_centres(
        docs, "doc_id", ["chars", "lines"], "y", max_iter=2, init=np.array(first, dtype=float)
    )
    return out.select("doc_id", r(F.col("chars"), 9).alias("chars"), r(F.col("lines"), 9).alias("lines"), "y")


def _seeded_centres(on: str) -> str:
    rows = "WHERE y = -1" if on == "majority" else ""
    lloyd, last = lloyd_ctes("pts", "SELECT * FROM spread", 2, 2, "c")
    return (
        f"WITH RECURSIVE src AS ({DOC_SQL}), pts AS (SELECT doc_id AS id, [chars, lines]::DOUBLE[] AS f FROM src {rows}), "
        f"{spread_ctes('pts', '(SELECT count(*) FROM src WHERE y = 1)')}, {lloyd} "
        f"SELECT doc_id, {rs('chars', 9)} AS chars, {rs('lines', 9)} AS lines, y FROM src WHERE y = 1 "
        f"UNION ALL SELECT NULL, {rs('c[1]', 9)}, {rs('c[2]', 9)}, -1 FROM {last}"
    )


def _to_seeded_centres(spark, sf, on: str):
    out = downsample_to_centres(documents(spark, sf), "doc_id", ["chars", "lines"], "y", on, max_iter=2)
    return out.select("doc_id", r(F.col("chars"), 9).alias("chars"), r(F.col("lines"), 9).alias("lines"), "y")


@query("resample_downsample_to_seeded_centres", _seeded_centres("majority"))
def to_seeded_centres(spark, sf):
    """As many k-means centres of the majority as there are minority rows, from seeded starting centres."""
    return _to_seeded_centres(spark, sf, "majority")


@query("resample_downsample_to_seeded_centres_of_all", _seeded_centres("all"))
def to_seeded_centres_of_all(spark, sf):
    return _to_seeded_centres(spark, sf, "all")
