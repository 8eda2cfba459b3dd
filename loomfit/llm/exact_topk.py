"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of integer weights by component. Candidates are indexed block by block: a posting
list per component holds the rows of the block with a weight there, and the weights. A query goes through its
own components one by one and adds weight times posting to a dense array of scores of the block. A partition
keeps the best of its blocks per query, and the partitions' lists are merged by Spark.

Queries are sent to the tasks in passes of a checked size; each pass reads all candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, query, read

K = 10
EVERY = 100  # a row whose id is divisible by this is a query
SCALE = 1024
BLOCK_ROWS = 4096  # candidates that are indexed and scored together
PASS_BYTES = 8 * 1024 * 1024  # of the queries sent to all tasks at once
TASK_PRODUCTS = 1 << 30  # products of query and candidate components that a task computes, about
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a double. Products beyond a long end at its bounds."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite; an empty one is."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All components, and where each vector begins."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Postings:
    """A block of vectors, indexed by component."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray):
        self.rows = len(offsets) - 1
        sizes = np.diff(offsets)
        component = np.arange(len(values)) - np.repeat(offsets[:-1], sizes)
        filled = np.flatnonzero(values)
        order = filled[np.argsort(component[filled], kind="stable")]
        self.row = np.repeat(np.arange(self.rows), sizes)[order]
        self.weight = values[order]
        self.begin = np.searchsorted(component[order], np.arange(int(sizes.max(initial=0)) + 1))

    def scores(self, terms: np.ndarray, weights: np.ndarray, out: np.ndarray) -> None:
        """Add up the scores of one query, component by component, into an array of zeros."""
        for term, weight in zip(terms, weights):
            if term + 1 >= len(self.begin):
                return
            at = slice(self.begin[term], self.begin[term + 1])
            out[self.row[at]] += weight * self.weight[at]


def _best(scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, highest first; ties to the smaller id, null ids last."""
    places = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        wanted = k - len(above)
        if len(equal) > wanted:
            equal = equal[np.lexsort((ids[equal], no_id[equal]))[:wanted]]
        places = np.concatenate([above, equal])
    return places[np.lexsort((ids[places], no_id[places], ~scores[places]))]


def _largest(values: np.ndarray) -> int:
    return max((abs(int(values.max())), abs(int(values.min())))) if len(values) else 0


def _partition_best(batches: Iterator[pa.RecordBatch], queries: list[np.ndarray], k: int) -> Iterator[pa.RecordBatch]:
    """The k best of a partition for each query: query, vec_id, score."""
    terms = [np.flatnonzero(q) for q in queries]
    weights = [q[t] for q, t in zip(queries, terms)]
    heaviest = max((_largest(q) for q in queries), default=0)
    width = max(map(len, queries), default=0)
    empty = np.zeros(0, np.int64)
    best = [(empty, empty, np.zeros(0, bool))] * len(queries)
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            block = batch.slice(begin, BLOCK_ROWS)
            ids = block.column("vec_id")
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            values, offsets = _flat(block.column("vector"))
            postings = Postings(values, offsets)
            # Where sums might leave 64 bits, Python's numbers are added, and the sums end at the bounds.
            wide = heaviest * _largest(values) * width > _HIGH
            if wide:
                postings.weight = postings.weight.astype(object)
            for i, (t, w) in enumerate(zip(terms, weights)):
                scores = np.zeros(postings.rows, object if wide else np.int64)
                postings.scores(t, w.astype(object) if wide else w, scores)
                if wide:
                    scores = np.array([min(max(int(s), _LOW), _HIGH) for s in scores], np.int64)
                if len(best[i][0]) == k:
                    near = np.flatnonzero(scores >= best[i][0][-1])
                    if not len(near):
                        continue
                else:
                    near = slice(None)
                merged = [np.concatenate(pair) for pair in zip(best[i], (scores[near], ids[near], no_id[near]))]
                places = _best(*merged, k)
                best[i] = tuple(m[places] for m in merged)
    n = [len(b[0]) for b in best]
    if sum(n):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(n)), n).astype(np.int32)),
                pa.array(np.concatenate([b[1] for b in best]), pa.int64(), mask=np.concatenate([b[2] for b in best])),
                pa.array(np.concatenate([b[0] for b in best])),
            ],
            ["query", "vec_id", "score"],
        )


def _passes(queries: DataFrame, pass_bytes: int) -> tuple[DataFrame, int]:
    """The queries with a pass number, so that no pass is larger than allowed unless it is one vector."""
    size = F.size("vector").cast("long") * 8 + 64
    total = queries.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-2 * total // pass_bytes)) if total > pass_bytes else 1
    while True:
        dealt = queries.withColumn("pass", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)))
        most = dealt.groupBy("pass").agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).filter("n > 1").agg(F.max("bytes")).first()[0]
        if (most or 0) <= pass_bytes:
            return dealt, n
        n *= 2


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, pass_bytes: int = PASS_BYTES
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows with the highest inner products for each query row.

    ``vectors`` has vec_id and embedding, ``is_query`` says of a row whether it is a query. Candidates are
    all rows but the query's own; all of them are given if there are fewer than k. Scores are inner products of
    floor(scale * x); a missing component counts as 0. Scores and components end at the bounds of 64 bits.

    Vectors that are null or hold a null, NaN or infinity take no part; an empty vector does, with scores of 0.
    Ties go to the smaller vec_id, null ids last. Repeated rows are candidates each, and a query that
    occurs n times, equal in id and vector, has its result n times, with its other copies as candidates. An empty
    table gives no rows. Other columns are ignored, whatever their names.

    Equal query rows are searched once. Queries reach the tasks in passes of ``pass_bytes`` at most, and
    what a pass leaves is a list of k + 1 rows for each query and partition of candidates.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(usable(F.col("embedding")), quantised(F.col("embedding"), scale)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).filter("vector is not null")
    queries = keep(rows.filter("is_query").groupBy("vec_id", "vector").agg(F.count("*").alias("copies")))
    queries, n_passes = _passes(queries, pass_bytes)
    sizes = rows.agg(F.count("*").alias("rows"), F.coalesce(F.avg(F.size("vector")), F.lit(0)).alias("width")).first()
    found = []
    for number in range(n_passes):
        asked = queries.filter(F.col("pass") == number).select("vec_id", "copies", "vector").toArrow().combine_chunks()
        if not asked.num_rows:
            continue
        lists = asked.column("vector").chunk(0)
        values, offsets = _flat(lists)
        dense = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        sent = spark.sparkContext.broadcast(dense)
        products = sizes["rows"] * len(dense) * max(1, int(sizes["width"]))
        tasks = max(1, min(-(-products // TASK_PRODUCTS), -(-sizes["rows"] // BLOCK_ROWS)))
        candidates = rows.select("vec_id", "vector")
        candidates = candidates.repartition(int(tasks)) if tasks > 1 else candidates
        own = [sum(int(v) * int(v) for v in q) for q in dense]
        who = spark.createDataFrame(
            pa.table(
                {
                    "query": pa.array(range(len(dense)), pa.int32()),
                    "query_id": asked.column("vec_id"),
                    "copies": asked.column("copies"),
                    "own_score": pa.array([min(v, _HIGH) for v in own], pa.int64()),
                }
            )
        )
        parts = candidates.mapInArrow(
            lambda batches, sent=sent: _partition_best(batches, sent.value, k + 1), "query int, vec_id long, score long"
        )
        found.append(keep(_merged(parts, who, k)))
        sent.unpersist()
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _merged(parts: DataFrame, who: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, without its own row, once for each copy of the query.

    Rows with equal ids and scores can't be told apart, so the first of those that could be the query's own goes.
    """
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    per_query = Window.partitionBy("query")
    placed = (
        parts.withColumn("place", F.row_number().over(per_query.orderBy(*order)))
        .filter(F.col("place") <= k + 1)
        .join(F.broadcast(who), "query")
        .withColumn("own", (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own_score")))
        .withColumn("own_place", F.min(F.when(F.col("own"), F.col("place"))).over(per_query))
    )
    after = F.coalesce(F.col("place") > F.col("own_place"), F.lit(False))
    return (
        placed.filter("own_place is null or place <> own_place")
        .withColumn("rank", F.col("place") - after.cast("int"))
        .filter(F.col("rank") <= k)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select("query_id", "rank", "vec_id", "score")
    )


SQL = f"""
WITH vectors AS (
  SELECT vec_id, row_number() OVER () AS r,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.r, v.vec_id, CAST(list_inner_product(q.vector, v.vector) AS BIGINT) AS score
  FROM vectors q JOIN vectors v ON q.r <> v.r
  WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
WHERE rank <= {K}"""


@query("op12_exact_topk", SQL)
def op12_exact_topk(spark, sf):
    return top_k(read(spark, sf, "embeddings"), F.col("vec_id") % EVERY == 0)
