"""Packing by optimal length buckets.

Pieces of a bucket are padded to the bucket's length. Dynamic programming over the histogram of all
lengths finds the bucket lengths with the least padding; then each bucket is cut into batches of as
many pieces as the token budget holds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, in_ranges, keep, query, read

BUCKETS = 8
MAX_TOKENS = 2048  # longest piece; longer documents are cut, nothing is dropped
BATCH_TOKENS = 16_384


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD}+")), F.lit(0)).cast("long")


def pieces(docs: DataFrame, tokens: Column, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, length: documents cut into pieces of ``max_tokens`` and a rest. No tokens make one piece of 0."""
    n = F.greatest(F.ceil(F.col("__n") / max_tokens), F.lit(1)).cast("int")
    rest = F.least(F.lit(max_tokens), F.col("__n") - F.col("piece") * max_tokens)
    return (
        docs.select("doc_id", F.coalesce(tokens, F.lit(0)).cast("long").alias("__n"))
        .select("doc_id", "__n", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
        .select("doc_id", "piece", rest.cast("int").alias("length"))
    )


def optimal_lengths(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """The bucket lengths, ascending, with the least padding in all; the smaller cut wins a tie."""
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(lengths)
    rows = np.concatenate([[0], np.cumsum(counts)])
    cells = np.concatenate([[0], np.cumsum(counts * lengths)])
    # padding[j, i]: that of lengths i .. j in one bucket
    padding = lengths[:, None] * (rows[1:, None] - rows[None, :-1]) - (cells[1:, None] - cells[None, :-1])
    far = np.iinfo(np.int64).max // 4
    padding[np.triu_indices(n, 1)] = far
    best, cuts = padding[:, 0].copy() if n else np.zeros(0, np.int64), []
    for _ in range(1, min(buckets, n)):
        before = np.concatenate([[far], best[:-1]])
        total = np.minimum(before[None, :], far) + padding
        cut = total.argmin(axis=1)
        best = total[np.arange(n), cut]
        cuts.append(cut)
    ends, j = [], n - 1
    for cut in reversed(cuts):
        ends.append(int(lengths[j]))
        j = int(cut[j]) - 1
        if j < 0:
            break
    if n and j >= 0:
        ends.append(int(lengths[j]))
    return sorted(set(ends))


def pack(
    docs: DataFrame,
    tokens: Column,
    buckets: int = BUCKETS,
    max_tokens: int = MAX_TOKENS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """Every piece with its batch: doc_id, piece, length, bucket (the padded length), batch.

    The driver gets the histogram, which has at most ``max_tokens + 1`` rows. Batches of a bucket are
    filled in order of document and piece; only a bucket's last batch can be short. Positions are counted
    inside ranges of that order, so no task needs a whole bucket. Null and empty texts are pieces of
    length 0. Repeated rows are packed each; a null id comes first; an empty table gives no rows.
    """
    rows = keep(pieces(docs, tokens, max_tokens))
    histogram = rows.groupBy("length").agg(F.count("*").alias("n")).toArrow()
    ends = optimal_lengths(histogram.column("length").to_numpy(), histogram.column("n").to_numpy(), buckets)
    if not ends:
        return rows.select("*", F.lit(0).alias("bucket"), F.lit(0).cast("long").alias("batch"))
    ranged = in_ranges(rows.withColumn("bucket", _bucket(F.col("length"), ends)), "bucket", "doc_id", "piece")
    sizes = ranged.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("bucket", "part").orderBy("doc_id", "piece")
    per_batch = F.greatest(F.floor(F.lit(batch_tokens) / F.greatest("bucket", F.lit(1))), F.lit(1))
    return (
        ranged.withColumn("__at", F.row_number().over(inside))
        .join(offsets, ["bucket", "part"])
        .select(
            "doc_id",
            "piece",
            "length",
            "bucket",
            F.floor((F.col("__before") + F.col("__at") - 1) / per_batch).cast("long").alias("batch"),
        )
    )


def _bucket(length: Column, ends: list[int]) -> Column:
    """The smallest bucket length that holds a piece."""
    out = F.lit(ends[-1])
    for end in reversed(ends[:-1]):
        out = F.when(length <= end, end).otherwise(out)
    return out.cast("int")


def _sql() -> str:
    steps = []
    for k in range(2, BUCKETS + 1):
        steps.append(f"""
b{k} AS (
  SELECT j, s.c AS cost, s.i AS i FROM (
    SELECT p.j, min(struct_pack(c := b.cost + p.pad, i := p.i)) AS s
    FROM pad p JOIN b{k - 1} b ON b.j = p.i - 1 GROUP BY p.j))""")
    k = f"least({BUCKETS}, (SELECT max(j) FROM h))"
    costs = " UNION ALL ".join(f"SELECT {k} AS k, j, cost, i FROM b{k}" for k in range(1, BUCKETS + 1))
    return f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
piece AS (
  SELECT doc_id, CAST(p AS INTEGER) AS piece, CAST(least({MAX_TOKENS}, n - p * {MAX_TOKENS}) AS INTEGER) AS length
  FROM (SELECT doc_id, n, unnest(range(greatest(CAST(ceil(n / {MAX_TOKENS}) AS BIGINT), 1))) AS p FROM doc)),
h AS (
  SELECT length, row_number() OVER (ORDER BY length) AS j, sum(c) OVER (ORDER BY length) AS rs,
    sum(c * length) OVER (ORDER BY length) AS cs, c
  FROM (SELECT length, count(*) AS c FROM piece GROUP BY length)),
pad AS (
  SELECT b.j, a.j AS i, CAST(b.length * (b.rs - a.rs + a.c) - (b.cs - a.cs + a.c * a.length) AS BIGINT) AS pad
  FROM h a JOIN h b ON a.j <= b.j),
b1 AS (SELECT j, pad AS cost, i FROM pad WHERE i = 1),{",".join(steps)},
best AS ({costs}),
path AS (
  SELECT {k} AS k, max(j) AS j FROM h
  UNION ALL
  SELECT p.k - 1, b.i - 1 FROM path p JOIN best b ON b.k = p.k AND b.j = p.j WHERE p.k > 1 AND b.i > 1),
ends AS (SELECT CAST(h.length AS INTEGER) AS bucket FROM path JOIN h USING (j)),
placed AS (
  SELECT p.*, (SELECT min(e.bucket) FROM ends e WHERE e.bucket >= p.length) AS bucket FROM piece p)
SELECT doc_id, piece, length, bucket,
  CAST(floor((row_number() OVER (PARTITION BY bucket ORDER BY doc_id, piece) - 1)
    / greatest({BATCH_TOKENS} // greatest(bucket, 1), 1)) AS BIGINT) AS batch
FROM placed"""


@query("op7_packing", _sql())
def op7_packing(spark, sf):
    return pack(read(spark, sf, "documents"), word_count(F.col("text")))
