"""Token counts from flat token files that have no index.

A token file is nothing but 16-bit ids, one document after another, each followed by the
end-of-document id. To count tokens per document, files are cut into blocks, each block is searched
for the end id with array operations, and a prefix scan over the block summaries carries the start
of a document that began in an earlier block.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_folder
from .common import keep, query, read, small_batches, text_bytes

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# How the vocabulary's makers cut a text before merging bytes. Fixed value.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 0  # the end-of-document id; ids of a vocabulary are stored plus one
WIDTH = 2  # bytes of a token
BLOCK_BYTES = 1024 * 1024
RUN_BLOCKS = 4096  # blocks that the first level of the prefix scan puts together


def _encoder(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, text_col: str = "text") -> DataFrame:
    """One row ``payload`` per document, in order: its ids plus one as little-endian 16-bit numbers.

    ``tokenizer`` is a path that all executors have. A null or empty text has no tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in small_batches(batches, "text"):
            payloads = [
                (np.array(encoder.encode_ordinary(str(text, "utf-8", "replace")), dtype=np.uint16) + 1).astype("<u2").tobytes()
                for text in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(payloads, pa.binary())], ["payload"])

    return docs.select(text_bytes(F.col(text_col)).alias("text")).mapInArrow(run, "payload binary")


def write_token_files(payloads: DataFrame, path: str) -> None:
    """Write one flat file per partition: the payloads, each followed by the end id.

    Spark's text writer puts out the bytes as they are and the end id as its line separator.
    """
    payloads.select(F.col("payload").cast("string").alias("value")).write.option(
        "lineSep", "\0" * WIDTH
    ).text(path)


def read_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The blocks of all files under a path: file, block number, bytes.

    A file is one row of Spark's binary reader before it is cut, so files must be below 2 GB.
    """
    if block_bytes % WIDTH:
        raise ValueError("blocks must hold whole tokens")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    n_blocks = F.ceil(F.col("length") / block_bytes).cast("int")
    blocks = F.transform(
        F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>")),
        lambda b: F.struct(
            b.cast("long").alias("block"),
            F.substring(F.col("content"), b * block_bytes + 1, F.lit(block_bytes)).alias("bytes"),
        ),
    )
    return files.select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.explode(blocks).alias("b")).select(
        "file", "b.block", "b.bytes"
    )


def summarise(blocks: DataFrame, end: int = END) -> DataFrame:
    """Search each block: its tokens, the lengths of the documents that end in it, and the tokens after the last end.

    The first length counts only what lies in this block. A block that ends inside a token raises.
    """
    schema = "file string, block long, n_tokens long, lengths array<int>, tail long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_tokens, lengths, tails = [], [], []
            for data in batch.column("bytes"):
                raw = data.as_buffer()
                if len(raw) % WIDTH:
                    raise ValueError("a token file ends inside a token")
                ids = np.frombuffer(raw, dtype="<u2")
                at = np.flatnonzero(ids == end)
                n_tokens.append(len(ids))
                lengths.append(np.diff(at, prepend=-1).astype(np.int32) - 1)
                tails.append(len(ids) - (int(at[-1]) + 1 if len(at) else 0))
            offsets = np.cumsum([0, *map(len, lengths)]).astype(np.int32)
            flat = np.concatenate(lengths) if lengths else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"),
                    batch.column("block"),
                    pa.array(n_tokens, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(tails, pa.int64()),
                ],
                ["file", "block", "n_tokens", "lengths", "tail"],
            )

    return blocks.select("file", "block", "bytes").mapInArrow(run, schema)


def scan_documents(summaries: DataFrame, run_blocks: int = RUN_BLOCKS) -> DataFrame:
    """Stitch block summaries into documents: file, doc_no, start, n_tokens, ended.

    The scan has two levels: runs of ``run_blocks`` blocks, then the blocks inside a run, so a file of
    any number of blocks never meets in one task. ``start`` is the token offset in the file. What
    follows the last end id is a document with ``ended`` false, if it has any token; empty documents
    have 0 tokens, and an empty file has none. ``summaries`` is read twice, so pass a written table.
    """
    s = summaries.withColumn("run", F.floor(F.col("block") / run_blocks))
    is_last = F.max("block").over(Window.partitionBy("file", "run")) == F.col("block")

    def before(*by: str, order: str):
        return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def scanned(df: DataFrame, window, name: str) -> DataFrame:
        """Tokens and ends before a row, and tokens from the last end to the row, within the window."""
        tokens = F.coalesce(F.sum("n_tokens").over(window), F.lit(0))
        after_end = F.max(F.when(F.col("n_ends") > 0, F.col("position") - F.col("tail"))).over(window)
        return df.withColumn("position", F.coalesce(F.sum("n_tokens").over(window), F.lit(0)) + F.col("n_tokens")).select(
            *df.columns,
            tokens.alias(f"{name}_tokens"),
            F.coalesce(F.sum("n_ends").over(window), F.lit(0)).alias(f"{name}_ends"),
            after_end.alias(f"{name}_after"),
        )

    inside = scanned(
        s.withColumn("n_ends", F.size("lengths").cast("long")).withColumn("last_in_run", is_last),
        before("file", "run", order="block"),
        "in",
    )
    runs = s.groupBy("file", "run").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.size("lengths").cast("long")).alias("n_ends"),
        F.max(F.when(F.size("lengths") > 0, F.struct("block", "tail"))).alias("end_block"),
        F.collect_list(F.struct("block", "n_tokens")).alias("sizes"),
    )
    runs = runs.select(
        "file",
        "run",
        "n_tokens",
        "n_ends",
        (
            F.col("end_block.tail")
            + F.aggregate(
                F.filter("sizes", lambda b: b.block > F.col("end_block.block")),
                F.lit(0).cast("long"),
                lambda total, b: total + b.n_tokens,
            )
        ).alias("tail"),
    )
    outer = scanned(runs, before("file", order="run"), "out").select(
        "file", "run", "out_tokens", "out_ends", "out_after", (F.lead("run").over(Window.partitionBy("file").orderBy("run")).isNull()).alias("last_run")
    )
    position = F.col("out_tokens") + F.col("in_tokens")
    open_from = F.coalesce(F.col("out_tokens") + F.col("in_after"), F.col("out_after"), F.lit(0))
    joined = inside.join(outer, ["file", "run"]).select(
        "file",
        "tail",
        "n_ends",
        (F.col("out_ends") + F.col("in_ends")).alias("first_no"),
        (position - open_from).alias("carried"),
        (position + F.col("n_tokens")).alias("position"),
        "lengths",
        (F.col("last_in_run") & F.col("last_run")).alias("last"),
        open_from.alias("open_from"),
    )
    # Starts run backwards from the end of the block: each document takes its tokens and one end id.
    ended = joined.select(
        "file", "first_no", "carried", "open_from", (F.col("position") - F.col("tail")).alias("stop"), F.posexplode("lengths").alias("i", "length")
    )
    lengths = F.col("length") + F.when(F.col("i") == 0, F.col("carried")).otherwise(F.lit(0))
    ended = ended.select("file", (F.col("first_no") + F.col("i")).alias("doc_no"), lengths.alias("n_tokens"), F.lit(True).alias("ended"))
    left = F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("tail"))
    rest = joined.filter("last").select(
        "file", (F.col("first_no") + F.col("n_ends")).alias("doc_no"), left.alias("n_tokens"), F.lit(False).alias("ended")
    )
    return ended.unionByName(rest.filter("n_tokens > 0"))


def count_tokens(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Tokens of each document in the flat token files under a path: file, doc_no, n_tokens, ended."""
    return scan_documents(keep(summarise(read_blocks(spark, path, block_bytes))))


@query("op2_token_counts")
def op2_token_counts(spark, sf):
    """Tokens of each document, counted from token files that Spark writes of ``documents``.

    A file holds the documents of one input split in their order, so a document is found again by the
    split's number and its place in it.
    """
    docs = read(spark, sf, "documents")
    path = work_folder(spark)
    write_token_files(encode(docs), path)
    places = docs.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("doc_no"),
        "doc_id",
    )
    counted = count_tokens(spark, path).withColumn("part", F.regexp_extract("file", r"^part-(\d+)", 1).cast("int"))
    return counted.join(places, ["part", "doc_no"]).select("doc_id", "part", "doc_no", "n_tokens", "ended")
