"""What the operators of this package share: the registry, the readers, and word and hash helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPACE = r"[\x20\x09-\x0D]"  # what separates words; bytes.split() splits at the same six bytes
WORD = r"[^\x20\x09-\x0D]"
BATCH_BYTES = 2 * 1024 * 1024  # text a task handles at once


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that computes the same rows where SQL can."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: an exact copy that lost executors don't touch."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete what ``keep`` wrote for these tables, once all that reads them is written itself."""
    for table in tables:
        folders = {file.rsplit("/", 1)[0] for file in table.inputFiles()}
        context = table.sparkSession.sparkContext
        for folder in folders:
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def id_hash(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo a number; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(-1))


def text_bytes(text: Column) -> Column:
    """The UTF-8 bytes of a text; none for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the values of a binary column take about ``most`` bytes together, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        begin, total = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = 1 << 16


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hash_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte, the same with A-Z as a-z, and the powers of an odd number."""
    exact = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    exact[_IS_SPACE] = 0
    folded = exact.copy()
    folded[65:91] = folded[97:123]
    powers = np.full(_POWERS, 0x2545F4914F6CDD1D, np.uint64)
    powers[0] = 1
    return exact, folded, np.cumprod(powers)


EXACT, FOLDED, _POWER = _hash_tables()


class Spans:
    """The words of a batch of texts, as places in their bytes.

    ``data`` has the bytes, ``starts`` and ``ends`` the words, ``offsets`` the first word of each text.
    """

    def __init__(self, texts: pa.Array):
        bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        self.data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        n = len(self.data)
        blank = np.ones(n + 2, bool)
        blank[1:-1] = _IS_SPACE[self.data]
        cut = np.zeros(n + 1, bool)  # before which byte a text begins
        cut[bounds] = True
        self.starts = np.flatnonzero(~blank[1:-1] & (blank[:-2] | cut[:-1]))
        self.ends = np.flatnonzero(~blank[1:-1] & (blank[2:] | cut[1:])) + 1
        self.offsets = np.searchsorted(self.starts, bounds)
        self.bounds = bounds

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self, table: np.ndarray = EXACT, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of the given spans of bytes; of an empty one, a constant.

        A polynomial of the bytes' random numbers, taken some words at a time so that memory stays small.
        """
        starts = self.starts if starts is None else starts
        ends = self.ends if ends is None else ends
        out = np.zeros(len(starts), np.uint64)
        filled = np.flatnonzero(ends > starts)
        sizes = ends[filled] - starts[filled]
        total = np.cumsum(sizes)
        begin = 0
        while begin < len(filled):
            done = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, done + 500_000, side="right")))
            size, at = sizes[begin:end], starts[filled[begin:end]]
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(first, size)
            values = table[self.data[place + np.repeat(at, size)]] * _POWER[place & (_POWERS - 1)]
            out[filled[begin:end]] = np.add.reduceat(values, first)
            begin = end
        return _mixed(out)


def in_ranges(df: DataFrame, *by: str) -> DataFrame:
    """The rows with a column ``part``, written in ranges of the given order.

    Every row of a part comes before every row of the next part. Spark samples the range bounds, so a
    value of the first column with a large share of the rows spans many parts, and what a later
    column orders can be scanned part by part.
    """
    return keep(df.repartitionByRange(*[F.col(c) for c in by]).withColumn("part", F.spark_partition_id()))


class Cells:
    """A filter of fixed size: which of 2**bits cells, by the first bits of a 64-bit number, hold something.

    It lets pass every number it was built from, and others by chance, so what passes is then joined
    exactly. It takes 2**bits / 8 bytes, whatever the number of rows.
    """

    def __init__(self, numbers: DataFrame, bits: int):
        """From the only column of ``numbers``; the cluster builds the filter in pieces."""
        self.bits = bits
        cell = F.shiftrightunsigned(F.col(numbers.columns[0]), 64 - bits) + 1
        pieces = (
            numbers.select(cell.alias("cell"))
            .groupBy(F.bitmap_bucket_number("cell").alias("piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap"))
        )
        self.packed = np.zeros((1 << bits) // 8, np.uint8)
        for row in pieces.collect():  # the filter's size at most, in one job
            piece = np.frombuffer(row["bitmap"], np.uint8)
            begin = (row["piece"] - 1) * len(piece)
            self.packed[begin : begin + len(piece)] = piece[: len(self.packed) - begin]

    def holds(self, numbers: np.ndarray) -> np.ndarray:
        """Whether each number, as a signed or unsigned 64-bit integer, passes."""
        cell = numbers.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.packed[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
