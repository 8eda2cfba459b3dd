"""The table models train on: one feature vector, label and weight vector per row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import quoted
from .. import session
from ..session import BATCH_ROWS_BYTES, SPREAD_ROWS, work_folder
from . import sums
from .sampling import Folds, batches


@dataclass(frozen=True)
class Gram:
    """Cross-product sums: all that a quadratic loss needs to know about the data."""

    n: float
    xtx: np.ndarray
    xty: np.ndarray
    yty: float

    @staticmethod
    def of(flat: np.ndarray, dim: int) -> "Gram":
        z = flat.reshape(dim + 2, dim + 2)
        return Gram(z[-1, -1], z[:dim, :dim], z[:dim, dim], z[dim, dim])

    def gradient(self, w: np.ndarray) -> np.ndarray:
        """Half the slope of the sum of squared residuals."""
        return self.xtx @ w - self.xty

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(
            self.n - other.n, self.xtx - other.xtx, self.xty - other.xty, self.yty - other.yty
        )

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(
            self.n + other.n, self.xtx + other.xtx, self.xty + other.xty, self.yty + other.yty
        )

    def squared_error(self, w: np.ndarray) -> float:
        """Sum of squared residuals of weights ``w``."""
        return float(w @ self.xtx @ w - 2 * w @ self.xty + self.yty)


def vector_size(df: DataFrame, vector: str) -> int:
    """Length of a vector column, from its first row; passes check every row against it."""
    row = df.select(F.size(quoted(vector)).alias("n")).first()
    if row is None:
        raise ValueError("the table is empty")
    return row["n"]


def _cells(pairs, blocks, width: int):
    """Turns slots of summed pairs of blocks into numbered cells."""
    shapes = [(blocks[i][1] - blocks[i][0], blocks[j][1] - blocks[j][0]) for i, j in pairs]
    ends = np.cumsum([a * b for a, b in shapes])
    origins = np.array([(blocks[i][0], blocks[j][0]) for i, j in pairs])
    wide = np.array([b for _, b in shapes])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slot, part in zip(batch.column("slot").to_pylist(), batch.column("part")):
                total = part.values.to_numpy()
                at = slot * width + np.arange(len(total))
                weighting, at = np.divmod(at, int(ends[-1]))
                pair = np.searchsorted(ends, at, side="right")
                row, column = np.divmod(at - np.append(0, ends)[pair], wide[pair])
                a, b = origins[pair, 0] + row, origins[pair, 1] + column
                upper = a <= b
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v[upper], pa.int32()) for v in (weighting, a, b)] + [pa.array(total[upper])],
                    ["weighting", "a", "b", "total"],
                )

    return cells


@dataclass
class LocalBatch:
    """One mini-batch small enough to be summed where the descent loop runs."""

    batch: pa.RecordBatch
    dim: int
    n_weights: int = 0

    def sum(self, kernel, size: int) -> np.ndarray:
        return kernel(self.batch)

    def grams(self) -> list[Gram]:
        return [Gram.of(self.sum(*sums.gram_kernel(self.dim)), self.dim)]

    def gradients(self, kind: str, w: np.ndarray, columns, at: np.ndarray | None = None):
        flat = self.sum(*sums.gradient_kernel(kind, w, None, 0, at))
        return flat[: w.size].reshape(w.shape), *flat[w.size :].reshape(2, -1)


@dataclass
class TrainingTable:
    """A DataFrame of ``f array<double>, y double`` and, optionally, weight vectors.

    ``wt`` and ``wv`` hold one training and one test weight per weighting (fold, hold-out, bootstrap);
    ``fold`` is the test fold where training is simply "all other folds". ``id`` is kept only for
    mini-batches.
    """

    df: DataFrame
    dim: int
    n_weights: int = 0
    n_folds: int = 0
    has_id: bool = False
    repeated: bool = False
    tasks: int | None = None
    _grams: list[Gram] | None = field(default=None, repr=False)
    _kept: bool = field(default=False, repr=False)

    @classmethod
    def build(
        cls,
        df: DataFrame,
        features: Sequence[str] | str,
        label: str,
        *,
        dim: int | None = None,
        intercept: bool = False,
        id_col: str | None = None,
        weight: str | None = None,
        train: Column | None = None,
        folds: Folds | None = None,
        weights: tuple[Column, Column, int] | None = None,
    ) -> "TrainingTable":
        """``features`` are column names, or the name of one vector column (and its ``dim``, if known).

        At most one weighting: ``weight`` counts rows, ``train`` flags the training rows, ``folds``
        gives one weighting per fold, ``weights`` gives train and test vectors directly.
        """
        if isinstance(features, str):
            vector = quoted(features).cast("array<double>")
            dim = dim or vector_size(df, features)
        else:
            dim = len(features)
            vector = F.array(*[quoted(c).cast("double") for c in features])
        if intercept:
            vector, dim = F.concat(F.array(F.lit(1.0)), vector), dim + 1
        columns = [vector.alias("f"), quoted(label).cast("double").alias("y")]
        n_weights = n_folds = 0
        repeated = False
        if weight is not None:
            w = F.array(quoted(weight).cast("double"))
            columns += [w.alias("wt"), w.alias("wv")]
            n_weights, repeated = 1, True
        elif train is not None:
            columns += [
                F.array(train.cast("double")).alias("wt"),
                F.array((~train).cast("double")).alias("wv"),
            ]
            n_weights = 1
        elif folds is not None:
            columns += [folds.train_weights().alias("wt"), folds.test_weights().alias("wv")]
            n_weights, repeated = folds.k, folds.copies is not None
            if folds.copies is None:
                columns.append(F.col(folds.fold).cast("int").alias("fold"))
                n_folds = folds.k
        elif weights is not None:
            columns += [weights[0].alias("wt"), weights[1].alias("wv")]
            n_weights, repeated = weights[2], True
        if id_col is not None:
            columns.append(quoted(id_col).alias("id"))
        return cls(df.select(*columns), dim, n_weights, n_folds, id_col is not None, repeated)

    @contextmanager
    def kept(self, passes: int) -> Iterator["TrainingTable"]:
        """Keep the vectors near the executors for repeated passes; lost blocks are recomputed.

        Where one piece holds more than twice a core's fair share of the rows, so that every pass
        would wait for it, the table is spread out first if the passes to come are worth that.
        """
        if self._kept:
            yield self
            return
        source, stored = self.df, self.df.persist(StorageLevel.MEMORY_AND_DISK)
        self.df, self._kept = stored, True
        try:
            pieces = stored.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
            row = pieces.agg(F.max("p").alias("last"), F.sum("n").alias("n"), F.max("n").alias("most")).first()
            self.tasks = 1 if row["last"] is None else row["last"] + 1
            cores = stored.sparkSession.sparkContext.defaultParallelism
            most, rows = row["most"] or 0, row["n"] or 0
            if most > 2 * rows / cores and most * passes >= SPREAD_ROWS:
                self.df = stored.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
                self.df.count()
                stored.unpersist()
                stored, self.tasks = self.df, cores
            yield self
        finally:
            self.df, self._kept = source, False
            stored.unpersist()

    def sum(self, kernel, size: int) -> np.ndarray:
        return sums.sum_rows(self.passed(), kernel, size, self.tasks)

    def passed(self) -> DataFrame:
        """What a pass reads."""
        return self.df.select(*[c for c in self.df.columns if c != "id"])

    @property
    def n_sums(self) -> int:
        """How many Gram sums a pass adds up: one per fold or weighting."""
        return max(self.n_folds or self.n_weights, 1)

    def gram_fits(self) -> bool:
        """Whether the driver can hold the cross products of all weightings."""
        return self.n_sums * (self.dim + 2) ** 2 * 8 <= session.TASK_STATE_BYTES

    def _block_sums(self, pairs, blocks):
        return sums.gram_kernel(self.dim, self.n_folds or 1, 0 if self.n_folds else self.n_weights, blocks, pairs)

    def block_passes(self) -> tuple[list[tuple[int, int]], list[list[tuple[int, int]]]]:
        """The blocks of the columns ``[f, y, 1]`` and the pairs of blocks that each pass adds up.

        Cross products are symmetric, so only pairs (i, j) with i <= j are summed, and a task never holds
        more of them than a quarter of its budget.
        """
        blocks = sums.column_blocks(self.dim + 2, session.BLOCK_COLUMNS)
        return blocks, list(sums.block_passes(blocks, self.n_sums, session.TASK_STATE_BYTES // 4))

    def gram_blocks(self) -> Iterator[tuple[int, slice, slice, np.ndarray]]:
        """(fold or weighting, rows, columns, sums) of each pair of blocks, one pass after another."""
        blocks, passes = self.block_passes()
        with self.kept(len(passes)) if len(passes) > 1 else nullcontext():
            for pairs in passes:
                flat, at = self.sum(*self._block_sums(pairs, blocks)), 0
                for k in range(self.n_sums):
                    for i, j in pairs:
                        rows, columns = slice(*blocks[i]), slice(*blocks[j])
                        shape = rows.stop - rows.start, columns.stop - columns.start
                        yield k, rows, columns, flat[at : at + shape[0] * shape[1]].reshape(shape)
                        at += shape[0] * shape[1]

    def gram_table(self) -> DataFrame:
        """The cross products as a table, for any number of features: weighting, a, b, total with a <= b.

        Columns are numbered; the label is number D and the count of rows D + 1. The sums stay on the cluster.
        """
        blocks, passes = self.block_passes()
        pieces, spark = [], self.df.sparkSession
        with self.kept(len(passes)) if len(passes) > 1 else nullcontext():
            for pairs in passes:
                kernel, size = self._block_sums(pairs, blocks)
                path, width = work_folder(spark), sums.SLOT_WIDTH
                summed = sums.added_up(sums.partial_sums(self.passed(), kernel, size, width))
                summed.mapInArrow(_cells(pairs, blocks, width), "weighting int, a int, b int, total double").write.parquet(path)
                pieces.append(spark.read.parquet(path))
        return reduce(DataFrame.unionAll, pieces)

    def grams(self) -> list[Gram]:
        """One Gram per weighting (a single one without weights); for as many features as the driver can hold."""
        if self._grams is None:
            side = self.dim + 2
            dense = np.empty((self.n_sums, side, side))
            for k, rows, columns, block in self.gram_blocks():
                dense[k, rows, columns] = block
                dense[k, columns, rows] = block.T
            parts = [Gram.of(g, self.dim) for g in dense]
            if self.n_folds:
                total = parts[0]
                for part in parts[1:]:
                    total = total + part
                parts = [total - part for part in parts]
            self._grams = parts
        return self._grams

    def gradients(self, kind: str, w: np.ndarray, columns, at: np.ndarray | None = None):
        """X'r, row counts and sums of r squared for many models; as many at a time as a task can hold."""
        picked = np.array(columns) if self.n_weights else None
        group = max(1, session.TASK_STATE_BYTES // (32 * max(self.dim, 1)))
        slopes, counts, squares = np.empty_like(w), np.empty(w.shape[1]), np.empty(w.shape[1])
        for begin in range(0, w.shape[1], group):
            ms = slice(begin, begin + group)
            part = w[:, ms]
            flat = self.sum(
                *sums.gradient_kernel(
                    kind, part, None if picked is None else picked[ms], self.n_weights, None if at is None else at[:, ms]
                )
            )
            slopes[:, ms] = flat[: part.size].reshape(part.shape)
            counts[ms], squares[ms] = flat[part.size :].reshape(2, -1)
        return slopes, counts, squares

    def mini_batches(self, column: int, batch_size: int, steps: int, seed: int):
        """A function from step number to the mini-batch of that step.

        All batches together are fetched if their size is small; otherwise they are written to the
        shared folder, one partition per step, and each step reads its own.
        """
        if not self.has_id:
            raise ValueError("mini-batches need an id column for their order")
        df = self.df.select("f", "y", "id", *(["wt"] if self.n_weights else []))
        if self.n_weights:
            df = df.filter(F.col("wt")[column] > 0)
            if self.repeated:
                copies = F.sequence(F.lit(1), F.col("wt")[column].cast("int"))
                df = df.withColumn("__copy", F.explode(copies)).withColumn(
                    "id", F.concat_ws(":", "id", "__copy")
                )
        picked = batches(df.select("f", "y", "id"), "id", batch_size, steps, True, seed)
        if batch_size * steps * (self.dim + 2) * 8 <= BATCH_ROWS_BYTES:
            rows = picked.select("batch", "f", "y").toArrow().sort_by("batch").combine_chunks()
            at = rows["batch"].to_numpy()
            bounds = np.searchsorted(at, np.arange(steps + 1))
            record = pa.RecordBatch.from_arrays(
                [rows["f"].combine_chunks(), rows["y"].combine_chunks()], names=["f", "y"]
            )
            return lambda t: LocalBatch(record.slice(bounds[t], bounds[t + 1] - bounds[t]), self.dim)
        path = work_folder(df.sparkSession)
        picked.select("batch", "f", "y").repartition("batch").write.partitionBy("batch").parquet(path)
        spark = df.sparkSession
        return lambda t: TrainingTable(spark.read.parquet(f"{path}/batch={t}"), self.dim)
