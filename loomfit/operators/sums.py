"""Sums over all rows of a table of vectors, the one building block of model training.

A pass runs a NumPy kernel over Arrow batches inside the tasks. Every task emits its partial sum,
cut into slots of fixed width, and partial sums are added up a tree: tasks are dealt into groups of about
the square root of their number, groups are added, then the groups' sums. What reaches the driver is the size
of the sum itself (D x D, or D x models), never a function of the row count. The driver is the tree's root
where the partial sums left are known to be small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session

SLOT_WIDTH = 8192
ASSIGN_CELLS = 1 << 21  # distances computed at once


def sum_rows(
    df: DataFrame, kernel: Callable[[pa.RecordBatch], np.ndarray], size: int, tasks: int | None = None
) -> np.ndarray:
    """Element-wise sum of ``kernel(batch)`` over all batches; ``size`` is its length.

    ``tasks`` is the number of tasks the table is read with, where the caller knows it.
    """
    width = SLOT_WIDTH
    parts = partial_sums(df, kernel, size, width)
    out = np.zeros(size)
    if tasks is None or tasks * size * 8 > session.DRIVER_SUM_BYTES:
        parts = added_up(parts)
    table = parts.select("slot", "part").toArrow()
    for slot, part in zip(table["slot"].to_pylist(), table["part"]):
        values = part.values.to_numpy()
        out[slot * width : slot * width + len(values)] += values
    return out


def partial_sums(df: DataFrame, kernel: Callable[[pa.RecordBatch], np.ndarray], size: int, width: int) -> DataFrame:
    """Each task's sum, cut into slots: slot, part."""

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = kernel(batch)
                total = part if total is None else total + part
        if total is not None:
            starts = np.append(np.arange(0, size, width), size).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(starts) - 1), pa.int32()),
                    pa.ListArray.from_arrays(pa.array(starts), pa.array(total)),
                ],
                names=["slot", "part"],
            )

    return df.mapInArrow(partial, "slot int, part array<double>")


def added_up(parts: DataFrame) -> DataFrame:
    """The sums of equal slots over all tasks, in two levels.

    Group g holds the tasks from g**2 to (g + 1)**2 - 1, so with n tasks no group has more than
    2 sqrt(n) + 1 of them, and there are sqrt(n) groups, whatever n is.
    """
    total = Summarizer.sum(array_to_vector("part")).alias("total")
    group = F.floor(F.sqrt(F.spark_partition_id())).cast("int")
    grouped = parts.withColumn("group", group).groupBy("slot", "group").agg(total)
    by_group = grouped.select("slot", vector_to_array("total").alias("part"))
    return by_group.groupBy("slot").agg(total).select("slot", vector_to_array("total").alias("part"))


def vectors(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as an (n, dim) matrix, without copying."""
    values = column.flatten()
    if column.null_count or values.null_count or len(values) != len(column) * dim:
        raise ValueError("a feature vector has a missing value or a wrong length")
    return values.to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(float, copy=False)


def list_array(matrix: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix, dtype=float).ravel()))


def scalars(column: pa.Array) -> np.ndarray:
    if column.null_count:
        raise ValueError("a label or weight is missing")
    return column.to_numpy(zero_copy_only=False).astype(float, copy=False)


# Kernels ---------------------------------------------------------------------------------------


def column_blocks(side: int, width: int) -> list[tuple[int, int]]:
    """``side`` columns cut into blocks of ``width``, as (from, to)."""
    return [(begin, min(begin + width, side)) for begin in range(0, side, width)]


def block_passes(
    blocks: Sequence[tuple[int, int]], sums_per_cell: int, most_bytes: int
) -> Iterator[list[tuple[int, int]]]:
    """The pairs (i, j) of blocks, i <= j, in passes whose sums take at most ``most_bytes``, or one pair."""
    picked, cells = [], 0
    for i, (a, b) in enumerate(blocks):
        for j, (c, d) in enumerate(blocks[i:], i):
            more = (b - a) * (d - c)
            if picked and (cells + more) * sums_per_cell * 8 > most_bytes:
                yield picked
                picked, cells = [], 0
            picked.append((i, j))
            cells += more
    if picked:
        yield picked


def gram_kernel(
    dim: int,
    groups: int = 1,
    weighted: int = 0,
    blocks: Sequence[tuple[int, int]] | None = None,
    pairs: Sequence[tuple[int, int]] = ((0, 0),),
):
    """Cross-product sums of ``[f, y, 1]`` per pair of column blocks and group; all columns by default.

    ``groups`` > 1 reads an integer column ``fold`` and sums every fold on its own (rows outside
    0..groups-1 count nowhere); ``weighted`` > 0 reads weight vectors ``wt`` and sums once per weight.
    """
    blocks = blocks or [(0, dim + 2)]
    needed = sorted({i for pair in pairs for i in pair})
    shape = [(blocks[i][1] - blocks[i][0], blocks[j][1] - blocks[j][0]) for i, j in pairs]
    n_sums = max(groups, weighted, 1)

    def columns(x, y, begin, end):
        if end <= dim:
            return x[:, begin:end]
        ends = np.column_stack([y, np.ones(len(y))])[:, max(begin - dim, 0) : end - dim]
        return np.hstack([x[:, begin:dim], ends]) if begin < dim else ends

    def kernel(batch):
        x, y = vectors(batch.column("f"), dim), scalars(batch.column("y"))
        parts = {i: columns(x, y, *blocks[i]) for i in needed}
        if weighted:
            wt = vectors(batch.column("wt"), weighted)
            of = [({i: parts[i] * wt[:, [k]] for i, _ in pairs}, parts) for k in range(weighted)]
        elif groups > 1:
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            of = [({i: parts[i][fold == k] for i in needed},) * 2 for k in range(groups)]
        else:
            of = [(parts, parts)]
        return np.concatenate([(left[i].T @ right[j]).ravel() for left, right in of for i, j in pairs])

    return kernel, n_sums * sum(a * b for a, b in shape)


def gradient_kernel(
    kind: str, w: np.ndarray, columns: np.ndarray | None, n_weights: int, at: np.ndarray | None = None
):
    """Sums ``X^T r`` for many models at once: ``w`` is (D, models).

    Labels of -1 count as 0 in the logistic loss; ``product`` takes the scores themselves for r, and
    ``curvature`` the scores of ``w`` times the logistic slope at ``at``. ``columns[m]`` picks the weight of
    model m from the row's weight vector ``wt``. Then come the summed weights, i.e. each model's row count,
    and each model's sum of r squared.
    """
    dim, models = w.shape

    def kernel(batch):
        x = vectors(batch.column("f"), dim)
        y = scalars(batch.column("y"))[:, None]
        z = x @ w
        if kind == "logistic":
            with np.errstate(over="ignore"):
                r = 1.0 / (1.0 + np.exp(-z)) - np.where(y == -1, 0.0, y)
        elif kind == "mae":
            r = -np.sign(y - z)
        elif kind == "curvature":
            with np.errstate(over="ignore"):
                s = 1.0 / (1.0 + np.exp(-(x @ at)))
            r = s * (1.0 - s) * z
        else:
            r = z if kind == "product" else z - y
        weighted = r
        if n_weights:
            wt = vectors(batch.column("wt"), n_weights)[:, columns]
            weighted = r * wt
            n = wt.sum(axis=0)
        else:
            n = np.full(models, float(len(x)))
        return np.concatenate([(x.T @ weighted).ravel(), n, (r * weighted).sum(axis=0)])

    return in_pieces(kernel, models), dim * models + 2 * models


def in_pieces(kernel: Callable[[pa.RecordBatch], np.ndarray], models: int) -> Callable[[pa.RecordBatch], np.ndarray]:
    """The kernel run over as many rows at a time as keep a table of rows x models small."""
    rows = max(1, ASSIGN_CELLS // max(models, 1))

    def run(batch):
        if batch.num_rows <= rows:
            return kernel(batch)
        total = kernel(batch.slice(0, rows))
        for begin in range(rows, batch.num_rows, rows):
            total += kernel(batch.slice(begin, rows))
        return total

    return run


def coordinate_kernel(w: np.ndarray, begin: int, end: int, column: int | None, n_weights: int):
    """X'(Xw - y) of the coordinates from ``begin`` to ``end``, and their cross products, for one model."""
    dim = len(w)

    def kernel(batch):
        x, y = vectors(batch.column("f"), dim), scalars(batch.column("y"))
        part, r = x[:, begin:end], x @ w - y
        weighted = part if column is None else part * vectors(batch.column("wt"), n_weights)[:, [column]]
        return np.concatenate([weighted.T @ r, (weighted.T @ part).ravel()])

    return kernel, (end - begin) * (end - begin + 1)


def newton_kernel(w: np.ndarray, columns: np.ndarray | None, n_weights: int):
    """Logistic gradient sums as in ``gradient_kernel``, followed by each model's Hessian sums."""
    dim, models = w.shape
    gradient, g_size = gradient_kernel("logistic", w, columns, n_weights)

    def kernel(batch):
        x = vectors(batch.column("f"), dim)
        with np.errstate(over="ignore"):
            s = 1.0 / (1.0 + np.exp(-(x @ w)))
        s = s * (1.0 - s)
        if n_weights:
            s = s * vectors(batch.column("wt"), n_weights)[:, columns]
        hessians = [(x.T @ (x * s[:, [m]])).ravel() for m in range(models)]
        return np.concatenate([gradient(batch), *hessians])

    return kernel, g_size + models * dim * dim


def imbalanced_kernel(w: np.ndarray, history: np.ndarray, alphas: np.ndarray, columns, n_weights: int):
    """Gradient sums of the imbalanced logistic loss for many models.

    A positive row's reward is ``p + alpha * sum_s softplus(x . w_s)`` over the weights of all
    earlier steps since ``p`` was last stored, so no per-row state is needed between steps.
    ``history`` is (steps, D, models).
    """
    dim, models = w.shape

    def kernel(batch):
        x = vectors(batch.column("f"), dim)
        y = scalars(batch.column("y"))
        y = np.where(y == -1, 0.0, y)
        with np.errstate(over="ignore"):
            s = 1.0 / (1.0 + np.exp(-(x @ w)))
        positive = y != 0
        reward = vectors(batch.column("p"), models)
        if len(history) and positive.any():
            gain = np.zeros((int(positive.sum()), models))
            for step in history:
                gain += np.logaddexp(0.0, x[positive] @ step)
            reward = reward.copy()
            reward[positive] += alphas * y[positive][:, None] * gain
        r = s - y[:, None] * (reward + s * (1.0 - reward))
        if n_weights:
            wt = vectors(batch.column("wt"), n_weights)[:, columns]
            r = r * wt
            n = wt.sum(axis=0)
        else:
            n = np.full(models, float(len(x)))
        return np.concatenate([(x.T @ r).ravel(), n])

    return kernel, dim * models + models


def reward_batches(history: np.ndarray, alphas: np.ndarray, dim: int, names: list[str]):
    """Batches of the table with the reward column ``p`` brought up to date by ``history``."""
    models = len(alphas)

    def refresh(batches):
        for batch in batches:
            x = vectors(batch.column("f"), dim)
            y = scalars(batch.column("y"))
            gain = np.zeros((len(x), models))
            for step in history:
                gain += np.logaddexp(0.0, x @ step)
            y = np.where(y == -1, 0.0, y)
            p = vectors(batch.column("p"), models) + alphas * y[:, None] * gain
            columns = {n: batch.column(n) for n in names}
            columns["p"] = list_array(p)
            yield pa.RecordBatch.from_pydict(columns)

    return refresh


def evaluation_kernel(w: np.ndarray, columns: np.ndarray | None, n_weights: int, use_sign: bool):
    """Per model and side (test, train): n, tp, fp, fn, wrong, absolute and squared error sums.

    ``wt`` holds training weights and ``wv`` test weights; without them every row is on both sides.
    """
    dim, models = w.shape

    def kernel(batch):
        x = vectors(batch.column("f"), dim)
        y = scalars(batch.column("y"))[:, None]
        p = x @ w
        if use_sign:
            p = np.sign(p)
        facts = [
            np.ones_like(p),
            (p == 1) & (y == 1),
            (p == 1) & (y == -1),
            (p == -1) & (y == 1),
            p != y,
            np.abs(p - y),
            (p - y) ** 2,
        ]
        out = []
        for side in ("wv", "wt"):
            if n_weights:
                wt = vectors(batch.column(side), n_weights)[:, columns]
                out += [(fact * wt).sum(axis=0) for fact in facts]
            else:
                out += [fact.sum(axis=0, dtype=float) for fact in facts]
        return np.concatenate(out)

    return in_pieces(kernel, models), 2 * 7 * models


def assign(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each row; the lowest index wins a tie.

    Distances come from one matrix product, |x|^2 - 2 x.c + |c|^2. Where that leaves more than one centre within
    its rounding error, those centres are measured again coordinate by coordinate.
    """
    k, dim = centres.shape
    shift = centres.mean(axis=0)  # near the rows, as a rule, which keeps the products small
    moved = centres - shift
    lengths = np.einsum("ij,ij->i", moved, moved)
    error = 16 * (dim + 4) * np.finfo(float).eps
    index = np.zeros(len(x), dtype=np.int32)
    step = max(1, ASSIGN_CELLS // (k + dim))
    for begin in range(0, len(x), step):
        rows = x[begin : begin + step]
        near = rows - shift
        d = lengths - 2.0 * (near @ moved.T)
        own = np.einsum("ij,ij->i", near, near)
        limit = d.min(axis=1) + error * (own + lengths.max())
        close = ~(d > limit[:, None])
        found = close.argmax(axis=1)
        for i in np.flatnonzero(close.sum(axis=1) > 1):
            candidates = np.flatnonzero(close[i])
            gap = rows[i] - centres[candidates]
            found[i] = candidates[np.einsum("ij,ij->i", gap, gap).argmin()]
        index[begin : begin + step] = found
    return index


def cluster_kernel(centres: np.ndarray):
    """Row count and coordinate sums of every cluster."""
    k, dim = centres.shape

    def kernel(batch):
        x = vectors(batch.column("f"), dim)
        index = assign(x, centres)
        sums = [np.bincount(index, weights=x[:, d], minlength=k) for d in range(dim)]
        return np.concatenate(
            [np.bincount(index, minlength=k).astype(float), np.column_stack(sums).ravel()]
        )

    return kernel, k + k * dim
