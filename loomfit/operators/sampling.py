"""Splits, folds, mini-batches and class rebalancing with exact sizes.

Everything here is decided by a row's own hash and a few cut points (see ``ordering``), so splits,
folds and resampling add filters or a ``copies`` column to the table and never shuffle it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import quoted
from .ordering import Positions, first_by_id, hash_number, id_rank, order_key, place, row_positions, seeded_rank, stratum_blocks

MAJORITY, MINORITY = -1, 1
DRAWS_PER_TASK = 5_000_000
FOLDS_AT_ONCE = 16  # folds whose copies are counted together, as the counts come to the driver


def stride(df: DataFrame, id_col: str, step: int = 50) -> DataFrame:
    """Every ``step``-th row by id, starting with the first."""
    ranked = id_rank(df, id_col, "__rank")
    return ranked.filter((F.col("__rank") - 1) % step == 0).drop("__rank")


def train_flag(df: DataFrame, id_col: str, ratio: float, seed: int = 1) -> Column:
    """Whether a row is among the first ``floor(N * ratio)`` rows of the seeded order."""
    positions = row_positions(df, id_col, seed)
    return positions.first({0: math.floor(positions.count() * ratio)})


def split(df: DataFrame, id_col: str, ratio: float, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; exactly ``floor(N * ratio)`` are train rows."""
    train = train_flag(df, id_col, ratio, seed)
    return df.filter(train), df.filter(~train)


def sample(df: DataFrame, id_col: str, n: int, seed: int = 1) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if there are fewer)."""
    return df.filter(row_positions(df, id_col, seed).first({0: n}))


def gather(df: DataFrame, ids: DataFrame, id_col: str, copies: str | None = None) -> DataFrame:
    """Rows whose id is listed; with ``copies``, each as often as the list says."""
    if copies is None:
        return df.join(ids, id_col, "left_semi")
    return repeat_rows(df.join(ids.select(id_col, copies), id_col), copies)


def remove(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is not listed."""
    return df.join(ids, id_col, "left_anti")


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Write each row ``copies`` times, numbered from 1 in the column ``copy``."""
    kept = df.filter(F.col(copies) > 0)
    return kept.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))


def add_copies(tables: Sequence[DataFrame], id_col: str, copies: str = "copies") -> DataFrame:
    """Add up how often rows are taken: ids with the sum of their copies over all tables.

    Ids are counted per task before they meet. A table without the copies column takes each of its rows once;
    a null number of copies counts as none.
    """
    counted = [
        t.select(quoted(id_col), (F.coalesce(quoted(copies), F.lit(0)) if copies in t.columns else F.lit(1)).cast("long").alias(copies))
        for t in tables
    ]
    return reduce(DataFrame.unionByName, counted).groupBy(quoted(id_col)).agg(F.sum(copies).alias(copies))


@dataclass(frozen=True)
class Folds:
    """A table with a test-fold column, and the training copies of every row per fold.

    ``copies`` is None where each row trains once in every fold but its own.
    """

    df: DataFrame
    k: int
    fold: str = "fold"
    copies: str | None = None

    def train(self, i: int) -> DataFrame:
        if self.copies is None:
            return self.df.filter(F.col(self.fold) != i)
        counted = self.df.withColumn("__copies", F.col(self.copies)[i])
        return repeat_rows(counted, "__copies").drop("__copies", "copy", self.copies)

    def test(self, i: int) -> DataFrame:
        return self.df.filter(F.col(self.fold) == i)

    def train_weights(self) -> Column:
        """One training weight per fold, as an array."""
        if self.copies is not None:
            return F.col(self.copies).cast("array<double>")
        return F.array(*[(F.col(self.fold) != i).cast("double") for i in range(self.k)])

    def test_weights(self) -> Column:
        return F.array(*[(F.col(self.fold) == i).cast("double") for i in range(self.k)])


def kfold(df: DataFrame, id_col: str, k: int, seed: int = 1) -> Folds:
    """k equal folds of ``floor(N / k)`` rows; the last ``N mod k`` rows in seeded order are left out."""
    positions = row_positions(df, id_col, seed)
    size = positions.count() // k
    fold = positions.block({0: [size * (i + 1) for i in range(k)]})
    # a filter of its own: filtering on the fold column would compute the folds twice
    return Folds(df.filter(positions.first({0: size * k})).withColumn("fold", fold), k)


def stratified_folds(df: DataFrame, id_col: str, by: str, k: int = 5, seed: int = 1) -> Folds:
    """k folds with equally many rows of every stratum; the rows of a stratum beyond a multiple of k are left out.

    ``by`` may have any number of values; null is one of them.
    """
    ends = lambda n: F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.floor(n / k) * i)
    placed = stratum_blocks(df, id_col, quoted(by), ends, seed, "fold")
    return Folds(placed.filter(F.col("fold") < k), k)


def stratified_upsampled_folds(
    df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 1, even: bool = False
) -> Folds:
    """Per-class folds whose training side holds as many minority as majority rows.

    The training minority of a fold is repeated often enough to reach the majority count; then exactly that many
    of the copies are drawn without replacement: the first ones in the seeded order of "fold:id:copy". With
    ``even`` they are dealt evenly instead: with a majority and b minority rows per fold, each minority row has
    a // b copies, and the first a % b rows of each fold have one more. Test folds are not resampled.
    """
    y = quoted(label)
    counts = class_counts(df, label)
    size = {c: counts.get(c, 0) // k for c in (MAJORITY, MINORITY)}
    if not all(size.values()):
        raise ValueError("every fold needs rows of both classes")
    rows = df.filter(y.isin(MAJORITY, MINORITY))
    if even:
        return _evenly_upsampled(rows, id_col, y, k, seed, size)
    ends = lambda n: F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.floor(n / k) * i)
    placed = stratum_blocks(rows, id_col, y.cast("int"), ends, seed, "fold")
    folded = placed.filter(F.col("fold") < k).withColumn("fold", F.col("fold").cast("int"))
    drawn = _drawn_copies(folded, id_col, y, k, seed, size)
    # the fold is bound to a variable: the optimiser would place the search for it into the lambda, once per fold
    copies = F.transform(
        F.array("fold"),
        lambda own: F.transform(
            F.sequence(F.lit(0), F.lit(k - 1)),
            lambda i: F.when(i == own, 0).when(y == MAJORITY, 1).otherwise(drawn(i)),
        ),
    )[0]
    return Folds(folded.withColumn("copies", copies), k, copies="copies")


def _drawn_copies(folded: DataFrame, id_col: str, y: Column, k: int, seed: int, size: dict[int, int]):
    """How many copies of a minority row are drawn for the training side of a fold, as a function of the fold."""
    n_copies = -(-size[MAJORITY] // size[MINORITY])
    keep = (k - 1) * size[MAJORITY]
    if k == 1 or size[MAJORITY] == n_copies * size[MINORITY]:
        return lambda i: F.lit(n_copies)
    row_id = quoted(id_col)
    cuts = []
    for begin in range(0, k, FOLDS_AT_ONCE):
        some = range(begin, min(begin + FOLDS_AT_ONCE, k))
        copies = (
            folded.filter(y == MINORITY)
            .select(row_id.alias("id"), "fold", F.explode(F.sequence(F.lit(some[0]), F.lit(some[-1]))).alias("i"))
            .filter(F.col("i") != F.col("fold"))
            .select("id", "i", F.explode(F.sequence(F.lit(1), F.lit(n_copies))).alias("copy"))
        )
        key = order_key(seed, F.col("i"), F.col("id"), F.col("copy"))
        found = Positions(copies, key, F.col("id"), F.col("i")).cuts({i: [keep] for i in some})
        cuts += [place(F.lit(cut.key), F.lit(cut.tie).cast(cut.kind)) for i in some for cut in found[i]]
    last = F.array(*cuts)

    def drawn(i: Column) -> Column:
        covered = lambda copy: place(order_key(seed, i, row_id, copy), row_id) <= F.get(last, i)
        return F.size(F.filter(F.sequence(F.lit(1), F.lit(n_copies)), covered))

    return drawn


def _evenly_upsampled(rows: DataFrame, id_col: str, y: Column, k: int, seed: int, size: dict[int, int]) -> Folds:
    each, more = divmod(size[MAJORITY], size[MINORITY])

    def ends(n: Column) -> Column:
        per_fold = F.floor(n / k)
        extra = F.when(per_fold == size[MAJORITY], 0).otherwise(more) if size[MAJORITY] != size[MINORITY] else F.lit(0)
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")),
                lambda i: F.array(per_fold * i + extra, per_fold * (i + 1)),
            )
        )

    placed = stratum_blocks(rows, id_col, y.cast("int"), ends, seed, "__block")
    folded = placed.filter(F.col("__block") < 2 * k).withColumn("fold", F.floor(F.col("__block") / 2).cast("int"))
    copies = F.when(y == MAJORITY, 1).otherwise(each + (F.col("__block") % 2 == 0).cast("int"))
    folded = folded.withColumn("copies", copies)
    # not a lambda over the folds: the optimiser would place the search for the block into it, once per fold
    per_fold = F.concat(
        F.array_repeat("copies", F.col("fold")), F.array(F.lit(0)), F.array_repeat("copies", k - 1 - F.col("fold"))
    )
    return Folds(folded.withColumn("copies", per_fold).drop("__block"), k, copies="copies")


def batches(
    df: DataFrame,
    id_col: str,
    batch_size: int,
    num_batches: int = 1,
    shuffle: bool = True,
    seed: int = 1,
) -> DataFrame:
    """Rows with the number of the mini-batch they belong to (a row may be in several).

    One order is repeated end to end and cut into pieces of ``batch_size``; batches run over the
    end of the table. Without ``shuffle`` the order is that of the id. Only rows that some batch
    needs are numbered.
    """
    needed = batch_size * num_batches
    if shuffle:
        positions = row_positions(df, id_col, seed)
        n = positions.count()
        rows = df.filter(positions.first({0: needed})) if needed < n else df
        ranked = seeded_rank(rows, id_col, seed, name="__rank")
    else:
        n = df.count()
        ranked = id_rank(first_by_id(df, id_col, needed, n), id_col, "__rank")
    first = F.col("__rank") - 1
    return (
        ranked.filter(first < needed)
        .withColumn("__at", F.explode(F.sequence(first, F.lit(needed - 1).cast("long"), F.lit(n).cast("long"))))
        .withColumn("batch", F.floor(F.col("__at") / batch_size).cast("int"))
        .drop("__rank", "__at")
    )


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    rows = df.filter(quoted(label).isin(MAJORITY, MINORITY)).groupBy(quoted(label).alias("y")).count()
    return {int(r["y"]): r["count"] for r in rows.collect()}


def downsample(df: DataFrame, id_col: str, label: str, seed: int = 1) -> DataFrame:
    """Keep all minority rows and as many seeded majority rows."""
    y = quoted(label)
    positions = row_positions(df, id_col, seed, by=y.cast("int"))
    n_maj, n_min = positions.count(MAJORITY), positions.count(MINORITY)
    if n_min > n_maj:
        raise ValueError(f"class {MINORITY} has more rows ({n_min}) than class {MAJORITY} ({n_maj})")
    return df.filter((y != MAJORITY) | positions.first({MAJORITY: n_min}))


def upsample_copies(
    df: DataFrame, id_col: str, label: str, seed: int = 1, ratio: float = 1.0
) -> DataFrame:
    """Add ``copies``: 1 for majority rows; minority copies sum to ``floor(ratio * majority)``."""
    y = quoted(label)
    positions = row_positions(df, id_col, seed, by=y.cast("int"))
    target = math.floor(ratio * positions.count(MAJORITY))
    each, extra = divmod(target, max(positions.count(MINORITY), 1))
    one_more = positions.first({MINORITY: extra}).cast("int")
    return df.withColumn("copies", F.when(y == MINORITY, F.lit(each) + one_more).otherwise(1))


def upsample(df: DataFrame, id_col: str, label: str, seed: int = 1, ratio: float = 1.0) -> DataFrame:
    """The table with minority rows physically repeated."""
    return repeat_rows(upsample_copies(df, id_col, label, seed, ratio), "copies").drop("copies", "copy")


def bootstrap_copies(
    minority: DataFrame, id_col: str, draws: dict[int, int], seed: int = 1, rows: int | None = None
) -> DataFrame:
    """Draws with replacement: ``(group, id, copies)`` with ``draws[group]`` draws per group.

    Draw j of a group picks the row at position ``hash(seed, group, j) mod n``. Draws are counted
    before they meet the rows. ``rows`` is the number of rows to draw from, if it is known.
    """
    spark = minority.sparkSession
    ranked = seeded_rank(minority.select(quoted(id_col)), id_col, seed, name="__rank")
    n = minority.count() if rows is None else rows
    if not n or not draws:
        raise ValueError("nothing to draw from")
    pieces = [
        spark.range(0, size, 1, size // DRAWS_PER_TASK + 1).select(F.lit(g).alias("group"), "id")
        for g, size in draws.items()
    ]
    drawn = (
        reduce(DataFrame.unionAll, pieces)
        .withColumn("__rank", hash_number(order_key(seed, F.col("group"), F.col("id"))) % n + 1)
        .groupBy("group", "__rank")
        .agg(F.count("*").cast("int").alias("copies"))
    )
    return drawn.join(ranked, "__rank").select("group", id_col, "copies")
