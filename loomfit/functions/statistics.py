"""Statistics of many columns in one aggregate each.

Columns are unfolded into (column number, value) pairs and grouped by the number. The plan has the
same size for ten or a thousand columns, one scan serves all of them, and partial sums are formed
before the shuffle of one row per column and task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.table import TrainingTable
from ..session import MAX_CLASSES, work_folder
from .scalars import quoted

SKETCH_ACCURACY = 10_000  # a sketch's quantiles are off by one in so many rows at most


@dataclass(frozen=True)
class ColumnProfile:
    numeric: bool
    n: int
    n_missing: int
    mean: float | None = None
    std: float | None = None
    low: Any = None
    high: Any = None

    def filled(self, value: float) -> "ColumnProfile":
        """The profile after missing values are replaced by ``value``."""
        if not self.n_missing or self.mean is None:
            return self
        k, n = self.n_missing, self.n
        mean = ((n - k) * self.mean + k * value) / n
        var = ((n - k) * (self.std**2 + (self.mean - mean) ** 2) + k * (value - mean) ** 2) / n
        return replace(
            self,
            n_missing=0,
            mean=mean,
            std=math.sqrt(var),
            low=min(self.low, value),
            high=max(self.high, value),
        )


Profile = dict[str, ColumnProfile]


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.NumericType, T.BooleanType))


def unfold(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(c, v, s)`` rows: column number and its value as a double, or as a string."""
    cells = []
    for i, name in enumerate(columns):
        number = is_numeric(df, name)
        v = quoted(name).cast("double") if number else F.lit(None).cast("double")
        v = F.when(~F.isnan(v), v)  # not a number is missing
        s = F.lit(None).cast("string") if number else quoted(name).cast("string")
        cells.append(F.struct(F.lit(i).alias("c"), v.alias("v"), s.alias("s")))
    return df.select(F.inline(F.array(*cells)))


def profile(df: DataFrame, columns: Sequence[str]) -> Profile:
    """Counts, missing counts, mean, population deviation and range of columns.

    Strings are profiled by their hash: that they are all equal is all that is asked of them. This
    keeps every aggregate buffer of fixed size, so the whole pass runs as one generated hash
    aggregate.
    """
    if not columns:
        return {}
    h = F.when(F.col("s").isNotNull(), F.xxhash64("s"))
    rows = (
        unfold(df, columns)
        .select("c", "v", h.alias("h"))
        .groupBy("c")
        .agg(
            F.count("*").alias("n"),
            (F.count("v") + F.count("h")).alias("present"),
            F.avg("v").alias("mean"),
            F.stddev_pop("v").alias("std"),
            F.min("v").alias("low"),
            F.max("v").alias("high"),
            F.min("h").alias("h_low"),
            F.max("h").alias("h_high"),
        )
        .collect()
    )
    found = {r["c"]: r for r in rows}
    out: Profile = {}
    for i, name in enumerate(columns):
        r, number = found.get(i), is_numeric(df, name)
        if r is None:
            out[name] = ColumnProfile(number, 0, 0)
        else:
            low, high = (r["low"], r["high"]) if number else (r["h_low"], r["h_high"])
            out[name] = ColumnProfile(number, r["n"], r["n"] - r["present"], r["mean"], r["std"], low, high)
    return out


def medians(df: DataFrame, columns: Sequence[str], known: Profile) -> dict[str, float | None]:
    """Exact medians of numeric columns (mean of the middle two), missing values aside."""
    present = [c for c in columns if known[c].n > known[c].n_missing]
    wanted = {}
    for c in present:
        n = known[c].n - known[c].n_missing
        wanted[c] = ((n - 1) // 2, n // 2)
    values = order_statistics(df, wanted, known)
    out: dict[str, float | None] = {c: None for c in columns}
    for c in present:
        lo, hi = (values[c, r] for r in wanted[c])
        out[c] = 0.5 * lo + 0.5 * hi
    return out


def order_statistics(
    df: DataFrame, wanted: Mapping[str, Sequence[int]], known: Profile
) -> dict[tuple[str, int], float]:
    """The r-th smallest value (from 0) of columns, in three scans; all ranks together.

    A mergeable quantile sketch gives a lower and an upper bound for each rank. One scan counts exactly
    what is below and between them, and the last one counts the distinct values between, which are about
    one in SKETCH_ACCURACY / 4 of the rows or have many repetitions, and finds the rank among them. The driver
    gets a row per rank. Not a number is left out; infinities are values.
    """
    # neighbouring ranks, like the middle two, share their bounds
    groups: list[tuple[str, list[int]]] = []
    for c, rs in wanted.items():
        for r in sorted(set(rs)):
            if groups and groups[-1][0] == c and r - groups[-1][1][-1] <= 1:
                groups[-1][1].append(r)
            else:
                groups.append((c, [r]))
    if not groups:
        return {}
    shares = [(_bounds(rs[0], known[c])[0], _bounds(rs[-1], known[c])[1]) for c, rs in groups]
    number = [F.when(~F.isnan(quoted(c).cast("double")), quoted(c).cast("double")) for c, _ in groups]
    sketch = df.agg(
        *[
            F.percentile_approx(v, F.array(*map(F.lit, share)), SKETCH_ACCURACY).alias(str(i))
            for i, (v, share) in enumerate(zip(number, shares))
        ]
    ).first()
    columns, bounds = [c for c, _ in groups], [tuple(found) for found in sketch]
    counted = _in_spans(df, columns, bounds).groupBy("t").agg(
        F.count_if(F.col("v") < F.col("low")).alias("below"),
        F.count_if(F.col("v").between(F.col("low"), F.col("high"))).alias("inside"),
    )
    found = {row["t"]: row for row in counted.collect()}
    solved: dict[tuple[str, int], float] = {}
    open_: list[tuple[str, tuple[float, float], int, list[int]]] = []
    for i, (c, rs) in enumerate(groups):
        below, inside = found[i]["below"], found[i]["inside"]
        low, high = bounds[i]
        if rs[0] < below or rs[-1] >= below + inside:  # the sketch was off: look among all values
            open_.append((c, (float("-inf"), float("inf")), 0, rs))
        elif low == high:
            solved |= {(c, r): low for r in rs}
        else:
            open_.append((c, (low, high), below, rs))
    if open_:
        spans = _in_spans(df, [o[0] for o in open_], [o[1] for o in open_])
        upto = F.sum("n").over(Window.partitionBy("t").orderBy("v"))
        first = F.get(F.array(*[F.lit(rs[0] - below) for _, _, below, rs in open_]), F.col("t"))
        last = F.get(F.array(*[F.lit(rs[-1] - below) for _, _, below, rs in open_]), F.col("t"))
        rows = (
            spans.filter(F.col("v").between(F.col("low"), F.col("high")))
            .groupBy("t", "v")
            .agg(F.count("*").alias("n"))
            .withColumn("upto", upto)
            .filter((F.col("upto") > first) & (F.col("upto") - F.col("n") <= last))
            .collect()
        )
        for row in rows:
            c, _, below, rs = open_[row["t"]]
            solved |= {(c, r): row["v"] for r in rs if row["upto"] - row["n"] <= r - below < row["upto"]}
    return solved


def _bounds(rank: int, known: ColumnProfile) -> tuple[float, float]:
    """Shares of the sorted values between which a rank lies, with room for twice the sketch's error."""
    n = max(known.n - known.n_missing, 1)
    return max(rank / n - 2 / SKETCH_ACCURACY, 0.0), min((rank + 1) / n + 2 / SKETCH_ACCURACY, 1.0)


def _in_spans(df: DataFrame, columns: Sequence[str], bounds: Sequence[tuple[float, float]]) -> DataFrame:
    """``(t, v, low, high)`` rows: every number of each column, with the column's place in the list and its bounds."""
    cells = [
        F.struct(F.lit(i).alias("t"), quoted(c).cast("double").alias("v"), F.lit(low).alias("low"), F.lit(high).alias("high"))
        for i, (c, (low, high)) in enumerate(zip(columns, bounds))
    ]
    return df.select(F.inline(F.array(*cells))).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def class_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The classes of categorical columns as a table, for any number of them.

    ``c`` is the column's number, ``v`` or ``s`` the class as a number or text, ``n`` its rows, ``code`` its place
    among the sorted classes, from 0, missing last, and ``upto`` and ``total`` the rows with a class up to this one
    and with any. Classes are counted before they meet, and sorted and summed up in ranges.
    """
    return _placed(unfold(df, columns).groupBy("c", "v", "s").agg(F.count("*").alias("n")))


def _placed(counted: DataFrame) -> DataFrame:
    """Counted classes with their places and running sums; see ``class_table``."""
    spark, path = counted.sparkSession, work_folder(counted.sparkSession)
    missing = (F.col("v").isNull() & F.col("s").isNull()).alias("missing")
    order = ("c", "missing", "v", "s")
    ranged = counted.select("c", "v", "s", "n", missing).repartitionByRange(*[F.col(c) for c in order])
    ranged.withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path).withColumn("known", F.when(F.col("missing"), 0).otherwise(F.col("n")))
    parts = ranged.groupBy("c", "part").agg(F.count("*").alias("__classes"), F.sum("known").alias("__rows"))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "c",
        "part",
        F.coalesce(F.sum("__classes").over(earlier), F.lit(0)).alias("__classes"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows"),
        F.sum("__rows").over(Window.partitionBy("c")).alias("total"),
    )
    inside = Window.partitionBy("c", "part").orderBy("missing", "v", "s")
    return (
        ranged.withColumn("__at", F.row_number().over(inside) - 1)
        .withColumn("__upto", F.sum("known").over(inside))
        .join(offsets, ["c", "part"])
        .select(
            "c", "v", "s", "n", (F.col("__classes") + F.col("__at")).alias("code"), (F.col("__rows") + F.col("__upto")).alias("upto"), "total"
        )
    )


def class_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Add the place of a row's class among the column's sorted classes, from 0; missing is the last one."""
    codes = class_table(df, [column]).select(F.struct("v", "s").alias("__class"), F.col("code").alias(name))
    # a struct of both kinds of value is never null, so the missing class finds its code
    return df.withColumn("__class", class_key(df, column)).join(codes, "__class", "left").drop("__class")


def class_key(df: DataFrame, column: str) -> Column:
    """A row's class as in ``class_table``: a struct of number and text, of which one or none is set."""
    if is_numeric(df, column):
        v, s = quoted(column).cast("double"), F.lit(None).cast("string")
        v = F.when(~F.isnan(v), v)
    else:
        v, s = F.lit(None).cast("double"), quoted(column).cast("string")
    return F.struct(v.alias("v"), s.alias("s"))


def split_classes(
    df: DataFrame, columns: Sequence[str], known: Profile, limit: int
) -> tuple[dict[str, list[tuple[Any, int]]], dict[str, DataFrame]]:
    """Classes with counts of the columns that have at most ``limit`` of them, and tables for the other columns.

    The data is read once. Lists are sorted, the missing class comes last; tables are as in ``class_table``.
    """
    if not columns:
        return {}, {}
    spark, path = df.sparkSession, work_folder(df.sparkSession)
    unfold(df, columns).groupBy("c", "v", "s").agg(F.count("*").alias("n")).write.parquet(path)
    counted = spark.read.parquet(path)
    present = F.count_if(F.col("v").isNotNull() | F.col("s").isNotNull())
    sizes = {row["c"]: row["k"] for row in counted.groupBy("c").agg(present.alias("k")).collect()}
    wide = [i for i in range(len(columns)) if sizes.get(i, 0) > limit]
    lists: dict[str, list[tuple[Any, int]]] = {c: [] for i, c in enumerate(columns) if i not in wide}
    few = counted.filter(~F.col("c").isin(wide)) if wide else counted
    for r in few.collect():  # at most limit + 1 rows of each column
        lists[columns[r["c"]]].append((r["v"] if known[columns[r["c"]]].numeric else r["s"], r["n"]))
    for classes in lists.values():
        classes.sort(key=lambda vc: (vc[0] is None, vc[0] if vc[0] is not None else 0))
    if not wide:
        return lists, {}
    path = work_folder(spark)
    _placed(counted.filter(F.col("c").isin(wide))).write.parquet(path)
    classes = spark.read.parquet(path)
    return lists, {columns[i]: classes.filter(F.col("c") == i).drop("c") for i in wide}


def class_counts_of(
    df: DataFrame, columns: Sequence[str], known: Profile, limit: int = MAX_CLASSES
) -> dict[str, list[tuple[Any, int]]]:
    """Sorted distinct values of categorical columns with their counts; a missing class comes last.

    For columns with at most ``limit`` of them; ``class_table`` has any number.
    """
    lists, wide = split_classes(df, columns, known, limit)
    if wide:
        raise ValueError(f"columns with more than {limit} distinct values: {list(wide)}")
    return lists


def _standardised(df: DataFrame, columns: Sequence[str], known: Profile) -> tuple[list[str], TrainingTable]:
    """The numeric columns that vary and miss nothing, and their standardised values as a table of vectors."""
    usable = [
        c for c in columns if known[c].numeric and known[c].n and not known[c].n_missing and known[c].std
    ]
    centred = df.select(
        F.array(*[(quoted(c).cast("double") - F.lit(known[c].mean)) / F.lit(known[c].std) for c in usable]).alias("f"),
        F.lit(0.0).alias("y"),
    )
    return usable, TrainingTable(centred, len(usable))


def correlations(df: DataFrame, columns: Sequence[str], known: Profile) -> np.ndarray:
    """Pearson matrix from one pass over centred columns; NaN where a column is constant or has a
    missing value."""
    usable, table = _standardised(df, columns, known)
    out = np.full((len(columns), len(columns)), np.nan)
    if not usable:
        return out
    (gram,) = table.grams()
    scale = np.sqrt(np.diag(gram.xtx))
    at = [columns.index(c) for c in usable]
    out[np.ix_(at, at)] = gram.xtx / np.outer(scale, scale)
    return out


def correlation_table(df: DataFrame, columns: Sequence[str], known: Profile) -> DataFrame:
    """(a, b, r) for each pair of usable columns, a before b or the same; for any number of columns.

    Constant columns and ones with missing values have no rows. The matrix stays on the cluster.
    """
    usable, table = _standardised(df, columns, known)
    if not usable:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    names = F.array(*map(F.lit, usable))
    n = known[usable[0]].n
    return table.gram_table().filter(F.col("b") < len(usable)).select(
        F.get(names, F.col("a")).alias("a"), F.get(names, F.col("b")).alias("b"), (F.col("total") / n).alias("r")
    )


def proportional(df: DataFrame, columns: Sequence[str], known: Profile) -> list[str]:
    """The columns that have a correlation of 1 with a later one, found block by block of the matrix."""
    usable, table = _standardised(df, columns, known)
    if not usable:
        return []
    n, found = known[usable[0]].n, set()
    for _, rows, others, block in table.gram_blocks():
        close = np.isclose(block / n, 1.0)
        a, b = np.nonzero(close)
        a, b = a + rows.start, b + others.start
        found.update(a[(a < b) & (b < len(usable))].tolist())
    return [usable[i] for i in sorted(found)]
