"""The seeded order: rows sorted by md5 of "seed:id", ties by id.

The order depends on nothing but the seed and the ids, so it survives lost executors, any
partitioning and any re-run. Two ways to use it:

* ``seeded_rank`` numbers all rows. It sorts inside hash buckets and adds the counts of the earlier
  buckets, so no task ever sees more than a bucket.
* ``Positions`` finds where the first r rows end. Splits, folds and exact-size samples then are
  plain filters on the row's own hash: one counting pass, one pass over a single bucket, and no
  shuffle of the table. It is for few strata, whose counts come to the driver.
* ``stratum_blocks`` does the same for any number of strata and cuts. Counts and cuts stay tables, and rows
  meet the cuts of their stratum by a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import quoted
from ..session import MAX_STRATA, work_folder

KEY, BUCKET, TIE, STRATUM = "__key", "__bucket", "__tie", "__stratum"
HEX_DIGITS = 3  # 4,096 buckets to count
KEY_DIGITS = 32  # length of a key
RANK_DIGITS = 4  # 65,536 buckets to sort
RANGE_ROWS = 1_000_000  # rows of a range of ids that are sorted together
MIN_RANGES = 64
SKETCH_ACCURACY = 10_000  # a sketch's quantiles are off by one in so many rows at most
REFINE_ROWS = 2_000_000  # largest bucket searched for a cut as it is; larger ones are counted finer


def order_key(seed: Any, *parts: Column) -> Column:
    """md5 of the seed and the parts, joined by colons."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def uniform(seed: Any, *parts: Column) -> Column:
    """A number in (0, 1) that is a function of the seed and the parts."""
    return (hash_number(order_key(seed, *parts)) + F.lit(0.5)) / F.lit(float(2**52))


def place(key: Column, tie: Column) -> Column:
    """What a row is ordered by."""
    return F.struct(key.alias("key"), tie.alias("tie"))


def hash_number(key: Column) -> Column:
    """First 13 hex digits (52 bits) of a key as a number."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("long")


def seeded_rank(
    df: DataFrame, id_col: str, seed: int = 1, by: str | None = None, name: str = "rank"
) -> DataFrame:
    """Add the 1-based position of each row in the seeded order, per value of ``by`` if given."""
    keyed = df.withColumn(KEY, order_key(seed, quoted(id_col))).withColumn(
        BUCKET, F.substring(KEY, 1, RANK_DIGITS)
    )
    return _number_rows(keyed, df.columns, [by] if by else [], [KEY, id_col], name)


def id_rank(df: DataFrame, id_col: str, name: str = "rank", ranges: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in ascending order of a numeric id.

    Rows are sorted in ranges of ids. Without ``ranges`` there are as many as it takes for about RANGE_ROWS rows
    in each, so no task gets more on a larger table.
    """
    if ranges is None:
        ranges = max(MIN_RANGES, math.ceil(df.count() / RANGE_ROWS))
    steps = [i / ranges for i in range(1, ranges)]
    bounds = df.select(F.percentile_approx(quoted(id_col), F.lit(steps), 10 * ranges)).first()[0]
    splits = [-math.inf, *sorted({float(b) for b in bounds or []}), math.inf]
    bucketed = (
        Bucketizer(splits=splits, inputCol="__id", outputCol=BUCKET)
        .transform(df.withColumn("__id", quoted(id_col).cast("double")))
        .drop("__id")
    )
    return _number_rows(bucketed, df.columns, [], [id_col], name)


def _number_rows(
    bucketed: DataFrame, columns: list[str], by: list[str], order: list[str], name: str
) -> DataFrame:
    """Number rows inside ordered buckets and add the sizes of the earlier buckets; null is a group, too."""
    sizes = bucketed.groupBy(*by, BUCKET).agg(F.count("*").alias("__size"))
    earlier = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.struct(*by, BUCKET).alias(STRATUM), F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before")
    )
    if not by:
        offsets = F.broadcast(offsets)  # one row per bucket, of which there is a fixed number
    inside = Window.partitionBy(*by, BUCKET).orderBy(*[quoted(c) for c in order])
    return (
        bucketed.withColumn("__within", F.row_number().over(inside).cast("long"))
        .withColumn(STRATUM, F.struct(*by, BUCKET))
        .join(offsets, STRATUM)
        .withColumn(name, F.col("__before") + F.col("__within"))
        .select(*[quoted(c) for c in columns], name)
    )


@dataclass(frozen=True)
class Cut:
    """The last row, in seeded order, of the first r rows of a stratum."""

    key: str | None
    tie: Any = None
    kind: Any = None
    everything: bool = False

    def covers(self, here: Column) -> Column:
        """Whether a row, given as its (key, tie), is at or before the cut."""
        if self.everything:
            return F.lit(True)
        if self.key is None:
            return F.lit(False)
        return here <= F.struct(F.lit(self.key).alias("key"), F.lit(self.tie).cast(self.kind).alias("tie"))


class Positions:
    """Exact positions in the seeded order of a table, per stratum, without sorting the table.

    ``key``, ``tie`` and ``by`` are expressions over the table; ``by`` must have few values.
    """

    def __init__(self, df: DataFrame, key: Column, tie: Column, by: Column | None = None):
        self.key, self.tie = key, tie
        self.by = F.lit(0) if by is None else by
        self._keyed = df.select(self.by.alias(STRATUM), key.alias(KEY), tie.alias(TIE))
        self._sizes = self._bucket_sizes(self._keyed, HEX_DIGITS, MAX_STRATA)
        self.counts = {s: sum(sizes.values()) for s, sizes in self._sizes.items()}
        self._found: dict[tuple[Any, int], Cut] = {}

    @staticmethod
    def _bucket_sizes(keyed: DataFrame, digits: int, groups: int) -> dict[Any, dict[str, int]]:
        """Rows per stratum and key prefix, of which there may be 16**HEX_DIGITS in each of some groups."""
        counted = keyed.groupBy(STRATUM, F.substring(KEY, 1, digits).alias(BUCKET)).agg(F.count("*").alias("n"))
        sizes: dict[Any, dict[str, int]] = {}
        most = groups * 16**HEX_DIGITS
        rows = counted.limit(most + 1).collect()  # one more than there can be, so nothing is cut off
        for row in rows:
            sizes.setdefault(row[STRATUM], {})[row[BUCKET]] = row["n"]
        if len(rows) > most or len(sizes) > MAX_STRATA:
            raise ValueError(f"more than {MAX_STRATA} strata")
        return sizes

    def count(self, stratum: Any = 0) -> int:
        return self.counts.get(stratum, 0)

    def cuts(self, ranks: Mapping[Any, Sequence[int]]) -> dict[Any, list[Cut]]:
        """For each stratum and each r, the cut after the first r rows. One small job for all new ones."""
        found = self._found
        targets: dict[Any, list[tuple[int, int]]] = {}  # stratum -> (rank, rank in what is searched)
        for stratum, wanted in ranks.items():
            for r in wanted:
                if r <= 0:
                    found[stratum, r] = Cut(None)
                elif r >= self.count(stratum):
                    found[stratum, r] = Cut(None, everything=True)
                elif (stratum, r) not in found:
                    targets.setdefault(stratum, []).append((r, r))
        spots = _locate(targets, self._sizes)
        digits = HEX_DIGITS
        while spots and max(size for *_, size in spots) > REFINE_ROWS:
            if digits >= KEY_DIGITS:
                raise ValueError("one id has too many rows for a seeded order; ids must be unique")
            digits += HEX_DIGITS
            finer = self._bucket_sizes(self._keyed.filter(_in_buckets(spots)), digits, len(spots))
            spots = [
                spot
                for stratum, prefix, rank, within, _ in spots
                for spot in _locate(
                    {stratum: [(rank, within)]},
                    {stratum: {b: n for b, n in finer[stratum].items() if b.startswith(prefix)}},
                )
            ]
        if spots:
            kind = self._keyed.schema[TIE].dataType
            prefix = F.substring(KEY, 1, digits)
            inside = Window.partitionBy(STRATUM, BUCKET).orderBy(KEY, TIE)
            at = F.struct(STRATUM, BUCKET, "__within")
            rows = (
                self._keyed.filter(_in_buckets(spots))
                .withColumn(BUCKET, prefix)
                .withColumn("__within", F.row_number().over(inside))
                .filter(at.isin([F.struct(F.lit(s), F.lit(b), F.lit(w)) for s, b, _, w, _ in spots]))
                .collect()
            )
            by_spot = {(s, b, w): rank for s, b, rank, w, _ in spots}
            for row in rows:
                rank = by_spot[row[STRATUM], row[BUCKET], row["__within"]]
                found[row[STRATUM], rank] = Cut(row[KEY], row[TIE], kind)
        return {s: [found[s, r] for r in targets] for s, targets in ranks.items()}

    def first(self, n: Mapping[Any, int]) -> Column:
        """Whether a row is among the first ``n[stratum]`` rows of its stratum."""
        return self.block({s: [r] for s, r in n.items()}) == 0

    def block(self, ends: Mapping[Any, Sequence[int]]) -> Column:
        """Index of the block a row falls in when its stratum is cut after ``ends``; -1 past the last.

        With several cuts the key is bound to a variable, so a row's hash is computed once. A single cut needs
        none, and stays inside generated code.
        """
        found = self.cuts(ends)
        here = place(self.key, self.tie)
        if max(map(len, found.values()), default=0) <= 1:
            return self._index(found, here)
        return F.transform(F.array(here), lambda bound: self._index(found, bound))[0]

    def _index(self, found: Mapping[Any, Sequence[Cut]], here: Column) -> Column:
        out = None
        for stratum, cuts in found.items():
            index = None
            for i, cut in enumerate(cuts):
                hit = (self.by == F.lit(stratum)) & cut.covers(here)
                index = F.when(hit, i) if index is None else index.when(hit, i)
            if index is not None:
                last = index.otherwise(-1)
                out = (
                    F.when(self.by == F.lit(stratum), last)
                    if out is None
                    else out.when(self.by == F.lit(stratum), last)
                )
        return F.lit(-1) if out is None else out.otherwise(-1)


def _locate(targets: Mapping[Any, Sequence[tuple[int, int]]], sizes: Mapping[Any, Mapping[str, int]]):
    """Where targets fall: (stratum, bucket, rank, position within the bucket, bucket size)."""
    spots = []
    for stratum, wanted in targets.items():
        before = 0
        left = sorted(wanted, key=lambda t: t[1])
        for bucket, n in sorted(sizes.get(stratum, {}).items()):
            while left and left[0][1] <= before + n:
                rank, at = left.pop(0)
                spots.append((stratum, bucket, rank, at - before, n))
            before += n
    return spots


def _in_buckets(spots) -> Column:
    """Whether a keyed row is in a bucket that holds a cut; the hash is computed once per row."""
    prefix = F.substring(KEY, 1, len(spots[0][1]))
    pairs = {(stratum, bucket) for stratum, bucket, *_ in spots}
    if len({s for s, _ in pairs}) == 1:
        return (F.col(STRATUM) == F.lit(next(iter(pairs))[0])) & prefix.isin([b for _, b in pairs])
    return F.struct(F.col(STRATUM), prefix).isin([F.struct(F.lit(s), F.lit(b)) for s, b in pairs])


def row_positions(df: DataFrame, id_col: str, seed: int = 1, by: Column | None = None) -> Positions:
    """``Positions`` over the ids of a table."""
    return Positions(df, order_key(seed, quoted(id_col)), quoted(id_col), by)


def stratum_blocks(
    df: DataFrame, id_col: str, by: Column, ends: Callable[[Column], Column], seed: int = 1, name: str = "block"
) -> DataFrame:
    """Add the index of the block a row is in when its stratum's seeded order is cut after ``ends`` rows.

    ``by`` may have any number of values; null is one of them. ``ends`` gives the ascending cuts of a stratum from
    its number of rows, as an array. Rows past the last cut are in block ``size(ends)``.

    Rows are counted per stratum and key prefix. A running sum over the prefixes of a stratum tells which
    of them hold a cut, and only their rows are sorted. The cuts, a row per stratum, are written to the
    shared folder; a stratum that holds most rows is split by the join as any skewed key is.
    """
    keyed = df.select(F.struct(by.alias("by")).alias(STRATUM), order_key(seed, quoted(id_col)).alias(KEY), quoted(id_col).alias(TIE))
    digits = HEX_DIGITS
    rows = df.count()
    while rows > REFINE_ROWS * 16**digits and digits < KEY_DIGITS:
        digits += 1
    prefix = F.substring(KEY, 1, digits).alias(BUCKET)
    whole, so_far = Window.partitionBy(STRATUM), Window.partitionBy(STRATUM).orderBy(BUCKET)
    counted = keyed.groupBy(STRATUM, prefix).agg(F.count("*").alias("n"))
    located = counted.withColumn("upto", F.sum("n").over(so_far)).withColumn("rows", F.sum("n").over(whole))
    cut = F.filter(ends(F.col("rows")), lambda r: (r > F.col("upto") - F.col("n")) & (r <= F.col("upto")))
    spots = located.select(STRATUM, BUCKET, F.explode(F.transform(cut, lambda r: r - F.col("upto") + F.col("n"))).alias("__within"))
    inside = Window.partitionBy(STRATUM, BUCKET).orderBy(KEY, TIE)
    sorted_rows = (
        keyed.withColumn(BUCKET, prefix)
        .join(spots.select(STRATUM, BUCKET).distinct(), [STRATUM, BUCKET], "left_semi")
        .withColumn("__within", F.row_number().over(inside))
    )
    cuts = (
        sorted_rows.join(spots, [STRATUM, BUCKET, "__within"])
        .groupBy(STRATUM)
        .agg(F.collect_list(place(F.col(KEY), F.col(TIE))).alias("__cuts"))
    )
    path = work_folder(df.sparkSession)
    sizes = keyed.groupBy(STRATUM).agg(F.count("*").alias("rows"))
    # A cut before the first row has no row to be found at.
    ahead = F.size(F.filter(ends(F.col("rows")), lambda r: r <= 0))
    sizes.withColumn("__ahead", ahead).drop("rows").join(
        cuts.withColumn("__cuts", F.sort_array("__cuts")), STRATUM, "left"
    ).write.parquet(path)
    cuts = df.sparkSession.read.parquet(path)
    # Binary search among a stratum's cuts, by steps that halve.
    most = cuts.agg(F.max(F.size("__cuts"))).first()[0] or 0
    steps = F.array(*[F.lit(1 << p) for p in reversed(range(max(most, 1).bit_length()))])
    passed = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get("__cuts", at + step - 1) < F.col("__here"), at + step).otherwise(at),
    )
    here = place(order_key(seed, quoted(id_col)), quoted(id_col))
    return (
        df.withColumn("__here", here)
        .withColumn(STRATUM, F.struct(by.alias("by")))
        .join(cuts, STRATUM)
        .withColumn(name, F.col("__ahead") + passed)
        .drop("__here", "__cuts", "__ahead", STRATUM)
    )


def first_by_id(df: DataFrame, id_col: str, n: int, rows: int) -> DataFrame:
    """At least the ``n`` rows with the smallest numeric ids, and not many more, of a table of ``rows`` rows.

    A quantile sketch gives an id that is large enough; all rows are taken if its filter should hold too few.
    """
    if n >= rows:
        return df
    share = min(n / rows + 2 / SKETCH_ACCURACY, 1.0)
    bound = df.select(F.percentile_approx(quoted(id_col), F.lit(share), SKETCH_ACCURACY)).first()[0]
    front = df.filter(quoted(id_col) <= F.lit(bound))
    return front if front.count() >= n else df
