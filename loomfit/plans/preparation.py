"""Preparation steps and the pipeline.

``step.fit(df, spec)`` looks at the data and returns a fitted step; a fitted step's ``transform`` is a
lazy projection. Steps share one column profile: a fitted step says what the profile looks like
after it, so a whole pipeline needs one profiling scan plus one scan each for medians, correlations
and classes, not one per step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import statistics as st
from ..functions.scalars import quoted
from ..operators.ordering import uniform
from ..session import MAX_CLASSES
from ..sources.dictionary import ColumnSpec

Profile = st.Profile


class Scan:
    """The table a step is fitted on, with its profile computed at most once."""

    def __init__(self, df: DataFrame, spec: ColumnSpec, known: Profile | None = None):
        self.df, self.spec, self._known = df, spec, known

    @property
    def columns(self) -> list[str]:
        return self.spec.features(self.df.columns)

    @property
    def profile(self) -> Profile:
        if self._known is None:
            self._known = st.profile(self.df, self.columns)
        return self._known

    @property
    def profiled(self) -> bool:
        return self._known is not None


@dataclass(frozen=True)
class Fitted:
    """A fitted step: the projection, and how it changes a known profile (None if unknown)."""

    project: Callable[[DataFrame], DataFrame]
    carry: Callable[[Profile], Profile | None] = lambda known: None
    state: Any = None

    def transform(self, df: DataFrame) -> DataFrame:
        return self.project(df)


class Step:
    """A preparation step. Subclasses implement ``learn``; user steps may do the same."""

    def learn(self, scan: Scan) -> Fitted:
        raise NotImplementedError

    def fit(self, df: DataFrame, spec: ColumnSpec) -> Fitted:
        return self.learn(Scan(df, spec))

    def fit_transform(self, df: DataFrame, spec: ColumnSpec) -> DataFrame:
        return self.fit(df, spec).transform(df)


def dropping(names: Sequence[str]) -> Fitted:
    """A fitted step that removes columns."""
    gone = set(names)

    def project(df: DataFrame) -> DataFrame:
        return df.select(*[quoted(c) for c in df.columns if c not in gone])

    return Fitted(project, lambda known: {c: p for c, p in known.items() if c not in gone}, list(names))


def replacing(exprs: dict[str, Column], carry: Callable[[Profile], Profile | None], state: Any) -> Fitted:
    """A fitted step that computes some columns anew."""

    def project(df: DataFrame) -> DataFrame:
        return df.select(*[exprs[c].alias(c) if c in exprs else quoted(c) for c in df.columns])

    return Fitted(project, carry, state)


@dataclass(frozen=True)
class DropColumns(Step):
    """Remove columns by name."""

    names: Sequence[str]

    def learn(self, scan: Scan) -> Fitted:
        return dropping(self.names)


@dataclass(frozen=True)
class DropUseless(Step):
    """Remove the columns the dictionary calls useless."""

    def learn(self, scan: Scan) -> Fitted:
        return dropping(scan.spec.useless_in(scan.df.columns))


@dataclass(frozen=True)
class DropCategorical(Step):
    """Remove all categorical columns."""

    def learn(self, scan: Scan) -> Fitted:
        return dropping(scan.spec.categorical_in(scan.df.columns))


@dataclass(frozen=True)
class RecodeMissing(Step):
    """Replace the answer codes that mean "missing" by NULL."""

    def learn(self, scan: Scan) -> Fitted:
        codes = {c: scan.spec.missing_codes(c) for c in scan.columns}
        codes = {c: found for c, found in codes.items() if found}
        exprs = {
            c: F.when(~F.coalesce(quoted(c).try_cast("double").isin(found), F.lit(False)), quoted(c))
            for c, found in codes.items()
        }
        return replacing(exprs, lambda known: None if codes else known, codes)


@dataclass(frozen=True)
class DropMostlyMissing(Step):
    """Remove columns with at least the given share of missing values."""

    share_categorical: float = 0.95
    share_continuous: float = 0.95

    def learn(self, scan: Scan) -> Fitted:
        continuous = set(scan.spec.continuous_in(scan.df.columns))

        def gone(name: str) -> bool:
            share = self.share_continuous if name in continuous else self.share_categorical
            p = scan.profile[name]
            return p.n_missing >= p.n * share

        return dropping([c for c in scan.columns if gone(c)])


@dataclass(frozen=True)
class DropConstant(Step):
    """Remove columns whose population deviation is at most ``eps``; all-missing columns stay."""

    eps: float = 1e-6

    def learn(self, scan: Scan) -> Fitted:
        def gone(p: st.ColumnProfile) -> bool:
            if p.numeric:
                return p.std is not None and p.std <= self.eps
            return p.low is not None and p.low == p.high

        return dropping([c for c in scan.columns if gone(scan.profile[c])])


@dataclass(frozen=True)
class DropProportional(Step):
    """Of each pair of columns with correlation 1, remove the one that comes first."""

    def learn(self, scan: Scan) -> Fitted:
        return dropping(st.proportional(scan.df, scan.columns, scan.profile))


@dataclass(frozen=True)
class Impute(Step):
    """Fill missing continuous values with the median or mean.

    ``distributions`` also fills each missing categorical value with a seeded draw from the observed
    frequencies of its column; the draw depends on the row's id (the first key of the spec). Columns with more
    than ``max_classes`` classes are drawn from their cumulative frequencies as a table, by a join in ranges.
    """

    strategy: str = "median"
    seed: int = 1
    max_classes: int = MAX_CLASSES

    def __post_init__(self):
        if self.strategy not in ("median", "mean", "distributions"):
            raise ValueError(f"unknown way to fill missing values: {self.strategy}")

    def learn(self, scan: Scan) -> Fitted:
        names = scan.spec.continuous_in(scan.df.columns)
        known = scan.profile
        if self.strategy == "mean":
            fills = {c: known[c].mean for c in names}
        else:
            fills = st.medians(scan.df, names, known)
        fills = {c: v for c, v in fills.items() if v is not None}
        exprs = {c: F.coalesce(quoted(c).cast("double"), F.lit(v)) for c, v in fills.items()}
        drawn: dict[str, list[tuple[Any, int]]] = {}
        wide: dict[str, DataFrame] = {}
        if self.strategy == "distributions":
            if not scan.spec.keys:
                raise ValueError("seeded draws need an id: put it first in the spec's keys")
            row_id = quoted(scan.spec.keys[0])
            counts, wide = st.split_classes(
                scan.df, scan.spec.categorical_in(scan.df.columns), known, self.max_classes
            )
            wide = {c: classes for c, classes in wide.items() if known[c].n_missing}
            drawn = {c: [vc for vc in v if vc[0] is not None] for c, v in counts.items()}
            drawn = {c: v for c, v in drawn.items() if v}
            for c, classes in drawn.items():
                kind = scan.df.schema[c].dataType
                draw = _draw(uniform(self.seed, F.lit(c), row_id), classes).cast(kind)
                exprs[c] = F.coalesce(quoted(c), draw)

        def carry(before: Profile) -> Profile | None:
            if any(before[c].n_missing for c in (*drawn, *wide)):
                return None
            return {c: p.filled(fills[c]) if c in fills else p for c, p in before.items()}

        fitted = replacing(exprs, carry, {"fills": fills, "draws": drawn, "tables": wide})
        if not wide:
            return fitted

        def project(df: DataFrame) -> DataFrame:
            out = fitted.project(df)
            for c, classes in wide.items():
                out = _draw_from(out, c, classes, uniform(self.seed, F.lit(c), row_id))
            return out.select(*[quoted(c) for c in df.columns])

        return Fitted(project, carry, fitted.state)


DRAW_RANGES = 1024


def _draw_from(df: DataFrame, column: str, classes: DataFrame, u: Column) -> DataFrame:
    """Fill a column's missing values from the slices of cumulative frequencies that hold ``u``.

    The unit interval is cut into DRAW_RANGES equal ranges; a class is listed in all that its slice meets, and
    a row looks in the one that holds its number. Rows that miss nothing meet no class, and are spread out.
    """
    share = lambda n: n / F.col("total")
    known = classes.filter(F.col("v").isNotNull() | F.col("s").isNotNull())
    slices = known.select(
        (F.col("v") if st.is_numeric(df, column) else F.col("s")).cast(df.schema[column].dataType).alias("__value"),
        share(F.col("upto") - F.col("n")).alias("__from"),
        share(F.col("upto")).alias("__to"),
    )
    last = F.lit(DRAW_RANGES - 1)
    at = lambda x: F.least(F.floor(x * DRAW_RANGES).cast("int"), last)
    slices = slices.withColumn("__range", F.explode(F.sequence(at(F.col("__from")), at(F.col("__to")))))
    missing = quoted(column).isNull()
    spread = -1 - F.pmod(F.xxhash64(u), F.lit(DRAW_RANGES)).cast("int")
    rows = df.withColumn("__u", u).withColumn("__row_range", F.when(missing, at(F.col("__u"))).otherwise(spread))
    inside = (F.col("__u") >= F.col("__from")) & (F.col("__u") < F.col("__to"))
    joined = rows.join(slices, (F.col("__row_range") == F.col("__range")) & inside, "left")
    return joined.withColumn(column, F.coalesce(quoted(column), F.col("__value"))).drop(
        "__u", "__row_range", "__value", "__from", "__to", "__range"
    )


def _draw(u: Column, classes: Sequence[tuple[Any, int]]) -> Column:
    """The value whose slice of the cumulative frequencies holds ``u``."""
    total = sum(n for _, n in classes)
    upto, chain = 0, None
    for value, n in classes[:-1]:
        upto += n
        hit = u < F.lit(upto / total)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    last = F.lit(classes[-1][0])
    return last if chain is None else chain.otherwise(last)


@dataclass(frozen=True)
class Standardise(Step):
    """Continuous columns to mean 0 and population deviation 1.

    Missing values are skipped; with ``allow_missing=False`` they are an error.
    """

    allow_missing: bool = True

    def learn(self, scan: Scan) -> Fitted:
        names = scan.spec.continuous_in(scan.df.columns)
        known = scan.profile
        flat = [c for c in names if known[c].std == 0]
        if flat:
            raise ValueError(f"columns without any variation: {flat}")
        holes = [c for c in names if known[c].n_missing]
        if holes and not self.allow_missing:
            raise ValueError(f"columns with missing values: {holes}")
        moments = {c: (known[c].mean, known[c].std) for c in names if known[c].std}
        exprs = {
            c: (quoted(c).cast("double") - F.lit(mean)) / F.lit(std) for c, (mean, std) in moments.items()
        }

        def carry(before: Profile) -> Profile:
            after = dict(before)
            for c, (mean, std) in moments.items():
                p = before[c]
                after[c] = replace(
                    p, mean=0.0, std=1.0, low=(p.low - mean) / std, high=(p.high - mean) / std
                )
            return after

        return replacing(exprs, carry, moments)


@dataclass(frozen=True)
class OneHot(Step):
    """Categorical columns to 0/1 columns, one per class seen in fitting, named ``column__class``.

    Classes are sorted; missing is a class of its own (``column__nan``) and comes last. Classes not
    seen in fitting give zeros. Continuous columns come first in the output.

    A column with more than ``max_classes`` classes becomes one sparse vector ``column__classes`` instead, with
    the same places; its classes stay a table and rows find theirs by a join.
    """

    drop_last: bool = False
    max_classes: int = MAX_CLASSES

    def learn(self, scan: Scan) -> Fitted:
        names = scan.spec.categorical_in(scan.df.columns)
        lists, wide = st.split_classes(scan.df, names, scan.profile, self.max_classes)
        classes = {c: [v for v, _ in found] for c, found in lists.items()}
        if self.drop_last:
            classes = {c: found[:-1] for c, found in classes.items()}
        # SQL text: thousands of indicators would be slow to build one Column object at a time
        made = []
        for c in classes:
            kind = "double" if scan.profile[c].numeric else "string"
            for v in classes[c]:
                hit = f"CAST({sql_name(c)} AS {kind}) <=> {sql_literal(v)}"
                made.append(f"CAST({hit} AS double) AS {sql_name(class_column(c, v))}")

        def project(df: DataFrame) -> DataFrame:
            out = df.selectExpr(*[sql_name(c) for c in df.columns if c not in classes], *made)
            for c, table in wide.items():
                out = _sparse(out, c, table, self.drop_last)
            return out

        return Fitted(project, state={**classes, **wide})


def _sparse(df: DataFrame, column: str, classes: DataFrame, drop_last: bool) -> DataFrame:
    """Replace a column by the sparse indicator vector of its class; unseen classes give zeros."""
    key, code = "__class", "__code"
    codes = classes.select(F.struct("v", "s").alias(key), F.col("code").cast("double").alias(code))
    size = int(codes.agg(F.max(code)).first()[0]) + (0 if drop_last else 1)
    placed = df.withColumn(key, st.class_key(df, column)).join(codes, key, "left").drop(key, column)
    # classes without a place, unseen or dropped, take one behind all others, which the encoder cuts off
    placed = placed.withColumn(code, F.least(F.coalesce(code, F.lit(float(size))), F.lit(float(size))))
    encoder = OneHotEncoder(inputCol=code, outputCol=f"{column}__classes", dropLast=True)
    fitted = encoder.fit(df.sparkSession.createDataFrame([(float(size),)], f"{code} double"))
    return fitted.transform(placed).drop(code)


def sql_name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def sql_literal(value: float | str | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST('{value!r}' AS double)"


def class_column(column: str, value: Any) -> str:
    return f"{column}__{'nan' if value is None else value}"


@dataclass(frozen=True)
class AddBias(Step):
    """Put a column ``bias`` of ones in front of the features."""

    def learn(self, scan: Scan) -> Fitted:
        keys = set(scan.spec.keys)

        def project(df: DataFrame) -> DataFrame:
            front = [quoted(c) for c in df.columns if c in keys]
            rest = [quoted(c) for c in df.columns if c not in keys]
            return df.select(*front, F.lit(1.0).alias("bias"), *rest)

        def carry(before: Profile) -> Profile:
            n = next(iter(before.values())).n if before else 0
            return {"bias": st.ColumnProfile(True, n, 0, 1.0, 0.0, 1.0, 1.0), **before}

        return Fitted(project, carry)


@dataclass(frozen=True)
class Powers(Step):
    """Powers 1..degree of the continuous columns, without cross terms.

    Output: categorical columns, then all first powers, then all squares, and so on.
    """

    degree: int

    def learn(self, scan: Scan) -> Fitted:
        names = scan.spec.continuous_in(scan.df.columns)
        others = scan.spec.categorical_in(scan.df.columns)

        def project(df: DataFrame) -> DataFrame:
            keys = [quoted(c) for c in df.columns if c in scan.spec.keys]
            powers = []
            for j in range(1, self.degree + 1):
                for c in names:
                    x = power = quoted(c).cast("double")
                    for _ in range(j - 1):
                        power = power * x
                    powers.append(power.alias(power_column(c, j)))
            return df.select(*keys, *[quoted(c) for c in others], *powers)

        return Fitted(project, state=names)


def power_column(column: str, degree: int) -> str:
    return column if degree == 1 else f"{column}__^{degree}"


@dataclass(frozen=True)
class FittedPipeline:
    steps: tuple[Fitted, ...]
    columns: tuple[str, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = step.transform(df)
        return df


@dataclass(frozen=True)
class Pipeline:
    """Steps in order; each is fitted on the output of the ones before."""

    steps: Sequence[Step]

    def _run(self, df: DataFrame, spec: ColumnSpec) -> tuple[FittedPipeline, DataFrame]:
        known: Profile | None = None
        fitted = []
        for step in self.steps:
            scan = Scan(df, spec, known)
            done = step.learn(scan)
            fitted.append(done)
            known = done.carry(scan.profile) if scan.profiled else None
            df = done.transform(df)
        return FittedPipeline(tuple(fitted), tuple(spec.features(df.columns))), df

    def fit(self, df: DataFrame, spec: ColumnSpec) -> FittedPipeline:
        return self._run(df, spec)[0]

    def fit_transform(self, df: DataFrame, spec: ColumnSpec) -> DataFrame:
        return self._run(df, spec)[1]


def survey_pipeline(drop_last: bool = True, degree: int | None = None) -> Pipeline:
    """The usual order of steps, with powers at the end if a degree is given."""
    steps: list[Step] = [
        DropUseless(),
        RecodeMissing(),
        DropMostlyMissing(),
        DropConstant(),
        Impute("median"),
        DropProportional(),
        Standardise(allow_missing=False),
        OneHot(drop_last),
    ]
    return Pipeline([*steps, Powers(degree)] if degree else steps)
