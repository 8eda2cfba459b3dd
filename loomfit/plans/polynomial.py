"""A linear estimator on powers of the continuous features."""

from __future__ import annotations

from collections.abc import Hashable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import balanced_sum, quoted, sign
from ..operators.linear import Estimator, LinearModel
from ..sources.dictionary import ColumnSpec
from .preparation import Powers, power_column


@dataclass(frozen=True)
class PolynomialModel:
    """Predicts from the original columns; their names must be those seen in fitting."""

    inner: LinearModel
    continuous: tuple[str, ...]
    others: tuple[str, ...]
    degree: int

    def score(self) -> Column:
        terms: dict[str, Column] = {c: quoted(c).cast("double") for c in self.others}
        for c in self.continuous:
            x = power = quoted(c).cast("double")
            for j in range(1, self.degree + 1):
                terms[power_column(c, j)] = power
                power = power * x
        w = list(self.inner.weights)
        bias = [F.lit(float(w.pop(0)))] if self.inner.intercept else []
        return balanced_sum(
            bias + [terms[c] * F.lit(float(v)) for c, v in zip(self.inner.features, w, strict=True)]
        )

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        absent = [c for c in (*self.others, *self.continuous) if c not in df.columns]
        if absent:
            raise ValueError(f"columns seen in fitting are absent: {absent}")
        return df.withColumn(name, sign(self.score()) if self.inner.classifies else self.score())


@dataclass(frozen=True)
class Polynomial:
    """Powers 1..degree of the continuous features, then ``estimator``."""

    degree: int
    continuous: Sequence[str]
    estimator: Estimator

    @property
    def features_key(self) -> Hashable:
        """Equal for models with equal features, which a search trains on one table."""
        return self.degree, tuple(self.continuous)

    def expanded(self, df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """The table with powers for the continuous features, and the names of all features."""
        spec = self._spec(df, features)
        out = Powers(self.degree).fit(df, spec).transform(df)
        return out, spec.features(out.columns)

    def _spec(self, df: DataFrame, features: Sequence[str]) -> ColumnSpec:
        return ColumnSpec(continuous=self.continuous, keys=[c for c in df.columns if c not in features])

    def fit(self, df: DataFrame, features: Sequence[str], label: str, **how) -> PolynomialModel:
        expanded, names = self.expanded(df, features)
        spec = self._spec(df, features)
        model = self.estimator.fit(expanded, names, label, **how)
        continuous = tuple(spec.continuous_in(df.columns))
        others = tuple(spec.categorical_in(df.columns))
        return PolynomialModel(replace(model, features=tuple(names)), continuous, others, self.degree)
