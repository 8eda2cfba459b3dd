"""Row-level formulas as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def softplus(z: Column) -> Column:
    """``ln(1 + e^z)`` without overflow for large z."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def sign(z: Column) -> Column:
    """-1, 0 or 1 as a double; ``+ 0.0`` turns a negative zero into zero."""
    return F.signum(z) + F.lit(0.0)


def soft_threshold(rho: Column, lam: float) -> Column:
    return sign(rho) * F.greatest(F.abs(rho) - F.lit(float(lam)), F.lit(0.0))


def label_to_01(y: Column) -> Column:
    return F.when(y == -1, 0).otherwise(y).cast("double")


def label_to_pm1(y: Column) -> Column:
    return F.when(y == 0, -1).otherwise(y).cast("double")


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def balanced_sum(terms: Sequence[Column]) -> Column:
    """Sum as a balanced tree, so thousands of terms stay a shallow expression."""
    terms = list(terms)
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        paired = [a + b for a, b in zip(terms[::2], terms[1::2])]
        terms = paired + terms[len(paired) * 2 :]
    return terms[0]


def linear_score(features: Sequence[str], weights: Sequence[float]) -> Column:
    """Dot product of feature columns and literal weights, inside codegen."""
    return balanced_sum(
        [quoted(c).cast("double") * F.lit(float(w)) for c, w in zip(features, weights, strict=True)]
    )


def dot(a: Column, b: Column) -> Column:
    """Dot product of two array columns."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    """Euclidean length of an array column."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, v: s + v * v))


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two array columns."""
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v))


def real_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def feature_array(features: Sequence[str]) -> Column:
    return F.array(*[quoted(c).cast("double") for c in features])
