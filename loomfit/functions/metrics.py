"""Scores of predictions against labels, each one an aggregate Column.

``weight`` counts a row that many times, which equals physically repeating it.
A metric here is any function ``(prediction, label, weight=None) -> Column``; user functions of
``(prediction, label)`` are accepted wherever these are (see ``plans.tuning``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import sign


def _mean(value: Column, weight: Column | None) -> Column:
    if weight is None:
        return F.avg(value)
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def _count(condition: Column, weight: Column | None) -> Column:
    one = F.lit(1.0) if weight is None else weight.cast("double")
    return F.sum(F.when(condition, one).otherwise(0.0))


def mse(p: Column, y: Column, weight: Column | None = None) -> Column:
    """Half the mean squared error."""
    return _mean((p - y) * (p - y), weight) * 0.5


def rmse(p: Column, y: Column, weight: Column | None = None) -> Column:
    return F.sqrt(_mean((p - y) * (p - y), weight))


def mae(p: Column, y: Column, weight: Column | None = None) -> Column:
    return _mean(F.abs(p - y), weight)


def misclassification(p: Column, y: Column, weight: Column | None = None) -> Column:
    return _mean((p != y).cast("double"), weight)


def accuracy(p: Column, y: Column, weight: Column | None = None) -> Column:
    return 1.0 - misclassification(p, y, weight)


def f1(p: Column, y: Column, weight: Column | None = None) -> Column:
    """F1 of class +1; 0 when there is nothing to score. A prediction of 0 is in no cell."""
    tp = _count((p == 1) & (y == 1), weight)
    fp = _count((p == 1) & (y == -1), weight)
    fn = _count((p == -1) & (y == 1), weight)
    return F.coalesce(F.try_divide(tp, tp + (fp + fn) * 0.5), F.lit(0.0))


def f1_continuous(p: Column, y: Column, weight: Column | None = None) -> Column:
    return f1(sign(p), y, weight)


def accuracy_f1(p: Column, y: Column, weight: Column | None = None) -> Column:
    """Both class scores of the sign of a continuous prediction, as a struct."""
    return F.struct(
        accuracy(sign(p), y, weight).alias("accuracy"), f1(sign(p), y, weight).alias("f1")
    )


def log_loss(score: Column, y01: Column, weight: Column | None = None) -> Column:
    """Mean negative log likelihood of a linear score; labels must be 0 or 1."""
    from .scalars import softplus

    return _mean(softplus(score) - y01 * score, weight)
