"""An ensemble of L1 logistic models, one per cluster of the majority class."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import balanced_sum, linear_score, quoted, sign
from . import sums
from .logistic import Logistic
from .sampling import MAJORITY, MINORITY, bootstrap_copies
from .table import TrainingTable


def f1_of(tp: float, fp: float, fn: float) -> float:
    cells = tp + 0.5 * (fp + fn)
    return float(tp / cells) if cells else 0.0


@dataclass(frozen=True)
class EnsembleModel:
    features: tuple[str, ...]
    weights: np.ndarray  # (D, models)
    clusters: tuple[int, ...]
    scores: tuple[float, ...]
    voting_weights: tuple[float, ...]

    def votes(self) -> list[Column]:
        """The class prediction of each model."""
        return [sign(linear_score(self.features, w)) for w in self.weights.T]

    def prediction(self, method: str = "percentage", percentage: float = 0.3) -> Column:
        """+1 if more than ``percentage`` of the models say so, or the sign of the weighted vote."""
        if method == "percentage":
            yes = balanced_sum([(v > 0).cast("int") for v in self.votes()])
            return F.when(yes > F.lit(percentage * len(self.clusters)), 1.0).otherwise(-1.0)
        if method == "weight_voting":
            return sign(balanced_sum([v * F.lit(w) for v, w in zip(self.votes(), self.voting_weights)]))
        raise ValueError("method is either `percentage` or `weight_voting`")

    def transform(self, df: DataFrame, name: str = "prediction", **how) -> DataFrame:
        return df.withColumn(name, self.prediction(**how))


def tag_clusters(df: DataFrame, clusters: DataFrame, id_col: str, label: str, tag: int) -> DataFrame:
    """Cluster ids from a table, by id; minority rows get ``tag``."""
    found = df.join(clusters, id_col, "left")
    return found.withColumn(
        "cluster", F.when(quoted(label) == MINORITY, F.lit(tag)).otherwise(F.col("cluster"))
    )


@dataclass(frozen=True)
class ClusterEnsemble:
    """Model i trains on the i-th large enough majority cluster and as many minority draws.

    All models train together: a row's weight in a model is 1 in its own cluster, the number of its
    draws if it is a minority row, and 0 elsewhere.
    """

    lambdas: Sequence[float]
    gammas: Sequence[float]
    max_iters: Sequence[int]
    seed: int = 1
    threshold_quantile: float = 0.0

    def training_weights(
        self, df: DataFrame, label: str, cluster: str, id_col: str
    ) -> tuple[DataFrame, list[int]]:
        """The table with weight vectors ``wt``/``wv``, and the clusters that get a model."""
        y = quoted(label)
        majority, minority = df.filter(y == MAJORITY), df.filter(y == MINORITY)
        # one aggregate for the sizes of the majority's clusters and of the minority
        group = F.when(y == MAJORITY, quoted(cluster)).alias("cluster")
        rows = df.filter(y.isin(MAJORITY, MINORITY)).groupBy(y.alias("y"), group).agg(F.count("*").alias("n")).collect()
        sizes = {r["cluster"]: r["n"] for r in rows if r["y"] == MAJORITY and r["cluster"] is not None}
        n_min = sum(r["n"] for r in rows if r["y"] == MINORITY)
        large = [c for c in sorted(sizes) if sizes[c] >= self.threshold_quantile * n_min]
        chosen = large[: len(self.lambdas)]
        if not chosen:
            raise ValueError("no majority cluster is large enough")
        drawn = (
            bootstrap_copies(minority, id_col, {c: sizes[c] for c in chosen}, self.seed, n_min)
            .groupBy(id_col)
            .agg(
                F.array(
                    *[F.sum(F.when(F.col("group") == c, F.col("copies")).otherwise(0)) for c in chosen]
                )
                .cast("array<double>")
                .alias("wt")
            )
        )
        none = F.array(*[F.lit(0.0)] * len(chosen))
        here = [quoted(cluster).eqNullSafe(F.lit(c)) for c in chosen]
        own = majority.withColumn("wt", F.array(*[h.cast("double") for h in here])).withColumn(
            "wv", F.array(*[(~h).cast("double") for h in here])
        )
        other = (
            minority.join(drawn, id_col, "left")
            .withColumn("wt", F.coalesce("wt", none))
            .withColumn("wv", F.array(*[F.lit(1.0)] * len(chosen)))
        )
        return own.unionByName(other), chosen

    def fit(
        self, df: DataFrame, features: Sequence[str], label: str, cluster: str, id_col: str
    ) -> EnsembleModel:
        """``cluster`` holds the cluster of each majority row; it is not read on minority rows."""
        weighted, chosen = self.training_weights(df, label, cluster, id_col)
        models = [
            Logistic(gamma=g, lambda_=lam, max_iters=t, reg_norm="l1", seed=self.seed)
            for g, lam, t in zip(self.gammas, self.lambdas, self.max_iters)
        ][: len(chosen)]
        columns = list(range(len(models)))
        table = TrainingTable.build(
            weighted, features, label, weights=(F.col("wt"), F.col("wv"), len(chosen))
        )
        with table.kept(max(m.max_iters for m in models)):
            w, _ = Logistic.train(models, table, columns)
            kernel, size = sums.evaluation_kernel(w, np.array(columns), table.n_weights, True)
            facts = table.sum(kernel, size).reshape(2, 7, len(models))[0]
        scores = tuple(f1_of(*facts[1:4, m]) for m in columns)
        return EnsembleModel(
            tuple(features), w, tuple(chosen[: len(models)]), scores, tuple(1 / (1 + math.exp(-s)) for s in scores)
        )
