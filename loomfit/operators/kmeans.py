"""k-means with spread-out starting points, nearest-centre assignment and centre down-sampling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session
from ..functions.scalars import feature_array, quoted
from ..session import work_folder
from . import races, sums
from .ordering import uniform
from .sampling import MAJORITY, MINORITY, class_counts
from .table import TrainingTable, vector_size

TOLERANCE = 1e-9
WEIGHT_STEPS = 16  # starting centres after which the rows' summed distances are written


def nearest_centre(vector: Column, centres: np.ndarray) -> Column:
    """Index of the nearest centre, ties to the lowest index, over Arrow batches."""
    dim = centres.shape[1]

    @F.arrow_udf("int")
    def index(v: pa.Array) -> pa.Array:
        return pa.array(sums.assign(sums.vectors(v, dim), centres), pa.int32())

    return index(vector.cast("array<double>"))


def nearest_in_pieces(df: DataFrame, vector: str, centres: np.ndarray, name: str = "cluster") -> DataFrame:
    """Add the index of the nearest of many centres.

    The centres are sent to the tasks piece by piece. Each piece improves on the best distance so
    far; between pieces the rows are kept in the shared folder, so a task holds one piece at a time.
    """
    k, dim = centres.shape
    piece = max(1, session.TASK_STATE_BYTES // (8 * dim))
    rows = df.withColumn(name, F.lit(-1)).withColumn("__best", F.lit(float("inf")))
    for first in range(0, k, piece):
        closer = _closer(centres[first : first + piece], first)
        found = rows.withColumn("__near", closer(quoted(vector).cast("array<double>"), "__best", name))
        rows = found.select(
            *[quoted(c) for c in df.columns],
            F.col("__near.j").alias(name),
            F.col("__near.d").alias("__best"),
        )
        if first + piece < k:
            path = work_folder(df.sparkSession)
            rows.write.parquet(path)
            rows = df.sparkSession.read.parquet(path)
    return rows.drop("__best")


def _closer(part: np.ndarray, first: int):
    """Compares the best distance so far with one piece of the centres."""
    dim = part.shape[1]

    @F.arrow_udf("struct<d: double, j: int>")
    def closer(v: pa.Array, best: pa.Array, at: pa.Array) -> pa.Array:
        x = sums.vectors(v, dim)
        index = sums.assign(x, part)
        d = ((x - part[index]) ** 2).sum(axis=1)
        known = best.to_numpy(zero_copy_only=False)
        better = d < known
        nearest = np.where(better, index + first, at.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays(
            [pa.array(np.where(better, d, known)), pa.array(nearest, pa.int32())], names=["d", "j"]
        )

    return closer


def distance_sum(vector: Column, centres: np.ndarray, so_far: Column) -> Column:
    """A number plus the distances of a row to some centres, one after another."""
    dim = centres.shape[1]

    @F.arrow_udf("double")
    def total(v: pa.Array, before: pa.Array) -> pa.Array:
        return pa.array(races.summed_distances(sums.vectors(v, dim), centres, before.to_numpy(zero_copy_only=False)))

    return total(vector, so_far)


def shipped_whole(centres: np.ndarray) -> bool:
    """Whether all centres, and the sums per centre, fit into one pass."""
    return centres.nbytes + 8 * len(centres) <= session.TASK_STATE_BYTES


def means_in_pieces(df: DataFrame, centres: np.ndarray) -> np.ndarray:
    """New centres where there are too many to sum per task: rows are averaged by a shuffle."""
    means = (
        nearest_in_pieces(df.select("f"), "f", centres)
        .select("cluster", F.posexplode("f").alias("pos", "v"))
        .groupBy("cluster", "pos")
        .agg(F.avg("v").alias("v"))
        .toArrow()
    )
    out = centres.copy()
    out[means["cluster"].to_numpy(), means["pos"].to_numpy()] = means["v"].to_numpy()
    return out


@dataclass(frozen=True)
class KMeansModel:
    features: tuple[str, ...] | None
    vector: str | None
    centres: np.ndarray
    last_centres: np.ndarray
    iterations: int

    def _vector(self) -> Column:
        return quoted(self.vector) if self.vector else feature_array(self.features)

    def assign(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        """Add the index of the nearest final centre."""
        return self._nearest(df, self.centres, name)

    def _nearest(self, df: DataFrame, centres: np.ndarray, name: str) -> DataFrame:
        if shipped_whole(centres):
            return df.withColumn(name, nearest_centre(self._vector(), centres))
        return nearest_in_pieces(df.withColumn("__f", self._vector()), "__f", centres, name).drop("__f")

    def training_clusters(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        """Add the index that led to the final centres (nearest centre before the last update)."""
        return self._nearest(df, self.last_centres, name)

    def centre_table(self, spark: SparkSession) -> DataFrame:
        """``(cluster, feature, value)`` rows."""
        names = list(self.features or [str(i) for i in range(self.centres.shape[1])])
        rows = [
            (j, name, float(v)) for j, c in enumerate(self.centres) for name, v in zip(names, c)
        ]
        return spark.createDataFrame(rows, "cluster int, feature string, value double")

    def centre_distances(self, spark: SparkSession) -> DataFrame:
        """``(a, b, distance)`` for all pairs of centres."""
        c = self.centres
        rows = [
            (i, j, float(np.sqrt(((c[i] - c[j]) ** 2).sum()))) for i in range(len(c)) for j in range(len(c))
        ]
        return spark.createDataFrame(rows, "a int, b int, distance double")


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n"))


def cluster_means(df: DataFrame, vector: str, cluster: str, centres: DataFrame) -> DataFrame:
    """New centres as a table: per cluster and dimension the mean, else the old value.

    ``centres`` has ``(cluster, pos, value)`` rows. Rows are averaged per cluster and dimension with
    map-side partial sums, so a cluster holding most rows is no hot spot.
    """
    means = (
        df.select(quoted(cluster).alias("cluster"), F.posexplode(quoted(vector)).alias("pos", "v"))
        .groupBy("cluster", "pos")
        .agg(F.avg("v").alias("mean"))
    )
    return centres.join(means, ["cluster", "pos"], "left").select(
        "cluster", "pos", F.coalesce("mean", "value").alias("value")
    )


def _over_all_cores(df: DataFrame) -> DataFrame:
    """The table in as many pieces as there are cores at least: its rows are few bytes, but much work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


@dataclass(frozen=True)
class KMeans:
    """Lloyd iterations; an empty cluster keeps its centre.

    Starting centres are drawn row by row with probability proportional to the summed distance to
    the centres chosen so far (``init="spread"``), or given as an array.
    """

    n_clusters: int = 8
    max_iter: int = 300
    seed: int = 1
    init: str | np.ndarray | Sequence[Sequence[float]] = "spread"

    def fit(self, df: DataFrame, features: Sequence[str] | str, id_col: str | None = None) -> KMeansModel:
        """``features`` are column names, or the name of one vector column."""
        names, vector = (None, features) if isinstance(features, str) else (tuple(features), None)
        column = quoted(vector).cast("array<double>") if vector else feature_array(names)
        dim = vector_size(df, vector) if vector else len(names)
        given = not isinstance(self.init, str)
        if not given and self.init != "spread":
            raise ValueError("init is `spread` or an array of centres")
        if not given and id_col is None:
            raise ValueError("seeded starting centres need an id column")
        keep = [] if given else [quoted(id_col).alias("id")]
        table = TrainingTable(
            df.select(column.alias("f"), *keep), dim, has_id=bool(keep)
        )
        with table.kept(min(self.max_iter, 20) + (0 if given else self.n_clusters)):
            centres = np.array(self.init, dtype=float) if given else self.start(table.df)
            last, iteration, moved = centres, 0, np.inf
            while iteration < self.max_iter and moved > TOLERANCE:
                last = centres
                if shipped_whole(centres):
                    kernel, size = sums.cluster_kernel(centres)
                    flat = table.sum(kernel, size)
                    k = len(centres)
                    n, total = flat[:k, None], flat[k:].reshape(k, dim)
                    centres = np.where(n > 0, total / np.maximum(n, 1), last)
                else:
                    centres = means_in_pieces(table.df, last)
                moved = np.abs(centres - last).max()
                iteration += 1
        return KMeansModel(names, vector, centres, last, iteration)

    def start(self, df: DataFrame) -> np.ndarray:
        """Seeded starting centres from ``(f, id)`` rows.

        A row's weight is the sum of its distances to the centres so far. It is a column that grows by the newest
        centres only: the weights are written to the shared folder once there are WEIGHT_STEPS newer centres, and a
        pass adds the distances to the centres since then. A pass draws as many centres as there are already, or as
        the driver can hold the rows for.
        """
        spark = df.sparkSession
        spark.sparkContext.setJobDescription("starting centre 1")
        first = df.agg(F.min_by("f", F.struct(uniform(f"{self.seed}:0", F.col("id")), "id")))
        chosen = [first.first()[0]]
        weighted, done, together = df.withColumn("weight", F.lit(0.0)), 0, True
        try:
            while len(chosen) < self.n_clusters:
                if len(chosen) - done > WEIGHT_STEPS:
                    path = work_folder(spark)
                    newest = np.array(chosen[done:])
                    weighted.withColumn("weight", distance_sum(F.col("f"), newest, F.col("weight"))).write.parquet(path)
                    weighted, done = _over_all_cores(spark.read.parquet(path)), len(chosen)
                held = session.BATCH_ROWS_BYTES // (32 * (len(chosen[0]) + 4))
                draws = min(len(chosen), self.n_clusters - len(chosen), max(1, held))
                spark.sparkContext.setJobDescription(
                    f"starting centres {len(chosen) + 1} to {len(chosen) + draws} of {self.n_clusters}"
                )
                more = self._drawn_together(weighted, chosen, done, draws) if together else None
                if more is None:
                    together = False
                    more = [self._drawn(weighted, chosen, done)]
                if more[-1] is None:  # every row is where a centre is, and so they stay
                    more[-1:] = [chosen[0]] * (self.n_clusters - len(chosen) - len(more) + 1)
                chosen += more
        finally:
            spark.sparkContext.setJobDescription(None)
        return np.array(chosen, dtype=float)

    def _drawn(self, weighted: DataFrame, chosen: list, done: int) -> list[float] | None:
        """The next centre, by an aggregate of its own; None if no row has a weight."""
        since = np.array(chosen[done:]).reshape(-1, len(chosen[0]))
        weight = distance_sum(F.col("f"), since, F.col("weight"))
        race = -F.ln(uniform(f"{self.seed}:{len(chosen)}", F.col("id"))) / F.col("weight")
        return (
            weighted.withColumn("weight", weight)
            .filter(F.col("weight") > 0)
            .agg(F.min_by("f", F.struct(race, "id")))
            .first()[0]
        )

    def _drawn_together(self, weighted: DataFrame, chosen: list, done: int, draws: int) -> list | None:
        """The next centres, one at least and at most ``draws``, in one pass.

        The tasks keep the few rows that can win a draw (see ``races``), whose races are run off here, with their
        exact weights. None if some weight has no bound; None as the centre if no row has a weight.
        """
        first, so_far = len(chosen), np.array(chosen, dtype=float)
        middle = so_far.mean(axis=0)
        apart = np.sqrt(((so_far - middle) ** 2).sum(axis=1))
        each, once = 1.5 * apart.mean(), 4 * apart.max()
        kernel = races.can_win(self.seed, first, draws, so_far[done:], middle, each, once)
        kind = weighted.schema["id"].dataType.simpleString()
        kept = (
            weighted.select("id", "f", "weight", F.col("id").cast("string").alias("key"))
            .mapInArrow(kernel, f"step int, id {kind}, f array<double>, weight double, low double, high double")
            .withColumn("winner", F.min("high").over(Window.partitionBy("step")))
            .filter("f IS NULL OR low <= winner")
            .select("step", "id", "f", "weight", (-F.ln(uniform(self.seed, F.col("step"), F.col("id")))).alias("time"))
            .toArrow()
            .sort_by("step")
            .combine_chunks()
        )
        left_out = kept.filter(kept["f"].is_null())["step"].to_numpy()
        draws = min([draws, *(left_out - first)])
        if draws == 0:
            return None
        kept = kept.filter(kept["f"].is_valid()).combine_chunks()
        if not kept.num_rows or kept["step"][0].as_py() > first:
            return [None]
        rows = np.searchsorted(kept["step"].to_numpy(), np.arange(first, first + draws + 1))
        x = np.array(kept["f"].combine_chunks().flatten()).reshape(-1, so_far.shape[1])
        weight, time = kept["weight"].to_numpy(), kept["time"].to_numpy()
        new, away = np.empty((draws, so_far.shape[1])), 0.0
        for t in range(draws):
            if t and away > t * each + once:  # the tasks' bounds hold no longer
                return new[:t].tolist()
            at = slice(rows[t], rows[t + 1])
            w = races.exact_weights(x[at], new[:t], weight[at])
            race = np.where(w > 0, time[at] / np.where(w > 0, w, 1.0), np.inf)
            ties = rows[t] + np.flatnonzero(race == race.min())
            best = ties[0]
            if len(ties) > 1:
                ids = kept["id"].take(pa.array(ties)).to_pylist()
                best = min(zip(ids, ties), key=lambda tie: (tie[0] is not None, tie[0], tie[1]))[1]
            new[t] = x[best]
            away += np.sqrt(((new[t] - middle) ** 2).sum())
        return new.tolist()


def downsample_to_centres(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    label: str,
    cluster_on: str = "majority",
    max_iter: int = 100,
    seed: int = 1,
    init: str | np.ndarray = "spread",
) -> DataFrame:
    """Minority rows plus as many k-means centres standing in for the majority.

    ``cluster_on`` is "majority", or "all" to cluster every row. Centres have no id. The cost is
    rows x minority rows per iteration by definition of the operator.
    """
    if cluster_on not in ("majority", "all"):
        raise ValueError("cluster_on is `majority` or `all`")
    k = class_counts(df, label).get(MINORITY, 0)
    rows = df.filter(quoted(label) == MAJORITY) if cluster_on == "majority" else df
    model = KMeans(k, max_iter, seed, init).fit(rows, features, id_col)
    spark = df.sparkSession
    schema = ", ".join(f"`{c}` double" for c in features)
    centres = spark.createDataFrame([tuple(map(float, c)) for c in model.centres], schema)
    minority = df.filter(quoted(label) == MINORITY).select(
        quoted(id_col), *[quoted(c).cast("double").alias(c) for c in features], quoted(label).cast("int").alias(label)
    )
    return minority.unionByName(
        centres.withColumn(label, F.lit(MAJORITY)).withColumn(id_col, F.lit(None).cast(df.schema[id_col].dataType))
    )
