"""k-means against plain NumPy, ties and empty clusters."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfit import session
from loomfit.operators.kmeans import KMeans, cluster_sizes, downsample_to_centres, nearest_centre


@pytest.fixture(scope="module")
def points():
    rng = np.random.RandomState(3)
    return np.concatenate([rng.normal(c, 0.3, size=(40, 2)) for c in ((0, 0), (3, 3), (0, 4))])


@pytest.fixture(scope="module")
def df(spark, points):
    rows = [(i, *map(float, p), -1 if i % 10 else 1) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, a double, b double, y int").repartition(4)


def lloyd(x, centres, steps):
    centres = np.array(centres, dtype=float)
    last = None
    for _ in range(steps):
        last = ((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[last == j].mean(axis=0) if (last == j).any() else c for j, c in enumerate(centres)])
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres, last


def test_lloyd(df, points):
    first = points[[0, 1, 2]]
    model = KMeans(3, 50, init=first).fit(df, ["a", "b"])
    want, last = lloyd(points, first, 50)
    assert np.allclose(model.centres, want)
    got = {r["id"]: r["cluster"] for r in model.training_clusters(df).collect()}
    assert [got[i] for i in range(len(points))] == list(last)
    assert sum(r["n"] for r in cluster_sizes(model.assign(df)).collect()) == len(points)


def test_training_index_is_from_before_the_last_update(df, points):
    first = points[[0, 1, 2]]
    model = KMeans(3, 2, init=first).fit(df, ["a", "b"])
    _, last = lloyd(points, first, 2)
    got = {r["id"]: r["cluster"] for r in model.training_clusters(df).collect()}
    assert [got[i] for i in range(len(points))] == list(last)


def test_start_is_the_seeded_race(df, points):
    def u(tag, i):
        return (int(hashlib.md5(f"5:{tag}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52

    ids = range(len(points))
    chosen = [points[min(ids, key=lambda i: (u(0, i), i))]]
    for t in (1, 2):
        w = sum(np.linalg.norm(points - c, axis=1) for c in chosen)
        open_ = [i for i in ids if w[i] > 0]
        chosen.append(points[min(open_, key=lambda i: (-np.log(u(t, i)) / w[i], i))])
    model = KMeans(3, 0, seed=5).fit(df, ["a", "b"], "id")
    assert np.allclose(model.centres, chosen)
    model = KMeans(3, 100, seed=5).fit(df, ["a", "b"], "id")
    assert np.allclose(model.centres, lloyd(points, chosen, 100)[0])


def test_centres_in_pieces(df, points, monkeypatch):
    """Centres sent piece by piece give the same clusters as centres sent whole."""
    first = np.vstack([points[:7], [[500.0, 500.0]]])
    want, last = lloyd(points, first, 3)
    monkeypatch.setattr(session, "TASK_STATE_BYTES", 3 * 2 * 8)
    model = KMeans(8, 3, init=first).fit(df, ["a", "b"])
    assert np.allclose(model.centres, want)
    got = {r["id"]: r["cluster"] for r in model.training_clusters(df).collect()}
    assert [got[i] for i in range(len(points))] == list(last)


def test_tie_goes_to_the_first_centre(spark):
    df = spark.createDataFrame([([0.0, 0.0],)], "v array<double>")
    centres = np.array([[9.0, 9.0], [1.0, 0.0], [0.0, 1.0]])
    assert df.select(nearest_centre(F.col("v"), centres)).first()[0] == 1


def test_empty_cluster_keeps_its_centre(df):
    model = KMeans(3, 5, init=[[0, 0], [3, 3], [500, 500]]).fit(df, ["a", "b"])
    assert list(model.centres[2]) == [500, 500]


def test_one_cluster(df, points):
    model = KMeans(1, 5, init=[[9, 9]]).fit(df, ["a", "b"])
    assert np.allclose(model.centres, [points.mean(axis=0)])


@pytest.mark.parametrize("on", ["majority", "all"])
def test_downsample_to_centres(df, points, on):
    y = np.array([-1 if i % 10 else 1 for i in range(len(points))])
    x = points[y == -1] if on == "majority" else points
    first = x[:12]
    out = downsample_to_centres(df, "id", ["a", "b"], "y", on, 4, init=first)
    assert out.filter("y = 1").count() == out.filter("y = -1").count() == 12
    got = sorted((r["a"], r["b"]) for r in out.filter("id IS NULL").collect())
    assert np.allclose(got, sorted(map(tuple, lloyd(x, first, 4)[0])))


def test_bad_settings(df):
    with pytest.raises(ValueError):
        KMeans(2, init="random").fit(df, ["a", "b"], "id")
    with pytest.raises(ValueError):
        KMeans(2).fit(df, ["a", "b"])
    with pytest.raises(ValueError):
        downsample_to_centres(df, "id", ["a", "b"], "y", "minority")


def test_nearest_by_products_is_the_nearest_by_coordinates():
    from loomfit.operators import sums

    rng = np.random.RandomState(4)
    for scale, offset in ((1, 0), (1e-3, 1e6), (1e3, 0)):
        centres = np.round(rng.normal(size=(37, 5)), 1) * scale + offset
        centres[20] = centres[3]
        x = np.vstack([np.round(rng.normal(size=(400, 5)), 1) * scale + offset, centres, (centres[1:] + centres[:-1]) / 2])
        gap = (x[:, None, :] - centres[None]).reshape(-1, 5)
        gaps = np.einsum("ij,ij->i", gap, gap).reshape(len(x), -1)
        got = sums.assign(x, centres)
        assert np.array_equal(gaps[np.arange(len(x)), got], gaps.min(axis=1))
        assert (got[400:437] <= np.arange(37)).all() and got[420] == 3


def test_weights_written_between_draws_change_nothing(df, monkeypatch):
    from loomfit.operators import kmeans

    want = KMeans(9, 0, seed=2).fit(df, ["a", "b"], "id").centres
    monkeypatch.setattr(kmeans, "WEIGHT_STEPS", 2)
    assert np.array_equal(KMeans(9, 0, seed=2).fit(df, ["a", "b"], "id").centres, want)
