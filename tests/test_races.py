"""Starting centres drawn many at a time, against draws one by one in plain NumPy."""

import hashlib
import math

import numpy as np
import pytest

from loomfit.catalog.common import documents
from loomfit.operators import races
from loomfit.operators.kmeans import KMeans, downsample_to_centres


def digest(*parts):
    return hashlib.md5(":".join(str(p) for p in parts if p is not None).encode()).hexdigest()


def one_by_one(ids, points, k, seed, first=None):
    """(-ln u / w, id) decides, rows that are where all centres are take no part, a missing id comes first.

    ``first`` is the first centre, where several rows have its id.
    """

    def draw(t, rows, w):
        u = {i: (int(digest(seed, t, ids[i])[:13], 16) + 0.5) / 2**52 for i in rows}
        return min(rows, key=lambda i: (-math.log(u[i]) / w[i], ids[i] is not None, ids[i] or 0))

    every = range(len(ids))
    if first is None:
        first = points[min(every, key=lambda i: int(digest(seed, 0, ids[i])[:13], 16))]
    chosen = [first]
    w = np.zeros(len(ids))
    for t in range(1, k):
        w = w + np.sqrt(((points - chosen[-1]) ** 2).sum(axis=1))
        rows = [i for i in every if w[i] > 0]
        chosen.append(points[draw(t, rows, w)] if rows else chosen[0])
    return np.array(chosen)


def table(spark, ids, points, kind="long"):
    return spark.createDataFrame([(i, p.tolist()) for i, p in zip(ids, points)], f"id {kind}, f array<double>").repartition(3)


@pytest.fixture(scope="module")
def points():
    rng = np.random.RandomState(8)
    return np.round(rng.lognormal(0, 1.5, size=(400, 2)), 1)  # some are equal, some far off


def test_heads_are_those_of_md5():
    ids = [b"", b"7", "\u00e9t\u00e9".encode(), b"12345678901", b"x" * 47, b"x" * 48, b"y" * 52, b"z" * 200, None]
    for seed in (1, 23, 456, 7890):
        prefixes = [f"{seed}:{step}:".encode() for step in (10, 57, 99)]
        got = races.Messages(ids).heads(prefixes)
        for k, p in enumerate(prefixes):
            for j, i in enumerate(ids):
                want = hashlib.md5(p[:-1] if i is None else p + i).hexdigest()[:8]
                assert f"{got[k, j]:08x}" == want


@pytest.mark.parametrize("dim", [1, 2, 7, 8, 20])
def test_distances_are_added_in_one_order(dim):
    rng = np.random.RandomState(dim)
    x, centres, so_far = rng.normal(size=(50, dim)), rng.normal(size=(30, dim)), rng.uniform(size=50)
    want = so_far.copy()
    for c in centres:
        want += np.sqrt(((x - c) ** 2).sum(axis=1))
    assert np.array_equal(races.summed_distances(x, centres, so_far), want)
    assert np.array_equal(races.exact_weights(x, centres, so_far), want)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_together_is_one_by_one(spark, points, seed):
    ids = list(range(len(points)))
    assert np.array_equal(KMeans(130, seed=seed).start(table(spark, ids, points)), one_by_one(ids, points, 130, seed))


def test_centres_take_few_jobs(spark, points):
    df = table(spark, range(len(points)), points).cache()
    df.count()
    context = spark.sparkContext
    context.setJobGroup("centres", "")
    try:
        KMeans(200).start(df)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("centres")) < 60


@pytest.mark.parametrize("on", ["majority", "all"])
def test_downsampling_to_many_centres(spark, points, on):
    """As many centres as minority rows, in few jobs; with ``all`` minority rows may become centres, too."""
    y = np.where(np.arange(len(points)) % 3, -1, 1)
    rows = [(i, *map(float, p), int(v)) for i, (p, v) in enumerate(zip(points, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int").repartition(3).cache()
    df.count()
    context = spark.sparkContext
    context.setJobGroup(f"down {on}", "")
    try:
        out = downsample_to_centres(df, "id", ["a", "b"], "y", on, max_iter=0)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup(f"down {on}")) < 60
    ids = [i for i in range(len(points)) if on == "all" or y[i] == -1]
    want = one_by_one(ids, points[ids], int((y == 1).sum()), 1)
    got = sorted((r["a"], r["b"]) for r in out.filter("id IS NULL").collect())
    assert got == sorted(map(tuple, want.tolist()))
    assert sorted(r["id"] for r in out.filter("y = 1").collect()) == list(np.flatnonzero(y == 1))


def test_ids_that_repeat_or_are_missing(spark, points):
    ids = [None if i % 50 == 3 else i // 2 for i in range(len(points))] * 2
    rows = np.vstack([points, points])
    got = KMeans(60).start(table(spark, ids, rows))
    assert np.array_equal(got, one_by_one(ids, rows, 60, 1, got[0]))


def test_all_ids_missing(spark, points):
    got = KMeans(9).start(table(spark, [None] * 40, points[:40]))
    assert np.array_equal(got, one_by_one([None] * 40, points[:40], 9, 1, got[0]))


def test_text_ids_of_any_length(spark, points):
    ids = [f"{'row ' * (i % 20)}{i}" for i in range(120)]
    assert np.array_equal(KMeans(50).start(table(spark, ids, points[:120], "string")), one_by_one(ids, points[:120], 50, 1))


def test_tasks_that_can_keep_few_rows(spark, points, monkeypatch):
    ids = [i // 100 for i in range(len(points))]
    monkeypatch.setattr(races, "KEPT_ROWS", 20)
    monkeypatch.setattr(races, "KEPT_PER_DRAW", 0)
    got = KMeans(70).start(table(spark, ids, points))
    assert np.array_equal(got, one_by_one(ids, points, 70, 1, got[0]))


def test_centres_farther_off_than_assumed(spark, points):
    far = np.vstack([points[:200], points[:20] * 1e7])
    ids = list(range(len(far)))
    assert np.array_equal(KMeans(90).start(table(spark, ids, far)), one_by_one(ids, far, 90, 1))


def test_rows_at_one_place(spark):
    same = np.ones((9, 2))
    assert np.array_equal(KMeans(5).start(table(spark, range(9), same)), np.ones((5, 2)))
    two = np.vstack([same, np.zeros((3, 2))])
    assert np.array_equal(KMeans(8).start(table(spark, range(12), two)), one_by_one(list(range(12)), two, 8, 1))


def test_points_without_bounds_are_drawn_one_by_one(spark, points, monkeypatch):
    odd = points[:30].copy()
    odd[4], odd[9, 0], odd[11] = np.inf, -np.inf, 1e300
    got = KMeans(6).start(table(spark, range(30), odd))
    monkeypatch.setattr(KMeans, "_drawn_together", lambda *a: None)
    assert np.array_equal(got, KMeans(6).start(table(spark, range(30), odd)), equal_nan=True)


def test_a_missing_value_is_an_error(spark):
    df = spark.createDataFrame([(i, [1.0, None if i == 7 else float(i)]) for i in range(9)], "id long, f array<double>")
    with pytest.raises(Exception, match="missing value"):
        KMeans(4).start(df)


def test_the_join_of_documents_moves_no_texts(spark, sf):
    plan = documents(spark, sf)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    sides = [plan.children().apply(i).output().mkString(",") for i in range(2)]
    assert all("doc_id#" in side and "text#" not in side for side in sides)
