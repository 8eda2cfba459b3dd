"""Sizes, disjointness and independence of partitioning."""

import hashlib

import pytest
from pyspark.sql import functions as F

from loomfit.operators import ordering, sampling
from loomfit.operators.ordering import id_rank, row_positions, seeded_rank


def labelled(spark, majority, minority):
    return spark.range(majority + minority).select(
        "id", F.when(F.col("id") < majority, -1).otherwise(1).alias("y")
    )


def seeded(ids, seed=1):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


def test_rank_is_the_sorted_order(spark):
    want = {i: k + 1 for k, i in enumerate(seeded(range(500), 4))}
    for parts in (1, 8):
        ranked = seeded_rank(spark.range(500).repartition(parts), "id", 4)
        assert {r["id"]: r["rank"] for r in ranked.collect()} == want


def test_positions_cut_exactly(spark):
    order = seeded(range(300))
    for n in (0, 1, 7, 299, 300, 500):
        df = spark.range(300)
        got = df.filter(row_positions(df, "id").first({0: n})).collect()
        assert {r["id"] for r in got} == set(order[:n])


def test_large_buckets_are_counted_finer(spark, monkeypatch):
    monkeypatch.setattr(ordering, "REFINE_ROWS", 1)
    order = seeded(range(300))
    df = spark.range(300)
    got = df.filter(row_positions(df, "id").first({0: 123})).collect()
    assert {r["id"] for r in got} == set(order[:123])
    folds = sampling.kfold(df, "id", 7).df.collect()
    assert {r["id"]: r["fold"] for r in folds} == {i: k // 42 for k, i in enumerate(order[:294])}


def test_an_id_with_most_rows_is_refused(spark, monkeypatch):
    monkeypatch.setattr(ordering, "REFINE_ROWS", 50)
    df = spark.range(300).select(F.when(F.col("id") < 100, 7).otherwise(F.col("id")).alias("id"))
    ranks = [row_positions(df, "id")]
    with pytest.raises(ValueError, match="unique"):
        ranks[0].cuts({0: list(range(1, 300))})


def test_positions_with_string_ids(spark):
    df = spark.range(50).select(F.concat(F.lit("r"), "id").alias("id"))
    assert df.filter(row_positions(df, "id").first({0: 20})).count() == 20


def test_positions_refuse_many_strata(spark):
    df = spark.range(500)
    with pytest.raises(ValueError, match="strata"):
        row_positions(df, "id", by=F.col("id"))


def test_empty_table(spark):
    empty = spark.range(0)
    train, test = sampling.split(empty, "id", 0.5)
    assert train.count() == test.count() == 0
    assert sampling.downsample(labelled(spark, 0, 0), "id", "y").count() == 0


def test_id_rank_of_uneven_ids(spark):
    df = spark.range(1000).select((F.col("id") * F.col("id") * F.col("id")).alias("id"))
    ranked = id_rank(df, "id", ranges=16)
    assert ranked.filter(F.col("id") != F.pow(F.col("rank") - 1, F.lit(3))).count() == 0


def test_stride(spark):
    got = sampling.stride(spark.range(0, 1000, 2), "id").collect()
    assert sorted(r["id"] for r in got) == list(range(0, 1000, 100))


def test_folds_leave_the_remainder_out(spark):
    folds = sampling.kfold(spark.range(11), "id", 3)
    rows = folds.df.collect()
    assert sorted(r["fold"] for r in rows) == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    order = seeded(range(11))
    assert {r["id"]: r["fold"] for r in rows} == {i: k // 3 for k, i in enumerate(order[:9])}
    assert folds.train(1).count() == 6 and folds.test(1).count() == 3


def test_stratified_folds(spark):
    df = labelled(spark, 13, 5)
    folds = sampling.stratified_upsampled_folds(df, "id", "y", 2)
    rows = folds.df.collect()
    for i in range(2):
        test = [r for r in rows if r["fold"] == i]
        assert sorted(r["y"] for r in test) == [-1] * 6 + [1] * 2
        assert all(r["copies"][i] == 0 for r in test)
        train = folds.train(i)
        counts = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
        assert counts == {-1: 6, 1: 6}
        assert {r["id"] for r in train.collect()}.isdisjoint({r["id"] for r in test})
    again = sampling.stratified_upsampled_folds(df.repartition(5), "id", "y", 2).df
    assert sorted(rows) == sorted(again.collect())


def test_fold_upsampling_keeps_exactly_the_majority_count(spark):
    folds = sampling.stratified_upsampled_folds(labelled(spark, 16, 6), "id", "y", 2)
    copies = [r["copies"] for r in folds.df.filter("y = 1").collect()]
    assert all(max(c) <= 3 for c in copies)
    assert [sum(c[i] for c in copies) for i in range(2)] == [8, 8]


@pytest.mark.parametrize("majority, minority, k, at_once", [(31, 9, 3, 16), (47, 12, 5, 2), (40, 10, 2, 16), (7, 9, 2, 16)])
def test_fold_upsampling_draws_from_all_copies(spark, monkeypatch, majority, minority, k, at_once):
    monkeypatch.setattr(sampling, "FOLDS_AT_ONCE", at_once)
    size = {-1: majority // k, 1: minority // k}
    fold = {i: n // size[-1] for n, i in enumerate(seeded(range(majority))) if n < size[-1] * k}
    fold |= {i: n // size[1] for n, i in enumerate(seeded(range(majority, majority + minority))) if n < size[1] * k}
    want = {i: [int(i < majority and f != fold[i]) for f in range(k)] for i in fold}
    n_copies = -(-size[-1] // size[1])
    for f in range(k):
        copies = [(i, c) for i in fold if i >= majority and fold[i] != f for c in range(1, n_copies + 1)]
        copies.sort(key=lambda d: (hashlib.md5(f"1:{f}:{d[0]}:{d[1]}".encode()).hexdigest(), d[0]))
        for i, _ in copies[: size[-1] * (k - 1)]:
            want[i][f] += 1
    folds = sampling.stratified_upsampled_folds(labelled(spark, majority, minority), "id", "y", k)
    assert {r["id"]: (r["fold"], r["copies"]) for r in folds.df.collect()} == {i: (fold[i], want[i]) for i in fold}


def test_batches_run_over_the_end(spark):
    got = sampling.batches(spark.range(5), "id", 2, 4, shuffle=False).collect()
    by_batch = {b: sorted(r["id"] for r in got if r["batch"] == b) for b in range(4)}
    assert by_batch == {0: [0, 1], 1: [2, 3], 2: [0, 4], 3: [1, 2]}


def test_batches_larger_than_the_table(spark):
    got = sampling.batches(spark.range(3), "id", 7, 2).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in got} == {0: 7, 1: 7}


def test_batches_follow_one_order(spark):
    order = seeded(range(10), 9)
    got = sampling.batches(spark.range(10), "id", 4, 5, seed=9).collect()
    for b in range(5):
        want = sorted(order[k % 10] for k in range(b * 4, b * 4 + 4))
        assert sorted(r["id"] for r in got if r["batch"] == b) == want


def test_upsample(spark):
    out = sampling.upsample_copies(labelled(spark, 7, 3), "id", "y")
    assert sorted(r["copies"] for r in out.filter("y = 1").collect()) == [2, 2, 3]
    rows = sampling.upsample(labelled(spark, 7, 3), "id", "y")
    assert rows.filter("y = 1").count() == rows.filter("y = -1").count() == 7


def test_upsample_below_one_copy(spark):
    rows = sampling.upsample(labelled(spark, 10, 6), "id", "y", ratio=0.25)
    assert rows.filter("y = 1").count() == 2


def test_downsample(spark):
    out = sampling.downsample(labelled(spark, 40, 9), "id", "y")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {-1: 9, 1: 9}
    with pytest.raises(ValueError):
        sampling.downsample(labelled(spark, 3, 9), "id", "y")


def test_bootstrap_draws(spark):
    minority = spark.range(100, 120)
    out = sampling.bootstrap_copies(minority, "id", {0: 50, 7: 1000}, seed=2).collect()
    order = seeded(range(100, 120), 2)
    want = {}
    for group, size in ((0, 50), (7, 1000)):
        for j in range(size):
            h = int(hashlib.md5(f"2:{group}:{j}".encode()).hexdigest()[:13], 16)
            key = (group, order[h % 20])
            want[key] = want.get(key, 0) + 1
    assert {(r["group"], r["id"]): r["copies"] for r in out} == want


def test_gather_and_remove(spark):
    df = spark.range(10)
    picked = spark.createDataFrame([(2, 2), (5, 0), (7, 1)], "id long, copies int")
    assert sorted(r["id"] for r in sampling.gather(df, picked, "id").collect()) == [2, 5, 7]
    assert sorted(r["id"] for r in sampling.gather(df, picked, "id", "copies").collect()) == [2, 2, 7]
    assert sampling.remove(df, picked, "id").count() == 7


def test_many_cuts_compute_one_hash_and_lose_nothing(spark, monkeypatch):
    from loomfit.operators import ordering

    monkeypatch.setattr(ordering, "HEX_DIGITS", 1)
    monkeypatch.setattr(ordering, "REFINE_ROWS", 3)
    monkeypatch.setattr(ordering, "MAX_STRATA", 4)
    df = spark.range(2000)
    k = 12
    positions = ordering.row_positions(df, "id")
    block = positions.block({0: [2000 * (i + 1) // k for i in range(k)]}).alias("block")
    placed = df.select("id", block)
    assert placed._jdf.queryExecution().executedPlan().toString().count("md5(") == 1
    sizes = {r["block"]: r["n"] for r in placed.groupBy("block").agg(F.count("*").alias("n")).collect()}
    assert sizes == {i: 2000 * (i + 1) // k - 2000 * i // k for i in range(k)}


def test_blocks_of_any_number_of_strata(spark, monkeypatch):
    from loomfit.operators import ordering

    monkeypatch.setattr(ordering, "REFINE_ROWS", 10)
    monkeypatch.setattr(ordering, "HEX_DIGITS", 1)
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 83) for i in range(3000)], "id long, s long")
    sizes = {}
    for row in df.groupBy("s").count().collect():
        sizes[row["s"]] = row["count"]
    ends = lambda n: F.array(F.lit(0).cast("long"), F.floor(n / 3), n - 1, n + 5)
    placed = ordering.stratum_blocks(df, "id", F.col("s"), ends).collect()
    ranked = {r["id"]: r["rank"] for r in ordering.seeded_rank(df, "id", by="s").collect()}
    assert len(placed) == 3000
    for row in placed:
        n, rank = sizes[row["s"]], ranked[row["id"]]
        assert row["block"] == sum(end < rank for end in (0, n // 3, n - 1, n + 5)), row


def test_copies_add_up(spark):
    one = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    two = spark.createDataFrame([(1, 5), (3, None), (None, 2)], "id long, copies int")
    got = {tuple(r) for r in sampling.add_copies([one, two], "id").collect()}
    assert got == {(1, 7), (2, 1), (3, 0), (None, 2)}


def test_ranges_of_ids_follow_the_table(spark, monkeypatch):
    from loomfit.operators import ordering

    monkeypatch.setattr(ordering, "RANGE_ROWS", 10)
    df = spark.range(5000).select((F.col("id") * 3 - 700).alias("id")).repartition(7)
    ranked = {r["id"]: r["rank"] for r in ordering.id_rank(df, "id").collect()}
    assert ranked == {i * 3 - 700: i + 1 for i in range(5000)}
    assert [r["id"] for r in sampling.stride(df, "id", 1000).orderBy("id").collect()] == [-700, 2300, 5300, 8300, 11300]


def test_unshuffled_batches_number_only_the_rows_they_use(spark, monkeypatch):
    from loomfit.operators import ordering

    df = spark.range(40_000)
    front = ordering.first_by_id(df, "id", 100, 40_000)
    assert 100 <= front.count() < 200
    got = sampling.batches(df, "id", 50, 2, shuffle=False).collect()
    assert sorted((r["batch"], r["id"]) for r in got) == [(i // 50, i) for i in range(100)]
    monkeypatch.setattr(ordering, "SKETCH_ACCURACY", 2)
    assert ordering.first_by_id(df, "id", 40_000, 40_000).count() == 40_000
