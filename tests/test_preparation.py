"""Edge tables for the preparation steps."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomfit.functions import statistics as st
from loomfit.plans import preparation as prep
from loomfit.session import work_folder
from loomfit.sources import tables
from loomfit.sources.dictionary import ColumnSpec, codes_from_answers, read_answer_table, recode_by_dictionary


def values(df, column):
    return [r[0] for r in df.select(F.col("`" + column + "`")).collect()]


def test_missing_at_the_threshold(spark):
    rows = [(1.0 if i == 0 else None, 1.0 if i < 2 else None, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "at double, below double, full double")
    for spec in (ColumnSpec(), ColumnSpec(continuous=("at", "below", "full"))):
        assert prep.DropMostlyMissing().fit_transform(df, spec).columns == ["below", "full"]
    kept = prep.DropMostlyMissing(share_categorical=1.0).fit_transform(df, ColumnSpec())
    assert kept.columns == ["at", "below", "full"]


def test_constant_and_all_missing(spark):
    rows = [(3.0, None, float(i), "a", "a" if i else "b") for i in range(5)]
    df = spark.createDataFrame(rows, "flat double, none double, x double, one string, two string")
    assert prep.DropConstant().fit_transform(df, ColumnSpec()).columns == ["none", "x", "two"]


def test_proportional(spark):
    rows = [(float(i), 2.0 * i, 3.0 * i + 1, -1.0 * i, 5.0) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, flat double")
    assert prep.DropProportional().fit_transform(df, ColumnSpec()).columns == ["c", "d", "flat"]


def test_one_hot_with_missing_and_unseen(spark):
    train = spark.createDataFrame([(1.0, 9.0), (2.0, 8.0), (None, 7.0)], "c double, x double")
    spec = ColumnSpec(continuous=("x",))
    fitted = prep.OneHot().fit(train, spec)
    assert fitted.transform(train).columns == ["x", "c__1.0", "c__2.0", "c__nan"]
    dropped = prep.OneHot(drop_last=True).fit(train, spec)
    assert dropped.transform(train).columns == ["x", "c__1.0", "c__2.0"]
    unseen = spark.createDataFrame([(3.0, 0.0)], "c double, x double")
    assert fitted.transform(unseen).first()[1:] == (0.0, 0.0, 0.0)


def test_one_hot_quotes_odd_values(spark):
    odd = ["it's", 'a "b"', "back\\slash", "tick`s", "é"]
    df = spark.createDataFrame([(v,) for v in odd], "c string")
    out = prep.OneHot().fit_transform(df, ColumnSpec())
    assert len(out.columns) == len(odd)
    assert sorted(sum(r) for r in out.collect()) == [1.0] * len(odd)


def test_one_hot_beyond_the_limit_is_a_sparse_vector(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("c"))
    out = prep.OneHot(max_classes=20).fit_transform(df, ColumnSpec())
    assert out.columns == ["c__classes"] and out.count() == 30


def test_recode_keeps_missing_and_ignores_blank(spark, tmp_path):
    raw = {
        "continuous_predictors": ["q"],
        "useless_predictors": ["u"],
        "signification": {"q": {"Values": {"77": "Refused", "88": "None", "1": "Yes", "BLANK": "Refused"}}},
    }
    path = tmp_path / "dictionary.json"
    path.write_text(json.dumps(raw))
    spec = ColumnSpec.from_json(spark, str(path))
    assert spec.missing_codes("q") == [77.0, 88.0]
    df = spark.createDataFrame([(77.0, 1), (88.0, 1), (1.0, 1), (None, 1)], "q double, u int")
    steps = prep.Pipeline([prep.DropUseless(), prep.RecodeMissing()])
    assert values(steps.fit_transform(df, spec), "q") == [None, None, 1.0, None]
    codes = codes_from_answers(read_answer_table(spark, str(path)))
    assert sorted(r["code"] for r in codes.collect()) == [77.0, 88.0]


def test_unknown_strategy():
    with pytest.raises(ValueError):
        prep.Impute("mode")


@pytest.mark.parametrize("n", [1, 2, 5, 6])
def test_median_of_few(spark, n):
    numbers = [10.0, -3.0, 7.5, 7.5, 1e9, 0.25][:n]
    df = spark.createDataFrame([(v,) for v in numbers] + [(None,)], "x double")
    middle = sorted(numbers)
    want = (middle[(n - 1) // 2] + middle[n // 2]) / 2
    assert st.medians(df, ["x"], st.profile(df, ["x"])) == {"x": want}


def test_median_of_skewed_values(spark):
    df = spark.range(1, 20001).select((F.exp(F.col("id") / 1000.0) * 1e-3).alias("x"))
    want = df.agg(F.percentile("x", F.lit(0.5))).first()[0]
    got = st.medians(df, ["x"], st.profile(df, ["x"]))["x"]
    assert got == pytest.approx(want, rel=1e-12)


def test_median_when_one_value_holds_most_rows(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5).cast("double").alias("x"))
    assert st.medians(df, ["x"], st.profile(df, ["x"]))["x"] == 5.0


def test_draws_follow_the_frequencies(spark):
    df = spark.range(6000).select(
        "id", F.when(F.col("id") < 3000, F.when(F.col("id") < 600, "a").otherwise("b")).alias("c")
    )
    spec = ColumnSpec(keys=("id",))
    out = prep.Impute("distributions").fit_transform(df, spec)
    assert out.filter("c IS NULL").count() == 0
    drawn = out.filter("id >= 3000 AND c = 'a'").count() / 3000
    assert drawn == pytest.approx(0.2, abs=0.03)
    again = prep.Impute("distributions").fit_transform(df.repartition(7), spec)
    assert sorted(out.collect()) == sorted(again.collect())


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 5.0)], "x double, flat double")
    with pytest.raises(ValueError, match="flat"):
        prep.Standardise().fit(df, ColumnSpec(continuous=("x", "flat")))
    with pytest.raises(ValueError, match="missing"):
        prep.Standardise(allow_missing=False).fit(df, ColumnSpec(continuous=("x",)))
    out = prep.Standardise().fit_transform(df, ColumnSpec(continuous=("x",)))
    assert values(out, "x") == [-1.0, 1.0, None]


def test_powers_order(spark):
    df = spark.createDataFrame([(1, 2.0, "k", 3.0)], "id int, a double, c string, b double")
    out = prep.Powers(3).fit_transform(df, ColumnSpec(continuous=("a", "b"), keys=("id",)))
    assert out.columns == ["id", "c", "a", "b", "a__^2", "b__^2", "a__^3", "b__^3"]
    assert out.first()[2:] == (2.0, 3.0, 4.0, 9.0, 8.0, 27.0)


def test_pipeline_profile_equals_separate_fits(spark):
    """Carrying the profile through the steps gives what fitting every step afresh gives."""
    df = spark.range(400).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.sqrt("id")).alias("x"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 11).cast("double").alias("z"),
        F.concat(F.lit("k"), F.col("id") % 3).alias("c"),
        F.lit(1.0).alias("flat"),
    )
    spec = ColumnSpec(continuous=("x", "z"), keys=("id",))
    steps = prep.survey_pipeline().steps
    together = prep.Pipeline(steps).fit_transform(df, spec)
    apart = df
    for step in steps:
        apart = step.fit_transform(apart, spec)
    assert together.columns == apart.columns
    for a, b in zip(sorted(together.collect()), sorted(apart.collect())):
        assert a == pytest.approx(b, abs=1e-9)


def test_pipeline_scans(spark):
    """One profiling pass serves all steps of a pipeline."""
    calls = []
    plain = st.profile

    def counted(df, columns):
        calls.append(list(columns))
        return plain(df, columns)

    st.profile = counted
    try:
        df = spark.range(50).select("id", F.sqrt("id").alias("x"), F.lower(F.lit("A")).alias("c"))
        prep.survey_pipeline().fit(df.withColumn("c", F.when(F.col("id") > 9, "b").otherwise("a")), ColumnSpec(("x",), keys=("id",)))
    finally:
        st.profile = plain
    assert len(calls) == 1


def test_sink_rejects_other_values(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0), (2, 0.0)], "id long, p double")
    with pytest.raises(ValueError, match="1 predictions"):
        tables.write_predictions(df, "id", "p", str(tmp_path / "out"))
    tables.write_predictions(df.filter("p = 1"), "id", "p", str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).collect()[0].asDict() == {"Id": "1", "Prediction": "1"}


def test_blank_fields_are_missing(spark):
    path = work_folder(spark)
    spark.createDataFrame([("Id,a.b,c",), ("1,,2.5",), ("2,3,NaN",)], "v string").coalesce(1).write.text(path)
    df = tables.read_features(spark, path)
    assert df.columns == ["Id", "a.b", "c"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, None, 2.5), (2, 3.0, None)]
    assert tables.column_names(spark, path) == ["a.b", "c"]


def test_load_once_reads_the_copy(spark):
    path = work_folder(spark)
    first = tables.load_once(spark.range(5), path)
    second = tables.load_once(spark.range(5).filter("id < 0"), path)
    assert first.count() == second.count() == 5


def test_load_once_refuses_a_broken_copy(spark, tmp_path):
    (tmp_path / "copy" / "_temporary").mkdir(parents=True)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.load_once(spark.range(5), str(tmp_path / "copy"))


def test_median_with_infinity_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    for values, want in (
        ([1.0, 2.0, 3.0, inf], 2.5),
        ([1.0, 2.0, 3.0, nan], 2.0),
        ([-inf, -inf, 5.0, inf], -inf),
        ([5e-324, 1e-323, 1.5e-323], 1e-323),
    ):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert st.medians(df, ["x"], st.profile(df, ["x"]))["x"] == want


def test_recode_text_answers(spark):
    from loomfit.plans.preparation import Pipeline, RecodeMissing
    from loomfit.sources.dictionary import ColumnSpec

    spec = ColumnSpec(("a",), (), {"a": {"7": "Refused", "7.0": "Refused"}}, ())
    df = spark.createDataFrame([("x",), ("7",), (None,), ("8",)], "a string")
    got = Pipeline([RecodeMissing()]).fit_transform(df, spec).collect()
    assert [r["a"] for r in got] == ["x", None, None, "8"]


def test_order_statistics_are_exact_even_if_the_sketch_is_off(spark, monkeypatch):
    rng = np.random.RandomState(2)
    values = [float(v) for v in np.concatenate([rng.normal(size=500), np.full(300, 0.25), [np.inf] * 40, [-np.inf] * 9])]
    df = spark.createDataFrame([(v,) for v in values] + [(float("nan"),), (None,)], "a double")
    known = st.profile(df, ["a"])
    ranks = [0, 8, 9, 400, 424, len(values) - 1]
    want = {("a", r): sorted(values)[r] for r in ranks}
    assert st.order_statistics(df, {"a": ranks}, known) == want
    monkeypatch.setattr(st, "_bounds", lambda rank, known: (0.9, 0.95))
    assert st.order_statistics(df, {"a": ranks}, known) == want


def test_classes_as_a_table(spark):
    rows = [(i, None if i % 9 == 0 else f"k{i % 40:02d}", None if i % 7 == 0 else float(i % 30)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, s string, x double")
    found = {(r["c"], r["v"], r["s"]): (r["n"], r["code"], r["upto"], r["total"]) for r in st.class_table(df, ["s", "x"]).collect()}
    for c, column in enumerate(("s", "x")):
        values = [r[c + 1] for r in rows]
        present = sorted({v for v in values if v is not None})
        upto = 0
        for code, value in enumerate(present):
            n = values.count(value)
            upto += n
            key = (c, value, None) if c else (c, None, value)
            assert found.pop(key) == (n, code, upto, sum(v is not None for v in values))
        assert found.pop((c, None, None))[:2] == (values.count(None), len(present))
    assert not found
    codes = {r["id"]: r["code"] for r in st.class_codes(df, "x").collect()}
    assert codes == {i: 30 if x is None else int(x) for i, _, x in rows}


def test_wide_one_hot_equals_narrow(spark):
    from pyspark.ml.functions import vector_to_array

    seen = spark.createDataFrame([(i, None if i % 5 == 0 else f"k{i % 7}") for i in range(40)], "id long, s string")
    new = seen.union(spark.createDataFrame([(99, "unseen")], "id long, s string"))
    spec = ColumnSpec(keys=("id",))
    for drop_last in (False, True):
        narrow = prep.OneHot(drop_last).fit(seen, spec).transform(new).collect()
        wide = prep.OneHot(drop_last, max_classes=3).fit(seen, spec).transform(new)
        got = {r["id"]: r["v"] for r in wide.select("id", vector_to_array("s__classes").alias("v")).collect()}
        assert got == {r["id"]: list(r)[1:] for r in narrow}


def test_dictionary_lookup_keeps_every_row(spark):
    codes = spark.createDataFrame([("a", 7.0), ("a", 7.0), ("b", 9.0)], "col string, code double")
    df = spark.createDataFrame([("7", 9), ("x", 7), (None, None), ("7.0", 1)], "a string, b int")
    got = recode_by_dictionary(df, ["a", "b"], codes).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, None), ("x", 7), (None, None), (None, 1)], key=str)
