"""The pipeline's stages on planted documents and edge rows."""

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from loomfit.llm.common import keep

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def planted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    words = "the quiet river runs by old trees and over many stones to that wide sea of light".split()
    rng = np.random.default_rng(1)
    body = " ".join(rng.choice(words, 200))
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [
        (10**6, body, "en", "s", 1),
        (10**6 + 1, body + " the", "en", "s", 1),
        (10**6 + 2, body, "en", "s", 1),
        (10**6 + 3, " ".join(rng.choice(words, 60)) + ". " + item, "en", "s", 1),
        (10**6 + 4, None, "en", "s", 1),
        (10**6 + 5, "", None, None, None),
        (10**6 + 6, "12 34 ###", "en", "s", 1),
        (10**6 + 7, " ".join(rng.choice(words, 40_000)), "en", "s", 1),
    ]
    clashing = "predicted score margins lang_pred ambiguous key h0 h1 component_id item_id length bucket".split()
    return docs.union(spark.createDataFrame(rows, COLUMNS)).withColumns({c: F.lit(c) for c in clashing})


def test_stages_do_what_they_say(spark, sf, planted):
    ids = {}
    docs = keep(planted)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, sf))
        assert docs.columns == planted.columns
        ids[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    new = {10**6 + k for k in range(8)}
    assert ids["language_id"] & new == {10**6, 10**6 + 1, 10**6 + 2, 10**6 + 3, 10**6 + 7}
    assert ids["jaccard_join"] & new == {10**6, 10**6 + 3, 10**6 + 7}
    assert ids["decontamination"] & new == {10**6, 10**6 + 7}
    packed = corpus_pipeline.packing(spark, docs, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == ids["decontamination"]


def test_stages_keep_null_and_shared_ids(spark, sf):
    words = "the quiet river runs by old trees and over many stones to that wide sea of light".split()
    rng = np.random.default_rng(2)
    a, b, c, d, e, f = (" ".join(rng.choice(words, 120)) for _ in range(6))
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [
        (None, a, "only null", None),
        (None, b, "null beside an id", None),
        (5, b + " the", "id beside a null", None),
        (7, c, "shared 1", None),
        (7, d, "shared 2", None),
        (8, e, "row", None),
        (8, e, "row", None),
        (None, f, "two nulls", None),
        (None, f + " the", "two nulls", None),
        (None, None, "empty", None),
        (None, "", "empty", None),
        (None, f"{d} {c}. {item}", "leak of null", None),
        (9, f"{a} {b}. {item}", "leak of a shared id", None),
        (9, f"{a} {e} {c}", "clean of a shared id", None),
    ]
    docs = keep(spark.createDataFrame([(i, t, "en", s, n) for i, t, s, n in rows], COLUMNS))
    kept = keep(corpus_pipeline.near_duplicates(spark, docs, sf))
    assert kept.columns == docs.columns
    once = {s for _, _, s, _ in rows} - {"null beside an id", "empty"}
    assert sorted(r["source"] for r in kept.collect()) == sorted([*once, "empty", "empty"])
    clean = corpus_pipeline.decontamination(spark, kept, sf)
    leaks = {"leak of null", "leak of a shared id"}
    assert sorted(r["source"] for r in clean.collect()) == sorted([*(once - leaks), "empty", "empty"])


def test_stages_take_empty_tables(spark, sf, planted):
    docs = planted.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "jaccard_join", "decontamination", "packing"]
