"""The corpus pipeline: from raw documents to training batches.

Each stage works on all rows that the one before it kept; its result is written as Parquet and read again.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomfit.llm import jaccard_join, language_codes, length_buckets, subsequence_toxicity, templates
from loomfit.llm.common import WORD, id_hash, keep, read


OTHERS = "__others"


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a struct of all other columns, so that no name clashes with one that a stage adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(True).alias("__"), *others).alias(OTHERS))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``packed`` put together, in the order given."""
    return rows.select(*[c if c in ("doc_id", "text") else F.col(OTHERS)[c].alias(c) for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity machine, trained on the labels, predicts as toxic.

    Null and empty texts stay. Extra columns of any name are kept.
    """
    model = subsequence_toxicity.fit_on_labels(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    scored = model.score(packed(docs), keep_cols=("doc_id", "text", OTHERS))
    return unpacked(scored.filter("predicted = 0"), docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents without letters, null and empty ones among them, and those whose language is ambiguous.

    Extra columns of any name are kept.
    """
    model = language_codes.LanguageCodes.fit(docs.select("doc_id", "text", "lang").filter(id_hash(F.col("doc_id"), 4) != 2))
    found = model.predict(packed(docs), keep_cols=("doc_id", "text", OTHERS))
    return unpacked(found.filter((F.col("lang_pred") != language_codes.UNKNOWN) & ~F.col("ambiguous")), docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """The packed rows with a column ``key`` of their id and text, ordered by id, null ids last.

    It takes the place of the id, which may be null or shared by several texts. It depends on the row only, so
    it is the same in every read. Only rows with the same id and text have the same key.
    """
    hashes = [F.xxhash64(F.lit(k), "doc_id", "text").alias(f"h{k}") for k in (0, 1)]
    return packed(docs).withColumn("key", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *hashes))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates, and all that are in no group.

    Rows that share an id are a group only if their texts are near duplicates; a null id comes last. Null and
    empty texts stay. Extra columns of any name are kept.
    """
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = keyed(docs.filter(worded))
    found = jaccard_join.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    same = [F.col(f"doc_id.h{k}") == F.col(f"component_id.h{k}") for k in (0, 1)]
    first = found.filter(same[0] & same[1]).select("doc_id.h0", "doc_id.h1").distinct()
    one = rows.select("*", "key.h0", "key.h1").join(first, ["h0", "h1"], "left_semi").dropDuplicates(["h0", "h1"])
    return unpacked(one, docs.columns).union(docs.filter(~worded))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark question, also with other values in it.

    Null and empty texts stay. Extra columns of any name are kept.
    """
    rows = keyed(docs)
    found = templates.leaks(rows.select(F.col("key").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark"))
    leaked = found.select("doc_id.h0", "doc_id.h1").distinct()
    return unpacked(rows.select("*", "key.h0", "key.h1").join(leaked, ["h0", "h1"], "left_anti"), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put every piece of every document into a batch of its length bucket; null and empty texts are pieces of 0."""
    return length_buckets.pack(docs, length_buckets.word_count(F.col("text")))


STAGES = [
    ("toxicity", toxicity),
    ("language_id", language_id),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Trained models and optimal buckets over their result are beyond SQL; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
