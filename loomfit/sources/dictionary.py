"""The column dictionary: which columns are continuous or useless, and what answers mean."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Answers with one of these meanings count as missing.
MISSING_MEANINGS = (
    "Don’t know/Not sure",
    "None",
    "Refused",
    "Refused/Missing",
    "Refused----Go to next module",
    "Don’t know/Not sure----Go to next module",
    "Don’t know/Not Sure Or Refused/Missing",
    "Don’t know/Not Sure/Refused/Missing",
    "Don’t know/Not Sure, Refused or Missing",
    "Don’t know/Refused/Missing",
    "Don’t know/Not Sure/Refused",
    "Don’t know / Not sure",
    "Don’t know/Not Sure",
    "Don’t know/Not sure/Missing",
    "Don’t know/Not sure/Refused",
    "Not applicable",
    "Don't Know/Not Sure",
    "Don’t know/Not sure/Refused/Missing",
    "Don ́t know, refused or missing values",
    "Never heard of ‘‘A one C’’ test",
    "Zero (none)",
)
BLANK = "BLANK"  # fixed value: the answer code that stands for an empty field


@dataclass(frozen=True)
class ColumnSpec:
    """Roles of columns. ``keys`` (ids, labels) are carried along and are never features."""

    continuous: Sequence[str] = ()
    useless: Sequence[str] = ()
    signification: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    keys: Sequence[str] = ()

    @classmethod
    def from_json(cls, spark: SparkSession, path: str, keys: Sequence[str] = ()) -> "ColumnSpec":
        """Load the dictionary file: ``continuous_predictors``, ``useless_predictors`` and
        ``signification`` -> column -> ``Values`` -> answer -> meaning."""
        text = "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
        raw = json.loads(text)
        meanings = {c: entry["Values"] for c, entry in raw.get("signification", {}).items()}
        return cls(raw["continuous_predictors"], raw["useless_predictors"], meanings, keys)

    def features(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in self.keys]

    def continuous_in(self, columns: Sequence[str]) -> list[str]:
        return [c for c in self.features(columns) if c in self.continuous]

    def categorical_in(self, columns: Sequence[str]) -> list[str]:
        return [c for c in self.features(columns) if c not in self.continuous]

    def useless_in(self, columns: Sequence[str]) -> list[str]:
        return [c for c in self.features(columns) if c in self.useless]

    def missing_codes(self, column: str) -> list[float]:
        """Answer codes of a column that mean "missing"."""
        answers = self.signification.get(column, {})
        return sorted({float(a) for a, m in answers.items() if m in MISSING_MEANINGS and a != BLANK})

    def answer_table(self, spark: SparkSession) -> DataFrame:
        """``(col, answer, meaning)`` rows."""
        rows = [(c, a, m) for c, answers in self.signification.items() for a, m in answers.items()]
        return spark.createDataFrame(rows, "col string, answer string, meaning string")


def read_answer_table(spark: SparkSession, path: str) -> DataFrame:
    """``(col, answer, meaning)`` rows straight from the dictionary file."""
    schema = "signification map<string, struct<Values: map<string, string>>>"
    return (
        spark.read.schema(schema)
        .json(path, multiLine=True)
        .select(F.explode("signification").alias("col", "entry"))
        .select("col", F.explode("entry.Values").alias("answer", "meaning"))
    )


def codes_from_answers(answers: DataFrame) -> DataFrame:
    """Per column, the numeric codes that mean "missing"; for dictionaries joined as tables."""
    return answers.filter(
        F.col("meaning").isin(*MISSING_MEANINGS) & (F.col("answer") != BLANK)
    ).select("col", F.col("answer").try_cast("double").alias("code")).distinct()


def recode_by_dictionary(df: DataFrame, columns: Sequence[str], codes: DataFrame) -> DataFrame:
    """Set the answers to NULL that a dictionary kept as a table calls missing.

    ``codes`` has ``(col, code)`` rows, as ``codes_from_answers`` gives them. Answers are compared as
    numbers; those that are none, and null, stay as they are. Rows are neither lost nor repeated.
    """
    for i, name in enumerate(columns):
        own = codes.filter(F.col("col") == name).select(F.col("code").alias(f"__code{i}")).distinct()
        answer = F.col("`" + name.replace("`", "``") + "`")
        hit = df.join(own, answer.try_cast("double") == F.col(f"__code{i}"), "left")
        df = hit.withColumn(name, F.when(F.col(f"__code{i}").isNull(), answer)).drop(f"__code{i}")
    return df
