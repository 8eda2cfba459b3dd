"""Quality rules: a threshold table compiled into one projection of built-in functions.

Each rule bounds one measure of a text. The measures are expressions, and the table compiles into
one verdict column, so documents are read once and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, query, read

# Function words of the languages that the corpus may hold.
STOP_WORDS = tuple(
    "the of and to in a is that for it as was with be by on not he are this have from or an at "
    "der die das und zu den mit von ist nicht ein eine einer für auf "
    "le la les de des et en un une du que qui dans pour par sur au est pas "
    "el los las y con para al del se no una por como".split()
)
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words


@dataclass(frozen=True)
class Rule:
    """A measure and the range in which a text is kept; None is no bound."""

    measure: str
    at_least: float | None = None
    at_most: float | None = None

    def broken(self) -> Column:
        value = F.col(self.measure)
        low = F.lit(False) if self.at_least is None else value < self.at_least
        high = F.lit(False) if self.at_most is None else value > self.at_most
        return low | high


RULES = (
    Rule("n_words", at_least=MIN_WORDS),
    Rule("mean_word_chars", at_least=2, at_most=14),
    Rule("symbol_ratio", at_most=0.1),
    Rule("shout_ratio", at_most=0.25),
    Rule("stop_word_ratio", at_least=0.01),
    Rule("dup_line_ratio", at_most=0.3),
    Rule("bullet_line_ratio", at_most=0.9),
    Rule("ellipsis_line_ratio", at_most=0.3),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with all measures; other columns are left behind.

    A null text counts as an empty one: all counts and ratios are 0. Whole texts are measured. Windows
    of words are compared by 64-bit hashes: only texts in which some hash repeats are sorted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("__text")).select(
        "doc_id",
        F.length(F.regexp_replace("__text", f"{SPACE}+", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("__text", F.lit(f"!(?!{WORD})")).cast("long").alias("n_shouts"),
        F.filter(F.split("__text", "\n"), lambda line: line.rlike(WORD)).alias("__lines"),
        F.filter(F.split("__text", f"{SPACE}+"), lambda word: word != "").alias("__words"),
    )
    counted = base.select(
        "doc_id",
        "word_chars",
        "n_symbols",
        "n_shouts",
        F.size("__words").cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("__lines", lambda line: line.rlike(rf"^{SPACE}*[-*•|]"))).alias("__bullets"),
        F.size(F.filter("__lines", lambda line: line.rlike(rf"(\.\.\.|…){SPACE}*$"))).alias("__ellipses"),
        F.size(F.filter("__words", lambda word: F.lower(word).isin(*STOP_WORDS))).alias("__stops"),
        F.transform("__words", lambda word: F.xxhash64(word)).alias("__hashes"),
    )
    passed = [c for c in counted.columns if c != "__hashes"]
    # The windows that begin in the last words are shorter, each of another length, so none repeats.
    windows = counted.select(
        *passed,
        F.transform("__hashes", lambda _, i: F.xxhash64(F.slice("__hashes", i + 1, WINDOW))).alias("__windows"),
    )
    at = F.transform("__windows", lambda window, i: F.struct(window.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    in_order = windows.select(
        *passed, F.when(repeats, F.sort_array(at)).otherwise(F.slice(at, 1, 0)).alias("__sorted")
    )
    places = in_order.select(
        *passed,
        F.sort_array(
            F.transform(
                F.filter(
                    "__sorted",
                    lambda w, j: F.coalesce(w.h == F.get("__sorted", j - 1).h, F.lit(False))
                    | F.coalesce(w.h == F.get("__sorted", j + 1).h, F.lit(False)),
                ),
                lambda w: w.i,
            )
        ).alias("__places"),
    )
    covered = F.zip_with(
        "__places",
        F.slice("__places", 2, F.size("__places")),
        lambda here, after: F.least(after - here, F.lit(WINDOW)),
    )
    return places.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.aggregate(covered, F.lit(0), lambda total, n: total + n).cast("long").alias("n_repeat_words"),
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"),
        _ratio(F.col("n_shouts"), F.col("n_words")).alias("shout_ratio"),
        _ratio(F.col("__stops"), F.col("n_words")).alias("stop_word_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.col("__bullets"), F.col("n_lines")).alias("bullet_line_ratio"),
        _ratio(F.col("__ellipses"), F.col("n_lines")).alias("ellipsis_line_ratio"),
    )


def quality(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measures, the measures whose rules are broken (``failed``), ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in 8-word windows that repeat.
    Null and empty texts fail it. Repeated rows give repeated results, a null id stays null, an empty
    table gives none, and columns besides id and text are ignored.
    """
    measured = measures(docs, id_col, text_col)
    failed = F.filter(
        F.array(*[F.when(rule.broken(), F.lit(rule.measure)) for rule in rules]), lambda name: name.isNotNull()
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return (
        measured.withColumn("base_failed", base_failed)
        .withColumn("failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    )


def _sql() -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    word, space = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"

    def broken(rule: Rule) -> str:
        bounds = []
        if rule.at_least is not None:
            bounds.append(f"{rule.measure} < {rule.at_least}")
        if rule.at_most is not None:
            bounds.append(f"{rule.measure} > {rule.at_most}")
        return " OR ".join(bounds)

    return f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{word}+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split)),
repeated AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows), range(8) r(j)
  WHERE c > 1 GROUP BY doc_id),
measured AS (
  SELECT s.doc_id, len(w) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: x[-1] = '!')) AS shouts,
    len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS stops,
    len(list_filter(l, lambda x: regexp_matches(x, '^{space}*[-*•|]'))) AS bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…){space}*$'))) AS ellipses, len(l) AS n_lines
  FROM split s LEFT JOIN repeated r USING (doc_id)),
ratios AS (
  SELECT *, coalesce(word_chars / nullif(n_words, 0), 0.0) AS mean_word_chars,
    coalesce(n_symbols / nullif(n_words, 0), 0.0) AS symbol_ratio,
    coalesce(shouts / nullif(n_words, 0), 0.0) AS shout_ratio,
    coalesce(stops / nullif(n_words, 0), 0.0) AS stop_word_ratio,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0.0) AS dup_line_ratio,
    coalesce(bullets / nullif(n_lines, 0), 0.0) AS bullet_line_ratio,
    coalesce(ellipses / nullif(n_lines, 0), 0.0) AS ellipsis_line_ratio,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(broken(rule) for rule in RULES)}) AS kept
FROM ratios"""


@query("op1_quality_rules", _sql())
def op1_quality_rules(spark, sf):
    return quality(read(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
