"""The registry of queries and the derived tables they share, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.dictionary import ColumnSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that computes the same table where SQL can."""

    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r(value: Column, places: int = 6) -> Column:
    """Rounded for comparison; adding zero drops the sign of a negative zero."""
    return F.round(value, places) + F.lit(0.0)


def rs(value: str, places: int = 6) -> str:
    return f"round({value}, {places}) + 0.0"


# Parts with a few size codes that mean "missing" ------------------------------------------------

PART_SPEC = ColumnSpec(
    continuous=("p_size", "p_retailprice"),
    useless=("p_name",),
    signification={
        "p_size": {
            "7": "Refused",
            "9": "Don’t know/Not sure",
            "11": "None",
            "13": "Thirteen",
            "BLANK": "Refused",
        }
    },
    keys=("p_partkey",),
)
SIZE_SQL = "CASE WHEN p_size NOT IN (7, 9, 11) THEN p_size END"
PART_SQL = f"SELECT p_partkey, p_brand, p_type, {SIZE_SQL} AS p_size, p_retailprice FROM part"


def parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with recoded sizes, without names."""
    from ..plans.preparation import DropUseless, Pipeline, RecodeMissing

    return Pipeline([DropUseless(), RecodeMissing()]).fit_transform(table(spark, sf, "part"), PART_SPEC)


# Purchases among events: an imbalanced label with three numeric features ------------------------

EVENT_FEATURES = ("bias", "x1", "x2", "x3")
EVENT_SQL = (
    "SELECT event_id, 1.0::DOUBLE AS bias, value / 100 AS x1, hour(ts) / 24 AS x2, "
    "(user_id % 10) / 10 AS x3, CASE WHEN event_type = 'purchase' THEN 1 ELSE -1 END AS y FROM events"
)


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.lit(1.0).alias("bias"),
        (F.col("value") / 100).alias("x1"),
        (F.hour("ts") / 24).alias("x2"),
        (F.col("user_id") % 10 / 10).alias("x3"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(-1).alias("y"),
    )


# Line items with a numeric target ---------------------------------------------------------------

ITEM_FEATURES = ("bias", "qty", "disc", "tax")
ITEM_SQL = (
    "SELECT 1.0::DOUBLE AS bias, l_quantity / 50 AS qty, l_discount * 10 AS disc, l_tax * 10 AS tax, "
    "l_extendedprice / 100000 AS y FROM lineitem"
)


def items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.lit(1.0).alias("bias"),
        (F.col("l_quantity") / 50).alias("qty"),
        (F.col("l_discount") * 10).alias("disc"),
        (F.col("l_tax") * 10).alias("tax"),
        (F.col("l_extendedprice") / 100000).alias("y"),
    )


# Labelled documents -----------------------------------------------------------------------------

DOC_SQL = (
    "SELECT d.doc_id, d.n_chars / 1000 AS chars, len(string_split(d.text, chr(10))) / 10 AS lines, "
    "CASE WHEN l.toxic = 1 THEN 1 ELSE -1 END AS y FROM documents d JOIN labels l USING (doc_id)"
)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    counted = table(spark, sf, "documents").select(  # before the join, which moves no texts then
        "doc_id", (F.col("n_chars") / 1000).alias("chars"), (F.size(F.split("text", "\n")) / 10).alias("lines")
    )
    return counted.join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "chars", "lines", F.when(F.col("toxic") == 1, 1).otherwise(-1).alias("y")
    )


# SQL building blocks ----------------------------------------------------------------------------


def key_sql(seed: object, *parts: str) -> str:
    """md5 of seed and parts joined by colons."""
    return "md5(concat_ws(':', '" + str(seed) + "', " + ", ".join(parts) + "))"


def uniform_sql(seed: object, *parts: str) -> str:
    return f"((('0x' || substr({key_sql(seed, *parts)}, 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE"


def rank_sql(seed: object, id_col: str, by: str | None = None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY {key_sql(seed, id_col)}, {id_col})"


def score_sql(xs: Sequence[str], w: str = "w") -> str:
    return " + ".join(f"d.{x} * {w}.b{i}" for i, x in enumerate(xs))


LOGISTIC = "1 / (1 + exp(-({z}))) - (CASE WHEN d.y = 1 THEN 1 ELSE 0 END)"
SQUARED = "({z}) - d.y"
ABSOLUTE = "-sign(d.y - ({z}))::DOUBLE"


def descent_ctes(
    data: str,
    xs: Sequence[str],
    steps: int,
    gamma: float,
    residual: str | Callable[[int], str],
    penalty: str = "0",
    prefix: str = "w",
    where: str | Callable[[int], str] = "TRUE",
    weight: str = "1",
    initial: Sequence[float] | None = None,
    joins: Callable[[int], str] = lambda t: "",
) -> tuple[str, str]:
    """Chained CTEs of descent steps over a relation ``data``; returns them and the last name.

    ``residual`` is in terms of ``{z}``, the score; ``penalty`` is the penalty slope in terms of
    ``{b}``, a weight.
    """
    start = initial or [0.0] * len(xs)
    ctes = [
        f"{prefix}0 AS (SELECT "
        + ", ".join(f"{v}::DOUBLE AS b{i}" for i, v in enumerate(start))
        + ")"
    ]
    for t in range(steps):
        z = score_sql(xs)
        rows = where(t) if callable(where) else where
        res = residual(t) if callable(residual) else residual
        cols = []
        for i, x in enumerate(xs):
            slope = penalty.format(b=f"max(w.b{i})")
            cols.append(
                f"max(w.b{i}) - {gamma} * (sum(({weight}) * d.{x} * ({res.format(z=z)})) "
                f"/ sum({weight}) + {slope}) AS b{i}"
            )
        ctes.append(
            f"{prefix}{t + 1} AS (SELECT {', '.join(cols)} FROM {data} d "
            f"CROSS JOIN {prefix}{t} w {joins(t)} WHERE {rows})"
        )
    return ",\n".join(ctes), f"{prefix}{steps}"


def solve_ctes(
    data: str, xs: Sequence[str], ridge: float = 0.0, prefix: str = "s", where: str = "TRUE", y: str = "y"
) -> tuple[str, str]:
    """Chained CTEs that solve the normal equations by elimination; the last one has ``b0, b1, ...``."""
    n = len(xs)
    cells = []
    for i, a in enumerate(xs):
        for j, b in enumerate(xs):
            extra = f" + {2 * ridge} * count(*)" if i == j else ""
            cells.append(f'sum(d."{a}" * d."{b}"){extra} AS a{i}_{j}')
        cells.append(f'sum(d."{a}" * d.{y}) AS a{i}_{n}')
    ctes = [f"{prefix}0 AS (SELECT {', '.join(cells)} FROM {data} d WHERE {where})"]
    for k in range(n):
        cells = []
        for i in range(n):
            for j in range(k + 1, n + 1):
                if i == k:
                    cells.append(f"a{k}_{j} / a{k}_{k} AS a{k}_{j}")
                else:
                    cells.append(f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j} AS a{i}_{j}")
        ctes.append(f"{prefix}{k + 1} AS (SELECT {', '.join(cells)} FROM {prefix}{k})")
    ctes.append(
        f"{prefix}w AS (SELECT {', '.join(f'a{i}_{n} AS b{i}' for i in range(n))} FROM {prefix}{n})"
    )
    return ",\n".join(ctes), f"{prefix}w"


def weights_sql(xs: Sequence[str], relation: str) -> str:
    """``(feature, weight)`` rows from a one-row relation."""
    return " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {rs(f'b{i}')} AS weight FROM {relation}" for i, x in enumerate(xs)
    )


def weight_rows(model, spark: SparkSession, places: int = 6) -> DataFrame:
    return model.weight_table(spark).select("feature", r(F.col("weight"), places).alias("weight"))
