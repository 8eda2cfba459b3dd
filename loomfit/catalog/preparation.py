"""Queries over preparation steps."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from ..functions import statistics as st
from ..plans import preparation as prep
from ..sources.dictionary import ColumnSpec
from .common import PART_SPEC, PART_SQL, SIZE_SQL, parts, query, r, rs, table, uniform_sql

# The classes of the part and order tables.
BRANDS = sorted(f"Brand#{i}" for i in range(1, 26))
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
STATUSES = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _indicators(column: str, classes, missing: bool = False) -> str:
    cols = [f"({column} IS NOT DISTINCT FROM '{v}')::INT::DOUBLE AS \"{column}__{v}\"" for v in classes]
    if missing:
        cols.append(f"({column} IS NULL)::INT::DOUBLE AS \"{column}__nan\"")
    return ", ".join(cols)


@query("prep_delete_columns", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def delete_columns(spark, sf):
    return prep.DropColumns(("p_name", "p_type")).fit_transform(table(spark, sf, "part"), PART_SPEC)


@query(
    "prep_roles",
    "SELECT 'continuous' AS role, 'p_size' AS name, count(p_size) AS n FROM part "
    "UNION ALL SELECT 'continuous', 'p_retailprice', count(p_retailprice) FROM part "
    "UNION ALL SELECT 'categorical', 'p_brand', count(p_brand) FROM part "
    "UNION ALL SELECT 'categorical', 'p_type', count(p_type) FROM part "
    "UNION ALL SELECT 'useless', 'p_name', count(p_name) FROM part",
)
def roles(spark, sf):
    df = table(spark, sf, "part")
    useless = PART_SPEC.useless_in(df.columns)
    named = (
        [("continuous", c) for c in PART_SPEC.continuous_in(df.columns)]
        + [("categorical", c) for c in PART_SPEC.categorical_in(df.columns) if c not in useless]
        + [("useless", c) for c in useless]
    )
    counts = df.select(*[F.col(c).cast("string").alias(c) for _, c in named]).unpivot(
        [], [c for _, c in named], "name", "value"
    )
    roles_ = spark.createDataFrame(named, "role string, name string")
    return counts.groupBy("name").agg(F.count("value").alias("n")).join(roles_, "name").select("role", "name", "n")


@query("prep_drop_useless", "SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part")
def drop_useless(spark, sf):
    return prep.DropUseless().fit_transform(table(spark, sf, "part"), PART_SPEC)


@query("prep_drop_categorical", "SELECT p_partkey, p_size, p_retailprice FROM part")
def drop_categorical(spark, sf):
    return prep.DropCategorical().fit_transform(table(spark, sf, "part"), PART_SPEC)


@query("prep_recode_missing", PART_SQL)
def recode_missing(spark, sf):
    return parts(spark, sf)


_SPARSE = (
    "p_partkey, CASE WHEN p_size = 13 THEN p_retailprice END AS rare, "
    "CASE WHEN p_size <= 25 THEN p_retailprice END AS half"
)


@query("prep_drop_mostly_missing", f"SELECT p_partkey, half, kind FROM (SELECT {_SPARSE}, p_type AS kind FROM part)")
def drop_mostly_missing(spark, sf):
    df = table(spark, sf, "part").selectExpr(
        *_SPARSE_EXPRS, "p_type AS kind", "CASE WHEN p_size = 13 THEN p_brand END AS rare_kind"
    )
    spec = ColumnSpec(continuous=("rare", "half"), keys=("p_partkey",))
    return prep.DropMostlyMissing().fit_transform(df, spec)


_SPARSE_EXPRS = (
    "p_partkey",
    "CASE WHEN p_size = 13 THEN p_retailprice END AS rare",
    "CASE WHEN p_size <= 25 THEN p_retailprice END AS half",
)


@query("prep_drop_constant", "SELECT p_partkey, p_size, NULL::DOUBLE AS nothing, p_type FROM part")
def drop_constant(spark, sf):
    df = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "p_size",
        "p_size * 0.0D + 3 AS three",
        "CASE WHEN p_size < 0 THEN 1.0D END AS nothing",
        "p_type",
        "concat(substr(p_brand, 1, 5), '') AS one_word",
    )
    return prep.DropConstant().fit_transform(df, ColumnSpec(keys=("p_partkey",)))


@query(
    "prep_drop_proportional",
    "SELECT p_partkey, p_size, 3 * p_retailprice + 1 AS tripled, -p_retailprice AS negative, "
    "CASE WHEN p_size > 1 THEN p_retailprice END AS holes FROM part",
)
def drop_proportional(spark, sf):
    df = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "p_size",
        "p_retailprice",
        "2 * p_retailprice AS doubled",
        "3 * p_retailprice + 1 AS tripled",
        "-p_retailprice AS negative",
        "CASE WHEN p_size > 1 THEN p_retailprice END AS holes",
    )
    return prep.DropProportional().fit_transform(df, ColumnSpec(keys=("p_partkey",)))


def _filled_sql(fill: str) -> str:
    return (
        f"WITH p AS ({PART_SQL}), f AS (SELECT {fill} AS size_fill FROM p) SELECT p_partkey, p_brand, p_type, "
        f"{rs('coalesce(p_size::DOUBLE, size_fill)')} AS p_size, p_retailprice FROM p, f"
    )


def _sizes_rounded(df):
    return df.withColumn("p_size", r(F.col("p_size")))


@query("prep_impute_median", _filled_sql("quantile_cont(p_size::DOUBLE, 0.5)"))
def impute_median(spark, sf):
    return _sizes_rounded(prep.Impute("median").fit_transform(parts(spark, sf), PART_SPEC))


@query("prep_impute_mean", _filled_sql("avg(p_size)"))
def impute_mean(spark, sf):
    return _sizes_rounded(prep.Impute("mean").fit_transform(parts(spark, sf), PART_SPEC))


@query(
    "prep_impute_distributions",
    "WITH p AS (SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_brand END AS brand, "
    f"{SIZE_SQL} AS p_size FROM part), "
    "c AS (SELECT brand, sum(count(*)) OVER (ORDER BY brand) AS upto, sum(count(*)) OVER () AS total, "
    "count(*) AS n FROM p WHERE brand IS NOT NULL GROUP BY brand), "
    "b AS (SELECT brand, (upto - n)::DOUBLE / total::DOUBLE AS lo, upto::DOUBLE / total::DOUBLE AS hi FROM c), "
    f"u AS (SELECT *, {uniform_sql(1, chr(39) + 'brand' + chr(39), 'p_partkey')} AS u FROM p), "
    "m AS (SELECT quantile_cont(p_size::DOUBLE, 0.5) AS m FROM p) "
    "SELECT u.p_partkey, coalesce(u.brand, b.brand) AS brand, coalesce(u.p_size::DOUBLE, m.m) AS p_size "
    "FROM u JOIN b ON u.u >= b.lo AND u.u < b.hi CROSS JOIN m",
)
def impute_distributions(spark, sf):
    df = parts(spark, sf).select(
        "p_partkey", F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("brand"), "p_size"
    )
    return prep.Impute("distributions").fit_transform(df, PART_SPEC)


def _standardised(columns) -> str:
    return ", ".join(
        rs(f"({c} - (SELECT avg({c}) FROM p)) / (SELECT stddev_pop({c}) FROM p)") + f" AS {c}" for c in columns
    )


@query(
    "prep_standardise_with_missing",
    f"WITH p AS ({PART_SQL}) SELECT p_partkey, p_brand, p_type, {_standardised(('p_size', 'p_retailprice'))} FROM p",
)
def standardise_with_missing(spark, sf):
    out = prep.Standardise().fit_transform(parts(spark, sf), PART_SPEC)
    return _sizes_rounded(out).withColumn("p_retailprice", r(F.col("p_retailprice")))


@query(
    "prep_standardise",
    f"WITH p AS (FROM part) SELECT p_partkey, {_standardised(('p_size', 'p_retailprice'))} FROM p",
)
def standardise(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    out = prep.Standardise(allow_missing=False).fit_transform(df, PART_SPEC)
    return _sizes_rounded(out).withColumn("p_retailprice", r(F.col("p_retailprice")))


_ORDER_SPEC = ColumnSpec(continuous=("o_totalprice",), keys=("o_orderkey",))


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "prep_one_hot",
    f"SELECT o_orderkey, o_totalprice, {_indicators('o_orderstatus', STATUSES)}, "
    f"{_indicators('o_orderpriority', PRIORITIES)} FROM orders",
)
def one_hot(spark, sf):
    return prep.OneHot().fit_transform(_orders(spark, sf), _ORDER_SPEC)


@query(
    "prep_one_hot_drop_last",
    f"SELECT o_orderkey, o_totalprice, {_indicators('o_orderstatus', STATUSES[:-1])}, "
    f"{_indicators('o_orderpriority', PRIORITIES[:-1])} FROM orders",
)
def one_hot_drop_last(spark, sf):
    return prep.OneHot(drop_last=True).fit_transform(_orders(spark, sf), _ORDER_SPEC)


@query(
    "prep_one_hot_missing",
    "WITH p AS (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_type END AS kind, "
    "CASE WHEN p_size <= 3 THEN p_size::DOUBLE END AS small FROM part) "
    f"SELECT p_partkey, {_indicators('kind', TYPES, missing=True)}, "
    + ", ".join(f'(small IS NOT DISTINCT FROM {v})::INT::DOUBLE AS "small__{v}"' for v in ("1.0", "2.0", "3.0"))
    + ', (small IS NULL)::INT::DOUBLE AS "small__nan" FROM p',
)
def one_hot_missing(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("kind"),
        F.when(F.col("p_size") <= 3, F.col("p_size")).cast("double").alias("small"),
    )
    return prep.OneHot().fit_transform(df, ColumnSpec(keys=("p_partkey",)))


@query("prep_add_bias", "SELECT p_partkey, 1.0::DOUBLE AS bias, p_size, p_retailprice FROM part")
def add_bias(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return prep.AddBias().fit_transform(df, PART_SPEC)


@query(
    "prep_powers",
    "SELECT p_partkey, p_type, p_size::DOUBLE AS p_size, p_retailprice, pow(p_size, 2) AS \"p_size__^2\", "
    f"{rs('pow(p_retailprice, 2)', 4)} AS \"p_retailprice__^2\", pow(p_size, 3) AS \"p_size__^3\", "
    f"{rs('pow(p_retailprice, 3)', 1)} AS \"p_retailprice__^3\" FROM part",
)
def powers(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    out = prep.Powers(3).fit_transform(df, PART_SPEC)
    return out.withColumn("p_retailprice__^2", r(F.col("`p_retailprice__^2`"), 4)).withColumn(
        "p_retailprice__^3", r(F.col("`p_retailprice__^3`"), 1)
    )


@query(
    "prep_column_concat",
    f"SELECT o_orderkey, 1.0::DOUBLE AS bias, o_totalprice, {_indicators('o_orderstatus', STATUSES)} FROM orders",
)
def column_concat(spark, sf):
    steps = prep.Pipeline([prep.OneHot(), prep.AddBias()])
    return steps.fit_transform(_orders(spark, sf).drop("o_orderpriority"), _ORDER_SPEC)


@query(
    "prep_sorted_classes",
    "SELECT o_orderpriority AS value, row_number() OVER (ORDER BY o_orderpriority) - 1 AS position "
    "FROM (SELECT DISTINCT o_orderpriority FROM orders)",
)
def sorted_classes(spark, sf):
    df = table(spark, sf, "orders").select("o_orderpriority")
    found = prep.OneHot().fit(df, ColumnSpec()).state["o_orderpriority"]
    return spark.createDataFrame([(v, i) for i, v in enumerate(found)], "value string, position long")


@query(
    "prep_class_codes",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM orders",
)
def class_codes(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return st.class_codes(df, "o_orderpriority").select("o_orderkey", "code")


@query(
    "prep_class_codes_missing",
    f"SELECT p_partkey, dense_rank() OVER (ORDER BY p_size NULLS LAST) - 1 AS code FROM ({PART_SQL})",
)
def class_codes_missing(spark, sf):
    return st.class_codes(parts(spark, sf), "p_size").select("p_partkey", "code")


_MANY_SQL = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END AS customer, "
    "CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::VARCHAR END AS day FROM orders"
)


def _many_classes(spark, sf):
    """Orders with two columns of more than a thousand classes each, some of them missing."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 > 0, F.col("o_custkey")).alias("customer"),
        F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate").cast("string")).alias("day"),
    )


@query(
    "agg_value_counts_many_classes",
    f"WITH o AS ({_MANY_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, {c}::VARCHAR AS value, count(*) AS n, "
        f"row_number() OVER (ORDER BY {c} NULLS LAST) - 1 AS code FROM o GROUP BY {c}"
        for c in ("customer", "day")
    ),
)
def value_counts_many(spark, sf):
    names = F.array(F.lit("customer"), F.lit("day"))
    found = st.class_table(_many_classes(spark, sf), ["customer", "day"])
    value = F.coalesce(F.col("v").cast("long").cast("string"), "s")
    return found.select(F.get(names, F.col("c")).alias("name"), value.alias("value"), "n", "code")


def _drawn_sql(c: str) -> str:
    return (
        f"cum_{c} AS (SELECT {c}, (sum(n) OVER (ORDER BY {c}))::DOUBLE / sum(n) OVER () AS upto, "
        f"(sum(n) OVER (ORDER BY {c}) - n)::DOUBLE / sum(n) OVER () AS above FROM "
        f"(SELECT {c}, count(*) AS n FROM o WHERE {c} IS NOT NULL GROUP BY {c})), "
        f"u_{c} AS (SELECT o_orderkey, {uniform_sql(1, repr(c), 'o_orderkey')} AS u FROM o WHERE {c} IS NULL), "
        f"d_{c} AS (SELECT o_orderkey, {c} FROM u_{c} JOIN cum_{c} ON u >= above AND u < upto)"
    )


@query(
    "prep_impute_distributions_many_classes",
    f"WITH o AS ({_MANY_SQL}), {_drawn_sql('customer')}, {_drawn_sql('day')} "
    "SELECT o.o_orderkey, coalesce(o.customer, a.customer) AS customer, coalesce(o.day, b.day) AS day "
    "FROM o LEFT JOIN d_customer a USING (o_orderkey) LEFT JOIN d_day b USING (o_orderkey)",
)
def impute_many_classes(spark, sf):
    """Draws from the frequencies of columns with many classes."""
    step = prep.Impute("distributions", max_classes=100)
    return step.fit_transform(_many_classes(spark, sf), ColumnSpec(keys=("o_orderkey",)))


@query(
    "prep_one_hot_many_classes",
    f"WITH o AS ({_MANY_SQL}) SELECT o_orderkey, dense_rank() OVER (ORDER BY customer NULLS LAST) - 1 AS customer, "
    "dense_rank() OVER (ORDER BY day NULLS LAST) - 1 AS day, 1.0::DOUBLE AS value, "
    "(SELECT count(DISTINCT customer) + max((customer IS NULL)::INT) FROM o) AS size FROM o",
)
def one_hot_many_classes(spark, sf):
    """Sparse indicator vectors, as the place of their only one, their value and size."""
    step = prep.OneHot(max_classes=100)
    out = step.fit_transform(_many_classes(spark, sf), ColumnSpec(keys=("o_orderkey",)))
    sparse = {c: unwrap_udt(F.col(f"{c}__classes")) for c in ("customer", "day")}
    return out.select(
        "o_orderkey",
        *[F.get(v["indices"], F.lit(0)).cast("long").alias(c) for c, v in sparse.items()],
        F.get(sparse["customer"]["values"], F.lit(0)).alias("value"),
        sparse["customer"]["size"].cast("long").alias("size"),
    )


PIPELINE_SQL = (
    f"WITH q AS ({PART_SQL}), p AS (SELECT p_partkey, p_brand, p_type, coalesce(p_size::DOUBLE, "
    "(SELECT quantile_cont(p_size::DOUBLE, 0.5) FROM q)) AS p_size, p_retailprice, "
    "2 * p_retailprice + 1 AS with_tax FROM q) "
    f"SELECT p_partkey, {_standardised(('p_size', 'with_tax'))}, {_indicators('p_brand', BRANDS[:-1])}, "
    f"{_indicators('p_type', TYPES[:-1])} FROM p"
)
PIPELINE_SPEC = ColumnSpec(
    (*PART_SPEC.continuous, "with_tax"), PART_SPEC.useless, PART_SPEC.signification, PART_SPEC.keys
)


def pipeline_input(spark, sf):
    """Parts with a price column proportional to the retail price, which the pipeline drops."""
    df = table(spark, sf, "part").withColumn("with_tax", 2 * F.col("p_retailprice") + 1)
    return df


@query("prep_pipeline", PIPELINE_SQL)
def pipeline(spark, sf):
    out = prep.survey_pipeline().fit_transform(pipeline_input(spark, sf), PIPELINE_SPEC)
    return out.withColumn("p_size", r(F.col("p_size"))).withColumn("with_tax", r(F.col("with_tax")))


class CapAt(prep.Step):
    """A user-defined step: continuous values above ``share`` of the largest are set to that bound."""

    def __init__(self, share: float):
        self.share = share

    def learn(self, scan: prep.Scan) -> prep.Fitted:
        names = scan.spec.continuous_in(scan.df.columns)
        bounds = {c: self.share * scan.profile[c].high for c in names}
        exprs = {c: F.least(F.col(c).cast("double"), F.lit(b)) for c, b in bounds.items()}
        return prep.replacing(exprs, lambda known: None, bounds)


@query(
    "prep_custom_step",
    "WITH p AS (FROM part), c AS (SELECT p_partkey, least(p_size, 0.5 * (SELECT max(p_size) FROM p)) AS p_size, "
    "least(p_retailprice, 0.5 * (SELECT max(p_retailprice) FROM p)) AS p_retailprice FROM p) "
    "SELECT p_partkey, "
    + ", ".join(
        rs(f"({c} - (SELECT avg({c}) FROM c)) / (SELECT stddev_pop({c}) FROM c)") + f" AS {c}"
        for c in ("p_size",)
    )
    + " FROM c",
)
def custom_step(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_size")
    out = prep.Pipeline([CapAt(0.5), prep.Standardise()]).fit_transform(df, PART_SPEC)
    return out.withColumn("p_size", r(F.col("p_size")))
