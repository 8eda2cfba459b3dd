"""Feature and label tables in, predictions out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import quoted


def column_names(spark: SparkSession, path: str) -> list[str]:
    """Feature names of a CSV: its header without the id."""
    return spark.read.csv(path, header=True).columns[1:]


def read_features(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """A feature CSV: first column the id, all others doubles; blanks are missing.

    Only the header is looked at to build the schema; the values are read once, when used.
    """
    header = spark.read.csv(path, header=True).columns
    schema = T.StructType(
        [T.StructField(header[0], T.LongType() if id_type == "long" else T.StringType())]
        + [T.StructField(c, T.DoubleType()) for c in header[1:]]
    )
    return nan_to_null(spark.read.csv(path, header=True, schema=schema, mode="FAILFAST"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A label CSV: id and, in the second column, an integer label."""
    header = spark.read.csv(path, header=True).columns
    df = spark.read.csv(path, header=True, schema=_label_schema(header), mode="FAILFAST")
    return df.select(quoted(header[0]), quoted(header[1]).alias("label"))


def _label_schema(header: Sequence[str]) -> T.StructType:
    rest = [T.StructField(c, T.StringType()) for c in header[2:]]
    return T.StructType(
        [T.StructField(header[0], T.LongType()), T.StructField(header[1], T.IntegerType()), *rest]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing values are NULL from here on."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(quoted(c)), quoted(c)).alias(c) if c in floats else quoted(c)
            for c in df.columns
        ]
    )


def join_labels(features: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """Features with their labels, by id."""
    return features.join(labels, id_col)


def load_once(df: DataFrame, path: str) -> DataFrame:
    """Parse once, read many times: the columnar copy at ``path`` is written if there is none.

    A copy counts once its write has finished; a folder left by a broken write is an error.
    """
    spark = df.sparkSession
    if not _written(spark, path):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _written(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def predictions(df: DataFrame, id_col: str, prediction: str) -> DataFrame:
    """``(Id, Prediction)`` rows, after checking that every prediction is -1 or 1."""
    p = quoted(prediction)
    bad = df.agg(F.count_if(p.isNull() | ~p.isin(-1, 1)).alias("bad")).first()["bad"]
    if bad:
        raise ValueError(f"{bad} predictions are neither -1 nor 1")
    return df.select(quoted(id_col).cast("long").alias("Id"), p.cast("int").alias("Prediction"))


def write_predictions(df: DataFrame, id_col: str, prediction: str, path: str) -> None:
    predictions(df, id_col, prediction).write.csv(path, header=True)
