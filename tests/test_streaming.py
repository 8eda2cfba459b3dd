"""A fitted pipeline and model applied to a stream give the same predictions as on a table."""

from pyspark.sql import functions as F

from loomfit.operators.logistic import Logistic
from loomfit.plans.preparation import survey_pipeline
from loomfit.session import work_folder
from loomfit.sources.dictionary import ColumnSpec
from loomfit.sources.tables import predictions
from loomfit.streaming.scoring import score_stream, write_stream


def test_stream_equals_table(spark):
    df = spark.range(200).select(
        "id",
        F.sqrt("id").alias("x"),
        F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias("c"),
        F.when(F.col("id") > 120, 1).otherwise(-1).alias("y"),
    )
    source, target = work_folder(spark), work_folder(spark)
    df.repartition(3).write.parquet(source)
    spec = ColumnSpec(("x",), keys=("id", "y"))
    fitted = survey_pipeline().fit(df, spec)
    model = Logistic(0.5, 5).fit(fitted.transform(df), fitted.columns, "y")
    want = predictions(model.transform(fitted.transform(df)), "id", "prediction")

    stream = spark.readStream.schema(df.schema).parquet(source)
    query = write_stream(score_stream(stream, fitted, model, "id"), target)
    assert query.awaitTermination(120)
    got = spark.read.csv(target, header=True, schema="Id long, Prediction int")
    assert sorted(got.collect()) == sorted(want.collect())
