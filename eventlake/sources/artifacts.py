"""Saved models and the history of training metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.errors import ModelQualityError


def save_model(pipeline: PipelineModel, path: str) -> None:
    """Save scaling and model as one pipeline, replacing an earlier one."""
    pipeline.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_metrics(spark: SparkSession, metrics: Row, path: str) -> None:
    """Append the metrics of a run to the history at ``path``, as JSON."""
    values = metrics.asDict()
    row = tuple(values[name] for name in schemas.METRICS.fieldNames())
    spark.createDataFrame([row], schemas.METRICS).write.mode("append").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Every run's metrics, newest first; empty where no model was trained yet."""
    try:
        history = spark.read.schema(schemas.METRICS).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        history = spark.createDataFrame([], schemas.METRICS)
    return history.orderBy(F.col("training_date").desc())


def check_model(spark: SparkSession, path: str, accuracy: float = 0.5) -> Row:
    """The newest metrics; raises unless they exist and reach ``accuracy``."""
    newest = read_metrics(spark, path).first()
    if newest is None:
        raise ModelQualityError(f"no metrics at {path}")
    if newest.accuracy < accuracy:
        raise ModelQualityError(f"accuracy {newest.accuracy} is under {accuracy}")
    return newest
