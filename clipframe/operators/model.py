"""Fit, select, store and apply classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipframe.functions.scores import argmax, softmax
from clipframe.operators.encode import decode_labels
from clipframe.operators.scoring import best_epoch, macro_f1
from clipframe.sources import commits
from clipframe.worker import kept

VECTOR = "__vector"
HISTORY_SCHEMA = "run string, epoch int, split string, metric string, value double"


def _with_vector(df: DataFrame, features: str) -> DataFrame:
    return df.withColumn(VECTOR, array_to_vector(F.col(features).cast("array<double>")))


def fit_classifier(train: DataFrame, features: str = "features", label_id: str = "label_id",
                   reg_param: float = 0.01, max_iter: int = 50) -> PipelineModel:
    """Scaled multinomial logistic regression. Gradients are summed in a tree."""
    pipeline = Pipeline(stages=[
        StandardScaler(inputCol=VECTOR, outputCol="__scaled", withMean=True),
        LogisticRegression(featuresCol="__scaled", labelCol=label_id, family="multinomial",
                           regParam=reg_param, maxIter=max_iter, aggregationDepth=3,
                           rawPredictionCol="__raw", probabilityCol="__probability",
                           predictionCol="__prediction"),
    ])
    return pipeline.fit(_with_vector(train, features))


def predict(model: PipelineModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Add ``scores`` (one probability per class), ``label_id`` and ``score``."""
    scored = model.transform(_with_vector(df, features))
    kept = [c for c in df.columns if c != "label_id"]
    scored = scored.select(*kept, vector_to_array("__probability").alias("scores"))
    return _pick(scored, kept)


def _pick(scored: DataFrame, kept: Sequence[str]) -> DataFrame:
    return scored.select(*kept, "scores", argmax(F.col("scores")).alias("label_id"),
                         F.array_max("scores").alias("score"))


def predict_batches(df: DataFrame, make_predict_fn: Callable, input_col: str,
                    batch_size: int = 64, **options) -> DataFrame:
    """Score with any model: ``make_predict_fn`` loads it once per Python worker
    and returns a function from an input batch to logits."""
    logits = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()),
                               batch_size=batch_size, **options)
    kept = [c for c in df.columns if c != "label_id"]
    # one barrier between the model call and the columns derived from it
    scored = df.withColumn("__logits", logits(F.col(input_col)))
    return _pick(scored.select(*kept, softmax(F.col("__logits")).alias("scores")), kept)


def score_batches(batches: DataFrame, make_model: Callable[[], Callable], key: str,
                  version: str | None = None) -> DataFrame:
    """Score stacked batches with any network: ``key, scores, label_id, score``.

    ``make_model`` loads the network; it takes
    ``(input_values [B, T], attention_mask [B, T])`` and returns logits ``[B, C]``.
    With the ``version`` of the network, which must tell its weights apart, a worker
    loads it once and keeps it from task to task until another version comes; without
    one it is loaded for each task.
    """
    narrow = batches.select(key, "input_values", "attention_mask")
    schema = T.StructType([
        T.StructField(key, narrow.schema[key].dataType.elementType),
        T.StructField("__logits", T.ArrayType(T.DoubleType()))])

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = make_model() if version is None else kept("network", version, make_model)
        for table in tables:
            for keys, values, mask in zip(*table.columns):
                size = len(keys)
                logits = np.asarray(network(
                    values.values.flatten().to_numpy().reshape(size, -1),
                    mask.values.flatten().to_numpy().reshape(size, -1)), np.float64)
                yield pa.RecordBatch.from_arrays(
                    [keys.values, pa.array(list(logits), pa.list_(pa.float64()))],
                    names=schema.names)

    scored = narrow.mapInArrow(run, schema)
    return _pick(scored.select(key, softmax(F.col("__logits")).alias("scores")), [key])


def predicted_labels(scored: DataFrame, dictionary: DataFrame, label: str = "label") -> DataFrame:
    return decode_labels(scored, dictionary, label)


def evaluate(model: PipelineModel, dev: DataFrame, features: str = "features",
             label_id: str = "label_id") -> DataFrame:
    """One row ``(macro_f1, n_classes, n_rows)`` on a labelled split."""
    renamed = dev.withColumnRenamed(label_id, "truth")
    scored = predict(model, renamed, features).withColumnRenamed("label_id", "pred")
    return macro_f1(scored)


def select_model(train: DataFrame, dev: DataFrame, reg_params: Sequence[float] = (0.001, 0.01, 0.1),
                 features: str = "features", label_id: str = "label_id", run: str = "fit",
                 max_iter: int = 50) -> tuple[PipelineModel, DataFrame]:
    """Fit one model per setting and keep the best dev macro-F1.

    Returns the model and the metric history (one row per fit).
    """
    spark = train.sparkSession
    models, rows = [], []
    for epoch, reg_param in enumerate(reg_params):
        models.append(fit_classifier(train, features, label_id, reg_param, max_iter))
        score = evaluate(models[-1], dev, features, label_id).first()["macro_f1"]
        rows.append((run, epoch, "eval", "macro_f1", score))
    history = spark.createDataFrame(rows, HISTORY_SCHEMA)
    return models[best_epoch(history).first()["best_epoch"]], history


def stored_part(spark: SparkSession, path: str) -> str:
    """The newest whole part of a model's folder."""
    keys = commits.complete(spark, path)
    if not keys:
        raise FileNotFoundError(f"no complete model in {path}")
    return f"{path.rstrip('/')}/{keys[-1]}"


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{stored_part(SparkSession.active(), path)}/pipeline")


def load_labels(spark: SparkSession, path: str) -> DataFrame:
    """``(label, label_id)`` as stored with the model."""
    return spark.read.parquet(f"{stored_part(spark, path)}/labels")
