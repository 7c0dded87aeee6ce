"""Label dictionary and the two lookups through it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipframe.operators.batching import number_rows
from clipframe.session import lookup_join, side_table

UNKNOWN_LABEL = "unknown label"


def label_dictionary(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, label_id)``: distinct labels in order, ids 0, 1, ..."""
    labels = df.select(F.col(label).alias("label")).filter(F.col("label").isNotNull()).distinct()
    labels, fits = side_table(labels)
    if not fits:
        numbered = number_rows(labels, ["label"], "label_id")
        return numbered.withColumn("label_id", F.col("label_id").cast("int"))
    place = F.row_number().over(Window.partitionBy().orderBy("label")) - 1
    return labels.select("label", place.cast("int").alias("label_id"))


def encode_labels(df: DataFrame, dictionary: DataFrame, label: str = "label") -> DataFrame:
    """Add ``label_id`` and ``label_error``; a label out of the dictionary is an error."""
    side = dictionary.select(F.col("label").alias(label), "label_id")
    coded = lookup_join(df, side, [label])
    return coded.select(*df.columns, "label_id", F.when(
        F.col("label_id").isNull(), UNKNOWN_LABEL).alias("label_error"))


def decode_labels(df: DataFrame, dictionary: DataFrame, label: str = "label") -> DataFrame:
    """Add the label of ``label_id``."""
    side = dictionary.select(F.col("label").alias(label), "label_id")
    return lookup_join(df, side, ["label_id"]).select(*df.columns, label)
