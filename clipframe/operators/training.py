"""Fit classifiers by epochs: seeded mini-batches, several settings in one pass.

The rows are written once, dealt into cells by a hash of their key. An epoch visits the
cells in an order drawn from the seed and the epoch; a few cells make a mini-batch.
Each task turns its rows into one gradient, for all settings at once (one matrix
product), and gradients are summed in a tree. Every epoch is stored with its metrics,
its weights and the state of the optimiser, as a part that counts once it is complete:
a run that ended anywhere goes on after its last whole epoch, and never counts twice.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipframe.functions.scores import argmax
from clipframe.operators.model import HISTORY_SCHEMA
from clipframe.operators.scoring import best_epoch, early_stop
from clipframe.session import new_folder
from clipframe.sources import commits

CELLS_PER_BATCH = 4
ROWS_PER_FILE = 1_000_000   # of a cell
FAN_IN = 64                 # arrays that meet in one task


class Setting(NamedTuple):
    name: str
    learning_rate: float = 0.5
    reg_param: float = 0.0


class Plan(NamedTuple):
    epochs: int = 10
    batches: int = 8            # of an epoch
    patience: int | None = None  # epochs without a new best before a setting stops
    warmup: float = 0.1         # share of all steps
    momentum: float = 0.9
    seed: int = 42


class LinearModel(NamedTuple):
    """Softmax regression on standardised features; ``weights``: features and one, by class."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def logits(self, features: np.ndarray) -> np.ndarray:
        return with_one((features - self.mean) / self.scale) @ self.weights

    def save(self, spark: SparkSession, folder: str, labels: DataFrame | None = None,
             run: str = "run") -> None:
        """Store the model and its labels; readers see both or neither."""
        part = commits.stage(spark, folder, f"model={run}")
        write_arrays(spark, f"{part}/weights", self._asdict())
        if labels is not None:
            labels.write.parquet(f"{part}/labels")
        commits.finish(spark, part)


def load_linear(spark: SparkSession, folder: str, run: str | None = None
                ) -> tuple[LinearModel, DataFrame | None]:
    """A stored model and its labels, by default the one stored last."""
    keys = [k for k in commits.complete(spark, folder) if k.startswith("model=")]
    if run is not None:
        keys = [k for k in keys if k == f"model={run}"]
    if not keys:
        raise FileNotFoundError(f"no complete model in {folder}")
    part = f"{folder.rstrip('/')}/{keys[-1]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{part}/labels")
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return (LinearModel(**read_arrays(spark, f"{part}/weights")),
            spark.read.parquet(f"{part}/labels") if there else None)


def predict_linear(model: LinearModel, df: DataFrame, features: str = "features") -> DataFrame:
    """Add ``scores`` (a probability for each class), ``label_id`` and ``score``."""
    def score(column: pa.Array) -> pa.Array:
        rows = len(column)
        if not rows:
            return pa.array([], pa.list_(pa.float64()))
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        shares = softmax_rows(model.logits(flat.reshape(rows, -1)))
        return pa.ListArray.from_arrays(
            pa.array(np.arange(rows + 1, dtype=np.int32) * shares.shape[1]), pa.array(shares.ravel()))

    kept = [c for c in df.columns if c not in ("scores", "label_id", "score")]
    scored = df.select(*kept, F.arrow_udf(score, "array<double>")(F.col(features)).alias("scores"))
    return scored.select(*kept, "scores", argmax(F.col("scores")).alias("label_id"),
                         F.array_max("scores").alias("score"))


def with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def softmax_rows(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def write_arrays(spark: SparkSession, path: str, arrays: dict[str, np.ndarray]) -> None:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    spark.createDataFrame([(bytearray(buffer.getvalue()),)], "arrays binary").write.parquet(path)


def read_arrays(spark: SparkSession, path: str) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(bytes(spark.read.parquet(path).first()[0]))) as stored:
        return dict(stored)


def tree_sum(df: DataFrame, measure: Callable[[np.ndarray, np.ndarray], np.ndarray],
             fan_in: int = FAN_IN) -> np.ndarray | None:
    """Sum of ``measure(labels, features)`` over batches of ``df (label_id, features)``.

    A task gives one array; arrays meet ``fan_in`` at a time, in the order of their
    tasks, until one is left. So the driver gets one, and the sum does not depend on
    which task ends first. None without rows.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                labels = batch.column(0).to_numpy(zero_copy_only=False)
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                found = measure(labels, flat.reshape(len(labels), -1))
                total = found if total is None else total + found
        if total is not None:
            yield state(TaskContext.get().partitionId(), total)

    def state(part: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([total.astype("<f8").tobytes()], pa.binary())],
            names=["part", "total"])

    def add(rows: pa.Table) -> pa.Table:
        rows = sorted(zip(rows.column("part").to_pylist(), rows.column("total").to_pylist()))
        total = np.frombuffer(rows[0][1], "<f8").copy()
        for _, more in rows[1:]:
            total += np.frombuffer(more, "<f8")
        return pa.Table.from_batches([state(rows[0][0] // fan_in, total)])

    schema = "part bigint, total binary"
    narrow = df.select("label_id", "features")
    tasks = narrow.rdd.getNumPartitions()
    totals = narrow.mapInArrow(partial, schema)
    while tasks > 1:
        tasks = -(-tasks // fan_in)
        totals = totals.groupBy(F.floor(F.col("part") / fan_in)).applyInArrow(add, schema)
    got = totals.first()
    return None if got is None else np.frombuffer(bytes(got["total"]), "<f8").copy()


def deal(rows: DataFrame, key: str, cells: int, seed: int) -> DataFrame:
    """The rows as a table with a folder for each cell, which a hash of the key chooses."""
    out = new_folder(rows.sparkSession, "cells")
    cell = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(cells)).cast("int")
    files = max(1, -(-rows.count() // (cells * ROWS_PER_FILE)))
    part = F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(files))
    (rows.select("label_id", "features", cell.alias("cell"), part.alias("part"))
     .repartition(cells * files, "cell", "part").drop("part")
     .sortWithinPartitions("cell").write.partitionBy("cell").parquet(out))
    return rows.sparkSession.read.schema(
        f"label_id {rows.schema['label_id'].dataType.simpleString()}, "
        f"features {rows.schema['features'].dataType.simpleString()}, cell int").parquet(out)


def moments(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray, int]:
    """Count, mean and deviation of each feature, and the number of classes.

    Two passes: the deviation is taken from the mean; a constant feature has scale one.
    """
    def measure(labels: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(axis=0)])

    total = tree_sum(rows, measure)
    if total is None:
        raise ValueError("no rows to learn from")
    n, mean = int(total[0]), total[1:] / total[0]
    spread = tree_sum(rows, lambda labels, x: ((x - mean) ** 2).sum(axis=0))
    scale = np.sqrt(spread / n)
    return n, mean, np.where(scale > 0, scale, 1.0), rows.agg(F.max("label_id")).first()[0] + 1


def rate(step: int, steps: int, warmup: float) -> float:
    """Share of the learning rate: up in a line during the warm-up, then down to zero."""
    first = int(warmup * steps)
    if step < first:
        return (step + 1) / first
    return (steps - step) / max(steps - first, 1)


def gradients(model: LinearModel, settings: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Measure of rows: count, loss of each setting, gradients of all settings.

    ``model.weights`` holds the settings side by side.
    """
    def measure(labels: np.ndarray, x: np.ndarray) -> np.ndarray:
        x = with_one((x - model.mean) / model.scale)
        shares = softmax_rows((x @ model.weights).reshape(len(x), settings, -1))
        rows = np.arange(len(x))
        loss = -np.log(np.maximum(shares[rows, :, labels], 1e-300)).sum(axis=0)
        shares[rows, :, labels] -= 1
        return np.concatenate([[len(x)], loss, (x.T @ shares.reshape(len(x), -1)).ravel()])

    return measure


def confusions(model: LinearModel, settings: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    def measure(labels: np.ndarray, x: np.ndarray) -> np.ndarray:
        scores = model.logits(x).reshape(len(x), settings, -1)
        classes = scores.shape[2]
        counts = np.zeros((settings, classes + 1, classes))  # a label never learnt comes last
        truth = np.minimum(labels, classes)
        for k in range(settings):
            np.add.at(counts[k], (truth, scores[:, k].argmax(axis=1)), 1)
        return counts.ravel()

    return measure


def macro_f1(counts: np.ndarray) -> float:
    """Mean F1 of the classes that occur as truth or prediction."""
    hit = np.append(np.diag(counts[:-1]), 0)
    sides = counts.sum(axis=1) + np.append(counts.sum(axis=0), 0)
    there = sides > 0
    return float((2 * hit[there] / sides[there]).mean()) if there.any() else float("nan")


def history_of(spark: SparkSession, folder: str) -> DataFrame:
    """``(run, epoch, split, metric, value)`` of the whole epochs stored in a folder."""
    found = spark.createDataFrame([], HISTORY_SCHEMA)
    for key in epochs_of(spark, folder):
        found = found.union(spark.read.schema(HISTORY_SCHEMA).parquet(f"{folder}/{key}/metrics"))
    return found


def epochs_of(spark: SparkSession, folder: str) -> list[str]:
    return sorted(k for k in commits.complete(spark, folder) if k.startswith("epoch="))


def train(rows: DataFrame, dev: DataFrame, folder: str, settings: Sequence[Setting],
          plan: Plan = Plan(), key: str = "path") -> tuple[LinearModel, DataFrame]:
    """Fit all settings on ``rows (key, label_id, features)``, one pass of mini-batches an epoch.

    After each epoch all settings are scored on ``dev`` and the epoch is stored in
    ``folder``. A setting without a new best macro-F1 for ``plan.patience`` epochs keeps
    its weights; when all have stopped, so does the run. Called again with the same
    folder, it goes on after the last whole epoch. Returns the weights of the best
    epoch of the best setting (the earlier, then the first by name, of equal ones) and
    the history of all epochs. The key decides in which cell a row lies; rows that
    repeat one lie in one cell. Labels are numbers from zero on.
    """
    spark, folder = rows.sparkSession, folder.rstrip("/")
    if len({s.name for s in settings}) < len(settings) or not settings:
        raise ValueError("settings need names of their own")
    done = epochs_of(spark, folder)
    cells = plan.batches * CELLS_PER_BATCH
    table = deal(rows, key, cells, plan.seed)
    k = len(settings)
    if done:
        stored = read_arrays(spark, f"{folder}/{done[-1]}/state")
        if stored["settings"].tolist() != [s.name for s in settings]:
            raise ValueError("the folder holds a run of other settings")
    else:
        _, mean, scale, classes = moments(table)
        shape = (len(mean) + 1, k, classes)
        stored = {"mean": mean, "scale": scale, "weights": np.zeros(shape),
                  "speed": np.zeros(shape), "active": np.ones(k, bool),
                  "settings": np.array([s.name for s in settings])}
    rates = np.array([s.learning_rate for s in settings])[:, None]
    shrink = np.array([s.reg_param for s in settings])[:, None]

    def flat() -> LinearModel:
        return LinearModel(stored["mean"], stored["scale"],
                           stored["weights"].reshape(len(stored["weights"]), -1))

    steps = plan.epochs * plan.batches
    for epoch in range(len(done), plan.epochs):
        if not stored["active"].any():
            break
        order = np.random.default_rng([plan.seed, epoch]).permutation(cells)
        seen, loss = 0, np.zeros(k)
        for batch in range(plan.batches):
            chosen = order[batch * CELLS_PER_BATCH:(batch + 1) * CELLS_PER_BATCH].tolist()
            total = tree_sum(table.filter(F.col("cell").isin(chosen)), gradients(flat(), k))
            if total is None:
                continue
            n = total[0]
            seen, loss = seen + int(n), loss + total[1:k + 1]
            gradient = total[k + 1:].reshape(stored["weights"].shape) / n
            gradient[:-1] += shrink * stored["weights"][:-1]
            speed = plan.momentum * stored["speed"] + gradient
            step = rate(epoch * plan.batches + batch, steps, plan.warmup) * rates * speed
            moving = stored["active"][:, None]
            stored["speed"] = np.where(moving, speed, stored["speed"])
            stored["weights"] = stored["weights"] - np.where(moving, step, 0)
        counts = tree_sum(dev, confusions(flat(), k))
        classes = stored["weights"].shape[2]
        counts = (np.zeros((k, classes + 1, classes)) if counts is None
                  else counts.reshape(k, classes + 1, classes))
        metrics = [(s.name, epoch, split, metric, float(value)) for i, s in enumerate(settings)
                   if stored["active"][i] for split, metric, value in (
                       ("train", "loss", loss[i] / max(seen, 1)), ("train", "rows", seen),
                       ("train", "batches", plan.batches), ("eval", "rows", counts[i].sum()),
                       ("eval", "macro_f1", macro_f1(counts[i])))]
        now = spark.createDataFrame(metrics, HISTORY_SCHEMA)
        if plan.patience is not None:
            stopped = early_stop(scores_of(history_of(spark, folder).union(now)), plan.patience)
            names = {r["run"] for r in stopped.filter("stop_epoch is not null").collect()}
            stored["active"] &= ~np.isin(stored["settings"], list(names))
        part = commits.stage(spark, folder, f"epoch={epoch:05d}")
        now.coalesce(1).write.parquet(f"{part}/metrics")
        write_arrays(spark, f"{part}/state", stored)
        commits.finish(spark, part)
    history = history_of(spark, folder)
    best = best_epoch(scores_of(history)).orderBy(
        F.desc("best_value"), "best_epoch", "run").first()
    at = read_arrays(spark, f"{folder}/epoch={best['best_epoch']:05d}/state")
    which = [s.name for s in settings].index(best["run"])
    return LinearModel(at["mean"], at["scale"], at["weights"][:, which]), history


def scores_of(history: DataFrame) -> DataFrame:
    return history.filter("split = 'eval' and metric = 'macro_f1'").select("run", "epoch", "value")
