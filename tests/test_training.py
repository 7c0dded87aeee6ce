"""Fits by epochs next to plain loops: batches, settings, stops, resuming."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipframe.operators import training as T
from clipframe.operators.scoring import macro_f1
from clipframe.plans import jobs
from clipframe.operators.preprocess import ClipSpec
from clipframe.sources import commits
from conftest import tone, wav


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 3, 240)
    x = rng.normal(size=(240, 5)) * [1, 10, 0.1, 1, 0] + labels[:, None] * [1, 4, 0, -1, 0] + 7
    rows = [(f"k{i}", int(c), v.tolist()) for i, (c, v) in enumerate(zip(labels, x))]
    df = spark.createDataFrame(rows, "path string, label_id int, features array<double>")
    return df.filter("label_id >= 0").repartition(3), df.limit(60), labels, x


def plain(spark, data, setting, plan):
    """The same fit in one process, over the same cells."""
    df, _, _, _ = data
    cells = plan.batches * T.CELLS_PER_BATCH
    rows = df.select("label_id", "features", F.pmod(F.xxhash64("path", F.lit(plan.seed)), F.lit(cells))
                     .alias("cell")).collect()
    x, y = np.array([r.features for r in rows]), np.array([r.label_id for r in rows])
    cell = np.array([r.cell for r in rows])
    scale = x.std(axis=0)
    x = T.with_one((x - x.mean(axis=0)) / np.where(scale > 1e-12, scale, 1))
    w, speed = np.zeros((6, 3)), np.zeros((6, 3))
    for epoch in range(plan.epochs):
        order = np.random.default_rng([plan.seed, epoch]).permutation(cells)
        for batch in range(plan.batches):
            mine = np.isin(cell, order[batch * T.CELLS_PER_BATCH:(batch + 1) * T.CELLS_PER_BATCH])
            z = np.exp(x[mine] @ w)
            g = x[mine].T @ (z / z.sum(axis=1, keepdims=True) - np.eye(3)[y[mine]]) / mine.sum()
            g[:-1] += setting.reg_param * w[:-1]
            speed = plan.momentum * speed + g
            at = T.rate(epoch * plan.batches + batch, plan.epochs * plan.batches, plan.warmup)
            w = w - at * setting.learning_rate * speed
    return w


PLAN = T.Plan(epochs=3, batches=2)
SETTINGS = [T.Setting("a", 0.1), T.Setting("b", 0.3, 0.01), T.Setting("c", 0.01)]


def test_equals_a_plain_loop_for_all_settings_at_once(spark, data, tmp_path):
    folder = str(tmp_path / "all")
    T.train(data[0], data[1], folder, SETTINGS, PLAN)
    state = T.read_arrays(spark, f"{folder}/epoch=00002/state")
    for i, setting in enumerate(SETTINGS):
        assert np.allclose(state["weights"][:, i], plain(spark, data, setting, PLAN), atol=1e-9)


def test_one_setting_alone_gives_the_same(spark, data, tmp_path):
    T.train(data[0], data[1], str(tmp_path / "all"), SETTINGS, PLAN)
    T.train(data[0], data[1], str(tmp_path / "one"), SETTINGS[1:2], PLAN)
    both = [T.read_arrays(spark, f"{tmp_path}/{f}/epoch=00002/state")["weights"] for f in ("all", "one")]
    assert np.allclose(both[0][:, 1], both[1][:, 0], atol=1e-12)


def test_a_run_goes_on_after_its_last_whole_epoch(spark, data, tmp_path, monkeypatch):
    whole, _ = T.train(data[0], data[1], str(tmp_path / "whole"), SETTINGS, PLAN)
    folder, finish, ended = str(tmp_path / "cut"), commits.finish, []

    def dies(spark, part):
        if part.endswith("epoch=00001") and not ended:
            ended.append(part)
            raise RuntimeError("lost")
        finish(spark, part)

    monkeypatch.setattr(commits, "finish", dies)
    with pytest.raises(RuntimeError):
        T.train(data[0], data[1], folder, SETTINGS, PLAN)
    assert T.epochs_of(spark, folder) == ["epoch=00000"]
    resumed, history = T.train(data[0], data[1], folder, SETTINGS, PLAN)
    assert all(np.array_equal(a, b) for a, b in zip(whole, resumed))
    again, once = T.train(data[0], data[1], folder, SETTINGS, PLAN)
    assert all(np.array_equal(a, b) for a, b in zip(whole, again))
    assert once.count() == history.count() == 3 * 3 * 5
    with pytest.raises(ValueError, match="other settings"):
        T.train(data[0], data[1], folder, SETTINGS[:1], PLAN)


def test_patience_stops_each_setting(spark, data, tmp_path):
    settings = [T.Setting("still", 0.0), T.Setting("moves", 0.2)]
    plan = T.Plan(epochs=4, batches=1, patience=1)
    _, history = T.train(data[0], data[1], str(tmp_path / "s"), settings, plan)
    epochs = {r.run: r.n for r in history.filter("metric = 'loss'").groupBy("run").agg(
        F.count("value").alias("n")).collect()}
    assert epochs["still"] == 2 <= epochs["moves"] <= 4


def test_scores_are_those_of_the_library(spark, data, tmp_path):
    best, history = T.train(data[0], data[1], str(tmp_path / "m"), SETTINGS, PLAN)
    best.save(spark, str(tmp_path / "models"), data[0].select("label_id").distinct())
    stored, labels = T.load_linear(spark, str(tmp_path / "models"))
    assert all(np.array_equal(a, b) for a, b in zip(best, stored)) and labels.count() == 3
    scored = T.predict_linear(stored, data[1].withColumnRenamed("label_id", "truth"))
    got = macro_f1(scored.withColumnRenamed("label_id", "pred")).first().macro_f1
    top = history.filter("metric = 'macro_f1'").agg(F.max("value")).first()[0]
    assert got == pytest.approx(top, abs=1e-12)
    assert scored.filter("abs(aggregate(scores, 0D, (a, x) -> a + x) - 1) > 1e-9").count() == 0


def test_odd_inputs(spark, data, tmp_path):
    empty = data[0].limit(0)
    with pytest.raises(ValueError, match="no rows"):
        T.train(empty, data[1], str(tmp_path / "e"), SETTINGS)
    best, history = T.train(data[0], empty, str(tmp_path / "d"), SETTINGS[:1], T.Plan(epochs=1, batches=1))
    assert history.filter("metric = 'rows' and split = 'eval'").first().value == 0
    assert T.predict_linear(best, empty).count() == 0
    unknown = data[1].withColumn("label_id", F.lit(9))
    _, history = T.train(data[0], unknown, str(tmp_path / "u"), SETTINGS[:1], T.Plan(epochs=1, batches=1))
    assert history.filter("metric = 'macro_f1'").first().value == 0.0
    with pytest.raises(ValueError, match="names"):
        T.train(data[0], data[1], str(tmp_path / "n"), [SETTINGS[0], SETTINGS[0]])
    with pytest.raises(FileNotFoundError):
        T.load_linear(spark, str(tmp_path / "none"))


def test_tree_of_many_tasks(spark, data):
    def count(labels, x):
        return np.array([len(x), x.sum()])

    for tasks, fan_in in ((1, 2), (7, 2), (13, 3), (40, 64)):
        got = T.tree_sum(data[0].repartition(tasks), count, fan_in)
        assert got[0] == 240 and got[1] == pytest.approx(data[3].sum())
    assert T.tree_sum(data[0].limit(0), count) is None


def test_job_over_files(spark, tmp_path):
    rows = []
    for i in range(24):
        name = f"c{i}.wav"
        (tmp_path / name).write_bytes(wav(tone(200 + 900 * (i % 2) + 5 * i, 0.1)))
        rows.append((name, ("low", "high")[i % 2]))
    metadata = spark.createDataFrame(rows + [("none.wav", "low")], "wav_file string, label string")
    out, spec = str(tmp_path / "out"), ClipSpec(apply_dbfs_norm=False)
    args = (metadata, metadata.limit(12), spec, out, SETTINGS[:2], PLAN, str(tmp_path))
    best, history = jobs.fit_epochs(*args)
    assert history.filter("metric = 'macro_f1'").agg(F.max("value")).first()[0] == 1.0
    assert history.filter("split = 'train' and metric = 'rows' and value = 24").count() == 6
    again, _ = jobs.fit_epochs(*args)
    assert all(np.array_equal(a, b) for a, b in zip(best, again))
    _, labels = T.load_linear(spark, f"{out}/models")
    assert {r.label for r in labels.collect()} == {"low", "high"}
