"""Whole jobs: scan -> label -> split -> write, statistics, fit, predict, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipframe.functions import labels as L
from clipframe.functions.paths import base_name, duration_seconds, join_path
from clipframe.operators import (joins, model, preprocess, scoring, signal, split, stats,
                                 training)
from clipframe.operators.clips import split_rejects
from clipframe.operators.encode import encode_labels, label_dictionary
from clipframe.operators.features import clip_features
from clipframe.sources import commits, manifest, scan, sinks, tables
from clipframe.sources.wav import HEADER_FIELDS, scan_header_files, scan_headers


def label_corpora(paths: DataFrame, mode: str = "strict", path_col: str = "wav_file",
                  corpus_col: str = "corpus") -> DataFrame:
    """``(corpus, wav_file, gender, emotion, label)`` by the rule of each row's corpus.

    A corpus without a rule raises; in quarantine mode its rows have a NULL label.
    """
    path, corpus = F.col(path_col), F.col(corpus_col)
    gender = emotion = F.when(F.lit(False), F.lit(""))
    for name, rule in L.CORPUS_RULES.items():
        own_gender, own_emotion = rule(path, mode)
        gender = gender.when(corpus == name, own_gender)
        emotion = emotion.when(corpus == name, own_emotion)
    if mode == "strict":
        known = corpus.isin(*L.CORPUS_RULES, L.SPLIT_CORPUS)
        unknown = F.raise_error(F.concat(F.lit("no label rule for corpus "),
                                         F.coalesce(corpus, F.lit("NULL"))))
        gender = F.when(F.coalesce(known, F.lit(False)), gender).otherwise(unknown)
    composed = L.with_label(paths.select(corpus_col, path_col), gender, emotion)
    return composed.withColumn("label", F.when(
        corpus == L.SPLIT_CORPUS, L.suffix_label(path)).otherwise(F.col("label")))


def metadata_tables(paths: DataFrame, seed: int = 42, dev_share: float = 0.2,
                    mode: str = "strict", split_corpus: str = L.SPLIT_CORPUS) -> DataFrame:
    """``(corpus, wav_file, label, split)``: dev is a stratified part of one corpus,
    train the rest of it and every other corpus."""
    labelled = label_corpora(paths, mode).select("corpus", "wav_file", "label")
    inside = labelled.filter(F.col("corpus") == split_corpus)
    others = labelled.filter(~F.col("corpus").eqNullSafe(split_corpus))
    divided = split.stratified_split(inside, "label", "wav_file", dev_share, seed)
    return divided.unionByName(others.withColumn("split", F.lit("train")))


def build_metadata(spark: SparkSession, base_dir: str, train_out: str, dev_out: str,
                   clips_out: str | None = None, rejects_out: str | None = None,
                   mode: str = "strict",
                   corpora: Sequence[str] = L.CORPORA) -> DataFrame:
    """Scan the corpora below ``<base>/train`` and write the train and dev CSVs.

    Returns ``(corpus, n, n_train, n_dev, n_rejected)``; ``n`` is checked against the
    scan and the rest says what was written. ``clips_out`` also stores the dev clips
    with their bytes; ``rejects_out`` the names without a label (quarantine mode),
    which raise where it is not given.
    """
    folders = [f"{base_dir.rstrip('/')}/train/{name}" for name in corpora]
    paths = scan.corpus_paths(manifest.list_files(spark, folders), base_dir)
    table = scan.materialise(metadata_tables(paths, mode=mode), "metadata")
    labelled = F.col("label").isNotNull()
    parts = table.groupBy("corpus").agg(
        *[F.count(F.when(labelled & (F.col("split") == s), 1)).alias(f"n_{s}")
          for s in ("train", "dev")], F.count(F.when(~labelled, 1)).alias("n_rejected"))
    counts = scan.materialise(stats.assert_counts(stats.corpus_counts(paths), table)
                              .join(parts, "corpus").withColumn("n", F.when(
                                  F.expr("n = n_train + n_dev + n_rejected"), F.col("n"))
                                  .otherwise(F.raise_error(F.lit("rows of no side")))), "counts")
    if not rejects_out and not counts.filter("n_rejected > 0").isEmpty():
        raise ValueError("some names have no label; give rejects_out to keep them")
    for side, out in (("train", train_out), ("dev", dev_out)):
        part = table.filter((F.col("split") == side) & labelled)
        sinks.write_csv(part.select("wav_file", "label"), out)
    if rejects_out:
        sinks.write_csv(table.filter(~labelled).select("corpus", "wav_file"), rejects_out)
    if clips_out:
        dev = table.filter(F.col("split") == "dev").select("wav_file", "label", "split")
        sinks.write_split_clips(scan.load_clips(dev, "wav_file", clips_per_task=1024), clips_out)
    return counts


def label_annotated(clips: DataFrame, turns: DataFrame, mode: str = "strict",
                    max_seconds: float = L.MAX_SECONDS) -> DataFrame:
    """``(wav_file, gender, emotion, label)`` of annotated dialog clips.

    ``clips``: ``(wav_file, duration_s)``; ``turns``: ``(session, dialog, turn,
    emotion_raw)``, one row per turn. In quarantine mode a clip that cannot be
    judged stays, with NULL label and its ``error``.
    """
    path = F.col("wav_file")
    keyed = clips.select(
        "wav_file", "duration_s", L.iemocap_session(path, mode).alias("session"),
        L.iemocap_dialog(path).alias("dialog"), L.iemocap_turn(path).alias("turn"))
    joined = joins.join_annotations(keyed, turns, ["session", "dialog", "turn"], mode)
    columns = ["wav_file", "gender", "emotion", "label"]
    if mode == "strict":
        kept = joins.usable_clips(joined, max_seconds=max_seconds)
        fields = L.iemocap_fields(path, F.col("emotion_raw"), mode)
        return L.with_label(kept, *fields).select(*columns)
    error = (F.when(F.col("session").isNull(), "no session number in clip name")
             .when(F.col("emotion_raw").isNull(), "no annotated emotion")
             .when(F.col("duration_s").isNull(), "no duration"))
    usable = joins.is_usable(F.col("emotion_raw"), F.col("duration_s"), max_seconds=max_seconds)
    kept = joined.withColumn("error", error).filter(F.col("error").isNotNull() | usable)
    good = F.col("error").isNull()
    fields = L.iemocap_fields(path, F.col("emotion_raw"), mode)
    return L.with_label(kept, *[F.when(good, f) for f in fields]).select(*columns, "error")


def clip_headers(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """``(path, num_frames, sample_rate, num_channels, bits, error)`` of every clip.

    ``source`` is a folder, the names of a manifest or a clip table. Files are read by
    range; an ingested table has the headers as columns; of any other clip table the
    bytes are looked at.
    """
    if isinstance(source, str):
        source = manifest.list_files(spark, source)
    names = [f.name for f in HEADER_FIELDS]
    if set(names) <= set(source.columns):
        return source.select("path", *names)
    if "content" not in source.columns:
        return scan_header_files(manifest.dealt(source))
    return scan_headers(source)


def _clips(spark: SparkSession, source: DataFrame | str) -> tuple[DataFrame, str | None]:
    """Clips to decode and, if their files are to be read, the column that names them."""
    if isinstance(source, str):
        source = manifest.list_files(spark, source)
    return (source, None) if "content" in source.columns else (manifest.balanced(source), "path")


def annotated_corpus(spark: SparkSession, root: str, mode: str = "strict",
                     clips: DataFrame | None = None) -> DataFrame:
    """Dialog corpus: annotation files below ``root``; clips there too, or in a table."""
    clips = manifest.list_files(spark, root) if clips is None else clips
    headers = scan.materialise(clip_headers(spark, clips), "headers")
    paths = clips.select(F.col("path").alias("wav_file"))
    clips = headers.select(F.col("path").alias("wav_file"), duration_seconds(
        F.col("num_frames"), F.col("sample_rate")).alias("duration_s"))
    path = F.col("wav_file")
    keys = paths.select(L.iemocap_session(path, mode).alias("session"),
                        L.iemocap_dialog(path).alias("dialog"))
    files = tables.annotated(manifest.list_files(spark, root, "*.txt"), "path")
    missing = joins.missing_annotations(
        keys, files.select("session", "dialog"), ["session", "dialog"]).limit(5).collect()
    if missing and mode == "strict":
        raise FileNotFoundError(f"no annotation file for {[tuple(r) for r in missing]}")
    lines = tables.annotated(manifest.read_lines(files))
    turns = tables.annotation_turns(lines, ["session", "dialog"], ["line_id"])
    return label_annotated(clips, turns, mode)


def dataset_stats(spark: SparkSession, source: DataFrame | str
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(durations, formats, audit)`` of every clip of a folder or clip table."""
    headers = scan.materialise(clip_headers(spark, source), "headers")
    timed = headers.withColumn("duration_s", duration_seconds(
        F.col("num_frames"), F.col("sample_rate")))
    return (stats.duration_stats(timed),
            stats.distinct_values(headers.filter(F.col("error").isNull()),
                                  ["sample_rate", "num_channels"]),
            stats.audit_headers(headers))


def mean_dbfs(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """``(mean_dbfs, n_clips, n_rejected)`` of a folder, the names of a manifest or a clip
    table: the target of the gain normalisation."""
    clips, path_col = _clips(spark, source)
    loud = signal.clip_loudness(clips, path_col=path_col)
    return stats.mean_level(loud, rejects=True)


def resolve_paths(df: DataFrame, base_dir: str = "", path_col: str = "wav_file") -> DataFrame:
    """Add ``input_values``, the full path of each clip."""
    return df.withColumn("input_values", join_path(base_dir, F.col(path_col)))


def training_features(metadata: DataFrame, dictionary: DataFrame, spec: preprocess.ClipSpec,
                      base_dir: str = "", clips_per_task: int = 1024) -> DataFrame:
    """``(wav_file, label_id, features, error)`` of the clips a metadata table names."""
    rows = encode_labels(resolve_paths(metadata, base_dir), dictionary)
    known = F.when(F.col("label_error").isNull(), F.col("input_values"))
    clips = scan.load_clips(rows.withColumn("input_values", known), "input_values", clips_per_task)
    clips = clips.withColumn("load_error", F.coalesce("label_error", "load_error"))
    return clip_features(clips, spec, keep=["wav_file", "label_id"])


def fit(train: DataFrame, dev: DataFrame, spec: preprocess.ClipSpec, base_dir: str = "",
        model_out: str | None = None, metrics_out: str | None = None,
        reg_params: Sequence[float] = (0.001, 0.01, 0.1)) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train metadata, choose by macro-F1 on the dev metadata.

    The features of either side are written once. Returns the model and the
    metric history, counts of samples and of rejected clips included.
    """
    dictionary = label_dictionary(train)
    sides, rejects = {}, {}
    for name, metadata in (("train", train), ("dev", dev)):
        table = scan.materialise(
            training_features(metadata, dictionary, spec, base_dir), f"features-{name}")
        sides[name], rejects[name] = split_rejects(table)
    best, history = model.select_model(sides["train"], sides["dev"], reg_params)
    counts = [("fit", 0, name, what, float(side.count()))
              for what, part in (("samples", sides), ("rejected", rejects))
              for name, side in part.items()]
    history = history.unionByName(
        history.sparkSession.createDataFrame(counts, model.HISTORY_SCHEMA))
    if model_out:
        sinks.write_model(best, model_out, dictionary)
    if metrics_out:
        sinks.append_metrics(history, metrics_out, "fit")
    return best, history


def fit_epochs(train: DataFrame, dev: DataFrame, spec: preprocess.ClipSpec, out: str,
               settings: Sequence[training.Setting], plan: training.Plan = training.Plan(),
               base_dir: str = "") -> tuple[training.LinearModel, DataFrame]:
    """Fit by epochs on the train metadata, all settings in one pass, scored on dev.

    ``out`` holds the features of either side, the epochs and, at the end, the best
    model with its labels; each is there as a whole or not at all. Called again after a
    failure, the job goes on with what is there. Returns the model and the metric history.
    """
    spark, dictionary = train.sparkSession, label_dictionary(train)
    sides = {}
    for name, metadata in (("train", train), ("dev", dev)):
        part = f"{out.rstrip('/')}/features/side={name}"
        if not commits.is_complete(spark, part):
            commits.stage(spark, f"{out.rstrip('/')}/features", f"side={name}")
            training_features(metadata, dictionary, spec, base_dir).write.parquet(f"{part}/rows")
            commits.finish(spark, part)
        sides[name], _ = split_rejects(spark.read.parquet(f"{part}/rows"))
    best, history = training.train(sides["train"], sides["dev"], f"{out.rstrip('/')}/epochs",
                                   settings, plan, key="wav_file")
    best.save(spark, f"{out.rstrip('/')}/models", dictionary)
    return best, history


def predict(spark: SparkSession, source: DataFrame | str, fitted: PipelineModel | str,
            spec: preprocess.ClipSpec, out: str | None = None,
            dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Label every clip of a folder or clip table: ``(predictions, rejected)``.

    Predictions are ``(wav_file, label)`` with base names, as in the CSV. The labels
    are those stored with the model; a model that is not stored needs ``dictionary``.
    """
    if isinstance(fitted, str):
        dictionary = model.load_labels(spark, fitted) if dictionary is None else dictionary
        fitted = model.load_model(fitted)
    elif dictionary is None:
        raise ValueError("give the dictionary of a model that is not stored")
    clips, path_col = _clips(spark, source)
    features = scan.materialise(clip_features(clips, spec, path_col=path_col), "features")
    good, rejected = split_rejects(features)
    labelled = model.predicted_labels(model.predict(fitted, good), dictionary)
    predictions = labelled.select(base_name(F.col("path")).alias("wav_file"), "label")
    if out:
        sinks.write_csv(predictions, out)
    return predictions, rejected.select("path", "error")


def score(pred: DataFrame, truth: DataFrame, how: str = "strict") -> DataFrame:
    """Macro-F1 of a prediction table against a truth table, matched by ``wav_file``."""
    return scoring.macro_f1(joins.pair_predictions(pred, truth, how=how))

