"""The registered queries: every operator, run over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipframe.functions import labels as L
from clipframe.functions.paths import base_name, duration_seconds, join_path, parent_name
from clipframe.functions.scores import argmax, softmax
from clipframe.operators import (batching, encode, features, joins, long_clips, model, scoring,
                                 signal, stats, training)
from clipframe.operators.augment import DEFAULT_AUGMENTATIONS
from clipframe.operators.clips import split_rejects
from clipframe.operators.kept_stats import CorpusStats
from clipframe.operators.preprocess import ClipSpec, plan_batches, preprocess
from clipframe.operators.split import stratified_split
from clipframe.plans import jobs
from clipframe.plans import standins as S
from clipframe.session import new_folder, spread
from clipframe.sources import manifest, scan, sinks, tables
from clipframe.sources.manifest import Manifest
from clipframe.sources.wav import scan_header_files, scan_headers, wav_bytes

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _sum(values: Column, of=lambda v: v) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + of(v.cast("double")))


def _sum_abs(values: Column) -> Column:
    return _sum(values, F.abs)


def _labelled(paths: DataFrame, rule) -> DataFrame:
    return L.with_label(paths, *rule(F.col("wav_file")))


# --- labels and metadata -------------------------------------------------

@query
def label_coraa(spark, sf_dir):
    paths = S.coraa_paths(S.table(spark, sf_dir, "documents"))
    return paths.select("wav_file", L.suffix_label(F.col("wav_file")).alias("label"))


@query
def label_baved(spark, sf_dir):
    return _labelled(S.baved_paths(S.table(spark, sf_dir, "events")), L.baved_fields)


@query
def label_emovo(spark, sf_dir):
    return _labelled(S.emovo_paths(S.table(spark, sf_dir, "events")), L.emovo_fields)


@query
def label_ravdess(spark, sf_dir):
    return _labelled(S.ravdess_paths(S.table(spark, sf_dir, "events")), L.ravdess_fields)


@query
def label_quarantine(spark, sf_dir):
    """Names cut short after the gender: no label instead of an error."""
    paths = S.baved_paths(S.table(spark, sf_dir, "events"))
    path = F.col("wav_file")
    cut = F.concat(F.substring_index(path, "-", 3), F.lit(".wav"))
    odd = paths.select(F.when(path.contains("/error/"), cut).otherwise(path).alias("wav_file"))
    labelled = L.with_label(odd, *L.baved_fields(path, "quarantine"))
    complete = F.col("label").isNotNull()
    return labelled.select("wav_file", *[F.when(complete, F.col(c)).alias(c)
                                         for c in ("gender", "emotion", "label")])


@query
def annotation_turns(spark, sf_dir):
    lines = S.dialog_lines(spread(S.table(spark, sf_dir, "events"), "event_id"))
    return tables.annotation_turns(lines, ["session", "dialog"], ["line_no"])


@query
def label_iemocap(spark, sf_dir):
    events = spread(S.table(spark, sf_dir, "events"), "event_id")
    turns = tables.annotation_turns(S.dialog_lines(events), ["session", "dialog"], ["line_no"])
    return jobs.label_annotated(S.dialog_clips(events), turns)


@query
def annotated_corpus(spark, sf_dir):
    """The whole job over annotation files, one for each dialog, and a table of clip headers."""
    events, root = spread(S.table(spark, sf_dir, "events"), "event_id"), new_folder(spark, "dialogs")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"])
    files = S.dialog_lines(events).groupBy("session", "dialog").agg(
        F.encode(F.array_join(lines, "\n"), "UTF-8").alias("content"))
    name = F.concat_ws("/", "session", F.lit("dialog/EmoEvaluation"), F.concat("dialog", F.lit(".txt")))
    sinks.export_clips(files, root, name, key="dialog")
    clips = S.dialog_clips(events).select(
        F.col("wav_file").alias("path"), F.floor(F.col("duration_s") * 16_000).alias("num_frames"),
        F.lit(16_000).alias("sample_rate"), F.lit(1).alias("num_channels"), F.lit(16).alias("bits"),
        F.lit(None).cast("string").alias("error"))
    return jobs.annotated_corpus(spark, root, clips=clips)


@query
def annotation_missing(spark, sf_dir):
    return joins.missing_annotations(S.table(spark, sf_dir, "documents"),
                                     S.table(spark, sf_dir, "labels"), ["doc_id"])


@query
def union_corpora(spark, sf_dir):
    labelled = jobs.label_corpora(S.corpus_paths(spark, sf_dir))
    return labelled.select("corpus", "wav_file", "label")


@query
def union_counts(spark, sf_dir):
    paths = S.corpus_paths(spark, sf_dir)
    labelled = jobs.label_corpora(paths)
    parts = {name: labelled.filter(F.col("corpus") == name).select("wav_file", "label")
             for name in L.CORPORA}
    return stats.assert_counts(stats.corpus_counts(paths), stats.union_all(parts))


@query
def build_metadata(spark, sf_dir):
    return jobs.metadata_tables(S.corpus_paths(spark, sf_dir))


@query
def build_metadata_files(spark, sf_dir):
    """Files scanned, labelled, split, written and read back; some names have no label."""
    names = S.document_paths(S.table(spark, sf_dir, "documents"))
    folder = new_folder(spark, "corpora")
    clip = wav_bytes(F.lit(bytearray(2)), F.lit(16_000), F.lit(1), F.lit(16))
    sinks.export_clips(names.withColumn("content", clip), folder, F.col("wav_file"), key="wav_file")
    sides = {side: new_folder(spark, side) for side in ("train", "dev", "rejects")}
    jobs.build_metadata(spark, f"{folder}/data", sides["train"], sides["dev"], mode="quarantine",
                        rejects_out=sides["rejects"], corpora=("CORAA_SER", "BAVED"))
    written = None
    for side, out in sides.items():
        rows = (tables.read_metadata(spark, out, "corpus string, wav_file string")
                .withColumn("label", F.lit(None).cast("string")) if side == "rejects"
                else tables.read_metadata(spark, out))
        rows = rows.select(F.lit(side).alias("side"), "wav_file", "label")
        written = rows if written is None else written.unionByName(rows)
    corpus = F.split(F.substring_index("wav_file", "/data/train/", -1), "/")[0]
    return written.groupBy("side", corpus.alias("corpus"), "label").agg(
        F.count(F.lit(1)).alias("n"))


@query
def class_counts(spark, sf_dir):
    labelled = jobs.label_corpora(S.corpus_paths(spark, sf_dir))
    return labelled.groupBy("corpus", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def path_join(spark, sf_dir):
    pages = S.table(spark, sf_dir, "pages")
    relative = F.substring_index("url", "://", -1)
    return pages.select(
        "page_id",
        join_path("", relative).alias("no_base"),
        join_path("data/test", relative).alias("plain"),
        join_path("data/test/", relative).alias("slash"),
        join_path("data/test", F.concat(F.lit("/"), relative)).alias("absolute"))


@query
def basename(spark, sf_dir):
    pages = S.table(spark, sf_dir, "pages")
    return pages.select("page_id", base_name(F.col("url")).alias("base"),
                        parent_name(F.col("url")).alias("parent"))


@query
def name_collisions(spark, sf_dir):
    return sinks.name_collisions(S.table(spark, sf_dir, "pages"), "url")


# --- split, dictionary ---------------------------------------------------

@query
def stratified_split_by_lang(spark, sf_dir):
    documents = S.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return stratified_split(documents, "lang", "doc_id")


@query
def stratified_split_scale(spark, sf_dir):
    """Many rows per class."""
    lines = S.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("clip"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("label"))
    return stratified_split(lines, "label", "clip")


@query
def dev_clips(spark, sf_dir):
    """The split stored with its audio bytes, read back."""
    wavs = stratified_split(S.document_wavs(spark, sf_dir), "lang", "doc_id")
    stored = sinks.write_split_clips(wavs, new_folder(spark, "dev-clips"))
    return stored.groupBy("split", "lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("content")).alias("bytes"))


@query
def label_dictionary(spark, sf_dir):
    documents = encode.label_dictionary(S.table(spark, sf_dir, "documents"), "lang")
    events = encode.label_dictionary(S.table(spark, sf_dir, "events"), "event_type")
    return (documents.select(F.lit("lang").alias("source"), "label", "label_id")
            .unionByName(events.select(F.lit("event_type").alias("source"), "label", "label_id")))


@query
def label_encode(spark, sf_dir):
    documents = S.table(spark, sf_dir, "documents").select("doc_id", "source")
    known = documents.join(S.table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    # event types are labels the dictionary does not know
    rows = documents.unionByName(S.table(spark, sf_dir, "events").select(
        (-1 - F.col("event_id")).alias("doc_id"), F.col("event_type").alias("source")))
    return encode.encode_labels(rows, encode.label_dictionary(known, "source"), "source")


@query
def label_decode(spark, sf_dir):
    documents = S.table(spark, sf_dir, "documents").select("doc_id", "lang")
    dictionary = encode.label_dictionary(documents, "lang")
    coded = encode.encode_labels(documents, dictionary, "lang").select("doc_id", "label_id")
    return encode.decode_labels(coded, dictionary, "lang")


# --- statistics ----------------------------------------------------------

ROUNDED = ("min_s", "max_s", "mean_s", "median_s", "std_s", "total_minutes")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ROUNDED})


@query
def duration_stats(spark, sf_dir):
    return _rounded(stats.duration_stats(S.table(spark, sf_dir, "events"), "value"))


@query
def duration_stats_by_type(spark, sf_dir):
    return _rounded(stats.duration_stats(S.table(spark, sf_dir, "events"), "value", ["event_type"]))


@query
def clip_duration_stats(spark, sf_dir):
    headers = scan_headers(S.document_wavs(spark, sf_dir), keep=["lang"])
    timed = headers.withColumn("duration_s", duration_seconds(
        F.col("num_frames"), F.col("sample_rate")))
    return _rounded(stats.duration_stats(timed, keys=["lang"]))


@query
def wav_header(spark, sf_dir):
    return scan_headers(S.document_wavs(spark, sf_dir), keep=["doc_id"])


@query
def wav_header_files(spark, sf_dir):
    """Headers read by range from files; every French one has a chunk before its data."""
    wavs = S.document_wavs(spark, sf_dir).withColumn("content", F.when(
        F.col("lang") == "fr", S.with_list_chunk(F.col("content"))).otherwise(F.col("content")))
    folder = _wav_files(spark, wavs)
    paths = scan.scan_paths(spark, folder, path_col="path")
    return _document_ids(scan_header_files(manifest.dealt(paths)))


def _wav_files(spark, wavs: DataFrame) -> str:
    """A new folder with a file per clip, ``clip <doc_id>.wav``."""
    folder = new_folder(spark, "wavs")
    name = F.concat(F.lit("clip "), F.col("doc_id"), F.lit(".wav"))
    sinks.export_clips(wavs, folder, name, key="doc_id")
    return folder


def _document_ids(clips: DataFrame, path: str = "path") -> DataFrame:
    doc_id = F.regexp_extract(path, r"clip (-?\d+)\.wav$", 1).cast("bigint")
    return clips.select(doc_id.alias("doc_id"), *[c for c in clips.columns if c != path])


def _both_forms(spark, sf_dir, job: Callable) -> DataFrame:
    """A job over a folder and over the table ingested from it."""
    folder = _wav_files(spark, S.document_wavs(spark, sf_dir))
    table = scan.ingest(spark, folder, new_folder(spark, "clips"))
    return job(spark, folder).withColumn("form", F.lit("folder")).unionByName(
        job(spark, table).withColumn("form", F.lit("table")))


@query
def dataset_stats_job(spark, sf_dir):
    return _rounded(_both_forms(spark, sf_dir, lambda *given: jobs.dataset_stats(*given)[0]))


@query
def mean_dbfs_job(spark, sf_dir):
    return _both_forms(spark, sf_dir, jobs.mean_dbfs).withColumn(
        "mean_dbfs", F.round("mean_dbfs", 6))


@query
def distinct_formats(spark, sf_dir):
    headers = scan_headers(S.document_wavs(spark, sf_dir), keep=["doc_id"])
    return stats.distinct_values(headers, ["sample_rate", "num_channels"])


@query
def header_audit(spark, sf_dir):
    return stats.audit_headers(scan_headers(S.document_wavs(spark, sf_dir), keep=["doc_id"]))


@query
def clip_dbfs(spark, sf_dir):
    levels = signal.clip_loudness(S.document_wavs(spark, sf_dir), keep=["doc_id"])
    return levels.withColumn("dbfs", F.round("dbfs", 6))


@query
def mean_dbfs(spark, sf_dir):
    levels = signal.clip_loudness(S.document_wavs(spark, sf_dir), keep=["lang"])
    means = stats.mean_level(levels, keys=["lang"])
    return means.withColumn("mean_dbfs", F.round("mean_dbfs", 6))


@query
def sample_dbfs(spark, sf_dir):
    """Clips stored one sample per row: a clip per user."""
    sample = F.greatest(F.lit(-32768.0), F.least(F.lit(32767.0),
                                                 F.round((F.col("value") - 245) * 100)))
    levels = signal.sample_loudness(S.table(spark, sf_dir, "events"), ["user_id"], sample)
    return levels.withColumn("dbfs", F.round("dbfs", 6))


# --- signals -------------------------------------------------------------

@query
def wav_decode(spark, sf_dir):
    clips = signal.decode_clips(S.document_wavs(spark, sf_dir), keep=["doc_id"])
    return clips.select(
        "doc_id", "sample_rate", "num_channels", "num_frames",
        F.round(_sum(F.col("channels")[0]), 6).alias("first_sum"),
        F.round(_sum(F.element_at("channels", -1)), 6).alias("last_sum"), "error")


@query
def pcm_decode(spark, sf_dir):
    clips = signal.decode_pcm(S.document_wavs(spark, sf_dir), keep=["doc_id"])
    total = F.aggregate("pcm", F.lit(0).cast("bigint"), lambda acc, v: acc + v)
    return clips.select(
        "doc_id", "num_frames", F.array_min("pcm").alias("lowest"),
        F.array_max("pcm").alias("highest"), total.alias("total"), "error")


@query
def rejected_clips(spark, sf_dir):
    """Documents as WAV files together with pages, which are none: reasons kept."""
    pages = S.table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("html").cast("binary").alias("content"))
    wavs = S.document_wavs(spark, sf_dir).select(F.lit("wav").alias("kind"), "content")
    done = signal.clip_loudness(wavs.unionByName(pages), keep=["kind"])
    return done.groupBy("kind", F.coalesce("error", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"))


@query
def gain_normalise(spark, sf_dir):
    spec = ClipSpec()
    clips = signal.normalise_gain(S.document_wavs(spark, sf_dir), spec.target_dbfs, ["doc_id"])
    return clips.select(
        "doc_id", F.size("samples").alias("n"), F.round(_sum(F.col("samples")), 6).alias("total"),
        F.round(F.array_min("samples").cast("double"), 6).alias("lowest"),
        F.round(F.array_max("samples").cast("double"), 6).alias("highest"), "error")


@query
def mono_mix(spark, sf_dir):
    clips = signal.mono_clips(S.document_wavs(spark, sf_dir), keep=["doc_id"])
    return clips.select(
        "doc_id", F.size("samples").alias("n"), F.round(_sum(F.col("samples")), 6).alias("total"),
        F.round(_sum(F.col("samples"), lambda v: v * v), 4).alias("energy"), "error")


@query
def resample(spark, sf_dir):
    waves = signal.resample_waves(S.table(spark, sf_dir, "embeddings"), "embedding",
                                  22_050, 16_000, ["vec_id"])
    return waves.select(
        "vec_id", F.size("samples").alias("n"), F.round(_sum(F.col("samples")), 4).alias("total"),
        F.round(F.array_max("samples").cast("double"), 4).alias("highest"))


@query
def standardise(spark, sf_dir):
    waves = signal.standardise_waves(S.table(spark, sf_dir, "embeddings"), "embedding", ["vec_id"])
    return waves.select(
        "vec_id", F.round(F.col("samples")[0].cast("double"), 5).alias("first"),
        F.round(F.element_at("samples", -1).cast("double"), 5).alias("last"),
        F.round(_sum_abs(F.col("samples")), 4).alias("absolute"))


@query
def noise_augment(spark, sf_dir):
    spec = DEFAULT_AUGMENTATIONS[1]
    waves = signal.augment_waves(S.table(spark, sf_dir, "embeddings"), "embedding", 16_000,
                                 [spec], "vec_id")
    return waves.select(
        "vec_id", F.round(_sum(F.col("samples")), 5).alias("total"),
        F.round(_sum_abs(F.col("samples")), 5).alias("absolute"))


@query
def augment_compose(spark, sf_dir):
    """Both default augmentations in order, on whole documents as 16 kHz clips."""
    spec = ClipSpec(apply_augmentation=True)
    wavs = S.document_wavs(spark, sf_dir).withColumn("split", F.lit("train"))
    done = preprocess(wavs, spec, key="doc_id", split_col="split", augment=True)
    return done.select("batch_id", "pos", "doc_id", "n_valid",
                       F.round(_sum_abs(F.col("input_values")), 3).alias("absolute"), "error")


@query
def pitch_shift(spark, sf_dir):
    """Whole documents as mono clips, half of them shifted; the others come out as they were."""
    spec = {**DEFAULT_AUGMENTATIONS[0], "p": 0.5}
    mono = signal.mono_clips(S.document_wavs(spark, sf_dir), keep=["doc_id"]).filter("error is null")
    both = signal.augment_waves(mono.select("doc_id", F.col("samples").alias("before")), "before",
                                16_000, [spec], "doc_id", keep=["before"])

    def state(column: str, *names: str) -> list[Column]:
        """What the two forms are compared by: no waveform is shuffled."""
        parts = F.size(column), F.xxhash64(column), _sum(F.col(column), lambda v: v * v)
        return [p.alias(n) for p, n in zip(parts, names)]

    states = scan.materialise(both.select(
        "doc_id", *state("before", "n_before", "hash_before", "energy_before"),
        *state("samples", "n", "hash", "energy")), "states")
    pairs = states.select("doc_id", "n_before", "hash_before", "energy_before").join(
        states.select("doc_id", "n", "hash", "energy"), "doc_id")
    share = F.when(F.col("energy_before") == 0, 1.0).otherwise(
        F.col("energy") / F.when(F.col("energy_before") != 0, F.col("energy_before")))
    moved = (F.col("n") != F.col("n_before")) | (F.col("hash") != F.col("hash_before"))
    return pairs.select("doc_id", "n", F.when(F.col("n") >= 4_096, moved).alias("is_shifted"),
                        share.between(0, 2).alias("energy_kept"))


def _tones(spark, sf_dir) -> DataFrame:
    """A pure tone of half a second for each supplier, ``(s_suppkey, bin, samples)``.

    ``bin`` counts 31.25 Hz, one line of a spectrum of 512 samples at 16 kHz.
    """
    rows = spread(S.table(spark, sf_dir, "supplier"), "s_suppkey").select(
        F.col("s_suppkey").cast("bigint").alias("s_suppkey"),
        (16 + F.col("s_suppkey") % 48).cast("int").alias("bin"))
    turn = 2 * np.pi / 512
    wave = F.transform(F.sequence(F.lit(0), F.lit(8_191)), lambda i: (
        F.sin(i * F.col("bin") * turn) / 2).cast("float"))
    # 48 waves in all, each made once
    waves = rows.select("bin").distinct().select(F.col("bin").alias("of_bin"), wave.alias("samples"))
    return rows.join(F.broadcast(waves), F.col("bin").eqNullSafe(F.col("of_bin")), "left").drop("of_bin")


@query
def tone_features(spark, sf_dir):
    """Where the spectral features see a pure tone: its centre, in lines, and the frequency of
    the line above it, where 85 % of the energy is reached."""
    table = features.wave_features(_tones(spark, sf_dir), "samples", 16_000, ["s_suppkey", "bin"])
    return table.select("s_suppkey", F.round(F.col("features")[0], 4).alias("rms"),
                        F.round(F.col("features")[4] / 31.25, 3).alias("centroid"),
                        F.col("features")[5].cast("double").alias("roll_off"), "error")


@query
def shifted_tones(spark, sf_dir):
    """Every tone moved up by four semitones: its length, its centre within a hundredth and
    its energy away from the ends within a tenth."""
    tones = _tones(spark, sf_dir)
    spec = {"name": "pitch_shift", "min_semitones": 4, "max_semitones": 4, "p": 1.0}
    moved = signal.augment_waves(tones, "samples", 16_000, [spec], "s_suppkey", keep=["bin"])
    middle = moved.select("s_suppkey", "bin", F.size("samples").alias("n"),
                          F.slice("samples", 2_049, 4_096).alias("samples"))
    seen = features.wave_features(middle, "samples", 16_000, ["s_suppkey", "bin", "n"])
    wanted = F.col("bin") * 31.25 * 2 ** (4 / 12)
    return seen.select(
        "s_suppkey", "n", (F.abs(F.col("features")[4] / wanted - 1) < 0.01).alias("is_moved"),
        (F.abs(F.col("features")[0] / (0.5 / 2 ** 0.5) - 1) < 0.1).alias("is_kept"))


@query
def augment_none(spark, sf_dir):
    """The training chain with both augmentations drawn for no clip: it is the plain chain."""
    wavs = S.document_wavs(spark, sf_dir).withColumn("split", F.lit("train"))
    dictionary = encode.label_dictionary(S.table(spark, sf_dir, "documents"), "lang")
    spec = ClipSpec(apply_augmentation=True, augmentations=[
        {**a, "p": 0.0} for a in DEFAULT_AUGMENTATIONS])
    done = preprocess(wavs, spec, key="doc_id", dictionary=dictionary, label="lang",
                      split_col="split", augment=True)
    return _batch_summary(done, "label_id")


@query
def pad_batch(spark, sf_dir):
    spec = ClipSpec(pad_to_multiple_of=8)
    plan = plan_batches(S.document_wavs(spark, sf_dir), spec, "doc_id")
    return plan.select("doc_id", "batch_id", "pos", "pad_to", F.col("plan_error").alias("error"))


def _batch_summary(done: DataFrame, *extra: str) -> DataFrame:
    return done.select(
        "batch_id", "pos", "doc_id", *extra, "n_valid",
        F.size("input_values").alias("padded"),
        F.aggregate("attention_mask", F.lit(0), lambda acc, v: acc + v).alias("mask"),
        F.round(_sum_abs(F.col("input_values")) / F.col("n_valid"), 4).alias("absolute"), "error")


@query
def preprocess_train(spark, sf_dir):
    wavs = S.document_wavs(spark, sf_dir)
    dictionary = encode.label_dictionary(S.table(spark, sf_dir, "documents"), "lang")
    done = preprocess(wavs, ClipSpec(), key="doc_id", dictionary=dictionary, label="lang")
    return _batch_summary(done, "label_id")


@query
def preprocess_test(spark, sf_dir):
    """The prediction form, with gain normalisation and a fixed minimum length."""
    spec = ClipSpec(apply_dbfs_norm=True, padding="max_length", max_length=4_000,
                    pad_to_multiple_of=64, batch_size=2)
    return _batch_summary(preprocess(S.document_wavs(spark, sf_dir), spec, key="doc_id"))


@query
def preprocess_files(spark, sf_dir):
    """Files named by a metadata table -> stacked batches, without a shuffle of audio."""
    folder = _wav_files(spark, S.document_wavs(spark, sf_dir))
    rows = S.table(spark, sf_dir, "documents").select("doc_id", "lang", F.concat(
        F.lit(f"{folder}/clip "), "doc_id", F.lit(".wav")).alias("path"))
    done = preprocess(rows, ClipSpec(), key="doc_id", path_col="path", label="lang",
                      dictionary=encode.label_dictionary(rows, "lang"))
    return _stack_summary(batching.stack_adjacent(done, "doc_id"))


@query
def odd_clips(spark, sf_dir):
    """Silent and empty clips and bytes that are no clip, next to usual ones."""
    spec = ClipSpec(apply_dbfs_norm=True)
    done = preprocess(S.odd_wavs(spark, sf_dir), spec, key="clip_id")
    return done.select("clip_id", "batch_id", "pos", "n_valid", "error")


def _train_batches(spark, sf_dir) -> DataFrame:
    dictionary = encode.label_dictionary(S.table(spark, sf_dir, "documents"), "lang")
    done = preprocess(S.document_wavs(spark, sf_dir), ClipSpec(), key="doc_id",
                      dictionary=dictionary, label="lang")
    return batching.stack_batches(done, "doc_id")


@query
def stacked_batches(spark, sf_dir):
    return _stack_summary(_train_batches(spark, sf_dir))


def _stack_summary(batches: DataFrame) -> DataFrame:
    valid = F.aggregate(F.flatten("attention_mask"), F.lit(0).cast("bigint"), lambda a, v: a + v)
    return batches.select(
        "batch_id", F.size("doc_id").alias("size"),
        F.array_max(F.transform("input_values", F.size)).alias("width"), valid.alias("valid"),
        F.array_join(F.col("label_id").cast("array<string>"), ",").alias("labels"),
        F.array_join(F.col("doc_id").cast("array<string>"), ",").alias("clips"))


def _sum_network() -> Callable:
    """A stand-in for a loaded network: means over every third valid sample."""
    def network(values: np.ndarray, mask: np.ndarray) -> np.ndarray:
        masked = values.astype(np.float64) * mask
        sums = np.stack([masked[:, c::3].sum(axis=1) for c in range(3)], axis=1)
        return sums / mask.sum(axis=1, keepdims=True)

    return network


@query
def score_batches(spark, sf_dir):
    scored = model.score_batches(_train_batches(spark, sf_dir), _sum_network, "doc_id")
    return scored.select("doc_id", "label_id", F.round("score", 5).alias("score"))


# --- scores --------------------------------------------------------------

@query
def softmax_scores(spark, sf_dir):
    scores = softmax(F.col("embedding"))
    rows = S.table(spark, sf_dir, "embeddings").select("vec_id", scores.alias("s"))
    return rows.select("vec_id", F.round(F.array_max("s"), 8).alias("top"),
                       F.round(_sum(F.col("s")), 8).alias("total"), F.size("s").alias("n"))


def _class_predictions(spark, sf_dir) -> DataFrame:
    rows = S.table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", argmax(S.class_logits(F.col("embedding"))).alias("pred"))


@query
def argmax_predict(spark, sf_dir):
    return _class_predictions(spark, sf_dir)


@query
def macro_f1(spark, sf_dir):
    scores = scoring.macro_f1(_class_predictions(spark, sf_dir), "label", "pred")
    return scores.withColumn("macro_f1", F.round("macro_f1", 8))


@query
def class_scores(spark, sf_dir):
    scores = scoring.class_scores(_class_predictions(spark, sf_dir), "label", "pred")
    return scores.withColumn("f1", F.round("f1", 8))


@query
def binary_f1(spark, sf_dir):
    scores = scoring.macro_f1(S.table(spark, sf_dir, "labels"), "quality", "toxic")
    return scores.withColumn("macro_f1", F.round("macro_f1", 8))


@query
def pred_truth_pairing(spark, sf_dir):
    """Toxic documents are predicted twice; benchmark items are known to the truth only."""
    labels = S.table(spark, sf_dir, "labels")
    pred = S.table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label")).union(
        labels.filter("toxic = 1").select("doc_id", F.lit("toxic")))
    truth = labels.select("doc_id", F.col("quality").cast("string").alias("label")).union(
        S.table(spark, sf_dir, "benchmark").select(-1 - F.col("item_id"), F.lit("none")))
    return joins.pair_predictions(pred, truth, "doc_id", how="report")


@query
def score_predictions(spark, sf_dir):
    rows = _class_predictions(spark, sf_dir).select(
        F.concat(F.lit("clip"), "vec_id", F.lit(".wav")).alias("wav_file"), "label", "pred")
    pred = rows.select("wav_file", F.col("pred").cast("string").alias("label"))
    truth = rows.select("wav_file", F.col("label").cast("string").alias("label"))
    return jobs.score(pred, truth).withColumn("macro_f1", F.round("macro_f1", 8))


@query
def best_epoch(spark, sf_dir):
    """The history goes through the metrics table, as after a fit."""
    folder = new_folder(spark, "metrics")
    for _ in range(2):  # a repeated run does not count twice
        sinks.append_metrics(S.daily_history(S.table(spark, sf_dir, "events")), folder, "daily")
    return scoring.best_epoch(sinks.read_metrics(spark, folder))


@query
def early_stop(spark, sf_dir):
    return scoring.early_stop(S.daily_history(S.table(spark, sf_dir, "events")), patience=5)


# --- sources and sinks ---------------------------------------------------

@query
def csv_roundtrip(spark, sf_dir):
    customers = S.table(spark, sf_dir, "customer")
    folder = new_folder(spark, "csv")
    sinks.write_csv(customers, folder)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in customers.schema.fields)
    return tables.read_metadata(spark, folder, ddl)


@query
def text_csv_roundtrip(spark, sf_dir):
    """Names with quotes, commas and blanks: base names of pages as a metadata table."""
    pages = S.table(spark, sf_dir, "pages").select(
        F.concat(F.lit('a "b", '), F.col("url")).alias("wav_file"),
        F.concat(F.lit(" x,"), F.col("page_id")).alias("label"))
    folder = new_folder(spark, "csv")
    sinks.write_csv(pages, folder)
    return tables.read_metadata(spark, folder)


@query
def wav_roundtrip(spark, sf_dir):
    """WAV files written to a folder, found by a scan, measured by header and samples."""
    folder = new_folder(spark, "wavs")
    name = F.concat(F.col("lang"), F.lit("/clip "), F.col("doc_id"), F.lit(".wav"))
    sinks.export_clips(S.document_wavs(spark, sf_dir), folder, name, key="doc_id")
    clips = scan.scan_clips(spark, folder)
    levels = signal.clip_loudness(clips, keep=["path", "length"])
    doc_id = F.regexp_extract("path", r"clip (\d+)\.wav$", 1).cast("bigint")
    return levels.select(doc_id.alias("doc_id"), parent_name(F.col("path")).alias("lang"),
                         "length", F.round("dbfs", 6).alias("dbfs"), "error")


@query
def manifest_versions(spark, sf_dir):
    """Files of all kinds of names, listed in tasks by three runs of a manifest.

    Half of the documents are there at first, the others come later, and every seventh
    of all is then written anew and longer. Every fifth file has no byte, and the names
    take turns: plain, with ``_``, with a dot (hidden).
    """
    folder, known = new_folder(spark, "names"), Manifest(spark, new_folder(spark, "manifest"))
    documents = S.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.when(
            F.col("doc_id") % 5 > 0, F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
        .otherwise(F.unhex(F.lit(""))).alias("content"))
    mark = F.element_at(F.array(F.lit(""), F.lit("_"), F.lit(".")), (F.col("doc_id") % 3 + 1).cast("int"))
    name = F.concat(F.coalesce("lang", F.lit("none")), F.lit("/"), (F.col("doc_id") % 4).cast("string"),
                    F.lit("/"), mark, F.lit("clip "), F.col("doc_id"), F.lit(".wav"))
    longer = F.concat("content", F.unhex(F.lit("00")))
    for part in (documents.filter("doc_id % 2 = 0"), documents.filter("doc_id % 2 <> 0"),
                 documents.filter("doc_id % 7 = 0").withColumn("content", longer)):
        sinks.export_clips(part, folder, name, key="doc_id")
        known.refresh(folder)
    return known.changes().select(
        F.regexp_extract("path", r"clip (\d+)\.wav$", 1).cast("bigint").alias("doc_id"),
        parent_name(F.col("path")).alias("folder"), "length", "change", "version")


@query
def load_by_path(spark, sf_dir):
    """Files opened from the paths of a metadata table; a missing one is rejected."""
    folder = new_folder(spark, "wavs")
    name = F.concat(F.col("doc_id"), F.lit(".wav"))
    sinks.export_clips(S.document_wavs(spark, sf_dir), folder, name, key="doc_id")
    items = S.table(spark, sf_dir, "documents").select("doc_id").unionByName(
        S.table(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("doc_id")))
    rows = items.select("doc_id", F.concat("doc_id", F.lit(".wav")).alias("wav_file"))
    clips = scan.load_clips(jobs.resolve_paths(rows, folder), clips_per_task=4096)
    levels = signal.clip_loudness(clips, keep=["doc_id", "length"])
    return levels.select("doc_id", "length", F.round("dbfs", 6).alias("dbfs"), "error")


@query
def kept_statistics(spark, sf_dir):
    """Statistics over two versions of a manifest: the second reads only its own files."""
    wavs, folder = S.document_wavs(spark, sf_dir), new_folder(spark, "wavs")
    known = Manifest(spark, new_folder(spark, "manifest"))
    kept = CorpusStats(spark, new_folder(spark, "statistics"), known)
    name = F.concat(F.lit("clip "), F.col("doc_id"), F.lit(".wav"))
    for part in ("doc_id % 3 = 0", "doc_id % 3 <> 0"):
        sinks.export_clips(wavs.filter(part), folder, name, key="doc_id")
        known.refresh(folder)
        kept.update()
    whole = kept.durations().select(
        F.lit("durations").alias("part"), "n", F.round("min_s", 6).alias("min_s"),
        F.round("max_s", 6).alias("max_s"), F.round("mean_s", 6).alias("mean_s"),
        F.round("std_s", 6).alias("std_s"), F.round("total_minutes", 6).alias("total_minutes"))
    none = [F.lit(None).cast("double")] * 5
    formats = kept.formats().select(F.concat_ws(" x ", "sample_rate", "num_channels"), "n_clips", *none)
    return whole.union(formats)


@query
def long_clip_levels(spark, sf_dir):
    """Files read in ranges of 1,000 bytes: their headers, and levels merged from the ranges."""
    folder = _wav_files(spark, S.document_wavs(spark, sf_dir))
    levels = long_clips.long_loudness(manifest.list_files(spark, folder), range_bytes=1_000)
    return _document_ids(levels.select(
        "path", "num_frames", "sample_rate", F.round("dbfs", 6).alias("dbfs"), "error"))


@query
def long_clip_waves(spark, sf_dir):
    """The clip chain over ranges of 1,000 bytes. Of clips at the target rate each range's
    first sample is given, of all the number of samples."""
    folder = _wav_files(spark, S.document_wavs(spark, sf_dir))
    files = manifest.list_files(spark, folder)
    waves, rejected = long_clips.long_waves(files, ClipSpec(), range_bytes=1_000)
    found = scan.materialise(_document_ids(waves).select(
        "doc_id", "first_sample", F.round(F.get("samples", F.lit(0)).cast("double"), 3).alias("value"),
        F.size("samples").alias("n")), "ranges")
    kept = S.table(spark, sf_dir, "documents").filter("lang in ('en', 'es')").select("doc_id").join(
        found, "doc_id").select("doc_id", "first_sample", "value")
    whole = found.groupBy("doc_id").agg(
        F.lit(None).cast("bigint").alias("first_sample"), F.sum("n").cast("double").alias("value"))
    return kept.union(whole).withColumn("error", F.lit(None).cast("string")).union(
        _document_ids(rejected).select("doc_id", F.lit(None).cast("bigint"),
                                       F.lit(None).cast("double"), "error"))


@query
def ingest_clips(spark, sf_dir):
    """A folder of WAV files packed into one table with header columns."""
    folder = new_folder(spark, "wavs")
    name = F.concat(F.lit("clip "), F.col("doc_id"), F.lit(".wav"))
    sinks.export_clips(S.document_wavs(spark, sf_dir), folder, name, key="doc_id")
    table = scan.ingest(spark, folder, new_folder(spark, "clips"))
    doc_id = F.regexp_extract("path", r"clip (\d+)\.wav$", 1).cast("bigint")
    return table.select(doc_id.alias("doc_id"), "length", "num_frames", "sample_rate", "error")


# --- model ---------------------------------------------------------------

def _linear_model() -> Callable[[np.ndarray], np.ndarray]:
    """A stand-in for a loaded network: ten fixed sums of the input vector."""
    weights = (np.arange(64)[:, None] % 10 == np.arange(10)).astype(np.float64)
    return lambda batch: batch.astype(np.float64) @ weights


@query
def batch_predict(spark, sf_dir):
    rows = S.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scored = model.predict_batches(rows, _linear_model, "embedding", input_tensor_shapes=[[64]])
    return scored.select("vec_id", "label_id", F.round("score", 8).alias("score"))


@query
def feature_vector(spark, sf_dir):
    table = features.clip_features(S.document_wavs(spark, sf_dir), ClipSpec(), ["doc_id"])
    finite = F.size(F.filter("features", lambda v: F.abs(v) < float("inf")))
    head = {"rms": 5, "peak": 5, "level": 4, "crossings": 6}
    return table.select("doc_id", F.size("features").alias("n"), finite.alias("n_finite"),
                        *[F.round(F.col("features")[i], digits).alias(name)
                          for i, (name, digits) in enumerate(head.items())], "error")


@query
def fit_predict(spark, sf_dir):
    """Features of every document, a fit on the train side, labels for the dev side."""
    wavs = S.document_wavs(spark, sf_dir)
    dictionary = encode.label_dictionary(wavs, "lang")
    table = features.clip_features(wavs, ClipSpec(), ["doc_id", "lang"])
    good, _ = split_rejects(scan.materialise(table, "features"))
    stored = stratified_split(encode.encode_labels(good, dictionary, "lang"), "lang", "doc_id")
    sides = {s: stored.filter(F.col("split") == s) for s in ("train", "dev")}
    best, _ = model.select_model(sides["train"], sides["dev"], reg_params=(0.01, 0.1), max_iter=20)
    folder = new_folder(spark, "model")
    sinks.write_model(best, folder)
    scored = model.predict(model.load_model(folder), sides["dev"].drop("lang"))
    labelled = model.predicted_labels(scored, dictionary, "lang")
    return labelled.select("doc_id", F.col("lang").alias("predicted"))


@query
def fit_evaluate(spark, sf_dir):
    """Embeddings as features: macro-F1 of a fit, on the dev side."""
    rows = S.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").alias("label_id"))
    stored = scan.materialise(stratified_split(rows, "label_id", "vec_id"), "embeddings")
    fitted = model.fit_classifier(stored.filter("split = 'train'"), max_iter=20)
    scores = model.evaluate(fitted, stored.filter("split = 'dev'"))
    return scores.select("n_classes", "n_rows", F.col("macro_f1").between(0, 1).alias("is_share"))


def _embedding_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Embeddings with their labels; every fifth is held back."""
    rows = S.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("int").alias("label_id"))
    return rows.filter("vec_id % 5 <> 0"), rows.filter("vec_id % 5 = 0")


@query
def fit_epochs(spark, sf_dir):
    """Two settings fitted by mini-batches for three epochs, with a stop in between."""
    rows, dev = _embedding_sides(spark, sf_dir)
    folder = new_folder(spark, "epochs")
    settings = [training.Setting("slow", 0.1), training.Setting("fast", 0.5, 0.01)]
    plan = training.Plan(epochs=3, batches=2)
    training.train(rows, dev, folder, settings, plan, key="vec_id")
    again, history = training.train(rows, dev, folder, settings, plan, key="vec_id")
    return history.groupBy("run", "epoch", "split").agg(
        F.max(F.when(F.col("metric") == "rows", F.col("value"))).cast("bigint").alias("n_rows"),
        F.max(F.when(F.col("metric") == "batches", F.col("value"))).cast("int").alias("n_batches"),
        F.count(F.lit(1)).alias("n_metrics"),
        F.max(F.when(F.col("metric") == "loss", F.col("value") < 10)).alias("finite_loss"))


@query
def fit_one_step(spark, sf_dir):
    """One step of the whole table from zero weights: each held-back row's scores follow
    from the class means alone. The model is stored with its labels and read back."""
    rows, dev = _embedding_sides(spark, sf_dir)
    plan = training.Plan(epochs=1, batches=1, warmup=0.0, momentum=0.0)
    fitted, _ = training.train(rows, dev, new_folder(spark, "epochs"),
                               [training.Setting("one", 1.0)], plan, key="vec_id")
    folder = new_folder(spark, "models")
    names = rows.select(F.concat(F.lit("class "), "label_id").alias("label"), "label_id").distinct()
    fitted.save(spark, folder, names)
    stored, dictionary = training.load_linear(spark, folder)
    scored = training.predict_linear(stored, dev.select("vec_id", "features"))
    return model.predicted_labels(scored, dictionary).select(
        "vec_id", "label", F.round("score", 6).alias("score"))


@query
def evaluate_stored(spark, sf_dir):
    """A model of given weights, stored and read back, scored on all embeddings."""
    rows = S.table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("int").alias("truth"),
        F.col("embedding").cast("array<double>").alias("features"))
    weights = (np.arange(65)[:, None] % 10 == np.arange(10)) * (np.arange(65)[:, None] < 64)
    folder = new_folder(spark, "models")
    training.LinearModel(np.zeros(64), np.ones(64), weights.astype(float)).save(spark, folder)
    scored = training.predict_linear(training.load_linear(spark, folder)[0], rows)
    return scoring.macro_f1(scored.withColumnRenamed("label_id", "pred")).withColumn(
        "macro_f1", F.round("macro_f1", 8))


@query
def predict_job(spark, sf_dir):
    """A fit over files, stored with its labels; every file predicted by the stored model."""
    folder = _wav_files(spark, S.document_wavs(spark, sf_dir))
    rows = S.table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    sides = scan.materialise(stratified_split(rows, "label", "doc_id").withColumn(
        "wav_file", F.concat(F.lit("clip "), "doc_id", F.lit(".wav"))), "metadata")
    stored = new_folder(spark, "model")
    train, dev = (sides.filter(F.col("split") == s) for s in ("train", "dev"))
    jobs.fit(train, dev, ClipSpec(), base_dir=folder, model_out=stored, reg_params=(0.01,))
    predictions, rejected = jobs.predict(spark, folder, stored, ClipSpec())
    found = predictions.withColumn("outcome", F.when(F.col("label").isin(
        [r[0] for r in model.load_labels(spark, stored).select("label").collect()]), "label"))
    found = found.select("wav_file", "outcome").unionByName(rejected.select(
        F.col("path").alias("wav_file"), F.col("error").alias("outcome")))
    return _document_ids(found, "wav_file")
