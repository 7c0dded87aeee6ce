"""The clip pre-processing chain: plan batches from headers, then one pass over the audio."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipframe.operators import clips as C
from clipframe.operators.augment import DEFAULT_AUGMENTATIONS, compose
from clipframe.operators.batching import assign_batches, by_batch, pad_target
from clipframe.operators.encode import encode_labels
from clipframe.sources.scan import materialise
from clipframe.sources.wav import scan_header_files, scan_headers


@dataclass(frozen=True)
class ClipSpec:
    """Parameters of the chain; the defaults are the usual ones."""

    sample_rate: int = 16_000
    apply_dbfs_norm: bool = False
    # Fixed value: mean level of the corpora.
    target_dbfs: float = -31.187887972911266
    on_silence: str = "reject"
    standardise: bool = True
    apply_augmentation: bool = False
    augmentations: Sequence[Mapping] = DEFAULT_AUGMENTATIONS
    padding: bool | str = True
    max_length: int | None = None
    pad_to_multiple_of: int | None = None
    batch_size: int = 4
    seed: int = 42
    epoch: int = 0

    def decode_steps(self) -> list[C.Step]:
        if self.apply_dbfs_norm:
            return [C.decode_pcm(), C.gain_to(self.target_dbfs, self.on_silence), C.to_float()]
        return C.decode()

    def steps(self, key: str, split_col: str | None, augment: bool) -> list[C.Step]:
        chain = [*self.decode_steps(), C.mono(), C.resample_to(self.sample_rate)]
        if self.standardise:
            chain.append(C.standardise())
        if augment and self.apply_augmentation:
            chain += compose(self.augmentations, key_col=key, seed=self.seed,
                             epoch=self.epoch, split_col=split_col)
        return chain


def clip_lengths(clips: DataFrame, spec: ClipSpec, keep: Sequence[str],
                 path_col: str | None = None) -> DataFrame:
    """``keep, num_samples, error``: length of each clip at the target rate.

    Read from the headers; an ingested clip table has them as columns, and then
    no audio is read; files named in ``path_col`` are read by range. Only where gain
    normalisation meets padding to the longest are samples decoded: a silent clip is
    known by its samples alone, and its length must not count.
    """
    if spec.apply_dbfs_norm and spec.padding in (True, "longest"):
        steps = [C.decode_pcm(), C.gain_to(spec.target_dbfs, spec.on_silence)]
        sized = C.run_steps(clips, steps, keep, ["num_frames", "sample_rate", "error"],
                            path_col=path_col)
    else:
        known = ["load_error"] if "load_error" in clips.columns else []
        headers = ["num_frames", "sample_rate", "error"]
        sized = (clips.select(*keep, *known, *headers) if set(headers) <= set(clips.columns)
                 else scan_header_files(clips, path_col, [*keep, *known]) if path_col
                 else scan_headers(clips, [*keep, *known]))
        sized = sized.withColumn("error", F.coalesce(
            *known, "error", F.when(F.col("num_frames") == 0, "no samples")))
    length = F.expr(f"(num_frames * {spec.sample_rate} + sample_rate - 1) div sample_rate")
    return sized.select(*keep, F.when(F.col("error").isNull(), length).cast("int")
                        .alias("num_samples"), "error")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise when a key occurs twice (keys only, combined on the map side)."""
    twice = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if twice:
        raise ValueError(f"{key} is not unique: {twice[0][0]!r} occurs {twice[0][1]} times")


def plan_batches(clips: DataFrame, spec: ClipSpec, key: str = "path",
                 dictionary: DataFrame | None = None, label: str = "label",
                 keep: Sequence[str] = (), path_col: str | None = None) -> DataFrame:
    """Narrow table ``(key, keep, batch_id, pos, pad_to, label_id, plan_error)``.

    Batches are cut over all rows in key order, before any row is rejected; the
    pad target counts the rows that succeed. The lengths are written to the shared
    folder first, so the audio is looked at once however often they are used.
    """
    columns = list(dict.fromkeys([key, *keep, *([label] if dictionary is not None else [])]))
    sized = materialise(clip_lengths(clips, spec, columns, path_col), "lengths")
    require_unique(sized, key)
    if dictionary is not None:
        sized = encode_labels(sized, dictionary, label)
        sized = sized.withColumn("error", F.coalesce("error", "label_error")).drop("label_error")
    batched = assign_batches(sized, [key], spec.batch_size)
    usable = F.when(F.col("error").isNull(), F.col("num_samples"))
    planned = pad_target(batched, usable, spec.padding, spec.max_length, spec.pad_to_multiple_of)
    ids = ["label_id"] if dictionary is not None else []
    return planned.select(key, *keep, "batch_id", "pos", "pad_to", *ids,
                          F.col("error").alias("plan_error"))


def preprocess(clips: DataFrame, spec: ClipSpec, key: str = "path",
               dictionary: DataFrame | None = None, label: str = "label",
               split_col: str | None = None, augment: bool = False,
               path_col: str | None = None, batches_per_task: int = 256) -> DataFrame:
    """WAV bytes or files -> padded batches, one row per clip.

    ``batch_id, pos, key, input_values, attention_mask, n_valid, [label_id], error``.
    With a ``dictionary`` the labels are encoded (training form); without, only
    the key is carried (prediction form). Augmentation touches rows whose
    ``split_col`` is ``train``. A row that fails keeps its place and its reason;
    ``split_rejects`` separates it.

    With ``path_col`` the rows name files and hold no bytes: the narrow plan is cut into
    tasks of whole batches, each opens its files, and no audio is shuffled;
    ``stack_adjacent`` can follow. Without, the audio of the table is shuffled once, as
    stored bytes, to meet its plan row; the plan side is hashed, so the audio is not sorted.
    """
    extra = [split_col] if split_col else []
    planned = F.col("plan_error").isNull()  # planned failures need no reading or decoding
    if path_col:
        named = [] if path_col == key else [path_col]
        plan = plan_batches(clips, spec, key, dictionary, label, [*extra, *named], path_col)
        joined = by_batch(plan, batches_per_task).withColumn(
            "__path", F.when(planned, F.col(path_col)))
    else:
        plan = plan_batches(clips, spec, key, dictionary, label, extra)
        joined = clips.select(key, "content").join(plan.hint("shuffle_hash"), key).withColumn(
            "content", F.when(planned, F.col("content")))
    ids = ["label_id"] if dictionary is not None else []
    keep = [key, "batch_id", "pos", *ids, "plan_error"]
    steps = [*spec.steps(key, split_col, augment), C.pad("pad_to")]
    done = C.run_steps(joined, steps, keep, ["input_values", "attention_mask", "n_valid", "error"],
                       inputs=["content", "pad_to", *extra],
                       path_col="__path" if path_col else None)
    return done.select("batch_id", "pos", key, "input_values", "attention_mask", "n_valid", *ids,
                       F.coalesce("plan_error", "error").alias("error"))
