"""Augmentation steps and their registry.

Every draw comes from ``md5(seed:epoch:name:key)``, so a retried task, another
partitioning or another run gives the same clip.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np

from clipframe.functions.kernels import (
    add_noise,
    digest_uniform,
    row_digest,
    shift_pitch,
)
from clipframe.operators.clips import ClipBatch, Step

# The default augmentation list, in order of application.
DEFAULT_AUGMENTATIONS = (
    {"name": "pitch_shift", "min_semitones": -3, "max_semitones": 3, "p": 0.25},
    {"name": "gaussian", "min_amplitude": 0.0001, "max_amplitude": 0.001, "p": 0.25},
)


def _draws(batch: ClipBatch, name: str, key_col: str, seed: int, epoch: int,
           p: float, split_col: str | None):
    """``(clip, size draw, row seed)`` of the clips the augmentation applies to."""
    keys = batch.column(key_col)
    splits = batch.column(split_col) if split_col else None
    for i in batch.good():
        if splits is not None and splits[i] != "train":
            continue
        digest = row_digest(seed, epoch, name, keys[i])
        if digest_uniform(digest, 0) < p:
            yield i, digest_uniform(digest, 8), int(digest[16:32], 16)


def gaussian(min_amplitude: float, max_amplitude: float, p: float = 0.5, *, key_col: str,
             seed: int = 42, epoch: int = 0, split_col: str | None = None) -> Step:
    """Add normal noise with an amplitude drawn from the given range."""

    def step(batch: ClipBatch) -> None:
        values = np.array(batch.values)
        for i, size, row_seed in _draws(batch, "gaussian", key_col, seed, epoch, p, split_col):
            amplitude = min_amplitude + (max_amplitude - min_amplitude) * size
            values[batch.offsets[i]:batch.offsets[i + 1]] = add_noise(
                batch.clip(i), amplitude, row_seed)
        batch.values = values

    return step


def pitch_shift(min_semitones: float, max_semitones: float, p: float = 0.5, *, key_col: str,
                seed: int = 42, epoch: int = 0, split_col: str | None = None) -> Step:
    """Move the pitch by a number of semitones drawn from the given range."""

    def step(batch: ClipBatch) -> None:
        values = np.array(batch.values)
        for i, size, _ in _draws(batch, "pitch_shift", key_col, seed, epoch, p, split_col):
            semitones = min_semitones + (max_semitones - min_semitones) * size
            values[batch.offsets[i]:batch.offsets[i + 1]] = shift_pitch(
                batch.clip(i), semitones)
        batch.values = values

    return step


AUGMENTATIONS = {"gaussian": gaussian, "pitch_shift": pitch_shift}


def build_augmentation(spec: Mapping, **common) -> Step:
    """A step from ``{'name': ..., <parameters>}``; the spec is left unchanged."""
    parameters = dict(spec)
    name = parameters.pop("name")
    if name not in AUGMENTATIONS:
        raise ValueError(f"unknown augmentation: {name!r}")
    return AUGMENTATIONS[name](**parameters, **common)


def compose(specs: Sequence[Mapping], **common) -> list[Step]:
    return [build_augmentation(spec, **common) for spec in specs]
