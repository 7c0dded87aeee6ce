"""Score and level expressions: softmax, argmax, dBFS, repeatable ranks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def softmax(logits: Column) -> Column:
    """Softmax of an array, shifted by its maximum for stability."""
    logits = logits.cast("array<double>")
    powers = bind(F.array_max(logits), lambda top: F.transform(logits, lambda v: F.exp(v - top)))
    return bind(powers, lambda p: bind(
        F.aggregate(p, F.lit(0.0), lambda acc, v: acc + v),
        lambda total: F.transform(p, lambda v: v / total)))


def argmax(values: Column) -> Column:
    """0-based index of the largest element, the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def rms_to_dbfs(rms: Column, full_scale: float | Column = 32768.0) -> Column:
    """Decibels below full scale; a silent clip is -inf (Spark's log10(0) is NULL)."""
    full = F.lit(full_scale) if isinstance(full_scale, float) else full_scale
    return F.when(rms == 0, F.lit(float("-inf"))).otherwise(20.0 * F.log10(rms / full))


def integer_rms(sum_of_squares: Column, count: Column) -> Column:
    """Root mean square truncated to an integer, as for PCM samples."""
    return F.floor(F.sqrt(sum_of_squares.cast("double") / count)).cast("double")


def seeded_hash(seed: int, key: Column) -> Column:
    """Repeatable pseudo-random rank of a key: hex md5 of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
