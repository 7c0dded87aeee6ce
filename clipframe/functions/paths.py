"""Path columns: join, base name, parent folder; clip duration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_path(base: str | Column, path: Column) -> Column:
    """POSIX join: an absolute right side wins, an empty base changes nothing."""
    base = F.lit(base) if isinstance(base, str) else base
    return (
        F.when(path.startswith("/") | (base == ""), path)
        .when(base.endswith("/"), F.concat(base, path))
        .otherwise(F.concat(base, F.lit("/"), path))
    )


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    """Name of the folder that holds the file; empty for a bare file name."""
    return F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit(""))


def duration_seconds(num_frames: Column, sample_rate: Column) -> Column:
    """Frames over rate as double; NULL (not an error) for rate 0."""
    return F.try_divide(num_frames.cast("double"), sample_rate.cast("double"))
