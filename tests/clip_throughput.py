"""Clips per second on generated WAV files: header, loudness, pre-processing.

    python tests/clip_throughput.py [clips] [seconds] [cores]

Writes stereo 22,050 Hz noise below a new folder in /tmp and prints one line per job.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from pathlib import Path

for name in ("OPENBLAS", "OMP", "MKL"):  # one core a task, and one for the plain loop
    os.environ[f"{name}_NUM_THREADS"] = "1"

import numpy as np  # noqa: E402

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest import wav  # noqa: E402

from clipframe.functions import kernels as K  # noqa: E402
from clipframe.operators import signal  # noqa: E402
from clipframe.operators.batching import stack_adjacent  # noqa: E402
from clipframe.operators.features import clip_features  # noqa: E402
from clipframe.operators.preprocess import ClipSpec, preprocess  # noqa: E402
from clipframe.session import build_session  # noqa: E402
from clipframe.sources import scan  # noqa: E402
from clipframe.sources.wav import decode_samples, scan_header_files  # noqa: E402


def plain_loop(paths: list[Path]) -> None:
    """Decode, down-mix, resample and standardise one file after the other."""
    for path in paths:
        samples, rate, channels, bits = decode_samples(path.read_bytes())
        x = (samples / 2.0 ** (bits - 1)).astype(np.float32).reshape(-1, channels).mean(axis=1)
        x, _ = K.resample_clips(x, np.array([0, len(x)]), rate, 16_000)
        K.zero_mean_unit_variance(x, np.array([0, len(x)]))


def main() -> None:
    count, seconds, cores = (int(a) for a in (sys.argv[1:] + ["400", "5", "8"][len(sys.argv) - 1:]))
    root = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")) / "clips"
    root.mkdir()
    rng = np.random.default_rng(0)
    for i in range(count):
        samples = rng.integers(-9_000, 9_000, 22_050 * seconds * 2)
        (root / f"{i:06d}.wav").write_bytes(wav(samples, 22_050, 2))
    spark = build_session("throughput", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    clips = scan.scan_clips(spark, str(root))
    paths = scan.scan_paths(spark, str(root), path_col="path").repartition(cores)
    jobs = {
        "headers": lambda: scan_header_files(paths),
        "loudness": lambda: signal.clip_loudness(clips),
        "features": lambda: clip_features(clips, ClipSpec()),
        "preprocess": lambda: preprocess(clips, ClipSpec()),
        "by path": lambda: preprocess(paths, ClipSpec(), path_col="path"),
        "stacked": lambda: stack_adjacent(
            preprocess(paths, ClipSpec(), path_col="path"), "path", labels=None),
    }
    for name, job in jobs.items():
        for _ in range(2):  # the second run is the one shown: the JVM is warm
            start = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
        print(f"{name:12s} {count / taken:8.1f} clips/s  {count * seconds / taken:9.0f} s/s")
    some = sorted(root.iterdir())[:max(1, count // 10)]
    start = time.perf_counter()
    plain_loop(some)
    taken = time.perf_counter() - start
    print(f"{'plain loop':12s} {len(some) / taken:8.1f} clips/s  {len(some) * seconds / taken:9.0f} s/s")
    spark.stop()


if __name__ == "__main__":
    main()
