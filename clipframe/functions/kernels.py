"""Sample-level maths on ragged arrays (numpy), used inside Arrow batches.

Workers get these functions by value: they refer to each other by plain names, not
through a module of this package. A batch of clips is one flat ``values`` array plus ``offsets`` (clip ``i`` is
``values[offsets[i]:offsets[i + 1]]``), so most kernels run over all clips of a
batch at once instead of looping over clips.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np

# Resampling filter (Hann-windowed sinc) and standardisation.
FILTER_WIDTH = 6
ROLL_OFF = 0.99
EPSILON = 1e-7

# Largest block of filter input built at once, in numbers.
BLOCK = 1 << 21


def lengths_to_offsets(lengths: np.ndarray) -> np.ndarray:
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return offsets


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum per clip (0 for an empty clip)."""
    out = np.zeros(len(offsets) - 1)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        out[filled] = np.add.reduceat(values, offsets[filled], dtype=np.float64)
    return out


def position_in_clip(offsets: np.ndarray) -> np.ndarray:
    return np.arange(offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))


# --- integer PCM ---------------------------------------------------------

def pcm_rms(samples: np.ndarray) -> int:
    if len(samples) == 0:
        return 0
    wide = samples.astype(np.float64)
    return int(math.sqrt(float(np.dot(wide, wide)) / len(wide)))


def pcm_dbfs(samples: np.ndarray, bits: int) -> float:
    rms = pcm_rms(samples)
    return 20.0 * math.log10(rms / 2.0 ** (bits - 1)) if rms else -math.inf


def pcm_mono(samples: np.ndarray, channels: int) -> np.ndarray:
    """Integer down-mix: floor of the mean for two channels, sum of floored
    shares for more."""
    if channels == 1:
        return samples
    frames = samples.reshape(-1, channels).astype(np.int64)
    if channels == 2:
        return (frames.sum(axis=1) >> 1).astype(np.int32)
    return (frames // channels).sum(axis=1).astype(np.int32)


def pcm_gain(samples: np.ndarray, decibels: float, bits: int) -> np.ndarray:
    """Scale, round down and clip to the range of the width."""
    top = 2.0 ** (bits - 1)
    scaled = np.floor(samples * 10.0 ** (decibels / 20.0))
    return np.clip(scaled, -top, top - 1).astype(np.int32)


# --- float waveforms -----------------------------------------------------

def mix_down(values: np.ndarray, offsets: np.ndarray, channels: np.ndarray):
    """Mean over interleaved channels -> ``(values, offsets)`` with one channel."""
    frames = np.diff(offsets) // channels
    if (channels == 1).all():
        return values, offsets
    out_offsets = lengths_to_offsets(frames)
    out = np.empty(out_offsets[-1], np.float32)
    for count in np.unique(channels):
        clips = np.flatnonzero(channels == count)
        source = np.concatenate([values[offsets[i]:offsets[i + 1]] for i in clips])
        mixed = source.reshape(-1, count).mean(axis=1, dtype=np.float64).astype(np.float32)
        at = 0
        for i in clips:
            out[out_offsets[i]:out_offsets[i + 1]] = mixed[at:at + frames[i]]
            at += frames[i]
    return out, out_offsets


def zero_mean_unit_variance(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Zero mean and unit variance per clip."""
    lengths = np.diff(offsets)
    count = np.maximum(lengths, 1)
    centred = values - np.repeat(segment_sums(values, offsets) / count, lengths)
    variance = segment_sums(centred * centred, offsets) / count
    centred /= np.repeat(np.sqrt(variance + EPSILON), lengths)
    return centred.astype(np.float32)


def resampled_length(length, old: int, new: int):
    common = math.gcd(old, new)
    return -(-length * (new // common) // (old // common))


def windowed_sinc(u: np.ndarray) -> np.ndarray:
    window = np.cos(np.clip(u / FILTER_WIDTH, -1.0, 1.0) * (np.pi / 2)) ** 2
    return np.sinc(u) * np.where(np.abs(u) < FILTER_WIDTH, window, 0.0)


def _filter_bank(o: int, n: int) -> tuple[np.ndarray, int]:
    """Taps ``[n, taps]``: row ``r`` serves outputs at input position ``q + r / n``."""
    cutoff = ROLL_OFF * min(o, n)
    reach = math.ceil(FILTER_WIDTH * o / cutoff)
    steps = np.arange(2 * reach + 2) - reach
    shift = np.arange(n)[:, None] / n
    return windowed_sinc((steps - shift) * (cutoff / o)) * (cutoff / o), reach


def _phase_matrix(bank: np.ndarray, o: int) -> np.ndarray:
    """The bank laid out for one block of ``o`` inputs -> ``n`` outputs."""
    n, taps = bank.shape
    matrix = np.zeros((o + taps, n))
    for phase in range(n):
        start, rest = divmod(phase * o, n)
        matrix[start:start + taps, phase] = bank[rest]
    return matrix


def resample_clips(values: np.ndarray, offsets: np.ndarray, old: int, new: int):
    """All clips of one rate ``old`` -> rate ``new``: ``(values, offsets)``.

    The clips are laid side by side, each padded with the zeros the filter
    reaches for, and every block of input becomes one row of a matrix product.
    """
    if old == new:
        return values, offsets
    common = math.gcd(old, new)
    o, n = old // common, new // common
    lengths = np.diff(offsets)
    out_offsets = lengths_to_offsets(resampled_length(lengths, old, new))
    if out_offsets[-1] == 0:
        return np.empty(0, np.float32), out_offsets
    bank, reach = _filter_bank(o, n)
    taps = bank.shape[1]
    blocks = -(-np.diff(out_offsets) // n)
    padded_blocks = blocks + -(-taps // o)
    starts = lengths_to_offsets(padded_blocks * o)
    padded = np.zeros(starts[-1] + o + taps)
    padded[np.repeat(starts[:-1] + reach, lengths) + position_in_clip(offsets)] = values
    if o + taps <= 32 * taps:
        matrix = _phase_matrix(bank, o)
        rows = np.lib.stride_tricks.sliding_window_view(padded, o + taps)[::o]
        total = int(padded_blocks.sum())
        flat = np.empty((total, n), np.float32)
        step = max(1, BLOCK // (o + taps))
        for at in range(0, total, step):
            end = min(at + step, total)
            flat[at:end] = rows[at:end] @ matrix
        flat = flat.ravel()
        source = np.repeat(starts[:-1] // o * n, np.diff(out_offsets))
        return flat[source + position_in_clip(out_offsets)], out_offsets
    # Rates with hardly a common factor: gather the taps of each output.
    out = np.empty(out_offsets[-1], np.float32)
    position = position_in_clip(out_offsets) * o
    first = np.repeat(starts[:-1], np.diff(out_offsets)) + position // n
    phase = position % n
    for at in range(0, len(out), BLOCK):
        part = slice(at, at + BLOCK)
        total = np.zeros(len(out[part]))
        for k in range(taps):
            total += bank[phase[part], k] * padded[first[part] + k]
        out[part] = total
    return out, out_offsets


# --- repeatable randomness ----------------------------------------------

def row_digest(seed: int, epoch: int, name: str, key: object) -> str:
    return hashlib.md5(f"{seed}:{epoch}:{name}:{key}".encode()).hexdigest()


def digest_uniform(digest: str, first: int) -> float:
    return int(digest[first:first + 8], 16) / 2.0 ** 32


def mix32(state: np.ndarray) -> np.ndarray:
    """32-bit integer finaliser: neighbouring counters give unrelated numbers."""
    state = state.astype(np.uint32)
    state ^= state >> np.uint32(16)
    state *= np.uint32(0x85EBCA6B)
    state ^= state >> np.uint32(13)
    state *= np.uint32(0xC2B2AE35)
    state ^= state >> np.uint32(16)
    return state


def counter_normals(row_seed: int, count: int) -> np.ndarray:
    """Standard normals number 0..count-1 of a row: depends on nothing else.

    The high word of the 64-bit seed moves the counter, the low one keys what comes of
    it, so rows whose counters overlap still have unrelated noise.
    """
    high, low = np.uint64(row_seed >> 32), np.uint64(row_seed & 0xFFFFFFFF)
    counter = np.arange(2 * count, dtype=np.uint64) * np.uint64(0x9E3779B9)
    once = mix32((counter + high) & np.uint64(0xFFFFFFFF)).astype(np.uint64)
    uniform = (mix32((once + low) & np.uint64(0xFFFFFFFF)) + 0.5) / 2.0 ** 32
    return np.sqrt(-2.0 * np.log(uniform[0::2])) * np.cos(2.0 * np.pi * uniform[1::2])


def add_noise(samples: np.ndarray, amplitude: float, row_seed: int) -> np.ndarray:
    noise = counter_normals(row_seed, len(samples))
    return (samples + amplitude * noise).astype(np.float32)


# --- pitch shift ---------------------------------------------------------

FRAME = 2048
HOP = 512
READ_BLOCK = 1 << 14  # samples that are read together, few enough for a cache


def _spectrum(samples: np.ndarray) -> np.ndarray:
    window = np.hanning(FRAME + 1)[:-1]
    padded = np.pad(samples, FRAME // 2)
    if len(padded) < FRAME:
        padded = np.pad(padded, (0, FRAME - len(padded)))
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    return np.fft.rfft(frames * window, axis=1)


def _overlap_add(spectrum: np.ndarray, length: int) -> np.ndarray:
    window = np.hanning(FRAME + 1)[:-1]
    frames = np.fft.irfft(spectrum, FRAME, axis=1) * window
    total = np.zeros(FRAME + HOP * (len(frames) - 1))
    weight = np.zeros_like(total)
    for i, frame in enumerate(frames):
        total[i * HOP:i * HOP + FRAME] += frame
        weight[i * HOP:i * HOP + FRAME] += window ** 2
    total /= np.where(weight > 1e-8, weight, 1.0)
    out = total[FRAME // 2:FRAME // 2 + length]
    return np.pad(out, (0, length - len(out)))


def time_stretch(samples: np.ndarray, rate: float) -> np.ndarray:
    """Phase vocoder: ``rate`` times faster at the same pitch."""
    spectrum = np.vstack([_spectrum(samples), np.zeros((2, FRAME // 2 + 1))])
    steps = np.arange(0, len(spectrum) - 2, rate)
    left = steps.astype(int)
    part = (steps - left)[:, None]
    magnitude = (1 - part) * np.abs(spectrum[left]) + part * np.abs(spectrum[left + 1])
    angles = np.angle(spectrum)
    expected = 2 * np.pi * HOP * np.arange(FRAME // 2 + 1) / FRAME
    drift = angles[left + 1] - angles[left] - expected
    drift -= 2 * np.pi * np.round(drift / (2 * np.pi))
    phase = angles[0] + np.vstack([np.zeros_like(expected),
                                   np.cumsum(drift + expected, axis=0)[:-1]])
    return _overlap_add(magnitude * np.exp(1j * phase), round(len(samples) / rate))


def _read_at(samples: np.ndarray, step: float, count: int) -> np.ndarray:
    """Windowed-sinc interpolation at ``0, step, 2 * step, ...``.

    The weights are those of :func:`windowed_sinc`. Its sine and cosine at a tap are taken
    from those of the place between two samples, as a sum of angles, so a sample costs
    four of them and not two for every tap.
    """
    cutoff = ROLL_OFF * min(1.0, 1.0 / step)
    reach = math.ceil(FILTER_WIDTH / cutoff)
    padded = np.pad(samples, (reach, reach + 2))
    out = np.zeros(count)
    for at in range(0, count, READ_BLOCK):
        position = np.arange(at, min(at + READ_BLOCK, count)) * step
        whole = position.astype(np.int64)
        whole = whole[whole < len(samples)]
        rest = position[:len(whole)] - whole
        fine, wide = np.pi * cutoff * rest, np.pi / FILTER_WIDTH * cutoff * rest
        sines, cosines = (np.sin(fine), np.cos(fine)), (np.sin(wide), np.cos(wide))
        total = np.zeros(len(whole))
        for k in range(2 * reach + 2):
            tap = (k - reach) * cutoff
            u = tap - cutoff * rest
            a, b = math.pi * tap, math.pi / FILTER_WIDTH * tap
            near = np.abs(u) < 1e-4
            weight = (math.sin(a) * sines[1] - math.cos(a) * sines[0]) / np.where(near, 1.0, np.pi * u)
            weight[near] = 1 - (np.pi * u[near]) ** 2 / 6
            weight *= (1 + math.cos(b) * cosines[1] + math.sin(b) * cosines[0]) / 2 * cutoff
            weight[np.abs(u) >= FILTER_WIDTH] = 0.0
            total += weight * padded[whole + k]
        out[at:at + len(whole)] = total
    return out


def shift_pitch(samples: np.ndarray, semitones: float) -> np.ndarray:
    """Move the pitch, keep the length."""
    factor = 2.0 ** (semitones / 12.0)
    slow = time_stretch(samples.astype(np.float64), 1.0 / factor)
    return _read_at(slow, factor, len(samples)).astype(np.float32)


# --- features ------------------------------------------------------------

BANDS = 20
FEATURE_SIZE = 6 + 2 * BANDS


def acoustic_features(samples: np.ndarray, rate: int) -> np.ndarray:
    """rms, peak, level, zero crossings, centroid, roll-off, then mean and
    deviation of the log energy in ``BANDS`` mel-spaced bands."""
    x = samples.astype(np.float64)
    rms = float(np.sqrt(np.mean(x * x))) if len(x) else 0.0
    level = 20 * math.log10(max(rms, 1e-10))
    crossings = float(np.mean(np.signbit(x[1:]) != np.signbit(x[:-1]))) if len(x) > 1 else 0.0
    size = 512
    hops = -(-max(len(x) - size, 0) // (size // 2))
    x = np.pad(x, (0, size + hops * (size // 2) - len(x)))  # the last frame holds the tail
    frames = np.lib.stride_tricks.sliding_window_view(x, size)[::size // 2]
    power = np.abs(np.fft.rfft(frames * np.hanning(size), axis=1)) ** 2
    frequency = np.fft.rfftfreq(size, 1.0 / rate)
    mean_power = power.mean(axis=0)
    total = mean_power.sum() + 1e-12
    centroid = float(frequency @ mean_power / total)
    rolled = np.searchsorted(np.cumsum(mean_power), 0.85 * total)
    roll_off = float(frequency[min(rolled, len(frequency) - 1)])
    bands = np.log(power @ _mel_bands(size, rate) + 1e-10)
    head = [rms, float(np.abs(x).max()), level, crossings, centroid, roll_off]
    return np.concatenate([head, bands.mean(axis=0), bands.std(axis=0)])


def _mel_bands(size: int, rate: int) -> np.ndarray:
    frequency = np.fft.rfftfreq(size, 1.0 / rate)
    edges = 700 * (10 ** (np.linspace(0, 2595 * np.log10(1 + rate / 1400), BANDS + 2) / 2595) - 1)
    rise = (frequency[:, None] - edges[:-2]) / (edges[1:-1] - edges[:-2])
    fall = (edges[2:] - frequency[:, None]) / (edges[2:] - edges[1:-1])
    return np.clip(np.minimum(rise, fall), 0, None)
