import math

import numpy as np
import pytest
from conftest import tone

from clipframe.functions import kernels as K


def ragged(*clips):
    offsets = K.lengths_to_offsets(np.array([len(c) for c in clips]))
    return np.concatenate([np.asarray(c, np.float32) for c in clips]), offsets


def brute_resample(x, old, new):
    """The defining sum, term by term."""
    common = math.gcd(old, new)
    o, n = old // common, new // common
    b = 0.99 * min(o, n)
    out = np.zeros(-(-len(x) * n // o))
    for m in range(len(out)):
        u = (np.arange(len(x)) / o - m / n) * b
        inside = np.abs(u) < 6
        w = np.sinc(u[inside]) * np.cos(np.pi * u[inside] / 12) ** 2
        out[m] = b / o * np.dot(x[inside], w)
    return out


@pytest.mark.parametrize("old,new", [
    (22_050, 16_000), (8_000, 16_000), (44_100, 16_000), (48_000, 16_000), (16_000, 16_001),
    (11_025, 16_000), (3, 2)])
def test_resample_matches_the_sum(old, new):
    rng = np.random.default_rng(1)
    clips = [rng.normal(size=size).astype(np.float32) for size in (1, 700, 64, 5)]
    values, offsets = K.resample_clips(*ragged(*clips), old, new)
    for i, clip in enumerate(clips):
        got = values[offsets[i]:offsets[i + 1]]
        want = brute_resample(clip.astype(np.float64), old, new)
        assert len(got) == len(want)
        np.testing.assert_allclose(got, want, atol=2e-6)


@pytest.mark.parametrize("rate", [8_000, 22_050, 44_100])
def test_resample_keeps_level_and_pitch(rate):
    flat, _ = K.resample_clips(*ragged(np.ones(rate)), rate, 16_000)
    assert abs(flat[8_000] - 1) < 1e-3
    values, _ = K.resample_clips(*ragged(tone(500, 1.0, rate) / 32768), rate, 16_000)
    spectrum = np.abs(np.fft.rfft(values[:16_000]))
    assert int(spectrum.argmax()) == 500


def test_standardise_per_clip():
    rng = np.random.default_rng(2)
    values, offsets = ragged(rng.normal(3, 5, 400), rng.normal(-1, 0.1, 50), [7.0])
    out = K.zero_mean_unit_variance(values, offsets).astype(np.float64)
    for i in (0, 1):
        part = out[offsets[i]:offsets[i + 1]]
        assert abs(part.mean()) < 1e-6 and abs(part.var() - 1) < 1e-3
    assert out[-1] == 0


def test_empty_clips_do_no_harm():
    values, offsets = ragged([1, 2, 3], [], [4, 5])
    assert len(K.zero_mean_unit_variance(values, offsets)) == 5
    _, out = K.resample_clips(values, offsets, 8_000, 16_000)
    assert np.diff(out).tolist() == [6, 0, 4]


def test_mono():
    same = np.repeat(np.arange(50, dtype=np.float32), 2)
    values, offsets = K.mix_down(*ragged(same, [1, 2, 3]), np.array([2, 1]))
    assert values.tolist() == [*range(50), 1, 2, 3] and offsets.tolist() == [0, 50, 53]


def test_integer_mono_rounds_down():
    assert K.pcm_mono(np.array([1, 2, -1, -2, 5, 5]), 2).tolist() == [1, -2, 5]
    assert K.pcm_mono(np.array([4, 4, 4, -1, -1, -1]), 3).tolist() == [3, -3]


def test_gain_reaches_the_target():
    samples = tone(300, 1.0, level=0.2).astype(np.int32)
    for target in (-31.19, -20.0, -6.5):
        gained = K.pcm_gain(samples, target - K.pcm_dbfs(samples, 16), 16)
        assert abs(K.pcm_dbfs(gained, 16) - target) < 0.1
    assert K.pcm_gain(np.array([32767, -32768]), 20, 16).tolist() == [32767, -32768]
    assert K.pcm_gain(np.array([-15]), 20 * math.log10(0.5), 16).tolist() == [-8]


def test_noise_depends_on_seed_only():
    a, b = K.counter_normals(123, 20_000), K.counter_normals(123, 50)
    assert np.array_equal(a[:50], b)
    assert abs(a.mean()) < 0.03 and abs(a.std() - 1) < 0.03
    assert not np.array_equal(b, K.counter_normals(124, 50))


@pytest.mark.parametrize("semitones", [-3, -1.5, 2, 3])
def test_pitch_shift_moves_the_tone(semitones):
    x = (tone(440, 1.0) / 32768).astype(np.float32)
    y = K.shift_pitch(x, semitones)
    assert len(y) == len(x)
    peak = np.abs(np.fft.rfft(y[2_000:14_000] * np.hanning(12_000))).argmax() * 16_000 / 12_000
    assert abs(peak - 440 * 2 ** (semitones / 12)) < 4


def test_pitch_shift_of_short_clips():
    for size in (1, 64, 3_000):
        assert len(K.shift_pitch(np.ones(size, np.float32), 2)) == size


def test_features():
    low = K.acoustic_features(tone(200) / 32768, 16_000)
    high = K.acoustic_features(tone(4_000) / 32768, 16_000)
    assert len(low) == K.FEATURE_SIZE and np.isfinite([low, high]).all()
    assert abs(low[4] - 200) < 100 and abs(high[4] - 4_000) < 100
    assert np.isfinite(K.acoustic_features(np.zeros(1), 16_000)).all()


def plain_stretch(x, rate):
    """A phase vocoder with one loop over frames and one over lines."""
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(K.FRAME) / K.FRAME)
    padded = np.concatenate([np.zeros(K.FRAME // 2), x, np.zeros(K.FRAME // 2)])
    starts = range(0, len(padded) - K.FRAME + 1, K.HOP)
    spectra = [np.fft.rfft(padded[s:s + K.FRAME] * window) for s in starts]
    spectra += [np.zeros(K.FRAME // 2 + 1)] * 2
    lines, phases, frames, at = K.FRAME // 2 + 1, np.angle(spectra[0]), [], 0.0
    while at < len(spectra) - 2:
        left, part = int(at), at - int(at)
        size = (1 - part) * abs(spectra[left]) + part * abs(spectra[left + 1])
        frames.append(np.fft.irfft(size * np.exp(1j * phases), K.FRAME) * window)
        turned = np.empty(lines)
        for k in range(lines):
            expected = 2 * np.pi * K.HOP * k / K.FRAME
            off = np.angle(spectra[left + 1][k]) - np.angle(spectra[left][k]) - expected
            turned[k] = expected + off - 2 * np.pi * round(off / (2 * np.pi))
        phases, at = phases + turned, len(frames) * rate
    total = np.zeros(K.FRAME + K.HOP * (len(frames) - 1))
    weight = np.zeros(len(total))
    for i, frame in enumerate(frames):
        total[i * K.HOP:i * K.HOP + K.FRAME] += frame
        weight[i * K.HOP:i * K.HOP + K.FRAME] += window ** 2
    out = np.where(weight > 1e-8, total / np.maximum(weight, 1e-8), 0)[K.FRAME // 2:]
    length = round(len(x) / rate)
    return np.concatenate([out, np.zeros(max(0, length - len(out)))])[:length]


@pytest.mark.parametrize("rate", [0.8, 1.25])
def test_stretch_equals_a_plain_vocoder(rate):
    rng = np.random.default_rng(2)
    x = np.sin(np.arange(6_000) * 0.21) + 0.2 * rng.normal(size=6_000)
    got, want = K.time_stretch(x, rate), plain_stretch(x, rate)
    assert len(got) == len(want) and np.allclose(got, want, atol=1e-8)


def test_spectral_features_equal_a_plain_transform():
    rng = np.random.default_rng(3)
    x, rate, size = rng.normal(size=1_500), 16_000, 512
    padded = np.concatenate([x, np.zeros(size + 256 * -(-(len(x) - size) // 256) - len(x))])
    window = [0.5 - 0.5 * np.cos(2 * np.pi * i / (size - 1)) for i in range(size)]
    turn = np.exp(-2j * np.pi * np.outer(np.arange(size // 2 + 1), np.arange(size)) / size)
    power = np.array([abs(turn @ (padded[s:s + size] * window)) ** 2
                      for s in range(0, len(padded) - size + 1, 256)])
    mean, lines = power.mean(axis=0), np.arange(size // 2 + 1) * rate / size
    got = K.acoustic_features(x, rate)
    assert got[4] == pytest.approx((lines * mean).sum() / mean.sum(), rel=1e-6)
    reached = next(f for f, e in zip(lines, np.cumsum(mean)) if e >= 0.85 * mean.sum())
    assert got[5] == reached
    mels = np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), K.BANDS + 2)
    edges = 700 * (10 ** (mels / 2595) - 1)
    for b in range(K.BANDS):
        low, peak, high = edges[b:b + 3]
        shape = np.maximum(0, np.minimum((lines - low) / (peak - low), (high - lines) / (high - peak)))
        energy = np.log(power @ shape + 1e-10)
        assert got[6 + b] == pytest.approx(energy.mean(), rel=1e-6)
        assert got[6 + K.BANDS + b] == pytest.approx(energy.std(), rel=1e-5, abs=1e-9)
