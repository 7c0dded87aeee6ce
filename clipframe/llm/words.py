"""Word and shingle hashing over Arrow string arrays, vectorised in numpy.

Works on the UTF-8 bytes of whole texts. A word is a maximal run of bytes that a
256-entry table keeps; hashes are 64 bits and depend on the (lower-cased) word only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (multiply and xor-shift), so that every bit counts."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers that depend on the seed only."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32))
               * np.uint64(0x9E3779B97F4A7C15))


def byte_table(separators: bytes) -> np.ndarray:
    keep = np.ones(256, bool)
    keep[list(separators)] = False
    return keep


# [^\x20\x09-\x0D]+
BLANK_SEPARATED = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower case
ALPHANUMERIC = byte_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# A random value for each byte at each of the first places of a string
PLACES = 32
PLACE_VALUES = stream(1, PLACES * 256)


def string_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of each string; they lie end to end and none is empty.

    Byte and place are hashed together, then summed: a power of the place as a factor
    would give strings of a regular build equal sums.
    """
    lengths = np.diff(np.append(starts, len(data)))
    code = np.arange(len(data)) - np.repeat(starts, lengths)
    far = np.flatnonzero(code >= PLACES)
    code <<= 8
    code |= data
    far_code = code[far].astype(np.uint64)
    code[far] = 0
    values = PLACE_VALUES[code]
    values[far] = mix(far_code * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64))


def chunks(array: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows; a null text has no bytes.

    A run holds at most ``limit`` bytes, or one row that alone is longer.
    """
    if array.null_count:
        array = pc.fill_null(array, "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[array.offset:array.offset + len(array) + 1].astype(np.int64)
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(array):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(max(stop, row + 1), len(array))
        yield row, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row]
        row = stop


class Words(NamedTuple):
    hashes: np.ndarray  # one per word
    first: np.ndarray   # index of each row's first word, and the number of words at the end


def split_words(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> Words:
    data = LOWER[data]
    inside = keep[data]
    size = len(data)
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True  # a word ends where its row ends
    begins = inside.copy()
    if size:
        begins[1:] &= ~inside[:-1] | edge[1:size]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.empty(0, np.uint64), first)
    at = np.cumsum(inside)[starts] - 1  # where each word begins among the kept bytes
    return Words(string_hashes(data[inside], at), first)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, rows not regarded; ``len - k + 1`` values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = stream(2, k) | np.uint64(1)
    total = hashes[:n] * factors[0]
    for j in range(1, k):
        total += hashes[j:j + n] * factors[j]
    return mix(total + np.uint64(k))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word shingles and each row's offsets in them, repeats included.

    A row with fewer words, but not none, has one shingle: the whole sequence.
    """
    hashes, first = words
    counts = np.diff(first)
    values = np.zeros(len(hashes), np.uint64)
    full = grams(hashes, k)
    values[:len(full)] = full
    left = np.repeat(first[1:], counts) - np.arange(len(hashes))
    valid = left >= k
    for n in range(1, k):
        at = first[:-1][counts == n]
        if len(at):
            factors = stream(2, n) | np.uint64(1)
            total = np.zeros(len(at), np.uint64)
            for j in range(n):
                total += hashes[at + j] * factors[j]
            values[at] = mix(total + np.uint64(n))
            valid[at] = True
    offsets = np.concatenate([[0], np.cumsum(valid)])[first]
    return values[valid], offsets


def shingle_sets(array: pa.Array, k: int, keep: np.ndarray = BLANK_SEPARATED) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for _, data, offsets in chunks(array):
        values, at = shingles(split_words(data, offsets, keep), k)
        for i in range(len(at) - 1):
            yield np.unique(values[at[i]:at[i + 1]])
