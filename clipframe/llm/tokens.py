"""Token ids of whole texts by a public tokenizer file and the tokenizers library.

The library is slow on long texts and prose repeats its words. So a batch of texts
is cut where a byte-level pre-tokenizer cuts anyway: around a single blank or line
feed between two characters that are no white space, and between a letter and a
punctuation mark. Every distinct part of the batch is encoded once, many of them in one
call, and remembered; the ids lie in flat arrays and are put together in numpy. Words of
letters alone are one piece to the pre-tokenizer, so they go to the same model without it.
The ids are those of the whole texts; the tests compare them. Parts are told apart by their
bytes.
"""

from __future__ import annotations

import codecs
import os
import sys
import threading
import time
import types
import zlib
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from clipframe.llm import words as W
from clipframe.llm.common import give_back

END_ID = 2
BATCH_BYTES = 4 << 20    # of text that are cut and encoded together
REMEMBERED = 1_500_000   # parts, at about 240 bytes each
IDLE_SECONDS = 3         # after which a worker forgets them
JOINED = 128             # distinct parts encoded in one text

# Bytes that only occur in characters that are no white space (first bytes, and all of ASCII)
SAFE_FIRST = np.zeros(256, bool)
SAFE_FIRST[0x21:0x7F] = True
SAFE_FIRST[0xC3:0xE0] = True
UNSAFE = ~SAFE_FIRST
UNSAFE[0x80:0xC0] = False  # they follow a first byte, which decides
BLANK, LINE = 0x20, 0x0A

ASCII_LETTERS = np.zeros(256, bool)
ASCII_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
PUNCTUATION = ~ASCII_LETTERS
PUNCTUATION[[*range(0x21), *range(0x30, 0x3A), *range(0x7F, 256)]] = False
# First bytes of two whose characters are all letters, but for the signs of times and division
LETTER_FIRST = np.zeros(256, bool)
LETTER_FIRST[[*range(0xC3, 0xC9), 0xD0, 0xD1]] = True
SIGN_FIRST, SIGNS = 0xC3, (0x97, 0xB7)
NO_LETTER = ~(ASCII_LETTERS | LETTER_FIRST)
NO_LETTER[0x80:0xC0] = False  # they follow a first byte, which decides


def byte_symbols() -> str:
    """What a byte-level pre-tokenizer writes for each byte, but a blank for a tab."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    symbols = [chr(b if b in own else next(others)) for b in range(256)]
    symbols[0x09] = " "
    return "".join(symbols)


SYMBOLS = byte_symbols()


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_state(key: object, make: Callable[[], object]) -> object:
    """One object per Python worker, kept over its tasks (functions arrive anew with each)."""
    holder = sys.modules.setdefault("_clipframe_worker", types.ModuleType("_clipframe_worker"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


def cuts(data: np.ndarray, offsets: np.ndarray, points: np.ndarray | None = None) -> np.ndarray:
    """Where parts begin: each row, each fitting blank, and each fitting line feed and what follows it.

    ``points`` tells by byte the punctuation marks before which a part begins after a letter.
    """
    size = len(data)
    if size < 3:
        return np.unique(offsets[:-1][np.diff(offsets) > 0])
    here = np.flatnonzero((data[1:-1] == BLANK) | (data[1:-1] == LINE)) + 1
    before, after = data[here - 1], data[here + 1]
    two = data[np.maximum(here - 2, 0)]
    ends = ((before > BLANK) & (before < 0x7F)) | (
        (before >= 0x80) & (before < 0xC0) & (two >= 0xC3) & (two < 0xE0))
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    here = here[ends & SAFE_FIRST[after] & ~edge[here] & ~edge[here + 1]]
    lines = here[data[here] == LINE]
    marks = edge[:size]
    marks[here] = True
    marks[lines + 1] = True
    if points is not None:
        here = np.flatnonzero(points[data[1:]]) + 1
        before, two = data[here - 1], data[np.maximum(here - 2, 0)]
        marks[here[ASCII_LETTERS[before] | (
            (before >= 0x80) & (before < 0xC0) & LETTER_FIRST[two]
            & ~((two == SIGN_FIRST) & np.isin(before, SIGNS)))]] = True
    return np.flatnonzero(marks)


def strings(array: pa.Array) -> list[bytes]:
    """The values of a binary array without nulls."""
    wide = pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type)
    at = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[
        array.offset:array.offset + len(array) + 1].tolist()
    data = array.buffers()[2].to_pybytes() if at[-1] else b""
    return [data[a:b] for a, b in zip(at, at[1:])]


class Memory:
    """Ids of parts by several encoders, remembered by the bytes of the parts.

    An encoder maps distinct parts to their ids, end to end, and the count of each.
    """

    def __init__(self, *encoders: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 limit: int = REMEMBERED):
        self.encoders, self.limit = encoders, limit
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pools = [np.empty(0, np.uint32) for _ in self.encoders]
        self.counts = [np.empty(0, np.int64) for _ in self.encoders]
        self.places = [np.empty(0, np.int64) for _ in self.encoders]

    def numbers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of each part, which begins at its start and ends at the next."""
        wide = len(data) >= 1 << 31
        edges = np.append(starts, len(data)).astype(np.int64 if wide else np.int32)
        parts = pa.Array.from_buffers(pa.large_binary() if wide else pa.binary(), len(starts), [
            None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        encoded = parts.dictionary_encode()
        named = strings(encoded.dictionary)
        if len(self.known) + len(named) > self.limit:
            self.forget()
        found = np.fromiter(map(self.known.get, named, repeat(-1)), np.int64, len(named))
        new = np.flatnonzero(found < 0)
        if len(new):
            fresh = [named[i] for i in new]
            found[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(fresh, found[new].tolist()))
            for k, encode in enumerate(self.encoders):
                ids, counts = encode(fresh)
                at = len(self.pools[k]) + np.cumsum(counts) - counts
                self.pools[k] = np.concatenate([self.pools[k], ids.astype(np.uint32, copy=False)])
                self.counts[k] = np.concatenate([self.counts[k], counts])
                self.places[k] = np.concatenate([self.places[k], at])
        return found[encoded.indices.to_numpy()]

    def ids(self, k: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of encoder ``k`` of a sequence of parts, and the count of each part."""
        sizes = self.counts[k][numbers]
        at = np.cumsum(sizes) - sizes
        flat = np.repeat(self.places[k][numbers] - at, sizes) + np.arange(int(sizes.sum()))
        return self.pools[k][flat], sizes


class Encoder:
    """Encodes batches of texts and remembers the ids of their parts.

    ``plain`` takes the strings of added tokens in texts as ordinary text.
    """

    def __init__(self, path: str, plain: bool = False, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        # Only of this kind is it known that white space, letters and marks are cut apart
        pre = self.tokenizer.pre_tokenizer
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.by_parts = (isinstance(pre, pre_tokenizers.ByteLevel) and pre.use_regex
                         and not pre.add_prefix_space and self.tokenizer.normalizer is None
                         and len(line) == 1 and all(
                             not (t.lstrip or t.rstrip or t.single_word or t.normalized)
                             and not any(c.isspace() for c in t.content)
                             for t in self.tokenizer.get_added_tokens_decoder().values()))
        self.line_ids = np.array(line[:1], np.uint32)
        added = [np.frombuffer(t.content.encode(), np.uint8)
                 for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.points = PUNCTUATION.copy()
        for token in added:
            self.points[token[1:]] = False  # no added token is cut
        self.bare = None
        if self.by_parts and all(NO_LETTER[token].any() for token in added):
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.memory = Memory(self.distinct, limit=remembered)
        self.lock, self.used, self.watched = threading.Lock(), 0.0, False

    def forget_later(self, seconds: float = IDLE_SECONDS) -> None:
        """Forget the parts once the encoder has not been used for a while.

        Workers live on after a stage, and what they remember lies beside later ones'.
        """
        def watch() -> None:
            while True:
                time.sleep(seconds / 4)
                with self.lock:
                    if time.monotonic() - self.used >= seconds:
                        self.memory.forget()
                        self.watched = False
                        break
            give_back()

        with self.lock:
            self.used = time.monotonic()
            if not self.watched:
                self.watched = True
                threading.Thread(target=watch, daemon=True).start()

    def whole(self, texts: list[str], bare: bool = False) -> list[np.ndarray]:
        tokenizer = self.bare if bare and texts else self.tokenizer
        return [np.array(e.ids, np.uint32)
                for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, parts: list[bytes], bare: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts encoded many in one text, with the one id of a line feed between them."""
        between = b"\t\n\t" if bare else b"\n"
        texts = [between.join(parts[i:i + JOINED]) for i in range(0, len(parts), JOINED)]
        encoded = self.whole([codecs.charmap_decode(t, "strict", SYMBOLS)[0] if bare else t.decode()
                              for t in texts], bare)
        ids = np.concatenate([*(x for own in encoded for x in (own, self.line_ids)),
                              np.empty(0, np.uint32)])
        ends = ids == self.line_ids[0]
        edges = np.flatnonzero(ends)
        if len(edges) != len(parts):
            raise ValueError("the tokenizer does not keep line feeds apart")
        return ids[~ends], np.diff(edges, prepend=-1) - 1

    def distinct(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts, end to end, and how many each has.

        Words are letters, plain parts have no white space, but for a blank before
        them: both are joined by line feeds, each of which is one id of its own between them.
        """
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        blank = data[begins] == BLANK

        def free(odd: np.ndarray) -> np.ndarray:
            """The parts that have no such byte but the blank before them."""
            before = np.concatenate([[0], np.cumsum(odd, dtype=np.int64)])
            return (before[ends] - before[begins] == blank) & (sizes > blank)

        odd = NO_LETTER[data]
        odd[1:] |= (data[:-1] == SIGN_FIRST) & np.isin(data[1:], SIGNS)
        words = free(odd) & (self.bare is not None)
        plain = free(UNSAFE[data]) & (sizes > 1) & ~words
        groups = [np.flatnonzero(g) for g in (words, plain, ~(words | plain))]
        alone = self.whole([parts[j].decode() for j in groups[2]])
        found = [*(self.joined([parts[j] for j in g], bare)
                   for g, bare in zip(groups, (True, False))),
                 (np.concatenate([*alone, np.empty(0, np.uint32)]),
                  np.array([len(x) for x in alone], np.int64))]
        order, ids = np.concatenate(groups), np.concatenate([ids for ids, _ in found])
        counts = np.zeros(len(parts), np.int64)
        counts[order] = np.concatenate([n for _, n in found])
        # from the order they were encoded in to that of the parts
        starts = np.zeros(len(parts), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        at = np.cumsum(counts) - counts
        return ids[np.repeat(starts - at, counts) + np.arange(len(ids))], counts

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[
            np.ndarray, np.ndarray]:
        """Ids of rows of UTF-8 bytes, each with the end id, and the rows' offsets in them."""
        if not self.by_parts or not len(data):
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
            ids = [np.append(x, np.uint32(end_id)) for x in self.whole(texts)]
            return (np.concatenate(ids).astype(np.uint32) if ids else np.empty(0, np.uint32),
                    np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64))
        starts = cuts(data, offsets, self.points)
        ids, sizes = self.memory.ids(0, self.memory.numbers(data, starts))
        # ids before each row, where the row before has its end id
        before = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)]
        return np.insert(ids, before[1:], np.uint32(end_id)), before + np.arange(len(offsets))


def encoded(texts: pa.Array, path: str, end_id: int = END_ID,
            remembered: int = REMEMBERED) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, ids, offsets)`` of runs of texts, end ids included; a null text is empty."""
    encoder = worker_state(f"encoder:{path}:{remembered}",
                           lambda: Encoder(path, remembered=remembered))
    for row, data, offsets in W.chunks(texts, BATCH_BYTES):
        with encoder.lock:
            ids, at = encoder.encode(data, offsets, end_id)
        encoder.forget_later()
        yield row, ids, at
    give_back()


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False))
