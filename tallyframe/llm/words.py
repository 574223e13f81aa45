"""Words, hashes and sliding windows over Arrow batches of texts, in NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Finisher that spreads all bits of 64-bit numbers."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def segment_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[begin:end]`` for each pair; equal runs hash alike wherever they stand."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=sums[1:])
    back = powers(len(values) + 1, _inverse(_BASE))
    length = (end - begin).astype(np.uint64)
    return mix((sums[end] - sums[begin]) * back[begin] + length * np.uint64(0x2545F4914F6CDD1D))


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each; a longer text stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > most:
            yield start, row
            start, total = row, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of all texts in order, and where each text's words begin (one more entry than texts)."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    at = np.asarray(lists.offsets).astype(np.int64)
    words = lists.values
    filled = np.asarray(pc.greater(pc.binary_length(words), 0)).astype(bool)
    if not filled.all():
        words = words.filter(pa.array(filled))
    count = np.zeros(len(filled) + 1, np.int64)
    np.cumsum(filled, out=count[1:])
    return words, count[at]


def string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings and the offsets between them."""
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, kind)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def hash_strings(strings: pa.Array) -> np.ndarray:
    if not len(strings):
        return np.zeros(0, np.uint64)
    data, at = string_bytes(strings)
    return segment_hashes(_BYTE[data], at[:-1], at[1:])


def windows(starts: np.ndarray, size: int) -> np.ndarray:
    """First positions of all runs of ``size`` words that lie within one text."""
    total = int(starts[-1])
    if total < size:
        return np.zeros(0, np.int64)
    inside = np.ones(total + 1, np.int8)
    for back in range(1, size):
        cut = starts[1:] - back
        cut = cut[cut >= 0]
        inside[cut] = 0
    inside[total - size + 1 :] = 0
    return np.flatnonzero(inside[:total])


def owners(starts: np.ndarray) -> np.ndarray:
    """Text number of each word."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))
