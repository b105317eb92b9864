"""Texts of an Arrow batch as flat numpy arrays, and rolling hashes over them.

All functions work on the UTF-8 bytes of several texts laid end to end, with the
offsets of the texts beside them. Memory is a small multiple of ``PART_BYTES`` or
of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 1 << 20

#: Bytes of the longest word whose hash is a polynomial.
SHORT = 64

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A-Z to a-z, all other bytes to themselves.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_SIGNS = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
_FOLDED = _SIGNS.copy()
_FOLDED[65:91] = _SIGNS[97:123]


class _Powers:
    """Powers of the base and of its inverse, as many as were asked for so far."""

    up = np.ones(1, U64)
    down = np.ones(1, U64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up))
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                factors = np.full(size, base & (2**64 - 1), U64)
                factors[0] = 1
                setattr(cls, name, np.cumprod(factors, dtype=U64))
        return cls.up[:n], cls.down[:n]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hashes' base and of its inverse."""
    return _Powers.of(n)


def separators(*spans: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, set for the bytes of the given closed ranges."""
    table = np.zeros(256, bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: The byte ranges between words, as the query contracts state them.
WHITE = separators((0x20, 0x20), (0x09, 0x0D))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def parts(
    batches: Iterator[pa.RecordBatch], column: str, size: int = PART_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of at most ``size`` bytes of text, one row at least."""
    for batch in batches:
        data, offsets = flat(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            own = offsets[start : end + 1]
            yield batch.slice(start, end - start), data[own[0] : own[-1]], own - own[0]
            start = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text."""
    inside = ~between[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hashes(data: np.ndarray, fold: bool = False) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes, modulo 2**64."""
    up, _ = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((_FOLDED if fold else _SIGNS)[data] * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans, from prefix sums; equal bytes give equal hashes.

    Different long spans may have the same hash for any base, so their user has to
    compare the bytes, or to take :func:`word_hashes`.
    """
    _, down = _Powers.of(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False
) -> np.ndarray:
    """Hashes of words: of the polynomial up to ``SHORT`` bytes, else keyed digests."""
    out = span_hashes(prefix_hashes(data, fold), starts, ends)
    for i in np.flatnonzero(ends - starts > SHORT):
        word = data[starts[i] : ends[i]].tobytes()
        word = word.translate(FOLD) if fold else word
        out[i] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
    return out


def window_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values."""
    if len(values) < size:
        return np.zeros(0, U64)
    weights = mix(np.arange(size, dtype=U64) + U64(0x51ED270B)) | U64(1)
    count = len(values) - size + 1
    total = np.zeros(count, U64)
    for j in range(size):
        total += values[j : j + count] * weights[j]
    return mix(total)


def shingle_hashes(
    data: np.ndarray, offsets: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of each text, with A-Z folded, repeats included.

    A text of fewer words, but not none, has one shingle, all of its words. Also
    returns the offsets of the texts among the hashes.
    """
    starts, ends, first = word_spans(data, offsets, WHITE)
    words = word_hashes(data, starts, ends, fold=True)
    counts = np.diff(first)
    values = np.zeros(len(words), U64)
    full = window_hashes(words, size)
    values[: len(full)] = full
    last = np.repeat(first[1:], counts)
    valid = np.arange(len(words)) + size <= last
    for short in range(1, size):
        at = first[:-1][counts == short]
        if len(at):
            rows = words[at[:, None] + np.arange(short)]
            weights = mix(np.arange(short, dtype=U64) + U64(0x51ED270B)) | U64(1)
            values[at] = mix((rows * weights).sum(axis=1, dtype=U64) + U64(short))
            valid[at] = True
    kept = np.zeros(len(words) + 1, np.int64)
    np.cumsum(valid, out=kept[1:])
    return values[valid], kept[first]


def signed(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return values.view(np.int64)
