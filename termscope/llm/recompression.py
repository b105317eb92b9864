"""Substring dedup by recompression of word sequences."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.arrays import (
    U64,
    WHITE,
    mix,
    parts,
    signed,
    window_hashes,
    word_hashes,
    word_spans,
)
from termscope.llm.bits import hashed_ids, id_bits
from termscope.sources.storage import scratch, stored

WINDOW_WORDS = 20

#: Bytes of text that are read at a time.
SLICE_BYTES = 256 << 10

#: Rounds that join pairs. After three, a symbol spans up to eight words besides runs,
#: and with the words around it that it depends on most still lie within a window.
PAIR_ROUNDS = 3

_PAIR = U64(0xA24BAED4963EE407)
_RUN = U64(0x9FB21C651E98DF25)
_FAR = np.int64(1 << 62)


class _Symbols:
    """Symbols over several texts: name, text, words, and where the words are.

    ``low`` and ``high`` bound the words that decide whether the symbol is there: equal
    words from low to high give an equal symbol, whatever surrounds them. The edge of a
    text is no word, so symbols that depend on it lie in no window.
    """

    def __init__(self, name, text, words, low, high):
        self.name, self.text, self.words, self.low, self.high = name, text, words, low, high

    def _edges(self):
        first = np.ones(len(self.name), bool)
        first[1:] = self.text[1:] != self.text[:-1]
        last = np.ones(len(self.name), bool)
        last[:-1] = first[1:]
        before = np.where(first, -_FAR, np.roll(self.low, 1))
        after = np.where(last, _FAR, np.roll(self.high, -1))
        return first, last, before, after

    def runs(self) -> _Symbols:
        """Name each maximal run of one symbol by the symbol and the run's length."""
        first, _, before, after = self._edges()
        start = first.copy()
        start[1:] |= self.name[1:] != self.name[:-1]
        at = np.flatnonzero(start)
        end = np.append(at[1:], len(start)) - 1
        length = (end - at + 1).astype(U64)
        name = np.where(length > 1, mix(self.name[at] * _RUN + length), self.name[at])
        return _Symbols(
            name, self.text[at], np.add.reduceat(self.words, at), before[at], after[end]
        )

    def pairs(self, number: int) -> _Symbols:
        """Name each pair of a left symbol and a right one after it.

        A bit of a symbol's name says whether it is left or right, so pairs never
        overlap and depend on nothing but their two symbols.
        """
        first, last, before, after = self._edges()
        right = (mix(self.name + U64(number)) >> U64(63)).astype(bool)
        opens = ~right & ~last
        opens[:-1] &= right[1:]
        closes = np.zeros(len(opens), bool)
        closes[1:] = opens[:-1]
        name = self.name.copy()
        high = np.where(right, self.high, after)
        low = np.where(right, before, self.low)
        at = np.flatnonzero(opens)
        name[at] = mix(self.name[at] * _PAIR + mix(self.name[at + 1] + U64(number)))
        low[at], high[at] = self.low[at], self.high[at + 1]
        words = self.words.copy()
        words[at] += self.words[at + 1]
        kept = ~closes
        return _Symbols(name[kept], self.text[kept], words[kept], low[kept], high[kept])


def recompressed(words: np.ndarray, text: np.ndarray) -> list[_Symbols]:
    """The symbols after each round."""
    at = np.arange(len(words), dtype=np.int64)
    if not len(words):
        return []
    rounds = [_Symbols(words, text, np.ones(len(words), np.int64), at, at + 1).runs()]
    for number in range(PAIR_ROUNDS):
        rounds.append(rounds[-1].pairs(number))
    return rounds


def window_keys(words: np.ndarray, first: np.ndarray, size: int):
    """Hash and key of the window at each word, and whether one starts there.

    The key is a symbol that the window decides: the one of most words, and of these
    the one with the greatest hash of its name. Equal windows have equal keys. Windows
    that decide none, within long runs, are their own key.
    """
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    last = np.repeat(first[1:], counts)
    starts = np.arange(len(words)) + size <= last
    own = np.zeros(len(words), U64)
    found = window_hashes(words, size)
    own[: len(found)] = found
    count, levels = len(words), size.bit_length()
    # Row k holds what counts for 2**k windows from a place on: two entries span any range.
    best = np.zeros((levels, count), U64)
    logs = np.array([0] + [n.bit_length() - 1 for n in range(1, size + 1)])
    for symbols in recompressed(words, text):
        spare = size - (symbols.high - symbols.low)
        fits = (symbols.low >= 0) & (symbols.high < _FAR) & (spare >= 0)
        span = np.minimum(symbols.words[fits], 63).astype(U64) << U64(58)
        rank = span | (mix(symbols.name[fits] + U64(0x2545F491)) >> U64(6))
        low = symbols.low[fits]
        start = np.maximum(low - spare[fits], 0)
        level = logs[low - start + 1]
        np.maximum.at(best.reshape(-1), level * count + start, rank)
        np.maximum.at(best.reshape(-1), level * count + low + 1 - (1 << level), rank)
    for k in range(levels - 1, 0, -1):
        half = 1 << (k - 1)
        np.maximum(best[k - 1], best[k], out=best[k - 1])
        after = best[k - 1][half:]
        np.maximum(after, best[k][: len(after)], out=after)
    keys = best[0]
    keys = np.where(keys == 0, mix(own ^ _RUN) >> U64(6), keys)
    return own, keys, starts


def _read(data: np.ndarray, offsets: np.ndarray, size: int):
    starts, ends, first = word_spans(data, offsets, WHITE)
    words = word_hashes(data, starts, ends)
    return (starts, ends, first, *window_keys(words, first, size))


def window_digests(data: np.ndarray, starts, ends, at: np.ndarray, size: int) -> np.ndarray:
    """128 bits of BLAKE2 over the words, with a blank between them, of each window ``at``."""
    sizes = ends - starts + 1
    stops = np.cumsum(sizes)
    joined = np.full(stops[-1] if len(stops) else 0, 0x20, np.uint8)
    letters = np.ones(len(joined), bool)
    letters[stops - 1] = False
    joined[letters] = data[~WHITE[data]]
    view = memoryview(joined.tobytes())
    spans = zip((stops - sizes)[at].tolist(), (stops[at + size - 1] - 1).tolist())
    digests = b"".join(blake2b(view[a:b], digest_size=16).digest() for a, b in spans)
    return np.frombuffer(digests, "S16")


def _halves(digests: np.ndarray) -> tuple[pa.Array, pa.Array]:
    pairs = digests.view(np.int64).reshape(-1, 2)
    return pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())


def _key_rows(docs: DataFrame, size: int) -> DataFrame:
    """``(key, doc_id)``, for each stretch of windows with one key.

    A stretch in which a window repeats is listed twice, as the key then occurs twice.
    """

    def emit(batches):
        for batch, data, offsets in parts(batches, "text", SLICE_BYTES):
            _, _, first, own, keys, starts = _read(data, offsets, size)
            at = np.flatnonzero(starts)
            text = np.searchsorted(first, at, "right") - 1
            new = np.ones(len(at), bool)
            new[1:] = (keys[at[1:]] != keys[at[:-1]]) | (np.diff(at) > 1)
            twice = np.zeros(len(at), bool)
            for step in range(1, size):
                twice[step:] |= (own[at[step:]] == own[at[:-step]]) & (
                    text[step:] == text[:-step]
                )
            # A stretch longer than a window has its key from several symbols.
            begin = np.flatnonzero(new)
            long = begin[np.diff(np.append(begin, len(at))) > size]
            rows = np.concatenate([begin, long, np.flatnonzero(twice)])
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(keys[at[rows]])), pa.array(ids[text[rows]], pa.int64())],
                ["key", "doc_id"],
            )

    return docs.mapInArrow(emit, "key bigint, doc_id bigint")


def _candidates(batches, size):
    """``(batch, text, spans, candidate windows, their digests)`` per slice."""
    for batch, data, offsets in parts(batches, "text", SLICE_BYTES):
        starts, ends, first, _, keys, valid = _read(data, offsets, size)
        hit = np.zeros(len(keys), bool)
        for i, shared in enumerate(batch.column("shared")):
            if shared.is_valid and first[i] < first[i + 1]:
                known = np.array(shared.values.to_numpy()).view(U64)
                hit[first[i] : first[i + 1]] = np.isin(keys[first[i] : first[i + 1]], known)
        at = np.flatnonzero(hit & valid)
        digests = window_digests(data, starts, ends, at, size)
        yield batch, data, (starts, ends, first), at, digests


def _may_be_listed(docs: DataFrame, lists: DataFrame) -> tuple[DataFrame, Broadcast]:
    """Documents that may have a list, as a bit map of fixed size tells."""
    bits = id_bits(lists, "doc_id")

    def near(batches):
        for batch in batches:
            yield batch.filter(pa.array(hashed_ids(batch.column("doc_id"), bits.value)))

    return docs.mapInArrow(near, "doc_id bigint, text string"), bits


def _first_windows(docs: DataFrame, shared: DataFrame, size: int) -> DataFrame:
    """``(doc_id, firsts)``: digests of the windows that no smaller document has."""

    def emit(batches):
        for batch, _, (_, _, first), at, digests in _candidates(batches, size):
            text = np.searchsorted(first, at, "right") - 1
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*_halves(digests), pa.array(ids[text], pa.int64())], ["high", "low", "doc_id"]
            )

    near, _ = _may_be_listed(docs, shared)
    windows = near.join(shared, "doc_id").mapInArrow(emit, "high bigint, low bigint, doc_id bigint")
    # Stored, so that the texts' shuffle is gone before the lists are dealt by document.
    firsts = windows.groupBy("high", "low").agg(F.min("doc_id").alias("doc_id"))
    firsts = stored(firsts, "windows")
    return firsts.groupBy("doc_id").agg(F.collect_list(F.struct("high", "low")).alias("firsts"))


def _repeated(digests: np.ndarray) -> np.ndarray:
    """Whether a digest occurred before in the array."""
    order = np.argsort(digests, kind="stable")
    again = np.zeros(len(digests), bool)
    again[order[1:]] = digests[order[1:]] == digests[order[:-1]]
    return again


def _covered(at: np.ndarray, count: int, size: int) -> np.ndarray:
    """Which of ``count`` words the windows of ``size`` words ``at`` some places cover."""
    change = np.zeros(count + size + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + size, -1)
    return np.cumsum(change)[:count] > 0


def kept_words(docs: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every row of ``docs``.

    ``kept`` are the words left, with one blank between them. A word goes when a window
    of ``size`` consecutive words covers it whose sequence also starts earlier, in a
    document of smaller doc_id or in the same one; windows are judged on the input.

    Recompression names runs of a word and then pairs of symbols, in rounds. A name is
    a hash of what it stands for, so it is the same everywhere with no table of names,
    and it depends on the words near it alone: equal windows share the names inside.
    One of them is the window's key.

    1. Keys are counted over all documents; windows whose key occurs once are unique.
    2. The others are compared by a 128-bit BLAKE2 digest of their whole word sequence,
       and the first document of each is found by an aggregate.
    3. Each document keeps the first place of the windows it is first for, and drops
       what its other candidate windows cover.

    Words are runs of anything but ASCII white space, unchanged. Nulls, empty texts and
    texts without words have no words. 64-bit hashes only propose windows. Rows that share a doc_id are one document and should be equal; each of them is kept or
    cut alike. Rows with a null doc_id stay whole. A document's keys are gathered for
    that document only, so no group is larger than its text.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = docs.where("doc_id is not null")
    with scratch(clean=True) as keep:
        keys = stored(_key_rows(known, size), "keys")
        # Stored, so that a hot key is split in the join instead of kept with its count.
        often = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        keys = keys.join(stored(often, "often"), "key")
        shared = keep(keys.groupBy("doc_id").agg(F.collect_set("key").alias("shared")), "shared")
    with scratch(clean=True) as keep:
        firsts = keep(_first_windows(known, shared, size), "firsts")
    lists = shared.join(firsts, "doc_id", "left")
    return _finished(docs, lists, size)


def _kept_rows(batch, data, starts, ends, first, gone) -> pa.RecordBatch:
    words, removed, kept = [], [], []
    for i in range(batch.num_rows):
        a, b = first[i], first[i + 1]
        stay = np.flatnonzero(~gone[a:b]) + a
        words.append(b - a)
        removed.append(b - a - len(stay))
        kept.append(b" ".join(data[s:e].tobytes() for s, e in zip(starts[stay], ends[stay])))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(words, pa.int64()),
            pa.array(removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n_words", "n_removed", "kept"],
    )


def _finished(docs: DataFrame, lists: DataFrame, size: int) -> DataFrame:
    """The rows of all documents; only those that may lose words are shuffled."""
    near, bits = _may_be_listed(docs, lists)
    shape = "doc_id bigint, n_words bigint, n_removed bigint, kept string"

    def untouched(batches):
        for batch in batches:
            batch = batch.filter(pa.array(~hashed_ids(batch.column("doc_id"), bits.value)))
            for own, data, offsets in parts([batch], "text", SLICE_BYTES):
                starts, ends, first = word_spans(data, offsets, WHITE)
                yield _kept_rows(own, data, starts, ends, first, np.zeros(len(starts), bool))

    def cut(batches):
        for batch, data, (starts, ends, first), at, digests in _candidates(batches, size):
            gone = np.ones(len(at), bool)
            bounds = np.searchsorted(at, first)
            for i, firsts in enumerate(batch.column("firsts")):
                a, b = bounds[i], bounds[i + 1]
                if firsts.is_valid and a < b:
                    halves = [firsts.values.field(x).to_numpy() for x in ("high", "low")]
                    known = np.ascontiguousarray(np.stack(halves, axis=1)).view("S16")[:, 0]
                    gone[a:b] = ~np.isin(digests[a:b], known) | _repeated(digests[a:b])
            yield _kept_rows(
                batch, data, starts, ends, first, _covered(at[gone], len(starts), size)
            )

    touched = near.join(lists, "doc_id", "left").mapInArrow(cut, shape)
    return docs.mapInArrow(untouched, shape).union(touched)
