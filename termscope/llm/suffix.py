"""Suffix-array dedup: column-wise construction over many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termscope.llm.arrays import U64, mix, parts, powers, prefix_hashes, signed
from termscope.llm.bits import hashed_ids, id_bits
from termscope.sources.storage import scratch, stored

LENGTH = 50

#: Bytes of an anchor. A string of LENGTH bytes has LENGTH - ANCHOR + 1 of them and is
#: sent to the collection of the one with the least hash.
ANCHOR = 20

#: Different segments that are read into memory before their collections are built, and
#: the most that a collection may have.
SEGMENTS = 150_000

#: Bytes of text that are hashed at a time.
SLICE_BYTES = 256 << 10

_ABSENT = 256
_SHIFT_BITS = 6


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchor_hashes(data: np.ndarray, anchor: int) -> np.ndarray:
    """A hash of the ``anchor`` bytes from each place on."""
    sums = prefix_hashes(data)
    _, down = powers(len(sums))
    found = sums[anchor:] - sums[:-anchor]
    found *= down[: len(found)]
    found ^= found >> U64(32)
    found *= U64(0xD6E8FEB86659FD93)
    found ^= found >> U64(32)
    return found


def stretches(hashes: np.ndarray, offsets: np.ndarray, length: int, anchor: int):
    """``(key, text, start, count)`` of each run of strings with one least hash.

    A run is a number of strings of ``length`` bytes at consecutive places of a text.
    """
    keys = _sliding_least(hashes, length - anchor + 1)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    new[offsets[:-1][offsets[:-1] < len(keys)]] = True
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(keys)))
    owner = np.searchsorted(offsets, start, "right") - 1
    count = np.minimum(count, offsets[owner + 1] - length + 1 - start)
    kept = count > 0
    return keys[start[kept]], owner[kept], start[kept], count[kept]


def one_anchor_each(hashes: np.ndarray, key, owner, start, count, width: int):
    """Cut runs so that all strings of one have the same first place of their anchor.

    Also returns that place. Only where anchors repeat closely is there anything to cut.
    """
    done = []
    while len(key):
        near = np.minimum(start[:, None] + np.arange(width), len(hashes) - 1)
        place = start + (hashes[near] == key[:, None]).argmax(axis=1)
        own = np.minimum(count, place - start + 1)
        done.append((key, owner, start, own, place))
        more = count > own
        key, owner, start, count = (
            key[more], owner[more], (start + own)[more], (count - own)[more],
        )
    if not done:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, U64), empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*done))


def column_minima(
    group: np.ndarray, rows: np.ndarray, docs: np.ndarray, strings: int, length: int
) -> np.ndarray:
    """For each row and string place, the least document that has the string there.

    ``rows`` is a matrix of bytes, one row per segment, aligned at the anchors; places
    beyond a segment are absent. One symbol of each segment is taken per round, from
    the last column to the first. A round sorts the suffixes by their new first symbol,
    stably, which keeps them in order, and updates the common prefix of neighbours: one
    more than the least of those between them before. As segments of a collection are
    aligned, equal strings start in the same column, so each round's order is all that
    is compared. Runs of common prefixes of ``length`` or more are equal strings.
    """
    count, columns = rows.shape
    order = np.argsort(group, kind="stable")
    common = np.zeros(count, np.int64)
    out = np.full((count, strings), np.iinfo(np.int64).max)
    for column in range(columns - 1, -1, -1):
        symbol = rows[order, column].astype(np.int64)
        key = group[order] * 512 + symbol
        moved = np.argsort(key, kind="stable")
        near = np.zeros(count, bool)
        near[1:] = (key[moved[1:]] == key[moved[:-1]]) & (symbol[moved[1:]] != _ABSENT)
        at = np.flatnonzero(near)
        fresh = np.zeros(count, np.int64)
        if len(at):
            spans = np.empty(2 * len(at), np.int64)
            spans[0::2] = moved[at - 1] + 1
            spans[1::2] = moved[at] + 1
            padded = np.append(common, 0)
            fresh[at] = 1 + np.minimum.reduceat(padded, spans)[0::2]
        order, common = order[moved], fresh
        if column < strings:
            start = np.flatnonzero(common < length)
            least = np.minimum.reduceat(docs[order], start)
            out[order, column] = np.repeat(least, np.diff(np.append(start, count)))
    return out


def _resolved(table: pa.Table, length: int, anchor: int) -> pa.RecordBatch:
    """``(key, shift, body, least)``: for each string of a body its least document.

    Only bodies of which some document loses a string are returned.
    """
    strings = length - anchor + 1
    columns = strings + length - 1
    group = np.unique(table.column("key").to_numpy(), return_inverse=True)[1]
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    shift = table.column("shift").to_numpy()
    bodies = table.column("body").combine_chunks()
    if isinstance(bodies, pa.ChunkedArray):
        bodies = bodies.chunk(0)
    ends = np.frombuffer(bodies.buffers()[1], np.int32)[
        bodies.offset : bodies.offset + len(bodies) + 1
    ].astype(np.int64)
    data = np.frombuffer(bodies.buffers()[2], np.uint8)
    sizes = np.diff(ends)
    # Rows are aligned so that the anchor begins in column strings - 1.
    rows = np.full((len(low), columns), _ABSENT, np.uint16)
    flat = np.repeat(np.arange(len(low)) * columns + strings - 1 - shift - ends[:-1], sizes)
    rows.reshape(-1)[flat + np.arange(ends[0], ends[-1])] = data[ends[0] : ends[-1]]
    least = column_minima(group, rows, low, strings, length)
    place = np.arange(strings)[None, :] - (strings - 1 - shift)[:, None]
    own = (place >= 0) & (place < (sizes - length + 1)[:, None])
    hit = (own & (least < high[:, None])).any(axis=1)
    own &= hit[:, None]
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum(own.sum(axis=1)[hit])), pa.int32()), pa.array(least[own])
    )
    kept = table.select(["key", "shift", "body"]).filter(pa.array(hit)).combine_chunks()
    columns = [c.combine_chunks() for c in kept.columns]
    columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays([*columns, lists], ["key", "shift", "body", "least"])


def _by_strings(bodies: DataFrame, length: int) -> DataFrame:
    """What ``_resolved`` returns, by aggregates over single strings.

    A string's rows meet only in a partial aggregate and in a join, so it does not
    matter how many bodies an anchor has. Equal strings have equal anchors.
    """
    places = F.sequence(F.lit(0), F.length("body") - length)
    cut = F.transform(places, lambda i: F.substring(F.col("body"), i + 1, F.lit(length)))
    rows = bodies.select("key", "shift", "body", "low", F.posexplode(cut).alias("place", "string"))
    # Stored, so that a hot string is split in the join.
    first = stored(rows.groupBy("string").agg(F.min("low").alias("first")), "strings")
    each = F.array_sort(F.collect_list(F.struct("place", "first")))
    return (
        rows.join(first, "string")
        .groupBy("key", "shift", "body")
        .agg(each.alias("each"))
        .select("key", "shift", "body", F.col("each.first").alias("least"))
    )


def _gone(batches) -> Iterator[pa.RecordBatch]:
    """``(doc_id, at, gone)``: strings, as bits from ``at`` on, that an earlier one has."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        lists = batch.column("least")
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(ids)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        earlier = lists.flatten().to_numpy() < ids[row]
        bits = np.zeros(len(ids), np.int64)
        np.bitwise_or.at(bits, row[earlier], np.int64(1) << place[earlier])
        at = (batch.column("at").to_numpy() >> _SHIFT_BITS).astype(np.int32)
        hit = bits != 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[hit]), pa.array(at[hit]), pa.array(bits[hit])], ["doc_id", "at", "gone"]
        )


def _whole_collections(batches, most: int) -> Iterator[pa.Table]:
    """Tables of about ``most`` rows that end where a key does; rows are sorted by key."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= most:
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                count -= cut
    if count:
        yield pa.Table.from_batches(held)


def _key_rows(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``(key, doc_id)`` of each document's anchors, each once."""

    def emit(batches):
        for batch, data, offsets in parts(batches, "text", SLICE_BYTES):
            if len(data) < length:
                continue
            keys, owner, _, _ = stretches(anchor_hashes(data, anchor), offsets, length, anchor)
            pairs = keys + mix(owner.astype(U64) + U64(1))
            _, once = np.unique(pairs, return_index=True)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(keys[once])), pa.array(ids[owner[once]], pa.int64())],
                ["key", "doc_id"],
            )

    return docs.mapInArrow(emit, "key bigint, doc_id bigint")


def _may_be_listed(docs: DataFrame, lists: DataFrame) -> tuple[DataFrame, Broadcast]:
    """Documents that may have a list, as a bit map of fixed size tells."""
    bits = id_bits(lists, "doc_id")

    def near(batches):
        for batch in batches:
            yield batch.filter(pa.array(hashed_ids(batch.column("doc_id"), bits.value)))

    return docs.mapInArrow(near, "doc_id bigint, text string"), bits


def _segments(docs: DataFrame, shared: DataFrame, length: int, anchor: int) -> DataFrame:
    """``(key, doc_id, at, body)``: the bytes of each stretch with a shared key.

    ``at`` is the stretch's place, with the anchor's place in it in its lowest bits.
    """

    def emit(batches):
        for batch, data, offsets in parts(batches, "text", SLICE_BYTES):
            if len(data) < length:
                continue
            hashes = anchor_hashes(data, anchor)
            keys, owner, start, count = stretches(hashes, offsets, length, anchor)
            first = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            hit = np.zeros(len(keys), bool)
            for i, known in enumerate(batch.column("shared")):
                a, b = first[i], first[i + 1]
                if a < b:
                    hit[a:b] = np.isin(keys[a:b], known.values.to_numpy().view(U64))
            keys, owner, start, count, place = one_anchor_each(
                hashes, keys[hit], owner[hit], start[hit], count[hit], length - anchor + 1
            )
            sizes = count + length - 1
            ends = np.append(0, np.cumsum(sizes))
            index = np.repeat(start - ends[:-1], sizes) + np.arange(ends[-1])
            bodies = pa.Array.from_buffers(
                pa.binary(),
                len(sizes),
                [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[index].tobytes())],
            )
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(keys)),
                    pa.array(ids[owner], pa.int64()),
                    pa.array(((start - offsets[owner]) << _SHIFT_BITS) | (place - start)),
                    bodies,
                ],
                ["key", "doc_id", "at", "body"],
            )

    near, _ = _may_be_listed(docs, shared)
    return near.join(shared, "doc_id").mapInArrow(
        emit, "key bigint, doc_id bigint, at bigint, body binary"
    )


def _kept_rows(batch: pa.RecordBatch, data, offsets, gone) -> pa.RecordBatch:
    total = np.append(0, np.cumsum(gone))
    removed = np.diff(total[offsets])
    begin = gone.copy()
    begin[1:] &= ~gone[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(gone)]
    begin[cuts] = gone[cuts]
    spans = np.diff(np.append(0, np.cumsum(begin))[offsets])
    # The texts left are what is left of all of them, at offsets less what is gone.
    ends = offsets - total[offsets]
    kept = pa.Array.from_buffers(
        pa.binary(),
        batch.num_rows,
        [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[~gone].tobytes())],
    )
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), kept],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
    )


def _finished(docs: DataFrame, gone: DataFrame, length: int) -> DataFrame:
    """The rows of all documents; only those that may lose bytes are shuffled."""
    near, bits = _may_be_listed(docs, gone)
    shape = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"

    def untouched(batches):
        for batch in batches:
            batch = batch.filter(pa.array(~hashed_ids(batch.column("doc_id"), bits.value)))
            kept = pc.fill_null(batch.column("text"), "").cast(pa.binary())
            none = pa.array(np.zeros(batch.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(kept).cast(pa.int64()), none, none, kept],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    def cut(batches):
        for batch, data, offsets in parts(batches, "text"):
            change = np.zeros(len(data) + 1, np.int64)
            lists = batch.column("gone")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            rows = lists.flatten()
            at = rows.field("at").to_numpy().astype(np.int64) + np.repeat(offsets[:-1], sizes)
            flags = rows.field("gone").to_numpy()
            step = 0
            while flags.any():
                hit = at[(flags & 1) == 1] + step
                np.add.at(change, hit, 1)
                np.add.at(change, hit + length, -1)
                flags, step = flags >> 1, step + 1
            yield _kept_rows(batch, data, offsets, np.cumsum(change[:-1]) > 0)

    touched = near.join(gone, "doc_id", "left").mapInArrow(cut, shape)
    return docs.mapInArrow(untouched, shape).union(touched)


def kept_bytes(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)`` of every row of ``docs``.

    ``kept`` are the bytes left of the UTF-8 text. A byte goes when a string of
    ``length`` bytes covers it that also starts in a document of smaller doc_id.
    Strings are judged on the input and never reach over two documents.

    1. Each string has an anchor, the one of its ``anchor``-byte parts with the least
       hash; equal strings have equal anchors at equal places. Anchors of one document
       only are out.
    2. Equal segments, the stretches of strings around the other anchors, become one
       with its least document. What is left is dealt by anchor. All segments with one
       anchor make a collection, whose order of suffixes and common prefixes is built
       column by column, a symbol of each segment per round. Anchors with more than
       ``SEGMENTS`` different segments have their strings aggregated one by one.
    3. Strings are compared byte by byte; those that a smaller document has are joined
       to the segments, by a SHA-256 of the segment's bytes, and sent to their document,
       which drops what they cover.

    Nulls are empty texts; empty texts and those shorter than ``length`` lose nothing.
    Rows that share a doc_id are one document and should be equal; rows with a null
    doc_id stay whole and count for nothing. Other columns are not looked at. A task
    holds some ``SEGMENTS`` different segments at a time, however many one anchor has.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = docs.where("doc_id is not null")
    with scratch(clean=True) as keep:
        segments = _shared_segments(known, length, anchor)
        segments = segments.withColumn("shift", F.col("at").bitwiseAND((1 << _SHIFT_BITS) - 1))
        # Stored, so that the segments of a hot body are split in the join.
        least = _least_documents(segments, length, anchor)
        found = segments.select("doc_id", "at", _body_id().alias("id")).join(least, "id")
        found = found.select("doc_id", "at", "least")
        found = found.mapInArrow(_gone, "doc_id bigint, at int, gone bigint")
        gone = found.groupBy("doc_id").agg(F.collect_list(F.struct("at", "gone")).alias("gone"))
        gone = keep(gone, "gone")
    return _finished(docs, gone, length)


def _body_id() -> Column:
    """A SHA-256 of a body and of its anchor's place in it, which decide its anchor.

    It stands for the body in the join with the segments, so that no bytes travel there.
    """
    place = F.lpad(F.col("shift").cast("string"), 2, "0").cast("binary")
    return F.unhex(F.sha2(F.concat(place, "body"), 256))


def _shared_segments(known: DataFrame, length: int, anchor: int) -> DataFrame:
    """The stored segments of all anchors that occur in more than one row.

    Anchors are hashed once to count them and again to list those of each document that
    repeat: two passes over the texts take less disk than a table of all anchors.
    """
    keys = _key_rows(known, length, anchor)
    with scratch() as keep:
        # Stored, so that a hot anchor is split in the join instead of kept with its documents.
        often = stored(
            keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "often"
        )
        listed = keys.join(often, "key").groupBy("doc_id")
        shared = stored(listed.agg(F.collect_set("key").alias("shared")), "shared")
        return keep(_segments(known, shared, length, anchor), "segments")


def _least_documents(segments: DataFrame, length: int, anchor: int) -> DataFrame:
    """The stored ``(id, least)``: for each string of a body its least document.

    Bodies of which no document loses a string are left out, as in ``_resolved``.
    """

    def resolve(batches):
        for table in _whole_collections(batches, SEGMENTS):
            yield _resolved(table, length, anchor)

    with scratch() as keep:
        bodies = stored(
            segments.groupBy("key", "shift", "body").agg(
                F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
            ),
            "bodies",
        )
        crowded = stored(
            bodies.groupBy("key")
            .agg(F.count("*").alias("n"))
            .where(F.col("n") > SEGMENTS)
            .select("key"),
            "crowded",
        )
        # No hint: Spark broadcasts the crowded anchors by their measured size.
        found = (
            bodies.join(crowded, "key", "left_anti")
            .repartition("key")
            .sortWithinPartitions("key")
            .mapInArrow(resolve, "key bigint, shift bigint, body binary, least array<bigint>")
        )
        found = found.union(_by_strings(bodies.join(crowded, "key"), length))
        return keep(found.select(_body_id().alias("id"), "least"), "least")
