"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.arrays import parts
from termscope.llm.tokens import WordEncoder
from termscope.sources.storage import stored

CAPACITY = 4096
END_ID = 1

#: Pieces that one task packs. With some thousands of pieces the rule leaves next to
#: no gaps, so more would not make the packing better; and the number of tasks, not
#: their size, grows with the input.
PIECES_PER_PART = 20_000

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_SPANS = "tokens array<int>"


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_tokens: bool = False
) -> DataFrame:
    """One row per piece of each document's ids, the end id appended.

    Only documents of more than ``capacity`` ids are cut; the last piece may be
    shorter. Null and empty texts have the end id alone. ``tokenizer`` is the path of
    the vocabulary on every machine. ``with_tokens`` adds the ids.
    """

    def cut(batches):
        encoder = WordEncoder(tokenizer)
        for batch, _, _ in parts(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = defaultdict(list)
            ids = batch.column("doc_id").to_pylist()
            for doc, found in zip(ids, encoder.encode(texts)):
                found = np.append(found, np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(found), capacity)):
                    own = found[start : start + capacity]
                    rows["doc_id"].append(doc)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(len(own))
                    rows["ids_crc32"].append(zlib.crc32(own.tobytes()))
                    if with_tokens:
                        rows["tokens"].append(own.astype(np.int32))
            columns = [
                pa.array(rows["doc_id"], pa.int64()),
                pa.array(rows["piece"], pa.int32()),
                *(pa.array(rows[c], pa.int64()) for c in ("start", "length", "ids_crc32")),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_tokens:
                columns.append(pa.array(rows["tokens"], pa.list_(pa.int32())))
                names.append("tokens")
            yield pa.RecordBatch.from_arrays(columns, names)

    shape = f"{_PIECES}, {_SPANS}" if with_tokens else _PIECES
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        cut, shape
    )


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the order given.

    A piece goes where the sum, over residual gaps, of the squared number of open bins
    with that gap becomes smallest; a new bin is one of the choices. Among equal
    choices the smaller gap wins, and in it the bin opened last.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    used = 0
    for k, size in enumerate(lengths.tolist()):
        gaps = np.flatnonzero(count[size:capacity])
        best_gap = capacity
        if len(gaps):
            # From gap g to g - size: 2 (N[g - size] - N[g] + 1); full bins count nothing.
            change = 2 * (count[gaps] - count[gaps + size] + 1)
            if gaps[0] == 0:
                change[0] = 1 - 2 * count[size]
            fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
            at = int(np.argmin(change))
            if change[at] <= fresh:
                best_gap = int(gaps[at]) + size
        if best_gap == capacity:
            chosen, used = used, used + 1
        else:
            chosen = open_bins[best_gap].pop()
            count[best_gap] -= 1
        bins[k], offsets[k] = chosen, capacity - best_gap
        left = best_gap - size
        if left:
            open_bins[left].append(chosen)
            count[left] += 1
    return bins, offsets


def _packed(rows: DataFrame, capacity: int, per_part: int) -> DataFrame:
    """``rows`` with ``bin`` (distinct over all parts), ``offset`` and ``filled``."""

    def pack(batches):
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        part = TaskContext.get().partitionId()
        lengths = table.column("length").to_numpy()
        ids = table.column("doc_id").fill_null(-1).to_numpy()
        order = np.lexsort((table.column("piece").to_numpy(), ids, -lengths))
        table, lengths = table.take(pa.array(order)), lengths[order]
        bins, offsets = sum_of_squares(lengths, capacity)
        filled = np.bincount(bins, weights=lengths).astype(np.int64)[bins]
        for name, values in (("bin", (part << 32) + bins), ("offset", offsets), ("filled", filled)):
            table = table.append_column(name, pa.array(values))
        yield from table.to_batches()

    shape = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    n = max(1, -(-rows.count() // per_part))
    # In turn, not by key: rows of one id, or of none, may be any number.
    return rows.repartition(n).mapInArrow(
        pack, f"{shape}, bin bigint, offset bigint, filled bigint"
    )


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, per_part: int = PIECES_PER_PART
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, at most ``capacity`` tokens each.

    Pieces are dealt in turn to parts of about ``per_part``, and each part is packed,
    longest first, by the sum-of-squares rule. The pieces of bins that stay under 99
    percent full, a few per part, are then dealt anew to fewer parts and packed again,
    so that gaps of different parts are filled from each other.

    Equal rows are packed as often as they occur. No sequence has a gap before its
    end. A part is packed in one task's memory, some 100 bytes a piece.
    """
    first = stored(_packed(pieces, capacity, per_part), "packed")
    poor = F.col("filled") * 100 < capacity * 99
    again = _packed(first.where(poor).select(*pieces.columns), capacity, per_part)
    columns = (*pieces.columns, "sequence_id", "offset")
    done = first.where(~poor).withColumn("sequence_id", F.col("bin") * 2)
    return done.select(*columns).union(
        again.withColumn("sequence_id", F.col("bin") * 2 + 1).select(*columns)
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places; see the two functions above.

    Every row of ``docs`` is packed, so repeated rows are packed repeatedly, and a null
    doc_id is carried along. Only doc_id and text are looked at.
    """
    return pack_pieces(stored(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)
