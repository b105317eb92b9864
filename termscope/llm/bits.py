"""A bit map of fixed size over ids: a first filter that travels to every task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.arrays import U64, mix

#: 2 MB, whatever the number of ids. Ids that collide pass, so an exact join follows.
BITS = 24
_LOW = 15


def _places(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U64)) >> U64(64 - BITS)).astype(np.int64)


def id_bits(ids: DataFrame, column: str) -> Broadcast:
    """The bit map of the ids in ``column``, sent to all executors."""

    def places(batches):
        for batch in batches:
            seen = np.unique(_places(pc.drop_null(batch.column(0)).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen >> _LOW), pa.array(seen & ((1 << _LOW) - 1))], ["high", "low"]
            )

    def packed(batches):
        for batch in batches:
            out = []
            for lows in batch.column("lows"):
                flags = np.zeros(1 << _LOW, bool)
                flags[np.array(lows.as_py())] = True
                out.append(np.packbits(flags).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("high"), pa.array(out, pa.binary())], ["high", "bits"])

    found = ids.select(F.col(column).cast("bigint")).mapInArrow(places, "high bigint, low bigint")
    rows = (
        found.distinct()
        .groupBy("high")
        .agg(F.collect_list("low").alias("lows"))
        .mapInArrow(packed, "high bigint, bits binary")
        .collect()
    )
    flags = np.zeros((1 << (BITS - _LOW), 1 << (_LOW - 3)), np.uint8)
    for row in rows:
        flags[row["high"]] = np.frombuffer(row["bits"], np.uint8)
    return ids.sparkSession.sparkContext.broadcast(flags.reshape(-1))


def hashed_ids(column: pa.Array, flags: np.ndarray) -> np.ndarray:
    """Whether each id of an Arrow column may be in the bit map; nulls are not."""
    ids = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
    at = _places(ids)
    hit = (flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
    valid = pc.is_valid(column).to_numpy(zero_copy_only=False)
    return hit.astype(bool) & valid
