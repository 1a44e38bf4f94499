"""A Bloom filter of identifiers, to keep texts that a join cannot need out of its shuffle.

The filter has 16 bits per identifier, up to ``MAX_BITS``; it is the only thing
that reaches the driver and the tasks. Beyond that size it lets more rows
through; a join after it decides, so results never depend on it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from .common import lean

BITS_PER_ID = 16
BLOCK_BITS = 1 << 16
MAX_BITS = 1 << 27


def membership(ids: DataFrame) -> Callable[[Column], Column]:
    """A condition on an identifier: false only if ``ids``, one column, does not hold it (or it is null)."""
    bits = min(MAX_BITS, max(BLOCK_BITS, 1 << (BITS_PER_ID * ids.count()).bit_length()))
    place = lambda id_: F.pmod(F.xxhash64(id_.cast("long")), F.lit(bits))

    def pack(group: pa.Table) -> pa.Table:
        held = np.zeros(BLOCK_BITS, bool)
        held[np.asarray(group["place"]) % BLOCK_BITS] = True
        return pa.table({"block": group["block"].slice(0, 1), "held": pa.array([np.packbits(held).tobytes()], pa.binary())})

    places = ids.select(place(F.col(ids.columns[0])).alias("place")).distinct()
    blocks = places.withColumn("block", F.floor(F.col("place") / BLOCK_BITS)).groupBy("block")
    packed = np.zeros(bits // 8, np.uint8)
    for block, held in blocks.applyInArrow(pack, "block long, held binary").collect():
        packed[block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8] = np.frombuffer(bytes(held), np.uint8)

    @arrow_udf("boolean")
    def holds(at: pa.Array) -> pa.Array:
        lean()
        at = np.asarray(at)
        return pa.array((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0)

    return lambda id_: id_.isNotNull() & holds(place(id_))
