"""Bitmaps of hashed keys that go to every task: bounded in size whatever the number of keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.llm import kernels as kn

BITS = 22
MOST_BITS = 28


def bits_for(count: int) -> int:
    """Bits (as a power of two) for so many keys: sixteen each, and 32 MB at most; beyond 16 million keys it lets more through."""
    return min(max((16 * count - 1).bit_length(), 10), MOST_BITS)


def bitmap(keys: DataFrame, bits: int = BITS):
    """A broadcast bitmap of 2 ** bits bits over the long column of ``keys``; at most 2 ** (bits - 3) bytes.

    Tasks set bits, Spark ORs the words, and only the finished words, at most 2 ** (bits - 6),
    reach the driver, as columns. With very many keys it lets more through, but it never loses one.
    """
    def words(batches):
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            word, value = kn.bit_words(values, bits)
            yield pa.record_batch({"word": pa.array(word), "value": pa.array(value.view(np.int64))})

    found = keys.mapInArrow(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    whole = np.zeros(1 << (bits - 6), np.uint64)
    whole[found.column("word").to_numpy()] = found.column("value").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(whole)
