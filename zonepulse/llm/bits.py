"""Bit filters of a fixed size: which rows of a pass can matter to a later join.

A filter never loses a row, it only lets some pass in vain; the join that follows is exact.
Its size is a parameter and doesn't grow with the data, so it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix


def _place(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.view(np.uint64))
    return (h >> np.uint64(64 - (bits - 6))).astype(np.int64), h & np.uint64(63)


def bit_filter(keys: DataFrame, bits: int) -> Broadcast:
    """Filter of ``2 ** bits`` bits over the only (long) column of ``keys``.  At most
    ``2 ** (bits - 6)`` rows of 16 bytes reach the driver."""

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, bit = _place(np.asarray(batch.column(0).to_numpy(zero_copy_only=False), dtype=np.int64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array((np.uint64(1) << bit).view(np.int64))], names=["w", "b"])

    got = (
        keys.where(F.col(keys.columns[0]).isNotNull()).mapInArrow(words_of, "w long, b long")
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    )
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def tester(filter_: Broadcast) -> Callable[[np.ndarray], np.ndarray]:
    """For tasks: keys (int64) -> whether each may be in the filter."""
    table = filter_.value
    bits = int(len(table)).bit_length() - 1 + 6

    def test(keys: np.ndarray) -> np.ndarray:
        word, bit = _place(keys, bits)
        return (table[word] >> bit) & np.uint64(1) == 1

    return test
