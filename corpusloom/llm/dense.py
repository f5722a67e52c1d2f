"""Counters and bit sets of a fixed size over 64-bit hashes: built in the tasks, merged by block, and small enough to go to every worker."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of a block, the unit in which arrays are merged.
BLOCK = 1 << 18


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The counter of every hash, from its highest bits."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def set_bits(mask: np.ndarray, hashes: np.ndarray) -> None:
    """Set the bit of every hash, from its lowest bits, in an array of bytes whose length is a power of two."""
    place = (hashes & np.uint64(len(mask) * 8 - 1)).astype(np.int64)
    np.bitwise_or.at(mask, place >> 3, (1 << (place & 7)).astype(np.uint8))


def has_bits(mask: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes & np.uint64(len(mask) * 8 - 1)).astype(np.int64)
    return (mask[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def blocks_of(array: np.ndarray) -> list[tuple[int, bytes]]:
    """The blocks of an array that aren't all zero, compressed."""
    raw = memoryview(array.reshape(-1).view(np.uint8))
    return [(i // BLOCK, zlib.compress(b, 1)) for i in range(0, len(raw), BLOCK) if np.any(b := raw[i : i + BLOCK])]


def merge(blocks: DataFrame, kind: type, op: Callable, size: int, finish: Callable = lambda x: x, fan: int = 64) -> np.ndarray:
    """The array of ``size`` entries that arrays written by tasks, as (block, data), make together by ``op``.

    Merged in two steps, so that no task sees the blocks of all tasks; what reaches the driver has a fixed size. ``finish`` makes the
    entries smaller on the way.
    """

    def join(last: bool):
        def run(table: pa.Table) -> pa.Table:
            total = None
            for data in table.column("data").to_pylist():
                part = np.frombuffer(zlib.decompress(data), kind)
                total = part.copy() if total is None else op(total, part)
            total = finish(total) if last else total
            return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "data": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

        return run

    some = blocks.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(fan))).groupBy("block", "part").applyInArrow(join(False), "block int, data binary")
    rows = some.groupBy("block").applyInArrow(join(True), "block int, data binary").collect()
    per = BLOCK // np.dtype(kind).itemsize
    zero = finish(np.zeros(per, kind))
    out = np.zeros(max(size, per), zero.dtype)
    for r in rows:
        part = np.frombuffer(zlib.decompress(r["data"]), zero.dtype)
        out[r["block"] * per : r["block"] * per + len(part)] = part
    return out[:size]
