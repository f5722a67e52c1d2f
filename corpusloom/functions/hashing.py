"""Content hashes, hash fractions, splits and order-sensitive digests."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
#: Largest value of the first 16 hex digits, and one more: the two split rules divide by different ones.
INCLUSIVE, EXCLUSIVE = float(16**16 - 1), float(16**16)


def sha(text: Column) -> Column:
    """Hex SHA-256 of UTF-8 text or of bytes."""
    return F.sha2(text.cast("binary"), 256)


def json_sha256(value: Any) -> str:
    """Hash of canonical JSON: sorted keys, no blanks, characters as they are. For driver-side evidence."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def hash_fraction(digest: Column, whole: float = INCLUSIVE) -> Column:
    """The first 16 hex digits of a digest as a number from 0 to 1."""
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(whole)


def hash_split(digest: Column, fraction: float, *, whole: float = INCLUSIVE, small: str = "validation", rest: str = "train") -> Column:
    """A split by content hash alone, stable under any order of rows. A fraction of 0 or less puts all rows into ``rest``."""
    if fraction <= 0:
        return F.lit(rest)
    return F.when(hash_fraction(digest, whole) < fraction, small).otherwise(rest)


def order_key(seed: int, source_id: Column, document_id: Column, digest: Column) -> Column:
    """The key that shuffles documents within a window, the same for the same seed."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(source_id, F.lit("")), document_id, digest), 256)


def _in_order(position: Column, value: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(position.alias("p"), value.alias("v")))), lambda x: x["v"])


def ordered_digest(position: Column, digest: Column) -> Column:
    """An aggregate: the hash of all digests put together in order. It holds its group's digests in one row; for groups of unbounded
    size there is :func:`block_digest`."""
    return F.sha2(F.array_join(_in_order(position, digest), ""), 256)


def chained_digest(position: Column, value: Column) -> Column:
    """An aggregate: d = sha256(d || value) over the values in order, from 64 zeros. Like :func:`ordered_digest` for bounded groups."""
    step = lambda d, v: F.sha2(F.concat(F.unhex(d), F.encode(v, "UTF-8")), 256)
    return F.aggregate(_in_order(position, value), F.lit("0" * 64), step)


def block_digest(df: DataFrame, group: list[str], position: str, digest: str, block: int = 10_000) -> DataFrame:
    """(group, documents, digest): an order-sensitive digest of groups of any size, as a hash over the hashes of blocks of positions.

    Blocks are ranges of ``block`` positions, so each is one bounded row wherever its rows lie. The value differs from that of
    :func:`ordered_digest`, and is the same for the same rows and positions however they are partitioned.
    """
    parts = df.groupBy(*group, F.floor(F.col(position) / block).alias("_block")).agg(ordered_digest(F.col(position), F.col(digest)).alias("_d"), F.count("*").alias("_n"))
    parts = parts.groupBy(*group, F.floor(F.col("_block") / block).alias("_super")).agg(ordered_digest(F.col("_block"), F.col("_d")).alias("_d"), F.sum("_n").alias("_n"))
    return parts.groupBy(*group).agg(F.sum("_n").alias("documents"), ordered_digest(F.col("_super"), F.col("_d")).alias("digest"))
