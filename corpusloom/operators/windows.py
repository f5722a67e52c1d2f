"""Count windows, prefix sums at scale, and differences of cumulative counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.hashing import order_key
from corpusloom.session import store


def mark_ranges(df: DataFrame, order: list[str], group: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """A stored copy of the rows with ``_part``, the number of their range in the order of (group, order). Ranges are of about equal size whatever the groups are.

    They are fixed by a table in the shared folder: a recomputed sample would move their limits.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return store(df.repartitionByRange(n, *(group or []), *order).withColumn("_part", F.spark_partition_id()), "ranges")


def range_sums(ranged: DataFrame, order: list[str], values: dict[str, Column], group: list[str] | None = None) -> DataFrame:
    """:func:`prefix_sums` of rows that have their ranges."""
    group = group or []
    vals = {f"_v{i}": F.coalesce(v, F.lit(0)) for i, v in enumerate(values.values())}
    ranged = ranged.withColumns(vals)
    totals = ranged.groupBy("_part", *group).agg(*[F.sum(v).alias(f"{v}t") for v in vals])
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], *[F.coalesce(F.sum(f"{v}t").over(before), F.lit(0)).alias(f"{v}o") for v in vals])
    on = [F.col("_part") == F.col("_p"), *[F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]]
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(offsets, on)
    out = out.withColumns({name: F.col(f"{v}o") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for name, v in zip(values, vals)})
    return out.drop("_p", *[f"_g{i}" for i in range(len(group))], *vals, *[f"{v}o" for v in vals])


def prefix_sums(df: DataFrame, order: list[str], values: dict[str, Column], group: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """Adds, for each name, the sum of its value over all rows before this one in the order (within the group).

    Two phases, so no group has to fit into a task: rows are sorted into ranges of (group, order); every range sums up per group; the sums of the
    ranges, one row per range and group within it, are turned into offsets; and each row adds its range's offset to the sum within the range.
    The order must be total. Nulls count as 0. All columns go along; put wide ones aside where that matters.
    """
    return range_sums(mark_ranges(df, order, group, partitions), order, values, group).drop("_part")


def count_windows(records: DataFrame, size: int, *, source: str = "source_id", index: str = "row_index", kept: Column | None = None) -> DataFrame:
    """Adds ``window``, the number of the count window, and ``next_cursor``, the raw row after its last one.

    Windows hold ``size`` kept rows of a source in the order of the raw index; ``kept`` is false for rows that don't count (blank
    ones), which carry the window they fall into and move its cursor only if a kept row follows or the source ends. Indexes are distinct within a source.
    """
    kept = F.lit(True) if kept is None else kept
    if size < 1:
        raise ValueError("a window needs at least one row")
    # the index alone is sorted; the rows themselves move once, to meet their windows
    rows = prefix_sums(records.select(F.col(source).alias("_s"), F.col(index).alias("_i"), kept.cast("int").alias("_kept")), ["_i"], {"_before": F.col("_kept")}, ["_s"])
    rows = rows.withColumn("window", F.floor(F.col("_before") / size).cast("long"))
    ends = rows.groupBy(F.col("_s").alias("_e"), F.col("window").alias("_w")).agg(F.max(F.when(F.col("_kept") == 1, F.col("_i"))).alias("_last"), F.sum("_kept").alias("_n"), F.max("_i").alias("_raw"))
    ends = ends.select("_e", "_w", (F.when(F.col("_n") >= size, F.col("_last")).otherwise(F.col("_raw")) + 1).alias("next_cursor"))
    placed = rows.join(ends, F.col("_s").eqNullSafe(F.col("_e")) & (F.col("window") == F.col("_w"))).select("_s", "_i", "window", "next_cursor")
    return records.join(placed, F.col(source).eqNullSafe(F.col("_s")) & (F.col(index) == F.col("_i"))).drop("_s", "_i")


def shuffled_windows(records: DataFrame, size: int, seed: int, *, source: str = "source_id", index: str = "row_index", document: str = "document_id", digest: str = "content_sha256") -> DataFrame:
    """Adds ``window``, ``next_cursor`` and ``order_key``: a source is read window by window, within one by the key."""
    return count_windows(records, size, source=source, index=index).withColumn("order_key", order_key(seed, F.col(source), F.col(document), F.col(digest)))


def counter_deltas(snapshots: DataFrame, counters: list[str], order: list[str], group: list[str] | None = None) -> DataFrame:
    """Adds ``<counter>_delta``: the growth of cumulative counters from snapshot to snapshot, beginning at 0; a counter that falls gets a true ``backwards``."""
    over = Window.partitionBy(*(group or [])).orderBy(*order)
    deltas = {f"{c}_delta": F.col(c) - F.lag(c, 1, 0).over(over) for c in counters}
    out = snapshots.withColumns(deltas)
    return out.withColumn("backwards", F.exists(F.array(*[F.col(d) < 0 for d in deltas]), lambda x: x))
