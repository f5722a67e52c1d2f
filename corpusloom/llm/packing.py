"""Filling fixed-capacity containers by minimum bin slack: subset sums over the multiset of remaining lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import store


def fullest_subset(counts: dict[int, int], capacity: int, span: int = 1 << 17) -> list[int]:
    """Lengths out of the multiset ``counts`` whose sum is as close to ``capacity`` as any; the longest is always in it.

    Reachable sums are the bits of one integer. A length with a count of c goes in as 1, 2, 4 ... copies, so that every
    step is one shift; going back over the steps gives the copies taken. Lengths are at most ``capacity``. Where more than
    ``span`` is to be filled, the longest lengths go in first, until so much is left for the sums: their integers stay small.
    """
    longest = max(counts)
    out, room, used = [longest], capacity - longest, {longest: 1}
    if room > span:
        for length in sorted(counts, reverse=True):
            take = min(counts[length] - used.get(length, 0), (room - span) // length)
            if take > 0:
                out += [length] * take
                used[length] = used.get(length, 0) + take
                room -= length * take
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        left, power = min(counts[length] - used.get(length, 0), room // length), 1
        while left > 0:
            take = min(power, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, power = left - take, power * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            out += [length] * take
            total -= length * take
    return out


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Containers as lists of positions in ``lengths``; every position is in exactly one. Lengths of 0 go along with the first container."""
    by: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        by.setdefault(n, []).append(i)
    empty = by.pop(0, [])
    counts = {n: len(v) for n, v in by.items()}
    out = []
    while counts:
        bin_ = []
        for n in fullest_subset(counts, capacity):
            bin_.append(by[n].pop())
            counts[n] -= 1
            if not counts[n]:
                del counts[n]
        out.append(bin_)
    if empty:
        out = out or [[]]
        out[0] += empty
    return out


def pack(
    records: DataFrame,
    layouts: DataFrame,
    *,
    id_col: str = "record_id",
    ids_col: str = "ids",
    group_cols: tuple[str, ...] = ("build_id", "stage", "split"),
    window_pieces: int = 4000,
    window_shards: int = 256,
    most_pieces: int = 400_000,
) -> DataFrame:
    """Assign records to shards of the capacity of their stage and split with as little room left as possible.

    A record longer than a shard is cut into full shards and a rest; no other record is cut. Whole records and rests are
    packed by minimum bin slack: each shard takes the longest length left and the multiset of remaining lengths that
    fills it closest to capacity. Groups are dealt by a hash of the record id into windows, however large a group is, so no task
    holds a group. A window is sized by tokens: it has the pieces of about ``window_shards`` shards, at least ``window_pieces``, and no more
    than ``most_pieces`` unless eight shards need more. Shards that a window couldn't fill to 99.5 % are opened, and their pieces packed
    again in fewer windows, until a group has one; what is moved shrinks with every round. Only ids and lengths move; the token arrays
    stay where they are (:func:`fill` puts them in).

    Returns one row per piece: the group columns, ``record_id, piece, pieces, start, length`` (tokens of ``ids`` in the
    piece and where they begin), ``eos`` (1 where the piece ends with the end token), ``window, shard, place`` (order within
    the shard) and ``capacity``. Shards are named by group, window and shard.

    Null ``ids`` are left out; empty ``ids`` are records of length 0, or 1 with the end token. Repeated rows of a record
    count once. Records whose stage and split have no layout, or one with no positive size, get one row with a null shard
    and capacity. Equal lengths are taken in order of descending id. Empty tables give no rows; other columns are ignored.
    """
    groups = list(group_cols)
    spark = records.sparkSession
    items = (
        records.filter(F.col(ids_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("record_id"), *groups, F.size(ids_col).alias("tokens"))
        .distinct()
    )
    rules = layouts.groupBy("stage", "split").agg(F.max("shard_size_tokens").cast("long").alias("capacity"), F.max(F.coalesce(F.col("append_eos"), F.lit(False)).cast("int")).alias("with_eos"))
    items = store(
        items.join(rules, ["stage", "split"], "left")
        .withColumn("capacity", F.when(F.col("capacity") > 0, F.col("capacity")))
        .withColumn("with_eos", F.coalesce("with_eos", F.lit(0)))
        .withColumn("full", F.col("tokens") + F.col("with_eos"))
        .withColumn("pieces", F.coalesce(F.greatest(F.lit(1), F.ceil(F.col("full") / F.col("capacity"))), F.lit(1)).cast("int")),
        "pack-items",
    )
    out = [*groups, "record_id", "piece", "pieces", "start", "length", "eos", "window", "shard", "place", "capacity"]
    kinds = {f.name: f.dataType.simpleString() for f in items.schema}
    front = "".join(f"{g} {kinds[g]}, " for g in groups)
    schema = front + "record_id long, piece int, pieces int, start long, length long, eos int, window int, shard int, place int, capacity long"
    loose = items.filter("capacity is null").select(
        *groups, "record_id", F.lit(0).alias("piece"), "pieces", F.lit(0).cast("long").alias("start"), F.col("tokens").cast("long").alias("length"),
        F.col("with_eos").alias("eos"), *[F.lit(None).cast("int").alias(c) for c in ("window", "shard", "place")], F.lit(None).cast("long").alias("capacity"),
    )

    def fill_window(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity, alone = int(pdf["capacity"].iloc[0]), int(pdf["windows"].iloc[0]) == 1
        pdf = pdf.sort_values(["record_id", "piece"], ignore_index=True)
        shard = 0
        cols = {c: pdf[c].tolist() for c in ("record_id", "tokens", "pieces", "piece", "with_eos")}
        rows, rest, lengths = [], [], []
        for record, tokens, pieces, piece, eos in zip(*cols.values()):
            if piece < 0:  # a record that wasn't placed before: its full shards first; only the end token may lie beyond the ids, and it is in the last piece
                for piece in range(pieces - 1):
                    rows.append((record, piece, pieces, piece * capacity, min(capacity, tokens - piece * capacity), 0, shard, 0))
                    shard += 1
                piece = pieces - 1
            rest.append((record, piece, pieces, piece * capacity, max(0, tokens - piece * capacity), eos))
            lengths.append(rest[-1][4] + eos)
        for positions in pack_lengths(lengths, capacity):
            opened = not alone and sum(lengths[i] for i in positions) < capacity - capacity // 200
            rows += [(*rest[i], -1 if opened else shard, place) for place, i in enumerate(positions)]
            shard += not opened
        done = pd.DataFrame(rows, columns=["record_id", "piece", "pieces", "start", "length", "eos", "shard", "place"])
        for g in groups:
            done[g] = pdf[g].iloc[0]
        return done.assign(window=int(pdf["window"].iloc[0]), capacity=capacity)[out]

    same = lambda table: [F.col(g).eqNullSafe(table[f"_{g}"]) for g in groups]
    left = items.filter("capacity is not null").select(*groups, "record_id", "tokens", "pieces", F.lit(-1).alias("piece"), "capacity", "with_eos", (F.col("full") - (F.col("pieces") - 1) * F.col("capacity")).alias("rest"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first, before, done = 0, None, [loose]
    while True:
        n, t, c = F.count("*"), F.sum("rest"), F.max("capacity")
        windows = F.greatest(F.least(F.floor(n / window_pieces), F.floor(t / (window_shards * c))), F.least(F.ceil(n / most_pieces), F.floor(t / (8 * c))), F.lit(1)).cast("int")
        sizes = left.groupBy(*groups).agg(windows.alias("windows")).select(*[F.col(g).alias(f"_{g}") for g in groups], "windows")
        if before is not None:  # fewer windows in every round
            old = before.select(*[F.col(f"_{g}").alias(f"_b{i}") for i, g in enumerate(groups)], F.col("windows").alias("_had"))
            sizes = sizes.join(old, [F.col(f"_{g}").eqNullSafe(F.col(f"_b{i}")) for i, g in enumerate(groups)]).select(*[f"_{g}" for g in groups], F.least("windows", F.ceil(F.col("_had") / 4).cast("int")).alias("windows"))
        sizes = store(sizes, "pack-windows")  # one small row per group
        top = sizes.agg(F.max("windows")).first()[0] or 0
        dealt = left.join(sizes, same(sizes)).withColumn("window", (F.pmod(F.xxhash64("record_id"), "windows") + first).cast("int"))
        # a number of partitions of its own: they are small in bytes, but not in work
        packed = dealt.select(*groups, "record_id", "tokens", "pieces", "piece", "capacity", "with_eos", "windows", "window").repartition(parts, *groups, "window").groupBy(*groups, "window").applyInPandas(fill_window, schema)
        if top <= 1:
            done.append(packed)
            break
        packed = store(packed, "packed")
        done.append(packed.filter("shard >= 0"))
        left = packed.filter("shard < 0").select(
            *groups, "record_id", (F.col("start") + F.col("length")).cast("int").alias("tokens"), "pieces", "piece", "capacity", F.col("eos").alias("with_eos"), (F.col("length") + F.col("eos")).alias("rest")
        )
        first, before = first + top, sizes
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def fill_report(packed: DataFrame, written: DataFrame, group_cols: tuple[str, ...] = ("build_id", "stage", "split")) -> DataFrame:
    """Per group: shards, tokens and share of room filled here, against the shards ``written`` before (repeated rows once, null sizes as 0)."""
    groups = list(group_cols)
    ours = (
        packed.filter("shard is not null").groupBy(*groups)
        .agg(F.count_distinct("window", "shard").alias("shards"), F.sum(F.col("length") + F.col("eos")).alias("tokens"), F.max("capacity").alias("capacity"))
        .withColumn("fill", F.col("tokens") / (F.col("shards") * F.col("capacity")))
    )
    theirs = written.select(*groups, "shard_index", "num_tokens").distinct().groupBy(*groups).agg(F.count_distinct("shard_index").alias("written_shards"), F.sum("num_tokens").alias("written_tokens"))
    return ours.join(theirs, groups, "full_outer")


def fill(packed: DataFrame, records: DataFrame, eos_id: int = 1, *, id_col: str = "record_id", ids_col: str = "ids", group_cols: tuple[str, ...] = ("build_id", "stage", "split")) -> DataFrame:
    """The shards themselves: group, window, shard and the token ids in order. One shuffle of the ids, by shard; a shard is bounded by its capacity."""
    groups = list(group_cols)
    ids = records.filter(F.col(ids_col).isNotNull()).select(F.col(id_col).cast("long").alias("record_id"), F.col(ids_col).alias("_ids")).dropDuplicates(["record_id"])
    piece = F.concat(F.slice("_ids", F.col("start").cast("int") + 1, F.col("length").cast("int")), F.array_repeat(F.lit(eos_id), F.col("eos")))
    return (
        packed.filter("shard is not null").join(ids, "record_id")
        .groupBy(*groups, "window", "shard")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", piece.alias("part")))), lambda x: x["part"])).alias("ids"))
    )
