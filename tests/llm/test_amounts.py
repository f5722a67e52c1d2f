"""Packing into shards and mixing of sources."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing, packing


def best_sum(lengths, capacity):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= capacity}
    return max(sums)


def test_subset_is_the_fullest():
    rng = random.Random(4)
    for _ in range(300):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 14))]
        capacity = max(lengths) + rng.randint(0, 80)
        chosen = packing.fullest_subset(Counter(lengths), capacity)
        assert not Counter(chosen) - Counter(lengths) and max(chosen) == max(lengths)
        rest = Counter(lengths)
        rest[max(lengths)] -= 1
        assert sum(chosen) == max(lengths) + best_sum(rest.elements(), capacity - max(lengths))


def test_packing_places_every_length_once():
    rng = random.Random(1)
    lengths = [rng.randint(0, 100) for _ in range(500)]
    bins = packing.pack_lengths(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert all(sum(lengths[i] for i in b) <= 100 for b in bins)
    assert len(bins) <= sum(lengths) / 100 * 1.02 + 1
    assert packing.pack_lengths([], 5) == [] and packing.pack_lengths([0, 0], 5) == [[0, 1]]


LAYOUTS = [("main", "train", 10, True, 1, "uint16"), ("main", "validation", 10, False, 1, "uint16"), ("main", "broken", 0, True, 1, "uint16")]


def layouts(spark):
    return spark.createDataFrame(LAYOUTS, "stage string, split string, shard_size_tokens long, append_eos boolean, eos_id int, dtype string")


def records(spark, rows):
    return spark.createDataFrame([(*r, "t") for r in rows], "record_id long, build_id string, stage string, split string, ids array<int>, shard string")


@pytest.mark.parametrize("window", [4000, 7])
def test_pack_round_trip(spark, window):
    rng = random.Random(9)
    rows = [(i, "b", "main", rng.choice(["train", "train", "validation"]), [2 + i] * rng.choice([0, 1, 3, 4, 9, 10, 11, 20, 35])) for i in range(120)]
    rows += [(500, "b", "main", "train", None), (501, "b", "main", "broken", [1]), (502, "b", "none", "train", [1, 2]), (503, None, "main", "train", [7] * 4)]
    df = records(spark, rows + rows[:9])
    out = packing.pack(df, layouts(spark), window_pieces=window, window_shards=3).collect()
    assert {r.record_id for r in out if r.shard is None} == {501, 502} and 500 not in {r.record_id for r in out}
    assert any(r.build_id is None and r.record_id == 503 and r.shard is not None for r in out)
    by = Counter()
    for r in out:
        if r.shard is not None:
            by[r.build_id, r.stage, r.split, r.window, r.shard] += r.length + r.eos
            assert r.length + r.eos <= 10
    assert max(by.values()) <= 10
    for i, _, _, split, ids in rows[:120]:
        mine = sorted((r for r in out if r.record_id == i), key=lambda r: r.piece)
        assert sum(r.length for r in mine) == len(ids) and [r.piece for r in mine] == list(range(mine[0].pieces))
        at = 0
        for r in mine:
            assert r.start == at
            at += r.length
        assert (len(mine) > 1) == (len(ids) + (split == "train") > 10)
        assert sum(r.eos for r in mine) == (split == "train") and all(r.eos == 0 for r in mine[:-1])
    packed = packing.pack(df, layouts(spark), window_pieces=window, window_shards=3)
    shards = packing.fill(packed, df).collect()
    tokens = Counter(t for s in shards for t in s.ids)
    want = Counter(t for r in rows if r[4] and r[0] not in (501, 502) for t in r[4])
    want[1] += sum(1 for r in rows if r[4] is not None and r[3] == "train" and r[0] != 502)
    assert tokens == want and all(len(s.ids) <= 10 for s in shards)


@pytest.mark.parametrize("capacity, count, top", [(256, 6000, 250), (50_000, 6000, 2500), (1_000_000, 6000, 2500), (50_000_000, 180_000, 2500)])
def test_shards_are_full_at_any_capacity(spark, capacity, count, top):
    rule = spark.createDataFrame([("m", "train", capacity, True)], "stage string, split string, shard_size_tokens long, append_eos boolean")
    df = spark.range(count).select(F.col("id").alias("record_id"), F.lit("b").alias("build_id"), F.lit("m").alias("stage"), F.lit("train").alias("split"), F.array_repeat(F.lit(7), (F.pmod(F.xxhash64("id"), F.lit(top - top // 50)) + top // 50).cast("int")).alias("ids"))
    packed = packing.pack(df, rule, window_pieces=1000, window_shards=64, most_pieces=50_000)
    by = packed.groupBy("window", "shard").agg(F.sum(F.col("length") + F.col("eos")).alias("t")).collect()
    assert sum(r.t for r in by) == df.agg(F.sum(F.size("ids") + 1)).first()[0] and max(r.t for r in by) <= capacity
    least = -(-sum(r.t for r in by) // capacity)
    assert len(by) <= max(least / 0.98, least + 1)
    assert packed.select("record_id").distinct().count() == count


def test_large_capacities_take_bounded_sums():
    counts = Counter(random.Random(3).choices(range(50, 2500), k=60_000))
    chosen = packing.fullest_subset(counts, 50_000_000)
    assert sum(chosen) == 50_000_000 and not Counter(chosen) - counts


def test_fill_report(spark):
    df = records(spark, [(i, "b", "main", "validation", [1] * (6 if i % 2 else 4)) for i in range(20)])
    written = spark.createDataFrame([("b", "main", "validation", i, 10 if i else None) for i in range(10)] * 2, "build_id string, stage string, split string, shard_index int, num_tokens long")
    r = packing.fill_report(packing.pack(df, layouts(spark)), written).first()
    assert (r.shards, r.tokens, r.fill, r.written_shards, r.written_tokens) == (10, 100, 1.0, 10, 90)
    assert packing.pack(df.limit(0), layouts(spark)).count() == 0


def targets(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "stage string, source_id string, weight double, max_repeats int, stage_multiple double, tokens string")


def test_mix_reaches_its_shares(spark):
    rng = np.random.default_rng(0)
    rows = [(i, ["a", "b", "c", "d"][min(3, i // 2000)], int(n)) for i, n in enumerate(rng.lognormal(5, 1, 8000))] + [(9001, None, 500), (9002, "a", 0), (9003, "a", None)]
    sizes = spark.createDataFrame(rows, "id long, source string, tokens long")
    total = sum(n or 0 for *_, n in rows)
    have = {s: sum(n for _, x, n in rows if x == s and n) for s in "abcd"}
    t = [("m", "a", 0.1, 3, 1.0), ("m", "b", 0.6, 5, 1.0), ("m", "c", 0.9, 1, 1.0), ("m", "none", 0.1, 2, 1.0), ("m", "d", 0.0, 2, 1.0), ("n", "a", None, 2, 1.0)]
    for power in (0.0, 0.5, 1.0):
        selection, report = mixing.mix_sources(sizes, targets(spark, t + t[:1]), size_power=power)
        got = {(r.stage, r.source_id): r for r in report.collect()}
        assert len(got) == 6
        assert got["m", "a"].reached_tokens == pytest.approx(0.1 * total, rel=0.02) and got["m", "a"].whole_copies == 0
        assert got["m", "b"].reached_tokens == pytest.approx(0.6 * total, rel=0.01) and got["m", "b"].reachable
        assert got["m", "c"].reached_tokens == have["c"] and not got["m", "c"].reachable
        assert got["m", "none"].reached_tokens == 0 and not got["m", "none"].reachable
        assert got["m", "d"].reached_tokens == 0 and got["n", "a"].reached_tokens == 0 and got["n", "a"].reachable
        picked = selection.collect()
        assert len({(r.stage, r.source_id, r.id) for r in picked}) == len(picked)
        repeats = {x[1]: x[3] for x in t}
        assert all(1 <= r.copies <= repeats[r.source_id] for r in picked)
        assert {r.copies for r in picked if r.source_id == "b"} == {got["m", "b"].whole_copies, got["m", "b"].whole_copies + 1} - {0}
        assert sorted(map(tuple, picked)) == sorted(map(tuple, mixing.mix_sources(sizes.repartition(3), targets(spark, t), size_power=power)[0].collect()))


def test_inclusion_follows_the_odds(spark):
    """Over many seeds a document is taken about as often as its inclusion probability says."""
    n = 60
    sizes = spark.createDataFrame([(i, "a", 100 if i % 2 else 400) for i in range(n)], "id long, source string, tokens long")
    total = n * 250
    taken = Counter()
    for seed in range(12):
        selection, _ = mixing.mix_sources(sizes, targets(spark, [("m", "a", 0.4, 1, 1.0)]), size_power=1.0, seed=seed, bins=64)
        taken.update(r.tokens for r in selection.collect())
    small, large = taken[100] / (12 * n / 2), taken[400] / (12 * n / 2)
    assert 2.5 < large / small < 6 and abs(small * 100 + large * 400 - 0.4 * 500) < 25 and total == 15000


def test_scale_meets_the_share():
    sizes, weights = np.array([100.0, 300.0, 600.0]), np.array([1.0, 2.0, 8.0])
    for share in (0.05, 0.5, 0.95):
        c = mixing.inclusion_scale(sizes, weights, np.ones(3), share)
        assert (sizes * np.minimum(1, c * weights)).sum() == pytest.approx(share * 1000, rel=1e-6)


def test_token_sizes(spark):
    df = spark.createDataFrame([(1, None, "a", 9), (2, "", "a", 9), (3, "Hello world", None, 9), (3, "Hello world", None, 9)], "doc_id long, text string, source string, id int")
    assert sorted(r.tokens for r in mixing.token_sizes(df, keep=("source",)).collect()) == [0, 0, 2, 2]
    s, r = mixing.mix_sources(mixing.token_sizes(df.limit(0), keep=("source",)), targets(spark, [("m", "a", 0.5, 2, 1.0)]))
    assert s.count() == 0 and r.select("available_tokens", "reached_tokens").first() == (0, 0)
    assert mixing.mix_sources(mixing.token_sizes(df, keep=("source",)), targets(spark, []).filter(F.lit(False)))[1].count() == 0
