"""Mixing sources to target weights: whole copies first, then Pareto order sampling for the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from corpusloom.llm import kernels as K
from corpusloom.session import store


def token_sizes(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), rank_file: str = K.RANK_FILE) -> DataFrame:
    """(id, *keep, tokens) of every document, whole texts under the public tokenizer; a null text has 0 tokens."""
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = K.tokenizer(rank_file)
        for batch in batches:
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(sizes, pa.int64())], ["id", *keep, "tokens"])

    schema = "".join([f"id {kinds[id_col]}", *[f", {c} {kinds[c]}" for c in keep], ", tokens long"])
    return documents.select(F.col(id_col).alias("id"), text_col, *keep).mapInArrow(run, schema)


def inclusion_scale(sizes: np.ndarray, weights: np.ndarray, counts: np.ndarray, share: float) -> float:
    """The c for which inclusion probabilities min(1, c * weight) take ``share`` of all tokens, given classes of documents
    with their tokens, mean weight and number."""
    goal, lo, hi = share * sizes.sum(), 0.0, 1.0
    while (sizes * np.minimum(1, hi * weights)).sum() < goal and hi < 1e18:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (sizes * np.minimum(1, mid * weights)).sum() < goal else (lo, mid)
    return hi


def mix_sources(
    sizes: DataFrame,
    targets: DataFrame,
    *,
    size_power: float = 0.5,
    seed: int = 42,
    bins: int = 4096,
) -> tuple[DataFrame, DataFrame]:
    """Select documents so that every source has its share of every stage's tokens.

    ``sizes`` has (id, source, tokens), one row per document; ``targets`` (stage, source_id, weight, max_repeats, stage_multiple). A source
    needs weight * stage_multiple * all tokens. It gives whole copies of all its documents as often as they fit, at most
    ``max_repeats`` times; the rest, a part of one copy, is a Pareto order sample: document i gets the inclusion probability
    p_i = min(1, c * tokens_i ^ size_power), c chosen to meet the rest, and the documents with the smallest
    (u/(1-u)) / (p_i/(1-p_i)) are taken until the rest is reached, u being a hash of seed, stage and document. Taking ends with
    the document that comes closest. The order of a source is cut by prefix sums over ``bins`` ranges of ranks, and row by
    row only within the one range that holds the cut, so no task holds a source.

    Returns (selection, report). Selection: ``stage, source_id, id, tokens, copies`` of documents used at least once. Report: one
    row per target with ``target_tokens, available_tokens, reached_tokens, target_share, reached_share, max_repeats, whole_copies``
    and ``reachable`` (all its tokens times max_repeats are enough).

    Null sources and documents without tokens take part in the total only. A source without documents reaches nothing.
    Null or negative weights, repeats or multiples count as 0. Repeated targets count once. Ties of ranks go by id. Empty tables: no
    selection, and a report of zeros for the targets there are.
    """
    spark = sizes.sparkSession
    sizes = store(sizes.select("id", "source", F.coalesce(F.col("tokens"), F.lit(0)).cast("long").alias("tokens")), "sizes")
    weight = F.pow(F.col("tokens").cast("double"), F.lit(size_power))
    grain = F.floor(F.log2(F.col("tokens").cast("double")) * 8).cast("int")
    # a few hundred classes of size per source, however many documents there are
    shape = sizes.groupBy("source", F.when(F.col("tokens") > 0, grain).alias("g")).agg(F.sum("tokens").alias("t"), F.avg(weight).alias("w"), F.count("*").alias("n")).collect()
    total = sum(r.t for r in shape)
    by: dict[str, list] = {}
    for r in shape:
        if r.source is not None and r.t:
            by.setdefault(r.source, []).append(r)
    plan = []
    nil = lambda x: max(0, x or 0)
    for r in targets.select("stage", "source_id", "weight", "max_repeats", "stage_multiple").distinct().collect():
        target, repeats = nil(r.weight) * nil(r.stage_multiple) * total, nil(r.max_repeats)
        own = by.get(r.source_id, [])
        have = sum(x.t for x in own)
        whole = min(repeats, int(target // have)) if have else 0
        rest = min(target - whole * have, have) if whole < repeats and have else 0.0
        c = inclusion_scale(np.array([x.t for x in own], float), np.array([x.w for x in own]), np.array([x.n for x in own]), rest / have) if rest > 0 else 0.0
        plan.append((r.stage, r.source_id, float(target), int(have), int(repeats), int(whole), float(rest), float(c), bool(have * repeats >= target)))
    schema = "stage string, source_id string, target_tokens double, available_tokens long, max_repeats int, whole_copies int, rest double, scale double, reachable boolean"
    plan = spark.createDataFrame(plan, schema)  # as many rows as targets

    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "stage", "id"), 11) + 0.5) / float(1 << 53)
    p = F.least(F.lit(1.0), F.col("scale") * weight)
    odds = (u / (1 - u)) / (p / (1 - p))
    rank = F.when(F.col("scale") <= 0, F.lit(None)).when(p >= 1, F.lit(0.0)).otherwise(odds / (1 + odds))  # monotone in the odds, within [0, 1]
    ranked = sizes.filter("tokens > 0").join(F.broadcast(plan), F.col("source") == F.col("source_id")).select("stage", "source_id", "id", "tokens", "whole_copies", "rest", rank.alias("rank"))
    ranked = ranked.withColumn("bin", F.least(F.lit(bins - 1), F.floor(F.col("rank") * bins)).cast("int"))
    key = Window.partitionBy("stage", "source_id")
    sums = ranked.filter("rank is not null").groupBy("stage", "source_id", "bin").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
    before = F.coalesce(F.sum("t").over(key.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cutting = store(
        sums.withColumn("before", before).filter("before < rest and before + t >= rest").select("stage", "source_id", F.col("bin").alias("cut_bin"), F.col("before").alias("cut_before")),
        "mix-cuts",
    )
    # one row per target: broadcast like the plan
    ranked = ranked.join(F.broadcast(cutting), ["stage", "source_id"], "left")
    inside = ranked.filter("bin = cut_bin")
    running = F.col("cut_before") + F.sum("tokens").over(key.orderBy("rank", "id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens") / 2
    inside = inside.withColumn("taken", (running <= F.col("rest")).cast("int"))
    outside = ranked.filter("cut_bin is null or bin is null or bin <> cut_bin").withColumn("taken", F.coalesce((F.col("bin") < F.col("cut_bin")).cast("int"), F.when(F.col("rank").isNotNull(), 1).otherwise(0)))
    selection = (
        outside.unionByName(inside)
        .select("stage", "source_id", "id", "tokens", (F.col("whole_copies") + F.col("taken")).alias("copies"))
        .filter("copies > 0")
    )
    reached = selection.groupBy("stage", "source_id").agg(F.sum(F.col("tokens") * F.col("copies")).alias("reached_tokens"))
    report = (
        plan.join(reached, ["stage", "source_id"], "left")
        .withColumn("reached_tokens", F.coalesce("reached_tokens", F.lit(0)))
        .withColumn("target_share", F.col("target_tokens") / F.nullif(F.sum("target_tokens").over(Window.partitionBy("stage")), F.lit(0.0)))
        .withColumn("reached_share", F.col("reached_tokens") / F.nullif(F.sum("reached_tokens").over(Window.partitionBy("stage")), F.lit(0)))
        .select("stage", "source_id", "target_tokens", "available_tokens", "reached_tokens", "target_share", "reached_share", "max_repeats", "whole_copies", "reachable")
    )
    return selection, report
