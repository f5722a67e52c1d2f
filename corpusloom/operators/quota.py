"""Filling token quotas with whole documents, in order, with deduplication; and auditing what was filled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.windows import mark_ranges, prefix_sums, range_sums
from corpusloom.session import discard, store


def fill_quotas(records: DataFrame, quotas: DataFrame, order: list[str], *, item: str = "item_id", tokens: str = "tokens", digest: str = "content_sha256", holdout: str = "holdout", reason: str = "reason", parallel_rounds: int = 12, stretch: int = 100_000, filter_first: bool = False) -> DataFrame:
    """Take documents in order until each item's quota of tokens is reached, exact duplicates of accepted ones left out.

    ``records`` has the order columns (a total order over all items and stages, no two rows alike), item, tokens, content hash, ``holdout`` and the reason
    for which a row is rejected whatever was accepted before it (null if none). A row is accepted if it has no such reason, if the tokens of
    the accepted rows of its item before it, holdouts aside, are below the quota, and if no accepted row before it has its hash. The last document of
    an item may overshoot; holdouts pass while the item is open, and don't count.

    Whether a row is accepted depends on earlier rows only, so these conditions have exactly one solution. It is found for all items and
    sources at once, as the fixed point of testing every row against the last round's accepted rows; a round that changes nothing proves it.
    A round is an aggregation by hash and a prefix sum by item, neither of which needs an item or a group of copies to fit into a task. Rows before
    the first that changes are final. Where long chains of dependence leave changes after ``parallel_rounds`` rounds, the next ``stretch`` rows
    from that row on, sizes and hashes only, are gone through one by one, and rounds go on behind them; so it always ends.

    Returns the rows with ``accepted`` and ``disposition``: ``train``, ``holdout``, ``duplicate_exact``, the given reason, or ``over_quota`` for rows that
    come when their item is full (which are neither tested nor remembered). With ``filter_first`` rows are tested before their item is looked at, so that
    duplicates and rejected rows have their reasons in full items too; what is accepted is the same. Rows of items without a quota are an error.
    """
    planned = quotas.select(F.col(item).alias("_i"), F.col("token_quota").cast("long").alias("_quota"))
    # plan items are dimension rows
    missing = F.when(F.col("_quota").isNull(), F.raise_error(F.concat(F.lit("no quota for item "), F.coalesce(F.col("_item").cast("string"), F.lit("null")))).cast("long")).otherwise(F.col("_quota"))
    # only the order, sizes and hashes go through the rounds; the records themselves move once, at the end
    keys = [f"_k{i}" for i in range(len(order))]
    light = records.select(
        *[F.col(c).alias(k) for c, k in zip(order, keys)], F.col(item).alias("_item"), F.col(tokens).cast("long").alias("_t"), F.col(digest).alias("_d"), F.coalesce(F.col(holdout), F.lit(False)).alias("_h"), F.col(reason).alias("_reason")
    )
    light = light.join(planned, F.col("_item") == F.col("_i"), "left").withColumn("_quota", missing).drop("_i")
    light = prefix_sums(light, keys, {"_pos": F.lit(1)}).withColumns({"_ok": F.col("_reason").isNull(), "_acc": F.col("_reason").isNull(), "_open": F.lit(True), "_dup": F.lit(False)})
    state, last = mark_ranges(light, ["_pos"], ["_item"]), None
    rounds, frozen = 0, 0
    while True:
        rounds += 1
        counted = F.when(F.col("_acc") & ~F.col("_h"), F.col("_t")).otherwise(0)
        sums = range_sums(state, ["_pos"], {"_before": counted}, ["_item"])
        first = state.groupBy("_d").agg(F.min(F.when(F.col("_acc"), F.col("_pos"))).alias("_first"), F.count("*").alias("_n")).filter("_n > 1 and _first is not null").select(F.col("_d").alias("_known"), "_first")
        tested = sums.join(first, F.col("_d") == F.col("_known"), "left").withColumn("_o", F.col("_before") < F.col("_quota")).withColumn("_u", F.coalesce(F.col("_first") < F.col("_pos"), F.lit(False)))
        tested = tested.withColumn("_a", F.col("_ok") & F.col("_o") & ~F.col("_u"))
        if frozen:  # gone through one by one
            tested = tested.withColumns({n: F.when(F.col("_pos") < frozen, F.col(o)).otherwise(F.col(n)) for n, o in (("_a", "_acc"), ("_o", "_open"), ("_u", "_dup"))})
        changed = (F.col("_a") != F.col("_acc")) | (F.col("_o") != F.col("_open")) | (F.col("_u") != F.col("_dup"))
        new = store(tested.withColumn("_c", changed).drop("_acc", "_open", "_dup", "_before", "_known", "_first").withColumnsRenamed({"_a": "_acc", "_o": "_open", "_u": "_dup"}), "quota-round")
        discard(last)
        last, state = new, new.drop("_c")
        first_change = new.filter("_c").agg(F.min("_pos")).first()[0]
        if first_change is None:
            break
        if rounds >= parallel_rounds:
            rounds, frozen = 0, first_change + stretch
            settled = store(_one_by_one(state, first_change, frozen), "stretch")
            state = state.join(settled.withColumnsRenamed({c: f"_n{c}" for c in ("_acc", "_open", "_dup")}).withColumnRenamed("_pos", "_p"), F.col("_pos") == F.col("_p"), "left")
            state = state.withColumns({c: F.coalesce(f"_n{c}", c) for c in ("_acc", "_open", "_dup")}).drop("_p", "_n_acc", "_n_open", "_n_dup")
    full, tests = [(~F.col("_open"), F.lit("over_quota"))], [(~F.col("_ok"), F.col("_reason")), (F.col("_dup"), F.lit("duplicate_exact"))]
    if filter_first:
        tests.reverse()
    disposition = F
    for when, what in tests + full if filter_first else full + tests:
        disposition = disposition.when(when, what)
    disposition = disposition.when(F.col("_h"), "holdout").otherwise("train")
    settled = state.select(*keys, F.col("_acc").alias("accepted"), disposition.alias("disposition"))
    return records.join(settled, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(order, keys)]).drop(*keys)


def _one_by_one(state: DataFrame, start: int, end: int) -> DataFrame:
    """(_pos, _acc, _open, _dup) of the rows from ``start`` up to ``end``, in order; those before are settled. The rows are bounded in number, and narrow."""
    part = state.filter((F.col("_pos") >= start) & (F.col("_pos") < end))
    before = state.filter((F.col("_pos") < start) & F.col("_acc"))
    used = {r["_item"]: r["t"] for r in before.filter("not _h").groupBy("_item").agg(F.sum("_t").alias("t")).collect()}  # a row per plan item
    seen = {r["_d"] for r in before.select("_d").join(part.select("_d").distinct(), "_d", "left_semi").distinct().collect()}
    out = []
    for r in part.select("_pos", "_item", "_t", "_d", "_h", "_ok", "_quota").orderBy("_pos").collect():
        opened, again = used.get(r["_item"], 0) < r["_quota"], r["_d"] is not None and r["_d"] in seen
        taken = r["_ok"] and opened and not again
        if taken:
            seen.add(r["_d"])
            if not r["_h"]:
                used[r["_item"]] = used.get(r["_item"], 0) + r["_t"]
        out.append((r["_pos"], taken, opened, again))
    return state.sparkSession.createDataFrame(out, "_pos long, _acc boolean, _open boolean, _dup boolean")


def item_statistics(filled: DataFrame, quotas: DataFrame, *, item: str = "item_id", tokens: str = "tokens") -> DataFrame:
    """Per plan item: requested and accepted tokens, documents and holdouts; items without rows have zeros."""
    mine = (F.col("disposition") == "train").cast("long")
    got = filled.groupBy(F.col(item).alias("_i")).agg(F.sum(mine * F.col(tokens)).alias("quota_tokens"), F.sum(mine).alias("documents"), F.sum((F.col("disposition") == "holdout").cast("long")).alias("holdout_documents"))
    out = quotas.select(item, F.col("token_quota").alias("requested_tokens")).join(got, F.col(item) == F.col("_i"), "left").drop("_i")
    return out.fillna(0, ["quota_tokens", "documents", "holdout_documents"])


def require_filled(statistics: DataFrame, item: str = "item_id") -> None:
    """Raise for items whose source was exhausted before the quota. Plan items are few."""
    short = statistics.filter("quota_tokens < requested_tokens").orderBy(item).collect()
    if short:
        raise ValueError("exhausted before quota: " + ", ".join(f"{r[item]}={r.quota_tokens}/{r.requested_tokens}" for r in short))


def audit_quotas(counted: DataFrame, quotas: DataFrame, tolerance: float, order: list[str], *, stage: str = "stage", item: str = "item_id", tokens: str = "tokens", canonical: bool = False) -> DataFrame:
    """Counted against planned tokens, one row per item and one per stage (item null).

    An item passes within the tolerance, or if its last document crosses the quota (``boundary_limited``); in canonical mode it must also
    reach the quota with that last document. A stage passes within the tolerance if all its items pass. Rows of unplanned items are an error.
    """
    if not 0 <= tolerance < 1:
        raise ValueError("the tolerance must be in [0, 1)")
    last = F.max_by(F.col(tokens), F.struct(*order))
    got = counted.groupBy(F.col(stage).alias("_s"), F.col(item).alias("_i")).agg(F.sum(tokens).alias("actual_tokens"), last.alias("last_document_tokens"))
    on = (F.col(stage) == F.col("_s")) & (F.col(item) == F.col("_i"))
    planned = quotas.select(stage, item, F.col("token_quota").cast("long").alias("planned_tokens"))
    items = planned.join(got, on, "full_outer")
    unplanned = F.when(F.col("planned_tokens").isNull(), F.raise_error(F.concat_ws("/", F.lit("unplanned item"), F.col("_s"), F.col("_i"))).cast("long")).otherwise(F.col("planned_tokens"))
    items = items.withColumn("planned_tokens", unplanned).drop("_s", "_i").fillna(0, ["actual_tokens", "last_document_tokens"])
    before = F.col("actual_tokens") - F.col("last_document_tokens")
    items = items.withColumn("relative_variance", F.abs(F.col("actual_tokens") - F.col("planned_tokens")) / F.col("planned_tokens"))
    items = items.withColumn("boundary_limited", (F.col("actual_tokens") > F.col("planned_tokens")) & (before < F.col("planned_tokens")))
    passed = (F.col("relative_variance") <= tolerance) | F.col("boundary_limited")
    if canonical:
        passed = passed & (F.col("actual_tokens") >= F.col("planned_tokens")) & (F.col("last_document_tokens") > 0) & (before < F.col("planned_tokens"))
    items = items.withColumn("overshoot_tokens", F.greatest(F.lit(0), F.col("actual_tokens") - F.col("planned_tokens"))).withColumn("passed", passed)
    columns = [stage, item, "planned_tokens", "actual_tokens", "relative_variance", "last_document_tokens", "boundary_limited", "overshoot_tokens", "passed"]
    stages = items.groupBy(stage).agg(F.sum("planned_tokens").alias("planned_tokens"), F.sum("actual_tokens").alias("actual_tokens"), F.bool_and("passed").alias("_all"))
    stages = stages.withColumn("relative_variance", F.abs(F.col("actual_tokens") - F.col("planned_tokens")) / F.col("planned_tokens"))
    stages = stages.select(
        stage, F.lit(None).cast("string").alias(item), "planned_tokens", "actual_tokens", "relative_variance", F.lit(None).cast("long").alias("last_document_tokens"),
        F.lit(None).cast("boolean").alias("boundary_limited"), F.greatest(F.lit(0), F.col("actual_tokens") - F.col("planned_tokens")).alias("overshoot_tokens"), (F.col("_all") & (F.col("relative_variance") <= tolerance)).alias("passed"),
    )
    return items.select(*columns).unionByName(stages)


def largest_remainder(weights: DataFrame, total: int, *, item: str = "item_id", weight: str = "weight", group: list[str] | None = None) -> DataFrame:
    """Adds ``token_quota``: shares of a total by weight, rounded down, the rest to the largest fractions, ties by item. As SQL, for dimension tables; the driver's
    planner uses exact decimals."""
    group = group or []
    over = Window.partitionBy(*group)
    exact = F.lit(total).cast("decimal(20,0)") * F.col(weight).cast("decimal(18,6)") / F.sum(F.col(weight).cast("decimal(18,6)")).over(over)
    out = weights.withColumn("_x", exact).withColumn("_f", F.floor("_x").cast("long"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy((F.col("_x") - F.col("_f")).desc(), F.col(item)))
    out = out.withColumn("_r", rank).withColumn("_left", F.lit(total) - F.sum("_f").over(over))
    return out.withColumn("token_quota", F.col("_f") + (F.col("_r") <= F.col("_left")).cast("long")).drop("_x", "_f", "_r", "_left")
