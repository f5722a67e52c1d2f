"""Whole builds as compositions of operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.hashing import EXCLUSIVE, hash_fraction, hash_split, json_sha256
from corpusloom.functions.repetition import measure_repetition, summarize_generations
from corpusloom.functions.scalars import item_id
from corpusloom.operators.aggregates import breakdowns, disposition_counts, license_counts, overlap, stage_measures
from corpusloom.operators.evaluation import conversion_counts, convert_benchmark, loss_summary, paired_losses, unequal_seeds
from corpusloom.operators.filters import QualityPolicy, contains_any, rejection_reasons
from corpusloom.operators.quota import audit_quotas, fill_quotas, item_statistics, require_filled
from corpusloom.operators.records import Source, simple_records, source_records
from corpusloom.operators.tokens import encode, fertility, round_trip_failures, tokenizer_metrics, train_bpe
from corpusloom.operators.windows import shuffled_windows
from corpusloom.plans.mixture import plan_items
from corpusloom.session import store
from corpusloom.sources.readers import Loader, with_row_index
from corpusloom.sources.sinks import publish, split_metadata, write_shards


def judged(records: DataFrame, policy: QualityPolicy, patterns: list[str], *, position: str, matcher: Callable[[DataFrame, str, list[str]], DataFrame] = contains_any) -> DataFrame:
    """Records with ``contaminated`` and ``reason``. Patterns are looked for in rows of an accepted length only, by ``matcher`` if one is given: a function of
    (records, text column, patterns) that adds the boolean ``contaminated``. Normalization and matching run once; the duplicates are found on what is stored."""
    if not policy.enabled:
        return records.withColumn("contaminated", F.lit(False)).withColumn("reason", F.lit(None).cast("string"))
    right = F.col("num_chars") >= policy.min_chars
    if policy.max_chars is not None:
        right = right & (F.col("num_chars") <= policy.max_chars)
    found = matcher(records.withColumn("_probe", F.when(right, F.col("text"))), "_probe", patterns).drop("_probe")
    return rejection_reasons(store(found, "judged") if policy.exact_dedup else found, policy, position=position)


def single_dataset(rows: DataFrame, dataset: str, split: str, policy: QualityPolicy, patterns: list[str] | None = None, *, text: str = "text", index: str = "row_index", source_id: str | None = None, validation_fraction: float = 0.0, already_nfkc: bool = False) -> DataFrame:
    """Raw rows of one dataset as records with their reason and, for accepted ones, their split by content hash (in ``id`` too)."""
    records = judged(simple_records(rows, dataset, split, text=text, index=index, source_id=source_id, already_nfkc=already_nfkc), policy, patterns or [], position=index)
    to = F.when(F.col("reason").isNull(), hash_split(F.col("text_sha256"), validation_fraction)) if validation_fraction > 0 else F.when(F.col("reason").isNull(), F.col("split"))
    moved = F.col("_to").isNotNull() & (F.col("_to") != F.col("split"))
    renamed = F.when(moved, F.replace("id", F.concat(F.lit("/"), F.col("split"), F.lit("/")), F.concat(F.lit("/"), F.col("_to"), F.lit("/")))).otherwise(F.col("id"))
    return records.withColumn("_to", to).withColumn("id", renamed).withColumn("split", F.coalesce("_to", "split")).drop("_to", "contaminated")


def build_corpus(spark: SparkSession, sources: Mapping[str, Source], plans: list[Mapping[str, Any]], loader: Loader, policy: QualityPolicy, patterns: list[str] | None = None, *, row_order: list[str], tokenizer: str | None = None, strict: bool = True, already_nfkc: bool = False) -> tuple[DataFrame, DataFrame]:
    """Corpora of all stages from sources and plans: records in shuffled count windows, filtered, deduplicated over all sources and stages in their order, to exact quotas, held-out documents apart.

    Tokens are counted by the tokenizer if one is given (exactly, on rows that pass the filter), else estimated. ``row_order`` gives raw rows their order. Returns (records with ``disposition`` and ``split``, statistics per item). With
    ``strict`` a source that is exhausted before its quota is an error.
    """
    parts = []
    for place, plan in enumerate(plans):
        for source_id in sorted({i["source_id"] for i in plan["items"]}):
            rows = with_row_index(loader(spark, sources[source_id]), row_order)
            records = source_records(rows, sources[source_id], plan["stage"], already_nfkc=already_nfkc)
            blank = records.filter("reason is not null")
            windows = shuffled_windows(records.filter("reason is null"), int(plan["buffer_size"]), int(plan["seed"]))
            held = hash_fraction(F.col("content_sha256"), EXCLUSIVE) < float(plan.get("validation_fraction", 0.0))
            windows = windows.withColumn("holdout", held).withColumn("_stage_at", F.lit(place))
            parts.append(windows.unionByName(blank.withColumn("_stage_at", F.lit(place)), allowMissingColumns=True))
    records = parts[0]
    for p in parts[1:]:
        records = records.unionByName(p)
    order = ["_stage_at", "source_id", "window", "order_key", "row_index"]
    blank, records = records.filter("reason is not null"), records.filter("reason is null").drop("reason")
    records = records.withColumn("item_id", item_id(F.col("source_id"), F.col("bucket_id")))
    records = judged(records.withColumn("_at", F.struct(*order)), QualityPolicy(policy.enabled, policy.min_chars, policy.max_chars, exact_dedup=False), patterns or [], position="_at").drop("contaminated", "_at")
    if tokenizer:
        records = encode(records.withColumn("_t", F.when(F.col("reason").isNull(), F.col("text"))), tokenizer, "_t", "_ids").withColumn("tokens", F.size("_ids").cast("long")).drop("_t", "_ids")
    else:
        records = records.withColumn("tokens", F.col("estimated_tokens"))
    items = plan_items(spark, plans)
    records = store(records.withColumn("plan_item", F.concat_ws(":", "stage", "item_id")), "records")
    quotas = items.withColumn("plan_item", F.concat_ws(":", "stage", "item_id"))
    # without deduplication every row is its own hash
    digest = F.col("content_sha256") if policy.enabled and policy.exact_dedup else F.concat_ws(":", *[F.col(c).cast("string") for c in order])
    filled = fill_quotas(records.withColumn("_digest", digest), quotas, order, item="plan_item", digest="_digest").drop("_digest")
    statistics = item_statistics(filled, quotas, item="plan_item")
    if strict:
        require_filled(statistics, "plan_item")
    out = filled.withColumn("source_split", F.col("split")).withColumn("split", F.when(F.col("disposition") == "holdout", "validation").otherwise(F.col("split")))
    rejected = blank.withColumn("disposition", F.col("reason")).withColumn("accepted", F.lit(False))
    return out.drop("_stage_at").unionByName(rejected.drop("_stage_at"), allowMissingColumns=True), statistics


def corpus_breakdowns(corpus: DataFrame) -> DataFrame:
    """Nine figures of a corpus by stage, role, item, source and bucket in one scan."""
    kept = corpus.filter("accepted").withColumn("bytes", F.octet_length("text").cast("long"))
    sets = [["stage"], ["stage", "role"], ["stage", "item_id"], ["stage", "source_id"], ["stage", "source_id", "bucket_id"]]
    return breakdowns(kept, sets, stage_measures())


def corpus_audit(corpus: DataFrame, plans_items: DataFrame, tolerance: float, canonical: bool = True) -> DataFrame:
    """Quota audit of a built corpus; see :func:`audit_quotas`."""
    fit = corpus.filter("disposition = 'train'")
    return audit_quotas(fit, plans_items, tolerance, ["source_id", "window", "order_key", "row_index"], canonical=canonical)


def evaluate_tokenizer(texts: DataFrame, tokenizer: str, by: list[str], probes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Metrics over all and by each dimension, texts that don't come back, and the probes' fertility."""
    out = {"metrics": tokenizer_metrics(encode(texts, tokenizer), by), "round_trip_failures": round_trip_failures(texts, tokenizer)}
    return out | ({"probes": fertility(probes, tokenizer)} if probes is not None else {})


def train_and_measure(texts: DataFrame, vocabulary: int, by: list[str] | None = None) -> tuple[str, DataFrame]:
    """A tokenizer trained on the texts, and its metrics on them."""
    made = train_bpe(texts, vocabulary=vocabulary)
    return made, tokenizer_metrics(encode(texts, made), by)


def tokenize_splits(records: DataFrame, tokenizer: str, path: str, order: list[str], *, split: str = "split", shard_size: int = 50_000_000, eos_id: int = 1, dtype: str = "uint16", replace: bool = False) -> dict[str, dict[str, Any]]:
    """Encode the texts of every split and write its token shards under ``path``; returns the metadata of each split. Splits are few."""
    import hashlib

    spark = records.sparkSession
    text = tokenizer if tokenizer.lstrip().startswith("{") else open(tokenizer, encoding="utf-8").read()
    encoded = store(encode(records.select(*order, split, "text"), tokenizer).drop("text"), "encoded")
    write_shards(encoded, path, order, shard_size, eos_id=eos_id, dtype=dtype, group=[split], replace=replace)
    counts = {r[split]: r["count"] for r in encoded.groupBy(split).count().collect()}
    meta = spark.read.parquet(f"{path}/metadata")
    digest = hashlib.sha256(text.encode()).hexdigest()
    return {s: split_metadata(meta.filter(F.col(split) == s), documents=n, tokenizer_sha256=digest, dtype=dtype, shard_size=shard_size, split=s) for s, n in sorted(counts.items())}


def prepare_benchmark(rows: DataFrame, path: str, dataset: str, config: str, *, index: str = "row_index", replace: bool = False) -> DataFrame:
    """Write the usable items of a benchmark and, beside them, the skipped rows with their reasons; returns the counts."""
    items = store(convert_benchmark(rows, dataset, config, index), "items")

    def write(p: str) -> None:
        items.filter("problem is null").drop("problem").write.json(f"{p}/items")
        items.filter("problem is not null").select("source_index", "config", "problem").write.json(f"{p}/skipped")

    publish(rows.sparkSession, path, write, replace=replace)
    return conversion_counts(items)


def comparison_report(losses: DataFrame, generations: DataFrame, predicted: DataFrame | None = None, *, label: str = "checkpoint_label") -> dict[str, DataFrame]:
    """What is compared between checkpoints: losses, each two paired by seed, repetition of generations, and accuracy on choices. Unequal seeds are an error."""
    odd = unequal_seeds(losses.withColumnRenamed(label, "label")).limit(1).collect()
    if odd:
        raise ValueError(f"not every checkpoint has the seed {odd[0]['seed']} once")
    out = {"losses": loss_summary(losses, label=label), "pairs": paired_losses(losses, label=label), "generations": summarize_generations(measure_repetition(generations), [label])}
    if predicted is not None:
        out["accuracy"] = predicted.groupBy(label, "category").agg(F.count("*").alias("total"), F.count_if("correct").alias("correct"))
    return out


def finalize(corpus: DataFrame, items: DataFrame, tolerance: float) -> dict[str, Any]:
    """The evidence of a finished build with its own hash: quota, licence, quality and overlap audits, and whether all passed. Every part is a small table."""
    rows = lambda df: [r.asDict(True) for r in df.collect()]
    quota = rows(corpus_audit(corpus, items, tolerance))
    kept = corpus.filter("accepted")
    shared = overlap(kept.filter("split = 'validation'"), kept.filter("split <> 'validation'"), "content_sha256").count()
    counts = rows(disposition_counts(corpus))[0]
    balanced = counts["read"] == counts["accepted"] + counts["held_out"] + counts["over_quota"] + counts["rejected"]
    body = {"quota": quota, "licenses": rows(license_counts(kept)), "quality": rows(corpus.groupBy("disposition").count()), "counts": counts, "overlap": shared}
    body["passed"] = bool(all(r["passed"] for r in quota) and shared == 0 and balanced)
    return body | {"audit_sha256": json_sha256(body)}
