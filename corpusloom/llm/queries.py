"""The queries of the training-data problems, over whole tables, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import budget, forest, leaks, mixing, overlap, packing, quality, splitting


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported totals that are more than 2.5 times off the tokens of the texts accepted."""
    estimates, _ = budget.estimate_tokens(_t(spark, sf_dir, "documents"))
    r = budget.quota_check(estimates, _t(spark, sf_dir, "unit_commits"), _t(spark, sf_dir, "build_progress"))
    off = (F.col("accepted_quota_tokens") > 2.5 * F.col("est_tokens")) | (F.col("accepted_quota_tokens") < F.col("est_tokens") / 2.5)
    return r.filter(off).select("build_id", "stage", "source_id")


def p1_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, bytes and estimated tokens by source, role, language and collection, with the totals reported."""
    estimates, _ = budget.estimate_tokens(_t(spark, sf_dir, "documents"), keep=("source", "collection"))
    return budget.budget_totals(estimates, _t(spark, sf_dir, "source_specs"), _t(spark, sf_dir, "build_progress"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are for the most part no natural-language sentences."""
    return quality.text_quality(_t(spark, sf_dir, "documents")).filter("structure <> 'prose'").select("doc_id")


def p2_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of every document, beside the characters its record claims (the largest of repeated records)."""
    claimed = _t(spark, sf_dir, "normalized_records").groupBy("doc_id").agg(F.max("num_chars").alias("num_chars"))
    return quality.text_quality(_t(spark, sf_dir, "documents")).join(claimed, "doc_id", "left")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming records that repeat something accepted before."""
    marked = forest.mark_incoming(_t(spark, sf_dir, "incoming_records"), _t(spark, sf_dir, "documents"), _t(spark, sf_dir, "unit_commits"))
    return marked.filter("reason is not null").select("incoming_id")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_t(spark, sf_dir, "encoded_records"), _t(spark, sf_dir, "shard_layouts"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded records that were placed in more than one piece, since no shard of theirs can hold them."""
    return _packed(spark, sf_dir).filter("shard is not null").groupBy("record_id").agg(F.count_distinct("piece").alias("n")).filter("n > 1").select("record_id")


def p4_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, tokens placed and records cut, by build, stage and split: what any packing must place."""
    groups = ("build_id", "stage", "split")
    each = _packed(spark, sf_dir).filter("shard is not null").groupBy(*groups, "record_id").agg(F.sum(F.col("length") + F.col("eos")).alias("t"), F.count("*").alias("n"))
    return each.groupBy(*groups).agg(F.count("*").alias("records"), F.sum("t").alias("tokens"), F.sum((F.col("n") > 1).cast("long")).alias("cut_records"))


def p4_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the shards are, by build, stage and split, beside the shards written before."""
    return packing.fill_report(_packed(spark, sf_dir), _t(spark, sf_dir, "packed_shards"))


def _near_splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    records = _t(spark, sf_dir, "normalized_records")
    return (*overlap.cross_split_overlap(_t(spark, sf_dir, "documents"), records, similarity=0.6), records)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a training and an evaluation document with equal or near-same texts."""
    pairs = overlap.expand(*_near_splits(spark, sf_dir)[:2])
    return pairs.select(F.least("eval_id", "train_id").alias("doc_id_a"), F.greatest("eval_id", "train_id").alias("doc_id_b")).distinct()


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs counted by evaluation split and source."""
    return overlap.overlap_counts(*_near_splits(spark, sf_dir))


def p5_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation texts of which at least 0.6 stands in a training text, however long that is: pairs of representatives of equal texts."""
    return overlap.cross_split_overlap(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "normalized_records"))[0]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with twelve or more consecutive words of an evaluation item's prompt."""
    return leaks.leaked_passages(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p6_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the longest leaked passage of each item's question and answers stands in each document, and how many words of the document are in any;
    passages of five to eleven words count where they stand whole."""
    return leaks.leaked_passages(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "eval_items"), passage_cols=("prompt", "choices"), whole_from=5)


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sizes = mixing.token_sizes(_t(spark, sf_dir, "documents"), keep=("source",))
    return mixing.mix_sources(sizes, _t(spark, sf_dir, "mixture_targets"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets that the selection falls short of although it uses all documents of the source as often as allowed."""
    spent = F.col("reached_tokens") >= F.col("available_tokens") * F.col("max_repeats")
    return _mixed(spark, sf_dir)[1].filter((F.col("reached_tokens") < F.col("target_tokens")) & spent).select("stage", "source_id")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of every source in every stage, as wanted and as reached."""
    return _mixed(spark, sf_dir)[1]


def p7_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of every stage, and how often each is used."""
    return _mixed(spark, sf_dir)[0]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that had to be split."""
    return splitting.split_documents(_t(spark, sf_dir, "documents")).filter("pieces > 1 and piece = 0").select("doc_id").distinct()


def p8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents."""
    return splitting.split_documents(_t(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (p1_found, p1_budget, p2_found, p2_statistics, p3_found, p4_found, p4_fill, p4_totals, p5_found, p5_counts, p5_contained, p6_found, p6_places, p7_found, p7_shares, p7_selection, p8_found, p8_pieces)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": """
            SELECT DISTINCT e.record_id FROM encoded_records e JOIN shard_layouts l ON e.stage = l.stage AND e.split = l.split
            WHERE e.ids IS NOT NULL AND len(e.ids) + CASE WHEN l.append_eos THEN 1 ELSE 0 END > l.shard_size_tokens""",
        "p4_totals": """
            WITH r AS (SELECT DISTINCT record_id, build_id, stage, split, len(ids) AS n FROM encoded_records WHERE ids IS NOT NULL),
            w AS (SELECT r.*, r.n + CASE WHEN l.append_eos THEN 1 ELSE 0 END AS full_, l.shard_size_tokens AS cap FROM r JOIN shard_layouts l ON r.stage = l.stage AND r.split = l.split)
            SELECT build_id, stage, split, COUNT(*) AS records, CAST(SUM(full_) AS BIGINT) AS tokens, CAST(SUM(CASE WHEN full_ > cap THEN 1 ELSE 0 END) AS BIGINT) AS cut_records
            FROM w GROUP BY build_id, stage, split""",
    }
