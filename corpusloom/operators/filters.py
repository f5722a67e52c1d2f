"""Acceptance of documents: length, exact duplicates, contamination, and the reasons of rejections."""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.hashing import json_sha256
from corpusloom.functions.text import normalize

_AUTOMATA: dict[str, object] = {}


@dataclass(frozen=True)
class QualityPolicy:
    """What is rejected. A policy that isn't enabled accepts every document."""

    enabled: bool = True
    min_chars: int = 1
    max_chars: int | None = None
    exact_dedup: bool = True


def fold_patterns(patterns: list[str]) -> list[str]:
    """Normalized, case-folded patterns in their given order; empty ones would match everything and are left out."""
    folded = (normalize(p).casefold() for p in patterns)
    return [p for p in folded if p]


def pattern_fingerprint(patterns: list[str], ordered: bool = False) -> str:
    """Hash of the set of patterns, or of their sequence with repetitions."""
    return json_sha256(list(patterns) if ordered else sorted(set(filter(None, patterns))))


def contains_any(df: DataFrame, text: str, patterns: list[str], name: str = "contaminated", fold: bool = True) -> DataFrame:
    """Adds a boolean: does the case-folded text contain one of the folded patterns? One automaton per worker, one scan of each text.

    A null text contains nothing. The patterns are a fixed set of tests that the caller holds already; they travel with the tasks.
    """
    kept = tuple(sorted(set(filter(None, patterns))))
    if not kept:
        return df.withColumn(name, F.lit(False))
    shared = df.sparkSession.sparkContext.broadcast(kept)
    digest = pattern_fingerprint(list(kept))

    @F.arrow_udf(T.BooleanType())
    def found(column: pa.Array) -> pa.Array:
        automaton = _AUTOMATA.get(digest)
        if automaton is None:
            automaton = ahocorasick.Automaton()
            for p in shared.value:
                automaton.add_word(p, None)
            automaton.make_automaton()
            _AUTOMATA.clear()
            _AUTOMATA[digest] = automaton
        return pa.array([bool(t) and next(automaton.iter(t.casefold() if fold else t), None) is not None for t in column.to_pylist()], pa.bool_())

    return df.withColumn(name, found.asNondeterministic()(F.col(text)))


def contains_any_join(df: DataFrame, key: str, folded: Column, patterns: DataFrame, name: str = "contaminated") -> DataFrame:
    """The same with a table of folded patterns (column ``pattern``) as a semi join on containment. Its work is texts times patterns: for a few patterns,
    or to check the automaton."""
    # the planner broadcasts the patterns if they are small, and loops over them within the JVM
    hits = df.select(F.col(key).alias("_k"), folded.alias("_f")).join(patterns.filter("pattern <> ''"), F.contains(F.col("_f"), F.col("pattern")), "left_semi").select("_k").distinct()
    return df.join(hits, F.col(key) == F.col("_k"), "left").withColumn(name, F.col("_k").isNotNull()).drop("_k")


def rejection_reasons(df: DataFrame, policy: QualityPolicy, *, digest: str = "text_sha256", chars: str = "num_chars", position: str = "doc_id", contaminated: str | None = "contaminated") -> DataFrame:
    """Adds ``reason``: ``too_short``, ``too_long``, ``duplicate_exact``, ``benchmark_contamination``, or null for accepted rows.

    The first that holds counts. A duplicate is a row whose hash an earlier *accepted* row has: contaminated rows are never
    accepted, so each copy of a contaminated text is contaminated, and the set form tests that before the order. First positions are
    found by a partial aggregation, and only hashes with several rows are joined back, so a text with very many copies is no hot
    group. A null hash is no duplicate of anything. Positions must be distinct and not null. ``df`` is read three times: pass a stored
    table where its columns are dear.
    """
    if not policy.enabled:
        return df.withColumn("reason", F.lit(None).cast("string"))
    length = F.when(F.col(chars) < policy.min_chars, "too_short")
    if policy.max_chars is not None:
        length = length.when(F.col(chars) > policy.max_chars, "too_long")
    if contaminated:
        length = length.when(F.col(contaminated), "benchmark_contamination")
    df = df.withColumn("reason", length)
    if not policy.exact_dedup:
        return df
    repeated = (
        df.filter("reason is null").groupBy(F.col(digest).alias("_d")).agg(F.min(position).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1").select("_d", "_first")
    )
    # decided on narrow rows; only the positions of duplicates go back to the rows with their texts
    narrow = df.filter("reason is null").select(F.col(position).alias("_p"), F.col(digest).alias("_h"))
    late = narrow.join(repeated, F.col("_h") == F.col("_d")).filter("_p > _first").select("_p")
    return df.join(late, F.col(position) == F.col("_p"), "left").withColumn("reason", F.when(F.col("_p").isNotNull(), "duplicate_exact").otherwise(F.col("reason"))).drop("_p")


def first_copies(df: DataFrame, digest: str, position: str) -> DataFrame:
    """One row per hash, that of the smallest position. Copies are dropped by a partial aggregation before the shuffle, so a group of copies is no skew."""
    rest = [c for c in df.columns if c != digest]
    return df.groupBy(digest).agg(F.min_by(F.struct(*rest), F.col(position)).alias("_r")).select(digest, "_r.*").select(*df.columns)


def unseen(df: DataFrame, accepted: DataFrame, digest: str = "text_sha256") -> DataFrame:
    """Rows whose hash isn't among the accepted ones (column of the same name)."""
    return df.join(accepted.select(digest).distinct(), digest, "left_anti")


def quality_report(reasons: DataFrame) -> DataFrame:
    """One row per reason, ``accepted`` among them, with its documents, and the total beside it."""
    by = reasons.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("documents"))
    return by.withColumn("total", F.sum("documents").over(Window.partitionBy()))
