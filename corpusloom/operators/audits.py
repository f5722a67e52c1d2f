"""Reconciliation of manifests, journals and files with the data they describe."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reconcile(claimed: DataFrame, actual: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Claimed against recomputed figures, one row per key and measure: ``key columns, measure, claimed, actual, matches``. Keys of either side appear; a missing side is null and doesn't match."""
    side = lambda df, name: df.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in measures])).alias("x")).select(*keys, F.col("x.measure").alias("measure"), F.col("x.v").alias(name))
    both = side(claimed, "claimed").alias("c").join(side(actual, "actual").alias("a"), F.expr(" and ".join([*[f"c.{k} <=> a.{k}" for k in keys], "c.measure = a.measure"])), "full_outer")
    out = both.select(*[F.coalesce(f"c.{k}", f"a.{k}").alias(k) for k in keys], F.coalesce("c.measure", "a.measure").alias("measure"), "claimed", "actual")
    return out.withColumn("matches", F.coalesce(F.col("claimed") == F.col("actual"), F.lit(False)))


def check_totals(report: DataFrame) -> DataFrame:
    """Of rows (total, accepted, rejected, reasons map): do accepted and rejected make the total, and the reasons the rejected?"""
    reasons = F.aggregate(F.map_values("reasons"), F.lit(0).cast("long"), lambda a, x: a + x)
    return report.withColumn("balanced", (F.col("total") == F.col("accepted") + F.col("rejected")) & (reasons == F.col("rejected")))


def journal_totals(artifacts: DataFrame, units: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Published and unpublished artifacts and bytes of a build's journal, and those whose unit is missing."""
    known = units.select(F.col(unit).alias("_u"), "published").groupBy("_u").agg(F.bool_or(F.coalesce("published", F.lit(False))).alias("_p"))
    rows = artifacts.join(known, F.col(unit) == F.col("_u"), "left")
    p, q, orphan = F.col("_p"), ~F.col("_p"), F.col("_u").isNull()
    size = lambda when: F.coalesce(F.sum(F.when(when, F.col("size"))), F.lit(0))
    return rows.agg(F.count_if(p).alias("published"), size(p).alias("published_bytes"), F.count_if(q).alias("unpublished"), size(q).alias("unpublished_bytes"), F.count_if(orphan).alias("orphans"))


def unpublished(artifacts: DataFrame, units: DataFrame, unit: str = "unit_id") -> DataFrame:
    """Artifacts of units that aren't published, in order of unit and path."""
    open_ = units.groupBy(unit).agg(F.bool_or(F.coalesce("published", F.lit(False))).alias("_p")).filter("not _p").select(unit)
    return artifacts.join(open_, unit, "left_semi").orderBy(unit, "relative_path")


def quota_status(requested: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Requested and actual tokens of every key of either side, 0 where one is missing, and what is left."""
    both = requested.select(*keys, F.col("token_quota").alias("requested_tokens")).join(actual.select(*keys, "actual_tokens"), keys, "full_outer").fillna(0, ["requested_tokens", "actual_tokens"])
    return both.withColumn("remaining_tokens", F.greatest(F.lit(0), F.col("requested_tokens") - F.col("actual_tokens")))


def verify_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Files of a manifest (path, size, sha256) against those found: adds ``state``: ``ok, missing, size, hash`` or ``unexpected``."""
    found = files.select(F.col("path").alias("_path"), F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    both = manifest.join(found, F.col("path") == F.col("_path"), "full_outer")
    state = F.when(F.col("path").isNull(), "unexpected").when(F.col("_path").isNull(), "missing").when(F.col("size") != F.col("_size"), "size").when(F.lower("sha256") != F.col("_sha"), "hash").otherwise("ok")
    return both.select(F.coalesce("path", "_path").alias("path"), state.alias("state"))


def verify_audit(items: DataFrame, stages: DataFrame) -> DataFrame:
    """Audit rows checked again: overshoot from planned and actual, the proof of a minimal boundary, and stage totals as sums of items. One row per stage."""
    over = F.greatest(F.lit(0), F.col("actual_tokens") - F.col("planned_tokens"))
    proof = (F.col("actual_tokens") >= F.col("planned_tokens")) & (F.col("actual_tokens") - F.col("last_document_tokens") < F.col("planned_tokens"))
    sums = items.groupBy("stage").agg(F.bool_and(F.col("overshoot_tokens") == over).alias("overshoot_ok"), F.bool_and(proof).alias("boundary_ok"), F.sum("planned_tokens").alias("_p"), F.sum("actual_tokens").alias("_a"))
    return stages.select("stage", "planned_tokens", "actual_tokens").join(sums, "stage", "full_outer").select("stage", "overshoot_ok", "boundary_ok", F.coalesce((F.col("planned_tokens") == F.col("_p")) & (F.col("actual_tokens") == F.col("_a")), F.lit(False)).alias("sums_ok"))


def projection(tokens: int, seconds: float, target_tokens: int, limit_hours: float = 48.0) -> dict[str, float | bool]:
    """Rate of a calibration, the hours its target would take, and whether they are within the limit."""
    rate = tokens / max(seconds, 1e-6)
    hours = target_tokens / max(rate, 1e-12) / 3600
    return {"tokens_per_second": rate, "projected_hours": hours, "within_limit": hours <= limit_hours}


def preflight(spark: SparkSession, checks: list[tuple[str, Callable[[], object]]]) -> DataFrame:
    """Run named checks in order, none stopping the others: (check, status, message). A check fails by raising, by returning False, or by returning a DataFrame with rows, the first of
    which is the message."""
    rows = []
    for name, check in checks:
        try:
            got = check()
            if isinstance(got, DataFrame):
                first = got.limit(1).collect()
                rows.append((name, "fail" if first else "pass", str(first[0].asDict()) if first else ""))
            else:
                rows.append((name, "fail" if got is False else "pass", "" if got in (None, True, False) else str(got)))
        except Exception as error:  # noqa: BLE001 - any failure of a check is its result
            rows.append((name, "fail", str(error).split("\n")[0][:500]))
    return spark.createDataFrame(rows, "check string, status string, message string")
