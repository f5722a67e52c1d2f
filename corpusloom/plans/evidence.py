"""Evidence around a build: the selection of a tokenizer, snapshots of files by content, the checks before a run, and counts of its shards."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.hashing import json_sha256
from corpusloom.functions.scalars import training_schedule
from corpusloom.operators.aggregates import overlap
from corpusloom.operators.audits import preflight, verify_files
from corpusloom.operators.tokens import round_trip_failures
from corpusloom.sources.paths import exists, file_system, free_bytes, move, remove
from corpusloom.sources.readers import file_table, read_shards, verify_shards
from corpusloom.sources.sinks import write_evidence

# The checks before a run, in their order, and the fields of a selection.
CHECKS = ("config", "source_revision", "dataset_manifest", "dataset_overlap", "tokenizer", "shards", "output_storage", "device", "training_math", "checkpoint")
SELECTION = ("version", "approved", "winner", "comparison_sha256", "selected_tokenizer_sha256", "operator_timestamp")


def require_sha256(value: object, what: str) -> str:
    """A lower-case hex SHA-256."""
    if not isinstance(value, str) or not re.fullmatch(r"[0-9a-f]{64}", value):
        raise ValueError(f"{what} is no SHA-256")
    return value


def require_label(value: object, what: str = "label") -> str:
    if not isinstance(value, str) or not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", value):
        raise ValueError(f"{what} may have letters, digits, dots, dashes and underscores: {value!r}")
    return value


def _chosen(comparison: Mapping[str, Any], winner: str) -> str:
    """The tokenizer hash of a comparison's winner, if the comparison is whole, unchanged and holds good for it."""
    claimed = comparison.get("comparison_sha256")
    if claimed != json_sha256({k: v for k, v in comparison.items() if k != "comparison_sha256"}):
        raise ValueError("the comparison isn't what its hash says")
    labels = comparison.get("labels") or {}
    side = next((s for s in ("candidate", "baseline") if labels.get(s) == winner), None)
    if side is None:
        raise ValueError(f"{winner!r} is none of the tokenizers compared")
    if comparison.get("shared_evidence_valid") is not True or (comparison.get("side_validity") or {}).get(side) is not True:
        raise ValueError(f"the evidence doesn't allow {winner!r} to be selected")
    found = require_sha256((comparison.get(side) or {}).get("tokenizer_sha256"), f"the hash of {winner!r}")
    if (comparison.get("fingerprints") or {}).get(f"{side}_tokenizer_sha256") != found:
        raise ValueError(f"the fingerprint of {winner!r} is another one")
    return found


def _moment(value: object) -> datetime:
    try:
        when = datetime.fromisoformat(str(value).replace("Z", "+00:00"))
    except ValueError:
        raise ValueError(f"no time: {value!r}") from None
    if when.tzinfo is None:
        raise ValueError("the time needs a time zone")
    return when


def write_selection(spark: SparkSession, path: str, comparison: Mapping[str, Any], winner: str, at: str | None = None) -> dict[str, Any]:
    """Approve one of two compared tokenizers, once: a file that is there already with other content is an error."""
    at = at or datetime.now(timezone.utc).isoformat()
    _moment(at)
    values = (1, True, winner, comparison.get("comparison_sha256"), _chosen(comparison, winner), at)
    selection = dict(zip(SELECTION, values))
    write_evidence(spark, path, selection)
    return selection


def check_selection(selection: Mapping[str, Any], comparison: Mapping[str, Any]) -> str:
    """The hash of the selected tokenizer, if the selection follows from the comparison."""
    if set(selection) != set(SELECTION) or selection["version"] != 1 or selection["approved"] is not True:
        raise ValueError("no approved selection")
    _moment(selection["operator_timestamp"])
    found = _chosen(comparison, selection["winner"])
    if selection["comparison_sha256"] != comparison["comparison_sha256"] or selection["selected_tokenizer_sha256"] != found:
        raise ValueError("the selection belongs to another comparison")
    return found


def file_identity(spark: SparkSession, path: str) -> dict[str, Any]:
    """Path, size and hash of one file that isn't empty."""
    rows = file_table(spark, path).limit(2).collect()
    if len(rows) != 1 or not rows[0]["size"]:
        raise ValueError(f"{path} isn't one file with content")
    return {"path": path, "size": rows[0]["size"], "sha256": rows[0]["sha256"]}


def snapshot_file(spark: SparkSession, source: str, folder: str, label: str) -> dict[str, Any]:
    """Copy a file to a name made of its content's hash, never over another: a copy that is there is checked and kept, and one that changes on the way is an error."""
    require_label(label)
    mine = file_identity(spark, source)
    suffix = re.search(r"\.[A-Za-z0-9]+$", source)
    target = f"{folder}/{label}-{mine['sha256']}{suffix.group() if suffix else ''}"
    if not exists(spark, target):
        part = f"{target}.staging"
        remove(spark, part)
        (fs, a), (goal_fs, b) = file_system(spark, source), file_system(spark, part)
        spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, a, goal_fs, b, False, spark.sparkContext._jsc.hadoopConfiguration())
        if file_identity(spark, part)["sha256"] != mine["sha256"]:
            remove(spark, part)
            raise ValueError(f"{source} changed while it was copied")
        try:
            move(spark, part, target)
        except FileExistsError:  # another one was faster
            remove(spark, part)
    there = file_identity(spark, target)
    if (there["size"], there["sha256"]) != (mine["size"], mine["sha256"]):
        raise ValueError(f"{target} has other content than its name says")
    return there


def run_checks(
    spark: SparkSession,
    config: Mapping[str, Any],
    *,
    required: Mapping[str, type],
    revisions: Mapping[str, str | None],
    manifest: DataFrame,
    files: DataFrame,
    train: DataFrame,
    held: DataFrame,
    probes: DataFrame,
    tokenizer: str,
    shards: DataFrame,
    metadata: DataFrame,
    output: str,
    free: int = 0,
    checkpoint: str | None = None,
    device: Callable[[], object] | None = None,
    digest: str = "text_sha256",
) -> DataFrame:
    """The ten checks before a run, each of which passes or fails whatever the others do: (check, status, message).

    ``config`` has the ``required`` keys of their types, and ``batch, accumulation, context, max_tokens, warmup_ratio``. Every source's revision is a commit.
    ``files`` (path, size, sha256) are those of the ``manifest``; ``train`` and ``held`` share no hash; ``probes`` (text) come back from the tokenizer; ``shards`` are what
    their ``metadata`` says; ``free`` bytes are left at ``output``; a checkpoint, if named, is a file with content. What device there is is for the caller to check.
    """

    def settings() -> None:
        wrong = sorted(k for k, kind in required.items() if not isinstance(config.get(k), kind) or isinstance(config.get(k), bool) and kind is not bool)
        if wrong:
            raise ValueError(f"missing or of another type: {', '.join(wrong)}")

    def commits() -> None:
        loose = sorted(k for k, v in revisions.items() if not v or not re.fullmatch(r"[0-9a-f]{40}", v))
        if loose:
            raise ValueError(f"not bound to a commit: {', '.join(loose)}")

    def room() -> str:
        left = free_bytes(spark, output)
        if left < free:
            raise OSError(f"{left} bytes are free at {output}, {free} are needed")
        return f"{left} bytes free"

    def schedule() -> str:
        s = training_schedule(config["batch"], config["accumulation"], config["context"], config["max_tokens"], config["warmup_ratio"])
        if s["warmup_steps"] >= s["total_steps"]:
            raise ValueError("the warm-up takes all steps")
        return json.dumps(s, sort_keys=True)

    steps: dict[str, Callable[[], object]] = {
        "config": settings, "source_revision": commits, "dataset_manifest": lambda: verify_files(manifest, files).filter("state <> 'ok'"), "dataset_overlap": lambda: overlap(train, held, digest),
        "tokenizer": lambda: round_trip_failures(probes, tokenizer), "shards": lambda: verify_shards(shards, metadata), "output_storage": room, "device": device or (lambda: None), "training_math": schedule,
        "checkpoint": lambda: None if checkpoint is None else str(file_identity(spark, checkpoint)["sha256"]),
    }
    return preflight(spark, [(name, steps[name]) for name in CHECKS])


def shard_evidence(spark: SparkSession, path: str, documents: int, eos_id: int, vocabulary: int, dtype: str = "uint16") -> dict[str, Any]:
    """Token shards counted again from their bytes: tokens, end tokens (one per document) and the largest id, with a hash of its own."""
    ends = F.size(F.filter("ids", lambda x: x == eos_id))
    r = read_shards(spark, path, dtype).agg(F.count("*").alias("shards"), F.sum(F.size("ids").cast("long")).alias("tokens"), F.sum(ends.cast("long")).alias("eos"), F.max(F.array_max("ids")).alias("top")).first()
    body = {"path": path, "shards": r["shards"], "total_tokens": r["tokens"] or 0, "eos_tokens": r["eos"] or 0, "max_id": r["top"], "documents": documents, "vocabulary": vocabulary}
    body["passed"] = bool(r["shards"] and body["eos_tokens"] == documents and r["top"] < vocabulary)
    return body | {"evidence_sha256": json_sha256(body)}


def reuse_evidence(kept: Mapping[str, Any], spark: SparkSession, path: str, documents: int, eos_id: int, vocabulary: int, dtype: str = "uint16") -> dict[str, Any]:
    """Evidence from an earlier run, if it is unchanged and the shards still say the same; an error otherwise."""
    if kept.get("evidence_sha256") != json_sha256({k: v for k, v in kept.items() if k != "evidence_sha256"}):
        raise ValueError("the evidence isn't what its hash says")
    now = shard_evidence(spark, path, documents, eos_id, vocabulary, dtype)
    if now != dict(kept):
        raise ValueError("the shards have changed since the evidence was made")
    return now
