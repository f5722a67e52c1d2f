"""Source registries, mixtures and probe sets from YAML, closed to unknown keys."""

from __future__ import annotations

import math
import re
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators.records import Bucket, Source

_REVISION = re.compile(r"[0-9a-f]{40}")
_SOURCE_KEYS = set(Source.__dataclass_fields__)
_MIXTURE_KEYS = {"version", "seed", "quota_tolerance", "validation_fraction", "buffer_size", "stages"}


def _yaml(path: str | Path) -> dict[str, Any]:
    import yaml

    loaded = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if not isinstance(loaded, dict):
        raise ValueError(f"not a mapping: {path}")
    return loaded


def _closed(given: dict, known: set[str], what: str) -> None:
    unknown = set(given) - known
    if unknown:
        raise ValueError(f"unknown keys in {what}: {sorted(unknown)}")


def _text(value: object, what: str) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ValueError(f"{what} must be a non-empty string")
    return value.strip()


def parse_source(raw: dict[str, Any]) -> Source:
    _closed(raw, _SOURCE_KEYS, f"source {raw.get('id')!r}")
    name = _text(raw.get("id"), "id")
    if raw.get("revision") is not None and not _REVISION.fullmatch(str(raw["revision"])):
        raise ValueError(f"the revision of {name!r} must be a full commit hash")
    buckets = []
    for b in raw.get("buckets") or []:
        _closed(b, {"id", "collections", "weight"}, f"a bucket of {name!r}")
        buckets.append(Bucket(_text(b.get("id"), "bucket id"), tuple(_text(c, "collection") for c in b["collections"]), float(b["weight"])))
    held = [c for b in buckets for c in b.collections]
    if len({b.id for b in buckets}) < len(buckets) or len(set(held)) < len(held):
        raise ValueError(f"buckets of {name!r} must be distinct and share no collection")
    return Source(**{k: v for k, v in raw.items() if k not in ("buckets", "data_files")} | {"buckets": tuple(buckets), "data_files": tuple(raw.get("data_files") or ())})


def load_registry(path: str | Path) -> dict[str, Source]:
    """Sources by id, from ``version`` and ``sources``."""
    raw = _yaml(path)
    _closed(raw, {"version", "sources"}, "the registry")
    out: dict[str, Source] = {}
    for entry in raw.get("sources") or []:
        source = parse_source(entry)
        if source.id in out:
            raise ValueError(f"repeated source {source.id!r}")
        out[source.id] = source
    return out


def registry_table(spark: SparkSession, sources: dict[str, Source]) -> DataFrame:
    """The registry as a dimension table."""
    rows = [(s.id, s.name, s.role, s.license, s.license_review, s.collection, [(b.id, list(b.collections), b.weight) for b in s.buckets]) for s in sources.values()]
    return spark.createDataFrame(rows, "source_id string, dataset string, role string, license string, license_review string, collection string, buckets array<struct<id: string, collections: array<string>, weight: double>>")


def load_mixture(path: str | Path) -> dict[str, Any]:
    raw = _yaml(path)
    _closed(raw, _MIXTURE_KEYS, "the mixture")
    whole = lambda v: isinstance(v, int) and not isinstance(v, bool)
    for key in ("quota_tolerance", "validation_fraction"):
        v = raw.get(key)
        if isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(v) or not 0 <= v < 1:
            raise ValueError(f"{key} must be in [0, 1)")
    if raw.get("version") != 1 or not whole(raw.get("seed")) or not whole(raw.get("buffer_size")) or raw["buffer_size"] < 1 or not isinstance(raw.get("stages"), dict):
        raise ValueError("a mixture has version 1, a whole seed, a positive buffer_size and stages")
    return raw


def load_probes(path: str | Path) -> dict[str, list[str]]:
    raw = _yaml(path)
    _closed(raw, {"groups", "version"}, "the probes")
    groups = raw.get("groups")
    if not isinstance(groups, dict) or not groups or any(not isinstance(t, list) or not t or any(not isinstance(x, str) or not x for x in t) for t in groups.values()):
        raise ValueError("every probe group needs texts that aren't empty")
    return groups


def probe_table(spark: SparkSession, groups: dict[str, list[str]]) -> DataFrame:
    return spark.createDataFrame([(g, t) for g, texts in groups.items() for t in texts], "`group` string, text string")


#: Thresholds of a tokenizer comparison, with their defaults.
CANDIDATE_DEFAULTS = {"min_overall": 0.01, "min_focus": 0.03, "max_general_loss": 0.01, "max_focus_loss": 0.01, "max_probe_loss": 0.05}


def load_candidate(path: str | Path) -> dict[str, Any]:
    """The recipe of a tokenizer candidate: labels, vocabulary, sample size and thresholds, each in its range."""
    raw = _yaml(path)
    _closed(raw, {"baseline", "candidate", "vocabulary", "sample_tokens", *CANDIDATE_DEFAULTS}, "the candidate")
    out = CANDIDATE_DEFAULTS | raw
    for key in ("baseline", "candidate"):
        _text(out.get(key), key)
    if out["baseline"] == out["candidate"]:
        raise ValueError("baseline and candidate need different labels")
    for key in ("vocabulary", "sample_tokens"):
        if isinstance(out.get(key), bool) or not isinstance(out.get(key), int) or out[key] < 1:
            raise ValueError(f"{key} must be a positive whole number")
    for key in CANDIDATE_DEFAULTS:
        if isinstance(out[key], bool) or not isinstance(out[key], (int, float)) or not 0 <= out[key] < 1:
            raise ValueError(f"{key} must be in [0, 1)")
    return out
