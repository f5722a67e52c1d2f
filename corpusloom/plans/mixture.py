"""Exact token quotas of stages, roles, sources and buckets, and checks of tokenizer candidates."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from corpusloom.functions.hashing import json_sha256
from corpusloom.operators.records import CORPUS_ROLES, Source


def _weight(value: object, name: str) -> Decimal:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        raise ValueError(f"the weight of {name!r} must be a number")
    exact = Decimal(str(value))
    if not exact.is_finite() or exact < 0:
        raise ValueError(f"the weight of {name!r} must be finite and not negative")
    return exact


def allocate(total: int, weights: Mapping[str, float | int | Decimal]) -> dict[str, int]:
    """Whole shares of a total that add up to it: each share rounded down, what is left given to the largest fractions, ties by name."""
    if isinstance(total, bool) or not isinstance(total, int) or total <= 0:
        raise ValueError("the total must be a positive whole number")
    exact = {name: _weight(w, name) for name, w in weights.items()}
    whole = sum(exact.values(), Decimal(0))
    if whole <= 0:
        raise ValueError("at least one weight must be positive")
    # numerators over the common denominator ``whole`` keep fractions comparable without rounding
    floors = {name: int((total * w) // whole) for name, w in exact.items()}
    fractions = {name: total * w - floors[name] * whole for name, w in exact.items()}
    lucky = sorted(exact, key=lambda name: (-fractions[name], name))[: total - sum(floors.values())]
    return {name: floors[name] + (name in lucky) for name in sorted(exact)}


def cap_bucket(quotas: dict[str, int], bucket: str, share: Decimal, total: int) -> dict[str, int]:
    """Keep a bucket's quota at or below a share of the total; what is above goes to the largest other bucket, ties by name."""
    most = int(Decimal(total) * share // 1)
    if quotas.get(bucket, 0) <= most:
        return quotas
    others = [b for b in quotas if b != bucket]
    if not others:
        raise ValueError(f"{bucket!r} can't be capped without another bucket")
    to = min(others, key=lambda b: (-quotas[b], b))
    return quotas | {bucket: most, to: quotas[to] + quotas[bucket] - most}


def mixture_plan(sources: Iterable[Source], mixture: Mapping[str, Any], stage: str, *, total_tokens: int | None = None, caps: Mapping[str, float] | None = None) -> dict[str, Any]:
    """One stage's quotas, from roles to sources to buckets, each level adding up exactly; ``caps`` bound the share of buckets by name.

    ``mixture`` has ``seed, quota_tolerance, validation_fraction, buffer_size`` and ``stages``, a stage ``total_tokens, role_weights, source_weights``. Sources whose role has no weight are left
    out; a role with a weight but no source, roles that may not enter a corpus, and unknown sources are errors. The plan carries its own hash.
    """
    if stage not in mixture.get("stages", {}):
        raise ValueError(f"unknown stage {stage!r}")
    cfg = mixture["stages"][stage]
    unknown = set(cfg) - {"total_tokens", "role_weights", "source_weights"}
    if unknown:
        raise ValueError(f"unknown keys in stage {stage!r}: {sorted(unknown)}")
    by_id = {s.id: s for s in sources}
    missing = set(cfg["source_weights"]) - set(by_id)
    if missing:
        raise ValueError(f"unknown sources: {sorted(missing)}")
    chosen = [by_id[i] for i in sorted(cfg["source_weights"])]
    barred = [s.id for s in chosen if s.role not in CORPUS_ROLES] + [r for r in cfg["role_weights"] if r not in CORPUS_ROLES]
    if barred:
        raise ValueError(f"not permitted in a corpus: {barred}")
    total = cfg["total_tokens"] if total_tokens is None else total_tokens
    roles = allocate(total, cfg["role_weights"])
    items = []
    for role, quota in roles.items():
        mine = [s for s in chosen if s.role == role]
        if not mine:
            raise ValueError(f"stage {stage!r} has a quota for {role!r} but no source")
        for source_id, share in allocate(quota, {s.id: cfg["source_weights"][s.id] for s in mine}).items():
            source = by_id[source_id]
            if not source.buckets:
                items.append({"id": source_id, "source_id": source_id, "bucket_id": None, "role": role, "token_quota": share})
                continue
            parts = allocate(share, {b.id: b.weight for b in source.buckets})
            for name, limit in (caps or {}).items():
                if any(b.id == name and Decimal(str(b.weight)) > Decimal(str(limit)) for b in source.buckets):
                    raise ValueError(f"bucket {name!r} has a weight above its cap of {limit}")
                if name in parts:
                    parts = cap_bucket(parts, name, Decimal(str(limit)), share)
            items += [{"id": f"{source_id}/{b.id}", "source_id": source_id, "bucket_id": b.id, "role": role, "token_quota": parts[b.id]} for b in source.buckets]
    plan = {"version": 1, "stage": stage, "seed": int(mixture["seed"]), "total_tokens": total, "quota_tolerance": float(mixture["quota_tolerance"]), "validation_fraction": float(mixture["validation_fraction"]), "buffer_size": int(mixture["buffer_size"]), "role_quotas": roles, "items": sorted(items, key=lambda i: i["id"])}
    return plan | {"plan_sha256": json_sha256(plan)}


def sample_plan(sources: Iterable[Source], mixture: Mapping[str, Any], stage: str = "main", total: int = 200_000_000) -> dict[str, Any]:
    """The plan of a tokenizer sample: a stage's proportions at a fixed total."""
    return mixture_plan(sources, mixture, stage, total_tokens=total)


def plan_items(spark: SparkSession, plans: Iterable[Mapping[str, Any]]) -> DataFrame:
    """The items of plans as a table; a quota of 0 can't be filled and is an error."""
    rows = [(p["stage"], i["id"], i["source_id"], i["bucket_id"], i["role"], i["token_quota"]) for p in plans for i in p["items"]]
    empty = [r[1] for r in rows if r[5] < 1]
    if empty:
        raise ValueError(f"quotas must be positive: {empty}")
    return spark.createDataFrame(rows, "stage string, item_id string, source_id string, bucket_id string, role string, token_quota long")


def exact_quotas(plan: Mapping[str, Any], actual: Mapping[str, int], last: Mapping[str, int]) -> bool:
    """Whether the actual tokens of every planned item, and of no other, reach its quota with the last document."""
    quota = {i["id"]: i["token_quota"] for i in plan["items"]}
    return set(quota) == set(actual) and all(actual[i] >= q and actual[i] - last.get(i, 0) < q for i, q in quota.items())


def compare_tokenizers(baseline: Mapping[str, Any], candidate: Mapping[str, Any], *, min_overall: float = 0.01, min_focus: float = 0.03, max_general_loss: float = 0.01, max_focus_loss: float = 0.01, max_probe_loss: float = 0.05, general: str = "pretrain_general", focus: str = "pretrain_telecom", fingerprints: tuple[str, ...] = ("input_files_sha256", "probe_sets_sha256")) -> dict[str, Any]:
    """Which of two tokenizers to keep, from their metrics on the same texts.

    Metrics have ``tokens``, ``roles`` (name to ``tokens``), ``probe_p95_tokens_per_word``, numbers of ``round_trip_failures`` and ``special_token_failures``, and the fingerprints of what they were
    measured on. The candidate wins if nothing fails and it saves enough tokens over all or on the focus role; a side with failures loses to one without; with unequal inputs nobody wins.
    """

    def positive(side: Mapping[str, Any], key: str) -> float:
        value = side.get(key)
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value) or value <= 0:
            raise ValueError(f"{key} must be a positive number")
        return float(value)

    saved = lambda a, b: (a - b) / a
    per_role = {}
    for role in sorted({*baseline["roles"], *candidate["roles"]}):
        if role not in baseline["roles"] or role not in candidate["roles"]:
            raise ValueError(f"role {role!r} was measured on one side only")
        a, b = positive(baseline["roles"][role], "tokens"), positive(candidate["roles"][role], "tokens")
        per_role[role] = saved(a, b)
    overall = saved(positive(baseline, "tokens"), positive(candidate, "tokens"))
    probes = positive(candidate, "probe_p95_tokens_per_word") / positive(baseline, "probe_p95_tokens_per_word") - 1
    shared = [f"{f} differs" for f in fingerprints if not baseline.get(f) or baseline.get(f) != candidate.get(f)]
    failures = {name: [k for k in ("round_trip_failures", "special_token_failures") if side.get(k)] for name, side in (("baseline", baseline), ("candidate", candidate))}
    if per_role[focus] < -max_focus_loss:
        failures["candidate"].append(f"{focus} regression")
    if per_role[general] < -max_general_loss:
        failures["candidate"].append(f"{general} regression")
    if probes > max_probe_loss:
        failures["candidate"].append("probe regression")
    better = overall >= min_overall or per_role[focus] >= min_focus
    if shared or all(failures.values()):
        winner = None
    elif failures["candidate"] or failures["baseline"]:
        winner = "baseline" if failures["candidate"] else "candidate"
    else:
        winner = "candidate" if better else "baseline"
    report = {"eligible": not shared and not any(failures.values()), "winner": winner, "overall_improvement": overall, "role_improvements": per_role, "probe_regression": probes, "shared_failures": shared, "failures": failures, "meets_threshold": better}
    return report | {"comparison_sha256": json_sha256(report)}
