"""Small scalar functions: identifiers, token estimates, answers, rates and schedules."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def token_estimate(text: Column, declared: Column | None = None) -> Column:
    """A declared token count of at least 1, cut to an integer, else a quarter of the characters, at least 1. A declared count below 1 is an error."""
    guess = F.greatest(F.lit(1), F.ceil(F.length(text) / 4)).cast("long")
    if declared is None:
        return guess
    bad = F.raise_error(F.concat(F.lit("token count must be at least 1: "), declared.cast("string"))).cast("long")
    return F.when(declared.isNull(), guess).when(declared < 1, bad).otherwise(declared.cast("long"))


def document_id(given: Column, digest: Column) -> Column:
    """The given id without blanks around it; a null or blank one is replaced by the content hash."""
    return F.coalesce(F.nullif(F.trim(given.cast("string")), F.lit("")), digest)


def item_id(source_id: Column, bucket_id: Column) -> Column:
    """``source/bucket``, or the source alone where it has no buckets."""
    return F.concat_ws("/", source_id, bucket_id)


def answer_index(answer: Column, choices: Column) -> Column:
    """0-based index of an answer given as a letter, a number or the text of a choice, in this order; null if none fits or it is out of range."""
    a = F.trim(answer)
    letter = F.when(a.rlike("^[A-Za-z]$"), F.ascii(F.upper(a)) - F.ascii(F.lit("A")))
    number = F.when(a.rlike("^[0-9]{1,9}$"), a.cast("int"))
    place = F.array_position(choices, a)
    index = F.coalesce(letter, number, F.when(place > 0, place.cast("int") - 1))
    return F.when((index >= 0) & (index < F.size(choices)), index)


def perplexity(loss: Column) -> Column:
    """e to the loss, which counts as 50 at most."""
    return F.exp(F.least(loss, F.lit(50.0)))


def tokens_per_second(start: Column, now: Column, seconds: Column) -> Column:
    return (now - start) / F.greatest(seconds, F.lit(1e-6))


def relative_variance(actual: Column, planned: Column) -> Column:
    return F.abs(actual - planned) / planned


def improvement(baseline: Column, candidate: Column) -> Column:
    """The share by which the candidate is smaller."""
    return (baseline - candidate) / baseline


def learning_rate(step: Column, warmup_steps: int, total_steps: int, highest: float, lowest: float) -> Column:
    """Linear warm-up, then a half cosine down to the lowest rate."""
    done = (step - warmup_steps) / F.lit(float(max(1, total_steps - warmup_steps)))
    falling = lowest + (0.5 * (1.0 + F.cos(F.lit(math.pi) * done))) * (highest - lowest)
    return F.when(step < warmup_steps, highest * step / float(max(1, warmup_steps))).when(step >= total_steps, F.lit(float(lowest))).otherwise(falling)


def training_schedule(batch: int, accumulation: int, context: int, max_tokens: int, warmup_ratio: float, *, step: int = 0, extra_steps: int | None = None) -> dict[str, int]:
    """Tokens per step, steps in all, warm-up steps and the step to stop at."""
    if extra_steps is not None and extra_steps < 1:
        raise ValueError("the number of further steps must be positive")
    per_step = batch * accumulation * context
    total = max(1, math.ceil(max_tokens / per_step))
    stop = total if extra_steps is None else min(total, step + extra_steps)
    return {"tokens_per_step": per_step, "total_steps": total, "warmup_steps": max(1, int(total * warmup_ratio)), "stop_step": stop}


def size_label(name: Column) -> Column:
    """Parameters named in a run's label, as ``170m`` or ``1b``; null without one."""
    number = F.regexp_extract(F.lower(name), r"(\d+)([mb])(?![a-z0-9])", 1)
    unit = F.regexp_extract(F.lower(name), r"(\d+)([mb])(?![a-z0-9])", 2)
    return F.when(number != "", number.cast("long") * F.when(unit == "m", 1_000_000).otherwise(1_000_000_000))


def parse_seeds(value: str) -> list[int]:
    """Distinct whole numbers from a comma-separated list."""
    seeds = [int(x) for x in value.split(",") if x.strip()]
    if not seeds or len(set(seeds)) != len(seeds):
        raise ValueError("seeds must be distinct, and at least one")
    return seeds


def parse_labels(values: list[str]) -> dict[str, str]:
    """``LABEL=PATH`` entries with distinct labels."""
    out: dict[str, str] = {}
    for value in values:
        label, found, path = value.partition("=")
        if not found or not path or not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", label) or label in out:
            raise ValueError(f"not a distinct LABEL=PATH: {value!r}")
        out[label] = path
    return out
