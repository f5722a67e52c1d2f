"""Analytics of training runs: metric tables, pilot reviews, schedules and phases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.scalars import perplexity

# Fixed values.
#: Columns of a run's metric table, in the order of its file.
METRICS = ("event", "attempted_step", "global_step", "tokens_processed", "train_loss", "val_loss", "val_perplexity", "lr", "grad_norm", "grad_scale", "optimizer_step_skipped", "optimizer_steps_skipped_total", "consecutive_optimizer_steps_skipped", "tokens_per_second", "peak_memory_mb", "elapsed_seconds")


def strict_number(raw: Column, name: str) -> Column:
    """A number from text; null for empty text; an error for anything that isn't a finite number."""
    x = F.try_cast(raw, "double") if hasattr(F, "try_cast") else raw.try_cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(raw.isNull() | (raw == ""), F.lit(None).cast("double")).when(bad, F.raise_error(F.concat(F.lit(f"{name} is not a finite number: "), raw)).cast("double")).otherwise(x)


def run_summary(metrics: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """First, best and last validation loss, first and last training loss, greatest throughput, memory, time and skipped steps."""
    at = F.struct(*order)
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at))
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at))
    aggs = [first("val_loss").alias("initial_val_loss"), F.min("val_loss").alias("best_val_loss"), last("val_loss").alias("final_val_loss")]
    aggs += [first("train_loss").alias("initial_train_loss"), last("train_loss").alias("final_train_loss")]
    for c in ("tokens_per_second", "peak_memory_mb", "elapsed_seconds", "optimizer_steps_skipped_total"):
        if c in metrics.columns:
            aggs.append(F.max(c).alias(f"max_{c}"))
    return metrics.groupBy(*by).agg(*aggs)


def pilot_review(metrics: DataFrame, value: str, by: list[str], order: list[str], share: float = 0.2, least: int = 5, threshold: float = 0.8) -> DataFrame:
    """Medians of the first and last part of a run, at least ``least`` rows each, their ratio, and whether it reaches the threshold.

    The rows of one run are ranked in a window; a run's metric table is small, and runs spread over tasks.
    """
    over = Window.partitionBy(*by)
    rows = metrics.filter(F.col(value).isNotNull())
    rows = rows.withColumn("_n", F.count("*").over(over)).withColumn("_r", F.row_number().over(over.orderBy(*order)))
    size = F.greatest(F.lit(least), F.floor(F.col("_n") * share))
    head, tail = F.col("_r") <= size, F.col("_r") > F.col("_n") - size
    out = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.median(F.when(head, F.col(value))).alias("head_median"), F.median(F.when(tail, F.col(value))).alias("tail_median"))
    return out.withColumn("ratio", F.col("tail_median") / F.col("head_median")).withColumn("passed", F.col("ratio") >= threshold)


def always_rising(metrics: DataFrame, value: str, by: list[str], order: list[str]) -> DataFrame:
    """Whether each value is above the one before, of runs with two values or more."""
    over = Window.partitionBy(*by).orderBy(*order)
    rows = metrics.filter(F.col(value).isNotNull()).withColumn("_up", F.col(value) > F.lag(value).over(over))
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.coalesce(F.bool_and("_up"), F.lit(False)).alias("always_rising"))


def with_perplexity(metrics: DataFrame, loss: str = "val_loss") -> DataFrame:
    return metrics.withColumn("perplexity", perplexity(F.col(loss)))


def phase_of(rows: DataFrame, phases: list[tuple[str, int]], tokens: str = "tokens_processed") -> DataFrame:
    """Adds the phase: the first whose boundary is above the tokens; the last one beyond all. Phases are a list of a few; boundaries must rise."""
    limits = [limit for _, limit in phases]
    if not phases or any(a >= b for a, b in zip(limits, limits[1:])):
        raise ValueError("phases need strictly rising boundaries")
    choice = None
    for name, limit in phases:
        choice = F.when(F.col(tokens) < limit, name) if choice is None else choice.when(F.col(tokens) < limit, name)
    return rows.withColumn("phase", choice.otherwise(phases[-1][0]))


def phase_join(rows: DataFrame, phases: DataFrame, tokens: str = "tokens_processed", limit: str = "until_tokens", name: str = "phase") -> DataFrame:
    """The same with a table of phases, a dimension of a few rows: it is put into one sorted array, in which every row finds its phase."""
    rows_ = phases.agg(F.array_sort(F.collect_list(F.struct(F.col(limit).alias("l"), F.col(name).alias("p")))).alias("_ps"))  # one row
    pick = F.coalesce(F.get(F.filter("_ps", lambda x: x["l"] > F.col(tokens)), 0), F.try_element_at("_ps", F.lit(-1)))
    return rows.join(F.broadcast(rows_), F.lit(True)).withColumn("phase", pick["p"]).drop("_ps")


def summary_markdown(summary: DataFrame, title: str = "Run summary", notes: list[str] | None = None) -> str:
    """Run summaries as Markdown, a section per run; figures that are missing are said to be unavailable. A summary has a row per run."""
    lines = [f"# {title}", ""]
    for row in summary.toLocalIterator():
        shown = row.asDict()
        lines += [f"## {' / '.join(str(shown[c]) for c in list(shown)[:1])}", *[f"- {k.replace('_', ' ')}: {'unavailable' if v is None else v}" for k, v in list(shown.items())[1:]], ""]
    if notes:
        lines += ["## Known limitations", *[f"- {n}" for n in notes], ""]
    return "\n".join(lines)
