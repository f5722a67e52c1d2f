"""Statistics of splits and stages, breakdowns by several dimensions, and quantiles by the higher rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.windows import prefix_sums


def split_statistics(records: DataFrame, *, split: str = "split", chars: str = "num_chars", line: Column | None = None) -> DataFrame:
    """Documents, characters and, given the JSON line of a row, its bytes with line ends, per split."""
    sums = [F.count("*").alias("documents"), F.sum(chars).alias("total_chars")]
    if line is not None:
        sums.append(F.sum(F.octet_length(line) + 1).alias("bytes"))
    return records.groupBy(split).agg(*sums)


def breakdowns(records: DataFrame, sets: list[list[str]], measures: dict[str, Column]) -> DataFrame:
    """Measures by each of several sets of dimensions in one scan; ``level`` tells the set, as the bits of the dimensions that are *not* in it."""
    dims = list(dict.fromkeys(d for s in sets for d in s))
    return records.groupingSets([[F.col(d) for d in s] for s in sets], *[F.col(d) for d in dims]).agg(F.grouping_id().alias("level"), *[m.alias(n) for n, m in measures.items()])


def stage_measures(tokens: str = "tokens", bytes_: str = "bytes", split: str = "split", held: str = "validation") -> dict[str, Column]:
    """Documents, tokens and bytes in all, for fitting and held out."""
    fit = F.col(split) != held
    out: dict[str, Column] = {"documents": F.count("*"), "tokens": F.sum(tokens), "bytes": F.sum(bytes_)}
    for name, when in (("fit", fit), ("held", ~fit)):
        out |= {f"{name}_documents": F.count_if(when), f"{name}_tokens": F.coalesce(F.sum(F.when(when, F.col(tokens))), F.lit(0)), f"{name}_bytes": F.coalesce(F.sum(F.when(when, F.col(bytes_))), F.lit(0))}
    return out


def disposition_counts(records: DataFrame, disposition: str = "disposition", by: list[str] | None = None) -> DataFrame:
    """Read, accepted, held-out, over-quota and rejected rows."""
    d = F.col(disposition)
    return records.groupBy(*(by or [])).agg(
        F.count("*").alias("read"),
        F.count_if(d == "train").alias("accepted"),
        F.count_if(d == "holdout").alias("held_out"),
        F.count_if(d == "over_quota").alias("over_quota"),
        F.count_if(~d.isin("train", "holdout", "over_quota")).alias("rejected"),
    )


def quantile_higher(df: DataFrame, value: str, quantiles: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Quantiles that are values of the data: of n sorted values, the one at index ceil((n - 1) * q).

    The distinct values and their counts are aggregated first, so copies cost nothing; the running counts are prefix sums over ranges of values, so no
    group has to fit into a task.
    """
    by = by or []
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    placed = prefix_sums(counts, [value], {"_before": F.col("_c")}, by)
    totals = placed.groupBy(*[F.col(g).alias(f"_{i}") for i, g in enumerate(by)]).agg(F.sum("_c").alias("n"))
    on = [F.col(g).eqNullSafe(F.col(f"_{i}")) for i, g in enumerate(by)] or [F.lit(True)]
    # the first value whose running count is beyond the rank
    rank = lambda q: F.ceil((F.col("n") - 1) * q)
    picks = [F.min(F.when(F.col("_before") + F.col("_c") > rank(q), F.col(value))).alias(name) for name, q in quantiles.items()]
    return placed.join(totals if by else F.broadcast(totals), on).groupBy(*by).agg(F.max("n").alias("n"), *picks)


def overlap(left: DataFrame, right: DataFrame, digest: str = "text_sha256") -> DataFrame:
    """Distinct hashes that are on both sides; splits by hash have none."""
    return left.select(digest).intersect(right.select(digest))


def license_counts(records: DataFrame, license_: str = "license") -> DataFrame:
    return records.groupBy(license_).agg(F.count("*").alias("documents"))


def largest_by(records: DataFrame, value: str, order: list[str], by: list[str]) -> DataFrame:
    """The value of the last row in the order, per group."""
    return records.groupBy(*by).agg(F.max_by(F.col(value), F.struct(*order)).alias(f"last_{value}"))
