"""Evaluation analytics: paired losses, blinded reviews, judgments, multiple choice and benchmark conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.scalars import answer_index

# Fixed values.
#: Scores of a judgment, each 0, 1 or 2.
SCORES = ("character_consistency", "object_location_consistency", "causal_coherence", "overall_consistency")
#: Differences up to this are ties.
TIE = 1e-12


def finite(x: Column) -> Column:
    """True for numbers that are neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))


def loss_summary(losses: DataFrame, *, label: str = "label", loss: str = "loss") -> DataFrame:
    """Seeds, mean, sample deviation (0 for one seed), least and greatest loss per checkpoint. Losses that aren't finite are an error."""
    checked = F.when(finite(F.col(loss)), F.col(loss)).otherwise(F.raise_error(F.lit("loss must be finite")).cast("double"))
    rows = losses.select(F.col(label).alias("label"), checked.alias("_l"))
    return rows.groupBy("label").agg(F.count("*").alias("seed_count"), F.avg("_l").alias("mean_loss"), F.coalesce(F.stddev_samp("_l"), F.lit(0.0)).alias("stdev_loss"), F.min("_l").alias("minimum_loss"), F.max("_l").alias("maximum_loss"))


def unequal_seeds(losses: DataFrame, *, label: str = "label", seed: str = "seed") -> DataFrame:
    """Seeds that not every checkpoint has exactly once."""
    labels = losses.agg(F.count_distinct(label).alias("_n"))
    return losses.groupBy(seed).agg(F.count_distinct(label).alias("labels"), F.count("*").alias("rows")).join(F.broadcast(labels), F.lit(True)).filter("labels <> _n or rows <> _n").drop("_n")


def paired_losses(losses: DataFrame, *, label: str = "label", seed: str = "seed", loss: str = "loss") -> DataFrame:
    """Each two checkpoints compared seed by seed: wins, ties and the mean difference.

    The losses of one seed are put into one row, as many as there are checkpoints, and paired there: no join, and the shuffle moves every loss once.
    """
    per_seed = losses.groupBy(F.col(seed).alias("_s")).agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("k"), F.col(loss).alias("v")))).alias("a"))
    pairs = per_seed.select(F.posexplode("a").alias("_i", "l"), "a").select("l", F.explode(F.slice("a", F.col("_i") + 2, F.size("a"))).alias("r"))
    d = F.col("l.v") - F.col("r.v")
    tie = F.abs(d) <= TIE
    out = pairs.groupBy(F.col("l.k").alias("left"), F.col("r.k").alias("right")).agg(F.count("*").alias("seed_count"), F.count_if(~tie & (d < 0)).alias("left_wins"), F.count_if(~tie & (d > 0)).alias("right_wins"), F.count_if(tie).alias("ties"), F.avg(d).alias("_m"))
    return out.withColumn("mean_loss_difference", F.when(F.abs("_m") <= TIE, 0.0).otherwise(F.col("_m"))).drop("_m")


def sample_reviews(generations: DataFrame, per_checkpoint: int, seed: int, batch: int = 20, *, checkpoint: str = "checkpoint_label", id_: str = "generation_id") -> DataFrame:
    """A blinded sample: ``per_checkpoint`` generations of each checkpoint by a seeded hash, shuffled over all, numbered ``review-0001`` on and dealt into
    batches. What reviewers see is ``review_id, prompt, text``; the other columns are the key. A checkpoint with too few generations is an error.

    Sampling takes a top list per checkpoint before anything is moved to one place; the review, numbered in one partition, is as large as was asked for.
    """
    if per_checkpoint < 1 or batch < 1:
        raise ValueError("sizes must be positive")
    draw = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(checkpoint).cast("string"), F.col(id_).cast("string")), 256)
    over = Window.partitionBy(checkpoint)
    ranked = generations.withColumn("_k", draw).withColumn("_r", F.row_number().over(over.orderBy("_k"))).filter(F.col("_r") <= per_checkpoint)
    short = F.raise_error(F.concat(F.lit("too few generations: "), F.col(checkpoint).cast("string"))).cast("boolean")
    ranked = ranked.withColumn("_c", F.count("*").over(over)).filter(F.when(F.col("_c") < per_checkpoint, short).otherwise(True)).drop("_c")
    number = F.row_number().over(Window.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_k")), 256)))
    out = ranked.withColumn("_n", number)
    return out.withColumn("review_id", F.format_string("review-%04d", "_n")).withColumn("batch", F.floor((F.col("_n") - 1) / batch).cast("int")).drop("_k", "_r", "_n")


def judgment_errors(judgments: DataFrame, expected: DataFrame, allowed_flags: list[str]) -> DataFrame:
    """(review_id, error) of judgments that break a rule, and of reviews that are missing: scores outside 0 to 2, flags unknown, repeated or beside ``none``, texts empty or
    above 500 characters, ids unknown or repeated. No rows: all is well."""
    flags = F.col("flags")
    rules = [
        *[F.when(~F.coalesce(F.col(s).isin(0, 1, 2), F.lit(False)), f"{s} must be 0, 1 or 2") for s in SCORES],
        F.when(flags.isNull() | F.exists(flags, lambda x: x.isNull()), "flags must be a list of strings"),
        F.when(F.size(F.array_distinct(flags)) < F.size(flags), "flags must not repeat"),
        F.when(F.size(F.array_except(flags, F.array(*[F.lit(f) for f in allowed_flags]))) > 0, "unknown flag"),
        F.when(F.array_contains(flags, "none") & (F.size(flags) > 1), "none stands alone"),
        *[F.when(~F.coalesce(F.length(F.trim(F.col(c))).between(1, 500), F.lit(False)), f"{c} must have 1 to 500 characters") for c in ("evidence", "reason")],
    ]
    broken = judgments.select("review_id", F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("error"))
    ids = judgments.groupBy("review_id").agg(F.count("*").alias("_n")).join(expected.select(F.col("review_id").alias("_e")).distinct(), F.col("review_id") == F.col("_e"), "full_outer")
    state = F.when(F.col("_e").isNull(), "unknown review").when(F.col("_n").isNull(), "missing review").when(F.col("_n") > 1, "repeated review")
    return broken.unionByName(ids.select(F.coalesce("review_id", "_e").alias("review_id"), state.alias("error")).filter("error is not null"))


def judgment_scores(judgments: DataFrame, key: DataFrame, *, label: str = "checkpoint_label") -> DataFrame:
    """Per checkpoint: reviews, and of every score the mean and how often 0, 1 and 2 were given."""
    rows = judgments.join(key.select("review_id", label), "review_id")
    aggs = [F.count("*").alias("story_count")]
    for s in [c for c in SCORES if c in judgments.columns]:
        aggs += [F.avg(s).alias(f"mean_{s}"), *[F.count_if(F.col(s) == v).alias(f"{s}_{v}") for v in (0, 1, 2)]]
    return rows.groupBy(label).agg(*aggs)


def flag_counts(judgments: DataFrame, key: DataFrame, *, label: str = "checkpoint_label") -> DataFrame:
    """How often each flag other than ``none`` was given to a checkpoint."""
    return judgments.join(key.select("review_id", label), "review_id").select(label, F.explode("flags").alias("flag")).filter("flag <> 'none'").groupBy(label, "flag").agg(F.count("*").alias("flagged"))


def predictions(scored: DataFrame, losses: str = "losses", answer: str = "answer_index") -> DataFrame:
    """Adds the choice of least loss (the first of equals) and whether it is the answer."""
    best = (F.array_position(losses, F.array_min(losses)) - 1).cast("int")
    return scored.withColumn("prediction_index", best).withColumn("correct", best == F.col(answer))


def choice_accuracy(predicted: DataFrame, category: str = "category") -> DataFrame:
    """Totals, hits and accuracy per category and over all (category null, ``overall`` true)."""
    out = predicted.rollup(category).agg(F.grouping(category).alias("_g"), F.count("*").alias("total"), F.count_if("correct").alias("correct"))
    return out.select(F.col(category), (F.col("_g") == 1).alias("overall"), "total", "correct", F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(0.0).alias("accuracy"))


def convert_benchmark(rows: DataFrame, dataset: str, config: str, index: str = "row_index") -> DataFrame:
    """Benchmark rows as multiple-choice items: trimmed question and choices, answer as index, category from the first field that has one.

    Adds ``problem``: null, or why a row can't be used (``no question``, ``too few choices``, ``empty choice``, ``bad answer``), so that callers keep or report them.
    """
    choices = F.transform("choices", lambda c: F.trim(c.cast("string")))
    question = F.trim(F.col("question").cast("string"))
    named = [F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in ("category", "subject", "task_name", "difficulty") if c in rows.columns]
    answer = answer_index(F.col("answer").cast("string"), choices)
    problem = (
        F.when(question.isNull() | (question == ""), "no question")
        .when(F.coalesce(F.size(choices), F.lit(0)) < 2, "too few choices")
        .when(F.exists(choices, lambda c: c.isNull() | (c == "")), "empty choice")
        .when(answer.isNull(), "bad answer")
    )
    return rows.select(
        F.concat_ws("/", F.lit(dataset), F.lit(config), F.col(index).cast("string")).alias("id"), question.alias("prompt"), choices.alias("choices"), answer.alias("answer"),
        F.coalesce(*named, F.lit(config)).alias("category"), F.lit(config).alias("config"), F.col(index).alias("source_index"), problem.alias("problem"),
    )


def conversion_counts(converted: DataFrame) -> DataFrame:
    """Examples kept and rows skipped, per configuration."""
    return converted.groupBy("config").agg(F.count_if(F.col("problem").isNull()).alias("examples"), F.count_if(F.col("problem").isNotNull()).alias("skipped"))


def asset_problems(items: DataFrame, categories: list[str], *, id_: str = "id", category: str = "category") -> DataFrame:
    """(id, problem) of ids and contents that repeat, ids that don't begin with their category, unknown categories, and, with a null id, categories without an item.
    Contents are looked at where there are ``prompt`` and ``choices``."""
    repeated = items.groupBy(id_).count().filter("count > 1").select(F.col(id_).alias("id"), F.lit("repeated id").alias("problem"))
    rules = F.array(F.when(~F.coalesce(F.col(category).isin(categories), F.lit(False)), "unknown category"), F.when(~F.coalesce(F.startswith(F.col(id_), F.col(category)), F.lit(False)), "id doesn't begin with its category"))
    broken = items.select(F.col(id_).alias("id"), F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("problem"))
    wanted = items.sparkSession.createDataFrame([(c,) for c in categories], "_wanted string")  # a handful
    absent = wanted.join(items.select(F.col(category).alias("_wanted")).distinct(), "_wanted", "left_anti").select(F.lit(None).cast("string").alias("id"), F.concat(F.lit("no item of the category "), "_wanted").alias("problem"))
    out = repeated.unionByName(broken).unionByName(absent)
    if {"prompt", "choices"} <= set(items.columns):
        same = items.groupBy("prompt", "choices").agg(F.count("*").alias("_n"), F.min(id_).alias("id")).filter("_n > 1").select("id", F.lit("repeated prompt and choices").alias("problem"))
        blank = items.filter((F.trim(F.coalesce("prompt", F.lit(""))) == "") | F.coalesce(F.exists("choices", lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""), F.lit(True)))
        out = out.unionByName(same).unionByName(blank.select(F.col(id_).alias("id"), F.lit("empty prompt or choice").alias("problem")))
    return out


def check_results(results: DataFrame, claimed: DataFrame, category: str = "category", tolerance: float = TIE) -> DataFrame:
    """Claimed totals and accuracies against those recomputed from single results: rows that differ."""
    ours = choice_accuracy(results.withColumn("correct", F.col("answer_index") == F.col("prediction_index")), category).filter("not overall").select(F.col(category).alias("_c"), F.col("total").alias("_t"), F.col("correct").alias("_k"), F.col("accuracy").alias("_a"))
    both = claimed.join(ours, F.col(category).eqNullSafe(F.col("_c")), "full_outer")
    same = (F.col("total") == F.col("_t")) & (F.col("correct") == F.col("_k")) & (F.abs(F.col("accuracy") - F.col("_a")) <= tolerance)
    return both.filter(~F.coalesce(same, F.lit(False)))


def compare_roles(baseline: DataFrame, candidate: DataFrame, role: str = "role", tokens: str = "tokens") -> DataFrame:
    """Tokens of two tokenizers by role, and the share that the candidate saves; roles of either side appear, null where one is missing."""
    b = baseline.select(role, F.col(tokens).alias("baseline_tokens"))
    return b.join(candidate.select(role, F.col(tokens).alias("candidate_tokens")), role, "full_outer").withColumn("improvement", (F.col("baseline_tokens") - F.col("candidate_tokens")) / F.col("baseline_tokens"))
