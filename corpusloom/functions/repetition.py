"""Repetition statistics of generated texts."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of figures, and what words and sentences are.
#: The rates that are averaged over a set of texts.
RATES = ("repeated_3gram_rate", "repeated_4gram_rate", "duplicate_sentence_rate", "distinct_2gram_ratio", "distinct_3gram_ratio")


_WORD = re.compile(r"[a-z0-9]+(?:'[a-z0-9]+)?", re.IGNORECASE)
_SENTENCE = re.compile(r"[^.!?]+[.!?]?")
_FIELDS = (
    "word_count", "sentence_count", "consecutive_duplicate_words", "total_3grams", "repeated_3gram_occurrences", "repeated_3gram_rate", "total_4grams", "repeated_4gram_occurrences", "repeated_4gram_rate",
    "duplicate_sentence_occurrences", "duplicate_sentence_rate", "distinct_2gram_ratio", "distinct_3gram_ratio",
)
_SCHEMA = T.StructType([T.StructField(f, T.DoubleType() if f in RATES else T.IntegerType()) for f in _FIELDS])


def figures(text: str | None) -> tuple:
    """The thirteen figures of a text, in the order of the columns; all 0 for a null or empty one."""
    words = [w.lower() for w in _WORD.findall(text or "")]
    sentences = [s for s in (" ".join(_WORD.findall(x.lower())) for x in _SENTENCE.findall(text or "")) if s]
    total, distinct = {}, {}
    for n in (2, 3, 4):
        total[n] = max(0, len(words) - n + 1)
        distinct[n] = len(set(zip(*(words[i:] for i in range(n)))))
    share = lambda part, whole: part / whole if whole else 0.0
    twice = len(sentences) - len(set(sentences))
    return (
        len(words), len(sentences), sum(map(str.__eq__, words, words[1:])), total[3], total[3] - distinct[3], share(total[3] - distinct[3], total[3]), total[4], total[4] - distinct[4], share(total[4] - distinct[4], total[4]),
        twice, share(twice, len(sentences)), share(distinct[2], total[2]), share(distinct[3], total[3]),
    )


@F.arrow_udf(_SCHEMA)
def _figures_udf(column: pa.Array) -> pa.Array:
    columns = list(zip(*map(figures, column.to_pylist()))) or [[]] * len(_FIELDS)
    return pa.StructArray.from_arrays([pa.array(c, pa.float64() if f in RATES else pa.int32()) for f, c in zip(_FIELDS, columns)], list(_FIELDS))


_figures_udf = _figures_udf.asNondeterministic()


def measure_repetition(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds thirteen figures of repetition to every row; all are 0 for a null or empty text.

    One pass over Arrow batches: the same as array functions (see :func:`corpusloom.functions.text.ngrams`) takes eight times as long, since lambdas over arrays aren't compiled.
    """
    return df.withColumn("_f", _figures_udf(F.col(text))).select("*", "_f.*").drop("_f")


def aggregate_repetition(measured: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Texts and mean rates, per group or over all; 0 without texts."""
    return measured.groupBy(*(by or [])).agg(F.count("*").alias("story_count"), *[F.coalesce(F.avg(r), F.lit(0.0)).alias(f"mean_{r}") for r in RATES])


def summarize_generations(measured: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Number of texts and words, and mean rates."""
    words = F.col("word_count")
    return measured.groupBy(*(by or [])).agg(
        F.count("*").alias("generation_count"),
        F.coalesce(F.min(words), F.lit(0)).alias("minimum_word_count"),
        F.coalesce(F.avg(words), F.lit(0.0)).alias("mean_word_count"),
        F.coalesce(F.max(words), F.lit(0)).alias("maximum_word_count"),
        *[F.coalesce(F.avg(r), F.lit(0.0)).alias(f"mean_{r}") for r in RATES],
    )
