"""Text functions: normalization, case folding, words, sentences and n-grams, as Columns and as plain Python."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control characters that are removed, and runs of blank lines.
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_BLANK_RUN = re.compile(r"\n{3,}")


def nfkc(text: str) -> str:
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


def tidy(text: str) -> str:
    """The steps of normalization after NFKC."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = "\n".join(map(str.rstrip, _CONTROL.sub("", text).split("\n"))).strip()
    return _BLANK_RUN.sub("\n\n", text) if "\n\n\n" in text else text


def normalize(text: str) -> str:
    """NFKC, one kind of line end, no control characters, no white space at line ends or around the text, at most one blank line in a row."""
    return tidy(nfkc(text))


def _texts(f):
    """A column function from a function of a text, over Arrow batches. Marked non-deterministic, so that the planner never evaluates it twice for a filter and a projection."""

    @F.arrow_udf(T.StringType())
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else f(t) for t in column.to_pylist()], pa.string())

    return run.asNondeterministic()


_NORMAL = T.StructType([T.StructField("text", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("chars", T.LongType())])


@F.arrow_udf(_NORMAL)
def _normal_udf(column: pa.Array) -> pa.Array:
    out = [None if t is None else normalize(t) for t in column.to_pylist()]
    shas = [None if t is None else hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in out]
    sizes = [None if t is None else len(t) for t in out]
    return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(shas, pa.string()), pa.array(sizes, pa.int64())], ["text", "sha256", "chars"])


_nfkc_udf, _normalize_udf, _casefold_udf = _texts(nfkc), _texts(normalize), _texts(str.casefold)
_normal_udf = _normal_udf.asNondeterministic()


def nfkc_col(text: Column) -> Column:
    """:func:`nfkc` as a Column."""
    return _nfkc_udf(text)


def normalize_col(text: Column, already_nfkc: bool = False) -> Column:
    """:func:`normalize` as a Column. Spark has no NFKC, so it is a pass over Arrow batches; texts known to be NFKC stay in the JVM."""
    if not already_nfkc:
        return _normalize_udf(text)
    t = F.regexp_replace(text, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    t = F.regexp_replace(t, r"(?U)[\s&&[^\n]]+(?=\n|\z)", "")
    t = F.regexp_replace(t, r"(?U)\A\s+|\s+\z", "")
    return F.regexp_replace(t, r"\n{3,}", "\n\n")


def normal_form(text: Column, already_nfkc: bool = False) -> Column:
    """A struct of the normalized ``text``, its hex ``sha256`` and its ``chars``; nulls for a null text. One evaluation gives all three."""
    if not already_nfkc:
        return _normal_udf(text)
    t = normalize_col(text, True)
    return F.struct(t.alias("text"), F.sha2(t.cast("binary"), 256).alias("sha256"), F.length(t).cast("long").alias("chars"))


def casefold_col(text: Column, full: bool = True) -> Column:
    """Unicode case folding. ``full=False`` folds in the JVM: lower case with sharp s as ss, which is the same for the Western languages."""
    return _casefold_udf(text) if full else F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def word_tokens(text: Column) -> Column:
    """Words with inner hyphens, dots and slashes, as used for tokens per word."""
    return F.regexp_extract_all(text, F.lit(r"([\p{L}\p{N}_]+(?:[-./][\p{L}\p{N}_]+)*)"), F.lit(1))


def story_words(text: Column) -> Column:
    """Lower-case ASCII words with an optional apostrophe part, as used for repetition."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+(?:'[a-z0-9]+)?)"), F.lit(1))


def story_sentences(text: Column) -> Column:
    """Sentences as their words joined by blanks; sentences without a word are left out."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"([^.!?]+[.!?]?)"), F.lit(1))
    return F.filter(F.transform(parts, lambda s: F.array_join(story_words(s), " ")), lambda s: s != "")


def ngrams(words: Column, n: int) -> Column:
    """Runs of ``n`` words, each joined by blanks (arrays of strings are compared by hash, arrays of arrays one by one); empty where there are fewer words."""
    joined = lambda i: F.array_join(F.slice(words, i, n), " ")
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), joined)).otherwise(F.array().cast("array<string>"))


def extra_occurrences(items: Column) -> Column:
    """How many entries of an array repeat an earlier one."""
    return F.size(items) - F.size(F.array_distinct(items))
