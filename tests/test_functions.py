import hashlib
import math
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import hashing as H
from corpusloom.functions import repetition as R
from corpusloom.functions import scalars as S
from corpusloom.functions.text import casefold_col, extra_occurrences, ngrams, normal_form, normalize, normalize_col, story_sentences, story_words, word_tokens


def plain_normalize(t):
    t = unicodedata.normalize("NFKC", t).replace("\r\n", "\n").replace("\r", "\n")
    t = "".join(c for c in t if c in "\t\n" or not (ord(c) < 32 or ord(c) == 127))
    t = "\n".join(line.rstrip() for line in t.split("\n")).strip()
    while "\n\n\n" in t:
        t = t.replace("\n\n\n", "\n\n")
    return t


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a\n\r \t\x00\x0b\x85\xa0\x1cＡé﻿ﬁ字。", max_size=30))
def test_normalize_is_the_plain_statement(text):
    assert normalize(text) == plain_normalize(text)


def test_normalize_golden(spark):
    raw = "Ａ token\r\n\r\n\r\ncontains\u0000 text.\n\nSecond paragraph.\t"
    want = "A token\n\ncontains text.\n\nSecond paragraph."
    assert normalize(raw) == want
    texts = [raw, "", None, "  x \n\n\n\n y\t\n", "½ ﬁ ，", "á", "﻿ x"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(normalize_col(F.col("t"))).collect()]
    assert got == [None if t is None else normalize(t) for t in texts]


def test_casefold(spark):
    df = spark.createDataFrame([("Straße İX",), (None,)], "t string")
    assert [r[0] for r in df.select(casefold_col(F.col("t"))).collect()] == ["Straße İX".casefold(), None]
    assert df.select(casefold_col(F.col("t"), full=False)).first()[0].startswith("strasse")


def test_words(spark):
    df = spark.createDataFrame([("RFC-8202 a/b.c, d_e ½",)], "t string")
    assert df.select(word_tokens(F.col("t"))).first()[0] == ["RFC-8202", "a/b.c", "d_e", "½"]


def test_hash_fraction_and_splits(spark):
    df = spark.createDataFrame([("0" * 64,), ("f" * 64,), ("1999999999999999" + "0" * 48,)], "h string")
    rows = df.select(H.hash_fraction(F.col("h")).alias("a"), H.hash_split(F.col("h"), 0.1).alias("s"), H.hash_split(F.col("h"), 0.0).alias("z")).collect()
    assert [r.a for r in rows] == [0.0, 1.0, int("1999999999999999", 16) / float(16**16 - 1)]
    assert [r.s for r in rows] == ["validation", "train", "train"] and {r.z for r in rows} == {"train"}


def test_digests(spark):
    values = [f"v{i}" for i in range(20)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "p long, v string").repartition(5)
    got = df.agg(H.ordered_digest(F.col("p"), F.col("v")).alias("o"), H.chained_digest(F.col("p"), F.col("v")).alias("c")).first()
    assert got.o == hashlib.sha256("".join(values).encode()).hexdigest()
    d = "0" * 64
    for v in values:
        d = hashlib.sha256(bytes.fromhex(d) + v.encode()).hexdigest()
    assert got.c == d
    a, b = (H.block_digest(df.withColumn("g", F.lit(1)).repartition(n), ["g"], "p", "v", 3).first() for n in (2, 7))
    assert a == b and a.documents == 20


def test_json_hash():
    assert H.json_sha256({"b": 1, "a": "é"}) == hashlib.sha256('{"a":"é","b":1}'.encode()).hexdigest()


def test_repetition_golden(spark):
    texts = ["Go go home. The little dog ran home. The little dog ran home!", "", None, "A cat ran.", "A cat. A cat."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    a, b, c, *rest = R.measure_repetition(df).orderBy("i").collect()
    assert (a.word_count, a.sentence_count, a.consecutive_duplicate_words) == (13, 3, 1)
    assert (a.repeated_3gram_occurrences, a.repeated_3gram_rate) == (4, 4 / 11)
    assert (a.repeated_4gram_occurrences, a.repeated_4gram_rate) == (3, 3 / 10)
    assert (a.duplicate_sentence_occurrences, a.duplicate_sentence_rate) == (1, 1 / 3)
    assert all(v == 0 for x in (b, c) for k, v in x.asDict().items() if k not in ("i", "text"))
    two = R.measure_repetition(df.filter("i >= 3"))
    assert R.aggregate_repetition(two).first().mean_duplicate_sentence_rate == 0.25
    s = R.summarize_generations(two).first()
    assert (s.minimum_word_count, s.mean_word_count, s.maximum_word_count) == (3, 3.5, 4)
    assert R.summarize_generations(two.limit(0)).first().mean_word_count == 0.0


def test_repetition_as_array_functions(spark):
    texts = ["Go go home. The little dog ran home. The little dog ran home!", "", "a b a b a b", "it's one, it's one? it's one!"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    w = story_words(F.col("text"))
    by_arrays = df.select(F.size(w), F.size(ngrams(w, 3)), extra_occurrences(ngrams(w, 3)), extra_occurrences(ngrams(w, 4)), extra_occurrences(story_sentences(F.col("text"))))
    by_pass = R.measure_repetition(df).select("word_count", "total_3grams", "repeated_3gram_occurrences", "repeated_4gram_occurrences", "duplicate_sentence_occurrences")
    assert by_arrays.collect() == by_pass.collect()


def test_normal_form_gives_all_three(spark):
    df = spark.createDataFrame([("Ａ \r\n",), (None,), ("",)], "t string")
    for known in (False, True):
        a, b, c = [r[0] for r in df.select(normal_form(F.col("t"), known)).collect()]
        want = "Ａ" if known else "A"
        assert (a.text, a.sha256, a.chars) == (want, hashlib.sha256(want.encode()).hexdigest(), 1) and b.text is None and c.chars == 0


def test_scalars(spark):
    df = spark.createDataFrame([("B", ["x", "y"]), ("0", ["x", "y"]), ("yes", ["no", "yes"]), ("C", ["x", "y"]), ("q z", ["x", "y"]), (" 1 ", ["x", "y"])], "a string, c array<string>")
    assert [r[0] for r in df.select(S.answer_index(F.col("a"), F.col("c"))).collect()] == [1, 0, 1, None, None, 1]
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(S.token_estimate(F.lit("abcde"))) == 2 and get(S.token_estimate(F.lit(""))) == 1
    assert get(S.token_estimate(F.lit("abcde"), F.lit(710))) == 710
    with pytest.raises(Exception, match="at least 1"):
        get(S.token_estimate(F.lit("x"), F.lit(0)))
    assert get(S.document_id(F.lit("  "), F.lit("h"))) == "h" and get(S.item_id(F.lit("s"), F.lit(None))) == "s" and get(S.item_id(F.lit("s"), F.lit("b"))) == "s/b"
    assert get(S.perplexity(F.lit(100.0))) == pytest.approx(math.exp(50))
    assert get(S.learning_rate(F.lit(5), 10, 100, 1.0, 0.1)) == 0.5 and get(S.learning_rate(F.lit(100), 10, 100, 1.0, 0.1)) == 0.1
    assert get(S.learning_rate(F.lit(55), 10, 100, 1.0, 0.1)) == pytest.approx(0.55)
    assert get(S.size_label(F.lit("run-170m"))) == 170_000_000 and get(S.size_label(F.lit("run"))) is None
    assert get(S.improvement(F.lit(10000), F.lit(9850))) == pytest.approx(0.015)
    assert S.training_schedule(2, 4, 8, 1000, 0.1) == {"tokens_per_step": 64, "total_steps": 16, "warmup_steps": 1, "stop_step": 16}
    assert S.parse_seeds("1, 2") == [1, 2] and S.parse_labels(["a=/x"]) == {"a": "/x"}
    for bad in ("", "1,1"):
        with pytest.raises(ValueError):
            S.parse_seeds(bad)
