import hashlib
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers, trainers

from corpusloom.operators import aggregates as A
from corpusloom.operators import audits, evaluation, filters, quota, records, runs, windows
from corpusloom.operators import tokens as T
from corpusloom.plans import pipelines


def test_quality_reasons(spark):
    rows = [(0, "A good document"), (1, "A good document"), (2, "short"), (3, "has the benchmark answer phrase in it"), (4, "Has the BENCHMARK answer phrase in it"), (5, None)]
    df = spark.createDataFrame(rows, "row_index long, text string")
    out = pipelines.single_dataset(df, "d", "train", filters.QualityPolicy(min_chars=10), filters.fold_patterns(["Benchmark answer phrase", " "]))
    got = {r.row_index: r.reason for r in out.collect()}
    assert got == {0: None, 1: "duplicate_exact", 2: "too_short", 3: "benchmark_contamination", 4: "benchmark_contamination"}
    report = {r.reason: (r.documents, r.total) for r in filters.quality_report(out).collect()}
    assert report["accepted"] == (1, 5) and report["benchmark_contamination"] == (2, 5)
    off = pipelines.single_dataset(df, "d", "train", filters.QualityPolicy(enabled=False), ["x"])
    assert off.filter("reason is not null").count() == 0


def test_contamination_ways_agree(spark):
    patterns = filters.fold_patterns(["rrc connection", "connection", "o-ran", "café"])
    texts = ["RRC Connection setup", "an O-RAN unit", "le CAFÉ", "nothing", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    a = {r.i: r.contaminated for r in filters.contains_any(df, "text", patterns).collect()}
    b = {r.i: r.contaminated for r in filters.contains_any_join(df, "i", F.lower("text"), spark.createDataFrame([(p,) for p in patterns], "pattern string")).collect()}
    assert a == b == {0: True, 1: True, 2: True, 3: False, 4: False, 5: False}
    assert filters.contains_any(df, "text", []).filter("contaminated").count() == 0
    assert filters.pattern_fingerprint(["b", "a", "a"]) == filters.pattern_fingerprint(["a", "b"]) != filters.pattern_fingerprint(["b", "a", "a"], ordered=True)


def test_first_copies_and_unseen(spark):
    df = spark.createDataFrame([(3, "x", "c"), (1, "x", "a"), (2, "y", "b")], "p long, h string, v string")
    assert sorted(map(tuple, filters.first_copies(df, "h", "p").collect())) == [(1, "x", "a"), (2, "y", "b")]
    assert filters.unseen(df, spark.createDataFrame([("x",), ("x",)], "h string"), "h").count() == 1


def test_prefix_sums_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice("aab"), rng.choice([None, *range(9)])) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, g string, n long").repartition(7)
    got = {r.i: (r.s, r.k) for r in windows.prefix_sums(df, ["i"], {"s": F.col("n"), "k": F.lit(1)}, ["g"]).collect()}
    seen, count = Counter(), Counter()
    for i, g, n in rows:
        assert got[i] == (seen[g], count[g])
        seen[g] += n or 0
        count[g] += 1
    assert windows.prefix_sums(df.limit(0), ["i"], {"s": F.col("n")}).count() == 0


def test_count_windows_with_blanks(spark):
    df = spark.createDataFrame([(i, "s", "" if i in (1, 4) else "x") for i in range(6)], "row_index long, source_id string, text string")
    got = windows.count_windows(df, 2, kept=F.col("text") != "")
    ends = sorted({(r.window, r.next_cursor) for r in got.filter("text <> ''").collect()})
    assert ends == [(0, 3), (1, 6)]


def test_shuffled_windows_depend_on_the_seed(spark):
    df = spark.createDataFrame([(i, "s", f"d{i}", hashlib.sha256(str(i).encode()).hexdigest()) for i in range(20)], "row_index long, source_id string, document_id string, content_sha256 string")
    order = lambda seed: [r.row_index for r in windows.shuffled_windows(df, 5, seed).orderBy("window", "order_key").collect()]
    a, b = order(42), order(43)
    assert a != b and sorted(a) == sorted(b) and {x // 5 for x in a[:5]} == {0}


def sequential(rows, quotas):
    """Rows in order, one at a time: what the fixed point must give."""
    counts, seen, out = Counter(), set(), {}
    for r in sorted(rows, key=lambda r: r["pos"]):
        item = r["item_id"]
        if counts[item] >= quotas[item]:
            out[r["pos"]] = "over_quota"
        elif r["reason"]:
            out[r["pos"]] = r["reason"]
        elif r["content_sha256"] in seen:
            out[r["pos"]] = "duplicate_exact"
        else:
            seen.add(r["content_sha256"])
            out[r["pos"]] = "holdout" if r["holdout"] else "train"
            counts[item] += 0 if r["holdout"] else r["tokens"]
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_quota_fill_is_the_sequential_loop(spark, seed):
    rng = random.Random(seed)
    rows = [dict(pos=i, item_id=rng.choice(["a/x", "a/y", "b"]), tokens=rng.randint(1, 9), content_sha256=str(rng.randint(0, 60)), holdout=rng.random() < 0.2, reason="too_short" if rng.random() < 0.1 else None) for i in range(150)]
    quotas = {"a/x": 60, "a/y": 40, "b": 90}
    df = spark.createDataFrame(rows, "pos long, item_id string, tokens long, content_sha256 string, holdout boolean, reason string")
    plan = spark.createDataFrame(list(quotas.items()), "item_id string, token_quota long")
    got = {r.pos: r.disposition for r in quota.fill_quotas(df, plan, ["pos"]).collect()}
    assert got == sequential(rows, quotas)


def test_quota_errors(spark):
    df = spark.createDataFrame([(0, "a", 5, "h", False, None)], "pos long, item_id string, tokens long, content_sha256 string, holdout boolean, reason string")
    plan = spark.createDataFrame([("b", 10)], "item_id string, token_quota long")
    with pytest.raises(Exception, match="no quota for item a"):
        quota.fill_quotas(df, plan, ["pos"]).collect()
    plan = spark.createDataFrame([("a", 10), ("b", 3)], "item_id string, token_quota long")
    stats = quota.item_statistics(quota.fill_quotas(df, plan, ["pos"]), plan)
    assert {r.item_id: r.quota_tokens for r in stats.collect()} == {"a": 5, "b": 0}
    with pytest.raises(ValueError, match="a=5/10, b=0/3"):
        quota.require_filled(stats)


def test_quota_audit_goldens(spark):
    rows = [("m", "tiny", 0, 8), ("m", "tiny", 1, 8), ("m", "bulk", 2, 990)]
    df = spark.createDataFrame(rows, "stage string, item_id string, p long, tokens long")
    plan = spark.createDataFrame([("m", "tiny", 10), ("m", "bulk", 990)], "stage string, item_id string, token_quota long")
    got = {r.item_id: r for r in quota.audit_quotas(df, plan, 0.03, ["p"]).collect()}
    assert got["tiny"].relative_variance == 0.6 and got["tiny"].boundary_limited and got["tiny"].passed
    assert got[None].relative_variance == pytest.approx(0.006) and got[None].passed
    canonical = {r.item_id: r.passed for r in quota.audit_quotas(df.filter("p <> 1"), plan, 0.9, ["p"], canonical=True).collect()}
    assert canonical == {"tiny": False, "bulk": True, None: False}
    with pytest.raises(Exception, match="unplanned item"):
        quota.audit_quotas(df, plan.filter("item_id = 'bulk'"), 0.1, ["p"]).collect()


def test_quantile_higher(spark):
    import numpy as np

    values = [1, 1, 1, 5, 9, 9, 12, 30]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    got = A.quantile_higher(df, "v", {"a": 0.5, "b": 0.95, "c": 0.0, "d": 1.0}).first()
    assert (got.a, got.b, got.c, got.d) == tuple(int(np.quantile(values, q, method="higher")) for q in (0.5, 0.95, 0, 1))


def test_shard_goldens(spark):
    df = spark.createDataFrame([(0, [2, 3]), (1, [2, 3, 3]), (2, None)], "i long, ids array<int>")
    got = T.build_shards(df, ["i"], 4, eos_id=1).orderBy("shard_index").collect()
    assert [r.ids for r in got] == [[2, 3, 1, 2], [3, 3, 1, 1]]
    assert bytes(got[0].payload) == b"\x02\x00\x03\x00\x01\x00\x02\x00" and got[0].byte_size == 8
    two = T.build_shards(spark.createDataFrame([(0, [2, 3]), (1, [3, 2])], "i long, ids array<int>"), ["i"], 4, eos_id=1)
    assert two.orderBy("shard_index").first().ids == [2, 3, 1, 3]
    audit = T.shard_audit(T.build_shards(df, ["i"], 4, eos_id=1), 1, vocabulary=4).first()
    assert (audit.shards, audit.total_tokens, audit.eos_tokens, audit.max_id, audit.in_vocabulary) == (2, 8, 3, 3, True)
    with pytest.raises(Exception, match="out of range"):
        T.build_shards(spark.createDataFrame([(0, [70000])], "i long, ids array<int>"), ["i"], 4).collect()
    assert T.bad_ids(df, vocabulary=3).count() == 2


def test_shards_straddle_and_pairs(spark):
    df = spark.createDataFrame([(0, list(range(10, 21)))], "i long, ids array<int>")
    shards = T.build_shards(df, ["i"], 4, eos_id=1)
    assert [r.ids for r in shards.orderBy("shard_index").collect()] == [[10, 11, 12, 13], [14, 15, 16, 17], [18, 19, 20, 1]]
    pairs = [(r.x, r.y) for r in T.next_token_pairs(shards, ["shard_index"]).filter("shard_index = 2").orderBy("position").collect()]
    assert pairs == [(18, 19), (19, 20), (20, 1)]


def test_window_sampler(spark):
    shards = spark.createDataFrame([(0, 100), (1, 1000), (2, 10), (3, 11)], "shard_index long, num_tokens long")
    a = T.sample_windows(shards, 10, 2000, 7).collect()
    assert len(a) == 2000 and {r.shard_index for r in a} == {0, 1}
    assert all(0 <= r.start < {0: 89, 1: 989}[r.shard_index] for r in a)
    assert 0.88 < sum(r.shard_index == 1 for r in a) / 2000 < 0.95
    assert sorted(map(tuple, a)) == sorted(map(tuple, T.sample_windows(shards.repartition(3), 10, 2000, 7).collect()))


def test_tokenizer_round_trip_and_training(spark):
    texts = ["hello hello world", "été 字 \n\n tab\t", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    made = T.train_bpe(df.filter("text is not null"), vocabulary=300, min_count=1)
    assert T.round_trip_failures(df, made).count() == 0
    probes = spark.createDataFrame([("g", "hello world"), ("g", "hello")], "`group` string, text string")
    r = T.fertility(probes, made).first()
    assert (r.text_count, r.words, r.characters) == (2, 3, 16) and r.tokens_per_word == r.tokens / 3
    with pytest.raises(Exception, match="unusable probe"):
        T.fertility(spark.createDataFrame([("g", "  ")], "`group` string, text string"), made).collect()
    pieces = T.pretoken_counts(df).collect()
    assert sum(len(p.piece) * p["count"] for p in pieces) == sum(len(t) for t in texts if t)


def test_training_weighs_pieces_by_full_counts(spark):
    """Counts beyond 65,536 still decide what is merged first; on real counts the merges are those of a trainer that reads every piece."""
    df = spark.createDataFrame([(" ab" * 70000 + " cd" * 80000,)], "text string")
    assert json.loads(T.train_bpe(df, vocabulary=262))["model"]["merges"][0] == ["c", "d"]
    rng = random.Random(2)
    counted = {"".join(rng.choices(" abcdeé字", k=rng.randint(1, 9))): rng.randint(1, 300) for _ in range(400)}
    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    trainer = trainers.BpeTrainer(vocab_size=500, special_tokens=["<x>"], initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False)
    tok.train_from_iterator((p for p, n in counted.items() for _ in range(n)), trainer)
    want = json.loads(tok.to_str())["model"]
    ids, merges = T._merge_pairs(counted.items(), 500, ("<x>",))
    assert ids == want["vocab"] and [list(m) for m in merges] == want["merges"]


def test_paired_losses(spark):
    df = spark.createDataFrame([("170m", 1, 1.7), ("170m", 2, 1.8), ("200m", 1, 1.8), ("200m", 2, 1.7)], "label string, seed long, loss double")
    r = evaluation.paired_losses(df).collect()
    assert len(r) == 1 and (r[0].left, r[0].right, r[0].left_wins, r[0].right_wins, r[0].ties, r[0].mean_loss_difference) == ("170m", "200m", 1, 1, 0, 0.0)
    s = evaluation.loss_summary(df.filter("seed = 1")).collect()
    assert all(x.stdev_loss == 0.0 for x in s)
    assert evaluation.unequal_seeds(df).count() == 0 and evaluation.unequal_seeds(df.limit(3)).count() == 1
    with pytest.raises(Exception, match="finite"):
        evaluation.loss_summary(spark.createDataFrame([("a", float("nan"))], "label string, loss double")).collect()


def test_reviews_and_judgments(spark):
    g = spark.createDataFrame([(c, f"{c}{i}", "p", "t") for c in "ab" for i in range(6)], "checkpoint_label string, generation_id string, prompt string, text string")
    r = evaluation.sample_reviews(g, 4, 1, 3).orderBy("review_id").collect()
    assert [x.review_id for x in r] == [f"review-{i:04d}" for i in range(1, 9)] and Counter(x.batch for x in r) == {0: 3, 1: 3, 2: 2}
    assert Counter(x.checkpoint_label for x in r) == {"a": 4, "b": 4}
    with pytest.raises(Exception, match="too few"):
        evaluation.sample_reviews(g, 7, 1).collect()
    schema = "review_id string, " + ", ".join(f"{s} int" for s in evaluation.SCORES) + ", flags array<string>, evidence string, reason string"
    j = spark.createDataFrame([("r1", 1, 1, 1, 1, ["object_swap"], "e", "r"), ("r2", 3, 1, 1, None, ["none", "x"], "", "r")], schema)
    key = spark.createDataFrame([("r1", "a"), ("r3", "a")], "review_id string, checkpoint_label string")
    errors = evaluation.judgment_errors(j, key, ["object_swap", "none"]).collect()
    assert {(e.review_id, e.error) for e in errors} >= {("r2", "unknown review"), ("r3", "missing review"), ("r2", "unknown flag"), ("r2", "none stands alone"), ("r2", "evidence must have 1 to 500 characters")}
    assert not [e for e in errors if e.review_id == "r1"]
    s = evaluation.judgment_scores(j, key).first()
    assert (s.story_count, s.mean_causal_coherence, s.causal_coherence_0, s.causal_coherence_1, s.causal_coherence_2) == (1, 1.0, 0, 1, 0)
    assert [tuple(x) for x in evaluation.flag_counts(j, key).collect()] == [("a", "object_swap", 1)]


def test_choices(spark):
    df = spark.createDataFrame([("1", "character", 0, [0.1, 0.2]), ("2", "character", 0, [0.3, 0.2]), ("3", "object", 1, [0.5, 0.5])], "id string, category string, answer_index int, losses array<double>")
    p = evaluation.predictions(df)
    got = {r.category: (r.correct, r.total, r.accuracy) for r in evaluation.choice_accuracy(p).collect()}
    assert got == {"character": (1, 2, 0.5), "object": (0, 1, 0.0), None: (1, 3, 1 / 3)}
    claimed = spark.createDataFrame([("character", 2, 1, 0.5), ("object", 1, 1, 1.0)], "category string, total long, correct long, accuracy double")
    assert [r.category for r in evaluation.check_results(p, claimed).collect()] == ["object"]


def test_benchmark_conversion(spark):
    rows = [(7, " Q? ", [" a ", "b"], "B", None, "core"), (8, "", ["a", "b"], "0", "c", None), (9, "Q", ["a"], "0", "c", None), (10, "Q", ["a", " "], "0", "c", None), (11, "Q", ["a", "b"], "7", "c", None)]
    df = spark.createDataFrame(rows, "row_index long, question string, choices array<string>, answer string, category string, subject string")
    got = {r.source_index: r for r in evaluation.convert_benchmark(df, "ds", "cfg").collect()}
    assert (got[7].id, got[7].prompt, got[7].choices, got[7].answer, got[7].category, got[7].problem) == ("ds/cfg/7", "Q?", ["a", "b"], 1, "core", None)
    assert [got[i].problem for i in (8, 9, 10, 11)] == ["no question", "too few choices", "empty choice", "bad answer"]
    assert tuple(evaluation.conversion_counts(evaluation.convert_benchmark(df, "ds", "cfg")).first()) == ("cfg", 1, 4)
    assets = spark.createDataFrame([("a-1", "a"), ("a-1", "a"), ("b-1", "a"), ("c-1", "c")], "id string, category string")
    assert {tuple(r) for r in evaluation.asset_problems(assets, ["a", "b"]).collect()} == {("a-1", "repeated id"), ("b-1", "id doesn't begin with its category"), ("c-1", "unknown category")}


def test_runs(spark):
    df = spark.createDataFrame([("r", i, None if i % 2 else 2.0 - i / 100, 1.0 + i, float(100 - i)) for i in range(30)], "run string, step long, val_loss double, peak_memory_mb double, tokens_per_second double")
    s = runs.run_summary(df.withColumn("train_loss", F.col("val_loss")), ["run"], ["step"]).first()
    assert (s.initial_val_loss, s.best_val_loss, s.final_val_loss, s.max_tokens_per_second) == (2.0, 1.72, 1.72, 100.0)
    p = runs.pilot_review(df, "tokens_per_second", ["run"], ["step"]).first()
    assert (p.head_median, p.tail_median, p.passed) == (97.5, 73.5, False)
    assert runs.always_rising(df, "peak_memory_mb", ["run"], ["step"]).first().always_rising
    t = spark.createDataFrame([(0,), (9,), (10,), (99,)], "tokens_processed long")
    assert [r.phase for r in runs.phase_of(t, [("a", 10), ("b", 20)]).collect()] == ["a", "a", "b", "b"]
    phases = spark.createDataFrame([("b", 20), ("a", 10)], "phase string, until_tokens long")
    assert [r.phase for r in runs.phase_join(t, phases).collect()] == ["a", "a", "b", "b"]
    with pytest.raises(ValueError):
        runs.phase_of(t, [("a", 10), ("b", 10)])


def test_deltas(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 7)], "t long, n long")
    got = windows.counter_deltas(df, ["n"], ["t"]).orderBy("t").collect()
    assert [(r.n_delta, r.backwards) for r in got] == [(5, False), (4, False), (-2, True)]


def test_audits(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, documents long")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 1)], "k string, documents long")
    assert {r.k: r.matches for r in audits.reconcile(a, b, ["k"], ["documents"]).collect()} == {"x": True, "y": False, "z": False}
    m = spark.createDataFrame([("p", 1, "AA"), ("q", 1, "b"), ("r", 1, "c")], "path string, size long, sha256 string")
    f = spark.createDataFrame([("p", 1, "aa"), ("q", 2, "b"), ("s", 1, "c")], "path string, size long, sha256 string")
    assert {r.path: r.state for r in audits.verify_files(m, f).collect()} == {"p": "ok", "q": "size", "r": "missing", "s": "unexpected"}
    units = spark.createDataFrame([("u", True), ("u", None), ("v", None)], "unit_id string, published boolean")
    art = spark.createDataFrame([("u", "b", 5), ("v", "a", 7), ("w", "c", 1)], "unit_id string, relative_path string, size long")
    assert tuple(audits.journal_totals(art, units).first()) == (1, 5, 1, 7, 1)
    assert [r.relative_path for r in audits.unpublished(art, units).collect()] == ["a"]
    got = audits.preflight(spark, [("a", lambda: True), ("b", lambda: False), ("c", lambda: 1 / 0), ("d", lambda: a.limit(0)), ("e", lambda: a.limit(1))]).collect()
    assert [r.status for r in got] == ["pass", "fail", "fail", "pass", "fail"]
    assert audits.projection(100_000_000, 1000.0, 12_000_000_000)["within_limit"]
    r = spark.createDataFrame([(10, 7, 3, {"x": 1, "y": 2}), (10, 7, 3, {"x": 1})], "total long, accepted long, rejected long, reasons map<string,long>")
    assert [x.balanced for x in audits.check_totals(r).collect()] == [True, False]


def test_records(spark):
    src = records.Source("s", "n", document_id_field="identifier", license_field="license", collection_field="collection", token_count_field="token_count", role="pretrain_telecom", buckets=(records.Bucket("b", ("C",), 1.0),))
    rows = spark.createDataFrame([(0, "RFC8202", "C", " MIT ", 710, "  Link-state routing.\r\n"), (1, " ", "C", "MIT", 3, " \n ")], "row_index long, identifier string, collection string, license string, token_count int, text string")
    a, b = records.source_records(rows, src, "main").orderBy("row_index").collect()
    assert (a.id, a.text, a.estimated_tokens, a.license, a.bucket_id) == ("s/main/RFC8202", "Link-state routing.", 710, "MIT", "b") and a.content_sha256 == a.text_sha256
    assert b.reason == "empty_text"
    with pytest.raises(Exception, match="document-level license"):
        records.source_records(rows.withColumn("license", F.lit(" ")), src, "main").collect()
    with pytest.raises(Exception, match="no bucket"):
        records.source_records(rows.withColumn("collection", F.lit("D")), src, "main").collect()
    with pytest.raises(ValueError, match="may not enter"):
        records.source_records(rows, records.Source("s", "n", role="rag_only"), "main")
    one = records.simple_records(spark.createDataFrame([(3, "Hello world", "row-3")], "row_index long, text string, rid string"), "unit", "train", source_id="rid").first()
    assert (one.id, one.num_chars) == ("unit/train/row-3", 11)
    assert [records.detect_text_field(c) for c in (["id", "story", "text"], ["content", "meta"], ["article", "url"], ["only"])] == ["text", "content", "article", "only"]
    with pytest.raises(ValueError):
        records.detect_text_field(["a", "b"])


@pytest.mark.parametrize("rounds, stretch", [(12, 100_000), (2, 50)])
def test_long_chains_of_duplicates_and_quotas_settle(spark, rounds, stretch):
    """Each item's second hash is the next one's first, so every item waits for the one before."""
    rows = []
    for i in range(130):
        for j, digest in enumerate((f"h{i}", f"h{i + 1}")):
            rows.append({"pos": 2 * i + j, "item_id": f"i{i:03d}", "tokens": 1, "content_sha256": digest, "holdout": False, "reason": None})
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "pos long, item_id string, tokens long, content_sha256 string, holdout boolean, reason string")
    quotas = {r["item_id"]: 1 for r in rows}
    plan = spark.createDataFrame(list(quotas.items()), "item_id string, token_quota long")
    got = {r.pos: r.disposition for r in quota.fill_quotas(df, plan, ["pos"], parallel_rounds=rounds, stretch=stretch).collect()}
    assert got == sequential(rows, quotas)
