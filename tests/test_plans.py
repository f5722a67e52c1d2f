from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import quota
from corpusloom.operators.filters import QualityPolicy
from corpusloom.operators.records import Bucket, Source
from corpusloom.plans import mixture as M
from corpusloom.plans import pipelines
from corpusloom.sources import readers
from corpusloom.streaming import incremental


def test_allocation_goldens(spark):
    for weights in ({"a": 1, "b": 1, "c": 1}, {"c": 1, "b": 1, "a": 1}):
        assert M.allocate(11, weights) == {"a": 4, "b": 4, "c": 3}
    for total, weights in ((0, {"a": 1}), (5, {}), (5, {"a": 0}), (5, {"a": -1}), (5, {"a": float("inf")})):
        with pytest.raises(ValueError):
            M.allocate(total, weights)
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0)], "item_id string, weight double")
    assert {r.item_id: r.token_quota for r in quota.largest_remainder(df, 11).collect()} == {"a": 4, "b": 4, "c": 3}
    assert M.cap_bucket({"p": 9, "x": 50, "y": 50}, "p", Decimal("0.08"), 100) == {"p": 8, "x": 51, "y": 50}


SOURCES = {
    "g1": Source("g1", "g1"),
    "g2": Source("g2", "g2"),
    "t": Source("t", "t", role="pretrain_telecom", collection_field="collection", buckets=(Bucket("b1", ("c1",), 0.6), Bucket("b2", ("c2",), 0.4))),
}
MIXTURE = {"seed": 42, "quota_tolerance": 0.5, "validation_fraction": 0.2, "buffer_size": 4, "stages": {s: {"total_tokens": 300, "role_weights": {"pretrain_general": 0.5, "pretrain_telecom": 0.5}, "source_weights": {"g1": 2, "g2": 1, "t": 1}} for s in ("pilot", "main")}}


def test_mixture_plan():
    plan = M.mixture_plan(SOURCES.values(), MIXTURE, "main")
    assert {i["id"]: i["token_quota"] for i in plan["items"]} == {"g1": 100, "g2": 50, "t/b1": 90, "t/b2": 60}
    assert plan["role_quotas"] == {"pretrain_general": 150, "pretrain_telecom": 150} and len(plan["plan_sha256"]) == 64
    assert M.exact_quotas(plan, {"g1": 101, "g2": 50, "t/b1": 95, "t/b2": 60}, {"g1": 5, "g2": 1, "t/b1": 9, "t/b2": 1})
    assert not M.exact_quotas(plan, {"g1": 101}, {"g1": 5})
    with pytest.raises(ValueError, match="unknown stage"):
        M.mixture_plan(SOURCES.values(), MIXTURE, "x")
    with pytest.raises(ValueError, match="above its cap"):
        M.mixture_plan(SOURCES.values(), MIXTURE, "main", caps={"b2": 0.08})
    assert M.sample_plan(SOURCES.values(), MIXTURE, total=3000)["total_tokens"] == 3000


def test_tokenizer_comparison():
    side = lambda t, g, f, p: {"tokens": t, "roles": {"pretrain_general": {"tokens": g}, "pretrain_telecom": {"tokens": f}}, "probe_p95_tokens_per_word": p, "input_files_sha256": "x", "probe_sets_sha256": "y"}
    r = M.compare_tokenizers(side(10000, 6000, 3000, 4.0), side(9850, 6030, 2900, 4.02))
    assert r["eligible"] and r["winner"] == "candidate" and r["overall_improvement"] == pytest.approx(0.015)
    bad = M.compare_tokenizers(side(10000, 6000, 3000, 4.0), side(9850, 6030, 2900, 4.02) | {"round_trip_failures": 1})
    assert bad["winner"] == "baseline" and not bad["eligible"]
    assert M.compare_tokenizers(side(1, 1, 1, 1), side(1, 1, 1, 1) | {"input_files_sha256": "z"})["winner"] is None


def _loader(spark, source):
    if source.id == "t":
        rows = [(i, f"c{i % 2 + 1}", f"telecom text number {i % 35} about radio {'x' * (i % 9)}") for i in range(50)]
        return spark.createDataFrame(rows, "pos long, collection string, text string")
    shared = [(i, f"general text number {i} {'y' * (i % 7)}" if i % 5 else "  ") for i in range(60)]
    return spark.createDataFrame(shared, "pos long, text string")


def test_two_stage_build(spark):
    plans = [M.mixture_plan(SOURCES.values(), MIXTURE, s) for s in ("pilot", "main")]
    corpus, stats = pipelines.build_corpus(spark, SOURCES, plans, _loader, QualityPolicy(min_chars=5), ["radio xxxx"], row_order=["pos"], strict=False)
    rows = corpus.collect()
    accepted = [r for r in rows if r.accepted]
    assert accepted and len({r.content_sha256 for r in accepted}) == len(accepted)
    kinds = {r.disposition for r in rows}
    assert kinds >= {"train", "holdout", "duplicate_exact", "empty_text", "benchmark_contamination"}
    by = {r.plan_item: r for r in stats.collect()}
    assert by["pilot:g1"].quota_tokens >= 100
    assert all(r.split == "validation" for r in rows if r.disposition == "holdout")
    wide = pipelines.corpus_breakdowns(corpus).filter("level = 15 - 8 or stage is not null").collect()
    assert wide
    with pytest.raises(ValueError, match="exhausted before quota"):
        pipelines.build_corpus(spark, SOURCES, plans, _loader, QualityPolicy(min_chars=5), row_order=["pos"])


def test_audit_of_a_build(spark):
    small = MIXTURE | {"stages": {"main": MIXTURE["stages"]["main"] | {"total_tokens": 120}}}
    plan = M.mixture_plan(SOURCES.values(), small, "main")
    corpus, _ = pipelines.build_corpus(spark, SOURCES, [plan], _loader, QualityPolicy(min_chars=5), row_order=["pos"])
    audit = pipelines.corpus_audit(corpus, M.plan_items(spark, [plan]), 0.9).collect()
    assert all(r.passed for r in audit if r.item_id) and len(audit) == 5
    evidence = pipelines.finalize(corpus, M.plan_items(spark, [plan]), 0.9)
    assert evidence["passed"] and evidence["overlap"] == 0 and len(evidence["audit_sha256"]) == 64


def test_tokenized_splits(spark, tmp_path):
    tok = "/opt/tokenizers/byte_bpe_50k.json"
    df = spark.createDataFrame([(i, "train" if i % 3 else "validation", f"text number {i}") for i in range(30)], "pos long, split string, text string")
    meta = pipelines.tokenize_splits(df, tok, f"file://{tmp_path}/t", ["pos"], shard_size=16, eos_id=50256)
    assert set(meta) == {"train", "validation"} and meta["train"]["total_documents"] == 20
    assert all(s["num_tokens"] == 16 for s in meta["train"]["shards"][:-1]) and meta["train"]["total_tokens"] == sum(s["num_tokens"] for s in meta["train"]["shards"])
    ends = readers.read_shards(spark, f"{tmp_path}/t/bin/split=train").select(F.explode("ids").alias("x")).filter("x = 50256").count()
    assert ends == 20


def test_benchmark_files_and_comparison(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Q", ["a", "b"], "A"), (2, None, ["a", "b"], "A")], "row_index long, question string, choices array<string>, answer string")
    assert tuple(pipelines.prepare_benchmark(rows, f"{tmp_path}/b", "d", "c").first()) == ("c", 1, 1)
    assert spark.read.json(f"{tmp_path}/b/skipped").first().problem == "no question"
    losses = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "checkpoint_label string, seed long, loss double")
    texts = spark.createDataFrame([("a", "A cat ran."), ("b", "A cat. A cat.")], "checkpoint_label string, text string")
    report = pipelines.comparison_report(losses, texts)
    assert report["pairs"].first().left_wins == 1 and report["generations"].count() == 2
    with pytest.raises(ValueError, match="seed [12] once"):
        pipelines.comparison_report(losses.limit(1).union(spark.createDataFrame([("b", 2, 1.0)], losses.schema)), texts)


def test_progress_file(spark, tmp_path):
    import json
    import time

    raw = f"{tmp_path}/raw"
    _write_raw(spark, raw, [(0, "s", "x"), (1, "s", "y")])
    listener = incremental.ProgressFile(f"{tmp_path}/p.json", 0.0)
    spark.streams.addListener(listener)
    try:
        incremental.run_build(spark.readStream.schema("row_index long, source_id string, text string").parquet(raw), f"{tmp_path}/b", {"v": 1})
        for _ in range(50):
            state = json.loads(open(f"{tmp_path}/p.json").read())
            if state["status"] == "complete":
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert state == {"status": "complete", "rows": 2}


def _write_raw(spark, path, rows):
    spark.createDataFrame(rows, "row_index long, source_id string, text string").coalesce(1).write.mode("append").parquet(path)


def test_stream_resumes_and_deduplicates(spark, tmp_path):
    raw, folder = f"{tmp_path}/raw", f"{tmp_path}/build"
    _write_raw(spark, raw, [(0, "s", "first text"), (1, "s", "first  text"), (2, "s", "first text\r\n"), (3, "s", " ")])
    schema = "row_index long, source_id string, text string"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(raw)
    incremental.run_build(stream(), folder, {"v": 1})
    assert incremental.committed(spark, folder).count() == 2
    _write_raw(spark, raw, [(4, "s", "first text"), (5, "t", "second text"), (6, "t", None)])
    incremental.run_build(stream(), folder, {"v": 1})
    got = incremental.committed(spark, folder)
    assert {r.text for r in got.collect()} == {"first text", "first  text", "second text"}
    with pytest.raises(ValueError, match="inputs of this build have changed"):
        incremental.run_build(stream(), folder, {"v": 2})
    state = {r.source_id: r.row_cursor for r in incremental.build_state(spark, folder).collect()}
    assert state == {"s": 2, "t": 6}
    # a batch that is run again leaves the same unit once
    batch = spark.createDataFrame([(4, "s", "first text"), (5, "t", "second text")], schema)
    incremental.unit_writer(folder)(batch, 1)
    incremental.unit_writer(folder)(batch, 1)
    assert incremental.committed(spark, folder).count() == 3


def test_streaming_windows(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    for part in ([0, 1, 2], [3, 4]):
        _write_raw(spark, raw, [(i, "s", "x") for i in part])
    schema = "row_index long, source_id string, text string"
    out = incremental.count_window_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(raw), 2)
    q = out.writeStream.format("memory").queryName("cw").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.row_index: r.window for r in spark.table("cw").collect()} == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2}
    hashes = spark.readStream.schema(schema).parquet(raw).withColumn("content_sha256", F.sha2("text", 256))
    q = incremental.dedup_stream(hashes).writeStream.format("memory").queryName("dd").outputMode("append").option("checkpointLocation", f"{tmp_path}/d").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dd").count() == 1
