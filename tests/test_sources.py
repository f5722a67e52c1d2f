import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import evaluation, runs
from corpusloom.operators.records import Source
from corpusloom.operators.runs import METRICS
from corpusloom.sources import paths, readers, registry, sinks


def _record(text, digest=None):
    import hashlib

    return {"id": "a", "text": text, "content_sha256": digest or hashlib.sha256(text.encode()).hexdigest()}


def test_strict_records(spark, tmp_path):
    good = tmp_path / "good.jsonl"
    good.write_text(json.dumps(_record("hé"), ensure_ascii=False) + "\n", encoding="utf-8")
    assert readers.read_strict_records(spark, str(good)).first().text == "hé"
    for name, line, message in (("blank", "  \n", "blank line"), ("array", "[1]\n", "not a record"), ("hash", json.dumps(_record("x", "0" * 64)) + "\n", "wrong hash")):
        path = tmp_path / f"{name}.jsonl"
        path.write_text(line)
        with pytest.raises(Exception, match=message):
            readers.read_strict_records(spark, str(path)).collect()


def test_patterns_and_streams(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_text('Plain  \n\n{"text": "", "prompt": "From PROMPT"}\n{"content": "C"}\n{"text": ""}\n')
    assert readers.read_patterns(spark, str(path)) == ["plain", "from prompt", "c"]
    assert readers.consumed_stream(spark, str(path)).first().records == 4


def test_metrics(spark, tmp_path):
    path = tmp_path / "m.csv"
    row = {c: "" for c in METRICS} | {"event": "train", "global_step": "1", "train_loss": "2.5"}
    path.write_text(",".join(METRICS) + "\n" + ",".join(row.values()) + "\n")
    got = readers.read_metrics(spark, str(path)).first()
    assert got.train_loss == 2.5 and got.val_loss is None
    path.write_text(",".join(METRICS) + "\n" + ",".join((row | {"lr": "nan"}).values()) + "\n")
    with pytest.raises(Exception, match="not a finite number"):
        readers.read_metrics(spark, str(path)).collect()
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        readers.read_metrics(spark, str(path))


def test_rows_by_glob_and_cursor(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part-{i}.jsonl").write_text(f'{{"text": "t{i}"}}\n')
    (tmp_path / "other.txt").write_text("no")
    rows = readers.with_row_index(readers.read_rows(spark, str(tmp_path), format="json", glob="*.jsonl"), ["text"])
    assert [r.text for r in readers.from_cursor(rows, 1).orderBy("row_index").collect()] == ["t1", "t2"]
    load = readers.file_loader(str(tmp_path.parent))
    assert load(spark, Source("s", tmp_path.name, data_files=("part-*.jsonl",))).count() == 3
    with pytest.raises(ValueError):
        readers.from_cursor(rows, -1)
    with pytest.raises(ValueError, match="x"):
        readers.require_schema(rows.withColumn("x", F.lit(1)), rows.schema)


def test_shards_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(0, [2, 3]), (1, [2, 3, 3])], "i long, ids array<int>")
    sinks.write_shards(df, f"file://{tmp_path}/s", ["i"], 4, eos_id=1)
    meta = spark.read.parquet(f"{tmp_path}/s/metadata")
    read = readers.read_shards(spark, f"{tmp_path}/s/bin").withColumn("path", F.regexp_extract("path", r"(bin/.*)$", 1))
    assert [r.ids for r in read.orderBy("path").collect()] == [[2, 3, 1, 2], [3, 3, 1]]
    assert readers.verify_shards(read, meta).count() == 0
    assert readers.verify_shards(read, meta.withColumn("sha256", F.lit("x"))).count() == 2
    body = sinks.split_metadata(meta, documents=2, tokenizer_sha256="t", dtype="uint16", shard_size=4)
    assert body["total_tokens"] == 7 and len(body["shards"]) == 2
    again = sinks.split_metadata(meta, documents=2, tokenizer_sha256="t", dtype="uint16", shard_size=4)
    assert body["metadata_sha256"] == again["metadata_sha256"]


def test_publish_is_all_or_nothing(spark, tmp_path):
    target = f"{tmp_path}/out"
    df = spark.range(3)
    sinks.publish(spark, target, lambda p: df.write.parquet(p))

    def refuse(path):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        sinks.publish(spark, target, lambda p: spark.range(9).write.parquet(p), refuse, replace=True)
    assert spark.read.parquet(target).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(FileExistsError):
        sinks.publish(spark, target, lambda p: df.write.parquet(p))
    sinks.publish(spark, target, lambda p: spark.range(9).write.parquet(p), replace=True)
    assert spark.read.parquet(target).count() == 9 and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_splits_chunks_and_evidence(spark, tmp_path):
    df = spark.createDataFrame([(i, f"id{i}", "train" if i % 2 else "validation", "x" * i, "h", i) for i in range(20)], "pos long, id string, split string, text string, text_sha256 string, num_chars long")
    report = {r.split: r.documents for r in sinks.split_report(df, "pos").collect()}
    assert report == {"train": 10, "validation": 10}
    sinks.write_splits(df, f"{tmp_path}/splits", order="pos", caps={"train": 3})
    got = spark.read.json(f"{tmp_path}/splits")
    assert got.filter("split = 'train'").count() == 3 and got.filter("split = 'validation'").count() == 10
    assert {r.id for r in got.filter("split = 'train'").collect()} == {"id1", "id3", "id5"}
    sinks.write_chunks(df, f"{tmp_path}/chunks", ["pos"], 500)
    back = spark.read.json(f"{tmp_path}/chunks")
    assert back.count() == 20 and back.select("chunk").distinct().count() > 2
    path = f"file://{tmp_path}/e.json"
    sinks.write_evidence(spark, path, {"a": 1})
    sinks.write_evidence(spark, path, {"a": 1})
    with pytest.raises(FileExistsError):
        sinks.write_evidence(spark, path, {"a": 2})
    m = sinks.manifest(sinks.split_report(df, "pos"), dataset="d")
    assert m["dataset"] == "d" and len(m["manifest_sha256"]) == 64
    dealt = sinks.byte_chunks(df.select("split", "pos", "num_chars"), ["pos"], F.col("num_chars"), 20, ["split"])
    assert all(r.s <= 20 or r.n == 1 for r in dealt.groupBy("split", "chunk").agg(F.sum("num_chars").alias("s"), F.count("*").alias("n")).collect())
    assert {r.path.rsplit("/", 1)[1] for r in readers.file_table(spark, str(tmp_path), "e.json").collect()} == {"e.json"}


def test_review_bundle_hides_the_key(spark, tmp_path):
    g = spark.createDataFrame([("a", f"a{i}", "p", "t", f"q{i}", i) for i in range(3)], "checkpoint_label string, generation_id string, prompt string, text string, prompt_id string, generation_seed long")
    sinks.write_reviews(evaluation.sample_reviews(g, 3, 1, 2), f"{tmp_path}/b")
    shown = spark.read.json(f"{tmp_path}/b/batches")
    assert set(shown.columns) == {"review_id", "prompt", "text", "batch"}
    assert "generation_id" in spark.read.json(f"{tmp_path}/b/key").columns
    key = tmp_path / "key.json"
    key.write_text('{"review-0001": {"checkpoint_label": "a", "generation_id": "g", "prompt_id": "p", "generation_seed": 3}}')
    r = readers.read_review_key(spark, str(key)).first()
    assert (r.review_id, r.checkpoint_label, r.generation_seed) == ("review-0001", "a", 3)


def test_metric_append(spark, tmp_path):
    row = spark.createDataFrame([tuple("1" for _ in METRICS)], ", ".join(f"{c} string" for c in METRICS))
    sinks.append_metrics(row, f"{tmp_path}/m")
    sinks.append_metrics(row, f"{tmp_path}/m")
    assert readers.read_metrics(spark, f"{tmp_path}/m").count() == 2
    with pytest.raises(ValueError):
        sinks.append_metrics(row.drop("lr"), f"{tmp_path}/m")


def test_registry(spark, tmp_path):
    path = tmp_path / "r.yaml"
    path.write_text("version: 1\nsources:\n- id: s\n  name: n\n  role: pretrain_telecom\n  buckets:\n  - {id: b, collections: [c], weight: 0.5}\n")
    found = registry.load_registry(path)
    assert found["s"].buckets[0].collections == ("c",)
    assert registry.registry_table(spark, found).first().buckets[0].id == "b"
    for text in ("version: 1\nextra: 1\n", "version: 1\nsources:\n- {id: s, name: n, typo: 1}\n", "version: 1\nsources:\n- {id: s, name: n}\n- {id: s, name: n}\n", "version: 1\nsources:\n- {id: s, name: n, revision: abc}\n"):
        path.write_text(text)
        with pytest.raises(ValueError):
            registry.load_registry(path)
    path.write_text("groups: {a: [x, y]}\n")
    assert registry.probe_table(spark, registry.load_probes(path)).count() == 2
    path.write_text("version: 1\nseed: 1\nquota_tolerance: 0.03\nvalidation_fraction: 0.1\nbuffer_size: 4\nstages: {}\n")
    assert registry.load_mixture(path)["buffer_size"] == 4
    path.write_text("version: 1\nseed: 1\nquota_tolerance: 1.5\nvalidation_fraction: 0.1\nbuffer_size: 4\nstages: {}\n")
    with pytest.raises(ValueError):
        registry.load_mixture(path)


def test_choice_items(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text('{"id": "a", "prompt": "p", "choices": ["x", "y"], "answer": "B"}\n')
    assert readers.read_choice_items(spark, str(path)).first().choices == ["x", "y"]
    path.write_text('{"id": "a"}\n{"id": "a"}\n')
    with pytest.raises(Exception, match="repeated id"):
        readers.read_choice_items(spark, str(path)).collect()


def test_verified_splits(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/a.jsonl").write_text('{"id": "1", "text": "x"}\n')
    found = readers.file_table(spark, f"{tmp_path}/c").first()
    manifest = lambda sha: spark.createDataFrame([("train", "c/a.jsonl", found.size, sha)], "split string, path string, size long, sha256 string")
    assert readers.read_verified_split(spark, str(tmp_path), manifest(found.sha256), "train").first().id == "1"
    with pytest.raises(ValueError, match="hash"):
        readers.read_verified_split(spark, str(tmp_path), manifest("0" * 64), "train")
    with pytest.raises(ValueError, match="no files"):
        readers.read_verified_split(spark, str(tmp_path), manifest(found.sha256), "validation")


def test_paths_and_storage(tmp_path):
    assert paths.managed_path(str(tmp_path), "a/b.json") == f"{tmp_path}/a/b.json"
    (tmp_path / "link").symlink_to(tmp_path)
    for bad in ("/a", "../a", "a/../b", "", "link/a", "a b"):
        with pytest.raises(ValueError):
            paths.managed_path(str(tmp_path), bad)
    assert paths.require_free(f"{tmp_path}/new/folder", 0)["free_gib"] > 0
    with pytest.raises(OSError):
        paths.require_free(str(tmp_path), 1e9)


def test_candidate_recipe(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("{baseline: a, candidate: b, vocabulary: 100, sample_tokens: 5}")
    assert registry.load_candidate(path)["min_overall"] == 0.01
    for text in ("{baseline: a, candidate: a, vocabulary: 1, sample_tokens: 5}", "{baseline: a, candidate: b, vocabulary: 0, sample_tokens: 5}", "{baseline: a, candidate: b, vocabulary: 1, sample_tokens: 5, min_focus: 2}"):
        path.write_text(text)
        with pytest.raises(ValueError):
            registry.load_candidate(path)


def test_summary_text_and_roles(spark):
    s = spark.createDataFrame([("r", 1.5, None)], "run string, best_val_loss double, max_tokens_per_second double")
    text = runs.summary_markdown(s, notes=["few seeds"])
    assert "- best val loss: 1.5" in text and "unavailable" in text and "few seeds" in text
    a, b = (spark.createDataFrame(x, "role string, tokens long") for x in ([("g", 100), ("t", 50)], [("g", 90)]))
    assert {r.role: r.improvement for r in evaluation.compare_roles(a, b).collect()} == {"g": 0.1, "t": None}
