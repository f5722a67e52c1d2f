"""Selections, snapshots, checks before a run, shard evidence and assets."""

import json

import numpy as np
import pytest

from corpusloom.functions.hashing import json_sha256
from corpusloom.operators.evaluation import asset_problems
from corpusloom.plans import evidence as E
from corpusloom.sources import readers

TOK = "/opt/tokenizers/byte_bpe_50k.json"


def comparison(**changes):
    body = {"labels": {"baseline": "old", "candidate": "new"}, "shared_evidence_valid": True, "side_validity": {"baseline": True, "candidate": True}, "baseline": {"tokenizer_sha256": "a" * 64}, "candidate": {"tokenizer_sha256": "b" * 64}, "fingerprints": {"baseline_tokenizer_sha256": "a" * 64, "candidate_tokenizer_sha256": "b" * 64}} | changes
    return body | {"comparison_sha256": json_sha256(body)}


def test_selection(spark, tmp_path):
    path = f"file://{tmp_path}/selection.json"
    made = E.write_selection(spark, path, comparison(), "new", "2030-01-01T00:00:00Z")
    assert E.check_selection(made, comparison()) == "b" * 64 and json.load(open(f"{tmp_path}/selection.json")) == made
    with pytest.raises(FileExistsError):
        E.write_selection(spark, path, comparison(), "old", "2030-01-01T00:00:00Z")
    for bad in ({"side_validity": {"baseline": True, "candidate": False}}, {"shared_evidence_valid": False}, {"candidate": {"tokenizer_sha256": "c" * 64}}, {"candidate": {}}):
        with pytest.raises(ValueError):
            E.write_selection(spark, path, comparison(**bad), "new")
    for bad in ({"winner": "other"}, {"approved": False}, {"operator_timestamp": "2030-01-01T00:00:00"}, {"selected_tokenizer_sha256": "a" * 64}):
        with pytest.raises(ValueError):
            E.check_selection(made | bad, comparison())
    with pytest.raises(ValueError, match="hash"):
        E.check_selection(made, comparison() | {"labels": {"candidate": "new"}})


def test_snapshot(spark, tmp_path):
    (tmp_path / "c.pt").write_bytes(b"weights")
    got = E.snapshot_file(spark, f"file://{tmp_path}/c.pt", f"file://{tmp_path}/s", "best")
    assert got["path"].endswith(f"best-{got['sha256']}.pt") and got == E.snapshot_file(spark, f"file://{tmp_path}/c.pt", f"file://{tmp_path}/s", "best")
    kept = got["path"].removeprefix("file://")
    open(kept, "wb").write(b"others!")
    (tmp_path / "s" / f".{kept.rsplit('/', 1)[1]}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="other content"):
        E.snapshot_file(spark, f"file://{tmp_path}/c.pt", f"file://{tmp_path}/s", "best")
    (tmp_path / "empty.pt").write_bytes(b"")
    with pytest.raises(ValueError):
        E.file_identity(spark, f"file://{tmp_path}/empty.pt")
    with pytest.raises(ValueError):
        E.snapshot_file(spark, f"file://{tmp_path}/c.pt", f"file://{tmp_path}/s", "../x")


def test_ten_checks(spark, tmp_path):
    np.array([5, 6, 1, 7, 1], "<u2").tofile(tmp_path / "shard_00000.bin")
    shards = readers.read_shards(spark, f"file://{tmp_path}/*.bin")
    files = readers.file_table(spark, f"file://{tmp_path}/*.bin")
    meta = shards.select("path", "num_tokens", "sha256")
    hashes = lambda *h: spark.createDataFrame([(x,) for x in h], "text_sha256 string")
    config = {"batch": 2, "accumulation": 2, "context": 8, "max_tokens": 3200, "warmup_ratio": 0.1}
    given = {"required": {"batch": int}, "revisions": {"s": "0" * 40}, "manifest": files, "files": files, "train": hashes("x"), "held": hashes("y"), "probes": spark.createDataFrame([("some text",)], "text string"), "tokenizer": TOK, "shards": shards, "metadata": meta, "output": f"file://{tmp_path}/out"}
    good = E.run_checks(spark, config, **given).collect()
    assert [r.check for r in good] == list(E.CHECKS) and all(r.status == "pass" for r in good)
    bad = {"required": {"nothing": int}, "revisions": {"s": "main"}, "held": hashes("x"), "free": 1 << 62, "checkpoint": f"file://{tmp_path}/none.pt", "metadata": meta.selectExpr("path", "num_tokens + 1 as num_tokens", "sha256"), "files": files.limit(0), "device": lambda: False}
    failed = {r.check for r in E.run_checks(spark, config | {"warmup_ratio": 2.0}, **(given | bad)).collect() if r.status == "fail"}
    assert failed == set(E.CHECKS) - {"tokenizer"}
    kept = E.shard_evidence(spark, f"file://{tmp_path}/*.bin", 2, 1, 8)
    assert kept["passed"] and kept["total_tokens"] == 5 and E.reuse_evidence(kept, spark, f"file://{tmp_path}/*.bin", 2, 1, 8) == kept
    np.array([5, 6, 1, 7, 7], "<u2").tofile(tmp_path / "shard_00000.bin")
    with pytest.raises(ValueError, match="changed"):
        E.reuse_evidence(kept, spark, f"file://{tmp_path}/*.bin", 2, 1, 8)


def test_assets(spark, tmp_path):
    lines = [{"id": "a-1", "category": "a", "text": "x"}, {"id": "a-2", "category": "a", "text": "y"}]
    (tmp_path / "p.jsonl").write_text("\n".join(map(json.dumps, lines)))
    assert readers.read_story_prompts(spark, f"{tmp_path}/p.jsonl").count() == 2
    for wrong in ({"id": "a-1", "category": "a", "text": "z"}, {"id": "a-3", "category": "a", "text": "x"}, {"id": "a-4", "text": "q"}):
        (tmp_path / "q.jsonl").write_text("\n".join(map(json.dumps, [*lines, wrong])))
        with pytest.raises(ValueError):
            readers.read_story_prompts(spark, f"{tmp_path}/q.jsonl")
    items = spark.createDataFrame([("a-1", "a", "p", ["x", "y"]), ("a-2", "a", "p", ["x", "y"]), ("c-1", "c", " ", ["x"])], "id string, category string, prompt string, choices array<string>")
    assert {(r.id, r.problem) for r in asset_problems(items, ["a", "b"]).collect()} == {("a-1", "repeated prompt and choices"), ("c-1", "unknown category"), ("c-1", "empty prompt or choice"), (None, "no item of the category b")}
    (tmp_path / "train.jsonl").write_text(json.dumps({"id": "1", "text": "t"}))
    assert readers.read_verified_split(spark, f"file://{tmp_path}", None, "train").count() == 1
    with pytest.raises(FileNotFoundError):
        readers.read_verified_split(spark, f"file://{tmp_path}", None, "other")
