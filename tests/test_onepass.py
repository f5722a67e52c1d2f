"""One-pass builds: stops and resumes, sealing, journal, publication."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.filters import QualityPolicy
from corpusloom.operators.records import Bucket, Source
from corpusloom.streaming import onepass

TOK = "/opt/tokenizers/byte_bpe_50k.json"
SOURCES = {"s": Source(id="s", name="x/s", license="mit", collection_field="c", buckets=(Bucket("p", ("p",), 0.5), Bucket("q", ("q",), 0.5))), "t": Source(id="t", name="x/t", license="mit")}
PLANS = [{"stage": "main", "buffer_size": 4, "seed": 1, "validation_fraction": 0.2, "items": [{"item_id": "s/p", "source_id": "s", "token_quota": 60}, {"item_id": "s/q", "source_id": "s", "token_quota": 90}, {"item_id": "t", "source_id": "t", "token_quota": 50}]}]


def rows(spark):
    def get(stage, source):
        mine = [(i, f"{'shared' if i % 6 == 0 else source} text number {i // 2 if i % 5 == 0 else i}", "pq"[i % 2]) for i in range(80)]
        mine[3] = (3, "  ", "q")
        return spark.createDataFrame(mine, "row_index long, text string, c string")

    return get


def build(spark, folder, **kw):
    return onepass.OnePassBuild(spark, folder, SOURCES, PLANS, rows(spark), {"v": 1}, **{"policy": QualityPolicy(min_chars=5), "tokenizer": TOK, "eos_id": 50256, "shard_size": 32, "limits": onepass.UnitLimits(rows=40, tokens=120, free_bytes=0), **kw})


def files(folder):
    out = {}
    for base, _, names in os.walk(f"{folder}/units"):
        out |= {os.path.relpath(os.path.join(base, n), folder): hashlib.sha256(open(os.path.join(base, n), "rb").read()).hexdigest() for n in names if n.endswith(".bin")}
    return out


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("whole")
    b = build(spark, f"file://{folder}")
    return b, b.run(), folder


def test_a_stopped_build_leaves_the_same_shards(spark, whole, tmp_path):
    b, state, folder = whole
    assert state["complete"] and state["units"] >= 3
    entries = b.journal.entries()
    limits = {f"main:{i['item_id']}": i["token_quota"] for i in PLANS[0]["items"]}
    assert all(v["actual"] >= limits[k] for k, v in state["items"].items())
    fit = b.records()
    assert fit.agg(F.sum("tokens")).first()[0] == sum(v["actual"] for v in state["items"].values())
    assert fit.select("content_sha256").distinct().count() == fit.count() == state["counters"]["corpus"]
    assert all(e["end"] < 80 for e in entries[:1])  # sealed before its source ended
    shards = [a for e in entries for a in e["artifacts"] if a["path"].endswith(".bin") and "train" in a["path"]]
    assert sum(a["size"] for a in shards) == 2 * (sum(v["actual"] for v in state["items"].values()) + state["counters"]["corpus"])
    calls = iter([False, True] * 40)
    again = build(spark, f"file://{tmp_path}")
    part = again.run(stop=lambda: next(calls))
    assert 0 < part["units"] < state["units"] and not part["complete"]
    done = build(spark, f"file://{tmp_path}").run()
    assert done == state and files(tmp_path) == files(folder)
    with pytest.raises(ValueError, match="changed"):
        onepass.OnePassBuild(spark, f"file://{tmp_path}", SOURCES, PLANS, rows(spark), {"v": 2})


def test_finalize_publish_and_quarantine(spark, whole, tmp_path):
    b, state, folder = whole
    got = b.finalize()
    assert got["passed"] and json.load(open(f"{folder}/manifest.json"))["manifest_sha256"] == got["manifest_sha256"] and got["licenses"] == {"mit": state["counters"]["corpus"]}
    with pytest.raises(OSError, match="left free"):
        onepass.publish_units(b.journal, f"file://{tmp_path}/p", 1 << 62)
    first = b.journal.entries()[0]
    # a crash after the copy and before the journal: the unit is checked and marked, unless its bytes are others
    place = f"{tmp_path}/p/{first['path']}"
    os.makedirs(place)
    with pytest.raises(OSError, match="other bytes"):
        onepass.publish_units(b.journal, f"file://{tmp_path}/p")
    assert os.listdir(f"{tmp_path}/p/quarantine") and not os.path.exists(place)
    assert onepass.publish_units(b.journal, f"file://{tmp_path}/p") == [e["unit"] for e in b.journal.entries()]
    assert onepass.publish_units(b.journal, f"file://{tmp_path}/p") == [] and files(f"{tmp_path}/p") == files(folder)


def test_journal(spark, tmp_path):
    j = onepass.Journal(spark, f"file://{tmp_path}")
    entry = {"stage": "m", "source": "s", "start": 0, "end": 5, "path": "u", "items": {"a": 3}, "artifacts": [{"path": "u/x", "size": 1, "sha256": "0"}]}
    assert j.commit(entry)["unit"] == 0 and j.commit(entry)["unit"] == 0 and j.cursor("m", "s") == 5
    with pytest.raises(onepass.JournalConflict, match="another result"):
        j.commit(entry | {"end": 6})
    with pytest.raises(onepass.JournalConflict, match="belongs"):
        j.commit(entry | {"start": 5, "end": 9})
    j.commit(entry | {"start": 5, "end": 9, "artifacts": []})
    assert j.used() == {"a": 6}
    name = f"{tmp_path}/journal/unit-000000000.json"
    text = open(name).read().replace('"a": 3', '"a": 4')
    open(name, "w").write(text)
    for f in os.listdir(f"{tmp_path}/journal"):
        if f.endswith(".crc"):
            os.remove(f"{tmp_path}/journal/{f}")
    with pytest.raises(onepass.JournalConflict, match="follow"):
        j.entries()


def test_stale_units_and_retries(spark, tmp_path):
    b = build(spark, f"file://{tmp_path}", tokenizer=None)
    os.makedirs(f"{tmp_path}/units/main/s/000000000000")
    with pytest.raises(FileExistsError, match="stale"):
        b.run()
    b = build(spark, f"file://{tmp_path}", tokenizer=None, stale="remove")
    assert b.run(most_tokens=1)["units"] == 1
    tries, waits = [], []

    def step():
        tries.append(1)
        if len(tries) < 3:
            raise TimeoutError("x")
        return 7

    assert onepass.retrying(step, (0.1, 0.2, 0.3), sleep=waits.append) == 7 and waits == [0.1, 0.2]
    with pytest.raises(ValueError):
        onepass.retrying(lambda: (_ for _ in ()).throw(ValueError("bad")), sleep=waits.append)
