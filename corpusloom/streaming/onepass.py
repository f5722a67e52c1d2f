"""One-pass builds to exact token quotas, in units that are sealed, journaled and published one by one, and resumed where they ended.

A unit is a stretch of one source's rows. What it is made of depends on its cursor alone, so a build that is stopped anywhere and
resumed leaves the same units, byte for byte. Nothing counts until the journal has it.
"""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.hashing import EXCLUSIVE, hash_fraction, json_sha256
from corpusloom.functions.scalars import item_id
from corpusloom.operators.filters import QualityPolicy, contains_any
from corpusloom.operators.quota import fill_quotas
from corpusloom.operators.records import Source, source_records
from corpusloom.operators.tokens import encode
from corpusloom.operators.windows import shuffled_windows
from corpusloom.plans.pipelines import judged
from corpusloom.session import discard, store
from corpusloom.sources.paths import exists, file_system, free_bytes, move, read_bytes, remove, write_bytes
from corpusloom.sources.readers import file_table
from corpusloom.sources.sinks import json_line, write_shards
from corpusloom.streaming.incremental import lock_identity

T = TypeVar("T")
#: Dispositions that a unit counts, beside the reasons of rejections.
COUNTERS = ("raw", "read", "normalized", "accepted", "held_out", "corpus", "discarded_encoded", "discarded_unencoded", "rejected")


class JournalConflict(ValueError):
    """An entry contradicts what the journal has."""


@dataclass
class Journal:
    """A build's units in order, each entry bound to the one before by its hash, written by one rename: a unit is in it as a whole or not at all."""

    spark: SparkSession
    folder: str

    def _names(self, kind: str) -> list[str]:
        root = f"{self.folder}/journal"
        if not exists(self.spark, root):
            return []
        fs, place = file_system(self.spark, root)
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(f"{root}/{n}" for n in names if n.startswith(kind) and n.endswith(".json"))

    def entries(self) -> list[dict[str, Any]]:
        """All units; a broken chain is an error. There is one small entry per unit."""
        out, before = [], ""
        for at, name in enumerate(self._names("unit-")):
            entry = json.loads(read_bytes(self.spark, name))
            body = {k: v for k, v in entry.items() if k != "sha256"}
            if entry["unit"] != at or entry["before"] != before or entry["sha256"] != json_sha256(body):
                raise JournalConflict(f"{name} doesn't follow from the entries before it")
            before = entry["sha256"]
            out.append(entry)
        return out

    def commit(self, entry: Mapping[str, Any]) -> dict[str, Any]:
        """Add a unit with its cursors, totals, hashes and artifacts at once. The same entry again is fine; a second one for the same rows, or with an artifact that is there already, is an error."""
        have = self.entries()
        for old in have:
            if (old["stage"], old["source"], old["start"]) == (entry["stage"], entry["source"], entry["start"]):
                if all(old[k] == v for k, v in entry.items()):
                    return old
                raise JournalConflict(f"unit {old['unit']} has these rows already, with another result")
        taken = {a["path"] for old in have for a in old["artifacts"]}
        if again := [a["path"] for a in entry["artifacts"] if a["path"] in taken]:
            raise JournalConflict(f"{again[0]} belongs to an earlier unit")
        body = {**entry, "unit": len(have), "before": have[-1]["sha256"] if have else ""}
        body["sha256"] = json_sha256(body)
        write_bytes(self.spark, f"{self.folder}/journal/unit-{len(have):09d}.json", json.dumps(body, sort_keys=True, ensure_ascii=False).encode())
        return body

    def published(self) -> set[int]:
        return {int(n.rsplit("-", 1)[1][:-5]) for n in self._names("published-")}

    def mark_published(self, unit: int, target: str) -> None:
        write_bytes(self.spark, f"{self.folder}/journal/published-{unit:09d}.json", json.dumps({"unit": unit, "target": target}).encode())

    def cursor(self, stage: str, source: str) -> int:
        return max((e["end"] for e in self.entries() if (e["stage"], e["source"]) == (stage, source)), default=0)

    def used(self) -> dict[str, int]:
        """Tokens of every item so far, without held-out ones."""
        out: dict[str, int] = {}
        for e in self.entries():
            for item, n in e["items"].items():
                out[item] = out.get(item, 0) + n
        return out


def retrying(step: Callable[[], T], delays: Iterable[float] = (1.0, 5.0, 25.0), transient: Callable[[BaseException], bool] | None = None, sleep: Callable[[float], None] = time.sleep) -> T:
    """Run a step again after transient failures: timeouts, lost connections, and the statuses 408, 429 and 5xx. A unit begins again at the cursor it had, since nothing of it counts before its commit."""

    def passing(error: BaseException) -> bool:
        text = str(error).lower()
        status = getattr(error, "status", None)
        return isinstance(error, (TimeoutError, ConnectionError)) or status in (408, 429) or isinstance(status, int) and 500 <= status < 600 or any(w in text for w in ("timed out", "connection reset", "connection refused", "status 408", "status 429", "status 5"))

    for delay in [*delays, None]:
        try:
            return step()
        except Exception as error:
            if delay is None or not (transient or passing)(error):
                raise
            sleep(delay)
    raise AssertionError


@dataclass(frozen=True)
class UnitLimits:
    """Where a unit ends: at the first window after which one of these is reached, or an item is full, or its rows are read."""

    rows: int = 200_000
    text_bytes: int = 256 << 20
    tokens: int = 50_000_000
    free_bytes: int = 25 << 30


@dataclass
class OnePassBuild:
    """Corpora of stages from sources, row by row in shuffled windows: filtered, deduplicated against all units before, counted in exact
    tokens, filled to the quotas of their items, held-out rows apart, and written as records and token shards.

    ``rows`` gives a stage's and source's raw rows with ``row_index``, in the same order at every call. ``plans`` are mixture plans in order of
    stages. Without a tokenizer the estimated tokens fill the quotas and no shards are written, as for a tokenizer's sample. A source is left as
    soon as all its items are full.
    """

    spark: SparkSession
    folder: str
    sources: Mapping[str, Source]
    plans: list[Mapping[str, Any]]
    rows: Callable[[str, str], DataFrame]
    identity: Mapping[str, Any]
    policy: QualityPolicy = field(default_factory=QualityPolicy)
    patterns: tuple[str, ...] = ()
    tokenizer: str | None = None
    limits: UnitLimits = field(default_factory=UnitLimits)
    shard_size: int = 50_000_000
    eos_id: int = 1
    dtype: str = "uint16"
    matcher: Callable[[DataFrame, str, list[str]], DataFrame] = contains_any
    stale: str = "error"

    def __post_init__(self) -> None:
        if self.stale not in ("error", "remove"):
            raise ValueError("stale units are an error or are removed")
        lock_identity(self.spark, self.folder, {**self.identity, "plans": self.plans, "patterns": list(self.patterns), "shard_size": self.shard_size})
        self.journal = Journal(self.spark, self.folder)

    def _items(self, plan: Mapping[str, Any], source: str) -> dict[str, int]:
        return {f"{plan['stage']}:{i['item_id']}": int(i["token_quota"]) for i in plan["items"] if i["source_id"] == source}

    def _history(self) -> DataFrame | None:
        """(content_sha256) accepted by all units before; one narrow column, never the texts."""
        places = [f"{self.folder}/{e['path']}/hashes" for e in self.journal.entries()]
        return self.spark.read.schema("content_sha256 string").parquet(*places) if places else None

    def _judge(self, plan: Mapping[str, Any], source: str, start: int) -> tuple[DataFrame, int] | None:
        """The rows of a stretch with their disposition and where the stretch ends; None behind the last row."""
        index = F.col("row_index")
        raw = self.rows(plan["stage"], source).filter((index >= start) & (index < start + self.limits.rows))
        records = store(source_records(raw, self.sources[source], plan["stage"]), "unit-rows")
        end = records.agg(F.max("row_index")).first()[0]
        if end is None:
            return None
        some = shuffled_windows(records.filter("reason is null").drop("reason"), int(plan["buffer_size"]), int(plan["seed"]))
        some = some.withColumn("holdout", hash_fraction(F.col("content_sha256"), EXCLUSIVE) < float(plan.get("validation_fraction", 0.0)))
        some = some.withColumn("plan_item", F.concat_ws(":", "stage", item_id(F.col("source_id"), F.col("bucket_id"))))
        policy = QualityPolicy(self.policy.enabled, self.policy.min_chars, self.policy.max_chars, exact_dedup=False)
        some = judged(some, policy, list(self.patterns), position="row_index", matcher=self.matcher).drop("contaminated")
        old = self._history()
        if old is not None and self.policy.exact_dedup:
            some = some.join(old.distinct().withColumn("_seen", F.lit(True)), "content_sha256", "left")
            some = some.withColumn("reason", F.coalesce("reason", F.when(F.col("_seen"), "duplicate_exact"))).drop("_seen")
        if self.tokenizer:
            some = encode(some.withColumn("_t", F.when(F.col("reason").isNull(), F.col("text"))), self.tokenizer, "_t", "ids").drop("_t").withColumn("tokens", F.size("ids").cast("long"))
        else:
            some = some.withColumn("tokens", F.col("estimated_tokens"))
        used = self.journal.used()
        left = [(item, max(0, quota - used.get(item, 0))) for item, quota in self._items(plan, source).items()]
        quotas = self.spark.createDataFrame(left, "plan_item string, token_quota long")
        some = store(some, "unit-encoded")
        digest = F.col("content_sha256") if self.policy.exact_dedup else F.col("row_index").cast("string")
        filled = fill_quotas(some.withColumn("_digest", digest), quotas, ["window", "order_key", "row_index"], item="plan_item", digest="_digest").drop("_digest")
        blank = records.filter("reason is not null").withColumn("disposition", F.col("reason")).withColumn("accepted", F.lit(False))
        out = store(filled.unionByName(blank, allowMissingColumns=True), "unit-filled")
        discard(records, some)
        return out, int(end) + 1

    def _seal_at(self, filled: DataFrame, items: dict[str, int], end: int) -> int:
        """The raw row behind the first window after which the unit is full; a row per window is looked at."""
        used, size, tokens = self.journal.used(), 0, 0
        mine = F.when(F.col("disposition") == "train", F.col("tokens")).otherwise(0)
        per = filled.filter("window is not null").groupBy("window", "plan_item").agg(F.max("row_index").alias("last"), F.sum(mine).alias("t"), F.sum(F.when(F.col("accepted"), F.octet_length("text")).otherwise(0)).alias("b"))
        windows: dict[int, list] = {}
        for r in per.collect():
            windows.setdefault(r["window"], []).append(r)
        for w in sorted(windows):
            full = False
            for r in windows[w]:
                size, tokens = size + r["b"], tokens + r["t"]
                before = used.get(r["plan_item"], 0)
                used[r["plan_item"]] = before + r["t"]
                full |= before < items[r["plan_item"]] <= used[r["plan_item"]]
            if full or size >= self.limits.text_bytes or tokens >= self.limits.tokens:
                return max(r["last"] for r in windows[w]) + 1
        return end

    def _unit(self, plan: Mapping[str, Any], source: str) -> dict[str, Any] | None:
        """Make, write and commit the next unit of a stage's source."""
        start = self.journal.cursor(plan["stage"], source)
        found = self._judge(plan, source, start)
        if found is None:
            return None
        filled, end = found
        end = self._seal_at(filled, self._items(plan, source), end)
        rows = filled.filter(F.col("row_index") < end)
        path = f"units/{plan['stage']}/{source}/{start:012d}"
        place = f"{self.folder}/{path}"
        if exists(self.spark, place):  # without a journal entry: the remains of a failed attempt
            if self.stale == "error":
                raise FileExistsError(f"{place} is no unit of the journal; resume with stale='remove'")
            remove(self.spark, place)
        kept = rows.filter("accepted").drop("ids", "accepted")
        order = ["window", "order_key", "row_index"]
        for part, split in (("fit", "train"), ("holdout", "holdout")):
            lines = kept.filter(F.col("disposition") == split)
            lines.select(*order, json_line([c for c in lines.columns if c not in order]).alias("value")).sort(*order).select("value").write.text(f"{place}/{part}")
        kept.select("content_sha256").write.parquet(f"{place}/hashes")
        if self.tokenizer:
            # the last shard of a unit may be short
            write_shards(rows.filter("accepted").select(*order, "disposition", "ids"), f"{place}/shards", order, self.shard_size, eos_id=self.eos_id, dtype=self.dtype, group=["disposition"])
        files = file_table(self.spark, place).collect()  # as many as a unit has files
        root = file_system(self.spark, place)[1].toUri().getPath()
        named = [{"path": f"{path}{r['path'].split(root, 1)[1]}", "size": r["size"], "sha256": r["sha256"]} for r in files]
        is_ = lambda d: F.count_if(F.col("disposition") == d)
        over = F.col("disposition") == "over_quota"
        encoded = F.col("tokens").isNotNull() & (F.col("tokens") >= 0)
        c = rows.agg(
            F.count("*").alias("raw"), F.count_if(F.coalesce(F.col("disposition") != "empty_text", F.lit(True))).alias("read"), F.count_if(F.col("window").isNotNull()).alias("normalized"), F.count_if(F.col("accepted")).alias("accepted"), is_("holdout").alias("held_out"), is_("train").alias("corpus"),
            F.count_if(over & encoded).alias("discarded_encoded"), F.count_if(over & ~encoded).alias("discarded_unencoded"), F.count_if(~F.col("disposition").isin("train", "holdout", "over_quota")).alias("rejected"),
        ).first()
        reasons = {r["disposition"]: r["count"] for r in rows.filter(~F.col("disposition").isin("train", "holdout", "over_quota")).groupBy("disposition").count().collect()}
        items = {r["plan_item"]: r["t"] for r in rows.filter("disposition = 'train'").groupBy("plan_item").agg(F.sum("tokens").alias("t")).collect()}
        entry = {"stage": plan["stage"], "source": source, "start": start, "end": end, "path": path, "items": dict(sorted(items.items())), "counters": {k: c[k] for k in COUNTERS}, "reasons": dict(sorted(reasons.items())), "artifacts": sorted(named, key=lambda a: a["path"])}
        done = self.journal.commit(entry)
        discard(filled)
        return done

    def run(self, stop: Callable[[], bool] = lambda: False, most_tokens: int | None = None, delays: Iterable[float] = (1.0, 5.0, 25.0), publish_to: str | None = None) -> dict[str, Any]:
        """Make units until all items are full or their sources exhausted; between units ``stop`` may end the run, and a calibration ends with ``most_tokens``. Returns :meth:`status`."""
        tokens = 0
        for plan in self.plans:
            for source in sorted({i["source_id"] for i in plan["items"]}):
                items = self._items(plan, source)
                while any(self.journal.used().get(i, 0) < q for i, q in items.items()):
                    if stop() or most_tokens is not None and tokens >= most_tokens:
                        return self.status()
                    if free_bytes(self.spark, self.folder) < self.limits.free_bytes:
                        raise OSError(f"less than {self.limits.free_bytes} bytes are free at {self.folder}")
                    unit = retrying(functools.partial(self._unit, plan, source), delays)
                    if unit is None:
                        break
                    tokens += sum(unit["items"].values())
                    if publish_to:
                        publish_units(self.journal, publish_to, self.limits.free_bytes)
        return self.status()

    def status(self) -> dict[str, Any]:
        """Units, cursors, counters, and requested, actual and remaining tokens of every item."""
        entries, used = self.journal.entries(), self.journal.used()
        items = {i: q for plan in self.plans for s in sorted({x["source_id"] for x in plan["items"]}) for i, q in self._items(plan, s).items()}
        cursors: dict[str, int] = {}
        for e in entries:
            cursors[f"{e['stage']}:{e['source']}"] = e["end"]
        return {
            "units": len(entries), "published": len(self.journal.published()), "cursors": cursors, "counters": {k: sum(e["counters"][k] for e in entries) for k in COUNTERS},
            "items": {i: {"requested": q, "actual": used.get(i, 0), "remaining": max(0, q - used.get(i, 0))} for i, q in items.items()}, "complete": all(used.get(i, 0) >= q for i, q in items.items()),
        }

    def records(self, part: str = "fit") -> DataFrame:
        """The records of all committed units."""
        places = [f"{self.folder}/{e['path']}/{part}" for e in self.journal.entries()]
        return self.spark.read.json(places) if places else self.spark.createDataFrame([], "content_sha256 string, tokens long")

    def finalize(self) -> dict[str, Any]:
        """The evidence of a complete build: quotas, counters, files as they are now, overlap of fit and held-out texts; ``manifest.json`` is written last, once, and only if all of it holds."""
        state = self.status()
        fit, held = self.records(), self.records("holdout")
        shared = fit.select("content_sha256").join(held.select("content_sha256"), "content_sha256", "left_semi").count() if {"content_sha256"} <= set(fit.columns) & set(held.columns) else 0
        repeated = fit.groupBy("content_sha256").count().filter("count > 1").count() if self.policy.exact_dedup and "content_sha256" in fit.columns else 0
        wrong = [p for e in self.journal.entries() for p in changed_files(self.spark, self.folder, e)]
        c = state["counters"]
        balanced = c["raw"] == sum(c[k] for k in ("corpus", "held_out", "discarded_encoded", "discarded_unencoded", "rejected"))
        licenses = {str(r["license"]): r["count"] for r in fit.groupBy("license").count().collect()} if "license" in fit.columns else {}
        body = {"status": state, "licenses": licenses, "overlap": shared, "repeated": repeated, "changed_files": wrong[:100], "passed": bool(state["complete"] and not shared and not repeated and not wrong and balanced)}
        body["manifest_sha256"] = json_sha256(body)
        if body["passed"]:
            write_bytes(self.spark, f"{self.folder}/manifest.json", json.dumps(body, sort_keys=True, ensure_ascii=False, indent=1).encode())
        return body


def changed_files(spark: SparkSession, root: str, entry: Mapping[str, Any]) -> list[str]:
    """Artifacts of a unit that are missing under ``root`` or have other bytes than its journal entry says."""
    place = f"{root}/{entry['path']}"
    if not exists(spark, place):
        return [a["path"] for a in entry["artifacts"]]
    base = file_system(spark, place)[1].toUri().getPath()
    found = {f"{entry['path']}{r['path'].split(base, 1)[1]}": (r["size"], r["sha256"]) for r in file_table(spark, place).collect()}
    return [a["path"] for a in entry["artifacts"] if found.get(a["path"]) != (a["size"], a["sha256"])]


def publish_units(journal: Journal, target: str, free: int = 0, delete: bool = False) -> list[int]:
    """Copy committed units to ``target``, each checked there by its hashes before it takes its place and the journal says so; with ``delete`` the own copy goes then.

    Less than ``free`` bytes beside a unit's size is an error. A copy with other bytes is set aside under ``quarantine`` and is an error. A unit that a crash left in place is
    checked and marked, and a half-made copy is made again.
    """
    spark, done = journal.spark, []
    copy = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def aside(place: str, entry: Mapping[str, Any], wrong: list[str]) -> None:
        move(spark, place, f"{target}/quarantine/{entry['unit']:09d}-{time.time_ns()}")
        raise OSError(f"unit {entry['unit']} has other bytes at its target: {wrong[0]}")

    for entry in journal.entries():
        if entry["unit"] in journal.published():
            continue
        final = f"{target}/{entry['path']}"
        if not exists(spark, final):
            size = sum(a["size"] for a in entry["artifacts"])
            if free_bytes(spark, target) - size < free:
                raise OSError(f"unit {entry['unit']} needs {size} bytes beside the {free} to be left free at {target}")
            staging = f"{target}/.staging-{entry['unit']:09d}"
            remove(spark, staging)
            (fs, source), (goal_fs, goal) = file_system(spark, f"{journal.folder}/{entry['path']}"), file_system(spark, f"{staging}/{entry['path']}")
            goal_fs.mkdirs(goal.getParent())
            copy(fs, source, goal_fs, goal, False, conf)
            if wrong := changed_files(spark, staging, entry):
                aside(staging, entry, wrong)
            move(spark, f"{staging}/{entry['path']}", final)
            remove(spark, staging)
        elif wrong := changed_files(spark, target, entry):
            aside(final, entry, wrong)
        journal.mark_published(entry["unit"], target)
        done.append(entry["unit"])
        if delete:
            for part in ("fit", "holdout", "shards"):  # hashes stay: they are the history of later units
                remove(spark, f"{journal.folder}/{entry['path']}/{part}")
    return done
