"""Incremental builds with Structured Streaming: exactly-once units, resumable, with history kept between micro-batches."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corpusloom.functions.hashing import json_sha256
from corpusloom.functions.text import normal_form
from corpusloom.operators.filters import first_copies
from corpusloom.sources.sinks import _fs


def lock_identity(spark: SparkSession, folder: str, identity: dict[str, Any]) -> str:
    """Bind a build's folder to its inputs: the first call writes their hash, later ones must bring the same, or the build is refused."""
    digest = json_sha256(identity)
    path = f"{folder}/identity.json"
    fs, target, _ = _fs(spark, path)
    if fs.exists(target):
        kept = json.loads(spark.read.text(path, wholetext=True).first()[0])
        if kept["sha256"] != digest:
            raise ValueError("the inputs of this build have changed; it can't be resumed")
        return digest
    out = fs.create(target, False)
    out.write(bytearray(json.dumps({"identity": identity, "sha256": digest}, sort_keys=True, ensure_ascii=False).encode()))
    out.close()
    return digest


def _unit_path(folder: str, batch: int) -> str:
    return f"{folder}/units/unit={batch:09d}"


def _units(spark: SparkSession, folder: str, before: int) -> list[str]:
    """Folders of the units committed before a batch. A unit of the same or a later number is the remains of a failed attempt and isn't history."""
    fs, root, make = _fs(spark, f"{folder}/units")
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root)]
    return sorted(str(p) for p in found if int(p.getName().split("=")[1]) < before and fs.exists(make(p, "_SUCCESS")))


def unit_writer(folder: str, *, text: str = "text", source: str = "source_id", order: str = "row_index", min_chars: int = 1, tokens: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that seals every micro-batch as one unit: its accepted records, those new by content hash against all units before it and within it.

    The unit's folder is named by the batch and overwritten as a whole, so a batch that is run again after a failure leaves the same unit once. History is read by hash only, from the units' columns.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_n", normal_form(F.col(text))).withColumns({"text": F.col("_n.text"), "content_sha256": F.col("_n.sha256"), "num_chars": F.col("_n.chars")}).drop("_n")
        rows = rows.filter(F.col("num_chars") >= max(1, min_chars))
        rows = first_copies(rows.withColumn("_at", F.struct(source, order)), "content_sha256", "_at").drop("_at")
        old = _units(spark, folder, number)
        if old:
            rows = rows.join(spark.read.parquet(*old).select("content_sha256"), "content_sha256", "left_anti")
        if tokens:
            rows = tokens(rows)
        rows.write.mode("overwrite").parquet(_unit_path(folder, number))

    return write


def run_build(stream: DataFrame, folder: str, identity: dict[str, Any], **options: Any):
    """Run a stream of raw rows into units under ``folder`` until all that is there is read; the checkpoint beside them makes the next call go on where this one ended."""
    spark = stream.sparkSession
    lock_identity(spark, folder, identity)
    query = stream.writeStream.foreachBatch(unit_writer(folder, **options)).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """All records of a build, with their unit."""
    return spark.read.option("basePath", f"{folder}/units").parquet(*_units(spark, folder, 1 << 62))


def build_state(spark: SparkSession, folder: str, *, source: str = "source_id", order: str = "row_index", tokens: str | None = None) -> DataFrame:
    """Per source: units, records, raw cursor and, if counted, tokens of a build so far."""
    aggs = [F.count_distinct("unit").alias("units"), F.count("*").alias("records"), (F.max(order) + 1).alias("row_cursor")]
    if tokens:
        aggs.append(F.sum(tokens).alias("quota_tokens"))
    return committed(spark, folder).groupBy(source).agg(*aggs)


def count_window_stream(stream: DataFrame, size: int, *, key: str = "source_id", order: str = "row_index") -> DataFrame:
    """Streaming count windows: (key, order, window), the windows of a key filled in the order of arrival of micro-batches and of ``order`` within one.

    The state of a key is the number of its rows so far. Rows of a key must come in order from batch to batch, as from a single ordered source.
    """
    kinds = {f.name: f.dataType for f in stream.schema}
    out = T.StructType([T.StructField(key, kinds[key]), T.StructField(order, kinds[order]), T.StructField("window", T.LongType())])

    def assign(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        places = pd.concat([f[order] for f in frames]).sort_values(ignore_index=True)
        state.update((seen + len(places),))
        yield pd.DataFrame({key: [k[0]] * len(places), order: places, "window": (seen + pd.RangeIndex(len(places))) // size})

    return stream.select(key, order).groupBy(key).applyInPandasWithState(assign, out, "seen long", "append", GroupStateTimeout.NoTimeout)


def dedup_stream(stream: DataFrame, digest: str = "content_sha256") -> DataFrame:
    """The first row of every hash in a stream; the hashes seen are the state. Without a watermark it grows with the distinct texts, which is what global deduplication means; see :func:`unit_writer` for history in tables."""
    return stream.dropDuplicates([digest])


class ProgressFile(StreamingQueryListener):
    """Writes the progress of a build's micro-batches to a JSON file on the driver, at most every ``interval`` seconds, and at its end."""

    def __init__(self, path: str, interval: float = 5.0) -> None:
        self.path, self.interval, self.last, self.rows = path, interval, 0.0, 0

    def _write(self, state: dict[str, Any]) -> None:
        part = f"{self.path}.part"
        with open(part, "w", encoding="utf-8") as out:
            json.dump(state, out, sort_keys=True)
        os.replace(part, self.path)

    def onQueryStarted(self, event) -> None:
        self._write({"status": "running", "rows": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.rows += p.numInputRows
        if time.monotonic() - self.last >= self.interval:
            self.last = time.monotonic()
            self._write({"status": "running", "batch": p.batchId, "rows": self.rows, "rows_per_second": p.processedRowsPerSecond})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._write({"status": "failed" if event.exception else "complete", "rows": self.rows})
