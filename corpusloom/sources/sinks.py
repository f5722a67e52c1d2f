"""Writing corpora: staged and verified publication, bounded chunks, binary shards, review bundles and evidence."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.hashing import block_digest, json_sha256
from corpusloom.operators.tokens import build_shards
from corpusloom.operators.windows import prefix_sums
from corpusloom.sources.paths import file_system


def json_line(columns: list[str]) -> Any:
    """A row as a JSON line with its keys in order, nulls kept."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def _fs(spark: SparkSession, path: str):
    return (*file_system(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path)


def publish(spark: SparkSession, path: str, write: Callable[[str], None], verify: Callable[[str], None] | None = None, replace: bool = False) -> str:
    """Write to a staging folder beside ``path``, verify it, and rename it into place; an older version is kept until then, and put back if the rename fails.

    A failed write or check leaves what was published before untouched and removes the staging folder.
    """
    fs, target, make = _fs(spark, path)
    if fs.exists(target) and not replace:
        raise FileExistsError(path)
    staging, backup = f"{path}.staging-{uuid.uuid4().hex}", make(f"{path}.backup-{uuid.uuid4().hex}")
    try:
        write(staging)
        if verify:
            verify(staging)
    except BaseException:
        fs.delete(make(staging), True)
        raise
    old = fs.exists(target)
    if old and not fs.rename(target, backup):
        raise OSError(f"can't set {path} aside")
    if not fs.rename(make(staging), target):
        if old:
            fs.rename(backup, target)
        raise OSError(f"can't move the staging folder to {path}")
    if old:
        fs.delete(backup, True)
    return path


def split_report(records: DataFrame, order: str, *, split: str = "split") -> DataFrame:
    """Per split: documents, bytes of JSON lines, characters, and an order-sensitive hash of hashes over blocks of rows, so that no row holds a split."""
    line = json_line([c for c in records.columns if c != order])
    sums = records.groupBy(split).agg(F.count("*").alias("documents"), F.sum(F.octet_length(line).cast("long") + 1).alias("bytes"), F.sum("num_chars").alias("total_chars"))
    placed = prefix_sums(records.select(split, order, "text_sha256"), [order], {"_at": F.lit(1)}, [split])
    return sums.join(block_digest(placed, [split], "_at", "text_sha256").select(split, F.col("digest").alias("documents_sha256")), split)


def write_splits(records: DataFrame, path: str, *, split: str = "split", order: str | None = None, caps: dict[str, int] | None = None, replace: bool = False) -> str:
    """JSON lines per split, each split at most as many documents as its cap, first ones first."""
    if caps:
        if order is None:
            raise ValueError("caps need an order")
        limit = F.coalesce(*[F.when(F.col(split) == s, F.lit(n)) for s, n in caps.items()], F.lit(1 << 62))
        records = prefix_sums(records, [order], {"_n": F.lit(1)}, [split]).filter(F.col("_n") < limit).drop("_n")
    return publish(records.sparkSession, path, lambda p: records.write.partitionBy(split).json(p), replace=replace)


def write_chunks(records: DataFrame, path: str, order: list[str], chunk_bytes: int, replace: bool = False) -> str:
    """JSON lines in chunks of about ``chunk_bytes``: a chunk is a range of the running sum of line sizes, so chunks are numbered the same however rows are partitioned; one line is never cut."""
    columns = records.columns
    sized = prefix_sums(records.withColumn("_line", json_line(columns)), order, {"_at": F.octet_length("_line") + 1})
    out = sized.select(F.floor(F.col("_at") / chunk_bytes).cast("long").alias("chunk"), F.col("_line").alias("value"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    sort = [f"_o{i}" for i in range(len(order))]
    return publish(records.sparkSession, path, lambda p: out.repartition("chunk").sortWithinPartitions("chunk", *sort).select("chunk", "value").write.partitionBy("chunk").text(p), replace=replace)


def write_shards(documents: DataFrame, path: str, order: list[str], shard_size: int, *, eos_id: int = 1, dtype: str = "uint16", group: list[str] | None = None, replace: bool = False) -> str:
    """Binary token shards, one file each, written by the tasks that hold them, and a table of their metadata beside.

    A task writes a shard under a temporary name and renames it, so a repeated or speculative task leaves one whole file. ``path`` must be a folder all machines share. On
    any other file system than mounted folders (``hdfs:``, object stores) the shards are a Parquet table ``bin`` of their bytes, one row each, which Spark commits as a whole;
    ``path`` in the metadata is then the name they would have.
    """
    spark = documents.sparkSession
    shards = build_shards(documents, order, shard_size, eos_id=eos_id, group=group, dtype=dtype, keep_ids=False)
    group = group or []
    mounted = path.startswith("file:") or "://" not in path and file_system(spark, path)[0].getScheme() == "file"

    def write(staging: str) -> None:
        if not mounted:
            name = F.concat_ws("/", F.lit("bin"), *[F.concat(F.lit(f"{g}="), F.col(g).cast("string")) for g in group], F.format_string("shard_%05d.bin", F.col("shard_index").cast("long")))
            shards.withColumn("path", name).write.parquet(f"{staging}/bin")
            spark.read.parquet(f"{staging}/bin").drop("payload").write.parquet(f"{staging}/metadata")
            return
        root = staging.removeprefix("file://").removeprefix("file:")

        def save(frames):
            for pdf in frames:
                names = []
                for _, row in pdf.iterrows():
                    folder = os.path.join(root, "bin", *[f"{g}={row[g]}" for g in group])
                    os.makedirs(folder, exist_ok=True)
                    name = os.path.join(folder, f"shard_{int(row['shard_index']):05d}.bin")
                    with open(part := f"{name}.{uuid.uuid4().hex}", "wb") as out:
                        out.write(row["payload"])
                        out.flush()
                        os.fsync(out.fileno())
                    os.replace(part, name)
                    names.append(os.path.relpath(name, root))
                yield pdf.drop(columns=["payload"]).assign(path=names)

        schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in shards.schema if f.name != "payload"), "path string"])
        shards.mapInPandas(save, schema).write.parquet(f"{staging}/metadata")

    return publish(spark, path, write, replace=replace)


def split_metadata(shards: DataFrame, *, documents: int, tokenizer_sha256: str, dtype: str, shard_size: int, append_eos: bool = True, split: str = "train") -> dict[str, Any]:
    """Portable metadata of a split's shards with its own hash. ``shards`` has path, shard_index, byte_size, num_tokens and sha256; there is one row per file."""
    rows = [{"path": r.path, "index": r.shard_index, "byte_size": r.byte_size, "num_tokens": r.num_tokens, "sha256": r.sha256} for r in shards.select("path", "shard_index", "byte_size", "num_tokens", "sha256").orderBy("shard_index").toLocalIterator()]
    body = {"split": split, "tokenizer_sha256": tokenizer_sha256, "dtype": dtype, "append_eos": append_eos, "shard_size_tokens": shard_size, "total_documents": documents, "total_tokens": sum(r["num_tokens"] for r in rows), "shards": rows}
    return body | {"metadata_sha256": json_sha256(body)}


def write_evidence(spark: SparkSession, path: str, value: dict[str, Any]) -> str:
    """A JSON document that is written once: the same content again is fine, other content is an error."""
    text = json.dumps(value, ensure_ascii=False, sort_keys=True, indent=1)
    fs, target, make = _fs(spark, path)
    if fs.exists(target):
        if spark.read.text(path, wholetext=True).first()[0] != text:
            raise FileExistsError(f"{path} has other content")
        return path
    part = make(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, target):
        raise OSError(f"can't publish {path}")
    return path


def manifest(stats: DataFrame, **fields: Any) -> dict[str, Any]:
    """A manifest of the rows of a small statistics table, with its own hash."""
    body = fields | {"splits": [r.asDict(True) for r in stats.collect()]}
    return body | {"manifest_sha256": json_sha256(body)}


def append_metrics(rows: DataFrame, path: str) -> None:
    """Append metric rows as CSV with the fixed header."""
    from corpusloom.operators.runs import METRICS

    if set(rows.columns) != set(METRICS):
        raise ValueError("metric rows must have exactly the fixed columns")
    rows.select(*METRICS).write.mode("append").option("header", True).csv(path)


def write_reviews(reviews: DataFrame, path: str, *, replace: bool = False) -> str:
    """A blinded bundle: batches with ``review_id, prompt, text`` only, and the key in a folder of its own."""
    shown = ["review_id", "prompt", "text"]
    hidden = [c for c in reviews.columns if c not in ("prompt", "text", "batch")]

    def write(p: str) -> None:
        reviews.select("batch", *shown).write.partitionBy("batch").json(f"{p}/batches")
        reviews.select(*hidden).coalesce(1).write.json(f"{p}/key")

    def verify(p: str) -> None:
        leaked = set(reviews.sparkSession.read.json(f"{p}/batches").columns) - {*shown, "batch"}
        if leaked:
            raise ValueError(f"the batches show {sorted(leaked)}")

    return publish(reviews.sparkSession, path, write, verify, replace)


def byte_chunks(records: DataFrame, order: list[str], size, chunk_bytes: int, group: list[str]) -> DataFrame:
    """Adds ``chunk``: chunks closed *before* the row that would overfill them, which depends on all rows before. Rows of one group pass one task in
    order as a stream; group by something bounded, such as a unit or a file."""
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in records.schema), "chunk int"])
    ready = records.withColumn("_size", size)

    def deal(pdf):
        pdf = pdf.sort_values(order)
        chunk, held, out = 0, 0, []
        for n in pdf["_size"]:
            if held and held + n > chunk_bytes:
                chunk, held = chunk + 1, 0
            held += n
            out.append(chunk)
        return pdf.drop(columns="_size").assign(chunk=out)

    return ready.groupBy(*group).applyInPandas(deal, schema)
