"""Normalized document records from raw rows: identity, provenance, and rows that can't be used."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import scalars as S
from corpusloom.functions.text import normal_form

# Fixed values.
#: Names under which a text column is looked for, in this order.
TEXT_NAMES = ("text", "story", "content", "article", "document")
#: Roles whose sources may enter a corpus.
CORPUS_ROLES = ("pretrain_general", "pretrain_telecom", "pretrain_structured")


@dataclass(frozen=True)
class Bucket:
    id: str
    collections: tuple[str, ...]
    weight: float


@dataclass(frozen=True)
class Source:
    """Where the documents of a source come from and which fields say what."""

    id: str
    name: str
    split: str = "train"
    config: str | None = None
    revision: str | None = None
    role: str = "pretrain_general"
    license: str | None = None
    license_review: str | None = None
    text_field: str | None = "text"
    document_id_field: str | None = None
    license_field: str | None = None
    collection: str | None = None
    collection_field: str | None = None
    token_count_field: str | None = None
    data_files: tuple[str, ...] = ()
    buckets: tuple[Bucket, ...] = field(default=())


def detect_text_field(columns: list[str]) -> str:
    """The text column by its name, else the only column there is."""
    for name in TEXT_NAMES:
        if name in columns:
            return name
    if len(columns) == 1:
        return columns[0]
    raise ValueError(f"no text column among {columns}")


def simple_records(rows: DataFrame, dataset: str, split: str, *, text: str = "text", index: str = "row_index", source_id: str | None = None, already_nfkc: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of one dataset: ``id, dataset, split, source_id, text, text_sha256, num_chars`` beside the row index. Null texts and texts that normalize to nothing give no record."""
    own = F.col(source_id).cast("string") if source_id else F.lit(None).cast("string")
    sid = F.coalesce(own, F.col(index).cast("string"))
    out = rows.filter(F.col(text).isNotNull()).select(F.col(index), *keep, sid.alias("source_id"), normal_form(F.col(text), already_nfkc).alias("_n")).filter("_n.chars > 0")
    return out.select(index, *keep, F.concat_ws("/", F.lit(dataset), F.lit(split), "source_id").alias("id"), F.lit(dataset).alias("dataset"), F.lit(split).alias("split"), "source_id", F.col("_n.text").alias("text"), F.col("_n.sha256").alias("text_sha256"), F.col("_n.chars").alias("num_chars"))


def _required(value: Column, message: str) -> Column:
    trimmed = F.trim(value.cast("string"))
    return F.when(trimmed.isNull() | (trimmed == ""), F.raise_error(F.lit(message)).cast("string")).otherwise(trimmed)


def source_records(rows: DataFrame, source: Source, stage: str, *, index: str = "row_index", already_nfkc: bool = False) -> DataFrame:
    """Provenance records of a source's rows, with ``bucket_id`` by the collection and ``reason`` ``empty_text`` where nothing is left of a text.

    A missing text, a licence or collection that a field ought to give but doesn't, and a collection of no bucket are errors. A source without buckets has a null bucket.
    """
    if source.role not in CORPUS_ROLES:
        raise ValueError(f"source {source.id!r} has the role {source.role!r}, which may not enter a corpus")
    if source.text_field is None:
        raise ValueError(f"source {source.id!r} has no text field")
    raw = F.col(source.text_field)
    present = F.when(raw.isNull(), F.raise_error(F.concat(F.lit(f"source {source.id} has no {source.text_field} in row "), F.col(index).cast("string"))).cast("string")).otherwise(raw)
    rows = rows.withColumn("_n", normal_form(present, already_nfkc)).withColumns({"_text": F.col("_n.text"), "_sha": F.col("_n.sha256")})
    given = F.col(source.document_id_field) if source.document_id_field else F.lit(None).cast("string")
    blank = F.col("_text") == ""
    license_ = F.lit(source.license) if not source.license_field else F.when(~blank, _required(F.col(source.license_field), f"source {source.id} has a row without its document-level license"))
    collection = F.lit(source.collection or source.id) if not source.collection_field else F.when(~blank, _required(F.col(source.collection_field), f"source {source.id} has a row without its collection"))
    bucket = F.lit(None).cast("string")
    if source.buckets:
        # a bucket is a set of collections named in the registry
        bucket = F.raise_error(F.concat(F.lit(f"source {source.id} has no bucket for collection "), F.col("collection"))).cast("string")
        for b in source.buckets:
            bucket = F.when(F.col("collection").isin(list(b.collections)), b.id).otherwise(bucket)
        bucket = F.when(F.col("collection").isNotNull(), bucket)
    declared = F.col(source.token_count_field) if source.token_count_field else None
    rows = rows.withColumns({"_doc": S.document_id(given, F.col("_sha")), "_est": S.token_estimate(F.col("_text"), declared), "_license": license_, "collection": collection})
    return rows.select(
        index, F.concat_ws("/", F.lit(source.id), F.lit(stage), "_doc").alias("id"), F.lit(source.name).alias("dataset"), F.lit(source.split).alias("split"), F.lit(source.id).alias("source_id"), "collection",
        F.col("_doc").alias("document_id"), F.col("_license").alias("license"), F.lit(source.license_review).alias("license_review"), F.lit(source.role).alias("role"), F.lit(stage).alias("stage"), bucket.alias("bucket_id"),
        F.col("_text").alias("text"), F.col("_sha").alias("content_sha256"), F.col("_sha").alias("text_sha256"), F.col("_n.chars").alias("num_chars"), F.col("_est").alias("estimated_tokens"),
        F.when(blank, "empty_text").alias("reason"),
    )


def with_source(records: DataFrame, registry: DataFrame, columns: list[str], key: str = "source_id") -> DataFrame:
    """Adds columns of the registry to records. The registry is a dimension table; repeated ids are an error at the driver before anything is joined."""
    repeated = registry.groupBy(key).count().filter("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"repeated source {repeated[0][key]!r}")
    return records.join(registry.select(key, *columns), key, "left")


def with_bucket(records: DataFrame, registry: DataFrame, *, source: str = "source_id", collection: str = "collection", strict: bool = False) -> DataFrame:
    """Adds ``bucket_id`` by source and collection, null where the source has no bucket for it, which ``strict`` makes an error for sources that have buckets."""
    rows = registry.select(F.col(source).alias("_s"), F.explode("buckets").alias("_b")).select("_s", F.col("_b.id").alias("bucket_id"), F.explode("_b.collections").alias("_c"))
    out = records.join(rows, (F.col(source) == F.col("_s")) & (F.col(collection) == F.col("_c")), "left").drop("_s", "_c")
    if strict:
        bucketed = registry.filter(F.size("buckets") > 0).select(F.col(source).alias("_s"))
        lost = F.col("_s").isNotNull() & F.col("bucket_id").isNull()
        out = out.join(bucketed, F.col(source) == F.col("_s"), "left").withColumn("bucket_id", F.when(lost, F.raise_error(F.concat_ws("/", F.lit("no bucket for"), F.col(source), F.col(collection))).cast("string")).otherwise(F.col("bucket_id"))).drop("_s")
    return out


def require_roles(records: DataFrame, role: str = "role") -> DataFrame:
    """The same rows; one whose role may not enter a corpus is an error."""
    bad = ~F.coalesce(F.col(role).isin(*CORPUS_ROLES), F.lit(False))
    return records.withColumn(role, F.when(bad, F.raise_error(F.concat(F.lit("role may not enter a corpus: "), F.coalesce(F.col(role), F.lit("null")))).cast("string")).otherwise(F.col(role)))
