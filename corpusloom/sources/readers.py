"""Reading raw rows, records, patterns, shards, metrics and files, strictly where the data ought to be exact."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import normalize
from corpusloom.operators.records import Source
from corpusloom.operators.runs import METRICS, strict_number
from corpusloom.operators.windows import prefix_sums

#: How a caller gives raw rows for a source; tests put their own in.
Loader = Callable[[SparkSession, Source], DataFrame]

SIMPLE_RECORD = T.StructType([*[T.StructField(c, T.StringType()) for c in ("id", "dataset", "split", "source_id", "text", "text_sha256")], T.StructField("num_chars", T.LongType())])
RECORD = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("id", "dataset", "split", "source_id", "collection", "document_id", "license", "license_review", "role", "stage", "bucket_id", "text", "content_sha256", "text_sha256")]
    + [T.StructField("num_chars", T.LongType()), T.StructField("estimated_tokens", T.LongType()), T.StructField("source_split", T.StringType())]
)
CHOICE_ITEM = "id string, prompt string, choices array<string>, answer string, category string"


def read_rows(spark: SparkSession, path: str | list[str], *, format: str | None = None, schema: T.StructType | str | None = None, glob: str | None = None) -> DataFrame:
    """Raw rows of Parquet, ORC, CSV or JSON-lines files (compressed or not), by a glob of file names if given; partition directories become columns and are pruned by filters."""
    first = path if isinstance(path, str) else path[0]
    kind = format or next((k for k in ("parquet", "orc", "csv") if f".{k}" in first), "json" if ".json" in first else "parquet")
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if kind == "json" and schema is not None:
        reader = reader.option("mode", "FAILFAST")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def file_loader(root: str) -> Loader:
    """A loader that reads ``root/<name>`` with a source's file globs."""

    def load(spark: SparkSession, source: Source) -> DataFrame:
        paths = [f"{root}/{source.name}/{g}" for g in source.data_files] or [f"{root}/{source.name}"]
        return read_rows(spark, paths)

    return load


def with_row_index(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Adds the position of every row in a total order, from 0."""
    return prefix_sums(df, order, {name: F.lit(1)})


def from_cursor(df: DataFrame, cursor: int, index: str = "row_index") -> DataFrame:
    """The rows from a raw cursor on."""
    if cursor < 0:
        raise ValueError("a cursor can't be negative")
    return df.filter(F.col(index) >= cursor)


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType = RECORD) -> DataFrame:
    """Records from JSON lines; blank lines are skipped, anything else that isn't a record of the schema is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_strict_records(spark: SparkSession, path: str | list[str], text: str = "text", digest: str = "content_sha256") -> DataFrame:
    """The same with every line checked: valid UTF-8, no blank line, an object, and a text that has the hash it claims."""
    raw = spark.read.format("text").option("wholetext", False).load(path).select("value", F.col("_metadata.file_path").alias("_file"))
    row = F.from_json("value", RECORD, {"mode": "PERMISSIVE"})
    bad = F.when(F.trim("value") == "", "blank line").when(~F.is_valid_utf8("value"), "not UTF-8").when(~F.startswith(F.trim("value"), F.lit("{")) | row[text].isNull(), "not a record").when(F.sha2(row[text].cast("binary"), 256) != F.coalesce(row[digest], F.lit("")), "wrong hash")
    checked = raw.select(F.when(bad.isNull(), row).otherwise(F.raise_error(F.concat(bad, F.lit(" in "), F.col("_file"))).cast(RECORD)).alias("r"))
    return checked.select("r.*")


def consumed_stream(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, records, bytes, sha256) of JSON-lines files, to prove two passes read the same."""
    files = file_table(spark, path)
    lines = spark.read.text(path).filter(F.trim("value") != "").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("records"))
    return files.join(lines, "path", "left").fillna(0, ["records"]).select(F.col("path").alias("file"), "records", F.col("size").alias("bytes"), "sha256")


def file_table(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, size, sha256) of files, hashed where they lie."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def read_patterns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Normalized, folded contamination patterns, one to a line; of a JSON object the first of ``text, prompt, content`` that isn't empty. Patterns are tests held by the driver; blank lines and empty patterns are left out."""
    t = F.trim("value")
    field = lambda name: F.nullif(F.get_json_object(t, f"$.{name}"), F.lit(""))
    raw = spark.read.text(path).filter(t != "").select(F.when(F.startswith(t, F.lit("{")), F.coalesce(field("text"), field("prompt"), field("content"), F.lit(""))).otherwise(t).alias("p"))
    folded = (normalize(r.p).casefold() for r in raw.toLocalIterator())
    return [p for p in folded if p]


def read_shards(spark: SparkSession, path: str | list[str], dtype: str = "uint16") -> DataFrame:
    """(path, ids, num_tokens, sha256) of binary shards of little-endian ids."""
    width = {"uint16": 2, "uint32": 4}[dtype]
    raw = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for b in batches:
            ids = [np.frombuffer(x, f"<u{width}").astype(np.int64) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int64())), b.column(1)], ["path", "ids", "content"])

    return raw.mapInArrow(run, "path string, ids array<long>, content binary").select("path", "ids", F.size("ids").cast("long").alias("num_tokens"), F.sha2("content", 256).alias("sha256"))


def verify_shards(shards: DataFrame, metadata: DataFrame) -> DataFrame:
    """Shards against their metadata (path, num_tokens, sha256): rows that are missing or differ."""
    m = metadata.select("path", F.col("num_tokens").alias("_n"), F.col("sha256").alias("_s"))
    both = shards.join(m, "path", "full_outer")
    return both.filter(~F.coalesce((F.col("num_tokens") == F.col("_n")) & (F.col("sha256") == F.col("_s")), F.lit(False))).select("path", "num_tokens", F.col("_n").alias("claimed_tokens"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A run's metric table: numbers strict, empty fields null; the header must be exactly the expected one, and ``line`` keeps the order of the file."""
    raw = spark.read.option("header", True).csv(path)
    if tuple(raw.columns) != METRICS:
        raise ValueError(f"unexpected header: {raw.columns}")
    texts = {"event"}
    rows = raw.select(*[F.col(c) if c in texts else strict_number(F.col(c), c).alias(c) for c in METRICS], F.monotonically_increasing_id().alias("line"))
    return rows


def read_choice_items(spark: SparkSession, path: str) -> DataFrame:
    """Multiple-choice items from JSON lines; repeated ids are an error."""
    items = spark.read.schema(CHOICE_ITEM).option("mode", "FAILFAST").json(path)
    over = Window.partitionBy("id")
    return items.withColumn("id", F.when(F.count("*").over(over) > 1, F.raise_error(F.concat(F.lit("repeated id: "), F.col("id"))).cast("string")).otherwise(F.col("id")))


def read_story_prompts(spark: SparkSession, path: str) -> DataFrame:
    """Prompts (id, category, text) from JSON lines; a missing field, a repeated id or a repeated text is an error."""
    rows = spark.read.schema("id string, category string, text string").option("mode", "FAILFAST").json(path)
    lacking = rows.filter(F.array_contains(F.transform(F.array("id", "category", "text"), lambda c: F.coalesce(F.trim(c), F.lit("")) == ""), True))
    for what, bad in (("a field is missing", lacking), ("an id repeats", rows.groupBy("id").count().filter("count > 1")), ("a text repeats", rows.groupBy("text").count().filter("count > 1"))):
        if first := bad.limit(1).collect():
            raise ValueError(f"{what}: {first[0][0]!r}")
    return rows


def read_review_key(spark: SparkSession, path: str) -> DataFrame:
    """(review_id, checkpoint_label, generation_id, prompt_id, generation_seed) from one JSON object keyed by review."""
    entry = "map<string, struct<checkpoint_label: string, generation_id: string, prompt_id: string, generation_seed: bigint>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", entry, {"mode": "FAILFAST", "allowNonNumericNumbers": "false"}).alias("m"))
    return whole.select(F.explode("m").alias("review_id", "e")).select("review_id", "e.*")


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The same rows; columns that are missing, unexpected or of another type are an error."""
    have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in expected}
    wrong = sorted({*have} ^ {*want}) + sorted(c for c in {*have} & {*want} if have[c] != want[c])
    if wrong:
        raise ValueError(f"columns that don't fit: {wrong}")
    return df


def read_verified_split(spark: SparkSession, root: str, manifest: DataFrame | None, split: str, schema: T.StructType = RECORD) -> DataFrame:
    """The records of a split from the files its manifest (split, path, size, sha256; paths below ``root``) lists, once all of them are proven to be there unchanged. A manifest has a row per file.
    A corpus without a manifest is one of the older form, ``SPLIT.jsonl`` below ``root``."""
    from corpusloom.operators.audits import verify_files
    from corpusloom.sources.paths import exists

    if manifest is None:
        if not exists(spark, f"{root}/{split}.jsonl"):
            raise FileNotFoundError(f"{root} has neither a manifest nor {split}.jsonl")
        return read_records(spark, f"{root}/{split}.jsonl", schema)
    mine = manifest.filter(F.col("split") == split)
    paths = [r.path for r in mine.select("path").toLocalIterator()]
    if not paths:
        raise ValueError(f"the manifest has no files of {split!r}")
    prefix = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    found = file_table(spark, [f"{root}/{p}" for p in paths]).withColumn("path", F.substring_index("path", prefix, -1))
    wrong = verify_files(mine, found).filter("state <> 'ok'").limit(5).collect()
    if wrong:
        raise ValueError("files that don't match their manifest: " + ", ".join(f"{r.path} ({r.state})" for r in wrong))
    return read_records(spark, [f"{root}/{p}" for p in paths], schema)
