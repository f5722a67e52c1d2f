"""Queries over the operators of the core, over whole tables, and the SQL that states the same."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import hashing as H
from corpusloom.functions import repetition as R
from corpusloom.functions import scalars as S
from corpusloom.functions.text import casefold_col, nfkc_col, normal_form, normalize_col, word_tokens
from corpusloom.operators import aggregates as A
from corpusloom.operators import audits, evaluation, filters, quota, records, runs, tokens, windows
from corpusloom.plans import pipelines
from corpusloom.session import new_path, store
from corpusloom.sources.readers import with_row_index
from corpusloom.streaming import incremental, onepass

#: A public byte-level tokenizer; queries that need one read it from here.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    """Registers a query with the SQL that states the same."""

    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        _QUERIES[f.__name__] = call
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


_WS = r"\t\x0b\x0c \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


#: Stands in the SQL below for the tables whose raw texts are brought to NFKC; see :func:`_nfkc_sql`.
_NFKC = "/* nfkc */"


def _nfkc_sql() -> str:
    """CTEs ``nfkc_documents`` and ``nfkc_items``: every compatibility character is exchanged by a table of them, and the rest is canonical composition. The table is
    made from the standard library's Unicode data."""
    import sys
    import unicodedata

    chars = (chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    table = ", ".join(f"('{c}', '" + n.replace("'", "''") + "')" for c in chars if (n := unicodedata.normalize("NFKC", c)) != unicodedata.normalize("NFC", c))

    def cte(name: str, table: str, key: str, text: str, keep: str) -> str:
        chars = f"SELECT {key}, unnest(regexp_extract_all({text}, '(?s).')) AS ch, generate_subscripts(regexp_extract_all({text}, '(?s).'), 1) AS i FROM {table} WHERE regexp_matches({text}, '[^\\x00-\\x7f]')"
        flat = f"SELECT {key}, nfc_normalize(string_agg(coalesce(r, ch), '' ORDER BY i)) AS t FROM ({chars}) LEFT JOIN compat ON ch = c GROUP BY {key}"
        return f"{name} AS (SELECT {keep}, coalesce(t, {text}) AS {text} FROM {table} LEFT JOIN ({flat}) USING ({key}))"

    return f"compat(c, r) AS (VALUES {table}), {cte('nfkc_documents', 'documents', 'doc_id', 'text', 'doc_id, source, lang')}, {cte('nfkc_items', 'eval_items', 'item_id', 'prompt', 'item_id')}"


def _norm(text: str) -> str:
    """The steps of normalization after NFKC, as SQL."""
    t = rf"regexp_replace({text}, '\r\n?', chr(10), 'g')"
    t = rf"regexp_replace({t}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"
    t = rf"regexp_replace({t}, '[{_WS}]+(\n|\z)', '\1', 'g')"
    t = rf"regexp_replace({t}, '\A[\n{_WS}]+|[\n{_WS}]+\z', '', 'g')"
    return rf"regexp_replace({t}, '\n{{3,}}', chr(10) || chr(10), 'g')"


_FOLD = "replace(lower({}), 'ß', 'ss')"
_DOCS = f"{_NFKC}, docs AS (SELECT doc_id, source, lang, t AS text, sha256(t) AS sha, length(t) AS num_chars FROM (SELECT *, {_norm('text')} AS t FROM nfkc_documents WHERE text IS NOT NULL) WHERE t <> '')"
_HEX = "('0x' || substr({}, 1, 16))::UBIGINT::DOUBLE"
_MIN_CHARS = 120


def _documents(t) -> DataFrame:
    """Documents as normalized records."""
    d = t("documents").withColumn("row_index", F.col("doc_id"))
    own = records.simple_records(d.select("row_index", "text", F.col("source").alias("_source"), "lang"), "documents", "train", keep=("_source", "lang"))
    return own.drop("source_id").withColumnsRenamed({"row_index": "doc_id", "_source": "source_id"})


def _prompts(t) -> list[str]:
    """The fixed set of test prompts as folded patterns."""
    return filters.fold_patterns([r.prompt for r in t("eval_items").select("prompt").toLocalIterator() if r.prompt])


_REASONS = f"""WITH {_DOCS}, p AS (SELECT {_FOLD.format(_norm('prompt'))} AS p FROM nfkc_items WHERE prompt <> ''),
    c AS (SELECT doc_id, bool_or(contains({_FOLD.format('d.text')}, p.p)) AS hit FROM docs d, p GROUP BY doc_id),
    r AS (SELECT d.*, CASE WHEN num_chars < {_MIN_CHARS} THEN 'too_short' WHEN num_chars > 20000 THEN 'too_long' WHEN hit THEN 'benchmark_contamination' END AS base FROM docs d JOIN c USING (doc_id)),
    f AS (SELECT *, CASE WHEN base IS NOT NULL THEN base WHEN row_number() OVER (PARTITION BY sha, base IS NULL ORDER BY doc_id) > 1 THEN 'duplicate_exact' END AS reason FROM r)"""


def _judged(t) -> DataFrame:
    policy = filters.QualityPolicy(min_chars=_MIN_CHARS, max_chars=20000)
    return pipelines.judged(_documents(t), policy, _prompts(t), position="doc_id")


@_query(f"""{_REASONS} SELECT coalesce(reason, 'accepted') AS reason, CASE WHEN {_HEX.format('sha')} / 18446744073709551615.0::DOUBLE < 0.1 THEN 'validation' ELSE 'train' END AS split,
    count(*) AS documents, sum(num_chars)::BIGINT AS total_chars FROM f GROUP BY ALL""")
def flagship_counts(t):
    j = _judged(t).withColumn("split", H.hash_split(F.col("text_sha256"), 0.1))
    return j.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason"), "split").agg(F.count("*").alias("documents"), F.sum("num_chars").alias("total_chars"))


@_query(f"""{_REASONS} SELECT coalesce(reason, 'accepted') AS reason, CASE WHEN reason IS NULL AND {_HEX.format('sha')} / 18446744073709551615.0::DOUBLE < 0.1 THEN 'validation' ELSE 'train' END AS split,
    count(*) AS documents, sum(num_chars)::BIGINT AS total_chars FROM f GROUP BY ALL""")
def flagship(t):
    """Raw documents through normalization, length, duplicates and contamination to hash splits, counted."""
    policy = filters.QualityPolicy(min_chars=_MIN_CHARS, max_chars=20000)
    d = t("documents").select("text", F.col("doc_id").alias("row_index"))
    out = pipelines.single_dataset(d, "documents", "train", policy, _prompts(t), validation_fraction=0.1)
    return out.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason"), "split").agg(F.count("*").alias("documents"), F.sum("num_chars").alias("total_chars"))


_HASHED = f"WITH {_NFKC} SELECT doc_id, sha256(t) AS text_sha256, length(t) AS num_chars FROM (SELECT doc_id, {_norm('text')} AS t FROM nfkc_documents WHERE text IS NOT NULL)"


@_query(_HASHED)
def normalize_hash(t):
    n = t("documents").filter("text is not null").select("doc_id", normal_form(F.col("text")).alias("n"))
    return n.select("doc_id", F.col("n.sha256").alias("text_sha256"), F.col("n.chars").alias("num_chars"))


@_query(_HASHED)
def normalize_nfkc(t):
    """NFKC apart, the other steps in the JVM."""
    n = t("documents").filter("text is not null").select("doc_id", nfkc_col(F.col("text")).alias("n")).select("doc_id", normalize_col(F.col("n"), already_nfkc=True).alias("n"))
    return n.select("doc_id", H.sha(F.col("n")).alias("text_sha256"), F.length("n").cast("long").alias("num_chars"))


@_query("""SELECT doc_id, CASE WHEN f1 < 0.1 THEN 'validation' ELSE 'train' END AS inclusive, CASE WHEN f2 < 0.1 THEN 'holdout' ELSE 'fit' END AS exclusive FROM (SELECT doc_id,
    ('0x' || substr(sha256(text), 1, 16))::UBIGINT::DOUBLE / 18446744073709551615.0::DOUBLE AS f1, ('0x' || substr(sha256(text), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE AS f2 FROM documents WHERE text IS NOT NULL)""")
def hash_splits(t):
    h = H.sha(F.col("text"))
    return t("documents").filter("text is not null").select("doc_id", H.hash_split(h, 0.1).alias("inclusive"), H.hash_split(h, 0.1, whole=H.EXCLUSIVE, small="holdout", rest="fit").alias("exclusive"))


@_query("SELECT id, sha256('42:' || coalesce(source_id, '') || ':' || document_id || ':' || content_sha256) AS order_key FROM normalized_records WHERE content_sha256 IS NOT NULL AND document_id IS NOT NULL")
def order_keys(t):
    r = t("normalized_records").filter("content_sha256 is not null and document_id is not null")
    return r.select("id", H.order_key(42, F.col("source_id"), F.col("document_id"), F.col("content_sha256")).alias("order_key"))


@_query("SELECT source, count(*) AS documents, sum(greatest(1, ceil(length(text) / 4.0)))::BIGINT AS estimated_tokens FROM documents WHERE text IS NOT NULL GROUP BY source")
def token_estimates(t):
    return t("documents").filter("text is not null").groupBy("source").agg(F.count("*").alias("documents"), F.sum(S.token_estimate(F.col("text"))).alias("estimated_tokens"))


@_query("SELECT id, coalesce(nullif(trim(document_id), ''), content_sha256) AS document_key, CASE WHEN bucket_id IS NULL THEN source_id ELSE source_id || '/' || bucket_id END AS item_id FROM normalized_records")
def record_keys(t):
    return t("normalized_records").select("id", S.document_id(F.col("document_id"), F.col("content_sha256")).alias("document_key"), S.item_id(F.col("source_id"), F.col("bucket_id")).alias("item_id"))


@_query(r"SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+(?:[-./][\p{L}\p{N}_]+)*')) AS words FROM documents WHERE text IS NOT NULL")
def word_counts(t):
    return t("documents").filter("text is not null").select("doc_id", F.size(word_tokens(F.col("text"))).cast("long").alias("words"))


@_query(f"SELECT sha256({_FOLD.format('prompt')}) AS folded_sha256, item_id FROM eval_items WHERE prompt IS NOT NULL")
def folded_prompts(t):
    return t("eval_items").filter("prompt is not null").select(H.sha(casefold_col(F.col("prompt"))).alias("folded_sha256"), "item_id")


@_query(f"{_REASONS} SELECT coalesce(reason, 'accepted') AS reason, count(*) AS documents, (SELECT count(*) FROM f) AS total FROM f GROUP BY 1")
def reject_reasons(t):
    return filters.quality_report(_judged(t))


@_query(f"{_REASONS} SELECT doc_id, sha AS text_sha256 FROM f WHERE reason IS NULL")
def accepted_documents(t):
    return _judged(t).filter("reason is null").select("doc_id", "text_sha256")


@_query(f"WITH {_DOCS} SELECT min(doc_id) AS doc_id, sha AS text_sha256 FROM docs GROUP BY sha")
def first_copies(t):
    return filters.first_copies(_documents(t).select("doc_id", "text_sha256"), "text_sha256", "doc_id")


@_query(f"WITH {_DOCS}, p AS (SELECT {_FOLD.format(_norm('prompt'))} AS pattern FROM nfkc_items WHERE prompt <> '') SELECT doc_id FROM docs d WHERE EXISTS (SELECT 1 FROM p WHERE contains({_FOLD.format('d.text')}, p.pattern))")
def contamination_join(t):
    return filters.contains_any(_documents(t), "text", _prompts(t)).filter("contaminated").select("doc_id")


@_query("""SELECT r.id, lower(r.text_sha256) AS sha FROM normalized_records r WHERE r.text_sha256 IS NOT NULL AND lower(r.text_sha256) NOT IN (SELECT lower(trim(h)) FROM (SELECT unnest(accepted_hashes) AS h FROM unit_commits) WHERE h IS NOT NULL)""")
def unseen_records(t):
    seen = t("unit_commits").select(F.explode("accepted_hashes").alias("sha")).filter("sha is not null").select(F.lower(F.trim("sha")).alias("sha"))
    return filters.unseen(t("normalized_records").filter("text_sha256 is not null").select("id", F.lower("text_sha256").alias("sha")), seen, "sha").select("id", "sha")


@_query(f"""WITH {_DOCS} SELECT CASE WHEN {_HEX.format('sha')} / 18446744073709551615.0::DOUBLE < 0.1 THEN 'validation' ELSE 'train' END AS split, count(*) AS documents, sum(num_chars)::BIGINT AS total_chars FROM docs GROUP BY 1""")
def split_statistics(t):
    return A.split_statistics(_documents(t).withColumn("split", H.hash_split(F.col("text_sha256"), 0.1)))


@_query(f"WITH {_DOCS} SELECT source, sha256(string_agg(sha, '' ORDER BY doc_id)) AS documents_sha256 FROM docs GROUP BY source")
def documents_digest(t):
    return _documents(t).groupBy(F.col("source_id").alias("source")).agg(H.ordered_digest(F.col("doc_id"), F.col("text_sha256")).alias("documents_sha256"))


@_query(f"""WITH {_DOCS} SELECT source, list_reduce(list_prepend(repeat('0', 64), list(sha ORDER BY doc_id)), lambda a, x: sha256(unhex(a) || encode(x))) AS chain FROM docs GROUP BY source""")
def chained_digest(t):
    return _documents(t).groupBy(F.col("source_id").alias("source")).agg(H.chained_digest(F.col("doc_id"), F.col("text_sha256")).alias("chain"))


@_query(f"""WITH {_DOCS}, b AS (SELECT source, doc_id // 1000 AS b, count(*) AS n, sha256(string_agg(sha, '' ORDER BY doc_id)) AS d FROM docs GROUP BY ALL), s AS (SELECT source, b // 1000 AS s, sum(n) AS n, sha256(string_agg(d, '' ORDER BY b)) AS d FROM b GROUP BY ALL)
    SELECT source AS source_id, sum(n)::BIGINT AS documents, sha256(string_agg(d, '' ORDER BY s)) AS digest FROM s GROUP BY source""")
def block_digests(t):
    return H.block_digest(_documents(t), ["source_id"], "doc_id", "text_sha256", 1000)


_DISTINCT = "r AS (SELECT DISTINCT id, stage, role, source_id, bucket_id, license, split, num_chars, estimated_tokens FROM normalized_records)"


def _distinct_records(t) -> DataFrame:
    return t("normalized_records").select("id", "stage", "role", "source_id", "bucket_id", "license", "split", "num_chars", "estimated_tokens").distinct()


@_query(f"""WITH {_DISTINCT} SELECT stage, role, source_id, bucket_id, grouping(stage, role, source_id, bucket_id) AS level, count(*) AS documents, sum(estimated_tokens)::BIGINT AS tokens, sum(num_chars)::BIGINT AS bytes,
    count(*) FILTER (split <> 'validation') AS fit_documents, coalesce(sum(estimated_tokens) FILTER (split <> 'validation'), 0)::BIGINT AS fit_tokens, coalesce(sum(num_chars) FILTER (split <> 'validation'), 0)::BIGINT AS fit_bytes,
    count(*) FILTER (split = 'validation') AS held_documents, coalesce(sum(estimated_tokens) FILTER (split = 'validation'), 0)::BIGINT AS held_tokens, coalesce(sum(num_chars) FILTER (split = 'validation'), 0)::BIGINT AS held_bytes
    FROM r GROUP BY GROUPING SETS ((stage), (stage, role), (stage, source_id), (stage, source_id, bucket_id))""")
def breakdowns(t):
    sets = [["stage"], ["stage", "role"], ["stage", "source_id"], ["stage", "source_id", "bucket_id"]]
    return A.breakdowns(_distinct_records(t), sets, A.stage_measures("estimated_tokens", "num_chars"))


@_query(f"WITH {_DISTINCT} SELECT license, count(*) AS documents FROM r GROUP BY license")
def license_counts(t):
    return A.license_counts(_distinct_records(t))


@_query("SELECT d.doc_id, b.bucket_id FROM documents d LEFT JOIN (SELECT source_id, b.id AS bucket_id, unnest(b.collections) AS c FROM (SELECT source_id, unnest(buckets) AS b FROM source_specs)) b ON d.source = b.source_id AND d.collection = b.c")
def bucket_lookup(t):
    return records.with_bucket(t("documents").select("doc_id", "source", "collection"), t("source_specs").withColumnRenamed("source_id", "source"), source="source").select("doc_id", "bucket_id")


@_query("SELECT d.doc_id, s.role, s.license FROM documents d LEFT JOIN source_specs s ON d.source = s.source_id")
def source_lookup(t):
    return records.with_source(t("documents").withColumnRenamed("source", "source_id"), t("source_specs"), ["role", "license"]).select("doc_id", "role", "license")


@_query("SELECT doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1)::BIGINT AS row_index FROM documents")
def row_positions(t):
    return windows.prefix_sums(t("documents").select("doc_id", "source"), ["doc_id"], {"row_index": F.lit(1)}, ["source"]).select("doc_id", "row_index")


@_query("""WITH i AS (SELECT doc_id, source, text IS NOT NULL AND trim(text) <> '' AS kept, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx FROM documents),
    w AS (SELECT *, coalesce(sum(kept::INT) OVER (PARTITION BY source ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 16 AS win FROM i),
    e AS (SELECT source, win, CASE WHEN sum(kept::INT) >= 16 THEN max(idx) FILTER (kept) ELSE max(idx) END + 1 AS next_cursor FROM w GROUP BY ALL)
    SELECT doc_id, win::BIGINT AS window, next_cursor::BIGINT AS next_cursor FROM w JOIN e USING (source, win)""")
def count_windows(t):
    d = with_row_index_by_source(t)
    kept = F.col("text").isNotNull() & (F.trim("text") != "")
    return windows.count_windows(d, 16, source="source", kept=kept).select("doc_id", "window", "next_cursor")


def with_row_index_by_source(t) -> DataFrame:
    return windows.prefix_sums(t("documents").select("doc_id", "source", "text"), ["doc_id"], {"row_index": F.lit(1)}, ["source"])


_QUOTA = 6000


def _quota_rows(t) -> DataFrame:
    """Documents of every source in shuffled windows, with estimated tokens."""
    d = _documents(t).withColumnRenamed("doc_id", "row_index")
    narrow = store(d.select("row_index", "source_id", F.col("row_index").cast("string").alias("document_id"), F.col("text_sha256").alias("content_sha256"), "num_chars"), "quota-documents")  # texts are normalized once
    d = store(windows.shuffled_windows(narrow, 16, 42), "quota-rows")
    held = H.hash_fraction(F.col("content_sha256"), H.EXCLUSIVE) < 0.1
    return d.withColumns({"item_id": F.col("source_id"), "tokens": F.greatest(F.lit(1), F.ceil(F.col("num_chars") / 4)).cast("long"), "holdout": held, "reason": F.when(F.col("num_chars") < _MIN_CHARS, "too_short")})


_ORDER = ["source_id", "window", "order_key", "row_index"]


def _quotas(t) -> DataFrame:
    return t("documents").filter("source is not null").groupBy(F.col("source").alias("item_id")).agg(F.lit(_QUOTA).cast("long").alias("token_quota"))


_WINDOWED = f"""{_DOCS}, i AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 16 AS win, sha256('42:' || source || ':' || doc_id || ':' || sha) AS k, greatest(1, ceil(num_chars / 4.0))::BIGINT AS tokens,
    {_HEX.format('sha')} / 18446744073709551616.0::DOUBLE < 0.1 AS held FROM docs),
    g AS (SELECT *, num_chars >= {_MIN_CHARS} AS ok, coalesce(sum(CASE WHEN num_chars >= {_MIN_CHARS} AND NOT held THEN tokens ELSE 0 END) OVER (PARTITION BY source ORDER BY win, k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM i),
    q AS (SELECT *, CASE WHEN before >= {_QUOTA} THEN 'over_quota' WHEN NOT ok THEN 'too_short' WHEN held THEN 'holdout' ELSE 'train' END AS disposition FROM g)"""


@_query(f"WITH {_WINDOWED} SELECT doc_id AS row_index, disposition FROM q")
def quota_fill(t):
    rows = _quota_rows(t).withColumn("content_sha256", F.col("row_index").cast("string"))
    return quota.fill_quotas(rows, _quotas(t), _ORDER).select("row_index", "disposition")


@_query(f"""WITH RECURSIVE {_WINDOWED}, o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY source, win, k, doc_id) AS pos FROM i),
    r AS (SELECT 0::BIGINT AS pos, NULL::VARCHAR AS source, 0::BIGINT AS used, []::VARCHAR[] AS seen, NULL::BIGINT AS doc_id, NULL::VARCHAR AS disposition UNION ALL
        SELECT pos, source, (CASE WHEN d = 'train' THEN u + tokens ELSE u END)::BIGINT, CASE WHEN d IN ('train', 'holdout') THEN list_append(seen, sha) ELSE seen END, doc_id, d FROM
        (SELECT *, CASE WHEN u >= {_QUOTA} THEN 'over_quota' WHEN num_chars < {_MIN_CHARS} THEN 'too_short' WHEN list_contains(seen, sha) THEN 'duplicate_exact' WHEN held THEN 'holdout' ELSE 'train' END AS d FROM
        (SELECT o.pos, o.source, o.doc_id, o.sha, o.tokens, o.held, o.num_chars, r.seen, CASE WHEN r.source = o.source THEN r.used ELSE 0 END AS u FROM r JOIN o ON o.pos = r.pos + 1)))
    SELECT doc_id AS row_index, source AS source_id, disposition FROM r WHERE pos > 0""")
def quota_fill_deduplicated(t):
    return quota.fill_quotas(_quota_rows(t), _quotas(t), _ORDER).select("row_index", "source_id", "disposition")


@_query(f"""WITH {_WINDOWED} SELECT source AS item_id, {_QUOTA}::BIGINT AS requested_tokens, coalesce(sum(tokens) FILTER (disposition = 'train'), 0)::BIGINT AS quota_tokens, count(*) FILTER (disposition = 'train') AS documents,
    count(*) FILTER (disposition = 'holdout') AS holdout_documents FROM q GROUP BY source""")
def item_statistics(t):
    rows = _quota_rows(t).withColumn("content_sha256", F.col("row_index").cast("string"))
    return quota.item_statistics(quota.fill_quotas(rows, _quotas(t), _ORDER), _quotas(t))


@_query("""WITH r AS (SELECT DISTINCT stage, source_id, id, estimated_tokens, doc_id FROM normalized_records WHERE estimated_tokens IS NOT NULL), a AS (SELECT stage, source_id AS item_id, sum(estimated_tokens)::BIGINT AS actual_tokens, arg_max(estimated_tokens, (doc_id, id)) AS last_document_tokens FROM r GROUP BY ALL),
    i AS (SELECT *, 5000::BIGINT AS planned_tokens FROM a), x AS (SELECT *, abs(actual_tokens - planned_tokens) / planned_tokens AS relative_variance, actual_tokens > planned_tokens AND actual_tokens - last_document_tokens < planned_tokens AS boundary_limited FROM i),
    y AS (SELECT *, greatest(0, actual_tokens - planned_tokens) AS overshoot_tokens, relative_variance <= 0.5 OR boundary_limited AS passed FROM x),
    s AS (SELECT stage, sum(planned_tokens)::BIGINT AS planned_tokens, sum(actual_tokens)::BIGINT AS actual_tokens, bool_and(passed) AS p FROM y GROUP BY stage)
    SELECT stage, item_id, planned_tokens, actual_tokens, round(relative_variance, 9) AS relative_variance, last_document_tokens, boundary_limited, overshoot_tokens, passed FROM y
    UNION ALL SELECT stage, NULL, planned_tokens, actual_tokens, round(abs(actual_tokens - planned_tokens) / planned_tokens, 9), NULL, NULL, greatest(0, actual_tokens - planned_tokens), p AND abs(actual_tokens - planned_tokens) / planned_tokens <= 0.5 FROM s""")
def quota_audit(t):
    r = t("normalized_records").filter("estimated_tokens is not null").select("stage", F.col("source_id").alias("item_id"), "id", "estimated_tokens", "doc_id").distinct()
    plan = r.groupBy("stage", "item_id").agg(F.lit(5000).cast("long").alias("token_quota"))
    out = quota.audit_quotas(r, plan, 0.5, ["doc_id", "id"], tokens="estimated_tokens")
    return out.withColumn("relative_variance", F.round("relative_variance", 9))


@_query("""WITH w AS (SELECT DISTINCT stage, source_id AS item_id, weight::DECIMAL(18,6) AS weight FROM mixture_targets), x AS (SELECT *, 1000003 * weight / sum(weight) OVER (PARTITION BY stage) AS e FROM w), f AS (SELECT *, floor(e)::BIGINT AS fl FROM x),
    r AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY e - fl DESC, item_id) AS n, 1000003 - sum(fl) OVER (PARTITION BY stage) AS rest FROM f) SELECT stage, item_id, (fl + CASE WHEN n <= rest THEN 1 ELSE 0 END)::BIGINT AS token_quota FROM r""")
def largest_remainder(t):
    w = t("mixture_targets").select("stage", F.col("source_id").alias("item_id"), "weight").distinct()
    return quota.largest_remainder(w, 1000003, group=["stage"]).select("stage", "item_id", "token_quota")


@_query("SELECT DISTINCT lower(text_sha256) AS text_sha256 FROM normalized_records WHERE split = 'train' AND lower(text_sha256) IN (SELECT lower(text_sha256) FROM normalized_records WHERE split <> 'train')")
def split_overlap(t):
    r = t("normalized_records").filter("text_sha256 is not null").select("split", F.lower("text_sha256").alias("text_sha256"))
    return A.overlap(r.filter("split = 'train'"), r.filter("split <> 'train'"))


_ENC = "e AS (SELECT DISTINCT record_id, build_id, stage, split, len(ids) AS n FROM encoded_records WHERE ids IS NOT NULL)"


def _encoded(t) -> DataFrame:
    return t("encoded_records").filter("ids is not null").dropDuplicates(["record_id"])


@_query(f"WITH {_ENC}, l AS (SELECT stage, split, list_sort(list(n)) AS v FROM e GROUP BY ALL) SELECT stage, split, len(v) AS n, v[ceil((len(v) - 1) * 0.5)::INT + 1] AS p50, v[ceil((len(v) - 1) * 0.95)::INT + 1] AS p95 FROM l")
def length_quantiles(t):
    out = A.quantile_higher(_encoded(t).withColumn("len", F.size("ids").cast("long")), "len", {"p50": 0.5, "p95": 0.95}, ["stage", "split"])
    return out


@_query(f"WITH {_ENC} SELECT record_id, coalesce(sum(n + 1) OVER (PARTITION BY build_id, stage, split ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS \"offset\" FROM e")
def token_offsets(t):
    return tokens.token_offsets(_encoded(t).select("record_id", "build_id", "stage", "split", F.size("ids").alias("n")), ["record_id"], F.col("n"), group=["build_id", "stage", "split"]).select("record_id", "offset")


@_query(f"""WITH {_ENC}, o AS (SELECT build_id, stage, split, coalesce(sum(n + 1) OVER (PARTITION BY build_id, stage, split ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o, n + 1 AS n FROM e),
    p AS (SELECT build_id, stage, split, o, n, unnest(generate_series((o // 2048)::BIGINT, ((o + n - 1) // 2048)::BIGINT)) AS shard_index FROM o)
    SELECT build_id, stage, split, shard_index, sum(least(o + n, (shard_index + 1) * 2048) - greatest(o, shard_index * 2048))::BIGINT AS num_tokens, count(*) AS pieces FROM p GROUP BY ALL""")
def shard_statistics(t):
    g = ["build_id", "stage", "split"]
    o = tokens.token_offsets(_encoded(t).select("record_id", *g, F.size("ids").alias("n")), ["record_id"], F.col("n"), group=g)
    return tokens.shard_statistics(o, 2048, g)


@_query(f"""WITH {_ENC}, m AS (SELECT build_id, stage, split, max(x) AS m FROM (SELECT build_id, stage, split, unnest(ids) AS x FROM encoded_records) GROUP BY ALL), z AS (SELECT DISTINCT record_id, build_id, stage, split, len(list_filter(ids, lambda x: x = 50256)) AS z FROM encoded_records WHERE ids IS NOT NULL)
    SELECT build_id, stage, split, ceil(sum(n + 1) / 2048)::BIGINT AS shards, sum(n + 1)::BIGINT AS total_tokens, (count(*) + (SELECT sum(z) FROM z WHERE z.build_id = e.build_id AND z.stage = e.stage AND z.split = e.split))::BIGINT AS eos_tokens,
    greatest(50256, any_value(m)) AS max_id FROM e JOIN m USING (build_id, stage, split) GROUP BY build_id, stage, split""")
def shard_audit(t):
    g = ["build_id", "stage", "split"]
    shards = tokens.build_shards(_encoded(t).select("record_id", "ids", *g), ["record_id"], 2048, eos_id=50256, group=g, dtype="uint16")
    return tokens.shard_audit(shards, 50256, g)


@_query("""WITH e AS (SELECT DISTINCT record_id, split, ids FROM encoded_records WHERE len(ids) > 1), p AS (SELECT split, unnest(list_zip(ids[:-2], ids[2:])) AS p FROM e)
    SELECT split, count(*) AS pairs, sum(p[1]::BIGINT * 3 + p[2]::BIGINT)::BIGINT AS checksum FROM p GROUP BY split""")
def next_token_pairs(t):
    p = tokens.next_token_pairs(_encoded(t).select("split", "ids"), ["split"])
    return p.groupBy("split").agg(F.count("*").alias("pairs"), F.sum(F.col("x").cast("long") * 3 + F.col("y").cast("long")).alias("checksum"))


@_query()
def window_samples(t):
    s = t("packed_shards").filter("num_tokens is not null").select(F.concat_ws("/", "build_id", "stage", "split", "shard_index").alias("shard"), "num_tokens").distinct()
    return tokens.sample_windows(s, 128, 1000, 42, key="shard")


@_query()
def pretoken_counts(t):
    return tokens.pretoken_counts(t("documents").filter("text is not null"))


@_query()
def tokenizer_metrics(t):
    d = t("documents").filter("text is not null").select("text", "source", "lang")
    return tokens.tokenizer_metrics(tokens.encode(d, TOKENIZER), ["source", "lang"])


@_query("SELECT doc_id, sha256(text) AS decoded_sha256 FROM documents WHERE text IS NOT NULL")
def round_trips(t):
    """What comes back from the token ids of every text."""
    d = tokens.decode(tokens.encode(t("documents").filter("text is not null").select("doc_id", "text"), TOKENIZER).drop("text"), TOKENIZER)
    return d.select("doc_id", H.sha(F.col("decoded")).alias("decoded_sha256"))


@_query()
def trained_tokenizer(t):
    made = tokens.train_bpe(t("documents").filter("text is not null"), vocabulary=2048)
    return tokens.tokenizer_metrics(tokens.encode(t("documents").filter("text is not null").select("text"), made))


_REP = {"word_count": "len(w)", "consecutive_duplicate_words": "len(list_filter(list_zip(w[1:-2], w[2:]), lambda p: p[1] = p[2]))"}


def _grams(n: int) -> str:
    return f"CASE WHEN len(w) >= {n} THEN list_transform(range(1, (len(w) - {n - 2})::BIGINT), lambda i: w[i:(i + {n - 1})]) ELSE [] END"


_REPSQL = f"""WITH w AS (SELECT doc_id, source, regexp_extract_all(lower(text), '[a-z0-9]+(?:''[a-z0-9]+)?') AS w, list_filter(list_transform(regexp_extract_all(lower(text), '[^.!?]+[.!?]?'), lambda s: array_to_string(regexp_extract_all(s, '[a-z0-9]+(?:''[a-z0-9]+)?'), ' ')), lambda s: s <> '') AS s FROM documents WHERE text IS NOT NULL),
    g AS (SELECT *, {_grams(2)} AS g2, {_grams(3)} AS g3, {_grams(4)} AS g4 FROM w),
    m AS (SELECT doc_id, source, len(w) AS word_count, len(s) AS sentence_count, CASE WHEN len(w) > 1 THEN len(list_filter(list_zip(w[:-2], w[2:]), lambda p: p[1] = p[2])) ELSE 0 END AS consecutive_duplicate_words, len(g3) AS total_3grams, len(g3) - len(list_distinct(g3)) AS repeated_3gram_occurrences,
    len(g4) AS total_4grams, len(g4) - len(list_distinct(g4)) AS repeated_4gram_occurrences, len(s) - len(list_distinct(s)) AS duplicate_sentence_occurrences, CASE WHEN len(g2) > 0 THEN len(list_distinct(g2)) / len(g2) ELSE 0 END AS distinct_2gram_ratio, CASE WHEN len(g3) > 0 THEN len(list_distinct(g3)) / len(g3) ELSE 0 END AS distinct_3gram_ratio,
    CASE WHEN len(g3) > 0 THEN (len(g3) - len(list_distinct(g3))) / len(g3) ELSE 0 END AS repeated_3gram_rate, CASE WHEN len(g4) > 0 THEN (len(g4) - len(list_distinct(g4))) / len(g4) ELSE 0 END AS repeated_4gram_rate, CASE WHEN len(s) > 0 THEN (len(s) - len(list_distinct(s))) / len(s) ELSE 0 END AS duplicate_sentence_rate FROM g)"""


@_query(f"""{_REPSQL} SELECT doc_id, word_count, sentence_count, consecutive_duplicate_words, total_3grams, repeated_3gram_occurrences, total_4grams, repeated_4gram_occurrences, duplicate_sentence_occurrences,
    round(distinct_2gram_ratio, 9) AS distinct_2gram_ratio, round(distinct_3gram_ratio, 9) AS distinct_3gram_ratio, round(repeated_3gram_rate, 9) AS repeated_3gram_rate, round(repeated_4gram_rate, 9) AS repeated_4gram_rate, round(duplicate_sentence_rate, 9) AS duplicate_sentence_rate FROM m""")
def repetition_metrics(t):
    m = R.measure_repetition(t("documents").filter("text is not null").select("doc_id", "text")).drop("text")
    counts = [c for c in m.columns if c != "doc_id" and c not in R.RATES]
    return m.select("doc_id", *[F.col(c).cast("long").alias(c) for c in counts], *[F.round(c, 9).alias(c) for c in R.RATES])


@_query(f"{_REPSQL} SELECT source, count(*) AS story_count, " + ", ".join(f"round(avg({r}), 6) AS mean_{r}" for r in R.RATES) + " FROM m GROUP BY source")
def aggregate_repetition(t):
    m = R.measure_repetition(t("documents").filter("text is not null").select("source", "text"))
    a = R.aggregate_repetition(m, ["source"])
    return a.select("source", "story_count", *[F.round(f"mean_{r}", 6).alias(f"mean_{r}") for r in R.RATES])


_LOSS = "l AS (SELECT event_type AS label, user_id AS seed, sum(value::DECIMAL(18,2))::DOUBLE / count(*) AS loss FROM events WHERE value IS NOT NULL GROUP BY ALL)"


def _losses(t) -> DataFrame:
    return t("events").filter("value is not null").groupBy(F.col("event_type").alias("label"), F.col("user_id").alias("seed")).agg((F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("loss"))


@_query(f"WITH {_LOSS} SELECT label, count(*) AS seed_count, round(avg(loss), 6) AS mean_loss, round(coalesce(stddev_samp(loss), 0), 6) AS stdev_loss, min(loss) AS minimum_loss, max(loss) AS maximum_loss FROM l GROUP BY label")
def loss_summary(t):
    s = evaluation.loss_summary(_losses(t))
    return s.withColumns({c: F.round(c, 6) for c in ("mean_loss", "stdev_loss")})


@_query(f"""WITH {_LOSS} SELECT a.label AS "left", b.label AS "right", count(*) AS seed_count, count(*) FILTER (a.loss - b.loss < -1e-12) AS left_wins, count(*) FILTER (a.loss - b.loss > 1e-12) AS right_wins, count(*) FILTER (abs(a.loss - b.loss) <= 1e-12) AS ties,
    round(avg(a.loss - b.loss), 6) AS mean_loss_difference FROM l a JOIN l b ON a.seed = b.seed AND a.label < b.label GROUP BY ALL""")
def paired_comparison(t):
    return evaluation.paired_losses(_losses(t)).withColumn("mean_loss_difference", F.round("mean_loss_difference", 6))


@_query(f"WITH {_LOSS} SELECT seed, count(DISTINCT label) AS labels, count(*) AS rows FROM l GROUP BY seed HAVING count(*) <> (SELECT count(DISTINCT label) FROM l)")
def unequal_seeds(t):
    return evaluation.unequal_seeds(_losses(t))


_GEN = "g AS (SELECT config AS checkpoint_label, item_id::VARCHAR AS generation_id, prompt, array_to_string(choices, ' ') AS text FROM eval_items)"


def _generations(t) -> DataFrame:
    return t("eval_items").select(F.col("config").alias("checkpoint_label"), F.col("item_id").cast("string").alias("generation_id"), "prompt", F.array_join("choices", " ").alias("text"))


@_query(f"""WITH {_GEN}, k AS (SELECT *, sha256('7:' || checkpoint_label || ':' || generation_id) AS k FROM g), r AS (SELECT *, row_number() OVER (PARTITION BY checkpoint_label ORDER BY k) AS r FROM k),
    n AS (SELECT *, row_number() OVER (ORDER BY sha256('7:' || k)) AS n FROM r WHERE r <= 20) SELECT printf('review-%04d', n) AS review_id, ((n - 1) // 20)::INT AS batch, checkpoint_label, generation_id, prompt, text FROM n""")
def judge_sample(t):
    return evaluation.sample_reviews(_generations(t), 20, 7).select("review_id", "batch", "checkpoint_label", "generation_id", "prompt", "text")


_JUDGE = "j AS (SELECT item_id::VARCHAR AS review_id, config AS checkpoint_label, " + ", ".join(f"((item_id // {k}) % 3)::INT AS {s}" for k, s in zip((1, 2, 3, 5), evaluation.SCORES)) + ", CASE WHEN item_id % 4 = 0 THEN ['none'] WHEN item_id % 4 = 1 THEN ['object_swap'] ELSE ['object_swap', 'loop'] END AS flags FROM eval_items)"


def _judgments(t) -> tuple[DataFrame, DataFrame]:
    i = F.col("item_id")
    scores = [F.pmod(F.floor(i / k), F.lit(3)).cast("int").alias(s) for k, s in zip((1, 2, 3, 5), evaluation.SCORES)]
    flags = F.when(i % 4 == 0, F.array(F.lit("none"))).when(i % 4 == 1, F.array(F.lit("object_swap"))).otherwise(F.array(F.lit("object_swap"), F.lit("loop")))
    j = t("eval_items").select(i.cast("string").alias("review_id"), *scores, flags.alias("flags"), F.lit("seen").alias("evidence"), F.lit("why").alias("reason"))
    return j, t("eval_items").select(i.cast("string").alias("review_id"), F.col("config").alias("checkpoint_label"))


@_query(f"WITH {_JUDGE} SELECT checkpoint_label, count(*) AS story_count, " + ", ".join(f"round(avg({s}), 9) AS mean_{s}, " + ", ".join(f"count(*) FILTER ({s} = {v}) AS {s}_{v}" for v in (0, 1, 2)) for s in evaluation.SCORES) + " FROM j GROUP BY checkpoint_label")
def judgment_summary(t):
    s = evaluation.judgment_scores(*_judgments(t))
    return s.withColumns({f"mean_{c}": F.round(f"mean_{c}", 9) for c in evaluation.SCORES})


@_query(f"WITH {_JUDGE} SELECT checkpoint_label, flag, count(*) AS flagged FROM (SELECT checkpoint_label, unnest(flags) AS flag FROM j) WHERE flag <> 'none' GROUP BY ALL")
def judgment_flags(t):
    return evaluation.flag_counts(*_judgments(t))


@_query("SELECT item_id::VARCHAR AS review_id, 'unknown flag' AS error FROM eval_items WHERE item_id % 4 >= 2")
def judgment_errors(t):
    j, key = _judgments(t)
    return evaluation.judgment_errors(j, key, ["none", "object_swap"])


@_query("""WITH s AS (SELECT (label % 3)::VARCHAR AS category, label % len(embedding) AS a, list_position(embedding, list_min(embedding)) - 1 AS p FROM embeddings)
    SELECT category, grouping(category) = 1 AS overall, count(*) AS total, count(*) FILTER (a = p) AS correct, round(count(*) FILTER (a = p) / count(*), 9) AS accuracy FROM s GROUP BY ROLLUP (category)""")
def choice_accuracy(t):
    e = t("embeddings").select((F.col("label") % 3).cast("string").alias("category"), (F.col("label") % F.size("embedding")).alias("answer_index"), F.col("embedding").alias("losses"))
    return evaluation.choice_accuracy(evaluation.predictions(e)).withColumn("accuracy", F.round("accuracy", 9))


@_query("""SELECT 'items/' || config || '/' || item_id AS id, trim(prompt) AS prompt, list_transform(choices, lambda c: trim(c)) AS choices, answer_index AS answer, coalesce(nullif(trim(category), ''), 'items') AS category, config, item_id AS source_index, NULL::VARCHAR AS problem FROM eval_items""")
def benchmark_items(t):
    rows = t("eval_items").select("config", F.col("item_id").alias("row_index"), F.col("prompt").alias("question"), "choices", F.element_at("choices", F.col("answer_index") + 1).alias("answer"), F.coalesce("category", F.lit("items")).alias("category"))
    configs = sorted(r[0] for r in rows.select("config").distinct().collect())  # parts of the benchmark, a handful
    return functools.reduce(DataFrame.unionByName, (evaluation.convert_benchmark(rows.filter(F.col("config") == c), "items", c) for c in configs))


_RUN = "m AS (SELECT user_id % 50 AS run, event_id AS step, CASE WHEN event_type = 'error' THEN value END AS val_loss, CASE WHEN event_type <> 'error' THEN value END AS train_loss, value AS tokens_per_second FROM events)"


def _metrics(t) -> DataFrame:
    v = F.col("value")
    return t("events").select((F.col("user_id") % 50).alias("run"), F.col("event_id").alias("step"), F.when(F.col("event_type") == "error", v).alias("val_loss"), F.when(F.col("event_type") != "error", v).alias("train_loss"), v.alias("tokens_per_second"))


@_query(f"""WITH {_RUN} SELECT run, arg_min(val_loss, step) FILTER (val_loss IS NOT NULL) AS initial_val_loss, min(val_loss) AS best_val_loss, arg_max(val_loss, step) FILTER (val_loss IS NOT NULL) AS final_val_loss,
    arg_min(train_loss, step) FILTER (train_loss IS NOT NULL) AS initial_train_loss, arg_max(train_loss, step) FILTER (train_loss IS NOT NULL) AS final_train_loss, max(tokens_per_second) AS max_tokens_per_second FROM m GROUP BY run""")
def run_summary(t):
    return runs.run_summary(_metrics(t), ["run"], ["step"])


@_query(f"""WITH {_RUN}, r AS (SELECT *, count(*) OVER (PARTITION BY run) AS n, row_number() OVER (PARTITION BY run ORDER BY step) AS r FROM m WHERE tokens_per_second IS NOT NULL), s AS (SELECT *, greatest(5, floor(n * 0.2)) AS k FROM r),
    x AS (SELECT run, count(*) AS rows, median(tokens_per_second) FILTER (r <= k) AS head_median, median(tokens_per_second) FILTER (r > n - k) AS tail_median FROM s GROUP BY run) SELECT run, rows, round(head_median, 6) AS head_median, round(tail_median, 6) AS tail_median, round(tail_median / head_median, 6) AS ratio, tail_median / head_median >= 0.8 AS passed FROM x""")
def pilot_review(t):
    p = runs.pilot_review(_metrics(t), "tokens_per_second", ["run"], ["step"])
    return p.withColumns({c: F.round(c, 6) for c in ("head_median", "tail_median", "ratio")})


@_query(f"WITH {_RUN}, u AS (SELECT run, tokens_per_second > lag(tokens_per_second) OVER (PARTITION BY run ORDER BY step) AS up FROM m WHERE tokens_per_second IS NOT NULL) SELECT run, count(*) AS rows, coalesce(bool_and(up), false) AS always_rising FROM u GROUP BY run")
def rising_memory(t):
    return runs.always_rising(_metrics(t), "tokens_per_second", ["run"], ["step"])


@_query("""WITH p AS (SELECT DISTINCT build_id, stage, source_id, row_cursor, accepted_quota_tokens FROM build_progress), d AS (SELECT *, accepted_quota_tokens - lag(accepted_quota_tokens, 1, 0) OVER (PARTITION BY build_id, stage, source_id ORDER BY row_cursor, accepted_quota_tokens) AS accepted_quota_tokens_delta FROM p)
    SELECT *, accepted_quota_tokens_delta < 0 AS backwards FROM d""")
def counter_deltas(t):
    p = t("build_progress").select("build_id", "stage", "source_id", "row_cursor", "accepted_quota_tokens").distinct()
    return windows.counter_deltas(p, ["accepted_quota_tokens"], ["row_cursor", "accepted_quota_tokens"], ["build_id", "stage", "source_id"])


@_query("""SELECT event_id AS step, round(CASE WHEN event_id < 500 THEN 0.0006 * event_id / 500 WHEN event_id >= 8000 THEN 0.00006 ELSE 0.00006 + 0.5 * (1 + cos(pi() * (event_id - 500) / 7500.0)) * (0.0006 - 0.00006) END, 12) AS lr,
    CASE WHEN event_id < 2000 THEN 'pilot' WHEN event_id < 6000 THEN 'main' ELSE 'cooldown' END AS phase, printf('%.6e', exp(least(value, 50))) AS perplexity FROM events WHERE value IS NOT NULL""")
def schedule(t):
    e = t("events").filter("value is not null").select(F.col("event_id").alias("step"), "value")
    e = runs.phase_of(e, [("pilot", 2000), ("main", 6000), ("cooldown", 9000)], "step")
    return e.select("step", F.round(S.learning_rate(F.col("step"), 500, 8000, 0.0006, 0.00006), 12).alias("lr"), "phase", F.format_string("%.6e", S.perplexity(F.col("value"))).alias("perplexity"))


@_query("""WITH c AS (SELECT source_id AS source, count(DISTINCT doc_id) AS documents FROM normalized_records GROUP BY 1), a AS (SELECT source, count(*) AS documents FROM documents GROUP BY 1)
    SELECT coalesce(c.source, a.source) AS source, 'documents' AS measure, c.documents::DOUBLE AS claimed, a.documents::DOUBLE AS actual, coalesce(c.documents = a.documents, false) AS matches FROM c FULL JOIN a ON c.source = a.source""")
def reconcile(t):
    claimed = t("normalized_records").groupBy(F.col("source_id").alias("source")).agg(F.count_distinct("doc_id").alias("documents"))
    return audits.reconcile(claimed, t("documents").groupBy("source").agg(F.count("*").alias("documents")), ["source"], ["documents"])


@_query("""WITH u AS (SELECT unit_id, bool_or(coalesce(published, false)) AS p FROM unit_commits GROUP BY 1), a AS (SELECT DISTINCT unit_id, quota_tokens AS size FROM unit_commits)
    SELECT count(*) FILTER (p) AS published, coalesce(sum(size) FILTER (p), 0)::BIGINT AS published_bytes, count(*) FILTER (NOT p) AS unpublished, coalesce(sum(size) FILTER (NOT p), 0)::BIGINT AS unpublished_bytes, count(*) FILTER (p IS NULL) AS orphans FROM a LEFT JOIN u USING (unit_id)""")
def journal_totals(t):
    return audits.journal_totals(t("unit_commits").select("unit_id", F.col("quota_tokens").alias("size")).distinct(), t("unit_commits"))


@_query("""WITH q AS (SELECT stage, source_id, (weight * 1000000)::BIGINT AS r FROM (SELECT DISTINCT stage, source_id, weight FROM mixture_targets)), a AS (SELECT stage, source_id, max(accepted_quota_tokens) AS a FROM build_progress GROUP BY ALL)
    SELECT stage, source_id, coalesce(r, 0) AS requested_tokens, coalesce(a, 0) AS actual_tokens, greatest(0, coalesce(r, 0) - coalesce(a, 0)) AS remaining_tokens FROM q FULL JOIN a USING (stage, source_id)""")
def quota_status(t):
    q = t("mixture_targets").select("stage", "source_id", F.round(F.col("weight") * 1000000).cast("long").alias("token_quota")).distinct()
    return audits.quota_status(q, t("build_progress").groupBy("stage", "source_id").agg(F.max("accepted_quota_tokens").alias("actual_tokens")), ["stage", "source_id"])


@_query("SELECT doc_id, coalesce(sum(coalesce(n_chars, 0)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chars_before FROM documents")
def global_prefix(t):
    return windows.prefix_sums(t("documents").select("doc_id", "n_chars"), ["doc_id"], {"chars_before": F.coalesce("n_chars", F.lit(0))}).select("doc_id", "chars_before")


@_query(f"""WITH {_DOCS}, a AS (SELECT sha, min((source, doc_id)) AS k FROM docs WHERE num_chars >= {_MIN_CHARS} GROUP BY sha) SELECT k[1] AS source_id, count(*) AS records, max(k[2]) + 1 AS row_cursor FROM a GROUP BY 1""")
def incremental_units(t):
    """The documents through a stream of units in a folder of its own."""
    d = t("documents").select(F.col("doc_id").alias("row_index"), F.col("source").alias("source_id"), "text")
    spark = d.sparkSession
    raw, folder = new_path(spark, "raw"), new_path(spark, "build")
    d.write.parquet(raw)
    incremental.run_build(spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 4).parquet(raw), folder, {"input": "documents", "min_chars": _MIN_CHARS}, min_chars=_MIN_CHARS)
    return incremental.build_state(spark, folder).drop("units")


@_query(f"""WITH {_DOCS}, h AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY doc_id) = 1 AND num_chars >= {_MIN_CHARS} AS ok, {_HEX.format('sha')} / 18446744073709551616.0::DOUBLE < 0.1 AS held, greatest(1, ceil(num_chars / 4.0))::BIGINT AS tokens FROM docs)
    SELECT (SELECT count(*) FROM nfkc_documents WHERE text IS NOT NULL) AS raw, count(*) AS "read", count(*) FILTER (ok) AS accepted, count(*) FILTER (ok AND held) AS held_out, count(*) FILTER (ok AND NOT held) AS corpus,
    (SELECT count(*) FROM nfkc_documents WHERE text IS NOT NULL) - count(*) FILTER (ok) AS rejected, coalesce(sum(tokens) FILTER (ok AND NOT held), 0)::BIGINT AS quota_tokens FROM h""")
def one_pass_build(t):
    """The documents as one source through sealed and journaled units, in a folder of its own."""
    d = t("documents").filter("text is not null").select(F.col("doc_id").alias("row_index"), "text")
    spark = d.sparkSession
    source = records.Source(id="documents", name="documents")
    plan = {"stage": "main", "buffer_size": 64, "seed": 42, "validation_fraction": 0.1, "items": [{"item_id": "documents", "source_id": "documents", "token_quota": 1 << 50}]}
    limits = onepass.UnitLimits(rows=1 << 40, text_bytes=1 << 60, tokens=1 << 60, free_bytes=0)
    build = onepass.OnePassBuild(spark, new_path(spark, "one-pass"), {"documents": source}, [plan], lambda *_: d, {"input": "documents"}, policy=filters.QualityPolicy(min_chars=_MIN_CHARS), limits=limits)
    state = build.run()
    c = state["counters"]
    row = (*(c[k] for k in ("raw", "read", "accepted", "held_out", "corpus", "rejected")), sum(i["actual"] for i in state["items"].values()))
    return spark.createDataFrame([row], "raw long, read long, accepted long, held_out long, corpus long, rejected long, quota_tokens long")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    nfkc = _nfkc_sql()
    return {name: sql.replace(_NFKC, nfkc) for name, sql in _SQL.items()}
