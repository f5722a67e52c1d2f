"""Every query of the core against its SQL on the smallest tables, and the entry points."""

import math
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from corpusloom import catalog

SF = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def value(v):
    if v is None or str(v) == "<NA>" or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(v)
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    return float(v) if isinstance(v, (int, float, np.integer, np.floating)) else str(v)


def rows(df):
    return sorted((tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", catalog.queries())
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    if name in SQL:
        assert rows(got) == rows(con.sql(SQL[name]).df())
    else:
        assert len(got)


def test_fixed_point_without_sql(spark):
    """The deduplicated quota fill on test data against the loop over rows in order."""
    from tests.test_operators import sequential

    t = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    source = [r.asDict() for r in catalog._quota_rows(t).orderBy(*catalog._ORDER).collect()]
    for i, r in enumerate(source):
        r["pos"] = i
    quotas = {r.item_id: r.token_quota for r in catalog._quotas(t).collect()}
    want = sequential(source, quotas)
    got = {r.row_index: r.disposition for r in catalog.queries()["quota_fill_deduplicated"](spark, SF).collect()}
    assert got == {r["row_index"]: want[r["pos"]] for r in source}


def test_nfkc_hashes_are_those_of_the_records(spark):
    """Most records carry the hash of their normalized text."""
    from pyspark.sql import functions as F

    ours = catalog.queries()["normalize_nfkc"](spark, SF)
    claimed = spark.read.parquet(f"{SF}/normalized_records.parquet").select("doc_id", F.lower("text_sha256").alias("sha")).dropDuplicates(["doc_id"])
    r = ours.join(claimed.filter("sha is not null"), "doc_id").agg(F.avg((F.col("text_sha256") == F.col("sha")).cast("int")).alias("share")).first()
    assert r.share > 0.9


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["reason", "split", "documents", "total_chars"] and df.count() > 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_raw_texts_are_brought_to_nfkc(spark, tmp_path):
    """Queries over raw texts against brute force, on texts that only NFKC makes equal."""
    import hashlib

    from corpusloom.functions.text import normalize

    texts = ["\ufb01ne text", "fine text", "\uff21\uff22\uff23 long enough", "ABC long enough", "plain", None, "x\u00b2", "e\u0301t\u00e9", "\u00e9t\u00e9"]
    texts += [("wide \uff37\uff4f\uff52\uff44 " * 20).strip(), ("wide Word " * 20).strip()]
    docs = [(i, t, "ab"[i > 4], "en", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "\uff57ide \uff37ord wide")], "item_id long, prompt string").write.parquet(f"{tmp_path}/eval_items.parquet")
    run = lambda name: entry.queries()[name](spark, str(tmp_path)).collect()
    plain = {i: normalize(t) for i, t, *_ in docs if t is not None}
    sha = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in plain.items()}
    firsts = {i for i in sha if i == min(j for j in sha if sha[j] == sha[i])}
    assert len(firsts) == 6
    assert {r.doc_id: r.text_sha256 for r in run("first_copies")} == {i: sha[i] for i in firsts}
    assert {r.doc_id for r in run("contamination_join")} == {9, 10}
    assert {r.source: r.documents_sha256 for r in run("documents_digest")} == {s: hashlib.sha256("".join(sha[i] for i, _, x, *_ in docs if x == s and i in sha).encode()).hexdigest() for s in "ab"}
    assert {r.row_index: r.disposition for r in run("quota_fill")}[0] == "too_short"
    plans = {n: entry.queries()[n](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString() for n in ("flagship", "reject_reasons", "tokenizer_metrics")}
    assert not any("ArrowEvalPython" in p for p in plans.values())  # texts are gone through once, into what is stored
    assert {r.text_sha256 for r in run("accepted_documents")} == set()
    assert {r.reason: r.documents for r in run("reject_reasons")} == {"too_short": 8, "benchmark_contamination": 2}
    duplicates = [r.row_index for r in run("quota_fill_deduplicated") if r.disposition == "duplicate_exact"]
    assert len(duplicates) == 1 and duplicates[0] in (9, 10)
    got = {tuple(r) for r in run("block_digests")}
    assert got == {tuple(r) for r in catalog.H.block_digest(spark.createDataFrame([(i, x, sha[i]) for i, _, x, *_ in docs if i in sha], "doc_id long, source_id string, text_sha256 string"), ["source_id"], "doc_id", "text_sha256", 1000).collect()}
