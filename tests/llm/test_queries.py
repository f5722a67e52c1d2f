import pytest

from corpusloom.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": ["build_id", "stage", "source_id"],
    "p2_found": ["doc_id"],
    "p3_found": ["incoming_id"],
    "p4_found": ["record_id"],
    "p5_found": ["doc_id_a", "doc_id_b"],
    "p6_found": ["doc_id", "item_id"],
    "p7_found": ["stage", "source_id"],
    "p8_found": ["doc_id"],
}


@pytest.mark.parametrize("name", queries.queries())
def test_query(spark, name):
    df = queries.queries()[name](spark, SF)
    rows = df.collect()
    assert rows and len(set(map(str, rows))) == len(rows)
    if name in COLUMNS:
        assert df.columns == COLUMNS[name]


def test_unreachable_targets_come_from_the_selection(spark):
    plan = queries.queries()["p7_found"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan.lower() and "reached_tokens" in plan


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_by_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("encoded_records", "shard_layouts"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = sorted(con.sql(queries.oracle_sql()[name]).fetchall())
    assert sorted(map(tuple, queries.queries()[name](spark, SF).collect())) == want
