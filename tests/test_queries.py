import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = df.collect()
    assert got
    if name in oracle_sql():
        cursor = con.execute(oracle_sql()[name])
        columns, want = [d[0] for d in cursor.description], cursor.fetchall()
        assert sorted(df.columns) == sorted(columns)
        assert check._rows(df.columns, got) == check._rows(columns, want)


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["id_a", "id_b", "reasons", "summary"] and rows.count() > 0


def test_candidate_pairs_lists_every_pair_of_a_block(spark, tmp_path):
    texts = ["prefix one", "prefix two", "prefix three", "other", "prefix two"]
    # The second and the last record compare alike and are one profile; the fourth shares no block.
    ids = [4, 8, 16, 32, 92]
    rows = [(i, t, "en", "web", 100) for i, t in zip(ids, texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries()["candidate_pairs"](spark, str(tmp_path))
    names = [f"DB{i:08d}" for i in ids]
    want = {(names[0], names[1]), (names[0], names[2]), (names[1], names[2]), (names[1], names[1])}
    assert found.columns == ["id_a", "id_b"] and sorted(map(tuple, found.collect())) == sorted(want)
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(c.execute(oracle_sql()["candidate_pairs"]).fetchall()) == sorted(want)
