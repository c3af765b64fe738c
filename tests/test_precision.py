"""Products of single precision that fall on a whole number."""

import duckdb

from vellum.plans import catalog


def test_blank_share_of_samples_at_the_limit(spark, tmp_path):
    path = f"{tmp_path}/embeddings.parquet"
    duckdb.sql(f"COPY (SELECT 1::BIGINT AS vec_id, [(236 / 2550)::FLOAT, -(236 / 2550)::FLOAT, 0.5, 0, NULL] AS embedding, 0 AS label UNION ALL SELECT 2, [], 0 UNION ALL SELECT 3, NULL, 0) TO '{path}' (FORMAT parquet)")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS FROM '{path}'")
    got = sorted(map(tuple, catalog.queries()["blank_share"](spark, str(tmp_path)).collect()))
    assert got == sorted(con.sql(catalog.oracle_sql()["blank_share"]).fetchall()) and got[0] == (1, 0.6)
