"""Files of one path: the query and its SQL keep one row for each."""

from __future__ import annotations

import duckdb

from sigloom.plans.queries import ORACLE_SQL, QUERIES


def test_one_path_with_several_lengths_is_one_member(spark, tmp_path):
    # The first three keys stand for one path with three lengths.
    folder = str(tmp_path / "orders.parquet")
    spark.createDataFrame([(k,) for k in (1, 65521, 131041, 2, 4)], "o_orderkey long").coalesce(1).write.parquet(folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{folder}/*.parquet'")
    want = con.sql(ORACLE_SQL["jn4_spec_files"])
    got = QUERIES["jn4_spec_files"](spark, str(tmp_path)).select(*want.columns)
    assert len(got.collect()) == 3
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
