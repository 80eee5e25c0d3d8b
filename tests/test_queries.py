"""Every registered query of the signal operators against its SQL."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from sigloom.plans.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([float(r[i]) if isinstance(r[i], (int, float)) and not isinstance(r[i], bool) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    assert got == plain(want.fetchall(), want.columns)
    assert got or name in ("sc7_uncovered", "jn1_skip_done", "fi4_no_song_actor", "sc2_raw_clips")


def test_one_exchange_serves_the_whole_clean_up(spark, sf_dir):
    plan = QUERIES["wn5_clean_signal"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2
