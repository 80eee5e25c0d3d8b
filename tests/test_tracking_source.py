"""The tracking data source: drifting headers, one parse a file, pruning, order, odd files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sigloom.sources import tracking_source as T


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def named(df):
    return df.withColumn("file", F.substring_index("path", "/", -1))


def test_drifting_headers(spark, tmp_path):
    place = tmp_path / "01_raw_motion" / "speech" / "Actor_01"
    place.mkdir(parents=True)
    (place / "a.csv").write_text(",x_0,kind\n1,2.5,NA\n0,1.5,p\n")
    (place / "b.csv").write_text(",Unnamed: 0,extra,x_0\n9,0,e,null\n8,1,f,7\n")
    (place / "c.csv").write_text('x_0,kind\n3,"q\nq, ""r"""\n 4 ,s\nbad,t\n1_0,u\n')
    (place / "d.csv").write_text("kind,x_0\n")
    (place / "e.csv").write_text("")
    (place / "f.csv").write_text("x_0,kind,x_0\n1,only\n\n2,b,8,9,10\n")
    (place / "_g.csv").write_text("x_0\n1\n")
    (place / "notes.txt").write_text("no")
    df = named(T.read_tracking_files(spark, str(tmp_path), ["x_0"]))
    assert df.columns == ["path", "row_idx", "x_0", "extra", "kind", "file"]
    assert dict(df.dtypes)["x_0"] == "double"
    got = {(r.file, r.row_idx): (r.x_0, r.kind, r.extra) for r in df.collect()}
    assert got == {
        ("a.csv", 0): (1.5, "p", None), ("a.csv", 1): (2.5, None, None),
        ("b.csv", 0): (None, None, "e"), ("b.csv", 1): (7.0, None, "f"),
        ("c.csv", 0): (3.0, 'q\nq, "r"', None), ("c.csv", 1): (4.0, "s", None), ("c.csv", 2): (None, "t", None), ("c.csv", 3): (None, "u", None),
        ("f.csv", 0): (1.0, "only", None), ("f.csv", 1): (2.0, "b", None),
    }
    plain = named(T.read_tracking_files(spark, str(tmp_path), ["x_0"], ["kind"], na_tokens=False))
    assert [r.kind for r in plain.where("file = 'a.csv'").orderBy("row_idx").collect()] == ["p", "NA"]


def test_thousand_headers_are_one_plan(spark, tmp_path):
    for k in range(1000):
        (tmp_path / f"{k}.csv").write_text(f",x_0,own_{k % 200},z{k}\n0,{k}.5,v{k},1\n")
    df = T.read_tracking_files(spark, str(tmp_path), ["x_0"], ["x_0", "own_7"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and len(plan) < 2000
    assert df.agg(F.sum("x_0"), F.count("own_7")).first() == (sum(k + 0.5 for k in range(1000)), 5)
    assert df.rdd.getNumPartitions() < 10
    assert len(T.read_tracking_files(spark, str(tmp_path), ["x_0"]).columns) == 2 + 1 + 200 + 1000


def test_one_file_is_opened(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"{k}.csv").write_text(f"x_0\n{k}\n")
    (tmp_path / "broken.csv").write_bytes(b"x_0\n\xff\xfe\n")
    df = T.read_tracking_files(spark, str(tmp_path), ["x_0"], ["x_0"])
    path = f"file://{tmp_path}/3.csv"
    assert [r.x_0 for r in df.where(F.col("path") == path).collect()] == [3.0]
    assert df.where(F.col("path").isin(path, f"file://{tmp_path}/4.csv")).rdd.getNumPartitions() == 1
    assert rows(T.read_tracking_files(spark, f"{tmp_path}/2.csv", ["x_0"]), "row_idx", "x_0") == [(0, 2.0)]
    with pytest.raises(FileNotFoundError, match="nowhere"):
        T.read_tracking_files(spark, str(tmp_path / "nowhere"), ["x_0"])


@pytest.mark.parametrize("whole", [0, 1 << 20])
def test_large_files_keep_their_order(spark, tmp_path, whole):
    n = 20_000
    (tmp_path / "up.csv").write_text(",x_0,k\n" + "".join(f"{i},{i}.0,a\n" for i in range(n)))
    (tmp_path / "down.csv").write_text(",x_0,k\n" + "".join(f"{n - i},{i}.0,\"b\nb\"\n" for i in range(n)))
    (tmp_path / "ties.csv").write_text(",x_0\n" + "".join(f"{'' if i == 5 else i // 3},{i}.0\n" for i in range(9)))
    df = T.register(spark).read.format(T.FORMAT).schema("path string, row_idx long, x_0 double, k string").option("wholeBytes", whole).option("blockBytes", 4000).load(f"file://{tmp_path}")
    df = named(df).cache()
    assert df.where("file = 'up.csv' and x_0 = row_idx and k = 'a'").count() == n
    assert df.where(f"file = 'down.csv' and x_0 = {n - 1} - row_idx and k = 'b\nb'").count() == n
    assert [r.x_0 for r in df.where("file = 'ties.csv'").orderBy("row_idx").collect()] == [5, 0, 1, 2, 3, 4, 6, 7, 8]
