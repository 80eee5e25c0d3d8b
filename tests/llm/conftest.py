from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{i % 97} and{i % 13}" for i in range(9000))
#: Nulls, empty and very long texts, ties and repeated rows.
EDGES = [
    (1, None, None, "a"),
    (2, "", "en", "a"),
    (3, "   \n\t ", "en", None),
    (4, LONG, "en", "a"),
    (5, LONG, "en", "b"),
    (6, LONG + " end", "de", "b"),
    (7, "short one", "de", "b"),
    (7, "short one", "de", "b"),
    (None, "short one", "de", "b"),
    (None, None, None, None),
    (8, "été … naïve \U0001f600 <|endoftext|> done", "fr", "c"),
    (9, "x", "fr", "c"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Edge cases with extra columns whose names operators use inside."""
    df = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    for c in ("id", "t", "h", "digest", "salt", "n", "v", "size", "shard", "raw", "spans", "item", "start", "__set", "__status", "__n", "row", "rest", "a.b"):
        df = df.selectExpr("*", f"1 as `{c}`")
    return df.cache()


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")
