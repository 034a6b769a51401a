from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls, blank, very long and repeated texts, ties, and extra columns
    whose names clash with those the operators make."""
    long = " ".join(f"w{i % 5000}x{i}" for i in range(60_000))
    base = " ".join(f"alpha{i}" for i in range(40))
    rows = [(1, base), (2, base), (2, base), (3, base.upper()), (4, None), (5, ""), (6, " \n\t"),
            (7, "one two"), (8, "one two"), (9, long), (10, long + " tail"), (None, base), (11, "é ü \U0001F600 " * 30)]
    return spark.createDataFrame([(i, t, "en", None, 0, 1, 2.0, 3, "x", "y") for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 "node bigint, score double, cluster int, size string, component string")
