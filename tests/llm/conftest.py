import os

import duckdb
import pytest

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="session")
def texts(spark):
    """Documents with what an operator must bear: NULLs, empty and long texts, ties, repeated rows, clashing names."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat and then it ran away from the big dog over there", 7),
        (2, " the cat sat on the mat and then it ran away from the big dog over there\n", 7),
        (3, "The cat sat on the mat and then it ran away from the big dog over here", 7),
        (4, None, 7),
        (5, "", 7),
        (6, " \t\n", 7),
        (7, "12 34 !?", 7),
        (8, "word", 7),
        (9, long, 7),
        (10, "before it: " + long[:5000], 7),
        (11, "a " * 400, 7),
        (12, "a " * 40, None),
        (13, "ünïcode ñandú Straße 中文 🙂 <|endoftext|> İstanbul ΑΣ", 7),
        (None, "the cat sat on the mat and then it ran away from the big dog over there", 7),
        (8, "word", 7),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, keep_id long").repartition(3)


@pytest.fixture(scope="session")
def no_texts(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
