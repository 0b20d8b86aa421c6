import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from sieve.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="sieve-tests")
    yield s
    s.stop()


def corpus_df(spark, docs):
    """docs: list of (title, body[, tags]) -> corpus with ids 1..n."""
    from pyspark.sql import functions as F
    rows = [(i + 1, d[0], d[1], list(d[2]) if len(d) > 2 else []) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "doc_id long, title string, body string, tags array<string>") \
        .withColumn("created_at", F.current_timestamp())


def queries_df(spark, qs, k=20):
    return spark.createDataFrame([(i + 1, q, k) for i, q in enumerate(qs)], "query_id long, q string, k int")
