"""Every registered query against its DuckDB oracle on sf0.001, and the
entry smoke check."""

import pytest

import __spark_entry__ as E
from tables import SF_SMALL
from oracle_check import compare, duck_connect

from fraudlens.plans.oracle import ORACLE
from fraudlens.plans.queries import QUERIES

NAMES = sorted(QUERIES)          # the optional llm queries have tests of their own


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "fraud_count", "total_transactions", "fraud_percentage"]


def test_every_query_is_registered_with_sql_or_known_exception():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(E.oracle_sql()) == {"score_transactions"}     # see score_transactions_rows
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    sql = ORACLE.get(name)
    if sql is None:
        assert df.count() > 0
        return
    ok, msg = compare(df, duck.execute(sql).df())
    assert ok, msg


def test_stream_raw_equals_batch_read(spark):
    """The raw messages whole: SQL has no equal for Spark's JSON text, so
    compare with the batch read of the same topic."""
    from pyspark.sql import functions as F
    from fraudlens.plans import queries as Q
    from fraudlens.sources.envelope import read_batch
    streamed = Q.stream_raw(spark, SF_SMALL)
    batch = read_batch(spark, Q.fixture_topics(spark, SF_SMALL), Q.TX_TOPIC).select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value"))
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
