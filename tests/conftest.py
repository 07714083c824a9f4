import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lakeshift.session import build_session

    spark = build_session("local[4]", app="lakeshift-tests", shuffle_partitions=4)
    yield spark
    spark.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakeshift-test-")


@pytest.fixture(scope="session")
def fx(spark):
    from lakeshift.testing.fixtures import Fixtures

    return Fixtures.of(spark, SF_SMALL)


def rows(df, *cols):
    """Sorted list of tuples (optionally projected) for order-free asserts."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)


def by_month(df):
    """Payments or settlements on the first of their months: a fraction of the day partitions, the same rows."""
    from pyspark.sql import functions as F

    time = next(c for c in ("settlement_timestamp", "payment_timestamp") if c in df.columns)
    return df.withColumn(time, F.date_trunc("month", time).cast("timestamp_ntz"))
