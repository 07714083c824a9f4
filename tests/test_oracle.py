"""Every registered query against its DuckDB oracle on sf0.001 (the driver
repeats this at sf0.01)."""

from lakeshift.testing import oracle
from lakeshift.testing.compare import run


def test_all_queries_match_oracle(spark):
    res = run(spark, "/root/testdata/sf0.001", verbose=False)
    bad = {k: v for k, v in res.items() if "error" in v or False in (v.get("hash_match"), v.get("cols_match"), v.get("types_match"))}
    assert not bad, bad


def test_every_query_of_the_library_has_sql():
    """The training-data operators have none where SQL can't express them; their tests are in tests/llm."""
    import __spark_entry__ as entry
    from lakeshift.queries import QUERIES

    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) == set(oracle.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_results_do_not_depend_on_session_time_zone(spark):
    names = ["merchants_valid", "customers_invalid", "latest_watermark", "incremental_extract", "merchants_merged", "scd2_merge_with_inserts", "scd2_as_of"]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = run(spark, "/root/testdata/sf0.001", names, verbose=False)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert all(v.get("hash_match") for v in res.values()), res
