"""Driver contract: entry() smoke, stable schema, matching query/oracle keys."""

import __spark_entry__ as entry


def test_entry_flagship_schema_is_stable(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "business_date",
        "merchant_id",
        "currency",
        "payment_count",
        "gross_payment_amount",
        "settled_amount",
        "missing_settlement_count",
        "under_settled_count",
        "unsettled_amount",
    ]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["date", "string", "string", "bigint", "double", "double", "bigint", "bigint", "double"]
    assert df.count() == 1420


def test_every_query_has_an_oracle():
    from lakeshift.queries import QUERIES
    from lakeshift.testing.oracle import QUERIES as SQL

    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) >= 60
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
