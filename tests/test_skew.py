"""Hot keys: a third of all rows on one merchant and one payment id.

Broadcast is disabled and AQE's skew thresholds are lowered so the shuffle
paths (salted existence join + AQE split, partial top-1) run at test scale.
"""

from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.operators.joins import flag_exists
from lakeshift.plans.silver import bronze_to_silver
from conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "200",
}


@contextmanager
def conf(spark, settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed_payments(spark, n):
    t = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.col("id").alias("source_record_id"),
        F.when(hot, F.lit("pay_hot")).otherwise(F.concat(F.lit("pay_"), F.col("id").cast("string"))).alias("payment_id"),
        F.lit("c").alias("customer_id"),
        F.when(hot, F.lit("m_hot")).otherwise(F.concat(F.lit("m_"), (F.col("id") % 100).cast("string"))).alias("merchant_id"),
        F.lit(10).cast(S.MONEY).alias("payment_amount"),
        F.lit("INR").alias("currency"),
        F.lit("CAPTURED").alias("payment_status"),
        t.alias("payment_timestamp"),
        t.alias("created_at"),
        (t + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") % 7).cast("decimal(18,6)"))).alias("updated_at"),
        F.lit("b").alias("source_batch_id"),
    )


def merchants(spark):
    ids = spark.range(100).select(F.concat(F.lit("m_"), F.col("id").cast("string")).alias("merchant_id"))
    ids = ids.unionByName(spark.range(2).select(F.lit("m_hot").alias("merchant_id")))  # duplicated key: no fan-out allowed
    return ids.select("merchant_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in S.MERCHANTS.fields if f.name != "merchant_id"])


def test_hot_keys_are_exact_and_split(spark):
    n = 120_000
    with conf(spark, SKEW_CONF):
        silver = bronze_to_silver(merchants(spark), spark.createDataFrame([], S.CUSTOMERS), skewed_payments(spark, n), spark.createDataFrame([], S.SETTLEMENTS))
        out = silver.payments_flagged.groupBy("rejection_reason").count()
        got = {r[0]: r[1] for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert got == {None: n * 2 // 3 + 1, S.DUPLICATE_PAYMENT_ID: n // 3 - 1}
    assert "SortMergeJoin(skew=true)" in plan  # salted buckets of the hot merchant split further by AQE
    assert "WindowGroupLimit" in plan


def test_existence_strategies_agree(spark):
    fact = skewed_payments(spark, 3000).select("source_record_id", "merchant_id").unionByName(
        spark.range(1).select(F.lit(-1).cast("long").alias("source_record_id"), F.lit(None).cast("string").alias("merchant_id"))
    )
    dim = merchants(spark)
    broadcast = rows(flag_exists(fact, "merchant_id", dim, "merchant_id", "f"))
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        salted = rows(flag_exists(fact, "merchant_id", dim, "merchant_id", "f"))
        plain = rows(flag_exists(fact, "merchant_id", dim.dropDuplicates(["merchant_id"]), "merchant_id", "f", unique=True))
    assert broadcast == salted == plain
    assert len(broadcast) == 3001 and dict((r[0], r[2]) for r in broadcast)[-1] is False
