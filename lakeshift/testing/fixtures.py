"""Deterministic migration entities derived from the TPC-H-style test tables.

Each entity is a lazy DataFrame built with plain Spark operators, so its size
(and every query over it) grows with the scale factor of the input tables.
``lakeshift.testing.oracle`` holds the same derivation as DuckDB SQL.

Shapes injected on purpose (first-match rules must see every one of them):
blank/NULL keys, duplicate payment ids, unknown merchants, negative / NULL /
zero amounts, short and late settlements, stale and in-batch duplicate
increments, a brand-new merchant.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.functions.columns import money, money_lit, padded_id, plus_days, ts_lit
from lakeshift.operators.joins import fits_broadcast

SEED_BATCH = "seed_001"
INC_BATCH = "inc_001"


def _ts(text: str):
    return ts_lit(text)


class Fixtures:
    """Lazy entity views over ``<sf_dir>/{orders,supplier,customer,nation,region}.parquet``.

    ``Fixtures.of`` memoizes one instance per (session, directory): DataFrames
    are immutable plans, so sharing them only saves file listing and analysis.
    """

    _instances: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        key = (id(spark), sf_dir.rstrip("/"))
        fx = cls._instances.get(key)
        if fx is None or fx.spark is not spark:
            fx = cls._instances[key] = cls(spark, sf_dir)
        return fx

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def _geo(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.table("region").select("r_regionkey", "r_name")
        geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
        # 25 x 5 rows by specification; broadcast only behind the size check.
        return F.broadcast(geo) if fits_broadcast(geo) else geo

    def _literal_rows(self, rows, schema) -> DataFrame:
        """A few fixed rows built JVM-side (no Python-to-JVM data transfer)."""
        def value(v, f):
            return ts_lit(v, f.dataType) if isinstance(v, datetime) else F.lit(v).cast(f.dataType)

        structs = [F.struct(*[value(v, f).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows]
        return self.spark.range(1).select(F.inline(F.array(*structs)))

    # -- full-load sources -------------------------------------------------
    @cached_property
    def merchants_raw(self) -> DataFrame:
        s = F.col("s_suppkey")
        categories = F.array(*[F.lit(c) for c in S.MERCHANT_CATEGORIES])
        sup = self.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        good = sup.join(self._geo(), sup.s_nationkey == F.col("n_nationkey")).select(
            padded_id("mrc_", s + 1, 6).alias("merchant_id"),
            F.col("s_name").alias("merchant_name"),
            F.element_at(categories, (s % 6 + 1).cast("int")).alias("merchant_category"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.when(s % 20 == 0, "HIGH").when(s % 20 < 5, "MEDIUM").otherwise("LOW").alias("risk_tier"),
            plus_days(_ts("1993-01-01"), s % 365).alias("created_at"),
            plus_days(_ts("1994-01-01"), s % 90).alias("updated_at"),
            F.lit(SEED_BATCH).alias("source_batch_id"),
        )
        c, u = datetime(1993, 1, 1), datetime(1994, 1, 1)
        bad = self._literal_rows(
            [(None, "bad", "FOOD", "X", "X", "LOW", c, u, SEED_BATCH), ("  ", "bad", "FOOD", "X", "X", "LOW", c, u, SEED_BATCH)],
            S.MERCHANTS,
        )
        return good.unionByName(bad)

    @cached_property
    def merchant_count(self):
        """Scalar subquery: number of suppliers (keeps the plan lazy, no driver round-trip)."""
        return self.table("supplier").agg(F.count(F.lit(1))).scalar()

    @cached_property
    def customers_raw(self) -> DataFrame:
        c = F.col("c_custkey")
        cus = self.table("customer").select("c_custkey", "c_name", "c_nationkey")
        good = cus.join(self._geo(), cus.c_nationkey == F.col("n_nationkey")).select(
            padded_id("cus_", c + 1, 8).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(padded_id("customer", c + 1, 8), F.lit("@example.test")).alias("email"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            plus_days(_ts("1993-01-01"), c % 365).alias("created_at"),
            plus_days(_ts("1994-01-01"), c % 90).alias("updated_at"),
            F.lit(SEED_BATCH).alias("source_batch_id"),
        )
        cr, u = datetime(1993, 1, 1), datetime(1994, 1, 1)
        bad = self._literal_rows(
            [(None, "bad", "x", "X", "X", cr, u, SEED_BATCH), ("  ", "bad", "x", "X", "X", cr, u, SEED_BATCH)],
            S.CUSTOMERS,
        )
        return good.unionByName(bad)

    @cached_property
    def payments_raw(self) -> DataFrame:
        k = F.col("o_orderkey")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        return orders.select(
            k.alias("source_record_id"),
            F.when(k % 400 == 11, F.lit(None).cast("string"))
            .when(k % 400 == 12, F.lit("  "))
            .when((k > 0) & (k % 100 == 0), padded_id("pay_", k - 1, 10))
            .otherwise(padded_id("pay_", k, 10))
            .alias("payment_id"),
            padded_id("cus_", F.col("o_custkey") + 1, 8).alias("customer_id"),
            F.when(k % 200 == 0, F.lit("mrc_missing"))
            .otherwise(padded_id("mrc_", F.col("o_custkey") % self.merchant_count + 1, 6))
            .alias("merchant_id"),
            F.when(k % 250 == 0, -money("o_totalprice"))
            .when(k % 500 == 31, F.lit(None).cast(S.MONEY))
            .otherwise(money("o_totalprice"))
            .alias("payment_amount"),
            F.lit("INR").alias("currency"),
            F.when(k % 100 < 80, "CAPTURED")
            .when(k % 100 < 90, "AUTHORIZED")
            .when(k % 100 < 97, "FAILED")
            .otherwise("REFUNDED")
            .alias("payment_status"),
            F.col("o_orderdate").alias("payment_timestamp"),
            F.col("o_orderdate").alias("created_at"),
            plus_days("o_orderdate", k % 11).alias("updated_at"),
            F.lit(SEED_BATCH).alias("source_batch_id"),
        )

    @cached_property
    def settlements_raw(self) -> DataFrame:
        k = F.col("source_record_id")
        eligible = self.payments_raw.filter(
            (F.col("payment_amount") > 0) & (F.col("merchant_id") != "mrc_missing") & (k % 10 != 3)
        )
        late = F.when(k % 50 == 9, F.lit(45)).otherwise(F.lit(0))
        return eligible.select(
            k.alias("source_record_id"),
            F.when(k % 500 == 21, F.lit(None).cast("string")).otherwise(padded_id("stl_", k, 10)).alias("settlement_id"),
            F.when(k % 500 == 24, F.lit("pay_unknown")).otherwise(F.col("payment_id")).alias("payment_id"),
            F.col("merchant_id"),
            F.when(k % 500 == 22, F.lit(0).cast(S.MONEY))
            .when(k % 50 == 7, F.round(F.col("payment_amount") * money_lit("0.95"), 2).cast(S.MONEY))
            .otherwise(F.col("payment_amount"))
            .alias("settlement_amount"),
            F.lit("SETTLED").alias("settlement_status"),
            plus_days("payment_timestamp", 1 + k % 14 + late).alias("settlement_timestamp"),
            F.col("payment_timestamp").alias("created_at"),
            plus_days("payment_timestamp", 2 + k % 14).alias("updated_at"),
            F.lit(SEED_BATCH).alias("source_batch_id"),
        )

    # -- incremental batch -------------------------------------------------
    @cached_property
    def id_step(self) -> Column:
        """Lies above every source id, whatever their number: a power of ten, ten million at least."""
        digits = F.length(F.max("source_record_id").cast("string"))
        power = F.rpad(F.lit("1"), digits + 1, F.lit("0")).cast("long")
        return self.payments_raw.agg(F.greatest(F.lit(10_000_000).cast("long"), power).alias("step")).scalar()

    @cached_property
    def payments_inc(self) -> DataFrame:
        """Three change variants of payments, produced in one pass over the
        source: each row emits every variant whose condition it meets (as a
        UNION ALL would), via ``explode`` of the matching structs."""
        k = F.col("source_record_id")
        cols = S.columns(S.PAYMENTS)

        def variant(cond, **overrides):
            return F.when(cond, F.struct(*[overrides.get(c, F.col(c)).alias(c) for c in cols]))

        amended = variant(
            k % 20 == 5,
            source_record_id=k + self.id_step,
            payment_amount=(F.col("payment_amount") + 10).cast(S.MONEY),
            updated_at=plus_days("updated_at", F.when(k % 40 == 25, F.lit(-30)).otherwise(F.lit(30))),
            source_batch_id=F.lit(INC_BATCH),
        )
        fresh = variant(
            k % 100 == 50,
            source_record_id=k + 2 * self.id_step,
            payment_id=F.when(k % 1000 == 350, F.lit(None).cast("string")).otherwise(padded_id("pay_", k + 2 * self.id_step, 10)),
            merchant_id=F.when(k % 200 == 150, F.lit("mrc_new")).when(k % 400 == 250, F.lit("mrc_missing")).otherwise(F.col("merchant_id")),
            source_batch_id=F.lit(INC_BATCH),
        )
        in_batch_newer = variant(
            k % 200 == 45,
            source_record_id=k + 3 * self.id_step,
            payment_amount=(F.col("payment_amount") + 20).cast(S.MONEY),
            updated_at=plus_days("updated_at", 60),
            source_batch_id=F.lit(INC_BATCH),
        )
        candidates = self.payments_raw.filter((k % 20 == 5) | (k % 100 == 50))  # k % 200 == 45 implies k % 20 == 5
        return (
            candidates.select(F.explode(F.array(amended, fresh, in_batch_newer)).alias("v"))
            .filter(F.col("v").isNotNull())
            .select("v.*")
        )

    @cached_property
    def merchants_inc(self) -> DataFrame:
        valid = self.merchants_raw.filter(F.col("merchant_id").isNotNull() & (F.trim("merchant_id") != ""))
        d = F.substring(F.col("merchant_id"), -1, 1)
        cols = S.columns(S.MERCHANTS)

        def variant(**overrides):
            return [overrides.get(c, F.col(c)).alias(c) for c in cols]

        newer = valid.filter(d.isin("1", "2", "4")).select(
            *variant(
                merchant_category=F.when(d.isin("1", "4"), F.lit("LUXURY")).otherwise(F.col("merchant_category")),
                updated_at=plus_days("updated_at", 200),
                source_batch_id=F.lit(INC_BATCH),
            )
        )
        older = valid.filter(d == "1").select(
            *variant(
                merchant_category=F.lit("OLDER_DUP"),
                updated_at=plus_days("updated_at", 100),
                source_batch_id=F.lit(INC_BATCH),
            )
        )
        t = datetime(1996, 1, 1)
        literal = self._literal_rows(
            [
                ("mrc_new", "Merchant new", "RETAIL", "X", "X", "LOW", t, t, INC_BATCH),
                (None, "bad", "RETAIL", "X", "X", "LOW", t, t, INC_BATCH),
            ],
            S.MERCHANTS,
        )
        return newer.unionByName(older).unionByName(literal)

    @cached_property
    def settlements_inc(self) -> DataFrame:
        k = F.col("source_record_id")
        cols = S.columns(S.SETTLEMENTS)

        def variant(**overrides):
            return [overrides.get(c, F.col(c)).alias(c) for c in cols]

        amended = self.settlements_raw.filter(k % 25 == 20).select(
            *variant(
                source_record_id=k + self.id_step,
                settlement_amount=(F.col("settlement_amount") + 5).cast(S.MONEY),
                updated_at=plus_days("updated_at", F.when(k % 50 == 45, F.lit(-30)).otherwise(F.lit(30))),
                source_batch_id=F.lit(INC_BATCH),
            )
        )
        later = plus_days("payment_timestamp", 20)
        fresh = self.payments_raw.filter(k % 100 == 13).select(
            (k + 2 * self.id_step).alias("source_record_id"),
            F.when(k % 1000 == 213, F.lit(None).cast("string")).otherwise(padded_id("stl_", k + 2 * self.id_step, 10)).alias("settlement_id"),
            F.when(k % 1000 == 613, F.lit("pay_unknown")).otherwise(F.col("payment_id")).alias("payment_id"),
            F.col("merchant_id"),
            F.when(k % 1000 == 413, F.lit(0).cast(S.MONEY)).otherwise(F.col("payment_amount")).alias("settlement_amount"),
            F.lit("SETTLED").alias("settlement_status"),
            later.alias("settlement_timestamp"),
            F.col("payment_timestamp").alias("created_at"),
            later.alias("updated_at"),
            F.lit(INC_BATCH).alias("source_batch_id"),
        )
        return amended.unionByName(fresh)
