"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query derives the migration entities from the scale-factor tables
(``lakeshift.testing.fixtures``) and runs the library operator over the whole
of them; ``lakeshift.testing.oracle`` holds the matching DuckDB SQL. Exact
decimals are cast to double only at this boundary.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift import schema as S
from lakeshift.functions.rules import present
from lakeshift.operators import dedup as D
from lakeshift.operators import expectations as E
from lakeshift.operators import joins as J
from lakeshift.operators import ledger as LG
from lakeshift.operators import range_digests as RD
from lakeshift.operators import reconcile as R
from lakeshift.operators import scd2 as H
from lakeshift.plans import audit as AU
from lakeshift.plans import merge as MG
from lakeshift.sinks import batches as BT
from lakeshift.sinks import manifest as MF
from lakeshift.sources import incremental as INC
from lakeshift.operators.upsert import upsert_latest_parts
from lakeshift.plans.gold import Gold
from lakeshift.plans.jobs import stage, unstage
from lakeshift.plans.silver import Silver, accepted, bronze_to_silver, check_payments, classify_payments, classify_settlements, orphan_keys
from lakeshift.testing.fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def finish(df: DataFrame) -> DataFrame:
    """Decimal money -> double at the report boundary."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema.fields])


class Context:
    """Pipeline stages over one scale factor, each evaluated once.

    ``Context(spark, sf_dir)`` returns one shared instance per (session,
    directory). What several queries read (classified payments and settlements,
    the reconciliation, the merged tables) is written to the shared folder when
    the first of them asks for it, as the jobs do, and read back.
    """

    _instances: dict = {}

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (id(spark), sf_dir.rstrip("/"))
        ctx = cls._instances.get(key)
        if ctx is None or ctx.fx.spark is not spark:
            ctx = super().__new__(cls)
            ctx._init(spark, sf_dir)
            cls._instances[key] = ctx
        return ctx

    def _init(self, spark: SparkSession, sf_dir: str):
        self.fx = Fixtures.of(spark, sf_dir)
        self.sf_dir, self._key = sf_dir.rstrip("/"), f"queries-{uuid.uuid4().hex}"

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        return stage(self.fx.spark, df, self._key, name)

    @cached_property
    def silver(self) -> Silver:
        fx = self.fx
        lazy = bronze_to_silver(fx.merchants_raw, fx.customers_raw, fx.payments_raw, fx.settlements_raw)
        merchants = self.staged(lazy.merchants_valid, "merchants_valid")  # its measured size decides the existence join
        dups = self.staged(D.duplicate_keys(check_payments(fx.payments_raw, merchants), "payment_id", accepted()), "duplicate_payment_ids")
        flagged = self.staged(classify_payments(fx.payments_raw, merchants, dups if J.fits_broadcast(dups) else None), "payments_flagged")
        payments = flagged.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.PAYMENTS))
        unknown = self.staged(orphan_keys(fx.settlements_raw, payments), "unknown_payment_ids")
        checked = self.staged(classify_settlements(fx.settlements_raw, payments, unknown if J.fits_broadcast(unknown) else None), "settlements_checked")
        return Silver(merchants, lazy.merchants_invalid, lazy.customers_valid, lazy.customers_invalid, flagged, checked)

    @cached_property
    def gold(self) -> Gold:
        s = self.silver
        recon = self.staged(R.reconcile(s.payments_silver, s.settlements_valid), "payment_reconciliation")
        return Gold(recon, R.merchant_daily_metrics(recon), H.scd2_init(s.merchants_valid), R.reconciliation_summary(recon, None, None))

    @cached_property
    def merchants_raw(self) -> DataFrame:
        """The source's merchants, written so that their measured size decides the joins with them."""
        return self.staged(self.fx.merchants_raw, "merchants_raw")

    @cached_property
    def target_totals(self) -> DataFrame:
        """The reconciliation's totals: of the written table, if a query wrote it; else made from the columns that
        they read. They are written whole, so that no join of the reconciliation is pruned away behind them."""
        s = self.silver
        recon = self.gold.payment_reconciliation if "gold" in vars(self) else R.reconcile(s.payments_silver, s.settlements_valid)
        return self.staged(R.target_totals(recon), "target_totals")

    @cached_property
    def merchants_merge(self) -> tuple[DataFrame, DataFrame]:
        """(merged merchants, rejected changes)."""
        merged, rejected = MG.merge_merchants(self.silver.merchants_valid, self.fx.merchants_inc)
        return self.staged(merged, "merchants_merged"), rejected

    @cached_property
    def payments_merge(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(merged payments, the increment's rows with their reasons, merged rows of changed keys)."""
        base = self.silver.payments_valid
        flagged = self.staged(MG.validate_payment_changes(self.fx.payments_inc, self.merchants_merge[0]), "payments_inc_flagged")
        current = flagged.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.PAYMENTS))
        untouched, winners = upsert_latest_parts(base, current, "payment_id")
        winners = self.staged(winners, "payments_resolved")
        return self.staged(untouched.unionByName(winners), "payments_merged"), flagged, winners

    @cached_property
    def settlements_merge(self) -> tuple[DataFrame, DataFrame]:
        """(merged settlements, the increment's rows with their reasons)."""
        checked = self.staged(MG.validate_settlement_changes(self.fx.settlements_inc, self.payments_merge[0]), "settlements_inc_checked")
        candidates = checked.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.SETTLEMENTS))
        base = self.silver.settlements_valid.select(*S.columns(S.SETTLEMENTS))
        return self.staged(D.latest_by_key(base.unionByName(candidates), "settlement_id"), "settlements_merged"), checked

    @cached_property
    def merge(self) -> MG.Merge:
        """The increment merged table by table: what validates the next one is written first."""
        fx, (merchants, rejected), (payments, flagged, _), (settlements, checked) = self.fx, self.merchants_merge, self.payments_merge, self.settlements_merge
        return MG.Merge(fx.merchants_inc, fx.payments_inc, fx.settlements_inc, merchants, self.silver.customers_valid, flagged, payments, checked, settlements, rejected)

    @cached_property
    def ledger(self) -> DataFrame:
        """The full load's ledger, the increment posted to it."""
        s, (_, flagged, winners) = self.silver, self.payments_merge
        return self.staged(LG.post_increment(LG.open_ledger(s.payments_flagged), s.payments_valid, flagged, winners, staged=self.staged), "ledger")

    #: What the queries share, in the order in which it is built.
    SHARED = ["silver", "gold", "merchants_merge", "payments_merge", "settlements_merge", "ledger"]

    def release(self) -> None:
        """Drop the shared tables; a later query builds them anew."""
        unstage(self.fx.spark, self._key)
        Context._instances.pop((id(self.fx.spark), self.sf_dir), None)


# -- Silver ---------------------------------------------------------------
@query
def merchants_valid(spark, sf_dir):
    return Context(spark, sf_dir).silver.merchants_valid


@query
def merchants_invalid(spark, sf_dir):
    return Context(spark, sf_dir).silver.merchants_invalid


@query
def customers_valid(spark, sf_dir):
    return Context(spark, sf_dir).silver.customers_valid


@query
def customers_invalid(spark, sf_dir):
    return Context(spark, sf_dir).silver.customers_invalid


@query
def payment_rejections(spark, sf_dir):
    return Context(spark, sf_dir).silver.payments_flagged.select("source_record_id", "payment_id", "merchant_id", "rejection_reason")


@query
def payments_invalid(spark, sf_dir):
    return finish(Context(spark, sf_dir).silver.payments_invalid)


@query
def payment_duplicates(spark, sf_dir):
    return finish(Context(spark, sf_dir).silver.payments_duplicates)


@query
def payments_valid(spark, sf_dir):
    return finish(Context(spark, sf_dir).silver.payments_valid)


@query
def payments_silver(spark, sf_dir):
    return finish(Context(spark, sf_dir).silver.payments_silver)


@query
def settlement_rejections(spark, sf_dir):
    return Context(spark, sf_dir).silver.settlements_checked.select("source_record_id", "settlement_id", "payment_id", "rejection_reason")


@query
def settlements_valid(spark, sf_dir):
    return finish(Context(spark, sf_dir).silver.settlements_silver)


# -- Gold -----------------------------------------------------------------
@query
def settlement_totals(spark, sf_dir):
    return finish(R.settlement_totals(Context(spark, sf_dir).silver.settlements_valid))


@query
def payment_reconciliation(spark, sf_dir):
    return finish(Context(spark, sf_dir).gold.payment_reconciliation)


@query
def merchant_daily_metrics(spark, sf_dir):
    return finish(Context(spark, sf_dir).gold.merchant_daily_metrics)


@query
def reconciliation_summary(spark, sf_dir):
    return finish(Context(spark, sf_dir).gold.reconciliation_summary)


# -- fixed parameters of the registered queries ---------------------------
WATERMARK = ("2001-01-01 00:00:00", 500)
CUTOFF = "2001-06-30 00:00:00"
BATCH_SIZE = 1000
TOP_YEAR, TOP_MONTH, TOP_N = 1998, 6, 10
AS_OF = "1994-08-15 00:00:00"
# Previous watermark state per table for ``advance_watermark`` (customers'
# mark lies after every change, so that table must keep its old mark).
OLD_STATE = [
    ("merchants", "1994-02-01 00:00:00", "mrc_000010"),
    ("customers", "1994-06-01 00:00:00", "cus_00000010"),
    ("payments", "2001-01-01 00:00:00", "500"),
    ("settlements", "2001-01-01 00:00:00", "500"),
]


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _sources(fx: Fixtures) -> dict[str, tuple[DataFrame, str]]:
    return {
        "merchants": (fx.merchants_raw, "merchant_id"),
        "customers": (fx.customers_raw, "customer_id"),
        "payments": (fx.payments_raw, "source_record_id"),
        "settlements": (fx.settlements_raw, "source_record_id"),
    }


# -- Extraction -----------------------------------------------------------
@query
def full_extract(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return finish(MF.assign_batches(fx.payments_raw, "payments", "source_record_id", BATCH_SIZE))


@query
def incremental_extract(spark, sf_dir):
    return finish(INC.changes_since(Fixtures.of(spark, sf_dir).payments_raw, WATERMARK, CUTOFF, "source_record_id"))


@query
def latest_watermark(spark, sf_dir):
    return _union([INC.latest_watermark(df, key, table) for table, (df, key) in _sources(Fixtures.of(spark, sf_dir)).items()])


@query
def advance_watermark(spark, sf_dir):


    fx = Fixtures.of(spark, sf_dir)
    state = spark.createDataFrame(
        [(t, datetime.fromisoformat(ts), k) for t, ts, k in OLD_STATE],
        T.StructType([T.StructField("source_table", T.StringType()), T.StructField("updated_at", T.TimestampNTZType()), T.StructField("source_key", T.StringType())]),
    )
    old = {t: (ts, k) for t, ts, k in OLD_STATE}
    marks = []
    for table, (df, key) in _sources(fx).items():
        extracted = INC.changes_since(df, old[table], CUTOFF, key)
        marks.append(
            extracted.agg(F.max(F.struct(F.col("updated_at").alias("t"), F.col(key).alias("k"))).alias("m"), F.count(F.lit(1)).alias("extracted_rows")).select(
                F.lit(table).alias("source_table"), F.col("m.t").alias("updated_at"), F.col("m.k").cast("string").alias("source_key"), "extracted_rows"
            )
        )
    return INC.advance_watermark(state, _union(marks))


@query
def batch_manifest(spark, sf_dir):
    return MF.batch_manifest(Fixtures.of(spark, sf_dir).payments_raw, "payments", "source_record_id", BATCH_SIZE)


@query
def ordered_batches(spark, sf_dir):
    """Batches of an incremental extract: ascending by time and key, with the mark after each."""
    ctx = Context(spark, sf_dir)
    order = ["updated_at", "source_record_id"]
    numbered = BT.number_batches(INC.changes_since(ctx.fx.payments_raw, None, CUTOFF, "source_record_id"), order, BATCH_SIZE, ctx.staged, "ordered_payments")
    return BT.ordered_manifest(numbered, "payments", "source_record_id", order)


@query
def row_digest(spark, sf_dir):
    p = Fixtures.of(spark, sf_dir).payments_raw
    return p.select("source_record_id", MF.row_digest(p).alias("row_digest"))


@query
def content_checksum(spark, sf_dir):
    """A fingerprint of the payments of each status, whatever their order and layout."""
    return finish(MF.content_checksum(Fixtures.of(spark, sf_dir).payments_raw, ["payment_status"]))


LEAF = 16


@query
def differing_key_ranges(spark, sf_dir):
    """Key ranges in which Silver's payments differ from the source's."""
    ctx = Context(spark, sf_dir)
    return RD.differing_ranges(ctx.fx.payments_raw, ctx.silver.payments_valid, "source_record_id", LEAF, ctx.staged, S.columns(S.PAYMENTS), fanout=8)


@query
def verify_manifest(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    recorded = MF.batch_manifest(ctx.fx.payments_raw, "payments", "source_record_id", BATCH_SIZE)
    # Every extracted row must land in Silver or in quarantine.
    landed = MF.batch_manifest(ctx.silver.payments_flagged, "payments", "source_record_id", BATCH_SIZE)
    return MF.verify_manifest(recorded, landed)


# -- Silver reports -------------------------------------------------------
@query
def quarantine_union(spark, sf_dir):
    return Context(spark, sf_dir).silver.quarantine_union()


@query
def rejection_counts(spark, sf_dir):
    q = Context(spark, sf_dir).silver.quarantine_union()
    return q.groupBy("source_table", "rejection_reason").agg(F.count(F.lit(1)).alias("rejected_rows"))


@query
def quality_report(spark, sf_dir):
    return Context(spark, sf_dir).silver.quality_report()


# -- Incremental merge ----------------------------------------------------
@query
def latest_by_key(spark, sf_dir):
    fx = Fixtures.of(spark, sf_dir)
    return finish(D.latest_by_key(fx.payments_raw.unionByName(fx.payments_inc).filter(present("payment_id")), "payment_id"))


@query
def merchants_merged(spark, sf_dir):
    return Context(spark, sf_dir).merchants_merge[0]


@query
def customers_merged(spark, sf_dir):
    return Context(spark, sf_dir).silver.customers_valid


@query
def payments_merged(spark, sf_dir):
    return finish(Context(spark, sf_dir).payments_merge[0].withColumn("payment_date", F.to_date("payment_timestamp")))


@query
def settlements_merged(spark, sf_dir):
    return finish(Context(spark, sf_dir).settlements_merge[0].withColumn("settlement_date", F.to_date("settlement_timestamp")))


@query
def incremental_payment_rejections(spark, sf_dir):
    return Context(spark, sf_dir).payments_merge[1].select("source_record_id", "payment_id", "merchant_id", "rejection_reason")


@query
def incremental_settlement_rejections(spark, sf_dir):
    return Context(spark, sf_dir).settlements_merge[1].select("source_record_id", "settlement_id", "payment_id", "rejection_reason")


@query
def merge_report(spark, sf_dir):
    return Context(spark, sf_dir).merge.report()


# -- Gold extras ----------------------------------------------------------
@query
def gold_report(spark, sf_dir):
    return Context(spark, sf_dir).gold.report()


@query
def top_merchants(spark, sf_dir):
    return R.top_merchants(Context(spark, sf_dir).gold.merchant_daily_metrics, TOP_YEAR, TOP_MONTH, TOP_N)


@query
def compact_by_month(spark, sf_dir):
    p = R.month_partitions(Context(spark, sf_dir).silver.payments_silver, "payment_date")
    return p.groupBy("partition_year", "partition_month").agg(F.count(F.lit(1)).alias("row_count"))


# -- SCD2 -----------------------------------------------------------------
def _history(ctx: Context) -> DataFrame:
    return H.scd2_init(ctx.silver.merchants_valid)


@query
def scd2_init(spark, sf_dir):
    return _history(Context(spark, sf_dir))


@query
def scd2_changed(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return H.scd2_changes(_history(ctx), ctx.fx.merchants_inc, "merchant_id", S.SCD2_TRACKED_COLUMNS)


@query
def scd2_merge(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return H.scd2_merge(_history(ctx), ctx.fx.merchants_inc, "merchant_id", S.SCD2_TRACKED_COLUMNS)


@query
def scd2_merge_with_inserts(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return H.scd2_merge(_history(ctx), ctx.fx.merchants_inc, "merchant_id", S.SCD2_TRACKED_COLUMNS, insert_new=True)


@query
def scd2_closed(spark, sf_dir):
    return scd2_merge(spark, sf_dir).filter(~F.col("is_current"))


@query
def scd2_opened(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return H.scd2_open(_history(ctx), ctx.fx.merchants_inc, "merchant_id", S.SCD2_TRACKED_COLUMNS)


@query
def scd2_current(spark, sf_dir):
    return scd2_merge(spark, sf_dir).filter(F.col("is_current"))


@query
def scd2_as_of(spark, sf_dir):
    return H.scd2_as_of(scd2_merge_with_inserts(spark, sf_dir), AS_OF)


@query
def scd2_report(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    hist = _history(ctx)
    result = H.scd2_merge(hist, ctx.fx.merchants_inc, "merchant_id", S.SCD2_TRACKED_COLUMNS)
    changed_count = H.scd2_changes(hist, ctx.fx.merchants_inc, "merchant_id", S.SCD2_TRACKED_COLUMNS).agg(F.count(F.lit(1))).scalar()
    return result.agg(
        F.count(F.lit(1)).alias("total_scd2_rows"),
        F.count_if(F.col("is_current")).alias("current_scd2_rows"),
        F.count_if(~F.col("is_current")).alias("closed_scd2_rows"),
    ).select(changed_count.alias("changed_merchants"), "total_scd2_rows", "current_scd2_rows", "closed_scd2_rows")


# -- Quality --------------------------------------------------------------
@query
def expect_not_null(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return _union(
        [
            E.run_expectations(ctx.fx.payments_raw, "payments_raw", [E.not_null("payment_id")]),
            E.run_expectations(ctx.fx.merchants_raw, "merchants_raw", [E.not_null("merchant_id")]),
            E.run_expectations(ctx.silver.payments_valid, "payments", [E.not_null("payment_id")]),
        ]
    )


@query
def expect_unique(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return _union(
        [
            E.run_expectations(ctx.fx.payments_raw, "payments_raw", [E.unique("payment_id")]),
            E.run_expectations(ctx.fx.merchants_raw, "merchants_raw", [E.unique("merchant_id")]),
            E.run_expectations(ctx.silver.payments_valid, "payments", [E.unique("payment_id")]),
        ]
    )


@query
def expect_between(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return _union(
        [
            E.run_expectations(ctx.fx.payments_raw, "payments_raw", [E.between("payment_amount", min_value="0.01")]),
            E.run_expectations(ctx.silver.payments_valid, "payments", [E.between("payment_amount", min_value="0.01")]),
        ]
    )


@query
def expect_in_set(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return _union(
        [
            E.run_expectations(ctx.fx.payments_raw, "payments_raw", [E.in_set("payment_status", S.PAYMENT_STATUSES)]),
            E.run_expectations(
                ctx.gold.payment_reconciliation, "reconciliation", [E.in_set("reconciliation_status", S.RECONCILIATION_STATUSES)]
            ),
        ]
    )


@query
def orphan_payments(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    merchants = ctx.silver.merchants_valid

    def count(df: DataFrame, name: str) -> DataFrame:
        return J.orphans(df, "merchant_id", merchants, "merchant_id").agg(F.count(F.lit(1)).alias("orphan_payment_count")).select(
            F.lit(name).alias("dataset"), "orphan_payment_count"
        )

    return count(ctx.fx.payments_raw, "payments_raw").unionByName(count(ctx.silver.payments_valid, "payments"))


@query
def expectation_suite(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return AU.expectation_suite(ctx.silver.merchants_valid, ctx.silver.payments_valid, ctx.gold.payment_reconciliation)


# -- Reconciliation and metrics -------------------------------------------
def _source_totals(ctx: Context) -> DataFrame:
    return AU.source_expected_totals(ctx.fx.payments_raw, ctx.merchants_raw)


def _migration(ctx: Context) -> DataFrame:
    return AU.migration_reconciliation(_source_totals(ctx), ctx.target_totals, ctx.silver.quality_report())


@query
def source_expected_totals(spark, sf_dir):
    return finish(_source_totals(Context(spark, sf_dir)))


@query
def target_totals(spark, sf_dir):
    return finish(Context(spark, sf_dir).target_totals)


@query
def migration_reconciliation(spark, sf_dir):
    return finish(_migration(Context(spark, sf_dir)))


@query
def merged_ledger(spark, sf_dir):
    return Context(spark, sf_dir).ledger


@query
def merged_reconciliation(spark, sf_dir):
    """The migration's reconciliation after the merge, against the combined source."""
    ctx = Context(spark, sf_dir)
    fx = ctx.fx
    source = AU.source_expected_totals(fx.payments_raw.unionByName(fx.payments_inc), ctx.merchants_merge[0])
    target = R.target_totals(R.reconcile(ctx.payments_merge[0], ctx.settlements_merge[0]))
    return finish(AU.migration_reconciliation(source, target, LG.quarantined_counts(ctx.ledger)))


@query
def pipeline_metrics(spark, sf_dir):
    ctx = Context(spark, sf_dir)
    return AU.pipeline_metrics(ctx.silver.quality_report(), _migration(ctx))
