"""Runnable jobs (X0-X9): read a run, write the next one, return its report.

Conventions:
* every output lives in a new ``run_id=<id>`` directory, written with
  ``errorifexists`` so a rerun with the same id fails instead of duplicating;
* an intermediate that feeds several outputs is written once as Parquet under
  the session's shared checkpoint folder (``spark.checkpoint.dir``) and read
  back, which cuts the lineage: losing an executor afterwards recomputes from
  that table, not from the source;
* reports are small aggregated DataFrames written as JSON.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.functions.columns import ts_lit
from lakeshift.operators import reconcile as R
from lakeshift.operators.ledger import open_ledger, post_increment, quarantined_counts, small
from lakeshift.operators.scd2 import scd2_merge
from lakeshift.plans.audit import expectation_suite, failure_metrics, migration_reconciliation, pipeline_metrics, source_expected_totals
from lakeshift.operators.upsert import upsert_latest_parts
from lakeshift.plans.gold import silver_to_gold
from lakeshift.plans.merge import Merge, merge_merchants, validate_payment_changes, validate_settlement_changes
from lakeshift.operators.dedup import duplicate_keys, latest_by_key
from lakeshift.operators.joins import fits_broadcast
from lakeshift.plans.silver import Silver, accepted, bronze_to_silver, check_payments, classify_payments, classify_settlements, orphan_keys
from lakeshift.session import ensure_checkpoint_dir
from lakeshift.sinks.batches import write_batches
from lakeshift.sinks.files import write_dataset, write_days, write_listing, write_report
from lakeshift.sinks.manifest import bronze_manifest, verify_files, verify_manifest
from lakeshift.sources.files import path_exists, read_bronze, read_dataset
from lakeshift.sources.incremental import STATE_COLUMNS, advance_watermark, changes_since, latest_watermark

TABLES = ["merchants", "customers", "payments", "settlements"]


def run_dir(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/run_id={run_id}"


def _refuse_existing(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        if path_exists(spark, p):
            raise FileExistsError(f"output already exists: {p} (use a new run id)")


def _stage_root(spark: SparkSession, job_key: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakeshift-stage/{job_key}"


def stage(spark: SparkSession, df: DataFrame, job_key: str, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    ``job_key`` (job name + run id) scopes the staged tables of one job run.
    """
    path = f"{_stage_root(spark, job_key)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def unstage(spark: SparkSession, job_key: str) -> None:
    """Drop a finished job run's staged tables (kept on failure for inspection)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_stage_root(spark, job_key))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _now(as_of) -> datetime:
    return as_of or _utc_now().replace(microsecond=0)


# -- X0: extraction -----------------------------------------------------------
def extract_full(spark: SparkSession, sources: dict[str, DataFrame], bronze_root: str, run_id: str, batch_size: int = 50_000, extract_date: str | None = None) -> DataFrame:
    """Full snapshot of each source table into Bronze CSV batches, ordered by key, + manifest."""
    out = run_dir(bronze_root, run_id)
    _refuse_existing(spark, out)
    extract_date = extract_date or _utc_now().date().isoformat()
    manifests, written = [], []
    staged = lambda df, name: stage(spark, df, f"extract-{run_id}", name)
    try:
        for table, df in sources.items():
            path = f"{out}/{table}/extract_date={extract_date}"
            key, columns = S.ENTITIES[table]["extract_key"], S.columns(S.ENTITIES[table]["schema"])
            batches, _, n = write_batches(df.select(*columns), path, table, key, [key], batch_size, staged)
            written.append((table, n))
            manifests.append(batches)
        manifest = manifests[0]
        for m in manifests[1:]:
            manifest = manifest.unionByName(m)
        write_listing(manifest.withColumn("run_id", F.lit(run_id)), f"{out}/_manifest")
        # Rows counted while writing, per table: what verification compares against.
        write_report(spark.createDataFrame(written, "source_table string, written_rows long"), f"{out}/_written")
        unstage(spark, f"extract-{run_id}")
        return read_manifest(spark, out)
    except Exception:
        spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit("FAILED").alias("status")).write.mode("overwrite").json(f"{out}/_manifest_failed")
        raise


MANIFEST = "source_table string, batch_id string, batch_number long, record_count long, last_source_key string, watermark_after_batch timestamp_ntz, sha256 string, status string, run_id string"
STATE = "source_table string, updated_at timestamp_ntz, source_key string"


class CheckFailed(RuntimeError):
    """A data check of a job did not pass; its report says which."""


def read_manifest(spark: SparkSession, run: str, more: str = "") -> DataFrame:
    return spark.read.schema(MANIFEST + more).json(f"{run}/_manifest")


def verify_extract(spark: SparkSession, bronze_run: str) -> DataFrame:
    """Manifest check (K4): count and SHA-256 of every batch, read again from the
    files, against the manifest; and per table, the rows counted during the
    write (batch ``*``) against those in the manifest."""
    recorded = read_manifest(spark, bronze_run)
    written = spark.read.schema("source_table string, written_rows long").json(f"{bronze_run}/_written")
    tables = [r["source_table"] for r in written.select("source_table").collect()]  # the entities
    landed = [bronze_manifest(spark, f"{bronze_run}/{t}", t, S.ENTITIES[t]["extract_key"]) for t in tables]
    files = landed[0]
    for more in landed[1:]:
        files = files.unionByName(more)
    columns = ["source_table", "batch_id", "recorded_count", "landed_count", "status"]
    per_batch = verify_files(recorded, files).select(*columns)
    none = written.select("source_table", F.lit(0).cast("long").alias("record_count"))  # an empty table has no batch
    counted = recorded.select("source_table", "record_count").union(none).groupBy("source_table").agg(F.sum("record_count").alias("record_count")).withColumn("batch_id", F.lit("*"))
    totals = written.select("source_table", F.lit("*").alias("batch_id"), F.col("written_rows").alias("record_count"))
    return per_batch.unionByName(verify_manifest(totals, counted).select(*columns))


def initialize_state(spark: SparkSession, sources: dict[str, DataFrame], state_root: str) -> DataFrame:
    """Save the current high-water mark of every table (``--initialize``)."""
    marks = [latest_watermark(df, S.ENTITIES[t]["extract_key"], t) for t, df in sources.items()]
    state = marks[0]
    for m in marks[1:]:
        state = state.unionByName(m)
    write_report(state, f"{state_root.rstrip('/')}/version=1")
    return read_state(spark, state_root)


class StateClaimed(RuntimeError):
    """Another run is extracting the next version of this state."""


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def claim_state(spark: SparkSession, state_root: str, version: int, run_id: str) -> str:
    """Claim a state version for a run by creating one file, which only one run can do.

    The claim stays beside the version that it led to. ``release_state`` gives up
    a claim whose run has failed.
    """
    path = f"{state_root.rstrip('/')}/_claims/version={version}"
    p, fs = _path(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:
        if fs.exists(p):
            raise StateClaimed(f"{path} is claimed by another run; release it if that run has failed") from e
        raise
    out.write(bytearray(run_id.encode()))
    out.close()
    return path


def release_state(spark: SparkSession, claim: str) -> None:
    p, fs = _path(spark, claim)
    fs.delete(p, False)


def state_versions(spark: SparkSession, state_root: str) -> list[int]:
    """The committed versions of a state; one whose write has not ended is none."""
    p, fs = _path(spark, state_root.rstrip("/"))
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    done = [n for n in names if n.startswith("version=") and path_exists(spark, f"{state_root.rstrip('/')}/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix("version=")) for n in done)


def read_state(spark: SparkSession, state_root: str) -> DataFrame:
    """Latest committed watermark state (highest ``version=`` directory)."""
    version = state_versions(spark, state_root)[-1]
    state = spark.read.schema(STATE).json(f"{state_root.rstrip('/')}/version={version}")
    return state.select("source_table", "updated_at", "source_key", F.lit(version).alias("version"))


def extract_incremental(
    spark: SparkSession, sources: dict[str, DataFrame], bronze_root: str, run_id: str, state_root: str, cutoff: datetime | None = None, batch_size: int = 50_000
) -> DataFrame:
    """Changes since the saved watermarks, up to a fixed cutoff (X0 incremental).

    The next state version is claimed before any data is written, so that of two
    runs at a time one fails with ``StateClaimed``. Order of commits: data, then
    manifest, then the new state version (Q12); a run that fails gives its claim
    up. The state has one row per table, so it is read on the driver as config.
    """
    out = run_dir(bronze_root, run_id)
    _refuse_existing(spark, out)
    cutoff = cutoff or _utc_now().replace(microsecond=0)
    version = state_versions(spark, state_root)[-1] + 1
    claim = claim_state(spark, state_root, version, run_id)
    try:
        _extract_changes(spark, sources, out, run_id, state_root, version, cutoff, batch_size)
    except Exception:
        release_state(spark, claim)
        raise
    return read_manifest(spark, out, ", cutoff_at timestamp_ntz")


def _extract_changes(spark: SparkSession, sources: dict[str, DataFrame], out: str, run_id: str, state_root: str, version: int, cutoff: datetime, batch_size: int) -> None:
    state = read_state(spark, state_root)
    marks = {r["source_table"]: (r["updated_at"], r["source_key"]) for r in state.collect()}
    staged = lambda df, name: stage(spark, df, f"extract-{run_id}", name)
    manifests, new_marks = [], []
    for table, df in sources.items():
        key = S.ENTITIES[table]["extract_key"]
        changes = changes_since(df, marks.get(table), cutoff, key).select(*S.columns(S.ENTITIES[table]["schema"]))
        batches, rows, _ = write_batches(changes, f"{out}/{table}", table, key, ["updated_at", key], batch_size, staged)
        manifests.append(batches)
        new_marks.append(latest_watermark(rows, key, table))  # of what was extracted, not of its text
    manifest = manifests[0]
    for m in manifests[1:]:
        manifest = manifest.unionByName(m)
    write_listing(manifest.withColumn("run_id", F.lit(run_id)).withColumn("cutoff_at", ts_lit(cutoff)), f"{out}/_manifest")
    merged = new_marks[0]
    for m in new_marks[1:]:
        merged = merged.unionByName(m)
    write_report(advance_watermark(state.select(*STATE_COLUMNS), merged), f"{state_root.rstrip('/')}/version={version}")
    unstage(spark, f"extract-{run_id}")


LEDGER = "source_record_id long, rejection_reason string, rows long"


# -- X1: Bronze -> Silver -----------------------------------------------------
def bronze_to_silver_job(spark: SparkSession, bronze_run: str, silver_root: str, quarantine_root: str, run_id: str, as_of: datetime | None = None) -> DataFrame:
    silver_out, q_out = run_dir(silver_root, run_id), run_dir(quarantine_root, run_id)
    _refuse_existing(spark, silver_out, q_out)
    as_of = _now(as_of)
    t = {name: read_bronze(spark, bronze_run, name).select(*S.columns(S.ENTITIES[name]["schema"])) for name in TABLES}
    # Parse each CSV once: every later pass (outputs, existence joins, winners
    # window, join-back, settlement rules, report) reads pruned Parquet columns.
    for name in TABLES:
        t[name] = stage(spark, t[name], f"silver-{run_id}", f"bronze_{name}")
    lazy = bronze_to_silver(t["merchants"], t["customers"], t["payments"], t["settlements"])
    # Repeated payment ids are normally rare: stage them, and when the staged
    # set (size measured from its files) fits the broadcast threshold, only
    # their rows are ranked; the rest of the payments is never shuffled.
    checked = check_payments(t["payments"], lazy.merchants_valid)
    dups = stage(spark, duplicate_keys(checked, "payment_id", accepted()), f"silver-{run_id}", "duplicate_payment_ids")
    sparse = classify_payments(t["payments"], lazy.merchants_valid, dups) if fits_broadcast(dups) else lazy.payments_flagged
    # The payment flags feed five outputs and the settlement rules: write once.
    flagged = stage(spark, sparse, f"silver-{run_id}", "payments_flagged")
    payments_valid = flagged.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.PAYMENTS))
    unknown = stage(spark, orphan_keys(t["settlements"], payments_valid), f"silver-{run_id}", "unknown_payment_ids")
    checked = classify_settlements(t["settlements"], payments_valid, unknown if fits_broadcast(unknown) else None)
    settlements_checked = stage(spark, checked, f"silver-{run_id}", "settlements_checked")
    silver = Silver(lazy.merchants_valid, lazy.merchants_invalid, lazy.customers_valid, lazy.customers_invalid, flagged, settlements_checked)

    write_dataset(silver.merchants_valid, f"{silver_out}/merchants")
    write_dataset(silver.customers_valid, f"{silver_out}/customers")
    write_dataset(silver.payments_silver, f"{silver_out}/payments", "payment_date")
    write_dataset(silver.settlements_silver, f"{silver_out}/settlements", "settlement_date")
    ts = F.lit(as_of).cast("timestamp")
    write_dataset(silver.merchants_invalid.withColumn("quarantined_at", ts), f"{q_out}/merchants")
    write_dataset(silver.customers_invalid.withColumn("quarantined_at", ts), f"{q_out}/customers")
    write_dataset(silver.payments_invalid.withColumn("quarantined_at", ts), f"{q_out}/payments_invalid")
    write_dataset(silver.payments_duplicates.withColumn("quarantined_at", ts), f"{q_out}/payments_duplicates")
    write_dataset(silver.settlements_invalid.withColumn("quarantined_at", ts), f"{q_out}/settlements")
    # Which source rows are not in Silver, and why: what a later merge accounts from.
    write_dataset(open_ledger(flagged), f"{silver_out}/_ledger")
    report = silver.quality_report().withColumn("run_id", F.lit(run_id)).withColumn("status", F.lit("COMPLETED"))
    write_report(report, f"{silver_out}/_quality_report")
    unstage(spark, f"silver-{run_id}")
    return spark.read.json(f"{silver_out}/_quality_report")


# -- X2: incremental merge ----------------------------------------------------
def merge_job(spark: SparkSession, base_silver_run: str, bronze_inc_run: str, silver_root: str, quarantine_root: str, run_id: str, as_of: datetime | None = None) -> DataFrame:
    """Merchants first, then payments (staged: they validate settlements and
    are an output), then settlements; absent change tables are empty (Q7)."""
    out, q_out = run_dir(silver_root, run_id), run_dir(quarantine_root, run_id)
    _refuse_existing(spark, out, q_out)
    ts = F.lit(_now(as_of)).cast("timestamp")
    base = {n: read_dataset(spark, base_silver_run, n) for n in TABLES}
    inc = {n: read_bronze(spark, bronze_inc_run, n, missing_ok=True).select(*S.columns(S.ENTITIES[n]["schema"])) for n in ("merchants", "payments", "settlements")}

    merchants, merchants_rejected = merge_merchants(base["merchants"], inc["merchants"])
    write_dataset(merchants, f"{out}/merchants")
    merchants = read_dataset(spark, out, "merchants")
    write_dataset(base["customers"], f"{out}/customers")

    # Silver payments are unique per id: only changed keys are re-ranked, and
    # only the days of their rows, old and new, are written again.
    payments_flagged = stage(spark, validate_payment_changes(inc["payments"], merchants), f"merge-{run_id}", "payments_flagged")
    current = payments_flagged.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.PAYMENTS))
    payment_winners = stage(spark, upsert_latest_parts(base["payments"].drop("payment_date"), current, "payment_id")[1], f"merge-{run_id}", "payments_resolved")
    _merge_days(base["payments"], payment_winners, "payment_id", "payment_timestamp", "payment_date", f"{base_silver_run}/payments", f"{out}/payments")
    payments = read_dataset(spark, out, "payments").drop("payment_date")

    # Settlements: a merged base is unique per settlement id (the merge
    # deduplicates), so it goes by days as well. A full-load base is not
    # guaranteed unique (Q3): the whole union is re-ranked (one shuffle), then
    # rebalanced by day.
    settlements_checked = stage(spark, validate_settlement_changes(inc["settlements"], payments), f"merge-{run_id}", "settlements_checked")
    candidates = settlements_checked.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.SETTLEMENTS))
    base_settlements = base["settlements"].drop("settlement_date")
    if path_exists(spark, f"{base_silver_run}/_merge_report"):
        winners = stage(spark, upsert_latest_parts(base_settlements, candidates, "settlement_id")[1], f"merge-{run_id}", "settlements_resolved")
        _merge_days(base["settlements"], winners, "settlement_id", "settlement_timestamp", "settlement_date", f"{base_silver_run}/settlements", f"{out}/settlements")
    else:
        merged = latest_by_key(base_settlements.unionByName(candidates), "settlement_id")
        write_dataset(merged.withColumn("settlement_date", F.to_date("settlement_timestamp")), f"{out}/settlements", "settlement_date")

    # Each written dataset is listed once (day partitions make listing the
    # dominant cost of small runs); the reports reuse these frames.
    written = {
        "merchants": merchants,
        "customers": read_dataset(spark, out, "customers"),
        "payments": payments,
        "settlements": read_dataset(spark, out, "settlements"),
    }
    m = Merge(
        inc["merchants"], inc["payments"], inc["settlements"], merchants, written["customers"],
        payments_flagged, payments, settlements_checked, written["settlements"], merchants_rejected,
    )
    write_dataset(merchants_rejected.withColumn("quarantined_at", ts), f"{q_out}/merchants")
    write_dataset(m.payments_rejected.drop("is_latest").withColumn("quarantined_at", ts), f"{q_out}/payments")
    write_dataset(m.settlements_rejected.withColumn("quarantined_at", ts), f"{q_out}/settlements")
    write_report(m.report().withColumn("run_id", F.lit(run_id)).withColumn("status", F.lit("COMPLETED")), f"{out}/_merge_report")
    ledger = post_increment(read_ledger(spark, base_silver_run), base["payments"], payments_flagged, payment_winners, staged=lambda df, name: stage(spark, df, f"merge-{run_id}", name))
    write_dataset(ledger, f"{out}/_ledger")
    write_report(
        cumulative_quality(spark, base_silver_run, written, read_ledger(spark, out), settlements_checked, merchants_rejected)
        .withColumn("run_id", F.lit(run_id))
        .withColumn("status", F.lit("COMPLETED")),
        f"{out}/_quality_report",
    )
    unstage(spark, f"merge-{run_id}")
    return spark.read.json(f"{out}/_merge_report")


def _merge_days(base: DataFrame, winners: DataFrame, key: str, time: str, day: str, base_path: str, path: str) -> None:
    """The merged dataset: days that hold a changed key, before or after, written
    anew from the base's rows of those days; for all others the base's folders.

    The base's keys and days are read beside the winners' keys; its other columns
    only in the touched days. A day is a partition, so their list is small.
    """
    winners = winners.withColumn(day, F.to_date(time))
    keys = small(winners.select(key))
    before = base.select(key, day).join(keys, key, "left_semi").select(day)
    days = {r[0] for r in before.union(winners.select(day)).distinct().collect()}
    there = F.col(day).isin([d for d in days if d is not None])
    kept = base.where(F.coalesce(there, F.lit(None in days))).join(keys, key, "left_anti").select(*base.columns)
    write_days(kept.unionByName(winners.hint("rebalance", day)), path, day, days, base_path)


def read_ledger(spark: SparkSession, run: str) -> DataFrame:
    """A Silver run's ledger; empty for a base snapshot without history."""
    if not path_exists(spark, f"{run}/_ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{run}/_ledger")


def cumulative_quality(
    spark: SparkSession,
    base_run: str,
    merged: dict[str, DataFrame],
    ledger: DataFrame,
    settlements_checked: DataFrame,
    merchants_rejected: DataFrame,
) -> DataFrame:
    """Quality report of a merged run in the Silver report's schema (Q10).

    Counts are cumulative over the base run and this increment; payments are
    counted by the run's ledger, so raw accounting (R2) also holds for merged
    runs, whether a change comes under a new source id or in place, and the
    reconciliation job runs on them unchanged.
    """
    if path_exists(spark, f"{base_run}/_quality_report"):
        prior = spark.read.json(f"{base_run}/_quality_report").select("section", "name", F.col("value").cast("long"))
    else:  # a base snapshot without history: count from zero
        prior = spark.createDataFrame([], "section string, name string, value long")
    reason = F.col("rejection_reason")
    increment = _quality_counts(
        [
            (merged["merchants"], "valid_rows", "merchants", None, "set"),
            (merged["customers"], "valid_rows", "customers", None, "set"),
            (merged["payments"], "valid_rows", "payments", None, "set"),
            (merged["settlements"], "valid_rows", "settlements", None, "set"),
            (merchants_rejected, "quarantined_rows", "merchants", None, "add"),
            (settlements_checked, "quarantined_rows", "settlements", reason.isNotNull(), "add"),
        ]
    )
    combined = prior.withColumn("op", F.lit("add")).unionByName(increment).unionByName(quarantined_counts(ledger).withColumn("op", F.lit("set")))
    # "set" rows replace the prior value of their (section, name).
    replaced = combined.groupBy("section", "name").agg(
        F.max(F.when(F.col("op") == "set", 1).otherwise(0)).alias("_has_set"),
        F.sum(F.when(F.col("op") == "set", F.col("value"))).alias("_set"),
        F.sum(F.when(F.col("op") == "add", F.col("value"))).alias("_delta"),
    )
    return replaced.select(
        "section", "name", F.when(F.col("_has_set") == 1, F.col("_set")).otherwise(F.col("_delta")).cast("long").alias("value")
    )


def _quality_counts(entries) -> DataFrame:
    parts = []
    for df, section, name, cond, op in entries:
        v = F.count(F.lit(1)) if cond is None else F.count_if(cond)
        parts.append(df.agg(v.alias("value")).select(F.lit(section).alias("section"), F.lit(name).alias("name"), "value", F.lit(op).alias("op")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- X3: Silver -> Gold -------------------------------------------------------
def silver_to_gold_job(spark: SparkSession, silver_run: str, gold_root: str, run_id: str, as_of: datetime | None = None) -> DataFrame:
    out = run_dir(gold_root, run_id)
    _refuse_existing(spark, out)
    as_of = _now(as_of)
    merchants = read_dataset(spark, silver_run, "merchants")
    payments = read_dataset(spark, silver_run, "payments")
    settlements = read_dataset(spark, silver_run, "settlements")
    gold = silver_to_gold(merchants, payments, settlements, run_id, as_of)
    # Four status values: each task writes at most four files, so no rebalance
    # shuffle of the whole reconciliation is needed here.
    write_dataset(gold.payment_reconciliation, f"{out}/payment_reconciliation", "reconciliation_status", rebalance=False)
    # Everything downstream reads the written reconciliation, not its lineage.
    recon = read_dataset(spark, out, "payment_reconciliation", gold.payment_reconciliation.schema)
    write_dataset(R.merchant_daily_metrics(recon), f"{out}/merchant_daily_metrics", "business_date")
    write_dataset(gold.merchant_scd2, f"{out}/merchant_scd2")
    write_dataset(R.reconciliation_summary(recon, run_id, as_of), f"{out}/reconciliation_summary")
    from lakeshift.plans.gold import Gold

    written = Gold(recon, read_dataset(spark, out, "merchant_daily_metrics", gold.merchant_daily_metrics.schema), read_dataset(spark, out, "merchant_scd2"), read_dataset(spark, out, "reconciliation_summary"))
    write_report(written.report().withColumn("run_id", F.lit(run_id)), f"{out}/_gold_report")
    return spark.read.json(f"{out}/_gold_report")


# -- X4: SCD2 -----------------------------------------------------------------
def scd2_job(spark: SparkSession, base_history: str, bronze_inc_run: str, gold_root: str, run_id: str, insert_new: bool = False) -> DataFrame:
    out = run_dir(gold_root, run_id)
    _refuse_existing(spark, out)
    history = spark.read.parquet(base_history)
    changes = read_bronze(spark, bronze_inc_run, "merchants", missing_ok=True).select(*S.columns(S.MERCHANTS))
    write_dataset(scd2_merge(history, changes, "merchant_id", S.SCD2_TRACKED_COLUMNS, insert_new), f"{out}/merchant_scd2")
    written = read_dataset(spark, out, "merchant_scd2")
    report = written.agg(
        F.count(F.lit(1)).alias("total_scd2_rows"),
        F.count_if("is_current").alias("current_scd2_rows"),
        F.count_if(~F.col("is_current")).alias("closed_scd2_rows"),
    )
    before = history.agg(F.count_if(~F.col("is_current"))).scalar()  # each change closes one version
    report = report.select((F.col("closed_scd2_rows") - before).alias("changed_merchants"), "*").withColumn("run_id", F.lit(run_id))
    write_report(report, f"{out}/_scd2_report")
    return spark.read.json(f"{out}/_scd2_report")


# -- X6, X7, X8: audit ----------------------------------------------------------
def validate_job(spark: SparkSession, silver_run: str, gold_run: str, out_root: str, run_id: str) -> DataFrame:
    out = run_dir(out_root, run_id)
    _refuse_existing(spark, out)
    suite = expectation_suite(
        read_dataset(spark, silver_run, "merchants"), read_dataset(spark, silver_run, "payments"), read_dataset(spark, gold_run, "payment_reconciliation")
    )
    write_report(suite, f"{out}/_expectations")
    result = spark.read.json(f"{out}/_expectations")
    if result.filter(F.col("suite_status") != "PASSED").limit(1).count():
        raise CheckFailed("data-quality validation failed; see the report")
    return result


def reconcile_job(spark: SparkSession, source_payments: DataFrame, source_merchants: DataFrame, silver_run: str, gold_run: str, out_path: str) -> DataFrame:
    _refuse_existing(spark, out_path)
    quality = spark.read.json(f"{silver_run}/_quality_report")
    result = migration_reconciliation(
        source_expected_totals(source_payments, source_merchants), R.target_totals(read_dataset(spark, gold_run, "payment_reconciliation")), quality
    )
    write_report(result, out_path)
    written = spark.read.json(out_path)
    if written.filter(F.col("status") != "PASSED").limit(1).count():
        raise CheckFailed("migration reconciliation failed; see the report")
    return written


def metrics_job(spark: SparkSession, quality_report: str, reconciliation_report: str, out_path: str) -> DataFrame:
    quality = spark.read.json(quality_report)
    status = "COMPLETED" if quality.filter(F.col("status") != "COMPLETED").limit(1).count() == 0 else "FAILED"
    metrics = pipeline_metrics(quality, spark.read.json(reconciliation_report), status).withColumn("pipeline", F.lit("migration"))
    write_report(metrics, out_path)
    return spark.read.json(out_path)


# -- X9: the full chain ---------------------------------------------------------
def full_migration(spark: SparkSession, sources: dict[str, DataFrame], root: str, run_id: str, batch_size: int = 50_000) -> dict[str, DataFrame]:
    """extract -> verify -> Silver -> Gold -> reconcile -> metrics, in order.

    Whatever fails, the failure metric is written before the error goes on.
    """
    root = root.rstrip("/")
    try:
        return _full_migration(spark, sources, root, run_id, batch_size)
    except Exception:
        failed = f"{root}/metrics/run_id={run_id}"
        if not path_exists(spark, failed):
            write_report(failure_metrics(spark).withColumn("pipeline", F.lit("migration")), failed)
        raise


def _full_migration(spark: SparkSession, sources: dict[str, DataFrame], root: str, run_id: str, batch_size: int) -> dict[str, DataFrame]:
    manifest = extract_full(spark, sources, f"{root}/bronze", run_id, batch_size)
    check = verify_extract(spark, run_dir(f"{root}/bronze", run_id))
    if check.filter(F.col("status") != "MATCHED").limit(1).count():
        raise CheckFailed("manifest verification failed: " + str(check.filter(F.col("status") != "MATCHED").take(20)))
    quality = bronze_to_silver_job(spark, run_dir(f"{root}/bronze", run_id), f"{root}/silver", f"{root}/quarantine", run_id)
    gold = silver_to_gold_job(spark, run_dir(f"{root}/silver", run_id), f"{root}/gold", run_id)
    recon_path = f"{root}/audit/gold_run_id={run_id}"
    recon = reconcile_job(spark, sources["payments"], sources["merchants"], run_dir(f"{root}/silver", run_id), run_dir(f"{root}/gold", run_id), recon_path)
    metrics = metrics_job(spark, f"{run_dir(f'{root}/silver', run_id)}/_quality_report", recon_path, f"{root}/metrics/run_id={run_id}")
    return {"manifest": manifest, "quality": quality, "gold": gold, "reconciliation": recon, "metrics": metrics}
