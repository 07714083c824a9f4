"""Property tests: Spark operators against brute-force Python models on random small frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeshift.operators.dedup import latest_by_key, split_duplicates
from lakeshift.operators.upsert import upsert_latest

SCHEMA = "source_record_id long, payment_id string, updated_at int, v int"
rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)),
    min_size=0,
    max_size=25,
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _with_ids(rows, start=0):
    return [(start + i, k, t, v) for i, (k, t, v) in enumerate(rows)]


def _newest(rows):
    """Per key: max updated_at (NULL lowest), then max id."""
    best = {}
    for r in rows:
        key = (r[2] is not None, r[2] if r[2] is not None else 0, r[0])
        if r[1] not in best or key > best[r[1]][0]:
            best[r[1]] = (key, r)
    return sorted(r for _, r in best.values())


@SETTINGS
@given(rows_st)
def test_latest_by_key_matches_model(spark, rows):
    data = _with_ids(rows)
    got = sorted(tuple(r) for r in latest_by_key(spark.createDataFrame(data, SCHEMA), "payment_id").collect())
    assert got == _newest(data)


@SETTINGS
@given(rows_st)
def test_split_duplicates_partitions_rows(spark, rows):
    data = _with_ids(rows)
    keep, dups = split_duplicates(spark.createDataFrame(data, SCHEMA), "payment_id")
    keep_rows, dup_rows = sorted(tuple(r) for r in keep.collect()), sorted(tuple(r) for r in dups.collect())
    assert keep_rows == _newest(data)
    assert sorted(keep_rows + dup_rows) == sorted(data)


@SETTINGS
@given(rows_st, rows_st)
def test_key_scoped_upsert_equals_full_rerank(spark, base_rows, change_rows):
    base = _newest(_with_ids(base_rows))  # a snapshot: one row per key
    changes = _with_ids(change_rows, start=1000)
    b, c = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(changes, SCHEMA)
    scoped = sorted(tuple(r) for r in upsert_latest(b, c, "payment_id", base_unique=True).collect())
    full = sorted(tuple(r) for r in upsert_latest(b, c, "payment_id").collect())
    assert scoped == full == _newest(base + changes)


keys_st = st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"])), max_size=20)


@SETTINGS
@given(keys_st, keys_st)
def test_flag_exists_matches_membership_on_both_paths(spark, fact_keys, dim_keys):
    from lakeshift.operators.joins import flag_exists

    fact = spark.createDataFrame([(i, k) for i, k in enumerate(fact_keys)], "id long, fk string")
    dim = spark.createDataFrame([(k,) for k in dim_keys], "pk string")
    expected = sorted((i, k, k is not None and k in set(dim_keys)) for i, k in enumerate(fact_keys))
    assert sorted(tuple(r) for r in flag_exists(fact, "fk", dim, "pk", "f").collect()) == expected
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(tuple(r) for r in flag_exists(fact, "fk", dim, "pk", "f", salt_buckets=3).collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 6))), max_size=25),
    st.one_of(st.none(), st.tuples(st.integers(0, 6), st.integers(0, 30))),
    st.integers(0, 6),
)
def test_changes_since_matches_model(spark, rows, mark, cutoff):
    from datetime import datetime, timedelta

    from lakeshift.sources.incremental import changes_since

    t0 = datetime(2024, 1, 1)
    data = [(k, None if d is None else t0 + timedelta(days=d)) for k, d in rows]
    df = spark.createDataFrame(data, "k long, updated_at timestamp_ntz")
    cut = t0 + timedelta(days=cutoff)
    wm = None if mark is None else (t0 + timedelta(days=mark[0]), mark[1])
    got = sorted(tuple(r) for r in changes_since(df, wm, cut, "k").collect())

    def take(k, ts):
        if ts is None or ts > cut:
            return False
        return wm is None or ts > wm[0] or (ts == wm[0] and k > wm[1])

    assert got == sorted(r for r in data if take(*r))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["x", "y", "z"])), st.one_of(st.none(), st.integers(-3, 3))), max_size=25))
def test_expectations_match_model(spark, rows):
    from lakeshift.operators import expectations as E

    df = spark.createDataFrame(rows, "k string, v int")
    res = {r["expectation"]: r["unexpected_count"] for r in E.run_expectations(df, "d", [E.not_null("k"), E.unique("k"), E.between("v", -1, 1), E.in_set("k", ["x", "y"])]).collect()}
    counts = {}
    for k, _ in rows:
        counts[k] = counts.get(k, 0) + 1
    assert res["expect_column_values_to_not_be_null"] == sum(1 for k, _ in rows if k is None)
    assert res["expect_column_values_to_be_unique"] == sum(n for k, n in counts.items() if k is not None and n > 1)
    assert res["expect_column_values_to_be_between"] == sum(1 for _, v in rows if v is not None and not -1 <= v <= 1)
    assert res["expect_column_values_to_be_in_set"] == sum(1 for k, _ in rows if k is not None and k not in ("x", "y"))


@SETTINGS
@given(st.lists(st.lists(st.tuples(st.sampled_from(["m1", "m2", "m3"]), st.sampled_from(["FOOD", "TRAVEL"]), st.integers(1, 20)), max_size=6), min_size=1, max_size=3))
def test_scd2_history_invariants_hold_for_any_batches(spark, batches):
    from datetime import datetime, timedelta

    from lakeshift import schema as S
    from lakeshift.operators.scd2 import scd2_init, scd2_merge

    t0 = datetime(2024, 1, 1)

    def dim(rows):
        return spark.createDataFrame(
            [(m, "n", c, "X", "X", "LOW", t0, t0 + timedelta(days=d), "b") for m, c, d in rows], S.MERCHANTS
        )

    hist = scd2_init(dim([("m1", "FOOD", 0), ("m2", "FOOD", 0)]))
    for step, batch in enumerate(batches):
        shifted = [(m, c, d + 20 * step) for m, c, d in batch]
        hist = spark.createDataFrame(scd2_merge(hist, dim(shifted), "merchant_id", S.SCD2_TRACKED_COLUMNS, insert_new=True).collect(), hist.schema)
    rows = [r.asDict() for r in hist.collect()]
    by_key = {}
    for r in rows:
        by_key.setdefault(r["merchant_id"], []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r["scd_version"])
        assert [v["scd_version"] for v in versions] == list(range(1, len(versions) + 1))
        assert sum(v["is_current"] for v in versions) == 1 and versions[-1]["is_current"] and versions[-1]["effective_to"] is None
        for a, b in zip(versions, versions[1:]):
            assert a["effective_to"] == b["effective_from"] and a["effective_from"] < b["effective_from"]
            assert any(a[c] != b[c] for c in S.SCD2_TRACKED_COLUMNS)


@SETTINGS
@given(rows_st, st.lists(st.booleans(), min_size=25, max_size=25))
def test_sparse_survivor_flag_equals_dense(spark, rows, accepted):
    from pyspark.sql import functions as F

    from lakeshift.operators.dedup import duplicate_keys, flag_latest, flag_latest_sparse

    data = [(i, None if k == "d" else k, t, v, accepted[i]) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA + ", ok boolean")
    dense = sorted(tuple(r) for r in flag_latest(df, "payment_id", eligible=F.col("ok")).collect())
    sparse = sorted(tuple(r) for r in flag_latest_sparse(df, "payment_id", duplicate_keys(df, "payment_id", F.col("ok")), eligible=F.col("ok")).collect())
    assert sparse == dense


money_st = st.decimals(min_value="-50", max_value="50", places=2, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(
    st.lists(money_st, min_size=1, max_size=8),
    st.lists(st.tuples(st.integers(0, 7), money_st), max_size=12),
)
def test_reconciliation_matches_model(spark, amounts, settlements):
    from datetime import datetime
    from decimal import Decimal

    from lakeshift import schema as S
    from lakeshift.operators.reconcile import reconcile

    t = datetime(2024, 1, 1)
    pay = spark.createDataFrame([(i, f"p{i}", "c", "m", a, "INR", "CAPTURED", t, t, t, "b") for i, a in enumerate(amounts)], S.PAYMENTS)
    stl = spark.createDataFrame([(j, f"s{j}", f"p{i}", "m", a, "SETTLED", t, t, t, "b") for j, (i, a) in enumerate(settlements)], S.SETTLEMENTS)
    got = {r["payment_id"]: (r["settled_amount"], r["settlement_record_count"], r["reconciliation_status"]) for r in reconcile(pay, stl).collect()}
    for i, a in enumerate(amounts):
        mine = [x for k, x in settlements if k == i]
        settled = sum(mine, Decimal("0.00"))
        diff = a - settled
        status = "MISSING_SETTLEMENT" if not mine else "MATCHED" if abs(diff) <= Decimal("0.01") else "UNDER_SETTLED" if diff > 0 else "OVER_SETTLED"
        assert got[f"p{i}"] == (settled, len(mine), status)


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 9)), max_size=6, unique_by=lambda r: r[0]),
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 9), st.integers(0, 99)), max_size=10),
)
def test_upsert_replace_matches_model(spark, base_rows, change_rows):
    from lakeshift.operators.upsert import upsert_replace

    base = spark.createDataFrame([(k, u, -1) for k, u in base_rows], "merchant_id string, updated_at int, v int")
    changes = spark.createDataFrame(change_rows, "merchant_id string, updated_at int, v int")
    got = sorted(tuple(r) for r in upsert_replace(base, changes, "merchant_id").collect())
    latest = {}
    for k, u, v in change_rows:  # newest change per key; ties -> smallest v (deterministic tiebreak)
        if k not in latest or (u, -v) > (latest[k][1], -latest[k][2]):
            latest[k] = (k, u, v)
    expected = sorted([(k, u, -1) for k, u in base_rows if k not in latest] + list(latest.values()))
    assert got == expected  # the change wins even when older than the base row


@SETTINGS
@given(st.lists(st.integers(0, 5000), unique=True, max_size=40), st.integers(1, 700))
def test_batch_manifest_matches_model(spark, keys, size):
    from lakeshift.sinks.manifest import batch_manifest

    df = spark.createDataFrame([(k,) for k in keys], "source_record_id long")
    got = {r["batch_id"]: (r["record_count"], r["last_source_key"]) for r in batch_manifest(df, "payments", "source_record_id", size).collect()}
    model = {}
    for k in keys:
        b = f"payments-{k // size + 1:05d}"
        n, last = model.get(b, (0, -1))
        model[b] = (n + 1, max(last, k))
    assert got == {b: (n, str(last)) for b, (n, last) in model.items()}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.integers(0, 5))), max_size=25))
def test_latest_watermark_matches_model(spark, rows):
    from datetime import datetime, timedelta

    from lakeshift.sources.incremental import latest_watermark

    t0 = datetime(2024, 1, 1)
    data = [(k, None if d is None else t0 + timedelta(days=d)) for k, d in rows]
    mark = latest_watermark(spark.createDataFrame(data, "k long, updated_at timestamp_ntz"), "k", "t").collect()[0]
    timed = [(ts, k) for k, ts in data if ts is not None]
    if not timed:
        assert mark["updated_at"] is None and mark["source_key"] is None
    else:
        ts, k = max(timed)
        assert (mark["updated_at"], mark["source_key"]) == (ts, str(k))
