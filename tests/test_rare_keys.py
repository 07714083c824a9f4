"""Settlements are marked by the few ids that no payment has, and the metrics by narrow columns (pipeline_metrics)."""

import random
import re

from lakeshift import schema as S
from lakeshift.operators import reconcile as R
from lakeshift.plans.silver import classify_settlements, orphan_keys
from lakeshift.queries import QUERIES, Context
from tests.conftest import SF_SMALL, rows


def tables(spark, seed):
    pick = random.Random(seed)
    ids = [None, "", "  ", "gone", *(f"p{k}" for k in range(12))]
    names = S.columns(S.SETTLEMENTS)
    own = {"source_record_id": lambda k: str(k), "settlement_id": lambda k: f"'s{k}'" if k % 7 else "null", "settlement_amount": lambda k: str(k % 5)}
    quoted = lambda x: "null" if x is None else f"'{x}'"
    lines = []
    for k in range(60):
        values = {**{n: own[n](k) for n in own}, "payment_id": quoted(pick.choice(ids))}
        lines.append("(" + ", ".join(f"cast({values.get(f.name, 'null')} as {f.dataType.simpleString()})" for f in S.SETTLEMENTS.fields) + ")")
    settlements = spark.sql(f"select * from values {', '.join(lines)} as t({', '.join(names)})")
    payments = spark.createDataFrame([(x,) for x in pick.sample(ids[4:], 6)], "payment_id string")
    return settlements, payments


def test_settlements_marked_by_orphan_keys_equal_the_join(spark):
    for seed in range(4):
        settlements, payments = tables(spark, seed)
        unknown = orphan_keys(settlements, payments)
        told = [r[0] for r in unknown.collect()]
        assert len(told) == len(set(told)) and None not in told and {"gone", "  "} & set(told)
        assert rows(classify_settlements(settlements, payments, unknown)) == rows(classify_settlements(settlements, payments))


def test_settlements_are_not_shuffled_where_few_ids_are_unknown(spark):
    settlements, payments = tables(spark, 9)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    few = Context(spark, SF_SMALL)
    silver, before = few.silver, spark.conf.get(limit)
    assert before != "-1"
    unknown = few.staged(orphan_keys(few.fx.settlements_raw, silver.payments_valid), "unknown_again")
    plan = classify_settlements(few.fx.settlements_raw, silver.payments_valid, unknown)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"Exchange hashpartitioning\(payment_id", plan)


def test_metrics_write_no_wide_table_and_keep_the_totals(spark):
    Context(spark, SF_SMALL).release()
    QUERIES["pipeline_metrics"](spark, SF_SMALL).collect()
    ctx = Context(spark, SF_SMALL)
    assert "gold" not in vars(ctx) and ctx.target_totals.count() == 1
    whole = R.target_totals(ctx.gold.payment_reconciliation)
    assert rows(whole) == rows(ctx.target_totals)
