"""Operator 12 against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshift.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5, every=100, low=80):
    """rows: (vec_id, whole numbers, label)."""
    out = set()
    for a, x, label in rows:
        if a % every:
            continue
        near = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), b) for b, y, other in rows if other == label and b != a)[:positives]
        far = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), b) for b, y, other in rows if other != label)
        for score, b in near:
            fits = [(s, c) for s, c in far if low * -score <= 100 * -s <= 100 * -score][:negatives]
            out |= {(a, b, k + 1, c, -score, -s) for k, (s, c) in enumerate(fits)}
    return out


def whole(rows, scale=256):
    """What takes part of rows (vec_id, embedding, label)."""
    out = {}
    for i, x, label in rows:
        if None not in (i, x, label) and x and None not in x and all(map(math.isfinite, x)):
            row = (label, [math.floor(float(np.float32(v)) * scale) for v in x])
            out[i] = min(out.get(i, row), row)
    return [(i, x, label) for i, (label, x) in out.items()]


def test_scores_are_exact_inner_products():
    rng = np.random.default_rng(1)
    for size, top, kind in ((64, 300, np.int32), (13, 5, np.int32), (1, 9, np.int64), (20, 1 << 27, np.int64)):
        a, b = (rng.integers(-top, top + 1, (n, size)) for n in (7, 33))
        b[0] = -top
        bits = int(max(abs(b).max(), 1)).bit_length() + 1
        got = hard_negatives.scores(hard_negatives.subset_sums(a, kind), hard_negatives.bit_planes(b, bits))
        assert (got == b @ a.T).all()


@pytest.mark.parametrize("cell", [7, 100, 1 << 19])
def test_equals_brute_force_with_ties_and_a_hot_label(spark, monkeypatch, cell):
    monkeypatch.setattr(hard_negatives, "SMALL_CELL", 1)
    rng = random.Random(cell)
    some = [[rng.randrange(-3, 4) / 4 for _ in range(11)] for _ in range(40)]  # few vectors: many ties
    rows = [(i, some[0] if i % 3 == 0 else rng.choice(some), 1 if rng.random() < 0.4 else rng.randrange(5)) for i in range(-40, 500)]
    got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, cell_size=cell).collect()
    assert {tuple(r) for r in got} == brute(whole(rows), every=20) and len(got) > 100


def test_query_equals_brute_force_on_the_whole_table(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries()["op12_hard_negatives"](spark, sf)
    assert [f"{n} {t}" for n, t in got.dtypes] == [c.replace("long", "bigint") for c in hard_negatives.RESULT.split(", ")]
    got = got.collect()
    assert {tuple(r) for r in got} == brute(whole(rows)) and got


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *[(100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, [0.9, 0.0], 2), (4, [0.5, 0.0], 2)],
        *[(None, [0.9, 0.0], 2), (5, None, 2), (6, [0.9, None], 2), (7, [nan, 0.9], 2), (8, [inf, 0.9], 2), (9, [0.9, 0.0], None), (10, [0.9], 2), (11, [], 2)],
        *[(200, [0.0, 1.0], 7), (300, [0.0, 0.0], 1)],
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    got = {tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 100 == 0).collect()}
    fits = [r for r in whole(rows) if len(r[1]) == 2]
    assert got == brute(fits)
    assert {r[3] for r in got if r[0] == 100 and r[1] == 1} == {2, 3}  # 4 is under 80 per cent
    assert not any(r[0] == 200 for r in got)  # no other row of its label
    for none in (frame.where("vec_id is null"), frame.where(F.lit(False)), frame.where("vec_id = 5")):
        assert hard_negatives.mine(none, F.col("vec_id") % 100 == 0).collect() == []
    assert hard_negatives.mine(frame.where("vec_id = 1"), F.col("vec_id") % 100 == 0).collect() == []
    huge = spark.createDataFrame([(100, [3e38, 1.0], 1), (1, [1.0, 1.0], 1)], SCHEMA)
    with pytest.raises(ValueError):
        hard_negatives.mine(huge, F.col("vec_id") % 100 == 0)
