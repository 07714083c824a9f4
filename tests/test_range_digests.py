"""Range digests against brute force."""

import random
from collections import Counter

from lakeshift.operators.range_digests import differing_ranges, differing_rows


def writer(tmp, names):
    def write(df, name):
        names.append(name)
        path = f"{tmp}/{len(names)}-{name}"
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)

    return write


def brute(left, right, leaf):
    out = {}
    for side, rows in enumerate((left, right)):
        for k, v in rows:
            out.setdefault(None if k is None else k // leaf, (Counter(), Counter()))[side][(k, v)] += 1
    return {(None if n is None else n * leaf, sum(a.values()), sum(b.values())) for n, (a, b) in out.items() if a != b}


def test_ranges_and_rows_equal_brute_force(spark, tmp_dir):
    rng = random.Random(6)
    left = [(rng.choice([None, *range(-300, 3000)]), rng.choice("ab")) for _ in range(1500)]
    right = list(left)
    for _ in range(12):
        right.pop(rng.randrange(len(right)))
        right.append((rng.choice([None, -77, 5, 2999, 90_000]), "c"))
    right[3] = (right[3][0], "d")
    schema = "k long, v string"
    a, b = spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema)
    got = differing_ranges(a, b, "k", 10, writer(tmp_dir, []), fanout=4)
    assert {(r.low_key, r.left_rows, r.right_rows) for r in got.collect()} == brute(left, right, 10)
    assert all(r.low_key is None or r.high_key == r.low_key + 9 for r in got.collect())
    rows = differing_rows(a, b, "k", 10, writer(f"{tmp_dir}/rows", []))
    want = Counter(left), Counter(right)
    assert sorted((r.k is not None, r.k or 0, r.left_rows, r.right_rows) for r in rows.collect()) == sorted((k is not None, k or 0, want[0][k, v], want[1][k, v]) for k, v in want[0] | want[1] if want[0][k, v] != want[1][k, v])


def test_equal_tables_end_at_the_top(spark, tmp_dir):
    df = spark.range(5000).selectExpr("id AS k", "id % 7 AS v")
    names = []
    assert differing_ranges(df, df.repartition(4), "k", 5, writer(tmp_dir, names), fanout=10).collect() == []
    assert names == ["leaves_left", "leaves_right", "differing_1000"]


def test_one_changed_row_is_one_path(spark, tmp_dir):
    df = spark.range(5000).selectExpr("id AS k", "id % 7 AS v")
    other = df.selectExpr("k", "CASE WHEN k = 1234 THEN 99 ELSE v END AS v")
    names = []
    write = writer(tmp_dir, names)
    assert [tuple(r) for r in differing_ranges(df, other, "k", 5, write, fanout=10).collect()] == [(1230, 1234, 5, 5)]
    assert [spark.read.parquet(f"{tmp_dir}/{k + 1}-{n}").count() for k, n in enumerate(names) if n.startswith("differing")] == [1, 1, 1, 1]


def test_empty_tables(spark, tmp_dir):
    df = spark.range(30).selectExpr("id AS k")
    none = df.where("false")
    assert differing_ranges(none, none, "k", 5, writer(tmp_dir, [])).collect() == []
    assert sorted(tuple(r) for r in differing_ranges(df, none, "k", 20, writer(f"{tmp_dir}/b", [])).collect()) == [(0, 19, 20, 0), (20, 39, 10, 0)]
