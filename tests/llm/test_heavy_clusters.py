"""Operator 6 where clusters are cut into blocks, with hubs, and links take rounds: the same results as brute force."""

import random

import pytest

from lakeshift.llm import bottom_k, components
from tests.llm.helpers import brute_groups


@pytest.mark.parametrize("hubs", [0, 1000])
def test_heavy_clusters_equal_brute_force(spark, monkeypatch, hubs):
    for name, value in {"BLOCK_WEIGHT": 1500, "HUB_WEIGHT": 1200, "ROW_WEIGHT": 10, "HUBS": 3, "HUB_BLOCKS": hubs, "MAP_BITS": 1 << 16}.items():
        monkeypatch.setattr(bottom_k, name, value)
    monkeypatch.setattr(components, "LINKS_AT_ONCE", 5)
    rng, rows = random.Random(hubs), []
    for group in range(3):  # copies of copies: many are near some, few near the first
        texts = [[f"w{group}x{k}" for k in range(150)]]
        for _ in range(70):
            text = list(rng.choice(texts[-12:] if group else texts[:6]))
            for _ in range(rng.randrange(1, 9)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            texts.append(text)
        rows += texts
    rows = [(k, " ".join(t)) for k, t in enumerate(rows)]
    rng.shuffle(rows)
    got = bottom_k.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()
    want = brute_groups(rows, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 3 < len({c for _, c in want.values()}) < 150
