"""Operator 11 against brute force."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakeshift.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else "".join(c for c in text if c not in ".!?") if how == 2 else text
        role = "user" if how == 4 else role
        out += [(conv, turn, role, text)] * (2 if how == 3 else 1)
    return out


def brute_faults(rows):
    out, seen = [], set()
    for role, text in rows:
        shown = text.strip(WHITE)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_repair(rows, faults):
    """(cost, audit, lines): the least cost of every suffix and state, then the least initials in ASCII order."""
    n = len(rows)
    wants = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def edits(i, state):
        want = wants[state]
        out = [(5, "I", 0, want[0], f"{want}:")]
        if i < n:
            (role, text), extra = rows[i], 5 if faults[i] == "truncated" else 0
            out.append((2, "D", 1, state, None))
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] == want[0] or (state == "" and role[:1] == "s"):
                    out.append((extra, "K", 1, role[0], f"{role}:{text}"))
                out.append((extra + 1, "R", 1, want[0], f"{want}:{text}"))
        return sorted(out, key=lambda e: e[1])

    cost = {}
    for i in range(n, -1, -1):
        for s in wants:
            cost[i, s] = 0 if i == n and s in ("", "a") else 10**9
        for _ in range(3):
            for s in wants:
                cost[i, s] = min([cost[i, s], *(c + cost[i + step, to] for c, _, step, to, _ in edits(i, s) if (i + step, to) in cost)])
    i, state, audit, lines = 0, "", "", []
    while not (i == n and cost[i, state] == 0):
        for c, name, step, to, line in edits(i, state):
            if c + cost[i + step, to] == cost[i, state]:
                audit += name
                lines += [line] if line is not None else []
                i, state = i + step, to
                break
    return cost[0, ""], audit, lines


def brute(rows, every=()):
    out, held = {}, {}
    for conv, *row in rows:
        held.setdefault(conv, []).append(row)
    for conv in every:
        held.setdefault(conv, [])
    for conv, own in held.items():
        name = lambda r: hashlib.md5(f"{' ' if conv is None else conv}:{str(conv is None).lower()}:{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()  # noqa: B023, E731
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, name(r)))
        said, turns = [(r[1], r[2]) for r in own], {r[0] for r in own} - {None}
        faults = brute_faults(said)
        pairs = ["".join((a[0][:1], b[0][:1])) for a, b in itertools.pairwise(said)]
        cost, audit, lines = brute_repair(said, faults)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def as_dict(frame):
    rows = frame.select(*COLUMNS).collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def letters_of(said):
    faults = ["", "blank", "duplicate", "truncated"]
    return "".join(chr(65 + 4 * faults.index(f) + turn_repair.ROLES.get(role[:1], 3)) for (role, _), f in zip(said, brute_faults(said), strict=True))


def applied(said, codes):
    out = []
    for (role, text), code in zip(said, turn_repair.by_row(codes), strict=True):
        for c in code:
            out += {"K": [f"{role}:{text}"], "U": [f"user:{text}"], "A": [f"assistant:{text}"], "u": ["user:"], "a": ["assistant:"], "D": []}[c]
    return out


def test_search_equals_brute_force():
    rng = random.Random(2)
    for n in range(1, 90):
        for _ in range(12):
            said, dirt = [], rng.choice([0.02, 0.1, 0.5, 1])
            for k in range(n):
                role = ("user", "assistant")[k % 2] if rng.random() > dirt else rng.choice(["system", "user", "assistant", "tool", "", "usher"])
                text = f"{k}." if rng.random() > dirt else rng.choice(["", "cut", "same.", " "])
                said.append((role, text))
            cost, codes = turn_repair.repair(letters_of(said).encode())
            want = brute_repair(said, brute_faults(said))
            assert (cost, codes.translate(turn_repair.AUDIT), applied(said, codes)) == want


def test_all_short_conversations():
    """Every run of up to four letters; roles x faults."""
    of = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    for n in range(1, 4):
        for kinds in itertools.product(itertools.product("suax", ["", "blank", "truncated"]), repeat=n):
            said = [(of[r], {"": f"{k}.", "blank": "", "truncated": f"{k}"}[f]) for k, (r, f) in enumerate(kinds)]
            faults = [f for _, f in kinds]
            letters = "".join(chr(65 + 4 * ["", "blank", "duplicate", "truncated"].index(f) + "suax".index(r)) for r, f in kinds)
            cost, codes = turn_repair.repair(letters.encode())
            assert (cost, codes.translate(turn_repair.AUDIT)) == brute_repair(said, faults)[:2]


def test_long_conversations_are_searched_in_stretches():
    rng = random.Random(7)
    said = [(("user", "assistant")[k % 2] if rng.random() > 0.05 else rng.choice(["user", "tool"]), f"{k}." if rng.random() > 0.05 else "") for k in range(6000)]
    letters = letters_of(said).encode()
    parts = list(turn_repair.stretches(letters))
    assert len(parts) > 50 and max(b - a for a, b, _ in parts) < 1500
    cost, codes = turn_repair.repair(letters)
    assert (cost, codes.translate(turn_repair.AUDIT), applied(said, codes)) == brute_repair(said, brute_faults(said))
    for letters in (b"B" * 30_000, b"A" * 5000, b"P" * 5000, b"FB" * 5000):  # nothing to part the search
        cost, codes = turn_repair.repair(letters)
        assert sum(c in "DKUA" for c in codes) == len(letters) and cost > 0


@pytest.mark.parametrize("small", [False, True])
def test_operator_on_made_conversations(spark, monkeypatch, small):
    rng, rows = random.Random(11), []
    if small:  # the hot conversation in many runs
        monkeypatch.setattr(turn_repair, "RUN_ROWS", 7)
        monkeypatch.setattr(turn_repair, "RUN_CHARS", 40)
    for conv in [None, *range(60)]:
        for k in range(1500 if conv == 3 else rng.randrange(1, 9)):
            turn = None if rng.random() < 0.03 else k if rng.random() > 0.05 else rng.randrange(9)
            role = rng.choice([("user", "assistant")[k % 2]] * 8 + ["system", None, "", "tool", "ürole"])
            text = rng.choice([f"Say {k}.", f"Wörd {k}?", f"{k}!\n", f"cut {k}", "same.", "", None, " \t\n", "two\nlines.", "end.  "])
            rows += [(conv, turn, role, text)] * (2 if rng.random() < 0.05 else 1)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("run", F.lit("x")).withColumn("name", F.lit(1)).repartition(5)
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert as_dict(turn_repair.repair_turns(frame)) == brute(clean)
    assert as_dict(turn_repair.repair_turns(turn_repair.damaged(frame))) == brute(brute_damage(rows))


def test_query_equals_brute_force_on_the_whole_table(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries()["op11_turn_repair"](spark, sf)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    assert as_dict(got) == brute(brute_damage(rows), {r[0] for r in rows})


def test_edge_cases(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair_turns(none).collect() == []
    far = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b." + "x" * 3_000_000 + ".")]
    out = as_dict(turn_repair.repair_turns(spark.createDataFrame(far, SCHEMA)))
    assert out[1][0] is None and out[1][1:7] == (0, 0, 0, 0, 0, "KK")
    alike = as_dict(turn_repair.repair_turns(spark.createDataFrame([(1, 1, "user", "a.")] * 40, SCHEMA).repartition(4)))
    assert alike[1][:7] == (0, 0, 39, 0, 39, 80, "D" * 40)


def test_conversations_that_lose_all_rows_stay(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    out = as_dict(turn_repair.op11_turn_repair(spark, str(tmp_path)))
    assert out == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
