"""Repair of conversations' structure by iterative-deepening A* (operator 11).

A conversation's rows are read as one letter each, for its role and its fault.
Edits turn them into roles of the form (system? (user assistant)+)?: a row is
deleted, kept or given another role, and turns without text are inserted. The
cheapest edits are found depth-first, edits in ASCII order of their initials,
under a bound on the cost that grows until a path is accepted; the first one is
the answer, and of all cheapest ones the least in ASCII order. A table holds for
each state, (rows read, role expected), the least cost that may still end it:
what has failed is not searched again with as little left, under any bound.

Long runs of faultless rows in which user and assistant take turns are kept by
every cheapest repair, but for five rows at either end: an edit in the run
would shift all rows up to its end, and two insertions shift them back for less. (Were all
12 rows or more edited, that would cost 12 or more; keeping them costs 10 at
most for shifting to them and back.) So the search starts anew in the midst of
each such run, in a known state, and its memory is that of the longest stretch
between two.

Spark sorts the rows by conversation and turn into a table of bounded runs,
finds repeated rows by an aggregate, and gives the search one letter a row. The
edits go back to the runs, whose repaired texts are made in parallel; one
conversation's digest alone is computed in order, over runs of text. A
conversation of any size thus costs a task no more than a byte a row, as much as
its own audit in the result.

Defined results: a null role or text counts as one space (so its row is blank,
or of no known role); rows without a turn come first, rows of one turn in the
order of the MD5 of role and text, so that equal rows are neighbours; a null
conv_id is a conversation of its own; a role's initial is its first character;
``gaps`` beyond 64 bits is null; texts of any length are whole; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.bpe import Recent
from lakeshift.llm.common import Stage, table

#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
WHITE = " \t\n\x0b\x0c\r"

#: A row's letter is "A" + 4 * fault + role.
ROLES = {"s": 0, "u": 1, "a": 2}
OTHER_ROLE = 3
NONE, BLANK, DUPLICATE, CUT = range(4)

#: States: nothing yet, after the system's turn, after the user's, after the assistant's (where a repair may also end).
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)

#: Shortest run of alternating faultless rows that parts the search, and rows at its ends that may be edited.
RUN, SHIFT = 12, 6
#: Rows of a block whose least cost, from whichever state, bounds the search from below.
BLOCK = 64
#: Rows and characters of a run of the sorted table.
RUN_ROWS, RUN_CHARS = 4096, 1 << 20
#: Stretches whose repair each worker remembers.
REMEMBERED = 100_000


def moves(letter: str | None, state: int) -> list[tuple[int, int, int, str]]:
    """(cost, rows read, state after, code) of the edits in a state, in ASCII order of their initials; no letter after the last row.

    Codes: D delete, u and a insert a user's or assistant's turn, K keep, U and A give that role.
    """
    wanted, after = (ROLES["a"], ASSISTANT) if state == USER else (ROLES["u"], USER)
    insert = (INSERT, 0, after, "a" if state == USER else "u")
    if letter is None:
        return [insert]
    fault, role = divmod(ord(letter) - ord("A"), 4)
    out = [(DELETE, 1, state, "D"), insert]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = TRUNCATED if fault == CUT else 0
    if role == wanted:
        out.append((extra, 1, after, "K"))
    else:
        if state == START and role == ROLES["s"]:
            out.append((extra, 1, SYSTEM, "K"))
        out.append((REROLE + extra, 1, after, "A" if state == USER else "U"))
    return out


MOVES = {(x, s): moves(x, s) for x in [None, *map(chr, range(ord("A"), ord("A") + 16))] for s in range(4)}
#: The least that a row of each letter costs in any state.
ROW = {x: min(cost for s in range(4) for cost, read, _, _ in MOVES[x, s] if read) for x in map(chr, range(ord("A"), ord("A") + 16))}


def block_cost(rows: str) -> int:
    """The least cost of some rows between any two states."""
    cost = [0] * 4
    for x in rows:
        for s in (USER, START, SYSTEM, ASSISTANT, USER):  # insertions before the row
            after = MOVES[None, s][0][2]
            cost[after] = min(cost[after], cost[s] + INSERT)
        new = [1 << 60] * 4
        for s in range(4):
            for c, read, after, _ in MOVES[x, s]:
                if read and cost[s] + c < new[after]:
                    new[after] = cost[s] + c
        cost = new
    return min(cost)


def lower_bounds(rows: str) -> list[int]:
    """For each number of rows read, a bound on what the others cost."""
    out = [0] * (len(rows) + 1)
    for start in range((len(rows) - 1) // BLOCK * BLOCK, -1, -BLOCK):
        stop = min(start + BLOCK, len(rows))
        own = 0
        for k in range(stop - 1, start - 1, -1):
            own += ROW[rows[k]]
            out[k] = own + out[stop]
        if len(rows) > BLOCK:
            out[start] = max(out[start], block_cost(rows[start:stop]) + out[stop])
    return out


def search(rows: str, state: int, ends: tuple[int, ...]) -> tuple[int, str]:
    """(cost, codes) of the cheapest edits from a state to one of ``ends``, the least in ASCII order among equals."""
    n = len(rows)
    table_of = [b for b in lower_bounds(rows) for _ in range(4)]  # of each state, the least cost that may end it
    bound = table_of[state]
    while True:
        spent, path = [0], []
        stack = [(0, state, iter(MOVES[rows[0] if n else None, state]), [1 << 60])]
        while stack:
            at, now, edits, least = stack[-1]
            if at == n and now in ends:
                return spent[-1], "".join(path)
            for cost, read, after, code in edits:
                left = table_of[4 * (at + read) + after]
                if spent[-1] + cost + left <= bound:
                    to = at + read
                    stack.append((to, after, iter(MOVES[rows[to] if to < n else None, after]), [1 << 60]))
                    spent.append(spent[-1] + cost)
                    path.append(code)
                    break
                least[0] = min(least[0], cost + left)
            else:  # failed with what was left: it costs at least what its edits would
                stack.pop()
                key = 4 * at + now
                table_of[key] = max(table_of[key], least[0])
                if stack:
                    above = stack[-1][3]
                    paid = spent.pop() - spent[-1]
                    above[0] = min(above[0], paid + table_of[key])
                    path.pop()
        bound = table_of[state]


_KNOWN = Recent(REMEMBERED)


def stretches(letters: bytes) -> Iterator[tuple[int, int, int]]:
    """(first, last, kept up to) of stretches to be searched, each followed by rows that all cheapest repairs keep."""
    x = np.frombuffer(letters, dtype=np.uint8)
    clean = (x == ord("A") + ROLES["u"]) | (x == ord("A") + ROLES["a"])
    linked = clean[1:] & clean[:-1] & (x[1:] != x[:-1])
    edges = np.flatnonzero(np.concatenate([[True], ~linked, [True]]))
    long = np.flatnonzero(np.diff(edges) >= RUN)
    at = 0
    for first, end in zip(edges[long].tolist(), edges[long + 1].tolist(), strict=True):
        yield at, first + SHIFT, end - SHIFT
        at = end - SHIFT
    yield at, len(letters), len(letters)


def repair(letters: bytes) -> tuple[int, str]:
    """(cost, codes) of the cheapest edits of a conversation's rows."""
    text, state, total, codes = letters.decode("ascii"), START, 0, []

    def after(row: int) -> int:
        return USER if text[row] == chr(ord("A") + ROLES["u"]) else ASSISTANT

    for first, last, kept in stretches(letters):
        ends = ENDS if last == len(text) else (after(last - 1),)
        key = (text[first:last], state, ends)
        found = _KNOWN.get(key) if last - first <= BLOCK else None
        if found is None:
            found = search(*key)
            if last - first <= BLOCK:
                _KNOWN.put(key, found)
        total += found[0]
        codes += [found[1], "K" * (kept - last)]
        if kept:
            state = after(kept - 1)
    return total, "".join(codes)


def by_row(codes: str) -> Iterator[str]:
    """The codes of each row: its own edit after the turns inserted before it; the last row also has those after it."""
    start, last = 0, None
    for k, code in enumerate(codes):
        if code in "DKUA":
            if last is not None:
                yield last
            last, start = codes[start : k + 1], k + 1
    if last is not None:
        yield last + codes[start:]


AUDIT = str.maketrans("uaUA", "IIRR")


def in_runs(rows: DataFrame) -> DataFrame:
    """Sorted rows (conv, ...) with ``run`` and ``nth``: runs of one conversation, of bounded size, in the rows' order."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, nth, chars, now = (TaskContext.get().partitionId() << 40) - 1, 0, 0, object()
        for batch in batches:
            runs, places = [], []
            for conv, size in zip(batch.column("conv").to_pylist(), batch.column("chars").to_pylist(), strict=True):
                if conv != now or nth + 1 >= RUN_ROWS or chars >= RUN_CHARS:
                    run, nth, chars, now = run + 1, -1, 0, conv
                nth += 1
                chars += size
                runs.append(run)
                places.append(nth)
            yield pa.record_batch([*batch.columns, pa.array(runs, pa.int64()), pa.array(places, pa.int32())], names=[*batch.schema.names, "run", "nth"])

    return rows.mapInArrow(number, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", run long, nth int")


def repaired(runs: DataFrame) -> DataFrame:
    """A row for each run (conv, run, letters) with its rows' ``codes``, and one for each conversation (no run) with its figures.

    Rows come sorted by conversation and run.
    """
    kind = runs.schema["conv"].dataType
    names = ["conv", "run", "codes", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def rows(conv: object, held: list[tuple[int, bytes]]) -> Iterator[tuple]:
        letters = b"".join(x for _, x in held)
        cost, codes = repair(letters)
        each = by_row(codes)
        for run, own in held:
            yield conv, run, [next(each) for _ in own], None, None, None, None, None, None
        x = np.frombuffer(letters, dtype=np.uint8) - ord("A")
        faults = np.bincount(x >> 2, minlength=4).tolist()
        pair = (x[:-1] & 3) * 4 + (x[1:] & 3)
        legal = np.isin(pair, [ROLES[a] * 4 + ROLES[b] for a, b in ("su", "ua", "au")]).sum()
        yield conv, None, None, faults[BLANK], faults[DUPLICATE], faults[CUT], len(pair) - int(legal), cost, codes.translate(AUDIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        fields = [("conv", None), ("run", pa.int64()), ("codes", pa.list_(pa.string())), *((c, pa.int64()) for c in names[3:8]), ("audit", pa.string())]

        def packed(found: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [[] for _ in names]
            return pa.record_batch([pa.array(x, t or conv_type) for x, (_, t) in zip(columns, fields, strict=True)], names=names)

        out, size = [], 0
        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for conv, number, letters in zip(*(batch.column(c).to_pylist() for c in ("conv", "run", "letters")), strict=True):
                if held and conv != now:
                    out += rows(now, held)
                    size += sum(len(x) for _, x in held)
                    held = []
                    if size >= 1 << 16:
                        yield packed(out, conv_type)
                        out, size = [], 0
                now = conv
                held.append((number, letters.encode("ascii")))
        if held:
            out += rows(now, held)
            yield packed(out, conv_type)

    schema = f"conv {kind.simpleString()}, run long, codes array<string>, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return runs.mapInArrow(run, schema)


def digests(texts: DataFrame) -> DataFrame:
    """(conv, digest): SHA-256 of the texts (conv, run, text) of each conversation, joined by newlines; rows sorted by both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            convs, found, conv_type = [], [], batch.schema.field("conv").type
            for conv, text in zip(batch.column("conv").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if sha is not None and conv == now:
                    sha.update(b"\n")
                else:
                    if sha is not None:
                        convs.append(now)
                        found.append(sha.hexdigest())
                    now, sha = conv, hashlib.sha256()
                sha.update(text.encode("utf-8", "surrogatepass"))
            yield pa.record_batch([pa.array(convs, conv_type), pa.array(found, pa.string())], names=["conv", "digest"])
        if sha is not None:
            yield pa.record_batch([pa.array([now], conv_type), pa.array([sha.hexdigest()], pa.string())], names=["conv", "digest"])

    return texts.mapInArrow(run, f"conv {texts.schema['conv'].dataType.simpleString()}, digest string")


def lines(codes: Column, role: Column, text: Column) -> Column:
    """What a row with its codes leaves of the repaired conversation: none, one or several lines, as an array."""

    def inserted(letters: Column) -> Column:
        each = F.filter(F.split(letters, ""), lambda c: c != "")
        return F.transform(each, lambda c: F.when(c == "u", F.lit("user:")).otherwise(F.lit("assistant:")))

    edit = F.regexp_extract(codes, "[DKUA]", 0)
    own = F.when(edit == "K", F.concat(role, F.lit(":"), text)).when(edit == "U", F.concat(F.lit("user:"), text)).when(edit == "A", F.concat(F.lit("assistant:"), text))
    own = F.filter(F.array(own), lambda x: x.isNotNull())
    return F.concat(inserted(F.regexp_extract(codes, "^[ua]*", 0)), own, inserted(F.regexp_extract(codes, "[ua]*$", 0)))


def repair_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation of rows (conv_id, turn, role, text)."""
    stage = Stage(rows.sparkSession, "turn_repair")
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    name = F.concat(F.coalesce(F.col("conv").cast("string"), F.lit(" ")), F.lit(":"), F.col("conv").isNull().cast("string"), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "role", "text")
    visible = F.rtrim("text", F.lit(WHITE))
    fault = F.when(visible == "", BLANK).when(~F.right(visible, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(NONE)
    initial = F.substring("role", 1, 1)
    role_of = F.when(initial == "s", ROLES["s"]).when(initial == "u", ROLES["u"]).when(initial == "a", ROLES["a"]).otherwise(OTHER_ROLE)
    rows = rows.select("*", F.md5(name.cast("binary")).alias("name"), fault.alias("fault"), role_of.alias("role_of"), F.length("text").alias("chars"))
    # The last key parts rows that are alike in all else.
    order = ["conv", "turn", "name", "tie"]
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = stage.write(in_runs(rows), "rows")

    seen = rows.where(F.col("fault") != BLANK).groupBy("name").agg(F.min(F.struct("run", "nth")).alias("first"), F.count("*").alias("n")).where("n > 1")
    seen = stage.write(seen.select("name", "first"), "seen")
    again = F.coalesce(F.struct("run", "nth") != F.col("first"), F.lit(False)) & (F.col("fault") != BLANK)
    letter = F.char(F.lit(ord("A")) + 4 * F.when(again, DUPLICATE).otherwise(F.col("fault")) + F.col("role_of"))
    marked = rows.select("conv", "run", "nth", "name", "fault", "role_of").join(seen, "name", "left").select("conv", "run", "nth", letter.alias("letter"))
    runs = marked.groupBy("conv", "run").agg(F.array_sort(F.collect_list(F.struct("nth", "letter"))).alias("list"))  # RUN_ROWS at most
    runs = stage.write(runs.select("conv", "run", F.array_join("list.letter", "").alias("letters")), "runs")
    found = stage.write(repaired(runs.repartition("conv").sortWithinPartitions("conv", "run")), "found")

    edits = found.where("run is not null").select("run", "codes")
    left = rows.select("conv", "run", "nth", "role", "text").join(edits, "run")
    left = left.select("conv", "run", "nth", F.array_join(lines(F.get("codes", F.col("nth")), F.col("role"), F.col("text")), "\n").alias("text"), F.get("codes", F.col("nth")).alias("code"))
    left = left.where("code <> 'D'").groupBy("run").agg(F.first("conv").alias("conv"), F.array_sort(F.collect_list(F.struct("nth", "text"))).alias("list"))  # RUN_CHARS, or one row
    texts = left.select("conv", "run", F.array_join("list.text", "\n").alias("text"))
    hashes = digests(texts.repartition("conv").sortWithinPartitions("conv", "run"))

    turns = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("distinct"))
    turns = turns.withColumnRenamed("conv", "turns_of")
    hashes = hashes.withColumnRenamed("conv", "digest_of")
    out = found.where("run is null").join(turns, F.col("conv").eqNullSafe(F.col("turns_of"))).join(hashes, F.col("conv").eqNullSafe(F.col("digest_of")), "left")
    wide = [F.col(c).cast("decimal(20,0)") for c in ("high", "low", "distinct")]
    gaps = F.coalesce(wide[0] - wide[1] + F.lit(1).cast("decimal(20,0)") - wide[2], F.lit(0).cast("decimal(20,0)")).try_cast("long")
    digest = F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest()))
    return out.select(F.col("conv").alias("conv_id"), gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", digest.alias("repaired_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with a quarter of them damaged, by a checksum of conversation and turn."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    how = F.crc32(F.concat(said[0], F.lit(":"), said[1]).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), how.alias("how")).where("how <> 0")
    role = F.when(F.col("how") == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(F.col("how") == 1, F.lit("")).when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair_turns(damaged(rows)).withColumnRenamed("conv_id", "its_id")
    every = rows.select("conv_id").distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("its_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.when(F.col("cost").isNull(), F.lit(0).cast("long")).otherwise(F.col("gaps"))
    digest = F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return out.select("conv_id", gaps.alias("gaps"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), digest.alias("repaired_sha256"))
