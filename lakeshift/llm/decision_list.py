"""Learned quality rules (operator 4).

Statistics of each whole text feed an ordered list of threshold conjunctions.
The list is learned by sequential covering: on two thirds of the labelled rows
a rule grows, condition by condition, by information gain; on the other third
it is pruned from its end; if it is precise enough there it joins the list, the
rows it covers leave, and the next rule is grown. The result is one ordered
Spark conditional expression that anyone can read.

Bounded: the fit sees at most ``sample`` labelled texts, chosen by hashes of ids
and texts (default 20,000), however many labels or documents share an id;
statistics and verdicts cover all rows.

Defined results: a null or empty text has no words and fails the base check;
without labels the list is empty and only the base check counts; a label that
is null is no label; repeated rows are judged each, and learned from once; other
columns pass through, whatever their names; a text of any length is counted
whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import SMALL_BYTES, free_names, slices, table

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = bytes(range(65, 91))
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "bang_share", "bar_share", "mean_line", "stop_share", "top_word_share"]


def repeated(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    _, pair = np.unique(seq[:-1] * len(ids) + seq[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * len(ids) + seq[2:], return_inverse=True, return_counts=True)
    if len(times) == n - 2:
        return 0
    twice = times[window] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : k + n - 2] |= twice
    return int(covered.sum())


def measure(text: str | None) -> list[float]:
    """BASE counts, then SHARES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    dup = len(lines) - len(set(lines))
    again = repeated(words)
    some, letters = max(n, 1), max(chars, 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    return [
        *(n, chars, symbols, dup, again),
        chars / some,
        symbols / letters,
        dup / max(len(lines), 1),
        again / some,
        len(counts) / some,
        (len(raw) - len(raw.translate(None, UPPER))) / letters,
        text.count("!") / some,
        text.count("|") / some,
        n / max(len(lines), 1),
        text.count(".") / some,
        max(counts.values(), default=0) / some,
    ]


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with a column per statistic; also the columns' names, which are free in ``docs``."""
    names = dict(zip([*BASE, *SHARES], free_names([*BASE, *SHARES], docs.columns), strict=True))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(names[c], T.LongType()) for c in BASE), *(T.StructField(names[c], T.DoubleType()) for c in SHARES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SMALL_BYTES):
            rows = [measure(t) for t in batch.column(text_col).to_pylist()]
            columns = list(zip(*rows, strict=True))
            more = [pa.array(c, pa.int64() if k < len(BASE) else pa.float64()) for k, c in enumerate(columns)]
            yield pa.record_batch([*batch.columns, *more], names=schema.names)

    return docs.mapInArrow(run, schema), names


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self, names: dict[str, str]) -> Column:
        c = F.col(names[self.name])
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, LEARNED.index(self.name)]
        return v > self.threshold if self.above else v <= self.threshold


Rule = tuple[Condition, ...]
LEARNED = ["n_words", *SHARES]


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray], longest: int) -> Rule:
    """Add the condition that gains most information until only bad rows are covered."""
    rule: list[Condition] = []
    while len(rule) < longest and bad.any() and not bad.all():
        before = np.log2(bad.mean())
        best, found = 1e-9, None
        for f, name in enumerate(LEARNED):
            at = np.searchsorted(cuts[f], x[:, f], side="left")  # rows with value <= cuts[k] have at <= k
            p = np.bincount(at[bad], minlength=len(cuts[f]) + 1)
            t = np.bincount(at, minlength=len(cuts[f]) + 1)
            p_low, t_low = np.cumsum(p)[:-1], np.cumsum(t)[:-1]
            for above, ps, ts in ((False, p_low, t_low), (True, p.sum() - p_low, t.sum() - t_low)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(ps > 0, ps * (np.log2(ps / np.maximum(ts, 1)) - before), -1.0)
                if len(gain) and gain.max() > best:
                    k = int(gain.argmax())
                    best, found = float(gain[k]), Condition(name, above, float(cuts[f][k]))
        if found is None:
            break
        rule.append(found)
        keep = found.holds(x)
        x, bad = x[keep], bad[keep]
    return tuple(rule)


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The shortest start of the rule that is worth most on rows it was not grown on."""
    best, worth = rule, -2.0
    for k in range(1, len(rule) + 1):
        hit = holds(rule[:k], x)
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        value = (p - n) / (p + n) if p + n else -1.0
        if value > worth + 1e-9:
            best, worth = rule[:k], value
    return best


def learn(x: np.ndarray, bad: np.ndarray, third: np.ndarray, precision: float = 0.9, least: int = 5, most: int = 24, longest: int = 4, failures: int = 3) -> list[Rule]:
    """Sequential covering; ``third`` marks the rows that only prune and accept rules.

    A rule that fails there is left out, and what it covers grows no further
    rule; learning ends after ``failures`` of them.
    """
    rules: list[Rule] = []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 129)[1:-1])) if len(x) else np.array([]) for f in range(len(LEARNED))]
    cuts = [(c[:-1] + c[1:]) / 2 for c in cuts]  # between values, so that no threshold is a value itself
    left, usable = np.ones(len(x), dtype=bool), np.ones(len(x), dtype=bool)
    while failures and len(rules) < most and (left & usable & bad & ~third).sum() >= least:
        g, h = left & usable & ~third, left & third
        rule = prune(grow(x[g], bad[g], cuts, longest), x[h], bad[h])
        hit = holds(rule, x) & left
        p, q = int((hit & bad).sum()), int((hit & bad & third).sum())
        if not rule:
            break
        if p < least or p < precision * hit.sum() or q < precision * (hit & third).sum():
            usable &= ~hit
            failures -= 1
            continue
        rules.append(rule)
        left &= ~hit
    return rules


def labelled(docs: DataFrame, labels: DataFrame, sample: int, seed: int) -> DataFrame:
    """(doc_id, key, quality) of at most ``sample`` labelled texts; ``key`` is xxhash64 of the text.

    Labels are taken once each, and so are the texts of an id, before any are
    chosen: first the ``sample`` labels, then the ``sample`` texts, whose hashes are
    smallest. So neither an id with most labels nor one with most documents
    exceeds the bound, which holds for both broadcasts as well.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality").distinct()
    known = known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "quality").limit(sample)
    texts = docs.select("doc_id", F.xxhash64("text").alias("key")).join(F.broadcast(known), "doc_id").distinct()
    return texts.orderBy(F.xxhash64("doc_id", "key", F.lit(seed)), "doc_id", "key", "quality").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, seed: int = 7) -> list[Rule]:
    """Rules for bad documents from at most ``sample`` labelled texts."""
    chosen = labelled(docs, labels, sample, seed)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    own, names = statistics(keyed.join(F.broadcast(chosen), ["doc_id", "key"]).withColumn("third", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0))
    own = own.where(~base_failed(names))  # the list judges only what passes the base check
    learned = [names[c] for c in LEARNED]
    rows = own.groupBy("doc_id", "key", "quality").agg(*[F.first(c).alias(c) for c in ["third", *learned]]).toPandas()  # rows alike count once
    rows = rows.sort_values(["doc_id", "key", "quality"], kind="stable")
    x = rows[learned].to_numpy(dtype=np.float64)
    return learn(x, rows["quality"].to_numpy() == 0, rows["third"].to_numpy(dtype=bool))


def base_failed(names: dict[str, str]) -> Column:
    n, again = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (n < 50) | (100 * again > 50 * n)


def verdict(rules: list[Rule], names: dict[str, str]) -> Column:
    """The list as an ordered conditional: the number of the first rule that holds, null for none."""
    out = F.lit(None).cast("int")
    for k in range(len(rules) - 1, -1, -1):
        whole = rules[k][0].column(names)
        for c in rules[k][1:]:
            whole = whole & c.column(names)
        out = F.when(whole, F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with statistics, ``base_failed``, ``rule`` (the list's number or null) and ``kept``; and their names."""
    rules = fit(docs, labels, sample)
    out, names = statistics(docs)
    added = ["base_failed", "rule", "kept"]
    names |= dict(zip(added, free_names(added, out.columns), strict=True))
    out = out.withColumns({names["base_failed"]: base_failed(names), names["rule"]: verdict(rules, names)})
    return out.withColumn(names["kept"], ~F.col(names["base_failed"]) & F.col(names["rule"]).isNull()), names


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> DataFrame:
    """Only the documents that pass, with their columns as they are."""
    out, names = judge(docs, labels, sample)
    return out.where(F.col(names["kept"])).select(*docs.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *BASE, "base_failed", "kept", "rule")
