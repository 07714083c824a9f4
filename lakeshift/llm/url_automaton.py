"""URL rules as one bit-parallel wildcard automaton (operator 8).

All glob rules are packed into one row of 64-bit words, a bit per state. For
each byte there is a mask of the states it may lead into and one of the states
that may wait on it (behind a wildcard). A batch of URLs is simulated
together: per byte position one shift with carry over the words, two masks and
an OR move every rule on every URL. Rules only cost words, so thousands can be
tried at once; the tables are constant and small.

Globs: ``?`` is one byte other than ``/``, ``*`` a run of such bytes, ``**``
any run, ``\\`` quotes the next character. They are matched against all of the
canonical URL, which is ``.host/path``: a rule for a host and its subdomains is
``*.host`` with the path and ``**`` behind it.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no host rule and gets the default verdict; of rules that fit, the longest
host and path wins, then the one listed first; repeated rows are judged each;
a URL of any length is matched whole; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import slices, table


@dataclass(frozen=True)
class Rule:
    """A glob over canonical URLs; ``name`` is what is reported, ``weight`` decides between rules that fit."""

    glob: str
    verdict: str
    name: str | None = None
    weight: int = 0


def quoted(text: str) -> str:
    return re.sub(r"([\\*?])", r"\\\1", text)


def site(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with all its subdomains and the paths that start with ``path``."""
    return Rule(f"*.{quoted(host)}{quoted(path)}**", verdict, host + path, len(host + path))


class Automaton:
    """Masks of all globs, and their simulation."""

    def __init__(self, globs: list[str]):
        into: list[list[int]] = [[] for _ in range(256)]  # states that a byte leads into
        wait: list[list[int]] = [[] for _ in range(256)]
        starts, ends = [], []
        size = 0
        free = [b for b in range(256) if b != ord("/")]
        for glob in globs:
            starts.append(size)
            raw, k = glob.encode(), 0
            while k < len(raw):
                if raw[k : k + 1] == b"*":
                    wide = raw[k : k + 2] == b"**"
                    for b in range(256) if wide else free:
                        wait[b].append(size)
                    k += 1 + wide
                    continue
                if raw[k : k + 1] == b"\\" and k + 1 < len(raw):
                    k += 1
                    accepted = [raw[k]]
                else:
                    accepted = free if raw[k : k + 1] == b"?" else [raw[k]]
                size += 1
                for b in accepted:
                    into[b].append(size)
                k += 1
            ends.append(size)
            size += 1
        self.words = (size + 63) // 64
        self.into, self.wait = (np.stack([self._mask(states) for states in masks]) for masks in (into, wait))
        self.begin, self.final = self._mask(starts), self._mask(ends)
        self.glob_of = np.full(64 * self.words, -1, dtype=np.int64)
        self.glob_of[ends] = np.arange(len(globs))

    def _mask(self, states: list[int]) -> np.ndarray:
        bits = np.zeros(64 * max(1, self.words), dtype=np.uint8)
        bits[states] = 1
        return np.packbits(bits, bitorder="little").view("<u8")

    def _one(self, raw: bytes, state: np.ndarray) -> np.ndarray:
        """The same steps on one long integer: for the few that are much longer than the others."""
        whole = lambda words: int.from_bytes(words.astype("<u8").tobytes(), "little")
        into, wait = [whole(m) for m in self.into], [whole(m) for m in self.wait]
        d = whole(state)
        for b in raw:
            d = (d << 1) & into[b] | d & wait[b]
        return np.frombuffer(d.to_bytes(8 * self.words, "little"), dtype="<u8")

    def matches(self, urls: list[bytes]) -> Iterator[tuple[int, int]]:
        """(url, glob) of every fit."""
        order = sorted(range(len(urls)), key=lambda k: -len(urls[k]))
        sizes = np.array([len(urls[k]) for k in order], dtype=np.int64)
        text = np.frombuffer(b"".join(urls[k] for k in order), dtype=np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(urls) else sizes
        state = np.tile(self.begin, (len(urls), 1))
        one = np.uint64(1)
        at, live = 0, len(urls)
        while live:
            live = int(np.searchsorted(-sizes, -at, side="left"))  # the first ones are longer than `at`
            if live <= 4:
                for k in range(live):
                    state[k] = self._one(urls[order[k]][at:], state[k])
                break
            byte = text[begins[:live] + at]
            now = state[:live]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = moved & self.into[byte] | now & self.wait[byte]
            at += 1
        row, word = np.nonzero(state & self.final)
        for r, w in zip(row.tolist(), word.tolist(), strict=True):
            hit = int(state[r, w] & self.final[w])
            while hit:
                low = hit & -hit
                yield order[r], int(self.glob_of[64 * w + low.bit_length() - 1])
                hit ^= low


def canonical(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` with columns host and path added."""
    rest = F.when(F.col(url_col).contains("://"), F.substring(F.col(url_col), F.instr(F.col(url_col), "://") + 3, F.length(url_col))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(host, upper, upper.lower()), "path": path})


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict): the name and verdict of the winning rule of each URL; named rules go first."""
    rules = sorted(rules, key=lambda r: (r.name is None, -r.weight))
    names, verdicts = [r.name for r in rules], [r.verdict for r in rules]
    globs = [r.glob for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs) if globs else None
        for batch in slices(batches, "path"):
            urls = [f".{h}{p}".encode("utf-8", "surrogatepass") for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            best = [len(globs)] * len(urls)
            for url, k in automaton.matches(urls) if automaton else ():
                best[url] = min(best[url], k)  # rules stand in the order in which they win
            found = [pa.array([(c + [last])[k] for k in best], pa.string()) for c, last in ((names, None), (verdicts, default))]
            yield pa.record_batch([*batch.columns, *found], names=[id_col, "host", "path", "rule", "verdict"])

    parts = canonical(pages.select(id_col, url_col), url_col).select(id_col, "host", "path")
    kind = pages.schema[id_col].dataType.simpleString()
    return parts.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


#: Rules of the registered query: sites with their languages, then what to leave out on any other site.
SITES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
UNWANTED = ["**.exe", "**.zip", "*/login**", "*/cart**", "*.ads.**", "*/de/**.html"]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [site(*s) for s in SITES] + [Rule(g, "block") for g in UNWANTED]
    return judge(table(spark, sf_dir, "pages"), rules)


ORACLE = """
WITH rests AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rests
), judged AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_full_match('.' || host || path, '(?s).*\\.(exe|zip)|[^/]*/(login|cart).*|[^/]*\\.ads\\..*|[^/]*/de/.*\\.html') THEN 'block'
  ELSE 'allow' END AS verdict
FROM judged
"""
