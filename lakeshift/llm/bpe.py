"""BPE encoding and decoding (operator 9).

Encoding finds, for each pre-token, the longest vocabulary entry at every
position with one Aho-Corasick pass, and then walks left to right: a token is
taken if merging would really leave it beside its predecessor (a table of
compatible pairs, filled on demand); otherwise the next shorter entry is tried,
and if none is left the walk takes back its last token and marks the place as a
dead end. Each place dies at most once, so the walk is linear in the text. The
result equals that of applying all merges by rank. Decoding gathers bytes from
one blob by an offset table.

Defined results: a null text counts as empty (no ids); the special token's own
string in a text becomes its id, as the tokenizers library does by default;
repeated rows are encoded each; a text of any length is processed in pieces
between white space, its ids being the only thing that grows with it; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from lakeshift.llm.common import slices, table

#: Fixed value: the pre-token pattern of byte-level BPE.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Entries of each of a worker's caches, which hold words and change no ids.
CACHE_ENTRIES = 400_000

#: Longer words are not cached.
CACHE_WORD = 48


class Recent:
    """A bounded map in two generations: when the young one is full, it becomes the old one."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.limit, self.young, self.old = entries // 2, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value


class TextEncoder:
    """Cuts texts into units that can be encoded on their own, and remembers the units' ids.

    A space after a visible character always begins a pre-token, so what lies
    between such spaces is independent of its surroundings. Subclasses give the
    ids of one unit as little-endian unsigned 32-bit integers.
    """

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.splitter = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.chunks = Recent()

    def unit_ids(self, unit: str) -> bytes:
        raise NotImplementedError

    def _spaced(self, chunks: list[str]) -> bytes | None:
        """Ids of chunks with a space before each; None if white space at a chunk's edge makes them depend on each other.

        Only chunks with visible characters at both ends are ever cached.
        """
        found = list(map(self.chunks.young.get, chunks))
        if None in found:
            for k, got in enumerate(found):
                if got is None:
                    chunk = chunks[k]
                    if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                        return None
                    if (got := self.chunks.get(chunk)) is None:
                        got = self.unit_ids(" " + chunk)
                        if len(chunk) <= CACHE_WORD:
                            self.chunks.put(chunk, got)
                    found[k] = got
        return b"".join(found)

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        head, *rest = text.split(" ")
        if head and not head[-1].isspace() and (tail := self._spaced(rest)) is not None:
            return self.unit_ids(head) + tail
        units, whole = [], head
        for chunk in rest:  # a run of white space stays in one unit
            if not whole or whole[-1].isspace() or not chunk or chunk[0].isspace():
                whole += " " + chunk
            else:
                units.append(whole)
                whole = " " + chunk
        return b"".join(map(self.unit_ids, [*units, whole]))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.splitter is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(self.special[p].to_bytes(4, "little") if p in self.special else self._plain(p) for p in self.splitter.split(text) if p)


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec(TextEncoder):
    """One vocabulary file, read once in each Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        vocab = spec["model"]["vocab"]
        super().__init__({t["content"]: t["id"] for t in spec["added_tokens"]})
        size = max([*vocab.values(), *self.special.values()]) + 1
        content: list[bytes] = [b""] * size
        for symbol, k in vocab.items():
            content[k] = bytes(symbols[c] for c in symbol)
        for text, k in self.special.items():
            content[k] = text.encode()
        self.lengths = np.array([len(c) for c in content], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.blob = np.frombuffer(b"".join(content), dtype=np.uint8)
        # rank -1: a single byte; made[(a, b)] = (rank of the merge, its result)
        self.rank = [-1] * size
        self.made: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, c = vocab[left], vocab[right], vocab[left + right]
            self.made.setdefault((a, b), (rank, c))
            if c not in self.parts:
                self.parts[c], self.rank[c] = (a, b), rank
        self.pairs, self.words = Recent(), Recent()
        ordinary = set(vocab.values())
        reachable: set[int] = set()
        for c in sorted(ordinary, key=lambda k: self.rank[k]):
            if c not in self.parts:
                if len(content[c]) == 1:
                    reachable.add(c)
            elif (p := self.parts[c])[0] in reachable and p[1] in reachable and self._apart(*p, self.rank[c]):
                reachable.add(c)
        self.trie = ahocorasick.Automaton()
        by_bytes = self.entry = {content[k]: k for k in reachable}
        for raw, k in by_bytes.items():
            self.trie.add_word(raw.decode("latin-1"), k)
        self.trie.make_automaton()
        self.size_of = [len(c) for c in content]
        self.shorter: list[int] = [-1] * size
        for raw, k in by_bytes.items():
            self.shorter[k] = next((by_bytes[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in by_bytes), -1)

    def _apart(self, left: int, right: int, until: float = float("inf")) -> bool:
        """Whether no merge of a rank under ``until`` joins anything across the border of the two tokens.

        Both tokens are undone merge by merge, latest first; what then touches
        the border existed up to the rank of the merge undone.
        """
        rank, parts, made = self.rank, self.parts, self.made
        while True:
            joined = made.get((left, right))
            if joined is not None and joined[0] < until:
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:  # the left one came later: before that, its right part touched the border
                until, left = min(until, a), parts[left][1]
            else:  # of equal ranks the leftmost merge comes first, and that is the one across the border
                until, right = min(until, b + 1), parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            known = self._apart(left, right)
            self.pairs.put((left, right), known)
        return known

    def encode_word(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        if (whole := self.entry.get(raw)) is not None:
            return [whole]
        n = len(raw)
        longest = [-1] * n
        size_of, shorter = self.size_of, self.shorter
        for end, k in self.trie.iter(raw.decode("latin-1")):
            longest[end + 1 - size_of[k]] = k  # ends come in order, so the longest stays
        open_at = bytearray(b"\1" * (n + 1))
        out: list[int] = []
        at, token = 0, longest[0] if n else -1
        while at < n:
            while token >= 0:
                end = at + size_of[token]
                if open_at[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                if not out:
                    raise ValueError("the vocabulary cannot spell this text")
                open_at[at] = 0
                last = out.pop()
                at -= size_of[last]
                token = shorter[last]
        return out

    def word_ids(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = np.array(self.encode_word(word.encode("utf-8", "surrogatepass")), dtype="<u4").tobytes()
            if len(word) <= CACHE_WORD:
                self.words.put(word, found)
        return found

    def unit_ids(self, unit: str) -> bytes:
        return b"".join(map(self.word_ids, PRETOKEN.findall(unit)))

    def decode_bytes(self, ids: bytes) -> Iterator[bytes]:
        """Bytes of ids, a bounded run of tokens at a time."""
        tokens = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        for k in range(0, len(tokens), 1 << 18):
            part = tokens[k : k + (1 << 18)]
            n = self.lengths[part]
            ends = np.cumsum(n)
            yield self.blob[np.arange(ends[-1]) + np.repeat(self.offsets[part] - (ends - n), n)].tobytes()

    def decode(self, ids: bytes) -> str:
        return b"".join(self.decode_bytes(ids)).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary): the ids of each text as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in slices(batches, text_col):
            ids = [bpe.encode(t) for t in batch.column(text_col).to_pylist()]
            yield pa.record_batch([batch.column(id_col), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(ids: DataFrame, vocabulary: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text): the inverse of ``encode``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in slices(batches, "ids"):
            texts = [bpe.decode(b or b"") for b in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column(id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = ids.schema[id_col].dataType.simpleString()
    return ids.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, text string")


def digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: (id, n_tokens, ids_sha256, decoded_sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(vocabulary)
        for batch in slices(batches, text_col):
            counts, of_ids, of_text = [], [], []
            for text in batch.column(text_col).to_pylist():
                ids = bpe.encode(text)
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.record_batch(
                [batch.column(id_col), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_vocabulary())
