"""SentencePiece encoding and decoding, models of the merge type (operator 13).

A space becomes ``▁`` and the text gets one more in front. Encoding finds the
longest piece at every character with one Aho-Corasick pass and walks left to
right: a piece is taken if merging would really leave it beside its predecessor;
otherwise the next shorter one is tried, and if none is left the walk takes back
its last piece and sets the place's bit in a field of failed positions. Each
place fails at most once, so the walk is linear in the text.

Two pieces may stand side by side if merging their characters again, best score
first and leftmost among equals, gives the same two. Most pairs need no merging:
what touches the border is always a suffix of the left piece's own merge tree
and a prefix of the right one's, and if no such two join into a piece, nothing
ever crosses. A merge depends on nothing outside the two pieces beside a border,
so a run of pieces whose neighbours all agree is what all merges give.

Decoding gathers bytes from one blob by an offset table.

Defined results: a null text counts as empty (no ids, empty text); characters
that no piece has become byte pieces, or one unknown id a run where the model
has none; marks of control ids in a text are ordinary text; repeated rows are
encoded each, nothing depends on ids, so null ids, ties and extra or clashing
columns change nothing; an empty table gives no rows; a text of any length is
encoded line by line and a bounded number of words at once, its ids being the
only thing that grows with it. Models of another type, with pieces of the user's
own or with a normalisation of characters are refused with an error.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from struct import pack, unpack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeshift.llm.bpe import Recent
from lakeshift.llm.common import slices, table

SPACE = "▁"

#: Fixed values of the model file: kinds of pieces, kind of model, mark of an unknown piece in decoded text.
NORMAL, UNKNOWN, CONTROL, OWN, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2
UNKNOWN_TEXT = " ⁇ "

#: The rank of what is no piece.
NEVER = 1 << 60

#: Words of a line that are encoded at once, and longest word that is cached.
WORDS_AT_ONCE, CACHE_WORD = 65_536, 48

#: Entries of a worker's caches of words and of pairs of pieces, which change no ids.
WORDS, PAIRS = 600_000, 1_000_000

#: A byte that begins no valid character gives one mark; the next byte is tried anew.
codecs.register_error("lakeshift-each-byte", lambda e: ("�", e.start + 1))


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            shift += 7
            at += 1
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class Model:
    """What a model file says of its pieces and options."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(fields(f.read()))
        self.pieces: list[tuple[str, float, int]] = []
        for number, raw in parts:
            if number == 1:
                piece = dict(fields(raw))
                score = unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        trainer = dict(fields(next((raw for number, raw in parts if number == 2), b"")))
        normalizer = dict(fields(next((raw for number, raw in parts if number == 3), b"")))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.prefix, squeeze, escape = (bool(normalizer.get(k, 1)) for k in (3, 4, 5))
        if trainer.get(3, 1) != MERGES or normalizer.get(2) or squeeze or not escape or trainer.get(24, 0) or any(kind == OWN for _, _, kind in self.pieces):
            raise ValueError("only merge-type models without normalisation or pieces of the user's own can be read")


class Offsets:
    """Strings by number: one blob, and where each begins."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def of(self, numbers: np.ndarray) -> bytes:
        """Their strings joined, a bounded run of numbers at a time."""
        out = []
        for k in range(0, len(numbers), 1 << 18):
            part = numbers[k : k + (1 << 18)]
            n = self.lengths[part]
            ends = np.cumsum(n)
            out.append(self.blob[np.arange(ends[-1]) + np.repeat(self.starts[part] - (ends - n), n)].tobytes())
        return b"".join(out)


class PieceCodec:
    """One model, read once in each Python worker."""

    def __init__(self, path: str):
        model = Model(path)
        self.prefix, self.byte_fallback = model.prefix, model.byte_fallback
        kinds = np.array([kind for _, _, kind in model.pieces])
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        self.byte_ids = {int(p[3:5], 16): k for k, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        merging = {p: k for k, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, UNUSED)}
        order = {s: r for r, s in enumerate(sorted({model.pieces[k][1] for k in merging.values()}, reverse=True))}
        self.rank = {p: order[model.pieces[k][1]] for p, k in merging.items()}
        self.known = {c for p in merging for c in p}
        # Tokens are pieces, and characters that occur in pieces only; those come after the model's ids.
        self.token = dict(merging)
        for c in sorted(self.known - merging.keys()):
            self.token[c] = len(model.pieces) + len(self.token)
        self.text_of = {k: p for p, k in self.token.items()}
        self.parts: dict[str, tuple[str, str]] = {}
        for p in sorted(merging, key=len):
            if len(p) > 1 and (split := self._last_merge(p)) is not None:
                self.parts[p] = split
        entries = sorted((p for p in self.token if len(p) == 1 or p in self.parts), key=len)
        self.trie = ahocorasick.Automaton()
        size = max(self.token.values(), default=0) + 1
        self.size_of, self.shorter = [0] * size, [-1] * size
        for p in entries:
            k = self.token[p]
            self.trie.add_word(p, k)
            self.size_of[k] = len(p)
            self.shorter[k] = next((self.token[p[:n]] for n in range(len(p) - 1, 0, -1) if self.size_of[self.token.get(p[:n], k)] == n), -1)
        self.trie.make_automaton()
        self.out = {k: self._ids(p, kinds) for k, p in self.text_of.items()}
        self.direct = all(ids == [k] for k, ids in self.out.items())
        self.crosses = any(a != SPACE and b == SPACE for p in merging for a, b in zip(p, p[1:], strict=False))  # then a space doesn't begin a new unit
        self.odd = re.compile("([^" + re.escape("".join(sorted(self.known))) + "])") if self.known else re.compile("(.)", re.S)
        self.breaks = "\n" not in self.known
        self.newline = self._unknown_ids("\n")
        self.pairs, self.words = Recent(PAIRS), Recent(WORDS)
        content = [self._surface(p, kind) for p, _, kind in model.pieces]
        self.surface, self.numbers = Offsets(content), Offsets([b"%d," % k for k in range(len(content))])
        self.silent = kinds == CONTROL
        self.spaced = np.array([kind in (NORMAL, UNUSED) and p.startswith(SPACE) for p, _, kind in model.pieces])

    # -- merging

    def _merged(self, symbols: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """All merges of a short run of characters, and the last of them."""
        rank, last = self.rank, None
        ranks = [rank.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while ranks and (best := min(ranks)) < NEVER:
            k = ranks.index(best)  # the leftmost of equals
            last = symbols[k], symbols[k + 1]
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get(symbols[k - 1] + symbols[k], NEVER)
            if k < len(ranks):
                ranks[k] = rank.get(symbols[k] + symbols[k + 1], NEVER)
        return symbols, last

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        symbols, last = self._merged(list(piece))
        return last if len(symbols) == 1 else None

    def _edge(self, token: int, side: int) -> list[str]:
        """What may stand at the left (0) or right (1) end of a piece while its characters merge."""
        out = [self.text_of[token]]
        while (split := self.parts.get(out[-1])) is not None:
            out.append(split[side])
        return out

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get(left << 24 | right)
        if known is None:
            ends, starts, rank = self._edge(left, 1), self._edge(right, 0), self.rank
            known = True
            if any([x + y in rank for x in ends for y in starts]):
                known = self._merged(list(ends[0] + starts[0]))[0] == [ends[0], starts[0]]
            self.pairs.put(left << 24 | right, known)
        return known

    def _ids(self, text: str, kinds: np.ndarray) -> list[int]:
        """Ids of one token: its own, its halves' where the model doesn't use it, or its bytes'."""
        k = self.token[text]
        if k < len(kinds) and kinds[k] == NORMAL:
            return [k]
        if k < len(kinds) and text in self.parts:
            return [x for half in self.parts[text] for x in self._ids(half, kinds)]
        return [k] if k < len(kinds) else self._unknown_ids(text)

    def _unknown_ids(self, c: str) -> list[int]:
        return [self.byte_ids[b] for b in c.encode("utf-8", "replace")] if self.byte_fallback else [self.unknown]

    def _walks(self, units: list[str]) -> list[list[int]]:
        """Ids of units of known characters, over one pass of the automaton."""
        joined = "\n".join(units) if self.breaks else None
        if joined is None:  # no character is left to part units
            return [self._walk(u, self._longest(u), 0, len(u), bytearray((len(u) >> 3) + 1)) for u in units]
        longest, failed, at, out = self._longest(joined), bytearray((len(joined) >> 3) + 1), 0, []
        for u in units:
            out.append(self._walk(joined, longest, at, at + len(u), failed))
            at += len(u) + 1
        return out

    def _longest(self, text: str) -> list[int]:
        longest, size_of = [-1] * len(text), self.size_of
        for end, k in self.trie.iter(text):
            longest[end + 1 - size_of[k]] = k  # ends come in order, so the longest stays
        return longest

    def _walk(self, text: str, longest: list[int], at: int, stop: int, failed: bytearray) -> list[int]:
        size_of, shorter, young = self.size_of, self.shorter, self.pairs.young
        taken: list[int] = []
        token = longest[at] if at < stop else -1
        while at < stop:
            while token >= 0:
                end = at + size_of[token]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not taken:
                        break
                    fits = young.get(taken[-1] << 24 | token)
                    if fits is None:
                        fits, young = self.compatible(taken[-1], token), self.pairs.young
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                at = end
                token = longest[at] if at < stop else -1
            else:
                if not taken:
                    raise ValueError(f"no pieces spell {text[at : at + 40]!r}")
                failed[at >> 3] |= 1 << (at & 7)
                last = taken.pop()
                at -= size_of[last]
                token = shorter[last]
        return taken if self.direct else [x for k in taken for x in self.out[k]]

    # -- encoding

    def _packed(self, units: list[str]) -> list[bytes]:
        """Ids of units."""
        plain = [u for u in units if self.odd.search(u) is None]
        of_plain = dict(zip(plain, self._walks(plain), strict=True))
        out = []
        for u in units:
            ids = of_plain.get(u)
            if ids is None:
                runs = self.odd.split(u)  # known characters, one odd character, and so on
                of_run = iter(self._walks(runs[::2]))
                ids = list(next(of_run))
                for c in runs[1::2]:
                    ids += self._unknown_ids(c)
                    ids += next(of_run)
            out.append(pack(f"<{len(ids)}I", *ids))
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words, each with one space before it."""
        found = list(map(self.words.young.get, words))
        if None in found:
            missing: dict[str, bytes] = {}
            for k, got in enumerate(found):
                if got is None:
                    found[k] = got = self.words.get(words[k])
                    if got is None:
                        missing[words[k]] = b""
            if missing:
                missing = dict(zip(missing, self._packed([SPACE + w for w in missing]), strict=True))
                for word, got in missing.items():
                    if len(word) <= CACHE_WORD:
                        self.words.put(word, got)
                found = [missing[w] if got is None else got for w, got in zip(words, found, strict=True)]
        return found

    def _line(self, line: str) -> Iterator[bytes]:
        """Ids of a line: no merge crosses from a visible character to a space."""
        if self.crosses:
            yield from self._packed([line.replace(" ", SPACE)])
            return
        head, *rest = line.replace(SPACE, " ").split(" ")
        if head:
            yield from self._packed([head])
        if "" in rest:  # spaces in a row belong to the word after them
            units, spaces = [], 0
            for word in rest:
                spaces += 1
                if word:
                    units.append(SPACE * spaces + word)
                    spaces = 0
            units += [SPACE * spaces] if spaces else []
            for k in range(0, len(units), WORDS_AT_ONCE):
                yield from self._packed(units[k : k + WORDS_AT_ONCE])
            return
        for k in range(0, len(rest), WORDS_AT_ONCE):
            yield from self._words(rest[k : k + WORDS_AT_ONCE])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.prefix:
            text = " " + text
        if not self.breaks:
            ids = b"".join(self._line(text))
        else:
            newline = pack(f"<{len(self.newline)}I", *self.newline)
            ids = newline.join([b"".join(self._line(line)) for line in text.split("\n")])
        if self.byte_fallback:
            return ids
        whole = np.frombuffer(ids, dtype="<u4")  # a run of unknown characters is one id
        keep = np.ones(len(whole), dtype=bool)
        keep[1:] = (whole[1:] != self.unknown) | (whole[:-1] != self.unknown)
        return whole[keep].tobytes()

    # -- decoding

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == CONTROL else UNKNOWN_TEXT.encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        skip, silent = 0, self.silent[tokens]
        if self.prefix and len(loud := np.flatnonzero(~silent)) and self.spaced[tokens[loud[0]]]:
            skip = 1  # the space that encoding has put in front
        runs = np.split(tokens, np.flatnonzero(silent)) if silent.any() else [tokens]  # bytes don't join across a control id
        return "".join([self.surface.of(run).decode("utf-8", "lakeshift-each-byte") for run in runs])[skip:]

    def decimals(self, ids: bytes) -> bytes:
        """Ids as decimal numbers, joined by commas."""
        return self.numbers.of(np.frombuffer(ids, dtype="<u4").astype(np.int64))[:-1]


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary): the ids of each text as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in slices(batches, text_col):
            ids = [pieces.encode(t) for t in batch.column(text_col).to_pylist()]
            yield pa.record_batch([batch.column(id_col), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def decode(ids: DataFrame, model: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text): the inverse of ``encode``; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in slices(batches, "ids"):
            texts = [pieces.decode(b or b"") for b in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column(id_col), pa.array(texts, pa.string())], names=[id_col, "text"])

    kind = ids.schema[id_col].dataType.simpleString()
    return ids.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, text string")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: (id, n_tokens, ids_sha256, decoded_sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(model)
        for batch in slices(batches, text_col):
            counts, of_ids, of_text = [], [], []
            for text in batch.column(text_col).to_pylist():
                ids = pieces.encode(text)
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(pieces.decimals(ids)).hexdigest())
                of_text.append(hashlib.sha256(pieces.decode(ids).encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(id_col), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op13_piece_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_model())
