"""Packing, BPE, quality rules, spans and near-duplicates against brute force, and their defined edge cases."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakeshift.llm import bottom_k, bpe, decision_list, packing, sentence_spans
from lakeshift.llm.common import Stage, table
from tests.llm.helpers import brute_groups, brute_words

SF = "/root/testdata/sf0.001"
EDGES = "doc_id long, text string, starts string, its_id int, n_words string, task int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.default_vocabulary())


def edge_rows():
    long = " ".join(f"word{i % 977}x{i % 31}." for i in range(20_000))
    same = "The same text of some words stands here, and here it stays for long enough. It has a second sentence. And it has a third one as well, for good measure."
    return [(1, None, "a", 1, "b", 1), (2, "", None, None, None, None), (3, " \n\t ", "", 0, "", 0), (4, long, "", 0, "", 0), (5, same, "", 0, "", 0), (6, same, "", 0, "", 0), (6, same, "", 0, "", 0), (7, "One", "", 0, "", 0), (None, same, "", 0, "", 0), (8, "naïve — 🎉 ñandú x  y <|endoftext|> z", "", 0, "", 0)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), EDGES)


def empty_docs(spark):
    return spark.createDataFrame([], EDGES)


def test_codec_equals_the_library(tokenizer):
    codec, rnd = bpe.codec(bpe.default_vocabulary()), random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "the", "'s", "'ll", "12", "é", "ß", "中文", "🎉", "<|endoftext|>", " ", " ", "\x1c", "\x85", "!", "...", "ing", "aaaa", "́", "'", "​"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    texts += ["".join(rnd.choice("etaoin") for _ in range(rnd.randint(1, 60))) for _ in range(1000)] + ["ab" * 3000, "=" * 2500, " " * 700 + "x"]
    library = packing.LibraryIds(bpe.default_vocabulary())
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert library.encode(text) == ids, text
        assert codec.decode(ids) == tokenizer.decode(want, skip_special_tokens=False)


def test_word_cache_generations_keep_ids(tokenizer):
    codec = bpe.Codec(bpe.default_vocabulary())
    codec.words, codec.chunks, codec.pairs = bpe.Recent(8), bpe.Recent(8), bpe.Recent(8)
    text = " ".join(f"w{i % 40}ly" for i in range(500))
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_bpe_query_columns_and_edges(spark, tokenizer):
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(edge_docs(spark), bpe.default_vocabulary()).collect()}
    want = set()
    for i, text, *_ in edge_rows():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert rows == want
    assert bpe.digests(empty_docs(spark), bpe.default_vocabulary()).count() == 0
    own = edge_docs(spark).where("doc_id in (4, 8)")
    back = bpe.decode(bpe.encode(own, bpe.default_vocabulary()), bpe.default_vocabulary())
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in own.collect()}


def check_packing(rows, texts, tokenizer, window):
    """Every id in one piece, sequences gapless and not too long; returns the share of padding."""
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in texts.items()}
    of_doc, of_sequence = Counter(), Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == of_doc[r["doc_id"]] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
        of_doc[r["doc_id"]] += r["length"]
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == of_sequence[r["sequence_id"]]
        of_sequence[r["sequence_id"]] += r["length"]
    assert all(of_doc[i] == len(x) for i, x in ids.items()) and max(of_sequence.values()) <= window
    return sum(window - n for n in of_sequence.values()) / sum(of_sequence.values())


def test_packing_places_every_id_once(spark, tokenizer):
    docs = table(spark, SF, "documents")
    rows = packing.op10_nnls_packing(spark, SF).collect()
    assert check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer, 1024) < 0.03
    texts = {i: t for i, t, *_ in edge_rows() if i not in (6, None)}
    own = edge_docs(spark).where("doc_id <> 6")
    check_packing(packing.pack(own, bpe.default_vocabulary(), window=64).collect(), texts, tokenizer, 64)
    assert packing.pack(edge_docs(spark), bpe.default_vocabulary()).select("doc_id").where("doc_id = 6").count() == 2
    assert packing.pack(empty_docs(spark), bpe.default_vocabulary()).count() == 0


@pytest.mark.parametrize("hot", [0, 30_000])
def test_plan_uses_every_count_and_solves_the_histogram(hot):
    counts = np.random.default_rng(0).integers(0, 60, 257)
    counts[0] = 0
    counts[77] += hot
    used = np.zeros(257, dtype=int)
    for parts, times in packing.plan(counts, 256):
        assert sum(a * n for a, n in parts.items()) <= 256
        for a, n in parts.items():
            used[a] += n * times
    assert (used == counts).all()
    columns = packing.combinations(counts, 256)
    assert all(sum(a * n for a, n in c.items()) == 256 for c in columns)
    x = packing.non_negative_least_squares([{1: 1}, {1: 1, 2: 2}], np.array([0, 3.0, 4.0]), 500)
    assert np.allclose(x, [1, 2], atol=0.05)


def brute_measure(text):
    words, lines = brute_words(text), (text or "").split("\n")
    full = [x for x in lines if brute_words(x)]
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    again = {k + d for k in range(len(words) - 2) for d in range(3) if windows[tuple(words[k : k + 3])] > 1}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(again)]


def test_statistics_equal_brute_force():
    rnd = random.Random(5)
    texts = [None, "", "a a a a", "x\nx\n\n \nx", "a b c a b c a b"] + ["".join(rnd.choice("ab #|\n\t\x0b é") for _ in range(rnd.randint(0, 80))) for _ in range(500)]
    for text in texts:
        assert decision_list.measure(text)[:5] == brute_measure(text), text


def test_quality_rules_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = labels.where("doc_id % 4 = 0")
    judged, _ = decision_list.judge(docs.select("doc_id", "text"), labels.where("doc_id % 4 <> 0"))
    rows = judged.join(held, "doc_id").where("not base_failed").select("kept", "quality").collect()
    assert len(rows) > 50 and sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.95
    for r in judged.where("base_failed").collect():
        assert not r.kept and (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_quality_rules_edges(spark):
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out, names = decision_list.judge(edge_docs(spark), no_labels)
    assert names["n_words"] == "n_words_" and out.count() == 10  # a clashing column passes through
    assert decision_list.keep_good(edge_docs(spark), no_labels).columns == edge_docs(spark).columns
    nulls = spark.createDataFrame([(None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    assert decision_list.keep_good(edge_docs(spark), nulls).select("doc_id").collect() == [(4,)]
    assert decision_list.keep_good(empty_docs(spark), no_labels).count() == 0


def test_sequential_covering_finds_a_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(decision_list.LEARNED)))
    bad = (x[:, 2] > 0.7) & (x[:, 5] <= 0.4)
    rules = decision_list.learn(x, bad, np.arange(3000) % 3 == 0)
    hit = np.zeros(3000, dtype=bool)
    for rule in rules:
        hit |= decision_list.holds(rule, x)
    assert (hit == bad).mean() > 0.98 and rules


def brute_spans(rows, run=3, longest=16, least=20):
    """Texts without repeats, by a walk over all documents in order."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        pieces = sentence_spans.sentences(text, longest)
        norm = [" ".join(brute_words(c, lower=True)) for _, _, c in pieces]
        starts = []
        for k in range(len(norm) - run + 1):
            span = tuple(norm[k : k + run])
            if span in seen:
                starts.append(k)
            seen.add(span)
        gone = {k + d for k in starts for d in range(run)}
        kept, at, k = "", 0, 0
        while k < len(pieces):
            j = k
            while j < len(pieces) and (j in gone) == (k in gone):
                j += 1
            if k not in gone or sum(p[1] for p in pieces[k:j]) < least:
                kept += text[at : pieces[j - 1][0]]
            at, k = pieces[j - 1][0], j
        out[i] = kept if gone else text
    return out


def test_spans_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    want = brute_spans([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.text for r in sentence_spans.op3_sentence_spans(spark, SF).collect()}
    assert got == want and sum(got[r.doc_id] != r.text for r in docs.collect()) > 10


def test_sentences_cover_the_text():
    rnd = random.Random(2)
    for _ in range(500):
        text = "".join(rnd.choice(["a", "bc ", ". ", "! ", "\n", " ", "x" * 5, "  \n "]) for _ in range(rnd.randint(0, 120)))
        pieces = sentence_spans.sentences(text, 4)
        assert all(w <= 4 for _, w, _ in pieces) and sum(w for _, w, _ in pieces) == len(text.split())
        assert not pieces or pieces[-1][0] == len(text)


def test_spans_catch_a_passage_and_leave_the_rest(spark):
    passage = "It was late when the last of them came home over the hills. Nobody spoke of what the river had taken that spring, nor would they. " * 1 + "Still, the lamps were lit in every window along the road that night. And the dog, which had waited by the gate since noon, slept at last beside the stove until the morning came."
    rows = [(i, f"Document {i} opens in its own words here. {passage} Then it goes on as number {i} for a while.") for i in range(40)]
    out = {r.doc_id: r.text for r in sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == rows[0][1] and all("lamps" not in out[i] and f"Document {i} opens" in out[i] and f"number {i}" in out[i] for i in range(1, 40))


@pytest.mark.parametrize("punctuated", [False, True])
def test_spans_catch_long_passages_at_any_offset(spark, punctuated):
    rnd = random.Random(11)

    def words(n):
        return [f"w{rnd.randrange(10**6)}" + (rnd.choice(".!?") if punctuated and rnd.random() < 0.08 else "") for _ in range(n)]

    texts = []
    for size in (51, 55, 80, 1000):
        for _ in range(40):
            passage = words(size)
            texts += [words(rnd.randrange(60)) + passage + words(rnd.randrange(60)) for _ in range(3)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    out = {r.doc_id: r.text.split() for r in sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    seen, met = set(), 0
    for i, t in enumerate(texts):
        windows = [tuple(t[k : k + 51]) for k in range(len(t) - 50)]
        again = {k + d for k, x in enumerate(windows) if x in seen for d in range(51)}
        own = {w for k, w in enumerate(t) if k not in again}
        left = [w for w in out[i] if w not in own]
        assert [w for w in out[i] if w in own] == [w for k, w in enumerate(t) if k not in again]  # nothing else goes
        assert len(left) <= 23, (i, len(again), len(left))
        met += bool(again)
        seen.update(windows)
    assert met == 2 * len(texts) // 3


def test_spans_edges(spark):
    docs = edge_docs(spark)
    out = sentence_spans.remove_repeats(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
    same = edge_rows()[4][1]
    assert sorted((i, t) for i, t in got if i in (5, 6)) == [(5, same), (6, ""), (6, "")]
    assert {t for i, t in got if i is None} == {same} and {t for i, t in got if i == 1} == {None}
    assert sentence_spans.remove_repeats(empty_docs(spark)).count() == 0


def near_copies(rnd, base, n, changes):
    for _ in range(n):
        words = list(base)
        for _ in range(changes):
            words[rnd.randrange(len(words))] = f"z{rnd.randrange(10**6)}"
        yield " ".join(words)


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(3000)}"
    base = [word() for _ in range(150)]
    common = " ".join(word() for _ in range(60))
    texts = list(near_copies(rnd, base, 120, 5))  # none of these pairs reach 0.8
    texts += near_copies(rnd, [word() for _ in range(150)], 150, 2)  # about half of these do, and few that meet the central one
    texts += [f"{common} " + " ".join(word() for _ in range(12)) for _ in range(60)]  # a passage that is most of a text
    for _ in range(80):
        own = [word() for _ in range(rnd.choice([1, 3, 6, 20, 55, 70, 300]))]
        texts += [" ".join(own), " ".join(own).upper(), *near_copies(rnd, own, 2, max(1, len(own) // 60))]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in bottom_k.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    assert got == brute_groups(rows, 4)


def test_near_duplicates_on_the_tables(spark):
    rows = bottom_k.op6_bottomk_dedup(spark, SF).collect()
    want = brute_groups([(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_edges(spark):
    docs = edge_docs(spark)
    out = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in bottom_k.near_duplicates(docs).collect()}
    assert out[1] == (0, 1, True) and out[2] == (0, 2, True) and out[3] == (0, 3, True) and out[7] == (1, 7, True)
    assert out[5][1:] == (5, True) and out[6][1:] == (5, False) and out[None][1:] == (None, True)
    kept = bottom_k.keep_first(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 7, 8, None])
    twice = spark.createDataFrame([edge_rows()[4]] * 2, EDGES)
    assert bottom_k.keep_first(twice).count() == 1
    assert bottom_k.near_duplicates(empty_docs(spark)).count() == 0


def test_one_id_with_unrelated_texts_keeps_each(spark):
    rnd = random.Random(4)
    a, b, c = ([f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(3))
    near = [*a[:-1], "other"]
    texts = [" ".join(x) for x in (a, near, b, b, c)] + ["", None]
    rows = [(0, t) for t in texts] + [(7, " ".join(b)), (7, " ".join(c) + " more"), (8, "apart from all of them"), (8, "apart from all of them")]
    kept = bottom_k.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = Counter((r.doc_id, r.text) for r in kept)
    assert got[(0, texts[0])] + got[(0, texts[1])] == 1
    assert got - Counter([(0, texts[0]), (0, texts[1])]) == Counter([(0, t) for t in (texts[2], texts[4], "", None)] + [(8, "apart from all of them")])


def test_half_hashes_of_long_texts_err_within_the_margin(spark):
    rng = np.random.default_rng(6)
    for n in (1_000, 100_000, 400_000):
        both = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
        a, b = (np.unique(np.concatenate([both, rng.integers(-(2**63), 2**63 - 1, n // 8)])) for _ in range(2))
        shared = len(np.intersect1d(a >> 32, b >> 32))
        margin = spark.range(1).select(bottom_k.miscount(F.lit(len(a)), F.lit(len(b))).alias("x")).first().x
        assert abs(shared - len(np.intersect1d(a, b))) <= margin
        assert n < 400_000 or abs(shared - len(np.intersect1d(a, b))) > 3  # the margin once was 3 for all


def test_pipeline_equals_brute_force(spark, tokenizer):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rules = decision_list.fit(docs, labels)
    kept = []
    for r in docs.collect():
        m = decision_list.measure(r.text)
        x = np.array([[m[0], *m[5:]]])
        if m[0] >= 50 and 100 * m[4] <= 50 * m[0] and not any(decision_list.holds(rule, x)[0] for rule in rules):
            kept.append((r.doc_id, r.text))
    groups = brute_groups(kept, 5)
    kept = [(i, t) for i, t in kept if groups[i][1] == i]
    texts = brute_spans(kept)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert check_packing(rows, texts, tokenizer, 1024) < 0.03


def test_pipeline_stages_take_empty_and_odd_tables(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "substring dedup", "packing"]
    schema = table(spark, SF, "documents").schema
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x y", "en", "s", 3)], schema)
    for docs in (spark.createDataFrame([], schema), odd):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = Stage(spark, "odd").write(stage(spark, docs, SF), "out")
            if k < 3:
                assert out.columns == docs.columns
            assert out.count() <= docs.count()
