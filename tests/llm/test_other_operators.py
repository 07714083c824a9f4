"""Nearest neighbours, licences, WARC, quotes and URL rules against brute force, and their defined edge cases."""

import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lakeshift.llm import hilbert_ann, license_scan, quote_linking, queries, url_automaton, warc_bundle
from lakeshift.llm.common import Stage, table
from lakeshift.llm.components import components, joined_roots

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_twin(spark, name):
    own = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    sql = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in sql.description]
    assert sorted(columns) == sorted(own.columns)
    assert sorted(map(repr, (tuple(r) for r in own.select(*columns).collect()))) == sorted(map(repr, sql.fetchall()))


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 11)) and "pipeline" in queries.QUERIES


# -- nearest neighbours
@pytest.mark.parametrize("n, bits", [(2, 4), (3, 2), (6, 1)])
def test_hilbert_visits_every_cell_by_unit_steps(n, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
    place = hilbert_ann.hilbert(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def brute_nearest(ids, vectors, limit=20):
    out = {}
    for k in np.flatnonzero(ids % 20 == 0):
        score = (vectors * vectors[k]).sum(axis=1)
        score[k] = -np.inf
        best = np.lexsort((ids, -score))[: min(limit, len(ids) - 1)]
        out[int(ids[k])] = [(int(ids[b]), score[b]) for b in best]
    return out


def test_recall_and_exact_scores(spark):
    rows = table(spark, SF, "embeddings").toPandas()
    want = brute_nearest(rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), dtype=np.float64))
    got = hilbert_ann.op1_hilbert_ann(spark, SF).collect()
    exact = {(q, v): s for q, best in want.items() for v, s in best}
    hits = [r for r in got if (r.query_id, r.vec_id) in exact]
    assert len(hits) >= 0.9 * len(exact)
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-12 for r in hits)
    for q in want:
        own = sorted((r.rank, -r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 21)) and [r[1:] for r in own] == sorted(r[1:] for r in own)


def test_equal_vectors_tie_by_id_and_bad_vectors_stay_out(spark):
    one, two = [1.0, 0.0, 2.0], [0.5, 0.5, 0.5]
    rows = [(i, one) for i in range(60)] + [(100, two), (101, None), (102, [0.0] * 3), (103, [1.0, None, 2.0]), (104, [float("nan"), 1.0, 1.0]), (105, [float("inf"), 1.0, 1.0]), (106, [1.0]), (None, one), (0, one)]
    got = hilbert_ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] for q in (0, 20, 40, 100)}
    assert {r.query_id for r in got} == set(by)
    assert by[0] == list(range(1, 21)) and by[20] == list(range(20)) and by[40] == list(range(20)) and by[100] == list(range(20))
    few = hilbert_ann.search(spark.createDataFrame(rows[59:61], "vec_id long, embedding array<float>"), F.lit(True)).collect()
    assert {(r.query_id, r.vec_id, r.rank) for r in few} == {(59, 100, 1), (100, 59, 1)}
    assert hilbert_ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


# -- licences
def test_licences_in_any_spelling(spark):
    mit = next(t for n, t in license_scan.KNOWN if n == "MIT")
    other = "  mit LICENCE\n\nCopyright (c) 2020 Somebody\nAll rights reserved.\n" + mit.split("\n", 1)[1].replace(" ", "\n  ").upper()
    rows = [(1, mit, 1), (2, other, 1), (3, "x\nreleased under THE mit licence!\nLicensed under CC BY-NC 4.0\ny", 1), (3, "x\nreleased under THE mit licence!\nLicensed under CC BY-NC 4.0\ny", 1), (4, None, 1), (5, "", 1), (None, mit, 1), (6, "about a licence " * 20_000, 1)]
    out = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, digest int"))
    got = sorted(((r.doc_id, r.license, r.notices, r.n_notices) for r in out.collect()), key=repr)
    # the first is also a paragraph of its own; the second's title stands apart from its paragraph
    assert got == sorted([(1, "MIT", "MIT", 1), (2, "MIT", "", 0), (3, None, "CC-BY-NC-4.0,MIT", 2), (3, None, "CC-BY-NC-4.0,MIT", 2), (4, None, "", 0), (5, None, "", 0), (None, "MIT", "MIT", 1), (6, None, "", 0)], key=repr)
    assert all(re.search(license_scan.TELLTALE, t) for _, t in license_scan.KNOWN)
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# -- WARC
def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int, kept string")


def test_bundles_round_trip(spark):
    big, small = "<p>é</p>" * 300, "tiny"
    rows = [(1, "http://a.b/x y\r\nz", big, 1, ""), (2, None, big, 1, ""), (7, "http://c", big, 1, ""), (7, "http://c", big, 1, ""), (3, "u", small, 1, ""), (4, "u", small, 1, ""), (5, "u", None, 1, ""), (6, "", "", 1, ""), (8, "u", "x" * 3_000_000, 1, ""), (None, "u", big, 1, "")]
    stage = Stage(spark, "test")
    index = warc_bundle.write_bundles(pages(spark, rows), f"{stage.folder}/bundles", stage, frame_bytes=4000)
    out = {(r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in warc_bundle.read_records(index).collect()}
    want = set()
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        again = html == big and page in (1, 2)
        want.add((f"urn:page:{'' if page is None else page}", "revisit" if again else "response", "urn:page:7" if again else None, len(raw), hashlib.sha1(raw).hexdigest(), b"" if again else raw))
    assert out == want
    # a bundle is plain Zstandard: any reader gets the records one after the other
    uri = index.first()["bundle"]
    files, path = warc_bundle.file_system(uri)
    data = files.open_input_file(path).readall()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert sum(p for _, _, p in warc_bundle.BundleReader(uri).frames) == len(plain)
    empty = warc_bundle.write_bundles(pages(spark, []), f"{stage.folder}/none", Stage(spark, "test"))
    assert warc_bundle.read_records(empty).count() == 0


# -- URL rules
def glob_pattern(glob):
    out, k = "", 0
    while k < len(glob):
        if glob[k] == "\\" and k + 1 < len(glob):
            out += re.escape(glob[k + 1])
            k += 1
        elif glob[k : k + 2] == "**":
            out += ".*"
            k += 1
        else:
            out += {"*": "[^/]*", "?": "[^/]"}.get(glob[k]) or re.escape(glob[k])
        k += 1
    return re.compile(out.encode(), re.DOTALL)


def test_automaton_equals_regular_expressions():
    rnd = random.Random(4)
    piece = ["a", "b", "/", ".", "*", "**", "?", "\\*", "ab", "é"]
    globs = ["".join(rnd.choice(piece) for _ in range(rnd.randint(0, 9))) for _ in range(150)]
    urls = ["".join(rnd.choice("ab/.*é?") for _ in range(rnd.choice([0, 1, 3, 8, 20, 200]))).encode() for _ in range(400)]
    want = {(u, g) for u, url in enumerate(urls) for g, glob in enumerate(globs) if glob_pattern(glob).fullmatch(url)}
    automaton = url_automaton.Automaton(globs)
    got = list(automaton.matches(urls))
    assert len(got) == len(set(got)) and set(got) == want and automaton.words > 5
    assert list(automaton.matches([])) == []


def test_rules_and_odd_urls(spark):
    rules = [url_automaton.site(*s) for s in url_automaton.SITES] + [url_automaton.Rule(g, "block") for g in url_automaton.UNWANTED]
    urls = {1: "http://Example.ORG/en/17?x", 2: "https://a.example.org/es/", 3: "http://org/", 4: "http://borg/", 5: "http://x.org", 6: "http://x.com/x.org/", 7: None, 8: "no scheme", 9: "", 10: "http://x.net/a.exe#y", 11: "http://x.org?/z", 12: "ftp://u@é.com/fr/é", 13: "http://x.net/" + "a/" * 20_000 + "b.zip"}
    got = {r.page_id: (r.host, r.path[:9], r.rule, r.verdict) for r in url_automaton.judge(spark.createDataFrame([(k, u, 0) for k, u in urls.items()], "page_id long, url string, host int"), rules).collect()}
    assert got[1] == ("example.org", "/en/17", "example.org/en/1", "block") and got[2] == ("a.example.org", "/es/", "example.org/es/", "block")
    assert got[3] == ("org", "/", "org/", "allow") and got[4][2] is None and got[5] == ("x.org", "", None, "allow") and got[6][2] is None
    assert got[7] == got[8] == got[9] == ("", "", None, "allow")
    assert got[10] == ("x.net", "/a.exe", None, "block") and got[11] == ("x.org", "", None, "allow")
    assert got[12] == ("u@é.com", "/fr/é", "com/fr/", "allow") and got[13][2:] == (None, "block")
    assert url_automaton.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0


# -- quotes
def brute_links(rows):
    """(conv, turn, text) -> reply_to and thread, by a walk over the messages."""

    def plain(t):
        return " ".join(re.findall(r"[^\W_]+", t.lower()))

    def bare(t):
        lines = t.split("\n")
        keep = [x for k, x in enumerate(lines) if not re.match(r"[ \t]{0,3}>", x) and not (re.match(r"On .* wrote:[ \t]*$", x) and k + 1 < len(lines) and re.match(r"[ \t]{0,3}>", lines[k + 1]))]
        return re.sub(r"\s+\Z", "", re.sub(r"\A(?:[ \t]*\n)+", "", "\n".join(keep))) if len(keep) < len(lines) else t

    said = {}
    for c, n, t in sorted(rows):
        for u in [bare(t), *re.split(r"\n[ \t]*\n", bare(t)), *bare(t).split("\n")]:
            if plain(u):
                said.setdefault((c, plain(u)), n)
    reply = {}
    for c, n, t in rows:
        best = []
        runs = []
        for line in t.split("\n"):
            marks = re.match(r"(?:[ \t]{0,3}>)+", line)
            level = marks[0].count(">") if marks else 0
            if runs and runs[-1][0] == level:
                runs[-1][1].append(line[marks.end() if marks else 0 :])
            else:
                runs.append((level, [line[marks.end() if marks else 0 :]]))
        for level, lines in runs:
            sources = [said[c, plain(u)] for u in ["\n".join(lines), *lines] if level and said.get((c, plain(u)), n) < n]
            if sources:
                best.append((-level, max(sources)))
        reply[c, n] = max(best)[1] if best else None
    out = {}
    for c, n, t in rows:
        root = n
        while reply.get((c, root)) is not None:
            root = reply[c, root]
        out[c, n] = (reply[c, n], root, bare(t))
    return out


def test_links_equal_brute_force(spark):
    rnd, rows = random.Random(6), []
    for c in range(30):
        texts = []
        for n in range(rnd.randint(1, 12)):
            lines = []
            for _ in range(rnd.randint(0, 2)):
                if texts:
                    mark = rnd.choice(["> ", ">", "> > ", ">>> "])
                    picked = rnd.choice(texts).split("\n")
                    lines += [mark + x.upper() for x in picked[: rnd.randint(1, len(picked))]]
            if lines and rnd.random() < 0.5:
                lines.insert(0, "On Monday someone wrote:")
            lines += [f"own {rnd.randrange(40)} words, {rnd.randrange(9)}", "", f"more {rnd.randrange(50)}"][: rnd.randint(0, 3)]
            texts.append("\n".join(lines))
            rows.append((c, n, texts[-1]))
    got = quote_linking.link(spark.createDataFrame([(c, n, "user", t, 0) for c, n, t in rows], "conv_id long, turn long, role string, text string, key int"))
    assert {(r.conv_id, r.turn): (r.reply_to, r.thread, r.text) for r in got.collect()} == brute_links(rows)


def test_two_wrapped_paragraphs_of_three_quoted_together_link(spark):
    said = "First of all we count\nthe boxes in the yard.\n\nThen somebody carries\nthem up the hill.\n\nLast of all we rest\nbeside the well."
    quote = "> First of all we\n> count the boxes in the yard.\n>\n> Then somebody carries them\n> up the hill.\n\nWho does?"
    rows = [(1, 0, "user", said), (1, 1, "assistant", "Well."), (1, 2, "user", quote)]
    out = quote_linking.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.turn: (r.reply_to, r.n_quotes, r.n_linked) for r in out} == {0: (None, 0, 0), 1: (None, 0, 0), 2: (0, 1, 1)}


def test_quote_edges(spark):
    rows = [(1, 0, "u", None), (1, 1, "a", "> nothing known"), (None, 1, "u", "> x"), (2, None, "u", "> x"), (1, 2, "u", "> ?!\n"), (1, 2, "u", "> ?!\n"), (1, 3, "u", "same"), (1, 4, "a", "> same\n" * 3000 + "end")]
    out = quote_linking.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(out) == len(rows)
    got = {(r.conv_id, r.turn): (r.reply_to, r.n_quotes, r.n_linked, r.text) for r in out}
    assert got[1, 0] == (None, 0, 0, None) and got[1, 1] == (None, 1, 0, "") and got[1, 2] == (None, 1, 0, "") and got[1, 4] == (3, 1, 1, "end")
    assert got[None, 1][0] is None and got[2, None][0] is None
    assert quote_linking.link(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_components(spark):
    rnd = random.Random(8)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(90)]
    parent = {x: x for pair in links for x in pair}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), Stage(spark, "cc")).collect()}
    assert got == {x: top(x) for x in parent if any(x in p and p[0] != p[1] for p in links)}
    assert got[40] == 0 and got[129 - 1] == 100
    more = [(40, 110), (7, 500), (500, 501), (90, 91), (3, 5)]
    stage = Stage(spark, "cc2")
    first = components(spark.createDataFrame(links[:69], "a long, b long"), stage)
    joined = {r.node: r.root for r in joined_roots(first, spark.createDataFrame(more, "a long, b long"), stage, "more").collect()}
    assert joined == {x: 0 for x in [*range(41), *range(100, 130), 500, 501]} | {90: 90, 91: 90}
