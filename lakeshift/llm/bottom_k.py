"""Near-duplicates by bottom-k sketches of one hash function (operator 6).

1. Each whole text becomes its set of word shingles, hashed by one 64-bit
   function; the ``k`` smallest hashes are its sketch. Equal word sequences are
   one class from here on, so exact copies are never compared.
2. Inverted lists hold retained values. Two sets of similarity ``t`` share, of
   the k smallest values of their union, about ``t`` * k; fewer than ``least``
   shared ones (28 of 64 at 0.8) have odds under 1e-9, and sets that fit
   into their sketch are bounded exactly. So each sketch enters the lists of
   only as many values as leave less than that many out, its rarest first:
   what thousands of texts have in common is the last to be listed, and values
   that only one sketch holds need no list.
3. Short lists give all their pairs. In a long list every class meets the
   list's most central class. A pair is estimated on the sketch of its union;
   what passes is verified on the full shingle sets.
4. Once those links have joined components, lists that still hold several are
   open. Classes that share open lists form clusters; a cluster that fits into a
   block of bounded weight is compared there once, on full sets. Of a very heavy one,
   the members outside the largest component of a list first meet its most central
   members; what stays apart meets the others in pairs of blocks. A block gives
   only the links that join components. Components of all links give each document
   its class.

Every link that exists between different texts thus joins its two components,
but for sketches' odds above; no list is capped and no pair is sampled.

Defined results: a text that is null, empty or without words has an empty set,
is linked with nothing and kept; fewer words than a shingle has form one
shingle; equal texts are linked; rows that repeat a doc_id and text count as
one document; rows of one doc_id with different texts are linked only where
these are similar, and ``keep_first`` keeps one row of each component; a null doc_id is linked with
nothing and kept; texts of any length are compared whole; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import SMALL_BYTES, Stage, free_names, slices, table, words_of
from lakeshift.llm.components import components, joined_roots

#: Lists up to this length give all their pairs; longer ones go by their central class and in blocks.
SHORT = 12
#: Shingles of a block and of a hub's chunk, what a class counts there besides its own, central classes of a hub,
#: and blocks of a cluster from which hubs come first.
BLOCK_WEIGHT, HUB_WEIGHT, ROW_WEIGHT, HUBS, HUB_BLOCKS = 1 << 20, 1 << 19, 1024, 64, 32
#: Bits of the map that tells which texts are needed again.
MAP_BITS = 1 << 26
#: Values of each sketch that sort out most pairs before whole sketches meet.
FEW = 16


def shingle_set(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, dtype=np.int64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64).view(np.int64)
    digest = xxhash.xxh3_64_intdigest
    of = np.array([digest(w) for w in words], dtype=np.uint64)
    n = len(of) - width + 1
    out = of[:n].copy()
    for k in range(1, width):  # order counts: a polynomial in an odd constant
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += of[k : k + n]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.unique(out.view(np.int64))


def longs(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64)))


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """(doc_id, key, digest, n, sketch) per row; ``digest`` names the word sequence, ``key`` the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SMALL_BYTES):
            nodes, sizes, kept = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text, lower=True)
                values = shingle_set(words, width)
                nodes.append(xxhash.xxh3_128_digest(b" ".join(words)) if words else None)
                sizes.append(len(values))
                kept.append(values[:k])
            yield pa.record_batch([batch.column("doc_id"), batch.column("key"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), longs(kept)], names=["doc_id", "key", "digest", "n", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(run, f"doc_id {kind}, key long, digest binary, n long, sketch array<long>")


def full_sets(texts: DataFrame, width: int, halves: bool = False) -> DataFrame:
    """(node, values): whole shingle sets of texts (node, text); with ``halves``, of the hashes' upper 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SMALL_BYTES):
            sets = [shingle_set(words_of(t, lower=True), width) for t in batch.column("text").to_pylist()]
            if halves:
                sets = [np.unique(s >> 32) for s in sets]
            values = longs(sets).cast(pa.list_(pa.int32() if halves else pa.int64()))
            yield pa.record_batch([batch.column("node"), values], names=["node", "values"])

    return texts.select("node", "text").mapInArrow(run, f"node long, values array<{'int' if halves else 'long'}>")


def similar(shared: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n + m - shared)


def lists(classes: DataFrame, stage: Stage, k: int, percent: int, least: int) -> DataFrame:
    """(v, node, n, centre): the inverted lists of retained values."""
    postings = classes.select("node", F.explode("sketch").alias("v"))
    common = stage.write(postings.groupBy("v").agg(F.count("*").alias("df")).where("df > 1"), "common")
    hits = postings.join(common, "v").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "v"))).alias("hits"))  # at most k of each sketch
    hits = hits.join(classes.select("node", "n", F.size("sketch").cast("long").alias("s")), "node")
    fits = 100 * F.col("n") <= percent * k  # then every set similar to it fits into a sketch as well
    overlap = F.when(fits, F.ceil(F.col("n") * percent / 100.0 - 1e-9)).otherwise(F.lit(least))
    listed = F.greatest(F.lit(0), F.col("s") - overlap + 1 - (F.col("s") - F.size("hits"))).cast("int")
    centre = F.aggregate("hits", F.lit(0).cast("long"), lambda total, x: total + x["df"])
    out = hits.select("node", "n", centre.alias("centre"), F.explode(F.slice("hits", F.lit(1), listed)).alias("hit"))
    return stage.write(out.select(F.col("hit.v").alias("v"), "node", "n", "centre"), "lists")


def first_pairs(listed: DataFrame, stage: Stage, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of short lists and of long lists' centres; and the long lists (v, members)."""
    heads = listed.groupBy("v").agg(F.count("*").alias("members"), F.max(F.struct("centre", "node", "n")).alias("head")).where("members > 1")
    heads = stage.write(heads, "heads")
    short = listed.join(heads.where(F.col("members") <= SHORT).select("v"), "v", "left_semi")
    short = stage.write(short.select("v", "node", "n"), "short")
    near = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.col("a") != F.col("b"))
    mine = short.select("v", F.col("node").alias("a"), "n").join(short.select("v", F.col("node").alias("b"), F.col("n").alias("m")), "v").where(F.col("a") < F.col("b"))
    long = heads.where(F.col("members") > SHORT)
    to_head = listed.join(long, "v").select(F.col("node").alias("a"), "n", F.col("head.node").alias("b"), F.col("head.n").alias("m"))
    pairs = mine.where(near).select("a", "b").union(to_head.where(near).select(F.least("a", "b"), F.greatest("a", "b")))
    return pairs.distinct(), long.select("v", "members")


def marked(docs: DataFrame, needed: DataFrame, stage: Stage, name: str) -> DataFrame:
    """Rows of docs whose key may be needed, so that few texts are shuffled.

    A bit map of fixed size holds the needed keys: MAP_BITS bits in runs of 4096
    bytes, 8 MB in all however many keys there are, which bounds its broadcast. Rows
    that only share a bit with a key go in the join that follows.
    """

    def bit(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(MAP_BITS))

    place = needed.select(bit(F.col("key")).alias("bit"))
    runs = place.groupBy(F.bitmap_bucket_number("bit").alias("run")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    runs = stage.write(runs, f"{name}_map")
    at = F.bitmap_bit_position("bit").cast("int")
    byte = F.conv(F.hex(F.expr("substring(map, bitmap_bit_position(bit) div 8 + 1, 1)")), 16, 10).cast("int")
    there = docs.withColumn("bit", bit(F.col("key"))).join(F.broadcast(runs), F.bitmap_bucket_number("bit") == F.col("run"))
    return there.where(F.getbit(byte, at % 8) == 1).select(*docs.columns)


def whole_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, stage: Stage, name: str, width: int, halves: bool = False) -> DataFrame:
    """(node, values): the full shingle sets of some nodes, made from their texts."""
    needed = stage.write(classes.join(nodes.distinct(), "node", "left_semi").select("node", "rep.doc_id", "rep.key"), f"{name}_needed")
    texts = marked(docs.select("doc_id", F.xxhash64("text").alias("key"), "text"), needed, stage, name).join(needed, ["doc_id", "key"])
    return stage.write(full_sets(texts, width, halves), f"{name}_sets")


def open_lists(listed: DataFrame, long: DataFrame, roots: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(v, node, n, centre, root, members, main, others) of long lists that hold several components.

    ``main`` is the largest component; ``others`` counts the members outside it.
    """
    placed = listed.join(long, "v").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stage.write(placed, f"{name}_placed")
    shares = placed.groupBy("v", "root").agg(F.count("*").alias("share"), F.first("members").alias("members"))
    main = shares.groupBy("v").agg(F.max(F.struct("share", "root")).alias("main"), F.first("members").alias("members")).where(F.col("main.share") < F.col("members"))
    main = stage.write(main.select("v", F.col("main.root").alias("main"), (F.col("members") - F.col("main.share")).alias("others")), f"{name}_main")
    return stage.write(placed.join(main, "v"), f"{name}_open")


def joining_links(percent: int):
    """A function of a group (node, n, root, values) that gives those of its links that join its components."""

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        n, node = group["n"].to_numpy(), group["node"].to_numpy()
        root = pd.factorize(group["root"])[0]
        _, column, times = np.unique(np.concatenate(group["values"].to_list()), return_inverse=True, return_counts=True)
        row, kept = np.repeat(np.arange(len(group)), n), times[column] > 1
        used, column = np.unique(column[kept], return_inverse=True)
        row, order = row[kept], np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        shared = np.zeros((len(group), len(group)), dtype=np.float32)
        for k in range(0, len(used), 4096):  # counts below 2 ** 24 are exact in this type
            part = slice(*np.searchsorted(column, [k, k + 4096]))
            holds = np.zeros((len(group), 4096), dtype=np.float32)
            holds[row[part], column[part] - k] = 1
            shared += holds @ holds.T
        links: dict[tuple[int, int], tuple[int, int]] = {}
        for a in range(len(group)):
            met = shared[a, a + 1 :].astype(np.int64)
            b = a + 1 + np.flatnonzero((100 * met >= percent * (n[a] + n[a + 1 :] - met)) & (root[a + 1 :] != root[a]))
            for other, k in zip(*np.unique(root[b], return_index=True), strict=True):
                links.setdefault((min(root[a], other), max(root[a], other)), (a, b[k]))
        parent, out = list(range(int(root.max()) + 1)), []

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for (x, y), (a, b) in links.items():
            x, y = top(x), top(y)
            if x != y:
                parent[x] = y
                out.append((node[a], node[b]))
        return pd.DataFrame(out, columns=["a", "b"])

    return compare


def weight() -> Column:
    """What a class weighs in a block: its set, and its row of the block's table of pairs."""
    return F.col("n") + ROW_WEIGHT


def clusters(opened: DataFrame, stage: Stage) -> DataFrame:
    """(node, n, v, members, cluster, heavy, hubs): classes that share open lists, directly or through others, are one cluster.

    ``v`` is the longest list of the class. Few classes make up many lists, so that a
    cluster that fits into a block is compared once, not list by list; ``heavy`` ones
    don't fit, and ``hubs`` would make so many pairs of blocks that hubs come first.
    """
    heads = opened.groupBy("v").agg(F.min("node").alias("b"))
    ties = opened.join(heads, "v").select(F.col("node").alias("a"), "b").distinct().where("a <> b")
    of_node = components(ties, stage, "cluster").withColumnRenamed("root", "cluster")
    nodes = opened.groupBy("node").agg(F.first("n").alias("n"), F.max(F.struct("members", "v")).alias("home"))
    nodes = nodes.select("node", "n", "home.v", "home.members").join(of_node, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    nodes = stage.write(nodes, "cluster_nodes")
    total = F.sum(weight())
    heavy = nodes.groupBy("cluster").agg((total > BLOCK_WEIGHT).alias("heavy"), (total > HUB_BLOCKS * BLOCK_WEIGHT).alias("hubs"))
    return stage.write(nodes.join(heavy, "cluster"), "clusters")


def hub_links(placed: DataFrame, sets: DataFrame, stage: Stage, percent: int) -> DataFrame:
    """Links (a, b) that join most of what is apart in open lists of the heaviest clusters, at little cost.

    Every member outside the largest component of a list goes to the longest
    such list that it is in; there, it meets the others that came, in chunks of
    a bounded size, and the most central members of the largest component.
    What stays apart is left to ``block_links``.
    """
    apart = placed.where("root <> main")
    sent = apart.groupBy("node").agg(F.max(F.struct("members", "v", "n", "root")).alias("to")).select("node", "to.v", "to.n", "to.root")
    sent = stage.write(sent, "hub_sent")
    chunks = sent.groupBy("v").agg(F.ceil(F.sum(weight()) / HUB_WEIGHT).cast("int").alias("chunks"))
    sent = sent.join(chunks, "v").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    central = Window.partitionBy("v").orderBy(F.desc("centre"), "node")
    hubs = placed.where("root = main").withColumn("nth", F.row_number().over(central)).where(F.col("nth") <= HUBS)
    so_far = F.sum(weight()).over(central.rowsBetween(Window.unboundedPreceding, -1))
    hubs = hubs.withColumn("so_far", F.coalesce(so_far, F.lit(0))).where(F.col("so_far") < HUB_WEIGHT)
    hubs = hubs.join(sent.select("v", "chunk").distinct(), "v").select("v", "chunk", "node", "n", "root")
    met = stage.write(sent.select("v", "chunk", "node", "n", "root").union(hubs), "hub_met")
    found = met.join(sets, "node").groupBy("v", "chunk").applyInPandas(joining_links(percent), "a long, b long")
    return stage.write(found, "hub_links")


def block_links(opened: DataFrame, of_node: DataFrame, sets: DataFrame, roots: DataFrame, stage: Stage, percent: int) -> DataFrame:
    """Links (a, b) that join components within open lists, in blocks of bounded weight with their full sets.

    A cluster that fits is one block. A heavy one is cut by its classes' longest
    lists and, within these, by components, so that blocks of a large component hold
    nothing else; then two blocks meet if a list has members in both whose
    components differ. Each two blocks meet once, however many lists they share, and
    give fewer links than they have members, however many pairs are similar.
    """
    nodes = of_node.join(opened.select("node").distinct(), "node", "left_semi").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = stage.write(nodes, "block_nodes")
    of_root = nodes.where("heavy").groupBy("v", "root").agg(F.sum(weight()).alias("w"))
    of_list = of_root.groupBy("v").agg(F.sum(F.when(F.col("w") <= BLOCK_WEIGHT, F.col("w"))).alias("rest"))
    of_root = of_root.join(of_list, "v")
    whole = F.col("w") <= BLOCK_WEIGHT
    cut = F.ceil(F.when(whole, F.col("rest")).otherwise(F.col("w")) / BLOCK_WEIGHT)
    of_root = of_root.select("v", "root", F.when(~whole, F.col("root")).alias("alone"), cut.alias("cut"))
    placed = nodes.join(of_root, ["v", "root"], "left")
    place = F.pmod(F.xxhash64(F.when(F.col("alone").isNull(), F.col("root")).otherwise(F.col("node"))), F.col("cut"))
    name = F.when(F.col("heavy"), F.xxhash64("v", "alone", place)).otherwise(F.xxhash64("cluster"))  # blocks of one name would merge, to no harm
    placed = stage.write(placed.select("node", "n", "root", name.alias("block")), "block_homes")
    pure = placed.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high")).select("block", F.when(F.col("low") == F.col("high"), F.col("low")).alias("pure"))
    there = opened.select("v", "node").join(placed.select("node", "block"), "node").select("v", "block").distinct().join(pure, "block")
    there = stage.write(there, "block_lists")
    two = there.withColumnsRenamed({"block": "low", "pure": "p"}).join(there.withColumnsRenamed({"block": "high", "pure": "q"}), "v")
    two = two.where((F.col("low") <= F.col("high")) & ~F.coalesce(F.col("p") == F.col("q"), F.lit(False))).select("low", "high").distinct()
    meets = stage.write(two.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block")), "block_meets")
    found = meets.join(placed, "block").select("low", "high", "node", "n", "root").join(sets, "node")
    return stage.write(found.groupBy("low", "high").applyInPandas(joining_links(percent), "a long, b long"), "block_links")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, stage: Stage, name: str, width: int, k: int, percent: int, least: int) -> DataFrame:
    """The links among candidate pairs (a, b): estimated on union sketches, then verified on full sets."""
    pairs = stage.write(pairs, f"{name}_pairs")
    # First the smallest few values: of 16, similar sets share two or more but for odds under 1e-9.
    few = classes.select("node", "n", F.slice("sketch", 1, FEW).alias("few"))
    thin = pairs.join(few.withColumnsRenamed({"node": "a", "few": "fa"}), "a").join(few.withColumnsRenamed({"node": "b", "n": "m", "few": "fb"}), "b")
    met = F.size(F.array_intersect(F.slice(F.array_sort(F.array_union("fa", "fb")), 1, FEW), F.array_intersect("fa", "fb")))
    pairs = stage.write(thin.where(met >= F.least(F.lit(2), F.col("n"), F.col("m"))).select("a", "b"), f"{name}_thin")
    side = classes.select("node", "n", "sketch")
    both = pairs.join(side.withColumnsRenamed({"node": "a", "sketch": "sa"}), "a")
    both = both.join(side.withColumnsRenamed({"node": "b", "n": "m", "sketch": "sb"}), "b")
    shared = F.array_intersect("sa", "sb")
    union_sketch = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    whole = (F.col("n") <= k) & (F.col("m") <= k)
    seen = F.when(whole, F.size(shared)).otherwise(F.size(F.array_intersect(union_sketch, shared))).cast("long")
    rated = both.select("a", "b", "n", "m", whole.alias("whole"), seen.alias("seen"))
    passes = F.when(F.col("whole"), similar(F.col("seen"), F.col("n"), F.col("m"), percent)).otherwise(F.col("seen") >= least)
    rated = stage.write(rated.where(passes).select("a", "b", "n", "m", "whole"), f"{name}_rated")
    unsure = rated.where(~F.col("whole")).select("a", "b", "n", "m")
    # Half hashes tell nearly all pairs; those within what they may miscount are compared on whole ones.
    close = compared(unsure, classes, docs, stage, f"{name}_halves", width, percent, halves=True)
    edge = miscount(F.col("n"), F.col("m")) * (100 + percent)
    close = stage.write(close.where(F.col("margin") > -edge), f"{name}_close")
    exact = compared(close.where(F.col("margin") <= edge).drop("margin"), classes, docs, stage, f"{name}_whole", width, percent)
    links = rated.where("whole").select("a", "b").union(close.where(F.col("margin") > edge).select("a", "b")).union(exact.where("margin >= 0").select("a", "b"))
    return stage.write(links, f"{name}_links")


def miscount(n: Column, m: Column) -> Column:
    """By how many shared values half hashes of sets of ``n`` and ``m`` may err, but for odds of about 1e-12."""
    n, m = n.cast("double"), m.cast("double")
    met = (n * n + m * m + n * m) / 2.0**32  # more collisions than are expected
    return 3 + 8 * (met + F.sqrt(met))


def compared(pairs: DataFrame, classes: DataFrame, docs: DataFrame, stage: Stage, name: str, width: int, percent: int, halves: bool = False) -> DataFrame:
    """Pairs (a, b, n, m) with ``margin``, which is negative where the full sets are not similar enough."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    sets = whole_sets(nodes, classes, docs, stage, name, width, halves)
    both = pairs.join(sets.withColumnsRenamed({"node": "a", "values": "va"}), "a").join(sets.withColumnsRenamed({"node": "b", "values": "vb"}), "b")
    shared = F.size(F.array_intersect("va", "vb")).cast("long")
    return both.select("a", "b", "n", "m", (100 * shared - percent * (F.col("n") + F.col("m") - shared)).alias("margin"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 64, least: int = 28) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, first_key, kept) per row; ``key`` is xxhash64 of the text.

    A component's first text is (component_id, first_key): an id with several texts may be first in several components.
    """
    stage = Stage(docs.sparkSession, "bottom_k", batch_bytes=SMALL_BYTES)
    rows = stage.write(sketches(docs, width, k), "rows")
    known = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = known.groupBy("digest").agg(F.min(F.struct("doc_id", "key")).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # The number of a written row is a shorter name, and as good: it is never computed again.
    classes = stage.write(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    listed = lists(classes, stage, k, percent, least)
    pairs, long = first_pairs(listed, stage, percent)
    links = verified(pairs, classes, docs, stage, "first", width, k, percent, least)
    roots = stage.write(components(links, stage, "first_cc"), "first_roots")
    opened = open_lists(listed, long, roots, stage, "hub")
    if not opened.isEmpty():
        of_node = clusters(opened, stage)
        sets = whole_sets(opened.select("node"), classes, docs, stage, "open", width)
        many = of_node.where("hubs")
        if not many.isEmpty():
            more = hub_links(opened.join(many.select("node"), "node", "left_semi"), sets, stage, percent)
            if not more.isEmpty():
                roots = stage.write(joined_roots(roots, more, stage, "hub"), "hub_roots")
                opened = open_lists(listed, long, roots, stage, "block")
        more = block_links(opened, of_node, sets, roots, stage, percent)
        if not more.isEmpty():
            roots = stage.write(joined_roots(roots, more, stage, "block"), "block_roots")
    ids = classes.select("digest", "node", F.col("rep").alias("first")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = stage.write(ids, "ids")
    least_ids = stage.write(ids.groupBy("root").agg(F.min("first").alias("first")), "least_ids")
    of_text = stage.write(ids.drop("first").join(least_ids, "root").select("digest", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("first_key")), "of_text")
    out = rows.withColumn("digest", F.when(F.col("doc_id").isNotNull(), F.col("digest"))).join(of_text, "digest", "left")
    out = out.select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "first_key")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, with its columns as they are."""
    stage = Stage(docs.sparkSession, "keep_first")
    judged = stage.write(near_duplicates(docs, width, percent).where("first_key is not null"), "judged")  # others stay
    its_id, its_key = free_names(["its_id", "its_key"], docs.columns)
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("key") == F.col("first_key"))
    here = (F.col("doc_id") == F.col(its_id)) & (F.xxhash64("text") == F.col(its_key))
    dropped = judged.where(~first).select(F.col("doc_id").alias(its_id), F.col("key").alias(its_key)).distinct()
    out = docs.join(dropped, here, "left_anti")
    again = judged.where(first).groupBy(F.col("doc_id").alias(its_id), F.col("key").alias(its_key)).agg(F.count("*").alias("n")).where("n > 1").select(its_id, its_key)
    again = stage.write(again, "again")
    if again.isEmpty():
        return out
    once = out.join(again, here, "left_semi").withColumn(its_key, F.xxhash64("text")).dropDuplicates(["doc_id", its_key]).drop(its_key)
    return out.join(again, here, "left_anti").unionByName(once)


def op6_bottomk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4).drop("key", "first_key")
