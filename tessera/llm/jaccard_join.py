"""N-gram Jaccard join by T-occurrence search (operator 4).

Links texts whose sets of distinct word n-grams have a Jaccard similarity of
at least ``percent`` / 100 and returns every document's component.

Equal sets form one class; what follows works on classes. A set of n
shingles shares at least T = ceil(n * percent / 100) with any partner.
Shingles are ordered by frequency (a counting sketch of fixed size over all
documents): the ``T - l`` most frequent ones are a set's long lists, the
others its short lists. By the prefix principle two linked sets share at
least l short lists (l grows with n), so only short lists are indexed, and
only those with two classes go on.

1. Classes that share short lists are first linked within groups of equal
   min-hashes: blocks of bounded size, each compared with itself and with
   the group's hub block. This joins large groups of near copies without
   comparing all their pairs. Classes outside a group's prevailing component
   then visit all its blocks, which settles the group exactly.
2. The search then covers what is left, exactly: short lists that still hold
   several components are merged per query class (heap merge by counting).
   Candidates of a fitting size are kept if their shared short lists and
   all long lists of one of them could make the overlap that a link needs;
   they are settled by binary probing of the
   sorted sets. Only classes of larger components are met, so a pair's
   lists are all counted in the query of the smaller one's class.
3. Connected components by joins. Links are given between components found
   so far, so that every step's graph has only its own links.

Scale: texts are read, not shuffled (only ``one_per_group`` joins the
documents to the rows that stay); short lists are computed twice
rather than stored; full sets are made only of classes with enough shared
lists (a bit filter of at most 8 MB tells their texts, an exact join
follows); lists travel in chunks, groups in blocks of bounded size. Sketch
and filter are the only broadcasts.

Case and words: A-Z lower-cased, words split at white space. Fewer words
than n count as one shingle; empty, blank and null texts have no set and no
links. Equal rows and ids are one class; a component's id is its smallest
non-null doc_id. Very long texts are handled whole. Extra columns are
ignored. An empty table gives an empty result. Sets are compared by 64-bit
hashes of their shingles.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text
from tessera.llm._graph import components
from tessera.llm._store import frugal, safely_named, small_batches, written

SKETCH_BITS = 20
CHUNK_BITS = 16  # counters per row of a partial sketch
SIGNATURES = 2
GROUP, HUBS, VISITORS = 96, 48, 256  # classes per block, in the hub block, visiting at once
FILTER_BITS = 26  # of the filter of texts, at most
LIST_CHUNK = 1024
U = np.uint64


def required(n, percent: int):
    """T: the least overlap of a set of n shingles with any partner."""
    return -(-n * percent // 100)


def matches(n):
    """l: the short lists that two linked sets share at least (of the smaller l)."""
    return 1 + n // 32


def long_lists(n, percent: int):
    return np.maximum(0, required(n, percent) - matches(n))


def least_shared(a, b, percent: int):
    """The short lists that linked sets of sizes a and b share at least. Of
    the set whose short lists end first in the order, all shared shingles up
    to there are short lists of both; the others are its long lists."""
    return np.maximum(matches(np.minimum(a, b)), -(-percent * (a + b) // (100 + percent)) - np.maximum(long_lists(a, percent), long_lists(b, percent)))


def linked(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


def node_of(s: np.ndarray) -> int:
    """The class of a set: 64 bits of a cryptographic hash."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def sets_of(texts: pa.Array, k: int):
    """The sorted distinct shingles of every text of a batch."""
    for _, data, offsets in _text.slices(texts):
        w = _text.Words(data, offsets)
        yield from _text.row_sets(w, w.hashes(), k)


def prints(docs: DataFrame, k: int) -> DataFrame:
    """One row per document (doc_id, _text = hash of the text, n, node) and
    rows of partial sketches (chunk, counts)."""
    schema = "doc_id long, _text long, n long, node long, chunk int, counts binary"

    @frugal
    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        mask = U((1 << SKETCH_BITS) - 1)
        for batch in batches:
            sizes, nodes, pending, held = [], [], [], 0
            for s in sets_of(batch.column(2), k):
                sizes.append(len(s))
                nodes.append(node_of(s) if len(s) else None)
                pending.append(s & mask)
                held += len(s)
                if held > 1 << 20:
                    sketch += np.bincount(np.concatenate(pending).astype(np.int64), minlength=len(sketch))
                    pending, held = [], 0
            if pending:
                sketch += np.bincount(np.concatenate(pending).astype(np.int64), minlength=len(sketch))
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=["doc_id", "_text", "n", "node", "chunk", "counts"])
        if sketch.any():
            parts = sketch.reshape(-1, 1 << CHUNK_BITS)
            kind = np.uint16 if sketch.max() < 1 << 16 else np.int64
            width = b"2" if kind is np.uint16 else b"8"
            blobs = [width + x.astype(kind).tobytes() for x in parts]
            none = pa.nulls(len(blobs), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(range(len(blobs)), pa.int32()), pa.array(blobs, pa.binary())],
                                             names=["doc_id", "_text", "n", "node", "chunk", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def sketch_of(rows: DataFrame) -> np.ndarray:
    """The sum of the partial sketches (fixed size, 8 MB)."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK_BITS, dtype=np.int64)
        for b in pdf["counts"]:
            total += np.frombuffer(b[1:], np.uint16 if b[:1] == b"2" else np.int64)
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "counts": [total.tobytes()]})

    salted = rows.filter("chunk IS NOT NULL").select("chunk", "counts", F.pmod(F.xxhash64("counts"), F.lit(16)).alias("_salt"))
    some = salted.groupBy("chunk", "_salt").applyInPandas(
        lambda p: add(p).assign(counts=lambda x: [b"8" + c for c in x["counts"]]), "chunk int, counts binary")
    out = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS), dtype=np.int64)
    for r in some.groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect():
        out[r["chunk"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(-1)


def short_lists(docs: DataFrame, k: int, percent: int, sketch) -> DataFrame:
    """(shingle, node) of every set's short lists. Sets so small that no
    other set can reach the similarity have none."""
    @frugal
    def run(batches):
        order = sketch.value
        mask = U((1 << SKETCH_BITS) - 1)
        for batch in batches:
            seen: dict[int, np.ndarray] = {}
            for s in sets_of(batch.column(0), k):
                n = len(s)
                if 100 * n < percent * (n + 1):
                    continue
                node = node_of(s)
                if node in seen:
                    continue
                keep = n - int(long_lists(n, percent))
                rank = order[(s & mask).astype(np.int64)]
                seen[node] = s[np.lexsort((s, rank))[:keep]] if keep < n else s
            if seen:
                size = [len(x) for x in seen.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(list(seen.values())).view(np.int64)),
                     pa.array(np.repeat(np.array(list(seen), dtype=np.int64), size))], names=["shingle", "node"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "shingle long, node long")


def text_filter(texts: DataFrame, n: int) -> np.ndarray:
    """Bits of the hashes in column _text: 16 per text, 2**FILTER_BITS at
    most (more texts only make it less selective)."""
    bits = min(FILTER_BITS, max(10, (16 * n - 1).bit_length()))
    words = (texts.select(F.pmod("_text", F.lit(1 << bits)).alias("_p"))
             .groupBy(F.expr("_p div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_p % 64 AS int))")).alias("bits")).toPandas())
    out = np.zeros((1 << bits) // 64, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out


def full_sets(docs: DataFrame, k: int, passing=None) -> DataFrame:
    """(node, n, set, sig0 ..) of the documents' classes; with a broadcast
    filter only of texts that may be in it."""
    schema = "node long, n int, set binary, " + ", ".join(f"sig{i} long" for i in range(SIGNATURES))

    @frugal
    def run(batches):
        for batch in batches:
            if passing is not None:
                bits = passing.value
                p = batch.column(0).to_numpy(zero_copy_only=False) & np.int64(len(bits) * 64 - 1)
                batch = batch.filter(pa.array((bits[p >> 6] >> (p & 63)) & 1 == 1))
            got = {}
            for s in sets_of(batch.column(1), k):
                if len(s):
                    got.setdefault(node_of(s), s)
            if got:
                sig = [[int(_text.mix(s ^ U(0x51ED27 + 977 * i)).min().view(np.int64)) for s in got.values()] for i in range(SIGNATURES)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(got), pa.int64()), pa.array([len(s) for s in got.values()], pa.int32()),
                     pa.array([s.tobytes() for s in got.values()], pa.binary()), *[pa.array(x, pa.int64()) for x in sig]],
                    names=["node", "n", "set", *[f"sig{i}" for i in range(SIGNATURES)]])

    return docs.select(F.xxhash64("text").alias("_text"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common shingles: the smaller set is probed in the larger, sorted one."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def compare(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links (a, b) between components, from the smallest one to each other
    that the classes of one block join to it; of two visitors (own is false)
    nobody takes care here."""
    pdf = pdf.sort_values("own", ascending=False).drop_duplicates("node")
    own = pdf["own"].tolist()
    sets_ = [np.frombuffer(x, np.uint64) for x in pdf["set"]]
    first: dict[int, int] = {}
    root = [first.setdefault(c, i) for i, c in enumerate(pdf["comp"].tolist())]

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    order = sorted(range(len(own)), key=lambda i: len(sets_[i]))
    for i, x in enumerate(order):
        for y in order[i + 1:]:
            if len(sets_[x]) * 100 < percent * len(sets_[y]):
                break
            if (own[x] or own[y]) and find(x) != find(y) and linked(overlap(sets_[x], sets_[y]), len(sets_[x]), len(sets_[y]), percent):
                root[find(y)] = find(x)
    top: dict[int, int] = {}
    for c, i in first.items():
        top[find(i)] = min(c, top.get(find(i), c))
    return pd.DataFrame([(top[find(i)], c) for c, i in first.items() if c != top[find(i)]], columns=["a", "b"], dtype="int64")


def group_links(sets: DataFrame, comps: DataFrame | None, key: str, percent: int, whole: bool) -> DataFrame:
    """Links between components (``comps``: node, comp; a class that is not
    there is its own) inside the groups of one min-hash. Groups are cut into
    blocks; the hub classes of a group, or (``whole``) all outside its
    prevailing component, visit every block."""
    member = sets.select(F.col(key).alias("key"), "node")
    if comps is not None:
        member = member.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    else:
        member = member.withColumn("comp", F.col("node"))
    per = member.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("_n"))
    mixed = (per.groupBy("key").agg(F.sum("_n").alias("_c"), F.max(F.struct("_n", "comp")).alias("_m"), F.count(F.lit(1)).alias("_k"))
             .filter("_k > 1").select("key", "_c", F.col("_m.comp").alias("_major"), (F.col("_c") - F.col("_m._n")).alias("_out")))
    member = member.join(mixed, "key")
    blocks = F.expr(f"cast((_c + {GROUP - 1}) div {GROUP} AS int)")
    if whole:
        visits, lots = F.col("comp") != F.col("_major"), F.expr(f"cast((_out + {VISITORS - 1}) div {VISITORS} AS int)")
    else:
        visits, lots = F.pmod(F.xxhash64("node", F.lit(1)), F.expr(f"(_c + {HUBS - 1}) div {HUBS}")) == 0, F.lit(1)
    own = (member.withColumn("_block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
           .withColumn("_lot", F.explode(F.sequence(F.lit(0), lots - 1))).withColumn("own", F.lit(True)))
    guest = (member.filter((F.col("_c") > GROUP) & visits).withColumn("_lot", F.pmod(F.xxhash64("node", F.lit(2)), lots).cast("int"))
             .withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("own", F.lit(False)))
    if whole:
        own = own.filter(F.col("_c") > GROUP)
    rows = own.unionByName(guest).select("key", "_block", "_lot", "own", "node", "comp").join(sets.select("node", "set"), "node")
    return rows.groupBy("key", "_block", "_lot").applyInPandas(lambda pdf: compare(pdf, percent), "a long, b long")


def candidates(lists: DataFrame, percent: int, ordered: bool = False) -> DataFrame:
    """Pairs (a, b) of classes in different components that share enough
    short lists. ``lists``: (shingle, node, n, comp and, if known, size =
    classes of the component); ``ordered`` if they are all lists of
    ``short_lists`` with two classes, so that what a set has besides comes
    later in the order. Of two components the smaller one (then that of the
    smaller id) asks, in all lists they share, so one query counts all shared
    lists of a pair."""
    order = F.struct(*[c for c in ("size", "comp") if c in lists.columns])  # sizes only save queries
    mixed = (lists.groupBy("shingle").agg(F.max(order).alias("_top"), F.min(order).alias("_low"), F.count(F.lit(1)).alias("_len"))
             .filter("_top <> _low").select("shingle", "_top", "_len"))
    rows = written(lists.join(mixed, "shingle").withColumn("_asks", order < F.col("_top")).drop("_top"), "jaccard-mixed")
    longest = rows.agg(F.max("_len")).first()[0] or 0
    chunk = F.pmod(F.xxhash64("node"), F.lit(max(1, -(-longest // LIST_CHUNK))))
    packed = rows.groupBy("shingle", chunk.alias("_chunk")).agg(
        F.collect_list(F.struct(order.alias("order"), "node", "n")).alias("_list"), F.max(order).alias("_top"))
    query = rows.filter("_asks").select("shingle", order.alias("_order"), F.col("node").alias("q"), F.col("n").alias("qn"))
    fits = lambda n: (n * 100 >= F.col("qn") * percent) & (n * percent <= F.col("qn") * 100)
    met = (query.join(packed, "shingle").filter(F.col("_order") < F.col("_top"))
           .withColumn("_list", F.filter("_list", lambda x: fits(x["n"].cast("long")) & (x["order"] > F.col("_order")))).filter(F.size("_list") > 0)
           .select("q", "qn", "_chunk", F.col("_list.node").alias("l_node"), F.col("_list.n").alias("l_n")))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        q, qn = int(pdf["q"].iloc[0]), int(pdf["qn"].iloc[0])
        node, at, times = np.unique(np.concatenate(pdf["l_node"].to_list()), return_index=True, return_counts=True)
        n = np.concatenate(pdf["l_n"].to_list())[at].astype(np.int64)
        ok = times >= (least_shared(n, qn, percent) if ordered else matches(np.minimum(n, qn)))
        return pd.DataFrame({"a": np.minimum(node[ok], q), "b": np.maximum(node[ok], q)}, dtype="int64")

    return met.groupBy("q", "_chunk").applyInPandas(merge, "a long, b long")


def settle(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose similarity reaches the threshold."""
    s = sets.select("node", "set")
    both = (pairs.join(s.withColumnsRenamed({"node": "a", "set": "sa"}), "a")
            .join(s.withColumnsRenamed({"node": "b", "set": "sb"}), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(linked(overlap(x, y), len(x), len(y), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after ``links`` (a, b) between components."""
    over = components(links)
    kept = (comps.join(over.select(F.col("comp").alias("_top"), F.col("node").alias("comp")), "comp", "left")
            .select("node", F.coalesce("_top", "comp").alias("comp")))
    return written(kept.unionByName(over.join(comps.select("node"), "node", "left_anti")), "jaccard-comps")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, _text (hash of the text), n_shingles, component_id per row."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    first = written(prints(docs, k), "jaccard-prints")
    rows = first.filter("chunk IS NULL").select("doc_id", "_text", "n", "node")
    sketch = spark.sparkContext.broadcast(sketch_of(first))
    # lists with one row are dropped before rows meet; counts combine map-side
    postings = short_lists(docs, k, percent, sketch)
    several = postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("shingle")
    shared = written(postings.join(several, "shingle").dropDuplicates(["shingle", "node"]), "jaccard-lists")
    several = shared.groupBy("shingle").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("shingle")
    classes = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("_least"), F.min("_text").alias("_text"), F.max("n").alias("n"))
    classes = written(classes, "jaccard-classes")
    active = (shared.join(several, "shingle").groupBy("node").agg(F.count(F.lit(1)).alias("_c")).join(classes, "node")
              .filter(F.col("_c") >= F.expr(f"1 + ((n * {percent} + 99) div 100) div 32")).select("node", "_text"))
    active = written(active, "jaccard-active")
    passing = spark.sparkContext.broadcast(text_filter(active, active.count()))
    sets = full_sets(docs, k, passing).join(active.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = written(sets, "jaccard-sets")
    comps = None
    for whole in (False, True):
        for i in range(SIGNATURES):
            new = written(group_links(sets, comps, f"sig{i}", percent, whole), "jaccard-links")
            if new.limit(1).count():
                comps = components(new) if comps is None else joined(comps, new)
    if comps is None:
        comps = spark.createDataFrame([], "node long, comp long")
    sized = comps.join(comps.groupBy("comp").agg(F.count(F.lit(1)).alias("size")), "comp")
    lists = (shared.join(sets.select("node", "n"), "node").join(sized, "node", "left")
             .withColumn("comp", F.coalesce("comp", "node")).withColumn("size", F.coalesce("size", F.lit(1).cast("long"))))
    pairs = written(candidates(lists, percent, ordered=True), "jaccard-pairs")
    found = written(settle(pairs, sets, percent), "jaccard-found")
    up = comps.select("node", "comp")
    more = (found.join(up.withColumnsRenamed({"node": "a", "comp": "ca"}), "a", "left")
            .join(up.withColumnsRenamed({"node": "b", "comp": "cb"}), "b", "left")
            .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    comps = joined(comps, written(more, "jaccard-more"))
    classes = classes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).select("node", "_least", "comp")
    classes = written(classes, "jaccard-components")
    ids = classes.groupBy("comp").agg(F.min("_least").alias("component_id"))
    table = classes.join(ids, "comp").select("node", "component_id")
    return rows.join(table, "node", "left").select(
        "doc_id", "_text", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("node"), F.lit(0)).alias("_node"))


@safely_named("doc_id", "text")
def one_per_group(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one of each group of linked documents: that with
    the smallest doc_id (then the smallest hash of its text). Documents
    without a set all stay; so do documents of a group without any id, if
    their sets differ."""
    own = written(jaccard_components(docs, k, percent), "jaccard-groups")
    with_set = own.filter("n_shingles > 0")
    group = F.when(F.col("component_id").isNull(), F.col("_node")).otherwise(F.lit(None).cast("long"))
    stay = (with_set.groupBy("component_id", group.alias("_g"))
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("_z"), "doc_id", "_text")).alias("_s"))
            .select(F.col("_s.doc_id").alias("_id"), F.col("_s._text").alias("_t")))
    copies = with_set.groupBy("doc_id", "_text").agg(F.count(F.lit(1)).alias("_n"))
    stay = stay.join(copies, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_t") == F.col("_text"))).select("_id", "_t", "_n")
    none = own.filter("n_shingles = 0").select(F.col("doc_id").alias("_id"), F.col("_text").alias("_t"), F.lit(1).alias("_n")).distinct()
    stay = written(stay.withColumn("_n", F.col("_n").cast("long")).unionByName(none.withColumn("_n", F.col("_n").cast("long"))), "jaccard-stay")
    keyed = docs.withColumn("_h", F.xxhash64("text"))
    got = keyed.join(stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_t")))
    once = got.filter("_n = 1").select(*docs.columns)
    if stay.filter("_n > 1").limit(1).count() == 0:  # no rows that are equal in id and text
        return once
    return once.unionByName(got.filter("_n > 1").dropDuplicates(["_id", "_t"]).select(*docs.columns))
