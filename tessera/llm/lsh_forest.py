"""MinHash near-dedup by an LSH forest (operator 12).

Links texts whose sets of distinct word n-grams have a Jaccard similarity of
at least ``percent`` / 100, confirmed on the full sets, and returns every
document's component. Equal sets form one class; all work is on classes.

1. Signatures: ``TREES`` * ``DEPTH`` min-hashes per class. A tree of the
   forest orders the classes by its own ``DEPTH`` values, so classes with
   long common prefixes stand together.
2. Regions: a tree's classes with equal first values. A region with up to
   ``REGION`` classes is not cut; a larger one is followed to the next
   value, and so on. So the depth adapts to each region: sparse regions
   stop at one value, where a pair at the threshold meets with probability
   0.85 a tree; in 16 trees it is missed in all with probability 7e-14 (at
   depth three in every tree 2e-7).
3. Marks: within a region one-byte sketches of all min-hashes are compared;
   classes without a partner that agrees in ``AGREE`` of 96 (more than six
   standard deviations below the threshold's mean) leave, and the others
   fall into parts linked by such agreements.
4. Full sets are made only of marked classes and compared inside the parts,
   in three rounds (one tree, two, the others); a part whose classes are all
   in one component by then is not read again. Only links that join two
   components leave a task.
5. A region still larger than ``REGION`` at full depth is cut into blocks,
   which some of its classes visit all; in the end every class outside its
   region's prevailing component visits all its blocks.

Scale: texts are read twice, never shuffled (a bit filter of at most 8 MB
tells marked texts, an exact join follows); regions and parts travel in
chunks of bounded size; counts combine map-side. The filter is the only
broadcast.

Case and words: A-Z lower-cased, words split at white space. Fewer words
than n count as one shingle; empty, blank and null texts have no set and no
links. Equal rows and ids are one class; a component's id is its smallest
non-null doc_id, ``kept`` rows have it (several, if it is repeated; null
equals null). Very long texts are handled whole. Extra columns are ignored.
An empty table gives an empty result. Sets are compared by 64-bit hashes of
their shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text
from tessera.llm._graph import components
from tessera.llm._runs import whole_groups
from tessera.llm._store import small_batches, written
from tessera.llm.jaccard_join import linked, node_of, overlap, sets_of, text_filter

TREES, DEPTH = 16, 6
AGREE = 60  # of TREES * DEPTH
REGION = 256  # classes of a region or block
HUBS, VISITORS = 32, 256  # classes that visit all blocks of a large region; visitors at once
ROUNDS = ((0, 1), (1, 3), (3, TREES))
MULTIPLIERS = np.random.Generator(np.random.PCG64(777)).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
U = np.uint64


def signatures(sets_: list[np.ndarray]) -> np.ndarray:
    """32-bit min-hashes, one row per set (none is empty)."""
    starts = np.cumsum([0] + [len(s) for s in sets_[:-1]])
    every = np.concatenate(sets_)
    out = np.empty((len(sets_), len(MULTIPLIERS)), dtype=np.uint32)
    for j, a in enumerate(MULTIPLIERS):
        out[:, j] = np.minimum.reduceat(every * a, starts) >> U(32)
    return out


def prints(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, _text, n, node, sig) of every document; of classes seen
    before in the same batch without the signature."""
    def run(batches):
        for batch in batches:
            sizes, nodes, new, held, blobs = [], [], {}, 0, []

            def flush():
                for i, s in zip(new, signatures(list(new.values()))):
                    blobs.append((i, s.astype(">u4").tobytes()))
                new.clear()

            seen = set()
            for i, s in enumerate(sets_of(batch.column(2), k)):
                node = node_of(s) if len(s) else None
                sizes.append(len(s))
                nodes.append(node)
                if node is not None and node not in seen:
                    seen.add(node)
                    new[i] = s
                    held += len(s)
                    if held > 1 << 18:
                        flush()
                        held = 0
            if new:
                flush()
            sig = [None] * len(sizes)
            for i, b in blobs:
                sig[i] = b
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sig, pa.binary())],
                                             names=["doc_id", "_text", "n", "node", "sig"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_text"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, _text long, n long, node long, sig binary")


def regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, region, node, size) of all regions with several classes: those
    with up to ``REGION``, and the larger ones at full depth."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    rows = classes.select("node", "sig", tree.alias("tree")).select(
        "node", "tree", F.substring("sig", F.col("tree") * (4 * DEPTH) + 1, F.lit(4 * DEPTH)).alias("label"))
    found = []
    for depth in range(1, DEPTH + 1):
        rows = rows.withColumn("region", F.xxhash64("tree", F.lit(depth), F.substring("label", 1, 4 * depth)))
        sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        rows = written(rows.join(sizes, "region").select("tree", "region", "node", "size", "label"), "forest-regions")
        found.append(rows.filter(F.col("size") <= REGION).drop("label"))
        rows = rows.filter(F.col("size") > REGION)
        if depth < DEPTH:
            rows = rows.drop("region", "size")
    small = found[0]
    for f in found[1:]:
        small = small.unionByName(f)
    return small, rows.drop("label")


def in_blocks(large: DataFrame, guests) -> DataFrame:
    """The rows of large regions by block: every class in its own, ``guests``
    (a condition) in all others too."""
    blocks = F.expr(f"cast((size + {REGION - 1}) div {REGION} AS int)")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = large.withColumn("own", own).withColumn("_b", F.explode(F.when(guests, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))))
    return rows.withColumn("region", F.xxhash64("region", "_b")).withColumn("own", F.col("own") == F.col("_b")).drop("_b")


def find(root: list[int], x: int) -> int:
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


def marked(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(tree, region, part, node, own) of the classes with a likely partner
    in their region; likely partners are in one part."""
    sketch = F.transform(F.sequence(F.lit(0), F.lit(TREES * DEPTH - 1)), lambda i: F.substring("sig", i * 4 + 4, F.lit(1)))
    light = classes.select("node", "n", F.concat(*[sketch[i] for i in range(TREES * DEPTH)]).alias("sketch"))

    def run(batches):
        for t, starts in whole_groups(batches, ["region"], 1 << 15, 8 << 20):
            sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(t.num_rows, -1)
            n = t.column("n").to_numpy()
            own = t.column("own").to_numpy(zero_copy_only=False)
            keep, part = [], []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows]):
                if b - a == 1:
                    continue
                s, m, o = sk[a:b], n[a:b], own[a:b]
                near = np.empty((b - a, b - a), dtype=bool)
                for i in range(0, b - a, 64):
                    near[i:i + 64] = (s[i:i + 64, None, :] == s[None, :, :]).sum(axis=2) >= AGREE
                near &= np.minimum(m[:, None], m) * 100 >= percent * np.maximum(m[:, None], m)
                near &= o[:, None] | o
                x, y = np.nonzero(np.triu(near, 1))
                if not len(x):
                    continue
                root = list(range(b - a))
                for i, j in zip(x.tolist(), y.tolist()):
                    i, j = find(root, i), find(root, j)
                    root[max(i, j)] = min(i, j)
                used = np.unique(np.concatenate([x, y]))
                keep.append(used + a)
                part += [find(root, i) for i in used.tolist()]
            if keep:
                out = t.select(["tree", "region", "node", "own"]).take(pa.array(np.concatenate(keep)))
                yield from out.append_column("part", pa.array(part, pa.int32())).combine_chunks().to_batches()

    met = (rows.join(light, "node").repartition("region").sortWithinPartitions("region")
           .select("tree", "region", "node", "own", "n", "sketch"))
    return met.mapInArrow(run, "tree int, region long, node long, own boolean, part int")


def full_sets(docs: DataFrame, k: int, nodes: DataFrame) -> DataFrame:
    """(node, set) of the classes ``nodes`` (node, _text)."""
    passing = docs.sparkSession.sparkContext.broadcast(text_filter(nodes, nodes.count()))

    def run(batches):
        for batch in batches:
            bits = passing.value
            p = batch.column(0).to_numpy(zero_copy_only=False) & np.int64(len(bits) * 64 - 1)
            texts = batch.column(1).filter(pa.array((bits[p >> 6] >> (p & 63)) & 1 == 1))
            got = {}
            for s in sets_of(texts, k):
                if len(s):
                    got.setdefault(node_of(s), s)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int64()), pa.array([s.tobytes() for s in got.values()], pa.binary())], names=["node", "set"])

    rows = docs.select(F.xxhash64("text").alias("_text"), F.col("text").cast("string").alias("text")).mapInArrow(run, "node long, set binary")
    return rows.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def links(rows: DataFrame, sets_: DataFrame, percent: int) -> DataFrame:
    """(a, b): confirmed links that join components inside the groups of
    ``rows`` (region, part, node, own, comp); visitors are not compared with
    each other."""
    def run(batches):
        for t, starts in whole_groups(batches, ["region", "part"], 4096, 16 << 20):
            nodes, comps = t.column("node").to_pylist(), t.column("comp").to_pylist()
            own, blobs = t.column("own").to_pylist(), t.column("set").combine_chunks()
            pairs = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), t.num_rows]):
                first: dict[int, int] = {}
                root = [first.setdefault(c, i) for i, c in enumerate(comps[a:b])]
                if len(first) < 2:
                    continue
                s = [np.frombuffer(x.as_buffer(), np.uint64) for x in blobs[a:b]]
                order = sorted(range(b - a), key=lambda i: (len(s[i]), nodes[a + i]))
                for i, x in enumerate(order):
                    for y in order[i + 1:]:
                        if len(s[x]) * 100 < percent * len(s[y]):
                            break
                        if (own[a + x] or own[a + y]) and find(root, x) != find(root, y) and linked(overlap(s[x], s[y]), len(s[x]), len(s[y]), percent):
                            root[find(root, y)] = find(root, x)
                            pairs.append((nodes[a + x], nodes[a + y]))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    met = (rows.join(sets_, "node").repartition("region", "part").sortWithinPartitions("region", "part")
           .select("region", "part", "node", "own", "comp", "set"))
    return met.mapInArrow(run, "a long, b long")


def with_comps(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return rows.withColumn("comp", F.col("node"))
    return rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def mixed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of groups with several components."""
    several = rows.groupBy(*keys).agg(F.min("comp").alias("_a"), F.max("comp").alias("_z")).filter("_a <> _z").select(*keys)
    return rows.join(several, keys, "left_semi")


def last_visits(large: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Rows by which every class outside its region's prevailing component
    meets all classes of the region, in lots of bounded size."""
    rows = mixed(with_comps(large, comps), ["region"])
    per = rows.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("_n"))
    major = per.groupBy("region").agg(F.max(F.struct("_n", "comp")).alias("_m"), F.sum("_n").alias("_c"))
    major = major.select("region", F.col("_m.comp").alias("_major"), (F.col("_c") - F.col("_m._n")).alias("_out"))
    rows = in_blocks(rows.join(major, "region"), F.col("comp") != F.col("_major"))
    lots = F.expr(f"cast((_out + {VISITORS - 1}) div {VISITORS} AS int)")
    lot = F.when(F.col("own"), F.sequence(F.lit(0), lots - 1)).otherwise(F.array(F.pmod(F.xxhash64("node", F.lit(2)), lots).cast("int")))
    return rows.withColumn("part", F.explode(lot)).select("region", "part", "node", "own", "comp")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    rows = written(prints(docs, k), "forest-prints")
    own = rows.select("doc_id", "n", "node")
    classes = rows.filter("sig IS NOT NULL").dropDuplicates(["node"]).select("node", "n", "_text", "sig")
    classes = written(classes, "forest-classes")
    small, large = regions(classes)
    hub = F.pmod(F.xxhash64("node", F.lit(1)), F.expr(f"(size + {HUBS - 1}) div {HUBS}")) == 0
    groups = small.withColumn("own", F.lit(True)).unionByName(in_blocks(large, hub))
    marks = written(marked(groups.drop("size"), classes, percent), "forest-marks")
    wanted = marks.select("node").unionByName(large.select("node")).distinct()
    wanted = written(classes.select("node", "_text").join(wanted, "node", "left_semi"), "forest-wanted")
    sets_ = written(full_sets(docs, k, wanted), "forest-sets")
    comps, found = None, None

    def joined(groups: DataFrame):
        nonlocal comps, found
        new = written(links(groups, sets_, percent), "forest-links")
        if new.limit(1).count():
            found = new if found is None else found.unionByName(new)
            comps = components(found)

    for a, b in ROUNDS:
        part = with_comps(marks.filter((F.col("tree") >= a) & (F.col("tree") < b)), comps)
        joined(mixed(part, ["region", "part"]).drop("tree"))
    if large.limit(1).count():
        joined(last_visits(large, comps))
    least = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("_least"))
    least = written(with_comps(least, comps), "forest-components")
    ids = least.groupBy("comp").agg(F.min("_least").alias("component_id"))
    table = least.join(ids, "comp").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (own.join(table, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
