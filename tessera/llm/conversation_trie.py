"""Conversation prefix trie (operator 13).

Conversations that begin with the same turns share work (a prefix cache, a
training example tree). Every distinct sequence of first turns is a node;
this operator returns all nodes with what they save.

1. Dictionary: every distinct (role, text) gets a number, in the order of
   its SHA-256; from here on a turn is a number and a length, a conversation
   an array of them. Conversations with equal sequences are one row with the
   number of members.
2. Shards: sequences are range-partitioned in their own order, so a shard is
   a run of neighbours and a subtree is cut only along the paths of a
   shard's first and last sequence.
3. In a shard sequences go into a ternary search tree, the median first,
   then the medians of both halves, which keeps it balanced. One iterative
   pass (children before parents) adds members, leaves and savings up. Nodes
   off the two border paths are complete and leave the task.
4. Border paths, with what their complete children added, are the sequences
   of the next pass, which merges 64 shards at a time; after the last pass
   no border is left. Nodes whose parent lay on a border get its name by a
   join on the path's digest.

Scale: texts are read once and never shuffled (only digests and numbers
are); equal turns and equal sequences combine map-side; border rows are two
per shard. The list of a node's ends is joined in buckets of 64 and 4,096
ids before one task streams its digest, so a node's ids are never all in
memory. One conversation's numbers (20 bytes a turn) must fit in a row.

Case and order: turns are ordered by turn (null first), ties by the turn's
SHA-256. Null roles and texts are empty. Rows without conv_id are left out.
Repeated rows are repeated turns. Negative ids: c % 100 has the sign of c.
An empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._store import written

FAN = 64  # shards that one merge takes together
SHARD = 200_000  # turns per shard, about
DEEP = 64  # turns that decide a sequence's shard
HEAD = 5  # most turns that a conversation takes from another
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = ("depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, key string, parent_key string")
PATH = ("shard long, ids array<long>, chars array<int>, n long, least long, ends string, members array<long>, firsts array<long>, "
        "kids array<long>, leaves array<long>, saved array<long>, digests array<string>")


def coded_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, chars) of every turn with a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("_sha"),
        F.char_length(text).alias("chars"))
    turns = written(turns, "trie-turns")
    book = turns.groupBy("_sha").agg(F.max("chars").alias("chars")).orderBy("_sha").withColumn("id", F.monotonically_increasing_id())
    return turns.drop("chars").join(written(book, "trie-dictionary"), "_sha").select("conv_id", "turn", "id", "chars")


def rebuilt(turns: DataFrame, heads: Column, every: int = 100) -> DataFrame:
    """(conv_id, ids, chars): the first ``heads`` turns of conversation
    c - c % every, then c's own turns after as many."""
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "chars"))).alias("_own"))
    own = written(own, "trie-own")
    first = own.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.slice("_own", 1, HEAD).alias("_head"))
    base = F.col("conv_id") - F.col("conv_id") % every
    got = own.withColumn("_base", base).withColumn("_h", heads.cast("int")).join(first, "_base", "left")
    seq = F.concat(F.coalesce(F.slice("_head", 1, F.col("_h")), F.slice("_own", 1, 0)), F.slice("_own", F.col("_h") + 1, F.size("_own")))
    return got.withColumn("_seq", seq).select("conv_id", F.col("_seq.id").alias("ids"), F.col("_seq.chars").alias("chars"))


def id_list_digests(members: DataFrame) -> DataFrame:
    """(seq, ends): SHA-256 of each group's conv_ids in decimal, ascending,
    joined by commas."""
    def joined(df: DataFrame, order: str, value: Column) -> DataFrame:
        parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), value.alias("_v")))), lambda x: x["_v"])
        return df.groupBy("seq", F.shiftright(F.col(order), 6).alias("_b")).agg(F.array_join(parts, ",").alias("_part"))

    small = joined(members, "conv_id", F.col("conv_id").cast("string")).withColumnRenamed("_b", "_c")
    large = joined(small, "_c", F.col("_part"))

    def stream(batches):
        at, state = None, None
        for batch in batches:
            seqs, out = batch.column(0).to_pylist(), []
            for seq, part in zip(seqs, batch.column(1).to_pylist()):
                if seq == at:
                    state.update(b",")
                else:
                    if at is not None:
                        out.append((at, state.hexdigest()))
                    at, state = seq, hashlib.sha256()
                state.update(part.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in (0, 1)], names=["seq", "ends"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([state.hexdigest()])], names=["seq", "ends"])

    return large.repartition("seq").sortWithinPartitions("seq", "_b").select("seq", "_part").mapInArrow(stream, "seq string, ends string")


class Trie:
    """A ternary search tree of number sequences. Every entry is a node of
    the trie: ``lo`` and ``hi`` lead to its siblings, ``eq`` to a child."""

    def __init__(self):
        self.turn, self.lo, self.hi, self.eq = [-1], [-1], [-1], [-1]
        self.parent, self.depth, self.chars = [-1], [0], [0]
        self.members, self.first, self.kids, self.leaves, self.saved, self.ends = [0], [None], [0], [0], [0], [None]

    def _new(self, parent: int, turn: int, chars: int) -> int:
        for column, value in ((self.turn, turn), (self.lo, -1), (self.hi, -1), (self.eq, -1), (self.parent, parent),
                              (self.depth, self.depth[parent] + 1), (self.chars, chars), (self.members, 0), (self.first, None),
                              (self.kids, 0), (self.leaves, 0), (self.saved, 0), (self.ends, None)):
            column.append(value)
        return len(self.turn) - 1

    def path(self, ids: list[int], chars: list[int]) -> list[int]:
        """The nodes of a sequence, the root first; missing ones are made."""
        at, nodes = 0, [0]
        for turn, n in zip(ids, chars):
            parent, at = at, self.eq[at]
            if at < 0:
                at = self.eq[parent] = self._new(parent, turn, n)
            while self.turn[at] != turn:
                side = self.lo if turn < self.turn[at] else self.hi
                if side[at] < 0:
                    side[at] = self._new(parent, turn, n)
                at = side[at]
            nodes.append(at)
        return nodes

    def meet(self, node: int, conv_id: int | None):
        if conv_id is not None and (self.first[node] is None or conv_id < self.first[node]):
            self.first[node] = conv_id

    def add(self, row: dict) -> None:
        """A sequence with its members, or a border path with what its nodes
        have gathered so far."""
        nodes = self.path(row["ids"], row["chars"])
        if row["members"] is None:
            last = nodes[-1]
            self.members[last] += row["n"]
            self.meet(last, row["least"])
            self.ends[last] = row["ends"]
            return
        for i, node in enumerate(nodes):
            self.members[node] += row["members"][i]
            self.kids[node] += row["kids"][i]
            self.leaves[node] += row["leaves"][i]
            self.saved[node] += row["saved"][i]
            self.meet(node, row["firsts"][i])
            self.ends[node] = self.ends[node] or row["digests"][i]

    def gather(self, border: set[int]) -> None:
        """Adds every node that is not on the border to its parent; entries
        are made after their parents, so going back meets children first."""
        for i in range(len(self.turn) - 1, -1, -1):
            up = self.parent[i]
            if up >= 0:
                self.meet(up, self.first[i])
            if i in border:
                continue
            if not self.kids[i]:
                self.leaves[i] = 1
            self.saved[i] += (self.members[i] - 1) * self.chars[i]
            if up >= 0:
                self.members[up] += self.members[i]
                self.kids[up] += 1
                self.leaves[up] += self.leaves[i]
                self.saved[up] += self.saved[i]


def by_medians(n: int):
    """0 .. n-1, the middle first, then the middles of both halves, and so on."""
    spans = [(0, n)]
    for a, b in spans:
        if a < b:
            m = (a + b) // 2
            yield m
            spans += [(a, m), (m + 1, b)]


def path_keys(ids: list[int]) -> list[str]:
    state = hashlib.blake2b(digest_size=16)
    keys = [state.hexdigest()]
    for x in ids:
        state.update(x.to_bytes(8, "little", signed=True))
        keys.append(state.hexdigest())
    return keys


def shard_nodes(rows: list[dict], last: bool, named: bool) -> tuple[list[dict], list[dict]]:
    """(complete nodes, border paths) of one shard's rows in order. ``last``:
    the shard is the whole trie, nothing is left open. ``named``: nodes were
    on a border before, so others may ask for them by key."""
    trie = Trie()
    for m in by_medians(len(rows)):
        trie.add(rows[m])
    ends = [] if last else [rows[0]] + [rows[-1]] * (len(rows) > 1)
    paths = [trie.path(r["ids"], r["chars"]) for r in ends]
    border = {x for p in paths for x in p}
    trie.gather(border)
    keys: dict[int, str] = {}
    for r, nodes in zip(ends, paths):
        keys.update(zip(nodes, path_keys(r["ids"])))
    if named:
        for r in rows:
            keys.update(zip(trie.path(r["ids"], r["chars"]), path_keys(r["ids"])))
    done = []
    for i in range(len(trie.turn)):
        if i in border:
            continue
        up = trie.parent[i]
        open_ = up in border
        done.append({"depth": trie.depth[i], "conv_id": trie.first[i], "parent_conv_id": None if up < 0 or open_ else trie.first[up],
                     "n_convs": trie.members[i], "n_children": trie.kids[i], "n_leaves": trie.leaves[i], "saved_tokens": trie.saved[i],
                     "ends_sha256": trie.ends[i] or EMPTY, "key": keys.get(i) if named else None, "parent_key": keys[up] if open_ else None})
    out, told = [], set()
    for r, nodes in zip(ends, paths):
        mine = [x not in told for x in nodes]  # what both paths share goes with the first
        told.update(nodes)
        out.append({"ids": r["ids"], "chars": r["chars"], "n": 0, "firsts": [trie.first[x] for x in nodes],
                    "digests": [trie.ends[x] if own else None for x, own in zip(nodes, mine)],
                    **{name: [getattr(trie, name)[x] if own else 0 for x, own in zip(nodes, mine)] for name in ("members", "kids", "leaves", "saved")}})
    return done, out


def merge_shards(paths: DataFrame, last: bool, named: bool) -> DataFrame:
    """Nodes (shard null) and border paths (shard set) of all shards; rows of
    a shard follow each other, in order."""
    kinds = paths.sparkSession.createDataFrame([], f"{PATH}, {NODE}").schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(kinds)

    def run(batches):
        def result(shard, rows):
            done, out = shard_nodes(rows, last, named)
            for i in range(0, len(done), 10_000):
                yield pa.RecordBatch.from_pylist(done[i:i + 10_000], schema=arrow)
            for r in out:
                yield pa.RecordBatch.from_pylist([{**r, "shard": shard // FAN}], schema=arrow)

        at, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if rows and r["shard"] != at:
                    yield from result(at, rows)
                    rows = []
                at = r["shard"]
                rows.append(r)
        if rows:
            yield from result(at, rows)

    return paths.mapInArrow(run, kinds)


def prefix_trie(conversations: DataFrame, heads: Column | None = None) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. ``heads``: how
    many first turns a conversation takes from conversation c - c % 100 (at
    most 5; unless given, crc32 of its decimal id modulo 6)."""
    spark = conversations.sparkSession
    heads = F.crc32(F.col("conv_id").cast("string")) % 6 if heads is None else heads
    seqs = rebuilt(coded_turns(conversations), heads)
    seqs = written(seqs.withColumn("seq", F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)), "trie-sequences")
    groups = seqs.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    rows = (groups.join(id_list_digests(seqs.select("seq", "conv_id")), "seq")
            .join(seqs.select(F.col("conv_id").alias("least"), "ids", "chars"), "least").select("ids", "chars", "n", "least", "ends"))
    rows = written(rows, "trie-distinct")
    turns = rows.agg(F.sum(F.size("ids") + 1)).first()[0]
    fields = spark.createDataFrame([], PATH).schema
    if not turns:
        return spark.createDataFrame([], NODE).drop("key", "parent_key")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD))
    paths = rows.repartitionByRange(shards, F.slice("ids", 1, DEEP)).sortWithinPartitions("ids")
    paths = paths.withColumn("shard", F.spark_partition_id().cast("long"))
    paths = paths.select(*[F.col(f.name) if f.name in paths.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    nodes, last, named = None, False, False
    while True:
        out = written(merge_shards(paths, last, named), "trie-pass")
        done = out.filter("shard IS NULL").select(*[c.split()[0] for c in NODE.split(", ")])
        nodes = done if nodes is None else nodes.unionByName(done)
        if last:
            break
        shards = out.agg(F.max("shard")).first()[0] + 1
        last, named = shards == 1, True
        paths = (out.filter("shard IS NOT NULL").select(*fields.names).repartition(shards, "shard")
                 .sortWithinPartitions("shard", "ids"))
    names = nodes.filter("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_name"))
    return (nodes.join(names, "parent_key", "left")
            .select("conv_id", "depth", F.coalesce("parent_conv_id", "_name").alias("parent_conv_id"), "n_convs", "n_children",
                    "n_leaves", "saved_tokens", "ends_sha256"))
