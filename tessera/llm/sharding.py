"""Sharding by balanced label propagation (operator 8).

Equal texts are linked (a star around a leader; a group larger than a
quarter of a shard gets one leader per quarter, themselves linked). Linked
documents start in an evenly spread shard. In each round a document asks
for the shard most of its neighbours are in (members and leaders take
turns, so two neighbours never swap places); what a group asks for is
granted as a whole while the shard has room, until nothing is granted.
Groups that are together and fit keep their shard; those that are not, or
are too many, fill the shards up with the documents without links, group
after group. The law is ``rows``: counts are at most one apart. Copies end
up together; only groups at a shard's border are cut (one a shard at most).

Scale: one pass over the texts gives narrow rows; a round joins the links
(one per linked document) with the current labels and sums votes per
(document, shard), which combines map-side, so a leader with many copies
is no hot key; grants and slots are running sums over bounded buckets.
Only per-shard counts (one row per shard) reach the driver.

Null texts have 16 bytes, no checksum and no links; empty texts are linked
like other equal texts; repeated rows are separate documents; extra columns
are ignored; very long texts count like others. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._prefix import running_sum
from tessera.llm._store import written

ROUNDS = 40  # at most; usually no request is granted long before
SLACK = 1.15  # shards may be fuller by this factor between rounds
BUCKET = 256


def narrow(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the text's fingerprint and a row number."""
    return written(docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64(F.col("text"), F.octet_length("text"))).alias("_print"),
        F.xxhash64(F.col("doc_id"), F.lit(8)).alias("_key"),
        F.monotonically_increasing_id().alias("_row")), "shard-rows")


def copy_links(rows: DataFrame, share: float) -> DataFrame:
    """(a, b) row numbers of linked equal texts. ``share``: rows of an even
    shard; larger groups are cut into parts of a quarter of it."""
    groups = (rows.filter("_print IS NOT NULL").groupBy("_print", "text_crc32", "size")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")).filter("_n > 1")
              .withColumn("_parts", F.greatest(F.ceil(F.col("_n") / F.lit(max(share / 4, 2.0))), F.lit(1)).cast("long")))
    member = (rows.join(groups, ["_print", "text_crc32", "size"])
              .withColumn("_part", F.pmod(F.col("_key"), F.least("_parts", "_n"))))
    leaders = member.groupBy("_print", "text_crc32", "size", "_part").agg(F.min("_row").alias("_leader"), F.min("_first").alias("_first"))
    to_leader = (member.join(leaders.drop("_first"), ["_print", "text_crc32", "size", "_part"])
                 .select(F.col("_row").alias("a"), F.col("_leader").alias("b"), F.lit(4).alias("w")))
    between = leaders.select(F.col("_leader").alias("a"), F.col("_first").alias("b"), F.lit(1).alias("w"))
    return to_leader.unionByName(between).filter("a <> b")


def loads(nodes: DataFrame) -> dict[int, int]:
    """Documents per shard (one row per shard)."""
    return {x["shard"]: x["count"] for x in nodes.groupBy("shard").count().collect()}


def propagate(nodes: DataFrame, links: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """_row, _key, _leader, _group and shard of the linked ``nodes``. Rounds
    go on until neither members nor leaders are granted anything."""
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")), "shard-links")
    leaders = links.select(F.col("b").alias("_row")).distinct().withColumn("_leads", F.lit(True))
    nodes = written(nodes.join(leaders, "_row", "left").withColumn("_leads", F.coalesce("_leads", F.lit(False))), "shard-nodes")
    fine = F.pmod(F.col("_group"), F.lit(max(1, nodes.count() // BUCKET)))
    quiet = 0
    for r in range(rounds):
        at = nodes.select(F.col("_row").alias("b"), F.col("shard").alias("_to"))
        votes = both.join(at, "b").groupBy(F.col("a").alias("_row"), "_to").agg(F.sum("w").alias("_votes"))
        best = nodes.filter(F.col("_leads") == F.lit(r % 2 == 1)).join(votes, "_row").groupBy("_row", "_leader", "_group", "shard").agg(
            F.max(F.struct(F.col("_votes"), (F.col("_to") == F.col("shard")).alias("_stay"), (-F.col("_to")).alias("_neg"))).alias("_best"),
            F.sum(F.when(F.col("_to") == F.col("shard"), F.col("_votes")).otherwise(0)).alias("_now"))
        best = best.withColumn("_to", -F.col("_best._neg")).withColumn("_ngain", F.col("_now") - F.col("_best._votes"))
        asks = written(best.filter((F.col("_ngain") < 0) & (F.col("_to") != F.col("shard"))).select("_row", "_leader", "_group", "_to"),
                       f"shard-asks{r}")
        load = loads(nodes)
        room = F.array(*[F.lit(max(0, capacity - load.get(s, 0))).cast("long") for s in range(shards)])
        # all of a group that ask for one shard are granted together
        whole = asks.groupBy("_to", "_leader", "_group").agg(F.count(F.lit(1)).alias("_n"))
        granted = running_sum(whole.withColumn("_fine", fine), ["_to"], "_fine", ["_group", "_leader"], F.col("_n"), "_used")
        granted = granted.filter(F.col("_used") + F.col("_n") <= F.element_at(room, F.col("_to") + 1)).select("_leader", "_to")
        moves = written(asks.join(granted, ["_leader", "_to"]).select("_row", F.col("_to").alias("_new")), f"shard-moves{r}")
        quiet = 0 if moves.limit(1).count() else quiet + 1
        if quiet == 2:
            break
        if not quiet:
            nodes = written(nodes.join(moves, "_row", "left").withColumn("shard", F.coalesce("_new", "shard")).drop("_new"), f"shard-round{r}")
    return nodes.select("_row", "_key", "_leader", "_group", "shard")


def shard(docs: DataFrame, shards: int = 40, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all rows."""
    rows = narrow(docs)
    count = rows.count()
    fine = F.pmod(F.col("_key"), F.lit(max(1, count // BUCKET)))
    by_group = F.pmod(F.col("_group"), F.lit(max(1, count // BUCKET)))
    links = written(copy_links(rows, count / shards), "shard-copies")
    linked = links.select(F.col("a").alias("_row")).unionByName(links.select(F.col("b").alias("_row"))).distinct()
    member = links.filter("w = 4").select(F.col("a").alias("_row"), F.col("b").alias("_leader"))
    start = F.pmod(F.xxhash64("_row", F.lit(3)), F.lit(shards)).cast("int")
    group = F.xxhash64("_leader", F.lit(8)).alias("_group")
    nodes = (rows.join(linked, "_row").join(member, "_row", "left").withColumn("_leader", F.coalesce("_leader", "_row"))
             .select("_row", "_key", "_leader", group, start.alias("shard")))
    nodes = propagate(nodes, links, shards, int(SLACK * count / shards) + 1, rounds)
    # every shard keeps at most its share of linked documents, in groups that
    # are together; all others fill the shards up in the order of a hash of
    # the group, so only groups at a shard's border are cut
    share = [count // shards + (s < count % shards) for s in range(shards)]
    groups = nodes.groupBy("_leader", "_group").agg(F.count(F.lit(1)).alias("_n"), F.min("shard").alias("shard"), F.max("shard").alias("_last"))
    ranked = running_sum(groups.filter("shard = _last").withColumn("_fine", by_group), ["shard"], "_fine", ["_group", "_leader"], F.col("_n"), "_rank")
    limit = F.element_at(F.array(*[F.lit(x).cast("long") for x in share]), F.col("shard") + 1)
    kept = ranked.filter(F.col("_rank") + F.col("_n") <= limit).select("_leader")
    stay = written(nodes.join(kept, "_leader", "left_semi").select("_row", "shard"), "shard-stay")
    load = loads(stay)
    bounds, border = [], 0
    for s in range(shards - 1):
        border += share[s] - load.get(s, 0)
        bounds.append(border)
    others = (rows.join(stay, "_row", "left_anti").join(member, "_row", "left").withColumn("_leader", F.coalesce("_leader", "_row"))
              .select("_row", "_key", "_leader", group, F.lit(0).alias("_one")))
    others = written(others, "shard-others")
    first = others.groupBy("_one", "_leader", "_group").agg(F.count(F.lit(1)).alias("_n"))
    first = running_sum(first.withColumn("_fine", by_group), ["_one"], "_fine", ["_group", "_leader"], F.col("_n"), "_pos").select("_leader", "_n", "_pos")
    others = written(others.join(first, "_leader").withColumn("_fine", fine), "shard-order")
    several = running_sum(others.filter("_n > 1"), ["_leader"], "_fine", ["_key", "_row"], F.lit(1), "_in")
    others = (others.filter("_n = 1").select("_row", "_pos")
              .unionByName(several.select("_row", (F.col("_pos") + F.col("_in")).alias("_pos"))))
    number = F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: b <= F.col("_pos"))) if bounds else F.lit(0)
    where = others.select("_row", number.cast("int").alias("shard")).unionByName(stay)
    placed = written(rows.join(where, "_row").select("_row", "doc_id", "size", "text_crc32", "_key", "shard"), "shard-placed")
    return running_sum(placed.withColumn("_fine", fine), ["shard"], "_fine", ["_key", "_row"], F.lit(1), "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
