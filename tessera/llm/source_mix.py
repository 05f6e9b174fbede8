"""Mixing sources to target weights (operator 2), DataFrame functions only.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating;
together they take as many words as there are. No source exceeds
``epochs`` times its own words: what is over goes to the others by weight
(water filling, solved in closed form on the source table).

Schedule: a source needs as many slots as its target has blocks of
``block`` words. The golden-ratio point frac(t * phi) picks the source in
whose share of the cumulative needs it falls, so at every moment each source
has had its share up to a few slots; a source's points are its slots in
their order, until it has what it needs. The n-th slot of a source takes
the n-th block of its stream: its documents in a shuffled order (by hash),
repeated up to ``epochs`` times. A document's ``first_slot`` is the slot that
begins it: sorted by it, the mix is in its order.
By the three-gap theorem any interval of length 1/S holds a point among the
first 2.2 S ones, so 3 S points give S slots in all; nothing is patched.

Scale: the texts are read once for their word counts; what follows works on
narrow rows. Stream positions and slot numbers are running sums over
bounded buckets, so a source that holds most of the rows is spread over
tasks; documents meet slots in an equi-join on (source, block). Only the
table of sources (the mixture's own configuration) is ordered as a whole.

Null texts have size 0 and are taken 0 times; null sources form one source;
repeated rows and ids are separate documents (ordered by id and text, so
only equal rows may swap places); very long texts span many blocks; clashing
extra columns are ignored. Documents that the mix does not take have no
first slot. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._prefix import running_sum
from tessera.llm._store import safely_named, small_batches, written

BLOCK = 256
EPOCHS = 3
BUCKET = 512  # rows per bucket of a running sum, over all sources
GRID = 1 << 48  # points are whole multiples of 1 / GRID
GOLDEN = 173961102589771  # GRID / phi
CELLS = 4096
DRAWN = 3  # points drawn for each slot that is needed
WORD = r"[^\x20\x09-\x0D]+"
MANY_SOURCES = 100_000  # source tables up to this many rows are broadcast


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def golden_point(t: Column) -> Column:
    """(t * GOLDEN) mod GRID for t below GRID, by 12 bits at a time: no
    product reaches 2**63."""
    x = F.lit(0).cast("long")
    for shift in (36, 24, 12, 0):
        x = (x * 4096 + F.shiftright(t, shift).bitwiseAND(F.lit(4095)) * F.lit(GOLDEN)).bitwiseAND(F.lit(GRID - 1))
    return x


def target_table(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """sid, source, source_size, target (double) and quota (whole words) of
    every source of (source, size)."""
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    t = own.withColumn("sid", F.row_number().over(everything).cast("long"))
    t = t.withColumn("_w", (F.col("sid") - 1) % 3 + 1).withColumn("_cap", F.col("source_size") * epochs)
    # in the order of cap / weight the saturated sources come first
    order = [F.col("_cap") * F.expr("6 div _w"), F.col("sid")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("_left", F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
    t = t.withColumn("_full", F.col("_cap") * F.sum("_w").over(after) < F.col("_left") * F.col("_w"))
    t = t.withColumn("_rest", F.sum("source_size").over(whole)
                     - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(whole), F.lit(0)))
    t = t.withColumn("_shared", F.sum(F.when(~F.col("_full"), F.col("_w"))).over(whole))
    t = t.withColumn("target", F.when(F.col("_full"), F.col("_cap").cast("double"))
                     .otherwise(F.col("_rest").cast("double") * F.col("_w") / F.col("_shared")))
    t = t.withColumn("quota", F.least(F.round("target").cast("long"), F.col("_cap")))
    return t.select("sid", "source", "source_size", "target", "quota")


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The slots: t (the point's number), sid and n, the slot's rank within
    its source."""
    spark = targets.sparkSession
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = targets.select("sid", F.expr(f"(quota + {block - 1}) div {block}").alias("_need")).filter("_need > 0")
    shares = t.withColumn("_all", F.sum("_need").over(whole)).withColumn("_upto", F.sum("_need").over(upto))

    def place(slots: str) -> Column:
        return F.floor(F.expr(slots).cast("double") / F.col("_all") * F.lit(float(GRID))).cast("long")

    shares = shares.withColumn("_lo", place("_upto - _need")).withColumn("_hi", place("_upto"))
    width = GRID // CELLS
    cells = shares.select("sid", "_need", "_lo", "_hi", F.explode(F.expr(f"sequence(_lo div {width}, (_hi - 1) div {width})")).alias("_cell"))
    slots = t.agg(F.coalesce(F.sum("_need"), F.lit(0))).first()[0]
    points = (spark.range(DRAWN * slots).withColumnRenamed("id", "t").withColumn("_x", golden_point(F.col("t") + 1))
              .withColumn("_cell", F.expr(f"_x div {width}")))
    # at most CELLS + sources rows
    drawn = points.join(cells, "_cell").filter("_x >= _lo AND _x < _hi").select("t", "sid", "_need")
    drawn = running_sum(drawn.withColumn("_fine", F.expr(f"t div {4 * BUCKET}")), ["sid"], "_fine", ["t"], F.lit(1), "n")
    return drawn.filter("n < _need").select("t", "sid", "n")


def mix(docs: DataFrame, block: int = BLOCK, epochs: int = EPOCHS, seed: int = 20240229, keep: list[str] = ["doc_id"]) -> DataFrame:
    """One row per document: the columns ``keep``, size, source_size, target,
    taken (words the mix takes, repeats counted) and first_slot."""
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)],
                       F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
                       F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("_key"),
                       F.monotonically_increasing_id().alias("_row"))
    rows = written(rows, "mix-sizes")  # fixes _row, reads the texts once
    targets = written(target_table(rows, epochs), "mix-targets")
    slots = schedule(targets, block)
    buckets = max(1, rows.count() // BUCKET)
    small = targets.count() <= MANY_SOURCES
    placed = rows.join(F.broadcast(targets) if small else targets, rows["source"].eqNullSafe(targets["source"])).drop("source")
    placed = placed.withColumn("_fine", F.pmod(F.col("_key"), F.lit(buckets)))
    placed = running_sum(placed, ["sid"], "_fine", ["_key", "_row"], F.col("size"), "_pos")
    placed = written(placed.drop("_fine", "_key"), "mix-streams")
    pieces = (placed.filter("size > 0")
              .select("_row", "sid", "size", "quota", F.explode(F.expr(
                  f"transform(sequence(0, {epochs - 1}), e -> _pos + e * source_size)")).alias("_from"))
              .filter("_from < quota").withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("quota")))
              .withColumn("n", F.explode(F.expr(f"sequence(_from div {block}, (_to - 1) div {block})")))
              .withColumn("_words", F.least(F.col("_to"), (F.col("n") + 1) * block) - F.greatest(F.col("_from"), F.col("n") * block)))
    taken = pieces.join(slots, ["sid", "n"]).groupBy("_row").agg(F.sum("_words").alias("taken"), F.min("t").alias("first_slot"))
    return placed.join(taken, "_row", "left").select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


@safely_named("doc_id", "text", "source")
def repeat_to_mix(docs: DataFrame, block: int = BLOCK, epochs: int = EPOCHS) -> DataFrame:
    """The documents as the mix takes them: each as often as it is begun (a
    text cut by its source's target stays whole; at most one per source).
    Texts meet their number of copies by id and hash of the text."""
    keyed = docs.withColumn("_text", F.xxhash64("text"))
    mixed = mix(keyed, block, epochs, keep=["doc_id", "_text"])
    copies = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0).cast("long")
    plan = written(mixed.groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_t"))
                   .agg(F.sum(copies).alias("_copies"), F.count(F.lit(1)).alias("_rows")).filter("_copies > 0"), "mix-copies")
    got = keyed.join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_t")))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    own = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    once = got.filter("_rows = 1").withColumn("_copy", again).select(*own)
    if plan.filter("_rows > 1").limit(1).count() == 0:  # no rows that are equal in id and text
        return once
    return once.unionByName(got.filter("_rows > 1").dropDuplicates(["_id", "_t"]).withColumn("_copy", again).select(*own))
