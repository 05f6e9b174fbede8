"""Nearest neighbours by shifted space-filling curves (operator 6).

Nearness is the inner product in double precision. ``CURVES`` Hilbert
orderings of the vectors, each of another shifted random projection, are
range-partitioned and ranked; a query meets the rows in the key windows
around its own place on every curve. The windows' results are merged and
reranked on the original vectors: that gives each query a first answer and
a bound, its k-th best score.

On vectors without strong structure windows of any useful width miss many
neighbours (README: recall), so an exact completion follows: consecutive
runs of the first curve are blocks with a centre and a radius; a query goes
to every block that could hold something better than its bound
(q.c + |q| r). Blocks that cannot are skipped. The result is exact; the
curves decide how much is skipped.

The projections' ranges come from at most ``SAMPLE`` rows (by a hash of the
id); all rows are indexed. Rank ties are broken by id, so a vector shared by
a third of all rows fills many blocks, not one.

Rows whose id or vector is null, whose vector is zero, has null or
non-finite components or another length than most vectors take no part. An
id that repeats counts once (the least vector). With fewer than k
candidates all are returned; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._store import written

CURVES, AXES, BITS = 4, 10, 6
WINDOW = 512  # ranks on either side of a query
BLOCK = 1024  # rows per block of a curve
RUN = 4096  # rows per block of the completion
BATCH = 512  # queries handled together, about
STACK = 1024  # block centres per row
SAMPLE = 10_000


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows x axes), after
    the transposition algorithm of Skilling (2004)."""
    x = [c.astype(np.uint64) for c in cells.T]
    one = np.uint64(1)
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        t = np.where((x[n - 1] & np.uint64(1 << level)) != 0, t ^ np.uint64((1 << level) - 1), t)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | (((x[i] ^ t) >> np.uint64(level)) & one)
    return key


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """(vec_id, v) of the rows that take part; v is an array of doubles."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(f"`{vec}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
    v = written(v.groupBy("vec_id").agg(F.min("v").alias("v")), "ann-vectors")
    dim = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return v.filter(F.size("v") == (dim["d"] if dim else 0))


def matrix(column) -> np.ndarray:
    """Arrays of one length as rows."""
    if isinstance(column, pa.Array):
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(column), -1)
    return np.stack(column.to_list()) if len(column) else np.zeros((0, 0))


def projections(vectors: DataFrame, seed: int = 5):
    """Per curve the axes, and the offset and scale of their cells, from a
    bounded sample."""
    sample = matrix(pd.Series([r["v"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()]))
    if not sample.size:
        return None
    r = np.random.Generator(np.random.PCG64(seed))
    out = []
    axes = min(AXES, sample.shape[1])
    for _ in range(CURVES):
        a = np.linalg.qr(r.standard_normal((sample.shape[1], sample.shape[1])))[0][:, :axes]
        y = sample @ a
        low, high = np.quantile(y, [0.005, 0.995], axis=0)
        shift = r.random(axes) * 0.5
        out.append((a, low, np.maximum(high - low, 1e-12), shift))
    return out


def ranked(vectors: DataFrame, curves) -> DataFrame:
    """(curve, rank, vec_id, v) in the order of every curve."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(curves)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            for c, (axes, low, width, shift) in enumerate(shared.value):
                cells = ((np.clip((x @ axes - low) / width, 0, 1) * 0.5 + shift) * (1 << BITS)).astype(np.int64)
                key = hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key.view(np.int64)), batch.column(0), batch.column(1)],
                                                 names=["curve", "key", "vec_id", "v"])

    keyed = vectors.mapInArrow(run, "curve int, key long, vec_id long, v array<double>")
    ordered = (keyed.repartitionByRange("curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
               .withColumn("_i", F.monotonically_increasing_id()))
    ordered = written(ordered, "ann-curves").withColumn("_p", F.shiftright("_i", 33))
    parts = ordered.groupBy("curve", "_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    w = Window.partitionBy("curve").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (ordered.join(parts, ["curve", "_p"])
            .select("curve", (F.col("_i") - F.col("_first") + F.col("_before")).alias("rank"), "vec_id", "v"))


def nearest(q_ids, q, ids, x, k: int, least=None) -> pd.DataFrame:
    """The k best rows of x for every query (ties: the smaller id); with
    ``least`` only those not below it."""
    out_q, out_v, out_s = [], [], []
    if len(q_ids) and len(ids):
        rough = q @ x.T
        for i in range(len(q_ids)):
            s = rough[i]
            margin = 1e-9 * max(1.0, float(np.abs(s).max()))
            bound = -np.inf if least is None else least[i] - margin
            if len(s) > k + 1:
                bound = max(bound, np.partition(s, len(s) - k - 1)[len(s) - k - 1] - margin)
            at = np.flatnonzero((s >= bound) & (ids != q_ids[i]))
            exact = (x[at] * q[i]).sum(axis=1)
            best = np.lexsort((ids[at], -exact))[:k]
            out_q.append(np.full(len(best), q_ids[i])); out_v.append(ids[at][best]); out_s.append(exact[best])
    cat = lambda a, t: np.concatenate(a).astype(t) if a else np.zeros(0, t)
    return pd.DataFrame({"query_id": cat(out_q, np.int64), "vec_id": cat(out_v, np.int64), "score": cat(out_s, np.float64)})


FOUND = "query_id long, vec_id long, score double"


def windows(order: DataFrame, every: int, k: int) -> DataFrame:
    """First answers: the best rows in the key windows of all curves."""
    rows = order.withColumn("block", F.expr(f"rank div {BLOCK}"))
    queries = (order.filter(F.col("vec_id") % every == 0)
               .withColumn("block", F.explode(F.expr(f"sequence(greatest(rank - {WINDOW}, 0) div {BLOCK}, (rank + {WINDOW}) div {BLOCK})"))))

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return nearest([], None, [], None, k)
        return nearest(a["vec_id"].to_numpy(), matrix(a["v"]), b["vec_id"].to_numpy(), matrix(b["v"]), k)

    return queries.groupBy("curve", "block").cogroup(rows.groupBy("curve", "block")).applyInPandas(run, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best distinct neighbours of every query, with their rank."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))


def complete(order: DataFrame, first: DataFrame, every: int, k: int, total: int) -> DataFrame:
    """Rows that are at least as good as a query's k-th of ``first``, from
    all blocks that can hold some."""
    line = order.filter("curve = 0")

    def pack_rows(pdf: pd.DataFrame) -> pd.DataFrame:
        x = matrix(pdf["v"])
        c = x.mean(axis=0)
        return pd.DataFrame({"run": [int(pdf["run"].iloc[0])], "ids": [pdf["vec_id"].to_numpy().astype("<i8").tobytes()], "rows": [x.tobytes()],
                             "centre": [c.tobytes()], "radius": [float(np.sqrt(((x - c) ** 2).sum(axis=1).max()))]})

    runs = written(line.withColumn("run", F.expr(f"rank div {RUN}")).groupBy("run").applyInPandas(
        pack_rows, "run long, ids binary, rows binary, centre binary, radius double"), "ann-runs")
    bound = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth"))
    queries = (line.filter(F.col("vec_id") % every == 0).join(bound, "vec_id", "left")
               .withColumn("kth", F.coalesce("kth", F.lit(float("-inf")))).withColumn("batch", F.expr(f"rank div {BATCH * every}")))

    def pack_queries(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"batch": [int(pdf["batch"].iloc[0])], "q_ids": [pdf["vec_id"].to_numpy().astype("<i8").tobytes()],
                             "q": [matrix(pdf["v"]).tobytes()], "kth": [pdf["kth"].to_numpy().tobytes()]})

    packed = queries.groupBy("batch").applyInPandas(pack_queries, "batch long, q_ids binary, q binary, kth binary")
    stacks = max(1, -(-total // (RUN * STACK)))
    packed = packed.withColumn("stack", F.explode(F.sequence(F.lit(0), F.lit(stacks - 1))))
    centres = (runs.withColumn("stack", F.expr(f"cast(run div {STACK} AS int)")).groupBy("stack")
               .agg(F.collect_list(F.struct("run", "centre", "radius")).alias("centres")))

    def choose(batches):
        """The queries that go to each block of a stack."""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids = np.frombuffer(row["q_ids"], "<i8")
                q = np.frombuffer(row["q"]).reshape(len(ids), -1)
                kth = np.frombuffer(row["kth"])
                c = np.stack([np.frombuffer(x["centre"]) for x in row["centres"]])
                r = np.array([x["radius"] for x in row["centres"]])
                reach = q @ c.T + np.linalg.norm(q, axis=1)[:, None] * r * (1 + 1e-9) + 1e-9
                for j, x in enumerate(row["centres"]):
                    go = reach[:, j] >= kth
                    if go.any():
                        out.append((x["run"], ids[go].tobytes(), q[go].tobytes(), kth[go].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] + [pa.binary()] * 3)],
                                                 names=["run", "q_ids", "q", "kth"])

    tasks = (packed.join(centres, "stack").select("q_ids", "q", "kth", "centres")
             .mapInArrow(choose, "run long, q_ids binary, q binary, kth binary"))

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
                got = nearest(q_ids, np.frombuffer(row["q"]).reshape(len(q_ids), -1),
                              ids, np.frombuffer(row["rows"]).reshape(len(ids), -1), k, np.frombuffer(row["kth"]))
                yield pa.RecordBatch.from_pandas(got, preserve_index=False)

    return tasks.join(runs.select("run", "ids", "rows"), "run").drop("run").mapInArrow(search, FOUND)


def nearest_neighbours(vectors: DataFrame, every: int = 20, k: int = 20, vec: str = "embedding", exact: bool = True) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of every row whose
    id is divisible by ``every``. Without ``exact`` only the key windows are
    searched."""
    rows = usable(vectors, vec)
    curves = projections(rows)
    if curves is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = written(ranked(rows, curves), "ann-ranked")
    first = written(best(windows(order, every, k), k), "ann-first")
    found = first.select("query_id", "vec_id", "score")
    if exact:
        found = found.unionByName(complete(order, first, every, k, rows.count()))
    return best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
