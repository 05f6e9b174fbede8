"""Toxicity scores of whole texts (operator 5).

A bag is a window of ``WINDOW`` words; its vector is the average of the
embeddings of all character n-grams of its words (hashed to ``2**BITS``
rows, so an unseen misspelling shares most vectors with the known word),
followed by a linear softmax over two classes. Embeddings and softmax are
trained jointly in numpy. A text's logit is that of its most toxic bag,
which keeps a single insult in a long text visible; a logistic calibration
on a part of the training rows kept aside turns it into a score.

The model is fitted on a bounded sample: at most ``max_each`` rows per class
(default 2,000), the first by a hash of the id, of texts of at most ``max_bytes`` (default 64 KB),
which bounds the driver's memory. Scoring reads all rows, texts of any length: one pass without a shuffle, the model's n-gram weights (1 MB) are
broadcast. Empty, null and blank texts have no bag and get the score of the
empty bag (the softmax bias), 0.5 at most. Rows with a null id, repeated rows
and extra columns are scored like any other; a label that occurs more than
once for an id counts as toxic if any of them is. Without any usable label of both classes
every text scores 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text
from tessera.llm._store import frugal, small_batches

BITS, DIM = 18, 16
SIZES = (3, 4, 5, 6)  # bytes of the n-grams, word borders included
WINDOW, STEP = 8, 4
MAX_EACH = 2_000
MAX_BYTES = 1 << 16  # of the texts learned from; longer ones are scored like all
THRESHOLD = 0.7
SURE, START = 2.0, 2.0

U32 = np.uint32
_rng = np.random.Generator(np.random.PCG64(7))
CODE = (_rng.integers(1, 1 << 31, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(U32)
CODE[list(b" \t\n\v\f\r")] = CODE[0x20]


class Bags:
    """n-grams of a slice of texts: for every size the buckets and which
    start positions are n-grams of one word; words and bags by row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        # a blank before every row, so that each word has a border in front
        rows = len(offsets) - 1
        padded = np.full(len(data) + rows + 1, 0x20, dtype=np.uint8)
        padded[np.arange(len(data)) + np.repeat(np.arange(1, rows + 1), np.diff(offsets))] = _text.LOWER[data]
        self.words = _text.Words(padded, np.append(offsets[:-1] + np.arange(rows), len(padded)))
        n = len(padded)
        blank = _text.IS_SPACE[padded]
        code = np.concatenate([CODE[padded], np.zeros(max(SIZES), U32)])
        inner = np.concatenate([blank, np.ones(max(SIZES), bool)])
        self.buckets, self.valid = [], []
        h = code[:n].copy()
        broken = np.zeros(n, dtype=bool)  # a border inside the n-gram
        for k in range(2, max(SIZES) + 1):
            if k > 2:
                broken |= inner[k - 2:k - 2 + n]
            h = h * U32(0x01000193) + code[k - 1:k - 1 + n]
            if k in SIZES:
                ok = ~broken
                ok[max(0, n - k + 1):] = False
                self.buckets.append((h * U32(0x9E3779B1) ^ (h >> U32(15)) * U32(0x85EBCA6B)) >> U32(32 - BITS))
                self.valid.append(ok)
        self.border = self.words.start - 1  # n-grams from here to the next border are the word's

    def per_word(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the weights of each word's n-grams, and their number."""
        if not len(self.border):
            return np.zeros(0), np.zeros(0)
        total = np.zeros(len(self.valid[0]), dtype=np.float64)
        count = np.zeros(len(self.valid[0]), dtype=np.int32)
        for b, ok in zip(self.buckets, self.valid):
            total += weight[b] * ok
            count += ok
        return np.add.reduceat(total, self.border), np.add.reduceat(count, self.border)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word, end word) of all bags."""
        n = self.words.count
        bags = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STEP)), 0)
        row = np.repeat(np.arange(len(n)), bags)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(bags) - bags, bags)
        a = self.words.first[:-1][row] + nth * STEP
        return row, a, np.minimum(a + WINDOW, self.words.first[1:][row])

    def logits(self, weight: np.ndarray, bias: float):
        """(row, first word, end word, logit) of all bags."""
        s, c = self.per_word(weight)
        s, c = np.concatenate([[0], np.cumsum(s)]), np.concatenate([[0], np.cumsum(c)])
        row, a, b = self.spans()
        return row, a, b, (s[b] - s[a]) / np.maximum(1, c[b] - c[a]) + bias

    def members(self, a: int, b: int) -> np.ndarray:
        """Buckets of the n-grams of words a to b."""
        lo = self.border[a]
        hi = self.border[b] if b < len(self.border) and self.words.row[b] == self.words.row[a] else int(self.words.end[b - 1])
        return np.concatenate([x[lo:hi][ok[lo:hi]] for x, ok in zip(self.buckets, self.valid)])


class Model:
    """Embeddings, softmax and calibration. ``weight`` is what scoring
    needs: each n-gram's embedding times the softmax's class difference."""

    def __init__(self, seed: int = 11):
        r = np.random.Generator(np.random.PCG64(seed))
        self.embedding = (r.standard_normal((1 << BITS, DIM)) * 0.1).astype(np.float32)
        self.softmax = (r.standard_normal((2, DIM)) * 0.1).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)
        self.scale, self.shift = 1.0, 0.0
        self.square = np.full(1 << BITS, 1e-4, dtype=np.float32)  # Adagrad, per row

    def weight(self) -> np.ndarray:
        return (self.embedding @ (self.softmax[1] - self.softmax[0])).astype(np.float32)

    def step(self, bags: list[np.ndarray], label: np.ndarray, share: np.ndarray, rate: float) -> None:
        """One gradient step on a batch of bags (cross entropy)."""
        size = np.array([len(b) for b in bags])
        flat = np.concatenate(bags)
        which = np.repeat(np.arange(len(bags)), size)
        per = 1.0 / np.maximum(1, size)
        mean = np.empty((len(bags), DIM), dtype=np.float32)
        at = np.concatenate([[0], np.cumsum(size)[:-1]])
        mean[:] = np.add.reduceat(self.embedding[flat], at, axis=0) * per[:, None]
        z = mean @ self.softmax.T + self.bias
        p = 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -30, 30)))
        g = ((p - label) * share).astype(np.float32)  # d loss / d (z1 - z0)
        d = self.softmax[1] - self.softmax[0]
        rows, inverse = np.unique(flat, return_inverse=True)
        push = np.bincount(inverse, weights=(g * per)[which]).astype(np.float32)
        self.square[rows] += push ** 2 * float(d @ d)
        self.embedding[rows] -= rate * (push / np.sqrt(self.square[rows]))[:, None] * d
        grad = (g[:, None] * mean).sum(0) / len(bags)
        self.softmax[1] -= 0.5 * rate * grad * 10
        self.softmax[0] += 0.5 * rate * grad * 10
        step = rate * float(g.mean())
        self.bias += np.array([step, -step], dtype=np.float32)

    def start(self, prepared: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """First direction of the embeddings: n-grams move along the
        softmax's class difference by their log odds between texts of the
        two classes, as far as that exceeds ``SURE`` standard errors."""
        df = np.full((2, 1 << BITS), 0.25)
        n = np.full(2, 0.5)
        for data, offsets, label in prepared:
            bags = Bags(data, offsets)
            row = np.repeat(bags.words.row, np.diff(np.append(bags.border, len(bags.valid[0])))) if len(bags.border) else np.zeros(0, int)
            lead = int(bags.border[0]) if len(bags.border) else 0
            seen = [(row.astype(np.int64) << BITS | b[lead:].astype(np.int64))[ok[lead:]] for b, ok in zip(bags.buckets, bags.valid)]
            seen = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
            for y in (0, 1):
                df[y] += np.bincount(seen[label[seen >> BITS] == y] & ((1 << BITS) - 1), minlength=1 << BITS)
                n[y] += (label == y).sum()
        odds = np.log(df[1] / n[1]) - np.log(df[0] / n[0])
        error = np.sqrt(1 / df[0] + 1 / df[1])
        odds = np.sign(odds) * np.maximum(0, np.abs(odds) - SURE * error)
        d = self.softmax[1] - self.softmax[0]
        self.embedding += (odds[:, None] * d / float(d @ d) * START).astype(np.float32)

    def raw(self, texts: pa.Array) -> np.ndarray:
        """Logit of the most toxic bag of each text (the bias without one)."""
        w, bias = self.weight(), float(self.bias[1] - self.bias[0])
        x = raw_logits(texts, w, bias)
        return np.where(np.isinf(x), bias, x)


def raw_logits(texts: pa.Array, weight: np.ndarray, bias: float) -> np.ndarray:
    """Logit of the most toxic bag of each text, minus infinity without one."""
    out = []
    for _, data, offsets in _text.slices(texts):
        row, _, _, logit = Bags(data, offsets).logits(weight, bias)
        best = np.full(len(offsets) - 1, -np.inf)
        np.maximum.at(best, row, logit)
        out.append(best)
    return np.concatenate(out) if out else np.zeros(0)


def train(texts: list[str], labels: np.ndarray, epochs: int = 8, seed: int = 11) -> Model:
    """Joint training; every fifth row is kept aside for the calibration."""
    model = Model(seed)
    r = np.random.Generator(np.random.PCG64(seed + 1))
    aside = np.arange(len(texts)) % 5 == 4
    if len(set(labels[aside])) < 2 or len(set(labels[~aside])) < 2:
        aside[:] = False
    fit = np.flatnonzero(~aside)
    prepared, order = [], r.permutation(fit)
    for i in range(0, len(order), 64):  # groups of texts; n-grams are made anew when needed, to save memory
        rows = order[i:i + 64]
        data, offsets = next((d, o) for _, d, o in _text.slices(pa.array([texts[j] for j in rows], pa.string()), 1 << 40))
        prepared.append((data, offsets, labels[rows]))
    positive = max(1, int(labels[fit].sum()))
    balance = np.array([1.0, max(0.2, (len(fit) - positive) / positive)])
    model.start(prepared)
    for epoch in range(epochs):
        rate = 0.5 if epoch < epochs - 2 else 0.2
        for data, offsets, label in prepared:
            bags = Bags(data, offsets)
            row, a, b, logit = bags.logits(model.weight(), float(model.bias[1] - model.bias[0]))
            if not len(row):
                continue
            # the most toxic bags stand for their text
            best = np.lexsort((-logit, row))
            nth = np.arange(len(row)) - np.searchsorted(row[best], row[best])
            pick = best[nth < np.where(label[row[best]] == 1, 1, 3)]
            y = label[row[pick]].astype(np.float32)
            model.step([bags.members(a[j], b[j]) for j in pick], y, balance[y.astype(int)], rate)
    check = np.flatnonzero(aside) if aside.any() else fit
    model.scale, model.shift = calibrate(model.raw(pa.array([texts[i] for i in check], pa.string())), labels[check])
    return model


def calibrate(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one input (Newton steps, ridge on the slope);
    the slope stays positive. The rarer toxic rows weigh more, by the root
    of the classes' ratio."""
    spread = float(logit.std()) or 1.0
    mid = float(logit.mean())
    x = (logit - mid) / spread
    w = np.array([1.0, 0.0])
    X = np.stack([x, np.ones_like(x)], 1)
    positive = max(1, int(label.sum()))
    c = np.where(label == 1, np.sqrt(max(1.0, (len(label) - positive) / positive)), 1.0)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -30, 30)))
        h = (X * (c * p * (1 - p))[:, None]).T @ X + np.diag([0.5, 1e-3])
        w = w - np.linalg.solve(h, X.T @ (c * (p - label)) + np.array([0.5 * (w[0] - 1), 0]))
    slope = max(1e-3, w[0]) / spread
    return slope, float(w[1] - slope * mid)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; null ids are in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def training_rows(docs: DataFrame, labels: DataFrame, max_each: int = MAX_EACH, max_bytes: int = MAX_BYTES) -> DataFrame:
    """At most ``max_each`` labelled texts per class outside the held-out
    fold, in the order of a hash, among texts of at most ``max_bytes`` bytes;
    ids in ``labels`` may repeat."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic"))
             .dropna().groupBy("_id").agg(F.max("_toxic").alias("_toxic")))
    rows = (docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
            .filter(F.col("_id").isNotNull() & (fold(F.col("_id"), 3) != 1)
                    & (F.coalesce(F.octet_length("_text"), F.lit(0)) <= max_bytes))
            .withColumn("_order", F.xxhash64("_id", F.octet_length("_text"))))
    # choose ids first (narrow rows), then read only the chosen texts
    ids = known.filter(fold(F.col("_id"), 3) != 1).join(rows.select("_id"), "_id", "left_semi")
    chosen = None
    for y in (0, 1):
        one = ids.filter((F.col("_toxic") > 0) == F.lit(bool(y))).orderBy(F.xxhash64("_id"), "_id").limit(max_each)
        one = one.select("_id", F.lit(y).alias("_y"))
        chosen = one if chosen is None else chosen.unionByName(one)
    return (rows.join(F.broadcast(chosen), "_id")  # at most 2 * max_each ids
            .orderBy("_order", "_id", F.col("_text")).limit(2 * max_each).select("_text", "_y"))


def fit(docs: DataFrame, labels: DataFrame, max_each: int = MAX_EACH, max_bytes: int = MAX_BYTES) -> Model | None:
    small_batches(docs.sparkSession)
    got = training_rows(docs, labels, max_each, max_bytes).toPandas()
    y = got["_y"].to_numpy(dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return None
    return train([t if isinstance(t, str) else "" for t in got["_text"]], y)


def score(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name`` (an equally named one is replaced)."""
    spark = docs.sparkSession
    small_batches(spark)
    keep = [f for f in docs.schema.fields if f.name.lower() != name.lower()]
    schema = T.StructType([*keep, T.StructField(name, T.DoubleType())])
    if model is None:
        return docs.select(*[F.col("`" + f.name.replace("`", "``") + "`") for f in keep], F.lit(0.0).alias(name))
    shared = spark.sparkContext.broadcast((model.weight(), float(model.bias[1] - model.bias[0]), model.scale, model.shift))
    at = [f.name for f in keep].index(text)
    source = docs.select(*[F.col("`" + f.name.replace("`", "``") + "`") for f in keep])

    @frugal
    def run(batches):
        weight, bias, scale, shift = shared.value
        for batch in batches:
            x = raw_logits(batch.column(at).cast(pa.string()), weight, bias)
            none = np.isinf(x)
            s = 1 / (1 + np.exp(-np.clip(scale * np.where(none, bias, x) + shift, -30, 30)))
            s[none] = np.minimum(s[none], 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())],
                                             names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, max_each: int = MAX_EACH, threshold: float = THRESHOLD,
             max_bytes: int = MAX_BYTES) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = fit(docs, labels, max_each, max_bytes)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
