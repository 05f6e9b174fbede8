"""Quality by weak supervision (operator 7).

Each rule votes good, bad or abstains on a whole text; a two-class latent
model whose class shares and per-rule accuracies are estimated by
expectation-maximisation turns the votes into a posterior probability of
good quality, which replaces an all-rules-must-pass filter. The rows' votes
are reduced to counts per vote pattern (at most 3**8 = 6,561 patterns,
whatever the input's size), so EM covers all rows and only that bounded
table reaches the driver. A text is kept if its posterior is at least 0.5
and the base limits hold.

One pass computes all measures; the narrow result is written once and read
for the counts and for the verdicts. Null, empty and blank texts have no
words: every rule abstains and the base limit rejects them. Very long texts
are handled whole; repeated rows count repeatedly; ids may be null or
repeat; extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text
from tessera.llm._store import written

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_letters", "n_marks", "n_distinct"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType())] + [T.StructField(m, T.LongType()) for m in MEASURES])

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True  # fixed values
MARK = np.zeros(256, dtype=bool)
MARK[list(b"!?#*$%&|<>~^=_@\\")] = True
ABSTAIN, BAD, GOOD = 0, 1, 2


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The MEASURES of each row of a slice."""
    rows = len(offsets) - 1
    words = _text.Words(data, offsets)

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[offsets[1:]] - total[offsets[:-1]]

    char = _text.chars(data)
    inside = ~_text.IS_SPACE[data]
    h = words.hashes(lower=False)
    salt = _text.mix(words.row.astype(np.uint64) + np.uint64(1))
    # words in 3-word windows that occur at least twice in their row
    s = _text.shingle_hashes(h, 3)
    repeat = np.zeros(len(h), dtype=bool)
    if len(s):
        whole = words.row[2:] == words.row[:-2]
        at = np.flatnonzero(whole)
        _, inverse, times = np.unique(_text.mix(s[at] ^ salt[at]), return_inverse=True, return_counts=True)
        again = at[times[inverse] > 1]
        for k in range(3):
            repeat[again + k] = True
    distinct = np.unique(_text.mix(h ^ salt), return_index=True)[1]
    # lines with a word, and those equal to an earlier one of their row
    breaks = np.flatnonzero(data == 0x0A)
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    start = start[start < offsets[-1]]
    row = np.searchsorted(offsets, start, side="right") - 1
    end = np.minimum(np.append(start[1:], offsets[-1]), offsets[row + 1])
    end = end - ((end > start) & (data[np.maximum(end, 1) - 1] == 0x0A))
    filled = np.concatenate([[0], np.cumsum(inside)])
    full = filled[end] > filled[start]
    start, end, row = start[full], end[full], row[full]
    lines = np.bincount(row, minlength=rows)
    line = _text.mix(_text.span_hashes(data, start, end) ^ _text.mix(row.astype(np.uint64) + np.uint64(1)))
    own = np.bincount(row[np.unique(line, return_index=True)[1]], minlength=rows)
    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 0xC3)
    return [words.count, per_row(char & inside), per_row(SYMBOL[data]), lines - own,
            np.bincount(words.row[repeat], minlength=rows), lines, per_row(upper), per_row(letter & char),
            per_row(MARK[data]), np.bincount(words.row[distinct], minlength=rows)]


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row."""
    def run(batches):
        for batch in batches:
            for first, data, offsets in _text.slices(batch.column(1).cast(pa.string())):
                got = measure(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(offsets) - 1)] + [pa.array(np.asarray(g), pa.int64()) for g in got],
                    names=SCHEMA.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, SCHEMA)


def _rule(bad: Column, good: Column, words: int = 1) -> Column:
    """A vote; texts with fewer words abstain."""
    return (F.when(F.col("n_words") < words, ABSTAIN).when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN))


def rules() -> dict[str, Column]:
    """The rules: name -> vote. Ratios compare products, so none divides."""
    c = F.col
    return {
        "symbols": _rule(c("n_symbols") * 100 > c("word_chars") * 6, c("n_symbols") * 200 < c("word_chars")),
        "marks": _rule(c("n_marks") * 100 > c("word_chars") * 8, c("n_marks") * 100 < c("word_chars")),
        "shouting": _rule(c("n_upper") * 100 > c("n_letters") * 50, c("n_upper") * 100 < c("n_letters") * 12, 8),
        "letters": _rule(c("n_letters") * 100 < c("word_chars") * 75, c("n_letters") * 100 > c("word_chars") * 92),
        "repeats": _rule(c("n_repeat_words") * 100 > c("n_words") * 40, c("n_repeat_words") * 100 < c("n_words") * 8, 20),
        "variety": _rule(c("n_distinct") * 100 < c("n_words") * 18, c("n_distinct") * 100 > c("n_words") * 35, 30),
        "lines": _rule((c("n_dup_lines") > 1) & (c("n_dup_lines") * 100 > c("n_lines") * 30), c("n_dup_lines") * 100 < c("n_lines") * 10),
        "word_length": _rule((c("word_chars") > c("n_words") * 14) | (c("word_chars") < c("n_words") * 2),
                             (c("word_chars") < c("n_words") * 9) & (c("word_chars") > c("n_words") * 3), 10),
    }


def pattern(names: list[str]) -> Column:
    """The votes as one number in base 3."""
    return sum((F.col(n).cast("int") * F.lit(3 ** i) for i, n in enumerate(names)), F.lit(0)).cast("int")


def estimate(codes: np.ndarray, counts: np.ndarray, n_rules: int, rounds: int = 100) -> dict:
    """EM over vote patterns: class share, votes of each rule by class and
    the posterior of good per pattern. Starts from "a bad vote usually means
    bad"; a Dirichlet prior of 1 % of the rows keeps every estimate inside
    (0, 1) and the two classes in their roles."""
    votes = (codes[:, None] // 3 ** np.arange(n_rules)) % 3
    good = np.where((votes == BAD).any(1), 0.1, np.where((votes == GOOD).any(1), 0.95, 0.5))
    total = counts.sum()
    prior = 0.01 * total
    # rows: good, bad; columns: abstain, bad vote, good vote
    expect = np.array([[0.20, 0.02, 0.78], [0.20, 0.40, 0.40]])
    onehot = np.eye(3)[votes]
    for _ in range(rounds):
        table = np.empty((2, n_rules, 3))
        share = np.empty(2)
        for k, p in enumerate((good, 1 - good)):
            w = counts * p
            table[k] = np.tensordot(w, onehot, axes=1) + prior * expect[k]
            table[k] /= table[k].sum(1, keepdims=True)
            share[k] = (w.sum() + prior) / (total + 2 * prior)
        log = np.log(share)[:, None] + np.einsum("prv,krv->kp", onehot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    accuracy = {"good": table[0, :, GOOD] / (1 - table[0, :, ABSTAIN]), "bad": table[1, :, BAD] / (1 - table[1, :, ABSTAIN])}
    return {"share": share, "table": table, "accuracy": accuracy, "posterior": good}


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the measures, the votes, base_failed, posterior and kept."""
    spark = docs.sparkSession
    rule = rules()
    names = [f"vote_{n}" for n in rule]
    rows = written(measures(docs), "quality").withColumns({f"vote_{n}": v for n, v in rule.items()})
    rows = rows.withColumn("_pattern", pattern(names))
    found = rows.groupBy("_pattern").count().toPandas().sort_values("_pattern")  # at most 3**rules rows
    codes, counts = found["_pattern"].to_numpy(), found["count"].to_numpy(dtype=np.float64)
    if len(codes):
        posterior = estimate(codes, counts, len(names))["posterior"]
    else:
        posterior = np.zeros(0)
    table = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior)], "_pattern int, posterior double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (rows.join(F.broadcast(table), "_pattern", "left").drop("_pattern")
            .withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.col("posterior") >= 0.5)))
