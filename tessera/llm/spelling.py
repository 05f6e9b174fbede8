"""Spelling variants (operator 11).

Counts the corpus's words and leads rare ones to the frequent word one edit
(insertion, deletion or replacement of a code point) away.

1. Counting: every text's letter runs are counted in its task; partial
   counts combine map-side. A seeded share of (document, run) pairs loses a
   letter, if asked for (the registered query's planted misspellings).
2. Lists: an edit lies either in a word's first or in its second half, so
   two near words agree outside one of these windows. Words that agree there
   (and in length, or are one longer) form a list, sorted by what they have
   inside the window. A list of more than ``LIST`` words is cut again by
   halving its window; a window of one place holds at most one word per
   letter. So no list is unbounded, and nothing is dropped.
3. Dynamic programming over sorted lists: every word runs down the rest of
   its list with a banded edit matrix (three cells per row). A list word
   takes over the rows of the prefix that it shares with the word before it
   (adjacent longest common prefixes); when a row exceeds one edit, the whole
   range that shares this prefix is skipped. Many words run at once, as rows
   of numpy arrays.
4. Each list gives every word one row: its number of near words and the best
   of them; these combine to the word's form. Roots are found by doubling:
   a form is at least twice as frequent, so six rounds suffice for any count.

Scale: lists go to tasks by a shuffle of about six rows per distinct word;
tasks take whole lists in chunks of bounded size. No broadcast.

Case and words: maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z
lower-cased. Null and empty texts have none; very long texts are cut at run
ends for counting. A null doc_id counts as the empty string in the seeded
deletions. Repeated rows count twice. Ties between near words go to the
smallest in code-point order. Extra columns are ignored; an empty table has
no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._runs import whole_groups
from tessera.llm._store import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")  # as the contract states it
HELD = 200_000  # distinct words that a task counts before it passes them on
PIECE = 1 << 20  # characters counted at once
LIST = 2048  # words in a list that is not cut again
CELLS = 1 << 21  # of a chunk's arrays: rows times the longest window
WORDS = 1 << 16  # rows of a chunk


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that do not cut a run."""
    start = 0
    while len(text) - start > PIECE:
        stop = start + PIECE
        m = RUN.match(text, stop - 1)
        stop = m.end() if m else stop
        yield text[start:stop]
        start = stop
    yield text[start:] if start else text


def counts(docs: DataFrame, one_in: int | None, shortest: int, least: int) -> DataFrame:
    """(word, n) of the words with at least ``shortest`` letters that occur
    at least ``least`` times. ``one_in``: if it divides the crc32 of
    ``<doc_id>:<run>``, the run's letter at crc32 % length is left out."""
    def run(batches):
        total: Counter = Counter()

        def result():
            kept = [(w, n) for w, n in total.items() if len(w) >= shortest]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in kept], pa.string()), pa.array([x[1] for x in kept], pa.int64())], names=["word", "n"])

        for batch in batches:
            texts = pc.ascii_lower(batch.column(1))
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                text = text.as_py()
                if not text:
                    continue
                own: Counter = Counter()
                for piece in pieces(text):
                    own.update(RUN.findall(piece))
                if one_in is not None:
                    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for w in [w for w in own if zlib.crc32(w.encode(), seed) % one_in == 0]:
                        at = zlib.crc32(w.encode(), seed) % len(w)
                        own[w], n = 0, own[w]
                        total[w[:at] + w[at + 1:]] += n
                total.update(own)
                if len(total) > HELD:
                    yield result()
        yield result()

    partial = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def member_rows(words: DataFrame) -> DataFrame:
    """Every word's rows in its lists. ``grow``: the list joins words of
    ``size`` and ``size`` + 1 letters (else of ``size``); [lo, hi) is the
    window of places, ``rest`` what lies outside it, ``mid`` what lies inside
    (a shorter word of a growing list lacks one place)."""
    size = F.char_length("word")
    kinds = F.array(*[F.struct(F.lit(g).alias("grow"), (size - d).alias("size"), F.lit(bool(g) and not d).alias("short"))
                      for g, d in ((False, 0), (True, 0), (True, 1))])
    rows = words.select("word", "n", F.explode(kinds).alias("k")).select("word", "n", "k.*")
    whole = F.col("size") + F.col("grow").cast("int")
    return halves(rows.withColumns({"lo": F.lit(0), "hi": whole, "rest": F.lit(""), "mid": F.col("word")}).drop("word"))


def halves(rows: DataFrame) -> DataFrame:
    """Both halves of each row's window."""
    cut = F.expr("(lo + hi) div 2").cast("int")
    two = F.array(*[F.struct(lo.alias("lo"), hi.alias("hi")) for lo, hi in ((F.col("lo"), cut), (cut, F.col("hi")))])
    inside = (F.col("_w.hi") - F.col("_w.lo") - F.col("short").cast("int"))
    at = F.col("_w.lo") - F.col("lo") + 1
    kept = F.substring("mid", at, inside)
    left = F.substring("mid", F.lit(1), at - 1)
    right = F.substring("mid", at + inside, F.length("mid"))
    rest = F.concat(F.substring("rest", F.lit(1), F.col("lo")), left, right, F.substring("rest", F.col("lo") + 1, F.length("rest")))
    return (rows.withColumn("_w", F.explode(two)).filter(F.col("_w.hi") > F.col("_w.lo"))
            .select("grow", "size", "short", F.col("_w.lo").alias("lo"), F.col("_w.hi").alias("hi"), rest.alias("rest"), kept.alias("mid"), "n"))


LISTED = ["grow", "size", "lo", "hi", "rest"]


def bounded_lists(words: DataFrame) -> DataFrame:
    """The rows of all lists with at least two words, none over ``LIST``
    unless its window is one place."""
    rows, done = written(member_rows(words), "spelling-rows"), None
    while True:
        sizes = rows.groupBy(*LISTED).agg(F.count(F.lit(1)).alias("_c"))
        large = written(sizes.filter((F.col("_c") > LIST) & (F.col("hi") - F.col("lo") > 1)).select(*LISTED), "spelling-large")
        if not large.limit(1).count():
            return rows if done is None else done.unionByName(rows)
        fit = rows.join(large, LISTED, "left_anti")
        done = fit if done is None else done.unionByName(fit)
        rows = written(halves(rows.join(large, LISTED, "left_semi")), "spelling-rows")


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters, lengths) of strings below U+0100, one row each, ended by 0."""
    texts = [x.encode("latin-1") for x in column.to_pylist()]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    width = int(size.max(initial=0)) + 3
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in texts), np.uint8).reshape(len(texts), width), size


def near_pairs(m: np.ndarray, size: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (earlier, later row) of one list whose rows are one edit
    apart. Rows ``m`` are sorted within lists; ``starts``: first row of each."""
    n, width = m.shape
    rows = np.arange(n)
    ends = np.append(starts[1:], n)
    end = np.repeat(ends, ends - starts)  # of each row's list
    head = np.zeros(n, dtype=bool)
    head[starts] = True
    lcp = np.zeros(n, dtype=np.int64)
    if n > 1:
        differ = m[1:] != m[:-1]
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp = np.minimum(lcp, size)
    lcp[head] = 0
    # leap[r, d]: the first row after r that does not share r's first d letters
    leap = np.empty((n, width), dtype=np.int32)
    for d in range(width):
        stop = np.flatnonzero(head | (lcp < d))
        at = np.searchsorted(stop, rows, side="right")
        leap[:, d] = np.append(stop, n)[at]
    np.minimum(leap, end[:, None], out=leap)
    # band[q, d]: cells d-1, d, d+1 of row d between q and the list word in turn
    band = np.empty((n, width, 3), dtype=np.uint8)
    band[:] = (1, 0, 1)
    q = rows[rows + 1 < end]
    at = q + 1  # the list word in turn
    depth = lcp[at]
    first, second = [], []
    while len(q):
        over = depth >= size[at]  # a list word that is a prefix already read: its last row is known
        row = band[q, depth]
        letter = m[at, depth]
        own = size[q]
        c0 = m[q, np.maximum(depth - 1, 0)]
        b0 = np.minimum(row[:, 0] + ((letter != c0) | (depth < 1)), row[:, 1] + 1)
        b1 = np.minimum(np.minimum(row[:, 1] + (letter != m[q, depth]), row[:, 2] + 1), b0 + 1)
        b2 = np.minimum(row[:, 2] + (letter != m[q, depth + 1]), b1 + 1)
        b0[depth < 1] = np.minimum(b0, row[:, 1] + 1)[depth < 1]
        b1[depth + 1 > own] = 2
        b2[depth + 2 > own] = 2
        b0[depth > own] = 2
        new = np.minimum(np.stack([b0, b1, b2], axis=1), 2).astype(np.uint8)
        go = ~over
        depth = depth + go
        band[q[go], depth[go]] = new[go]
        dead = go & (new.min(axis=1) > 1)
        whole = ~dead & (depth == size[at])
        off = own - size[at] + 1
        hit = whole & (off >= 0) & (off <= 2)
        hit[hit] = band[q[hit], depth[hit], off[hit]] == 1
        first.append(q[hit])
        second.append(at[hit])
        at = np.where(dead, leap[at, np.minimum(depth, width - 1)], np.where(whole, at + 1, at))
        moved = dead | whole
        live = at < end[q]
        back = np.where(live, lcp[np.minimum(at, n - 1)], 0)
        depth = np.where(moved, np.minimum(back, depth), depth)
        q, at, depth = q[live], at[live], depth[live]
    return np.concatenate(first) if first else rows[:0], np.concatenate(second) if second else rows[:0]


def near_in_lists(lists: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) per word and list with a near word."""
    def chunk_result(t: pa.Table, starts: np.ndarray):
        m, size = letters(t.column("mid"))
        a, b = near_pairs(m, size, starts)
        grow, lo = t.column("grow").to_numpy(zero_copy_only=False), t.column("lo").to_numpy()
        if grow.any():  # a growing list: only words of different length, and each pair in one window
            ok = ~grow[a] | (size[a] != size[b])
            a, b = a[ok], b[ok]
            rest, rest_size = letters(t.column("rest"))
            long = np.where(size[a] > size[b], a, b)
            short = np.where(size[a] > size[b], b, a)
            same = (m[long] == m[short]) | (np.arange(m.shape[1]) >= size[short][:, None])
            prefix = same[np.arange(len(a)), :].all(axis=1)  # the longer one's extra letter comes last
            after = np.minimum(lo[long], rest.shape[1] - 1)
            more = (lo[long] < rest_size[long]) & (m[long, size[long] - 1] == rest[long, after])
            ok = ~(grow[a] & prefix & more)  # the place can be moved to the next window, which has it too
            a, b = a[ok], b[ok]
        if not len(a):
            return None
        used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        part = t.take(pa.array(used))
        words = [r[:x] + w + r[x:] for r, x, w in zip(part.column("rest").to_pylist(), part.column("lo").to_pylist(), part.column("mid").to_pylist())]
        n = part.column("n").to_numpy()
        order = np.empty(len(words), dtype=np.int64)
        order[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        a, b = at[:len(a)], at[len(a):]
        me, other = np.concatenate([a, b]), np.concatenate([b, a])
        by = np.lexsort((order[other], -n[other], me))
        me, other = me[by], other[by]
        each, top, times = np.unique(me, return_index=True, return_counts=True)
        best = other[top]
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i in each]), pa.array(times), pa.array(n[best]), pa.array([words[i] for i in best])],
                                          names=["word", "n_near", "best_n", "best"])

    def run(batches):
        for t, starts in whole_groups(batches, LISTED, WORDS, 4 << 20):
            ends = np.append(starts[1:], t.num_rows)
            several = ends - starts > 1
            if not several.any():
                continue
            starts, ends = starts[several], ends[several]
            width = np.maximum.reduceat(pc.utf8_length(t.column("mid")).to_numpy(), np.stack([starts, ends], 1).ravel()[:-1])[::2] + 3
            i = 0
            while i < len(starts):  # lists of a chunk have similar lengths; long words go in smaller chunks
                j, widest, held = i, 0, 0
                while j < len(starts):
                    widest_, held_ = max(widest, int(width[j])), held + int(ends[j] - starts[j])
                    if j > i and widest_ * held_ > CELLS:
                        break
                    widest, held, j = widest_, held_, j + 1
                keep = np.concatenate([np.arange(x, y) for x, y in zip(starts[i:j].tolist(), ends[i:j].tolist())])
                sizes = (ends - starts)[i:j]
                out = chunk_result(t.take(pa.array(keep)), np.cumsum(sizes) - sizes)
                if out is not None:
                    yield out
                i = j

    rows = lists.repartition(*LISTED).sortWithinPartitions(*LISTED, "mid")
    return rows.select(*LISTED, "mid", "n").mapInArrow(run, "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every (word, form) row: the end of the chain."""
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = written(at.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        if not after.filter("_moved").limit(1).count():
            return after.select("word", "root")
        at = after.select("word", "root")


def spelling_variants(docs: DataFrame, one_in: int | None = 97, shortest: int = 5, least: int = 3, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word. The form is the
    most frequent near word, if it is ``ratio`` times as frequent."""
    words = written(counts(docs, one_in, shortest, least), "spelling-words")
    best = F.min(F.struct((-F.col("best_n")).alias("_neg"), "best"))
    near = near_in_lists(bounded_lists(words)).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b"))
    found = words.join(near, "word", "left").withColumn("form_n", -F.col("_b._neg"))
    good = F.col("form_n") >= F.lit(ratio) * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(good, F.col("_b.best")).alias("form"),
                                 F.when(good, F.col("form_n")).alias("form_n")), "spelling-forms")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
