"""Language-model scores by deleted interpolation (operator 10).

A token's probability is l2 * c(h,w)/c(h) + l1 * c(w)/N + l0 / (V + 1):
maximum-likelihood bigram and unigram and a uniform part that also covers
unknown words. The weights depend on the bucket of the context's frequency
and are learned by expectation-maximisation on a deleted part of the
training rows, whose tokens are judged by the counts of the other part.

Counts cover all training rows and are never held in one place. Documents
are dealt into blocks of about ``BLOCK`` bytes by a hash. A block asks for
the counts of its distinct words and word pairs: sorted 64-bit hashes, split
by their leading bits into parts, with its own counts. Each part adds up
what the blocks sent and answers every block in the order it asked, so a
frequent word or pair is one number per block. Blocks then meet their
answers and score their documents; the texts travel compressed. The sums EM
needs are counts of (context bucket, quantised ratios of the three
probabilities), a table of bounded size, from all deleted tokens.

Null and empty texts are one end token. Null ids belong to the training
rows and are not held out. Repeated rows count repeatedly. Extra columns
are ignored. A text must fit a task's memory; there is no other limit.
Without training rows every probability is the uniform one. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text
from tessera.llm._store import text_bytes, written

BLOCK = 8 << 20  # bytes of text per block and per part
FOLDS, HELD_OUT, DELETED = 7, 2, 5
BUCKETS = 48  # of context frequencies: 0, then powers of two
STEP = 4  # quantisation of ratios: quarter octaves
U = np.uint64
START, END = U(0x243F6A8885A308D3), U(0x13198A2E03707344)
MAIN, HELD, DEL = 0, 1, 2


def squeeze(a: np.ndarray) -> bytes:
    """Integers as compressed byte planes (with their number in front)."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return len(a).to_bytes(8, "little") + bytes(pa.Codec("zstd", 1).compress(planes, asbytes=True))


def unsqueeze(b: bytes, kind) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    width = np.dtype(kind).itemsize
    if n == 0:
        return np.zeros(0, kind)
    planes = pa.Codec("zstd", 1).decompress(b[8:], n * width, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(kind).reshape(-1)


def small(a: np.ndarray) -> bytes:
    """Counts in the narrowest of 1, 2, 4 or 8 bytes."""
    top = int(a.max()) if len(a) else 0
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + squeeze(a.astype(kind))


def unsmall(b: bytes) -> np.ndarray:
    return unsqueeze(b[1:], f"<u{b[0]}").astype(np.int64)


# Documents of a block travel as rows of compressed texts.
PACK = "block long, n long, ids binary, known binary, kinds binary, texts binary"


def pack(docs: DataFrame, blocks: int) -> DataFrame:
    """(doc_id, text) in blocks. Documents of the deleted part have blocks of
    their own, from ``blocks`` on."""
    crc = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(-1))
    kind = F.when(crc == HELD_OUT, HELD).when(crc == DELETED, DEL).otherwise(MAIN)
    h = F.xxhash64("doc_id", "text")
    block = F.when(crc == DELETED, F.pmod(h, F.lit(max(1, blocks // FOLDS))) + blocks).otherwise(F.pmod(h, F.lit(blocks)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       kind.cast("byte").alias("kind"), block.cast("long").alias("block"))

    def run(batches):
        for batch in batches:
            where = batch.column(3).to_numpy()
            order = np.argsort(where, kind="stable")
            batch = batch.take(pa.array(order))
            where = where[order]
            cut = np.flatnonzero(np.diff(where)) + 1
            out = []
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(where)]):
                part = batch.slice(a, b - a)
                ids = part.column(0)
                texts = pc.fill_null(part.column(1), "")
                sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
                raw = next((d for _, d, _ in _text.slices(texts, 1 << 62)), np.zeros(0, np.uint8))
                out.append((int(where[a]), b - a, pc.fill_null(ids, 0).to_numpy().astype("<i8").tobytes(),
                            ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                            part.column(2).to_numpy().astype(np.uint8).tobytes(),
                            len(z := squeeze(sizes)).to_bytes(8, "little") + z + squeeze(raw)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64()] + [pa.binary()] * 4)],
                    names=["block", "n", "ids", "known", "kinds", "texts"])

    return rows.mapInArrow(run, PACK)


class Block:
    """Tokens of a block's documents, in a defined order."""

    def __init__(self, rows: pd.DataFrame):
        tokens, counts = [], []
        # rows arrive in any order; equal order in all passes is not needed,
        # since answers are aligned with sorted distinct hashes
        self.ids = np.frombuffer(b"".join(rows["ids"]), "<i8")
        self.known = np.frombuffer(b"".join(rows["known"]), np.uint8).astype(bool)
        self.kinds = np.frombuffer(b"".join(rows["kinds"]), np.uint8)
        for blob in rows["texts"]:
            k = int.from_bytes(blob[:8], "little")
            sizes = unsqueeze(blob[8:8 + k], np.int64)
            data = unsqueeze(blob[8 + k:], np.uint8)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            first = 0
            while first < len(sizes):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _text.SLICE, side="right")) - 1)
                w = _text.Words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                out = np.full(len(w.row) + len(w.count), END, dtype=np.uint64)
                out[np.arange(len(w.row)) + w.row] = w.hashes()
                tokens.append(out)
                counts.append(w.count + 1)
                first = last
        self.token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        self.size = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.first = np.cumsum(self.size) - self.size
        context = np.empty_like(self.token)
        if len(context):
            context[1:] = self.token[:-1]
            context[self.first] = START
        self.pair = _text.mix(context * U(0x9E3779B97F4A7C15) + _text.mix(self.token ^ U(0xB7E151628AED2A6B)))
        self.trains = np.repeat(self.kinds != HELD, self.size)
        # contexts are counted like words: a start token per document
        self.context = context


def part_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each part begins among sorted hashes (parts = leading bits)."""
    edges = np.arange(1 << bits, dtype=np.uint64) << U(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def known_words(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """All word hashes of a block with the start token, and their training flag."""
    starts = np.full(len(b.size), START, dtype=np.uint64)
    return np.concatenate([b.token, starts]), np.concatenate([b.trains, b.kinds != HELD])


ASK = "part long, block long, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWER = "block long, part long, words binary, pairs binary, words_main binary, pairs_main binary, n_tokens long, n_types long, n_main long"


def ask(packed: DataFrame, bits: int) -> DataFrame:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        b = Block(rows)
        block = int(rows["block"].iloc[0])
        out = []
        for keys, flags in (known_words(b), (b.pair, b.trains)):
            if flags.all() or not flags.any():
                u, n = np.unique(keys, return_counts=True)
                n = n * int(flags.any())
            else:
                u, inverse = np.unique(keys, return_inverse=True)
                n = np.bincount(inverse[flags], minlength=len(u))
            out.append((u, n, part_of(u, bits)))
        del b
        (wu, wn, we), (pu, pn, pe) = out
        table = []
        for p in range(1 << bits):
            i, j, k, m = we[p], we[p + 1], pe[p], pe[p + 1]
            table.append((p, block, squeeze(np.diff(wu[i:j], prepend=U(0))), small(wn[i:j]),
                          squeeze(np.diff(pu[k:m], prepend=U(0))), small(pn[k:m])))
        return pd.DataFrame(table, columns=["part", "block", "words", "word_counts", "pairs", "pair_counts"])

    return packed.groupBy("block").applyInPandas(run, ASK)


def answer(asked: DataFrame, blocks: int) -> DataFrame:
    """Per part: the counts of all hashes, answered block by block. Blocks of
    the deleted part also get the counts without that part."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        part = int(rows["part"].iloc[0])
        who = rows["block"].to_numpy()
        out: dict[str, list[bytes]] = {}
        n_tokens = n_types = n_main = 0
        for name, counts in (("words", "word_counts"), ("pairs", "pair_counts")):
            keys = [np.cumsum(unsqueeze(x, np.uint64)) for x in rows[name]]
            sizes = np.array([len(k) for k in keys])
            own = np.concatenate([unsmall(x) for x in rows[counts]])
            u, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            del keys
            deleted = np.repeat(who >= blocks, sizes)
            total = np.bincount(inverse, weights=own, minlength=len(u)).astype(np.int64)
            main = total - np.bincount(inverse[deleted], weights=own[deleted], minlength=len(u)).astype(np.int64)
            if name == "words":
                word = u != START
                n_tokens, n_types, n_main = int(total[word].sum()), int((total[word] > 0).sum()), int(main[word].sum())
            ends = np.cumsum(sizes)
            spans = list(zip(ends - sizes, ends))
            out[name] = [small(total[inverse[a:b]]) for a, b in spans]
            out[f"{name}_main"] = [small(main[inverse[a:b]]) if x >= blocks else b"" for (a, b), x in zip(spans, who)]
        table = pd.DataFrame({"block": who, "part": part, **{k: out[k] for k in ("words", "pairs", "words_main", "pairs_main")}})
        table["n_tokens"], table["n_types"], table["n_main"] = 0, 0, 0
        table.loc[0, ["n_tokens", "n_types", "n_main"]] = n_tokens, n_types, n_main
        return table

    return asked.groupBy("part").applyInPandas(run, ANSWER)


def parts_of_probability(b: Block, answers: pd.DataFrame, main: bool):
    """c(h), c(h,w) and c(w) of every token of the block."""
    answers = answers.sort_values("part")
    suffix = "_main" if main else ""
    words = np.concatenate([unsmall(x) for x in answers[f"words{suffix}"]])
    pairs = np.concatenate([unsmall(x) for x in answers[f"pairs{suffix}"]])
    n = len(b.token)
    _, inverse = np.unique(np.concatenate([b.token, np.full(len(b.size), START, dtype=np.uint64)]), return_inverse=True)
    of_word = words[inverse]
    c_w = of_word[:n]
    c_h = np.empty(n, np.int64)
    if n:
        c_h[1:] = c_w[:-1]
        c_h[b.first] = of_word[n:]
    _, inverse = np.unique(b.pair, return_inverse=True)
    return c_h, pairs[inverse], c_w


def bucket(c_h: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 of its count)."""
    return np.where(c_h > 0, np.minimum(BUCKETS - 1, 1 + np.floor(np.log2(np.maximum(c_h, 1))).astype(np.int64)), 0)


NONE = -10_000  # ratio of a part that is zero


def em_cells(packed: DataFrame, answers: DataFrame, n_main: int, types: int) -> DataFrame:
    """Counts of (bucket, ratio of bigram to uniform, of unigram to uniform)
    over the deleted tokens; ratios in 1/STEP octaves."""
    def run(key, docs: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"b": [], "r2": [], "r1": [], "n": []}, dtype="int64")
        c_h, c_hw, c_w = parts_of_probability(Block(docs), got, True)
        with np.errstate(divide="ignore", invalid="ignore"):
            r2 = np.where(c_hw > 0, np.round(STEP * np.log2(c_hw / np.maximum(c_h, 1) * (types + 1))), NONE).astype(np.int64)
            r1 = np.where(c_w > 0, np.round(STEP * np.log2(c_w / max(n_main, 1) * (types + 1))), NONE).astype(np.int64)
        cells, n = np.unique(np.stack([bucket(c_h), r2, r1]), axis=1, return_counts=True)
        return pd.DataFrame({"b": cells[0], "r2": cells[1], "r1": cells[2], "n": n})

    return (packed.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, "b long, r2 long, r1 long, n long")
            .groupBy("b", "r2", "r1").agg(F.sum("n").alias("n")))


def weights(cells: pd.DataFrame, rounds: int = 60) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) per bucket by EM. Every
    bucket is drawn a little (10 tokens) towards the weights of all; an
    unseen context has no bigram part."""
    lam = np.tile(np.array([0.4, 0.5, 0.1]), (BUCKETS, 1))
    if len(cells):
        b, n = cells["b"].to_numpy(), cells["n"].to_numpy(dtype=float)
        p = np.stack([np.where(cells[c] == NONE, 0.0, 2.0 ** (cells[c].to_numpy() / STEP)) for c in ("r2", "r1")]
                     + [np.ones(len(cells))], axis=1)
        pooled = lam[0]
        for _ in range(rounds):
            post = lam[b] * p
            post *= (n / post.sum(1))[:, None]
            pooled = post.sum(0) / n.sum()
            got = np.stack([np.bincount(b, weights=post[:, k], minlength=BUCKETS) for k in range(3)], axis=1)
            got += 10 * np.maximum(pooled, 1e-3)
            lam = got / got.sum(1, keepdims=True)
    lam[0] = [0.0, lam[0, 1] + lam[0, 0] / 2, lam[0, 2] + lam[0, 0] / 2]
    return lam


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_blocks(packed: DataFrame, answers: DataFrame, n: int, types: int, lam: np.ndarray) -> DataFrame:
    names = [x.split()[0] for x in SCORES.split(", ")]

    def run(key, docs: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({c: [] for c in names})
        b = Block(docs)
        c_h, c_hw, c_w = parts_of_probability(b, got, False)
        k = lam[bucket(c_h)]
        p = k[:, 0] * c_hw / np.maximum(c_h, 1) + k[:, 1] * c_w / max(n, 1) + k[:, 2] / (types + 1)
        base = np.log10((c_w + 1) / (n + types + 1))
        add = lambda x: np.add.reduceat(x, b.first)
        ids = pd.array(b.ids.astype("int64"), dtype="Int64")
        ids[~b.known] = pd.NA
        return pd.DataFrame({"doc_id": ids, "held_out": b.kinds == HELD, "n_tokens": b.size, "n_known": add((c_w > 0).astype(np.int64)),
                             "train_tokens": n, "base_score": add(base), "score": add(np.log10(p))})

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, SCORES)


def lm_scores(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select("doc_id", "text")
    size = text_bytes(docs)
    blocks = max(1, -(-size // block))
    bits = max(0, (blocks - 1).bit_length())
    packed = pack(docs, blocks)
    answers = written(answer(ask(packed, bits), blocks), "lm-answers")
    n, types, n_main = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "n_types", "n_main")]).first()
    deleted = F.col("block") >= blocks
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    cells = em_cells(pack(docs.filter(crc == DELETED), blocks), answers.filter(deleted).drop("words", "pairs"), n_main, types)
    lam = weights(cells.toPandas())  # at most BUCKETS x ratios x ratios cells
    return score_blocks(packed, answers.drop("words_main", "pairs_main"), n, types, lam)
