"""Byte-pair encoding and decoding of whole texts (operator 9).

``encode`` gives the same ids as the tokenizer's own library. Texts are cut
into pre-tokens with array operations on their UTF-8 bytes; the distinct
pre-tokens of a slice are encoded by a backtracking encoder: an
Aho-Corasick automaton yields the longest token at every position, a token
is accepted only if it is compatible with its predecessor (the pair would
not be merged differently, looked up in a memoised table), otherwise the
next shorter prefix token is tried. Decoding gathers bytes through an
offset table. Ids and decoded bytes of a slice are compared with the text,
so the round trip is checked for every row.

Rows are independent: no shuffle, one pass, state per worker bounded by
``CACHE`` pre-tokens. Null and empty texts have no tokens (empty id list,
digest of the empty string). Very long texts are handled whole. Repeated
rows and extra columns pass through; an empty table gives an empty one. An
input column named like an output column is replaced.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text
from tessera.llm._store import frugal, small_batches

CACHE = 200_000  # pre-tokens kept per worker (longer than 64 bytes: never)
SLICE = 4 << 20

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
# Characters with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def char_classes() -> np.ndarray:
    """Class of every code point for the pre-token pattern."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        if k := kinds.get(unicodedata.category(chr(c))[0]):
            table[c] = k
    table[WHITE_SPACE] = SPACE
    return table


class Vocabulary:
    """Tables of a byte-level BPE tokenizer file (JSON): bytes and merges of
    every token; its size is that of the file, so it may be broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        n = max([*ids.values(), *self.special.values()]) + 1
        self.token = [b""] * n
        for letters, i in ids.items():
            self.token[i] = bytes(byte[c] for c in letters)
        for content, i in self.special.items():
            self.token[i] = content
        self.pair: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.order = [0] * n  # position in the merge list; single bytes come first
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            i = ids[left + right]
            self.pair[ids[left], ids[right]] = i
            self.split[i] = (ids[left], ids[right])
            self.order[i] = rank + 1
        self.classes = char_classes()
        self.byte_offset = np.concatenate([[0], np.cumsum([len(t) for t in self.token])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(self.token), dtype=np.uint8)
        digits = [b"%d," % i for i in range(n)]
        self.digit_offset = np.concatenate([[0], np.cumsum([len(t) for t in digits])]).astype(np.int64)
        self.digits = np.frombuffer(b"".join(digits), dtype=np.uint8)


class Encoder:
    """Backtracking encoder over a vocabulary; one per Python worker."""

    def __init__(self, vocab: Vocabulary):
        import ahocorasick
        self.v = vocab
        special = set(vocab.special.values())
        by_bytes = {t: i for i, t in enumerate(vocab.token) if t and i not in special}
        self.automaton = ahocorasick.Automaton()
        for t, i in by_bytes.items():
            self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.by_letters = {t.decode("latin-1"): i for t, i in by_bytes.items()}
        self.length = [len(t) for t in vocab.token]
        self.reach = max(map(len, by_bytes), default=1)  # no match is longer
        self.shorter = {}  # token -> longest token that is a proper prefix of it
        for t, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in by_bytes), None)
        self.compatible: dict[tuple[int, int], bool] = {}
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether merging never joins across the border of a and b."""
        known = self.compatible.get((a, b))
        if known is None:
            known = self._fits(a, b)
            if len(self.compatible) < 2 * CACHE:
                self.compatible[a, b] = known
        return known

    def _fits(self, a: int, b: int) -> bool:
        order, split, pair = self.v.order, self.v.split, self.v.pair
        # A merge across the border happens iff it comes before the later
        # merge inside the two neighbours. Undo their merges from the last
        # one on: ``limit`` is the earliest merge undone so far (a merge at
        # the same rank wins only from the left).
        limit = 1 << 60
        while True:
            joined = pair.get((a, b))
            if joined is not None and order[joined] < limit:
                return False
            if order[a] > order[b]:
                limit, a = order[a], split[a][1]
            elif order[b]:
                limit, b = order[b] + 1, split[b][0]
            else:
                return True

    def longest(self, w: str) -> int:
        """Longest token at the start of ``w``: the automaton's walk from its
        root bounds the length, the last token on that walk is the match."""
        n = self.automaton.longest_prefix(w)
        find = self.by_letters.get
        t = find(w[:n])
        while t is None:
            n -= 1
            t = find(w[:n])
        return t

    def word(self, key: bytes) -> tuple[int, ...]:
        w = key.decode("latin-1")
        size = len(w)
        length, shorter, known, longest, reach = self.length, self.shorter, self.compatible, self.longest, self.reach
        t = longest(w[:reach])
        if length[t] == size:
            return (t,)
        open_ = bytearray(b"\1") * (size + 1)  # positions not yet given up
        out: list[int] = []
        at = 0
        while True:
            end = at + length[t]
            if open_[end]:
                if out:
                    ok = known.get((out[-1], t))
                    if ok is None:
                        ok = self.fits(out[-1], t)
                else:
                    ok = True
                if ok:
                    out.append(t)
                    if end == size:
                        return tuple(out)
                    at, t = end, longest(w[end:end + reach])
                    continue
            t = shorter[t]
            while t is None:  # nothing fits here: give the position up
                open_[at] = 0
                t = out.pop()
                at -= length[t]
                t = shorter[t]

    def forget(self) -> None:
        """Drops what was learned from texts (a worker serves other tasks too)."""
        self.cache.clear()
        self.compatible.clear()

    def words(self, keys: list[bytes]) -> list[tuple[int, ...]]:
        cache, out = self.cache, []
        for k in keys:
            ids = cache.get(k)
            if ids is None:
                ids = self.word(k)
                if len(k) <= 64 and len(cache) < CACHE:
                    cache[k] = ids
            out.append(ids)
        return out

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
        """Starts and ends of all pre-tokens, and the special tokens by start."""
        n = len(data)
        special: dict[int, int] = {}
        cuts = offsets
        raw = data.tobytes()
        for content, i in self.v.special.items():
            at = raw.find(content)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(content) <= offsets[row + 1]:
                    special[at] = i
                    cuts = np.concatenate([cuts, [at, at + len(content)]])
                    at = raw.find(content, at + len(content))
                else:
                    at = raw.find(content, at + 1)
        cut = np.zeros(n + 1, dtype=bool)
        cut[cuts] = True
        kind = self.v.classes[data]  # right for ASCII
        lead = np.flatnonzero(data >= 0xC0)
        head = np.ones(n, dtype=bool)
        if len(lead):
            b = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
            b0, b1, b2, b3 = b[lead], b[lead + 1] & 63, b[lead + 2] & 63, b[lead + 3] & 63
            cp = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1,
                          np.where(b0 < 0xF0, (b0 & 15) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
            kind[lead] = self.v.classes[cp]
            head = _text.chars(data)
            kind = kind[np.maximum.accumulate(np.where(head, np.arange(n), 0))]
        change = np.ones(n, dtype=bool)
        change[1:] = kind[1:] != kind[:-1]
        change |= cut[:n]
        run = np.flatnonzero(change)
        end = np.append(run[1:], n)
        k = kind[run]
        mark = np.zeros(n + 1, dtype=bool)
        mark[run] = True
        # a white-space run before another run of the same text gives up its
        # last character: a plain blank joins the next run, others stand alone
        s = np.flatnonzero((k == SPACE) & ~cut[end])
        if len(s):
            last = end[s] - 1
            while (inner := ~head[last]).any():
                last = last - inner
            mark[last] = True
            blank = data[last] == 0x20
            mark[end[s][blank]] = False
        # contractions: a lone apostrophe at a token start and a letter run
        q = np.flatnonzero((data[run] == 0x27) & (end - run == 1) & mark[run] & ~cut[end])
        q = q[k[q + 1] == LETTER] if len(q) else q
        if len(q):
            padded = np.concatenate([data, np.zeros(2, np.uint8)])
            a, b, until = padded[end[q]], padded[end[q] + 1], end[q + 1]
            one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
            two = np.zeros(len(q), dtype=bool)
            for x, y in (b"re", b"ve", b"ll"):
                two |= (a == x) & (b == y) & (until - end[q] >= 2)
            mark[end[q][one | two]] = False
            mark[end[q][one] + 1] = True
            mark[end[q][two] + 2] = True
        for at, i in special.items():
            mark[at:at + len(self.v.token[i])] = False
            mark[at] = True
        mark[n] = True
        border = np.flatnonzero(mark)
        return border[:-1], border[1:], special

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a slice and, per row, the running end among them."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        start, end, special = self.spans(data, offsets)
        hashes = _text.span_hashes(data, start, end)
        for at in special:
            hashes[np.searchsorted(start, at)] = np.uint64(0)  # told apart from ordinary text
        _, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        ids, ends = self._assemble(data, start[where], end[where], special, which)
        back, _ = _text.gather(self.v.bytes, self.v.byte_offset, ids)
        if len(back) != len(data) or not np.array_equal(back, data):  # two pre-tokens with one hash
            ids, ends = self._assemble(data, start, end, special, np.arange(len(start)))
        rows = np.searchsorted(start, offsets[1:], side="left")  # pre-tokens up to each row's end
        return ids, np.concatenate([[0], ends])[rows]

    def _assemble(self, data, start, end, special, which):
        raw = data.tobytes()
        keys = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        lists = self.words(keys)
        if special:
            for j, a in enumerate(start.tolist()):
                if a in special:
                    lists[j] = (special[a],)
        size = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(size.sum()))
        return _text.gather(flat, np.concatenate([[0], np.cumsum(size)]), which)


_encoders: dict[str, Encoder] = {}


def _encoder(key: str, shared) -> Encoder:
    if key not in _encoders:
        _encoders[key] = Encoder(shared.value)
    return _encoders[key]


def encode(docs: DataFrame, tokenizer: str, ids: bool = True, digests: bool = False,
           text: str = "text", joined: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text, with n_tokens (long), ids
    (array<int>, if asked for) and digests (ids_sha256 of the decimal ids
    joined by commas, decoded_sha256 of the text decoded from the ids). With
    ``joined`` ids are a string, the decimal ids joined by commas."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(tokenizer))  # the file's size
    added = [T.StructField("n_tokens", T.LongType())]
    if ids:
        added.append(T.StructField("ids", T.StringType() if joined else T.ArrayType(T.IntegerType())))
    if digests:
        added += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    names = {f.name.lower() for f in added}
    keep = [f for f in docs.schema.fields if f.name != text and f.name.lower() not in names]
    schema = T.StructType([*keep, *added])
    quoted = ["`" + f.name.replace("`", "``") + "`" for f in keep]
    # the text goes last, under its position: other columns keep their names
    source = docs.select(*[F.col(c) for c in quoted], F.col(f"`{text}`").cast("string").alias(text))

    @frugal
    def run(batches):
        enc = _encoder(tokenizer, shared)
        v = enc.v
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first, data, offsets in _text.slices(texts, SLICE):
                rows = len(offsets) - 1
                got, ends = enc.encode(data, offsets)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                out = [batch.column(i).slice(first, rows) for i in range(len(keep))]
                out.append(pa.array(ends - starts, type=pa.int64()))
                if ids and joined:
                    blob, where = _text.gather(v.digits, v.digit_offset, got)
                    where = np.concatenate([[0], where])
                    blob = blob.tobytes()
                    out.append(pa.array([blob[x:max(x, y - 1)].decode() for x, y in zip(where[starts].tolist(), where[ends].tolist())],
                                        type=pa.string()))
                elif ids:
                    border = pa.array(np.concatenate([[0], ends]), type=pa.int32())
                    out.append(pa.ListArray.from_arrays(border, pa.array(got, type=pa.int32())))
                if digests:
                    for table, offset, comma in ((v.digits, v.digit_offset, 1), (v.bytes, v.byte_offset, 0)):
                        blob, where = _text.gather(table, offset, got)
                        where = np.concatenate([[0], where])
                        blob = blob.tobytes()
                        a, b = where[starts].tolist(), where[ends].tolist()
                        out.append(pa.array([hashlib.sha256(blob[x:max(x, y - comma)]).hexdigest()
                                             for x, y in zip(a, b)], type=pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in schema.fields])
        enc.forget()

    return source.mapInArrow(run, schema)


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Replaces the id list by its text (special tokens included); a null
    list gives a null text, bytes that are not UTF-8 become U+FFFD."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(tokenizer))
    keep = [f for f in tokens.schema.fields if f.name not in (ids, text)]
    schema = T.StructType([*keep, T.StructField(text, T.StringType())])
    quoted = ["`" + f.name.replace("`", "``") + "`" for f in keep]
    source = tokens.select(*[F.col(c) for c in quoted], F.col(f"`{ids}`").alias(ids))

    def run(batches):
        v = shared.value
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            border = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)[border[0]:border[-1]]
            blob, where = _text.gather(v.bytes, v.byte_offset, flat)
            where = np.concatenate([[0], where])[border - border[0]].tolist()
            blob = blob.tobytes()
            known = lists.is_valid().to_pylist()
            texts = [blob[a:b].decode("utf-8", "replace") if ok else None
                     for a, b, ok in zip(where[:-1], where[1:], known)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(texts, pa.string())],
                                             names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema)
