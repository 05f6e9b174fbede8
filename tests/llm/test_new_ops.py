"""Spelling variants, LSH forest and conversation trie against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import conversation_trie, lsh_forest, spelling
from tessera.llm._runs import whole_groups
from tessera.llm.registry import table
from tests.llm.fixtures import SF_SMALL, awkward_docs, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_whole_groups_keeps_groups_together():
    keys = sorted(random.Random(3).choices(range(40), k=500))
    t = pa.table({"k": keys, "v": range(500)})
    seen = []
    for chunk, starts in whole_groups(t.to_batches(max_chunksize=7), ["k"], 20, 1 << 20):
        got = chunk.column("k").to_pylist()
        assert not set(got) & set(seen)
        assert [got[i] for i in starts] == sorted(set(got))
        seen += got
    assert seen == keys


# spelling variants

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows, one_in=97, shortest=5, least=3):
    seen = collections.Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if one_in and h % one_in == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            seen[w] += 1
    words = {w: n for w, n in seen.items() if len(w) >= shortest and n >= least}
    near, by = collections.defaultdict(set), collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by[w[:i] + "*" + w[i + 1:]].add(w)
            less = w[:i] + w[i + 1:]
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for group in by.values():
        for w in group:
            near[w] |= group - {w}
    form = {w: min(near[w], key=lambda x: (-words[x], x)) if near[w] else None for w in words}
    form = {w: f if f and words[f] >= 2 * words[w] else None for w, f in form.items()}
    out = collections.Counter()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w, form[w], root, n, len(near[w]), words.get(form[w])] += 1
    return out


def result(df):
    return collections.Counter(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def test_banded_rows_find_all_pairs():
    rnd = random.Random(1)
    for _ in range(150):
        lists = []
        for _ in range(rnd.randint(1, 5)):
            letters = rnd.choice(["ab", "abcdé", "a"])
            lists.append(sorted({"".join(rnd.choices(letters, k=rnd.randint(0, 7))) for _ in range(rnd.randint(1, 25))}))
        starts = np.cumsum([0] + [len(x) for x in lists])
        m, size = spelling.letters(pa.array([w for x in lists for w in x]))
        a, b = spelling.near_pairs(m, size, starts[:-1])
        want = {(s + i, s + j) for s, x in zip(starts.tolist(), lists) for i, j in itertools.combinations(range(len(x)), 2) if one_edit(x[i], x[j])}
        assert len(a) == len(want) and set(zip(a.tolist(), b.tolist())) == want


def test_spelling_variants_match_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert result(spelling.spelling_variants(docs)) == variants(docs.select("doc_id", "text").collect())


def test_spelling_lists_are_cut_and_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LIST", 3)
    monkeypatch.setattr(spelling, "PIECE", 50)
    rnd = random.Random(5)
    rows = [(i % 9 or None, " ".join("".join(rnd.choices("abÀé", k=rnd.randint(4, 7))) for _ in range(60))) for i in range(30)]
    rows += [(50, "aaaaa aaaaaa aaaaaaa " * 4 + "AAAAA!aaaaÿ"), (50, "aaaaa aaaaaa aaaaaaa " * 4 + "AAAAA!aaaaÿ"), (51, None), (52, ""), (53, "x" * 3000 + " " + "x" * 2999)] * 2
    docs = spark.createDataFrame([(*r, "clash", 7) for r in rows], "doc_id long, text string, word string, n int")
    for one_in in (97, 2, None):
        assert result(spelling.spelling_variants(docs, one_in)) == variants(rows, one_in)
    assert spelling.spelling_variants(empty_docs(spark)).count() == 0
    assert result(spelling.spelling_variants(awkward_docs(spark))) == variants(awkward_docs(spark).select("doc_id", "text").collect())


# LSH forest

def groups(rows, k, percent):
    cls, n = collections.defaultdict(list), []
    for i, (_, text) in enumerate(rows):
        w = WORD.findall((text or "").translate(LOWER))
        s = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
        n.append(len(s))
        if s:
            cls[s].append(i)
    sets = list(cls)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(sets)), 2):
        if min(len(sets[i]), len(sets[j])) * 100 >= percent * max(len(sets[i]), len(sets[j])):
            both = len(sets[i] & sets[j])
            if both * 100 >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    members = collections.defaultdict(list)
    for i, s in enumerate(sets):
        members[find(i)] += cls[s]
    comp = {i: rows[i][0] for i in range(len(rows))}
    for m in members.values():
        ids = [rows[i][0] for i in m if rows[i][0] is not None]
        comp.update({i: min(ids) if ids else None for i in m})
    return collections.Counter((rows[i][0], n[i], comp[i], rows[i][0] == comp[i]) for i in range(len(rows)))


def near_copies(seed, bases, copies, words=40):
    rnd = random.Random(seed)
    rows = []
    for b in range(bases):
        text = [f"w{rnd.randint(0, 300)}" for _ in range(words)]
        for _ in range(copies):
            own = list(text)
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                own[rnd.randrange(words)] = f"x{rnd.randint(0, 9)}"
            rows.append((len(rows) + 10, " ".join(own)))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_forest_matches_brute_force(spark, monkeypatch, small):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    rows += [(r[0] + 10**6, r[1]) for r in near_copies(2, 6, 60)]
    if small:  # regions go to full depth and blocks, visitors travel in lots
        for name, value in (("REGION", 8), ("HUBS", 2), ("VISITORS", 3)):
            monkeypatch.setattr(lsh_forest, name, value)
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, node int, kept boolean").repartition(5)
    got = lsh_forest.near_duplicates(docs, 3, 85)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = collections.Counter(tuple(r) for r in got.collect())
    want = groups(rows, 3, 85)
    assert got == want
    assert sum(n for r, n in want.items() if not r[3]) > 100


def test_forest_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert collections.Counter(tuple(r) for r in lsh_forest.near_duplicates(docs).collect()) == groups(rows, 5, 80)
    assert lsh_forest.near_duplicates(empty_docs(spark)).count() == 0


# conversation trie

def trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    seq = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seq[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:])
    members, kids = collections.defaultdict(list), collections.defaultdict(set)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            kids[s[:-1]].add(s)
    leaves, saved = collections.Counter(), collections.Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not kids[s]
            saved[s[:d]] += (len(m) - 1) * (len(s[-1][1]) if s else 0)
    out = collections.Counter()
    for s, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if seq[c] == s)
        out[min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(df):
    assert df.columns == NODE
    return collections.Counter(tuple(r) for r in df.collect())


def test_trie_matches_brute_force(spark):
    df = table(spark, SF_SMALL, "conversations")
    assert nodes(conversation_trie.prefix_trie(df)) == trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_trie_merges_borders_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "FAN", 2)
    monkeypatch.setattr(conversation_trie, "SHARD", 20)
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(["u", "a"]), rnd.choice(["", "x", "long 🙂"])) for c in range(-150, 150) for t in range(rnd.randint(0, 7))]
    rows += [(7, t, "u", "same") for t in range(120)] + [(c, t, "u", "hot") for c in range(1000, 1100) for t in range(3)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n_convs int").repartition(4)
    assert nodes(conversation_trie.prefix_trie(df)) == trie(rows)


def test_trie_awkward_rows(spark):
    rows = [(None, 1, "u", "x"), (1, None, "u", "first"), (1, None, None, None), (1, 2, "u", "x"), (1, 2, "u", "x"), (100, 0, None, "a"), (100, 1, "", "b"),
            (101, 0, "u", "c"), (102, 0, "u", "y" * 100_000), (-5, 0, "u", "neg"), (3, 0, "u", "only"), (0, 0, "u", "base")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert nodes(conversation_trie.prefix_trie(df)) == trie(rows)
    assert conversation_trie.prefix_trie(df.limit(0)).count() == 0


# column names in pipeline stages, long pre-tokens

CLASHES = ["_t", "_h", "_n", "_score", "_found", "_text", "_copies", "_id", "a.b", "a`b"]


def test_stages_keep_columns_whatever_their_names(spark):
    import corpus_pipeline as c
    docs = table(spark, SF_SMALL, "documents").limit(40)
    wide = docs.toDF(*docs.columns)
    for i, name in enumerate(CLASHES):
        wide = wide.withColumn(f"c{i}", lsh_forest.F.col("doc_id") * 100 + i)
    wide = wide.toDF(*docs.columns, *CLASHES)
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, wide, SF_SMALL)
        assert out.columns == wide.columns, name
        for r in out.collect():
            assert list(r)[len(docs.columns):] == [r["doc_id"] * 100 + i for i in range(len(CLASHES))], name


def test_long_pretokens_are_linear():
    import time
    import tokenizers
    from tessera.llm import _text, bpe
    from tessera.llm.registry import tokenizer_path
    enc = bpe.Encoder(bpe.Vocabulary(tokenizer_path()))
    rnd = random.Random(4)
    text = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=4_000_000))
    began = time.thread_time()
    [(_, data, offsets)] = list(_text.slices(pa.array([text]), 1 << 20))
    ids, _ = enc.encode(data, offsets)
    assert time.thread_time() - began < 60
    library = tokenizers.Tokenizer.from_file(str(tokenizer_path()))
    library.no_truncation()
    library.no_padding()
    part = text[:200_000]
    [(_, data, offsets)] = list(_text.slices(pa.array([part])))
    assert enc.encode(data, offsets)[0].tolist() == library.encode(part, add_special_tokens=False).ids
