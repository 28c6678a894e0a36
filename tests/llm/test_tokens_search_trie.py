"""Token files, ranked search and the prefix trie against the library and plain Python."""

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from samples import TEXTS, awkward, empty, long_text, twins

from basketry.llm import lexical_search, prefix_trie, simple8b, token_files
from basketry.llm.parens import Parens

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


# --- token files ---------------------------------------------------------------------------------------------


def number_lists():
    rng = np.random.default_rng(3)
    lists = [[], [0], [2**32 - 1], [2**30 - 1, 2**30], [0] * 500, [1, 2**31, 1] * 50, [32767, 32766, 5] * 9, [1 << 20] * 7]
    lists += [rng.integers(0, 1 << int(rng.integers(1, 33)), int(rng.integers(1, 900))).tolist() for _ in range(60)]
    return lists + [np.where(rng.random(5000) < 0.02, 50_000, rng.integers(0, 300, 5000)).tolist()]


def test_words_hold_any_numbers():
    for values in number_lists():
        words, escapes = simple8b.encode(np.array(values, np.uint32))
        assert simple8b.decode(words, escapes, len(values)).tolist() == values
        assert len(words) <= max(1, len(values))
    dense = number_lists()[-1]
    words, escapes = simple8b.encode(np.array(dense, np.uint32))
    assert len(escapes) and 64 * len(words) + 32 * len(escapes) < 12 * len(dense)
    for wrong in ((words, escapes[:-1], len(dense)), (words[:-1], escapes, len(dense)), (words * np.uint64(0), escapes, len(dense))):
        with pytest.raises(ValueError):
            simple8b.decode(*wrong)


def test_blocks_know_their_documents(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 64)
    rng = random.Random(4)
    sizes = np.array([rng.choice([1, 2, 30, 64, 65, 400]) for _ in range(120)])
    ids = np.random.default_rng(4).integers(0, 60_000, int(sizes.sum()))
    out = io.BytesIO()
    writer = token_files.Writer(out)
    at = 0
    for first in range(0, 120, 7):
        part = sizes[first:first + 7]
        names = np.arange(first, first + len(part))
        writer.add(ids[at:at + part.sum()], part, names, names % 10 == 0)
        at += part.sum()
    writer.close()
    reader = token_files.Reader(pa.BufferReader(out.getvalue()))
    starts = np.cumsum(sizes) - sizes
    for run in (1, 3, 1000):
        got = [x for k in range(0, reader.n_blocks, run) for x in reader.documents(k, min(k + run, reader.n_blocks))]
        assert [x[0] for x in got] == [None if k % 10 == 0 else k for k in range(120)]
        assert [x[1] for x in got] == starts.tolist() and [x[2] for x in got] == sizes.tolist()
        assert np.concatenate([p for x in got for p in x[3]]).tolist() == ids.tolist()
    damaged = bytearray(out.getvalue())
    damaged[100] ^= 1
    with pytest.raises(ValueError):
        list(token_files.Reader(pa.BufferReader(bytes(damaged))).documents(0, 9))


def library_rows(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    turns = spark.createDataFrame([(t or "",) for _, t in texts], "t string").select(F.xxhash64("t")).collect()
    lined = sorted(((i is not None, i or 0, turn[0], t or "") for (i, t), turn in zip(texts, turns)))
    out, start = [], 0
    for has_id, i, _, text in lined:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        out.append((i if has_id else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("texts", [TEXTS, [(k * 7 % 300, long_text(k % 200, k)) for k in range(300)] + [(5, t) for t in twins(1024)]])
def test_tokens_round_trip(spark, folder, monkeypatch, texts):
    want = library_rows(spark, texts)
    docs = awkward(spark, texts).repartition(3)
    assert Counter(tuple(r) for r in token_files.round_trip(docs, BYTE_BPE).collect()) == Counter(w[:4] for w in want)
    files = token_files.write_tokens(docs, BYTE_BPE, folder)
    rows = token_files.read_tokens(files).collect()
    assert Counter((r.doc_id, r.start, tuple(r.ids)) for r in rows) == Counter((w[0], w[1], tuple(w[4])) for w in want)
    total = files.agg(F.sum("documents"), F.sum("ids")).first()
    assert tuple(total) == (len(texts), sum(w[2] for w in want))


def test_no_documents_make_no_files(spark):
    assert token_files.round_trip(empty(spark), BYTE_BPE).count() == 0


# --- ranked search -------------------------------------------------------------------------------------------


def plain_terms(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def plain_search(docs, items, k=10):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    n_words = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        rows = []
        for i, b in bags:
            m = 10 + 90 * b.total() * n_docs // n_words if n_words else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                        for t in terms if b[t])
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(rows)[:k], 1)]
    return Counter(out)


ITEM_SCHEMA = "item_id long, text string, doc_id string, score string, rank string, bag string"


def item_rows(spark, items):
    return spark.createDataFrame([(i, t, "d", "s", "r", "b") for i, t in items], ITEM_SCHEMA)


def test_search_of_awkward_documents(spark):
    items = [(1, "one THREE"), (2, "Bé naïve, 中文😀 x"), (3, None), (4, ""), (None, "word"), (5, "id. nothing"), (5, "one"),
             (6, " ".join(long_text(60, 1).split())), (7, "zzzzzz")]
    rows = lexical_search.search(awkward(spark), item_rows(spark, items)).collect()
    assert Counter(tuple(r) for r in rows) == plain_search(TEXTS, items)
    assert lexical_search.search(empty(spark), item_rows(spark, items)).count() == 0
    assert lexical_search.search(awkward(spark), item_rows(spark, [])).count() == 0


def test_search_in_rounds_blocks_and_classes(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(40)]
    docs = [(rng.randint(0, 400), " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 40])))) for _ in range(500)]
    docs += [(k, "w1 w2 w3") for k in range(900, 800, -1)] + [(None, "w1 w2 w3")]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 9)))) for k in range(30)]
    want = plain_search(docs, items)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in lexical_search.search(df, item_rows(spark, items)).collect()) == want
    for name, value in (("ROUND_BYTES", 300), ("ITEMS", 4), ("CLASSES", 7), ("EXACT", 1)):
        monkeypatch.setattr(lexical_search, name, value)
    assert Counter(tuple(r) for r in lexical_search.search(df, item_rows(spark, items)).collect()) == want


def test_copies_are_one_class(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("alpha beta alpha").alias("text"))
    table = lexical_search.bags(docs, [b"alpha", b"beta"], "doc_id", "text")
    rows = lexical_search._classes(table, 3000, 9000, 10).collect()
    assert len(rows) == 1 and [m.id for m in rows[0].members] == list(range(10))


# --- the trie ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("deep", [0.2, 0.5, 0.95])
def test_parentheses_close_where_they_should(deep):
    for n in (1, 2, 70, 3000):
        rng, opens, open_now = random.Random(n), [True], 1
        while sum(opens) < n:
            opens.append(open_now < 2 or rng.random() < deep)
            open_now += 1 if opens[-1] else -1
        opens = np.array(opens + [False] * open_now)
        stack, close = [], {}
        for k, o in enumerate(opens.tolist()):
            if o:
                stack.append(k)
            else:
                close[stack.pop()] = k
        tree = Parens(opens)
        assert tree.find_close(tree.starts).tolist() == [close[k] for k in tree.starts.tolist()]
        pairs = opens[:-1] & ~opens[1:]
        assert tree.leaves(tree.sizes()).tolist() == [int(pairs[k:close[k]].sum()) for k in tree.starts.tolist()]


def plain_nodes(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()[:16]
            turns[c].append((turn is not None, turn or 0, digest, role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    out, below = Counter(), {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(below[k][0] for k in kids[node]) or 1
        saved = sum(below[k][1] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        below[node] = leaves, saved
        ends = ",".join(map(str, sorted(c for c in members[node] if paths[c] == node)))
        out[min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids[node]),
            leaves, saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def trie_rows(spark, rows):
    return spark.createDataFrame([(*r, "k", "p", "s") for r in rows], "conv_id long, turn long, role string, text string, key string, path string, shard string")


def conversations(seed, n, lengths, texts):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", None]) if texts > 3 else "user", f"é{rng.randint(0, texts)}" if rng.random() < 0.95 else None)
            for c in rng.sample(range(-20, 5 * n), n) for t in range(rng.choice(lengths))]


@pytest.mark.parametrize("rows", [
    conversations(1, 60, [1, 2, 9, 14], 1), conversations(2, 200, [1, 3, 10, 12], 4), conversations(3, 40, [10, 30], 0),
    [(c, t, "user", "same") for c in range(300) for t in range(11)], [(7, 0, "user", "alone")], [(3, 0, None, None), (4, None, "", "")],
    [(None, 1, "user", "nobody"), (5, None, "b", "x"), (5, None, "a", "x"), (5, 1, "a", "x"), (5, 1, "a", "x"), (6, 2, "a", "y" * 99_999)],
    [(25, t, "user", f"{t % 3}") for t in range(4000)] + [(26, t, "user", f"{t % 3}") for t in range(3990)],
])
def test_nodes_against_brute_force(spark, rows):
    got = prefix_trie.nodes(trie_rows(spark, rows).repartition(5)).collect()
    assert Counter(tuple(r) for r in got) == plain_nodes(rows)


def test_many_shards_and_short_pieces_change_nothing(spark, monkeypatch):
    rows = conversations(5, 150, [1, 9, 12], 2) + [(c, t, "user", "same") for c in range(2000, 2400) for t in range(10)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 50)
        assert Counter(tuple(r) for r in prefix_trie.nodes(trie_rows(spark, rows)).collect()) == plain_nodes(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert prefix_trie.nodes(trie_rows(spark, [])).count() == 0
