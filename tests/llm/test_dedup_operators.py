"""SimHash groups, connected components and repeated passages against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from samples import awkward, empty, long_text, twins

from basketry.llm import blobs, simhash, substring_dedup
from basketry.llm.components import components


def groups(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(0)
    for kind, top in (("u1", 300), ("<u2", 200_000), ("<u4", 1 << 40)):
        values = np.unique(rng.integers(0, top, 500))
        assert (blobs.unpack(blobs.pack(values, kind), kind) == values).all()
        assert len(blobs.unpack(blobs.pack(values[:0], kind), kind)) == 0


def test_components_of_chains_stars_and_pairs(spark):
    rng = random.Random(4)
    pairs = [(k, k + 1) for k in range(40)] + [(50, k) for k in range(51, 90)] + [(k, k) for k in range(90, 95)]
    pairs += [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(45)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = groups(161, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_links_join_exactly_what_is_near(spark, distance):
    rng = random.Random(distance)
    values = []
    for _ in range(25):
        start = rng.getrandbits(64)
        values.append(start)
        for far in (1, 2, 3, 4, 5, 6):
            values.append(start ^ sum(1 << b for b in rng.sample(range(64), far)))
    values = sorted({0, (1 << 64) - 1, 0xF, *values})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), distance).collect()
    assert all(bin((e.a ^ e.b) & ((1 << 64) - 1)).count("1") <= distance for e in edges)
    at = {v: k for k, v in enumerate(signed)}
    near = [(i, j) for i, j in itertools.combinations(range(len(values)), 2)
            if bin(values[i] ^ values[j]).count("1") <= distance]
    assert groups(len(values), [(at[e.a], at[e.b]) for e in edges]) == groups(len(values), near)


@pytest.mark.parametrize("distance", [1, 3])
def test_links_of_small_sets_are_whole(spark, distance):
    for seed in range(6):
        rng = random.Random(seed)
        values = [4, 12, 13, 9] if not seed else sorted(rng.sample(range(64 if distance == 1 else 4096), 14))
        edges = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long").coalesce(1), distance).collect()
        assert all((e.a ^ e.b).bit_count() <= distance for e in edges)
        at = {v: k for k, v in enumerate(values)}
        near = [(i, j) for i, j in itertools.combinations(range(len(values)), 2) if (values[i] ^ values[j]).bit_count() <= distance]
        assert groups(len(values), [(at[e.a], at[e.b]) for e in edges]) == groups(len(values), near)


def plain_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_of_awkward_documents(spark):
    docs = awkward(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    given = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, f"{plain_fingerprint(r.text):016x}") for r in given)
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == want
    of = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert of[1] == of[2] == of[3] == 1 and of[4] == of[14] == 4 and of[9] == of[10] == of[11] == 9 and of[7] == 7
    assert {r.component_id for r in rows if r.doc_id is None and r.fingerprint == "0" * 16} == {1}
    assert simhash.near_duplicates(empty(spark)).count() == 0


def plain_removal(docs, width):
    first = {}
    key = lambda i: float("inf") if i is None else i
    split = [(i, (t or "").encode().split()) for i, t in docs]
    for i, words in split:
        for k in range(len(words) - width + 1):
            window = tuple(words[k:k + width])
            first[window] = min(first.get(window, key(i)), key(i))
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - width + 1):
            if first[tuple(words[k:k + width])] < key(i):
                gone.update(range(k, k + width))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return Counter(out)


def test_repeated_words_against_brute_force(spark):
    rng = random.Random(8)
    shared = [" ".join(rng.choice("abc") for _ in range(n)) for n in (4, 5, 6, 12, 30)]
    docs = [(k, "\n".join(rng.choice([*shared, long_text(rng.randint(0, 20), rng.random())]) for _ in range(rng.randint(0, 6))))
            for k in range(120)]
    docs += [(None, shared[4]), (3, shared[4]), (3, shared[3])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = substring_dedup.remove_repeats(df, width=5).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows) == plain_removal(docs, 5)


def test_words_of_equal_rolling_hashes_make_windows_differ(spark):
    words = [f"w{k}" for k in range(49)]
    docs = [(k, " ".join([*words, t])) for k, t in enumerate(twins(1024) + twins(4096))] + [(9, " ".join([*words, twins(1024)[1]]))]
    rows = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {0: 0, 1: 0, 2: 0, 3: 0, 9: 50}


def test_small_chunks_and_many_buckets_change_nothing(spark, monkeypatch):
    text = long_text(300, 2)
    docs = [(k, text + " " + long_text(50, k)) for k in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 40)
    rows = substring_dedup.remove_repeats(df, width=50).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows) == plain_removal(docs, 50)


def test_awkward_documents_keep_their_columns(spark):
    docs = awkward(spark)
    out = substring_dedup.remove_repeats(docs, names=("a", "b", "c"))
    assert out.columns == [*docs.columns, "a", "b", "c"]
    rows = [tuple(r) for r in out.select("doc_id", "a", "b", "c").collect()]
    given = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(rows) == plain_removal(given, 50)
    replaced = substring_dedup.remove_repeats(docs)
    assert sorted(replaced.columns) == sorted({*docs.columns, "n_removed"})
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
