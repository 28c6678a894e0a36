"""Archives, url lists, packing and the pipeline."""

import gzip
import io
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import TEXTS, awkward, empty, long_text, twins

import corpus_pipeline
from basketry.llm import packing, quality_classifier, url_filter, warc
from basketry.llm.cutting_stock import best_pattern, rounded, solve

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


# --- archives ------------------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, digest string, target string")


def test_records_are_owned_by_one_range_each():
    payloads = [random.Random(k).randbytes(k * 37 % 900) + warc.MAGIC * (k % 3) for k in range(60)]
    payloads.append(gzip.compress(b"WARC/9 no record"))
    raw = [warc.record(k, "u", p, "0", None, False) for k, p in enumerate(payloads)]
    data = b"".join(gzip.compress(r) for r in raw)
    for size in (1, 7, 100, 1000, 10_000, len(data)):
        if size < 100 and len(data) / size > 3000:
            starts = range(0, 2000, size)
        else:
            starts = range(0, len(data), size)
        got = [r for s in starts for r in warc.records_in(io.BytesIO(data), s, min(s + size, len(data)))]
        assert got == raw[:len(got)] and (len(got) == len(raw) or size < 100)
    with pytest.raises(ValueError):
        list(warc.records_in(io.BytesIO(data[:-40]), 0, len(data)))


def test_archives_round_trip(spark, folder):
    big, small = "é" * 600, "b" * 999
    rows = [(1, "http://a/", big), (2, None, big), (3, "http://b/\r\nX: y", big), (4, "u", small), (5, "u", small),
            (6, "u", None), (7, "u", ""), (None, "u", big), (None, "u", "c" * 2000), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 99), (3, "u", big)]
    files = warc.write_archives(pages(spark, rows), folder)
    out = warc.read_archives(files, range_bytes=100).collect()
    assert len(out) == len(rows)
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in out)
    assert kinds[1, "revisit", 3] == kinds[2, "revisit", 3] == kinds[None, "revisit", 3] == 1 and kinds[3, "response", None] == 2
    assert kinds[4, "response", None] == kinds[5, "response", None] == kinds[None, "response", None] == 1
    by = {r.page_id: r for r in out if r.page_id}
    assert by[1].payload_bytes == by[3].payload_bytes == 1200 and by[1].payload_digest == by[3].payload_digest
    assert by[3].payload.decode() == big and by[1].payload is None and by[8].payload.decode() == rows[9][2] and by[6].payload_bytes == 0
    assert warc.round_trip(pages(spark, []), folder + "/none").count() == 0


def test_long_headers_begin_a_range(spark, folder):
    urls = ["http://a/" + "".join(random.Random(k).choices("abcdefgh0123456789", k=n)) for k, n in enumerate((100_000, 9, 3_000_000, 65_300))]
    raw = [warc.record(k, u, b"x" * 50, "0", None, False) for k, u in enumerate(urls)]
    data = b"".join(gzip.compress(r) for r in raw)
    for size in (1000, 50_000, len(data)):
        got = [r for s in range(0, len(data), size) for r in warc.records_in(io.BytesIO(data), s, min(s + size, len(data)))]
        assert got == raw
    rows = [(k, u, "x" * 50) for k, u in enumerate(urls)]
    df = pages(spark, rows).repartition(1)
    files = warc.write_archives(df, folder + "/a")
    for size in (1000, warc.RANGE_BYTES):
        out = warc.read_archives(files, range_bytes=size).collect()
        assert sorted((r.page_id, r.url) for r in out) == [(k, u) for k, u, _ in rows]
    assert warc.round_trip(df, folder + "/b").count() == len(rows)


def test_missing_records_are_an_error(spark, folder):
    files = warc.write_archives(pages(spark, [(k, "u", "x") for k in range(5)]), folder)
    rows = warc.read_archives(files, with_payload=False)
    assert warc.complete(rows, files).count() == 5
    with pytest.raises(ValueError):
        warc.complete(rows.where("page_id > 0"), files)


# --- url lists -----------------------------------------------------------------------------------------------


def plain_judge(url, rules):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h) + len(p), len(h), f"{h}/{p}", v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_rules_against_brute_force(spark):
    rng = random.Random(6)
    parts = ["a", "b", "net", "example", "org", "en", "english", "x1", "Ä"]
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in (
        (".".join(rng.choice(parts) for _ in range(rng.randint(1, 3))),
         "/".join(rng.choice(["", *parts]) for _ in range(rng.randint(0, 3)))) for _ in range(150))}.values())
    urls = ["{}://{}{}{}".format(
        rng.choice(["http", "", "s://t"]), ".".join(rng.choice([*parts, "NET", ""]) for _ in range(rng.randint(0, 4))),
        "".join("/" + rng.choice(["", *parts]) for _ in range(rng.randint(0, 4))), rng.choice(["", "?a=/en/", "#://net/", "?"]))
        for _ in range(1500)]
    urls += [None, "", "nothing", "://", "http://", "http://net", "http://NET/", "http://net?x", "HTTP://a.net:80/en/", "x\n://net/\n"]
    urls += ["x" * 100_000, "http://" + "y" * 50_000 + ".net/" + "z" * 100_000 + "?", "http://net/" + "é/" * 300]
    df = spark.createDataFrame([(k, u, "r", "h") for k, u in enumerate(urls)], "page_id long, url string, row string, host string")
    listed = spark.createDataFrame([*rules, rules[0], (None, "a", "block")], "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, listed).collect()}
    assert len(got) == len(urls)
    for k, url in enumerate(urls):
        assert got[k] == plain_judge(url, rules), url


def test_rules_of_the_registered_query(spark, folder):
    from basketry.llm.queries import QUERIES

    paths = {"http://a.org/fr": None, "http://a.org/fr/": "org/fr/", "http://org/fr/x": "org/fr/", "http://a.org/france/": None,
             "http://example.net/en/": "example.net/en/", "http://example.net/english/": "net/", "http://x.example.com/de/": "example.com/de/",
             "http://example.com/de": None, "http://notnet/": None, "http://net": None}
    spark.createDataFrame(list(enumerate(paths)), "page_id long, url string").write.parquet(f"{folder}/pages.parquet")
    rows = {r.page_id: (r.rule, r.verdict) for r in QUERIES["op2_url_filter"](spark, folder).collect()}
    for k, (url, rule) in enumerate(paths.items()):
        assert rows[k] == (rule, "block" if rule in ("net/", "example.com/de/") else "allow"), url


def test_urls_of_many_parts(spark):
    urls = ["http://example.net/" + "/" * 1_000_000, "http://" + "." * 1_000_000 + "net/x", "http://" + "a." * 200_000 + "org/" + "fr/" * 200_000]
    rules = [("net", "", "block"), ("example.net", "/", "allow"), ("org", "fr/fr/", "block"), ("a.a.org", "", "allow")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    started = time.monotonic()
    got = {r.page_id: r.rule for r in url_filter.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {0: "example.net//", 1: "net/", 2: "org/fr/fr/"} and time.monotonic() - started < 20


def test_urls_without_rules_pages_or_ids(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([(None, "http://A.b/c"), (1, None), (1, None)], "page_id long, url string")
    rows = Counter(tuple(r) for r in url_filter.judge(df, none).collect())
    assert rows == {(None, "a.b", "/c", None, "allow"): 1, (1, "", "", None, "allow"): 2}
    assert url_filter.judge(df.limit(0), none).count() == 0


# --- packing -------------------------------------------------------------------------------------------------


def test_knapsack_and_program_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes, values = np.unique(rng.integers(1, 9, 4)), None
        values = rng.random(len(sizes))
        best, pattern = best_pattern(values, sizes, 12)
        assert pattern @ sizes <= 12 and pattern @ values == pytest.approx(best)
        import itertools

        every = max(float(np.dot(c, values)) for c in itertools.product(range(13), repeat=len(sizes)) if np.dot(c, sizes) <= 12)
        assert best == pytest.approx(every)
    sizes, demand = np.array([3, 5, 7]), np.array([30, 20, 10])
    patterns, amounts = solve(sizes, demand, 10)
    assert (amounts @ patterns == pytest.approx(demand)) and amounts.sum() == pytest.approx(26.0, abs=1.0)
    assert (patterns @ sizes <= 10).all()
    counts = rounded(patterns, amounts, demand, 25)
    assert counts.sum() <= 25 and (counts @ patterns <= demand).all()


def check_packing(rows, ids_of, room=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
        assert len(r.ids) == r.length > 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == room or (at < room and at & (at - 1) == 0)
    for doc, parts in by_doc.items():
        want = Counter()
        for ids in ids_of[doc]:
            want.update(enumerate(ids))
        got = Counter((r.start + k, x) for r in parts for k, x in enumerate(r.ids))
        assert got == want, doc


def library_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    out = defaultdict(list)
    for i, t in texts:
        out[i].append([*library.encode(t or "", add_special_tokens=False).ids, 1])
    return out


def test_awkward_documents_are_packed_whole(spark):
    rows = packing.pack(awkward(spark), WORD_BPE).collect()
    check_packing(rows, library_ids(TEXTS))
    assert packing.pack(empty(spark), WORD_BPE).count() == 0


def test_many_documents_are_packed_without_padding(spark):
    rng = random.Random(12)
    texts = [(k, long_text(min(int(rng.lognormvariate(4, 1)), 900), k % 400)) for k in range(900)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    rows = packing.pack(df, WORD_BPE, room=512).collect()
    check_packing(rows, library_ids(texts), 512)
    pieces = Counter(r.doc_id for r in rows)
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    cut = sum(n > -(-tokens[i] // 512) for i, n in pieces.items())
    assert cut < 0.15 * len(texts)
    want = library_ids(texts)
    for r in packing.with_checksum(packing.pack(df.where("doc_id < 40"), WORD_BPE, room=512)).collect():
        ids = want[r.doc_id][0][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id][0])


def test_words_of_equal_rolling_hashes_are_packed_apart(spark):
    texts = [(k, t) for k, t in enumerate(twins(1024) + twins(4096))]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), WORD_BPE).collect()
    check_packing(rows, library_ids(texts))


# --- the pipeline --------------------------------------------------------------------------------------------


def test_stages_take_awkward_documents(spark):
    docs = awkward(spark)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "substring dedup", "PII", "packing"]
    for source in (docs, empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, source, "/root/testdata/sf0.001")
            assert out.columns == source.columns and out.dtypes == source.dtypes, name
            assert out.count() <= source.count()
    pieces = corpus_pipeline.packed(spark, docs, "").collect()
    check_packing(pieces, library_ids(TEXTS))
    assert corpus_pipeline.packed(spark, empty(spark), "").count() == 0


def test_stages_keep_clean_texts_and_cut_passages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, folder).collect()}
    given = {r.doc_id for r in docs.collect()} & labels.keys()
    assert sum((i in kept) == (labels[i] == 1) for i in given) > 0.95 * len(given)
    passage = long_text(60, 3)
    rows = [(1, "first " + passage), (2, "start " + passage + " end"), (3, "clean  text"), (4, None)]
    cut = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeated_passages(spark, awkward(spark, rows), "").collect()}
    assert cut == {1: (rows[0][1], len(rows[0][1])), 2: ("start end", 9), 3: ("clean  text", 11), 4: (None, None)}


def test_one_document_of_each_group_stays(spark):
    rows = corpus_pipeline.near_duplicates(spark, awkward(spark), "").collect()
    assert Counter(r.doc_id for r in rows) == Counter([1, 4, 7, 8, 9, 12, 13, None])


def test_texts_of_one_id_or_none_are_documents_of_their_own(spark):
    a, b, c, d = (long_text(60, k) for k in (11, 12, 13, 14))
    given = [(1, a), (1, b), (None, c), (None, c), (4, c), (5, d), (5, d), (None, d), (None, "x y z"), (None, "p q r s t u v"), (6, b), (0, None)]
    rows = corpus_pipeline.near_duplicates(spark, awkward(spark, given).repartition(3), "").collect()
    best = {}
    for i, t in given:
        key = (i is None, i)
        best[t] = min(best.get(t, key), key) if not (best.get(t) or (0,))[0] else key
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((key[1], t) for t, key in best.items())


def test_pipeline_packs_what_it_kept(spark):
    folder = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, folder).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    kept = {r.doc_id for r in rows}
    assert 0.5 * len(docs) < len(kept) < len(docs) and kept <= docs
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    good = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 0").collect()}
    assert len(kept & good) <= 1
    assert quality_classifier.N_FEATURES == 13
