"""Rules, classifier, sketches, tokens, personal data: against plain Python on small and awkward documents."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from samples import TEXTS, awkward, empty, long_text, twins

from basketry.llm import bpe, pii, quality_classifier, quality_rules, sketches
from basketry.llm import words as w
from basketry.llm.tagger import N_CLASSES, Tagger, classes
from basketry.llm.tokens import fragment_ids

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def fuzz(alphabet, n, most=30, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


# --- quality rules -------------------------------------------------------------------------------------------


def test_ledger_of_awkward_documents(spark):
    rows = quality_rules.verdicts(quality_rules.ledger(awkward(spark))).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in TEXTS)
    by = {r.doc_id: r for r in rows}
    for k in (1, 2, 3):
        assert (by[k].n_words, by[k].word_chars, by[k].n_repeat_words, by[k].base_failed) == (0, 0, 0, True)
    assert by[8].n_words == 1 and by[8].word_chars == 50_000
    assert by[13].n_words == by[13].n_repeat_words == 500 and by[13].n_distinct == 1
    assert by[7].n_words == 30_000 and by[7].kept and not by[13].kept
    assert quality_rules.ledger(empty(spark)).count() == 0


def test_lines_symbols_and_policies(spark):
    text = "a b\n\na b\n \n$$ |\na b" + " w" * 60
    df = spark.createDataFrame([(1, text), (2, "# " * 60), (3, long_text(80))], "doc_id long, text string")
    ledger = quality_rules.ledger(df)
    rows = {r.doc_id: r for r in quality_rules.verdicts(ledger).collect()}
    assert (rows[1].n_lines, rows[1].n_dup_lines, rows[1].n_symbols) == (4, 1, 3)
    assert rows[2].failed & quality_rules.mask_of(["symbols"]) and rows[3].kept
    found = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablations(ledger).collect()}
    bits = [r.failed for r in ledger.collect()]
    lines = spark.createDataFrame([(1, "\n".join(twins(1024) + twins(4096)))], "doc_id long, text string")
    assert [r.n_dup_lines for r in quality_rules.ledger(lines).collect()] == [0]
    for k, (name, _) in enumerate(quality_rules.RULES):
        assert found[name] == (sum(b >> k & 1 for b in bits), sum(b == 1 << k for b in bits))


# --- quality classifier --------------------------------------------------------------------------------------


def test_held_out_documents_are_told_apart(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality_classifier.classify(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    held = rows.where("held_out").join(labels, "doc_id").collect()
    good = np.array([r.score for r in held if r.quality == 1])
    bad = np.array([r.score for r in held if r.quality == 0])
    assert len(bad) > 5 and (good[:, None] > bad).mean() > 0.97
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert rows.where("score < 0 OR score > 1 OR (score >= 0.5) <> (predicted = 1)").count() == 0


def test_classifier_takes_awkward_documents(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(7, 1), (9, 1), (13, 0), (4, 0), (1, 1), (99, 1), (None, 0), (2, None)], "doc_id long, quality int")
    rows = quality_classifier.classify(docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in TEXTS)
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    none = quality_classifier.classify(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert quality_classifier.classify(empty(spark), labels).count() == 0


def test_weights_are_those_of_a_plain_fit(spark):
    texts = [(k, long_text(20 + 7 * (k % 40), k) if k % 2 else "# bad !! " * (3 + k % 30)) for k in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    given = [(k, k % 2) for k, _ in texts] + [(3, 1), (8, 1), (500, 1), (None, 1)]  # twice, contradicting, no document, no id
    table = quality_classifier.features(docs)
    model = quality_classifier.fit(table, spark.createDataFrame(given, "doc_id long, quality int"))
    x = quality_classifier.features_of(pa.array([t for _, t in texts]))
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, np.maximum(x.std(axis=0), 1e-3))
    used = [k for k, _ in texts if zlib.crc32(str(k).encode()) % 3 != 1 and k != 8]
    z, y = model.expand(x[used]), np.array([k % 2 for k in used], float)
    penalty = np.full(z.shape[1], 2e-4 * len(used) + 0.01)
    penalty[0] = 0
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + np.diag(penalty), z.T @ y), atol=1e-6)
    held = [k for k, _ in texts if k not in used and k != 8]
    assert np.mean((model.score(x[held]) >= 0.5) == np.array([k % 2 for k in held])) > 0.95
    assert (np.diff(model.knots[1]) >= 0).all()


def test_rising_curve_pools_violators():
    places, shares = quality_classifier.rising_curve(np.arange(5.0), np.full(5, 100.0), np.array([0, 30, 20, 90, 95.0]))
    assert len(places) == 4 and (np.diff(shares) > 0).all() and shares[1] == pytest.approx(51 / 202)


# --- sketches ------------------------------------------------------------------------------------------------


ALL = (1 << 64) - 1


def plain_mixed(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> shift) * factor & ALL
    return x ^ x >> 31


def plain_sketch(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = set()
    for k in range(max(len(words) - 4, min(len(words), 1))):
        h = 0
        for word in words[k:k + 5]:
            h = plain_mixed((h * w.WORD_BASE + xxhash.xxh3_64_intdigest(word.encode()) + 1) & ALL)
        hashes.add(h >> 32)
    return sorted(h for h in hashes if h < 1 << 31) or sorted(hashes)[:1]


def plain_likeness(a, b):
    return len(set(a) & set(b)) / min(len(a), len(b)) if a and b else float(not a and not b)


def plain_order(spark, texts):
    turns = spark.createDataFrame([(t or "",) for _, t in texts], "t string").select(F.xxhash64("t")).collect()
    keyed = [(i is None, -(i or 0), -turn[0], t or "", i) for (i, t), turn in zip(texts, turns)]
    return [(k[4], k[3]) for k in sorted(keyed, key=lambda k: k[:4])]


@pytest.mark.parametrize("texts", [TEXTS, [(k % 3 or None, long_text(k % 9, k)) for k in range(60)], list(enumerate(twins(1024)))])
def test_edits_follow_falling_ids(spark, texts):
    lined = plain_order(spark, texts)
    want = Counter()
    for (i, text), (_, after) in zip(lined, lined[1:] + lined[:1]):
        new = sketches.edited(text, after)
        own, changed, following = plain_sketch(text), plain_sketch(new), plain_sketch(after)
        want[i, len(text), hashlib.sha256(new.encode()).hexdigest(), "".join(f"{h:08x}" for h in own),
             "".join(f"{h:08x}" for h in changed), plain_likeness(own, changed), plain_likeness(own, following)] += 1
    assert Counter(tuple(r) for r in sketches.compare_edits(awkward(spark, texts)).collect()) == want


def test_rows_of_one_id_fall_into_many_ranges(spark):
    rows = spark.range(100_000).select(
        F.lit(5).cast("long").alias("key"), F.xxhash64("id").alias("turn"), F.col("id").cast("string").alias("text"), F.lit(False).alias("no_id"))
    dealt = sketches._with_neighbours(rows).where("ghost = 0").groupBy("part").count().collect()
    assert len(dealt) > 4 and max(r["count"] for r in dealt) < 30_000 and sum(r["count"] for r in dealt) == 100_000


def test_short_texts_are_found_in_long_ones():
    errors = []
    for size in (5, 8, 10, 20, 40):
        for seed in range(100):
            whole = long_text(2000, seed)
            a, b = sketches.sketches(pa.array([" ".join(whole.split()[700:700 + size]), whole]))
            errors.append(1 - sketches.containment(a, b))
    assert np.mean(errors) < 0.2 and np.mean(errors[100:]) < 0.1 and max(errors[300:]) == 0


def test_edits_of_few_documents(spark):
    one = sketches.compare_edits(awkward(spark, [(5, "abcd efgh")])).collect()
    assert [r.near_next for r in one] == [1.0]
    assert sketches.compare_edits(awkward(spark, [(1, None), (2, "")])).count() == 2
    assert sketches.compare_edits(empty(spark)).count() == 0


def test_sketch_estimates_containment_and_merges():
    whole = long_text(8000, 3)
    part = " ".join(whole.split()[:2000])
    a, b = sketches.sketches(pa.array([whole, part]))
    assert sketches.containment(a, b) > 0.97 and sketches.containment(a, sketches.sketches(pa.array([long_text(900, 9)]))[0]) < 0.03
    assert (sketches.from_text(sketches.to_text(a)) == a).all()
    assert (sketches.merged(a, b) == np.union1d(a, b)).all()
    short, other, none = sketches.sketches(pa.array(["one two", "one three", " "]))
    assert len(short) == len(other) == 1 and not len(none)
    assert sketches.containment(short, other) == 0 and sketches.containment(none, none) == 1


# --- tokens --------------------------------------------------------------------------------------------------

ODD = ["a", "s", "t", "'", "re", "ll", " ", "  ", "\n", "\t", "é", "\u00a0", "1", "²", "中", "!", "?", "<|endoftext|>", "<|end",
       "oftext|>", "’", "\x1c", "\x85", "x", "q", "Z", "😀", "_", "'s", "'d"]


def test_same_ids_as_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(2)
    texts = twins(1024) + twins(4096) + fuzz(ODD, 4000) + ["".join(chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0x2FFF)])) for _ in range(20)) for _ in range(2000)]
    ids, ends = bpe.encode_column(pa.array(texts), BYTE_BPE)
    for k, text in enumerate(texts):
        assert ids[ends[k]:ends[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_fragments_encode_one_by_one():
    from tokenizers import Tokenizer

    from basketry.llm.common import text_bytes
    from basketry.llm.packing import fragments

    path = public_tokenizers.path("word_bpe_49k.json")
    library, known = Tokenizer.from_file(path), fragment_ids(path)
    texts = fuzz([*ODD, "J\u030c", "I\u0307", "A", "B.", "It's", "we'LL", "<|startoftext|>", "|>"], 6000, seed=4) + [long_text(300)]
    latin = [*"aJKés\u00dc\u00df\u00ff\u00d7\u00f7\u03a3\u03c2\u212a\u0130\u4e2d.,;'=<| ", "'s", "\u030c", "\u0338", "\u0307", "<|endoftext|>"]
    texts += fuzz(latin, 6000, seed=5) + ["caf\u00e9, Stra\u00dfe.", "J", "\u030c", "A\u00d7.", ""]
    data, starts, ends, doc = fragments(*text_bytes(pa.array(texts)))
    ids, sizes = known.of_spans(data, starts, ends)
    at = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(doc, np.arange(len(texts) + 1))]
    for k, text in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_fragment_table_forgets_and_survives_clashes(monkeypatch):
    from basketry.llm import tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    words = [f" w{k % 300}".encode() for k in range(2000)]
    want = [x.tolist() for x in tokens.FragmentIds(path).of(words)]
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    monkeypatch.setattr(tokens, "SLOTS", 64)
    small = tokens.FragmentIds(path)
    assert [x.tolist() for x in small.of(words)] == want
    for k in range(0, 2000, 20):
        got = small.of(words[k:k + 20])
        assert got[1].tolist() == want[1][k:k + 20]
    monkeypatch.setattr(tokens, "REMEMBERED", 1000)
    monkeypatch.setattr(tokens, "SLOTS", 1 << 12)
    monkeypatch.setattr(tokens.xxhash, "xxh3_64_intdigest", lambda value: 7)
    clashing = tokens.FragmentIds(path)
    assert [x.tolist() for x in clashing.of(words)] == want and [x.tolist() for x in clashing.of(words)] == want


def test_encoding_round_trip_of_awkward_documents(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    rows = bpe.decode(bpe.encode(awkward(spark), BYTE_BPE), BYTE_BPE).collect()
    assert Counter((r.doc_id, r.decoded) for r in rows) == Counter((i, t or "") for i, t in TEXTS)
    texts = {i: t or "" for i, t in TEXTS if i is not None}
    assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in rows if r.doc_id)
    assert bpe.encode(empty(spark), BYTE_BPE).count() == 0
    odd = spark.createDataFrame([([50256, 447],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, BYTE_BPE).collect()] == [library.decode([50256, 447], skip_special_tokens=False), "", ""]


# --- personal data -------------------------------------------------------------------------------------------


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]
    return out


def test_base_spans_are_those_of_the_patterns():
    parts = [*"0123456789", "@", ".", "+", "-", " ", "a", "b", "(", ")", "25", "4111111111111111", "a@b.c", "1.2.3.4", "+1 (555) 555-5555", "é"]
    for text in fuzz(parts, 20_000, 25):
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_no_square_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "@" * 100_000, "+1" + "(" * 200_000, "a@" * 50_000, "1." * 100_000):
        pii.base_spans(text)


def test_gradients_are_right():
    tagger = Tagger.new(5, 3, 0)
    tagger.weights = {k: v.astype(np.float64) for k, v in tagger.weights.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, N_CLASSES, (4, 7)), rng.integers(0, 5, (4, 7))
    _, grads = tagger.gradients(x, y)
    for name, grad in grads.items():
        place = (x[0, 3], 2) if name[0] == "x" else tuple(rng.integers(0, s) for s in grad.shape)
        kept, ends = tagger.weights[name][place], []
        for move in (1e-3, -1e-3):
            tagger.weights[name][place] = kept + move
            ends.append(tagger.gradients(x, y)[0])
        tagger.weights[name][place] = kept
        assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(grad[place], abs=1e-5)


def test_viterbi_finds_the_best_path():
    import itertools

    tagger = Tagger.new(3, 4, 2)
    rng = np.random.default_rng(1)
    tagger.weights["next"] = rng.normal(0, 1, (3, 3)).astype(np.float32)
    x = rng.integers(0, N_CLASSES, (5, 6))
    tags, _ = tagger.decode(x)
    losses = lambda row, path: tagger.gradients(x[row:row + 1], np.array([path]))[0]
    for row in range(5):
        best = min(itertools.product(range(3), repeat=6), key=lambda p: losses(row, p))
        assert tuple(tags[row]) == best


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_tagger_finds_held_out_and_rewritten_spans(spark, tagger):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    windows = [(t[s:s + 64], [(k, a - s, b - s) for k, a, b in pii.base_spans(t) if s <= a and b <= s + 64])
               for t in texts for s in pii.windows(t)]
    x, tags = pii.examples([w for w in windows if w[1]], seed=99)
    got, _ = tagger.decode(x)
    assert (got == tags).mean() > 0.95 and ((got == tags) & (tags > 0)).sum() / (tags > 0).sum() > 0.8


def test_findings_join_base_spans_and_clean_texts_stay_clean(tagger):
    text = "call (319) 555-5132 or +1 (644) 555-7859 today"
    (base, spans), = pii.find([text], tagger)
    assert [text[a:b] for _, a, b in base] == ["+1 (644) 555-7859"] and set(base) <= set(spans)
    clean = ["Licensed under CC BY-NC 4.0.", "version 2.0.13 of 2020-01-02 at 12:30", "token = \"0641917ea4e9feb9cda83477b57ac2654884f485\"", ""]
    assert pii.find(clean, tagger) == [([], [])] * 4


def spelled_out():
    """Addresses without digits in every rewritten form, as they are and in capitals, in four settings."""
    rng = random.Random(8)
    settings = ["{}", "write to {} for more", "Contact: {}\nThanks", "Please send any comment you may have to {} and we answer"]
    users, hosts = ["john", "maria.lopez", "anna_k", "peterwagner"], ["example.com", "physics.acme.org"]
    for k in range(200):
        new = pii._rewritten("email", f"{rng.choice(users)}@{rng.choice(hosts)}", rng)
        yield settings[k % 4], new.upper() if k % 3 == 0 else new


def test_windows_hold_spelled_out_addresses():
    for setting, new in spelled_out():
        for lead in ("", "x" * 50 + " "):
            text = lead + setting.format(new)
            a = text.index(new)
            places = {p for s in pii.windows(text) for p in range(s, s + pii.WINDOW)}
            assert places >= set(range(a, a + len(new))), text
            assert pii._holds("email", new), new
    assert pii.windows("we met at noon. Then at the end of a dotted line (at home)") == []


def test_spelled_out_addresses_without_digits_are_found(tagger):
    cases = [(setting.format(new), new) for setting, new in spelled_out()]
    found = [[t[a:b] for _, a, b in spans] for (t, _), (_, spans) in zip(cases, pii.find([t for t, _ in cases], tagger))]
    assert sum(f == [new] for f, (_, new) in zip(found, cases)) > 0.9 * len(cases)
    assert pii.find(["Look at example.com for more.", "A look at the dot com boom"], tagger) == [([], [])] * 2


def test_reconciled_spans_are_disjoint_and_heaviest():
    text = "x 4111.1111.1111.1111 y 10[.]20[.]30[.]40 z"
    found = [("card", 2, 15, 3.0), ("card", 10, 21, 4.0), ("ip", 2, 21, 1.0), ("ip", 24, 41, 2.0), ("phone", 24, 41, 9.0)]
    assert pii.reconciled(text, [], found) == [("ip", 24, 41), ("card", 2, 21)]
    assert pii.reconciled(text, [("email", 30, 31)], found) == [("email", 30, 31), ("card", 2, 21)]


def test_scan_and_mask_awkward_documents(spark, tagger):
    docs = awkward(spark, [*TEXTS, (20, "mail a.b@c.de or +1 555 555 5555, 4111 1111 1111 1111"), (21, "1.2.3.4")])
    rows = {r.doc_id: r for r in pii.scan(docs, tagger).collect()}
    assert rows[20].base_spans == "email:5:13,card:34:53,phone:17:32" and (rows[20].n_email, rows[20].n_phone) == (1, 1)
    assert rows[1].spans == rows[2].spans == "" and rows[21].spans == "ip:0:7"
    out = pii.mask(docs, tagger)
    assert out.columns == docs.columns
    new = {r.doc_id: r for r in out.collect()}
    assert new[20].text == "mail <EMAIL> or <PHONE>, <CARD>" and new[20].n_chars == 31 and new[1].text is None
    assert new[7].text == long_text() and out.count() == docs.count()
    assert pii.train(empty(spark)) is None and pii.scan(empty(spark), None).count() == 0
    assert pii.masked("abcdef", [("ip", 1, 4), ("card", 2, 5)]) == "a<IP>f"


def test_copies_of_a_window_count_once_in_the_sample(spark, monkeypatch):
    texts = ["call +1 (555) 555-5555 now"] * 3000 + [f"number {k} of many" for k in range(100)]
    kept, store = [], pii.stored
    monkeypatch.setattr(pii, "stored", lambda df, name: kept.append(store(df, name)) or kept[-1])
    monkeypatch.setattr(pii, "STEPS", 2)
    pii.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert Counter(r.part for r in kept[0].collect()) == Counter(set(texts))


def test_classes_fill_up_short_texts():
    assert classes(["a1", ""], 4).tolist() == [[4, 3, 1, 1], [1, 1, 1, 1]]
