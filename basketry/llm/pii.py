"""Personal data in texts: fixed patterns, and a trained tagger that adds what they miss.

The patterns find e-mail and network addresses, card and phone numbers. The tagger, a bidirectional LSTM with CRF
transitions over characters, learns from spans that the patterns label in a bounded sample of the corpus, as they stand
and rewritten the way people write them to escape patterns (no plus sign, spelled-out at and dot, other separators),
and from spelled-out addresses of the sample's words, which have no digit. It reads overlapping windows around every
digit, at sign and spelled-out at with a domain behind it: a span of any of the four kinds has one. The windows'
findings are reconciled over the whole text: overlapping findings of a kind become one, a finding must hold what its
kind demands, and of those that still overlap a heaviest set of disjoint ones stays. Base spans always stay.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import each_piece, one_thread_each, pieces, record_batch, rows_of, stored, texts_of
from basketry.llm.tagger import Tagger, classes

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

#: Characters of a window, and from one window to the next.
WINDOW, STRIDE = 64, 32
#: Windows to learn from, at most: a bounded sample, by the smallest hashes.
SAMPLE = 2400
#: Documents per window of the sample whose windows may compete, at most.
STORED = 200
#: Spelled-out addresses without digits to learn from, per window that begins with an e-mail address.
DIGIT_FREE = 4
HIDDEN, STEPS, BATCH, RATE, SEED = 16, 700, 48, 0.02, 11

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits can only match from its start, which keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
HINT = re.compile(r"[0-9@]|[(\[{]\s*+at\s*+[)\]}]", re.I)
# Spelled-out signs of an address in any case; an at with a domain behind it; all of what may be such an address.
AT = r"(?:\s*+[\[({]\s*+at\s*+[\])}]\s*+|\s++at\s++)"
DOT = r"(?:\.|\s*+[\[({]\s*+(?:dot|\.)\s*+[\])}]\s*+|\s++dot\s++)"
SPELLED = re.compile(rf"(?:[\[({{]\s*+at(?=\s*+[\])}}]\s*+[a-z0-9-]++{DOT}[a-z0-9-])|\sat(?=\s++[a-z0-9-]++{DOT}[a-z0-9-]))", re.I)
CHAIN = re.compile(rf"(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?:(?:{AT}|{DOT})[a-z0-9._%+-]++)++", re.I)
AT_SIGN, DOT_SIGN = re.compile(AT, re.I), re.compile(DOT, re.I)


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def is_ip(parts: list[str]) -> bool:
    return len(parts) == 4 and all(p and len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in parts)


def is_card(digits: str) -> bool:
    return 16 <= len(digits) <= 19 and luhn(digits)


def _emails(text: str):
    free = at = 0  # a local part begins after the last match and the last at sign
    while (at := text.find("@", at)) >= 0:
        found = DOMAIN.match(text, at)
        local = text[free:at]
        size = len(local) - len(local.rstrip(LOCAL))
        if found and size:
            yield "email", at - size, found.end()
            free = at = found.end()
        else:
            at += 1
            free = at


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, by kind and place; per kind leftmost and disjoint."""
    if not HINT.search(text):
        return []
    spans: list[Span] = list(_emails(text))
    spans += [("ip", *m.span()) for m in IP.finditer(text) if is_ip(m.group().split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if is_card(NO_DIGIT.sub("", m.group()))]
    spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(NO_DIGIT.sub("", m.group())) <= 15]
    return spans


def windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit, an at sign or a part of what may be a spelled-out address, on a fixed
    raster, each place in two of them. A finding that counts (``_holds``) has one of these."""
    marked = {m.start() // STRIDE for m in HINT.finditer(text)}
    spelled = [m.start() // STRIDE for m in SPELLED.finditer(text)]
    if spelled:
        marked.update(spelled)
        for m in CHAIN.finditer(text):
            if SPELLED.search(text, *m.span()):
                marked.update(range(m.start() // STRIDE, (m.end() - 1) // STRIDE + 1))
    return sorted({k * STRIDE for m in marked for k in (m - 1, m) if k >= 0})


# --- learning ------------------------------------------------------------------------------------------------


def _rewritten(kind: str, value: str, rng: random.Random) -> str:
    """The same datum as the patterns don't find it."""
    if kind == "email":
        user, _, host = value.partition("@")
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", "."), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", "[dot]")])
        return user + at + host.replace(".", dot)
    if kind == "ip":
        return value.replace(".", rng.choice(["[.]", "(.)", " . "]))
    digits = NO_DIGIT.sub("", value)
    if kind == "card":
        mark = rng.choice([".", "_", "/", "  "])
        return mark.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    area, first, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    return rng.choice([f"({area}) {first}-{last}", f"{area}-{first}-{last}", f"{area}.{first}.{last}", f"1-{area}-{first}-{last}"])


def _address(words: str, rng: random.Random) -> str:
    """An e-mail address without digits, of words as they come."""
    names = re.findall(r"[A-Za-z]{2,12}", words) or ["info"]
    user = rng.choice(["", ".", "_", "-"]).join(rng.choices(names, k=rng.randint(1, 2)))
    return f"{user}@{'.'.join(rng.choices(names, k=rng.randint(1, 2)))}.{rng.choice(['com', 'org', 'net', 'edu', 'de'])}"


def _decoys(rng: random.Random) -> str:
    """Numbers that are no personal data."""
    n = lambda a, b: rng.randint(a, b)
    return rng.choice([
        f"version {n(1, 20)}.{n(0, 20)}.{n(0, 99)}", f"{n(1990, 2030)}-{n(1, 12):02d}-{n(1, 28):02d}", f"{n(0, 23)}:{n(0, 59):02d}",
        f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", f"{rng.getrandbits(80):x}", f"{rng.getrandbits(160):040x}", f"#{n(1, 99999)}",
        f"{n(1, 99)}.{n(1, 99)}", f"{n(1000, 9999)}", f"page {n(1, 900)}", f"{n(1, 9999)}-{n(1, 99)}", f"@{rng.choice(['the', 'home', 'a'])}",
    ])


def examples(rows: list[tuple[str, list[Span]]], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags of windows with labelled spans: as they stand, rewritten, and with decoys.

    Tag 0 is outside; kind k begins with tag 2k + 1 and goes on with 2k + 2.
    """
    rng = random.Random(seed)
    texts, tags = [], []

    def add(text: str, spans: list[Span]) -> None:
        row = np.zeros(WINDOW, np.int64)
        for kind, a, b in spans:
            row[a:b] = 2 * KINDS.index(kind) + 2
            if a < WINDOW:
                row[a] = 2 * KINDS.index(kind) + 1
        texts.append(text)
        tags.append(row)

    for text, spans in rows:
        add(text, spans)
        for kind, a, b in spans[:1]:
            new = _rewritten(kind, text[a:b], rng)
            lead = text[max(0, a - rng.randint(0, 20)):a]
            add((lead + new + text[b:])[:WINDOW], [(kind, len(lead), min(len(lead) + len(new), WINDOW))])
        words = re.sub(r"[0-9@+]+", "", text)
        if spans and spans[0][0] == "email":
            for _ in range(DIGIT_FREE):
                address = _address(words, rng)
                new = _rewritten("email", address, rng)
                lead = words[:rng.randint(0, 30)] + rng.choice([" ", ": ", "\n"])
                add(f"{lead}{new}{rng.choice([' ', '.', ', '])}{words}"[:WINDOW], [("email", len(lead), min(len(lead) + len(new), WINDOW))])
            add(f"{lead}at {address.partition('@')[2]} {words}"[:WINDOW], [])
        a = rng.randint(0, 30)
        add(f"{words[:a]} {_decoys(rng)} {words[a:]}"[:WINDOW], [])
    return classes(texts, WINDOW), np.array(tags).reshape(-1, WINDOW)


def train(documents: DataFrame, text_column: str = "text") -> Tagger | None:
    """A tagger from at most ``SAMPLE`` windows of ``documents`` (None if no text has one).

    Distinct windows with the smallest hashes are taken, half of them with a span of the patterns. Of a large corpus only
    hashes below a bound that falls with the number of documents compete, so that the windows stored on the way are
    bounded too.
    """
    share = min(1.0, STORED * SAMPLE / max(documents.count(), 1))

    def cut(piece):
        texts, marks = [], []
        for text in piece.column("text").to_pylist():
            spans = base_spans(text)
            for start in windows(text):
                part = text[start:start + WINDOW]
                inside = [(k, max(a - start, 0), min(b - start, WINDOW)) for k, a, b in spans if a < start + WINDOW and b > start]
                texts.append(part)
                marks.append(";".join(f"{k}:{a}:{b}" for k, a, b in inside))
        return {"part": pa.array(texts, pa.string()), "spans": pa.array(marks, pa.string())}

    own = texts_of(documents.select(F.lit(0).alias("doc_id"), F.col(f"`{text_column}`").alias("text")), "doc_id", "text")
    found = each_piece(own, cut, "part string, spans string").withColumn("rank", F.pmod(F.xxhash64("part"), F.lit(1 << 30)))
    # Equal windows share a rank: one of each, or copies would fill the sample.
    found = found.where(F.col("rank") <= int(share * (1 << 30))).distinct()
    found = stored(found, "labelled-windows").coalesce(8)
    parts = [found.where(some).orderBy("rank", "part").limit(SAMPLE // 2) for some in ("spans <> ''", "spans = ''")]

    def learn(batches):
        """Trains in one task, which Spark gives one thread: many small products gain nothing from more."""
        rows = sorted((r["part"], r["spans"]) for r in rows_of(batches))
        if rows:
            read = lambda s: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in s.split(";") if x)]
            x, tags = examples([(part, read(spans)) for part, spans in rows])
            tagger = Tagger.new(2 * len(KINDS) + 1, HIDDEN, SEED)
            tagger.train(x, tags, STEPS, BATCH, RATE, SEED)
            names, arrays = zip(*tagger.weights.items())
            yield record_batch({"name": list(names), "shape": [list(w.shape) for w in arrays],
                                "weights": pa.array([w.tobytes() for w in arrays], pa.binary())})

    sample = parts[0].unionByName(parts[1]).select("part", "spans").repartition(1)
    weights = sample.mapInArrow(learn, "name string, shape array<long>, weights binary").collect()
    if not weights:
        return None
    return Tagger({r["name"]: np.frombuffer(r["weights"], np.float32).reshape(r["shape"]) for r in weights})


# --- finding -------------------------------------------------------------------------------------------------


def _holds(kind: str, value: str) -> bool:
    """Whether a finding of the tagger has what its kind demands, however it is written."""
    if kind == "email":
        plain = DOT_SIGN.sub(".", AT_SIGN.sub("@", value))
        return re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", plain) is not None
    digits = NO_DIGIT.sub("", value)
    if kind == "ip":
        return is_ip([p for p in re.split(r"[^0-9]+", value) if p]) and re.fullmatch(r"[0-9.\s()\[\]{}]+", value) is not None
    if kind == "card":
        return is_card(digits) and re.fullmatch(r"[0-9 ._/-]+", value) is not None
    return (10 <= len(digits) <= 15 and re.fullmatch(r"[+(]?[0-9][0-9 ().-]*", value) is not None
            and len(re.findall(r"[0-9]+", value)) >= 3 and re.search(r"[0-9]{4}$", value) is not None)


def _runs(tags: np.ndarray, margin: np.ndarray) -> list[tuple[str, int, int, float]]:
    out, start = [], None
    kinds = np.append((tags + 1) // 2, 0)
    for t in range(len(kinds)):
        if start is not None and (kinds[t] != kinds[start] or (t < len(tags) and tags[t] % 2 == 1)):
            out.append((KINDS[kinds[start] - 1], start, t, float(margin[start:t].sum())))
            start = None
        if start is None and kinds[t]:
            start = t
    return out


def _whole(text: str, start: int, end: int) -> tuple[int, int]:
    """Without white space or closing marks at either end, and with all of a cut number or word."""
    while start > 0 and text[start - 1].isalnum() and text[start].isalnum():
        start -= 1
    while end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
        end += 1
    while start < end and text[start] in " \t\n.,;:-":
        start += 1
    while end > start and text[end - 1] in " \t\n.,;:-(":
        end -= 1
    return start, end


def reconciled(text: str, base: list[Span], found: list[tuple[str, int, int, float]]) -> list[Span]:
    """Base spans and the heaviest disjoint set of findings that hold and meet no base span, by kind and place."""
    joined: list[list] = []
    for kind, a, b, weight in sorted(found):
        if joined and joined[-1][0] == kind and a < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], b)
            joined[-1][3] = max(joined[-1][3], weight)
        else:
            joined.append([kind, a, b, weight])
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    tops = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
    extra = []
    for kind, a, b, weight in joined:
        a, b = _whole(text, a, b)
        k = int(np.searchsorted(starts, b, "left"))
        if a < b and weight > 0 and (k == 0 or tops[k - 1] <= a) and _holds(kind, text[a:b]):
            extra.append((b, a, kind, weight))
    extra.sort()
    ends, best, chosen = [e[0] for e in extra], [0.0], []
    for k, (b, a, kind, weight) in enumerate(extra):
        before = int(np.searchsorted(ends[:k], a, "right"))
        chosen.append(before if best[before] + weight > best[-1] else -1)
        best.append(max(best[-1], best[before] + weight))
    k, spans = len(extra), list(base)
    while k:
        if chosen[k - 1] >= 0:
            b, a, kind, _ = extra[k - 1]
            spans.append((kind, a, b))
            k = chosen[k - 1]
        else:
            k -= 1
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(texts: list[str], tagger: Tagger | None, block: int = 512) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    bases = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, reconciled(t, b, [])) for t, b in zip(texts, bases)]
    places = [(k, start) for k, t in enumerate(texts) for start in windows(t)]
    found: list[list] = [[] for _ in texts]
    for at in range(0, len(places), block):
        part = places[at:at + block]
        tags, margin = tagger.decode(classes([texts[k][s:s + WINDOW] for k, s in part], WINDOW))
        for row in np.flatnonzero(tags.any(axis=1)):
            k, start = part[row]
            size = min(WINDOW, len(texts[k]) - start)
            found[k] += [(kind, start + a, start + b, w) for kind, a, b, w in _runs(tags[row, :size], margin[row, :size])]
    return [(b, reconciled(t, b, f)) for t, b, f in zip(texts, bases, found)]


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def scan(documents: DataFrame, tagger: Tagger | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, base counts ``n_email, n_ip, n_card, n_phone``, ``base_spans`` and ``spans`` of every document.

    Spans are written ``kind:start:end`` in code points, end exclusive, by kind and start. A null text is empty and has
    none; null ids and repeated rows pass through; an empty table gives an empty result; further columns are left out.
    """

    def make(piece):
        found = find(piece.column("text").to_pylist(), tagger)
        counts = {f"n_{k}": pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS}
        return {"doc_id": piece.column("doc_id"), **counts, "base_spans": [written(b) for b, _ in found],
                "spans": [written(s) for _, s in found]}

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string"
    return each_piece(texts_of(documents, id_column, text_column), make, schema)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind; overlapping spans become one, named after the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(documents: DataFrame, tagger: Tagger | None, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """``documents`` with personal data replaced, and the length (if there is such a column) of the new text.

    A null text stays null; all other columns stay as they are.
    """
    one_thread_each(documents.sparkSession)

    def run(batches):
        for piece in pieces(batches, text_column):
            texts = piece.column(text_column).to_pylist()
            found = find([t or "" for t in texts], tagger)
            new = [None if t is None else masked(t, s) for t, (_, s) in zip(texts, found)]
            columns = dict(zip(piece.schema.names, piece.columns))
            columns[text_column] = pa.array(new, pa.string())
            if length_column in columns:
                sizes = [old if t == n or n is None else len(n)
                         for old, t, n in zip(columns[length_column].to_pylist(), texts, new)]
                columns[length_column] = pa.array(sizes, columns[length_column].type)
            yield record_batch(columns)

    return documents.mapInArrow(run, T.StructType(documents.schema.fields))
