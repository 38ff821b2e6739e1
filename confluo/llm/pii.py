"""Personal data: generators propose, boosted trees decide, calibrated thresholds select.

High-recall generators propose overlapping spans of four kinds: e-mail addresses, also with bracketed or spelt-out signs ("at ... dot"); IP addresses,
also with bracketed dots; card numbers, also with dots and slashes; phone numbers, also without a plus sign. Each span gets format
features (digits, groups, checksum, separators) and context features (neighbouring characters, words before it, how digit-heavy the
surroundings are). One boosted-tree model per kind scores the spans.

The base spans are those of fixed patterns with fixed checks; they always stay, and are found in time linear in the text. The models learn from
them: a bounded sample of texts gives base spans, disguised copies of them as further positives, and as negatives copies with numbers that fail
the checks and proposals that are no disguise of a valid span; other proposals have no label. The threshold of a kind is the lowest
score (0.5 at least) down to which the share of positives on a held-out half of the sample reaches ``PRECISION``. Selected spans do not overlap each other or base
spans: base first, then higher scores, then earlier and longer ones.

Texts without a digit, an at sign, a bracketed "at" or a lone "dot" are passed over at once, as no generator can propose anything there.

At most ``sample`` texts are learned from, those with the smallest hash (equal texts count once); tasks reduce them to rows of numbers, of which
the driver takes at most ``SPANS``.

Defined results: a NULL text is empty and has no spans; offsets are code points, ends exclusive; rows with equal ids are scanned one
by one; without training spans only base spans are found; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import Batches, fresh, pick, sample_distinct, small_batches, str_texts, with_columns
from confluo.llm.trees import Boosted, fit_boosted

# Kinds in order, and the base patterns.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

_AT = r"(?:\s?[\[({]\s?(?:at|AT|@)\s?[\])}]\s?|@)"
_DOT = r"(?:\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\.)"
PROPOSE = {
    "email": re.compile(rf"[\w.%+-]+{_AT}[\w-]+(?:{_DOT}[\w-]+)+"),
    "ip": re.compile(r"(?<![\d.])\d{1,3}(?:\s?[\[(]?\.[\])]?\s?\d{1,3}){3}(?![\d.])"),
    "card": re.compile(r"(?<!\w)\d(?:[\x20./_-]?\d){12,18}(?!\w)"),
    "phone": re.compile(r"(?<![\w.])(?:\+|00)?[(\d][\d\x20()./-]{5,20}\d(?!\w)"),
}
_SPELT = re.compile(r"[\w.%+-]{1,64}\sat\s[\w-]{1,64}(?:\sdot\s[\w-]{1,64}){1,8}", re.I)
_ARTICLE = re.compile(r"\sat\s(?:the|a|an|this|that|your|our|my)\s", re.I)
_BRACKETED = re.compile(r"[\[({]\s?(?:at|AT)\s?[\])}]")
_DIGIT = re.compile(r"[0-9]")

SAMPLE = 20_000
SPANS = 50_000
PRECISION = 0.98
WINDOW = 40

Span = tuple[int, int, str]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes(kind: str, found: str) -> bool:
    """The fixed check of a base match."""
    if kind == "ip":
        parts = [p.lstrip("0") for p in found.split(".")]
        return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)
    if kind == "card":
        digits = _only_digits(found)
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 10 <= len(_only_digits(found)) <= 15


_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of the address pattern starts where a run of digits starts, so no other place is tried.
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the base pattern: from each at sign to both sides, never before the end of the match before."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, sign + 1) if start < sign else None
        if host:
            yield start, host.end()
            done = host.end()
        else:
            done = sign + 1
        sign = text.find("@", done)


def base_matches(text: str, kind: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the base pattern, one after the other, in time linear in the text."""
    if kind == "email":
        return _emails(text)
    return (m.span() for m in (_DOTTED if kind == "ip" else BASE[kind]).finditer(text))


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind."""
    out: list[Span] = []
    digits = _DIGIT.search(text)
    for kind in KINDS:
        if digits if kind != "email" else "@" in text:
            out += [(a, b, kind) for a, b in base_matches(text, kind) if passes(kind, text[a:b])]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _may_hold(text: str) -> bool:
    """False if no generator can propose anything."""
    return bool(_DIGIT.search(text)) or "@" in text or _hidden_sign(text)


def _hidden_sign(text: str) -> bool:
    return _BRACKETED.search(text) is not None or (" dot " in text or " DOT " in text or " Dot " in text)


def proposals(text: str, kind: str) -> Iterator[tuple[int, int]]:
    if kind == "email":
        if "@" not in text and not _hidden_sign(text):
            return
        # Only around a sign: a search from every word would be slow on long texts.
        for sign in re.finditer(r"@|[\[({]\s?(?:at|AT|@)\s?[\])}]|\s(?:at|AT|At)(?=\s[\w-]{1,64}\s(?i:dot)\s)", text):
            pattern = _SPELT if sign[0][0].isspace() else PROPOSE[kind]
            low, high = max(0, sign.start() - 80), min(len(text), sign.end() + 120)
            behind = text[sign.end() : high]
            if "." not in behind and "dot" not in behind.lower():
                continue
            for m in pattern.finditer(text, low, high):
                if m.start() <= sign.start() < m.end():
                    yield m.span()
        return
    if _DIGIT.search(text):
        for m in PROPOSE[kind].finditer(text):
            yield m.span()


def disguised(kind: str, found: str) -> bool:
    """True if the span can be another way to write something that passes as a base span."""
    if kind == "email":
        plain = re.sub(_AT, "@", re.sub(_DOT, ".", found), count=1)
        plain = re.sub(r"\s(?i:at)\s", "@", re.sub(r"\s(?i:dot)\s", ".", plain), count=1)
        return BASE[kind].fullmatch(plain) is not None
    if kind == "ip":
        plain = re.sub(r"[\s\[\]()]", "", found)
        return _DOTTED.fullmatch(plain) is not None and passes(kind, plain)
    digits = _only_digits(found)
    if kind == "card":
        return passes(kind, digits)
    return passes(kind, digits.removeprefix("00"))


WORDS_OF = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "from"),
    "card": ("card", "visa", "payment", "credit", "pay"),
    "phone": ("call", "phone", "tel", "mobile", "fax"),
}
FEATURES = (
    "length", "digits", "groups", "longest group", "shortest group", "first group", "luhn", "all at most 255", "plus", "brackets", "dots", "dashes",
    "blanks", "slashes", "at", "spelt dots", "article", "last part", "letters", "lower", "hyphenated date", "letter before", "letter after", "digits around", "hint before",
    "line start", "sign before",
)


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    found, before, after = text[start:end], text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    digits, groups = _only_digits(found), re.findall(r"[0-9]+", found)
    sizes = [len(g) for g in groups] or [0]
    near = before.lower()
    return [
        float(len(found)), float(len(digits)), float(len(groups)), float(max(sizes)), float(min(sizes)), float(sizes[0]),
        float(len(digits) > 0 and luhn(digits)), float(all(len(g) <= 3 and int(g) <= 255 for g in groups)), float(found[:1] == "+"),
        float(sum(c in "()[]{}" for c in found)), float(found.count(".")), float(found.count("-")), float(sum(c.isspace() for c in found)),
        float(found.count("/")), float("@" in found or _BRACKETED.search(found) is not None), float(found.lower().count(" dot ")),
        float(_ARTICLE.search(found) is not None), float(len(re.split(r"\W+", found.rstrip(")]}"))[-1])), sum(c.isalpha() for c in found) / max(len(found), 1),
        float(found == found.lower()), float(re.fullmatch(r"[12][0-9]{3}[-/.][01]?[0-9][-/.][0-3]?[0-9]", found) is not None),
        float(before[-1:].isalpha()), float(after[:1].isalpha()), float(sum(c.isdigit() for c in before + after)),
        float(any(w in near for w in WORDS_OF[kind])), float(not before or before[-1] == "\n"), float(before[-1:] in "$#=:/\\_.,-" and before != ""),
    ]


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("aeinorstlmd") for _ in range(rng.randint(2, 8)))


def disguises(found: str, kind: str, rng: random.Random) -> list[str]:
    """Other ways to write a base span, some with other names and numbers."""
    digits = _only_digits(found)
    if kind == "email":
        name, _, host = found.partition("@")
        name = rng.choice([name, re.sub("[0-9]", "", name).strip(".") or _word(rng), _word(rng), f"{_word(rng)}.{_word(rng)}"])
        host = rng.choice([host, re.sub("[0-9]", "", host), f"{_word(rng)}.{rng.choice(['com', 'org', 'net', 'de'])}"])
        return [f"{name} [at] {host}", f"{name}(at){host.replace('.', '(dot)')}", f"{name} [at] {host.replace('.', ' [dot] ')}", f"{name}[@]{host}", f"{name} (at) {host}", f"{name} at {host.replace('.', ' dot ')}"]
    if kind == "ip":
        parts = [p if rng.random() < 0.5 else str(rng.randint(0, rng.choice([9, 99, 255]))) for p in found.split(".")]
        return [s.join(parts) for s in ("[.]", "(.)", "[.]", " . ")]
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), "/".join(fours), "_".join(fours)]
    return [found.lstrip("+"), "00" + digits, found.lstrip("+0123456789 ") or digits, f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}.{digits[-7:-4]}.{digits[-4:]}"]


def examples(text: str, seed: int) -> dict[str, list[tuple[list[float], int]]]:
    """Training spans of one text."""
    rng, base, out = random.Random(seed), base_spans(text), {k: [] for k in KINDS}
    taken = [(a, b) for a, b, _ in base]
    for start, end, kind in base:
        out[kind].append((features(text, start, end, kind), 1))
        for other in rng.sample(disguises(text[start:end], kind, rng), 2):
            changed = text[:start][-200:] + other + text[end : end + 200]
            at = len(text[:start][-200:])
            for a, b in proposals(changed, kind):
                if a == at and b == at + len(other):
                    out[kind].append((features(changed, a, b, kind), 1))
        # The same place with digits that fail the check, and numbers that are no personal data.
        for other in _decoys(text[start:end], kind, rng):
            changed = text[:start][-200:] + other + text[end : end + 200]
            at = len(text[:start][-200:])
            for a, b in proposals(changed, kind):
                if a < at + len(other) and b > at:
                    out[kind].append((features(changed, a, b, kind), 0))
    covered = _cover(len(text), taken)
    for kind in KINDS:
        for a, b in proposals(text, kind):
            if not any(covered[a:b]) and not disguised(kind, text[a:b]):
                out[kind].append((features(text, a, b, kind), 0))
    return out


def _cover(size: int, spans: list[tuple[int, int]]) -> bytearray:
    """A mark for every code point inside a span."""
    out = bytearray(size)
    for a, b in spans:
        out[a:b] = b"\1" * (b - a)
    return out


def _decoys(found: str, kind: str, rng: random.Random) -> list[str]:
    if kind == "card":
        digits = _only_digits(found)
        wrong = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
        return [wrong, ".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))]
    if kind == "ip":
        out = []
        for joint in (".", "[.]"):
            parts = [str(rng.randint(0, rng.choice([9, 99, 255]))) for _ in range(4)]
            parts[rng.randrange(4)] = str(rng.randint(256, 999))
            out.append(joint.join(parts))
        return out
    if kind == "phone":
        return [
            f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", f"{rng.randint(1, 999)} {rng.randint(1, 999)} {rng.randint(1, 999)}",
            str(rng.randint(10**6, 10**9)), f"{rng.randint(1, 12)}/{rng.randint(1, 28)}/{rng.randint(1900, 2099)}", f"({rng.randint(1, 99)}) {rng.randint(1000, 99999)}",
            str(rng.randint(10**14, 10**16)), f"{rng.randint(1000, 9999)}.{rng.randint(1000, 9999)}", str(rng.randint(10**9, 10**10)),
        ]
    return [
        f"{_word(rng)} (at) {_word(rng)}.{_word(rng).capitalize()}", f"{_word(rng).capitalize()} [at] {_word(rng)}.{_word(rng).capitalize()}", f"{rng.randint(1, 99)} (at) {rng.randint(1, 99)}.{rng.randint(10, 99)}",
        f"{rng.randint(1, 9)}[@]{rng.randint(1, 99)}.{rng.randint(0, 99)}", f"{_word(rng)} at {rng.choice(['the', 'a', 'this'])} dot {_word(rng)}",
        f"{_word(rng).capitalize()} at {_word(rng)} dot {_word(rng).capitalize()}",
    ]


@dataclass(frozen=True)
class SpanModel:
    models: dict[str, Boosted]
    thresholds: dict[str, float]

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """Base spans, and all selected spans, both by start, then kind."""
        if not _may_hold(text):
            return [], []
        base = base_spans(text)
        taken, scored = _cover(len(text), [(a, b) for a, b, _ in base]), []
        for kind, model in self.models.items():
            found = [(a, b) for a, b in dict.fromkeys(proposals(text, kind)) if not any(taken[a:b])]
            if found:
                scores = model.predict(np.array([features(text, a, b, kind) for a, b in found]))
                scored += [(-s, a, -b, kind) for (a, b), s in zip(found, scores, strict=True) if s >= self.thresholds[kind]]
        chosen = list(base)
        for _, a, b, kind in sorted(scored):
            if not any(taken[a:-b]):
                taken[a:-b] = b"\1" * (-b - a)
                chosen.append((a, -b, kind))
        return base, sorted(chosen, key=lambda s: (s[0], KINDS.index(s[2])))


def fit(rows: list[tuple[int, str, int, np.ndarray]]) -> SpanModel:
    """Models and thresholds from rows ``half, kind, label, features``; the second half is kept for calibration."""
    halves = [{k: [] for k in KINDS}, {k: [] for k in KINDS}]
    for half, kind, label, x in rows:
        halves[half][kind].append((x, label))
    models, thresholds = {}, {}
    for kind in KINDS:
        train, held = halves[0][kind], halves[1][kind]
        if len({y for _, y in train}) < 2 or not any(y for _, y in held):
            continue
        model = fit_boosted(np.array([x for x, _ in train]), np.array([y for _, y in train], float), rounds=60, depth=3, least=3.0)
        scores, truth = model.predict(np.array([x for x, _ in held])), np.array([y for _, y in held])
        order = np.argsort(-scores, kind="stable")
        right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
        # Only where the score changes is a threshold possible.
        last = np.append(scores[order][1:] < scores[order][:-1], True)
        good = np.flatnonzero((right >= PRECISION) & last)
        if len(good):
            # Halfway to the next lower score, so that spans like the lowest accepted ones are accepted too.
            low = scores[order][good[-1]]
            below = scores[order][good[-1] + 1] if good[-1] + 1 < len(order) else 0.0
            models[kind], thresholds[kind] = model, max(float(low + below) / 2, 0.5)
    return SpanModel(models, thresholds)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, spans: int = SPANS) -> SpanModel:
    """Fit on the training spans of at most ``sample`` different texts; the driver takes at most ``spans`` rows of numbers."""
    small_batches(docs.sparkSession)
    rows = pick(docs, text).toDF("text").where(F.col("text").rlike(r"[0-9@]"))
    chosen = sample_distinct(rows, F.col("text"), sample)
    # At most ``sample`` hashes of 64 bits; equal texts are one example.
    texts = rows.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for h, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [(kind, y, x) for kind, some in examples(body, h).items() for x, y in some]
                out += [(h, n, kind, y, x) for n, (kind, y, x) in enumerate(found)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["h", "n", "kind", "label", "x"])

    found = texts.select("h", "text").mapInArrow(run, "h bigint, n bigint, kind string, label int, x array<double>")
    got = found.orderBy(F.xxhash64("h", "n"), "h", "n").limit(spans).toArrow().sort_by([("h", "ascending"), ("n", "ascending")])
    hashes, kinds, labels = (got.column(c).to_pylist() for c in ("h", "kind", "label"))
    xs = got.column("x").combine_chunks()
    numbers = xs.flatten().to_numpy().reshape(len(hashes), len(FEATURES)) if len(hashes) else np.zeros((0, len(FEATURES)))
    return fit([(h >> 7 & 1, kind, y, x) for h, kind, y, x in zip(hashes, kinds, labels, numbers, strict=True)])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact_text(text: str, spans: list[Span]) -> str:
    """Every span, or stretch of overlapping spans, replaced by the mask of its first kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], MASKS[kind]]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: SpanModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of base spans by kind, their digest, and all selected spans."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few small trees

    def run(batches: Batches) -> Batches:
        own = shared.value
        for batch in batches:
            found = [own.spans(t) for t in str_texts(batch.column(1))]
            columns = [batch.column(0)]
            columns += [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
            columns.append(pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string()))
            columns.append(pa.array([listed(every) for _, every in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """The documents with masked texts and all their other columns; NULL texts stay NULL."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    (name,) = fresh(docs, "redacted")

    def run(batches: Batches) -> Batches:
        own = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            masked = [t if t is None else redact_text(t, own.spans(t)[1]) for t in texts]
            yield with_columns(batch, [text], **{name: pa.array(masked, pa.string())})

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text]
    out = docs.mapInArrow(run, ", ".join([*fields, f"`{name}` string"]))
    return out.select(*[F.col(f"`{name}`").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns])
