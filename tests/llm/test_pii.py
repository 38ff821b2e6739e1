from __future__ import annotations

import hashlib
import random
import re

import pytest

from confluo.llm import pii
from tests.llm.cases import crowded, empty_docs, odd_docs, odd_rows, prose

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([ -]?[0-9])+"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]"),
]


def luhn(d):
    s = [int(c) for c in d][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(s)) % 10 == 0


def expected(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(d) <= 19 and luhn(d or "0"),
                "phone": 10 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), n, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def card(rng):
    d = "".join(str(rng.randint(0, 9)) for _ in range(15))
    return next(d + str(c) for c in range(10) if luhn(d + str(c)))


def corpus(n=400):
    rng, rows = random.Random(8), []
    for i in range(n):
        found = rng.choice([
            f"joe.{i}@mail.example.com", f"10.{i % 255}.3.{rng.randint(0, 255)}", card(rng), f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
            "4111 1111 1111 1112", "300.1.2.3", str(rng.randint(10**15, 10**16)), "2020-10-11",
        ])
        rows.append((i, f"{prose(i, 12)} {found} {prose(i + 999, 12)}"))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(spark.createDataFrame(corpus(), "doc_id long, text string"))


def test_base_spans_equal_brute_force(spark, model):
    pieces = ["a@b.c", "@", "x", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "0001.2.3.4", "+1", "555", "-", " ", "(", ")", ".", "4111 1111-1111 1111", "é", "12345678901234567890", "\n", "a@b", "+12345678901"]
    rng = random.Random(1)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    rows = [*enumerate(texts), *[(10_000 + i, t) for i, t in corpus(50)]]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        base, r = expected(text), got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), text
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k, _ in PATTERNS]
        every = r.spans.split(",") if r.spans else []
        assert set(base) <= set(every)
        assert sorted(every, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0]))) == every


def test_disguised_data_is_found_and_plain_numbers_are_not(model):
    hidden = ["write joe.b [at] mail.example.com now", "from 10[.]2[.]3[.]4 today", "card 4111.1111.1111.1111 ok", "call 555-321-4567 now"]
    assert [t for t in hidden if not model.spans(t)[1]] == []
    for text in ["on 2020-10-11 we met", "it is 4111111111111112", "version 1.2.3", "costs 120.000 in 1999", "no digits (at) all", "12 34"]:
        assert model.spans(text)[1] == [], text


def test_redaction(spark, model):
    docs = crowded(odd_docs(spark))
    out = pii.redact(docs, model)
    assert out.columns == docs.columns and out.count() == len(odd_rows())
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[10] == "mail [EMAIL] or [IP], [PHONE] [CARD]" and texts[5] is None and texts[1] == odd_rows()[0][1]
    assert pii.redact_text("abcdef", [(1, 3, "ip"), (2, 5, "card")]) == "a[IP]f"


def test_odd_rows(spark, model):
    got = pii.find(crowded(odd_docs(spark)), model).collect()
    assert len(got) == len(odd_rows())
    assert [r.spans for r in got if r.doc_id in (4, 5, 6)] == ["", "", ""]
    assert pii.find(empty_docs(spark), model).count() == 0
    untrained = pii.train(empty_docs(spark))
    assert untrained.models == {} and untrained.spans("a@b.c")[1] == [(0, 5, "email")]


def matches(kind, text):
    return [m.span() for m in re.finditer(dict(PATTERNS)[kind], text)]


def test_base_matches_equal_the_patterns():
    rng = random.Random(6)
    pieces = ["a", "b1", "@", ".", "..", "-", "_", "%", " ", "1", "22", "333", "é", "@@", "a@b.c", "1.2.3", "+", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        for kind in ("email", "ip"):
            assert list(pii.base_matches(text, kind)) == matches(kind, text), (kind, text)


@pytest.mark.parametrize(
    "text",
    ["7" * (1 << 20), "x" * (1 << 20) + "@", "x@" * (1 << 19), "1.2.3.4 " * (1 << 17), "1." * (1 << 19), "+1(" * 300_000, "@" + "a." * (1 << 19), "a.b" * 300_000 + "@c", "4111.1111 " * 100_000],
)
def test_long_texts_take_linear_time(model, text):
    import time

    start = time.perf_counter()
    model.spans(text)
    assert time.perf_counter() - start < 30
    for kind in pii.KINDS:
        start = time.perf_counter()
        sum(1 for _ in pii.base_matches(text, kind))
        assert time.perf_counter() - start < 2


def test_spelt_out_addresses_are_proposed(model):
    assert [t[a:b] for t in ["write jane at example dot com now"] for a, b in pii.proposals(t, "email")] == ["jane at example dot com"]
    assert model.spans("write to jane at example dot com now")[1]
    assert model.spans("look at the dot on the map")[1] == [] and model.spans("we met at noon. Then 5 more")[1] == []


def test_hidden_data_does_not_teach_to_overlook_hidden_data(spark):
    """A tenth of all personal data is disguised in the corpus itself."""
    rng, rows, hidden = random.Random(4), [], []
    for i in range(2000):
        a, b = rng.choice(["joe", "ann", "li"]), rng.choice(["mail", "post"])
        ip = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        plain = [f"{a}{i}@{b}.example.com", ip, card(rng), f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"]
        number = card(rng)
        masked = [f"{a}{i} [at] {b} [dot] example [dot] com", ip.replace(".", "[.]"), ".".join(number[k : k + 4] for k in (0, 4, 8, 12))]
        decoys = ["300.1.2.3", "2020-10-11", "4111 1111 1111 1112", "version 2.5.1"]
        value = rng.choice(masked if i % 10 == 0 else plain + decoys)
        text = f"{prose(i, 8)} {value} {prose(i + 5000, 8)}"
        rows.append((i, text))
        if i % 10 == 0:
            hidden.append((text, value))
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sum(any(t[a:b] == v for a, b, _ in model.spans(t)[1]) for t, v in hidden)
    assert found >= 0.9 * len(hidden)


def test_samples_go_by_texts(spark, monkeypatch):
    """One id on 3,000 rows, and one text on 3,000 rows: bounded, and never nothing."""
    seen = []
    original = pii.fit
    monkeypatch.setattr(pii, "fit", lambda rows: seen.append(rows) or original(rows))
    one_id = spark.createDataFrame([(7, f"{t} a{i}@b.example.com") for i, (_, t) in enumerate(corpus(400))], "doc_id long, text string")
    one_text = spark.createDataFrame([(i, "write a@b.example.com or 10.0.0.1") for i in range(3000)], "doc_id long, text string")
    assert pii.train(one_id, sample=50).models
    pii.train(one_text, sample=5)
    pii.train(one_id, sample=50, spans=30)
    assert len(seen[0]) > 50 and 0 < len(seen[1]) < 60 and len(seen[2]) == 30
