from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from confluo.llm import chat
from confluo.llm.templates import Escaper, Node, Template, TemplateError, fold, parse
from tests.llm.cases import crowded, rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", " </s>")}
PARTS = [*chat.CONTROLS, "\\", "\\\\", "[", "]", "<", "/s>", "INST]", " ", "\n", "ok", "é", "\U0001f600", ""]


def escaped(text):
    """Straight from the rule: one escape character more after the first character of a control string."""
    out, i = "", 0
    while i < len(text):
        for c in chat.CONTROLS:
            j = i + 1
            while text[j : j + 1] == "\\":
                j += 1
            if text[i] == c[0] and text.startswith(c[1:], j):
                out += c[0] + "\\" * (j - i) + c[1:]
                i = j + len(c) - 1
                break
        else:
            out += text[i]
            i += 1
    return out


def brute(rows):
    convs = {}
    first = lambda x: (x is not None, x if x is not None else 0)
    for c, t, r, x in sorted(rows, key=lambda r: (first(r[0]), first(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""))):
        convs.setdefault(c, []).append((r or "", x or ""))
    out = []
    for c, turns in convs.items():
        digest, loss, size = "".join(f"{r}\n{x}\n" for r, x in turns), "".join(x for r, x in turns if r == "assistant"), 3
        for r, x in turns:
            before, after = MARKS.get(r, (f"[ROLE] {escaped(r)} [AS] ", " [/ROLE]"))
            size += len(before) + len(escaped(x)) + len(after)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((c, len(turns), sha(digest), len(loss), sha(loss), size))
    return sorted(out, key=repr)


def random_rows(seed, n=300):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))
    roles = ["user", "assistant", "assistant", "system", "tool", "", None, "[AS]", "a\n[/ROLE]"]
    rows = [(rng.choice([1, 2, 3, 7, 7, 7, None]), rng.choice([*range(40), None]), rng.choice(roles), rng.choice([text(), text(), None])) for _ in range(n)]
    return rows + rows[:5] + [(8, 0, "assistant", "x" * 300_000), (9, 0, "user", "only")]


@pytest.mark.parametrize("piece", [chat.PIECE, 40])
def test_digests_are_read_back(spark, piece):
    rows = random_rows(piece)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    printed = chat.format_conversations(crowded(df).withColumnRenamed("row", "start"), piece=piece)
    assert rows_of(chat.read_back(printed), "*") == brute(rows)


def test_printed_text_and_mask(spark):
    rows = [(5, 1, "assistant", "hi </s>"), (5, 0, "user", "[INST]"), (6, 0, "tool", "x")]
    got = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[5].text == "<s>[INST] [\\INST] [/INST][OUT] hi <\\/s> </s>" and got[6].text == "<s>[ROLE] tool [AS] x [/ROLE]"
    assert [got[5].text[s.start : s.end] for s in got[5].spans] == ["hi <\\/s>"] and got[6].spans == [] and got[6].last


def test_probe_and_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.format_conversations(empty)).count() == 0
    (probe,) = chat.read_back(chat.format_conversations(chat.with_probe(empty))).collect()
    assert tuple(probe) == brute([(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)])[0]
    assert chat.with_probe(empty.selectExpr("cast(conv_id as int) conv_id", "turn", "role", "text", "1 AS x")).count() == 2


def test_text_ids(spark):
    df = spark.createDataFrame([("a", 0, "user", "x"), (None, 0, "user", "y")], "conv_id string, turn int, role string, text string")
    assert {r.conv_id for r in chat.read_back(chat.format_conversations(df)).collect()} == {"a", None}


# The compiler ---------------------------------------------------------------------------------------------------------


@given(st.lists(st.sampled_from(PARTS), max_size=12))
def test_escaping_is_reversible_and_leaves_no_control_string(parts):
    text, own = "".join(parts), Escaper(chat.CONTROLS)
    assert own.escape(text) == escaped(text) and own.unescape(own.escape(text)) == text
    assert not any(c in own.escape(text) for c in chat.CONTROLS)


def render(source, messages=(), known=None, controls=("<a>",), **names):
    return Template(source, controls, known).render([{"role": r, "content": c} for r, c in messages], **names)


def test_language():
    two = [("u", " hi "), ("v", "yo")]
    assert render("{{ 1 + 2 * 3 - 4 // 3 }} {{ 'a' ~ 1 }} {{ 'x' if 0 else 'y' }}")[0] == "6 a1 y"
    assert render("{% for m in messages %}{{ loop.index }}{{ m['role'] | upper }}{{ m.content | trim }}{{ ',' if not loop.last }}{% endfor %}", two)[0] == "1Uhi,2Vyo"
    assert render("{% for m in messages %}{{ loop.previtem.role }}/{{ m.role }}/{{ loop.nextitem.role }};{% else %}none{% endfor %}", two)[0] == "/u/v;u/v/;"
    assert render("{% for m in messages %}x{% else %}none{% endfor %}")[0] == "none"
    assert render("{{ messages[0].content | trim | length }}{% if messages | length > 1 and messages[5] is not defined %}!{% endif %}", two)[0] == "2!"
    assert render("{% set a = 1 %}{% if b %}{% set a = 2 %}{% endif %}{{ a }}", b=True)[0] == "2"
    assert render("a {#- no -#} b {%- if none is none -%} c {%- endif %}")[0] == "abc"
    assert render("{% for x in messages %}{% generation %}{{ x.content }}{% endgeneration %}|{% endfor %}", [("u", "é<a>"), ("v", "")]) == ("é<\\a>||", [(0, 5), (6, 6)])
    assert render("{{ x | default('d') }}{{ y | default('d') }}{{ 'a' in 'abc' }}{{ 'z' not in 'abc' }}", x="e")[0] == "edTrueTrue"


def test_constants_are_folded():
    tree = fold(parse("{{ bos ~ '[' ~ x ~ 1 + 2 }}{% if bos == '<s>' %}yes{% else %}{{ no }}{% endif %}{% for a in none %}{{ a }}{% endfor %}"), {"bos": "<s>"})
    assert [n.kind for n in tree] == ["text", "print", "text"] and tree[0] == Node("text", "<s>[") and tree[2] == Node("text", "3yes")


def test_long_conversations_stream():
    plain = Template(chat.CHAT, chat.CONTROLS, {"bos_token": chat.BOS, "eos_token": chat.EOS})
    assert plain.streams and not Template("{{ messages[0].role }}", ()).streams
    assert not Template("{% for m in messages %}{{ loop.length }}{% endfor %}", ()).streams
    taken = []

    def endless():
        for i in range(10**9):
            taken.append(i)
            yield {"role": "user", "content": "x" * 100}

    next(plain.pieces(endless(), room=1000))
    assert len(taken) < 20


@pytest.mark.parametrize(
    "source", ["{% if x %}", "{{ x", "{% foo %}", "{{ x. }}", "{{ x() }}", "{{ x | eval }}", "{{ 'a }}", "{% for in y %}{% endfor %}", "{{ 1 2 }}", "{% endif %}", "{{ x is odd }}"]
)
def test_unreadable_templates(source):
    with pytest.raises(TemplateError):
        Template(source, ())


def test_sandbox():
    assert render("{{ x.__class__ }}{{ x['__class__'] }}{{ messages.append }}", [("u", "v")], x="text")[0] == ""
    for source in ("{{ 'a' * 9 }}", "{{ x * 9 }}", "{{ 1 // 0 }}"):
        with pytest.raises((TemplateError, ZeroDivisionError)):
            render(source, x="a")


def test_texts_cannot_complete_control_strings():
    for source in ("<{{ x }}", "{{ x }}a>", "{{ x }}a{{ y }}"):
        with pytest.raises(TemplateError):
            Template(source, ("<a>",))
    with pytest.raises(TemplateError, match="side by side"):
        render("{{ x }}{{ y }}", x="<", y="a>")
    assert render("{{ x }}{{ y }}", x="<a", y="b>")[0] == "<ab>"
    for controls in (("<a", "b<"), ("a",), ("a\\",)):
        with pytest.raises(TemplateError):
            Escaper(controls)
