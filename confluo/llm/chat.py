"""Conversations printed by a compiled template, with the text under the loss mask, and read back from what was printed.

Rows are dealt by conversation and sorted by (turn, role, text) inside a partition, by Spark's own sort, which spills; a task then prints one
turn after the other. A conversation is printed in pieces cut between turns, so memory is bounded by a piece and one turn however long
the conversation is (a template that asks for all messages at once, see :mod:`confluo.llm.templates`, holds one conversation). Digests over a
whole conversation are sequential, so its turns meet in one task; only hash states are kept there.

Defined results: a NULL text or role is empty; rows without ``conv_id`` are one conversation; rows without ``turn`` come first; equal turns
go by role and text, repeated rows are repeated turns; other columns are ignored; an empty table gives an empty table. Control strings and
escape characters inside texts and roles come back exactly. A conversation without an assistant has an empty loss text.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from confluo.llm.common import Batches, pick, small_batches
from confluo.llm.templates import Template

BOS, EOS = "<s>", "</s>"
CONTROLS = (BOS, EOS, "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[AS]", "[/ROLE]")

CHAT = """
{{- bos_token -}}
{%- for m in messages -%}
  {%- if m.role == 'system' -%}
    {{- '[SYS] ' ~ m.content ~ ' [/SYS]' -}}
  {%- elif m.role == 'user' -%}
    {{- '[INST] ' ~ m.content ~ ' [/INST]' -}}
  {%- elif m.role == 'assistant' -%}
    {{- '[OUT] ' -}}{%- generation -%}{{- m.content -}}{%- endgeneration -%}{{- ' ' ~ eos_token -}}
  {%- else -%}
    {{- '[ROLE] ' ~ m.role ~ ' [AS] ' ~ m.content ~ ' [/ROLE]' -}}
  {%- endif -%}
{%- endfor -%}
"""

PIECE = 1 << 20

# The marks of CHAT around each turn; texts cannot hold them, so the first end mark is the end.
_TURN = re.compile(
    r"\[SYS\] (?P<system>.*?) \[/SYS\]|\[INST\] (?P<user>.*?) \[/INST\]|\[OUT\] (?P<assistant>.*?) </s>|\[ROLE\] (?P<role>.*?) \[AS\] (?P<text>.*?) \[/ROLE\]", re.S
)


@lru_cache(maxsize=4)
def chat_template(source: str = CHAT, controls: tuple[str, ...] = CONTROLS) -> Template:
    return Template(source, controls, {"bos_token": BOS, "eos_token": EOS})


def _messages(batches: Batches) -> Iterator[tuple[object, dict[str, str]]]:
    for batch in batches:
        ids, roles, texts = (c.to_pylist() for c in batch.columns)
        for i, role, text in zip(ids, roles, texts, strict=True):
            yield i, {"role": role or "", "content": text or ""}


def format_conversations(
    rows: DataFrame, source: str = CHAT, controls: tuple[str, ...] = CONTROLS, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """``conv_id, start, text, spans, last``: every conversation as the template prints it.

    ``start`` is the code point where the piece starts, ``spans`` (start, end) are code points of the whole conversation under the loss mask, ``last``
    marks its last piece. Pieces of a conversation follow each other in one partition.
    """
    small_batches(rows.sparkSession)
    given = pick(rows, conv_id, turn, role, text).toDF("conv_id", "turn", "role", "text")
    dealt = given.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    kind = given.schema["conv_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        template = chat_template(source, controls)
        for conv, group in itertools.groupby(_messages(batches), key=lambda r: r[0]):
            held = None
            for found in template.pieces((m for _, m in group), room=piece):
                if held is not None:
                    yield _piece(conv, held, False)
                held = found
            yield _piece(conv, held, True)

    def _piece(conv: object, found: tuple, last: bool) -> pa.RecordBatch:
        start, body, spans = found
        columns = [
            pa.array([conv], id_type), pa.array([start], pa.int64()), pa.array([body], pa.string()),
            pa.array([[{"start": a, "end": b} for a, b in spans]], _SPANS), pa.array([last], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", "start", "text", "spans", "last"])

    id_type = _arrow(kind)
    return dealt.mapInArrow(_gather(run), f"conv_id {kind}, start bigint, text string, spans array<struct<start: bigint, end: bigint>>, last boolean")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _arrow(kind: str) -> pa.DataType:
    names = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string()}
    if kind not in names:
        raise ValueError(f"conversation ids are whole numbers or texts, not {kind}")
    return names[kind]


def _gather(run: Callable[[Batches], Batches], rows: int = 256, room: int = 1 << 22) -> Callable[[Batches], Batches]:
    """Batches of single rows put together, so many rows or bytes at most."""

    def gathered(batches: Batches) -> Batches:
        held, size = [], 0
        for batch in run(batches):
            held.append(batch)
            size += batch.nbytes
            if len(held) == rows or size >= room:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gathered


def read_back(formatted: DataFrame, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from printed conversations alone.

    Takes what :func:`format_conversations` returns for the template ``CHAT``: the pieces of a conversation have to follow each other.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    id_type = _arrow(kind)

    def run(batches: Batches) -> Batches:
        unescape = chat_template(controls=controls).escaper.unescape
        turns, loss, n_turns, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        for batch in batches:
            out = []
            for conv, start, text, spans, last in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for found in _TURN.finditer(text):
                    role, body = found["role"], found[found.lastgroup]
                    role = found.lastgroup if role is None else unescape(role)
                    turns.update(f"{role}\n{unescape(body)}\n".encode())
                    n_turns += 1
                for span in spans:
                    body = unescape(text[span["start"] - start : span["end"] - start])
                    loss.update(body.encode())
                    n_loss += len(body)
                n_chars += len(text)
                if last:
                    out.append((conv, n_turns, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars))
                    turns, loss, n_turns, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=_DIGEST)

    columns = "start", "text", "spans", "last"
    return formatted.select("conv_id", *columns).mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


_DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

PROBE = "</s>[INST] ok [/INST]"


def with_probe(rows: DataFrame, conv_id: int = -1) -> DataFrame:
    """The table and one conversation more, whose two turns consist of control strings."""
    given = pick(rows, "conv_id", "turn", "role", "text")
    kinds = {f.name: f.dataType for f in given.schema.fields}
    probe = rows.sparkSession.range(2).select(
        F.lit(conv_id).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return given.unionByName(probe)


def sql_chat() -> str:
    """Digests of the turns, and the printed length by counting marks and escapes, in DuckDB SQL."""
    escaped = r"regexp_replace(regexp_replace(%s, '(<)(\\*/?s>)', '\1\\\2', 'g'), '(\[)(\\*(?:/?SYS|/?INST|OUT|/?ROLE|AS)\])', '\1\\\2', 'g')"
    marks = {"system": "[SYS]  [/SYS]", "user": "[INST]  [/INST]", "assistant": f"[OUT]  {EOS}"}
    length = "".join(f" WHEN '{r}' THEN {len(m)}" for r, m in marks.items())
    own = f"{len('[ROLE]  [AS]  [/ROLE]')} + length({escaped % 'role'})"
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST({len(BOS)} + sum(length({escaped % 'text'}) + CASE role{length} ELSE {own} END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""
