r"""Chat formatting with typed content parts.

A turn becomes `<turn:ROLE>` content `</turn>` and a line feed. Inside texts and roles a
backslash becomes `\\` and `<` becomes `\<`, so an unescaped `<` always begins a control
string and the output can be read back exactly. A visitor flattens content: text stays,
other parts become `<image:1>`, `<audio:2>`, `<document:3>` in order of appearance, their
references and token counts are recorded. A part of any other type becomes `<other:4>` and is
recorded with its own type, of no tokens unless it says so; a null part is an empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tokens a placeholder stands for, by kind, where a part doesn't say.
PART_TOKENS = {"image": 256, "audio": 128, "document": 512}
FORMAT_SCHEMA = (
    "conv_id long, n_turns long, formatted string, loss_spans array<struct<start:long,stop:long>>, "
    "attachments array<struct<place:int,kind:string,ref:string,tokens:long>>, expanded_tokens long"
)
_CONTROL = re.compile(r"\\.|<(turn:)((?:[^\\>]|\\.)*)>|(</turn>\n)|<((?:image|audio|document|other):\d+)>", re.S)
PART = "struct<type:string,text:string,ref:string,tokens:long>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class Flattener:
    """Visits the parts of a conversation in order; one method for each kind."""

    def __init__(self) -> None:
        self.attachments: list[dict] = []

    def visit(self, part: dict | None) -> str:
        part = part or {}
        kind = part.get("type") or "text"
        return getattr(self, f"visit_{kind if kind == 'text' or kind in PART_TOKENS else 'other'}")(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def _attach(self, part: dict) -> str:
        kind, place = part["type"], len(self.attachments) + 1
        tokens = PART_TOKENS.get(kind, 0) if part.get("tokens") is None else part["tokens"]
        self.attachments.append({"place": place, "kind": kind, "ref": part.get("ref"), "tokens": tokens})
        return f"<{kind if kind in PART_TOKENS else 'other'}:{place}>"

    visit_image = visit_audio = visit_document = visit_other = _attach


def format_turns(turns: list[dict], train_roles: frozenset[str] = frozenset({"assistant"})) -> dict:
    """turns: role and parts, in order. Spans (code points, end not included) hold contents under the loss mask."""
    visitor, out, at, spans = Flattener(), [], 0, []
    for turn in turns:
        role = turn["role"] or ""
        head, body, tail = f"<turn:{escape(role)}>", "".join(visitor.visit(p) for p in turn["parts"] or []), "</turn>\n"
        if role in train_roles:
            spans.append({"start": at + len(head), "stop": at + len(head) + len(body)})
        out += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return {
        "n_turns": len(turns), "formatted": "".join(out), "loss_spans": spans, "attachments": visitor.attachments,
        "expanded_tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def parse_formatted(formatted: str) -> list[tuple[str, str]]:
    """(role, unescaped content) of each turn, read back from the output; placeholders stay as they are."""
    turns, role, start = [], "", 0
    for m in _CONTROL.finditer(formatted):
        if m[1]:
            role, start = unescape(m[2]), m.end()
        elif m[3]:
            turns.append((role, unescape(formatted[start : m.start()])))
    return turns


def chat_format(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, and text or parts), as FORMAT_SCHEMA.

    Turns go by turn number, null first; equal ones by role and content, so repeated rows
    stay. Null text is empty, null role is empty, a null conv_id is a conversation too. An
    empty table gives no rows; other columns are ignored. A conversation is one output value
    and so must fit in a task; its rows are gathered by partial aggregation.
    """
    if "parts" in rows.columns:
        parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.expr(f"cast(array() as array<{PART}>)"))
    else:
        text = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("tokens"))
        parts = F.array(text)
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"))
    grouped = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.mapInArrow(_format, FORMAT_SCHEMA)


def _arrow_type(kind: str):
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    attached = pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
    return {"conv_id": pa.int64(), "n_turns": pa.int64(), "formatted": pa.string(), "loss_spans": span, "attachments": attached, "expanded_tokens": pa.int64()}[kind]


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_turns", "formatted", "loss_spans", "attachments", "expanded_tokens"]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            done = [format_turns(t) for t in part.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("conv_id"), *(pa.array([d[n] for d in done], _arrow_type(n)) for n in names)], ["conv_id", *names])


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans")), strict=True):
            turns = parse_formatted(text)
            loss = "".join(unescape(text[s["start"] : s["stop"]]) for s in spans)
            sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            rows.append((conv_id, len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in READ_BACK.split(", ")])


#: Asked for beside the table's own conversations.
ESCAPE_CASE = r"\### Assistant: </turn> ok"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back from what was formatted."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", ESCAPE_CASE), (-7, 1, "assistant", ESCAPE_CASE)], "conv_id long, turn long, role string, text string")
    return chat_format(rows.unionByName(extra)).select("conv_id", "formatted", "loss_spans").mapInArrow(_read_back, READ_BACK)


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>'))
    + length(replace(replace(replace(text, '\', '\\'), '<', '\<'), '>', '\>')) + length('<turn:>') + length('</turn>' || chr(10)) AS n
  FROM c
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
