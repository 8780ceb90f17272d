"""Conversations formatted by a compiled template, with the spans the loss is taken on."""

from __future__ import annotations

import hashlib
import itertools
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strataflow.llm.common import ship
from strataflow.llm.template import compile_template

#: Strings with a meaning to the reader of the output; inside texts they are escaped.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "[TEXT]")
TEMPLATE = (
    "<s>{% for m in messages %}[TURN]{{ m.role }}[TEXT]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text }}{% endgeneration %}"
    "{% elif m.role == 'user' %}[INST]{{ m.text }}[/INST]"
    "{% else %}{{ m.text }}{% endif %}{% endfor %}</s>"
)
BACKSLASH = "\\"


class Escaper:
    """Make control strings in a text harmless, and undo it exactly.

    A backslash becomes two; after the first character of a control string goes a backslash and a dot.
    So an escaped text holds no control string. None may have a backslash, fewer than two characters,
    or a later character that begins a control string, so none can arise where two texts meet.
    """

    def __init__(self, controls: tuple[str, ...]):
        firsts = {c[:1] for c in controls}
        if any(len(c) < 2 or BACKSLASH in c or firsts & set(c[1:]) for c in controls):
            raise ValueError("control strings need two characters, no backslash and no first character inside")
        listed = "|".join(re.escape(c[1:]) for c in sorted(controls, key=len, reverse=True))
        heads = "".join(re.escape(c) for c in sorted(firsts))
        self._mark = re.compile(rf"([{heads}])(?={listed})") if controls else None
        self._undo = re.compile(r"\\(.)", re.S)

    def escape(self, text: str) -> str:
        text = text.replace(BACKSLASH, BACKSLASH * 2)
        return self._mark.sub(r"\1\\.", text) if self._mark else text

    def unescape(self, text: str) -> str:
        return self._undo.sub(lambda m: BACKSLASH if m[1] == BACKSLASH else "", text)


def format_conversations(
    turns: DataFrame, template: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS, conv: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss`` (start and end code points of every
    piece under a generation marker).

    The template is compiled once per task and renders each conversation as a stream of pieces. Turns
    stand in the order of ``turn`` (nulls first; ties by role, then text). Rows are sorted within
    partitions by conversation and read as a stream, so a task holds one conversation's output at a
    time, never a group as a table.

    Ids keep their type and value: large whole numbers beside a null are not rounded.

    Defined cases: a null text or role is empty; rows with a null conversation id form one
    conversation with a null id; repeated rows are turns of their own; texts of any length are whole, a
    conversation being one cell; an empty table gives no rows; further columns are ignored. Control strings inside texts and roles are escaped reversibly.
    """
    ship(turns.sparkSession)
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("formatted", pa.string()), ("loss", spans_type)])

    def render(batches):
        run = compile_template(template, Escaper(controls).escape)
        columns = ("conv_id", "role", "text")
        flat = (row for b in batches for row in zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in columns], strict=True))
        out, size = [], 0
        for which, group in itertools.groupby(flat, key=lambda x: x[0]):
            pieces, spans, at = [], [], 0
            for piece, masked in run({"messages": ({"role": r, "text": t} for _, r, t in group)}):
                if masked and piece:
                    spans.append({"start": at, "end": at + len(piece)})
                pieces.append(piece)
                at += len(piece)
            out.append((which, "".join(pieces), spans))
            size += at
            if size > 1 << 22:
                yield _batch(out, schema)
                out, size = [], 0
        if out:
            yield _batch(out, schema)

    return rows.mapInArrow(render, f"conv_id {kind.simpleString()}, formatted string, loss array<struct<start:long,end:long>>")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_turns(formatted: str, controls: tuple[str, ...] = CONTROLS) -> list[tuple[str, str]]:
    """(role, text) of every turn, read back from text in the default template."""
    undo = Escaper(controls).unescape
    turns = []
    for part in formatted.removeprefix("<s>").removesuffix("</s>").split("[TURN]")[1:]:
        role, _, body = part.partition("[TEXT]")
        if body.startswith("[INST]"):
            body = body.removeprefix("[INST]").removesuffix("[/INST]")
        turns.append((undo(role), undo(body)))
    return turns


def digests(formatted: DataFrame, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """What the formatted texts say, read back: counts and digests of the turns and the loss text."""

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def read(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        undo, out = Escaper(controls).unescape, []
        for text, marked in zip(texts, spans, strict=True):
            turns = read_turns(text, controls)
            every, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
            for role, body in turns:
                every.update(f"{role}\n{body}\n".encode())
            for span in marked:
                said = undo(text[span["start"] : span["end"]])
                loss.update(said.encode())
                chars += len(said)
            out.append((len(turns), every.hexdigest(), chars, loss.hexdigest(), len(text)))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    ship(formatted.sparkSession)
    found = formatted.select("conv_id", read("formatted", "loss").alias("r"))
    return found.select("conv_id", "r.*")
