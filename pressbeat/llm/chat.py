"""Conversations as training text with a loss mask, by any template that renders a list of messages.

The template is a black box: a function from messages to one string. Successive prefixes of a conversation are rendered and
consecutive outputs compared: what the output grows by is the span of the new turn. Where an output does not begin with the
one before it, the template has rewritten history and the turns it changed are reported. The text inside a span is found by
rendering the last turn with two different probes, whose outputs agree up to where the text starts and after where it ends.

Control strings inside texts are escaped by a backslash before each, backslashes by doubling, so a text can never open or close a
turn and is read back exactly. Rows of a conversation are taken by turn, ties by role and text; a null role or text is empty, a
null conversation id is a conversation of its own; repeated rows are repeated turns. Other columns are not read. A conversation
is one output row by nature: rendering its prefixes costs its length times its turns, as the method asks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressbeat.llm.common import lengthy, map_arrow

Message = tuple[str, str]
Template = Callable[[list[Message]], str]

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
ESCAPED = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))
UNESCAPED = re.compile(r"\\(\\|" + "|".join(map(re.escape, CONTROLS)) + ")")


def escape(text: str) -> str:
    return ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return UNESCAPED.sub(r"\1", text)


def marked(role: str) -> tuple[str, str]:
    """What the own template puts before and after a turn of ``role``."""
    known = {"user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>\n")}
    return known.get(role) or (f"<s>[ROLE] {escape(role)} [/ROLE] ", " </s>")


def instruction_template(messages: list[Message]) -> str:
    """The own template; the texts it is given are already escaped."""
    return "".join(f"{before}{text}{after}" for (before, after), text in ((marked(role), text) for role, text in messages))


def role_of(mark: str) -> str:
    """The role whose turns the own template opens with ``mark``."""
    for role in ("user", "assistant", "system"):
        if mark == marked(role)[0]:
            return role
    return unescape(mark.removeprefix("<s>[ROLE] ").removesuffix(" [/ROLE] "))


class Turn(NamedTuple):
    """Where a turn and its text lie in the rendered conversation; -1 where the template has removed or changed the text."""

    role: str
    start: int
    end: int
    text_start: int
    text_end: int


def shared(a: str, b: str) -> int:
    """How many characters two strings share from the start."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def render(messages: list[Message], template: Template = instruction_template) -> tuple[str, list[Turn], list[int]]:
    """The rendered conversation, its turns and the numbers of the turns at which the template rewrote history."""
    escaped = [(role, escape(text)) for role, text in messages]
    before, turns, rewritten = "", [], []
    for k, (role, text) in enumerate(escaped):
        prefix = escaped[:k]
        output = template(prefix + [(role, text)])
        same = shared(before, output)
        if same < len(before):
            rewritten.append(k)
            turns = [t if t.end <= same else t._replace(start=min(t.start, same), end=same, text_start=-1, text_end=-1) for t in turns]
        probes = [template(prefix + [(role, probe)]) for probe in ("x", "y")]
        at = shared(*probes)
        tail = len(probes[0]) - at - 1
        end = len(output) - tail
        found = at <= end and output[at:end] == text and at >= same
        turns.append(Turn(role, same, len(output), at if found else -1, end if found else -1))
        before = output
    return before, turns, rewritten


def format_conversations(rows: DataFrame, template: Template = instruction_template, assistant: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (spans), loss (text spans of the assistant), rewritten."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64())])
        edge = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in lengthy(batches, 4 << 20):
            texts, spans, losses, histories = [], [], [], []
            for turns in batch.column(1).to_pylist():
                text, found, rewritten = render([(t["role"], t["text"]) for t in turns], template)
                texts.append(text)
                spans.append([{"start": t.start, "end": t.end, "text_start": t.text_start, "text_end": t.text_end} for t in found])
                losses.append([{"start": t.text_start, "end": t.text_end} for t in found if t.role == assistant and t.text_start >= 0])
                histories.append(rewritten)
            arrays = [batch.column(0), pa.array(texts, pa.string()), pa.array(spans, pa.list_(span)), pa.array(losses, pa.list_(edge)), pa.array(histories, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "formatted", "turns", "loss", "rewritten"])

    empty = F.lit("")
    slim = rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce(F.col("role"), empty).alias("role"), F.coalesce(F.col("text"), empty).alias("text"))
    grouped = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    kind = (
        "conv_id bigint, formatted string, turns array<struct<start: bigint, end: bigint, text_start: bigint, text_end: bigint>>, "
        "loss array<struct<start: bigint, end: bigint>>, rewritten array<int>"
    )
    return map_arrow(grouped, run, kind)


def read_back(formatted: str, turns: list[dict]) -> list[Message]:
    """Roles and texts of a conversation rendered by the own template, from the rendered text and its spans alone."""
    return [(role_of(formatted[t["start"] : t["text_start"]]), unescape(formatted[t["text_start"] : t["text_end"]])) for t in turns]


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold: turns and loss text read back, as counts and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = read_back(text, row["turns"])
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in row["loss"])
                said = "".join(f"{role}\n{words}\n" for role, words in turns)
                out.append((row["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    kind = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return map_arrow(formatted.select("conv_id", "formatted", "turns", "loss"), run, kind)
