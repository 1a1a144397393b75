"""Chat formatting: records of any known layout become canonical turns.

A record's schema fingerprint is a hash of its sorted nested field paths; it
selects a declarative mapping that says where role and text of each turn are.
Turns are rendered with a template that marks them; control strings inside texts
are escaped reversibly, and the loss mask covers the assistants' texts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_map

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

#: Layouts by name: ("turns", list field, role field, text field, role names) or ("fields", ((field, role), ...)).
LAYOUTS: dict[str, tuple] = {
    "messages": ("turns", "messages", "role", "content", {}),
    "conversations": ("turns", "conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    "prompt": ("fields", (("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    "completion": ("fields", (("prompt", "user"), ("completion", "assistant"))),
    "instruction": ("fields", (("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    "question": ("fields", (("question", "user"), ("answer", "assistant"))),
}
#: Field paths of each layout; a second set, if any, leaves out what may be missing.
PATHS: dict[str, tuple[tuple[str, ...], ...]] = {
    "messages": (("messages", "messages[]", "messages[].content", "messages[].role"), ("messages",)),
    "conversations": (("conversations", "conversations[]", "conversations[].from", "conversations[].value"), ("conversations",)),
    "prompt": (("prompt", "response"), ("prompt", "response", "system")),
    "completion": (("completion", "prompt"),),
    "instruction": (("input", "instruction", "output"), ("instruction", "output"), ("input", "instruction", "output", "system"), ("instruction", "output", "system")),
    "question": (("answer", "question"),),
}


def field_paths(value, at: str = "") -> set[str]:
    """Nested field paths of a record; list elements share the path of their list and ``[]``."""
    out, stack = set(), [(value, at)]
    while stack:
        x, path = stack.pop()
        if isinstance(x, dict):
            for k, v in x.items():
                out.add(here := f"{path}.{k}" if path else k)
                stack.append((v, here))
        elif isinstance(x, list) and x:
            out.add(here := f"{path}[]")
            stack += [(v, here) for v in x]
    return out


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


BY_FINGERPRINT: dict[str, str] = {fingerprint(p): name for name, sets in PATHS.items() for p in sets}


def canonical(record: dict, layout: str) -> list[tuple[str, str]]:
    """(role, text) of each turn by the layout's mapping; null texts are empty."""
    kind, *rule = LAYOUTS[layout]
    if kind == "turns":
        field, role, text, names = rule
        return [(names.get(str(t[role] or ""), str(t[role] or "")), str(t[text] or "")) for t in record[field]]
    return [(role, str(record[field] or "")) for field, role in rule[0] if field in record]


def escape(text: str) -> str:
    """One more backslash in every ``<``, backslashes, ``|``; so no control string is left."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the code point spans that the loss covers."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        turns.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def format_records(records: DataFrame) -> DataFrame:
    """conv_id, layout, fingerprint, formatted text and loss spans of JSON records.

    ``records`` has conv_id and record. A record of no known layout, or that is
    no JSON object, gets a null layout, no turns and its fingerprint, so that
    nothing is lost silently; a null record counts as an empty object.
    """

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            try:
                record = json.loads(text.as_py() or "{}")
            except ValueError:
                record = None
            mark = fingerprint(field_paths(record))
            layout = BY_FINGERPRINT.get(mark) if isinstance(record, dict) else None
            formatted, spans = render(canonical(record, layout)) if layout else ("", [])
            yield conv_id, layout, mark, formatted, [list(s) for s in spans]

    return arrow_map(records.select("conv_id", "record"), rows, "conv_id long, layout string, fingerprint string, formatted string, loss array<array<long>>")


def as_records(conversations: DataFrame) -> DataFrame:
    """Rows by turn as JSON records in the layouts such data come in.

    A user's turn and its answer give a prompt record, with a system turn before
    them too; other conversations give messages. Turns are ordered by number; of
    equal numbers, by role and text. Null roles and texts are empty.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.concat_ws(",", F.transform("t", lambda x: x["role"]))
    text = lambda k: F.get("t", F.lit(k))["text"]
    usual = F.forall("t", lambda x: x["role"].isin("system", "user", "assistant"))
    name = lambda x: F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"])
    record = (
        F.when(roles == "user,assistant", F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(roles == "system,user,assistant", F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))))
        .when(usual & (F.col("conv_id") % 2 == 1), F.to_json(F.struct(F.transform("t", lambda x: F.struct(name(x).alias("from"), x["text"].alias("value"))).alias("conversations"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from the formatted texts."""

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for conv_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            text = text.as_py()
            turns = read_back(text)
            whole = "".join(f"{r}\n{t}\n" for r, t in turns)
            loss = "".join(unescape(text[a:b]) for a, b in spans)
            yield conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)

    return arrow_map(formatted.select("conv_id", "formatted", "loss"), rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
