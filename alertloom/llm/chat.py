"""Chat formatting: layouts found by schema fingerprint, canonical turns, one reversible template.

The fingerprint of a record is the hash of its sorted nested field paths. It selects a declared
mapping from layout to turns, so prompt, instruction and message layouts of one table all become
(role, text) turns without guessing. Turns are rendered between control strings; control strings
inside texts are escaped, and the loss mask covers the assistant texts.

A conversation may be long: its turns are sorted within a partition and formatted as they stream
by, one row per turn with its place in the conversation; hashes over a conversation are running
ones. Nulls: a null text or role is empty, a null conv_id is a conversation of its own, a null
turn comes first. Rows with equal turn are ordered by place, role and text. A record of an
unknown layout or broken JSON gives one row without role and with layout null, and no turns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.common import stored


@dataclass(frozen=True)
class Layout:
    """``each``: path of a list of turns with ``role`` and ``text`` fields; or ``turns``: roles with fields to join."""

    name: str
    paths: tuple[str, ...]
    each: str = ""
    role: str = "role"
    text: str = "content"
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()


def _listed(name: str, each: str, role: str, text: str, extra: tuple[str, ...] = ()) -> list[Layout]:
    full = (f"{each}[]", f"{each}[].{role}", f"{each}[].{text}", *extra)
    return [Layout(name, full, each, role, text), Layout(name, (f"{each}[]", *extra), each, role, text)]


LAYOUTS: tuple[Layout, ...] = (
    Layout("turn", ("role", "text"), role="role", text="text"),
    Layout("turn", ("role", "content"), role="role", text="content"),
    *_listed("messages", "messages", "role", "content"),
    *_listed("conversations", "conversations", "from", "value"),
    Layout("prompt", ("prompt", "completion"), turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt", ("prompt", "response"), turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("prompt", ("prompt", "response", "system"), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question", ("question", "answer"), turns=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout("instruction", ("instruction", "output"), turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction", ("instruction", "input", "output"), turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("nested prompt", ("data", "data.prompt", "data.response"), turns=(("user", ("data.prompt",)), ("assistant", ("data.response",)))),
)

#: Names that layouts use for the three roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(value: Any, at: str = "") -> set[str]:
    """Nested field paths; items of lists share the path of their list, and items that are no objects name their kind."""
    if isinstance(value, dict):
        paths: set[str] = set()
        for k, v in value.items():
            here = f"{at}.{k}" if at else k
            if not isinstance(v, list):
                paths.add(here)
            paths |= field_paths(v, here)
        return paths
    if isinstance(value, list):
        kinds = {f"{at}[]:{type(v).__name__}" for v in value if not isinstance(v, (dict, list))}
        return {f"{at}[]"}.union(kinds, *(field_paths(v, f"{at}[]") for v in value))
    return set()


def fingerprint(paths: Sequence[str] | set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


def _at(value: Any, path: str) -> Any:
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _string(value: Any) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(value: Any, layout: Layout) -> list[tuple[str, str]]:
    """Canonical turns of a record."""
    if layout.turns:
        joined = [(role, "\n\n".join(filter(None, (_string(_at(value, f)) for f in fields)))) for role, fields in layout.turns]
        return [(role, text) for role, text in joined if role != "system" or text]
    rows = _at(value, layout.each) if layout.each else [value]
    found = [(_string(r.get(layout.role)), _string(r.get(layout.text))) for r in rows or []]
    return [(ROLES.get(role, role) if layout.name != "turn" else role, text) for role, text in found]


def canonical_turns(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``conv_id, turn, part, role, text, layout`` from JSON records ``conv_id, turn, record``."""
    declared: Mapping[str, Layout] = {fingerprint(x.paths): x for x in layouts}

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for at, raw in enumerate(batch.column("record").to_pylist()):
                try:
                    value = json.loads(raw or "null")
                    layout = declared.get(fingerprint(field_paths(value)))
                except (ValueError, RecursionError):  # broken, or nested too deeply for any layout
                    layout = None
                if layout is None:
                    rows.append((at, 0, None, None, None))
                else:
                    rows += [(at, n, role, text, layout.name) for n, (role, text) in enumerate(turns_of(value, layout))]
            at, *rest = zip(*rows, strict=True) if rows else ((),) * 5
            take = pa.array(at, pa.int64())
            types = (pa.int32(), pa.string(), pa.string(), pa.string())
            columns = [batch.column(c).take(take) for c in ("conv_id", "turn")]
            columns += [pa.array(v, t) for v, t in zip(rest, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "part", "role", "text", "layout"])

    rows = records.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "turn")], "record")
    return rows.mapInArrow(convert, "conv_id long, turn long, part int, role string, text string, layout string")


# The template. No text between marks holds a control string, so marks are found by searching.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER = ("[ROLE] ", " [/ROLE] ", " [/TURN]")
_NAMES = r"(?:/?s>|/?INST\]|<SYS>>|</SYS>>|/?ROLE\]|/?TURN\])"
_CONTROL = re.compile(rf"([<\[])(\\*)(?={_NAMES})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_NAMES})")


def escape(text: str) -> str:
    """A backslash more within each control string, escaped ones included."""
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as text, and the span of the loss mask in it (empty but for the assistant)."""
    if role in MARKS:
        begin, end = MARKS[role]
    else:
        begin, end = f"{OTHER[0]}{escape(role)}{OTHER[1]}", OTHER[2]
    body = escape(text)
    at = len(begin)
    return f"{begin}{body}{end}", at, at + len(body) if role == "assistant" else at


def read_turn(formatted: str, at: int = 0) -> tuple[str, str, int]:
    """Role and text of the turn at a place of formatted text, and the place behind it."""
    for role, (begin, end) in MARKS.items():
        if formatted.startswith(begin, at):
            stop = formatted.index(end, at + len(begin))
            return role, unescape(formatted[at + len(begin) : stop]), stop + len(end)
    if not formatted.startswith(OTHER[0], at):
        raise ValueError(f"no turn at {at}")
    middle = formatted.index(OTHER[1], at)
    stop = formatted.index(OTHER[2], middle + len(OTHER[1]))
    role = unescape(formatted[at + len(OTHER[0]) : middle])
    return role, unescape(formatted[middle + len(OTHER[1]) : stop]), stop + len(OTHER[2])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conversation, begin = object(), 0
    for batch in batches:
        rows = []
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if conv != conversation:
                conversation, begin = conv, 0
            formatted, a, b = render(role, text)
            rows.append((conv, begin, formatted, begin + a, begin + b))
            begin += len(formatted)
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["conv_id", "start", "formatted", "loss_start", "loss_end"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def format_turns(turns: DataFrame) -> DataFrame:
    """Stored ``conv_id, start, formatted, loss_start, loss_end``: the rows of a conversation in order are its text."""
    known = turns.filter("layout IS NOT NULL")
    ordered = known.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "role", "text")
    schema = "conv_id long, start long, formatted string, loss_start long, loss_end long"
    return stored(ordered.mapInArrow(_format, schema), "formatted")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    conversation: Any = None
    state: list | None = None

    def closed() -> tuple:
        n, turns, loss_chars, loss, chars = state
        return conversation, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if state is None or r["conv_id"] != conversation:
                if state is not None:
                    rows.append(closed())
                conversation, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            text, at = r["formatted"], 0
            while at < len(text):
                role, said, at = read_turn(text, at)
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            masked = unescape(text[r["loss_start"] - r["start"] : r["loss_end"] - r["start"]])
            state[2] += len(masked)
            state[3].update(masked.encode())
            state[4] += len(text)
        yield batch_of(rows)
    if state is not None:
        yield batch_of([closed()])


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted text: turns, their hash, masked text and its hash."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "start")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(_digests, schema)


def op2_chat(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    said = "</s>[INST] ok [/INST]"
    extra = json.dumps({"messages": [{"role": r, "content": said} for r in ("user", "assistant")]})
    added = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit(extra).alias("record"))
    return digests(format_turns(canonical_turns(rows.select("conv_id", "turn", record.alias("record")).unionByName(added))))


OP2_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) t(k)
), escaped AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>|/?ROLE\]|/?TURN\])', '\1\\\2\3', 'g') AS body,
         regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>|/?ROLE\]|/?TURN\])', '\1\\\2\3', 'g') AS name
  FROM turns
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
                ELSE 24 + length(name) END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
