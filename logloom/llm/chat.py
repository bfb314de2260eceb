"""Chat formatting: conversations through a finite-state machine over roles.

A template declares the roles' labels, which roles carry loss, the states that
may follow each other, and the marks. Every turn moves the machine; a turn that
its state does not allow is written all the same, but the conversation is not
valid, and the first such turn and what was expected are reported. Each turn
gives three segments: a header, the text and the end mark. Only the text of a
loss role carries loss.

Texts are escaped so that no mark can occur inside them, whatever they hold,
and every text comes back from the output (``read_back``).

A conversation's rows are dealt to one task, sorted and streamed: the machine's
state and one part are held, never a conversation. A part is written when it
passes ``part_chars``, so a conversation of any length is a run of parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

START = "start"


@dataclass(frozen=True)
class Template:
    """``follows``: for each state (``start`` or the role of the last turn) the roles
    that may come next. ``ends``: roles that a whole conversation may end with."""

    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"})
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant", "tool")})
    ends: frozenset[str] = frozenset({"user", "assistant"})
    opening: str = "### "
    closing: str = ": "
    end: str = "</turn>\n"

    def header(self, role: str) -> str:
        """Roles without a label are written after a ``?``, which no label starts with."""
        label = self.labels.get(role)
        return self.opening + (escape_role(role) if label is None else label) + self.closing

    def role(self, label: str) -> str:
        if label.startswith("?"):
            return unescape(label[1:])
        return next(r for r, name in self.labels.items() if name == label)


def escape(text: str) -> str:
    """Text in which neither ``###`` nor ``</`` occurs: a backslash comes before
    each backslash and inside each ``##`` and ``</``."""
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    if "##" in text:
        text = text.replace("##", "#\\#")
    if "</" in text:
        text = text.replace("</", "<\\/")
    return text


def escape_role(role: str) -> str:
    return "?" + escape(role).replace(":", "\\:")


_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


PARTS = ("conv_id long, part long, formatted string, loss array<struct<start:long,stop:long>>, n_turns long, last boolean, valid boolean, "
         "bad_turn long, expected string")
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
PART_SCHEMA = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(_SPAN)), ("n_turns", pa.int64()),
                         ("last", pa.bool_()), ("valid", pa.bool_()), ("bad_turn", pa.int64()), ("expected", pa.string())])


class Machine:
    """The state of the conversation being written."""

    def __init__(self, conv_id, template: Template):
        self.conv_id, self.template = conv_id, template
        self.state, self.seen, self.bad, self.expected = START, 0, None, None
        self.parts = 0
        self._fresh()

    def _fresh(self) -> None:
        self.text, self.chars, self.loss, self.turns = [], 0, [], 0

    def turn(self, role: str, text: str) -> None:
        t = self.template
        if self.bad is None and role not in (allowed := t.follows.get(self.state, ())):
            self.bad, self.expected = self.seen, " or ".join(allowed)
        self.state, self.seen, self.turns = role, self.seen + 1, self.turns + 1
        head, body = t.header(role), escape(text)
        self.text += [head, body, t.end]
        if role in t.loss:
            self.loss.append({"start": self.chars + len(head), "stop": self.chars + len(head) + len(body)})
        self.chars += len(head) + len(body) + len(t.end)

    def close(self, last: bool) -> tuple:
        """The part so far. Validity is known with the last part only."""
        if last and self.bad is None and self.state not in self.template.ends:
            self.bad, self.expected = self.seen, " or ".join(self.template.follows.get(self.state, ()))
        valid = self.bad is None if last else None
        out = (self.conv_id, self.parts, "".join(self.text), self.loss, self.turns, last, valid, self.bad if last else None, self.expected if last else None)
        self.parts += 1
        self._fresh()
        return out


def _format(template: Template, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: Machine | None = None
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), PART_SCHEMA)], schema=PART_SCHEMA)
            out.clear()
            return made

        for batch in (part for whole in batches for part in slices(whole, 4 << 20)):
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if machine is None or machine.conv_id != conv_id:
                    if machine is not None:
                        held += machine.chars
                        out.append(machine.close(True))
                    machine = Machine(conv_id, template)
                elif machine.chars >= part_chars:
                    held += machine.chars
                    out.append(machine.close(False))
                if held >= part_chars:
                    yield flush()
                    held = 0
                machine.turn(role, text)
        if machine is not None:
            out.append(machine.close(True))
            yield flush()

    return run


def format_chats(turns: DataFrame, template: Template = Template(), *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", part_chars: int = 1 << 16) -> DataFrame:
    """Conversations as formatted parts: conv_id, part (from 0), formatted, loss
    (spans of code points in formatted that carry loss), n_turns (of the part), last,
    and with the last part valid, bad_turn (number, from 0, of the first turn that
    the template does not allow; the number of turns if the conversation must not
    end there) and expected (the roles it allows there).

    Rows are taken by (turn, role, text), null turns first; rows that repeat a turn
    are turns each. Null text is empty, a null role the role of no name; rows with a
    null conv_id are one conversation. An empty table has no parts. Other columns
    are not read. Parts of a conversation follow each other in one task.
    """
    rows = turns.select(
        F.col(f"`{conv_col}`").cast("long").alias("c"), F.col(f"`{turn_col}`").cast("long").alias("n"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("r"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    dealt = rows.repartition("c").sortWithinPartitions("c", "n", "r", "t")
    return dealt.select("c", "r", "t").mapInArrow(_format(template, part_chars), PARTS)


DIGEST_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                           ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])


def turns_of(formatted: str, template: Template = Template()) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn, read from the output alone."""
    at, t = 0, template
    while at < len(formatted):
        if not formatted.startswith(t.opening, at):
            raise ValueError(f"no turn starts at {at}")
        start = at + len(t.opening)
        if formatted[start : start + 1] == "?":  # the closing mark's colon is escaped inside such a role
            colon = re.compile(r"(?:[^\\:]|\\.)*+", re.DOTALL).match(formatted, start).end()
        else:
            colon = formatted.index(t.closing, start)
        stop = formatted.index(t.end, colon)
        yield t.role(formatted[start:colon]), unescape(formatted[colon + len(t.closing) : stop])
        at = stop + len(t.end)


def _digest(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = chars = loss_chars = 0
        all_, masked = hashlib.sha256(), hashlib.sha256()
        for batch in (part for whole in batches for part in slices(whole, 16 << 20)):
            out = []
            for conv_id, formatted, loss, last, valid in zip(*(c.to_pylist() for c in batch.columns)):
                for role, text in turns_of(formatted, template):
                    n += 1
                    all_.update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"] : span["stop"]])
                    loss_chars += len(text)
                    masked.update(text.encode())
                chars += len(formatted)
                if last:
                    out.append((conv_id, n, all_.hexdigest(), loss_chars, masked.hexdigest(), chars, valid))
                    n = chars = loss_chars = 0
                    all_, masked = hashlib.sha256(), hashlib.sha256()
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), DIGEST_SCHEMA)], schema=DIGEST_SCHEMA)

    return run


def read_back(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """One row a conversation, read from the formatted parts as ``format_chats``
    returns them (each conversation's parts in order in one task): n_turns,
    turns_sha256 (role, newline, text, newline of each turn), loss_chars and
    loss_sha256 (the unescaped text under the loss mask), formatted_chars, valid."""
    types = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    return parts.select("conv_id", "formatted", "loss", "last", "valid").mapInArrow(_digest(template), types)


#: A conversation whose texts hold the escape sign, a header and an end mark.
TRIAL = (-7, r"\### Assistant: </turn> ok")


def with_trial(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) and the trial conversation: a user, then an assistant."""
    conv_id, text = TRIAL
    role = F.expr("inline(array(struct(0L as turn, 'user' as role), struct(1L as turn, 'assistant' as role)))")
    trial = turns.sparkSession.range(1).select(F.lit(conv_id).cast("long").alias("conv_id"), F.lit(text).alias("text"), role)
    columns = ["conv_id", "turn", "role", "text"]
    return turns.select(columns).union(trial.select(columns))


def oracle_sql() -> str:
    """DuckDB SQL for the trial query's result: what comes back must be the rows
    themselves; the lengths follow from the escapes, the states from a pattern."""
    conv_id, text = TRIAL
    t = Template()
    label = " ".join(f"WHEN '{role}' THEN '{name}'" for role, name in t.labels.items())
    escaped = "replace(replace(replace({x}, '\\', '\\\\'), '##', '#\\#'), '</', '<\\/')"
    other = "'?' || replace(" + escaped.format(x="role") + ", ':', '\\:')"
    marks = len(t.opening) + len(t.closing) + len(t.end)
    by = "ORDER BY turn NULLS FIRST, role, text"
    return f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT {conv_id}, 0, 'user', '{text}' UNION ALL SELECT {conv_id}, 1, 'assistant', '{text}'),
f AS (SELECT *, {marks} + length(CASE role {label} ELSE {other} END) + length({escaped.format(x='text')}) AS chars,
CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN role[1:1] ELSE '?' END AS state FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {by})) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' {by}) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars,
regexp_full_match(string_agg(state, '' {by}), 's?u(a(t+a)*u)*(a(t+a)*)?') AS valid FROM f GROUP BY conv_id"""
