"""Operator 9: chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. It is only called, never
inspected: rendering successive prefixes of a conversation and comparing consecutive outputs shows each
turn's span, and rendering a prefix whose last text is a marker shows where the text lies in the span. A
prefix whose output does not continue the one before means that the template rewrites history; such
conversations are reported (rewrites_history) and get no spans.

Long conversations: outputs are compared over windows of ``window`` turns that overlap by one turn; if the
overlapping turn renders differently as a window's first turn than as the last of the window before,
the template looks further back, and the whole prefixes are rendered instead.

Rows are partitioned by conversation and sorted by turn; a task streams over them and holds one
conversation at a time, as its formatted text is one row.

Defined results: null text or role is empty; a null conv_id is a conversation of its own; turns of one number
are ordered by role and text, null turns first; repeated rows are turns each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

#: Stands for a text while its place is looked up; a private-use character, see ``locate``.
MARK = "\ue0ff"
WINDOW = 32
SCHEMA = ("conv_id long, n_turns long, formatted string, spans array<struct<start:long,stop:long,text_start:long,"
          "text_stop:long,role:string,loss:boolean>>, rewrites_history boolean")


def escape(text: str) -> str:
    """Breaks up control strings: all of them begin with < or [, behind which a backslash is put."""
    return text.replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


def inst_template(turns: Turns) -> str:
    """Each turn as <s>[ROLE]role[/ROLE]text</s>, role and text escaped."""
    return "".join(f"<s>[ROLE]{escape(role)}[/ROLE]{escape(text)}</s>" for role, text in turns)


_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.S)


def read_back(formatted: str) -> Turns:
    """The turns of an ``inst_template`` output."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _spans(template: Template, turns: Turns, known: int = 0) -> list[tuple[int, int, int, int]] | None:
    """(start, stop, text start, text stop) of the turns from number ``known`` on; None if history changes."""
    out, before = [], template(turns[:known]) if known else template([])
    for i in range(known, len(turns)):
        now = template(turns[:i + 1])
        if not now.startswith(before):
            return None
        role, text = turns[i]
        marked = template([*turns[:i], (role, MARK)])
        at = marked.find(MARK, len(before)) if marked.startswith(before) else -1
        if at < 0:
            return None
        length = len(now) - (len(marked) - len(MARK))
        if length < 0 or now[:at] != marked[:at] or now[at + length:] != marked[at + len(MARK):]:
            return None
        out.append((len(before), len(now), at, at + length))
        before = now
    return out


def locate(template: Template, turns: Turns, window: int = WINDOW) -> list[tuple[int, int, int, int]] | None:
    """Spans of all turns in ``template(turns)``; None if the template rewrites history."""
    if any(MARK in text for _, text in turns):  # then the mark is no safe mark: a longer one is
        raise ValueError("a text holds the private-use character U+E0FF")
    whole = template(turns)
    if len(turns) > window:
        out = _spans(template, turns[:window])
        while out is not None and len(out) < len(turns):
            a = len(out) - 1
            more = _spans(template, turns[a:a + window])
            shift = out[a][0] - more[0][0] if more else 0
            if not more or tuple(x + shift for x in more[0]) != out[a]:
                out = None
            elif template(turns[a:a + window])[more[0][0]:more[-1][1]] != whole[out[a][0]:more[-1][1] + shift]:
                out = None  # the whole conversation has this stretch otherwise
            else:
                out += [tuple(x + shift for x in s) for s in more[1:]]
        if out and out[-1][1] == len(whole) and template(turns[:window]) == whole[:out[window - 1][1]]:
            return out
    return _spans(template, turns)


def format_conversations(conversations: DataFrame, template: Template = inst_template,
                         loss_roles: tuple[str, ...] = ("assistant",), window: int = WINDOW) -> DataFrame:
    """A row per conversation: conv_id, n_turns, formatted, spans (code points, with the loss mask), rewrites_history."""
    def one(conv_id: int | None, turns: Turns) -> dict:
        texts = [(r, t.replace(MARK, "\ufffd")) for r, t in turns] if any(MARK in t for _, t in turns) else turns
        spans = locate(template, texts, window)
        return {"conv_id": conv_id, "n_turns": len(turns), "formatted": template(turns), "spans": [
            {"start": a, "stop": b, "text_start": c, "text_stop": d, "role": role, "loss": role in loss_roles}
            for (a, b, c, d), (role, _) in zip(spans or [], turns)], "rewrites_history": spans is None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
            ("spans", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "stop", "text_start", "text_stop")]
                                         + [("role", pa.string()), ("loss", pa.bool_())]))),
            ("rewrites_history", pa.bool_())])
        key, turns, ready, size = None, [], [], 0
        for batch in batches:
            for c, r, t in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if turns and c != key:
                    ready.append(one(key, turns))
                    size += len(ready[-1]["formatted"])
                    turns = []
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_pylist(ready, schema)
                        ready, size = [], 0
                key = c
                turns.append((r, t))
        if turns:
            ready.append(one(key, turns))
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long"), "turn", empty("role"), empty("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, SCHEMA)


def digest(formatted: DataFrame, reader: Callable[[str], Turns] = read_back) -> DataFrame:
    """Read back from the output: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites_history
    (the template did: there are no spans, and no loss mask)."""
    def one(conv_id: int | None, text: str, spans: list[dict], rewrites: bool) -> dict:
        turns = reader(text)
        loss = "".join(unescape(text[s["text_start"]:s["text_stop"]]) for s in spans if s["loss"])
        every = "".join(f"{role}\n{said}\n" for role, said in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        return {"conv_id": conv_id, "n_turns": len(turns), "turns_sha256": sha(every), "loss_chars": len(loss),
                "loss_sha256": sha(loss), "formatted_chars": len(text), "rewrites_history": rewrites}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                            ("rewrites_history", pa.bool_())])
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "spans", "rewrites_history")))
            yield pa.RecordBatch.from_pylist([one(*r) for r in rows], schema)

    return formatted.select("conv_id", "formatted", "spans", "rewrites_history").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "rewrites_history boolean")


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, 20 + length(replace(replace(role, '<', '<\'), '[', '[\'))
                + length(replace(replace(text, '<', '<\'), '[', '[\')) AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars, false AS rewrites_history
FROM e GROUP BY conv_id
"""
