"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string. Successive prefixes of a
conversation are rendered and consecutive outputs compared: what a turn adds is its span, and an output
that does not begin with the one before shows a template that rewrites history. Where a trained turn's
text lies inside its span is found by rendering the turn with two other texts: they part where the
text begins and meet again where it ends.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
Template = Callable[[Turns], str]

TURNS = (
    "array<struct<role: string, start: long, end: long, loss_start: long, loss_end: long>>"
)
SCHEMA = f"formatted string, turns {TURNS}, rewritten_at long"


def escape(text: str) -> str:
    """Control strings start with ``<|``; a text holds none after this, and ``unescape`` undoes it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def chatml(turns: Turns) -> str:
    """The default template."""
    return "".join(
        "<|im_start|>" + escape(role).replace("\n", "\\\n") + "\n" + escape(text) + "<|im_end|>\n"
        for role, text in turns
    )


TURN = re.compile(r"<\|im_start\|>((?:\\.|[^\\\n])*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def read_back(formatted: str) -> Turns:
    """The turns of a text that ``chatml`` made."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def _text_span(render: Template, turns: Turns, role: str, before: str, end: int) -> tuple[int, int]:
    """Where the text after ``turns`` begins and ends; ``before`` is their output, ``end`` the new one's."""
    one, two = render([*turns, (role, "a")]), render([*turns, (role, "b")])
    start = len(before) if one.startswith(before) and two.startswith(before) else 0
    start += len(os.path.commonprefix([one[start:], two[start:]]))
    tail = len(os.path.commonprefix([one[start:][::-1], two[start:][::-1]]))
    return start, end - tail


def format_turns(turns: Turns, render: Template, trained: str) -> tuple[str, list[dict], int | None]:
    """The output, a span per turn, and the first turn that rewrote history (then no spans)."""
    spans, before = [], render([])
    for i, (role, _) in enumerate(turns):
        now = render(turns[:i + 1])
        if not now.startswith(before):
            return render(turns), [], i
        low = high = len(now)
        if role == trained:
            low, high = _text_span(render, turns[:i], role, before, len(now))
        spans.append({"role": role, "start": len(before), "end": len(now), "loss_start": low,
                      "loss_end": high})
        before = now
    return before, spans, None


def format_conversations(rows: DataFrame, render: Template = chatml, trained: str = "assistant",
                         conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conv, n_turns, chat) with chat = SCHEMA, a row per conversation.

    Turns are in order of ``turn``, null first, ties by role and text; repeated rows are turns of
    their own. Null roles and texts are empty; a null conversation is one of its own; an empty table
    gives an empty one; other columns are not read. Spans count code points; turns that are not
    trained have an empty loss span at their end. ``rewritten_at`` is null, or the first turn whose
    output did not continue the one before; ``turns`` is empty then. A conversation is one row of the
    result, so one task holds it; nothing else meets in a task. Prefixes cost the square of a
    conversation's length, which is the price of a template that is not looked into.
    """
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    collected = rows.groupBy(F.col(f"`{conv}`").alias(conv)).agg(
        F.sort_array(F.collect_list(
            F.struct(F.col(f"`{turn}`").alias("turn"), blank(role).alias("role"),
                     blank(text).alias("text")))).alias("__turns")
    )

    @F.pandas_udf(SCHEMA)
    def formatted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([
                format_turns([(t["role"], t["text"]) for t in turns], render, trained)
                for turns in batch
            ], columns=["formatted", "turns", "rewritten_at"]).astype({"rewritten_at": "Int64"})

    return collected.select(conv, F.size("__turns").cast("long").alias("n_turns"),
                            formatted("__turns").alias("chat"))


DIGEST = "turns_sha256 string, n_read long, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: pd.Series, turns: pd.Series) -> pd.DataFrame:
    """What outputs of ``chatml`` hold, read back from them and their loss masks."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for text, spans in zip(formatted, turns, strict=True):
        read = read_back(text)
        loss = "".join(unescape(text[s["loss_start"]:s["loss_end"]]) for s in spans)
        out.append((sha("".join(f"{r}\n{t}\n" for r, t in read)), len(read), len(loss), sha(loss),
                    len(text)))
    return pd.DataFrame(out, columns=[c.split(" ")[0] for c in DIGEST.split(", ")])


def with_digest(made: DataFrame) -> DataFrame:
    """Adds ``digest``, a struct of DIGEST, to what ``format_conversations`` made with ``chatml``."""
    @F.pandas_udf(DIGEST)
    def run(formatted: pd.Series, turns: pd.Series) -> pd.DataFrame:
        return digests(formatted, turns)

    return made.withColumn("digest", run("chat.formatted", "chat.turns"))
