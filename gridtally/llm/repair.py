"""Conversation structure repair: Knuth's lightest derivation over a hypergraph of repair items.

The rows of a conversation are to become an optional system turn and pairs of user and assistant turns.
Items say what one row may become, which turn may be inserted, and which state of that order the first
rows can reach; a deduction joins two of them, adds their costs and appends their audits. The agenda pops
the lightest item, by cost, then audit, until the goal is popped. Both grow with every deduction, and
appending the same edit to two audits of one item keeps their order: with equal costs neither can be the
beginning of the other, for what follows would be insertions, which cost.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
ROLES = {"s": "system", "u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Costs of edits; a truncated row that stays costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What follows a turn: nothing yet, a system, a user, an assistant turn. The first and last may end it.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
FINAL = (START, ASSISTANT)

FAULTS = ("blank", "duplicate", "truncated")
SCHEMA = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class Audit:
    """Edits in order, shared by all items that begin with them; compared by jumps to ancestors.

    Audits with the same edits are the same object, made by ``then`` from one root.
    """

    __slots__ = ("edit", "back", "depth", "jump", "onward")

    def __init__(self, edit: str = "", back: Audit | None = None):
        self.edit, self.back, self.onward = edit, back, {}
        self.depth = back.depth + 1 if back else 0
        if back is None:
            self.jump = self
        elif back.depth - back.jump.depth == back.jump.depth - back.jump.jump.depth:
            self.jump = back.jump.jump
        else:
            self.jump = back

    def then(self, edit: str) -> Audit:
        if edit not in self.onward:
            self.onward[edit] = Audit(edit, self)
        return self.onward[edit]

    def upto(self, depth: int) -> Audit:
        at = self
        while at.depth > depth:
            at = at.jump if at.jump.depth >= depth else at.back
        return at

    def __lt__(self, other: Audit) -> bool:
        depth = min(self.depth, other.depth)
        a, b = self.upto(depth), other.upto(depth)
        if a is b:
            return self.depth < other.depth
        while a.back is not b.back:
            a, b = (a.back, b.back) if a.jump is b.jump else (a.jump, b.jump)
        return a.edit < b.edit

    def text(self) -> str:
        edits, at = [], self
        while at.back:
            edits.append(at.edit)
            at = at.back
        return "".join(reversed(edits))


def lightest(rows: list[tuple[str, str | None]]) -> tuple[int, str]:
    """The cost and audit of the lightest repair of rows (initial of the role, first fault)."""
    root = Audit()
    agenda: list[tuple] = []
    done: dict[tuple, tuple[int, Audit | str]] = {}

    def propose(cost: int, audit: Audit, item: tuple) -> None:
        if item not in done:
            heapq.heappush(agenda, (cost, audit, item))

    # Axioms: the empty beginning, the turns that may be inserted, what a row may become.
    propose(0, root, ("prefix", 0, START))
    for turn in "ua":
        propose(INSERT, root.then("I"), ("insert", -1, turn))
    for k, (initial, fault) in enumerate(rows):
        propose(DELETE, root.then("D"), ("row", k, ""))
        if fault in ("blank", "duplicate"):
            continue
        extra = TRUNCATED if fault else 0
        if initial in ROLES:
            propose(extra, root.then("K"), ("row", k, initial))
        for turn in "ua":
            if turn != initial:
                propose(REROLE + extra, root.then("R"), ("row", k, turn))

    def join(prefix: tuple, edit: tuple) -> None:
        """One deduction: a state of the first rows, and an edit that follows it."""
        _, k, state = prefix
        kind, _, turn = edit
        state = NEXT.get((state, turn)) if turn else state
        if state is not None:
            cost, audit = done[prefix]
            more, last = done[edit]
            propose(cost + more, audit.then(last.edit), ("prefix", k + (kind == "row"), state))

    inserts: list[tuple] = []
    edits: dict[int, list[tuple]] = {}
    prefixes: dict[int, list[tuple]] = {}
    while True:
        cost, audit, item = heapq.heappop(agenda)
        if item in done:
            continue
        done[item] = cost, audit
        kind, k, state = item
        if kind == "goal":
            return cost, audit.text()
        if kind == "prefix":
            prefixes.setdefault(k, []).append(item)
            for edit in (*edits.get(k, ()), *inserts):
                join(item, edit)
            if k == len(rows) and state in FINAL:
                propose(cost, audit, ("goal", k, state))
        elif kind == "row":
            edits.setdefault(k, []).append(item)
            for prefix in prefixes.get(k, ()):
                join(prefix, item)
        else:
            inserts.append(item)
            for prefix in [p for each in prefixes.values() for p in each]:
                join(prefix, item)


def apply(rows: list[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The repaired turns; the audit decides every role, for turns follow each other in one way."""
    given, state = iter(rows), START
    for edit in audit:
        role, text = next(given) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit == "K":
            turn = role[:1]
        else:
            turn = "a" if state == USER else "u"
            role = ROLES[turn]
        state = NEXT[state, turn]
        yield role, text


def faults(rows: list[tuple[str, str]]) -> list[str | None]:
    """The first fault of each row: blank, a copy of an earlier row, or without an end."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        fault = None
        if not bare:
            fault = "blank"
        elif key in seen:
            fault = "duplicate"
        elif not bare.endswith(ENDS):
            fault = "truncated"
        seen.add(key)
        out.append(fault)
    return out


def repair(turns: list[int | None], rows: list[tuple[str, str]]) -> tuple:
    """The values of SCHEMA for one conversation in order."""
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    first = faults(rows)
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    cost, audit = lightest(list(zip(initials, first, strict=True)))
    digest, between = hashlib.sha256(), ""
    for role, text in apply(rows, audit):
        digest.update(f"{between}{role}:{text}".encode())
        between = "\n"
    return gaps, *[first.count(f) for f in FAULTS], illegal, cost, audit, digest.hexdigest()


def repair_conversations(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", present: str | None = None,
) -> DataFrame:
    """One row per conversation: its id and the columns of SCHEMA.

    Rows go by turn, null first, then role and text. A null role or text is one space. Only a role's
    first character decides its place; a role without one, or with another than s, u and a, cannot be
    kept. Every null id belongs to one conversation of that id. Where the boolean column ``present`` is
    given and not true, the row only says that its conversation exists; one without other rows gets
    zeros, an empty audit and the hash of nothing. Repeated rows are faults like any others; an empty
    table gives an empty one; other columns play no part.

    Rows are sorted by conversation and stream through their task; a conversation, whose repaired text
    has one hash and is read in order, is held by one task, and its agenda needs about 4 items a row.
    """
    there = F.coalesce(F.col(f"`{present}`"), F.lit(False)) if present else F.lit(True)
    chosen = rows.select(
        F.col(f"`{conversation}`").alias("id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"), there.alias("there"),
    )
    kind = rows.schema[conversation].dataType.simpleString()

    def repaired(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", *[c.split(" ")[0] for c in SCHEMA.split(", ")]]
        now, turns, held, out = None, [], [], []

        def frame():
            made = pd.DataFrame(out, columns=names)
            made["id"] = made["id"].astype(object)
            return made

        for part in parts:
            for r in part.itertuples(index=False):
                key = (pd.isna(r.id), None if pd.isna(r.id) else r.id)
                if now is not None and key != now:
                    out.append((now[1], *repair(turns, held)))
                    turns, held = [], []
                now = key
                if r.there:
                    turns.append(None if pd.isna(r.turn) else int(r.turn))
                    held.append((r.role, r.text))
            if len(out) >= 1000:
                yield frame()
                out.clear()
        if now is not None:
            out.append((now[1], *repair(turns, held)))
        yield frame()

    sort = [F.col("id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return (
        chosen.repartition("id").sortWithinPartitions(*sort)
        .mapInPandas(repaired, f"id {kind}, {SCHEMA}")
        .withColumnRenamed("id", conversation)
    )
