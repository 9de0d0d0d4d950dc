"""Repair of conversations against all edits tried, and the odd cases."""

import hashlib
import random
import re
import zlib

import pytest

from gridtally.llm import repair

ORDER = re.compile(r"(s?(ua)+)?\Z")
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def every(rows, most=4):
    """The least (cost, audit) of all edits with at most so many insertions."""
    best = None

    def go(i, cost, audit, out, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and ORDER.match(out) and (best is None or (cost, audit) < best):
            best = cost, audit
        if inserted < most:
            for turn in "ua":
                go(i, cost + 2, audit + "I", out + turn, inserted + 1)
        if i < len(rows):
            initial, fault = rows[i]
            extra = int(fault == "truncated")
            go(i + 1, cost + 3, audit + "D", out, inserted)
            if fault not in ("blank", "duplicate"):
                if initial:
                    go(i + 1, cost + extra, audit + "K", out + initial, inserted)
                for turn in "ua":
                    go(i + 1, cost + 2 + extra, audit + "R", out + turn, inserted)

    go(0, 0, "", "", 0)
    return best


def rounds(rows):
    """The same, row by row over the states, for longer conversations."""
    def inserted(states):
        while True:
            new = dict(states)
            for at, (cost, audit) in states.items():
                for turn in "ua":
                    to = STEPS.get((at, turn))
                    if to is not None and (to not in new or (cost + 2, audit + "I") < new[to]):
                        new[to] = cost + 2, audit + "I"
            if new == states:
                return new
            states = new

    states = inserted({"": (0, "")})
    for initial, fault in rows:
        new = {}
        for at, (cost, audit) in states.items():
            moves = [(at, 3, "D")]
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                moves.append((STEPS.get((at, initial)), extra, "K"))
                moves += [(STEPS.get((at, turn)), 2 + extra, "R") for turn in "ua"]
            for to, more, edit in moves:
                if to is not None and (to not in new or (cost + more, audit + edit) < new[to]):
                    new[to] = cost + more, audit + edit
        states = inserted(new)
    return min(v for at, v in states.items() if at in ("", "a"))


def rows_of(rng, most):
    faults = [None, None, None, "blank", "duplicate", "truncated"]
    return [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.choice(faults)) for _ in range(rng.randrange(most))]


def test_lightest_is_the_least_of_all_edits():
    rng = random.Random(3)
    for _ in range(300):
        rows = rows_of(rng, 5)
        assert repair.lightest(rows) == every(rows) == rounds(rows)


def test_lightest_in_longer_conversations():
    rng = random.Random(4)
    for rows in [rows_of(rng, 40) for _ in range(800)] + [rows_of(rng, 3000) for _ in range(3)]:
        assert repair.lightest(rows) == rounds(rows)


def test_audits_compare_as_texts():
    rng = random.Random(5)
    root = repair.Audit()
    made = []
    for _ in range(300):
        at = root
        for c in "".join(rng.choice("DIKR") for _ in range(rng.randrange(9))):
            at = at.then(c)
        made.append(at)
    for a in made:
        for b in made:
            assert (a < b) == (a.text() < b.text()) and (a is b) == (a.text() == b.text())


def by_hand(rows):
    """The columns of one conversation, rows in order as (turn, role, text), by the plain rules."""
    space = " \t\n\x0b\x0c\r"
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faults = []
    for i, (_, role, text) in enumerate(rows):
        bare = text.strip(space)
        faults.append(
            "blank" if not bare else
            "duplicate" if any(r[1:] == (role, text) for r in rows[:i]) else
            "truncated" if bare[-1] not in ".!?" else None)
    cost, audit = rounds([(role[:1], f) for (_, role, _), f in zip(rows, faults, strict=True)])
    out, state, left = [], "", list(rows)
    for edit in audit:
        row = left.pop(0) if edit != "I" else (None, "", "")
        if edit == "D":
            continue
        state = row[1][0] if edit == "K" else "a" if state == "u" else "u"
        role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[state]
        out.append(f"{role}:{row[2]}")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def damaged(rows):
    """Given rows (conv, turn, role, text) as {conv: rows after damage}."""
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " "))
    for conv, turn, role, text in order:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        after = [(turn, "user" if hit == 4 else role,
                  "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text)]
        out.setdefault(conv, []).extend(after * {0: 0, 3: 2}.get(hit, 1))
    return out


def check(got, given):
    want = damaged(given)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == by_hand(want[r.conv_id])


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_is_brute_force(spark, sf):
    from gridtally.llm.queries import REGISTRY
    given = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    got = REGISTRY["op13_lightest_repair"](spark, sf).collect()
    check(got, given)
    assert len({r.audit for r in got}) > 10


def test_query_on_odd_rows(spark, tmp_path):
    from gridtally.llm.queries import REGISTRY
    rng = random.Random(8)
    # Distinct turns, so that damage cannot change their order.
    given = [(rng.choice([None, 1, 2, 3, 4]), t, rng.choice([None, "", "user", "assistant", "system", "tool", "User"]),
              rng.choice([None, "", " \n", "Yes.", "no", "x! ", "End?\x1f", "long " * 500]))
             for t in [None, -3, *range(60)]]
    given += [(9, 1, "user", "Same."), (9, 1, "user", "Same."), (7, 5, "user", "a.")]
    table = [(*r, 1, "x") for r in given]
    schema = "conv_id long, turn long, role string, text string, id long, there string"
    spark.createDataFrame(table, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    check(REGISTRY["op13_lightest_repair"](spark, str(tmp_path)).collect(), given)


def test_without_rows(spark):
    rows = spark.createDataFrame([("c", 1, "user", "Hi.", False), ("c", 2, "user", "Hi.", None)],
                                 "conv_id string, turn int, role string, text string, present boolean")
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.repair_conversations(rows, present="present").collect()] == [
        ("c", 0, 0, 0, 0, 0, 0, "", empty)]
    assert repair.repair_conversations(rows.limit(0)).collect() == []
    kept = repair.repair_conversations(rows).collect()
    assert [r.audit for r in kept] == ["KID"] or kept[0].cost == 5
