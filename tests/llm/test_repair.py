import hashlib
import re
from itertools import product

import numpy as np
import pytest

from dinerlake.llm import repair

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, cost int"


def every_audit(roles, faults, inserts=2):
    """All edits of a short conversation, tried one by one."""
    found = []

    def walk(row, given, cost, audit, left):
        if row == len(roles):
            if LEGAL.fullmatch(given):
                found.append((cost, audit))
        elif left >= 0:
            more = 3 if faults[row] == repair.CUT else 0
            walk(row + 1, given, cost + 4, audit + "D", left)
            if faults[row] in (repair.SOUND, repair.CUT):
                walk(row + 1, given + roles[row], cost + more, audit + "K", left)
                for role in "ua":
                    if role != roles[row]:
                        walk(row + 1, given + role, cost + 3 + more, audit + "R", left)
        if left:
            for role in "ua":
                walk(row, given + role, cost + 3, audit + "I", left - 1)

    walk(0, "", 0, "", inserts)
    return min(found)


def by_rows(roles, faults):
    """Least (cost, audit) by a table over rows and last role."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}

    def insert(best):
        for _ in range(2):
            for state, label in list(best.items()):
                new = (label[0] + 3, label[1] + "I")
                best[follow[state]] = min(best.get(follow[state], new), new)
        return best

    best = insert({"": (0, "")})
    for role, fault in zip(roles, faults):
        new = {}

        def put(state, label):
            new[state] = min(new.get(state, label), label)

        for state, (cost, audit) in best.items():
            put(state, (cost + 4, audit + "D"))
            if fault in (repair.SOUND, repair.CUT):
                more = 3 if fault == repair.CUT else 0
                if role == follow[state] or (role == "s" and state == ""):
                    put(role, (cost + more, audit + "K"))
                put(follow[state], (cost + 3 + more, audit + "R"))
        best = insert(new)
    return min(best[s] for s in ("", "a") if s in best)


@pytest.mark.parametrize("size", range(4))
def test_against_every_audit(size):
    for roles in product("suat", repeat=size):
        for faults in product(range(4), repeat=size):
            assert repair.cheapest("".join(roles), bytes(faults)) == every_audit("".join(roles), faults, size + 1)


def test_longer_ones_against_a_table():
    rng = np.random.default_rng(3)
    for _ in range(1_500):
        size = rng.integers(4, 40)
        roles = "".join(rng.choice(list("suat"), size, p=[0.1, 0.45, 0.4, 0.05]))
        faults = bytes(rng.choice(4, size, p=[0.7, 0.1, 0.1, 0.1]).tolist())
        assert repair.cheapest(roles, faults) == by_rows(roles, faults)


def test_a_very_long_conversation():
    roles, faults = "ua" * 30_000 + "uu" + "ua" * 30_000, bytes(120_002)
    cost, audit = repair.cheapest(roles, faults)
    assert cost == 3 and len(audit) == 120_002 + audit.count("I")


def plain(rows):
    """The reports by conversation."""
    result = {}
    for conv in {r[0] for r in rows}:
        own = [(t, r or " ", " " if x is None else x) for c, t, r, x, *_ in rows if c == conv]
        key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
        own.sort(key=key)
        faults, known = [], set()
        for _, role, text in own:
            bare = text.strip(repair.SPACE)
            faults.append(
                1 if not bare else 2 if (role, text) in known else 3 if bare[-1] not in ".!?" else 0)
            known.add((role, text))
        roles = "".join(r[1][0] for r in own)
        cost, audit = by_rows(roles, faults)
        numbers = [t for t, _, _ in own if t is not None]
        state, lines, at = "", [], 0
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            role, text = ("", "") if letter == "I" else own[at][1:]
            at += letter != "I"
            state = "s" if letter == "K" and state == "" and role[0] == "s" else {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            lines.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
        result[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(faults.count(f) for f in (1, 2, 3)),
            sum(roles[i:i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def conversations():
    rng = np.random.default_rng(8)
    rows = [
        (int(c), int(t), str(rng.choice(["user", "assistant", "system", "tool", "User"], p=[.4, .4, .1, .05, .05])),
         str(rng.choice(["Yes.", "No!", "and then", "", " \t\n", "Ünd? ", "漢字。", "a\x0b.", "same."])), 1)
        for c in range(60) for t in range(rng.integers(1, 12))
    ]
    rows += [(70, None, "user", "Hm?", 1), (70, None, None, "Hm?", 1), (70, 3, "assistant", None, 1),
             (71, None, "", "Ha.", 1), (71, None, "system", "Be good.", 1), (72, 5, "user", "x" * 300_000, 1),
             (72, 9, "assistant", "y " * 400_000 + ".", 1), (None, 0, "user", "Who?", 1),
             (None, 2, "assistant", "I.", 1), (73, 1, "user", "Twice.", 1), (73, 1, "user", "Twice.", 1),
             (-4, -9, "assistant", "Minus.", 1), (-4, 9, "user", "Plus.", 1)]
    return rows


def test_reports_and_turns_against_plain_version(spark):
    rows = conversations()
    found = repair.mended(spark.createDataFrame(rows, SCHEMA))
    got = {r[0]: tuple(r)[1:] for r in repair.reports(found).collect()}
    assert got == plain(rows)
    lines = {}
    for r in sorted(repair.turns(found).collect(), key=lambda r: r.seq):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, report in got.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == report[-1]


def test_dropped_rows_and_empty_tables(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 0), (1, 1, "user", "Ho.", 1), (2, 0, "user", "A.", 1)], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in repair.reports(repair.mended(rows, F.col("cost") == 1)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[2] == (0, 0, 0, 0, 0, 0, "", empty)
    assert got[1] == plain([(1, 0, "user", "Hi.")])[1]
    assert repair.mended(rows.limit(0)).count() == 0
