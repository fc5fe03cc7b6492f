"""Repaired conversations against every possible edit, and pieces against whole conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest

from slotline.llm.conversation_repair import GONE, OPEN, cheapest, damaged, edited, faulty, repaired, report, shortest

CONVERSATIONS = "conv_id long, turn long, role string, text string, kind string, copies double, initial int, of long"
PATTERN = re.compile(r"(s?(ua)+)?\Z")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def every_edit(rows):
    """Least cost and audit over all edits; rows are (initial, must go, open). An audit holds at most two
    insertions in a row, as two more bring nothing but cost."""

    @lru_cache(maxsize=None)
    def best(at, state, inserted):
        found = [(0, "")] if at == len(rows) and state in ("", "a") else []
        if inserted < 2:
            found += [(cost + 3, "I" + audit) for cost, audit in best(at, NEXT[state], inserted + 1)]
        if at < len(rows):
            initial, gone, cut = rows[at]
            found += [(cost + 4, "D" + audit) for cost, audit in best(at + 1, state, 0)]
            if not gone:
                more = 3 if cut else 0
                if initial == NEXT[state] or (initial == "s" and state == ""):
                    found += [(cost + more, "K" + audit) for cost, audit in best(at + 1, initial, 0)]
                found += [(cost + 3 + more, "R" + audit) for cost, audit in best(at + 1, NEXT[state], 0)]
        return tuple(found)

    return min(best(0, "", 0))


def test_short_conversations_against_every_edit():
    codes = {"s": 0, "u": 1, "a": 2, "t": 3}
    kinds = [(i, g, c) for i in "suat" for g, c in ((False, False), (True, False), (False, True))]
    chosen = random.Random(1)
    cases = [*product(kinds, repeat=1), *product(kinds, repeat=2), *(tuple(chosen.choices(kinds, k=chosen.randint(3, 5))) for _ in range(150)), ()]
    for rows in cases:
        code = bytes(codes[i] | (GONE if g else 0) | (OPEN if c else 0) for i, g, c in rows)
        assert cheapest(code) == every_edit(rows), rows


def test_audit_gives_legal_roles():
    chosen = random.Random(2)
    for _ in range(200):
        code = bytes(chosen.choices([0, 1, 2, 3, 5, 9, 10], k=chosen.randint(0, 60)))
        messages = [("suat"[x & 3], str(at)) for at, x in enumerate(code)]
        cost, audit = cheapest(code)
        assert PATTERN.match("".join(role[0] for role, _ in edited(messages, audit)))
        # Any way through a middle state costs as much at least.
        assert cost == min(
            a[0] + b[0] for state in range(4)
            if (a := shortest(code[: len(code) // 2], 0, (state,), trailing=False)) and (b := shortest(code[len(code) // 2 :], state, (0, 3)))
        )


def plain(rows):
    """The whole report, one conversation at a time."""
    held = {}
    for conv, turn, role, text, *_ in rows:
        here = held.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, here in held.items():
        here.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, codes, count, edits = set(), bytearray(), dict.fromkeys(("blank", "again", "cut"), 0), []
        for turn, role, text in here:
            stripped = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not stripped else "again" if (role, text) in seen else "cut" if stripped[-1] not in ".!?" else None
            seen.add((role, text))
            count[fault] = count.get(fault, 0) + 1
            codes.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3) | (GONE if fault in ("blank", "again") else OPEN if fault else 0))
            edits.append((role[:1], fault in ("blank", "again"), fault == "cut"))
        turns = [x for x, _, _ in here if x is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:]))
        cost, audit = every_edit(tuple(edits)) if len(edits) < 6 else cheapest(bytes(codes))
        messages = edited([(r, t) for _, r, t in here], audit)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()
        out[conv] = ((gaps, count["blank"], count["again"], count["cut"], illegal, cost, audit, digest), messages)
    return out


@pytest.fixture
def odd_conversations():
    chosen = random.Random(3)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None], ["a.", "b!", "c", "d? ", " \t", None, "é.", "日", "."]
    rows = [
        (conv or None, chosen.choice([None, *range(8)]), chosen.choice(roles), chosen.choice(texts))
        for conv in range(60) for _ in range(chosen.randint(1, 9) if conv % 20 else 60)
    ]
    rows += [(900, 0, "user", "x" * 200_000 + "."), (900, 1, "assistant", "y " * 100_000)]
    rows += [(901, None, "user", "same.")] * 30
    rows += [(1, 5, "user", "Same."), (1, 5, "user", "Same.")]
    return [(*row, "k", 1.0, 2, 3) for row in rows]


@pytest.mark.parametrize("piece", [512, 5, 1])
def test_report_and_messages(spark, odd_conversations, piece):
    rows = damaged(spark.createDataFrame(odd_conversations, CONVERSATIONS))
    want = plain(odd_conversations)
    assert {row[0]: tuple(row[1:]) for row in report(rows, piece).collect()} == {key: value for key, (value, _) in want.items()}
    parts = {}
    for row in repaired(rows, piece).orderBy("conv_id", "part").collect():
        parts.setdefault(row.conv_id, []).extend((x.role, x.text) for x in row.messages)
    assert parts == {key: messages for key, (_, messages) in want.items()} or all(parts.get(k, []) == m for k, (_, m) in want.items())


def test_texts_are_cut_by_bytes_too(spark, odd_conversations):
    rows = damaged(spark.createDataFrame(odd_conversations, CONVERSATIONS))
    want = {key: value for key, (value, _) in plain(odd_conversations).items()}
    assert {row[0]: tuple(row[1:]) for row in report(rows, 512, 50_000).collect()} == want


def test_dropped_conversation_and_empty_table(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(dropped, 0, "user", "Gone.", "k", 1.0, 2, 3)], CONVERSATIONS)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(x) for x in report(damaged(one)).collect()] == [(dropped, 0, 0, 0, 0, 0, 0, "", empty)]
    assert report(damaged(one.limit(0))).collect() == []


def test_undamaged_rows_can_be_repaired(spark):
    rows = spark.createDataFrame([("c", 0, "user", "Hi.", 1), ("c", 1, "user", "Again.", 1)], "conv_id string, turn long, role string, text string, copies long")
    found = report(faulty(rows)).collect()[0]
    assert (found.cost, found.audit) == (3, "KR")
