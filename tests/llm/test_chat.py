from __future__ import annotations

import itertools
import random

from millrace.llm import chat
from millrace.llm.chat import ASSISTANT, COSTS, ROLES, SYSTEM, UNKNOWN, USER, format_chats, repair

SCHEMA = "conv_id long, turn long, role string, text string, row int, part string"


def legal(roles):
    rest = roles[1:] if roles[:1] == [SYSTEM] else roles
    return len(rest) > 0 and len(rest) % 2 == 0 and all(r == (USER, ASSISTANT)[i % 2] for i, r in enumerate(rest))


def cheapest(roles):
    best = [10**9]

    def go(at, done, cost):
        if cost >= best[0]:
            return
        for k in range(3):
            for empty in itertools.product((USER, ASSISTANT), repeat=k):
                grown, paid = done + list(empty), cost + COSTS["insert"] * k
                if at == len(roles):
                    if legal(grown):
                        best[0] = min(best[0], paid)
                elif k < 2:
                    for role in range(3):
                        new = 0 if role == roles[at] else COSTS["name"] if roles[at] == UNKNOWN else COSTS["relabel"]
                        go(at + 1, [*grown, role], paid + new)
        if at < len(roles) and done:
            same = COSTS["merge"] if roles[at] == done[-1] else COSTS["name"] if roles[at] == UNKNOWN else COSTS["merge_other"]
            go(at + 1, done, cost + same)
    go(0, [], 0)
    return best[0]


def test_cheapest_repair():
    draw = random.Random(1)
    cases = [[r] for r in range(4)] + [[draw.randrange(4) for _ in range(draw.randint(2, 5))] for _ in range(80)]
    for roles in cases:
        cost, found, ending = repair(roles)
        done = []
        for action, role, empty in found:
            done += list(empty) + ([] if action == "merge" else [role])
        assert legal(done + list(ending)), roles
        assert cost == cheapest(roles), roles


def test_rendering(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
        (2, 0, " USER ", "a"), (2, 1, "user", "b"), (2, 2, "assistant", None),
        (3, 0, "user", "only"),
        (None, 5, "tool", "x"), (None, None, None, "y"),
        (4, 1, "assistant", "r"), (4, 1, "assistant", "r"),
    ]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA)
    found = format_chats(df).collect()
    text = lambda c: "".join(r.rendered for r in sorted((r for r in found if r.conv_id == c), key=lambda r: (r.position, r.part)))
    assert text(1) == "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n"
    assert text(2) == "<|user|>\na\nb<|end|>\n<|assistant|>\n<|end|>\n"
    assert text(3) == "<|user|>\nonly<|end|>\n<|assistant|>\n<|end|>\n"
    assert text(None) == "<|user|>\nx<|end|>\n<|assistant|>\ny<|end|>\n"
    assert text(4) == "<|user|>\nr<|end|>\n<|assistant|>\nr<|end|>\n"  # as cheap as a merge behind an empty turn
    assert sum(r.action != "insert" for r in found) == len(rows)
    assert format_chats(df.limit(0)).collect() == []


def test_many_conversations_are_legal(spark):
    draw = random.Random(2)
    rows = [(c, t, draw.choice([*ROLES, "other", None]), f"t{t}") for c in range(60) for t in range(draw.randint(1, 30))]
    found = format_chats(spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)).collect()
    for conv in range(60):
        own = sorted((r.position, r.part, r.role) for r in found if r.conv_id == conv)
        assert legal([ROLES.index(role) for _, part, role in own if part == 0])
        assert sorted(r.source_turn for r in found if r.conv_id == conv and r.action != "insert") == sorted(t for c, t, _, _ in rows if c == conv)


def expected(roles):
    """Position, part, role, action, last and turn (None: inserted) of the repair of a whole conversation."""
    _, found, ending = repair(roles)
    out, position, part = [], -1, 0
    for at, (action, role, bridge) in enumerate(found):
        for empty in bridge:
            position += 1
            out.append((position, 0, ROLES[empty], "insert", None))
        position, part = (position, part + 1) if action == "merge" else (position + 1, 0)
        out.append((position, part, ROLES[role], action, at))
    return out + [(position + 1 + k, 0, ROLES[empty], "insert", None) for k, empty in enumerate(ending)]


def test_a_conversation_in_many_blocks_is_repaired_as_one(spark):
    draw = random.Random(3)
    said = {None: 20_000, 1: 1, 2: 9_999, 3: 10_000, 4: 10_001, 5: 3, 6: 25_000}
    roles = {c: [draw.choice([0, 1, 1, 1, 2, 2, 3]) for _ in range(n)] for c, n in said.items()}
    rows = [(c, t, [*ROLES, None][r], f"t{t}", 0, "") for c, own in roles.items() for t, r in enumerate(own)]
    draw.shuffle(rows)
    turns = spark.createDataFrame(rows, SCHEMA)
    blocks = []
    cut = chat._cut
    chat._cut = lambda ordered: blocks.append(cut(ordered)) or blocks[-1]
    try:
        found = format_chats(turns).collect()
    finally:
        chat._cut = cut
    assert max(len(r.roles) for r in blocks[0].collect()) <= chat.BLOCK
    for conv, own in roles.items():
        have = sorted((r.position, r.part, r.role, r.action, r.source_turn) for r in found if r.conv_id == conv)
        assert have == expected(own)
        ends = {(p, k) for p, k, *_ in have} - {(p, k - 1) for p, k, *_ in have if k}
        assert all(r.rendered.endswith("<|end|>\n") == ((r.position, r.part) in ends) for r in found if r.conv_id == conv)
