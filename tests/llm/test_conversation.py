import hashlib
import re
import time
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import conversation, queries
from riskloom.llm.conversation import decide_repairs, repair, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string, audit string, head int, m string, absent boolean"
LEGAL = re.compile(r"(s?(ua)+)?")
WS = "\x20\t\n\x0b\x0c\r"


def brute(rows):
    """(cost, audit, repaired) of rows (role, text, fault) by trying every edit of every row and every insert of up to two turns."""
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    best = None

    def step(i, cost, audit, out):
        nonlocal best
        initials = "".join(r[:1] for r, _ in out)
        # cut what can't become legal any more
        if not re.fullmatch(r"s?(ua)*u?", initials) or (best is not None and cost > best[0]):
            return
        for extra in inserts:
            c, a, o = cost + 3 * len(extra), audit + "I" * len(extra), out + [(r, "") for r in extra]
            if i == len(rows):
                if LEGAL.fullmatch("".join(r[:1] for r, _ in o)) and (best is None or (c, a) < best[:2]):
                    best = (c, a, o)
                continue
            role, text, fault = rows[i]
            step(i + 1, c + 4, a + "D", o)
            if fault < 2:
                step(i + 1, c + 3 * fault, a + "K", o + [(role, text)])
                for to in ("user", "assistant"):
                    step(i + 1, c + 3 + 3 * fault, a + "R", o + [(to, text)])

    step(0, 0, "", [])
    return best


def code(role, fault):
    return {"s": 0, "u": 3, "a": 6}.get(role[:1], 9) + fault


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool"]), st.integers(0, 2)), max_size=5))
def test_search_equals_every_edit(rows):
    want = brute([(r, "t", f) for r, f in rows])
    assert repair(bytes(code(r, f) for r, f in rows)) == want[:2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 11), max_size=14))
def test_blocks_change_nothing(codes):
    whole = repair(bytes(codes))
    old, conversation.BLOCK = conversation.BLOCK, 3
    try:
        assert repair(bytes(codes)) == whole
    finally:
        conversation.BLOCK = old


@pytest.mark.parametrize("codes", [bytes([3]) * 100_000, bytes([3, 6, 4, 8, 0, 9, 7]) * 15_000])
def test_long_conversations(codes):
    t = time.perf_counter()
    cost, audit = repair(codes)
    assert cost > 0 and len(audit) >= len(codes) and time.perf_counter() - t < 30


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, text)
        out[conv] += [(turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def expected(rows):
    result = []
    for conv, turns in damage(rows).items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.md5(x[2].encode()).hexdigest()))
        seen, counts, marked = set(), [0] * 4, []
        for _, role, text in turns:
            bare = text.strip(WS)
            fault = 3 if not bare else 2 if (role, text) in seen else 1 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, min(fault, 2)))
        known = {t for t, _, _ in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, out = brute(marked)
        result.append((conv, gaps, counts[3], counts[2], counts[1], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()))
    return sorted(result, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", None) for r in rows], SCHEMA)


ODD = [(None, None, None, None), (None, 1, "user", "Hi."), (None, None, "", ""), (1, 0, "user", None), (2, 0, "system", "Be kind."), (2, 1, "user", "Why?"),
       (2, 2, "assistant", "Because \n"), (2, 2, "assistant", "Because."), (2, 9, "tool", "x."), (3, 4, "user", "Same."), (3, 4, "user", "Same."), (3, 4, "user", "Same."),
       (4, -3, "assistant", "\t\x0b"), (4, -1, "unknown", "É?"), (5, 2, "system", "Alone.")]


def test_query_equals_brute_force(spark, tmp_path):
    rows = ODD + [(c, t, ("user", "assistant", "system")[(c * t) % 3], ("Yes.", "No", " ", "Maybe!")[(c + t) % 4]) for c in range(10, 120) for t in range(c % 6)]
    rows += [(c, 0, "user", "Hi.") for c in range(1000, 1060)]
    table(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted((tuple(r) for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()), key=str)
    assert got == expected(rows)
    assert any(r[7] == "" for r in got)        # a conversation without rows after the damage


def test_repaired_turns(spark):
    rows = table(spark, [(1, 0, "user", "Hi."), (1, 1, "user", "There"), (2, 0, "assistant", "x" * 2_000_000 + "."), (3, 0, "user", " ")])
    decisions = decide_repairs(rows)
    assert {r["conv_id"]: r["audit"] for r in decisions.collect()} == {1: brute([("user", "Hi.", 0), ("user", "There", 1)])[1], 2: "IK", 3: "D"}
    got = [(r["conv_id"], r["position"], r["edit"], r["role"], len(r["text"])) for r in repaired_turns(rows, decisions).orderBy("conv_id", "position").collect()]
    assert got[-2:] == [(2, 0, "I", "user", 0), (2, 1, "K", "assistant", 2_000_001)]
    assert all(LEGAL.fullmatch("".join(r[3][0] for r in got if r[0] == c)) for c in (1, 2, 3))


def test_empty_table(spark):
    rows = table(spark, [])
    assert decide_repairs(rows).collect() == [] and repaired_turns(rows, decide_repairs(rows)).collect() == []
