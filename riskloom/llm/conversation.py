"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles.

Legal role initials are ``(s?(ua)+)?``. Edits of a row: Keep (0), Rerole to user or assistant (3), Delete (4); an empty user or assistant
turn may be Inserted anywhere (3). A blank row or a repeat of an earlier (role, text) must be deleted, a truncated row that stays adds 3.
Among the cheapest edits the one whose initials in order (the audit) are ASCII-least is taken.

The search is depth-first branch and bound: an explicit stack of prefixes, ordered by cost plus a lower bound of the suffix (from the role that the prefix ends
in), then by initial; the incumbent is the best (cost, audit) that reached the end; a table per (row, last role) holds the best prefix seen there and eliminates
worse ones, cost first, then audit. It ends when the stack is empty, that is when every other prefix is proved worse. Bounds are
computed backwards in blocks of ``BLOCK`` rows, of which only the ends are kept, and each block is searched from the state that the last one ended in, so that a conversation of any
length needs a byte a row, its audit, and the tables of one block.

Spark sorts rows by conversation; a first pass reads narrow rows (no text), a second one streams the rows past their conversation's
audit. A conversation is one task's stream, since its audit is one value and a SHA-256 of it has to be read in order; texts are not gathered.

Defined results: nulls in role and text are one space; a null conversation id is a conversation, a null turn comes first and is left out of ``gaps``; rows
of one turn are ordered by role, then by the MD5 of their text; other roles than system, user and assistant go by their first
character; empty conversations and empty tables give no edits and no rows. Only the four named columns are read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map
from .line_dedup import SPACE

KEEP, REROLE, DELETE, INSERT, STAYS = 0, 3, 4, 3, 3
BLOCK = 4096
#: states: last role of a prefix
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)              # the only role that may be put after each state, by rerole or insert
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: row codes: role initial (s, u, a, other) * 3 + (sound, truncated, blank or duplicate)
INITIALS = "sua"
ENDS = (0, 2 * INSERT, INSERT, 0)                  # least cost from each state when no row is left


def _edits(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(initial, cost, next state) of the edits that a row allows after ``state``."""
    initial, fault = divmod(code, 3)
    out = [("D", DELETE, state)]
    if fault < 2:
        extra = STAYS if fault else 0
        follows = {0: state == EMPTY, 1: AFTER[state] == USER, 2: state == USER}
        if follows.get(initial):
            out.append(("K", KEEP + extra, initial + 1))
        out.append(("R", REROLE + extra, AFTER[state]))
    return tuple(out)


EDITS = tuple(tuple(_edits(code, state) for state in range(4)) for code in range(12))


def _bounds(codes: bytes, ends: tuple[int, ...]) -> list[tuple[int, ...]]:
    """For each row and state, the least cost of the rows from there, given that after the last row."""
    rows = [ends]
    for code in reversed(codes):
        below = rows[-1]
        direct = [min(cost + below[to] for _, cost, to in EDITS[code][s]) for s in range(4)]
        one = [min(direct[s], INSERT + direct[AFTER[s]]) for s in range(4)]
        rows.append(tuple(min(one[s], INSERT + one[AFTER[s]]) for s in range(4)))
    return rows[::-1]


def _before(a: tuple, b: tuple) -> bool:
    """Prefix ``a`` (cost, depth, initial, parent) is better than ``b``: cheaper, or equal in cost with the ASCII-lesser audit."""
    if a[0] != b[0]:
        return a[0] < b[0]
    shorter = a[1] < b[1]
    while a[1] > b[1]:
        a = a[3]
    while b[1] > a[1]:
        b = b[3]
    if a is b:
        return shorter
    while a[3] is not b[3]:
        a, b = a[3], b[3]
    return a[2] < b[2]


def _search(codes: bytes, state: int, bounds: list[tuple[int, ...]], last: bool) -> tuple[int, str, int]:
    """(cost, audit, end state) of the best edits of one block from ``state``; turns are inserted after its last row only if it is the ``last`` block."""
    n, tables = len(codes), {}
    stack = [((0, 0, "", None), 0, state)]
    incumbent = None        # (cost to the end of the conversation, prefix, state)
    while stack:
        node, i, state = stack.pop()
        bound = node[0] + bounds[i][state]
        if incumbent is not None and bound > incumbent[0]:
            continue
        seen = tables.get((i, state))
        if seen is not None and not _before(node, seen):
            continue
        tables[i, state] = node
        if i == n and (not last or state in (EMPTY, ASSISTANT)):
            if incumbent is None or bound < incumbent[0] or _before((0, *node[1:]), (0, *incumbent[1][1:])):
                incumbent = (bound, node, state)
            if not last:
                continue
        options = [("I", node[0] + INSERT, i, AFTER[state])]
        if i < n:
            options += [(letter, node[0] + cost, i + 1, to) for letter, cost, to in EDITS[codes[i]][state]]
        options.sort(key=lambda o: (o[1] + bounds[o[2]][o[3]], o[0]), reverse=True)
        stack += [((cost, node[1] + 1, letter, node), at, to) for letter, cost, at, to in options]
    _, best, state = incumbent
    audit, node = [], best
    while node[3] is not None:
        audit.append(node[2])
        node = node[3]
    return best[0], "".join(reversed(audit)), state


def repair(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the best edits of a conversation given by its row codes."""
    starts = range(0, max(len(codes), 1), BLOCK)
    ends = [ENDS]
    for at in reversed(starts[1:]):
        ends.append(_bounds(codes[at: at + BLOCK], ends[-1])[0])
    cost, audit, state = 0, [], EMPTY
    for at, end in zip(starts, reversed(ends)):
        part = codes[at: at + BLOCK]
        paid, edits, state = _search(part, state, _bounds(part, end), at == starts[-1])
        cost += paid
        audit.append(edits)
    return cost, "".join(audit)


@lru_cache(maxsize=1 << 14)
def _repair_short(codes: bytes) -> tuple[int, str]:
    return repair(codes)


def with_faults(rows: DataFrame, absent: str | None = None) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``m`` (MD5 of the text), ``initial`` and ``fault`` (0 none, 1 truncated, 2 duplicate, 3 blank).

    ``absent`` names a boolean column of rows that only stand for their conversation. Rows are dealt by conversation here, and stay so.
    """
    gone = F.lit(False) if absent is None else F.col(absent)
    named = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("absent"))
    bare = F.btrim(F.col("text"), F.lit(SPACE))
    named = named.select("conv_id", "turn", "role", "absent", F.md5("text").alias("m"), F.left("role", F.lit(1)).alias("initial"),
                         (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    again = F.row_number().over(Window.partitionBy("conv_id", "absent", "role", "m").orderBy("turn"))
    marked = named.repartition("conv_id").withColumn("again", again)
    fault = F.when(F.col("blank"), 3).when(F.col("again") > 1, 2).when(F.col("cut"), 1).otherwise(0)
    return marked.select("conv_id", "turn", "role", "m", "initial", "absent", "again", fault.alias("fault"))


DECISION = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place to one decision per conversation."""
    open_: dict | None = None
    out: list[tuple] = []
    names = [f.split()[0] for f in DECISION.split(", ")]

    def close(c: dict) -> tuple:
        codes = bytes(c["codes"])
        cost, audit = _repair_short(codes) if len(codes) <= 64 else repair(codes)
        gaps = c["max"] - c["min"] + 1 - c["turns"] if c["turns"] else 0
        return (c["conv"], gaps, c["faults"][3], c["faults"][2], c["faults"][1], c["illegal"], cost, audit)

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k == "audit" else pa.int64()) for k, v in zip(names, cols)], names=names)

    for b in batches:
        for conv, turn, initial, absent, fault in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "initial", "absent", "fault"))):
            if open_ is None or conv != open_["conv"]:
                if open_ is not None:
                    out.append(close(open_))
                    if len(out) >= 4096:
                        yield flush()
                open_ = {"conv": conv, "codes": bytearray(), "min": 0, "max": None, "turns": 0, "faults": [0] * 4, "illegal": 0, "role": None}
            if absent:
                continue
            role = INITIALS.find(initial) if initial else -1
            role = role if role >= 0 else 3
            if open_["role"] is not None and (open_["role"], role) not in ((0, 1), (1, 2), (2, 1)):
                open_["illegal"] += 1
            open_["role"] = role
            open_["faults"][fault] += 1
            open_["codes"].append(role * 3 + min(fault, 2))
            if turn is not None and turn != open_["max"]:
                open_["min"] = turn if not open_["turns"] else open_["min"]
                open_["max"], open_["turns"] = turn, open_["turns"] + 1
    if open_ is not None:
        out.append(close(open_))
    if out:
        yield flush()


def decide_repairs(rows: DataFrame, absent: str | None = None) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)."""
    order = ["conv_id", "turn", "role", "m", "again"]
    return arrow_map(with_faults(rows, absent).sortWithinPartitions(*order).select(*order, "initial", "absent", "fault"), _decide, DECISION)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each conversation's decision (a dict, None, None, None), then its repaired turns (None, edit, role, text) in order."""
    audit, at, state, deciding = "", 0, EMPTY, False
    for b in batches:
        cols = {k: b.column(k).to_pylist() for k in ("head", "role", "text", "audit")}
        for k in range(b.num_rows):
            if cols["head"][k]:
                while deciding and at < len(audit):         # turns inserted after the last row
                    state = AFTER[state]
                    yield None, "I", ROLES[state], ""
                    at += 1
                yield {n: b.column(n)[k].as_py() for n in b.schema.names}, None, None, None
                audit, at, state, deciding = cols["audit"][k], 0, EMPTY, True
                continue
            while audit[at] == "I":
                state = AFTER[state]
                yield None, "I", ROLES[state], ""
                at += 1
            edit, role = audit[at], cols["role"][k]
            at += 1
            if edit == "K":
                state = INITIALS.find(role[0]) + 1
                yield None, edit, role, cols["text"][k]
            elif edit == "R":
                state = AFTER[state]
                yield None, edit, ROLES[state], cols["text"][k]
    while deciding and at < len(audit):
        state = AFTER[state]
        yield None, "I", ROLES[state], ""
        at += 1


TURNS = "conv_id long, position long, edit string, role string, text string"
DIGEST = DECISION + ", repaired_sha256 string"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size, conv, n = [], 0, None, 0
    for head, edit, role, text in _repaired(batches):
        if head is not None:
            conv, n = head["conv_id"], 0
            continue
        out.append((conv, n, edit, role, text))
        n, size = n + 1, size + len(text) + 64
        if size > 1 << 20:
            yield _batch(out, TURNS)
            out, size = [], 0
    if out:
        yield _batch(out, TURNS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if t == "long" else pa.string()) for (_, t), c in zip(fields, zip(*rows))], names=[n for n, _ in fields])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in DECISION.split(", ")]
    out, head, sha, first = [], None, None, True
    for found, _, role, text in _repaired(batches):
        if found is not None:
            if head is not None:
                out.append((*(head[n] for n in names), sha.hexdigest()))
                if len(out) >= 4096:
                    yield _batch(out, DIGEST)
                    out = []
            head, sha, first = found, hashlib.sha256(), True
            continue
        sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False
    if head is not None:
        out.append((*(head[n] for n in names), sha.hexdigest()))
    if out:
        yield _batch(out, DIGEST)


def _streams(rows: DataFrame, decisions: DataFrame, absent: str | None) -> DataFrame:
    """Each conversation's decision followed by its rows in order, in one task."""
    here = rows if absent is None else rows.where(~F.col(absent))
    named = here.select("conv_id", F.lit(False).alias("head"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    both = decisions.withColumn("head", F.lit(True)).unionByName(named.withColumn("m", F.md5("text")), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("head"), "turn", "role", "m").drop("turn", "m")


def repaired_turns(rows: DataFrame, decisions: DataFrame, absent: str | None = None) -> DataFrame:
    """The repaired conversations: (conv_id, position, edit K, R or I, role, text)."""
    return arrow_map(_streams(rows, decisions, absent), _turns, TURNS)


def repair_digests(rows: DataFrame, decisions: DataFrame, absent: str | None = None) -> DataFrame:
    """``decisions`` with the SHA-256 of each conversation's repaired ``role:text`` lines."""
    return arrow_map(_streams(rows, decisions, absent), _digests, DIGEST)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, absent) damaged by crc32 of ``conv_id:turn`` mod 20 (nulls: one space).

    0: absent, 1: text emptied, 2: ``.!?`` removed, 3: repeated once, 4: role user.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(name.cast("binary")) % 20
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), hit.alias("hit"))
    return rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                       (F.col("hit") == 0).alias("absent"), F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("col")
