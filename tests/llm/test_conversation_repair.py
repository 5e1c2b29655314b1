"""op11 against a literal search over all edits, and its tables against single steps."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest
from retail_insight.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, key string, pos string, n string, fault string, symbol string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NEXT = {"": "u", "s": "u", "a": "u", "u": "a"}
NAMES = {"u": "user", "a": "assistant"}


def literal(rows):
    """The report and the digest of one conversation's damaged rows [(turn, role, text)]."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        found = WORD.findall(text)
        if not found:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if found[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, inserts):
        """(cost, letters, lines) from row i on."""
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            c, way, lines = best(i, NEXT[state], inserts + 1)
            options.append((c + 3, "I" + way, (f"{NAMES[NEXT[state]]}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            c, way, lines = best(i + 1, state, 0)
            options.append((c + 4, "D" + way, lines))
            if faults[i] not in ("blank", "duplicate"):
                late = 3 if faults[i] == "truncated" else 0
                if (state, role[:1]) in AFTER:
                    c, way, lines = best(i + 1, AFTER[state, role[:1]], 0)
                    options.append((c + late, "K" + way, (f"{role}:{text}", *lines)))
                c, way, lines = best(i + 1, NEXT[state], 0)
                options.append((c + 3 + late, "R" + way, (f"{NAMES[NEXT[state]]}:{text}", *lines)))
        return min(options) if options else (10 ** 9, "", ())

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None])
            text = rng.choice(["a.", "b!", "Wie?", "cut off", "é…", " \t\n", "", None, f"t{rng.random()}.", "end. \n"])
            turn = rng.choice([turn, turn, turn, turn + 1, None])
            rows.append((conv if conv % 9 else None, turn, role, text))
            if rng.random() < .1:
                rows.append(rows[-1])
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def query(df, **options):
    out = cr.damaged_and_repaired(df, **options)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r[1:]) for r in out.collect()}


@pytest.mark.parametrize("options", [{}, {"block": 2, "chunk_rows": 3}])
def test_query_is_the_literal_result(spark, options):
    rows = conversations(3, 120)
    want = {c: literal(r) if r else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            for c, r in damaged(rows).items()}
    assert query(frame(spark, rows), **options) == want


def test_a_conversation_whose_rows_all_go(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert query(frame(spark, [(gone, 0, "user", "hi.")])) == {
        gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(spark):
    assert query(frame(spark, [])) == {}


def test_one_long_conversation_and_a_long_text(spark):
    sys.setrecursionlimit(10_000)
    rows = [(1, t, ("user", "assistant")[t % 3 % 2], f"text {t % 90}.") for t in range(300)] + [(1, 900, "user", "x" * 200_000)]
    assert query(frame(spark, rows), chunk_rows=32) == {1: literal(damaged(rows)[1])}


def test_block_lookups_equal_single_steps():
    t, rng = cr.tables(4), np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 17, 64):
        symbols = rng.integers(0, cr.SYMBOLS, n)
        at, paid = t.read(symbols)
        for end in range(len(t.vectors)):
            v, cost = end, 0
            for s in symbols[::-1]:
                cost += t.cost[s, v]
                v = t.step[s, v]
            assert (at[end], paid[end]) == (v, cost)
            behind = t.behind(symbols, end)
            assert all(t.step[symbols[i], behind[i]] == behind[i - 1] for i in range(1, n))
