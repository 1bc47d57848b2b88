"""Repaired conversations against a plain search over all edits."""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waymill.llm import conversations, grammar
from waymill.llm.conversations import damaged, repair_conversations, repaired
from waymill.llm.grammar import Rope, cheapest_edits, re_pair

SPACES = " \t\n\x0b\x0c\r"


def plainly(rows):
    """Cost, audit and repaired lines of (role, text, fault) by trying everything: the result must be s?(ua)+ or empty."""

    @lru_cache(None)
    def search(i, before, inserted):
        """Best (cost, audit, lines) from row i on; ``before`` is the last role's initial."""
        ways = []
        if i == len(rows) and before in ("", "a"):
            ways.append((0, "", ()))
        fitting = "assistant" if before == "u" else "user"
        if inserted < 3:
            cost, audit, lines = search(i, fitting[0], inserted + 1)
            ways.append((cost + 2, "I" + audit, (f"{fitting}:", *lines)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, lines = search(i + 1, before, 0)
            ways.append((cost + 3, "D" + audit, lines))
            if fault in ("", "truncated"):
                more = int(fault == "truncated")
                cost, audit, lines = search(i + 1, fitting[0], 0)
                ways.append((cost + 2 + more, "R" + audit, (f"{fitting}:{text}", *lines)))
                if role[:1] == fitting[0] or role[:1] == "s" and before == "":
                    cost, audit, lines = search(i + 1, role[0], 0)
                    ways.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    return search(0, "", 0)


def expected(rows):
    """What the operator returns for one conversation's (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, lines = plainly(tuple((r, x, f) for (_, r, x), f in zip(rows, faults)))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
CODES = st.lists(st.integers(0, 11), max_size=9)


def as_rows(codes):
    faults = ("", "truncated", "blank")
    return tuple((("system", "user", "assistant", "tool")[c // 3], "x", faults[c % 3]) for c in codes)


@settings(max_examples=150, deadline=None)
@given(st.lists(CODES, max_size=6))
def test_cheapest_edits(sequences):
    found = cheapest_edits([np.array(s, np.int64) for s in sequences])
    assert found == [plainly(as_rows(s))[:2] for s in sequences]


def test_grammar_shares_long_repeats():
    pattern = [4, 7, 5, 2, 8, 3, 3, 9]
    sequences = [np.array(pattern * n, np.int64) for n in (4000, 250, 1)]
    short, rules = re_pair(sequences, 12)
    assert max(map(len, short)) < 40 and len(rules) < 40
    audits = cheapest_edits(sequences)
    assert audits[2] == plainly(as_rows(pattern))[:2]
    reached = [[(0, Rope("")), None, None, None]]
    for code in pattern * 250:
        reached = grammar.combined(reached, grammar.symbol_matrix(code))
    ends = grammar.combined(reached, grammar.inserts())[0]
    whole = min(((e[0], str(e[1])) for e in (ends[0], ends[3]) if e), key=lambda w: w)
    assert audits[1] == whole


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("DIKR", max_size=300), min_size=1, max_size=6), st.lists(st.text("DIKR", max_size=300), min_size=1, max_size=6))
def test_ropes_compare_as_texts(one, other):
    def joined(parts):
        rope = Rope("")
        for p in parts:
            rope = rope + Rope(p)
        return rope

    a, b = joined(one), joined(other)
    assert (str(a), a < b, b < a) == ("".join(one), str(a) < str(b), str(b) < str(a))
    assert not (a + b) < (a + b) and ((a + b) < (a + a)) == ("".join(one + other) < "".join(one + one))


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! {t}?") for c in (1, None) for t in (*range(60), None)]
    found = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    plain = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
            plain += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert sorted(map(tuple, found), key=repr) == sorted(plain, key=repr)


HUGE = "word " * 400_000
ROWS = {
    1: [(0, "system", "Be kind."), (1, "user", "Hello."), (2, "assistant", "Hi!")],
    2: [(0, "user", "Hello."), (3, "user", "Hello."), (3, "user", "More"), (9, "assistant", " \t")],
    3: [(None, "user", "a."), (None, None, "b."), (None, "assistant", None)],
    4: [(5, "assistant", ""), (5, "assistant", "")],
    5: [(1, "user", "same?"), (1, "user", "same?"), (1, "user", "same?"), (None, "user", "same?"), (2, "assistant", "é \U0001f600.")],
    6: [(1, "tool", HUGE), (2, "user", HUGE + "."), (3, "assistant", HUGE + "\n?\n")],
    7: [(t, ("user", "assistant", "assistant")[t % 3], f"text {t % 50}{'.' * (t % 2)}") for t in range(120)],
    None: [(1, "system", "x."), (2, "system", "x."), (3, "assistant", "y")],
    8: [(0, "assistant", "z.")],
}


def test_repair_with_nulls_ties_and_long_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "_CHUNK", 7)
    rows = [(c, *r, "k") for c, own in ROWS.items() for r in own]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string").withColumn("digest", F.lit("clash"))
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repaired(docs, docs).collect()}
    assert found == {c: expected(own) for c, own in ROWS.items()}


def test_conversations_without_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    nothing = spark.createDataFrame([], schema)
    assert repair_conversations(nothing).collect() == [] and repaired(nothing, nothing).collect() == []
    one = spark.createDataFrame([(1, 1, "user", "x"), (1, 1, "user", "x")], schema)
    [row] = repaired(one, nothing).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
