"""Cheapest edits of symbol sequences, worked out once per rule of a grammar that all sequences share."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# A row's code: three times the role (system, user, assistant, other), plus 0 (sound), 1 (truncated) or 2 (to be deleted).
OTHER_ROLE = 3
DELETE = 2
KEEP_COST, INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 0, 2, 2, 3, 1
_FLAT = 256


class Rope:
    """A text as a tree of parts, so that joining two is a matter of one node."""

    __slots__ = ("left", "right", "size", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None, size: int = 0):
        self.text, self.left, self.right = text, left, right
        self.size = len(text) if text is not None else size

    def __add__(self, other: Rope) -> Rope:
        if not self.size:
            return other
        if not other.size:
            return self
        size = self.size + other.size
        if size <= _FLAT:
            return Rope(str(self) + str(other))
        return Rope(None, self, other, size)

    def __str__(self) -> str:
        if self.text is not None:
            return self.text
        parts, open_ = [], [self]
        while open_:
            node = open_.pop()
            if node.text is not None:
                parts.append(node.text)
            else:
                open_ += [node.right, node.left]
        return "".join(parts)

    def __lt__(self, other: Rope) -> bool:
        mine, theirs = [self], [other]
        while mine and theirs:
            a, b = mine.pop(), theirs.pop()
            if a is b:
                continue
            if a.text is None and (a.size >= b.size or b.text is not None):
                mine += [a.right, a.left]
                theirs.append(b)
            elif b.text is None:
                theirs += [b.right, b.left]
                mine.append(a)
            else:
                common = min(a.size, b.size)
                if a.text[:common] != b.text[:common]:
                    return a.text < b.text
                if a.size > common:
                    mine.append(Rope(a.text[common:]))
                if b.size > common:
                    theirs.append(Rope(b.text[common:]))
        return not mine and bool(theirs)


# The best way from each state to each: its cost and its audit, or nothing.
Matrix = list[list[tuple[int, Rope] | None]]


def _best(ways: list[tuple[int, Rope, Rope]]) -> tuple[int, Rope] | None:
    """The cheapest of some ways, given as cost and two parts of an audit; of equal ones that with the least audit."""
    if not ways:
        return None
    least = min(w[0] for w in ways)
    audits = [a + b for cost, a, b in ways if cost == least]
    return least, audits[0] if len(audits) == 1 else min(audits)


def combined(one: Matrix, other: Matrix) -> Matrix:
    """The matrix of what ``one`` stands for followed by what ``other`` stands for, by minimum and addition.

    Two audits of equal cost between the same states never are one the start of the other: the longer one would have
    further inserts, and so cost more.  So the lesser of two stays the lesser whatever follows.
    """
    result: Matrix = []
    for row in one:
        ways: list[list[tuple[int, Rope, Rope]]] = [[] for _ in range(STATES)]
        for middle, first in enumerate(row):
            if first is not None:
                for last, then in enumerate(other[middle]):
                    if then is not None:
                        ways[last].append((first[0] + then[0], first[1], then[1]))
        result.append([_best(w) for w in ways])
    return result


def _turn_to(state: int) -> int:
    """The state after a message that is made to fit: the assistant's after the user's, else the user's."""
    return ASSISTANT if state == USER else USER


def inserts() -> Matrix:
    """Any number of inserted messages."""
    matrix: Matrix = [[None] * STATES for _ in range(STATES)]
    for state in range(STATES):
        at, count = state, 0
        while matrix[state][at] is None:
            matrix[state][at] = (INSERT_COST * count, Rope("I" * count))
            at, count = _turn_to(at), count + 1
    return matrix


def symbol_matrix(code: int) -> Matrix:
    """Inserted messages, and then what may be done with a row of this code."""
    role, fault = divmod(code, 3)
    one: Matrix = [[None] * STATES for _ in range(STATES)]
    for state in range(STATES):
        ways: list[list[tuple[int, Rope, Rope]]] = [[] for _ in range(STATES)]
        ways[state].append((DELETE_COST, Rope("D"), Rope("")))
        if fault != DELETE:
            more = TRUNCATED_COST * fault
            ways[_turn_to(state)].append((REROLE_COST + more, Rope("R"), Rope("")))
            kept = {0: SYSTEM if state == START else None, 1: USER, 2: ASSISTANT}.get(role)
            if kept is not None and (kept == SYSTEM or kept == _turn_to(state)):
                ways[kept].append((KEEP_COST + more, Rope("K"), Rope("")))
        one[state] = [_best(w) for w in ways]
    return combined(inserts(), one)


def re_pair(sequences: Sequence[np.ndarray], symbols: int) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Replace the most frequent pair of neighbours by a new symbol again and again, in all sequences together.

    Returns the shortened sequences and the rules: symbol ``symbols + i`` stands for the i-th pair.  It ends when the most
    frequent pair occurs too seldom to pay for another pass over the sequences; what is left is right whenever it ends.
    """
    lengths = np.array([len(s) for s in sequences], np.int64)
    line = np.full(int(lengths.sum()) + len(sequences), -1, np.int64)
    # Each sequence is followed by a mark that belongs to no pair.
    within = np.ones(len(line), bool)
    within[np.cumsum(lengths + 1) - 1] = False
    if len(sequences):
        line[within] = np.concatenate(sequences)
    rules: list[tuple[int, int]] = []
    while len(line) > 1:
        several = symbols + len(rules)
        pairs = np.where((line[:-1] >= 0) & (line[1:] >= 0), line[:-1] * several + line[1:], -1)
        values, counts = np.unique(pairs[pairs >= 0], return_counts=True)
        if not len(values) or counts.max() < 2 + len(line) // 1000:
            break
        pair = int(values[counts.argmax()])
        at = np.flatnonzero(pairs == pair)
        if pair // several == pair % several:
            # In a run of one symbol every other pair is taken.
            run = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1)))
            offset = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[offset % 2 == 0]
        rules.append((pair // several, pair % several))
        line[at] = several
        line = np.delete(line, at + 1)
    ends = np.flatnonzero(line < 0)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    return [line[a:b] for a, b in zip(starts.tolist(), ends.tolist())], rules


def cheapest_edits(sequences: Sequence[np.ndarray]) -> list[tuple[int, str]]:
    """For each sequence of codes the least cost of edits that give an orderly conversation, and their initials.

    Orderly is: nothing; or an optional system message and then one or more times user and assistant.  A message is kept,
    given another role, deleted, or an empty one is inserted before or after it.  Of equal costs the audit that is least as text
    counts.  One matrix is made for each rule of the grammar, from those of its two parts.
    """
    codes = 3 * (OTHER_ROLE + 1)
    short, rules = re_pair(sequences, codes)
    matrices = [symbol_matrix(code) for code in range(codes)]
    for left, right in rules:
        matrices.append(combined(matrices[left], matrices[right]))
    last = inserts()
    found = []
    for sequence in short:
        reached: Matrix = [[None] * STATES]
        reached[0][START] = (0, Rope(""))
        for symbol in sequence.tolist():
            reached = combined(reached, matrices[symbol])
        ends = combined(reached, last)[0]
        best = _best([(end[0], end[1], Rope("")) for end in (ends[START], ends[ASSISTANT]) if end is not None])
        found.append((best[0], str(best[1])))
    return found
