"""Which sets the join looks at: none that links is ruled out, and large groups of near copies do not meet all with all."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from waymill.llm import jaccard
from waymill.llm.jaccard import _partnered, _visits, linked, may_link, near_duplicates, partnered


def ordered_sets(rng, n=80):
    """Sets in one common order, with each one's prefix that a link must share."""
    base = [[rng.randrange(1 << 40) for _ in range(rng.randint(5, 60))] for _ in range(6)]
    sets = []
    for _ in range(n):
        own = [x if rng.random() > 0.08 else rng.randrange(1 << 40) for x in rng.choice(base)]
        sets.append(np.unique(np.array(own[: rng.randint(len(own) * 3 // 4, len(own))], np.uint64)))
    counts = Counter(int(x) for s in sets for x in s)
    in_order = [sorted(s.tolist(), key=lambda x: (counts[x], x)) for s in sets]
    return sets, [s[: len(s) - -(-80 * len(s) // 100) + 1] for s in in_order]


@pytest.mark.parametrize("seed", range(8))
def test_no_link_is_ruled_out(seed, monkeypatch):
    sets, firsts = ordered_sets(random.Random(seed))
    places = [{x: i for i, x in enumerate(f)} for f in firsts]
    links = {(i, j) for i in range(len(sets)) for j in range(i) if linked(sets[i], sets[j], 80)}
    assert len(links) > 20
    rows = sorted((x, i, (place << 32) + len(sets[i])) for i, p in enumerate(places) for x, place in p.items())
    shingles, names, at = (np.array(c, np.int64) for c in zip(*rows))
    for paired in (64, 2):
        monkeypatch.setattr(jaccard, "_PAIRED", paired)
        kept = set(zip(shingles[partnered(shingles, at, 80)].tolist(), names[partnered(shingles, at, 80)].tolist()))
        for i, j in links:
            common = places[i].keys() & places[j].keys()
            assert common
            for x in common:
                pair = [(np.int64(len(sets[k])), np.int64(places[k][x])) for k in (i, j)]
                assert may_link(*pair, 80) and {(x, i), (x, j)} <= kept
    # Most of what shares a shingle by chance has no partner.
    assert partnered(np.array([7, 7]), np.array([(0 << 32) + 50, (9 << 32) + 50]), 80).tolist() == [False, False]


@pytest.mark.parametrize("group", [200_000, 3])
def test_batches_do_not_matter(monkeypatch, group):
    monkeypatch.setattr(jaccard, "_GROUP", group)
    rng = random.Random(5)
    rows = sorted((rng.randrange(12), i, (rng.randrange(5) << 32) + 30) for i in range(300))
    columns = [np.array(c, np.int64) for c in zip(*rows)]
    whole = partnered(columns[0], columns[2], 80)
    for size in (1, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in columns], names=["shingle", "row", "at"]) for i in range(0, 300, size)]
        found = [r for b in _partnered(80)(iter(batches)) for r in b.column(1).to_pylist()]
        expected = columns[1][whole].tolist()
        assert found == expected if group > 3 else set(expected) <= set(found)
    assert [b.num_rows for b in _partnered(80)(iter([]))] == [0]


def test_visits_go_to_the_larger_component():
    at = (0 << 32) + 20
    rows = [(1, 10, at, 100, 5, 7), (1, 11, at, 101, 1, 11), (1, 12, at, 102, 1, 12), (1, 13, (9 << 32) + 20, 103, 9, 13)]
    rows += [(2, 10, at, 100, 5, 7), (2, 14, at, 104, 5, 7), (3, 20, at, 105, 1, 20), (3, 21, at, 105, 1, 21)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["shingle", "row", "at", "chunk", "weight", "component"])

    def found(one_each):
        return {(r, c) for b in _visits(80, one_each)(iter([batch])) for r, c in zip(*(x.to_pylist() for x in b.columns))}

    assert found(False) == {(11, 100), (12, 100), (11, 102)}
    assert {r for r, _ in found(True)} == {11, 12} and len(found(True)) == 2


def test_near_copies_over_many_chunks_meet_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_CHUNK_DOCS", 20)
    counts = Counter()
    store = jaccard.materialize

    def counted(df, path):
        table = store(df, path)
        counts[path.rsplit("/", 1)[1].rsplit("-", 1)[0]] += table.count()
        return table

    monkeypatch.setattr(jaccard, "materialize", counted)
    rng = random.Random(3)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    texts = []
    for i in range(600):
        own = base.copy()
        own[rng.randrange(150)] = f"x{i}"
        texts.append(" ".join(own))
    texts += [" ".join(f"o{rng.randrange(900)}" for _ in range(120)) for _ in range(100)]
    rows = [(i, t) for i, t in enumerate(texts)]
    found = near_duplicates(spark.createDataFrame(rows + rows[:1] * 200, "doc_id long, text string").repartition(6)).collect()
    names = {r["doc_id"]: r["component_id"] for r in found}
    assert len(found) == 900 and all(names[i] == (0 if i < 600 else i) for i in range(700))
    # Thirty chunks: each with each would be some ten thousand.
    assert counts["distinct-visits"] < 3 * 600


def test_sets_go_to_the_chunk_of_the_shingle_that_most_sets_have(spark, monkeypatch):
    """So that a group of near copies fills few chunks, and those which do not link have few chunks to visit."""
    tables = {}
    store = jaccard.materialize

    def kept(df, path):
        return tables.setdefault(path.rsplit("/", 1)[1].rsplit("-", 1)[0], store(df, path))

    monkeypatch.setattr(jaccard, "materialize", lambda df, path: store(df, path) if "labels" in path or "edges" in path else kept(df, path))
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(120):
        own = base.copy()
        for k in rng.sample(range(150), 2):
            own[k] = f"x{i}-{k}"
        texts.append(" ".join(own))
    near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4))
    shared = [(r["row"], r["shingle"]) for r in tables["shared"].collect()]
    counts = Counter(shingle for _, shingle in shared)
    most = Counter()
    for row, shingle in shared:
        most[row] = max(most[row], counts[shingle])
    blocks = tables["known"].collect()
    assert len(blocks) > 100 and all(counts[r["block"]] == most[r["row"]] for r in blocks)
