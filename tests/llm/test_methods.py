"""The operators' inner methods against plain versions."""

from __future__ import annotations

import io
import math
import random
import zipfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waymill.llm import jaccard, repeats
from waymill.llm.archives import read_directory, stored_range
from waymill.llm.fingerprint import PrefixHashes, code_points, fingerprint_of, likeness
from waymill.llm.hosts import measure_text
from waymill.llm.jaccard import CountTree, coarse, fine_vector, link_sets, linked, possible
from waymill.llm.language import GRAM, LanguageFilters
from waymill.llm.pieces import MODEL, PieceTable, piece_table, sample_pieces
from waymill.llm.recurrent import PARTS, Network, score_texts, train
from waymill.llm.shingles import shingle_sets
from waymill.llm.suffixes import suffix_array
from waymill.llm.toxicity import _indexed, increasing_rates


@given(st.lists(st.integers(1, 4), max_size=60))
@settings(max_examples=300, deadline=None)
def test_suffix_array(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def _brute_repeats(texts: list[bytes], length: int) -> list[list[int]]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    return [
        sorted({p for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1 for p in range(i, i + length)}) for t in texts
    ]


@pytest.mark.parametrize("hot, meet", [(20_000, 20_000), (2, 20_000), (2, 3), (0, 0)])
def test_repeated_strings(spark, monkeypatch, hot, meet):
    monkeypatch.setattr(repeats, "_HOT", hot)
    monkeypatch.setattr(repeats, "_MEET", meet)
    rng = random.Random(hot)
    word = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(300)]
    shared = [" ".join(rng.choices(word, k=60)) for _ in range(3)]
    texts = ["a" * 300, "é" * 120, "\0" * 250, "ab" * 130]
    for _ in range(40):
        parts = [" ".join(rng.choices(word, k=rng.randint(0, 50)))]
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            parts += [s[rng.randint(0, 20) : len(s) - rng.randint(0, 20)], " ".join(rng.choices(word, k=rng.randint(0, 30)))]
        texts.append(" ".join(parts))
    texts += [texts[5], texts[6] + "x", "y" + texts[6]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in repeats.repeated_strings(docs, length=100).collect()}
    for i, places in enumerate(_brute_repeats([t.encode() for t in texts], 100)):
        spans = found[i]["spans"]
        assert sorted(p for s in spans for p in range(s["start"], s["end"])) == places
        assert all(a["end"] < b["start"] for a, b in zip(spans, spans[1:]))
        if spans:
            assert found[i]["kept_text"].encode().decode() == found[i]["kept_text"]


def test_a_short_passage_in_many_documents_does_not_gather(spark, monkeypatch):
    """190 bytes that many short documents share give as many different contexts; no key keeps more than some of them."""
    monkeypatch.setattr(repeats, "_HOT", 200)
    monkeypatch.setattr(repeats, "_MEET", 200)
    largest = []
    divide = repeats.divided_contexts

    def watched(spark, contexts, length):
        found = divide(spark, contexts, length)
        sizes = [df.groupBy("key").count().agg({"count": "max"}).first()[0] for df in (contexts, found[0])]
        largest.append(sizes)
        return found

    monkeypatch.setattr(repeats, "divided_contexts", watched)
    passage = "".join(random.Random(1).choices("abcdefgh", k=190))
    rng = random.Random(2)
    texts = ["".join(rng.choices("stuvwxyz", k=120)) + passage + "".join(rng.choices("stuvwxyz", k=120)) for _ in range(3000)]
    texts += [texts[0][60:380] + "!", "?" + texts[1][30:340]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in repeats.repeated_strings(docs).collect()}
    assert {i: s for i, s in found.items() if s} == {0: [(60, 380)], 1: [(30, 340)], 3000: [(0, 320)], 3001: [(1, 311)]}
    [(before, after)] = largest
    assert before > 1000 and after <= 200


@given(st.text("ab ", max_size=80), st.text("ab ", max_size=80), st.data())
@settings(max_examples=100, deadline=None)
def test_prefix_hashes(one, other, data):
    a, b = PrefixHashes(code_points(one)), PrefixHashes(code_points(other))
    i, j = data.draw(st.integers(0, len(one))), data.draw(st.integers(0, len(other)))
    n = 0
    while i + n < len(one) and j + n < len(other) and one[i + n] == other[j + n]:
        n += 1
    assert a.common_extension(i, b, j) == n
    spliced = PrefixHashes(code_points(other), a, i)
    assert fingerprint_of(spliced) == fingerprint_of(PrefixHashes(code_points(one[:i] + other)))
    assert (likeness(fingerprint_of(a), fingerprint_of(b)) == 1.0) == (one == other)


def test_directory_of_packages():
    for comment, wide in ((b"", False), (b"PK\5\6 in a comment", True)):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            for name in ("a", "ünï", "empty"):
                with z.open(zipfile.ZipInfo(name), "w", force_zip64=wide) as m:
                    m.write(name.encode() * 7 if name != "empty" else b"")
            z.comment = comment
        members = read_directory(raw, len(raw.getvalue()))
        assert [m.name for m in members] == ["a", "ünï", "empty"]
        start, size = stored_range(raw, members[1])
        assert raw.getvalue()[start : start + size] == "ünï".encode() * 7
    many = io.BytesIO()
    with zipfile.ZipFile(many, "w") as z:
        for i in range(65_600):
            z.writestr(zipfile.ZipInfo(str(i)), b"x")
    assert len(read_directory(many, len(many.getvalue()))) == 65_600
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 100)
    with pytest.raises(ValueError, match="compressed"):
        stored_range(packed, read_directory(packed, len(packed.getvalue()))[0])
    with pytest.raises(ValueError, match="no end"):
        read_directory(io.BytesIO(b"nothing"), 7)


def test_sampled_segmentations_follow_their_probabilities():
    table, word = PieceTable(MODEL, 0.5), "thtion"
    names = {"▁" + word[:i] for i in range(7)} | {word[i:j] for i in range(6) for j in range(i + 1, 7)}
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    known = {n: processor.piece_to_id(n) for n in names if processor.id_to_piece(processor.piece_to_id(n)) == n}
    chances: dict[tuple, float] = {}

    def extend(rest: str, taken: tuple, log_p: float) -> None:
        if not rest:
            chances[taken] = math.exp(log_p)
        for i in range(1, len(rest) + 1):
            if rest[:i] in known:
                piece = known[rest[:i]]
                extend(rest[i:], (*taken, piece), log_p + table.log_p[piece])

    extend("▁" + word, (), 0.0)
    total, n = sum(chances.values()), 20_000
    rng = random.Random(1)
    found = Counter(tuple(x.tolist()) for x in sample_pieces(table, [rng.getrandbits(60) for _ in range(n)], [word] * n))
    assert set(found) <= set(chances)
    for taken, chance in chances.items():
        p = chance / total
        assert abs(found[taken] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=5))
@settings(max_examples=60, deadline=None)
def test_pieces_are_lossless_and_depend_on_the_row_only(texts):
    table = piece_table(MODEL, 0.5)
    keys = list(range(len(texts)))
    together = sample_pieces(table, keys, texts)
    for key, text, pieces in zip(keys, texts, together):
        assert b"".join(table.text[i] for i in pieces.tolist()).decode()[1:] == text
        assert (sample_pieces(table, [key], [text])[0] == pieces).all()


def test_gradients_and_probabilities():
    rng = np.random.default_rng(3)
    net = Network.of_counts(np.sort(rng.random(30))[::-1] * 100, end=4, classes=5)
    net = net.with_flat(net.flat() + rng.standard_normal(len(net.flat())) * 0.1)
    states = rng.standard_normal((30, net.u.shape[0])).astype(np.float32)
    one = np.repeat(states[:1], 30, axis=0)
    assert abs(np.exp(net.log_p(one, np.arange(30))).sum() - 1) < 1e-5
    targets, g = rng.integers(0, 30, 30), {}
    net.log_p(states, targets, g)
    for part in ("class_w", "class_b", "word_w", "word_b"):
        values = getattr(net, part)
        at = np.unravel_index(np.abs(g[part]).argmax(), values.shape)
        step, before = 1e-2, values[at]
        values[at] = before + step
        up = net.log_p(states, targets).sum()
        values[at] = before - step
        down = net.log_p(states, targets).sum()
        values[at] = before
        assert abs((down - up) / (2 * step) - g[part][at]) < 0.05 * abs(g[part][at]) + 1e-2
    assert set(PARTS) > set(g) - {"states"}


def test_training_learns_what_follows_and_windows_do_not_matter():
    rng = np.random.default_rng(0)
    texts = [np.array([(s + k) % 6 for k in range(rng.integers(1, 60))], np.int32) for s in rng.integers(0, 6, 600)]
    net = Network.of_counts(np.array([10.0, 9, 9, 9, 9, 9, 1]), end=6, classes=3)
    before = score_texts(net, texts).sum()
    for _ in range(3):
        net = train(net, texts)
    after = score_texts(net, texts)
    assert after.sum() > 0.6 * before
    assert np.allclose(after, score_texts(net, texts, lanes=3, steps=5), rtol=1e-3, atol=1e-2)


def test_nearest_examples_are_exact():
    rng = random.Random(5)
    terms = {f"t{i}".encode(): i for i in range(12)}
    rows = []
    for i in range(500):
        some = rng.sample(range(12), rng.randint(1, 4))
        rows.append({"id": i, "label": int(0 in some), "terms": some, "counts": [rng.randint(1, 3) for _ in some]})
    model = _indexed(rows, terms, np.linspace(1, 3, 12), neighbours=7, block=16)
    vectors = {}
    for r in rows:
        v = np.zeros(12)
        v[r["terms"]] = (1 + np.log(r["counts"])) * model.idf[r["terms"]]
        vectors[r["id"]] = v / np.linalg.norm(v)
    for _ in range(60):
        terms_, weights = model.vector(" ".join(f"T{rng.randrange(14)}," for _ in range(rng.randint(1, 6))))
        if not len(terms_):
            continue
        q = np.zeros(12)
        q[terms_] = weights
        every = np.round([vectors[i] @ q for i in model.ids], 9)
        order = np.lexsort((np.arange(500), -every))[:7]
        at, cosines = model.nearest(terms_, weights)
        positive = every[order] > 0
        assert (at[: positive.sum()] == order[positive]).all() and np.allclose(cosines[: positive.sum()], every[order][positive])
    steps, rates = increasing_rates(np.array([0.1, 0.2, 0.2, 0.9, 0.95]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(rates) >= 0).all() and len(steps) == len(rates)


def _sets(rng: random.Random, n: int) -> list[np.ndarray]:
    base = [np.array(rng.sample(range(1 << 62), 90), np.uint64) * np.uint64(3) for _ in range(3)]
    sets = []
    for _ in range(n):
        own = base[rng.randrange(3)].copy()
        for i in rng.sample(range(90), rng.randint(0, 20)):
            own[i] = rng.getrandbits(63)
        sets.append(np.unique(own[: rng.randint(60, 90)]))
    return sets


def test_tree_rules_out_no_link():
    sets = _sets(random.Random(2), 300)
    fine = [fine_vector(s) for s in sets]
    tree = CountTree(np.array([coarse(f) for f in fine]), 80)
    marked = possible(fine, 80)
    labels = np.arange(len(sets))
    links = {(i, j) for i in range(300) for j in range(300) if i != j and linked(sets[i], sets[j], 80)}
    assert links
    for i in range(300):
        near = set(tree.near(coarse(fine[i])).tolist())
        assert {j for a, j in links if a == i} <= near
        assert marked[i] or not any(a == i for a, _ in links)

    def components(pairs):
        names = list(range(300))
        for a, b in pairs:
            old, new = names[a], names[b]
            names = [new if x == old else x for x in names]
        return {tuple(i for i in range(300) if names[i] == x) for x in names}

    assert components(link_sets(sets, labels, 80)) == components(links)
    across = components((a, b) for a, b in links if (a < 100) != (b < 100))
    assert components(link_sets(sets, labels, 80, hosts=100)) == across


def test_near_duplicates_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "_CHUNK_DOCS", 3)
    rng = random.Random(8)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(100)]
        for _ in range(12):
            own = base.copy()
            for i in rng.sample(range(100), rng.randint(0, 5)):
                own[i] = f"v{rng.randrange(5000)}"
            texts.append(" ".join(own))
    sets = [set(s.tolist()) for s in shingle_sets(pa.array(texts))]
    names = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = max(names[i], names[j]), min(names[i], names[j])
                names = [new if x == old else x for x in names]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(texts))] == names


def test_shingles():
    texts = ["A b c d e f", "a B c d e", "a b", None, "", "a b c d e a b c d e a b c d e"]
    sets = list(shingle_sets(pa.array(texts)))
    assert [len(s) for s in sets] == [2, 1, 1, 0, 0, 5]
    assert sets[1][0] in sets[0] and sets[2][0] not in sets[0] and sets[1][0] in sets[5]


def test_language_filters_return_every_language_of_a_gram():
    rng = np.random.default_rng(1)
    grams = rng.integers(97, 123, (4000, GRAM)).astype(np.uint8)
    packed = grams.astype(np.int64) @ (256 ** np.arange(GRAM))
    langs = rng.integers(0, 11, 4000)
    filters = LanguageFilters.build([f"l{i:02}" for i in range(11)], packed, langs)
    for gram, lang in zip(grams[:500], langs[:500]):
        total, known = filters.hits(gram, np.array([0, GRAM]))
        assert total[0] == 1 and known[lang, 0] >= 1 - filters.false_rate[lang]
    assert (filters.false_rate < 0.01).all()


def test_measures():
    assert measure_text("a b c d") == (4, 4, 0, 1, 0, 0)
    assert measure_text("x y z x y z") == (6, 6, 0, 1, 0, 6)
    assert measure_text("é # é\né # é\n \n") == (6, 6, 2, 2, 1, 6)
    assert measure_text(None) == measure_text("") == (0, 0, 0, 0, 0, 0)
