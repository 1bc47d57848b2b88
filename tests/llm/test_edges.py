"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waymill.llm.archives import read_archives, write_archives
from waymill.llm.fingerprint import PrefixHashes, code_points, compare_edited, fingerprint_edits, fingerprint_of, fingerprints, likeness
from waymill.llm.hosts import host_rules
from waymill.llm.jaccard import near_duplicates
from waymill.llm.language import identify_languages, learn_languages
from waymill.llm.mixing import emit_copies, mix_sources
from waymill.llm.pieces import decode_pieces, encode_pieces
from waymill.llm.repeats import repeated_strings
from waymill.llm.scoring import score_documents
from waymill.llm.toxicity import fit_toxicity, score_toxicity
from waymill.storage import new_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, copies int, row int, n int, key string, word string"
BASE = " ".join(f"w{i * 7919 % 1009}" for i in range(120))
LONG = "".join(f"ab{i * i % 10007}c " for i in range(150_000))
ROWS = [
    (1, BASE, "en", "a", 1),
    (2, BASE, "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "de", "b", 0),
    (5, " \n\t ", "de", None, 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, BASE + " you idiot clown", None, "b", 9),
    (7, BASE + " you idiot clown", None, "b", 9),
    (None, "lonely text without key é ▁ \U0001f600 \x00", "fr", "c", 3),
    (8, "x", "fr", "c", 1),
    (9, "one two three", "fr", "c", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0.5, 1, 2, 3, "k", "w") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows, column):
    return sorted(((r["doc_id"], r[column]) for r in rows), key=repr)


def test_archives(spark, docs, empty):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "key", "n")
    records = read_archives(write_archives(pages, new_folder(spark, "archives"), package_bytes=200)).collect()
    assert len(records) == len(ROWS)
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in records}
    assert (1, "revisit", 2) in kinds and (2, "response", None) in kinds and (3, "revisit", 4) in kinds
    # Pages that repeat the largest key and payload are responses, too.
    assert [r["record_type"] for r in records if r["page_id"] == 7] == ["response", "response"]
    assert {r["payload"].decode() for r in records if r["payload"] is not None} == {r[1] or "" for r in ROWS}
    for r in records:
        if r["payload"] is not None:
            assert r["payload_bytes"] == len(r["payload"])
    large = read_archives(write_archives(pages, new_folder(spark, "archives"), revisit_bytes=10**6), payloads=False)
    # Only the long text is large enough, and it is alone.
    assert large.filter("record_type = 'revisit'").count() == 0
    nothing = pages.limit(0)
    assert read_archives(write_archives(nothing, new_folder(spark, "archives"))).count() == 0


def test_fingerprints(docs, empty):
    edits = fingerprint_edits(docs).collect()
    assert len(edits) == len(ROWS) and fingerprint_edits(empty).count() == 0
    # Null keys come first, so that the first document follows the last.
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for own, after in zip(order, order[1:] + order[:1]):
        text, following = own[1] or "", after[1] or ""
        edit = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        expected.append((own[0], hashlib.sha256(edit.encode()).hexdigest()))
    assert by_id(edits, "edited_sha256") == sorted(expected, key=repr)
    marks = fingerprints(docs.withColumn("fingerprint", F.lit(1))).collect()
    assert {r["text"] or "": r["fingerprint"] for r in marks}[BASE] == next(e["fingerprint"] for e in edits if e["doc_id"] == 1)
    one = fingerprint_edits(docs.filter("doc_id = 8")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_lm(docs, empty):
    scored = score_documents(docs, F.col("doc_id") != 2, head=16, outputs=8, classes=3).collect()
    assert len(scored) == len(ROWS)
    found = {r["doc_id"]: r for r in scored}
    assert found[3]["n_tokens"] == found[4]["n_tokens"] == found[5]["n_tokens"] == 1
    assert found[3]["score"] == found[4]["score"] < 0
    assert found[2]["n_known"] == found[2]["n_tokens"] == 121
    assert score_documents(empty, F.lit(True)).count() == 0
    # Nothing to learn from: the base gives every token the probability of an unknown word, which is then 1.
    for r in score_documents(docs, F.lit(False)).collect():
        assert r["train_tokens"] == 0 and abs(r["base_score"]) < 1e-6 and r["score"] <= 0


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i in (7, 100))) for i in (1, 2, 4, 6, 7, 8, 9)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels, least_association=0.0)
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}) == 1
    assert score_toxicity(empty, model).count() == 0
    blank = fit_toxicity(docs, labels.limit(0))
    assert {r["score"] for r in score_toxicity(docs, blank).collect()} == {0.5}
    assert score_toxicity(empty, fit_toxicity(empty, labels)).count() == 0


def test_mixing(docs, empty):
    sized = docs.withColumn("size", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    mixed = mix_sources(sized)
    rows = mixed.collect()
    assert len(rows) == len(ROWS) and {r["source"] for r in rows} == {"a", "b", "c", None}
    assert all(0 <= r["copies"] <= 3 for r in rows)
    assert emit_copies(mixed).count() == sum(r["copies"] for r in rows)
    assert mix_sources(sized.limit(0)).count() == 0
    zero = mix_sources(docs.withColumn("size", F.lit(0).cast("long"))).collect()
    assert {(r["copies"], r["target"]) for r in zero} == {(0, 0.0)}
    with pytest.raises(ValueError, match="__row"):
        mix_sources(sized.withColumn("__row", F.lit(1)))


def test_pieces(docs, empty):
    coded = decode_pieces(encode_pieces(docs.withColumn("pieces", F.lit(1)).withColumn("decoded", F.lit(1)))).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in coded) and len(coded) == len(ROWS)
    assert len({tuple(r["pieces"]) for r in coded if r["doc_id"] == 7}) == 1
    assert decode_pieces(encode_pieces(empty)).count() == 0
    at_once = encode_pieces(docs, decoded="again").collect()
    assert sorted((r["again"], r["pieces"]) for r in at_once) == sorted((r["decoded"], r["pieces"]) for r in coded)


def test_repeats(docs, empty):
    rows = repeated_strings(docs).collect()
    assert len(rows) == len(ROWS) and repeated_strings(empty).count() == 0
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in rows}
    assert spans[1] == spans[2] == [(0, len(BASE))] and spans[3] == spans[4] == spans[8] == []
    assert spans[7] == [(0, len(BASE) + len(" you idiot clown"))]


def test_hosts(docs, empty):
    rows = host_rules(docs).collect()
    assert len(rows) == len(ROWS) and host_rules(empty).count() == 0
    found = {r["doc_id"]: r for r in rows}
    assert found[3]["n_words"] == found[4]["n_words"] == found[5]["n_words"] == 0 and found[3]["base_failed"]
    assert not found[1]["base_failed"]


def test_near_duplicates(docs, empty):
    rows = near_duplicates(docs).collect()
    assert len(rows) == len(ROWS) and near_duplicates(empty).count() == 0
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found[1] == found[2] == (116, 1) and found[7][1] == 1
    assert found[3] == (0, 3) and found[4] == (0, 4) and found[8] == (1, 8) and found[9] == (1, 9)


def test_languages(docs, empty):
    filters = learn_languages(docs)
    rows = identify_languages(docs.withColumn("lang_pred", F.lit("x")), filters).collect()
    assert len(rows) == len(ROWS) and identify_languages(empty, filters).count() == 0
    found = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert found[3] == found[4] == found[5] == "und" and found[1] == "en"
    none = learn_languages(empty)
    assert {r["lang_pred"] for r in identify_languages(docs, none).collect()} == {"und"}


def test_pipeline_stages(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(1, 0), (2, 0), (7, 1), (8, 0)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
        result = stage(spark, docs, str(tmp_path))
        assert result.count() > 0
        if name != "pieces":
            assert result.columns == list(corpus_pipeline.COLUMNS)


@pytest.mark.parametrize("stage", [corpus_pipeline.near_copies, corpus_pipeline.repeats])
def test_a_stage_leaves_only_its_result(spark, docs, tmp_path, stage):
    own = Path(new_folder(spark, "own").removeprefix("file:")).parent
    before = set(own.iterdir())
    result = stage(spark, docs, str(tmp_path))
    assert len(set(own.iterdir()) - before) == 1
    assert result.count() > 0


@pytest.mark.parametrize(
    "operator",
    [
        lambda d, s: mix_sources(d, size="n"),
        lambda d, s: host_rules(d),
        lambda d, s: identify_languages(d, learn_languages(d)),
    ],
)
@pytest.mark.parametrize("name", ["__text", "__range", "__local", "__before", "__host"])
def test_reserved_names_are_refused(spark, docs, operator, name):
    with pytest.raises(ValueError, match="reserved"):
        operator(docs.withColumn(name, F.lit(1)), spark)


@pytest.mark.parametrize("n", [*range(0, 70), 100, 127, 128, 200, 255, 256, 300, 511, 512, 700])
def test_edits_of_short_texts_stay_alike(n):
    text, after = "".join(chr(97 + i * i * 7 % 26) + "xyz"[i % 3] for i in range(n))[:n], "Q" * 400
    _, n_chars, _, own, edited, near, far, same = compare_edited(1, text, after)
    assert n_chars == n and same >= n - n // 4
    if n >= 8:
        assert 0 < near < 1 and near > far
    assert likeness(own, own) == 1.0 and likeness(own, edited) == near


def test_texts_of_neighbouring_lengths_are_comparable():
    text = "".join(f"word{i} " for i in range(400))
    for n in (9, 20, 40, 70, 130, 260, 520):
        one, other = (fingerprint_of(PrefixHashes(code_points(text[:k]))) for k in (n, 2 * n - 2))
        assert likeness(one, other) > 0
