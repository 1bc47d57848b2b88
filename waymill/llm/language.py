"""Language identification by bit-sliced Bloom filters of byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, new_folder
from .arrays import LOWER, released, row_blocks, text_bytes
from .columns import refuse_reserved

GRAM = 4
_PIECE = 4_000_000
_HELD = 2_000_000
# Letters are kept in lower case, and so are all bytes of longer characters; the rest separates.
_FORM = LOWER.copy()
_FORM[[b for b in range(128) if not (97 <= b <= 122 or 65 <= b <= 90)]] = 32
# Odd multipliers of the Bloom filter's hash functions.
_HASHES = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def _grams(data: np.ndarray, first: int, last: int) -> np.ndarray:
    """The n-grams that start at first … last-1, packed in 32 bits; zero-filled after the end."""
    part = np.zeros(last - first + GRAM - 1, np.uint32)
    there = _FORM[data[first : last + GRAM - 1]]
    part[: len(there)] = there
    packed = part[: last - first].copy()
    for i in range(1, GRAM):
        packed |= part[i : last - first + i] << np.uint32(8 * i)
    return packed


def _complete(offsets: np.ndarray, first: int, last: int) -> np.ndarray:
    """Which of the n-grams that start at first … last-1 end in the row they start in."""
    whole = np.ones(last - first, bool)
    for i in range(1, GRAM):
        crossing = offsets[1:] - i
        crossing = crossing[(crossing >= first) & (crossing < last)]
        whole[crossing - first] = False
    return whole


def _counted(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams with their numbers."""
    if counts is None:
        grams = np.sort(grams)
    else:
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.empty(0, np.int64)
    if counts is None:
        return grams[starts], np.diff(np.append(starts, len(grams)))
    return grams[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) → (lang, gram, n), added up within the task as far as memory for it is bounded."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, counts = _counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            for i in range(0, len(grams), 100_000):
                some = slice(i, i + 100_000)
                n = len(grams[some])
                arrays = [pa.array([lang] * n, pa.string()), pa.array(grams[some].astype(np.int64)), pa.array(counts[some])]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        names = sorted(set(langs))
        code = np.array([names.index(x) for x in langs])
        data, offsets = text_bytes(batch.column(1))
        for first in range(0, len(data), _PIECE):
            last = min(len(data), first + _PIECE)
            grams, whole = _grams(data, first, last), _complete(offsets, first, last)
            lengths = np.diff(np.clip(offsets, first, last))
            of = np.repeat(code, lengths)
            for k in np.unique(of):
                got = _counted(grams[whole & (of == k)])
                held.setdefault(names[k], []).append(got)
                size += len(got[0])
            if size > _HELD:
                for lang, parts in held.items():
                    merged = _counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                    held[lang] = [merged]
                size = sum(len(parts[0][0]) for parts in held.values())
                if size > _HELD // 2:
                    yield from rows()
                    size = 0
    yield from rows()


@dataclass(frozen=True)
class LanguageFilters:
    """Bit ``l % 8`` of ``table[l // 8][slot]`` is set when language ``l`` has an n-gram in that slot."""

    languages: tuple[str, ...]
    table: np.ndarray
    false_rate: np.ndarray

    @staticmethod
    def build(languages: list[str], grams: np.ndarray, langs: np.ndarray) -> LanguageFilters:
        """Filters for pairs of an n-gram and the index of a language that has it; 16 slots or more per n-gram."""
        bits = max(10, int(np.ceil(np.log2(16 * max(1, len(np.unique(grams)))))))
        table = np.zeros((max(1, -(-len(languages) // 8)), 1 << bits), np.uint8)
        bit = (1 << (langs % 8)).astype(np.uint8)
        for odd in _HASHES:
            np.bitwise_or.at(table, (langs // 8, LanguageFilters.slots(grams, odd, bits)), bit)
        fill = [(table[i // 8] >> (i % 8) & 1).mean() for i in range(len(languages))]
        return LanguageFilters(tuple(languages), table, np.array(fill) ** len(_HASHES))

    @staticmethod
    def slots(grams: np.ndarray, odd: int, bits: int) -> np.ndarray:
        mixed = grams.astype(np.uint32)
        mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(odd)
        mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(odd)
        return mixed >> np.uint32(32 - bits)

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row: the number of n-grams, and per language how many its filter has (corrected for false positives)."""
        rows, known = len(offsets) - 1, np.zeros((len(self.languages), len(offsets) - 1))
        total, bits = np.zeros(rows), self.table.shape[1].bit_length() - 1
        for first in range(0, len(data), _PIECE):
            last = min(len(data), first + _PIECE)
            grams, whole = _grams(data, first, last), _complete(offsets, first, last)
            places = [self.slots(grams, odd, bits) for odd in _HASHES]
            at = np.clip(offsets, first, last) - first

            def per_row(flags: np.ndarray, at: np.ndarray = at) -> np.ndarray:
                return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int32)))[at])

            total += per_row(whole)
            for word, slice_ in enumerate(self.table):
                found = slice_[places[0]] & slice_[places[1]] & slice_[places[2]]
                found[~whole] = 0
                for i in range(8 * word, min(8 * word + 8, len(self.languages))):
                    known[i] += per_row(found >> np.uint8(i % 8) & np.uint8(1))
        wrong = self.false_rate[:, None]
        return total, np.maximum(0, (known - total * wrong) / (1 - wrong))


def learn_languages(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least_rate: float = 5e-6
) -> LanguageFilters:
    """Filters of the n-grams of each language, from all documents that have a language and a text.

    A language has an n-gram if at least ``least_rate`` of its n-grams are that one; an n-gram has all languages that have it.
    So a filter holds at most 1 / least_rate n-grams, whatever the size of the corpus; no more than these are sent to the driver.
    Repeated rows count each, and from an empty table nothing is learnt.
    """
    learnt = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    counts = learnt.mapInArrow(released(_count_batches), "lang string, gram bigint, n bigint")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = materialize(counts, new_folder(docs.sparkSession, "grams"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    sums = {row["lang"]: row["total"] for row in totals.collect()}
    if not sums:
        return LanguageFilters.build([], np.empty(0, np.int64), np.empty(0, np.int64))
    names = sorted(sums)
    total = F.element_at(F.create_map(*(F.lit(x) for pair in sums.items() for x in pair)), F.col("lang"))
    table = counts.filter(F.col("n") / total >= least_rate).select("lang", "gram").toArrow()
    index = {name: i for i, name in enumerate(names)}
    langs = np.array([index[x] for x in table["lang"].to_pylist()], np.int64)
    return LanguageFilters.build(names, table["gram"].to_numpy().astype(np.int64), langs)


def identify_languages(docs: DataFrame, filters: LanguageFilters, *, text: str = "text") -> DataFrame:
    """The other columns with ``lang_pred`` and ``score`` in place of the text.

    All n-grams of the whole text are looked up; the language whose filter has most of them wins, of
    equal ones the first by code point.  The score is its share among the two best.  A null text,
    or one without a letter, is ``und`` with score 0, and so is every text when nothing was learnt.
    Repeated rows get equal results, and an empty table an empty one.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, "lang_pred", "score")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["lang_pred string", "score double"])
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    names = [f.name for f in kept]
    refuse_reserved(names)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shared.value
        for whole in batches:
            for first, last in row_blocks(text_bytes(whole.column(0))[1], _PIECE):
                batch = whole.slice(first, last - first)
                data, offsets = text_bytes(batch.column(0))
                preds, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
                if learnt.languages:
                    _, known = learnt.hits(data, offsets)
                    best, top = known.argmax(axis=0), known.max(axis=0)
                    second = np.sort(known, axis=0)[-2] if len(learnt.languages) > 1 else np.zeros_like(top)
                    share = np.divide(top, top + second, out=np.zeros_like(top), where=top > 0)
                    latin = _rows_with((_FORM[data] != 32) & (data < 128), offsets)
                    for i in range(batch.num_rows):
                        if latin[i] or any(c.isalpha() for c in batch.column(0)[i].as_py() or ""):
                            preds[i], scores[i] = learnt.languages[best[i]], share[i]
                arrays = [batch.column(i + 1) for i in range(len(names))] + [pa.array(preds, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "lang_pred", "score"])

    return docs.select(F.col(text).alias("__text"), *names).mapInArrow(released(predicted), schema)


def _rows_with(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows have a byte that is flagged."""
    at = np.flatnonzero(flags)
    return np.searchsorted(at, offsets[1:]) > np.searchsorted(at, offsets[:-1])
