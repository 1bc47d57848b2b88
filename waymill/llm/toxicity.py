"""Toxicity by the nearest labelled examples, with a block-max inverted index."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialize, new_folder
from .arrays import released

_PUNCTUATION = b".,;:!?\"'()[]{}<>*#%&$|-_/"
_FLUSH = 200_000


def terms_of(text: str | None) -> list[bytes]:
    """Words of a text in lower case (A-Z), without punctuation at their ends."""
    return [w.strip(_PUNCTUATION) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()]


@dataclass(frozen=True)
class ToxicityModel:
    """Labelled examples as unit TF-IDF vectors in a block-max inverted index.

    Examples are in blocks of ``block``; for each term, ``block_max`` holds the largest weight in each
    block and ``starts`` where the term's postings of each block begin in ``examples`` and ``weights``.
    """

    terms: dict[bytes, int]
    idf: np.ndarray
    block: int
    ids: np.ndarray
    labels: np.ndarray
    block_max: np.ndarray
    starts: np.ndarray
    examples: np.ndarray
    weights: np.ndarray
    neighbours: int
    steps: np.ndarray
    rates: np.ndarray
    no_evidence: float

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a text that the model knows, and their weights in its unit TF-IDF vector."""
        known = self.terms
        counts = Counter(known[t] for t in terms_of(text) if t in known)
        if not counts:
            return np.empty(0, np.int64), np.empty(0)
        terms = np.array(sorted(counts))
        weights = np.array([1 + math.log(counts[t]) for t in terms.tolist()]) * self.idf[terms]
        return terms, weights / math.sqrt(float(weights @ weights))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The nearest examples and their cosines, exactly; of equal ones the first in the index.

        Blocks are looked at in order of the most that any of their examples can reach; the search ends
        when no block left can reach the cosines found.
        """
        bound = weights @ self.block_max[terms]
        best = np.empty(0), np.empty(0, np.int64)
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or len(best[0]) == self.neighbours and bound[b] < best[0][-1] - 1e-9:
                break
            found = np.zeros(self.block)
            for t, w in zip(terms.tolist(), weights.tolist()):
                some = slice(self.starts[t, b], self.starts[t, b + 1])
                found[self.examples[some] - b * self.block] += w * self.weights[some]
            at = np.flatnonzero(found)
            cosines, at = np.round(np.concatenate((best[0], found[at])), 9), np.concatenate((best[1], at + b * self.block))
            there = at != without
            cosines, at = cosines[there], at[there]
            order = np.lexsort((at, -cosines))[: self.neighbours]
            best = cosines[order], at[order]
        return best[1], best[0]

    def vote(self, cosines: np.ndarray, labels: np.ndarray) -> float:
        """Share of the toxic ones among the neighbours, each weighing its squared cosine."""
        return float((cosines**2) @ labels / (cosines**2).sum())

    def score(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        """The calibrated probability of label 1, and the examples that speak for it with their cosines."""
        terms, weights = self.vector(text)
        if not len(terms):
            return self.no_evidence, np.empty(0, np.int64), np.empty(0)
        at, cosines = self.nearest(terms, weights)
        if not len(at):
            return self.no_evidence, at, cosines
        vote = self.vote(cosines, self.labels[at])
        return float(self.rates[np.searchsorted(self.steps, vote, side="right") - 1]), self.ids[at], cosines


def increasing_rates(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing step function from vote to rate of label 1 with least squares (adjacent violators are pooled).

    Each step is shrunk by half a case of either label.  The first step holds below it, too.
    """
    order = np.argsort(votes, kind="stable")
    pools: list[list[float]] = []
    for v, y in zip(votes[order].tolist(), labels[order].tolist()):
        if pools and pools[-1][0] == v:
            pools[-1][1] += y
            pools[-1][2] += 1
        else:
            pools.append([v, y, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, y1, n1 = pools.pop()
            pools[-1][1] += y1
            pools[-1][2] += n1
    if not pools:
        return np.array([-1.0]), np.array([0.5])
    steps = np.array([p[0] for p in pools])
    steps[0] = -1.0
    return steps, np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])


def _association(toxic: str, all_: str, n_toxic: int, n_all: int):
    """The likelihood ratio statistic of a term's presence against the label, as SQL."""
    cells = (
        (toxic, f"{n_toxic}d", all_),
        (f"({all_} - {toxic})", f"{n_all - n_toxic}d", all_),
        (f"({n_toxic} - {toxic})", f"{n_toxic}d", f"({n_all} - {all_})"),
        (f"({n_all} - {all_} - {n_toxic} + {toxic})", f"{n_all - n_toxic}d", f"({n_all} - {all_})"),
    )
    parts = [f"if({o} > 0, {o} * ln({o} * {n_all}d / ({row} * {col})), 0)" for o, row, col in cells]
    return F.expr(f"2 * ({' + '.join(parts)})")


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) → (term, toxic, n): in how many texts of the task a term is."""
    every: Counter = Counter()
    toxic: Counter = Counter()

    def rows() -> pa.RecordBatch:
        names = list(every)
        arrays = [pa.array(names, pa.binary()), pa.array([toxic[t] for t in names], pa.int64()), pa.array([every[t] for t in names], pa.int64())]
        every.clear()
        toxic.clear()
        return pa.RecordBatch.from_arrays(arrays, names=["term", "toxic", "n"])

    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            terms = set(terms_of(text.as_py())) - {b""}
            every.update(terms)
            if label:
                toxic.update(terms)
            if len(every) > _FLUSH:
                yield rows()
    yield rows()


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_examples: int = 20_000,
    max_terms: int = 4_096,
    least_association: float = 20.0,
    least_lift: float = 2.0,
    neighbours: int = 15,
    block: int = 64,
) -> ToxicityModel:
    """A model from labelled documents; ``labels`` has keys and labels of 0 and 1, and holds no row that must not be learnt from.

    It is fitted on at most ``max_examples`` labelled keys, those whose hash is smallest (all, where there are
    fewer); that bounds what is sent to every task.  Its terms are the words whose presence goes with
    label 1: by the likelihood ratio statistic at least ``least_association``, ``least_lift`` times as
    frequent there, at most ``max_terms`` of them.  How many documents hold a term is counted over all of
    ``docs``.  Votes are calibrated on the examples, each without itself among its neighbours.

    Rows with a null key or label are not learnt from; of several labels of one key the largest counts.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(key).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("__label"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(max_examples).toArrow()
    chosen = spark.createDataFrame(chosen, "__id bigint, __label int")
    # At most max_examples rows of two numbers are broadcast.
    examples = docs.select(F.col(key).cast("bigint").alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    examples = examples.dropDuplicates(["__id"]).select("__id", "__label", "__text")
    examples = materialize(examples, new_folder(spark, "examples"))
    n_all, n_toxic = examples.agg(F.count("*"), F.coalesce(F.sum("__label"), F.lit(0))).first()
    terms: dict[bytes, int] = {}
    if 0 < n_toxic < n_all:
        present = examples.select("__label", "__text").mapInArrow(released(_presence), "term binary, toxic bigint, n bigint")
        present = present.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
        lift = F.col("toxic") / F.col("n") >= least_lift * n_toxic / n_all
        strength = _association("toxic", "n", int(n_toxic), int(n_all))
        present = present.filter("toxic > 1").withColumn("g", strength).filter(lift & (F.col("g") >= least_association))
        rows = present.orderBy(F.desc("g"), "term").limit(max_terms).collect()
        terms = {bytes(row["term"]): i for i, row in enumerate(rows)}

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            for value in batch.column(0):
                seen += 1
                for t in terms.keys() & set(terms_of(value.as_py())):
                    held[terms[t]] += 1
        at = np.append(np.flatnonzero(held), -1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(held[at[:-1]], seen))], names=["term", "n"])

    idf = np.ones(len(terms))
    if terms:
        counts = docs.select(text).mapInArrow(released(frequencies), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
        found = {row["term"]: row["n"] for row in counts.collect()}
        total = found.get(-1, 0)
        idf = np.array([1 + math.log((total + 1) / (found.get(i, 0) + 1)) for i in range(len(terms))])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter(terms[t] for t in terms_of(v.as_py()) if t in terms) for v in batch.column(2)]
            arrays = [
                *batch.columns[:2],
                pa.array([list(c.keys()) for c in counts], pa.list_(pa.int32())),
                pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "terms", "counts"])

    rows = examples.mapInArrow(released(counted), "id bigint, label int, terms array<int>, counts array<int>").toArrow().to_pylist()
    return _indexed(rows, terms, idf, neighbours, block)


def _indexed(rows: list[dict], terms: dict[bytes, int], idf: np.ndarray, neighbours: int, block: int) -> ToxicityModel:
    """The index over examples (``id``, ``label``, ``terms``, ``counts``), calibrated on the same."""
    labels = np.array([r["label"] for r in rows], np.float64)
    empty = np.array([not r["terms"] for r in rows], bool)
    no_evidence = (labels[empty].sum() + 0.5) / (empty.sum() + 1) if len(rows) else 0.5
    # Examples with the same strongest term stand together, which keeps the blocks' bounds low.
    rows = [r for r in rows if r["terms"]]
    rows.sort(key=lambda r: (max(zip((idf[t] for t in r["terms"]), r["terms"])), r["id"]))
    n, blocks = len(rows), -(-len(rows) // block)
    post: list[list[tuple[int, float]]] = [[] for _ in terms]
    vectors = []
    for i, r in enumerate(rows):
        at = np.array(sorted(zip(r["terms"], r["counts"])))
        w = (1 + np.log(at[:, 1])) * idf[at[:, 0]]
        w = w / math.sqrt(float(w @ w))
        vectors.append((at[:, 0], w))
        for t, x in zip(at[:, 0].tolist(), w.tolist()):
            post[t].append((i, x))
    block_max, starts = np.zeros((len(terms), blocks)), np.zeros((len(terms), blocks + 1), np.int32)
    examples = np.array([i for p in post for i, _ in p], np.int64)
    weights = np.array([x for p in post for _, x in p])
    at = 0
    for t, p in enumerate(post):
        own = np.array([i for i, _ in p], np.int64)
        starts[t] = at + np.searchsorted(own, np.arange(blocks + 1) * block)
        if len(p):
            np.maximum.at(block_max[t], own // block, weights[at : at + len(p)])
        at += len(p)
    kept = np.array([r["label"] for r in rows], np.float64)
    model = ToxicityModel(
        terms, idf, block, np.array([r["id"] for r in rows], np.int64), kept, block_max, starts, examples, weights,
        neighbours, np.array([-1.0]), np.array([no_evidence]), float(no_evidence),
    )
    votes, truth = [], []
    for i in range(n):
        near, cosines = model.nearest(*vectors[i], without=i)
        if len(near):
            votes.append(model.vote(cosines, kept[near]))
            truth.append(kept[i])
    steps, rates = increasing_rates(np.array(votes), np.array(truth))
    return ToxicityModel(**{**model.__dict__, "steps": steps, "rates": rates})


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents with ``score``, ``predicted`` and ``evidence``, the nearest examples with their cosines.

    Whole texts are scored.  A null or empty text, and one without any of the model's terms, has no
    evidence and the rate of label 1 among such examples as its score.  Equal texts get equal
    scores.  Input columns with these names are replaced.  An empty table gives an empty result.
    """
    added = ("score", "predicted", "evidence")
    kept = [f for f in docs.schema.fields if f.name not in added]
    evidence = "evidence array<struct<example: bigint, cosine: double>>"
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["score double", "predicted int", evidence])
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    pair = pa.struct([("example", pa.int64()), ("cosine", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        place = names.index(text)
        for batch in batches:
            results = [fitted.score(value.as_py()) for value in batch.column(place)]
            arrays = [
                *batch.columns,
                pa.array([s for s, _, _ in results], pa.float64()),
                pa.array([int(s >= threshold) for s, _, _ in results], pa.int32()),
                pa.array([[{"example": i, "cosine": c} for i, c in zip(a.tolist(), w.tolist())] for _, a, w in results], pa.list_(pair)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *added])

    return docs.select(*names).mapInArrow(released(scored), schema)
