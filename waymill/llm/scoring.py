"""Score documents by a recurrent language model trained on the corpus."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import released, row_blocks
from .recurrent import Network, score_texts, train

# No word is empty, so that the empty word can stand for a text's end.
END = b""
_BYTES = 1 << 24
_TOKENS = 4_000_000
_SLICE = 1 << 14


def _blocks(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches of up to about ``size`` bytes in a column: small ones together, large ones in parts; a row beyond it is by itself."""
    held: list[pa.RecordBatch] = []
    filled = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(lengths + 16)))
        for first, last in row_blocks(offsets, size):
            more = int(offsets[last] - offsets[first])
            if held and filled + more > size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, filled = [], 0
            held.append(batch.slice(first, last - first))
            filled += more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in lower case (A-Z), one text's after another's, and the number each text has; null has none."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    offsets = split.offsets.to_numpy()
    words = split.values.slice(offsets[0], offsets[-1] - offsets[0])
    # Space at a text's ends leaves an empty piece there.
    there = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(there.to_numpy(zero_copy_only=False))))
    return words.filter(there).cast(pa.binary()), np.diff(before[offsets - offsets[0]])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, "text", _BYTES):
        counts = words_of(block.column("text"))[0].value_counts()
        yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([len(block)], pa.int64())], names=["word", "n"])


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent words with their counts, and sums over all words.

    ``words`` and ``counts`` have one order, in which ``end`` is the place of the end; some of them (the end among them) have
    outputs of their own in the network, as ``ids``; all other words share the output ``other``.
    """

    words: pa.Array
    end: int
    counts: np.ndarray
    ids: np.ndarray
    other: int
    total: int
    distinct: int

    @property
    def kind(self) -> type:
        """The type of stored output ids."""
        return np.uint16 if self.ids.max() < 1 << 16 and self.other < 1 << 16 else np.int32

    @property
    def own(self) -> np.ndarray:
        return self.ids != self.other

    @property
    def base(self) -> float:
        """log10 of what smoothed counts are divided by."""
        return float(np.log10(self.total + 0.5 * (self.distinct + 1)))

    @property
    def rest(self) -> float:
        """log10 of the smoothed counts of all words without an output of their own, one unknown word among them."""
        held = self.counts[self.own & (self.counts > 0)]
        return float(np.log10(self.total + 0.5 * (self.distinct + 1) - (held + 0.5).sum()))


def build_vocabulary(counts: DataFrame, head: int, outputs: int) -> tuple[Vocabulary, np.ndarray]:
    """The vocabulary of stored counts (``word``, ``n``), and the counts behind each output of the network."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(head).toArrow()
    words, numbers = [bytes(w) for w in top["word"].to_pylist()], top["n"].to_numpy().astype(np.int64)
    if END not in words:
        # The end has an output of its own, however rare it is.
        row = counts.filter(F.col("word") == F.lit(bytearray(END))).first()
        words, numbers = [*words, END], np.append(numbers, row["n"] if row else 0)
    chosen = list(range(min(outputs - 2, len(words))))
    if words.index(END) not in chosen:
        chosen.append(words.index(END))
    weights = [(numbers[i] + 0.5, i) for i in chosen]
    rest = float(total + 0.5 * (distinct + 1) - sum(w for w, _ in weights))
    order = sorted([*weights, (max(rest, 0.5), -1)], key=lambda x: (-x[0], x[1]))
    other = next(k for k, (_, i) in enumerate(order) if i < 0)
    ids = np.full(len(words), other, np.int32)
    for k, (_, i) in enumerate(order):
        if i >= 0:
            ids[i] = k
    vocabulary = Vocabulary(pa.array(words, pa.binary()), words.index(END), numbers, ids, other, int(total), int(distinct))
    return vocabulary, np.array([w for w, _ in order])


def _encoded(known: Vocabulary, column: pa.Array) -> dict[str, pa.Array]:
    """What the vocabulary says of each text: output ids, numbers of tokens and known ones, both scores' sums over the head, other words."""
    words, sizes = words_of(column)
    ranks = pc.fill_null(pc.index_in(words, value_set=known.words), -1).to_numpy()
    of = np.repeat(np.arange(len(sizes)), sizes)

    def summed(head: np.ndarray, outside: float) -> np.ndarray:
        return np.bincount(of, np.append(head, outside)[ranks], len(sizes))

    smoothed, there = np.log10(known.counts + 0.5), known.counts > 0
    base = summed(smoothed, 0) + smoothed[known.end] - (sizes + 1) * known.base
    score = summed(np.where(known.own, 0, smoothed - known.rest), -known.rest)
    outside = ranks < 0
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of[outside], minlength=len(sizes)))))
    ids = np.append(known.ids, known.other).astype(known.kind)[ranks]
    places = np.concatenate(([0], np.cumsum(sizes))) * ids.itemsize
    return {
        "ids": pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)]),
        "n_tokens": pa.array(sizes + 1, pa.int64()),
        "n_known": pa.array((summed(there, 0) + there[known.end]).astype(np.int64)),
        "base": pa.array(base),
        "score": pa.array(score),
        "others": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.filter(pa.array(outside))),
    }


def _stored(column: pa.Array, kind: type) -> list[np.ndarray]:
    """The output ids of each text."""
    return [np.frombuffer(value.as_py(), kind) for value in column]


def train_network(docs: DataFrame, kind: type, net: Network, rounds: Iterable[int]) -> Network:
    """Train on the documents (``ids``, ``part``) whose part is the number of the round, for each of the rounds in turn.

    Every task trains on its own share from the same start; parameters are averaged, weighted by tokens, in slices: those of 32
    tasks at a time, then 32 of these, so that a slice of some tasks is held at once and not one of all.
    Only one set of parameters passes through the driver.
    """
    spark = docs.sparkSession
    schema = "slice int, bundle int, weight double, numbers binary"

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        weight = frame["weight"].sum()
        sums = sum(w * np.frombuffer(x, np.float32) for w, x in zip(frame["weight"], frame["numbers"])) / weight
        row = (frame["slice"].iloc[0], frame["bundle"].iloc[0], weight, sums.astype(np.float32).tobytes())
        return pd.DataFrame([row], columns=list(frame.columns))

    for turn in rounds:
        shared = spark.sparkContext.broadcast(net)

        def trained(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            current, tokens = shared.value, 0
            for block in _blocks(batches, "ids", _TOKENS * np.dtype(kind).itemsize):
                texts = _stored(block.column("ids"), kind)
                current, tokens = train(current, texts), tokens + sum(len(t) + 1 for t in texts)
            if tokens:
                flat = current.flat()
                slices = [flat[i : i + _SLICE].tobytes() for i in range(0, len(flat), _SLICE)]
                n = len(slices)
                arrays = [np.arange(n, dtype=np.int32), np.full(n, TaskContext.get().partitionId(), np.int32), np.full(n, float(tokens))]
                yield pa.RecordBatch.from_arrays([*map(pa.array, arrays), pa.array(slices, pa.binary())], names=["slice", "bundle", "weight", "numbers"])

        results = docs.filter(F.col("part") == turn).select("ids").mapInArrow(released(trained), schema)
        for _ in range(2):
            results = results.withColumn("bundle", F.shiftright("bundle", 5)).groupBy("slice", "bundle").applyInPandas(merged, schema)
        whole = results.groupBy("slice").applyInPandas(merged, schema).orderBy("slice").collect()
        if whole:
            net = net.with_flat(np.concatenate([np.frombuffer(row["numbers"], np.float32) for row in whole]))
    return net


def better_network(docs: DataFrame, kind: type, start: Network, trained: Network) -> Network:
    """The trained network, if it gives these documents (none it has been trained on so far) a higher probability than the counts do."""
    shared = docs.sparkSession.sparkContext.broadcast((start, trained))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, net = shared.value
        for block in _blocks(batches, "ids", _TOKENS * np.dtype(kind).itemsize):
            texts = _stored(block.column("ids"), kind)
            plain = sum(float(counts.frequency_log_p(np.append(t, counts.end)).sum()) for t in texts)
            gain = float(score_texts(net, texts).sum()) - plain
            yield pa.RecordBatch.from_arrays([pa.array([gain], pa.float64())], names=["gain"])

    gain = docs.select("ids").mapInArrow(released(judged), "gain double").agg(F.sum("gain")).first()[0]
    return trained if gain is not None and gain > 0 else start


def score_documents(
    docs: DataFrame,
    learnt_from: Column,
    *,
    key: str = "doc_id",
    text: str = "text",
    head: int = 1 << 18,
    outputs: int = 4096,
    classes: int = 64,
    rounds: int = 8,
    seed: int = 0,
) -> DataFrame:
    """Log10 probabilities of whole documents by smoothed counts (``base_score``) and by the network (``score``).

    Words are counted in all documents for which ``learnt_from`` holds (null counts as false).  A gated
    recurrent network predicts the ``outputs`` most frequent of them, through ``classes`` classes, and one
    output for all others, which share its probability by their smoothed counts.  It starts from the counts and
    is trained on all documents learnt from, dealt to ``rounds`` parts by the hash of their key; each round starts
    from the average of the round before.  Before it learns the last part it is judged on it: where a small corpus
    has not taught it to do better than the counts, it stays as it started.  The counts of the ``head`` most frequent words go to every task;
    all others meet their counts in a join.  Texts are split twice, for the counts and for their output ids; these are stored, and
    all rounds and the scoring read them.

    Result: ``key``, ``n_tokens`` (an end is one), ``n_known`` (with a count), ``train_tokens``, ``base_score``, ``score`` and
    ``scored_by`` (``network``, or ``counts`` where it stays as it started); one row per document.  A null or empty text is an end only.  Repeated rows get equal scores.
    Where there is nothing to learn from, both scores are by the smoothing alone.  A null key is a key like any other (and in one
    part of the training documents); a very long text is read in windows, with its words held once.  An empty table gives an
    empty result.  Other columns are not used.
    """
    spark = docs.sparkSession
    used = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(learnt_from, F.lit(False)).alias("learn"))
    texts = used.filter("learn").select("text")
    counts = texts.mapInArrow(released(_count_words), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts, new_folder(spark, "words"))
    vocabulary, behind = build_vocabulary(counts, head, outputs)
    end, kind = int(vocabulary.ids[vocabulary.end]), vocabulary.kind
    shared = spark.sparkContext.broadcast(vocabulary)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, "text", _BYTES):
            found = _encoded(shared.value, block.column("text"))
            columns = {name: block.column(name) for name in ("key", "learn", "part")} | found
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    key_type = used.schema["key"].dataType.simpleString()
    numbers = "n_tokens bigint, n_known bigint, base double, score double"
    part = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(rounds)).cast("int")
    schema = f"key {key_type}, learn boolean, part int, ids binary, {numbers}, others array<binary>"
    codes = used.select("key", "learn", part.alias("part"), "text").mapInArrow(released(encoded), schema)
    codes = materialize(codes.withColumn("row", F.monotonically_increasing_id()), new_folder(spark, "codes"))

    start = Network.of_counts(behind, end, classes, seed)
    last = rounds - 1
    learn = codes.filter("learn")
    net = train_network(learn, kind, start, range(last))
    net = better_network(learn.filter(F.col("part") == last), kind, start, net)
    if net is not start:
        net = train_network(learn, kind, net, [last])
    model = spark.sparkContext.broadcast(net)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, "ids", _TOKENS * np.dtype(kind).itemsize):
            found = score_texts(model.value, _stored(block.column("ids"), kind)) / np.log(10)
            score = pa.array(block.column("score").to_numpy() + found)
            yield block.drop_columns(["ids", "score"]).append_column("score", score)

    schema = f"row bigint, key {key_type}, {numbers}"
    parts = codes.select("row", "key", "n_tokens", "n_known", "base", "ids", "score").mapInArrow(released(scored), schema)
    parts = materialize(parts, new_folder(spark, "scores"))
    # Each word outside the head meets its count; what it adds is the same for both scores.
    others = codes.select("row", F.explode("others").alias("word"))
    met = match_unique(others, counts, ["word"], "left")
    added = met.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("added"), F.count("n").alias("known")
    )
    whole = parts.join(added, "row", "left")
    extra = F.coalesce("added", F.lit(0.0))
    return whole.select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra).alias("base_score"),
        (F.col("score") + extra).alias("score"),
        F.lit("counts" if net is start else "network").alias("scored_by"),
    )
