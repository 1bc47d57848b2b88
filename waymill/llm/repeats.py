"""Remove long byte strings that occur more than once in the corpus, by suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import U64, mix64, powers, random64, released, text_bytes
from .jaccard import _grouped, _repeated, row_key
from .suffixes import suffix_array

GRAM = 40
_BASE = 0xA0761D6478BD642F
_BYTES = random64(np.arange(256), 21)
_PIECE = 1 << 20
_PLACE = 24
_CELL = 50
# Contexts that one suffix array is built over, occurrences from which an anchor counts as hot, and contexts that one key may have.
_RUN = 20_000
_HOT = 20_000
_MEET = 20_000


@np.errstate(over="ignore")
def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the rows' strings of ``length`` bytes: row, place in the row, hash, and the least and most bytes before it.

    The anchor of a string is, of the ``GRAM``-byte grams in it, the first of those with the least hash;
    so equal strings have their anchor at the same place and with the same hash.  One anchor
    serves all strings of a row that begin from ``most`` to ``least`` bytes before it.
    """
    width = length - GRAM + 1
    found: list[tuple[np.ndarray, ...]] = []
    up, down = powers(_BASE, _PIECE + length), powers(pow(_BASE, -1, 1 << 64), _PIECE + length)
    for first in range(0, len(data) - length + 1, _PIECE):
        last = min(len(data) - length + 1, first + _PIECE)
        part = data[first : last + length - 1]
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(_BYTES[part] * up[: len(part)])))
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1])
        keyed = (grams & ~U64((1 << _PLACE) - 1)) | np.arange(len(grams), dtype=U64)
        # The least of each stretch of grams: the least of a block's end and of the next block's start.
        padded = np.full(-(-len(keyed) // width) * width, ~U64(0), U64)
        padded[: len(keyed)] = keyed
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        count = last - first
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        place = (least & U64((1 << _PLACE) - 1)).astype(np.int64)
        row = np.searchsorted(offsets, np.arange(first, last), side="right") - 1
        inside = np.arange(first, last) + length <= offsets[row + 1]
        start = np.flatnonzero(inside & np.concatenate(([True], (place[1:] != place[:-1]) | ~inside[:-1] | (row[1:] != row[:-1]))))
        end = np.flatnonzero(inside & np.concatenate(((place[1:] != place[:-1]) | ~inside[1:] | (row[1:] != row[:-1]), [True])))
        at = place[start]
        found.append((row[start], at + first - offsets[row[start]], grams[at], at - end, at - start))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _ordered(texts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The order of rows of bytes, each filled up with zeros and known by its size, from the suffix array of all of them in cells."""
    rows, width = texts.shape
    cells = -(-width // _CELL)
    padded = np.zeros((rows, cells * _CELL), np.uint8)
    padded[:, :width] = texts
    # Ranks of the cells' contents take the place of the contents.
    flat = np.ascontiguousarray(padded.reshape(rows * cells, _CELL)).view(f"S{_CELL}").ravel()
    _, ranks = np.unique(flat, return_inverse=True)
    line = np.zeros((rows, cells + 2), np.int64)
    line[:, :cells] = ranks.reshape(rows, cells) + 2 + width
    line[:, cells] = sizes + 1
    starts = np.array(suffix_array(line.ravel().tolist()))
    starts = starts[starts % (cells + 2) == 0]
    return starts // (cells + 2)


def _breaks(texts: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For rows in order, how many first bytes each has in common with the one before it."""
    now, last = texts[order[1:]], texts[order[:-1]]
    differ = np.concatenate((now != last, np.ones((len(now), 1), bool)), axis=1).argmax(axis=1)
    return np.concatenate(([0], np.minimum(differ, np.minimum(sizes[order[1:]], sizes[order[:-1]]))))


def repeated_starts(group: np.ndarray, left: list[bytes], right: list[bytes], least: np.ndarray, times: np.ndarray, length: int) -> np.ndarray:
    """Which strings of ``length`` bytes around anchors occur twice or more.

    A context is the bytes before and from its anchor; in one group anchors are the same.  The string that
    begins l bytes before the anchor occurs again if another context of the group has the same l bytes before and
    length - l bytes from the anchor: two suffix arrays, of the bytes from the anchors and of the reversed
    bytes before them, with their common lengths show which have.  ``least`` is the least l to look at, ``times`` how often a
    context occurs.  Result: rows are contexts, columns are l.
    """
    n = len(group)
    most = np.array([len(x) for x in left])
    far = np.array([len(x) for x in right])
    widths = max(1, int(most.max())), max(1, int(far.max()))
    sides = []
    for texts, sizes, width in ((right, far, widths[1]), ([x[::-1] for x in left], most, widths[0])):
        filled = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in texts), np.uint8).reshape(n, width)
        order = _ordered(filled, sizes)
        order = order[np.argsort(group[order], kind="stable")]
        common = _breaks(filled, sizes, order)
        common[np.concatenate(([True], group[order[1:]] != group[order[:-1]]))] = -1
        sides.append((order, common))
    result = np.zeros((n, int(most.max()) + 1), bool)
    (right_order, right_common), (left_order, left_common) = sides
    from_anchor, to_anchor = np.empty(n, np.int64), np.empty(n, np.int64)
    for l in range(int(least.min()), int(most.max()) + 1):
        some = np.flatnonzero((least <= l) & (l <= most))
        if not len(some):
            continue
        from_anchor[right_order] = np.cumsum(right_common < length - l)
        to_anchor[left_order] = np.cumsum(left_common < l)
        classes = from_anchor[some] * (n + 1) + to_anchor[some]
        _, of = np.unique(classes, return_inverse=True)
        result[some, l] = np.bincount(of, weights=times[some])[of] > 1
    return result


def _covered(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches joined where they overlap or touch: starts and ends of the maximal ones."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]


def _whole_characters(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """What is left without the stretches, which are narrowed so that no character is cut."""
    data = np.frombuffer(raw, np.uint8)
    inner = (data & 0xC0) == 0x80
    keep = np.ones(len(data), bool)
    for s, e in zip(starts.tolist(), ends.tolist()):
        while s < e and inner[s]:
            s += 1
        while e > s and e < len(data) and inner[e]:
            e -= 1
        keep[s:e] = False
    return data[keep].tobytes()


def _number(*parts: bytes) -> int:
    joined = hashlib.blake2b(digest_size=8)
    for p in parts:
        joined.update(len(p).to_bytes(8, "little") + p)
    return int.from_bytes(joined.digest(), "little", signed=True)


_CONTEXT = ("key", "digest", "least", "before", "after", "times")


def _parts(length: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each context in parts of at most ``width`` of its strings, under keys that name the bytes which all strings of a part have.

    Parts begin at multiples of the width, so that equal strings fall into parts alike whatever else their contexts hold.
    """

    def divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_CONTEXT, "of_key", "of_digest"]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            rows = []
            for key, digest, least, before, after, times in zip(*(c.to_pylist() for c in batch.columns)):
                most = len(before)
                for low in range(least - least % width, most + 1, width):
                    a, b = max(least, low), min(most, low + width - 1)
                    left, right = before[most - b :], after[: length - a]
                    name = _number(str((key, low)).encode(), left[b - low :], right[: max(0, length - low - width + 1)])
                    rows.append((name, _number(left, right), a, left, right, times, key, digest))
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return divided


def divided_contexts(spark: SparkSession, contexts: DataFrame, length: int) -> tuple[DataFrame, list[DataFrame]]:
    """Contexts such that no key has more than ``_MEET`` of them, and for each division which contexts are parts of which.

    A passage shorter than ``length`` that stands in very many documents gives its anchors as many different contexts.  Those of
    such a key are divided by how far before the anchor their strings begin, finer and finer: the fewer strings, the more bytes are common
    to all of them, and contexts in which these differ part.  With one string left, equal keys are equal contexts, and these are one row.
    """
    whole: list[DataFrame] = []
    links: list[DataFrame] = []
    # The bands of hot anchors are at most half as wide as the strings are long; only narrower parts take them further.
    for i in reversed(range(length.bit_length() - 2)):
        sizes = contexts.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > _MEET).select("key", F.lit(True).alias("large"))
        large = materialize(sizes, new_folder(spark, "large-keys"))
        if large.isEmpty():
            break
        marked = match_unique(contexts, large, ["key"], "left")
        whole.append(marked.filter("large is null").select(*_CONTEXT))
        schema = "key bigint, digest bigint, least int, before binary, after binary, times bigint, of_key bigint, of_digest bigint"
        parts = marked.filter("large").select(*_CONTEXT).mapInArrow(released(_parts(length, 1 << i)), schema)
        parts = materialize(parts, new_folder(spark, "parts"))
        links.append(parts.select("key", "digest", "of_key", "of_digest").dropDuplicates())
        # Equal contexts become one row, within the tasks first.
        same = parts.groupBy("key", "digest", "least").agg(*(F.any_value(c).alias(c) for c in ("before", "after")), F.sum("times").alias("times"))
        contexts = materialize(same.select(*_CONTEXT), new_folder(spark, "contexts"))
    return reduce(DataFrame.union, [*whole, contexts]), links


def repeated_strings(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """Per document: ``key``, ``n_bytes``, ``spans``, ``kept_sha256``, ``kept_text`` and ``row_key``.

    ``spans`` (``start``, ``end``) are the maximal runs of bytes covered by strings of ``length`` bytes that also start
    anywhere else, in the same document or another; all strings are judged on the whole input.
    ``kept_sha256`` is of the bytes left; ``kept_text`` is the text left where there are spans (else null), without
    cutting characters: a run that begins or ends within a character leaves that character in.
    ``row_key`` tells rows with another key or text apart, to join by.

    1. Every string of ``length`` bytes has one anchor, a gram within it that depends on its bytes only.  Anchors that
       occur once in the corpus, by hash, serve no repeated string; equal texts count once here, as a text that
       occurs twice is removed whole.
    2. Contexts of the other anchors, as far as their strings reach, meet by anchor; equal ones are counted and
       handled once.  Suffix arrays over them show which strings occur again (``repeated_starts``).
    3. An anchor with very many contexts is divided by how far before it a string begins, to powers of two,
       and by the bytes that all such strings have: what is alike there falls together, and what differs goes apart.  Keys that have
       very many contexts still are divided further (``divided_contexts``), so that no task holds more than some thousands together.

    A null text counts as empty; texts shorter than ``length`` have no spans.  Repeated rows repeat each other's
    strings.  Null keys are kept as they are.  Other columns are not used.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    if length <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")

    def stored(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, new_folder(spark, name))

    found = "struct<hash: bigint, at: int, least: int, most: int>"
    arrow_found = pa.struct([("hash", pa.int64()), ("at", pa.int32()), ("least", pa.int32()), ("most", pa.int32())])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            row, at, hashes, least, most = anchors(data, offsets, length)
            values = pa.StructArray.from_arrays(
                [pa.array(hashes.view(np.int64)), *(pa.array(x.astype(np.int32)) for x in (at, least, most))], fields=list(arrow_found)
            )
            cuts = pa.array(np.searchsorted(row, np.arange(len(offsets))).astype(np.int32))
            sizes = pa.array(np.diff(offsets))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], sizes, batch.column(3), pa.ListArray.from_arrays(cuts, values)], names=["id", "row_key", "n", "digest", "anchors"]
            )

    id_type = docs.schema[key].dataType.simpleString()
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(key).alias("id"), row_key(key, text).alias("row_key"), whole.alias("text"))
    hashed = keyed.select("*", F.unhex(F.sha2("text", 256)).alias("digest"))
    sketch = hashed.mapInArrow(released(sketched), f"id {id_type}, row_key binary, n bigint, digest binary, anchors array<{found}>")
    sketch = stored(sketch.withColumn("row", F.monotonically_increasing_id()), "sketch")
    classes = sketch.groupBy("digest").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
    classes = stored(classes, "classes")
    chosen = sketch.join(classes.select("row"), "row").select(F.explode("anchors").alias("a"), "row")
    spread = chosen.select("a.hash", "a.at", "a.least", "a.most", "row").repartition("hash").sortWithinPartitions("hash")
    shared = stored(spread.mapInArrow(released(_repeated), "hash bigint, at int, least int, most int, row bigint"), "shared")
    hot = shared.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > _HOT).select("hash", F.lit(True).alias("hot"))
    marked = match_unique(shared, hot, ["hash"], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    marks = marked.groupBy("row").agg(F.collect_list(F.struct("hash", "at", "least", "most", "hot")).alias("marks"))
    reps = sketch.select("row", "row_key").join(marks, "row")
    affected = stored(keyed.select("row_key", "text").join(reps, "row_key").select("row", "text", "marks"), "affected")

    ctx_schema = "key bigint, digest bigint, least int, before binary, after binary, times bigint, row bigint, at int"
    ctx_arrow = pa.schema(
        [("key", pa.int64()), ("digest", pa.int64()), ("least", pa.int32()), ("before", pa.binary()), ("after", pa.binary()),
         ("times", pa.int64()), ("row", pa.int64()), ("at", pa.int32())]
    )

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each distinct context of the batch once, with how often it occurs, and its occurrences."""
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                some = batch.slice(first, 1000)
                distinct: dict[tuple, list] = {}
                rows: list[tuple] = []
                for row, value, marks_ in zip(some.column(0).to_pylist(), some.column(1), some.column(2).to_pylist()):
                    raw = value.as_py().encode("utf-8", "surrogatepass")
                    seen = set()
                    for m in marks_:
                        hash_, at, low, high = m["hash"], m["at"], m["least"], m["most"]
                        if (at, low) in seen:
                            continue
                        seen.add((at, low))
                        if m["hot"]:
                            bands = [(0, 0), *((1 << j, (2 << j) - 1) for j in range(length.bit_length()))]
                            bands = [(max(low, a), min(high, b), _number(str((hash_, a)).encode(), raw[at - a : at + length - b])) for a, b in bands if a <= high and low <= b]
                            bands = [b for b in bands if b[0] <= b[1]]
                        else:
                            bands = [(low, high, hash_)]
                        for a, b, key_ in bands:
                            before, after = raw[at - b : at], raw[at : at + length - a]
                            digest = _number(before, after)
                            held = distinct.get((key_, digest))
                            if held is None:
                                distinct[key_, digest] = [a, before, after, 1]
                            else:
                                held[3] += 1
                            rows.append((key_, digest, None, None, None, None, row, at))
                rows += [(k, d, *v, None, None) for (k, d), v in distinct.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 8, ctx_arrow)], schema=ctx_arrow)

    pieces = stored(affected.mapInArrow(released(contexts), ctx_schema), "contexts")
    meeting, links = divided_contexts(spark, pieces.filter("times is not null").select(*_CONTEXT), length)
    meeting = meeting.repartition("key").sortWithinPartitions("key", "digest")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []

        def rows() -> pa.RecordBatch:
            groups = np.unique([r[0] for r in run], return_inverse=True)[1]
            columns = list(zip(*run))
            again = repeated_starts(groups, columns[3], columns[4], np.array(columns[2]), np.array(columns[5]), length)
            some = np.flatnonzero(again.any(axis=1)).tolist()
            arrays = [
                pa.array([run[i][0] for i in some], pa.int64()), pa.array([run[i][1] for i in some], pa.int64()),
                pa.array([np.flatnonzero(again[i]).tolist() for i in some], pa.list_(pa.int32())),
            ]
            run.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["key", "digest", "offsets"])

        for table in _grouped(batches):
            merged: list[tuple] = []
            for r in zip(*(c.to_pylist() for c in table.columns)):
                if merged and merged[-1][1] == r[1]:
                    merged[-1] = (*r[:5], merged[-1][5] + r[5])
                else:
                    merged.append(r)
            if len(merged) == 1 and merged[0][5] == 1:
                continue
            run.extend(merged)
            if len(run) >= _RUN:
                yield rows()
        if run:
            yield rows()

    results = stored(meeting.mapInArrow(released(judged), "key bigint, digest bigint, offsets array<int>"), "judged")
    # What was found of parts of a context was found of the context.
    for parts in reversed(links):
        of_parts = match_unique(parts, results, ["key", "digest"])
        of_whole = of_parts.groupBy(F.col("of_key").alias("key"), F.col("of_digest").alias("digest"))
        of_whole = of_whole.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("offsets")))).alias("offsets"))
        results = stored(results.union(of_whole), "judged")
    occurrences = pieces.filter("times is null").select("key", "digest", "row", "at")
    hits = match_unique(occurrences, results, ["key", "digest"])
    hits = hits.groupBy("row").agg(F.collect_list(F.struct("at", "offsets")).alias("hits"))
    single = classes.filter("copies = 1").select("row")
    texts = affected.select("row", "text").join(single, "row").join(hits, "row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, value, hits_ in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                raw = value.as_py().encode("utf-8", "surrogatepass")
                begins = np.concatenate([h["at"] - np.array(h["offsets"], np.int64) for h in hits_])
                starts, ends = _covered(begins, begins + length)
                left = hashlib.sha256()
                at = 0
                for s, e in zip(starts.tolist(), ends.tolist()):
                    left.update(raw[at:s])
                    at = e
                left.update(raw[at:])
                spans = [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())]
                kept = _whole_characters(raw, starts, ends).decode("utf-8", "surrogatepass")
                rows.append((row, spans, left.hexdigest(), kept))
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            types = (pa.int64(), pa.list_(span), pa.string(), pa.string())
            columns = zip(*rows) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["row", "spans", "kept_sha256", "kept_text"])

    spans = "array<struct<start: bigint, end: bigint>>"
    cut_rows = stored(texts.mapInArrow(released(cut), f"row bigint, spans {spans}, kept_sha256 string, kept_text string"), "cut")
    done = match_unique(classes, cut_rows, ["row"], "left").drop("row")
    done = match_unique(sketch.select("id", "row_key", "n", "digest"), done, ["digest"])
    gone = (F.col("copies") > 1) & (F.col("n") >= length)
    return done.select(
        F.col("id").alias(key),
        F.col("n").alias("n_bytes"),
        F.when(gone, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))))
        .otherwise(F.coalesce("spans", F.array().cast(spans)))
        .alias("spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        "row_key",
    )
