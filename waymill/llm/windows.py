"""Removal of words whose window of consecutive words occurs earlier, by super-k-mers dealt by their minimisers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import U64, mix64, powers, random64, released, row_blocks, text_bytes, word_spans
from .shingles import word_hashes

# Bytes of text taken at a time, words of a long text taken at a time, and packed bytes that a task gathers before it deals them.
_BLOCK = 1 << 20
_SEGMENT = 1 << 18
_GATHERED = 1 << 24
# Windows of a packed string at most; a word of more bytes travels as its SHA-256.
_RUN = 256
_LONG_WORD = 256
# Packed strings of a bucket, about; and of a minimiser at most before its windows travel singly.
_BUCKET = 50_000
_HOT = 50_000
# The minimisers treated so are at most as many.
_HOT_MOST = 1 << 20
_NO_KEY = np.iinfo(np.int64).max
_BASE = 0x9FB21C651E98DF25


@dataclass
class Runs:
    """Runs of windows: whose they are, at which word they start, how many windows they hold, and what deals them."""

    place: np.ndarray
    mark: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    key: np.ndarray
    digest: np.ndarray
    lengths: np.ndarray
    packed: np.ndarray

    @staticmethod
    def together(parts: list[Runs]) -> Runs:
        return Runs(*(np.concatenate([getattr(p, name) for p in parts]) for name in Runs.__dataclass_fields__))

    def texts(self) -> pa.Array:
        offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.lengths), [None, pa.py_buffer(offsets), pa.py_buffer(self.packed)])


@np.errstate(over="ignore")
def _marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word as it is written; one that is longer than a block is hashed by itself."""
    found, at = np.empty(len(starts), U64), 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + _BLOCK, side="right"))
        if to <= at:
            found[at] = int.from_bytes(hashlib.blake2b(data[starts[at] : ends[at]], digest_size=8).digest(), "little")
            to = at + 1
        else:
            found[at:to] = word_hashes(data[starts[at] : ends[to - 1]], lower=False)[0]
        at = to
    return found


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each starts in that (and where it ends)."""
    sizes = ends - starts
    if len(sizes) and sizes.max() > _LONG_WORD:
        words = [
            bytes(data[a:b]) if b - a <= _LONG_WORD else b"\0" + hashlib.sha256(data[a:b]).hexdigest().encode()
            for a, b in zip(starts.tolist(), ends.tolist())
        ]
        sizes = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    else:
        low = int(starts[0]) if len(starts) else 0
        keep = np.zeros(int(ends[-1]) - low + 1 if len(ends) else 0, np.int8)
        keep[starts - low] += 1
        keep[ends[:-1] - low + 1] -= 1
        inside = np.cumsum(keep, dtype=np.int8).view(bool)
        text = np.append(data[low : low + len(inside) - 1], np.uint8(32))
        text[ends - low] = 32
        text = text[inside]
    return text, np.concatenate(([0], np.cumsum(sizes + 1)))


def _slices(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """values[low:high] of each pair of bounds, one after the other."""
    sizes = high - low
    shift = np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return values[np.arange(int(sizes.sum())) + shift]


def _sums(numbers: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A hash of any span of numbers, by prefix sums over powers."""
    up, down = powers(_BASE, len(numbers) + 1), powers(pow(_BASE, -1, 1 << 64), len(numbers) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(numbers * up[:-1])))

    def of(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((sums[high] - sums[low]) * down[low] + (high - low).astype(U64))

    return of


@np.errstate(over="ignore")
def window_runs(
    place: np.ndarray, mark: np.ndarray, texts: pa.Array, window: int, gram: int, hot: np.ndarray, packed: bool
) -> Iterator[Runs]:
    """The windows of texts in runs that share a minimiser: the least hash of the ``gram`` words at any place in the window.

    Equal windows have equal minimisers wherever they stand.  Those of a ``hot`` minimiser come singly, under
    a hash of the whole window.  Long texts are taken in segments, whose ends only divide runs.
    """
    data, offsets = text_bytes(texts)
    factors = random64(np.arange(gram), 21) | U64(1)
    for first, last in row_blocks(offsets, _BLOCK):
        # A space after each text keeps words from running across.
        own = offsets[first : last + 1] - offsets[first]
        spaced = np.insert(data[offsets[first] : offsets[last]], own[1:], 32)
        all_starts, all_ends = word_spans(spaced)
        bounds = np.searchsorted(all_starts, own + np.arange(len(own)))
        for low in range(0, len(all_starts), _SEGMENT):
            high = min(len(all_starts), low + _SEGMENT + window - 1)
            if high - low < window:
                break
            starts, ends = all_starts[low:high], all_ends[low:high]
            marks = _marks(spaced, starts, ends)
            grams = sum((marks[i : len(marks) - gram + 1 + i] * factors[i] for i in range(gram)), np.zeros(1, U64))
            least, width = mix64(grams), 1
            while width < window - gram + 1:
                step = min(width, window - gram + 1 - width)
                least, width = np.minimum(least[:-step], least[step:]), width + step
            row = np.searchsorted(bounds, np.arange(low, low + len(least)), side="right") - 1
            at = np.flatnonzero(np.arange(low, low + len(least)) + window <= bounds[row + 1])
            if not len(at):
                continue
            key, row = least[at], row[at]
            new = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]) | (key[1:] != key[:-1])))
            if len(hot):
                alone = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
                new |= alone
            begins = np.flatnonzero(new)
            place_in = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
            begins = np.flatnonzero(place_in % _RUN == 0)
            windows = np.diff(np.append(begins, len(at)))
            a, b = at[begins], at[begins] + windows + window - 1
            digest = _sums(marks)(a, b)
            key, row = key[begins], row[begins]
            if len(hot):
                key = np.where(alone[begins], digest, key)
            if packed:
                text, where = _spelled(spaced, starts, ends)
                spelled, lengths = _slices(text, where[a], where[b]), where[b] - where[a]
            else:
                spelled, lengths = np.empty(0, np.uint8), np.zeros(len(a), np.int64)
            whose = first + row
            yield Runs(place[whose], mark[whose], low + a - bounds[row], windows, key, digest, lengths, spelled)


def _gathered(batches: Iterator[pa.RecordBatch], window: int, gram: int, hot: np.ndarray, packed: bool) -> Iterator[Runs]:
    """The runs of (place, mark, text) rows, as many together as fit."""
    parts: list[Runs] = []
    size = 0
    for batch in batches:
        place, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for runs in window_runs(place, mark, batch.column(2), window, gram, hot, packed):
            parts.append(runs)
            size += len(runs.packed) if packed else 180 * len(runs.key)
            if size >= _GATHERED:
                yield Runs.together(parts)
                parts, size = [], 0
    if parts:
        yield Runs.together(parts)


def _repeats(groups: np.ndarray, order: np.ndarray, place: np.ndarray, mark: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of things ordered by group and place: which is the first of its group, and which stands elsewhere than the first.

    What stands at the very place of the first comes from a repeated row, and is no repeat of it.
    """
    names = groups[order]
    new = np.concatenate(([True], names[1:] != names[:-1]))[: len(names)]
    first = order[new][np.cumsum(new) - 1]
    is_first, elsewhere = np.zeros(len(groups), bool), np.zeros(len(groups), bool)
    is_first[order[new]] = True
    elsewhere[order] = (place[order] != place[first]) | (mark[order] != mark[first]) | (start[order] != start[first])
    return is_first, elsewhere


_COVERS = pa.schema([("place", pa.int64()), ("mark", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _covers(place: np.ndarray, mark: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (place, mark, start, end)], schema=_COVERS)


def _apart(runs: Runs, window: int) -> tuple[np.ndarray, pa.RecordBatch]:
    """Of runs with equal texts only the earliest has to travel: which those are, and the words that the others cover."""
    groups = runs.texts().dictionary_encode().indices.to_numpy()
    order = np.lexsort((runs.start, runs.mark, runs.place, groups))
    is_first, again = _repeats(groups, order, runs.place, runs.mark, runs.start)
    return is_first, _covers(runs.place[again], runs.mark[again], runs.start[again], runs.start[again] + runs.windows[again] + window - 1)


def repeated_windows_of(runs: Runs, window: int) -> pa.RecordBatch:
    """The words covered by windows of these runs that occur earlier in them; windows are sorted and compared word by word."""
    words = np.flatnonzero(runs.packed == 32)
    offsets = np.concatenate(([0], words + 1)).astype(np.int64)
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(runs.packed)])
    ids = spelled.dictionary_encode().indices.to_numpy().astype(np.int64)
    counts = runs.windows + window - 1
    firsts = np.cumsum(counts) - counts
    # Runs in order of place, so that windows need to be sorted by their words only.
    by_place = np.lexsort((runs.start, runs.mark, runs.place))
    each = runs.windows[by_place]
    run = np.repeat(by_place, each)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(each) - each, each)
    at, start = firsts[run] + offset, runs.start[run] + offset
    groups = _sums(random64(ids, 22))(at, at + window)
    order = np.argsort(groups, kind="stable")
    same = np.flatnonzero(groups[order[1:]] == groups[order[:-1]])
    one, other = at[order[same]], at[order[same + 1]]
    if not all((ids[one + i] == ids[other + i]).all() for i in range(window)):
        # Different windows have met in one hash: number them by their words.
        groups = np.unique(ids[at[:, None] + np.arange(window)], axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(groups, kind="stable")
    gone = np.flatnonzero(_repeats(groups, order, runs.place[run], runs.mark[run], start)[1])
    # Neighbouring windows of a run become one span.
    new = np.flatnonzero(np.concatenate(([True], (run[gone[1:]] != run[gone[:-1]]) | (gone[1:] != gone[:-1] + 1)))[: len(gone)])
    begin, end = gone[new], gone[np.append(new, len(gone))[1:] - 1]
    return _covers(runs.place[run[begin]], runs.mark[run[begin]], start[begin], start[end] + window)


_NUMBERS = ("place", "mark", "start", "windows", "lengths")


def _boxed(runs: Runs, some: np.ndarray, where: np.ndarray) -> pa.Buffer:
    """The chosen runs as one compressed text: five columns of numbers, then the packed strings."""
    columns = [getattr(runs, name)[some].astype(np.int64) for name in _NUMBERS]
    return pa.compress(b"".join([*(c.tobytes() for c in columns), _slices(runs.packed, where[some], where[some + 1]).tobytes()]), codec="zstd")


def _opened(box: bytes, size: int, n: int) -> Runs:
    raw = np.frombuffer(pa.decompress(box, decompressed_size=size, codec="zstd"), np.uint8)
    numbers = raw[: 40 * n].view(np.int64).reshape(5, n)
    none = np.empty(0, U64)
    return Runs(numbers[0], numbers[1], numbers[2], numbers[3], none, none, numbers[4], raw[40 * n :])


def repeated_windows(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 20, gram: int = 5
) -> DataFrame:
    """Per document: ``key``, ``n_words``, the spans of words removed, ``kept_text`` (words joined by one space) and its SHA-256.

    A word goes if a window of ``window`` consecutive words that covers it has a word sequence that also starts earlier:
    in a document with a smaller key, or earlier in its own.  Windows are judged on the input.  The key is a whole number.

    1. Consecutive windows that share a minimiser (the least hash of ``gram`` words in the window) travel as one packed
       string to the bucket of that minimiser, so that a word is sent about three times and not ``window`` times.  Of equal
       strings of a task only the earliest travels: the others are known to be repeats.
    2. In a bucket the windows are sorted, compared word by word, and all but the earliest of each kind cover their words.
    3. Minimisers are counted first.  Where more than 50,000 strings (or, beyond 5 * 10^10 strings, a millionth of all) share
       one, its windows travel singly and are dealt by a hash of the whole window; only then equal windows still meet, and no
       task gets a whole minimiser's strings.  Of a window a task sends one, so that copies do not gather either.
    4. Spans of covered words meet their texts in a join whose hot keys are split.

    A null text counts as empty and has no window, as have texts with fewer words.  Null keys come after all others, rows with one
    key in the order of their texts' hashes; repeated rows are one document, whose windows are not compared with themselves,
    and each gets its result.  Very long texts are taken in segments; words of more than 256 bytes travel as their SHA-256.
    Other columns are not used; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    if not 0 < gram < window:
        raise ValueError("a minimiser has fewer words than a window")
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.col(key).alias("key"), F.coalesce(F.col(key).cast("bigint"), F.lit(int(_NO_KEY))).alias("place"), whole.alias("text"))
    keyed = keyed.select("key", "place", F.xxhash64("text").alias("mark"), "text")
    rows = keyed.select("place", "mark", "text")
    none = np.empty(0, U64)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _gathered(batches, window, gram, none, packed=False):
            order = np.lexsort((runs.digest, runs.key))
            keys, digests = runs.key[order], runs.digest[order]
            distinct = np.concatenate(([True], (keys[1:] != keys[:-1]) | (digests[1:] != digests[:-1])))
            keys, counts = np.unique(keys[distinct], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])

    total = Observation()
    counts = rows.mapInArrow(released(counted), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    frequent = counts.observe(total, F.sum("n").alias("n")).filter(F.col("n") > _HOT)
    frequent = materialize(frequent, new_folder(spark, "frequent"))
    strings = total.get["n"] or 0
    # So many minimisers at most have more than this share of all strings.
    hot = frequent.filter(F.col("n") > strings // _HOT_MOST).select("key").collect()
    hot = spark.sparkContext.broadcast(np.sort(np.array([r["key"] for r in hot], np.int64).view(U64)))
    buckets = max(1, -(-strings // _BUCKET))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _gathered(batches, window, gram, hot.value, packed=True):
            travels, covers = _apart(runs, window)
            some = np.flatnonzero(travels)
            to = (mix64(runs.key[some]) % U64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            some, to = some[order], to[order]
            cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            where = np.concatenate(([0], np.cumsum(runs.lengths)))
            rows_: list[tuple] = []
            for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(to)]):
                one = some[low:high]
                rows_.append((int(to[low]), high - low, 40 * (high - low) + int(runs.lengths[one].sum()), _boxed(runs, one, where).to_pybytes()))
            if covers.num_rows:
                # What is known already goes along to any bucket.
                raw = b"".join(c.to_numpy().tobytes() for c in covers.columns)
                rows_.append((int(covers.column(1)[0].as_py()) % buckets, -covers.num_rows, len(raw), pa.compress(raw, codec="zstd", asbytes=True)))
            columns = zip(*rows_) if rows_ else [()] * 4
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["bucket", "n", "size", "box"])

    boxes = rows.mapInArrow(released(dealt), "bucket bigint, n int, size bigint, box binary")
    boxes = boxes.repartition("bucket").sortWithinPartitions("bucket")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Runs] = []
        bucket = None
        for batch in batches:
            for to, n, size, box in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                if n < 0:
                    raw = np.frombuffer(pa.decompress(box.as_py(), decompressed_size=size, codec="zstd"), np.int64).reshape(4, -n)
                    yield _covers(*raw)
                    continue
                if to != bucket:
                    if held:
                        yield repeated_windows_of(Runs.together(held), window)
                    held, bucket = [], to
                held.append(_opened(box.as_py(), size, n))
        if held:
            yield repeated_windows_of(Runs.together(held), window)

    covers = boxes.mapInArrow(released(judged), "place bigint, mark bigint, start bigint, end bigint")
    covers = materialize(covers, new_folder(spark, "covers"))
    spans = covers.groupBy("place", "mark").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("covers"))
    met = match_unique(keyed, spans, ["place", "mark"], "left").select("key", "text", "covers")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        types = (pa.int64(), pa.list_(span), pa.string(), pa.string())
        for batch in batches:
            for first in range(0, max(1, batch.num_rows), 1000):
                some = batch.slice(first, 1000)
                results = []
                for value, covers_ in zip(some.column(1), some.column(2).to_pylist()):
                    raw = np.frombuffer(value.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                    starts, ends = word_spans(raw)
                    merged: list[dict] = []
                    for c in covers_ or []:
                        if merged and c["start"] <= merged[-1]["end"]:
                            merged[-1]["end"] = max(merged[-1]["end"], c["end"])
                        else:
                            merged.append(dict(c))
                    kept = np.ones(len(starts), bool)
                    for c in merged:
                        kept[c["start"] : c["end"]] = False
                    left = b" ".join([raw[a:b].tobytes() for a, b in zip(starts[kept].tolist(), ends[kept].tolist())])
                    results.append((len(starts), merged, left.decode("utf-8", "surrogatepass"), hashlib.sha256(left).hexdigest()))
                columns = zip(*results) if results else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=["key", "n_words", "spans", "kept_text", "kept_sha256"]
                )

    kind = docs.schema[key].dataType.simpleString()
    done = met.mapInArrow(
        released(cut), f"key {kind}, n_words bigint, spans array<struct<start: bigint, end: bigint>>, kept_text string, kept_sha256 string"
    )
    return done.withColumnRenamed("key", key)
