"""Near-duplicate documents by an exact Jaccard join of their shingle sets, with R-trees over count vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import U64, released
from .components import connected_components
from .shingles import shingle_sets

GROUPS = 128
_GROUP_BITS = 7
_CELL_BITS = 19
_CELLS = 1 << _CELL_BITS
_SLICE = 1 << 12
_BITS = 1 << 24
# A chunk has about so many documents and shingles at most, so that one fits in a task.
_CHUNK_DOCS = 1024
_CHUNK_SHINGLES = 1 << 20
# Visits that a task merges at a time.
_MERGED = 500_000
# Sets of one shingle that are looked at pair by pair, and rows of one shingle that are held at a time.
_PAIRED = 64
_GROUP = 200_000


def fine_vector(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of the groups that their hashes' first bits name; the more shingles, the more groups.

    There are ``GROUPS`` times a power of two of them, half a shingle to one in each on average.
    """
    bits = max(_GROUP_BITS, len(shingles).bit_length())
    counts = np.bincount((shingles >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    if counts.max(initial=0) > 0xFF:
        raise ValueError("too many shingles with the same first bits")
    return counts.astype(np.uint8)


def coarse(fine: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The counts of fewer groups, each of which takes in as many neighbours."""
    return fine.reshape(groups, -1).sum(axis=1, dtype=np.int64)


def overlap_bound(one: np.ndarray, other: np.ndarray) -> int:
    """The most shingles that two sets can have in common: the smaller counts of each group, summed."""
    groups = min(len(one), len(other))
    return int(np.minimum(coarse(one, groups), coarse(other, groups)).sum())


class CountTree:
    """An R-tree over the count vectors of sets.

    Two sets have at most as many shingles in common as the sum of the smaller counts of each group; for a node
    the counts are the largest of any set below.  Sets are packed by halving along the group in which they
    differ most.
    """

    def __init__(self, points: np.ndarray, percent: int, fan: int = 16):
        self.percent, self.fan = percent, fan
        self.points, self.sizes = points, points.sum(axis=1)
        self.order = np.concatenate(list(self._packed(np.arange(len(points))))) if len(points) else np.empty(0, np.int64)
        self.levels = []
        high, least, most = self.points[self.order], self.sizes[self.order], self.sizes[self.order]
        while len(high) > fan:
            cuts = np.arange(0, len(high), fan)
            high = np.maximum.reduceat(high, cuts)
            least, most = np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)
            self.levels.append((high, least, most))

    def _packed(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        if len(rows) <= self.fan:
            yield rows
            return
        spread = np.concatenate((self.points[rows].var(axis=0), [self.sizes[rows].var() / GROUPS]))
        axis = int(spread.argmax())
        values = self.sizes[rows] if axis == GROUPS else self.points[rows, axis]
        rows = rows[np.argsort(values, kind="stable")]
        # Halves of whole nodes, so that the nodes above are cut where the packing cut.
        middle = -(-len(rows) // (2 * self.fan)) * self.fan
        yield from self._packed(rows[:middle])
        yield from self._packed(rows[middle:])

    def _reach(self, point: np.ndarray, size: int, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which of the vectors may belong to a set that links: by size, and by the bound of the overlap."""
        bound = np.minimum(point, high).sum(axis=1)
        # intersection / union >= p / 100  <=>  (100 + p) * intersection >= p * (both sizes together)
        fits = (100 + self.percent) * bound >= self.percent * (size + least)
        return fits & (100 * most >= self.percent * size) & (100 * size >= self.percent * least)

    def near(self, point: np.ndarray) -> np.ndarray:
        """The sets whose bound allows a link, by falling bound."""
        size = int(point.sum())
        at = None
        for high, least, most in reversed(self.levels):
            at = np.arange(len(high)) if at is None else at[at < len(high)]
            at = at[self._reach(point, size, high[at], least[at], most[at])]
            at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
        rows = self.order if at is None else self.order[at[at < len(self.order)]]
        points, sizes = self.points[rows], self.sizes[rows]
        rows = rows[self._reach(point, size, points, sizes, sizes)]
        return rows[np.argsort(-np.minimum(point, self.points[rows]).sum(axis=1), kind="stable")]


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= percent * (len(one) + len(other) - common)


def possible(fine: list[np.ndarray], percent: int, hosts: int | None = None) -> np.ndarray:
    """Which of the sets may link with another by their count vectors; with ``hosts`` as in ``link_sets``.

    The tree has vectors of few groups; the pairs that it leaves are bounded again by all groups that both have.
    """
    points = np.array([coarse(f) for f in fine]).reshape(len(fine), GROUPS)
    tree, marked = CountTree(points[:hosts], percent), np.zeros(len(points), bool)
    for q in range(hosts or 0, len(points)):
        # What is marked already has a partner, and every partner of it looks for itself.
        if hosts is None and marked[q]:
            continue
        size = int(points[q].sum())
        for row in tree.near(points[q]).tolist():
            both = size + int(tree.sizes[row])
            if row != q and (100 + percent) * overlap_bound(fine[q], fine[row]) >= percent * both:
                marked[q] = marked[row] = True
    return marked


def link_sets(sets: list[np.ndarray], labels: np.ndarray, percent: int, hosts: int | None = None) -> list[tuple[int, int]]:
    """Links that join sets with different labels, enough to connect all that any link connects.

    With ``hosts``, only links between the first so many sets and the others (the guests) are looked for.
    Pairs that are connected already are not verified; all others that the tree cannot rule out are.
    """
    points = np.array([coarse(fine_vector(s)) for s in sets]).reshape(len(sets), GROUPS)
    tree, found, labels = CountTree(points[:hosts], percent), [], labels.copy()
    for q in range(hosts or 0, len(sets)):
        rows = tree.near(points[q])
        rows = rows[labels[rows] != labels[q]]
        while len(rows):
            if linked(sets[q], sets[rows[0]], percent):
                found.append((q, int(rows[0])))
                labels[labels == labels[rows[0]]] = labels[q]
                rows = rows[labels[rows] != labels[q]]
            else:
                rows = rows[1:]
    return found


def _in_slices(values: np.ndarray) -> pa.RecordBatch:
    """An array of fixed length as rows of slices, to be merged with those of other tasks."""
    parts = [values[i : i + _SLICE].tobytes() for i in range(0, len(values), _SLICE)]
    task = TaskContext.get().partitionId()
    arrays = [np.arange(len(parts), dtype=np.int32), np.full(len(parts), task, np.int32)]
    return pa.RecordBatch.from_arrays([*map(pa.array, arrays), pa.array(parts, pa.binary())], names=["slice", "bundle", "numbers"])


_SLICES = "slice int, bundle int, numbers binary"


def _merged_slices(parts: DataFrame, merge: np.ufunc, kind: type) -> np.ndarray:
    """The tasks' arrays merged by a function of numpy, those of 32 tasks at a time, then 32 of these; only the result comes to the driver."""

    def merging(kind: type):
        def merged(frame: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(len(frame["numbers"].iloc[0]) // np.dtype(kind).itemsize, np.int64)
            for x in frame["numbers"]:
                merge(total, np.frombuffer(x, kind), out=total)
            return pd.DataFrame([(frame["slice"].iloc[0], frame["bundle"].iloc[0], total.tobytes())], columns=list(frame.columns))

        return merged

    for level in (kind, np.int64):
        parts = parts.withColumn("bundle", F.shiftright("bundle", 5))
        parts = parts.groupBy("slice", "bundle").applyInPandas(merging(level), _SLICES)
    rows = parts.groupBy("slice").applyInPandas(merging(np.int64), _SLICES).orderBy("slice").collect()
    return np.concatenate([np.frombuffer(row["numbers"], np.int64) for row in rows]) if rows else np.empty(0, np.int64)


def cell_counts(texts: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all texts fall into each of a fixed number of hash cells; it ranks frequent shingles last."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_CELLS, np.uint32)
        for batch in batches:
            for shingles in shingle_sets(batch.column(0), words):
                np.add.at(counts, (shingles >> U64(64 - _CELL_BITS)).astype(np.int64), 1)
        yield _in_slices(counts)

    found = _merged_slices(texts.mapInArrow(released(counted), _SLICES), np.add, np.uint32)
    return np.minimum(found, np.iinfo(np.int32).max).astype(np.int32) if len(found) else np.zeros(_CELLS, np.int32)


def key_bits(keys: DataFrame) -> np.ndarray:
    """A bit table of fixed size over 128-bit keys: a key whose bit is not set is not among them."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(_BITS // 64, np.int64)
        for batch in batches:
            if batch.num_rows:
                at = _bit_of(batch.column(0))
                np.bitwise_or.at(bits, at >> 6, np.left_shift(np.int64(1), at & 63))
        yield _in_slices(bits)

    found = _merged_slices(keys.mapInArrow(released(marked), _SLICES), np.bitwise_or, np.int64)
    return found if len(found) else np.zeros(_BITS // 64, np.int64)


def _bit_of(keys: pa.Array) -> np.ndarray:
    return np.array([int.from_bytes(k[:8], "little") for k in keys.to_pylist()], U64).astype(np.int64) & (_BITS - 1)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by their first column, those whose value another row has; holds back one row at a time."""
    held = None
    paired = False
    for batch in batches:
        whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not whole.num_rows:
            continue
        values = whole.column(0).to_numpy()
        same = values[1:] == values[:-1]
        keep = np.concatenate(([paired], same))
        keep[:-1] |= same
        paired, held = bool(keep[-1]), whole.slice(whole.num_rows - 1)
        yield whole.slice(0, whole.num_rows - 1).filter(pa.array(keep[:-1]))
    if held is not None and paired:
        yield held


def row_key(key: str, text: str) -> Column:
    """128 bits that tell rows with another key or another text apart."""
    shown = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat(shown, F.lit("/"), F.coalesce(F.col(text), F.lit(""))).cast("binary")))


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with the same first column, from rows sorted by it."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        values = table.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            if held and held[0].column(0)[0].as_py() != values[low]:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(low, high - low))
    if held:
        yield pa.concat_tables(held)


def may_link(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """Whether sets that share a shingle may link, by their sizes and the shingle's place in each (``size``, ``place``).

    Shingles stand in one order in all sets, so that two sets have in common at most as many before the shared one as the smaller
    place, and after it as the shorter rest.
    """
    common = np.minimum(one[1], other[1]) + np.minimum(one[0] - one[1], other[0] - other[1])
    return (100 + percent) * common >= percent * (one[0] + other[0])


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return at & 0xFFFFFFFF, at >> 32


def partnered(shingles: np.ndarray, at: np.ndarray, percent: int) -> np.ndarray:
    """Of sets (sorted by a shingle that they have), which may link with another that has it; ``at`` packs place and size.

    All pairs are looked at where up to ``_PAIRED`` sets have the shingle; where more have it, all are kept.
    """
    starts = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1]))[: len(shingles)])
    counts = np.diff(np.append(starts, len(shingles)))
    several = np.repeat(counts, counts)
    keep = several > _PAIRED
    some = np.flatnonzero((several > 1) & ~keep)
    for step in range(1, _PAIRED):
        # What has as many neighbours left in its group.
        some = some[some + step < len(shingles)]
        some = some[shingles[some] == shingles[some + step]]
        if not len(some):
            break
        ok = some[may_link(_unpacked(at[some]), _unpacked(at[some + step]), percent)]
        keep[ok] = keep[ok + step] = True
    return keep


def _partnered(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(shingle, row, at), sorted by shingle → those that may link with another of the same shingle, and how many rows have it.

    The last group of a batch waits for the next; a group that grows beyond ``_GROUP`` rows is passed on as it comes, and is not
    counted further.
    """

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 3
        passing = None

        def chosen(columns: list[np.ndarray], keep: np.ndarray) -> pa.RecordBatch:
            _, of, counts = np.unique(columns[0], return_inverse=True, return_counts=True)
            several = np.minimum(counts, _GROUP)[of] if passing is None else np.full(len(of), _GROUP)
            arrays = [*(c[keep] for c in columns), several[keep].astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["shingle", "row", "at", "several"])

        for batch in batches:
            columns = [np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns)]
            if passing is not None:
                own = int(np.searchsorted(columns[0] != passing, True))
                yield chosen([c[:own] for c in columns], np.ones(own, bool))
                columns = [c[own:] for c in columns]
                if not len(columns[0]):
                    held = columns
                    continue
                passing = None
            if not len(columns[0]):
                continue
            end = int(np.flatnonzero(np.concatenate(([True], columns[0][1:] != columns[0][:-1])))[-1])
            whole, held = [c[:end] for c in columns], [c[end:] for c in columns]
            yield chosen(whole, partnered(whole[0], whole[2], percent))
            if len(held[0]) > _GROUP:
                passing = held[0][0]
                yield chosen(held, np.ones(len(held[0]), bool))
                held = [h[:0] for h in held]
        yield chosen(held, partnered(held[0], held[2], percent))

    return kept


def _visits(percent: int, one_each: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(shingle, row, at, chunk, weight, component), sorted by shingle → which rows are to visit which chunks (``row``, ``chunk``).

    Of two sets of different components that share a shingle and may link, that of the smaller one (by weight, then name) visits the
    other's chunk, unless both are in it.  With ``one_each`` a component sends one set for each shingle, to one chunk:
    of many near copies in many chunks each chunk's component meets another so, and few are left apart for the visits of all
    sets.  Near copies share many shingles and so give the same visits again and again; these are merged in blocks
    before they leave the task.
    """

    def pairs(columns: list[np.ndarray], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, at, chunks = columns
        if len(rows) <= _PAIRED:
            size, place = _unpacked(at)
            ok = may_link((size[:, None], place[:, None]), (size, place), percent)
            go, to = np.nonzero(ok & (rank[:, None] < rank) & (chunks[:, None] != chunks))
            if one_each:
                first = np.unique(rank[go], return_index=True)[1]
                go, to = go[first], to[first]
            return rows[go], chunks[to]
        if one_each:
            first = np.unique(rank, return_index=True)[1]
            top = first[-1]
            go = first[:-1][chunks[first[:-1]] != chunks[top]]
            return rows[go], np.full(len(go), chunks[top])
        places, of = np.unique(chunks, return_inverse=True)
        best = np.zeros(len(places), np.int64)
        np.maximum.at(best, of, rank)
        sent = [(rows[(rank < best[k]) & (of != k)], places[k]) for k in np.flatnonzero(best > 0).tolist()]
        return np.concatenate([r for r, _ in sent]), np.repeat([c for _, c in sent], [len(r) for r, _ in sent])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> pa.RecordBatch:
            rows, chunks = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((chunks, rows))
            rows, chunks = rows[order], chunks[order]
            new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (chunks[1:] != chunks[:-1])))
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows[new]), pa.array(chunks[new])], names=["row", "chunk"])

        held = [np.empty(0, np.int64)] * 6
        last = False
        source = iter(batches)
        while not last:
            batch = next(source, None)
            last = batch is None
            columns = held if last else [np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns)]
            shingles = columns[0]
            starts = np.flatnonzero(np.concatenate(([True], shingles[1:] != shingles[:-1]))) if len(shingles) else np.empty(0, np.int64)
            # The last group may go on in the next batch.
            end = len(shingles) if last or not len(starts) else int(starts[-1])
            held = [c[end:] for c in columns]
            starts = starts[starts < end]
            if not len(starts):
                continue
            components = columns[5][:end]
            mixed = np.minimum.reduceat(components, starts) != np.maximum.reduceat(components, starts)
            ends = np.append(starts[1:], end)
            for low, high in zip(starts[mixed].tolist(), ends[mixed].tolist()):
                rows, at, chunks, weights, names = (c[low:high] for c in columns[1:])
                order = np.lexsort((names, weights))
                rank = np.empty(len(rows), np.int64)
                # Equal ranks for sets of one component.
                rank[order] = np.cumsum(np.concatenate(([0], names[order[1:]] != names[order[:-1]])))
                go, to = pairs([rows, at, chunks], rank)
                if len(go):
                    found.append((go, to))
                    size += len(go)
                if size > _MERGED:
                    yield merged()
                    size = 0
        if found:
            yield merged()

    return visits


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, U64) for x in table.column("shingles").to_pylist()]


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """Per document: ``key``, ``n_shingles`` and ``component_id``, the smallest key that links lead to.

    Two documents link when their sets of ``words``-word shingles have ``percent`` percent or more in common
    (intersection by union), exactly.  Links between equal sets are not looked for one by one: each distinct set is
    handled once.  The steps:

    1. Two sets that link share one of the first fifth or so of their shingles in any common order.  In the
       order used, shingles that are frequent in the corpus come last (by counts in a fixed number of cells), so
       that shared passages do not bring unrelated documents together.
       Sizes and the shingle's place in both sets rule out most pairs that share one: what has no partner left goes no further.
    2. Sets that share such a shingle go to chunks, by that of these shingles which most sets have; in each chunk an R-tree
       over count vectors finds the pairs that may link, and these are verified unless connected already.
    3. Sets that share a shingle with a set of another chunk, may link with it and are not connected with it travel to that
       chunk (those of the smaller component), and are looked up in its R-tree.  Where a shingle's sets were divided to several chunks,
       each component of theirs sends one set first, which connects the parts of large groups; then all that are still apart
       visit.  No possible link is left out.

    A document with fewer words has one shingle; one without words (or null) has none and links with nothing.
    Null keys never are a ``component_id`` unless all keys of a component are null.  Repeated rows are
    linked.  Other columns are not used.  An empty table gives an empty result.
    """
    spark = docs.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, new_folder(spark, name))

    def by_row(one: DataFrame, other: DataFrame) -> DataFrame:
        """Joined by row, always by dealing out both sides: nothing bounds how many rows there are, and rows are no hot keys."""
        return one.join(other.hint("merge"), "row")

    cells = spark.sparkContext.broadcast(cell_counts(docs.select(text), words))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 2000) for whole in batches for i in range(0, whole.num_rows, 2000)):
            sizes, digests, firsts, points = [], [], [], []
            for shingles in shingle_sets(batch.column(2), words):
                n = len(shingles)
                rare = np.argsort(cells.value[(shingles >> U64(64 - _CELL_BITS)).astype(np.int64)], kind="stable")
                sizes.append(n)
                points.append(fine_vector(shingles).tobytes())
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if n else None)
                firsts.append(shingles[rare[: n - (percent * n + 99) // 100 + 1 if n else 0]].view(np.int64))
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(f) for f in firsts]))).astype(np.int32))
            values = pa.array(np.concatenate(firsts) if firsts else np.empty(0, np.int64))
            arrays = [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, values)]
            arrays.append(pa.array(points, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "row_key", "n", "digest", "firsts", "point"])

    id_type = docs.schema[key].dataType.simpleString()
    keyed = docs.select(F.col(key).alias("id"), row_key(key, text).alias("row_key"), F.col(text).alias("text"))
    sketch = keyed.mapInArrow(released(sketched), f"id {id_type}, row_key binary, n bigint, digest binary, firsts array<bigint>, point binary")
    sketch = stored(sketch.withColumn("row", F.monotonically_increasing_id()), "sketch")
    # One row stands for each distinct set: that with the smallest key.
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least")
    classes = sketch.filter("n > 0").groupBy("digest").agg(least).select("digest", F.col("least.row").alias("row"), F.col("least.id").alias("least"))
    classes = stored(classes, "classes")
    chosen = by_row(sketch.select("row", "firsts", "n"), classes.select("row"))
    spread = chosen.select(F.posexplode("firsts").alias("place", "shingle"), "row", "n")
    spread = spread.select("shingle", "row", (F.shiftleft(F.col("place").cast("long"), 32) + F.col("n")).alias("at"))
    spread = spread.repartition("shingle").sortWithinPartitions("shingle")
    shared = stored(spread.mapInArrow(released(_partnered(percent)), "shingle bigint, row bigint, at bigint, several int"), "shared")
    # The chunk of a set: that of its shared shingles which most sets have, so that a group of near copies fills few chunks; large ones are divided.
    block = F.max(F.struct("several", F.xxhash64("shingle").alias("hash"), "shingle"))
    size = F.max(F.col("at").bitwiseAND(0xFFFFFFFF)).alias("n")
    known = stored(shared.groupBy("row").agg(block.alias("block"), size).select("row", F.col("block.shingle").alias("block"), "n"), "known")
    loads = known.groupBy("block").agg(F.count("*").alias("docs"), F.sum("n").alias("load"))
    parts = F.greatest(F.ceil(F.col("docs") / _CHUNK_DOCS), F.ceil(F.col("load") / _CHUNK_SHINGLES))
    divided = match_unique(known, loads.select("block", parts.alias("parts")), ["block"])
    chunk = F.xxhash64("block", F.pmod(F.xxhash64("row"), F.col("parts")))
    placed = divided.select("row", chunk.alias("chunk"))
    # The vectors are attached last, and so sent once.
    placed = stored(by_row(sketch.select("row", "row_key", "point"), placed), "chunks")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """The wanted rows (by ``row_key``) with their shingles, from one pass over the texts.

        A bit table of fixed size keeps nearly all other rows from being shingled and sent; the join is exact.
        """
        bits = spark.sparkContext.broadcast(key_bits(wanted.select("row_key").dropDuplicates()))

        def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = _bit_of(batch.column(0))
                batch = batch.filter(pa.array((bits.value[at >> 6] >> (at & 63) & 1).astype(bool)))
                for first in range(0, batch.num_rows, 500):
                    some = batch.slice(first, 500)
                    raw = [s.tobytes() for s in shingle_sets(some.column(1), words)]
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(raw, pa.binary())], names=["row_key", "shingles"])

        found = keyed.select("row_key", "text").mapInArrow(released(shingled), "row_key binary, shingles binary")
        # A row that is repeated gives one set, however often: first within the tasks.
        found = found.groupBy("row_key").agg(F.any_value("shingles").alias("shingles"))
        return found.join(wanted, "row_key").drop("row_key")

    def points_of(table: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x, np.uint8) for x in table.column("point").to_pylist()]

    # By count vectors first: most sets that share a shingle cannot link, and their shingles are never sent.
    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            marked = pa.array(possible(points_of(table), percent))
            yield from table.select(["chunk", "row"]).filter(marked).combine_chunks().to_batches()

    chunks = placed.select("chunk", "row", "point").repartition("chunk").sortWithinPartitions("chunk")
    hopes = stored(chunks.mapInArrow(released(hopeful), "chunk bigint, row bigint"), "hopes")
    wanted = stored(by_row(placed.select("row", "row_key"), hopes), "wanted")
    sets = sets_of(wanted).select("chunk", "row", "shingles")
    edge_schema = "a bigint, b bigint"

    def edges_of(found: list[tuple[int, int]], rows: np.ndarray) -> pa.RecordBatch:
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(rows[pairs[:, 0]]), pa.array(rows[pairs[:, 1]])], names=["a", "b"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            rows, own = table.column("row").to_numpy(), _sets(table)
            yield edges_of(link_sets(own, rows, percent), rows)

    def meetings_of(labelled: DataFrame, blocks_only: bool) -> DataFrame | None:
        """Links between sets of different components in different chunks, found where sets visit chunks; None without visits."""
        weights = labelled.groupBy("component").agg(F.count("*").alias("weight"))
        weighed = stored(match_unique(labelled, weights, ["component"]), "weighed")
        # At first every set comes with one of its shingles only, that by which it was dealt to its chunk.
        with_shingle = known.select("row", F.col("block").alias("shingle"), F.col("n").alias("at")) if blocks_only else shared
        places = by_row(with_shingle, weighed.select("row", "chunk", "weight", "component"))
        places = places.select("shingle", "row", "at", "chunk", "weight", "component").repartition("shingle").sortWithinPartitions("shingle")
        visits = stored(places.mapInArrow(released(_visits(percent, blocks_only)), "row bigint, chunk bigint"), "visits").dropDuplicates()
        visits = stored(visits, "distinct-visits")
        if visits.isEmpty():
            return None
        # A chunk with many guests meets them in parts, so that no task holds more than one part of them.
        parts = visits.groupBy("chunk").agg(F.ceil(F.count("*") / _CHUNK_DOCS).alias("parts"))
        parts = stored(parts, "parts")
        visits = match_unique(visits, parts, ["chunk"])
        place = F.xxhash64("chunk", F.pmod(F.xxhash64("row"), F.col("parts")))
        points = placed.select("chunk", "row", "point")
        guests = by_row(points.drop("chunk"), visits.select("row", place.alias("chunk"))).select("chunk", F.lit(True).alias("guest"), "row", "point")
        hosts = match_unique(points, parts, ["chunk"])
        hosts = hosts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        hosts = hosts.select(F.xxhash64("chunk", F.pmod("part", "parts")).alias("chunk"), F.lit(False).alias("guest"), "row", "point")
        met = guests.union(hosts).repartition("chunk").sortWithinPartitions("chunk", "guest")
        met = stored(met.mapInArrow(released(meeting), "chunk bigint, guest boolean, row bigint"), "met")
        wanted = by_row(by_row(met, placed.select("row", "row_key")), labelled.select("row", "component"))
        meetings = sets_of(stored(wanted.drop("row"), "wanted")).select("chunk", "guest", "component", "shingles")
        links = meetings.repartition("chunk").sortWithinPartitions("chunk", "guest").mapInArrow(released(across), edge_schema)
        return stored(links, "links")

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            table = table.combine_chunks()
            marked = pa.array(possible(points_of(table), percent, int(table.column("guest").to_numpy().argmax())))
            yield from table.select(["chunk", "guest", "row"]).filter(marked).combine_chunks().to_batches()

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            names = table.column("component").to_numpy()
            hosts = int(table.combine_chunks().column("guest").to_numpy().argmax())
            yield edges_of(link_sets(_sets(table), names, percent, hosts), names)

    edges = stored(sets.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(released(within), edge_schema), "links")
    found = connected_components(edges)
    component = F.coalesce("component", "row").alias("component")
    labelled = match_unique(placed.select("row", "chunk"), found.withColumnRenamed("node", "row"), ["row"], "left")
    labelled = stored(labelled.select("row", "chunk", component), "labelled")
    # Sets of smaller components visit the chunks in which larger ones share a shingle with them: one of each part of a block first.
    for blocks_only in (True, False):
        links = meetings_of(labelled, blocks_only)
        if links is not None:
            again = connected_components(links)
            again = again.select(F.col("node").alias("component"), F.col("component").alias("whole"))
            joined = match_unique(labelled, again, ["component"], "left")
            labelled = stored(joined.select("row", "chunk", F.coalesce("whole", "component").alias("component")), "labelled")
    merged = labelled.select(F.col("row").alias("node"), "component")
    named = match_unique(classes, merged.select(F.col("node").alias("row"), "component"), ["row"], "left")
    named = stored(named.select("digest", "least", F.coalesce("component", "row").alias("component")), "named")
    firsts = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = match_unique(named, firsts, ["component"]).select("digest", "component_id")
    result = match_unique(sketch.select("id", "n", "digest"), named, ["digest"], "left")
    return result.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )

