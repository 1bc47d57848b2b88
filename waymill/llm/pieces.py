"""Sampled segmentation into the pieces of a public SentencePiece model, and lossless decoding."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, mix64, released, row_blocks, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# A literal mark in the text stands for itself, beyond all code points; the mark stands for a space.
_LITERAL = 0x110000
# Spaces with the word after them; pieces never go on after such a chunk or across a line's end.
_CHUNK = re.compile(r" *[^ \n]+| +|\n")
_CUT = re.compile(r"(?<=[^ ]) ")
_SLICE = 1 << 20
# A block of lattices has about so many chunks, and distinct ones of so many characters; a batch so many bytes of text.
_BLOCK = 200_000
_BLOCK_CHARS = 600_000
_BATCH = 3_000_000
# A longer chunk has its lattice to itself, made and walked in segments of so many characters.
_LONG = 512
_SEGMENT = 1 << 15
_BASE = U64(0x9E3779B97F4A7C15)


class PieceTable:
    """The pieces of a model with log probabilities, and a hash table of all their beginnings.

    A piece-merging model has ranks, not probabilities; Zipf's law turns the rank r of a piece into
    a probability in proportion to 1 / (r + ``flatten``), to the power ``alpha``.  A character without a piece
    is its UTF-8 bytes, each as improbable as the last piece.
    """

    def __init__(self, model: str, alpha: float, flatten: float = 10.0):
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.n = processor.get_piece_size()
        names = [processor.id_to_piece(i) for i in range(self.n)]
        plain = [i for i in range(self.n) if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i))]
        for i in plain:
            rest = names[i].lstrip(MARK)
            if MARK in rest or "\n" in names[i][1:] or names[i][:1] == "\n" != names[i]:
                raise ValueError("the model has pieces that go on after a word or a line")
        self.byte_ids = np.zeros(256, np.int64)
        self.text = [b""] * self.n
        for i in range(self.n):
            if processor.is_byte(i):
                value = int(names[i][3:5], 16)
                self.byte_ids[value], self.text[i] = i, bytes([value])
        ranks = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-processor.get_score(i), i)))}
        weights = np.log(np.array([ranks.get(i, len(plain)) for i in range(self.n)]) + flatten)
        self.log_p = -alpha * (weights + np.log(np.exp(-weights[plain]).sum()))
        self.byte_log_p = float(self.log_p[self.byte_ids[0]])
        keys: dict[int, int] = {}
        for i in plain:
            self.text[i] = names[i].replace(MARK, " ").encode()
            codes = np.array([ord(c) for c in names[i]])
            value = 0
            for at, letter in enumerate(self.letter(codes).tolist()):
                value = (value * int(_BASE) + letter) & ((1 << 64) - 1)
                keys.setdefault(value, -1)
                if at == len(codes) - 1:
                    keys[value] = i
        self.bits = int(np.ceil(np.log2(len(keys) * 16)))
        self.keys, self.values = np.zeros(1 << self.bits, U64), np.full(1 << self.bits, -2, np.int32)
        self.longest = max(len(names[i]) for i in plain)
        # What find() gives for each single character; those of one byte without a piece are that byte's.
        self.singles = np.full(_LITERAL + 1, -2, np.int32)
        self.singles[:128] = self.byte_ids[:128]
        self.probes = 0
        for key, value in keys.items():
            at, probes = int(self.slot(np.array([key], U64))[0]), 1
            while self.values[at] != -2:
                at, probes = (at + 1) % len(self.keys), probes + 1
            self.keys[at], self.values[at], self.probes = key, value, max(self.probes, probes)
        for code in {ord(names[i][0]) for i in plain}:
            value = keys.get(int(self.letter(np.array([code]))[0]), -2)
            self.singles[code] = self.singles[code] if code < 128 and value == -1 else value

    @staticmethod
    def letter(codes: np.ndarray) -> np.ndarray:
        return mix64(codes.astype(U64) + U64(1))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> U64(29))) * U64(0xBF58476D1CE4E5B9) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 where it is only the beginning of pieces, -2 where no piece begins so."""
        at, result = self.slot(keys), np.full(len(keys), -2, np.int32)
        left = np.arange(len(keys))
        for _ in range(self.probes):
            got, values = self.keys[at], self.values[at]
            same = got == keys[left]
            result[left[same]] = values[same]
            more = ~same & (values != -2)
            left, at = left[more], (at[more] + 1) % len(self.keys)
            if not len(left):
                break
        return result


@lru_cache(maxsize=2)
def piece_table(model: str, alpha: float) -> PieceTable:
    return PieceTable(model, alpha)


class Lattice:
    """The piece lattices of distinct chunks, forward-filtered together.

    Nodes are the positions between characters.  They are numbered by position first, so that one step
    of the filter is one array operation over all chunks that are long enough.  ``into[v]`` is the first edge that
    ends in node v, ``cumulative`` the probability, given v, of its edges so far, ``source`` where they come from.
    """

    def __init__(self, table: PieceTable, chunks: list[str]):
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(-lengths, kind="stable")
        self.rank = np.empty(len(chunks), np.int64)
        self.rank[order] = np.arange(len(chunks))
        self.lengths, sizes = lengths, lengths[order]
        longest = int(sizes[0])
        # How many chunks have a node at each position, and the number of its first node.
        wide = np.searchsorted(-sizes, -np.arange(longest + 1), side="right")
        first = np.concatenate(([0], np.cumsum(wide)))
        self.first = first
        joined = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        joined[joined == ord(MARK)] = _LITERAL
        joined[joined == 32] = ord(MARK)
        begin = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        # The character after each node, in the order of the nodes.
        before = np.concatenate(([0], np.cumsum(wide[1:]))).astype(np.int32)
        position = np.repeat(np.arange(longest, dtype=np.int32), wide[1:])
        rank = np.arange(len(position), dtype=np.int32) - before[position]
        codes = joined[begin[order].astype(np.int32)[rank] + position]
        letters = table.letter(codes)
        wide, first = np.append(wide, 0).astype(np.int32), first.astype(np.int32)
        # Edges of one character; one without a piece of its own is an edge of its bytes.
        piece = table.singles[codes]
        start = first[position] + rank
        heads, tails, pieces = [start], [first[position + 1] + rank], [np.where(piece >= 0, piece, table.n + codes).astype(np.int32)]
        going = (piece != -2) & (rank < wide[position + 2])
        start, rank, hashes, spot = start[going], rank[going], letters[going], position[going] + np.int32(1)
        for _ in range(1, table.longest):
            if not len(start):
                break
            hashes = hashes * _BASE + letters[before[spot] + rank]
            piece = table.find(hashes)
            whole = piece >= 0
            heads.append(start[whole]), tails.append(first[spot[whole] + 1] + rank[whole]), pieces.append(piece[whole])
            going = (piece != -2) & (rank < wide[spot + 2])
            start, rank, hashes, spot = start[going], rank[going], hashes[going], spot[going] + np.int32(1)
        del joined, codes, letters, position, start, rank, hashes, spot, piece, going
        tail = np.concatenate(tails)
        by_tail = np.argsort(tail, kind="stable").astype(np.int32)
        tail = tail[by_tail]
        self.source = np.concatenate(heads)[by_tail]
        self.piece = np.concatenate(pieces)[by_tail]
        del heads, tails, pieces, by_tail
        self.into = np.concatenate(([0], np.cumsum(np.bincount(tail, minlength=first[-1]))))
        log_p = np.where(self.piece < table.n, table.log_p[np.minimum(self.piece, table.n - 1)], 0.0)
        fallback = np.flatnonzero(self.piece >= table.n)
        code = self.piece[fallback] - table.n
        log_p[fallback] = table.byte_log_p * (1 + (code > 0x7F) + (code > 0x7FF) + ((code > 0xFFFF) & (code != _LITERAL)))
        forward = np.zeros(first[-1])
        self.cumulative = np.empty(len(tail))
        for layer in range(1, longest + 1):
            low, high = self.into[first[layer]], self.into[first[layer + 1]]
            starts = self.into[first[layer] : first[layer + 1]] - low
            counts = np.diff(np.append(starts, high - low))
            value = forward[self.source[low:high]] + log_p[low:high]
            top = np.maximum.reduceat(value, starts)
            mass = np.exp(value - np.repeat(top, counts))
            total = np.add.reduceat(mass, starts)
            forward[first[layer] : first[layer + 1]] = top + np.log(total)
            share = np.cumsum(mass / np.repeat(total, counts))
            self.cumulative[low:high] = share - np.repeat(np.concatenate(([0.0], share))[starts], counts)
        # Nothing is lost to rounding at a node's last edge.
        self.cumulative[self.into[first[1] + 1 :] - 1] = 2.0

    @np.errstate(over="ignore")
    def sample(self, kinds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each occurrence of a chunk, its number of pieces; and all pieces in order.

        Each walks back from its last node; every edge is drawn by its share, with random numbers
        that depend on the occurrence's key and the number of the step only.
        """
        node = self.first[self.lengths[kinds]] + self.rank[kinds]
        layer0 = self.first[1]
        active = np.arange(len(kinds))
        taken, drawn, step = np.zeros(len(kinds), np.int64), [], 0
        while len(active):
            chance = (mix64(keys[active] + U64(step) * U64(0xD1342543DE82EF95)) >> U64(40)) / float(1 << 24)
            edge = self.into[node]
            behind = np.flatnonzero(self.cumulative[edge] <= chance)
            while len(behind):
                edge[behind] += 1
                behind = behind[self.cumulative[edge[behind]] <= chance[behind]]
            drawn.append((active, self.piece[edge]))
            taken[active] += 1
            node = self.source[edge]
            going = node >= layer0
            active, node, step = active[going], node[going], step + 1
        ends = np.cumsum(taken)
        pieces = np.empty(ends[-1] if len(ends) else 0, np.int32)
        for step, (of, piece) in enumerate(drawn):
            pieces[ends[of] - 1 - step] = piece
        return taken, pieces


class LongChunk:
    """The piece lattice of one long chunk (an unspaced line, say), in memory for one number a character.

    The filter keeps the probability of each position only; edges are found for a segment of positions at a time, for the filter
    and again, from the last segment back, for the sampling.
    """

    def __init__(self, table: PieceTable, chunk: str):
        self.table = table
        codes = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        codes[codes == ord(MARK)] = _LITERAL
        codes[codes == 32] = ord(MARK)
        self.codes = codes
        forward = [0.0]
        for low in range(0, len(codes), _SEGMENT):
            first, source, _, log_p = self._edges(low, min(len(codes), low + _SEGMENT))
            for begin, end in zip(first, first[1:]):
                if end == begin + 1:
                    forward.append(forward[source[begin]] + log_p[begin])
                else:
                    values = [forward[source[e]] + log_p[e] for e in range(begin, end)]
                    top = max(values)
                    forward.append(top + math.log(sum([math.exp(v - top) for v in values])))
        self.forward = np.array(forward)

    def _edges(self, low: int, high: int) -> tuple[list[int], list[int], list[int], list[float]]:
        """The edges into the positions after ``low`` up to ``high``, short ones first: where those of each position begin, and
        the source, the piece and the log probability of each edge."""
        table, begin = self.table, max(0, low - self.table.longest + 1)
        codes = self.codes[begin:high]
        letters = table.letter(codes)
        single = table.singles[codes]
        size = 1 + (codes > 0x7F) + (codes > 0x7FF) + ((codes > 0xFFFF) & (codes != _LITERAL))
        chance = np.where(single >= 0, table.log_p[np.maximum(single, 0)], table.byte_log_p * size)
        own = np.arange(low - begin, high - begin)
        tails, sources = [own], [own]
        pieces, chances = [np.where(single >= 0, single, table.n + codes)[own]], [chance[own]]
        start, hashes = np.flatnonzero(single != -2), letters[single != -2]
        for length in range(2, table.longest + 1):
            inside = start + length <= len(codes)
            start, hashes = start[inside], hashes[inside]
            if not len(start):
                break
            with np.errstate(over="ignore"):
                hashes = hashes * _BASE + letters[start + length - 1]
            piece = table.find(hashes)
            whole = (piece >= 0) & (begin + start + length > low)
            tails.append(start[whole] + length - 1), sources.append(start[whole])
            pieces.append(piece[whole]), chances.append(table.log_p[piece[whole]])
            start, hashes = start[piece != -2], hashes[piece != -2]
        tail = np.concatenate(tails) - (low - begin)
        order = np.argsort(tail, kind="stable")
        first = np.concatenate(([0], np.cumsum(np.bincount(tail, minlength=high - low))))
        ordered = [np.concatenate(x)[order] for x in (sources, pieces, chances)]
        return first.tolist(), (ordered[0] + begin).tolist(), ordered[1].tolist(), ordered[2].tolist()

    @np.errstate(over="ignore")
    def sample(self, key: np.ndarray) -> np.ndarray:
        """The pieces of one occurrence, drawn as ``Lattice.sample`` draws them."""
        found, node, step = [], len(self.codes), 0
        while node:
            low = (node - 1) // _SEGMENT * _SEGMENT
            first, source, piece, log_p = self._edges(low, node)
            behind = max(0, low - self.table.longest)
            forward = self.forward[behind:node].tolist()
            steps = np.arange(step, step + node - low).astype(U64)
            chances = iter(((mix64(key + steps * U64(0xD1342543DE82EF95)) >> U64(40)) / float(1 << 24)).tolist())
            while node > low:
                left, edge, last = next(chances), first[node - low - 1], first[node - low] - 1
                if edge < last:
                    values = [forward[source[e] - behind] + log_p[e] for e in range(edge, last + 1)]
                    top = max(values)
                    shares = [math.exp(v - top) for v in values]
                    left *= sum(shares)
                    for share in shares[:-1]:
                        if share > left:
                            break
                        left -= share
                        edge += 1
                node = source[edge]
                found.append(piece[edge])
                step += 1
        return np.array(found[::-1], np.int32)


def row_seed(key: object, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}/{key}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _chunks(text: str) -> Iterator[list[str]]:
    """The chunks of a text with a space put before it, for slices of about a million characters."""
    text = " " + text if text else text
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + _SLICE) if len(text) - at > _SLICE else None
        end = cut.start() if cut else len(text)
        yield _CHUNK.findall(text, at, end)
        at = end


def sample_pieces(table: PieceTable, keys: list[int], texts: list[str]) -> list[np.ndarray]:
    """Sampled pieces of each text, in blocks of chunks that bound the memory for lattices, by number and by characters."""
    results: list[list[np.ndarray]] = [[] for _ in texts]
    kinds: dict[str, int] = {}
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = chars = 0

    def add(row: int, part: np.ndarray) -> None:
        results[row].append(_with_bytes(table, part) if (part >= table.n).any() else part.astype(np.int32))

    def flush() -> None:
        nonlocal size, chars
        if held:
            lattice = Lattice(table, list(kinds))
            counts, pieces = lattice.sample(np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))
            ends, at = np.concatenate(([0], np.cumsum(counts))), 0
            for row, own, _ in held:
                add(row, pieces[ends[at] : ends[at + len(own)]])
                at += len(own)
        held.clear()
        kinds.clear()
        size = chars = 0

    def take(row: int, key: int, number: int, chunks: list[str]) -> None:
        nonlocal size, chars
        for first in range(0, len(chunks), _BLOCK):
            before = len(kinds)
            own = np.array([kinds.setdefault(c, len(kinds)) for c in chunks[first : first + _BLOCK]], np.int64)
            count = np.arange(number + first, number + first + len(own)).astype(U64)
            held.append((row, own, U64(key) + count * _BASE))
            size += len(own)
            if len(kinds) > before:
                chars += sum(map(len, islice(kinds, before, None)))
            if size >= _BLOCK or chars >= _BLOCK_CHARS:
                flush()

    for row, (key, text) in enumerate(zip(keys, texts)):
        number = 0
        for chunks in _chunks(text):
            long = [i for i, c in enumerate(chunks) if len(c) > _LONG]
            at = 0
            for i in long:
                take(row, key, number + at, chunks[at:i])
                # What stands before it in the text comes first in the result, too.
                flush()
                with np.errstate(over="ignore"):
                    add(row, LongChunk(table, chunks[i]).sample(U64(key) + U64(number + i) * _BASE))
                at = i + 1
            take(row, key, number + at, chunks[at:])
            number += len(chunks)
    flush()
    return [np.concatenate(r) if r else np.empty(0, np.int32) for r in results]


def _with_bytes(table: PieceTable, pieces: np.ndarray) -> np.ndarray:
    """Characters without a piece replaced by their bytes' pieces."""
    result = []
    for piece in pieces.tolist():
        if piece < table.n:
            result.append(piece)
        else:
            code = piece - table.n
            raw = (MARK if code == _LITERAL else chr(code)).encode("utf-8", "surrogatepass")
            result.extend(table.byte_ids[b] for b in raw)
    return np.array(result, np.int32)


def encode_pieces(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    name: str = "pieces",
    decoded: str | None = None,
    lossless: str | None = None,
    model: str = MODEL,
    alpha: float = 0.5,
    seed: int = 0,
) -> DataFrame:
    """The documents with ``name``, a segmentation of the whole text sampled by its probability.

    Forward filtering and backward sampling over each chunk's lattice draw from the exact distribution of
    all segmentations.  Random numbers depend on the row's key, the place in the text and the seed only:
    runs agree whatever the partitioning, and repeated rows get the same pieces.  ``model`` is a path that
    every executor has.  Null and empty texts have no pieces; a null key is a key like any other.
    An input column called ``name`` is replaced.  With ``decoded`` the pieces are decoded at once, by what ``decode_pieces``
    does, into a column of that name; that spares sending them to Python again.  With ``lossless`` a column of that name tells
    whether they decode to the text, which is not sent back.

    Texts are taken some three million bytes at a time, and their lattices in blocks; a word of more than 512 characters has
    a lattice to itself that is made in segments, so that memory does not follow the length of words.  An empty table gives
    an empty result; other columns stay as they are.
    """
    new = {name: "array<int>"} | ({decoded: "string"} if decoded else {}) | ({lossless: "boolean"} if lossless else {})
    docs = docs.drop(*new)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"`{n}` {kind}" for n, kind in new.items()])
    at_key, at_text = docs.columns.index(key), docs.columns.index(text)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model, alpha)
        for whole in batches:
            for first, last in row_blocks(text_bytes(whole.column(at_text))[1], _BATCH):
                batch = whole.slice(first, last - first)
                seeds = [row_seed(k, seed) for k in batch.column(at_key).to_pylist()]
                texts = [t or "" for t in batch.column(at_text).to_pylist()]
                found = sample_pieces(table, seeds, texts)
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32))
                values = pa.array(np.concatenate(found) if found else np.empty(0, np.int32), pa.int32())
                arrays = [*batch.columns, pa.ListArray.from_arrays(offsets, values)]
                if decoded is not None:
                    arrays.append(pa.array([_decoded(table, f.tolist()) for f in found], pa.string()))
                if lossless is not None:
                    arrays.append(pa.array([_decoded(table, f.tolist()) == t for f, t in zip(found, texts)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *new])

    return docs.mapInArrow(released(encoded), schema)


def _decoded(table: PieceTable, ids: list[int]) -> str:
    """The text of pieces, without the space that encoding put before it."""
    return b"".join(map(table.text.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def decode_pieces(docs: DataFrame, *, pieces: str = "pieces", name: str = "decoded", model: str = MODEL) -> DataFrame:
    """The documents with ``name``, the text of their pieces; exactly what was encoded.  Null pieces give null.

    An input column called ``name`` is replaced.
    """
    docs = docs.drop(name)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"`{name}` string"])
    at = docs.columns.index(pieces)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model, 1.0)
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                values = [None if ids is None else _decoded(table, ids) for ids in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.string())], names=[*batch.schema.names, name])

    return docs.mapInArrow(released(decoded), schema)
