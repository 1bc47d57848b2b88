"""Document fingerprints from prefix polynomial hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U64, mix64, released
from .neighbours import with_following

# Two bases modulo the prime 2^31 - 1: equal spans have equal pairs of hashes, different ones hardly ever.
PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_406_932_606)
_P = U64(PRIME)
_PIECE = 1 << 18
SPAN = 32
KEPT = 32
_tables: dict[int, np.ndarray] = {}


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, for x below 2^62."""
    x = (x & _P) + (x >> U64(31))
    x = (x & _P) + (x >> U64(31))
    return x - _P * (x >= _P)


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a base, kept between calls."""
    have = _tables.get(base, np.ones(1, U64))
    while len(have) < n:
        have = np.concatenate((have, _mod(have * U64(pow(base, len(have), PRIME)))))
    _tables[base] = have
    return have[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """Modular prefix arrays of a text; they answer any question of span equality in constant time.

    ``sums[b][i]`` is the sum of c_j · B^j over the first i code points c_j, modulo the prime; the hash of
    a span is the difference of two entries, divided by the power of B at its start.
    """

    def __init__(self, codes: np.ndarray, before: PrefixHashes | None = None, keep: int = 0):
        """Of ``codes``, or of the first ``keep`` code points of another text followed by ``codes``."""
        self.n = keep + len(codes)
        self.sums = []
        for b, base in enumerate(BASES):
            sums = np.zeros(self.n + 1, np.uint32)
            if keep:
                sums[: keep + 1] = before.sums[b][: keep + 1]
            for at in range(keep, self.n, _PIECE):
                part = codes[at - keep : at - keep + _PIECE].astype(U64) + U64(1)
                scale = U64(pow(base, at, PRIME))
                terms = _mod(_mod(part * scale) * _powers(base, len(part)))
                sums[at + 1 : at + 1 + len(part)] = _mod(np.cumsum(terms) + U64(sums[at]))
            self.sums.append(sums)

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """The hashes of one span."""
        return tuple(
            (int(s[end]) - int(s[start])) * pow(base, -start, PRIME) % PRIME for s, base in zip(self.sums, BASES)
        )

    def spans(self, width: int) -> Iterator[np.ndarray]:
        """The hashes of all spans of one width, both in one number, in pieces."""
        for at in range(0, self.n - width + 1, _PIECE):
            last = min(self.n - width + 1, at + _PIECE)
            both = np.zeros(last - at, U64)
            for sums, base in zip(self.sums, BASES):
                differ = sums[at + width : last + width].astype(U64) + _P - sums[at:last].astype(U64)
                inverse = pow(base, -1, PRIME)
                scaled = _mod(_mod(differ) * U64(pow(inverse, at, PRIME)))
                both = (both << U64(31)) | _mod(scaled * _powers(inverse, last - at))
            yield both

    def common_extension(self, start: int, other: PrefixHashes, other_start: int) -> int:
        """How far this text from ``start`` and the other from ``other_start`` are the same, by binary search."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, start + middle) == other.span(other_start, other_start + middle):
                low = middle
            else:
                high = middle - 1
        return low


def span_widths(n: int) -> list[int]:
    """The widths of the spans that a text of n code points is told by, the wider first.

    A span is an eighth of the text (a power of two, 1 to ``SPAN``), so that an edit of a part leaves whole spans in short
    texts too.  Texts of less than 16 spans' length have those of half the width as well: two texts of which one is up to twice as
    long as the other then have a width in common.
    """
    if not n:
        return []
    width = min(SPAN, 1 << max(0, (n // 8).bit_length() - 1))
    return [width, width // 2] if 1 < width and n < 16 * SPAN else [width]


def _least_spans(hashes: PrefixHashes, width: int) -> np.ndarray:
    least = np.empty(0, U64)
    for both in hashes.spans(width):
        mixed = np.sort(np.concatenate((least, mix64(both))))
        least = mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))][:KEPT]
    return least


def fingerprint_of(hashes: PrefixHashes) -> str:
    """Length, hash of the whole text, and for each of its span widths the ``KEPT`` smallest of the mixed hashes of its spans.

    Equal texts have equal fingerprints.
    """
    whole = "".join(f"{h:08x}" for h in hashes.span(0, hashes.n))
    marks = (f"{width:x}-{(_least_spans(hashes, width) >> U64(32)).astype('>u4').tobytes().hex()}" for width in span_widths(hashes.n))
    return ".".join((f"{hashes.n:x}", whole, *marks))


def _marks(fingerprint: str) -> dict[str, set[str]]:
    parts = (part.partition("-")[::2] for part in fingerprint.split(".")[2:])
    return {width: {x[i : i + 8] for i in range(0, len(x), 8)} for width, x in parts}


def likeness(one: str, other: str) -> float:
    """Share of spans that two fingerprinted texts have in common (0 to 1), 1 only for equal fingerprints.

    Taken at the widest spans that both have; 0 if there are none, as for texts of very different length.  Estimated from the
    smallest hashes of both together as twice the common spans by the spans of the one and the other; exact where a
    text has no more spans than are kept.
    """
    if one == other:
        return 1.0
    a, b = _marks(one), _marks(other)
    width = max(a.keys() & b.keys(), key=lambda w: int(w, 16), default=None)
    if width is None:
        return 0.0
    a, b = a[width], b[width]
    both = sorted(a | b)
    if len(a) == KEPT or len(b) == KEPT:
        both = both[:KEPT]
    common = sum(x in a and x in b for x in both)
    return min(2 * common / (len(both) + common), 0.999999)


def fingerprints(docs: DataFrame, *, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """The documents with the fingerprint of their whole text; null counts as empty.

    An input column of that name is replaced; repeated rows get equal fingerprints.
    """
    docs = docs.drop(name)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"`{name}` string"])
    place = docs.columns.index(text)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint_of(PrefixHashes(code_points(v.as_py() or ""))) for v in batch.column(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.string())], names=[*batch.schema.names, name])

    return docs.mapInArrow(released(marked), schema)


@lru_cache(maxsize=2)
def _hashed(text: str) -> tuple[PrefixHashes, str]:
    """The hashes and the fingerprint of a text; the following text is the next to be asked for again."""
    hashes = PrefixHashes(code_points(text))
    return hashes, fingerprint_of(hashes)


def compare_edited(key: object, text: str, following: str) -> tuple:
    """A text, its edit (the last quarter replaced by the start of the following text) and the following text, compared."""
    quarter = len(text) // 4
    tail = following[:quarter]
    own, own_mark = _hashed(text)
    edited = PrefixHashes(code_points(tail), own, len(text) - quarter)
    edited_mark, next_mark = fingerprint_of(edited), _hashed(following)[1]
    digest = hashlib.sha256((text[: len(text) - quarter] + tail).encode("utf-8", "surrogatepass")).hexdigest()
    return (
        key, len(text), digest, own_mark, edited_mark, likeness(own_mark, edited_mark), likeness(own_mark, next_mark),
        own.common_extension(0, edited, 0),
    )


_COMPARED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("same_start", pa.int64()),
    ]
)


def fingerprint_edits(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edit, with their likeness, the likeness to the following document,
    and ``same_start``, the longest common extension of text and edit from their start.

    Columns are ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next`` and ``same_start``; other columns of the input are not used.  See ``with_following`` for the order, nulls
    and ties.  A single document follows itself.  An empty table gives an empty result.
    """
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, same_start bigint"
    )
    return with_following(docs, key, text, compare_edited, schema, _COMPARED)
