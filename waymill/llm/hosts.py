"""Quality rules per document, and verdicts on whole hosts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import released
from .columns import group_key, refuse_reserved

_SYMBOLS = b"#*$%&|<>"
_SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measure_text(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    joined = raw.translate(None, _SPACES)
    # A code point has one byte that does not continue another.
    chars = len(joined.decode("utf-8", "surrogatepass"))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeats = 0
    if len(words) > 3:
        windows = list(zip(words, words[1:], words[2:]))
        counts = Counter(windows)
        if len(counts) < len(windows):
            last = -1
            for start, window in enumerate(windows):
                if counts[window] > 1:
                    repeats += start + 3 - max(start, last)
                    last = start + 3
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeats


def measure_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of the documents with the columns of ``MEASURES`` in place of the text.

    Whole texts are measured; a null text counts as empty.  Columns already named like a measure are replaced.
    """
    kept = [c for c in docs.columns if c != text and c not in MEASURES]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in kept]
        + [f"{m} bigint" for m in MEASURES]
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure_text(value.as_py()) for value in batch.column(0)]
            columns = zip(*rows) if rows else [[]] * len(MEASURES)
            arrays = [batch.column(i + 1) for i in range(len(kept))] + [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *MEASURES])

    refuse_reserved(kept)
    return docs.select(F.col(text).alias("__text"), *kept).mapInArrow(released(measured), schema)


@dataclass(frozen=True)
class Rules:
    """Limits of the document rules and of the host verdict."""

    least_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 20
    dup_line_percent: int = 30
    mean_chars: tuple[float, float] = (2.0, 12.0)
    host_rate: float = 0.5

    def base_failed(self) -> Column:
        words = F.col("n_words")
        return (words < self.least_words) | (100 * F.col("n_repeat_words") > self.repeat_percent * words)

    def failed(self) -> Column:
        """Any rule: the base, many symbols, many repeated lines, or words of an odd mean length."""
        words, (short, long) = F.col("n_words"), self.mean_chars
        return (
            self.base_failed()
            | (100 * F.col("n_symbols") > self.symbol_percent * words)
            | (100 * F.col("n_dup_lines") > self.dup_line_percent * F.col("n_lines"))
            | (F.col("word_chars") < short * words)
            | (F.col("word_chars") > long * words)
        )


def beta_prior(counts: DataFrame) -> tuple[float, float]:
    """The two parameters of a beta prior for the hosts' failure rates, from all hosts (``n``, ``f``).

    The method of moments for unequal group sizes: the spread of the rates beyond what
    counts of that size show by chance gives the prior's strength.  One row of sums passes through the driver.
    """
    n, f = F.col("n"), F.col("f")
    total, failed, hosts, squares, ratio = counts.agg(
        F.sum(n), F.sum(f), F.count("*"), F.sum(n.cast("double") * n), F.sum(f.cast("double") * f / n)
    ).first()
    if not total:
        return 1.0, 1.0
    # Half a failure is added on both sides, so that a corpus without any has a prior too.
    rate = (failed + 0.5) / (total + 1)
    spread = ratio - failed * failed / total
    freedom = total - squares / total - (hosts - 1)
    within = 1.0 if freedom <= 0 else (spread / (rate * (1 - rate)) - (hosts - 1)) / freedom
    within = min(max(within, 1e-4), 0.5)
    strength = 1 / within - 1
    return rate * strength, (1 - rate) * strength


def host_verdicts(counts: DataFrame, rules: Rules) -> DataFrame:
    """Hosts (``__host``, ``n``, ``f``) with ``host_rate``, the shrunk failure rate, and ``host_kept``."""
    a, b = beta_prior(counts)
    rate = (F.col("f") + F.lit(a)) / (F.col("n") + F.lit(a + b))
    return counts.select("__host", rate.alias("host_rate"), (rate <= rules.host_rate).alias("host_kept"))


def host_rules(docs: DataFrame, *, text: str = "text", host: str = "source", rules: Rules | None = None) -> DataFrame:
    """Documents without their text, with measures, ``base_failed``, ``failed``, ``host_rate`` and ``kept``.

    A document that fails the base rules goes; any other goes only with its whole host, when the
    host's failure rate, shrunk towards all hosts' by an empirical beta prior, is above the
    limit.  A host with few documents is therefore not judged by them alone.

    A null host is a host of its own.  A null or empty text has no words and fails the base rules.
    Repeated rows count each.  An empty table gives an empty result.
    """
    rules = rules or Rules()
    added = ("base_failed", "failed", "host_rate", "host_kept", "kept")
    docs = docs.select(*(c for c in docs.columns if c not in added))
    measured = measure_documents(docs, text).withColumns(
        {"base_failed": rules.base_failed(), "failed": rules.failed(), "__host": group_key(F.col(host))}
    )
    # The texts are read once; counts and the join both start from the stored measures.
    measured = materialize(measured, new_folder(docs.sparkSession, "measures"))
    counts = measured.groupBy("__host").agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("f"))
    counts = materialize(counts, new_folder(docs.sparkSession, "hosts"))
    judged = match_unique(measured, host_verdicts(counts, rules), ["__host"], "left")
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("host_kept")).drop("__host", "host_kept")
