"""Repair of conversations: faults of rows, and the cheapest edits that give an orderly sequence of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import match_unique
from ..storage import materialize, new_folder
from .arrays import released
from .columns import group_key
from .grammar import ASSISTANT, DELETE, OTHER_ROLE, START, SYSTEM, USER, cheapest_edits

_SPACES = " \t\n\x0b\x0c\r"
# Codes of a conversation that a task hands on at a time, and codes that it works out at a time.
_CHUNK = 1 << 20
_BATCH = 1 << 18


def damaged(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by the crc32 of ``conv:turn`` modulo 20; nulls count as one space in it.

    0 drops the row, 1 empties its text, 2 takes out full stops, exclamation and question marks, 3 repeats it, and 4 makes it the
    user's.  Only the four columns are returned.  An empty table stays empty, and equal rows are damaged alike.
    """
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    some = rows.select(*(F.col(c).alias(n) for c, n in ((conv, "conv"), (turn, "turn"), (role, "role"), (text, "text"))), kind.alias("kind"))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    some = some.filter("kind <> 0").select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias(role),
        changed.alias(text), times.alias("times"),
    )
    return some.select(conv, turn, role, text)


def row_faults(rows: DataFrame, *, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each distinct row of a conversation once, with ``n`` (how often it is there), its faults and its code.

    ``blank``: the text has nothing but spaces; ``seen``: an earlier row of the conversation has its role and text.  The first of
    ``n`` equal rows has the fault that ``code`` names; the others are blank or repeat it.  Equal rows are counted
    within the tasks first; the earliest turn of a text is met in a join whose hot keys are split.
    """
    named = rows.select(
        group_key(F.col(conv)).alias("conv"),
        F.col(turn).alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))),
    )
    counted = named.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("n"))
    counted = counted.withColumn("digest", F.unhex(F.sha2("text", 256)))
    counted = materialize(counted, new_folder(rows.sparkSession, "rows"))
    firsts = counted.groupBy("conv", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("undated"), F.min("turn").alias("first"))
    met = match_unique(counted, firsts, ["conv", "role", "digest"])
    end = F.substring(F.rtrim("text", F.lit(_SPACES)), -1, 1)
    seen = F.col("turn").isNotNull() & (F.col("undated") | (F.col("turn") > F.col("first")))
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER_ROLE)
    fault = F.when(F.col("blank") | F.col("seen"), DELETE).when(end.isin(".", "!", "?"), 0).otherwise(1)
    met = met.withColumns({"blank": end == "", "seen": seen})
    return met.select("conv", "turn", "role", "digest", "text", "n", "blank", "seen", (3 * place + fault).alias("code"))


def _in_order(faults: DataFrame, *more: str | Column) -> DataFrame:
    """Rows in the order of conversation, turn, role and text, in ranges, so that a long conversation lies in many tasks."""
    order = ["conv", "turn", "role", "digest"]
    return faults.select(*order, *more).repartitionByRange(*order).sortWithinPartitions(*order)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, conv, code, n) in order → the codes of each run of rows of one conversation."""
    conv, place, codes, size, part = None, 0, [], 0, 0

    def done() -> pa.RecordBatch:
        names = ["conv", "place", "part", "codes"]
        text = "".join(codes)
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], pa.string()), pa.array([place], pa.int32()), pa.array([part], pa.int32()), pa.array([text], pa.string())], names=names
        )

    for batch in batches:
        for place_, conv_, code, n in zip(*(c.to_pylist() for c in batch.columns)):
            if conv_ != conv or size >= _CHUNK:
                if codes:
                    yield done()
                part = part + 1 if conv_ == conv else 0
                conv, place, codes, size = conv_, place_, [], 0
            codes.append(_LETTERS[code] + _LETTERS[code - code % 3 + DELETE] * (n - 1))
            size += n
    if codes:
        yield done()


_LETTERS = "abcdefghijkl"


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct sequences of codes → illegal neighbours, cost, audit, and the audit without the rows that must be deleted."""
    for batch in batches:
        held: list[str] = []
        size = 0
        for codes in batch.column(0).to_pylist():
            held.append(codes)
            size += len(codes)
            if size >= _BATCH:
                yield _worked_out(held)
                held, size = [], 0
        if held:
            yield _worked_out(held)


def _worked_out(texts: list[str]) -> pa.RecordBatch:
    sequences = [np.frombuffer(t.encode(), np.uint8).astype(np.int64) - ord("a") for t in texts]
    # Rows that must be deleted are one symbol whatever their role.
    found = cheapest_edits([np.where(s % 3 == DELETE, DELETE, s) for s in sequences])
    illegal, edits = [], []
    for codes, (_, audit) in zip(sequences, found):
        roles = codes // 3
        before, after = roles[:-1], roles[1:]
        legal = ((before == 0) & (after == 1)) | ((before == 1) & (after == 2)) | ((before == 2) & (after == 1))
        illegal.append(int((~legal).sum()))
        letters = np.frombuffer(audit.encode(), np.uint8)
        rows = np.cumsum(letters != ord("I")) - 1
        forced = (letters != ord("I")) & (codes[rows] % 3 == DELETE)
        edits.append(letters[~forced].tobytes().decode())
    columns = [pa.array(texts, pa.string()), pa.array(illegal, pa.int64()), pa.array([c for c, _ in found], pa.int64())]
    columns += [pa.array([a for _, a in found], pa.string()), pa.array(edits, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["codes", "illegal", "cost", "audit", "edits"])


class _Repaired:
    """The repaired text of one conversation, hashed as its rows come."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state, self.hash, self.first = edits, 0, START, hashlib.sha256(), True

    def _write(self, line: str) -> None:
        self.hash.update((line if self.first else "\n" + line).encode("utf-8", "surrogatepass"))
        self.first = False

    def _fitting(self) -> str:
        self.state = ASSISTANT if self.state == USER else USER
        return "assistant" if self.state == ASSISTANT else "user"

    def inserted(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self._write(f"{self._fitting()}:")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter = self.edits[self.at]
        self.at += 1
        if letter == "R":
            self._write(f"{self._fitting()}:{text}")
        elif letter == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            self._write(f"{role}:{text}")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, role, text), each conversation's edits (as a row without role) before its rows → hash of the repaired text."""
    conv, repaired = None, None

    def done() -> pa.RecordBatch:
        repaired.inserted()
        return pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([repaired.hash.hexdigest()])], names=["conv", "repaired_sha256"])

    for batch in batches:
        for conv_, role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if role is None:
                if repaired is not None:
                    yield done()
                conv, repaired = conv_, _Repaired(text.as_py())
            else:
                repaired.row(role, text.as_py())
    if repaired is not None:
        yield done()


def repair_conversations(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per conversation its faults, the cheapest edits that mend it, and the hash of what they give.

    Rows of a conversation are taken by turn (nulls first), rows of one turn by role and the SHA-256 of their text, equal rows
    together.  Each row's first fault counts: ``blank`` (nothing but spaces), ``duplicate`` (role and text were there
    before), ``truncated`` (the last character that is no space is none of ``.!?``).  ``gaps`` are turns missing between the least
    and the greatest; ``illegal`` are neighbours whose roles' initials are not su, ua or au.

    Edits: keep a row (cost 0), give it the role user or assistant (2), delete it (3; blank rows and duplicates must be),
    insert an empty message of either (2); a truncated row that stays adds 1.  They lead to nothing, or to an optional system
    message followed by one or more pairs of user and assistant.  ``audit`` has the initials of the cheapest edits in order; of
    equal costs the least text.  ``repaired_sha256`` is of ``role:text`` lines joined by newlines.  ``cost`` is the edits'.

    How it is done: rows become one letter each (role and fault).  Ranges of the order are written as texts of letters, by as many
    tasks as a long conversation needs; the texts are put together per conversation, and each distinct one is solved once, by
    matrices over a grammar that the texts of a batch share (see ``grammar``).  The edits then meet their rows again, in
    order, and are applied as a stream; a hash is of all that goes before, so that a conversation's last step is one task's,
    whatever its length, in memory for one row and one letter a row.

    Null roles and texts count as one space; a null conversation is one of its own.  Empty tables give an empty
    result.  Very long texts are held one at a time.  Other columns are not used.
    """
    spark = rows.sparkSession
    faults = row_faults(rows, conv=conv, turn=turn, role=role, text=text)
    faults = materialize(faults, new_folder(spark, "faults"))
    turns = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    counts = faults.groupBy("conv").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.when(F.col("seen"), 0).otherwise(1))).alias("duplicate"),
        F.sum((F.col("code") % 3 == 1).cast("long")).alias("truncated"),
    )
    ordered = _in_order(faults, "code", "n").select(F.spark_partition_id().alias("place"), "conv", "code", "n")
    chunks = ordered.mapInArrow(released(_chunks), "conv string, place int, part int, codes string")
    pieces = F.sort_array(F.collect_list(F.struct("place", "part", "codes")))
    texts = materialize(chunks.groupBy("conv").agg(F.array_join(pieces["codes"], "").alias("codes")), new_folder(spark, "codes"))
    solved = texts.select("codes").dropDuplicates().mapInArrow(
        released(_solved), "codes string, illegal bigint, cost bigint, audit string, edits string"
    )
    solved = materialize(solved, new_folder(spark, "solved"))
    audits = materialize(match_unique(texts, solved, ["codes"]).drop("codes"), new_folder(spark, "audits"))
    heads = audits.select("conv", F.lit(None).cast("string").alias("role"), F.col("edits").alias("text"))
    heads = heads.select("*", F.lit(0).alias("kind"), F.lit(None).cast(faults.schema["turn"].dataType).alias("turn"), F.lit(None).cast("binary").alias("digest"))
    lines = faults.filter(F.col("code") % 3 != DELETE).select("conv", "role", "text", F.lit(1).alias("kind"), "turn", "digest")
    lines = heads.union(lines).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")
    hashes = lines.select("conv", "role", "text").mapInArrow(released(_hashed), "conv string, repaired_sha256 string")
    found = counts.join(audits.drop("edits"), "conv").join(hashes, "conv")
    return found.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(original: DataFrame, rows: DataFrame, *, conv: str = "conv_id", **columns: str) -> DataFrame:
    """``repair_conversations`` of ``rows``, with a row for every conversation of ``original``; those without rows have nothing to mend."""
    every = original.select(conv).dropDuplicates().withColumn("conv", group_key(F.col(conv)))
    found = every.withColumnRenamed(conv, "id").join(repair_conversations(rows, conv=conv, **columns), "conv", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        F.col("id").alias(conv),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
