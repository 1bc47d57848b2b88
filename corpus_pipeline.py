"""The corpus pipeline: raw documents to sampled pieces, in five stages.

Each stage takes (spark, docs, folder) and all that the stage before kept; ``run`` writes what a stage returns as
Parquet into the shared folder and gives the next stage a scan of it.  All but the last return the columns of
documents.  Stages keep every document that their operator does not speak against.  Of what the operators for copies and repeats
store on their way, a stage leaves only their results.

In all stages a null text counts as empty, whole texts are worked on however long they are, columns other than those of documents are
left behind, and an empty table gives an empty result.  What a stage does with null keys and repeated rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.llm.columns import fold, group_key, word_count
from waymill.llm.jaccard import near_duplicates
from waymill.llm.mixing import emit_copies, mix_sources
from waymill.llm.pieces import encode_pieces
from waymill.llm.repeats import repeated_strings, row_key
from waymill.llm.toxicity import fit_toxicity, score_toxicity
from waymill.storage import materialize, new_folder, passing_folders

# What a stage returns passes its columns on in this order.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity by the nearest labelled examples is below 0.3.

    Examples are the labelled documents outside the fold that is held out for measuring.  A document without
    evidence stays, whatever the rate of toxic examples.  Null keys have no label and are judged as all others; repeated
    rows stay or go together.
    """
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learnt = labels.filter(F.coalesce(fold(F.col("doc_id"), 4) != 2, F.lit(False))).select("doc_id", "toxic")
    model = fit_toxicity(docs.select("doc_id", "text"), learnt)
    scored = score_toxicity(docs.select(*COLUMNS), model, threshold=0.3)
    return scored.filter((F.size("evidence") == 0) | (F.col("predicted") == 0)).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id; repeated rows of it count as one.

    Documents without words are linked with nothing and stay.  Null keys are no group's smallest unless all its keys are null.
    """
    path = new_folder(spark, "kept-keys")
    with passing_folders(spark):
        found = near_duplicates(docs.select("doc_id", "text"))
        # A document with words stands for its group; those without any link with nothing and stay.
        kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(group_key(F.col("doc_id")).alias("__key"))
        kept = materialize(kept, path)
    # Repeated rows meet where the join has put them; the texts are dealt out once.
    keyed = docs.select(*COLUMNS, group_key(F.col("doc_id")).alias("__key"))
    return keyed.join(kept.dropDuplicates(), "__key", "left_semi").dropDuplicates().select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without their byte strings of 200 that occur again; whole characters, and n_chars of what is left.

    No document goes, also if nothing of its text is left.  Repeated rows repeat each other's strings and keep no text of 200 bytes or
    more; null keys are kept as they are.
    """
    path = new_folder(spark, "kept-texts")
    with passing_folders(spark):
        found = repeated_strings(docs.select("doc_id", "text"), length=200).filter("kept_text is not null")
        found = materialize(found.select(F.col("row_key").alias("__key"), F.col("kept_text").alias("__text")), path)
    found = found.dropDuplicates(["__key"])
    keyed = docs.select(*COLUMNS, row_key("doc_id", "text").alias("__row"))
    joined = keyed.join(found, F.col("__row") == F.col("__key"), "left")
    text = F.coalesce("__text", "text")
    chars = F.when(F.col("__text").isNotNull(), F.length("__text")).otherwise(F.col("n_chars")).cast("long")
    return joined.select("doc_id", text.alias("text"), "lang", "source", chars.alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as a mix of the sources to weights of 1, 2, 3 in turn takes them.

    A null source is one of its own; documents of a source without any words are not taken.  Repeated rows are taken each by itself.
    """
    sized = docs.select(*COLUMNS, word_count(F.col("text")).alias("size"))
    return emit_copies(mix_sources(sized, weights=(1, 2, 3), share=1, most=3)).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with their sampled pieces; ``lossless`` tells that decoding gives the text again.

    Repeated rows get the same pieces, null and empty texts none.
    """
    coded = encode_pieces(docs.select("doc_id", "source", "text"), lossless="lossless")
    return coded.select("doc_id", "source", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeats),
    ("source mixing", mixing),
    ("pieces", pieces),
]

# Sampling and the nearest examples have no counterpart in SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), new_folder(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
