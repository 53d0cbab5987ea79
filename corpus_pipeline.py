"""A corpus pipeline of the llm operators: toxicity, quality, near copies, repeated passages, packing.

Each stage works on all rows that the one before it kept, written as Parquet and read again. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnframe.llm import packing, quality, repeats, simhash, toxicity
from cairnframe.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Repeated strings of so many bytes, in runs of more than 50 words, are taken out: shorter than op4's 400 bytes,
#: as passages of little more than 50 words have some 250 to 400 bytes.
REPEAT_BYTES, REPEAT_WORDS = 240, 51


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go.

    Null and empty texts score as the intercept does, so they stay unless most labels are toxic; whole
    texts count, however long. Repeated rows have equal scores and stay or go together; a score of
    exactly 0.5 is toxic. A null doc_id is held out of learning. An empty table gives no rows, empty
    labels keep all. Columns besides COLUMNS are dropped; none of theirs can clash with the operator's.
    """
    scored = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or consist of their host's frequent lines go; the others lose these lines.

    Null and empty texts have no words and go. A null source is a host of its own. Repeated rows count
    as one document and share their verdict; a line in exactly the greatest number of documents is not
    frequent. Long texts are handled whole. An empty table gives no rows; other columns are dropped.
    """
    judged = quality.quality_rules(docs, keep=["doc_id", "lang", "source"], with_text=True).where("kept")
    return judged.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the least doc_id.

    Null, empty and blank texts have fingerprint zero and are near copies of each other. Of rows that
    tie for a group, by sharing this doc_id or having none, one stays. An empty table gives no rows;
    other columns are dropped.
    """
    return simhash.one_of_each(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words that are found elsewhere too are taken out of the texts.

    Null and empty texts become empty; a text that is repeated as a whole does too, in all rows that
    have it. Characters cut in the middle go. Long texts are handled whole, every row stays, and an
    empty table gives no rows; other columns are dropped.
    """
    cut = repeats.remove_repeats(docs, REPEAT_BYTES, keep=["doc_id", "lang", "source"], with_text=True, min_words=REPEAT_WORDS)
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of equal length; a row for each piece of a document.

    Null and empty texts give the one token that ends a document. Repeated rows are documents of their
    own, long texts are cut into pieces without loss, an empty table gives no rows, other columns are
    ignored.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: The classifier, the trie join and the tokenizer are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; what is between them lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
