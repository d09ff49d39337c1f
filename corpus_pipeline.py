"""The documents' pipeline: one operator of ``emporia.llm`` per stage.

Each stage works on all that the one before kept, and its decisions take
effect: toxic documents go, one document of each group of near duplicates
stays, documents that give a benchmark item away go, personal data is replaced
in the texts, and what is left is packed.  All but the last return the columns
of ``documents``.

In every stage: null texts count as empty (and stay null where the text isn't
changed), rows are told apart by their columns and not by their ids, so
repeated ids lose no text; columns of other names pass through unread, also
where an operator uses such names itself; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import packing, pii, simhash, tiling, toxicity
from emporia.llm.common import crc_split, free_name, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model learned from the labelled ones among them."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_split(F.col("doc_id"), 3) != 1)
    name = free_name(docs, "toxicity")
    scored = toxicity.annotate(docs, model, name)
    return scored.filter(F.col(f"{name}.score") < toxicity.THRESHOLD).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: 4-word shingles, at most 4 differing bits."""
    return simhash.representatives(docs, shingle=4, max_distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item is covered by."""
    return tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; ``n_chars`` follows."""
    clean = pii.redact(docs, pii.train(docs))
    if "n_chars" in clean.columns:
        length = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
        clean = clean.withColumn("n_chars", length)
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(packing.pieces(docs, digest=True)).drop("piece_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", redact),
    ("packing", pack),
]

#: Learned scores, similarity components and packing aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
