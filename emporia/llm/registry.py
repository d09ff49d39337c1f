"""Named queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm import (
    archives, filter_audit, language_model, main_text, neighbours, packing, pii, quality, simhash, tiling, token_files, toxicity,
    vector_codes,
)
from emporia.llm.common import crc_split, table
from emporia.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_split(F.col("doc_id"), 3) != 1)
    scored = toxicity.annotate(docs.select("doc_id", "text"), model)
    score = F.col("toxicity.score")
    return scored.select(
        "doc_id",
        (crc_split(F.col("doc_id"), 3) == 1).alias("held_out"),
        score.alias("score"),
        (score >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("toxicity.passages").alias("passages"),
    )


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per piece of every document, packed in windows of 2048."""
    cut = packing.pieces(table(spark, sf_dir, "documents"), digest=True)
    return packing.pack(cut).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base spans counted and hashed, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.annotate(docs, pii.train(docs))
    base = F.col("pii.base")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(pii.every_span(F.col("pii"))).alias("spans"),
    )


@query
def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document, learned from the rows that aren't held out."""
    held_out = crc_split(F.col("doc_id"), 10) == 0
    scored = language_model.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), crc_split(F.col("doc_id"), 4) != 2)
    scored = quality.annotate(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        (crc_split(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item that the document gives away."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an ARC record, converted to WARC and read back."""
    found = archives.pages_to_warc(table(spark, sf_dir, "pages"), fresh_dir(spark, "archives"), min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, 4 bits."""
    found = simhash.components(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to token files and read back."""
    path = fresh_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code of four bytes, with its error and its label's."""
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


@query
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text, by the winning paths of its host."""
    found = main_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, per source: what each step removes, and the filters' Shapley sums."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op13_filter_audit"] = filter_audit.AUDIT_SQL
