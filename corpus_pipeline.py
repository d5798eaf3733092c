"""From raw documents to token ids, in five stages; each reads what the stage before it wrote.

A stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``; the last
returns ids. Null and empty texts, repeated rows, empty tables and more columns do what the operators
say. Rows with the same doc_id are one document, and stay or go together; rows without one are never
taken for a copy of another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.checks.registry import table
from cairn.llm import byte_pairs, decontamination, jaccard_join, line_dedup, quality_classifier
from cairn.llm.queries import vocabulary
from cairn.llm.staging import stage
from cairn.llm.texts import remainder

ACCEPTED = 0.7


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ``ACCEPTED``."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    learning = docs.where(remainder("doc_id", 4) != 2)
    model = quality_classifier.fit(quality_classifier.features(learning).join(labels, "doc_id"))
    return quality_classifier.score_documents(docs, model).where(F.col("score") >= ACCEPTED).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; a text left without a word goes. ``n_chars`` follows."""
    kept = line_dedup.dedup_lines(docs)
    rest = kept.where((F.col("n_dropped") == 0) | (F.length(F.btrim("row.text", F.lit(line_dedup.BLANKS))) > 0)).select("row.*")
    return rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rest


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    copies = jaccard_join.jaccard_components(docs).where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are benchmark passages."""
    found = decontamination.find_matches(docs, table(spark, sf_dir, "benchmark"), passages=False)
    return found.where(~F.col("contaminated")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text."""
    return byte_pairs.encode_documents(docs, vocabulary(), keep=True).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", reject_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_pairs", encode),
]

#: A Gaussian discriminant and byte-pair merges cannot be stated in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
