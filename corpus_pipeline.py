"""A training corpus out of ``documents``: stages of the operators in ``tallyline.llm``.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns the columns of the documents, the last one the packed pieces. Rows that share
an identifier are one document and stay or go together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import common, exact, packing, quality, secrets, simhash


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose identifier is among those kept."""
    own = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(own, docs["doc_id"].eqNullSafe(own["kept_id"]), "left_semi")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at or over its threshold."""
    model = quality.train(docs, common.table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).where(F.col("score") >= quality.THRESHOLD).select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest identifier."""
    return _only(docs, exact.exact_groups(docs).where("kept"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest identifier."""
    return _only(docs, simhash.components(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` counted again for those."""
    found = secrets.scan(docs)
    text = F.coalesce("found.masked", "doc.text")
    changed = {"text": text, "n_chars": F.when(F.col("found.masked").isNull(), F.col("doc.n_chars")).otherwise(F.char_length("found.masked")) if "n_chars" in docs.columns else None}
    return found.select(*[changed[c].alias(c) if changed.get(c) is not None else F.col(f"doc.`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents fill."""
    return packing.pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_filter),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Fingerprints, scores and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
