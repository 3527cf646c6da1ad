"""Corpus preparation: from raw documents to the token ids of a clean, mixed corpus.

Each stage takes (spark, docs, sf_dir), docs with the columns of documents, and works on all that the stage before kept.
All but the last return the same columns; ``run`` writes each stage's rows and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.llm import bpe, lines, mixing, near_documents, quality
from pressmill.session import cut_lineage

#: share of the tokens that mixing keeps
MIX_BUDGET = 0.8


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer accepts."""
    return quality.score_documents(docs).where("kept").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that no earlier line resembles; a document that loses all its words goes."""
    kept = lines.kept_lines(docs).where((F.col("n_removed") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row")["n_chars"]) if "n_chars" in docs.columns else None
    changed = {"text": F.col("kept"), "n_chars": n_chars}
    return kept.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id; rows without an id stay."""
    gone = near_documents.near_documents(docs).where("id <> component_id").select("id")
    return docs.join(gone, docs["doc_id"] == gone["id"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the targets of sources, languages and topics."""
    return mixing.sample(docs, budget=MIX_BUDGET)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of each text as little-endian unsigned 32-bit integers."""
    out = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return out.select(F.col("id").alias("doc_id"), "n_tokens", "ids")


STAGES = [("quality classifier", keep_good), ("line dedup", drop_repeated_lines), ("n-gram Jaccard join", keep_one_of_each_group),
          ("mixing sources", mix_sources), ("BPE encoding", to_tokens)]
#: SQL can't express the scorer, the join of shingle sets and the encoding; the tests hold them against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
