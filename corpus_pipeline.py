"""The corpus pipeline: documents in, packed training sequences out, one operator a stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import fertility, line_runs, packing, queries, simhash, toxicity
from stopwise.llm.common import shared_root, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or of their sentences calls toxic go."""
    model = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).where(F.col("toxicity.score") < 0.5).select(*COLUMNS)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the fertility bands go."""
    return fertility.rate(docs, queries.fertility_config()).where("kept").select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least ten documents go; a document may become empty and stays."""
    out = line_runs.dedup_lines(docs, min_docs=10, min_chars=1)
    return out.withColumn("text", F.col("kept")).withColumn("n_chars", F.char_length("kept").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs, words=3, max_bits=3).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(queries.WORDS), size=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack_sequences),
]

#: The stages train a model and use tokenizers, which SQL can't express; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on the table the one before has written."""
    docs, folder = queries.table(spark, sf_dir, "documents"), shared_root(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"{k}-{name}")
    return docs
