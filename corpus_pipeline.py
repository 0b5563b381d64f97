"""A training-data pipeline over ``documents``, in five stages of ``kpool.llm``.

Each stage takes all rows that its predecessor kept, is written as Parquet in
the cluster's shared folder and read again.  All stages but the last return
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpool.llm._io import Scratch, fresh, ship
from kpool.llm._tree import MAX_EPOCHS, SEED, WEIGHTS, levels
from kpool.llm.mixing import mix, repeat_copies
from kpool.llm.packing import pack, token_pieces
from kpool.llm.quality import keep_good
from kpool.llm.queries import SEQUENCE, word_tokenizer
from kpool.llm.simhash import keep_one_of_each
from kpool.llm.substring import dedup_substrings


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base test or are likely bad go."""
    return keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each near-duplicate component stays."""
    return keep_one_of_each(docs, radius=3, shingle=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word windows are cut out of the texts; ``n_chars``
    (if there) follows the text.  Documents left without words stay as rows."""
    out = dedup_substrings(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many rows of each document as epochs take it; some take none."""
    copies = fresh(docs.columns, "copies")
    return repeat_copies(mix(docs, levels(), WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED, copies=copies), copies)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows with their sequence and offset; copies are rows of their own."""
    return pack(token_pieces(docs, word_tokenizer(), SEQUENCE), SEQUENCE)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

#: EM, SimHash components and packing are not expressible in SQL; tests/llm/test_pipeline.py holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), Scratch()
    for name, stage in STAGES:
        now = Scratch()
        docs = now.write(stage(spark, docs, sf_dir), f"stage-{name}")
        before.drop()
        before = now
    return docs
