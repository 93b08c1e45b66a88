"""Corpus pipeline: toxicity, language ID, near duplicates, benchmark decontamination, packing.

Each stage calls one operator of ``swipeflow.llm`` over everything its predecessor
kept, and its decisions take effect: documents that are toxic or in no known
language go, one document of each near-duplicate group stays, documents that
hold a benchmark passage go, and what is left is packed. All stages but the last
return the columns of ``documents``; the last returns pieces of sequences.

Each stage's result is written as Parquet to the shared folder and read again as
the next one's input, so a lost executor never repeats a finished stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipeflow.llm import decontam, jaccard_join, langid, packing, toxicity
from swipeflow.llm.common import ship_package, table
from swipeflow.session import scratch_dir

TOXIC_AT = 0.5


def _carried(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral column names, so that none clashes with a prediction, and the names to give back."""
    names = {f"_c{i}": c for i, c in enumerate(docs.columns)}
    return docs.toDF(*names), names


def _restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*(F.col(k).alias(c) for k, c in names.items()))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC_AT``."""
    ship_package(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    carried, names = _carried(docs)
    own = {c: k for k, c in names.items()}
    scored = toxicity.score(carried, model, own["doc_id"], own["text"], keep=tuple(names))
    return _restored(scored.filter(F.col("score") < TOXIC_AT), names)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter that are within the learned distance of some learned language."""
    ship_package(spark)
    known = langid.learn_profiles(docs)
    carried, names = _carried(docs)
    own = {c: k for k, c in names.items()}
    named = langid.identify(carried, known, own["doc_id"], own["text"], keep=tuple(names))
    return _restored(named.filter("is_known"), names)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, a null id last."""
    ship_package(spark)
    return jaccard_join.keep_one(docs, null_ids_stay=False)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences (see ``packing``)."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned scores and byte-pair ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
