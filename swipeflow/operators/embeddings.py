"""Learned dense embeddings of short texts (L3): word vectors trained once, documents as their means.

``Word2Vec`` is fitted on the collection's words and saved with the documents' vectors under one folder;
later searches load both and train nothing. Questions are embedded with the stored model and searched
by the exact cosine top-k. Words that the model does not know add nothing; a text of unknown words has a
zero vector (no neighbours as a document, equally far from all as a question).

Bounds: the fitted vocabulary lives on the driver and is broadcast (``max_words`` most frequent words,
64 doubles each: 50 MB at most); training reads at most about ``fit_rows`` documents, chosen by a hash of their id.
"""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .merge import path_exists
from .retrieval import vector_topk

MAX_WORDS = 100_000
FIT_ROWS = 2_000_000


def with_words(df: DataFrame, text_col: str, out: str = "_words") -> DataFrame:
    """Lower-case alphanumeric runs of a text; a null text has none."""
    runs = F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z0-9]+")
    return df.withColumn(out, F.filter(runs, lambda w: F.length(w) > 0))


def frequent_words(words: DataFrame, max_words: int) -> int:
    """The smallest count a word may have so that at most ``max_words`` stay (one row comes back)."""
    counts = words.select(F.explode("_words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n"))
    kept = 0
    for row in by_count.limit(max_words + 1).toLocalIterator():  # each count holds a word at least
        kept += row["words"]
        if kept > max_words:
            return row["n"] + 1
    return 1


def train(docs: DataFrame, text_col: str = "doc", id_col: str = "doc_id", size: int = 64, partitions: int = 1, seed: int = 7, fit_rows: int = FIT_ROWS, max_words: int = MAX_WORDS) -> Word2VecModel:
    words = with_words(docs, text_col)
    n = docs.count()
    if n > fit_rows:
        words = words.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(fit_rows / n * (1 << 30)))
    least = frequent_words(words, max_words)
    # a fixed order of the sentences, so that equal input trains equal vectors
    ordered = words.select(id_col, "_words").sort(id_col) if partitions == 1 else words
    return Word2Vec(vectorSize=size, minCount=least, numPartitions=partitions, maxIter=8, stepSize=0.05, windowSize=5, seed=seed, inputCol="_words", outputCol="_vector").fit(ordered)


def embed(model: Word2VecModel, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, embedding): the mean of the word vectors of a text."""
    return model.transform(with_words(df, text_col)).select(id_col, vector_to_array("_vector").alias("embedding"))


def build_collection(docs: DataFrame, path: str, **training) -> None:
    """Train on ``docs`` (doc_id, doc) and store the model and the documents' vectors."""
    model = train(docs, **training)
    embed(model, docs, "doc_id", "doc").write.mode("overwrite").parquet(f"{path}/vectors")
    model.write().overwrite().save(f"{path}/model")


def collection_exists(spark: SparkSession, path: str) -> bool:
    """The model is written last."""
    return path_exists(spark, f"{path}/model/metadata/_SUCCESS")


def search(spark: SparkSession, path: str, questions: DataFrame, k: int = 3) -> DataFrame:
    """The k nearest stored documents of every question (question_id, question), by the stored model."""
    asked = embed(Word2VecModel.load(f"{path}/model"), questions, "question_id", "question")
    hits = vector_topk(spark.read.parquet(f"{path}/vectors"), asked.select(F.col("question_id").alias("query_id"), F.col("embedding").alias("query_vec")), k, id_col="doc_id")
    return hits.withColumnRenamed("query_id", "question_id")
