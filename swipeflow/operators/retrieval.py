"""Top-k reports, report context, alert documents and similarity search.

Top-k per group uses ``row_number() <= k``: Catalyst adds a partial
WindowGroupLimit before the shuffle, so each map task forwards at most k rows
per group and no group is ever gathered whole. Broadcasts are limited to
sides whose row count was checked against a bound first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..session import materialize, scratch_dir
from .merge import path_exists

SEARCH_QUESTIONS = K.SEARCH_QUESTIONS
RAG_QUESTIONS = K.RAG_QUESTIONS

MAX_BROADCAST_QUERIES = 10_000


def top_fraud_days(daily: DataFrame, as_of: str, days_back: int = 7, n: int = 20) -> DataFrame:
    """H3: days since the cutoff with the most fraud (ties by key)."""
    cutoff = F.date_sub(C.as_of_date(as_of), days_back)
    return (
        daily.filter(F.col("txn_date") >= cutoff)
        .orderBy(F.desc("fraud_count"), "txn_date", "merchant_category", "card_type")
        .limit(n)
    )


def top_alerts(alerts: DataFrame, as_of: str, n: int = 10) -> DataFrame:
    """This year's HIGH and CRITICAL alerts by fraud amount."""
    return (
        alerts.filter(
            (F.col("txn_year") == F.year(C.as_of_ts(as_of))) & F.col("severity").isin("HIGH", "CRITICAL")
        )
        .orderBy(
            F.desc("fraud_amount_usd"), "txn_month", "txn_day", "txn_hour", "merchant_category", "merchant_state"
        )
        .limit(n)
    )


def risky_customers(c360: DataFrame, n: int = 5) -> DataFrame:
    """HIGH-tier customers with the most fraud flags."""
    return (
        c360.filter(F.col("risk_tier") == "HIGH")
        .orderBy(F.desc("fraud_flag_count"), "customer_id")
        .select("customer_id", "home_state", "credit_score", "fraud_flag_count", "lifetime_spend_usd", "risk_tier")
        .limit(n)
    )


def fixed_scores(silver: DataFrame) -> DataFrame:
    """Score table with a fixed probability formula of the offset (used to
    check the score-table operators without a trained model)."""
    milli = (F.col("kafka_offset") * 7919) % 1000
    p = milli / 1000.0
    return silver.filter(F.col("dq_passed")).select(
        "transaction_id",
        milli.alias("score_milli"),
        F.col("is_fraud").cast("double").alias("label"),
        (p >= 0.5).cast("double").alias("prediction"),
        p.alias("fraud_probability"),
        C.score_band(p).alias("fraud_score_band"),
    )


def score_band_counts(scores: DataFrame) -> DataFrame:
    """F8."""
    return scores.groupBy("fraud_score_band").agg(F.count(F.lit(1)).alias("txn_count"))


def very_high_summary(scores: DataFrame) -> DataFrame:
    """count and mean probability of the VERY_HIGH band."""
    return scores.filter(F.col("fraud_score_band") == "VERY_HIGH").agg(
        F.count(F.lit(1)).alias("very_high_count"),
        F.sum("score_milli").alias("_m"),
    ).select("very_high_count", C.rquot("_m", "very_high_count", 1000, 10**6).alias("avg_prob"))


def fraud_context(daily, alerts, c360, scores, as_of: str, days_back: int = 7) -> DataFrame:
    """L1 as tidy rows: (section, item_rank, label, count_value, amount_value).

    Four bounded sub-results (20 + 10 + 5 + 1 rows) in one frame.
    """
    rank = lambda *o: F.row_number().over(Window.orderBy(*o))  # noqa: E731 - over <= 20 rows
    d = top_fraud_days(daily, as_of, days_back).select(
        F.lit("daily_summary").alias("section"),
        rank(F.desc("fraud_count"), "txn_date", "merchant_category", "card_type").alias("item_rank"),
        F.concat_ws("|", F.col("txn_date").cast("string"), "merchant_category", "card_type").alias("label"),
        F.col("fraud_count").cast("long").alias("count_value"),
        F.col("fraud_amount_usd").cast("decimal(18,2)").alias("amount_value"),
    )
    a = top_alerts(alerts, as_of).select(
        F.lit("high_severity_alerts").alias("section"),
        rank(F.desc("fraud_amount_usd"), "txn_month", "txn_day", "txn_hour", "merchant_category",
             "merchant_state").alias("item_rank"),
        F.concat_ws("|", F.col("alert_ts").cast("string"), "merchant_category", "merchant_state").alias("label"),
        F.col("fraud_count").cast("long").alias("count_value"),
        F.col("fraud_amount_usd").cast("decimal(18,2)").alias("amount_value"),
    )
    r = risky_customers(c360).select(
        F.lit("high_risk_customers").alias("section"),
        rank(F.desc("fraud_flag_count"), "customer_id").alias("item_rank"),
        F.col("customer_id").alias("label"),
        F.col("fraud_flag_count").cast("long").alias("count_value"),
        F.col("lifetime_spend_usd").cast("decimal(18,2)").alias("amount_value"),
    )
    s = very_high_summary(scores).select(
        F.lit("ml_very_high_scores").alias("section"),
        F.lit(1).alias("item_rank"),
        F.format_string("%.4f", F.coalesce(F.col("avg_prob"), F.lit(0.0))).alias("label"),
        F.col("very_high_count").cast("long").alias("count_value"),
        F.lit(None).cast("decimal(18,2)").alias("amount_value"),
    )
    return reduce(DataFrame.unionByName, [d, a, r, s])


def alert_documents(alerts: DataFrame, n: int | None = 500) -> DataFrame:
    """L2: alerts (fraud_count > 0) rendered as English sentences with a
    stable natural-key id and a metadata struct. ``n`` keeps the top ``n`` by
    fraud amount (the indexing report); ``None`` renders every alert."""
    df = alerts.filter(F.col("fraud_count") > 0)
    if n is not None:
        df = df.orderBy(
            F.desc_nulls_last("fraud_amount_usd"),
            *[F.asc_nulls_last(c) for c in
              ("txn_year", "txn_month", "txn_day", "txn_hour", "merchant_category", "merchant_state")],
        ).limit(n)
    u = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    day = F.when(
        F.col("txn_year").isNotNull() & F.col("txn_month").isNotNull() & F.col("txn_day").isNotNull(),
        F.format_string("%d-%02d-%02d", F.col("txn_year"), F.col("txn_month"), F.col("txn_day")),
    ).otherwise(F.lit("unknown date"))
    # fixed sentence pattern of the alert renderer
    text = F.concat(
        F.lit("On "), day,
        F.lit(" at hour "), u("txn_hour"),
        F.lit(", "), F.col("fraud_count").cast("string"),
        F.lit(" fraudulent "), u("merchant_category"),
        F.lit(" transactions occurred in "), u("merchant_state"),
        F.lit(" totalling "), F.coalesce(C.money_text("fraud_amount_usd"), F.lit("$0.00")),
        F.lit(", affecting "), F.col("affected_customers").cast("string"),
        F.lit(" customers. Severity: "), F.col("severity"), F.lit("."),
    )
    doc_id = F.concat_ws("-", u("txn_year"), u("txn_month"), u("txn_day"), u("txn_hour"), u("merchant_category"),
                         u("merchant_state"))
    return df.select(
        doc_id.alias("doc_id"),
        text.alias("doc"),
        F.substring(text, 1, 120).alias("preview"),
        F.struct(
            F.col("merchant_category").alias("category"),
            F.col("merchant_state").alias("state"),
            F.col("severity").alias("severity"),
            F.col("txn_month").alias("month"),
            F.col("txn_year").alias("year"),
        ).alias("meta"),
        "fraud_amount_usd",
    )


# --- dense vectors -------------------------------------------------------------


def _batch_topk(bc_queries, k: int):
    """mapInPandas body: cosine of each corpus row against every query with
    one matrix product per Arrow batch; keeps the batch's best k per query
    (all rows tied with the k-th are kept, so the final rank is exact)."""
    import numpy as np
    import pandas as pd

    def run(batches):
        q_ids, q_unit = bc_queries.value
        for pdf in batches:
            pdf = pdf[pdf["_v"].notna()]
            if pdf.empty:
                continue
            d = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["_v"]])
            norms = np.linalg.norm(d, axis=1)
            ok = norms > 0
            d, ids = d[ok] / norms[ok, None], pdf["doc_id"].to_numpy()[ok]
            if len(ids) == 0:
                continue
            sims = np.round(d @ q_unit.T, 9)  # rows: corpus, columns: queries; equal vectors tie in any batch
            kk = min(k, len(ids))
            kth = np.partition(sims, len(ids) - kk, axis=0)[len(ids) - kk]
            rows, cols = np.nonzero(sims >= kth)
            yield pd.DataFrame({"query_id": q_ids[cols], "doc_id": ids[rows], "_sim": sims[rows, cols]})

    return run


def vector_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    max_queries: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """Exact cosine top-k of every query over the corpus.

    Up to ``max_queries`` queries (64-wide vectors: 10k queries ~ 5 MB) are broadcast as one matrix; more are
    joined with the corpus in blocks (``vector_join``), exactly as well. Corpus partitions score
    Arrow batches with numpy (one matrix product per batch) and forward at
    most ~k candidates per query; ``row_number() <= k`` then picks the final
    top-k per query, again with a partial limit before its shuffle.
    """
    import numpy as np

    spark = corpus.sparkSession
    rows = queries.select("query_id", "query_vec").limit(max_queries + 1).collect()  # bounded
    if len(rows) > max_queries:
        from .vector_join import Hashing, vector_topk_join

        return vector_topk_join(corpus, queries, k, id_col, vec_col, hashing=Hashing(0, 1))
    c = corpus.select(F.col(id_col).alias("doc_id"), F.col(vec_col).alias("_v"))
    id_type = dict(c.dtypes)["doc_id"]
    qid_type = dict(queries.dtypes)["query_id"]
    if not rows:
        return spark.createDataFrame([], f"query_id {qid_type}, rank int, doc_id {id_type}, similarity double")
    q_ids = np.array([r[0] for r in rows])
    qm = np.array([np.asarray(r[1], dtype=np.float64) for r in rows])
    norms = np.linalg.norm(qm, axis=1, keepdims=True)
    q_unit = qm / np.where(norms > 0, norms, 1.0)  # a zero query is equally far (0) from all
    bc = spark.sparkContext.broadcast((q_ids, q_unit))
    scored = c.mapInPandas(_batch_topk(bc, k), f"query_id {qid_type}, doc_id {id_type}, _sim double")
    w = Window.partitionBy("query_id").orderBy(F.desc("_sim"), "doc_id")
    near = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return near.select("query_id", "rank", "doc_id", F.round("_sim", 4).alias("similarity"))


def label_centroids(emb: DataFrame) -> DataFrame:
    """Query vectors derived from the table: the mean vector of each label."""
    dims = F.size("embedding")
    exploded = emb.select("label", F.posexplode("embedding").alias("i", "x"))
    per_dim = exploded.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return per_dim.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("query_vec")
    ).select(F.col("label").alias("query_id"), "query_vec")


# --- sparse text retrieval (TF-IDF over an inverted index) ---------------------


def tokens(df: DataFrame, id_col: str, text_col: str, analyzer: str = "char3") -> DataFrame:
    """(id, term, tf) over whole texts. Words are lower-case alphanumeric
    runs; ``char3`` (default) turns each word, padded with one space on each
    side, into its character trigrams, so inflections still match ("fraud" /
    "fraudulent", "severe" / "severity"); ``word`` keeps whole words."""
    words = df.select(
        F.col(id_col).alias("id"), F.explode(F.split(F.lower(F.col(text_col)), "[^a-z0-9]+")).alias("w")
    ).filter(F.length("w") > 0)
    if analyzer == "word":
        t = words.select("id", F.col("w").alias("term"))
    else:
        padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))
        grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, 3))
        t = words.select("id", F.explode(grams).alias("term"))
    return t.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def build_term_index(corpus: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "doc", analyzer: str = "char3") -> None:
    """L3: the inverted index, stored once for all searches: ``postings`` (term, id, w, norm), ``documents`` (id) and
    ``terms`` (term, idf).

    A posting carries the norm of its document, so a search joins one table. A term that
    occurs in every document has idf 0 and adds nothing to any product or norm: it has no list, and the
    longest lists go. IDF = ln((N + 1) / (df + 1)) as in Spark ML. Postings are sorted by term, so Parquet
    statistics skip the lists that no question asks for."""
    dt = materialize(tokens(corpus, id_col, text_col, analyzer))
    n_docs = corpus.count()
    terms = dt.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    terms = materialize(terms.select("term", F.log(F.lit(n_docs + 1) / (F.col("df") + 1)).alias("idf")))
    weights = dt.join(terms.filter("idf > 0"), "term").select("id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norms = weights.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = weights.join(norms, "id").select("term", "id", "w", "norm")
    unit.repartitionByRange("term", "id").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
    norms.select("id").write.mode("overwrite").parquet(f"{path}/documents")
    terms.write.mode("overwrite").parquet(f"{path}/terms")


def term_index_exists(spark: SparkSession, path: str) -> bool:
    """The terms are written last."""
    return path_exists(spark, f"{path}/terms/_SUCCESS")


def search_index(spark: SparkSession, path: str, questions: DataFrame, k: int = 3, analyzer: str = "char3") -> DataFrame:
    """Cosine of TF-IDF vectors, exact: the questions' terms join the stored lists of these terms (an
    equi-join, hot terms split by AQE), products are summed per (question, document), top-k per question.

    A question that holds a term of every document is answered with k documents: those that share no other
    term with it follow with similarity 0, in the order of their ids."""
    postings, terms = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms")
    asked = tokens(questions, "question_id", "question", analyzer).join(terms, "term")
    qw = asked.filter("idf > 0").select(F.col("id").alias("question_id"), "term", (F.col("tf") * F.col("idf")).alias("qw"))
    qn = qw.groupBy("question_id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    dots = qw.join(postings, "term").groupBy("question_id", "id").agg(F.sum(F.col("qw") * F.col("w")).alias("dot"), F.min("norm").alias("norm"))
    # scores rounded to 10 places before ranking, so mathematically equal
    # scores (templated texts) tie exactly and the doc_id tie-break decides
    scored = dots.join(qn, "question_id").select("question_id", F.col("id").alias("doc_id"), F.round(F.col("dot") / (F.col("norm") * F.col("qnorm")), 10).alias("_s"))
    w = Window.partitionBy("question_id").orderBy(F.desc("_s"), "doc_id")
    near = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("rank")
    first = spark.read.parquet(f"{path}/documents").orderBy("id").limit(2 * k)  # of these at least k are not among the near ones
    ids = [r["id"] for r in first.collect()]
    if ids:
        rest = asked.filter("idf = 0").join(qn, asked["id"] == qn["question_id"]).select("question_id").distinct()
        zero = rest.select("question_id", F.explode(F.array(*[F.lit(i) for i in ids])).alias("doc_id"), F.lit(0.0).alias("_s"))
        near = near.unionByName(zero).groupBy("question_id", "doc_id").agg(F.max("_s").alias("_s"))
    return (
        near.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("question_id", "rank", "doc_id", F.round("_s", 4).alias("similarity"))
    )


def tfidf_search(corpus: DataFrame, questions: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "doc", analyzer: str = "char3") -> DataFrame:
    """``build_term_index`` and one search, for a corpus that is searched once."""
    path = scratch_dir(corpus.sparkSession, "term-index")
    build_term_index(corpus, path, id_col, text_col, analyzer)
    return search_index(corpus.sparkSession, path, questions, k, analyzer)


def rag_context(hits: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "doc") -> DataFrame:
    """One context text per question: hits numbered ``[Alert i]: text``
    joined by blank lines (each group holds at most k rows)."""
    j = hits.join(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), "doc_id")
    return j.groupBy("question_id").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rank", "_text"))),
                lambda s: F.concat(F.lit("[Alert "), s["rank"].cast("string"), F.lit("]: "), s["_text"]),
            ),
            "\n\n",
        ).alias("context"),
        F.count(F.lit(1)).alias("n_hits"),
    )


def question_frame(spark: SparkSession, questions: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(questions, 1)), "question_id INT, question STRING")
