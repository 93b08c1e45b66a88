"""Named queries over the given tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each builds the medallion lineage lazily from the parquet tables, so Catalyst
sees one plan per query (pruned scans, pushed filters) and every query's work
grows with the tables it reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import constants as K
from ..operators import gold, silver
from ..sources import tables

AS_OF = K.AS_OF
NEXT_RUN = "2024-02-02 00:00:00"
ONE_DAY = "2024-01-10"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


# --- shared lineage -----------------------------------------------------------


def bronze(spark, d) -> DataFrame:
    return tables.raw_transactions(spark, d)


def cleansed(spark, d) -> DataFrame:
    return silver.cleanse_transactions(bronze(spark, d))


def silver_txn(spark, d) -> DataFrame:
    return silver.silver_transactions(bronze(spark, d), AS_OF)


def customers(spark, d) -> DataFrame:
    return silver.cleanse_customers(tables.raw_customers(spark, d), AS_OF)


def enriched(spark, d) -> DataFrame:
    return silver.enrich_transactions(silver_txn(spark, d), customers(spark, d))


def staging(spark, d, raw: DataFrame | None = None) -> DataFrame:
    """Warehouse staging copy: raw rows with a typed timestamp."""
    from ..functions.columns import parse_ts

    return (bronze(spark, d) if raw is None else raw).withColumn("transaction_ts", parse_ts("transaction_ts"))


def snapshot(spark, d) -> tuple[DataFrame, DataFrame]:
    """(Bronze, Silver) written once, for reports that read them many times: the given tables are scanned once."""
    from ..session import materialize

    raw = materialize(bronze(spark, d))
    return raw, materialize(silver.silver_transactions(raw, AS_OF))


# --- Silver -------------------------------------------------------------------

_DEDUP_COLS = ["transaction_id", "customer_id", "amount_usd", "transaction_ts", "kafka_offset", "dq_passed"]


@register("parse_and_cleanse")
def q_parse_and_cleanse(spark, d):
    return cleansed(spark, d).select(
        "transaction_id",
        "customer_id",
        "card_type",
        "merchant_category",
        "merchant_state",
        "amount_usd",
        "currency",
        "transaction_ts",
        "response_code",
        "kafka_offset",
        "dq_passed",
    )


@register("dedup_latest")
def q_dedup_latest(spark, d):
    return silver.deduplicate(cleansed(spark, d)).select(*_DEDUP_COLS)


@register("dedup_keep_null_keys")
def q_dedup_keep_null_keys(spark, d):
    return silver.deduplicate(cleansed(spark, d), keep_null_keys=True).select(*_DEDUP_COLS)


@register("derive_features")
def q_derive_features(spark, d):
    return silver_txn(spark, d).select(
        "transaction_id",
        "kafka_offset",
        "txn_year",
        "txn_month",
        "txn_day",
        "txn_hour",
        "txn_day_of_week",
        "is_weekend",
        "is_late_night",
        "txn_quarter",
    )


@register("cleanse_customers")
def q_cleanse_customers(spark, d):
    return customers(spark, d)


@register("enrich_left_join")
def q_enrich(spark, d):
    return enriched(spark, d).select(
        "transaction_id",
        "kafka_offset",
        "customer_id",
        "merchant_state",
        "amount_usd",
        "home_state",
        "credit_score",
        "credit_limit_usd",
        "account_age_days",
        "cust_card_type",
        "is_cross_state",
        "amount_to_limit_ratio",
    )


@register("silver_quality_report")
def q_silver_quality(spark, d):
    return silver.silver_quality_report(silver_txn(spark, d))


@register("wrangle_variant")
def q_wrangle(spark, d):
    return silver.wrangle_transactions(staging(spark, d)).select(
        "transaction_id",
        "kafka_offset",
        "merchant_category",
        "merchant_state",
        "card_type",
        "currency",
        "txn_hour",
        "txn_day_of_week",
        "txn_month",
        "txn_year",
        "is_weekend",
        "is_late_night",
        "dq_passed",
    )


# --- Gold ---------------------------------------------------------------------


@register("daily_txn_summary")
def q_daily(spark, d):
    return gold.daily_txn_summary(silver_txn(spark, d))


@register("customer_360")
def q_customer_360(spark, d):
    return gold.customer_360(enriched(spark, d), customers(spark, d))


@register("fraud_alerts_hourly")
def q_alerts(spark, d):
    return gold.fraud_alerts_hourly(silver_txn(spark, d))


@register("state_performance")
def q_state(spark, d):
    return gold.state_performance(silver_txn(spark, d))


@register("executive_kpi")
def q_kpi(spark, d):
    return gold.executive_kpi(gold.daily_txn_summary(silver_txn(spark, d)))


@register("card_type_analysis")
def q_card_type(spark, d):
    return gold.card_type_analysis(silver_txn(spark, d))


@register("hourly_summary")
def q_hourly(spark, d):
    return gold.hourly_summary(silver_txn(spark, d))


@register("merchant_daily")
def q_merchant_daily(spark, d):
    return gold.merchant_daily(silver_txn(spark, d))


@register("customer_risk")
def q_customer_risk(spark, d):
    return gold.customer_risk(silver_txn(spark, d), AS_OF)


@register("geo_daily")
def q_geo(spark, d):
    return gold.geo_daily(enriched(spark, d))


@register("card_performance")
def q_card_perf(spark, d):
    return gold.card_performance(silver_txn(spark, d))


@register("daily_summary_sql")
def q_daily_sql(spark, d):
    return gold.daily_summary_sql(staging(spark, d))


@register("daily_summary_one_day")
def q_daily_one_day(spark, d):
    """F9 as the procedure runs it: one day, which Parquet statistics prune."""
    return gold.daily_summary_sql(staging(spark, d), ONE_DAY)


@register("customer_360_sql")
def q_c360_sql(spark, d):
    return gold.customer_360_sql(staging(spark, d), tables.raw_customers(spark, d), AS_OF)


# --- upserts ------------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from ..operators import compact, embeddings, merge, ml, quality, ranking, retrieval, sequence, sinks, sketches, vector_join, windows  # noqa: E402
from ..schemas import MART_CUSTOMERS, MART_TRANSACTION_DEFAULTS, MART_TRANSACTIONS  # noqa: E402
from ..streaming import audit as stream_audit  # noqa: E402
from ..streaming import bronze_stream  # noqa: E402

_MERGE_COLS = ["transaction_id", "customer_id", "amount_usd", "transaction_ts", "kafka_offset", "dq_passed",
               "merchant_category"]


def first_delivery(spark, d):
    """Silver as of the first delivery (replayed copies not yet arrived)."""
    b = bronze(spark, d).filter(~F.col("replayed"))
    return silver.silver_transactions(b, AS_OF)


@register("merge_upsert")
def q_merge_upsert(spark, d):
    tgt = first_delivery(spark, d).select(*_MERGE_COLS)
    src = silver_txn(spark, d).select(*_MERGE_COLS)
    return merge.merge_frames(tgt, src, ["transaction_id"])


@register("merge_newer_offset")
def q_merge_newer(spark, d):
    tgt = first_delivery(spark, d).select(*_MERGE_COLS)
    off = F.col("kafka_offset")
    src = tgt.select(
        *[c for c in _MERGE_COLS if c not in ("amount_usd", "kafka_offset")],
        (F.col("amount_usd") + 1).cast("decimal(15,2)").alias("amount_usd"),
        F.when(off % 2 == 0, off + 1).otherwise(off - 1).alias("kafka_offset"),
    )
    return merge.merge_frames(tgt, src, ["transaction_id"], newer_wins="kafka_offset")


_DAILY_KEYS = ["txn_date", "merchant_category", "card_type"]


@register("merge_daily")
def q_merge_daily(spark, d):
    first = staging(spark, d).filter(~F.col("replayed"))
    tgt = gold.daily_summary_sql(first)
    src = gold.daily_summary_sql(staging(spark, d))
    measures = [c for c in tgt.columns if c not in _DAILY_KEYS + ["txn_year", "txn_month"]]
    return merge.merge_frames(tgt, src, _DAILY_KEYS, update_cols=measures)


@register("merge_customer_360")
def q_merge_c360(spark, d):
    first = staging(spark, d).filter(~F.col("replayed"))
    cust = tables.raw_customers(spark, d)
    tgt = gold.customer_360_sql(first, cust, AS_OF)
    src = gold.customer_360_sql(staging(spark, d), cust, AS_OF)
    upd = [c for c in tgt.columns if c not in ("customer_id", "avg_daily_spend")]
    return merge.merge_frames(tgt, src, ["customer_id"], update_cols=upd)


# --- data quality ---------------------------------------------------------------


@register("dq_checks")
def q_dq_checks(spark, d):
    return quality.run_checks(staging(spark, d), AS_OF)


@register("staging_checks")
def q_staging_checks(spark, d):
    return quality.staging_checks(staging(spark, d), AS_OF)


@register("dq_metrics")
def q_dq_metrics(spark, d):
    from ..session import materialize

    # Silver is read by four sub-results; only their columns are kept
    s = materialize(silver_txn(spark, d).select(*quality.METRIC_COLUMNS))
    return quality.dq_metrics(bronze(spark, d), s, quality.gold_groups(s))


@register("layer_counts")
def q_layer_counts(spark, d):
    s = silver_txn(spark, d)
    return quality.layer_counts(bronze(spark, d), s, gold.daily_txn_summary(s))


@register("null_rates")
def q_null_rates(spark, d):
    return quality.null_rates(silver_txn(spark, d))


@register("null_analysis")
def q_null_analysis(spark, d):
    from ..session import materialize

    columns = ["transaction_id", "customer_id", "merchant_category", "transaction_ts", "kafka_offset"]
    return quality.null_analysis(materialize(silver_txn(spark, d).select(*columns)), "customer_id")


@register("duplicates_both_ways")
def q_duplicates(spark, d):
    return quality.duplicate_counts(staging(spark, d))


@register("amount_outliers")
def q_outliers(spark, d):
    return quality.amount_outliers(staging(spark, d).filter(F.col("amount_usd") > 0), factor=1.0).select(
        "transaction_id", "kafka_offset", "amount_usd"
    )


@register("amount_outliers_3x")
def q_outliers_3x(spark, d):
    """D7 at the surveyed factor, over amounts among which every 211th is a hundredfold."""
    rows = staging(spark, d).filter(F.col("amount_usd") > 0)
    big = F.when(F.col("kafka_offset") % 211 == 5, F.col("amount_usd") * 100).otherwise(F.col("amount_usd")).cast("decimal(17,2)")
    return quality.amount_outliers(rows.withColumn("amount_usd", big)).select("transaction_id", "kafka_offset", "amount_usd")


def _daily_sketches(spark, d):
    """One stored sketch a day and category."""
    from ..session import materialize

    return materialize(sketches.sketch_by(silver_txn(spark, d), ["txn_year", "txn_month", "txn_day", "merchant_category"]))


@register("p99_by_month")
def q_p99_by_month(spark, d):
    """p99 by month and category, and by month over all of them, merged from the daily sketches."""
    daily = _daily_sketches(spark, d)
    by_category = sketches.merge_up(daily, ["txn_year", "txn_month", "merchant_category"])
    by_month = sketches.merge_up(by_category, ["txn_year", "txn_month"]).withColumn("merchant_category", F.lit("ALL"))
    return sketches.quantiles(by_category.unionByName(by_month), 0.99, "p99_amount_usd")


@register("p99_sketch_check")
def q_p99_sketch_check(spark, d):
    """The merged sketches against all rows: their count, and whether 0.99 lies within the stated rank error of the estimate's rank."""
    from ..session import materialize

    by = ["txn_year", "txn_month", "merchant_category"]
    estimates = materialize(sketches.quantiles(sketches.merge_up(_daily_sketches(spark, d), by), 0.99, "p99").withColumnRenamed("n", "sketched"))
    s = silver_txn(spark, d).filter("txn_month IS NOT NULL")
    ranks = sketches.rank_of_estimate(s, estimates, by, "p99").join(estimates, by)
    error = sketches.rank_error()
    fits = (F.col("rank_below") <= 0.99 + error) & (F.col("rank_upto") >= 0.99 - error)
    return ranks.select(*by, "n", "sketched", fits.alias("within_rank_error"))


@register("dq_checks_one_day")
def q_dq_checks_day(spark, d):
    return quality.run_checks(staging(spark, d), AS_OF, check_date=ONE_DAY)


@register("top_categories")
def q_top_categories(spark, d):
    return quality.top_categories(silver_txn(spark, d))


def _freshness(spark, d, raw=None, s=None):
    s = silver_txn(spark, d) if s is None else s
    return quality.freshness(
        {
            "bronze": (staging(spark, d, raw), "transaction_ts"),
            "silver": (s, "transaction_ts"),
            "gold": (gold.daily_txn_summary(s), "txn_date"),
            "mart": None,
        },
        AS_OF,
    )


@register("freshness")
def q_freshness(spark, d):
    return _freshness(spark, d)


LATER = "2024-02-02 00:10:00"


@register("load_freshness")
def q_load_freshness(spark, d):
    """F12 by load stamps: Bronze and Silver got the replayed rows in the second run, Gold was last built in the first.
    Their events are old, so only the stamps tell which layer stalls."""
    runs = [(AS_OF, bronze(spark, d).filter(~F.col("replayed"))), (NEXT_RUN, bronze(spark, d).filter("replayed"))]
    loads = [sinks.stamp_bronze(rows, "batch", at) for at, rows in runs]
    silvers = [silver.silver_transactions(rows, at) for at, rows in runs]
    daily = gold.daily_txn_summary(silvers[0]).withColumn("gold_created_at", F.lit(AS_OF).cast("timestamp"))
    layers = {
        "bronze": (loads[0].unionByName(loads[1]), "bronze_ingested_at"),
        "silver": (silvers[0].unionByName(silvers[1]), "silver_processed_at"),
        "gold": (daily, "gold_created_at"),
        "mart": None,
    }
    return quality.freshness(layers, LATER)


@register("root_cause_lookup")
def q_root_cause(spark, d):
    issues = quality.issues_from_checks(quality.run_checks(staging(spark, d), AS_OF))
    return quality.explain_issues(issues, quality.root_cause_rules(spark))


@register("alert_rules")
def q_alert_rules(spark, d):
    raw, s = snapshot(spark, d)
    return _alert_rules(spark, d, quality.run_checks(staging(spark, d, raw), AS_OF), raw, s)


def _alert_rules(spark, d, checks, raw=None, s=None):
    s = silver_txn(spark, d) if s is None else s
    model = quality.latest_model_row(ml.auc_exact(retrieval.fixed_scores(s), "score_milli"), AS_OF)
    return quality.alert_rules(_freshness(spark, d, raw, s), checks, _audit_log(spark, d, raw), model)


@register("auc")
def q_auc(spark, d):
    return ml.auc_exact(retrieval.fixed_scores(silver_txn(spark, d)), "score_milli")


@register("health_summary")
def q_health(spark, d):
    raw, s = snapshot(spark, d)
    layers = quality.layer_counts(raw, s, gold.daily_txn_summary(s))
    checks = quality.run_checks(staging(spark, d, raw), AS_OF)
    return quality.health_summary(layers, checks, _alert_rules(spark, d, checks, raw, s))


# --- RFM, windows ---------------------------------------------------------------


@register("rfm_scores")
def q_rfm(spark, d):
    return ranking.rfm_scores(gold.customer_360(enriched(spark, d), customers(spark, d)))


@register("rfm_segments")
def q_rfm_segments(spark, d):
    return ranking.segment_summary(q_rfm(spark, d))


@register("rfm_orders")
def q_rfm_orders(spark, d):
    """RFM over the long order history (many customers, heavy ties)."""
    o = tables.orders_history(spark, d)
    c360 = o.groupBy(F.col("o_custkey").cast("string").alias("customer_id")).agg(
        F.max("o_orderdate").alias("last_txn_ts"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("lifetime_spend_usd"),
        F.lit(0).alias("fraud_flag_count"),
    )
    return ranking.rfm_scores(c360)


@register("velocity")
def q_velocity(spark, d):
    return windows.velocity(enriched(spark, d).filter(F.col("dq_passed")))


@register("impossible_travel")
def q_travel(spark, d):
    return windows.impossible_travel(enriched(spark, d).filter(F.col("dq_passed")))


@register("yoy_volume")
def q_yoy(spark, d):
    return windows.yoy_volume(tables.orders_history(spark, d))


# --- top-k, context, documents, vectors ----------------------------------------


def _gold_frames(spark, d):
    from ..session import materialize

    s = materialize(silver_txn(spark, d))
    e = silver.enrich_transactions(s, customers(spark, d))
    return (
        gold.daily_txn_summary(s),
        gold.fraud_alerts_hourly(s),
        gold.customer_360(e, customers(spark, d)),
        retrieval.fixed_scores(s),
    )


@register("top_fraud_days")
def q_top_days(spark, d):
    return retrieval.top_fraud_days(gold.daily_txn_summary(silver_txn(spark, d)), AS_OF)


def _busy_silver(spark, d):
    """Silver in which some frauds come in bursts of 25 and 60, so that every severity occurs."""
    off = F.col("kafka_offset")
    times = F.when(F.col("is_fraud") & (off % 11 == 0), 60).when(F.col("is_fraud") & (off % 7 == 0), 25).otherwise(1)
    return silver_txn(spark, d).withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


@register("top_alerts")
def q_top_alerts(spark, d):
    return retrieval.top_alerts(gold.fraud_alerts_hourly(_busy_silver(spark, d)), AS_OF)


@register("risky_customers")
def q_risky(spark, d):
    return retrieval.risky_customers(gold.customer_360(enriched(spark, d), customers(spark, d)))


@register("fraud_context")
def q_context(spark, d):
    return retrieval.fraud_context(*_gold_frames(spark, d), AS_OF)


def _documents(spark, d, n):
    return retrieval.alert_documents(gold.fraud_alerts_hourly(silver_txn(spark, d)), n)


def _stored(spark, d, name):
    """A folder for what is built once per application and state of the input files."""
    import hashlib

    from ..session import ensure_checkpoint_dir

    state = hashlib.sha256(repr((d, tables.version(spark, d, ["events", "customer"]))).encode()).hexdigest()[:20]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{spark.sparkContext.applicationId}-{state}"


def _alert_texts(spark, d):
    """All alert documents, stored once: the term index, the embeddings and the contexts read them."""
    path = _stored(spark, d, "alert-texts")
    if not merge.path_exists(spark, f"{path}/_SUCCESS"):
        _documents(spark, d, None).select("doc_id", "doc").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _term_index(spark, d):
    path = _stored(spark, d, "term-index")
    if not retrieval.term_index_exists(spark, path):
        retrieval.build_term_index(_alert_texts(spark, d), path)
    return path


@register("alert_documents")
def q_alert_docs(spark, d):
    return _documents(spark, d, 500).select("doc_id", "doc", "preview", "meta.*")


@register("vector_topk")
def q_vector_topk(spark, d):
    emb = tables.table(spark, d, "embeddings")
    return retrieval.vector_topk(emb, retrieval.label_centroids(emb), k=5)


@register("vector_topk_lsh")
def q_vector_topk_lsh(spark, d):
    """E5 for a large query set: the five nearest of every vector of the table, itself included."""
    emb = tables.table(spark, d, "embeddings")
    return vector_join.vector_topk_join(emb, emb.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec")), k=5)


@register("tfidf_search")
def q_tfidf(spark, d):
    qs = retrieval.question_frame(spark, retrieval.SEARCH_QUESTIONS)
    return retrieval.search_index(spark, _term_index(spark, d), qs, k=3)


@register("rag_context")
def q_rag(spark, d):
    qs = retrieval.question_frame(spark, retrieval.RAG_QUESTIONS)
    return retrieval.rag_context(retrieval.search_index(spark, _term_index(spark, d), qs, k=8), _alert_texts(spark, d))


@register("embedding_search")
def q_embedding_search(spark, d):
    """L3-L5 with learned dense vectors: the collection is trained and stored once, then searched."""
    path = _stored(spark, d, "collection")
    if not embeddings.collection_exists(spark, path):
        embeddings.build_collection(_alert_texts(spark, d), path)
    return embeddings.search(spark, path, retrieval.question_frame(spark, retrieval.SEARCH_QUESTIONS), k=3)


# --- scores and model -------------------------------------------------------------


@register("score_bands")
def q_score_bands(spark, d):
    return retrieval.score_band_counts(retrieval.fixed_scores(silver_txn(spark, d)))


@register("very_high_summary")
def q_very_high(spark, d):
    return retrieval.very_high_summary(retrieval.fixed_scores(silver_txn(spark, d)))


@register("confusion_metrics")
def q_confusion(spark, d):
    return ml.confusion_metrics(retrieval.fixed_scores(silver_txn(spark, d)))


@register("feature_frame")
def q_features(spark, d):
    return ml.build_feature_df(enriched(spark, d).filter(F.col("dq_passed"))).drop("transaction_ts")


@register("split_time")
def q_split_time(spark, d):
    f = ml.build_feature_df(enriched(spark, d).filter(F.col("dq_passed")))
    return ml.split_time(f).select("transaction_id", "split")


@register("split_hash")
def q_split_hash(spark, d):
    f = ml.build_feature_df(enriched(spark, d).filter(F.col("dq_passed")))
    train, test = ml.split_hash(f)
    return train.select("transaction_id", F.lit("train").alias("split")).unionByName(
        test.select("transaction_id", F.lit("test").alias("split"))
    )


@register("oversample")
def q_oversample(spark, d):
    f = ml.build_feature_df(enriched(spark, d).filter(F.col("dq_passed")))
    train, _ = ml.split_hash(f)
    return ml.oversample(train).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


_FEATURES: dict[tuple, DataFrame] = {}
_MODELS: dict[tuple, tuple] = {}


def _features(spark, d, state):
    """The feature rows of one application and state of the input files, built and stored once for all its models."""
    from ..session import materialize

    key = (spark.sparkContext.applicationId, d, state)
    if key not in _FEATURES:
        _FEATURES[key] = materialize(ml.build_feature_df(enriched(spark, d).filter(F.col("dq_passed"))))
    return _FEATURES[key]


def _trained(spark, d, model="gbt", trees=100, depth=6, balance="oversample"):
    """The surveyed model, its features and training rows, fitted once per application and state of the
    input files. ``balance``: copies of fraud rows, or class weights."""
    from ..session import materialize

    state = tables.version(spark, d, ["events", "customer"])
    key = (spark.sparkContext.applicationId, d, state, model, trees, depth, balance)
    if key not in _MODELS:
        f = _features(spark, d, state)
        side = ml.split_hash(f)[0]
        train = ml.fewer_partitions(materialize(ml.oversample(side) if balance == "oversample" else ml.weight_classes(side)))
        weight = None if balance == "oversample" else "weight"
        fitted = ml.build_pipeline(max_iter=trees, max_depth=depth, model=model, weight_col=weight).fit(train)
        _MODELS[key] = fitted, f, train
    return _MODELS[key]


@register("gbt_scores")
def q_gbt_scores(spark, d):
    model, f, _ = _trained(spark, d)
    return ml.score(model, f, AS_OF)


@register("random_forest_scores")
def q_rf_scores(spark, d):
    """K8: the random-forest variant, 40 trees."""
    model, f, _ = _trained(spark, d, "rf", trees=40)
    return ml.score(model, f, AS_OF)


@register("feature_importance")
def q_importance(spark, d):
    model, f, _ = _trained(spark, d)
    return ml.feature_importance(model, f)


@register("class_weights")
def q_class_weights(spark, d):
    f = ml.build_feature_df(enriched(spark, d).filter(F.col("dq_passed")))
    return ml.class_weights(ml.split_hash(f)[0]).select("label", "rows", F.round("weight", 6).alias("weight"))


@register("gbt_weighted")
def q_gbt_weighted(spark, d):
    """I4 / K6: the model fitted with class weights beside the one fitted on copied fraud rows, on the same test side."""
    from ..session import materialize

    rows = None
    for balance in ("weights", "oversample"):
        model, f, train = _trained(spark, d, balance=balance)
        scored = materialize(ml.score(model, ml.split_hash(f)[1]))
        sizes = {"train_rows": F.count(F.lit(1)), "train_transactions": F.countDistinct("transaction_id")}
        one = ml.confusion_metrics(scored).select(
            F.lit(balance).alias("balance"), "*", ml.auc_exact(scored).select("auc").scalar().alias("auc"), *[train.agg(c).scalar().alias(n) for n, c in sizes.items()]
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


# --- ingest, streaming, mart ------------------------------------------------------


@register("parse_events_json")
def q_parse_json(spark, d):
    parsed = bronze_stream.parse_transactions(bronze_stream.to_envelope(bronze(spark, d)), as_of=AS_OF)
    return parsed.select(
        "kafka_offset", "kafka_partition", "transaction_id", "customer_id", "card_type", "merchant_category",
        "merchant_state", "amount_usd", "transaction_ts", "is_fraud", "response_code", "_corrupt_record",
    )


@register("bronze_partition_counts")
def q_bronze_parts(spark, d):
    parsed = bronze_stream.parse_transactions(bronze_stream.to_envelope(bronze(spark, d)), as_of=AS_OF)
    return parsed.groupBy("_partition_year", "_partition_month").agg(F.count(F.lit(1)).alias("row_count"))


@register("mart_conform")
def q_mart(spark, d):
    return sinks.conform(bronze(spark, d), MART_TRANSACTIONS, MART_TRANSACTION_DEFAULTS).select(
        "transaction_id", "customer_id", "amount_usd", "currency", "transaction_ts", "_reject_reason"
    )


@register("audit_log")
def q_audit(spark, d):
    """Two runs, each counting its own rows: the first delivery, then the replayed copies."""
    return _audit_log(spark, d)


def _audit_log(spark, d, raw=None):
    from ..session import materialize

    runs = []
    raw = materialize(bronze(spark, d)) if raw is None else raw
    for started, replayed in ((AS_OF, False), (NEXT_RUN, True)):
        b = raw.filter(F.col("replayed") == replayed)
        conf = sinks.conform(b, MART_TRANSACTIONS, MART_TRANSACTION_DEFAULTS)
        t = silver.silver_transactions(b, started)
        layers = {"bronze": (b, conf.filter(F.col("_reject_reason").isNotNull())), "silver": (t, t.filter(~F.col("dq_passed")))}
        runs.append(sinks.audit_rows(layers, "card_pipeline", started))
    return runs[0].unionByName(runs[1]).unionByName(sinks.audit_failure(spark, "card_pipeline", "gold", "table not found", NEXT_RUN))


@register("mart_load")
def q_mart_load(spark, d):
    """Rows that the mart accepts."""
    rows = sinks.conform(bronze(spark, d), MART_TRANSACTIONS, MART_TRANSACTION_DEFAULTS).filter(F.col("_reject_reason").isNull())
    return rows.select("transaction_id", "customer_id", "card_type", "merchant_category", "amount_usd", "currency", "transaction_ts", "is_fraud")


@register("mart_customers")
def q_mart_customers(spark, d):
    raw = tables.raw_customers(spark, d)
    score = F.when(F.col("customer_id").cast("long") % 61 == 0, "unknown").otherwise(F.col("credit_score").cast("string"))
    return sinks.conform(raw.withColumn("credit_score", score), MART_CUSTOMERS).select(
        "customer_id", "credit_score", "credit_limit_usd", "account_open_date", "phone", "_reject_reason"
    )


@register("mart_contract_counts")
def q_contract_counts(spark, d):
    return sinks.contract_counts(sinks.conform(bronze(spark, d), MART_TRANSACTIONS, MART_TRANSACTION_DEFAULTS), "transaction_id")


def _stream_dirs(spark, name):
    from ..session import scratch_dir

    base = scratch_dir(spark, name)
    return f"{base}/landing", f"{base}/bronze", f"{base}/silver", f"{base}/alerts", f"{base}/_ckpt"


@register("stream_bronze")
def q_stream_bronze(spark, d):
    landing, bronze_dir, _, _, ck = _stream_dirs(spark, "stream-bronze")
    bronze_stream.write_landing(bronze(spark, d), landing)
    src = bronze_stream.event_stream(spark, options={"path": landing, "maxFilesPerTrigger": 2})
    q = bronze_stream.start_bronze(bronze_stream.parse_transactions(src, as_of=AS_OF), bronze_dir, f"{ck}/b")
    q.awaitTermination()
    return spark.read.parquet(bronze_dir).select("kafka_offset", "transaction_id", "amount_usd", "_partition_day")


@register("stream_silver_merge")
def q_stream_silver(spark, d):
    landing, _, silver_dir, _, ck = _stream_dirs(spark, "stream-silver")
    bronze_stream.write_landing(bronze(spark, d), landing)
    src = bronze_stream.parse_transactions(bronze_stream.event_stream(spark, options={"path": landing, "maxFilesPerTrigger": 2}), as_of=AS_OF)
    q = bronze_stream.start_silver(src, silver_dir, f"{ck}/s", as_of=AS_OF)
    q.awaitTermination()
    return spark.read.parquet(silver_dir).select(*_DEDUP_COLS)


@register("stream_dedup")
def q_stream_dedup(spark, d):
    """J4, stateful: first arrivals. Which copy of an id arrives first depends on the files' order, so only what all copies
    share is returned, and the place of rows without an id. Replayed messages carry their event's time, so the watermark spans the table."""
    landing, bronze_dir, _, _, ck = _stream_dirs(spark, "stream-dedup")
    bronze_stream.write_landing(bronze(spark, d), landing)
    events = bronze_stream.event_stream(spark, options={"path": landing, "maxFilesPerTrigger": 2})
    bronze_stream.start_dedup(bronze_stream.parse_transactions(events, as_of=AS_OF), bronze_dir, f"{ck}/d", "400 days").awaitTermination()
    place = F.when(F.col("transaction_id").isNull(), F.col("kafka_offset"))
    return spark.read.parquet(bronze_dir).select("transaction_id", "customer_id", "amount_usd", "transaction_ts", place.alias("offset_without_id"))


@register("silver_quarantine")
def q_quarantine(spark, d):
    """Every Bronze row without an id, as the Silver MERGE leaves it in the quarantine table."""
    from ..session import scratch_dir

    base = scratch_dir(spark, "quarantine")
    rows = silver.silver_transactions(bronze(spark, d), AS_OF, keep_null_keys=True)
    merge.upsert_partitioned(spark, rows, f"{base}/silver", ["transaction_id"], bronze_stream.SILVER_STREAM_PARTS, quarantine=f"{base}/quarantine", rows_move=False)
    return spark.read.parquet(f"{base}/quarantine").select("kafka_offset", "customer_id", "amount_usd", "quarantine_reason")


@register("stream_hourly_alerts")
def q_stream_alerts(spark, d):
    landing, _, silver_dir, alerts_dir, ck = _stream_dirs(spark, "stream-alerts")
    bronze_stream.write_landing(bronze(spark, d), landing)
    events = bronze_stream.event_stream(spark, options={"path": landing, "maxFilesPerTrigger": 2})
    src = bronze_stream.parse_transactions(events, as_of=AS_OF)
    bronze_stream.start_hourly_alerts(src, silver_dir, alerts_dir, f"{ck}/a", as_of=AS_OF).awaitTermination()
    return spark.read.parquet(alerts_dir).select(
        "alert_ts", "merchant_category", "merchant_state", "fraud_count", "affected_customers", "severity",
        F.col("fraud_amount_usd").cast("decimal(25,2)").alias("fraud_amount_usd"),
    )


@register("vector_collection_upsert")
def q_collection_upsert(spark, d):
    """L4: the indexed collection (top-100 alert documents) upserted by id
    with a later rendering of every alert document: the others are inserted."""
    first = _documents(spark, d, 100).select("doc_id", "doc", "preview")
    later = _documents(spark, d, None).select(
        "doc_id", F.concat(F.col("doc"), F.lit(" [refreshed]")).alias("doc"), "preview"
    )
    return merge.merge_frames(first, later, ["doc_id"])


@register("pipeline_health_json")
def q_health_json(spark, d):
    """M1 + C3: the metrics record rendered as one JSON text, every value as text with fixed places."""
    m = q_dq_metrics(spark, d)
    text = [F.col(c).cast("decimal(20,4)").cast("string").alias(c) if t == "double" else F.col(c).cast("string").alias(c) for c, t in m.dtypes]
    return m.select(F.to_json(F.struct(*text)).alias("pipeline_health"))


@register("cleanse_dq")
def q_cleanse_dq(spark, d):
    """The DQ view of cleansing: parsed timestamp, sanitised amount,
    and the never-NULL flag with the rule that failed first."""
    c = cleansed(spark, d)
    reason = (
        F.when(F.col("transaction_id").isNull(), "transaction_id")
        .when(F.col("customer_id").isNull(), "customer_id")
        .when(F.col("amount_usd").isNull(), "amount_usd")
        .when(F.col("transaction_ts").isNull(), "transaction_ts")
    )
    return c.select("transaction_id", "kafka_offset", "amount_usd", "transaction_ts", "dq_passed",
                    reason.alias("dq_failed_rule"))


@register("split_stratified")
def q_split_stratified(spark, d):
    """Exact per-class 80/20 split (hash order within each class)."""
    f = ml.build_feature_df(enriched(spark, d).filter(F.col("dq_passed"))).select("transaction_id", "label")
    return ml.stratified_labels(f)


@register("mask_pii")
def q_mask_pii(spark, d):
    return silver.mask_pii(customers(spark, d), salt="pepper").select("customer_id", "full_name", "email", "home_state")


@register("daily_surrogate_keys")
def q_surrogate(spark, d):
    """The key of every daily-summary group."""
    daily = gold.daily_summary_sql(staging(spark, d))
    return daily.select(sinks.surrogate_key("txn_date", "merchant_category", "card_type").alias("summary_key"), "txn_date", "merchant_category", "card_type", "total_transactions")


@register("landing_paths")
def q_landing_paths(spark, d):
    """Events per zero-padded landing folder of their day."""
    from ..functions.columns import landing_day

    return staging(spark, d).groupBy(landing_day("transaction_ts").alias("folder")).agg(F.count(F.lit(1)).alias("rows"))


@register("point_in_time")
def q_point_in_time(spark, d):
    """Bronze as of a moment, by ingest stamps (an hour after the event; events without a time at the start)."""
    from . import pipeline

    ts = F.coalesce(F.col("transaction_ts"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    stamped = staging(spark, d).withColumn("bronze_ingested_at", ts + F.expr("INTERVAL 1 HOUR"))
    return pipeline.as_of(stamped, "2024-01-12 06:00:00").select("kafka_offset", "transaction_id", "bronze_ingested_at")


_LANDING = "customer_id string, credit_score bigint, created_at string"


def _landing(spark, d, fmt, lines=None, frame=None):
    """Land customer rows as ``fmt`` in files of at most 500 and read them back with bad text kept."""
    from pyspark.sql.types import StructType

    from ..session import scratch_dir

    path = scratch_dir(spark, f"landing-{fmt}")
    writer = (frame if frame is not None else lines).write.option("maxRecordsPerFile", 500)
    writer.parquet(path) if frame is not None else writer.text(path)
    schema = StructType.fromDDL(_LANDING)
    return path, sinks.read_landing(spark, path, fmt, schema, aliases={"created_at": "event_created_at"}, keep_bad=True, header=False)


def _landed_customers(spark, d):
    n = F.col("c_custkey")
    score = F.when(n % 41 == 0, "n/a").otherwise((580 + n % 271).cast("string"))
    return tables.table(spark, d, "customer").select(n.cast("string").alias("customer_id"), score.alias("credit_score"), F.lit("2023-01-01T00:00:00Z").alias("event_created_at"))


@register("landing_csv")
def q_landing_csv(spark, d):
    line = F.concat_ws(",", "customer_id", "credit_score", "event_created_at")
    rows = _landed_customers(spark, d).select(line.alias("value"))
    _, df = _landing(spark, d, "csv", lines=rows)
    return df


@register("landing_json")
def q_landing_json(spark, d):
    src = _landed_customers(spark, d)
    score = F.when(F.col("credit_score") == "n/a", F.lit('"n/a"')).otherwise(F.col("credit_score"))
    line = F.concat(F.lit('{"customer_id":"'), F.col("customer_id"), F.lit('","credit_score":'), score, F.lit(',"event_created_at":"'), F.col("event_created_at"), F.lit('"}'))
    _, df = _landing(spark, d, "json", lines=src.select(line.alias("value")))
    return df.select("customer_id", F.col("_corrupt_record").isNotNull().alias("is_bad"), "_corrupt_record", "credit_score", "created_at")


@register("landing_parquet")
def q_landing_parquet(spark, d):
    _, df = _landing(spark, d, "parquet", frame=_landed_customers(spark, d))
    return df


@register("landing_files")
def q_landing_files(spark, d):
    """Every file of a landing folder with its rows. Each nation's customers land as one file."""
    from ..session import scratch_dir

    path = scratch_dir(spark, "landing-files")
    rows = tables.table(spark, d, "customer").select("c_custkey", "c_nationkey").withColumn("nation", F.col("c_nationkey"))
    rows.repartition("nation").write.partitionBy("nation").parquet(path)
    files = sinks.landing_files(spark, path)
    return files.select(F.regexp_extract("file_path", "nation=([0-9]+)/part-[^/]*$", 1).cast("int").alias("nation"), "row_count", F.col("modified_at").isNotNull().alias("has_time"))


@register("landing_compact")
def q_landing_compact(spark, d):
    """Customers land in many small files; the copy holds the same rows in fewer, and a copy of the copy merges nothing."""
    from ..session import scratch_dir

    base = scratch_dir(spark, "landing-compact")
    paths = [f"{base}/{x}" for x in ("landed", "copy", "copy-of-copy")]
    landed = tables.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    landed.write.option("maxRecordsPerFile", 100).parquet(paths[0])
    told = [compact.compact(spark, a, b, target_bytes=64 << 10) for a, b in zip(paths, paths[1:])]
    smaller = [told[0]["files_after"] < told[0]["files_before"], told[1]["files_after"] == told[1]["files_before"]]
    out = None
    for stage, path, merges in zip(("landed", "copy", "copy of copy"), paths, (None, *smaller)):
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.sum("c_custkey").alias("keys"), F.countDistinct("c_name").alias("names"))
        row = rows.select(F.lit(stage).alias("stage"), "*", F.lit(merges).cast("boolean").alias("as_expected"))
        out = row if out is None else out.unionByName(row)
    return out


@register("mart_sequence_keys")
def q_sequence_keys(spark, d):
    """Two loads get dense keys; the second goes on where the first ended."""
    from ..session import scratch_dir

    path = scratch_dir(spark, "sequence-keys") + "/transactions"
    rows = bronze(spark, d).select("transaction_id", "customer_id", "amount_usd", "transaction_ts", "kafka_offset", "replayed")
    for load, replayed in (("first", False), ("second", True)):
        sequence.load_numbered(spark, rows.filter(F.col("replayed") == replayed).drop("replayed"), path, load, ["kafka_offset"])
    return spark.read.parquet(path).select("sequence_key", "load_id", "transaction_id", "kafka_offset")


@register("gold_contracts")
def q_gold_contracts(spark, d):
    """The Gold tables against their contracts (types, lengths, NOT NULL, natural key)."""
    from ..schemas import GOLD_CONTRACTS

    s = silver_txn(spark, d)
    frames = {
        "daily_txn_summary": gold.daily_txn_summary(s),
        "customer_360": gold.customer_360(enriched(spark, d), customers(spark, d)),
        "fraud_alerts_hourly": gold.fraud_alerts_hourly(s),
        "state_performance": gold.state_performance(s),
    }
    out = None
    for name, frame in frames.items():
        schema, key = GOLD_CONTRACTS[name]
        row = sinks.contract_counts(sinks.conform(frame, schema), key).select(F.lit(name).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@register("silver_point_in_time")
def q_silver_point_in_time(spark, d):
    """Silver as of a moment. First deliveries arrive an hour after their event, replays (which win later) two days after it."""
    from ..functions.columns import parse_ts
    from . import pipeline

    event = F.coalesce(parse_ts("transaction_ts"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    delay = F.when(F.col("replayed"), F.expr("INTERVAL 48 HOURS")).otherwise(F.expr("INTERVAL 1 HOUR"))
    arrived = bronze(spark, d).withColumn("bronze_ingested_at", event + delay)
    return pipeline.silver_as_of(arrived, "2024-01-12 06:00:00").select("transaction_id", "kafka_offset", "amount_usd", "transaction_ts", "dq_passed", "silver_processed_at")


@register("stream_window_alerts")
def q_window_alerts(spark, d):
    """Tumbling event-time windows of the stream, in update mode; no row is late within the watermark."""
    landing, _, _, alerts_dir, ck = _stream_dirs(spark, "stream-windows")
    bronze_stream.write_landing(bronze(spark, d), landing)
    events = bronze_stream.event_stream(spark, options={"path": landing, "maxFilesPerTrigger": 2})
    parsed = bronze_stream.parse_transactions(events, as_of=AS_OF)
    bronze_stream.start_window_alerts(parsed, alerts_dir, f"{ck}/w", watermark="400 days").awaitTermination()
    return bronze_stream.latest_windows(spark, alerts_dir).select(
        "alert_ts", "merchant_category", "merchant_state", "fraud_count", F.col("fraud_amount_usd").cast("decimal(25,2)").alias("fraud_amount_usd"), "severity"
    )


@register("stream_audit")
def q_stream_audit(spark, d):
    """A stream in which every 101st message is cut short; its audit rows, one a micro-batch, in sum, and the duration rule over them."""
    landing, bronze_dir, _, _, ck = _stream_dirs(spark, "stream-audit")
    messages = bronze_stream.to_envelope(bronze(spark, d))
    cut = F.when(F.col("offset") % 101 == 7, F.substring("value", 1, 25)).otherwise(F.col("value"))
    bronze_stream.write_envelopes(messages.withColumn("value", cut), landing)
    events = bronze_stream.event_stream(spark, options={"path": landing, "maxFilesPerTrigger": 2})
    parsed = stream_audit.counted(bronze_stream.parse_transactions(events, as_of=AS_OF), F.col("_corrupt_record").isNotNull())
    name, log = "audited_bronze", f"{bronze_dir}__audit"
    stream_audit.run_audited(spark, lambda: bronze_stream.start_bronze(parsed, bronze_dir, f"{ck}/b", name=name), log, name, "card_stream")
    rows = stream_audit.read_audit(spark, log)
    rule = quality.alert_rules(_freshness(spark, d), quality.run_checks(staging(spark, d), AS_OF), batches=rows).filter("rule_name = 'merge_duration_minutes'")
    return rows.groupBy("pipeline_name").agg(
        F.sum("rows_processed").alias("rows_processed"),
        F.sum("rows_failed").alias("rows_failed"),
        F.bool_and(F.col("status") == F.when(F.col("rows_failed") > 0, "PARTIAL").otherwise("SUCCESS")).alias("status_fits"),
        (F.countDistinct("batch_id") == F.count(F.lit(1))).alias("one_row_a_batch"),
        F.bool_and(F.col("duration_ms") > 0).alias("has_duration"),
    ).withColumn("duration_rule_firing", rule.select("firing").scalar())


@register("pipeline_layers")
def q_pipeline_layers(spark, d):
    """The whole batch pipeline, its tables registered in the catalog and counted through it."""
    import uuid

    from ..session import materialize, scratch_dir
    from . import pipeline

    base = scratch_dir(spark, "pipeline-layers")
    pipeline.run_pipeline(spark, d, base, AS_OF)
    database = f"cards_{uuid.uuid4().hex}"
    paths = pipeline.layout(base)
    pipeline.register_tables(spark, paths, database)
    out = None
    for name in paths:
        if spark.catalog.tableExists(f"{database}.{name}"):
            row = spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            out = row if out is None else out.unionByName(row)
    out = materialize(out)
    spark.sql(f"DROP DATABASE {database} CASCADE")  # external tables: the files stay
    return out


@register("managed_table")
def q_managed_table(spark, d):
    """The wrangled copy as a managed table, read back through the catalog."""
    import uuid

    from ..session import materialize

    name = f"wrangled_{uuid.uuid4().hex}"
    sinks.save_table(q_wrangle(spark, d), name)
    out = materialize(spark.table(name).groupBy("merchant_category", "dq_passed").agg(F.count(F.lit(1)).alias("rows"), F.sum("kafka_offset").alias("offsets")))
    spark.sql(f"DROP TABLE {name}")
    return out


@register("stream_restart")
def q_stream_restart(spark, d):
    """The stream is run to its end, more files land, and a second query goes on from the same checkpoint."""
    landing, bronze_dir, _, _, ck = _stream_dirs(spark, "stream-restart")
    for part, replayed in (("first", False), ("second", True)):
        bronze_stream.write_landing(bronze(spark, d).filter(F.col("replayed") == replayed), f"{landing}/{part}")
        for _ in range(2):  # the second time there is nothing new
            events = bronze_stream.event_stream(spark, options={"path": f"{landing}/*", "maxFilesPerTrigger": 2})
            bronze_stream.start_bronze(bronze_stream.parse_transactions(events, as_of=AS_OF), bronze_dir, f"{ck}/r").awaitTermination()
    return spark.read.parquet(bronze_dir).select("kafka_offset", "transaction_id", "amount_usd")


@register("model_run")
def q_model_run(spark, d):
    """The fitted model is evaluated, saved with its metrics row, loaded again and checked for drift."""
    from pyspark.ml import PipelineModel

    from ..session import scratch_dir

    model, f, train = _trained(spark, d)
    path = scratch_dir(spark, "model-run")
    test = ml.split_hash(f)[1]
    ml.save_model(model, ml.evaluate(spark, model, train, test, AS_OF), path)
    metrics = ml.drift_check(spark.read.parquet(f"{path}/metrics"))
    again = ml.score(PipelineModel.load(f"{path}/model"), test, AS_OF).select("transaction_id", F.col("fraud_probability").alias("again"))
    same = ml.score(model, test, AS_OF).join(again, "transaction_id").agg(F.count_if(F.col("fraud_probability") == F.col("again")).alias("n")).scalar()
    return metrics.select(
        "test_rows", same.alias("equal_scores"), (F.col("test_auc") > 0.5).alias("better_than_chance"), (F.col("retrain") == (F.col("test_auc") < 0.9)).alias("drift_fits")
    )
