"""Driver contract and a DuckDB cross-check of every twin at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from swipeflow.sources.tables import TABLES

from .conftest import SF_SMALL

FAST = [
    "daily_txn_summary",
    "customer_360",
    "fraud_alerts_hourly",
    "daily_summary_sql",
    "customer_360_sql",
    "merge_upsert",
    "merge_newer_offset",
    "dq_checks",
    "null_rates",
    "velocity",
    "impossible_travel",
    "yoy_volume",
    "alert_documents",
    "confusion_metrics",
    "mart_conform",
    "vector_topk_lsh",
    "tfidf_search",
    "rag_context",
    "landing_files",
    "landing_compact",
    "mart_sequence_keys",
    "gold_contracts",
    "load_freshness",
    "silver_point_in_time",
    "split_stratified",
    "class_weights",
    "p99_sketch_check",
    "rfm_scores",
    "managed_table",
]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "fraud_rate_pct" in df.columns


def test_every_twin_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if hasattr(v, "as_tuple"):
        return f"{float(v):.9g}"
    return str(v)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(dcols)

    def lines(cols, rows):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted("|".join(_canon(r[i]) for i in order) for r in rows)

    assert lines(df.columns, [tuple(r) for r in df.collect()]) == lines(dcols, cur.fetchall())
