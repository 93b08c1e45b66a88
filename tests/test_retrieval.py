"""Vector top-k vs numpy brute force; text retrieval and report context."""

import numpy as np
import pandas as pd

from swipeflow.operators import retrieval
from swipeflow.sources import tables

from .conftest import SF_SMALL


def test_vector_topk_matches_numpy(spark):
    emb = tables.table(spark, SF_SMALL, "embeddings")
    q = retrieval.label_centroids(emb)
    got = retrieval.vector_topk(emb, q, k=3).toPandas()
    e = emb.toPandas()
    mat = np.stack(e.embedding.map(lambda v: np.asarray(v, dtype=np.float64)))
    mat /= np.linalg.norm(mat, axis=1, keepdims=True)
    for label, grp in e.groupby("label"):
        c = np.stack(grp.embedding.map(lambda v: np.asarray(v, dtype=np.float64))).mean(axis=0)
        sims = mat @ (c / np.linalg.norm(c))
        order = sorted(range(len(sims)), key=lambda i: (-sims[i], e.vec_id[i]))[:3]
        want = [int(e.vec_id[i]) for i in order]
        assert got[got.query_id == label].sort_values("rank").doc_id.tolist() == want


def test_vector_topk_in_passes_equals_single_pass(spark):
    emb = tables.table(spark, SF_SMALL, "embeddings")
    q = retrieval.label_centroids(emb)
    one = retrieval.vector_topk(emb, q, k=4).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    many = retrieval.vector_topk(emb, q, k=4, max_queries=2).toPandas()
    many = many.sort_values(["query_id", "rank"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(one, many)


def test_tfidf_and_rag_context(spark):
    docs = spark.createDataFrame(
        [("d1", "critical fraud at the ATM in Texas"), ("d2", "late night grocery purchase"),
         ("d3", "severe fraudulent online retail activity")],
        "doc_id string, doc string",
    )
    qs = retrieval.question_frame(spark, ["severe fraud", "late night"])
    hits = retrieval.tfidf_search(docs, qs, k=2).toPandas()
    top = hits[hits["rank"] == 1].set_index("question_id").doc_id.to_dict()
    assert top == {1: "d3", 2: "d2"}
    ctx = retrieval.rag_context(retrieval.tfidf_search(docs, qs, k=2), docs).toPandas().set_index("question_id")
    assert ctx.loc[2, "context"].startswith("[Alert 1]: late night grocery purchase")
    assert ctx.loc[1, "n_hits"] == 2
