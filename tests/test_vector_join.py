"""The join of large query sets with a corpus, against numpy and against the exact top-k."""

import numpy as np
import pytest

from swipeflow.operators import retrieval, vector_join
from swipeflow.sources import tables

from .conftest import SF_CHECK


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")


def as_queries(df):
    return df.selectExpr("vec_id AS query_id", "embedding AS query_vec")


def brute(corpus, queries, k):
    out = []
    usable = [(i, np.asarray(v, float)) for i, v in corpus if v is not None and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0]
    for q, qv in queries:
        if qv is None or not np.isfinite(np.asarray(qv, float)).all():
            continue
        size = np.linalg.norm(qv) or 1.0
        near = sorted((-round(float(np.dot(qv, v)) / (size * np.linalg.norm(v)), 9) + 0.0, i) for i, v in usable if len(v) == len(qv))[:k]
        out += [(q, r, i, round(-s, 4) + 0.0) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def result(df):
    return sorted((r["query_id"], r["rank"], r["doc_id"], r["similarity"] + 0.0) for r in df.collect())


def clustered(rng, n, dim=16):
    centers = rng.standard_normal((n // 10, dim))
    rows = [(i, centers[i % len(centers)] + 0.25 * rng.standard_normal(dim)) for i in range(n)]
    hot = rng.standard_normal(dim)
    return rows + [(n + i, hot) for i in range(n // 3)]  # a third are equal


@pytest.mark.parametrize("block", [7, 2048])
def test_exact_join_equals_numpy_with_hot_and_odd_vectors(spark, block):
    rng = np.random.default_rng(1)
    rows = clustered(rng, 60)
    rows += [(900, [0.0] * 16), (901, None), (902, [float("nan")] + [1.0] * 15), (903, [1.0, 2.0]), (904, [1.0] * 16), (905, [2.0] * 16)]
    df = frame(spark, rows)
    got = vector_join.vector_topk_join(df, as_queries(df), 4, hashing=vector_join.Hashing(0, 1), block=block)
    assert result(got) == brute(rows, rows, 4)


def test_hashed_join_finds_clustered_neighbours_and_answers_every_query(spark):
    rng = np.random.default_rng(2)
    rows = clustered(rng, 300) + [(9000, [0.0] * 16)]
    df = frame(spark, rows)
    got = result(vector_join.vector_topk_join(df, as_queries(df), 5, hashing=vector_join.Hashing(4, 10), block=50))
    want = brute(rows, rows, 5)
    assert len(got) == len(want)  # no query has fewer rows than the exact answer
    hit = {(q, d) for q, _, d, _ in got} & {(q, d) for q, _, d, _ in want}
    assert len(hit) >= 0.9 * len(want)
    exact = {(q, d): s for q, _, d, s in brute(rows, rows, len(rows))}
    assert all(exact[(q, d)] == s for q, _, d, s in got)  # similarities are exact


def test_planned_hashing_reaches_the_recall_on_the_given_vectors(spark, monkeypatch):
    emb = tables.table(spark, SF_CHECK, "embeddings").select("vec_id", "embedding")
    monkeypatch.setattr(vector_join, "BUCKET_ROWS", 60)
    units = vector_join.unit_vectors(emb, "vec_id", "embedding")
    plan = vector_join.plan_hashing(units, units.drop("digest"), 5, 0.9, bucket_rows=60)
    # nearest neighbours of random vectors are far: the plan must not pretend that narrow buckets find them
    assert plan.bits <= 3
    queries = as_queries(emb)
    exact = retrieval.vector_topk(emb, queries, k=5)
    got = vector_join.vector_topk_join(emb, queries, 5, recall=0.9, hashing=plan if plan.bits else vector_join.Hashing(2, 8))
    found = exact.join(got, ["query_id", "doc_id"], "left_semi").count()
    assert found >= 0.9 * exact.count()


def test_narrow_clusters_get_many_bits(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((80, 24))
    rows = [(i, centers[i % 80] + 0.02 * rng.standard_normal(24)) for i in range(800)]
    units = vector_join.unit_vectors(frame(spark, rows), "vec_id", "embedding")
    plan = vector_join.plan_hashing(units, units.drop("digest"), 5, 0.95, bucket_rows=20)
    assert plan.bits >= 4 and plan.tables < 1 << plan.bits
    df = frame(spark, rows)
    exact = brute(rows, rows, 5)
    got = result(vector_join.vector_topk_join(df, as_queries(df), 5, hashing=plan))
    assert len({x[:1] + x[2:3] for x in got} & {x[:1] + x[2:3] for x in exact}) >= 0.95 * len(exact)


def test_no_vectors_and_no_queries(spark):
    df, none = frame(spark, [(1, [1.0, 0.0])]), frame(spark, [])
    for corpus, queries in ((none, df), (df, none)):
        assert vector_join.vector_topk_join(corpus, as_queries(queries), 3).count() == 0


def broadcast_columns(plan):
    """Columns of every broadcast of an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        below = [plan.executedPlan()]
    elif kind.endswith("QueryStageExec"):
        below = [plan.plan()]
    else:
        below = [plan.children().apply(i) for i in range(plan.children().size())]
    own = [plan.output().mkString(" ")] if kind == "BroadcastExchangeExec" else []
    return own + [c for p in below for c in broadcast_columns(p)]


def test_only_bucket_sizes_are_broadcast(spark, tmp_dir):
    rng = np.random.default_rng(4)
    frame(spark, clustered(rng, 3000, 64)).coalesce(1).write.parquet(f"{tmp_dir}/vectors")
    df = spark.read.parquet(f"{tmp_dir}/vectors")  # files: Spark's estimate of the rows is far below their size
    vectors = vector_join.materialize(vector_join._distinct_vectors(vector_join.unit_vectors(df, "vec_id", "embedding"), 5))
    asked = vector_join.materialize(vector_join.unit_vectors(as_queries(df), "query_id", "query_vec", keep_zero=True).drop("digest"))
    near = vector_join._candidates(vectors, asked, 5, vector_join.Hashing(5, 20), 64, 17)
    assert near.collect()
    sent = broadcast_columns(near._jdf.queryExecution().executedPlan())
    assert len(sent) >= 2 and not any("unit" in c for c in sent)
    # the joins over query ids send nothing whole either
    out = vector_join.vector_topk_join(df, as_queries(df), 5, hashing=vector_join.Hashing(5, 20), block=64)
    out.collect()
    sent = broadcast_columns(out._jdf.queryExecution().executedPlan())
    assert all("n_v" in c or "n_q" in c for c in sent)


def test_bits_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "MAX_BITS", 3)
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((80, 24))
    units = vector_join.unit_vectors(frame(spark, [(i, centers[i % 80] + 0.02 * rng.standard_normal(24)) for i in range(800)]), "vec_id", "embedding")
    assert vector_join.plan_hashing(units, units.drop("digest"), 5, 0.95, bucket_rows=20).bits == 3


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_rounds_bound_the_copies_and_leave_no_shuffle_files(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = clustered(rng, 300)
    df = frame(spark, rows)
    monkeypatch.setattr(vector_join, "ROUND_VALUES", 1)
    planned = []
    real = vector_join._rounds

    def noted(vectors, queries, sizes):
        rounds = real(vectors, queries, sizes)
        values = [units.agg({"dim": "sum"}).first()[0] for units in (vectors, queries)]
        total = sum(r[0] * (r[1] * r[4] + r[3] * r[2]) for r in sizes.select("dim", "rows_v", "n_v", "rows_q", "n_q").collect())
        planned.append((rounds, total / sum(values)))
        return rounds

    monkeypatch.setattr(vector_join, "_rounds", noted)
    for hashing in (vector_join.Hashing(0, 1), vector_join.Hashing(2, 5)):
        before = shuffle_files(spark)
        got = vector_join.vector_topk_join(df, as_queries(df), 4, hashing=hashing, block=40)
        assert not shuffle_files(spark) - before
        rounds, copies = planned[-1]
        assert copies > vector_join.ROUND_COPIES and len(rounds) >= copies / vector_join.ROUND_COPIES
        # every table, and of a table dealt over rounds every part, comes once
        shares = [(t, 1 / r.parts) for r in rounds for t in r.tables]
        assert all(abs(sum(s for u, s in shares if u == t) - 1) < 1e-9 for t in range(hashing.tables)) and len({(t, r.part) for r in rounds for t in r.tables}) == len(shares)
        want = brute(rows, rows, 4)
        if hashing.bits:
            assert len(result(got)) == len(want)
        else:
            assert result(got) == want


@pytest.mark.parametrize("spread", [1.0, 1e-7, 0.0])
def test_single_precision_only_narrows_the_choice(monkeypatch, spread):
    monkeypatch.setattr(vector_join, "PIECE_VALUES", 3_000)
    rng = np.random.default_rng(7)
    unit = lambda a: a / np.linalg.norm(a, axis=1)[:, None]
    center = rng.standard_normal(12)
    d = unit(np.concatenate([center + spread * rng.standard_normal((400, 12)), rng.standard_normal((200, 12))]))
    q = np.concatenate([d[::7], np.zeros((1, 12))])
    for k in (1, 5, 700):
        rows, cols, sims = vector_join._nearest(d, q, k)
        exact = np.round(q @ d.T, 9)
        kth = np.sort(exact, axis=1)[:, -min(k, len(d))]
        assert sorted(zip(rows, cols)) == sorted(zip(*np.nonzero(exact >= kth[:, None])))
        assert np.abs(sims - exact[rows, cols]).max() < 2e-9


def test_vectors_travel_as_given(spark):
    rows = [(1, [0.1, 0.2]), (2, [0.3, -0.4])]
    for kind in ("float", "double"):
        units = vector_join.unit_vectors(frame(spark, rows).selectExpr("vec_id", f"CAST(embedding AS array<{kind}>) AS embedding"), "vec_id", "embedding")
        assert units.schema["vector"].dataType.simpleString() == f"array<{kind}>"
        for r in units.collect():
            given = np.array(dict(rows)[r["id"]], np.float32 if kind == "float" else np.float64).astype(np.float64)
            assert list(r["vector"]) == list(given) and r["length"] == np.linalg.norm(given)
