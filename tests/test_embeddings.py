"""Learned embeddings and the stored term index: built once, searched often."""

import random

import pytest

from swipeflow.operators import embeddings, retrieval

TOPICS = {"fuel": ["gas", "station", "pump", "diesel", "petrol"], "food": ["grocery", "bread", "milk", "fruit", "store"], "trip": ["flight", "hotel", "travel", "airport", "luggage"]}


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(5)
    rows = []
    for k in range(360):
        topic = list(TOPICS)[k % 3]
        rows.append((f"{topic}-{k:03d}", " ".join(rnd.choices(TOPICS[topic], k=12))))
    rows += [("null", None), ("empty", ""), ("unknown", "zzz")]
    return spark.createDataFrame(rows, "doc_id string, doc string")


def test_words_of_a_topic_find_its_documents(spark, docs, tmp_dir):
    path = f"{tmp_dir}/c"
    assert not embeddings.collection_exists(spark, path)
    embeddings.build_collection(docs, path, size=16)
    assert embeddings.collection_exists(spark, path)
    # none of the questions' documents need hold both words: the ranking comes from learned neighbours
    asked = retrieval.question_frame(spark, ["pump diesel", "milk bread", "hotel airport"])
    hits = embeddings.search(spark, path, asked, k=5).collect()
    assert {(r["question_id"], r["doc_id"].split("-")[0]) for r in hits} == {(1, "fuel"), (2, "food"), (3, "trip")}
    assert all(r["similarity"] > 0.8 for r in hits)


def test_the_second_search_trains_nothing(spark, docs, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/c"
    embeddings.build_collection(docs, path, size=8)
    asked = retrieval.question_frame(spark, ["travel"])
    first = embeddings.search(spark, path, asked, k=3).collect()

    def no_training(*args, **kwargs):
        raise AssertionError("trained again")

    monkeypatch.setattr(embeddings.Word2Vec, "fit", no_training)
    assert embeddings.search(spark, path, asked, k=3).collect() == first


def test_vocabulary_and_fit_are_bounded(spark, docs):
    words = embeddings.with_words(docs, "doc")
    counts = {}
    for r in words.collect():
        for w in r["_words"]:
            counts[w] = counts.get(w, 0) + 1
    least = embeddings.frequent_words(words, 6)
    assert 0 < sum(n >= least for n in counts.values()) <= 6 and embeddings.frequent_words(words, 1000) == 1
    model = embeddings.train(docs, size=8, fit_rows=90, max_words=6)
    assert 0 < model.getVectors().count() <= 6


def test_the_stored_index_answers_as_a_search_from_scratch(spark, docs, tmp_dir):
    path = f"{tmp_dir}/i"
    assert not retrieval.term_index_exists(spark, path)
    retrieval.build_term_index(docs, path)
    assert retrieval.term_index_exists(spark, path)
    for texts in (["diesel station", "fruit"], ["zzz", "", "nothing known xq"]):
        asked = retrieval.question_frame(spark, texts)
        stored, fresh = (sorted(map(tuple, x.collect())) for x in (retrieval.search_index(spark, path, asked), retrieval.tfidf_search(docs, asked)))
        assert stored == fresh
    # a term of every document weighs nothing and has no list
    everywhere = spark.createDataFrame([("a", "same one"), ("b", "same two")], "doc_id string, doc string")
    retrieval.build_term_index(everywhere, f"{tmp_dir}/e", analyzer="word")
    assert {r["term"] for r in spark.read.parquet(f"{tmp_dir}/e/postings").collect()} == {"one", "two"}
    # but a question that holds it is filled up with documents that share nothing else
    hits = retrieval.search_index(spark, f"{tmp_dir}/e", retrieval.question_frame(spark, ["same two", "two", "same"]), analyzer="word").collect()
    assert sorted((r["question_id"], r["rank"], r["doc_id"], r["similarity"]) for r in hits) == [(1, 1, "b", 1.0), (1, 2, "a", 0.0), (2, 1, "b", 1.0)]
