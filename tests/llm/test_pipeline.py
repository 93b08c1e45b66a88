import itertools

import public_tokenizers
import pytest

import __spark_entry__ as entry
import corpus_pipeline as P
from swipeflow.llm import decontam, langid, queries, token_count, toxicity
from tests.conftest import SF_SMALL
from tests.llm.test_pairs import closure, shingles


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage over the smallest tables."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    # rows that every stage must bear: nulls in any column, an empty and a long text, a repeated row
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "the and " * 8000, None, None, None), (-4, "?!", "en", "s", 2), (None, "of the and that it is on", "en", None, 3)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.filter("doc_id = 3")).cache()
    out = {}
    for name, stage in P.STAGES:
        result = stage(spark, docs, SF_SMALL).cache()
        out[name] = (docs, result)
        docs = result
    return out


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is not None, x))


def test_stages_keep_the_columns(stages):
    for name, (given, made) in list(stages.items())[:-1]:
        assert made.schema.simpleString() == given.schema.simpleString(), name
    assert [n for n, _ in P.STAGES] == ["toxicity", "language_id", "ngram_jaccard_join", "benchmark_decontamination", "packing"]


def test_toxicity_stage_drops_what_the_operator_rejects(spark, stages):
    given, made = stages["toxicity"]
    scored = toxicity.score(given, toxicity.train(given, spark.read.parquet(f"{SF_SMALL}/labels.parquet")))
    assert ids(made) == ids(scored.filter("predicted = 0"))
    assert 0 < made.count() < given.count()


def test_language_stage_drops_only_undetermined_texts(stages):
    given, made = stages["language_id"]
    named = langid.identify(given, langid.learn_profiles(given))
    assert ids(made) == ids(named.filter("is_known"))
    assert not {-1, -2, -4} & set(ids(made)) and -3 in ids(made)


def test_near_duplicate_stage_equals_brute_force(stages):
    given, made = stages["ngram_jaccard_join"]
    rows = [(r["doc_id"], shingles(r["text"])) for r in given.collect()]
    links = [(a, b) for (a, x), (b, y) in itertools.combinations([r for r in rows if r[0] is not None], 2) if x and 5 * len(x & y) >= 4 * len(x | y)]
    root = closure({d for d, _ in rows if d is not None}, links)
    got = ids(made)  # a list: a row that repeats may stay once only
    assert len(got) == len(set(got)) and set(got) == {d for d, _ in rows if d is None or root[d] == d}
    assert made.count() < given.count()


def test_decontamination_stage_equals_brute_force(spark, stages):
    given, made = stages["benchmark_decontamination"]
    norm = lambda t: "".join(map(chr, decontam.Normal([t or ""]).cps)).strip()
    items = [norm(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    whole = {r["doc_id"] for r in given.collect() if any(i in norm(r["text"]) for i in items)}
    gone = set(ids(given)) - set(ids(made))
    assert whole <= gone and len(gone - whole) <= 1 and whole


def test_packing_stage_holds_every_token(stages):
    given, made = stages["packing"]
    tokenizer = token_count.load(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in given.collect())
    assert made.agg({"length": "sum"}).first()[0] == want


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(P.run(spark, SF_SMALL).select(*cols).collect()) == sorted(docs.select(*cols).collect())


def test_stages_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_extra_columns_ride_along(spark):
    from tests.llm.conftest import clashing

    docs = clashing(spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40))
    for _, stage in P.STAGES[:-1]:
        made = stage(spark, docs, SF_SMALL)
        assert made.columns == docs.columns
        docs = made
    assert docs.count() > 10


def test_every_operator_is_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.REGISTRY}
    assert set(queries.REGISTRY) <= set(names) and "pipeline" in names
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
