import numpy as np
from pyspark.sql import functions as F

from swipeflow.llm import langid, toxicity
from tests.conftest import SF_CHECK
from tests.llm.conftest import clashing


def docs_of(spark):
    return spark.read.parquet(f"{SF_CHECK}/documents.parquet")


def test_language_held_out_accuracy_and_odd_texts(session):
    docs = docs_of(session).withColumn("lang", F.when(F.col("doc_id") % 10 != 0, F.col("lang")))
    odd = session.createDataFrame([(-1, None), (-2, ""), (-3, "123 !?"), (-4, "THE AND THE OF"), (None, "the"), (-5, "the and of " * 20000), (-1, None)], "doc_id long, text string")
    profiles = langid.learn_profiles(clashing(docs))
    everything = clashing(docs.select("doc_id", "text").unionByName(odd))
    got = langid.identify(everything, profiles)
    assert got.count() == docs.count() + 7
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {rows[k]["lang_pred"] for k in (-1, -2, -3)} == {"und"} and rows[-3]["score"] == 0
    assert rows[-4]["lang_pred"] == rows[-5]["lang_pred"] == "en"
    truth = docs_of(session).select("doc_id", "lang").filter(F.length("text") > 60).collect()
    held = [(r["lang"], rows[r["doc_id"]]) for r in truth if rows[r["doc_id"]]["held_out"]]
    assert sum(lang == r["lang_pred"] for lang, r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_language_without_training_rows(session):
    docs = session.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs)
    assert langid.identify(docs, profiles).first()["lang_pred"] == "und"
    assert langid.identify(docs.limit(0), profiles).count() == 0


def test_grams_equal_brute_force():
    text = "Ab, ab aé 42b"
    words = [" ab ", " ab ", " aé ", " b "]
    want = sorted(w[i : i + n] for w in words for n in (1, 2, 3) for i in range(len(w) - n + 1) if w[i : i + n].strip())
    grams = langid.Grams([text, "", text])
    assert grams.count[grams.doc == 0].sum() == len(want) == grams.count[grams.doc == 2].sum()
    assert (grams.doc == 0).sum() == len(set(want))
    assert grams.has_letter.tolist() == [True, False, True]


def test_toxicity_held_out(session):
    docs, labels = docs_of(session), session.read.parquet(f"{SF_CHECK}/labels.parquet")
    labels = clashing(labels.unionByName(labels.limit(5)).unionByName(labels.limit(5).withColumn("toxic", F.lit(None).cast("int"))))
    model = toxicity.train(clashing(docs), labels)
    odd = session.createDataFrame([(-1, None), (-2, ""), (-3, "you idiot, you worthless scum, pathetic moron"), (-4, "a plain short text"), (-5, "x " * 50000)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in toxicity.score(docs.select("doc_id", "text").unionByName(odd), model).collect()}
    assert rows[-1]["score"] == rows[-2]["score"] < 0.5 < rows[-3]["score"] and rows[-4]["predicted"] == 0
    truth = [(r["toxic"], rows[r["doc_id"]]) for r in session.read.parquet(f"{SF_CHECK}/labels.parquet").collect()]
    held = [(y, r["score"]) for y, r in truth if r["held_out"]]
    bad, good = (np.array([s for y, s in held if y == k]) for k in (1, 0))
    assert (bad[:, None] > good[None, :]).mean() > 0.85
    assert (good < 0.5).mean() > 0.95


def test_toxicity_without_labels(session):
    docs = docs_of(session).limit(5)
    labels = session.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.0] * 5
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    good = [np.where(rng.random(4000) < a, y, ~y) for a in (0.9, 0.8, 0.7)]
    votes = np.stack([*good, good[2], good[2], np.where(rng.random(4000) < 0.95, y, ~y)], axis=1).astype(float)
    model = toxicity.fit_label_model(votes, 0.05 + 0.9 * votes[:, -1], np.ones(4000))
    assert abs(model.share - 0.3) < 0.05 and abs(model.fires[1, 0] - 0.9) < 0.06
    assert model.weight[2:5].max() < 0.5 < model.weight[0]
    assert ((model.posterior(votes) >= 0.5) == y).mean() > 0.94


FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä."


def test_unlearned_languages_and_gibberish_get_the_nearest_language_but_are_not_known(session):
    rnd = np.random.default_rng(7)
    gibberish = lambda n: " ".join("".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), rnd.integers(2, 10))) for _ in range(n))
    profiles = langid.learn_profiles(docs_of(session))
    foreign = [FINNISH, FINNISH * 30, " ".join(f"{x:08x}" for x in rnd.integers(0, 1 << 32, 80)), *(gibberish(n) for n in (12, 20, 60, 500))]
    names, score, distance, known = profiles.predict([*foreign, "Привет", ""])
    # a letter is enough for a learned language; only the filter asks whether it is near
    assert set(names[:-1]) <= set(profiles.languages) and names[-1] == "und" and score[-1] == 0
    assert (score[:-1] > 0).all() and not known.any()
    # whole documents outside the sample, and short cuts of them, are known
    texts = [r["text"] for r in docs_of(session).filter((langid.fold("doc_id") == 0) & F.col("text").rlike(r"\p{L}")).collect()]
    cuts = [" ".join(t.split()[:n]) for t in texts for n in (2, 4, 8)]
    assert profiles.predict(texts)[3].all()
    assert (~profiles.predict(cuts)[3]).sum() <= 0.01 * len(cuts)


def test_the_nearest_profile_equals_brute_force(session):
    """Out-of-place distances by plain lists and dictionaries."""
    train = [("x", "the cat and the hat and the bat"), ("y", "le chat et le chien et la nuit"), ("z", "der hund und die katze und der tag")]
    docs = session.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(train * 40)], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs)
    table = {lang: gs for lang, gs in zip(profiles.languages, ([int(profiles.grams[i]) for i in np.argsort(profiles.ranks[:-1, k]) if np.isfinite(profiles.ranks[i, k])] for k in range(3)))}

    def brute(text):
        grams = langid.Grams([text])
        counts = dict(zip(grams.gram.tolist(), grams.count.tolist()))
        ordered = sorted(counts.items(), key=lambda x: -x[1])
        rank = {g: np.mean([i for i, (_, m) in enumerate(ordered) if m == n]) for g, n in ordered}
        return {lang: sum(min(abs(gs.index(g) - r) if g in gs else langid.PROFILE, langid.PROFILE) for g, r in rank.items()) / (len(rank) * langid.PROFILE) for lang, gs in table.items()}

    texts = ["the bat", "la nuit et le chat", "die katze", "hat und chat", "q"]
    names, _, distance, _ = profiles.predict(texts)
    for name, d, text in zip(names, distance, texts):
        want = brute(text)
        assert abs(want[name] - d) < 1e-9 and d == min(abs(x) for x in [d, *want.values()])


def test_one_row_a_sampled_id_is_fitted(session, monkeypatch):
    docs, labels = docs_of(session), session.read.parquet(f"{SF_CHECK}/labels.parquet")
    some = labels.filter("toxic = 1").select("doc_id").first()["doc_id"]
    again = docs.filter(F.col("doc_id") == some)
    hot = docs.unionByName(again.crossJoin(session.range(3000)).drop("id"))
    sent = []
    seen = toxicity.fit_logistic
    monkeypatch.setattr(toxicity, "fit_logistic", lambda rows, cols, n, *a, **k: sent.append(n) or seen(rows, cols, n, *a, **k))
    one, many = toxicity.train(docs, labels), toxicity.train(hot, labels)
    assert sent[0] == sent[1] and np.array_equal(one.keys, many.keys) and np.allclose(one.weight, many.weight)


def test_sampled_labels_are_the_smallest_hashes(session):
    rows = session.range(5000).selectExpr("id AS doc_id", "cast(id % 3 = 0 AS int) AS toxic")
    got = {r["_id"] for r in toxicity.sample_labels(rows, "doc_id", "toxic", 100, 200)[0].collect()}
    allowed = rows.filter(langid.fold("doc_id") != 0).select("doc_id", "toxic", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect()
    want = {r["doc_id"] for k, n in ((1, 100), (0, 200)) for r in sorted((r for r in allowed if r["toxic"] == k), key=lambda r: r["h"])[:n]}
    assert got == want


def test_limits_of_sparse_sizes_and_languages():
    spread = [("a", 10, 100, 30.0, 9.25), ("a", 12, 3, 2.7, 2.43), ("b", 8, 1, 0.9, 0.81)]
    limits = langid.learn_limits(["a", "b"], spread)
    want = 0.3 + langid.SPREADS * 0.05 + langid.MARGIN
    assert np.allclose(limits[[0, 10, 12, 63], 0], want) and np.allclose(limits[10], want)
    assert (langid.learn_limits(["a"], []) == langid.FARTHEST).all()
