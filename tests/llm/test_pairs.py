import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from swipeflow.llm import blocks, decontam, graph, jaccard_join, pivots
from tests.llm.conftest import clashing


def closure(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("smallest", [True, False])
def test_components_of_chains_stars_and_loops(session, smallest):
    chain = [(i, i + 1) for i in range(60)]
    star = [(500, 500 + k) for k in range(1, 90)]
    edges = chain + star + star[:5] + [(900, 900), (1000, 1001), (1001, 1000), (None, 3)]
    got = {r["node"]: r["component"] for r in graph.components(session.createDataFrame(edges, "a long, b long"), smallest=smallest).collect()}
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    want = closure(nodes, [e for e in edges if None not in e and e[0] != e[1]])
    assert set(got) == nodes
    if smallest:
        assert got == want
    assert len({(got[n], want[n]) for n in nodes}) == len(set(want.values()))
    assert graph.components(session.createDataFrame([], "a long, b long")).count() == 0


def test_block_tasks_meet_every_pair_once(session):
    rows = [(1, m) for m in range(23)] + [(2, m) for m in range(3)] + [(3, 1)]
    dealt = blocks.block_tasks(session.createDataFrame(rows, "k long, m long"), "k", "m", 5).collect()
    tasks = {}
    for r in dealt:
        tasks.setdefault(r["_task"], []).append(r)
    met = []
    for members in tasks.values():
        chunk = np.array([r["_chunk"] for r in members])
        left, right = blocks.pairs_to_compare(chunk, members[0]["_split"])
        met += [(members[0]["k"], *sorted((members[i]["m"], members[j]["m"]))) for i in left for j in right if members[0]["_split"] or i < j]
    want = [(k, *p) for k, n in ((1, 23), (2, 3)) for p in itertools.combinations(range(n), 2)]
    assert sorted(met) == want


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_copies(rnd):
    vocab = [f"w{i}" for i in range(4000)]
    passage = [rnd.choice(vocab) for _ in range(40)]
    texts = []
    for _ in range(8):  # groups of near copies around the threshold
        base = [rnd.choice(vocab) for _ in range(rnd.randint(60, 120))]
        for _ in range(8):
            t = list(base)
            for _ in range(rnd.randint(0, 3)):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            texts.append(" ".join(t))
    hot = [rnd.choice(vocab) for _ in range(100)]
    texts += [" ".join(hot[:-1] + [f"z{k}"]) for k in range(40)]  # one large group
    texts += [" ".join(passage + [rnd.choice(vocab) for _ in range(60)]) for _ in range(60)]  # a shared passage, no copies
    return texts + ["One two, three", "one  two THREE!", "a", "", None, "...", None, "x y z u v", texts[0], texts[0]]


@pytest.mark.parametrize("limits", [{}, {"SMALL": 6, "DEPTH": 3, "BLOCK": 7}])
def test_jaccard_join_equals_brute_force(session, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(jaccard_join, k, v)
    if limits:
        monkeypatch.setattr(jaccard_join.candidate_links, "__defaults__", (6, 3))
    texts = near_copies(random.Random(4))
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.join_similar(clashing(session.createDataFrame(rows, "doc_id long, text string"))).collect()}
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    want = closure(range(len(texts)), links)
    count = {i: 0 for i in want}
    for i, j in links:
        count[i] += 1
        count[j] += 1
    assert len(links) > 800
    assert got == {i: (want[i], count[i]) for i in want}


def test_jaccard_join_of_repeated_ids_and_empty_tables(session):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "g h i j k l"), (None, "a b c d e f"), (2, "g h i j k l")]
    got = sorted(tuple(r) for r in jaccard_join.join_similar(session.createDataFrame(rows, "doc_id long, text string")).fillna(-1).collect())
    assert got == [(-1, 1, 2), (1, 1, 1), (1, 1, 2), (1, 1, 2), (2, 1, 1)]
    empty = session.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.join_similar(empty).count() == 0 and jaccard_join.keep_one(empty).count() == 0


def test_keep_one_keeps_all_columns_and_null_ids(session):
    df = session.createDataFrame([(1, "a b c d e f", "x"), (2, "A b, c d e f", "y"), (None, "a b c d e f", "z"), (3, None, "w")], "doc_id long, text string, lang string")
    assert sorted((r["lang"] for r in jaccard_join.keep_one(df).collect())) == ["w", "x", "z"]


def test_runs_for_recall():
    assert jaccard_join.runs_for(0.9) == 1 and jaccard_join.runs_for(0.9999) == 4


def edit(rnd, text, edits):
    s = list(text)
    for _ in range(edits):
        k = rnd.randrange(1, len(s) - 1)
        op = rnd.random()
        if op < 0.4:
            s[k] = rnd.choice("qxz")
        elif op < 0.7 and s[k] != " " and s[k - 1] != " " and s[k + 1] != " ":
            del s[k]
        else:
            s.insert(k, rnd.choice("qxz"))
    return "".join(s)


def best_edits(item, text):
    """Fewest edits of the whole item anywhere in the text (plain dynamic programming)."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_leaks_equal_brute_force(session):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 8)))
    items = [(k, " ".join(word() for _ in range(rnd.randint(9, 40)))) for k in range(12)]
    items = [(k, t) for k, t in items if len(t) >= decontam.MIN_CHARS]
    docs = []
    for k, t in items:
        for rate in (0, 0.03, 0.07, 0.1, 0.15, 0.3):
            filler = " ".join(word() for _ in range(60))
            docs.append(f"{filler} {edit(rnd, t, int(rate * len(t)))} {filler}")
        docs += [t.upper().replace(" ", ",\n "), t[: len(t) // 2] + " " + word(), t + " " + t]
    rows = [(i, t) for i, t in enumerate(docs)] + [(-1, None), (-2, ""), (None, docs[0])]
    bench = session.createDataFrame([*items, (99, None), (98, ""), (96, "!" * 100)], "item_id long, text string")
    found = decontam.find_leaks(clashing(session.createDataFrame(rows, "doc_id long, text string")), clashing(bench)).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found}
    norm = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    want = {}
    for i, t in rows[: len(docs)]:
        for k, it in items:
            made = decontam.make_item(k, it, decontam.ERROR_RATE)
            edits = best_edits(norm(it), norm(t))
            if edits <= made.budget:
                want[i, k] = edits
    assert {k: v for k, v in got.items() if k[0] is not None} == want and len(want) > 50
    assert any(r["doc_id"] is None for r in found)
    for r in found:
        if r["doc_id"] is not None and r["edits"] == 0:
            assert norm(docs[r["doc_id"]][r["start"] : r["end"]]) == norm(dict(items)[r["item_id"]])


def test_short_items_are_found_unchanged_as_whole_words(session):
    items = [(1, "What is the capital of France?"), (2, "Yes!"), (3, "日本の首都はどこですか"), (4, "a b"), (5, "yes"), (6, "?"), (7, "ab a b ab")]
    texts = ["He asked: WHAT is the  capital of France", "what is the capital of Francee", "yes, yes", "eyes yesterday", "答え 日本の首都はどこですか。", "x a, b", "a bc", "ab a b ab a b ab", "", None]
    docs = clashing(session.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = sorted((r["doc_id"], r["item_id"], r["edits"], texts[r["doc_id"]][r["start"] : r["end"]]) for r in decontam.find_leaks(docs, session.createDataFrame(items, "item_id long, text string")).collect())
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    want = {(i, k) for i, t in enumerate(texts) for k, it in items if norm(it).strip() and norm(it) in norm(t)}
    assert {g[:2] for g in got} == want and {e for _, _, e, _ in got} == {0}
    assert [t for i, k, _, t in got if (i, k) == (2, 5)] == ["yes", "yes"] and (0, 1, 0, "WHAT is the  capital of France") in got
    # overlapping places of one item count once
    assert sum(g[:2] == (7, 7) for g in got) == 1


def test_quotes_of_long_items_are_leaks(session):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    item = " ".join(word() for _ in range(160))
    filler = " ".join(word() for _ in range(80))
    quotes = [item[a : a + 200] for a in range(0, len(item) - 200, 37)]
    texts = [f"{filler} {q} {filler}" for q in quotes] + [f"{filler} {item} {filler}", f"{filler} {item[:100]} {filler}", filler, f"{edit(rnd, item[100:420], 12)}", f"{item[:250]} {filler} {item[300:600]}"]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = decontam.find_leaks(docs, session.createDataFrame([(5, item)], "item_id long, text string")).collect()
    per = {i: [(r["start"], r["end"], r["edits"]) for r in rows if r["doc_id"] == i] for i in range(len(texts))}
    n = len(quotes)
    assert all(len(per[i]) == 1 and per[i][0][1] - per[i][0][0] >= decontam.PASSAGE for i in range(n))
    assert [texts[n][a:b] for a, b, _ in per[n]] == [item] and per[n + 1] == per[n + 2] == []
    assert len(per[n + 3]) == 1 and per[n + 3][0][2] > 0 and len(per[n + 4]) == 2
    assert {r["item_chars"] for r in rows} == {len(item)}


def test_many_matches_of_one_item_end_soon():
    import time

    found = [(0, 1, 50 * k + d, 50 * k + d + 45, d, 45, 45) for k in range(20_000) for d in (0, 1)]
    began = time.monotonic()
    assert len(decontam.merged(found)) == 20_000 and time.monotonic() - began < 5


def test_leaks_of_empty_tables(session):
    docs, bench = (session.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    assert decontam.find_leaks(docs, bench).count() == 0 and decontam.drop_contaminated(docs, bench).count() == 0


def test_banded_alignment_of_equal_places_takes_the_leftmost():
    item, text = (np.array([ord(c) for c in s], np.uint32) for s in ("abcdabcd", "xabcdabcdxabcdabcd"))
    assert decontam.banded_alignment(item, text, 0, 12, 2, 0, len(text)) == (1, 9, 0)
    text = np.array([ord(c) for c in "xabzdabcdx"], np.uint32)
    assert decontam.banded_alignment(item, text, 0, 3, 1, 0, len(text)) == (1, 9, 1)


def test_vectors_equal_brute_force(session):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 24))
    vectors = base.tolist()
    vectors += [(base[k % 30] + 0.05 * rng.normal(size=24)).tolist() for k in range(90)]
    vectors += [base[7].tolist()] * 60 + [(-base[3]).tolist(), (base[3] * 5).tolist()] + [(base[9] + 0.03 * rng.normal(size=24)).tolist() for _ in range(50)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0], [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate([*vectors, *odd])]
    df = clashing(session.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pivots.link_vectors(df, block=16).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    n = len(vectors)
    links = [(i, j) for i in range(n) for j in range(i + 1, n) if close[i, j]] + [(n + 6, n + 7)]
    want = closure(range(len(rows)), links)
    count = dict.fromkeys(want, 0)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    true = sum(count.values())
    assert sum(c for c, _, _ in got.values()) >= 0.98 * true and true > 4000
    assert all(got[i][0] <= count[i] for i in got)
    assert sum(got[i][1] != want[i] for i in got) <= 2
    assert all(got[i] == (0, i, True) for i in range(n, n + 6))
    assert pivots.link_vectors(df.limit(0)).count() == 0
    assert df.select(F.count("*")).first()[0] == len(got)


def test_documents_of_words_built_to_a_pattern_are_no_copies(session):
    marks = [bin(i).count("1") & 1 for i in range(10240)]
    x, y = (" ".join(("alpha", "beta")[m ^ flip] for m in marks) for flip in (0, 1))
    words = ["".join("ab"[m ^ flip] for m in marks[:2048]) for flip in (0, 1)]
    a, b = (" ".join([w] * 9 + [w + str(k) for k in range(9)]) for w in words)
    prefix = " ".join(f"p{k}" for k in range(10240))
    rows = [(1, f"{prefix} {x}"), (2, f"{prefix[::-1]} {y}"), (3, a), (4, b), (5, a)]
    for first, second in ((a, b), (words[0], words[1])):
        one, two = (jaccard_join.Shingles([t]) for t in (first, second))
        assert not set(one.hashes.tolist()) & set(two.hashes.tolist())
        assert [v.tolist() for v in one.fingerprints()] != [v.tolist() for v in two.fingerprints()]
    fp = [tuple(v.tolist()[0] for v in jaccard_join.Shingles([t]).fingerprints()) for t in (x, y, x, "alphabeta", "alpha beta", "Alpha, BETA!")]
    assert fp[0] != fp[1] and fp[0] == fp[2] and fp[3] != fp[4] == fp[5]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.join_similar(session.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 0), 2: (2, 0), 3: (3, 1), 4: (4, 0), 5: (3, 1)}


def test_rows_are_dropped_by_row_not_by_id(session):
    a, b, c, d = ("a b c d e f", "g h i j k l", "m n o p q r", "s t u v w x y z a b c d e f g h i j k l m n")
    rows = [(1, a, "x"), (5, a, "x"), (5, b, "x"), (7, c, "x"), (7, c, "x"), (7, c, "x"), (None, c, "x"), (None, d, "x"), (None, d + " o", "x"), (None, None, "x"), (None, None, "x")]
    df = session.createDataFrame(rows, "doc_id long, text string, _key string").repartition(4)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    got = sorted((tuple(r) for r in jaccard_join.keep_one(df, null_ids_stay=False).collect()), key=order)
    of_d = [r for r in got if r[1] and r[1].startswith(d)]
    assert len(of_d) == 1
    assert [r for r in got if r not in of_d] == [(None, None, "x"), (None, None, "x"), (1, a, "x"), (5, b, "x"), (7, c, "x")]
    # by default rows with a null id stay beside the row that represents them
    stay = sorted((tuple(r) for r in jaccard_join.keep_one(df).collect()), key=order)
    assert stay == sorted([r for r in rows if r[0] is None] + [(1, a, "x"), (5, b, "x"), (7, c, "x")], key=order)
    # texts whose rows all have a null id are linked with different texts too
    links = [r["n_links"] for r in jaccard_join.join_similar(df.filter(F.col("text").startswith(d))).collect()]
    assert links == [1, 1]


def test_contaminated_rows_go_by_their_own_text(session):
    item = "the quick brown fox jumps over the lazy dog and runs far away"
    rows = [(1, f"so {item} now"), (1, "clean"), (None, f"so {item} now"), (None, "clean"), (2, None), (3, "clean"), (3, f"{item}"), (3, f"{item}")]
    df = clashing(session.createDataFrame(rows, "doc_id long, text string"))
    bench = session.createDataFrame([(1, item)], "item_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in decontam.drop_contaminated(df, bench).collect()), key=repr)
    assert got == sorted([(1, "clean"), (None, "clean"), (2, None), (3, "clean")], key=repr)
