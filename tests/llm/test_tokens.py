import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from swipeflow.llm import packing, pretok, text, token_count
from tests.llm.conftest import clashing

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n  x", "<|endoftext|> hi <|startoftext|>", "İSTANBUL ΣΑΣ", "it's 'll we've '’s ''s", "é é 漢字 ½ ٣", "a" * 3000, "word " * 5000]


def texts():
    rnd = random.Random(5)
    alphabet = "ab1 \n\t'stmdrevlST!?.é漢٣ 　_-½"
    return ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(400)]


@pytest.mark.parametrize(("path", "joins"), [(WORDS, False), (BYTES, True)])
def test_pretokens_equal_the_librarys(path, joins):
    pre = token_count.load(path).pre_tokenizer
    table = pretok.probe_classes(pre)
    for t in texts()[10:]:
        own = pretok.PreTokens([t], table, joins)
        assert [own.string(i) for i in range(len(own.starts))] == [t[a:b] for _, (a, b) in pre.pre_tokenize_str(t)]


def test_counts_equal_the_librarys(session):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "again"), (None, "no id")]
    df = clashing(session.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(token_count.count_tokens(df, WORDS).collect(), key=str)
    lib = token_count.load(WORDS)
    want = [(d, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got], key=str) == sorted(want, key=str)
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert token_count.count_tokens(df.limit(0), WORDS).count() == 0


def test_packing_holds_every_id_once(session):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = clashing(session.createDataFrame(rows, "doc_id long, text string"))
    got = packing.pack_documents(df, BYTES).toPandas()
    lib = token_count.load(BYTES)
    for doc, t in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in got[got.doc_id == doc].sort_values("start").itertuples():
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for _, g in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]]
        total = int(g.length.sum())
        assert total <= 1024 and total & (total - 1) == 0
    assert packing.pack_documents(df.limit(0), BYTES).count() == 0


def test_repeated_documents_are_packed_each(session):
    df = session.createDataFrame([(1, "x y")] * 3, "doc_id long, text string")
    got = packing.pack_documents(df, BYTES).toPandas()
    assert got[got.start == 0].shape[0] == 3


def test_words_of_a_slice_are_cut_together_and_merged_once(monkeypatch):
    rnd = random.Random(8)
    lib = token_count.load(BYTES)
    encoder = packing.Encoder(BYTES, pretok.probe_classes(lib.pre_tokenizer))
    merge, asked = encoder.merge, []
    monkeypatch.setattr(encoder, "merge", lambda raw: asked.append(raw) or merge(raw))
    words = ["".join(rnd.choice("abcdefgh漢é") for _ in range(8)) for _ in range(70_000)]  # more words than the first arrays hold
    slices = [[" ".join(words[a : a + 500]) for a in range(b, b + 35_000, 500)] for b in (0, 35_000)]
    for given in (*slices, slices[0], ODD[3:], ["", ""]):
        given = [t or "" for t in given]
        own = pretok.PreTokens(given, encoder.table, True)
        places = own.distinct()[1]
        assert own.strings(places) == [own.string(i) for i in places]
        for closing in (0, None):
            ids, offsets = encoder.encode(given, closing)
            for i, t in enumerate(given):
                want = lib.encode(t, add_special_tokens=False).ids + ([] if closing is None else [closing])
                assert ids[offsets[i] : offsets[i + 1]].tolist() == want
    assert len(asked) == len(set(asked)) > 1 << 16
    monkeypatch.setattr(packing, "CACHE", 10)  # forgets between slices
    assert encoder.encode(slices[1])[0].tolist() == encoder.encode(slices[1])[0].tolist()


def test_merger_equals_library():
    merge, lib = packing.merger(BYTES), token_count.load(BYTES)
    for w in ("hello", " world", "漢字", "thtionble", "\n\n"):
        assert merge(w.encode()) == lib.encode(w, add_special_tokens=False).ids


def test_hilbert_keys_visit_neighbours():
    cells = np.array([(a, b, c) for a in range(4) for b in range(4) for c in range(4)])
    keys = packing.hilbert_keys(cells, 2)
    assert sorted(keys.tolist()) == list(range(64))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def alternating(n):
    """A B B A B A A B ... and the same with A and B exchanged: alike modulo any power of two, letter by letter different."""
    first = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return first, first.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [32, 64, 128, 1024, 2048, 4096])
def test_words_built_to_a_pattern_are_told_apart(session, n):
    x, y = alternating(n)
    assert text.string_hash(x) != text.string_hash(y)
    rows = [(1, x), (2, y), (3, f"{x} {y}"), (4, f"{y} {x} {y}")]
    df = session.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    lib = token_count.load(WORDS)
    got = {r["doc_id"]: r["n_tokens"] for r in token_count.count_tokens(df, WORDS).collect()}
    assert got == {d: len(lib.encode(t, add_special_tokens=False).ids) for d, t in rows}
    lib = token_count.load(BYTES)
    want = {d: [*lib.encode(t, add_special_tokens=False).ids, 0] for d, t in rows}
    pieces = packing.pack_documents(df, BYTES).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in pieces} == {d: len(ids) for d, ids in want.items()}
    for r in pieces:
        own = np.array(want[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(own.tobytes()) == r["ids_crc32"]
