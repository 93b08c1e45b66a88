"""Shards by prefix sums, the prefix trie and the repair of conversations, against brute force."""

import functools
import hashlib
import random
import zlib

import pytest

from swipeflow.llm import order, prefix_trie, queries, repair, sharding
from tests.llm.conftest import clashing

TURNS = "conv_id long, turn long, role string, text string"


# ---- order and shards ---------------------------------------------------------------


def test_rows_are_numbered_and_summed_in_order_over_many_partitions(session, tmp_dir):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 2, 2, 7]), rnd.randrange(9), k) for k in range(900)]
    session.createDataFrame(rows, "a int, size long, k int").repartition(7).write.parquet(f"{tmp_dir}/t")
    got = order.in_order(session.read.parquet(f"{tmp_dir}/t"), ["a"], "size").collect()
    got.sort(key=lambda r: r["_at"])
    assert [r["_at"] for r in got] == list(range(900)) and {r["k"] for r in got} == set(range(900))
    assert [r["a"] for r in got] == sorted((r[0] for r in rows), key=lambda a: (a is not None, a))
    total = 0
    for r in got:
        assert r["_before"] == total
        total += r["size"]


def test_equal_keys_are_spread_over_partitions(session, tmp_dir):
    session.range(4000).selectExpr("1 AS a", "1L AS size").repartition(8).write.parquet(f"{tmp_dir}/t")
    got = order.in_order(session.read.parquet(f"{tmp_dir}/t"), ["a"], "size")
    assert sorted(r["_at"] for r in got.collect()) == list(range(4000))


def test_ordered_digest_streams_pieces_in_order(session):
    rows = [(k % 3, k, f"p{k}") for k in range(50)] + [(None, 1, None), (None, 0, "x")]
    got = {r["key"]: r["sha256"] for r in order.ordered_digest(session.createDataFrame(rows, "key long, at long, piece string"), "key", ["at"], "piece", ",").collect()}
    want = {key: ",".join(f"p{k}" for k in range(50) if k % 3 == key) for key in range(3)} | {None: "x,"}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def shards_of(docs, shards):
    """The law in plain Python: order, targets, nearer end of the row, unless the end of a group is close."""
    rows = sorted((hashlib.sha256((t or "").encode()).digest(), i is not None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    total, at, ends = sum(r[3] for r in rows), 0, []
    for r in rows:
        ends.append((at, at + r[3]))
        at += r[3]
    groups = {}
    for r, (a, b) in zip(rows, ends):
        groups[r[0]] = (min(groups.get(r[0], (a, b))[0], a), b)
    largest, cuts = max(r[3] for r in rows), []
    for k in range(1, shards):
        (r, row), = [(r, e) for r, e in zip(rows, ends) if shards * e[0] <= k * total < shards * e[1]]
        off = lambda x: abs(shards * x - k * total)
        near = min(groups[r[0]], key=off)
        close = 2 * off(near) <= shards * largest and 200 * off(near) <= total
        cuts.append(max([near if close else min(row, key=off), *cuts]))
    out, slots = [], {}
    for r, (a, _) in zip(rows, ends):
        shard = sum(c <= a for c in cuts)
        out.append((r[2] if r[1] else None, r[3], r[4], shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
    return out


def documents(rnd, n):
    hot = "the same text again " * 5
    texts = [hot if rnd.random() < 0.33 else " ".join(rnd.choice(["a", "bé", "c" * 9]) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "no id"), (None, None), (5, None), (6, ""), (7, "日本語 " * 400)]
    return rows + [(3, texts[3])] * 3


@pytest.mark.parametrize("n,shards", [(600, 40), (600, 7), (8, 40), (50, 1)])
def test_shards_equal_the_law_in_plain_python(session, n, shards):
    docs = documents(random.Random(n), n)
    got = sharding.shard_by_bytes(clashing(session.createDataFrame(docs, "doc_id long, text string")), shards)
    rows = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(shards_of(docs, shards), key=repr)


def test_shards_are_near_equal_and_gapless(session):
    docs = documents(random.Random(1), 3000)
    got = sharding.shard_by_bytes(session.createDataFrame(docs, "doc_id long, text string"), 40)
    rows = got.collect()
    largest, by = max(r["size"] for r in rows), {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    sizes = {k: sum(r["size"] for r in v) for k, v in by.items()}
    mean = sum(sizes.values()) / 40
    assert set(by) == set(range(40)) and all(abs(s - mean) <= largest for s in sizes.values())
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    report = {r["shard"]: (r["n_rows"], r["bytes"]) for r in sharding.shard_report(got).collect()}
    assert report == {k: (len(v), sizes[k]) for k, v in by.items()}


def test_shards_of_nothing_and_of_one_row(session):
    empty = session.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_by_bytes(empty, 40).count() == 0
    one = sharding.shard_by_bytes(session.createDataFrame([(1, "x" * 100)], "doc_id long, text string"), 40).collect()
    assert len(one) == 1 and one[0]["slot"] == 0


# ---- trie ---------------------------------------------------------------------------


def turn_order(rows):
    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    return sorted(((t is not None, t or 0, (r or "")[:16], (x or "")[:64], digest(r or "", x or ""), r or "", x or "") for t, r, x in rows))


def trie_of(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t, r, x))
    own = {c: [k[-2:] for k in turn_order(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes = {}
    for c, p in built.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    kids = {p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes) for p in nodes}
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(members) if built[c] == p)
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p], sum(not kids[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rnd, n):
    rows = []
    for c in range(n):
        for t in range(rnd.choice([0, 1, 2, 3, 12])):
            rows.append((c, t, rnd.choice(["user", "assistant"]), rnd.choice(["hé", "yes", "no way"])))
    rows += [(c, t, "user", "copy") for c in range(1000, 1040) for t in range(3)]
    rows += [(2000, None, "user", "null turn"), (2000, 0, None, "x"), (2000, 0, "user", None), (2000, 1, "a", "tie b"), (2000, 1, "a", "tie a")]
    return rows + [(-3, 0, "user", "negative"), (None, 0, "user", "no id"), (2001, 3, "user", "again"), (2001, 3, "user", "again")]


def test_trie_equals_brute_force(session, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BUCKET", 7)
    rows = conversations(random.Random(2), 60)
    df = clashing(session.createDataFrame(rows, TURNS))
    got = prefix_trie.trie_nodes(*prefix_trie.rebuilt_with_shared_heads(df))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got.columns == columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == trie_of(rows)


def test_plain_conversations_and_an_empty_table(session):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "c")]
    nodes = {(r["conv_id"], r["depth"]): r for r in prefix_trie.conversation_trie(session.createDataFrame(rows, TURNS)).collect()}
    assert set(nodes) == {(1, 0), (1, 1), (1, 2), (3, 2)}
    assert nodes[(1, 1)]["n_convs"] == 3 and nodes[(1, 1)]["n_leaves"] == 2 and nodes[(1, 1)]["n_children"] == 2
    assert nodes[(1, 1)]["ends_sha256"] == hashlib.sha256(b"2").hexdigest() and nodes[(1, 0)]["saved_tokens"] == 2
    assert prefix_trie.conversation_trie(session.createDataFrame([], TURNS)).count() == 0


# ---- repair -------------------------------------------------------------------------


def brute_repair(symbols):
    code, best = [ord(c) - ord("A") for c in symbols], None
    for length in [0, *range(2, 2 * len(code) + 4)]:
        target = ("s" if length % 2 else "") + "ua" * (length // 2)

        @functools.lru_cache(None)
        def rest(i, j, target=target):
            if (i, j) == (len(code), len(target)):
                return 0, ""
            options = []
            if i < len(code):
                c, a = rest(i + 1, j)
                options.append((c + 3, "D" + a))
            if j < len(target) and target[j] != "s":
                c, a = rest(i, j + 1)
                options.append((c + 2, "I" + a))
            if i < len(code) and j < len(target) and code[i] < 8:
                c, a = rest(i + 1, j + 1)
                if "suax"[code[i] % 4] == target[j]:
                    options.append((c + (code[i] >= 4), "K" + a))
                if target[j] != "s":
                    options.append((c + 2 + (code[i] >= 4), "R" + a))
            return min(options) if options else (10**6, "")

        best = min(filter(None, [best, rest(0, 0)]))
    return best


@pytest.mark.parametrize("limits", [{}, {"DENSE_CELLS": 10, "WIDE": 8}])
def test_alignment_equals_all_alignments(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(repair, name, value)
    rnd = random.Random(7)
    for n in [*range(5)] * 60 + [*range(5, 22)] * 12:
        symbols = "".join(rnd.choice(repair.SYMBOLS if rnd.random() < 0.3 else "ABBBCCC") for _ in range(n))
        assert repair.align(symbols) == brute_repair(symbols), symbols


def test_bands_and_dense_tables_agree_on_long_conversations(monkeypatch):
    rnd = random.Random(1)
    symbols = "".join(rnd.choice(repair.SYMBOLS) if rnd.random() < 0.2 else "BC"[i % 2] for i in range(1500))
    dense = repair.align(symbols)
    monkeypatch.setattr(repair, "DENSE_CELLS", 1)
    assert repair.align(symbols) == dense
    letters = dense[1]
    assert sum(letters.count(x) for x in "DKR") == 1500


def report_of(rows):
    """The contract of op11 in plain Python."""
    blank = lambda v: " " if v is None else str(v)
    out = []
    for conv in {r[0] for r in rows}:
        kept = []
        for c, t, role, text in rows:
            if c != conv:
                continue
            f = zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20
            role, text = blank(role), blank(text)
            text = "" if f == 1 else "".join(x for x in text if x not in ".!?") if f == 2 else text
            kept += [(t, "user" if f == 4 else role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
        turns = [(k[0], k[1], *k[-2:]) for k in turn_order(kept)]
        seen, symbols, faults = set(), "", [0, 0, 0]
        for _, _, role, text in turns:
            body = text.rstrip(repair.SPACE)
            fault = 2 if not body else 3 if (role, text) in seen else 1 if body[-1] not in ".!?" else 0
            seen.add((role, text))
            if fault:
                faults[(None, 2, 0, 1)[fault]] += 1
            kind = "sua".find(role[0]) if role else -1
            symbols += repair.SYMBOLS[4 * fault + (kind if kind >= 0 else 3)]
        pairs = zip([t[2][:1] for t in turns], [t[2][:1] for t in turns][1:])
        cost, audit = brute_repair(symbols)
        lines, i, left = [], 0, sum(x != "D" for x in audit)
        for x in audit:
            role, text = (turns[i][2], turns[i][3]) if x != "I" else ("", "")
            if x != "D":
                lines.append((role if x == "K" else "assistant" if left % 2 else "user") + ":" + text)
                left -= 1
            i += x != "I"
        numbers = {t[1] for t in turns if t[0]}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out.append((conv, gaps, *faults, sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def damaged_talks(rnd):
    rows = []
    for c in range(120):
        for t in range(rnd.choice([1, 2, 5, 9])):
            role = ("system" if t == 0 and c % 3 == 0 else None) or ("user", "assistant")[t % 2] if rnd.random() < 0.9 else rnd.choice([None, "", "tool", "u"])
            rows.append((c, t * rnd.choice([1, 1, 2]), role, rnd.choice(["Fine.", "Well", "So? \n", "", " \t", None, "é!", "Fine.\x85"])))
    rows += [(500, None, "user", "first."), (500, None, "assistant", "second."), (500, 7, "user", "x."), (500, 7, "user", "x.")]
    return rows + [(None, 0, "user", "no id."), (None, 1, "assistant", "yes."), (-4, 0, "assistant", "Only.")]


def test_repair_report_equals_the_contract_in_plain_python(session, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", 3)
    rows = damaged_talks(random.Random(4))
    df = clashing(session.createDataFrame(rows, TURNS))
    got = repair.repair_report(repair.damaged(df), df.select("conv_id"))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == report_of(rows)


def test_repaired_turns_follow_the_grammar(session):
    rows = [(1, k, r, t) for k, (r, t) in enumerate([("assistant", "Hi."), ("system", "Be kind."), ("user", "Why?"), ("user", "Why?"), ("assistant", "Because")])]
    turns = repair.checked_turns(session.createDataFrame(rows, TURNS))
    plans = repair.plan_repairs(turns)
    assert plans.first()["audit"] == "DKKDK" and plans.first()["cost"] == 7
    got = [(r["edit"], r["role"], r["text"]) for r in repair.repaired_turns(turns, plans).orderBy("pos").collect()]
    assert got == [("K", "system", "Be kind."), ("K", "user", "Why?"), ("K", "assistant", "Because")]


def test_repair_of_an_empty_table(session):
    empty = session.createDataFrame([], TURNS)
    assert repair.repair_report(repair.damaged(empty), empty.select("conv_id")).count() == 0


def test_registered_with_sql():
    for name in ("op11_conversation_repair", "op12_prefix_trie", "op13_sharding"):
        assert name in queries.REGISTRY and name in queries.ORACLE
