"""Benchmark decontamination by the q-gram lemma.

A passage that holds a benchmark item of n characters with at most k edits
shares at least ``n + 1 - q (k + 1)`` q-grams with it, all of them near one
diagonal of the document-by-item matrix. The search keeps every such passage:

1. Texts and items are lower-cased and every run of characters that are neither
   letters nor digits becomes one space. The distinct q-grams of all items form
   a bitmap, split by item length class.
2. One pass over a document marks the positions whose q-gram occurs in some
   item of a class; windows of the largest passage of that class with fewer
   marks than the smallest bound of the class cannot hold an item and are dropped.
3. In what remains, marks are looked up exactly and counted per item in
   overlapping diagonal bands of width k; regions below the item's own bound go.
4. The rest is verified by banded alignment of the whole item against the
   region, free ends in the document, at most k edits.

Two kinds of leak lie outside the edit bound. An item of fewer than ``MIN_CHARS`` characters, where edits would
leave nothing to recognise, is searched unchanged, as whole words, whatever its length (Aho-Corasick). Of an
item of ``LONG_ITEM`` characters or more, overlapping passages of ``PASSAGE`` characters count as well, each with
the edit budget of its own length; so any quote of ``PASSAGE + STEP`` characters is found. Passages that
overlap in the document are one leak, unless the whole item is found there.

The benchmark is a small table by its nature: it is collected and broadcast
only up to ``MAX_ITEM_CHARS`` characters, and processed in groups of that size
beyond it, each group over all documents, so no item is dropped.

Edge cases: null or empty texts match nothing; items without a letter or digit match nothing; repeated items
(equal after normalising) each report their matches; overlapping matches of one
item keep the one with fewest edits, then the leftmost; repeated documents give
their rows each; empty tables give empty results. Texts are read whole. Only
the named columns are read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import numbered, without
from swipeflow.llm.text import CodePoints, category_table, chunks, lower_table, mix64

Q = 8
#: Edits allowed per item character.
ERROR_RATE = 0.08
MIN_CHARS = 40
#: Items of this many characters are also searched by passages, one beginning every ``STEP`` characters.
LONG_ITEM, PASSAGE, STEP = 240, 160, 40
CLASSES = 8
MAX_ITEM_CHARS = 1_000_000

_U = np.uint64


class Normal:
    """Normalised texts in one array, with the original position of every character."""

    def __init__(self, texts: list[str]) -> None:
        code = CodePoints(texts)
        kind = category_table()[code.cps]
        word = (kind == 1) | (kind == 2) | (kind == 4)
        keep = word.copy()
        keep[1:] |= word[:-1]  # the first character after a word stands for the run
        first = code.firsts
        keep[first] = word[first]
        self.at = np.flatnonzero(keep)
        self.cps = np.where(word[self.at], lower_table()[code.cps[self.at]], 0x20).astype(np.uint32)
        self.raw_offsets = code.offsets
        self.offsets = np.searchsorted(self.at, code.offsets)

    def grams(self) -> np.ndarray:
        """64-bit hash of the q-gram at every position (the last q - 1 are padded)."""
        with np.errstate(over="ignore"):
            h = self.cps.astype(_U) + _U(1)
            step, factor = 1, 0x9E3779B97F4A7C15
            while step < Q:
                nxt = np.zeros_like(h)
                nxt[:-step] = h[step:]
                h = h * _U(factor) + nxt
                factor = factor * factor & ((1 << 64) - 1)
                step *= 2
        return mix64(h)


@dataclass
class Item:
    """A benchmark item or a passage of one: the item's id, normalised characters, edit budget, q-gram bound, and the
    characters of the whole item."""

    item_id: int
    cps: np.ndarray
    budget: int
    bound: int
    whole: int


def normal_item(text: str | None) -> np.ndarray:
    cps = Normal([(text or "").strip()]).cps
    return cps[:-1] if len(cps) and cps[-1] == 0x20 else cps


def make_item(item_id: int, text: str | None, rate: float) -> Item | None:
    """The whole item, or None if it is too short for edits."""
    cps = normal_item(text)
    return searchable(item_id, cps, rate, len(cps)) if len(cps) >= MIN_CHARS else None


def searchable(item_id: int, cps: np.ndarray, rate: float, whole: int) -> Item:
    n = len(cps)
    budget = min(int(rate * n), (n + 1) // Q - 2)  # the bound stays positive
    return Item(item_id, cps, budget, n + 1 - Q * (budget + 1), whole)


def passages(item: Item, rate: float) -> list[Item]:
    """Overlapping passages of a long item; the last one ends with it."""
    n = len(item.cps)
    if n < LONG_ITEM:
        return []
    starts = sorted({*range(0, n - PASSAGE, STEP), n - PASSAGE})
    return [searchable(item.item_id, item.cps[a : a + PASSAGE], rate, n) for a in starts]


class ShortItems:
    """Items too short for edits, found unchanged as whole words."""

    def __init__(self, items: list[tuple[int, np.ndarray]]) -> None:
        import ahocorasick

        self.owners: dict[str, list[int]] = {}
        for item_id, cps in items:
            self.owners.setdefault(_string(cps), []).append(item_id)
        self.machine = ahocorasick.Automaton()
        for text in self.owners:
            self.machine.add_word(f" {text} ", text)
        if self.owners:
            self.machine.make_automaton()

    def matches(self, normal: Normal) -> Iterator[tuple[int, int, int, int, int, int]]:
        if not self.owners:
            return
        for doc, (a, b) in enumerate(zip(normal.offsets[:-1].tolist(), normal.offsets[1:].tolist())):
            text = _string(normal.cps[a:b])
            # one space in front and at least one behind, so an end at position e is the text's position e - 1
            for end, found in self.machine.iter(f" {text} "):
                for item_id in self.owners[found]:
                    yield doc, item_id, a + end - 1 - len(found), a + end - 1, 0, len(found)


def _string(cps: np.ndarray) -> str:
    return cps.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


class Index:
    """All items: exact q-gram table, and per length class a bit in the bitmap, the window and the least bound."""

    def __init__(self, items: list[Item]) -> None:
        self.items = sorted(items, key=lambda x: (len(x.cps), x.item_id))
        grams, owner, place = [], [], []
        for k, item in enumerate(self.items):
            n = Normal.__new__(Normal)
            n.cps = item.cps
            g = n.grams()[: len(item.cps) - Q + 1]
            grams.append(g)
            owner.append(np.full(len(g), k))
            place.append(np.arange(len(g)))
        gram, owner, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (grams, owner, place))
        order = np.argsort(gram, kind="stable")
        self.gram, self.owner, self.place = gram[order].astype(_U), owner[order], place[order]
        bits = max(22, (16 * len(self.gram)).bit_length())
        self.shift = _U(64 - bits)
        self.bitmap = np.zeros(1 << bits, np.uint8)
        self.classes: list[tuple[int, int]] = []
        for c, members in enumerate(np.array_split(np.arange(len(self.items)), CLASSES)):
            if not len(members):
                continue
            mine = (self.owner >= members[0]) & (self.owner <= members[-1])
            self.bitmap[self.gram[mine] >> self.shift] |= 1 << c
            own = [self.items[m] for m in members]
            self.classes.append((max(len(x.cps) + x.budget for x in own), min(x.bound for x in own)))

    def regions(self, normal: Normal, gram: np.ndarray) -> list[tuple[int, int]]:
        """Disjoint ranges of normalised positions that may hold an item."""
        n = len(gram)
        marks = self.bitmap[gram >> self.shift]
        marked = np.flatnonzero(marks)
        marks = marks[marked]
        open_at = np.zeros(n + 1, np.int64)
        for c, (window, bound) in enumerate(self.classes):
            hits = marked[(marks >> c) & 1 == 1]
            if len(hits) < bound:
                continue
            near = np.flatnonzero(hits[bound - 1 :] - hits[: len(hits) - bound + 1] < window)
            if len(near):
                # all windows that contain the run of hits
                open_at += np.bincount(np.maximum(hits[near + bound - 1] - window, 0), minlength=n + 1)
                open_at -= np.bincount(np.minimum(hits[near] + window, n), minlength=n + 1)
        inside = np.concatenate([[0], (np.cumsum(open_at[:n]) > 0).astype(np.int8), [0]])
        edge = np.diff(inside)
        return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))

    def matches(self, normal: Normal) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(text, item, start, end, edits, length sought, length of the whole item) of every verified place, in normalised positions."""
        if not len(self.items) or not len(normal.cps):
            return
        gram = normal.grams()
        # a q-gram across two texts is none
        for size in range(1, Q):
            ends = normal.offsets[1:] - size
            gram[ends[(ends >= normal.offsets[:-1])]] = 0
        for low, high in self.regions(normal, gram):
            first = int(np.searchsorted(normal.offsets, low, side="right")) - 1
            last = int(np.searchsorted(normal.offsets, high, side="left"))
            for doc in range(first, last):
                a, b = max(low, int(normal.offsets[doc])), min(high, int(normal.offsets[doc + 1]))
                if b - a >= Q:
                    yield from ((doc, *m) for m in self.in_region(normal.cps, gram, a, b, int(normal.offsets[doc]), int(normal.offsets[doc + 1])))

    def in_region(self, cps: np.ndarray, gram: np.ndarray, a: int, b: int, doc_start: int, doc_end: int) -> list[tuple[int, int, int, int, int, int]]:
        g = gram[a:b]
        lo, hi = np.searchsorted(self.gram, g), np.searchsorted(self.gram, g, side="right")
        reps = hi - lo
        if not reps.sum():
            return []
        pos = np.repeat(np.arange(a, b), reps)
        entry = np.repeat(lo - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        owner, diagonal = self.owner[entry], pos - self.place[entry]
        order = np.lexsort((diagonal, owner))
        owner, diagonal = owner[order], diagonal[order]
        cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
        found = []
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            item = self.items[owner[s]]
            d = diagonal[s:e]
            if len(d) < item.bound:
                continue
            # bands [d, d + k] that overlap: any alignment within budget stays in one of width k
            dense = np.flatnonzero(d[item.bound - 1 :] - d[: len(d) - item.bound + 1] <= item.budget)
            if not len(dense):
                continue
            begin, end = d[dense], d[dense + item.bound - 1]
            groups = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1] + item.budget, [True]]))
            for x, y in zip(groups[:-1], groups[1:], strict=True):
                low = int(begin[x]) - item.budget
                high = int(end[y - 1]) + item.budget
                hit = banded_alignment(item.cps, cps, low, high, item.budget, doc_start, doc_end)
                if hit:
                    found.append((item.item_id, *hit, len(item.cps), item.whole))
        return found


def literal(item: np.ndarray, text: np.ndarray, low: int, high: int) -> int | None:
    """The first place from low to high where ``text`` holds ``item`` unchanged."""
    if high < low:
        return None
    at = text[low : high + len(item)].tobytes().find(item.tobytes())
    while at >= 0 and at % 4:
        at = text[low : high + len(item)].tobytes().find(item.tobytes(), at + 1)
    return low + at // 4 if at >= 0 else None


def banded_alignment(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int, start: int, end: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best place of the whole item in ``text[start:end]`` on the
    diagonals low..high (text position minus item position), or None beyond the budget.

    Row by row over the item; the vector holds one cell per diagonal. A cell carries its
    edits and where its alignment began, packed so that fewer edits, then the leftmost, win.
    """
    exact = literal(item, text, max(low, start), min(high, end - len(item)))
    if exact is not None:
        return exact, exact + len(item), 0
    width = high - low + 1
    shift = 1 << 40
    big = (budget + 1) * shift * 4
    diagonals = np.arange(low, high + 1)
    ok = (diagonals >= start) & (diagonals <= end)
    cells = np.where(ok, diagonals, big)  # row 0: nothing aligned, free start
    ramp = np.arange(width) * shift
    for i, c in enumerate(item):
        at = diagonals + i  # text position consumed by the diagonal step
        inside = (at >= start) & (at < end)
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == c
        step = np.where(inside, cells + np.where(same, 0, shift), big)
        up = np.full(width, big)  # item character deleted: diagonal d + 1 of the row before
        up[:-1] = cells[1:] + shift
        up = np.where((at + 1 >= start) & (at + 1 <= end), up, big)
        best = np.minimum(step, up)
        # text characters inserted: from lower diagonals of this row, one edit each
        best = np.minimum(best, np.minimum.accumulate(best - ramp) + ramp)
        cells = np.where((at + 1 >= start) & (at + 1 <= end), best, big)
    k = int(np.argmin(cells))
    edits, begin = int(cells[k]) // shift, int(cells[k]) % shift
    return (begin, int(diagonals[k]) + len(item), edits) if edits <= budget else None


def best_only(found: list[tuple]) -> list[tuple]:
    """Of overlapping matches (text, item, start, end, edits, ...) of one item in one text, the one with fewest edits,
    then the leftmost."""
    kept: list[tuple] = []
    key, starts, ends = None, [], []  # of the kept matches of one item and text, which do not overlap
    for m in sorted(found, key=lambda m: (m[0], m[1], m[4], m[2])):
        if m[:2] != key:
            key, starts, ends = m[:2], [], []
        at = bisect.bisect_left(starts, m[3])
        if at and ends[at - 1] > m[2]:
            continue
        starts.insert(at, m[2])
        ends.insert(at, m[3])
        kept.append(m)
    return sorted(kept)


def merged(found: list[tuple]) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item, start, end, edits, item length): the best whole matches, and stretches of overlapping passages of an
    item that no whole match of it touches, with the edits of their worst passage."""
    whole = best_only([m[:6] for m in found if m[5] == m[6]])
    taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for m in whole:
        taken.setdefault(m[:2], []).append((m[2], m[3]))
    stretches: list[list[int]] = []
    for m in sorted(m for m in found if m[5] < m[6]):
        last = stretches[-1] if stretches else None
        if last and tuple(last[:2]) == m[:2] and m[2] < last[3]:
            last[3], last[4] = max(last[3], m[3]), max(last[4], m[4])
        else:
            stretches.append([*m[:5], m[6]])
    out = list(whole)
    for x in stretches:
        spans = taken.get((x[0], x[1]), [])
        at = bisect.bisect_left(spans, (x[3], -1))
        if not (at and spans[at - 1][1] > x[2]):
            out.append(tuple(x))
    return sorted(out)


def item_groups(benchmark: DataFrame, id_col: str, text_col: str, limit: int = MAX_ITEM_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in groups of at most ``limit`` characters (or one item), streamed from Spark."""
    group: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    for r in rows.toLocalIterator():
        if group and size + len(r["t"]) > limit:
            yield group
            group, size = [], 0
        group.append((r["i"], r["t"]))
        size += len(r["t"])
    if group:
        yield group


MATCH_FIELDS = "item_id long, start long, end long, edits int, item_chars int"
MATCH_SCHEMA = f"doc_id long, {MATCH_FIELDS}"


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = ERROR_RATE) -> DataFrame:
    """One row per passage: doc_id, item_id, start and end in code points of the original text, edits, item_chars."""
    picked = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return _search_all(picked, item_groups(benchmark, item_id, item_text), rate)


def _search_all(picked: DataFrame, item_lists: Iterator[list[tuple[int, str]]], rate: float) -> DataFrame:
    out = None
    for group in item_lists:
        found = _search(picked, group, rate)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else picked.sparkSession.createDataFrame([], f"doc_id {picked.schema['_id'].dataType.simpleString()}, {MATCH_FIELDS}")


def _search(picked: DataFrame, group: list[tuple[int, str]], rate: float) -> DataFrame:
    id_type = picked.schema["_id"].dataType
    arrow_id = pa.binary() if id_type.simpleString() == "binary" else pa.int64()
    shared = picked.sparkSession.sparkContext.broadcast(group)  # at most MAX_ITEM_CHARS characters or one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [x for x in (make_item(i, t, rate) for i, t in shared.value) if x]
        short = ShortItems([(i, c) for i, c in ((i, normal_item(t)) for i, t in shared.value) if 0 < len(c) < MIN_CHARS])
        index = Index(items + [p for item in items for p in passages(item, rate)])
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            rows: list[tuple[int, int, int, int, int, int]] = []
            for a, _, texts in chunks(batch, "_text"):
                normal = Normal(texts)
                short_ones = best_only(list(short.matches(normal)))
                for doc, item, start, end, edits, chars in sorted(merged(list(index.matches(normal))) + short_ones):
                    base = normal.raw_offsets[doc]
                    rows.append((ids[a + doc], item, int(normal.at[start] - base), int(normal.at[end - 1] - base) + 1, edits, chars))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (arrow_id, *(pa.int64(),) * 3, pa.int32(), pa.int32()), strict=True)], ["doc_id", "item_id", "start", "end", "edits", "item_chars"])

    return picked.mapInArrow(run, f"doc_id {id_type.simpleString()}, {MATCH_FIELDS}")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that hold no benchmark passage, all columns kept. Each row goes or stays by its own text, whatever
    its id; rows with a null text stay."""
    keyed, names = numbered(docs, id_col, text_col)
    picked = keyed.filter("_key is not null").select(F.col("_key").alias("_id"), F.col(f"_c{docs.columns.index(text_col)}").cast("string").alias("_text"))
    leaks = _search_all(picked, item_groups(benchmark, "item_id", "text"), ERROR_RATE)
    return without(keyed, leaks.select("doc_id"), "_key").select(*names)
