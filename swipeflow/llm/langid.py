"""Language identification by rank-order profiles.

A language profile is the list of its most frequent character n-grams (one to
three letters of lower-cased words, a word's edges shown as a space), ordered by
frequency in a bounded sample of labelled documents. A document is described
the same way by its own most frequent n-grams. Its out-of-place distance to a
profile sums, over these n-grams, how far each is from its place in the
profile, or the largest distance where the profile lacks it. The nearest
profile wins. N-grams of equal count share their mean rank, so short texts
are compared without arbitrary orders.

Every text with a letter gets the nearest learned language. A text that is too far even from
that profile is marked as in no learned language (``is_known`` false), which only a filter uses.
How far is too far is learned too, by language and by the number of distinct
n-grams (short texts lie less steadily): each half of the training documents is
measured against the profile of the other half, whole and in windows of 1, 2,
4, ... words, and the limit is the mean of these distances plus ``SPREADS``
standard deviations plus ``MARGIN``, at most ``FARTHEST``, and no narrower than
that of any larger class. Classes of fewer than
``LEAST`` measured texts take the limit of the next shorter class, then of the
next longer; a language without any takes that of all languages together.

Bounds: ``PER_LANGUAGE`` training documents a language, chosen by a hash of
doc_id over all labelled documents; ``PROFILE`` n-grams a profile. N-grams are
32-bit hashes; a collision moves one n-gram's rank.

Edge cases: a null text or one without a letter gets ``und``
and score 0, as does every text if no labelled document exists; a few words
in an unknown language can count as known, as the limit of short texts is wide; equal distances take the
alphabetically first language; very long texts are read whole; repeated rows
give one row each; empty tables give empty results. Only the named columns are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swipeflow.llm.text import CodePoints, category_table, chunks, lower_table, mix64

PER_LANGUAGE = 1536
SALTS = 64
PROFILE = 400
UNDETERMINED = "und"
SHARPNESS = 25.0
#: Reject limit: standard deviations and distance added to the mean distance of unseen texts of the language.
SPREADS = 4.0
MARGIN = 0.15
#: No limit is above this, as hardly an n-gram is shared there.
FARTHEST = 0.97
#: Texts measured in a size class before its spread counts; size classes (two for each doubling of n-grams).
LEAST = 20
SIZES = 64

_U = np.uint64


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. Null ids are in no fold."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


class Grams:
    """n-grams of several texts with their counts: ``doc``, ``gram``, ``count``, sorted by (doc, gram)."""

    def __init__(self, texts: list[str]) -> None:
        code = CodePoints([f" {t} " for t in texts])
        kind = category_table()[code.cps]
        inside = (kind == 1) | (kind == 4)
        letters = np.concatenate([[0], np.cumsum(kind == 1)])
        self.has_letter = letters[code.offsets[1:]] > letters[code.offsets[:-1]]
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        keep[code.offsets[:-1]] = True
        at = np.flatnonzero(keep)
        stream = np.where(inside[at], lower_table()[code.cps[at]], 0x20).astype(_U)
        doc = (np.searchsorted(code.offsets, at, side="right") - 1).astype(_U)
        space = stream == 0x20
        n = len(stream)
        keys = []
        with np.errstate(over="ignore"):
            for size in (1, 2, 3):
                m = n - size + 1
                if m <= 0:
                    break
                ok = doc[:m] == doc[size - 1 :]
                if size == 1:
                    ok &= ~space
                elif size == 2:
                    ok &= ~(space[:m] & space[1:])
                else:
                    ok &= ~space[1 : m + 1]
                i = np.flatnonzero(ok)
                h = np.full(len(i), size, _U)
                for k in range(size):
                    h = h * _U(0x9E3779B97F4A7C15) + stream[i + k] + _U(1)
                keys.append((doc[i] << _U(32)) | (mix64(h) >> _U(32)))
        key = np.sort(np.concatenate(keys)) if keys else np.empty(0, _U)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        self.doc = (key[first] >> _U(32)).astype(np.int64)
        self.gram = (key[first] & _U(0xFFFFFFFF)).astype(np.int64)
        self.count = np.diff(np.append(first, len(key)))
        self.n_docs = len(texts)


def ranked(grams: Grams, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, gram, rank) of each document's ``top`` most frequent n-grams; ties share the mean rank."""
    if not len(grams.doc):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    cap = (1 << 20) - 1
    order_key = (grams.doc.astype(_U) << _U(44)) | ((cap - np.minimum(grams.count, cap)).astype(_U) << _U(24)) | (grams.gram.astype(_U) >> _U(8))
    order = np.argsort(order_key)
    doc, gram, level = grams.doc[order], grams.gram[order], order_key[order] >> _U(24)
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    first = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))
    length = np.diff(np.append(first, len(level)))
    rank = np.repeat(place[first] + (length - 1) / 2, length)
    kept = place < top
    return doc[kept], gram[kept], np.minimum(rank[kept], top)


def size_class(n: np.ndarray) -> np.ndarray:
    """Class of texts of ``n`` distinct n-grams."""
    return (2 * np.log2(np.maximum(n, 1))).astype(np.int64)


def learn_limits(languages: list[str], spread: list[tuple[str, int, int, float, float]]) -> np.ndarray:
    """Reject distance by size class and language, from (language, size class, texts, sum of distances, sum of squares)."""
    sums = np.zeros((3, SIZES, len(languages)))
    for lang, c, *row in spread:
        sums[:, c, languages.index(lang)] = row
    together = sums.sum(axis=2)
    out = np.full((SIZES, len(languages)), FARTHEST)
    for k in range(len(languages)):
        own = sums[:, :, k] if (sums[0, :, k] >= LEAST).any() else together
        known = np.flatnonzero(own[0] >= LEAST)
        if len(known):
            n, total, squares = own[:, known]
            mean = total / n
            limit = mean + SPREADS * np.sqrt(np.maximum(squares / n - mean**2, 0)) + MARGIN
            limit = np.maximum.accumulate(limit[::-1])[::-1]
            at = np.maximum(np.searchsorted(known, np.arange(SIZES), side="right") - 1, 0)
            out[:, k] = np.minimum(limit[at], FARTHEST)
    return out


class Profiles:
    """Ranks of all profile n-grams in every language; ``missing`` where a profile lacks one."""

    def __init__(self, by_language: dict[str, list[int]], size: int = PROFILE, spread: list[tuple[str, int, int, float, float]] = ()) -> None:
        self.languages = sorted(by_language)
        self.limits = learn_limits(self.languages, spread)
        self.size = size
        self.grams = np.unique(np.array([g for gs in by_language.values() for g in gs], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), np.inf)
        for k, lang in enumerate(self.languages):
            own = np.array(by_language[lang], np.int64)
            self.ranks[np.searchsorted(self.grams, own), k] = np.arange(len(own))

    def distances(self, grams: Grams) -> np.ndarray:
        """Mean out-of-place distance over a document's n-grams, 0 to 1, by document and language."""
        doc, gram, rank = ranked(grams, self.size)
        at = np.searchsorted(self.grams, gram)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == gram, at, len(self.grams)) if len(self.grams) else np.zeros(len(gram), np.int64)
        seen = np.maximum(np.bincount(doc, minlength=grams.n_docs), 1)
        out = np.ones((grams.n_docs, len(self.languages)))
        for k in range(len(self.languages)):
            apart = np.minimum(np.abs(self.ranks[at, k] - rank), self.size)
            out[:, k] = np.bincount(doc, apart, minlength=grams.n_docs) / (seen * self.size)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(nearest language, score, distance to its profile, whether that is within the limit) of each text."""
        grams = Grams(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts)), np.zeros(len(texts), bool)
        apart = self.distances(grams)
        best = np.argmin(apart, axis=1)
        nearest = apart[np.arange(len(texts)), best]
        share = np.exp(-SHARPNESS * (apart - nearest[:, None]))
        limit = self.limits[size_class(np.bincount(grams.doc, minlength=len(texts))), best]
        score = np.where(grams.has_letter, 1 / share.sum(axis=1), 0.0)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), grams.has_letter.tolist(), strict=True)]
        return names, score, np.where(grams.has_letter, nearest, 1.0), grams.has_letter & (nearest < limit)


def training_rows(docs: DataFrame, id_col: str, lang_col: str, per_language: int) -> DataFrame:
    """At most ``per_language`` training ids of each language: the smallest hashes within each of ``SALTS`` slots,
    so that no language is ranked in one task."""
    h = F.xxhash64(F.col(id_col).cast("string"))
    ids = docs.filter(F.col(lang_col).isNotNull() & (fold(id_col) != 0)).select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), h.alias("_h"), F.pmod(h, F.lit(SALTS)).alias("_slot"))
    w = Window.partitionBy("_lang", "_slot").orderBy("_h", "_id")
    return ids.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= max(1, per_language // SALTS)).select("_id").distinct()


def windows(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(positions, texts): all texts whole, then the middle 1, 2, 4, ... words of those that have more."""
    yield list(range(len(texts))), texts
    words = [t.split() for t in texts]
    m = 1
    while longer := [i for i, w in enumerate(words) if len(w) > m]:
        yield longer, [" ".join(words[i][(len(words[i]) - m) // 2 :][:m]) for i in longer]
        m *= 2


def measure(rows: DataFrame, halves: list[dict[str, list[int]]], size: int) -> list[tuple[str, int, int, float, float]]:
    """What ``learn_limits`` needs: distances of ``rows`` (lang, text, half) to their language's profile of the other half."""
    # broadcast bound: 2 x size n-grams for each language
    shared = rows.sparkSession.sparkContext.broadcast([Profiles(h, size) for h in halves])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, half = batch.column("lang").to_pylist(), batch.column("half").to_pylist()
            for a, b, texts in chunks(batch, "text"):
                for other, known in enumerate(shared.value):
                    mine = [i for i in range(b - a) if half[a + i] != other and names[a + i] in known.languages]
                    for at, cut in windows([texts[i] for i in mine]):
                        grams = Grams(cut)
                        own = np.array([known.languages.index(names[a + mine[i]]) for i in at], np.int64)
                        d = known.distances(grams)[np.arange(len(cut)), own] if len(cut) else np.empty(0)
                        ok = np.flatnonzero(grams.has_letter)
                        n = size_class(np.bincount(grams.doc, minlength=len(cut)))
                        yield pa.RecordBatch.from_arrays([pa.array([known.languages[own[i]] for i in ok.tolist()], pa.string()), pa.array(n[ok].astype(np.int32)), pa.array(d[ok])], ["lang", "size", "d"])

    found = rows.mapInArrow(run, "lang string, size int, d double").groupBy("lang", "size")
    # at most SIZES rows for each language
    return [tuple(r) for r in found.agg(F.count("*"), F.sum("d"), F.sum(F.col("d") * F.col("d"))).collect()]


def learn_profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, size: int = PROFILE) -> Profiles:
    """Language profiles and reject limits from labelled documents outside fold 0."""
    # broadcast bound: per_language ids (8 bytes) for each language
    chosen = F.broadcast(training_rows(docs, id_col, lang_col, per_language))
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    # halves by text, so that copies of a document do not measure themselves
    rows = rows.join(chosen, "_id", "left_semi").select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, half = batch.column("lang").to_pylist(), np.asarray(batch.column("half"))
            for a, b, texts in chunks(batch, "text"):
                here = sorted(set(names[a:b]))
                grams = Grams(texts)
                lang = 2 * np.array([here.index(x) for x in names[a:b]])[grams.doc] + half[a:b][grams.doc]
                key, inverse = np.unique((lang.astype(_U) << _U(32)) | grams.gram.astype(_U), return_inverse=True)
                n = np.bincount(inverse, grams.count, minlength=len(key)).astype(np.int64)
                which = (key >> _U(32)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([here[k // 2] for k in which.tolist()], pa.string()), pa.array((which % 2).astype(np.int32)), pa.array((key & _U(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], ["lang", "half", "gram", "n"])

    counted = rows.mapInArrow(run, "lang string, half int, gram long, n long").groupBy("lang", "gram")
    counts = counted.agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col("half") == h, F.col("n"))).alias(f"n{h}") for h in (0, 1))).persist()
    try:
        tops: dict[str, dict[str, list[int]]] = {"n": {}, "n0": {}, "n1": {}}
        for n, by_language in tops.items():
            place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc(n), "gram"))
            top = counts.filter(F.col(n).isNotNull()).select("lang", "gram", place.alias("_n")).filter(F.col("_n") <= size)
            # at most size n-grams a language
            for r in sorted(top.collect(), key=lambda r: (r["lang"], r["_n"])):
                by_language.setdefault(r["lang"], []).append(r["gram"])
    finally:
        counts.unpersist()
    return Profiles(tops["n"], size, measure(rows, [tops["n0"], tops["n1"]], size))


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, distance, is_known of every row; ``keep`` names columns to carry along."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    text = text_col if text_col in keep else "_text"  # a carried text is sent once
    picked = docs.select(F.col(id_col).alias("_id"), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("_held"), *keep, *([] if text in keep else [F.col(text_col).cast("string").alias("_text")]))
    schema = picked.select(F.col("_id").alias("doc_id"), F.col("_held").alias("held_out"), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("distance"), F.lit(False).alias("is_known"), *keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            names, scores, apart, within = [], [np.empty(0)], [np.empty(0)], [np.empty(0, bool)]
            for _, _, texts in chunks(batch, text):
                lang, score, nearest, ok = known.predict(texts)
                names += lang
                scores.append(score)
                apart.append(nearest)
                within.append(ok)
            made = [pa.array(names, pa.string()), *(pa.array(np.concatenate(x)) for x in (scores, apart, within))]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_held"), *made, *(batch.column(k) for k in keep)], ["doc_id", "held_out", "lang_pred", "score", "distance", "is_known", *keep])

    return picked.mapInArrow(run, schema)
