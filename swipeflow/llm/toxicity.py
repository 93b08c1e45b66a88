"""Toxicity by weak supervision.

1. Candidate voters. A document's features are its distinct lower-cased words,
   word beginnings of 4 to 7 letters, and a few surface patterns. Over a bounded
   sample of labelled rows, Spark counts how often each feature occurs in toxic
   and in clean documents; the features most typical of toxic ones become
   lexicon voters, beside a small seed lexicon, the patterns, and a voter that
   says "clean" where no lexicon voter fires.
2. Label model. A generative model holds for each class how often every voter
   fires. Expectation maximisation estimates these accuracies, the class share
   and the correlation of voters within a class; correlated voters share their
   weight. The human label enters as the last voter, with an estimated accuracy and
   its whole weight, so only clearly mislabelled rows are outvoted.
3. Classifier. A logistic regression over all kept features is fitted to the
   posterior labels, row weights restoring the class shares of all labels, and
   scores every document.

Bounds (parameters): ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled rows taken by a
hash of doc_id over all labelled rows outside fold 0, ``FEATURES`` kept
features, ``VOTERS`` of which vote. Only the votes of the sample reach the driver.

Edge cases: null or empty text has no features and gets the score of the bias;
labels that are null are no labels; a document labelled twice counts as toxic if
any label says so; without labels of both classes every score is 0; equal
scores of features are ordered by hash; repeated rows give one row each;
empty tables give empty results; texts are read whole. Only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import settle, smallest_hashes
from swipeflow.llm.langid import fold
from swipeflow.llm.text import Words, category_table, chunks, find_sorted, member_filter, range_hashes, string_hash

SAMPLE_TOXIC, SAMPLE_CLEAN = 8_000, 16_000
FEATURES, VOTERS = 3_000, 300
PREFIXES = (4, 5, 6, 7)
#: General insults; the corpus decides by its labels how much each one counts.
SEED_LEXICON = ("idiot", "stupid", "moron", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "dumb", "hate", "kill", "ugly", "vermin", "filth", "garbage")
PATTERNS = ("shouting", "exclaiming", "symbols", "repeating")

_U = np.uint64


def features(texts: list[str], only: np.ndarray | None = None, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs; feature hashes, or indexes into sorted ``only``."""
    words = Words(texts, digits=False)
    docs, keys = [], []
    for size in (0, *PREFIXES):
        if size:
            at = np.flatnonzero(words.ends - words.starts > size)
            h = range_hashes(words.cps, words.starts[at], words.starts[at] + size, salt=size)
        else:
            at, h = np.arange(len(words.starts)), words.hashes()
        if only is not None:
            hit, which = find_sorted(h, only, table)
            docs.append(words.doc[at[hit]])
            keys.append(which.astype(_U))
        else:
            docs.append(words.doc[at])
            keys.append(h)
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return doc[first], key[first]


def patterns(texts: list[str]) -> np.ndarray:
    """Whether each surface pattern holds, by text and pattern."""
    out = np.zeros((len(texts), len(PATTERNS)), bool)
    kinds = category_table()
    for i, t in enumerate(texts):
        head = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = max(1, len(head))
        letters = int((kinds[head] == 1).sum())
        words = t.split()
        out[i] = (
            letters > 10 and sum(map(str.isupper, words)) > 0.5 * len(words),
            t.count("!") > 0.02 * n and t.count("!") > 2,
            int((kinds[head] == 3).sum()) > 0.12 * n,
            len(words) > 20 and len(set(words)) < 0.3 * len(words),
        )
    return out


@dataclass
class LabelModel:
    """Class share, how often each voter fires in clean and toxic documents, and the voters' weights."""

    share: float
    fires: np.ndarray  # 2 x voters
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = self.weight * (np.log(self.fires[1]) - np.log(self.fires[0]))
        no = self.weight * (np.log1p(-self.fires[1]) - np.log1p(-self.fires[0]))
        z = np.log(self.share / (1 - self.share)) + votes @ yes + (1 - votes) @ no
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_label_model(votes: np.ndarray, start: np.ndarray, row_weight: np.ndarray, rounds: int = 8) -> LabelModel:
    """EM over 0/1 votes (rows x voters) from a first guess ``start`` of the posterior.

    The last voter is the human label; it keeps its whole weight."""
    q = start.astype(float)
    votes = votes.astype(float)
    model = None
    for _ in range(rounds):
        fires, correlation = np.empty((2, votes.shape[1])), 0.0
        for label, p in ((0, (1 - q) * row_weight), (1, q * row_weight)):
            total = p.sum() + 1e-9
            fires[label] = (p @ votes + 0.5) / (total + 10.0)
            centred = (votes - (p @ votes) / total) * np.sqrt(p / total)[:, None]
            spread = np.sqrt((centred**2).sum(axis=0)) + 1e-9
            both = (centred.T @ centred) / np.outer(spread, spread)
            correlation = correlation + np.clip(both, 0, 1) / 2
        np.fill_diagonal(correlation, 1.0)
        weight = 1 / correlation.sum(axis=1).clip(min=1)
        weight[-1] = 1.0
        share = float(np.clip((q * row_weight).sum() / row_weight.sum(), 1e-4, 1 - 1e-4))
        model = LabelModel(share, fires.clip(1e-5, 1 - 1e-5), weight)
        q = model.posterior(votes)
    return model


def fit_logistic(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, target: np.ndarray, row_weight: np.ndarray, l2: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on sparse 0/1 features (Adam, full batch)."""
    w, b = np.zeros(n_cols), float(np.log((target @ row_weight + 1) / ((1 - target) @ row_weight + 1)))
    m, v, mb, vb = np.zeros(n_cols), np.zeros(n_cols), 0.0, 0.0
    total = row_weight.sum()
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[cols], minlength=n_rows) + b
        r = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) * row_weight / total
        g, gb = np.bincount(cols, r[rows], minlength=n_cols) + l2 * w, r.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate, c1, c2 = 0.1, 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    return w, b


@dataclass
class Model:
    """Sorted feature hashes with their weights, pattern weights and bias; ``trained`` is false without labels."""

    keys: np.ndarray
    weight: np.ndarray
    pattern_weight: np.ndarray
    bias: float
    trained: bool = True

    def score(self, texts: list[str]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        doc, which = features(texts, self.keys, member_filter(self.keys))
        z = np.bincount(doc, self.weight[which.astype(np.int64)], minlength=len(texts)) if len(doc) else np.zeros(len(texts))
        z = z + patterns(texts) @ self.pattern_weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def sample_labels(labels: DataFrame, id_col: str, label_col: str, toxic: int, clean: int) -> tuple[DataFrame, float, float]:
    """Bounded sample (_id, _y) of the training labels, and the number of labels per sampled row in each class."""
    y = labels.filter(F.col(label_col).isNotNull() & (fold(id_col) != 0)).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_y"))
    counts = {r["_y"]: r["n"] for r in y.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    parts = [smallest_hashes(y.filter(F.col("_y") == k), F.xxhash64(F.col("_id").cast("string")), "_id", n, counts.get(k, 0)) for k, n in ((1, toxic), (0, clean))]
    share = [counts.get(k, 0) / max(1, min(n, counts.get(k, 0))) for k, n in ((1, toxic), (0, clean))]
    return parts[0].unionByName(parts[1]), share[0], share[1]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """Fit the whole chain on the training labels."""
    spark = docs.sparkSession
    sample, per_toxic, per_clean = sample_labels(labels, id_col, label_col, toxic, clean)
    given = {int(r["_id"]): int(r["_y"]) for r in sample.collect()}  # bounded: toxic + clean rows
    nothing = Model(np.empty(0, _U), np.empty(0), np.zeros(len(PATTERNS)), 0.0, trained=False)
    if len(set(given.values())) < 2:
        return nothing
    chosen = F.broadcast(spark.createDataFrame(pa.table({"_id": pa.array(list(given), pa.int64()), "_y": pa.array(list(given.values()), pa.int32())})))
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    # one text of each sampled id, however often the id occurs; copies meet as one row a task
    rows = settle(texts.join(chosen, "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.asarray(batch.column("_y"))
            for a, b, texts in chunks(batch, "_text"):
                doc, key = features(texts)
                uniq, inverse = np.unique(key, return_inverse=True)
                bad = np.bincount(inverse, y[a:b][doc], minlength=len(uniq)).astype(np.int64)
                n = np.bincount(inverse, minlength=len(uniq)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), pa.array(bad), pa.array(n - bad)], ["key", "bad", "good"])

    n_bad = sum(given.values())
    n_good = len(given) - n_bad
    p1, p0 = (F.col("bad") + 0.1) / F.lit(n_bad + 1.0), (F.col("good") + 0.1) / F.lit(n_good + 1.0)
    both = (F.col("bad") + F.col("good") + 1.0) / F.lit(len(given) + 1.0)
    z = (p1 - p0) / F.sqrt(both / F.lit(float(n_bad)))
    typical = rows.mapInArrow(count, "key long, bad long, good long").groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    typical = typical.filter((F.col("bad") >= 3) & (p1 > 4 * p0)).orderBy(F.desc(z), "key").limit(FEATURES)
    top = [r["key"] for r in typical.select("key").collect()]  # bounded: FEATURES
    seeds = np.array([string_hash(w) for w in SEED_LEXICON], _U)
    ordered = np.concatenate([np.array(top, np.int64).view(_U), seeds])
    keys = np.unique(ordered)
    shared = spark.sparkContext.broadcast((keys, member_filter(keys)))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only, table = shared.value
        for batch in batches:
            for a, b, texts in chunks(batch, "_text"):
                doc, which = features(texts, only, table)
                at = np.searchsorted(doc, np.arange(b - a + 1))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(which.astype(np.int32)))
                marks = pa.array(patterns(texts) @ (1 << np.arange(len(PATTERNS))), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("_y").slice(a, b - a), lists, marks], ["y", "which", "marks"])

    got = rows.mapInArrow(vote, "y int, which array<int>, marks int").toArrow()  # bounded: one row a sampled id
    assert got.num_rows <= len(given)
    y = np.asarray(got["y"].combine_chunks()) if got.num_rows else np.empty(0, np.int32)
    if not len(y) or y.min() == y.max():
        return nothing
    lists = got["which"].to_pylist()
    marks = (np.asarray(got["marks"].combine_chunks())[:, None] >> np.arange(len(PATTERNS))) & 1
    r = np.repeat(np.arange(len(y)), [len(x) for x in lists])
    c = np.array([i for x in lists for i in x], np.int64)
    row_weight = np.where(y == 1, per_toxic, per_clean).astype(float)
    lexicon = np.full(len(keys), -1)
    rate = [np.bincount(c[y[r] == k], minlength=len(keys)) / max(1, (y == k).sum()) for k in (0, 1)]
    seeded = np.searchsorted(keys, seeds)
    seeded = seeded[rate[1][seeded] > 2 * rate[0][seeded]]  # a seed word that is as common in clean documents has no vote
    voters = np.unique(np.concatenate([np.searchsorted(keys, ordered[: min(VOTERS, len(top))]), seeded]))
    lexicon[voters] = np.arange(len(voters))
    votes = np.zeros((len(y), len(voters) + len(PATTERNS) + 2), np.float32)
    fired = lexicon[c] >= 0
    votes[r[fired], lexicon[c[fired]]] = 1
    votes[:, len(voters) : -2] = marks
    votes[:, -2] = ~votes[:, : len(voters)].any(axis=1)
    votes[:, -1] = y
    label_model = fit_label_model(votes, 0.02 + 0.96 * y, row_weight)
    target = label_model.posterior(votes)
    cols = np.concatenate([c, np.nonzero(marks)[1] + len(keys)])
    at = np.concatenate([r, np.nonzero(marks)[0]])
    w, bias = fit_logistic(at, cols, len(y), len(keys) + len(PATTERNS), target, row_weight)
    return Model(keys, w[: len(keys)], w[len(keys) :], float(bias))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; ``keep`` names columns to carry along."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = text_col if text_col in keep else "_text"  # a carried text is sent once
    picked = docs.select(F.col(id_col).alias("_id"), F.coalesce(fold(id_col) == 0, F.lit(False)).alias("_held"), *keep, *([] if text in keep else [F.col(text_col).cast("string").alias("_text")]))
    schema = picked.select(F.col("_id").alias("doc_id"), F.col("_held").alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), *keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            s = np.concatenate([np.empty(0), *(known.score(texts) for _, _, texts in chunks(batch, text))])
            made = [pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_held"), *made, *(batch.column(k) for k in keep)], ["doc_id", "held_out", "score", "predicted", *keep])

    return picked.mapInArrow(run, schema)
