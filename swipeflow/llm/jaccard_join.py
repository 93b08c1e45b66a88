"""n-gram Jaccard self-join of documents by chosen paths.

A document is the set of its shingles: five consecutive words (lower-cased runs
of letters and digits), or all its words if it has fewer. Two documents link if the
Jaccard similarity of their sets is at least ``THRESHOLD``.

1. Documents with the same word sequence are one class, compared once.
2. Each class gets a min-hash signature; its positions are the tokens that paths
   choose from. A run starts with all classes in one bucket. A bucket chooses
   ``BRANCH`` positions by a hash of its path and splits its members by their token
   there, so a pair of similarity s stays together in each child with
   probability s; with two children of a threshold pair at least one keeps it
   together at every depth with a probability that solves
   p = 1 - (1 - s p)^2. Runs are repeated until the target recall:
   1 - (1 - p)^runs >= ``RECALL``.
3. Buckets of at most ``SMALL`` members are compared by brute force on signatures.
   In a larger one, members that resemble its leader (a random member) are linked to
   the leader and leave it, as in dense groups no token would split them; the
   rest go on to the children. What is still large after ``DEPTH`` levels is
   compared in blocks.
4. Connected candidates form clusters. Inside a cluster all pairs are verified on
   the exact shingle sets, in blocks, each pair in one task. Tasks emit link
   counts and spanning links per class, never a row per pair.

A signature resembles another if they agree in at least ``LOOSE`` of the positions (39 of 64). All runs share the
signature, so a pair exactly at the threshold is lost for good with a probability of 1.3e-4, on top of
1 - ``RECALL``; more similar pairs far less. In a bucket of over ``SMALL`` members a pair is also parted for the rest of the run if only one of the
two resembles the leader; other runs have other leaders. ``runs_for`` counts the paths alone.

Edge cases: null texts and texts without a word link with nothing and are their
own class, each with its own id; copies count as links of each other; rows
that share a doc_id count as separate documents; ties cannot change the result;
texts are read whole; an empty table gives an empty result. Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.blocks import block_tasks, groups, local_roots, pairs_to_compare
from swipeflow.llm.common import numbered, row_key, settle, without
from swipeflow.llm.graph import components
from swipeflow.llm.text import Words, chunks, mix64, range_hashes

WIDTH = 5
THRESHOLD = Fraction(4, 5)
SIGNATURE = 64
LOOSE = 0.6
RECALL = 0.9999
BRANCH, SMALL, DEPTH = 2, 1024, 3
BLOCK = 512

_U = np.uint64


def runs_for(recall: float, similarity: float = float(THRESHOLD), branch: int = BRANCH) -> int:
    """Repetitions after which a pair at the threshold shares a final bucket with probability ``recall``."""
    p = 1.0
    for _ in range(200):
        p = 1 - (1 - similarity * p) ** branch
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


class Shingles:
    """Shingle hashes of several texts; text i has ``hashes[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, texts: list[str], width: int = WIDTH) -> None:
        self.source = words = Words(texts)
        self.words = words.hashes()
        count = np.diff(words.bounds)
        n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        self.bounds = np.concatenate([[0], np.cumsum(n)])
        doc = np.repeat(np.arange(len(texts)), n)
        starts = words.bounds[doc] + np.arange(self.bounds[-1]) - self.bounds[doc]
        self.hashes = range_hashes(self.words, starts, starts + np.minimum(width, count[doc]))

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """The halves of a 128-bit digest of each text's words, character by character."""
        w = self.source
        length = w.ends - w.starts
        at = np.concatenate([[0], np.cumsum(length)])
        stream = w.cps[np.repeat(w.starts - at[:-1], length) + np.arange(at[-1])].astype(np.uint32) << 1
        stream[at[:-1]] |= 1  # marks where a word begins
        bounds = (4 * at[w.bounds]).tolist()
        raw = memoryview(stream.tobytes())
        digests = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True))
        halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
        return halves[:, 0].copy(), halves[:, 1].copy()

    def signatures(self, size: int = SIGNATURE) -> np.ndarray:
        """Min-hash signature (texts x size) of the texts that have shingles; zeros for the others."""
        out = np.zeros((len(self.bounds) - 1, size), np.uint32)
        some = np.flatnonzero(np.diff(self.bounds))
        if len(some):
            starts = self.bounds[some]
            factors = mix64(np.arange(1, size + 1, dtype=_U)) | _U(1)
            with np.errstate(over="ignore"):
                for k in range(size):
                    out[some, k] = np.minimum.reduceat(((self.hashes * factors[k]) >> _U(32)).astype(np.uint32), starts)
        return out

    def sets(self) -> list[np.ndarray]:
        return [np.unique(self.hashes[a:b]) for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True)]


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (see ``row_key``), fp, fp2, sig, short (the low byte of each position of sig) of every row; all but
    doc_id and key are null for rows without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in chunks(batch, "_text"):
                s = Shingles(texts)
                none = np.diff(s.bounds) == 0
                fp, fp2 = s.fingerprints()
                sig = s.signatures()
                columns = []
                for width, raw in ((SIGNATURE * 4, sig.tobytes()), (SIGNATURE, sig.astype(np.uint8).tobytes())):
                    columns.append(pa.array([None if x else raw[i * width : (i + 1) * width] for i, x in enumerate(none.tolist())], pa.binary()))
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(a, b - a), batch.column("_key").slice(a, b - a), pa.array(fp, mask=none), pa.array(fp2, mask=none), *columns], ["doc_id", "key", "fp", "fp2", "sig", "short"])

    picked = docs.select(F.col(id_col).cast("long").alias("_id"), row_key(id_col, text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    return picked.mapInArrow(run, "doc_id long, key binary, fp long, fp2 long, sig binary, short binary")


def _rows(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """Fixed-width signatures of a binary column, one row each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), SIGNATURE)


def children(paths: np.ndarray, sig: np.ndarray, branch: int = BRANCH) -> tuple[np.ndarray, np.ndarray]:
    """(rows, child path) after each path has chosen ``branch`` positions of the signature."""
    n = len(paths)
    rows, out = [], []
    with np.errstate(over="ignore"):
        first = mix64(paths ^ _U(0xA0761D6478BD642F)) % _U(SIGNATURE)
        for k in range(branch):
            # positions of one path differ from each other: an odd stride around the signature
            stride = (mix64(paths ^ _U(0xE7037ED1A0B428DB)) | _U(1)) % _U(SIGNATURE)
            at = ((first + _U(k) * stride) % _U(SIGNATURE)).astype(np.int64)
            token = sig[np.arange(n), at].astype(_U)
            out.append(mix64(mix64(paths + _U(k + 1)) ^ (token << _U(8)) ^ at.astype(_U)))
            rows.append(np.arange(n))
    return np.concatenate(rows), np.concatenate(out)


def start_paths(classes: DataFrame, runs: int) -> DataFrame:
    """path, fp: the children of every run's first bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                fp, sig = batch.column("fp"), _rows(batch.column("sig"), np.uint32)
                for r in range(runs):
                    at, path = children(mix64(np.full(len(sig), r + 1, _U)), sig)
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), fp.take(pa.array(at))], ["path", "fp"])

    return classes.select("fp", "sig").mapInArrow(run, "path long, fp long")


def compare_small(lists: DataFrame) -> DataFrame:
    """Spanning candidate links (a, b) of buckets, by one byte of each signature position (chance agreement 1 in 256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["_task"]):
            fp, sig = np.asarray(t["fp"].combine_chunks()), _rows(t["short"], np.uint8)
            left, right = pairs_to_compare(np.asarray(t["_chunk"].combine_chunks()), t["_split"][0].as_py())
            linked = np.zeros((len(fp), len(fp)), bool)
            for i in left.tolist():
                linked[i, right] = np.count_nonzero(sig[right] == sig[i], axis=1) >= LOOSE * SIGNATURE
            linked |= linked.T
            np.fill_diagonal(linked, False)
            root = local_roots(linked)
            some = np.flatnonzero(root != np.arange(len(fp)))
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(fp[some]), pa.array(fp[root[some]])], ["a", "b"])

    return lists.repartition("_task").sortWithinPartitions("_task").mapInArrow(run, "a long, b long")


def split_large(members: DataFrame) -> DataFrame:
    """a, b, path, fp: links (a, b) to leaders, or the children's (path, fp) of members unlike their leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fp, leader = np.asarray(batch.column("fp")), np.asarray(batch.column("leader"))
            sig = _rows(batch.column("sig"), np.uint32)
            alike = np.count_nonzero(sig == _rows(batch.column("leader_sig"), np.uint32), axis=1) >= LOOSE * SIGNATURE
            near, far = np.flatnonzero(alike & (fp != leader)), np.flatnonzero(~alike)
            rows, path = children(np.asarray(batch.column("path")).view(_U)[far], sig[far])
            none = pa.nulls(len(near), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(fp[near]), pa.array(leader[near]), none, none], ["a", "b", "path", "fp"])
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(path.view(np.int64)), pa.array(fp[far][rows])], ["a", "b", "path", "fp"])

    return members.mapInArrow(run, "a long, b long, path long, fp long")


def candidate_links(classes: DataFrame, runs: int, small: int = SMALL, depth: int = DEPTH) -> DataFrame:
    """Links (a, b) that connect all classes which some bucket found alike."""
    sigs, shorts = classes.select("fp", "sig"), classes.select("fp", "short")
    front = settle(start_paths(classes, runs))
    found = []
    for level in range(depth):
        sizes = settle(front.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1"))
        lists = front.join(sizes, "path")
        little = lists.filter(F.col("size") <= small).select(F.col("path").alias("_task"), "fp", F.lit(0).alias("_chunk"), F.lit(False).alias("_split"))
        found.append(compare_small(little.join(shorts, "fp")))
        if sizes.filter(F.col("size") > small).isEmpty():
            break
        # a class is in a bucket once, so no distinct is needed, which would keep a hot bucket's join in one task
        large = settle(lists.filter(F.col("size") > small).select("path", "fp"))
        if level == depth - 1:
            found.append(compare_small(block_tasks(large, "path", "fp", BLOCK).join(shorts, "fp")))
            break
        leaders = large.groupBy("path").agg(F.min(F.struct(F.xxhash64("path", "fp").alias("h"), F.col("fp").alias("leader"))).alias("m")).select("path", F.col("m.leader").alias("leader"))
        leaders = settle(leaders.join(sigs.withColumnsRenamed({"fp": "leader", "sig": "leader_sig"}), "leader"))
        parted = settle(split_large(large.join(sigs, "fp").join(leaders, "path")))
        found.append(parted.filter("a is not null").select("a", "b"))
        front = parted.filter("path is not null").select("path", "fp")
    return reduce(DataFrame.union, found)


def task_sets(docs: DataFrame, dealt: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """fp, n, items (sorted distinct shingle hashes), _task, _chunk, _split: every class of ``dealt`` (fp, key, n,
    tasks) once for each of its tasks. Each text is read and hashed once; of copies of the representing row, one in
    each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for i, fp in enumerate(batch.column("fp").to_pylist()):
                if fp not in seen:
                    seen.add(fp)
                    new.append(i)
            if not new:
                continue
            batch = batch.take(pa.array(new))
            for a, b, texts in chunks(batch, "_text"):
                s = Shingles(texts)
                part = batch.slice(a, b - a)
                tasks = part.column("tasks")
                at = pa.array(np.repeat(np.arange(b - a), np.asarray(tasks.value_lengths())))
                items = pa.array([x.tobytes() for x in s.sets()], pa.binary()).take(at)
                each = tasks.flatten()
                yield pa.RecordBatch.from_arrays([part.column("fp").take(at), part.column("n").take(at), items, *(each.field(k) for k in range(3))], ["fp", "n", "items", "_task", "_chunk", "_split"])

    texts = docs.filter(F.col(text_col).isNotNull()).select(row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("_text"))
    return texts.join(dealt, "key").select("fp", "n", "tasks", "_text").mapInArrow(run, "fp long, n long, items binary, _task long, _chunk int, _split boolean")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sorted distinct arrays."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left], np.int64).reshape(len(left), len(right))
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float64)
    for s in range(0, len(common), 2048):
        part = common[s : s + 2048]
        a, b = (np.stack([np.isin(part, x[np.searchsorted(x, part[0]) : np.searchsorted(x, part[-1], side="right")], assume_unique=True) for x in side]).astype(np.float32) for side in (left, right))
        out += a @ b.T
    return np.rint(out).astype(np.int64)


def verify(tasks: DataFrame, threshold: Fraction = THRESHOLD) -> DataFrame:
    """fp, links (documents linked by this task), root (a class it is connected with)."""
    over, under = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["_task"]):
            fp = np.asarray(t["fp"].combine_chunks())
            first = np.unique(fp, return_index=True)[1]  # repeated rows of one id
            t, fp = t.take(pa.array(first)), fp[first]
            items = [np.frombuffer(x, _U) for x in t["items"].to_pylist()]
            weight, size = np.asarray(t["n"].combine_chunks()), np.array([len(x) for x in items])
            split = t["_split"][0].as_py()
            left, right = pairs_to_compare(np.asarray(t["_chunk"].combine_chunks()), split)
            if not len(right) or len(fp) < 2:
                continue
            both = intersections([items[i] for i in left], [items[i] for i in right])
            union = size[left][:, None] + size[right][None, :] - both
            close = both * under >= union * over
            linked = np.zeros((len(fp), len(fp)), bool)
            linked[np.ix_(left, right)] = close
            linked |= linked.T
            np.fill_diagonal(linked, False)
            some = np.flatnonzero(linked.any(axis=1))
            if len(some):
                root = local_roots(linked)
                yield pa.RecordBatch.from_arrays([pa.array(fp[some]), pa.array(linked[some] @ weight), pa.array(fp[root[some]])], ["fp", "links", "root"])

    return tasks.repartition("_task").sortWithinPartitions("_task").mapInArrow(run, "fp long, links long, root long")


def link_rows(docs: DataFrame, id_col: str, text_col: str, recall: float) -> tuple[DataFrame, DataFrame]:
    """(rows, alone): doc_id, key, first (the first row reachable over links: no_id, doc_id, key), n_links of every row
    with a word; doc_id of every other row. Rows with an id come first, then the smallest id, then the key."""
    base = settle(describe(docs, id_col, text_col))
    worded = base.filter("fp is not null")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    classes = settle(worded.groupBy("fp", "fp2").agg(F.min(order).alias("first"), F.count("*").alias("n"), F.min("sig").alias("sig"), F.min("short").alias("short")))
    cluster = components(candidate_links(classes, runs_for(recall)), smallest=False).withColumnsRenamed({"node": "fp", "component": "cluster"})
    members = settle(classes.select("fp", F.col("first.key").alias("key"), "n").join(cluster, "fp"))
    dealt = block_tasks(members, "cluster", "fp", BLOCK).groupBy("fp", "key", "n").agg(F.collect_list(F.struct("_task", "_chunk", "_split")).alias("tasks"))
    found = settle(verify(task_sets(docs, dealt, id_col, text_col)))
    links = found.groupBy("fp").agg(F.sum("links").alias("links"))
    reach = components(found, "fp", "root", smallest=False).withColumnRenamed("node", "fp")
    known = classes.select("fp", "fp2", "first", "n").join(links, "fp", "left").join(reach, "fp", "left")
    known = settle(known.select("fp", "fp2", "first", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "fp").alias("component")))
    named = settle(known.groupBy("component").agg(F.min("first").alias("first")))
    known = known.drop("first").join(named, "component").select("fp", "fp2", "first", (F.col("n") - 1 + F.col("links")).alias("n_links"))
    return worded.select("doc_id", "key", "fp", "fp2").join(known, ["fp", "fp2"]).drop("fp", "fp2"), base.filter("fp is null").select("doc_id")


def join_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest doc_id reachable over links), n_links (other documents linked directly) of every row."""
    rows, alone = link_rows(docs, id_col, text_col, recall)
    out = rows.select("doc_id", F.col("first.doc_id").alias("class_id"), "n_links")
    return out.unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_ids_stay: bool = True) -> DataFrame:
    """One row of each class stays, the one with the smallest id (of rows that share it, the one with the smallest
    key, of its copies any one). Rows with a null id stay too, or count as rows after all ids."""
    rows = link_rows(docs, id_col, text_col, RECALL)[0]
    if null_ids_stay:
        rows = rows.filter("doc_id is not null")
    rows = settle(rows.select("key", (F.col("key") == F.col("first.key")).alias("is_first")))
    repeated = settle(rows.filter("is_first").groupBy("key").count().filter("count > 1").select("key"))
    keyed, names = numbered(docs, id_col, text_col)
    out = without(keyed, rows.filter(~F.col("is_first")).select("key").unionByName(repeated), "_key").select(*names)
    if repeated.isEmpty():
        return out
    # copies of a row are reduced within each partition before the shuffle
    return out.unionByName(keyed.join(repeated.withColumnRenamed("key", "_key"), "_key", "left_semi").dropDuplicates(["_key"]).select(*names))
