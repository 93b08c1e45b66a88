"""Sequence packing along a space-filling curve.

Each document is tokenised once; its token counts are projected by fixed random
signs to a few dimensions and the direction of that vector is quantised to a
Hilbert key, so documents with similar vocabulary get close keys. Rows are
range-partitioned and sorted by (key, doc_id, ids), and every partition packs
its stretch of the curve: documents follow one another and are cut where a
sequence is full. Only the last tokens of a partition are left over; they go to
sequences whose lengths are powers of two, which need no padding.

Tokens are 2-byte ids where the vocabulary allows, compressed. The tokenised
table is written once to the shared checkpoint folder, so the range bounds are
sampled from it and lost tasks do not tokenise again.

A hot key (copies of one text) is split by doc_id, which is part of the range
key. Memory per task is bounded by an Arrow batch and one open sequence.

Edge cases: null or empty text is the closing id alone; documents of any length
are cut over several sequences; repeated rows are packed once per row (pieces
of rows that share a doc_id are told apart by sequence_id); ties in the key are
ordered by doc_id, then by the ids; an empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import settle
from swipeflow.llm.pretok import PreTokens, probe_classes
from swipeflow.llm.text import chunks, mix64
from swipeflow.llm.token_count import CACHE, _byte_alphabet, load

SEQUENCE = 1024
DIMS, BITS = 4, 8
CLOSING_ID = 0


@functools.cache
def merger(path: str):
    """Byte pairs merged as in the tokenizer file: bytes of one pre-token -> ids.

    The file's ids are checked to follow the order of its merges; then the rank
    of a byte string is its id, and the faster library gives the same ids.
    """
    decode = {c: b for b, c in _byte_alphabet().items()}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [vocab[a + b] for a, b in pairs]
    if ids == sorted(ids) and len(set(ids)) == len(ids) and not model.get("ignore_merges"):
        import tiktoken

        ranks = {bytes(decode[c] for c in token): i for token, i in vocab.items()}
        core = tiktoken.Encoding("pieces", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        return core.encode_single_piece
    tokenizer = load(path)
    return lambda raw: tokenizer.encode(raw.decode("utf-8"), add_special_tokens=False).ids


class Encoder:
    """Ids of slices of whole texts; one per task."""

    def __init__(self, path: str, table: np.ndarray) -> None:
        self.tokenizer, self.merge, self.table = load(path), merger(path), table
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.reset()

    def reset(self) -> None:
        self.slot: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts = np.zeros(1 << 16, np.int64)  # one more than there are slots

    def remember(self, keys: list[int], words: list[str]) -> None:
        merged = [self.merge(word.encode("utf-8", "surrogatepass")) for word in words]
        known = len(self.slot)
        ends = self.used + np.cumsum([len(ids) for ids in merged], dtype=np.int64)
        used = int(ends[-1]) if len(ends) else self.used
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(used, len(self.ids)), np.uint32)])
        if known + len(keys) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros(max(known + len(keys) + 1, len(self.starts)), np.int64)])
        self.ids[self.used : used] = np.fromiter(itertools.chain.from_iterable(merged), np.uint32, used - self.used)
        self.starts[known + 1 : known + 1 + len(keys)] = ends
        self.slot.update(zip(keys, range(known, known + len(keys)), strict=True))
        self.used = used

    def encode(self, texts: list[str], closing: int | None = CLOSING_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets); ``closing`` is appended to each."""
        if len(self.slot) > CACHE:
            self.reset()
        marked = {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        pre = PreTokens(["" if i in marked else t for i, t in enumerate(texts)], self.table, joins_space=True)
        hashes, places, index = pre.distinct()
        slots = np.fromiter(map(self.slot.get, hashes.tolist(), itertools.repeat(-1)), np.int64, len(hashes))
        new = np.flatnonzero(slots < 0)
        slots[new] = len(self.slot) + np.arange(len(new))
        self.remember(hashes[new].tolist(), pre.strings(places[new]))
        begin = self.starts[slots]
        begin, length = begin[index], (self.starts[slots + 1] - begin)[index]
        total = int(length.sum())
        at = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else begin, length) + np.arange(total)
        ids = self.ids[at]
        offsets = np.concatenate([[0], np.cumsum(length)])[pre.bounds]
        if marked:
            parts = [np.asarray(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32) if i in marked else ids[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
            ids = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        if closing is not None:
            ids = np.insert(ids, offsets[1:], closing)
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets


@functools.cache
def projection(vocab: int, dims: int = DIMS) -> np.ndarray:
    """A fixed random sign per id and dimension."""
    h = mix64(np.arange(vocab, dtype=np.uint64) + np.uint64(1))
    return (((h[:, None] >> np.arange(dims, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1).astype(np.float32)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of points with integer coordinates (rows x dims, ``bits`` each)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, offsets: np.ndarray, vocab: int) -> np.ndarray:
    """Hilbert key of each document's projected token counts (their direction)."""
    if len(offsets) < 2:
        return np.empty(0, np.int64)
    sums = np.add.reduceat(projection(vocab)[ids], offsets[:-1], axis=0, dtype=np.float64)
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return hilbert_keys(np.clip((unit + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64))


def tokenise(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _key, _n (tokens with the closing id) and _ids (compressed) of every row."""
    spark = docs.sparkSession
    vocab = load(path).get_vocab_size(with_added_tokens=True)
    shared = spark.sparkContext.broadcast(probe_classes(load(path).pre_tokenizer))
    kind = "<u2" if vocab <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, codec = Encoder(path, shared.value), pa.Codec("zstd", compression_level=1)
        for batch in batches:
            for a, b, texts in chunks(batch, "_text"):
                ids, offsets = encoder.encode(texts)
                small = ids.astype(kind)
                packed = [codec.compress(small[s:e].tobytes(), asbytes=True) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(a, b - a), pa.array(curve_keys(ids, offsets, vocab)), pa.array(np.diff(offsets)), pa.array(packed, pa.binary())], ["_id", "_key", "_n", "_ids"])

    picked = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return picked.mapInArrow(run, "_id long, _key long, _n long, _ids binary")


PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Packs one stretch of the curve; holds at most one open sequence between batches."""

    def __init__(self, partition: int, size: int = SEQUENCE) -> None:
        self.size, self.next_id = size, partition << 40
        self.open: list[tuple[int | None, int, int, np.ndarray]] = []  # id, start, document tokens, ids

    def add(self, rows: list[tuple[int | None, int, int, np.ndarray]], last: bool = False) -> pa.RecordBatch | None:
        """Pieces of all sequences that are now full; of all that is left if ``last``."""
        rows = self.open + rows
        lengths = np.array([len(r[3]) for r in rows], np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        full = total - total % self.size
        marks = np.arange(0, full + 1, self.size)
        if last:
            rest, tail = total - full, []
            while rest:
                step = 1 << (rest.bit_length() - 1)
                tail.append((tail[-1] if tail else full) + step)
                rest -= step
            marks = np.append(marks, np.array(tail, np.int64))
        stop = int(marks[-1])
        begins = ends - lengths
        cuts = np.unique(np.concatenate([marks, begins[begins < stop]]))
        made = []
        owners = np.searchsorted(ends, cuts[:-1], side="right").tolist()
        places = (np.searchsorted(marks, cuts[:-1], side="right") - 1).tolist()
        for s, e, k, seq in zip(cuts[:-1].tolist(), cuts[1:].tolist(), owners, places, strict=True):
            doc, start, tokens, ids = rows[k]
            at = s - int(begins[k])
            made.append((doc, start + at, e - s, zlib.crc32(ids[at : at + e - s].astype("<u4").tobytes()), tokens, self.next_id + seq, s - int(marks[seq])))
        self.next_id += len(marks) - 1
        self.open = []
        for k in range(int(np.searchsorted(ends, stop, side="right")), len(rows)):
            doc, start, tokens, ids = rows[k]
            at = max(0, stop - int(begins[k]))
            self.open.append((doc, start + at, tokens, ids[at:]))
        if not made:
            return None
        names = [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made, strict=True)], names)


def pack_tokens(tokens: DataFrame, vocab: int, size: int = SEQUENCE) -> DataFrame:
    """Pieces of the tokenised rows, packed in the order of the curve."""
    kind = "<u2" if vocab <= 1 << 16 else "<u4"
    width = int(kind[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), size)
        codec = pa.Codec("zstd")
        for batch in batches:
            docs, counts, packed = (batch.column(c).to_pylist() for c in ("_id", "_n", "_ids"))
            for a in range(0, len(docs), 512):
                rows = [(d, 0, n, np.frombuffer(codec.decompress(x, n * width, asbytes=True), kind)) for d, n, x in zip(docs[a : a + 512], counts[a : a + 512], packed[a : a + 512], strict=True)]
                made = packer.add(rows)
                if made is not None:
                    yield made
        made = packer.add([], last=True)
        if made is not None:
            yield made

    # rows that repeat an id are spread as well, by their place in the settled input
    placed = tokens.withColumn("_place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange("_key", "_id", "_place").sortWithinPartitions("_key", "_id", "_place")
    return ranged.select("_id", "_n", "_ids").mapInArrow(run, PIECE_SCHEMA)


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    vocab = load(path).get_vocab_size(with_added_tokens=True)
    return pack_tokens(settle(tokenise(docs, path, id_col, text_col)), vocab, size)
