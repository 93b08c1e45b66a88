"""Prefix trie of conversations by collapsing whole sequences.

Every turn gets a digest of its role and text, and every conversation a chain of digests, one a
prefix: ``sha256(prefix before, turn)``. Equal chains mean equal sequences of turns, so:

1. identical conversations collapse to one weighted sequence (smallest conversation, number
   of conversations); the conversations that end there are kept as rows, not as a list;
2. a sequence that is a proper prefix of another one goes by an anti-join with the
   distinct proper prefixes; the rest are the leaves;
3. the weighted prefixes of the sequences are aggregated by their digest into nodes.

Sums over a subtree need no pass over the ancestors of a node. A sequence s of weight w that passes
a node adds w times the bytes of its turns from the node on. The bytes of every node below are
subtracted once: a node belongs to the sequence of its smallest conversation, and what a
sequence owns is always the end of its path, so one number a sequence (where its own part
begins) tells its share for each of its prefixes. All steps are linear in the number of turns.

Skew: only digests and lengths are shuffled after the first sort. A conversation of any
length is spread by the global order; its chain then streams through one task in constant memory.
Copies collapse in map-side aggregates. The join of a node with its parent is split by
skew handling when many nodes have one parent. The ends of a node stream in order.

Edge cases: null role or text is empty; turns are ordered by turn, a null one first, ties by
the start of role and text, then by digest (``order.tie_keys``); repeated rows all count;
rows with a null conversation id belong to no conversation and are left out; conversations
whose rebuilt sequence is empty are members and ends of the root; an empty table has no
nodes. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import settle
from swipeflow.llm.order import EMPTY_SHA256, in_order, ordered_digest, tie_keys

#: Digest of the empty sequence.
ROOT = hashlib.sha256(b"").digest()
#: Ids that are joined to one piece before the digest of an end list.
ID_BUCKET = 4096


def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, _digest, bytes) of every row with a conversation id."""
    filled = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("_role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_body"),
    )
    keyed = filled.select("conv_id", "_turn", *tie_keys("_role", "_body"), F.octet_length("_body").cast("long").alias("bytes"))
    placed = settle(in_order(keyed, ["conv_id", "_turn", "_role_key", "_text_key", "_digest"], keep=["conv_id", "_digest", "bytes"]))
    starts = placed.groupBy("conv_id").agg(F.min("_at").alias("_first"))
    return placed.join(starts, "conv_id").select("conv_id", (F.col("_at") - F.col("_first") + 1).alias("pos"), "_digest", "bytes")


def rebuilt_with_shared_heads(rows: DataFrame, family: int = 5, head_lengths: int = 9) -> tuple[DataFrame, DataFrame]:
    """(ids, turns): conversations whose first h turns are those of conversation ``c - c % family``,
    h = crc32(c) % ``head_lengths``, followed by their own turns after the first h.

    Only the turns that can be a head, ``head_lengths - 1`` of a conversation, are copied.
    """
    own = settle(ordered_turns(rows))
    c = F.col("conv_id")
    head = F.crc32(c.cast("string").cast("binary")) % head_lengths
    ids = settle(rows.filter(c.isNotNull()).select(c.cast("long").alias("conv_id")).distinct().select(c, head.alias("_h"), (c - c % family).alias("_base")))
    heads = own.filter(F.col("pos") < head_lengths).withColumnRenamed("conv_id", "_base")
    first = ids.join(heads, "_base").filter(F.col("pos") <= F.col("_h"))
    rest = own.filter(F.col("pos") > head)
    turns = first.select("conv_id", F.lit(0).alias("_side"), "pos", "_digest", "bytes").unionByName(rest.withColumn("_side", F.lit(1)))
    return ids.select("conv_id"), turns


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """depth, key, parent and cum (bytes so far) of every turn; ``last`` marks the end of a conversation."""
    names = ["conv_id", "depth", "key", "parent", "bytes", "cum", "last"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]

    def made(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    held: list | None = None
    for batch in batches:
        out = []
        for c, digest, n in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "_digest", "bytes"))):
            same = held is not None and held[0] == c
            depth, parent, cum = (held[1], held[2], held[5]) if same else (0, ROOT, 0)
            if held is not None:
                held[6] = not same
                out.append(held)
            held = [c, depth + 1, hashlib.sha256(parent + digest).digest(), parent, n, cum + n, True]
        yield made(out)
    if held is not None:
        yield made([held])


def prefix_rows(turns: DataFrame) -> DataFrame:
    """The chain of every conversation in ``turns`` (conv_id, _side, pos, _digest, bytes)."""
    placed = turns.repartition("conv_id").sortWithinPartitions("conv_id", "_side", "pos").select("conv_id", "_digest", "bytes")
    return placed.mapInArrow(_chain, "conv_id long, depth long, key binary, parent binary, bytes long, cum long, last boolean")


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ascending ids of ``ends`` (key, conv_id), comma-joined."""
    bucket = F.floor(F.col("conv_id") / ID_BUCKET).cast("long")
    pieces = ends.groupBy("key", bucket.alias("_bucket")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("_piece"))
    return ordered_digest(pieces, "key", ["_bucket"], "_piece", ",").withColumnRenamed("sha256", "ends_sha256")


def trie_nodes(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations ``ids`` (conv_id, each once) with their ``turns``."""
    chain = settle(prefix_rows(turns))
    ends = ids.join(chain.filter("last").select("conv_id", "key", "depth", "cum"), "conv_id", "left")
    ends = settle(ends.select("conv_id", F.coalesce("key", F.lit(ROOT)).alias("key"), F.coalesce("depth", F.lit(0)).alias("len"), F.coalesce("cum", F.lit(0)).alias("total")))

    # whole sequences: one row for all conversations that are the same
    sequences = settle(ends.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("w"), F.min("len").alias("len"), F.min("total").alias("total")))
    kept = chain.join(sequences.select("conv_id", "w", "len", "total"), "conv_id")
    root = sequences.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("bytes"), F.lit(0).cast("long").alias("cum"), "w", "len", "total",
    )
    prefixes = settle(kept.drop("last").unionByName(root))

    # leaves: sequences that are no proper prefix
    proper = prefixes.filter("depth < len").select("key").distinct()
    leaves = sequences.join(proper, "key", "left_anti").select("conv_id", F.lit(1).alias("leaf"))

    # a prefix fixes depth, parent and bytes, so any of its rows tells them
    nodes = settle(
        prefixes.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"), F.sum("w").alias("n_convs"), F.min("depth").alias("depth"),
            F.min("parent").alias("parent"), F.min("bytes").alias("bytes"), F.min("cum").alias("cum"),
        )
    )
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("_from"), F.min(F.col("cum") - F.col("bytes")).alias("_before"))
    shares = sequences.select("conv_id").join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
    rest = F.col("total") - F.col("cum") + F.col("bytes")
    own = F.when(F.col("_from").isNull(), 0).when(F.col("depth") >= F.col("_from"), rest).otherwise(F.col("total") - F.col("_before"))
    subtree = (
        prefixes.join(shares, "conv_id")
        .groupBy("key")
        .agg(F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(F.col("w") * rest - own).alias("saved_tokens"))
    )
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    done = nodes.join(subtree, "key").join(children, "key", "left").join(end_digests(ends.select("key", "conv_id")), "key", "left").join(parents, "parent", "left")
    return done.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def conversation_trie(rows: DataFrame) -> DataFrame:
    """Trie of plain conversations: rows of conv_id, turn, role, text, as they are."""
    turns = settle(ordered_turns(rows))
    ids = settle(rows.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id")).distinct())
    return trie_nodes(ids, turns.withColumn("_side", F.lit(0)))
