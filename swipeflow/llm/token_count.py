"""Token counts with a whole-token shortcut.

Offline, every string of the vocabulary is encoded once; the pre-tokens that
come back as exactly one token are proved to count one wherever they occur
(merging never crosses a pre-token). Their hashes form a fixed-size table,
broadcast to the tasks. A task normalises a slice of whole texts, cuts it into
pre-tokens (``pretok``), counts proved ones directly and merges only the rest,
once per distinct pre-token.

A text that contains a special string of the tokenizer is encoded whole by the
library, as the library cuts such strings out before anything else.

Edge cases: null or empty text counts 0 tokens and 0 bytes; repeated rows and
repeated ids give one output row each; an empty table gives an empty result;
texts are never cut, and memory per task is bounded by a slice or by the
longest text. Only the named columns are read.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from swipeflow.llm.pretok import PreTokens, probe_classes
from swipeflow.llm.text import chunks, string_hash

LIMIT_TOKENS = 2048
#: Distinct pre-tokens whose count a task remembers; beyond it the memory starts anew.
CACHE = 300_000


@functools.cache
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each task one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def prove_single(path: str) -> np.ndarray:
    """Sorted hashes of all pre-tokens that the tokenizer encodes as one token."""
    tokenizer = load(path)
    suffix = "</w>"
    words = set()
    decode = {c: b for b, c in _byte_alphabet().items()}
    for token in tokenizer.get_vocab():
        if token.endswith(suffix) and all(c in decode for c in token[: -len(suffix)]):
            raw = bytes(decode[c] for c in token[: -len(suffix)])
            try:
                words.add(raw.decode("utf-8"))
            except UnicodeDecodeError:
                continue
    words = sorted(w for w in words if w and normalise(w) == w)
    proved = []
    for word, enc in zip(words, tokenizer.encode_batch(words, add_special_tokens=False), strict=True):
        if len(enc.ids) == 1:
            proved.append(string_hash(word))
    return np.unique(np.array(proved, np.uint64))


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies show each byte as."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


def normalise(text: str) -> str:
    """NFC, then lower case character by character (no final-sigma rule)."""
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


class Counter:
    """Counts the tokens of slices of texts; one per task."""

    def __init__(self, path: str, table: np.ndarray, single: np.ndarray) -> None:
        self.tokenizer = load(path)
        self.table, self.single = table, single
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[int, int] = {}

    def merged(self, pre: PreTokens, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Token counts of distinct pre-tokens that are not proved single."""
        keys = hashes.tolist()
        if len(self.known) > CACHE:
            self.known = {}
        missing = [i for i, k in enumerate(keys) if k not in self.known]
        if missing:
            words = [pre.string(places[i]) for i in missing]
            for i, enc in zip(missing, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
                self.known[keys[i]] = len(enc.ids)
        return np.array([self.known[k] for k in keys], np.int64)

    def counts(self, texts: list[str]) -> np.ndarray:
        pre = PreTokens([normalise(t) for t in texts], self.table, joins_space=False)
        hashes, places, index = pre.distinct()
        at = np.searchsorted(self.single, hashes)
        at[at == len(self.single)] = 0
        one = self.single[at] == hashes if len(self.single) else np.zeros(len(hashes), bool)
        each = np.ones(len(hashes), np.int64)
        rest = np.flatnonzero(~one)
        if len(rest):
            each[rest] = self.merged(pre, hashes[rest], places[rest])
        sums = np.concatenate([[0], np.cumsum(each[index])])
        out = sums[pre.bounds[1:]] - sums[pre.bounds[:-1]]
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                out[i] = len(self.tokenizer.encode(t, add_special_tokens=False).ids)
        return out


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((probe_classes(load(path).pre_tokenizer), prove_single(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, *shared.value)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for _, _, texts in chunks(batch, "text"):
                n_bytes += [len(t.encode("utf-8", "surrogatepass")) for t in texts]
                n_tokens += counter.counts(texts).tolist()
            over = [n > limit for n in n_tokens]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(over, pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    picked = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    return picked.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
