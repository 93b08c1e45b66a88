"""Vectorised text helpers shared by the operators of this folder.

Executors receive Arrow batches of whole texts. ``chunks`` cuts a batch into
slices of bounded size (a text is never cut), and ``CodePoints`` lays the
slice out as one numpy array of code points with the offsets of its texts, so
that normalising, segmenting and hashing run over the whole slice at once
instead of row by row in Python. Memory per task is a small multiple of the
slice, or of the longest single text.

Null texts are treated as empty everywhere.
"""

from __future__ import annotations

import functools
import hashlib
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_CHARS = 400_000

_U = np.uint64
# Odd multipliers of the rolling hashes; any odd 64-bit numbers do.
_BASE = 0x9E3779B97F4A7C15
_SCALE = 0xD6E8FEB86659FD93
MASK64 = (1 << 64) - 1
#: Longest range that is hashed by the prefix sum alone.
LONG = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit keys (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = x.astype(_U, copy=True)
        x ^= x >> _U(32)
        x *= _U(_SCALE)
        x ^= x >> _U(29)
        x *= _U(_BASE)
        x ^= x >> _U(32)
    return x


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, _U)
        self.down = np.ones(1, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            inverse = pow(_BASE, -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[_U(1)], np.full(size, _BASE, _U)]), dtype=_U)
                self.down = np.cumprod(np.concatenate([[_U(1)], np.full(size, inverse, _U)]), dtype=_U)
        return self.up, self.down


_powers = Powers()


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of ``values[starts[i]:ends[i]]`` for every i.

    Equal ranges hash equally wherever they stand; the length is mixed in. Ranges of up to ``LONG`` values
    are hashed from one prefix sum. That sum is a polynomial modulo 2**64, in which long ranges built to a
    pattern can meet, so longer ranges get a cryptographic digest of their values.
    """
    n = len(values)
    up, down = _powers.get(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, _U)
        np.cumsum((values.astype(_U) + _U(1 + salt)) * up[:n], out=sums[1:], dtype=_U)
        h = (sums[ends] - sums[starts]) * down[starts]
        out = mix64(h + (ends - starts).astype(_U) * _U(_SCALE))
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        raw = values[starts[i] : ends[i]].astype(_U).tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little")
    return out


def string_hash(text: str) -> int:
    """``range_hashes`` of one whole string."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return int(range_hashes(cps, np.array([0]), np.array([len(cps)]))[0])


@functools.cache
def lower_table() -> np.ndarray:
    """Code point -> its lower-case code point (itself where that is not one code point)."""
    table = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for cp in range(sys.maxunicode + 1):
        if not 0xD800 <= cp <= 0xDFFF:
            low = chr(cp).lower()
            if len(low) == 1:
                table[cp] = ord(low)
    return table


@functools.cache
def category_table() -> np.ndarray:
    """Code point -> 0 white space, 1 letter, 2 number, 3 anything else, 4 combining mark."""
    table = np.full(sys.maxunicode + 1, 3, np.uint8)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)[0]
        if c.isspace():
            table[cp] = 0
        elif kind == "L":
            table[cp] = 1
        elif kind == "M":
            table[cp] = 4
        elif kind == "N":
            table[cp] = 2
    return table


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """(from, to, texts) slices of a batch with about ``limit`` bytes of text each."""
    texts = batch.column(column).to_pylist()
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i, [x or "" for x in texts[start:i]]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts), [x or "" for x in texts[start:]]


class CodePoints:
    """Code points of several texts in one array; text i is ``cps[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, texts: list[str]) -> None:
        self.text = "".join(texts)
        self.cps = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=self.offsets[1:])

    @property
    def firsts(self) -> np.ndarray:
        """Positions where a non-empty text begins."""
        return self.offsets[:-1][self.offsets[1:] > self.offsets[:-1]]


def runs(same: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Start positions of maximal runs: ``same[i]`` says that i continues i - 1."""
    start = ~same
    if len(start):
        start[firsts] = True
    return np.flatnonzero(start)


class Words:
    """Words of several texts: maximal runs of letters and digits, lower-cased.

    ``starts``/``ends`` index ``cps`` (lower-cased), ``doc`` is the text of a
    word, ``bounds`` the word range of each text.
    """

    def __init__(self, texts: list[str], digits: bool = True) -> None:
        code = CodePoints(texts)
        self.raw, self.offsets = code.cps, code.offsets
        self.cps = lower_table()[code.cps]
        kind = category_table()[code.cps]
        inside = (kind == 1) | (kind == 4)
        if digits:
            inside |= kind == 2
        edge = np.zeros(len(inside) + 1, bool)
        edge[:-1] = inside
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        if len(begin):
            f = code.firsts
            begin[f] = inside[f]
        self.starts = np.flatnonzero(begin)
        stop = np.zeros(len(inside) + 1, bool)
        stop[:-1] = begin | ~inside
        stop[-1] = True
        if len(inside):
            stop[code.firsts] = True
        cuts = np.flatnonzero(stop)
        self.ends = cuts[np.searchsorted(cuts, self.starts, side="right")]
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        return range_hashes(self.cps, self.starts, self.ends)


def member_filter(keys: np.ndarray, bits: int = 20) -> np.ndarray:
    """Bitmap by the high bits of 64-bit keys: a cheap first test before the exact one."""
    table = np.zeros(1 << bits, bool)
    if len(keys):
        table[keys >> _U(64 - bits)] = True
    return table


def find_sorted(needles: np.ndarray, keys: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``needles``, positions in sorted ``keys``) of all exact matches."""
    if not len(keys) or not len(needles):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if table is not None:
        bits = len(table).bit_length() - 1
        at = np.flatnonzero(table[needles >> _U(64 - bits)])
    else:
        at = np.arange(len(needles))
    found = np.searchsorted(keys, needles[at])
    found[found == len(keys)] = 0
    ok = keys[found] == needles[at]
    return at[ok], found[ok]
