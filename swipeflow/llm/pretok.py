"""Vectorised pre-tokenisation for the two public byte-pair vocabularies.

A byte-pair tokenizer first cuts a text into pre-tokens by a pattern over
character classes, then merges inside each pre-token. Cutting depends only on
the class of each character (space, letter, number, other) and on a few
English contractions, so it is done here for a whole slice of texts at once.
Merging is left to the libraries, once per distinct pre-token.

``probe_classes`` asks the tokenizer's own pre-tokenizer how it treats every
code point, so the classes follow its Unicode tables, not Python's.
"""

from __future__ import annotations

import numpy as np

from swipeflow.llm.text import CodePoints, category_table, range_hashes

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Code points from here on are unassigned, private or marks: class OTHER, but
#: for the probed block of tags.
PROBED = 0x40000


def _joined(pre_tokenizer, cps: list[int], mates: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(joined with its mate, part of some pre-token) for each code point after its mate character."""
    text = "".join(f"\n{m}{chr(c)}" for m, c in zip(mates, cps, strict=True))
    joined, seen = np.zeros(len(text) + 1, bool), np.zeros(len(text) + 1, bool)
    for _, (start, end) in pre_tokenizer.pre_tokenize_str(text):
        joined[start + 1 : end] = True
        seen[start:end] = True
    here = np.arange(len(cps)) * 3 + 2
    return joined[here], seen[here]


def probe_classes(pre_tokenizer) -> np.ndarray:
    """Class of each code point below ``PROBED``: the kind of character that the pre-tokenizer joins it with.

    Python's category is tried first and the other classes only where that guess fails.
    """
    mates = {LETTER: "a", NUMBER: "1", OTHER: "!"}
    guess = category_table()[:PROBED]
    guess = np.where(guess == 4, OTHER, guess)
    table = np.full(PROBED, SPACE, np.uint8)
    left, seen_alone = [], {}
    cps = [c for c in range(PROBED) if not 0xD800 <= c <= 0xDFFF]
    step = 16384
    for at in range(0, len(cps), step):
        block = [c for c in cps[at : at + step] if guess[c] != SPACE]
        hit, _ = _joined(pre_tokenizer, block, [mates[int(guess[c])] for c in block])
        arr = np.array(block, np.int64)
        table[arr[hit]] = guess[arr[hit]]
        left += arr[~hit].tolist() + [c for c in cps[at : at + step] if guess[c] == SPACE]
    one_by_one = len(pre_tokenizer.pre_tokenize_str("11")) == 2
    for kind, mate in mates.items():
        if left:
            hit, seen = _joined(pre_tokenizer, left, [mate] * len(left))
            table[np.array(left)[hit]] = kind
            seen_alone |= dict(zip(left, seen.tolist(), strict=True))
            left = [c for c, h in zip(left, hit.tolist(), strict=True) if not h]
    if one_by_one:  # what joins with nothing, but is kept, is a number
        for c in left:
            if seen_alone[c]:
                table[c] = NUMBER
    table[0xD800:0xE000] = OTHER
    return table


def class_of(cps: np.ndarray, table: np.ndarray) -> np.ndarray:
    return np.where(cps < PROBED, table[np.minimum(cps, PROBED - 1)], OTHER).astype(np.uint8)


def _contractions(cps: np.ndarray, start: np.ndarray, doc_end: np.ndarray) -> None:
    """Cut 's 't 'm 'd 're 've 'll out where a pre-token begins with the quote."""
    n = len(cps)
    at = np.flatnonzero((cps == 0x27) & start)
    if not len(at):
        return
    pad = np.zeros(2, np.uint32)
    ext = np.concatenate([cps, pad])
    one, two = ext[at + 1], ext[at + 2]
    room = doc_end[at] - at
    short = np.isin(one, [ord(c) for c in "stmd"]) & (room >= 2)
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    long &= (room >= 3) & ~short
    for hit, length in ((at[short], 2), (at[long], 3)):
        for k in range(1, length):
            start[hit + k] = False
        after = hit + length
        after = after[(after < n) & (after <= doc_end[hit] - 1)]
        start[after] = True


class PreTokens:
    """Pre-tokens of several texts: ``starts``/``ends`` into ``cps``; ``bounds`` per text."""

    def __init__(self, texts: list[str], table: np.ndarray, joins_space: bool) -> None:
        code = CodePoints(texts)
        cps, offsets = code.cps, code.offsets
        n = len(cps)
        kind = class_of(cps, table)
        first = np.zeros(n + 1, bool)
        first[code.firsts] = True
        first[n] = True
        first = first[:n] if n else np.zeros(0, bool)
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        start = change | first
        doc_end = np.repeat(offsets[1:], np.diff(offsets))
        if joins_space:
            # the last white space before a word is cut off its run; a plain space joins the word
            before_word = np.zeros(n, bool)
            before_word[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:]
            start |= before_word
            start[1:] &= ~(before_word[:-1] & (cps[:-1] == 0x20))
        else:
            start |= kind == NUMBER
        _contractions(cps, start, doc_end)
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n)[: len(starts)]
        if not joins_space:
            words = kind[starts] != SPACE
            starts, ends = starts[words], ends[words]
        self.text, self.cps, self.starts, self.ends = code.text, cps, starts, ends
        self.bounds = np.searchsorted(starts, offsets)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, one place of each, index of each pre-token among them)."""
        h = range_hashes(self.cps, self.starts, self.ends)
        return np.unique(h, return_index=True, return_inverse=True)

    def string(self, i: int) -> str:
        return self.text[self.starts[i] : self.ends[i]]

    def strings(self, at: np.ndarray) -> list[str]:
        return [self.text[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]
