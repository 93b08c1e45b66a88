"""Repair of conversation structure by aligning turns to the alternating grammar.

The role initials of a good conversation are empty, or an optional ``s`` and then ``ua`` repeated.
Rows with a fault are found first (blank, duplicate, truncated). Then the turns of a conversation
are aligned with the target string of each feasible length by Wagner-Fischer: a turn is kept
(cost 0), reroled (2) or deleted (3, a must for blank and duplicate turns), a target symbol is
inserted as an empty turn (2), and a truncated turn that stays adds 1. The cheapest edits
win, of equal ones the audit (their initials in order) that is least in ASCII.

The targets of all lengths end alike (``...uaua``), so one table over (turns left, symbols left) holds
the costs for every length; ``s`` can only be a kept turn, which starts the odd lengths.
The table is banded as by Ukkonen: an incumbent cost C comes from aligning without
insertions, then from narrow bands, and a cell whose surplus of turns or symbols alone
costs more than C allows is never filled. Bands are widened until they cover the
incumbent's cost, which proves it. All optimal lengths are then backtraced side by side,
and the least audit stays.

Time is turns x band, memory the square root of turns x band (rows of the table are kept at
intervals and filled again for the backtrace). Texts and digests never enter a task as a group:
one byte a turn does.

Edge cases: a null role or text is one space; rows are taken by turn, a null one first, ties by the
start of role and text, then by digest (``order.tie_keys``); rows with a null conversation id form
one conversation; an empty role has no initial and can only be reroled or deleted; a
conversation without rows does not appear in ``plan_repairs`` (``op11`` adds it); an empty table gives
no rows. Only the named columns are read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.common import settle
from swipeflow.llm.order import EMPTY_SHA256, in_order, ordered_digest, tie_keys

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: White space of the fault rules; everything else is content.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: A turn in one character: role class s, u, a, x (other) as 0 to 3, plus 4 if truncated, 8 if blank, 12 if a duplicate.
CLASSES = "sua"
SYMBOLS = "ABCDEFGHIJKLMNOP"
#: Turns whose symbols are joined to one piece.
PIECE = 8192
#: Cells of the table that are kept whole; larger tables keep every n-th row.
DENSE_CELLS = 1 << 21
#: Letters of audits that a task lays out at once.
BATCH = 65_536
FAR = 1 << 29
#: Bands wider than this are filled by array operations.
WIDE = 40


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text with the faults of ``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties
    its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it a user's. A null is one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("_f") == 1, "").when(F.col("_f") == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    copies = F.when(F.col("_f") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.withColumn("_f", fault)
        .filter("_f <> 0")
        .select("conv_id", "turn", F.when(F.col("_f") == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), copies.alias("_copies"))
        .withColumn("_copy", F.explode("_copies"))
        .select("conv_id", "turn", "role", "text")
    )


# ---- alignment of one conversation -------------------------------------------------


class Turns:
    """Symbols of a conversation as lists, with the number of turns that need not go from each position on."""

    def __init__(self, symbols: str) -> None:
        code = [ord(c) - ord("A") for c in symbols]
        self.n = len(code)
        self.kind = [c % 4 for c in code]
        self.must_go = [c >= 8 for c in code]
        self.truncated = [TRUNCATED if 4 <= c < 8 else 0 for c in code]
        self.left = [0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            self.left[i] = self.left[i + 1] + (not self.must_go[i])
        # every alignment costs at least this
        self.base = DELETE * sum(self.must_go) + sum(self.truncated)

    def straight_cost(self) -> int:
        """The incumbent to begin with: no insertion but for the last symbol; everything deleted, if that is cheaper."""
        cost, k = self.base + INSERT * (self.left[0] % 2), self.left[0] + self.left[0] % 2
        for kind, gone in zip(self.kind, self.must_go):
            if not gone:
                cost += KEEP if kind == wanted(k) else REROLE
                k -= 1
        return min(cost, DELETE * self.n)


def wanted(k: int) -> int:
    """Class of the target symbol with which k symbols are left: assistants end, users go before them."""
    return 2 if k % 2 else 1


class Table:
    """Costs of aligning the turns from i on with the last k symbols, for the k within ``half`` of the turns left.

    A row is a list over k from ``left[i] - half`` on, or an array if the band is wide.
    """

    def __init__(self, turns: Turns, half: int) -> None:
        self.t, self.half, self.width = turns, half, 2 * half + 1
        self.wide = self.width > WIDE
        if self.wide:
            self.columns = np.arange(self.width, dtype=np.int64)
            self.drift = INSERT * self.columns
        self.step = 1 if (turns.n + 1) * self.width <= DENSE_CELLS else math.isqrt(turns.n)
        ks = range(-half, half + 1)
        row = [INSERT * k if k >= 0 else FAR for k in ks]
        row = np.array(row) if self.wide else row
        self.kept, self.block = {turns.n: row}, {}
        # the cheapest even, non-empty rest behind each turn that can be the leading s
        self.after_s: dict[int, int] = {}
        for i in range(turns.n - 1, -1, -1):
            if turns.kind[i] == 0 and not turns.must_go[i]:
                low = turns.left[i + 1] - half
                begin = 2 - low if low <= 2 else low % 2
                rest = row[begin::2]
                self.after_s[i] = int(min(rest)) if len(rest) else FAR
            row = self._before(i, row)
            if i % self.step == 0:
                self.kept[i] = row

    def _before(self, i: int, row):
        """Row i from row i + 1."""
        t, low = self.t, self.t.left[i] - self.half
        gone, after = t.must_go[i], t.truncated[i]
        if self.wide:
            if gone:
                cost = row + DELETE
            else:
                k = low + self.columns
                stays = row + np.where(np.where(k % 2 == 1, 2, 1) == t.kind[i], KEEP + after, REROLE + after)
                cost = np.where(k >= 1, stays, FAR)
                cost[:-1] = np.minimum(cost[:-1], row[1:] + DELETE)
            cost[: max(0, -low)] = FAR
            return np.minimum(np.minimum.accumulate(cost - self.drift) + self.drift, FAR)
        out, insert = [], FAR
        for c in range(self.width):
            k = low + c
            if k < 0:
                out.append(FAR)
                continue
            if gone:
                cost = row[c] + DELETE
            else:
                cost = row[c + 1] + DELETE if c + 1 < self.width else FAR
                if k:
                    cost = min(cost, row[c] + after + (KEEP if t.kind[i] == wanted(k) else REROLE))
            cost = min(cost, insert, FAR)
            out.append(cost)
            insert = cost + INSERT
        return out

    def row(self, i: int):
        if i in self.kept:
            return self.kept[i]
        if i not in self.block:
            j = min(-(-i // self.step) * self.step, self.t.n)
            row, self.block = self.kept[j], {}
            while (j - 1) % self.step:
                j -= 1
                row = self.block[j] = self._before(j, row)
        return self.block[i]

    def at(self, i: int, k: int) -> int:
        c = k - self.t.left[i] + self.half
        return self.row(i)[c] if 0 <= c < self.width and k >= 0 else FAR

    def symbols_left(self, i: int) -> range:
        """The even numbers of symbols in the band."""
        low = max(0, self.t.left[i] - self.half)
        return range(low + low % 2, self.t.left[i] + self.half + 1, 2)

    def best(self) -> int:
        odd = [DELETE * i + self.t.truncated[i] + rest for i, rest in self.after_s.items()]
        return int(min([FAR, *odd, *(self.at(0, k) for k in self.symbols_left(0))]))

    def least_audit(self, cost: int) -> str:
        """The ASCII-least letters of all alignments, to all lengths, that cost ``cost``: every optimal
        length is followed at once, and those whose next letter is not the least drop out."""
        t, i, left, out, at = self.t, 0, cost, [], self.at
        ks = [k for k in self.symbols_left(0) if at(0, k) == cost]
        leading = sorted(j for j, rest in self.after_s.items() if DELETE * j + t.truncated[j] + rest == cost)
        while True:
            if i < t.n:
                gone = [k for k in ks if at(i + 1, k) + DELETE == left]
                if gone or (leading and leading[-1] > i):
                    out.append("D")
                    ks, i, left = gone, i + 1, left - DELETE
                    leading = [j for j in leading if j >= i]
                    continue
            put = [k - 1 for k in ks if k and at(i, k - 1) + INSERT == left]
            if put:
                out.append("I")
                ks, leading, left = put, [], left - INSERT
                continue
            if i == t.n:
                return "".join(out)
            left -= t.truncated[i]
            stay = [k - 1 for k in ks if k and wanted(k) == t.kind[i] and at(i + 1, k - 1) == left]
            if leading and leading[0] == i:
                stay = sorted({*stay, *(k for k in self.symbols_left(i + 1) if k and at(i + 1, k) == left)})
            if stay:
                out.append("K")
            else:
                out.append("R")
                left -= REROLE
                stay = [k - 1 for k in ks if k and wanted(k) != t.kind[i] and at(i + 1, k - 1) == left]
            ks, leading, i = stay, [], i + 1


def align(symbols: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair."""
    t = Turns(symbols)
    cost = t.straight_cost()
    half = min(WIDE // 2, (cost - t.base) // 2)
    while True:
        table = Table(t, half)
        cost = min(cost, table.best())
        # a surplus of more than this many turns or symbols costs more than the incumbent
        needed = (cost - t.base) // 2
        if needed <= half:
            return cost, table.least_audit(cost)
        half = min(needed, 4 * half + 4)


_align = functools.lru_cache(maxsize=1 << 14)(align)


def illegal_pairs(symbols: str) -> int:
    kinds = (np.frombuffer(symbols.encode("ascii"), np.uint8) - ord("A")) % 4
    legal = np.isin(kinds[:-1] * 4 + kinds[1:], [CLASSES.index(a) * 4 + CLASSES.index(b) for a, b in ("su", "ua", "au")])
    return int((~legal).sum())


# ---- tables -------------------------------------------------------------------------


def checked_turns(rows: DataFrame) -> DataFrame:
    """Every row at its place: conv_id, turn, role, text, _at (global order), symbol."""
    filled = rows.select(
        F.col("conv_id"), F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    keyed = filled.select("conv_id", "turn", "role", "text", *tie_keys())
    order = ["conv_id", "turn", "_role_key", "_text_key", "_digest"]
    placed = settle(in_order(keyed, order, keep=["conv_id", "turn", "role", "text", "_digest"]))
    firsts = placed.groupBy("conv_id", "_digest").agg(F.min("_at").alias("_at")).select("_at", F.lit(False).alias("_again"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = (
        F.when(trimmed == "", 8)
        .when(F.coalesce("_again", F.lit(True)), 12)
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), 4)
        .otherwise(0)
    )
    kind = F.instr(F.lit(CLASSES), F.substring("role", 1, 1)) - 1
    kind = F.when((kind < 0) | (F.col("role") == ""), len(CLASSES)).otherwise(kind)
    symbol = F.substring(F.lit(SYMBOLS), kind + fault + 1, F.lit(1))
    return placed.join(firsts, "_at", "left").select("conv_id", "turn", "role", "text", "_at", symbol.alias("symbol"))


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for pieces in batch.column("_pieces").to_pylist():
            symbols = "".join(pieces)
            cost, audit = _align(symbols)
            code = np.frombuffer(symbols.encode("ascii"), np.uint8) - ord("A")
            counts = [int((code // 4 == f).sum()) for f in (2, 3, 1)]
            found.append((*counts, illegal_pairs(symbols), cost, audit))
        names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        made = [pa.array([f[j] for f in found], pa.string() if c == "audit" else pa.int64()) for j, c in enumerate(names)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("_first"), *made], names=["conv_id", "_first", *names])


def plan_repairs(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``checked_turns``: fault counts, cost, audit, and the place of its first row."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    # symbols are small and aligning them is not: keep all partitions
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = turns.groupBy("conv_id", F.expr(f"_at div {PIECE}").alias("_piece")).agg(
        F.min("_at").alias("_first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "symbol"))), lambda x: x["symbol"]), "").alias("_symbols"),
    )
    whole = pieces.repartition(tasks, "conv_id").groupBy("conv_id").agg(F.min("_first").alias("_first"), F.transform(F.array_sort(F.collect_list(F.struct("_piece", "_symbols"))), lambda x: x["_symbols"]).alias("_pieces"))
    schema = f"conv_id {kind}, _first long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return whole.mapInArrow(_plan, schema)


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of audits of about ``BATCH`` letters together; one longer audit stands alone."""
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > BATCH:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, pos, edit, _at, _role) of every turn of the repaired conversations."""
    for batch in batches:
        audits, firsts = batch.column("audit").to_pylist(), batch.column("_first").to_numpy()
        for a, b in _slices([len(x) for x in audits]):
            letters = np.frombuffer("".join(audits[a:b]).encode("ascii"), np.uint8)
            owner = np.repeat(np.arange(b - a), [len(x) for x in audits[a:b]])
            begin = np.searchsorted(owner, np.arange(b - a))

            def within(marks: np.ndarray) -> np.ndarray:
                """Marks up to and with each letter of the same audit."""
                sums = np.concatenate([[0], np.cumsum(marks)])
                return sums[1:] - sums[begin[owner]]

            stays = np.flatnonzero(letters != ord("D"))
            at = firsts[a:b][owner] + within(letters != ord("I")) - 1
            pos = within(letters != ord("D"))[stays] - 1
            mine = owner[stays]
            left = np.bincount(mine, minlength=b - a)[mine] - pos
            edit = letters[stays]
            role = np.where(edit == ord("K"), None, np.where(left % 2 == 1, "assistant", "user"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id").take(pa.array(a + mine)),
                    pa.array(pos.astype(np.int64)),
                    pa.array(edit.view("S1").astype("U1").tolist(), pa.string()),
                    pa.array(at[stays], pa.int64(), mask=edit == ord("I")),
                    pa.array(role, pa.string()),
                ],
                names=["conv_id", "pos", "edit", "_at", "_role"],
            )


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, pos from 0, edit (K, R, I), role, text. Every edit finds its row by
    its global place, so no conversation is gathered."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    edits = plans.select("conv_id", "_first", "audit").mapInArrow(_edits, f"conv_id {kind}, pos long, edit string, _at long, _role string")
    found = edits.join(turns.select("_at", "role", "text"), "_at", "left")
    return found.select("conv_id", "pos", "edit", F.coalesce("_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def gaps_of(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps): missing numbers between the least and the largest turn; 0 without numbers."""
    distinct = turns.filter(F.col("turn").isNotNull()).select("conv_id", "turn").distinct()
    return distinct.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def repair_report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation of ``ids`` (conv_id): faults, cost, audit and digest of the repair of ``rows``."""
    turns = settle(checked_turns(rows))
    plans = settle(plan_repairs(turns))
    lines = repaired_turns(turns, plans).select("conv_id", "pos", F.concat("role", F.lit(":"), "text").alias("_line"))
    digests = ordered_digest(lines, "conv_id", ["pos"], "_line", "\n")
    done = ids.select("conv_id").distinct()
    for k, part in enumerate((plans, gaps_of(turns), digests)):
        part = part.withColumnRenamed("conv_id", f"_c{k}")
        done = done.join(part, _same("conv_id", f"_c{k}"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return done.select(
        "conv_id", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
