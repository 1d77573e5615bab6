"""Conversation structure repair by aligning turns to the alternating grammar ``(s?(ua)+)?``.

The target strings of all even lengths end alike (``...uaua``), and an odd one is ``s`` before an even one.
So one Wagner-Fischer matrix of suffixes, rows against characters left to write, aligns a conversation to
every feasible length; the one with a leading ``s`` keeps a system row before it.  Ukkonen's band limits the
matrix: an incumbent (the cheaper of deleting everything and a greedy repair) bounds how far inserts and
deletes can lead from the diagonal.  The audits of the lengths that cost least are backtraced, ASCII-least
letter first, and compared.

In a conversation of more than ``FOLD_ROWS`` rows the band would grow with its length.  There the columns of
equal parity are folded into one (both write the same character next), which covers all lengths at once: same
cost and audit, memory and time linear in the rows.

Spark deals the rows twice.  First without texts (a role initial, fault flags and a digest per row), to
find the edits; then with texts, behind the conversation's audit, to write or hash the repaired rows one by one.  A
task holds one conversation's flags and audit, never its texts, so a conversation may hold any share of all rows.

Defined cases: nulls count as one space; rows of equal turn are ordered by role, then text; a null conv_id is one
conversation; a role other than system, user and assistant fits no place of the grammar unless its first letter does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm.bpe import stable
from secflow.llm.common import arrow_map, pinned, table

REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
FOLD_ROWS = 512
FAR = 1 << 60
BLANK = r"[^\x20\x09-\x0D]"
ROLES = {"u": "user", "a": "assistant"}

# A row's code is its role initial (x: none of s, u, a), upper case where the row is truncated; a row that must go is "-".


def _write(code: str, char: str) -> int:
    """Cost of giving ``char`` from the row: kept or reroled, a truncated row adds ``CUT``."""
    if code == "-":
        return FAR
    extra = CUT if code.isupper() else 0
    if code.lower() == char:
        return extra
    return REROLE + extra if char in ROLES else FAR


def _char(left: int) -> str:
    """The character that an alternating string writes when ``left`` characters are left."""
    return "a" if left % 2 else "u"


def incumbent(codes: str) -> int:
    """Cost of some repair: everything deleted, or rows taken greedily in alternation."""
    cost, left = 0, 0
    for c in reversed(codes):
        want = "ua"[(left + 1) % 2]
        if c.lower() == want:
            cost, left = cost + _write(c, want), left + 1
        else:
            cost += DELETE
    return min(DELETE * len(codes), cost + INSERT * (left % 2))


def band(codes: str) -> tuple[list[list[int]], list[range]]:
    """Suffix costs: ``E[i][k - columns[i].start]`` turns rows i.. into the last k characters of the target."""
    n, most = len(codes), incumbent(codes)
    # e inserts and d deletes cost at least 3e + 4d, and k - (n - i) is e - d.
    columns = [range(max(0, n - i - most // DELETE), n - i + most // INSERT + 1) for i in range(n + 1)]
    rows = [[INSERT * k for k in columns[n]]]
    for i in range(n - 1, -1, -1):
        below, first, row = rows[-1], columns[i + 1].start, []
        for k in columns[i]:
            best = FAR
            if 0 <= k - first < len(below):
                best = below[k - first] + DELETE
            if k and 0 <= k - 1 - first < len(below):
                best = min(best, below[k - 1 - first] + _write(codes[i], _char(k)))
            if row and k > columns[i].start:
                best = min(best, row[-1] + INSERT)
            row.append(best)
        rows.append(row)
    return rows[::-1], columns


def _walk(codes: str, cost: Callable[[int, int], int], i: int, k: int) -> str:
    """The ASCII-least audit of the cheapest edits from row ``i`` with ``k`` characters left."""
    audit, n, now = [], len(codes), cost(i, k)
    while i < n or k:
        if i < n and cost(i + 1, k) + DELETE == now:
            audit.append("D")
            now, i = now - DELETE, i + 1
        elif k and cost(i, k - 1) + INSERT == now:
            audit.append("I")
            now, k = now - INSERT, k - 1
        else:
            step = _write(codes[i], _char(k))
            audit.append("K" if codes[i].lower() == _char(k) else "R")
            now, i, k = now - step, i + 1, k - 1
    return "".join(audit)


def align(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair over all feasible target lengths."""
    rows, columns = band(codes)

    def cost(i: int, k: int) -> int:
        return rows[i][k - columns[i].start] if k in columns[i] else FAR

    plain = [(cost(0, k), k) for k in columns[0] if k % 2 == 0]
    # With a leading s: the rows before it go, it is kept, and at least one pair follows.
    led = [(DELETE * i + _write(codes[i], "s") + cost(i + 1, k), i, k) for i in range(len(codes))
           if codes[i] in "sS" for k in columns[i + 1] if k and k % 2 == 0]
    least = min([c for c, _ in plain] + [c for c, _, _ in led])
    audits = [_walk(codes, cost, 0, k) for c, k in plain if c == least]
    audits += ["D" * i + "K" + _walk(codes, cost, i + 1, k) for c, i, k in led if c == least]
    return least, min(audits)


def fold(codes: str) -> tuple[int, str]:
    """The same with all columns of one parity in one: 0 even, 1 odd, 2 even but not none, 3 nothing written yet."""
    cost = [(0, INSERT, 2 * INSERT, 0)]
    for c in reversed(codes):
        even, odd, more, start = cost[-1]
        u, a, s = _write(c, "u"), _write(c, "a"), _write(c, "s") if c in "sS" else FAR
        e, o, m = min(even + DELETE, odd + u), min(odd + DELETE, even + a), min(more + DELETE, odd + u)
        e, o, m = min(e, o + INSERT), min(o, e + INSERT), min(m, o + INSERT, e + 2 * INSERT)
        cost.append((e, o, m, min(start + DELETE, odd + u, o + INSERT, more + s)))
    cost.reverse()
    audit, i, at, n = [], 0, 3, len(codes)
    while i < n or cost[i][at]:
        now, after = cost[i][at], 0 if at == 1 else 1
        if i < n and cost[i + 1][at] + DELETE == now:
            audit.append("D")
            i += 1
        elif cost[i][after] + INSERT == now:
            audit.append("I")
            at = after
        else:
            led = at == 3 and codes[i] in "sS" and cost[i + 1][2] + _write(codes[i], "s") == now
            audit.append("K" if led or codes[i].lower() == ("a" if at == 1 else "u") else "R")
            i, at = i + 1, 2 if led else after
    return cost[0][3], "".join(audit)


@lru_cache(maxsize=100_000)
def _short(codes: str) -> tuple[int, str]:
    return align(codes)


def repair_codes(codes: str) -> tuple[int, str]:
    return _short(codes) if len(codes) <= 32 else align(codes) if len(codes) <= FOLD_ROWS else fold(codes)


def normal(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) without nulls in role and text, whatever other columns ``df`` has."""
    return df.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
                     F.col(f"`{turn_col}`").cast("long").alias("turn"),
                     F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"))


def damage(rows: DataFrame) -> DataFrame:
    """Known damage by a hash of conversation and turn; a dropped row stays as a mark with ``present`` false."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    hurt = rows.withColumn("kind", kind).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") <= 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return hurt.drop("copy")


def _digest() -> Column:
    role = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.unhex(F.sha2(role, 256))


AUDIT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
         "audit string")
_AUDITS = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in
                     ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])
_LEGAL = {"su", "ua", "au"}


class _Conversation:
    """Flags of one conversation's rows in order."""

    def __init__(self):
        self.initials, self.codes, self.seen, self.turns = [], [], set(), set()
        self.blank = self.duplicate = self.truncated = 0

    def add(self, turn: int | None, initial: str, fault: str, digest: bytes) -> None:
        if turn is not None:
            self.turns.add(turn)
        self.initials.append(initial)
        again = digest in self.seen
        self.seen.add(digest)
        if fault == "b":
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif fault == "t":
            self.truncated += 1
        code = initial if initial in ("s", "u", "a") else "x"
        self.codes.append("-" if fault == "b" or again else code.upper() if fault == "t" else code)

    def row(self, conv: int | None) -> tuple:
        cost, audit = repair_codes("".join(self.codes))
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        illegal = sum(a + b not in _LEGAL for a, b in zip(self.initials, self.initials[1:], strict=False))
        return conv, gaps, self.blank, self.duplicate, self.truncated, illegal, cost, audit


def _find_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place -> one row per conversation."""
    now, conv, out = None, (), []
    for b in batches:
        for c, turn, present, initial, fault, digest in zip(*(b.column(n).to_pylist() for n in (
                "conv_id", "turn", "present", "initial", "fault", "digest")), strict=True):
            if now is None or c != conv:
                if now is not None:
                    out.append(now.row(conv))
                now, conv = _Conversation(), c
            if present:
                now.add(turn, initial, fault, digest)
        if len(out) >= 1000:
            yield _batch(out, _AUDITS)
            out = []
    if now is not None:
        out.append(now.row(conv))
    yield _batch(out, _AUDITS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)],
                                      schema=schema)


ORDER = ["conv_id", "turn", "role", "digest"]


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost of the cheapest repair and the audit of its edits.

    ``rows`` as from ``normal``, or from ``damage`` with ``present``.
    """
    if "present" not in rows.columns:
        rows = rows.withColumn("present", F.lit(True))
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    flags = rows.select("conv_id", "turn", "role", "present", F.substring("role", 1, 1).alias("initial"),
                        F.when(~F.col("text").rlike(BLANK), "b").when(~last.isin(".", "!", "?"), "t")
                        .otherwise("").alias("fault"), _digest().alias("digest"))
    return arrow_map(flags.repartition("conv_id").sortWithinPartitions(*ORDER), _find_edits, AUDIT)


class _Writer:
    """Applies an audit to the rows of a conversation as they come; returns the repaired rows."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.left = sum(map(audit.count, "KRI"))

    def _put(self, role: str, text: str) -> tuple[int, str, str]:
        self.place, self.left = self.place + 1, self.left - 1
        return self.place - 1, role, text

    def inserts(self) -> list[tuple[int, str, str]]:
        """The inserts before the next row's edit, or at the end."""
        out = []
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            out.append(self._put(ROLES[_char(self.left)], ""))
        return out

    def row(self, role: str, text: str) -> list[tuple[int, str, str]]:
        out = self.inserts()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            out.append(self._put(role, text))
        elif letter == "R":
            out.append(self._put(ROLES[_char(self.left)], text))
        return out


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, place, role, text) in order; a conversation starts with (conv_id, -1, None, None)."""
    writer, conv = None, None
    for b in batches:
        for c, audit, role, text in zip(*(b.column(n).to_pylist() for n in ("conv_id", "audit", "role", "text")),
                                        strict=True):
            if audit is None:
                yield from ((conv, *x) for x in writer.row(role, text))
                continue
            if writer:
                yield from ((conv, *x) for x in writer.inserts())
            writer, conv = _Writer(audit), c
            yield c, -1, None, None
    if writer:
        yield from ((conv, *x) for x in writer.inserts())


TURN = "conv_id long, turn long, role string, text string"
_TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_HASHES = pa.schema([("hash_id", pa.int64()), ("repaired_sha256", pa.string())])


def _write_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for row in _repaired(batches):
        if row[1] < 0:
            continue
        out.append(row)
        size += len(row[3])
        if len(out) >= 5000 or size > 1 << 22:
            yield _batch(out, _TURNS)
            out, size = [], 0
    yield _batch(out, _TURNS)


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, now, conv = [], None, None
    for c, place, role, text in _repaired(batches):
        if place < 0:
            if now is not None:
                out.append((conv, now.hexdigest()))
            now, conv = hashlib.sha256(), c
            if len(out) >= 5000:
                yield _batch(out, _HASHES)
                out = []
            continue
        now.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
    if now is not None:
        out.append((conv, now.hexdigest()))
    yield _batch(out, _HASHES)


def _beside_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order."""
    if "present" in rows.columns:
        rows = rows.filter("present")
    text = rows.select("conv_id", "turn", "role", _digest().alias("digest"), "text", F.lit(None).cast("string").alias("audit"),
                       F.lit(1).alias("kind"))
    head = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                        F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"), "audit", F.lit(0).alias("kind"))
    both = head.unionByName(text).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", *ORDER[1:]).select("conv_id", "audit", "role", "text")


def repair(df: DataFrame, **columns: str) -> DataFrame:
    """The repaired conversations: (conv_id, turn from 0, role, text)."""
    rows = stable(normal(df, **columns))
    return arrow_map(_beside_audits(rows, pinned(audits(rows), "audits")), _write_rows, TURN)


def digests(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, cost, audit and the sha256 of the repaired ``role:text`` lines."""
    rows = stable(rows)
    found = pinned(audits(rows), "audits")
    hashed = arrow_map(_beside_audits(rows, found), _hash_rows, "hash_id long, repaired_sha256 string")
    return found.join(hashed, F.col("conv_id").eqNullSafe(F.col("hash_id"))).drop("hash_id")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(damage(normal(table(spark, sf_dir, "conversations"))))
