"""Best-fit packing of token sequences by exact complements.

Only the histogram of piece lengths decides the packing, and it has at most ``capacity`` entries
however many documents there are.  Spark counts it, the driver turns it into patterns (lists of
lengths that share a sequence, with a number of sequences each), and the pieces take their places
by their rank within their length:

* longest length first, the gap it leaves is filled exactly by a single length, else a pair, else
  a triple whose sum is the gap, as often as the counts allow;
* what has no exact complement is placed best fit, longest first.

Ranks come from per-block counters and a prefix sum over the blocks, so no task sees all pieces of
a length.

Defined cases: null or empty text is the end token alone; a text longer than the capacity is cut
into full pieces, the first one may be shorter; repeated rows are packed each; ids may be null.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secflow.llm.bpe import default_tokenizer, encoder
from secflow.llm.common import arrow_map, keyed_text, pinned, slices, table

CAPACITY = 2048
BLOCK_BYTES = 4 << 20
PIECE = ("block long, local long, doc_id long, piece int, start long, length long, ids_crc32 long")
PIECE_SCHEMA = pa.schema([("block", pa.int64()), ("local", pa.int64()), ("doc_id", pa.int64()),
                          ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                          ("ids_crc32", pa.int64())])


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full pieces, the first one may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _pieces(path: str, capacity: int, end_id: int, limit: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        enc, base = encoder(path), TaskContext.get().partitionId() << 24
        for n_block, b in enumerate(slices(batches, "text", limit)):
            out, rank = {n: [] for n in PIECE_SCHEMA.names}, defaultdict(int)
            for doc, ids in zip(b.column("doc_id").to_pylist(), enc.texts(b.column("text")), strict=True):
                n_ids = len(ids) // 4 + 1
                pieces = cut(n_ids, capacity)
                for i, (start, n) in enumerate(pieces):
                    crc = zlib.crc32(ids[4 * start:4 * (start + n)])
                    if i == len(pieces) - 1:
                        crc = zlib.crc32(end, crc)
                    row = (base + n_block, rank[n], doc, i, start, n, crc)
                    rank[n] += 1
                    for name, v in zip(PIECE_SCHEMA.names, row, strict=True):
                        out[name].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=PIECE_SCHEMA)
    return run


class _Lengths:
    """Available lengths with counts; bit i of ``bits`` is set while length i is available."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n, self.capacity = dict(counts), capacity
        self.bits = sum(1 << k for k in self.n)
        self.mirror = sum(1 << (capacity - k) for k in self.n)

    def take(self, length: int, k: int) -> None:
        self.n[length] -= k
        if not self.n[length]:
            del self.n[length]
            self.bits &= ~(1 << length)
            self.mirror &= ~(1 << (self.capacity - length))

    def largest(self, limit: int) -> int:
        return (self.bits & ((2 << limit) - 1)).bit_length() - 1 if limit > 0 else -1

    def enough(self, parts: tuple[int, ...]) -> int:
        """How many times the combination can be taken."""
        return min(self.n.get(p, 0) // parts.count(p) for p in set(parts))

    def pair(self, total: int, held: tuple[int, ...]) -> tuple[int, int] | None:
        """The pair (largest first) whose sum is ``total`` that can be taken along with ``held``."""
        if total < 2:
            return None
        both = self.bits & (self.mirror >> (self.capacity - total)) if total <= self.capacity else 0
        both &= (2 << total) - 1
        while both:
            a = both.bit_length() - 1
            if 2 * a < total:
                return None
            if self.enough((*held, a, total - a)):
                return a, total - a
            both &= ~(1 << a)
        return None

    def complement(self, length: int) -> tuple[int, ...] | None:
        """A single, pair or triple that fills the gap beside ``length`` exactly."""
        gap = self.capacity - length
        if self.bits >> gap & 1 and self.enough((length, gap)):
            return (gap,)
        if found := self.pair(gap, (length,)):
            return found
        a = self.largest(gap - 2)
        while a > 0 and 3 * a >= gap:
            if self.enough((length, a)) and (rest := self.pair(gap - a, (length, a))):
                return (a, *rest)
            a = self.largest(a - 1)
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence, number of such sequences) that use up ``counts``."""
    left, patterns = _Lengths(counts, capacity), []
    if k := left.n.get(capacity, 0):
        patterns.append(((capacity,), k))
        left.take(capacity, k)
    rest: dict[int, int] = {}
    length = left.largest(capacity)
    while length > 0:
        while left.n.get(length) and (found := left.complement(length)):
            pattern = (length, *found)
            k = left.enough(pattern)
            patterns.append((pattern, k))
            for p in pattern:
                left.take(p, k)
        if k := left.n.get(length, 0):
            rest[length] = k
            left.take(length, k)
        length = left.largest(length - 1)
    # Best fit, longest first: the fullest open sequence that still takes the piece.
    gaps: list[int] = []
    open_: dict[int, list[list]] = {}

    def put(pattern: tuple[int, ...], k: int) -> None:
        gap = capacity - sum(pattern)
        if gap not in open_:
            bisect.insort(gaps, gap)
            open_[gap] = []
        open_[gap].append([pattern, k])

    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                each = min(capacity // length, n)
                put((length,) * each, n // each)
                n %= each
                continue
            gap = gaps[at]
            pattern, k = open_[gap][-1]
            each = min(gap // length, n)
            used = min(k, n // each)
            open_[gap][-1][1] -= used
            if not open_[gap][-1][1]:
                open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
                    gaps.pop(at)
            put(pattern + (length,) * each, used)
            n -= used * each
    return patterns + [(p, k) for group in open_.values() for p, k in group]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, pieces per sequence, first sequence, first offset) by rank."""
    at: dict[int, int] = defaultdict(int)
    rows, sequence = defaultdict(list), 0
    for pattern, k in patterns:
        offset = 0
        for length in dict.fromkeys(pattern):
            each = pattern.count(length)
            rows[length].append((at[length], each, sequence, offset))
            at[length] += each * k
            offset += each * length
        sequence += k
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
PLACED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                           ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()),
                           ("offset", pa.int64())])


def _place(table_: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            seq, off = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
            for n in np.unique(lens).tolist():
                own = np.flatnonzero(lens == n)
                rows = table_[n]
                r = rows[np.searchsorted(rows[:, 0], rank[own], side="right") - 1]
                inside = rank[own] - r[:, 0]
                seq[own] = r[:, 2] + inside // r[:, 1]
                off[own] = r[:, 3] + inside % r[:, 1] * n
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in PLACED_SCHEMA.names[:5]] + [pa.array(seq), pa.array(off)],
                schema=PLACED_SCHEMA)
    return run


def pack(df: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack the texts of ``df``: one row per piece with its sequence and its place there."""
    docs = keyed_text(df, id_col, text_col)
    pieces = pinned(arrow_map(docs, _pieces(tokenizer or default_tokenizer(), capacity, end_id, BLOCK_BYTES),
                              PIECE), "pieces")
    per_block = pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in
              per_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per_block.select("block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["block", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    return arrow_map(ranked, _place(places(plan(counts, capacity))), PLACED)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
