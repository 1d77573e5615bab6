"""Merkle manifest of a dataset, its tree stored in van Emde Boas order, with a proof for every row.

A leaf is the hash of a row.  Per source, leaves in order form a tree of arity 16 up to a subroot; the subroots,
ordered by source, form another tree up to the root.

The tree is stored in blocks: aligned subtrees of ``16 ** BLOCK_LEVELS`` leaves.  A block is one binary value in van Emde
Boas order: it is split at half its height into a top subtree and the bottom subtrees below it, which are stored one
after another, each split in the same way.  Where a node lies follows from arithmetic on its depth and number alone
(``address``); only the last subtree of a level can be partial, so the ones before it have a fixed size.  Building a block
writes its nodes at their addresses, and the siblings of a node are read from theirs, for a path from the root in
about log(nodes) / log(cache line) lines whatever the size of a line.  The roots of a source's blocks are the leaves of its next
blocks, until one block is left.

On Spark: a row's position in its source comes from a range partitioning by (source, doc_id, leaf); only the
first source of a partition continues from earlier ones, so one row per partition goes through the driver.  Rows meet in
their block, a block meets its ancestors' siblings by (source, block), and no task holds more than a block.  A
hot source is many blocks.

Defined cases: rows of equal source and doc_id are ordered by leaf, and equal rows are as many equal leaves; a
null doc_id comes first and is never tampered with; an empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm.common import arrow_map, pinned, slices, table

ARITY = 16
BLOCK_LEVELS = 3
BLOCK = ARITY ** BLOCK_LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SLICE_BYTES = 4 << 20


def levels(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    n = 0
    while leaves > 1:
        leaves, n = -(-leaves // ARITY), n + 1
    return n


def size(bottom: int, height: int) -> int:
    """Nodes of a tree with ``height`` levels of nodes and ``bottom`` nodes in the lowest."""
    total = 0
    for _ in range(height):
        total, bottom = total + bottom, -(-bottom // ARITY)
    return total


@lru_cache(maxsize=10_000)
def address(bottom: int, height: int, depth: int) -> np.ndarray:
    """Places of the nodes at ``depth`` (0: the root level) of a tree in van Emde Boas order."""
    if height == 1:
        return np.arange(bottom, dtype=np.int64)
    top = height // 2
    low = height - top
    each = ARITY ** (low - 1)                       # lowest nodes of a full bottom subtree
    above = -(-(-(-bottom // each)) // ARITY)       # lowest nodes of the top subtree
    if depth < top:
        return address(above, top, depth)
    first = size(above, top)
    full, rest = divmod(bottom, each)
    inside = address(each, low, depth - top)
    parts = [(first + np.arange(full, dtype=np.int64)[:, None] * size(each, low) + inside).ravel()]
    if rest:
        parts.append(first + full * size(each, low) + address(rest, low, depth - top))
    return np.concatenate(parts)


def parent(run: bytes) -> bytes:
    """The node above a run of siblings (32 bytes each): the hash of their hex texts."""
    return hashlib.sha256(run.hex().encode()).digest()


def _runs(nodes: bytes) -> list[bytes]:
    step = 32 * ARITY
    return [nodes[i:i + step] for i in range(0, len(nodes), step)]


def build(leaves: bytes, above: int) -> bytes:
    """The nodes of a block with ``above`` levels above its leaves, in van Emde Boas order."""
    bottom, height = len(leaves) // 32, above + 1
    out = np.empty((size(bottom, height), 32), np.uint8)
    nodes = leaves
    for depth in range(above, -1, -1):
        out[address(bottom, height, depth)] = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
        if depth:
            nodes = b"".join(map(parent, _runs(nodes)))
    return out.tobytes()


class Block:
    """Reads a stored block."""

    def __init__(self, stored: bytes, leaves: int, above: int):
        self.nodes = np.frombuffer(stored, np.uint8).reshape(-1, 32)
        self.leaves, self.height = leaves, above + 1

    def level(self, up: int) -> bytes:
        """The nodes ``up`` levels above the leaves, in order."""
        return self.nodes[address(self.leaves, self.height, self.height - 1 - up)].tobytes()

    def runs(self) -> list[list[bytes]]:
        """By level from the leaves up (the block's root excluded), the runs of siblings."""
        return [_runs(self.level(up)) for up in range(self.height - 1)]


def path_in(i: int, runs: list[list[bytes]]) -> list[tuple[int, bytes]]:
    """(place in the run, the run's nodes) of each level from leaf ``i`` up."""
    out = []
    for run in runs:
        out.append((i % ARITY, run[i // ARITY]))
        i //= ARITY
    return out


def fold(leaf: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that follows from a leaf and the siblings on its path."""
    for at, run in path:
        leaf = parent(run[:32 * at] + leaf + run[32 * at + 32:])
    return leaf


def siblings(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join([run[:32 * at] + run[32 * at + 32:] for at, run in path])


# --- rows and positions -----------------------------------------------------------------

def _field(value: bytes | int | None) -> bytes:
    if value is None:
        return b"-"
    if isinstance(value, int):
        value = b"%d" % value
    return b"%d:%b" % (len(value), value)


LEAF = "key string, doc_id long, leaf binary, changed binary"
_LEAF = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("leaf", pa.binary()), ("changed", pa.binary())])


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The leaf of every row, and that of the tampered row where it differs.

    Hashed piece by piece: a text is never copied into a longer one, so a very long text costs its own size once.
    """
    for b in slices(batches, "text", SLICE_BYTES):
        columns = [b.column("doc_id"), *(b.column(c).cast(pa.binary()) for c in ("source", "lang")),
                   b.column("n_chars"), b.column("text").cast(pa.binary())]
        leaves, changed = [], []
        for doc, source, lang, n_chars, text in zip(*(c.to_pylist() for c in columns), strict=True):
            start = hashlib.sha256(b"".join(map(_field, (doc, source, lang, n_chars))))
            lower = text
            if text is not None and doc is not None and zlib.crc32(b"%d" % doc) % 5 == 0:
                lower = text.lower()              # bytes: A-Z alone
            digests = []
            for t in (text, lower):
                h = start.copy()
                h.update(b"-" if t is None else b"%d:" % len(t))
                h.update(t or b"")
                digests.append(h.digest())
                if lower == text:
                    break
            leaves.append(digests[0])
            changed.append(digests[1] if len(digests) > 1 else None)
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("doc_id"), pa.array(leaves, pa.binary()),
                                          pa.array(changed, pa.binary())], schema=_LEAF)


def manifest_rows(df: DataFrame) -> DataFrame:
    """(key, doc_id, leaf, changed): the ordering key of the source, and the leaf of the tampered row, if any."""
    kinds = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
    rows = df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in FIELDS])
    # '' for null and 's' before a name keep the order of (null first, bytewise).
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), F.col("source")))
    return arrow_map(rows.withColumn("key", key), _hash_rows, LEAF)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: each row's number among the rows of its key in this partition."""
    part, now, n = TaskContext.get().partitionId(), None, 0
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column("key").to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        at = np.arange(b.num_rows) - np.repeat(starts, np.diff(np.append(starts, b.num_rows)))
        if keys[0] == now:
            at[:starts[1] if len(starts) > 1 else b.num_rows] += n
        now, n = keys[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, part, np.int32)), pa.array(at), *b.columns],
                                         names=["part", "at", *b.schema.names])


ROW = ["key", "pos", "doc_id", "leaf", "changed"]


def positions(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``pos``, the place in the order of their key, and the largest number of rows of a key."""
    spark = rows.sparkSession
    # Equal rows may fall on both sides of a bound: any order among them gives the same tree.
    spread = rows.withColumn("spread", F.monotonically_increasing_id())
    by = ["key", *order, "spread"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spread.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("spread")
    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    numbered = pinned(arrow_map(dealt, _number, f"part int, at long, {kinds}"), "merkle-rows")
    counts = numbered.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    end = F.struct("key", "n")
    ends = (counts.groupBy("part").agg(F.min(end).alias("first"), F.max(end).alias("last"), F.max("n").alias("most"))
            .orderBy("part").collect())          # one row per partition
    before, carried, open_key, most = [], 0, None, 0
    for r in ends:
        base = carried if r["first"]["key"] == open_key else 0
        if base:
            before.append((r["part"], r["first"]["key"], base))
        carried = r["last"]["n"] + (base if r["first"]["key"] == r["last"]["key"] else 0)
        open_key, most = r["last"]["key"], max(most, r["most"], base + r["first"]["n"], carried)
    known = F.broadcast(spark.createDataFrame(before, "part int, key string, base long"))   # one row per partition
    at = F.col("at") + F.coalesce("base", F.lit(0).cast("long"))
    return numbered.join(known, ["part", "key"], "left").withColumn("pos", at).drop("part", "at", "base"), most


# --- blocks -----------------------------------------------------------------------------

BLOCK_ROW = ("key string, block long, leaves int, above int, done boolean, root binary, nodes binary, "
             "doc_ids array<long>, changed map<int,binary>")
_BLOCK = pa.schema([("key", pa.string()), ("block", pa.int64()), ("leaves", pa.int32()), ("above", pa.int32()),
                    ("done", pa.bool_()), ("root", pa.binary()), ("nodes", pa.binary()),
                    ("doc_ids", pa.list_(pa.int64())), ("changed", pa.map_(pa.int32(), pa.binary()))])


def _build_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block, pos) -> one row per block."""
    now, held, out = None, [], []

    def close():
        leaves = b"".join([x[1] for x in held])
        # Blocks fill in order, so a partial first block is its key's only one and ends with its subroot.
        done = now[1] == 0 and len(held) < BLOCK
        above = levels(len(held)) if done else BLOCK_LEVELS
        nodes = build(leaves, above)
        out.append((now[0], now[1], len(held), above, done, nodes[:32], nodes, [x[0] for x in held],
                    [(i, x[2]) for i, x in enumerate(held) if x[2] is not None]))

    for b in batches:
        for key, block, doc, leaf, changed in zip(*(b.column(c).to_pylist() for c in (
                "key", "block", "doc_id", "leaf", "changed")), strict=True):
            if (key, block) != now:
                if now is not None:
                    close()
                now, held = (key, block), []
            held.append((doc, leaf, changed))
        if len(out) >= 64:
            yield _rows(out, _BLOCK)
            out = []
    if now is not None:
        close()
    yield _rows(out, _BLOCK)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)],
                                      schema=schema)


def blocks(placed: DataFrame) -> DataFrame:
    dealt = placed.withColumn("block", (F.col("pos") / BLOCK).cast("long")).repartition("key", "block")
    rows = dealt.sortWithinPartitions("key", "block", "pos").select("key", "block", *ROW[2:])
    return pinned(arrow_map(rows, _build_blocks, BLOCK_ROW), "merkle-blocks")


def tree(placed: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """Tiers of blocks from the leaves up, and (key, subroot)."""
    tiers = [blocks(placed)]
    while most >= BLOCK:      # a key with a full first block goes on with its blocks' roots
        nodes = tiers[-1].filter(~F.col("done")).select(
            "key", F.col("block").alias("pos"), F.lit(None).cast("long").alias("doc_id"), F.col("root").alias("leaf"),
            F.lit(None).cast("binary").alias("changed"))
        tiers.append(blocks(nodes))
        most = -(-most // BLOCK)
    ends = [t.filter("done").select("key", F.col("root").alias("subroot")) for t in tiers]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return tiers, out


PATH = "array<struct<at:int,run:binary>>"
ABOVE = f"key string, block long, subroot binary, top binary, path {PATH}"
_PATH = pa.list_(pa.struct([("at", pa.int32()), ("run", pa.binary())]))
_ABOVE = pa.schema([("key", pa.string()), ("block", pa.int64()), ("subroot", pa.binary()), ("top", pa.binary()),
                    ("path", _PATH)])


def _paths_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf of an upper block is the root of something below it: its path through the block and on to the top."""
    for b in batches:
        for r in b.to_pylist():
            runs, out = Block(r["nodes"], r["leaves"], r["above"]).runs(), []
            for i in range(r["leaves"]):
                path = [{"at": a, "run": x} for a, x in path_in(i, runs)] + r["path"]
                out.append((r["key"], r["block"] * BLOCK + i, r["subroot"], r["top"], path))
                if len(out) >= 256:
                    yield _rows(out, _ABOVE)
                    out = []
            yield _rows(out, _ABOVE)


def with_paths(tiers: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """The lowest blocks, each with its subroot and the path of its root to the top.

    ``tops`` has (key, top, path) for every key; without it the subroots are the tops.  A key's last block takes its
    row from ``tops``, the blocks below take theirs from the block above: both joins are one to one.
    """
    above = None
    for tier in reversed(tiers):
        ends = tier.filter("done").withColumn("subroot", F.col("root"))
        if tops is None:
            ends = ends.withColumn("top", F.col("root")).withColumn("path", F.array().cast(PATH))
        else:
            ends = ends.join(tops, "key")
        here = ends
        if above is not None:
            here = ends.unionByName(tier.filter(~F.col("done")).join(above, ["key", "block"]))
        if tier is not tiers[0]:
            above = pinned(arrow_map(here, _paths_down, ABOVE), "merkle-paths")
    return here


PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
         "verified boolean")
_PROOF = pa.schema([("doc_id", pa.int64()), *((n, pa.string()) for n in
                    ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every leaf of a block: its proof, and the root that it (or the changed leaf) folds to."""
    for b in batches:
        for r in b.to_pylist():
            block, out = Block(r["nodes"], r["leaves"], r["above"]), []
            runs, leaves, changed = block.runs(), block.level(0), dict(r["changed"] or [])
            higher = [(x["at"], x["run"]) for x in r["path"]]
            beyond, subroot, top = siblings(higher), r["subroot"].hex(), r["top"].hex()
            for i, doc in enumerate(r["doc_ids"]):
                leaf, path = leaves[32 * i:32 * i + 32], path_in(i, runs)
                proof = hashlib.sha256((siblings(path) + beyond).hex().encode()).hexdigest()
                folded = fold(fold(changed.get(i, leaf), path), higher).hex()
                out.append((doc, leaf.hex(), subroot, top, proof, folded, folded == top))
            yield _rows(out, _PROOF)


def stored_tree(df: DataFrame) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """The blocks of the sources' trees by tier, those of the tree over the subroots, and (key, pos) of the subroots.

    ``df`` has the columns of documents.
    """
    rows = pinned(manifest_rows(df), "merkle-leaves")
    placed, most = positions(rows, ["doc_id", "leaf"])
    tiers, subroots = tree(placed, most)
    # The tree over the subroots is that of one key whose rows are ordered by source.
    named = subroots.select(F.lit("").alias("key"), F.col("key").alias("name"), F.lit(None).cast("long").alias("doc_id"),
                            F.col("subroot").alias("leaf"), F.lit(None).cast("binary").alias("changed"))
    ordered, sources = positions(named, ["name"])
    top_tiers, _ = tree(ordered, sources)
    return tiers, top_tiers, ordered.select("name", "pos")


def manifest(df: DataFrame) -> DataFrame:
    """A row per document with its leaf, subroot, root, proof digest and the check of the (tampered) row."""
    tiers, top_tiers, names = stored_tree(df)
    down = arrow_map(with_paths(top_tiers), _paths_down, ABOVE)
    tops = names.join(down, F.col("pos") == F.col("block")).select(F.col("name").alias("key"), "top", "path")
    return arrow_map(with_paths(tiers, pinned(tops, "merkle-tops")), _prove, PROOF)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
