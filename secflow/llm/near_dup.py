"""MinHash near-duplicates with odd sketches.

Each text becomes a set of shingle hashes, a MinHash sample of it and an odd sketch: the samples
folded into a parity bitmap.  Texts with equal sets form one node.  Nodes that agree on a band of
samples meet in its bucket.  A pair's similarity is estimated from the population count of the XOR
of its sketches, and pairs that are not clearly too far apart are confirmed on their full sets.

No bucket emits all its pairs.  First every node of a bucket meets the bucket's smallest node, its
hub; confirmed links give components.  Then the nodes that share a hub are one group, and only
groups that hold several components go on: their nodes outside the group's largest component
(outliers) are held, block by block, as an inverted index, and the group's other nodes stream past
it.  Only links come out.  Afterwards every pair of a bucket either lies in one component or has
been judged, so components equal those of all candidate pairs.  A pair at the threshold misses all
bands with probability below 5e-8.

Defined cases: null text or text without words has an empty set, is linked with nothing and is
kept; fewer words than a shingle make one shingle of the whole; equal texts are one node; rows
that share an id but differ in text are separate nodes; a null id becomes a component's id only if
all its ids are null, and ``kept`` compares ids null-safely.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secflow.llm.common import arrow_map, keyed_text, pinned, slices, table
from secflow.llm.components import stars
from secflow.llm.shingles import mix, shingle_hashes, word_hashes

SAMPLES, ROWS = 128, 4                    # 32 bands of 4 samples
SKETCH_BITS = 512
MARGIN = 0.2                              # about five standard deviations of the estimate
SLICE_BYTES = 1 << 20
CLASS_ROWS = 512                          # members confirmed against one hub in one group
OUTLIER_ROWS, MEMBER_ROWS = 512, 4096     # of one group in one task
NO_ID = -(1 << 63)

SIGNED = "doc_id long, n_shingles long, node binary, bands array<long>, sketch array<long>"
SIGNED_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
                           ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])


def _params(samples: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2024)
    return (rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, samples, dtype=np.uint64))


def min_hashes(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    best = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(shingles), 2048):
        np.minimum(best, (shingles[lo:lo + 2048, None] * a + b).min(0), out=best)
    return best


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity of the samples that hash to each bit, as 64-bit words."""
    at = (mix(samples ^ mix(np.arange(len(samples), dtype=np.uint64) + np.uint64(1))) % np.uint64(bits))
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def most_odd_bits(threshold: float, margin: float = MARGIN, samples: int = SAMPLES,
                  bits: int = SKETCH_BITS) -> int:
    """The XOR population count expected at ``threshold - margin``; pairs above it are too far apart."""
    differing = 2 * samples * (1 - max(0.0, threshold - margin))
    return math.ceil(bits / 2 * (1 - (1 - 2 / bits) ** differing))


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _sets(b: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in b.column("text").to_pylist()]
    words, first = word_hashes(texts)
    for i in range(len(texts)):
        yield np.unique(shingle_hashes(words[first[i]:first[i + 1]], size))


def _sign(size: int):
    a, b_ = _params(SAMPLES)
    salt = mix(np.arange(SAMPLES // ROWS, dtype=np.uint64) + np.uint64(77))

    def run(batches):
        for b in slices(batches, "text", SLICE_BYTES):
            n, nodes, bands, sketches = [], [], [], []
            for s in _sets(b, size):
                n.append(len(s))
                if not len(s):
                    for x in (nodes, bands, sketches):
                        x.append(None)
                    continue
                low = min_hashes(s, a, b_)
                key = salt.copy()
                for r in low.reshape(-1, ROWS).T:
                    key = mix(key * np.uint64(31) + r)
                nodes.append(set_key(s))
                bands.append(key.view(np.int64))
                sketches.append(odd_sketch(low))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                schema=SIGNED_SCHEMA)
    return run


def _xor_count(x: str, y: str) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0),
                       lambda s, v: s + v)


def _close(pairs: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """Pairs (u, v) whose odd sketches allow the threshold, with both nodes' ids of a document that has them."""
    def side(x):
        return nodes.select(F.col("node").alias(x), F.col("sketch").alias("s" + x), F.col("rep").alias("rep_" + x))
    return (pairs.join(side("u"), "u").join(side("v"), "v").filter(_xor_count("su", "sv") <= limit)
            .select("u", "v", "rep_u", "rep_v"))


MEMBER = "v binary, class long, kind int, node binary, label binary, sketch array<long>, shingles binary"
MEMBER_SCHEMA = pa.schema([("v", pa.binary()), ("class", pa.int64()), ("kind", pa.int32()), ("node", pa.binary()),
                           ("label", pa.binary()), ("sketch", pa.list_(pa.int64())), ("shingles", pa.binary())])
LINK_SCHEMA = pa.schema([("u", pa.binary()), ("v", pa.binary())])


def _members(size: int):
    """Send each needed text's set to the groups that ask for it."""
    def run(batches):
        for b in slices(batches, "text", SLICE_BYTES):
            for asked, s in zip(b.column("asked").to_pylist(), _sets(b, size), strict=True):
                key, raw = set_key(s), s.tobytes()
                # Another text under the same id is another node.
                mine = [x for x in asked if x["node"] == key]
                for lo in range(0, len(mine), 64):
                    part = mine[lo:lo + 64]
                    yield pa.RecordBatch.from_pydict(
                        {n: [x[n] for x in part] if n != "shingles" else [raw] * len(part)
                         for n in MEMBER_SCHEMA.names}, schema=MEMBER_SCHEMA)
    return run


def _confirm(percent: int):
    """Each group's hub (kind 0) against its members: links that reach the threshold."""
    def run(batches):
        at, hub = None, None
        for b in batches:
            us, vs = [], []
            for v, c, kind, node, raw in zip(*(b.column(n).to_pylist() for n in
                                               ("v", "class", "kind", "node", "shingles")), strict=True):
                if kind == 0:
                    at, hub = (v, c), np.frombuffer(raw, dtype=np.uint64)
                    continue
                if at != (v, c):
                    raise RuntimeError("a group's hub is missing")
                own = np.frombuffer(raw, dtype=np.uint64)
                if len(own) and len(hub):
                    pos = np.minimum(np.searchsorted(hub, own), len(hub) - 1)
                    both = int((hub[pos] == own).sum())
                    if 100 * both >= percent * (len(own) + len(hub) - both):
                        us.append(node)
                        vs.append(v)
            yield pa.RecordBatch.from_pydict({"u": us, "v": vs}, schema=LINK_SCHEMA)
    return run


class _Outliers:
    """The outliers of one group block: sketches, labels and an inverted index of their shingles."""

    def __init__(self, rows: list[tuple]):
        self.nodes, self.labels = [r[0] for r in rows], [r[1] for r in rows]
        self.sketch = np.array([r[2] for r in rows], dtype=np.int64).reshape(len(rows), -1).view(np.uint64)
        sets = [np.frombuffer(r[3], dtype=np.uint64) for r in rows]
        self.size = np.array([len(x) for x in sets])
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.known, self.first, n = np.unique(flat[order], return_index=True, return_counts=True)
        self.last = self.first + n

    def links(self, label: bytes, sketch: list[int], raw: bytes, percent: int, limit: int) -> list[int]:
        """Outliers of other components that reach the threshold with a member."""
        far = np.bitwise_count(self.sketch ^ np.array(sketch, dtype=np.int64).view(np.uint64)).sum(1) > limit
        if far.all():
            return []
        own = np.frombuffer(raw, dtype=np.uint64)
        pos = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        pos = pos[self.known[pos] == own]
        lo, n = self.first[pos], self.last[pos] - self.first[pos]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.size))
        good = ~far & (100 * both >= percent * (len(own) + self.size - both))
        return [i for i in np.flatnonzero(good).tolist() if self.labels[i] != label]


def _compare(percent: int, limit: int):
    """Outliers (kind 0) of a group block against its members: one link per pair of components."""
    def run(batches):
        at, rows, held, seen = None, [], None, set()
        for b in batches:
            us, vs = [], []
            for v, c, kind, node, label, sketch, raw in zip(*(b.column(n).to_pylist() for n in MEMBER_SCHEMA.names),
                                                            strict=True):
                if at != (v, c):
                    at, rows, held, seen = (v, c), [], None, set()
                if kind == 0:
                    rows.append((node, label, sketch, raw))
                    continue
                if held is None:
                    held, rows = _Outliers(rows), []
                for i in held.links(label, sketch, raw, percent, limit):
                    if (label, held.labels[i]) not in seen:
                        seen.add((label, held.labels[i]))
                        us.append(node)
                        vs.append(held.nodes[i])
            yield pa.RecordBatch.from_pydict({"u": us, "v": vs}, schema=LINK_SCHEMA)
    return run


def _with_sets(asked: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Rows (v, class, kind, node, label, sketch, rep) with the nodes' sets, grouped by (v, class).

    A node's set is computed from the text of one document that has it, ``rep``.  What is asked of a text is dealt by
    the document's id and listed in parts, so a text that very many groups ask for makes no single long row.
    """
    by_text = (asked.withColumn("rep", F.coalesce("rep", F.lit(NO_ID))).repartition("rep")
               .withColumn("part", F.pmod(F.xxhash64("v", "class"), F.lit(64)))
               .groupBy("rep", "part")
               .agg(F.collect_list(F.struct("v", "class", "kind", "node", "label", "sketch")).alias("asked"))
               .drop("part"))
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("rep"), "text").join(by_text, "rep")
    sets = arrow_map(texts.select("text", "asked"), _members(size), MEMBER)
    return sets.repartition("v", "class").sortWithinPartitions("v", "class", "kind")


def _confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int, limit: int) -> DataFrame:
    """Pairs (u, v) that reach the threshold on their full sets.

    v is the hub of its pairs.  A hub's pairs are dealt to classes of about ``CLASS_ROWS`` members,
    each with its own copy of the hub's set, so a hub with very many members fills many groups.
    """
    ways = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("v")) / CLASS_ROWS)
    dealt = _close(pairs, nodes, limit).withColumn("class", F.pmod(F.xxhash64("u"), ways).cast("long"))
    dealt = dealt.withColumn("at", F.row_number().over(Window.partitionBy("v", "class").orderBy("u")))

    def row(kind, node):
        return F.struct("v", "class", F.lit(kind).alias("kind"), F.col(node).alias("node"),
                        F.lit(None).cast("binary").alias("label"), F.lit(None).cast("array<long>").alias("sketch"),
                        F.col("rep_" + node).alias("rep"))
    member, hub = row(1, "u"), row(0, "v")
    asked = dealt.select(F.inline(F.when(F.col("at") == 1, F.array(hub, member)).otherwise(F.array(member))))
    return arrow_map(_with_sets(asked, docs, size), _confirm(percent), "u binary, v binary")


def _across(met: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int,
            limit: int) -> DataFrame:
    """Links between components inside the groups of nodes that share a hub (a link may come from several blocks).

    ``labels`` are the stars (u, v) found so far; other nodes are components of their own.
    """
    group = met.select(F.col("u").alias("node"), "v").union(
        met.select(F.col("v").alias("node"), "v").distinct())
    group = group.join(nodes.select("node", "rep", "sketch"), "node").join(
        labels.select(F.col("u").alias("node"), F.col("v").alias("label")), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    whole, kin = Window.partitionBy("v"), Window.partitionBy("v", "label")
    rows = group.repartition("v").withColumn("kin", F.count(F.lit(1)).over(kin)).withColumns({
        "most": F.max(F.struct("kin", "label")).over(whole), "n": F.count(F.lit(1)).over(whole)}) \
        .filter(F.col("most.kin") < F.col("n"))
    rows = rows.withColumns({"m_blocks": F.ceil(F.col("n") / MEMBER_ROWS),
                             "o_blocks": F.ceil((F.col("n") - F.col("most.kin")) / OUTLIER_ROWS)})
    rows = rows.withColumns({"m": F.pmod(F.xxhash64("node"), F.col("m_blocks")),
                             "o": F.pmod(F.xxhash64("node"), F.col("o_blocks"))})

    def blocks(kind, other, block):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col(other + "_blocks") - 1), lambda x: F.struct(
            block(x).cast("long").alias("class"), F.lit(kind).alias("kind")))
    outlier = blocks(0, "m", lambda m: F.col("o") * F.col("m_blocks") + m)
    member = blocks(1, "o", lambda o: o * F.col("m_blocks") + F.col("m"))
    at = F.explode(F.when(F.col("label") != F.col("most.label"), F.concat(outlier, member)).otherwise(member))
    asked = rows.withColumn("at", at).select("v", "at.class", "at.kind", "node", "label", "sketch", "rep")
    return arrow_map(_with_sets(asked, docs, size), _compare(percent, limit), "u binary, v binary")


def near_duplicates(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    docs = keyed_text(df, id_col, text_col)
    signed = pinned(arrow_map(docs, _sign(size), SIGNED), "near-signed")
    limit = most_odd_bits(percent / 100)
    nodes = pinned(signed.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"),
        F.any_value("sketch").alias("sketch")), "near-nodes")

    rows = nodes.select("node", F.explode("bands").alias("band"))
    hub = F.min("node").over(Window.partitionBy("band"))
    met = pinned(rows.withColumn("v", hub).filter(F.col("node") != F.col("v"))
                 .select(F.col("node").alias("u"), "v").distinct(), "near-met")
    links = pinned(_confirmed(met, nodes, docs, size, percent, limit), "near-links")
    labels = stars(links, "near-components")
    more = pinned(_across(met, labels, nodes, docs, size, percent, limit), "near-links")
    # The stars found so far stand for the links they came from.
    labels = stars(labels.union(more), "near-components")

    named = nodes.select("node", "rep").join(labels.select(F.col("u").alias("node"), F.col("v").alias("label")),
                                             "node", "left").select(
        "node", "rep", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_node = named.join(least, "label").select("node", "component_id")
    lone = signed.filter(F.col("node").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    joined = signed.select("doc_id", "n_shingles", "node").join(of_node, "node").select(
        "doc_id", "n_shingles", "component_id")
    return joined.union(lone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's four-word shingles at 80 of 100."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)
