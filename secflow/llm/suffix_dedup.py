"""Exact substring deduplication over suffix arrays of shards.

A byte is removed if a string of ``length`` bytes covers it that also starts earlier (a smaller
doc_id, or the same document and an earlier start).  Strings are judged on the input.

Every window of ``length`` bytes is keyed by the smallest hash among its short grams, so equal
windows have equal keys and can meet in one shard.  Documents are read in blocks of bounded size:

1. Each block lists its key grams once; bucket by bucket the grams that occur more than once come
   back, and which documents repeat an earlier one as a whole (all their windows start earlier).
2. Each block cuts out the runs of windows whose key occurs more than once.  A run's equal copies
   inside the block are settled there; the first one goes to its key's bucket.
3. A bucket's shards get a suffix array by induced sorting and permuted common prefixes: suffixes
   that share ``length`` bytes are neighbours, and all but the first owner of such a group are
   removed.  Byte ranges go back to the blocks, which cut their texts.

A gram is sent once per block, so a passage in a third of all documents costs a row per block.
Runs under a gram with more than ``HOT`` occurrences are cut to single windows and dealt by the
window's own hash, which spreads such a gram over all buckets.  All three readings of the
documents see the same blocks (``stable``).

Defined cases: null text counts as empty; texts shorter than ``length`` lose nothing; null ids come
last in the order; rows with equal ids are ordered by their place in the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from secflow.llm.bpe import blocks, stable
from secflow.llm.common import arrow_map, keyed_text, table
from secflow.llm.sais import permuted_lcp, suffix_array
from secflow.llm.shingles import mix, powers
from secflow.session import ship_package

LENGTH, GRAM = 100, 24
BLOCK_BYTES = 6 << 20
CHUNK_BYTES = 1 << 16
SHARD_BYTES = 400_000
RUN_WINDOWS = 256                 # longest run of windows sent as one string
HOT = 10_000
LAST = np.iinfo(np.int64).max     # a null id's place in the order
GAP = 0xFF                        # never a byte of UTF-8

ROWS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
ROW = "bucket int, block long, payload binary"
GRAMS = np.dtype([("gram", "<u8"), ("tag", "<u4"), ("n", "<u4")])
WHOLE = np.dtype([("h0", "<u8"), ("h1", "<u8"), ("doc_id", "<i8"), ("index", "<i4")])
RUN = np.dtype([("gram", "<u8"), ("doc_id", "<i8"), ("index", "<i4"), ("start", "<i4"), ("bytes", "<i4"),
                ("repeats", "<i4")])
RANGE = np.dtype([("index", "<i4"), ("start", "<i4"), ("end", "<i4")])


def _frame(*parts: np.ndarray | bytes) -> bytes:
    """Length-prefixed concatenation of arrays."""
    raw = [p if isinstance(p, bytes) else p.tobytes() for p in parts]
    return np.array([len(r) for r in raw], dtype="<i8").tobytes() + b"".join(raw)


def _unframe(payload: bytes, kinds: list) -> list:
    sizes = np.frombuffer(payload, dtype="<i8", count=len(kinds))
    out, at = [], 8 * len(kinds)
    for kind, n in zip(kinds, sizes.tolist(), strict=True):
        raw = payload[at:at + n]
        out.append(raw if kind is bytes else np.frombuffer(raw, dtype=kind))
        at += n
    return out


def _slide_min(x: np.ndarray, w: int) -> np.ndarray:
    k = 1
    while 2 * k <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:len(x) - (w - k)], x[w - k:]) if k < w else x


class Block:
    """The texts of one block with their window keys and key grams."""

    def __init__(self, ids: list, texts: list[bytes], length: int, gram: int):
        self.length, self.gram = length, gram
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.order = np.array([LAST if i is None else i for i in ids], dtype=np.int64)
        self.raw = b"".join(texts)
        self.texts = texts

    def whole(self) -> np.ndarray:
        out = np.zeros(len(self.texts), dtype=WHOLE)
        for i, t in enumerate(self.texts):
            out[i] = (*np.frombuffer(hashlib.blake2b(t, digest_size=16).digest(), "<u8"), self.order[i], i)
        return out

    def copies(self, whole: np.ndarray) -> np.ndarray:
        """Documents (long enough to matter) that repeat an earlier one of this block."""
        at = np.lexsort((whole["index"], whole["doc_id"], whole["h1"], whole["h0"]))
        w = whole[at]
        same = np.zeros(len(at), dtype=bool)
        same[1:] = (w["h0"][1:] == w["h0"][:-1]) & (w["h1"][1:] == w["h1"][:-1])
        return at[same & (self.sizes[at] >= self.length)]

    def index(self, live: np.ndarray) -> None:
        """Window keys and key grams of the documents in ``live``.

        ``key[s]`` is the key of the window that starts at byte s (valid where ``ok``); ``at`` and
        ``value`` are the key grams' places and hashes.
        """
        n, w = len(self.raw), self.length - self.gram + 1
        data = np.frombuffer(self.raw, dtype=np.uint8)
        self.ok = np.zeros(n, dtype=bool)
        self.key = np.zeros(n, dtype=np.uint64)
        places, values = [], []
        use = [d for d in live.tolist() if self.sizes[d] >= self.length]
        at = 0
        while at < len(use):
            # Neighbouring documents are hashed together; windows across their borders are invalid.
            end = at + 1
            lo = int(self.first[use[at]])
            while end < len(use) and use[end] == use[end - 1] + 1 and self.first[use[end] + 1] - lo <= CHUNK_BYTES:
                end += 1
            hi = int(self.first[use[end - 1] + 1])
            for a, b in self._spans(lo, hi, end - at == 1):
                power, inverse = powers(b - a + 1)
                total = np.zeros(b - a + 1, dtype=np.uint64)
                np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * power[:b - a], dtype=np.uint64, out=total[1:])
                h = mix((total[self.gram:] - total[:-self.gram]) * inverse[:b - a - self.gram + 1])
                key = _slide_min(h, w)
                self.key[a:a + len(key)] = key
                # Borders: a gram or window must not reach into the next document.
                edges = self.first[np.searchsorted(self.first, a, "right"):np.searchsorted(self.first, b, "left")]
                valid = np.ones(len(key), dtype=bool)
                for e in (edges - a).tolist():
                    valid[max(0, e - self.length + 1):e] = False
                self.ok[a:a + len(key)] |= valid
                masked = np.where(valid, key, np.uint64(0))
                padded = np.concatenate([np.zeros(w - 1, np.uint64), masked, np.zeros(w - 1, np.uint64)])
                most = ~_slide_min(~padded, w)
                hit = np.flatnonzero((most == h) & (most > 0))
                places.append(hit + a)
                values.append(h[hit])
            at = end
        self.at = np.concatenate(places) if places else np.zeros(0, np.int64)
        self.value = np.concatenate(values) if values else np.zeros(0, np.uint64)
        if len(self.at):
            self.at, first = np.unique(self.at, return_index=True)
            self.value = self.value[first]

    def _spans(self, lo: int, hi: int, single: bool) -> Iterator[tuple[int, int]]:
        """A long document in overlapping stretches (every window lies in one of them)."""
        if not single or hi - lo <= 2 * CHUNK_BYTES:
            yield lo, hi
            return
        a = lo
        while True:
            b = min(hi, a + CHUNK_BYTES)
            if hi - b < self.length:
                b = hi
            yield a, b
            if b == hi:
                return
            a = b - self.length + 1


def _read(batches, limit: int, length: int, gram: int):
    for block, ids, texts in blocks(batches, limit):
        raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        yield block, Block(ids, raw, length, gram)


def _by_bucket(keys: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (keys % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in range(n):
        if cuts[b] < cuts[b + 1]:
            yield b, order[cuts[b]:cuts[b + 1]]


def _list_grams(n_buckets: int, length: int, gram: int, limit: int):
    def run(batches):
        for block, b in _read(batches, limit, length, gram):
            whole = b.whole()
            copies = b.copies(whole)
            live = np.setdiff1d(np.arange(len(b.texts)), copies)
            b.index(live)
            doc = np.searchsorted(b.first, b.at, "right") - 1
            tags = whole["h0"].astype(np.uint32) | np.uint32(1)
            grams, first, n = np.unique(b.value, return_index=True, return_counts=True)
            entry = np.zeros(len(grams), dtype=GRAMS)
            # Tag 0: more than once in this block; else the text that holds it.
            entry["gram"], entry["n"] = grams, n
            entry["tag"] = np.where(n > 1, np.uint32(0), tags[doc[first]]) if len(grams) else 0
            own = whole[live[b.sizes[live] >= length]]
            by_hash = dict(_by_bucket(own["h0"], n_buckets)) if len(own) else {}
            by_gram = dict(_by_bucket(grams, n_buckets)) if len(grams) else {}
            for k in sorted(by_gram.keys() | by_hash.keys()):
                part = entry[by_gram[k]] if k in by_gram else entry[:0]
                docs = own[by_hash[k]] if k in by_hash else own[:0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([block]), pa.array([_frame(part, docs)], pa.binary())],
                    schema=ROWS)
    return run


def _grouped(batches) -> Iterator[tuple[int, list, list]]:
    """(bucket, blocks, payloads) from rows sorted by bucket."""
    now, own, loads = None, [], []
    for b in batches:
        for k, block, p in zip(*(b.column(c).to_pylist() for c in ROWS.names), strict=True):
            if k != now and own:
                yield now, own, loads
                own, loads = [], []
            now = k
            own.append(block)
            loads.append(p)
    if own:
        yield now, own, loads


def _replies(bucket: int, parts: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket] * len(parts), pa.int32()), pa.array(list(parts), pa.int64()),
             pa.array(list(parts.values()), pa.binary())], schema=ROWS)


def _repeated(hot: int):
    """Grams that occur more than once (bit 0 of ``n``: hot), and documents that repeat another."""
    def run(batches):
        for bucket, own, loads in _grouped(batches):
            parts = [_unframe(p, [GRAMS, WHOLE]) for p in loads]
            g = np.concatenate([p[0] for p in parts])
            block = np.repeat(np.arange(len(own)), [len(p[0]) for p in parts])
            order = np.argsort(g["gram"], kind="stable")
            g, block = g[order], block[order]
            begin = np.flatnonzero(np.concatenate([[True], g["gram"][1:] != g["gram"][:-1]])) if len(g) else \
                np.zeros(0, np.int64)
            size = np.diff(np.append(begin, len(g)))
            if len(g):
                low = np.minimum.reduceat(g["tag"], begin)
                more = (low == 0) | (low != np.maximum.reduceat(g["tag"], begin))
                total = np.add.reduceat(g["n"].astype(np.int64), begin)
                flags = np.repeat(more, size)
                heat = np.repeat(total > hot, size).astype(np.uint8)
            w = np.concatenate([p[1] for p in parts])
            wb = np.repeat(np.arange(len(own)), [len(p[1]) for p in parts])
            at = np.lexsort((w["index"], np.array(own)[wb], w["doc_id"], w["h1"], w["h0"]))
            later = np.zeros(len(at), dtype=bool)
            later[1:] = (w["h0"][at][1:] == w["h0"][at][:-1]) & (w["h1"][at][1:] == w["h1"][at][:-1])
            copy, copy_block = w["index"][at[later]], wb[at[later]]
            out = {}
            for i, b in enumerate(own):
                mine = np.flatnonzero((block == i) & flags) if len(g) else np.zeros(0, np.int64)
                texts = copy[copy_block == i]
                if len(mine) or len(texts):
                    out[b] = _frame(g["gram"][mine], heat[mine] if len(g) else np.zeros(0, np.uint8), texts)
            yield from _replies(bucket, out)
    return run


def _pack_texts(limit: int):
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                        ("raw", pa.binary())])

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for block, ids, texts in blocks(batches, limit):
            raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([[len(r) for r in raw]], pa.list_(pa.int32())),
                 pa.array([pack.compress(b"".join(raw))], pa.binary())], schema=schema)
    return run


def _unpack(left: pa.Table) -> tuple[int, list, list[bytes]]:
    if not left.num_rows:
        raise RuntimeError("the input changed between two readings of a block")
    r = left.to_pylist()[0]
    raw = zstandard.ZstdDecompressor().decompress(r["raw"], max_output_size=max(1, sum(r["sizes"])))
    ends = np.cumsum(r["sizes"]).tolist()
    return r["block"], r["doc_id"], [raw[e - n:e] for e, n in zip(ends, r["sizes"], strict=True)]


def _pieces(begin: np.ndarray, n: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of at most ``RUN_WINDOWS`` windows; single windows where hot."""
    most = np.where(hot, 1, RUN_WINDOWS)
    parts = -(-n // most)
    of = np.repeat(np.arange(len(n)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    return begin[of] + nth * most[of], np.minimum(most[of], n[of] - nth * most[of]), hot[of]


def _send_runs(n_buckets: int, length: int, gram: int):
    """One block with its repeated grams: runs for the buckets, byte ranges settled here."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, ids, texts = _unpack(left)
        b = Block(ids, texts, length, gram)
        parts = [_unframe(p, ["<u8", np.uint8, "<i4"]) for p in right.column("payload").to_pylist()]
        many = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
        heat = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint8)
        order = np.argsort(many)
        many, heat = many[order], heat[order] > 0
        copies = np.union1d(b.copies(b.whole()), np.concatenate([p[2] for p in parts]) if parts else []).astype(int)
        ranges = [(d, 0, int(b.sizes[d])) for d in copies.tolist()]
        b.index(np.setdiff1d(np.arange(len(texts)), copies))
        found: dict[int, list] = {}
        if len(many):
            # Runs of one key, found with a byte per position beside the keys.
            cut = b.ok[1:] & b.ok[:-1] & (b.key[1:] == b.key[:-1])
            begin, last = b.ok.copy(), b.ok.copy()
            begin[1:] &= ~cut
            last[:-1] &= ~cut
            begin, last = np.flatnonzero(begin), np.flatnonzero(last)
            if len(begin):
                n = last - begin + 1
                del cut, last
                slot = np.minimum(np.searchsorted(many, b.key[begin]), len(many) - 1)
                known = many[slot] == b.key[begin]
                begin, n, hot = begin[known], n[known], heat[slot[known]]
                begin, n, hot = _pieces(begin, n, hot)
                owner = np.searchsorted(b.first, begin, "right") - 1
                by_owner = np.lexsort((begin, owner, b.order[owner]))
                seen: set[bytes] = set()
                raw = b.raw
                for i in by_owner.tolist():
                    s, size, d = int(begin[i]), int(n[i]) + length - 1, int(owner[i])
                    text = raw[s:s + size]
                    if text in seen:
                        ranges.append((d, s - int(b.first[d]), s - int(b.first[d]) + size))
                        continue
                    seen.add(text)
                    g = int(b.key[s])
                    bucket = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little") if \
                        hot[i] else g
                    # The key gram again inside the run: windows may repeat within it.
                    lo, hi = np.searchsorted(b.at, (s, s + size - gram + 1))
                    again = int((b.value[lo:hi] == np.uint64(g)).sum() > 1)
                    found.setdefault(bucket % n_buckets, []).append(
                        ((g, b.order[d], d, s - int(b.first[d]), size, again), text))
        rows = [(k, _frame(np.array([x[0] for x in v], dtype=RUN), b"".join(x[1] for x in v), np.zeros(0, RANGE)))
                for k, v in found.items()]
        if ranges:
            rows.append((block % n_buckets, _frame(np.zeros(0, RUN), b"", np.array(ranges, dtype=RANGE))))
        pack = zstandard.ZstdCompressor(level=1)
        return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                     pa.array([block] * len(rows), pa.int64()),
                                     pa.array([pack.compress(r[1]) for r in rows], pa.binary())], schema=ROWS)
    return run


def later_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For texts in owner order, the window starts of each whose string starts earlier already."""
    data = np.frombuffer(bytes([GAP]).join([*texts, b""]), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    sa = suffix_array(data, 256)
    common = permuted_lcp(data, sa, length)
    # Position order is owner order, then start: the smallest position of a group stays.
    ends = np.repeat(first + sizes, sizes + 1)
    valid = np.arange(len(data)) + length <= ends
    group = np.cumsum(common[sa] < length)
    keep = valid[sa]
    group, pos = group[keep], sa[keep]
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    least = np.repeat(np.minimum.reduceat(pos, begin), np.diff(np.append(begin, len(pos)))) if len(pos) else pos
    late = np.sort(pos[pos != least])
    cuts = np.searchsorted(late, np.append(first, len(data)))
    return [late[a:b] - f for a, b, f in zip(cuts[:-1], cuts[1:], first, strict=True)]


def _covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged byte ranges of windows."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    lo, hi = starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + length
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


def _shards(length: int):
    def run(batches):
        for bucket, own, loads in _grouped(batches):
            raw = zstandard.ZstdDecompressor()
            parts = [_unframe(raw.decompressobj().decompress(p), [RUN, bytes, RANGE]) for p in loads]
            out = {b: [] for b in dict.fromkeys(own)}
            for b, p in zip(own, parts, strict=True):
                out[b] += p[2].tolist()
            runs = np.concatenate([p[0] for p in parts])
            block = np.repeat(np.array(own, dtype=np.int64), [len(p[0]) for p in parts])
            text = []
            for r, raw_text, _ in parts:
                ends = np.cumsum(r["bytes"]).tolist()
                text += [raw_text[e - n:e] for e, n in zip(ends, r["bytes"].tolist(), strict=True)]
            order = np.lexsort((runs["start"], runs["index"], block, runs["doc_id"]))
            # Equal runs: the first owner keeps its run for the suffix array, the others are covered.
            firsts: dict[bytes, int] = {}
            for i in order.tolist():
                if text[i] in firsts:
                    r = runs[i]
                    out[int(block[i])].append((int(r["index"]), int(r["start"]), int(r["start"] + r["bytes"])))
                else:
                    firsts[text[i]] = i
            left = np.array(list(firsts.values()), dtype=np.int64)
            if len(left):
                # A gram's only run, or different single windows, can hold no further match.
                _, group, size = np.unique(runs["gram"][left], return_inverse=True, return_counts=True)
                longest = np.zeros(len(size), dtype=np.int64)
                np.maximum.at(longest, group, runs["bytes"][left])
                left = left[(longest[group] > length) & ((size[group] > 1) | (runs["repeats"][left] > 0))]
            # Shards hold whole grams; inside, owners in order.
            rank = np.empty(len(text), dtype=np.int64)
            rank[order] = np.arange(len(text))
            left = left[np.lexsort((rank[left], runs["gram"][left]))]
            at = 0
            while at < len(left):
                end, size = at, 0
                while end < len(left) and (size < SHARD_BYTES or
                                           runs["gram"][left[end]] == runs["gram"][left[end - 1]]):
                    size += int(runs["bytes"][left[end]])
                    end += 1
                shard = left[at:end][np.argsort(rank[left[at:end]])]
                for i, starts in zip(shard.tolist(), later_windows([text[i] for i in shard.tolist()], length),
                                     strict=True):
                    base = int(runs["start"][i])
                    out[int(block[i])] += [(int(runs["index"][i]), base + lo, base + hi)
                                           for lo, hi in _covered(starts, length)]
                at = end
            yield from _replies(bucket, {b: np.array(v, dtype=RANGE).tobytes() for b, v in out.items() if v})
    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                    ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def _cut(with_text: bool):
    schema = RESULT if with_text else pa.schema(list(RESULT)[:5])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        _, ids, texts = _unpack(left)
        loads = [np.frombuffer(p, dtype=RANGE) for p in right.column("payload").to_pylist()]
        r = np.concatenate(loads) if loads else np.zeros(0, RANGE)
        r = r[np.lexsort((r["start"], r["index"]))]
        cuts = np.searchsorted(r["index"], np.arange(len(texts) + 1))
        out = {n: [] for n in schema.names}
        for i, (doc, t) in enumerate(zip(ids, texts, strict=True)):
            kept, at, spans, removed = [], 0, 0, 0
            own = r[cuts[i]:cuts[i + 1]]
            for lo, hi in zip(own["start"].tolist(), own["end"].tolist(), strict=True):
                if spans and lo <= at:
                    removed += max(0, hi - at)
                    at = max(at, hi)
                    continue
                kept.append(t[at:lo])
                spans, removed, at = spans + 1, removed + hi - lo, hi
            kept.append(t[at:])
            rest = b"".join(kept)
            # A character that lost some of its bytes goes whole.
            row = (doc, len(t), removed, spans, hashlib.sha256(rest).hexdigest(),
                   rest.decode("utf-8", "ignore") if with_text else "")
            for n, v in zip(schema.names, row, strict=False):
                out[n].append(v)
        return pa.Table.from_pydict(out, schema=schema)
    return run


def deduplicate(df: DataFrame, length: int = LENGTH, with_text: bool = False, id_col: str = "doc_id",
                text_col: str = "text", gram: int = GRAM, block_bytes: int = BLOCK_BYTES, hot: int = HOT,
                buckets: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256 [, kept_text]) for every row."""
    spark = df.sparkSession
    ship_package(spark)
    docs = stable(keyed_text(df, id_col, text_col))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    grams = arrow_map(docs, _list_grams(n, length, gram, block_bytes), ROW)
    repeated = arrow_map(grams.repartition("bucket").sortWithinPartitions("bucket"), _repeated(hot), ROW)
    texts = arrow_map(docs, _pack_texts(block_bytes), "block long, doc_id array<long>, sizes array<int>, raw binary")
    runs = texts.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(
        _send_runs(n, length, gram), ROW)
    ranges = arrow_map(runs.repartition("bucket").sortWithinPartitions("bucket"), _shards(length), ROW)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return texts.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(
        _cut(with_text), schema + ", kept_text string" * with_text)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))
