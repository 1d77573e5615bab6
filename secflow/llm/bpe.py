"""Byte-level BPE over a distinct-word table, and its way back.

A word is a stretch of text that starts at a single white-space character after a visible one.
The tokenizer's own pre-tokenizer always starts a new piece there, so the ids of a text are the
ids of its words in order.  Documents are read in blocks of bounded size:

1. every block lists its distinct words; a word's position in the list is its slot;
2. the lists are shuffled in buckets of words, and a bucket's words are encoded by the library,
   each distinct one once;
3. ids go back to their block; the block's documents take them by position (slot numbers).

Decoding looks the ids of each block's words up in the vocabulary's id-to-piece table, a list that is
bounded by the vocabulary and travels with the job (no join), and concatenates the pieces by position.

A word is sent once per block, so a very frequent word is listed once per block, never once per
occurrence, and a bucket's share of words does not depend on how frequent they are.  Both readings
of the documents see the same blocks: ``stable`` pins any input that is not a plain file scan.

Defined cases: null text counts as empty (no tokens); the special token's string in a text is that
token, as in the library; repeated rows are each returned; a null id is kept.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from secflow.llm.common import arrow_map, keyed_text, pinned, slices, table
from secflow.session import ship_package

BLOCK_BYTES = 12 << 20
LONG_WORD = 64
LIBRARY_TEXTS = 1 << 14

# White space in a row (or beside characters that some Unicode versions count as white space).
_SPACE = "[\\s\u180e\u200b\ufeff]"
_RUN = re.compile(_SPACE + _SPACE)
# A word of letters with marks behind it: the pre-tokenizer splits it between the two.  Letters of Latin-1 and ASCII
# marks only (no apostrophe, which may belong to a word, and none of a special token), whatever the Unicode version.
_LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
_MARKS = "".join(c for c in map(chr, range(33, 127)) if re.match(r"[!-&(-;=@\[-`{}~]", c))
_ARROW_RUN = ("[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u180e\u200b\ufeff]{2}")
_START = re.compile(f"(?<!{_SPACE})(?=[ \n])")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def words(text: str) -> list[str]:
    """Keys of the text's words; ``word_of`` gives the text back from a key."""
    if _RUN.search(text):
        return ["\t" + w for w in _START.split(text)]
    keys = text.replace("\n", " \n").split(" ")
    keys[0] = "\t" + keys[0]
    return keys


def word_of(key: str) -> str:
    return key if key[:1] == "\n" else key[1:] if key[:1] == "\t" else " " + key


class Words:
    """Ids of words, in one array: ``at`` numbers the words, word i has ``ids[ends[i - 1]:ends[i]]``."""

    def __init__(self):
        self.at: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def slots(self, keys: list[str]) -> np.ndarray:
        """The number of each key, or -1."""
        return np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))

    def sizes(self) -> np.ndarray:
        return np.diff(self.ends)

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Append new keys; their numbers."""
        n = len(self.ends) - 1
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.at.update(zip(keys, range(n, n + len(keys)), strict=True))
        return np.arange(n, n + len(keys))

    def of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered words, one after the other, and how many each has."""
        sizes = self.sizes()[slots]
        return self.ids[_stretches(self.ends[slots], sizes)], sizes


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each stretch, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _from(texts: pa.Array, start: np.ndarray) -> pa.Array:
    """What each text holds from its byte ``start`` on."""
    if not len(texts):
        return texts
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    both = np.empty(2 * len(texts) + 1, np.int32)
    both[::2], both[1::2] = at, at[:-1] + start
    halves = pa.StringArray.from_buffers(2 * len(texts), pa.py_buffer(both), texts.buffers()[2])
    return halves.take(pa.array(np.arange(1, 2 * len(texts), 2)))


class Encoder:
    """Encodes word keys with the library, each distinct one once while the worker remembers it.

    The last ``limit`` to twice ``limit`` distinct words are remembered, in two generations.
    """

    def __init__(self, path: str, limit: int = 350_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.words, self.old = Words(), Words()
        self.limit = limit
        newline = self.tok.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else None

    @property
    def known(self) -> dict[str, int]:
        return self.words.at

    def _library(self, texts: list[str]) -> list[bytes]:
        out = []
        # The library's answers are many times larger than the ids: few at a time.
        for at in range(0, len(texts), LIBRARY_TEXTS):
            found = self.tok.encode_batch_fast(texts[at:at + LIBRARY_TEXTS], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in found]
        return out

    def encode(self, keys: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each key."""
        return self._library([word_of(k) for k in keys])

    def _letters(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of keys that are letters alone, one after the other, and how many each has.  The library gets many as
        one text, a line each: the line's end is a piece and an id of its own, and no letter has that id."""
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for i in range(0, len(keys), LIBRARY_TEXTS):
            part = keys[i:i + LIBRARY_TEXTS]
            text = "".join(["\n " + k for k in part])
            found = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            line = found == self.newline
            starts = np.flatnonzero(line)
            if len(starts) != len(part):
                raise RuntimeError("the tokenizer does not keep lines apart")
            ids.append(found[~line])
            sizes.append(np.diff(starts, append=len(found)) - 1)
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, keys: list[str], letters: np.ndarray) -> None:
        """Encode and remember new keys; ``letters`` tells which ones are letters alone."""
        joined = letters if self.newline is not None else np.zeros(len(keys), bool)
        plain, other = [keys[i] for i in np.flatnonzero(joined)], [keys[i] for i in np.flatnonzero(~joined)]
        self.words.add(plain, *self._letters(plain))
        found = self.encode(other)
        self.words.add(other, np.frombuffer(b"".join(found), "<u4"),
                       np.fromiter(map(len, found), np.int64, len(found)) // 4)

    def _slots(self, keys: list[str], letters: np.ndarray) -> np.ndarray:
        """Numbers of distinct keys, remembered or new."""
        slots = self.words.slots(keys)
        new = np.flatnonzero(slots < 0)
        before = self.old.slots([keys[i] for i in new])
        held = new[before >= 0]
        slots[held] = self.words.add([keys[i] for i in held], *self.old.of(before[before >= 0]))
        unseen = new[before < 0]
        names = [keys[i] for i in unseen]
        self._learn(names, letters[unseen])
        slots[unseen] = self.words.slots(names)
        return slots

    def _ids(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct keys, one after the other, and how many each has.  Letters that occur with several marks
        are encoded and remembered once, and so are the marks, as words without a space."""
        stems = pc.utf8_rtrim(keys, _MARKS)
        cut, whole = (pc.binary_length(k).to_numpy() for k in (stems, keys))
        marked = pc.match_substring_regex(stems, _LETTERS).to_numpy(zero_copy_only=False) & (cut < whole)
        coded = pc.if_else(pa.array(marked), stems, keys).dictionary_encode()
        marks = _from(keys.filter(pa.array(marked)), cut[marked]).dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ends = ["\t" + m for m in marks.dictionary.to_numpy(zero_copy_only=False).tolist()]
        letters = pc.match_substring_regex(coded.dictionary, _LETTERS).to_numpy(zero_copy_only=False)
        pairs = np.full((len(keys), 2), -1, np.int64)
        pairs[:, 0] = self._slots(names, letters)[coded.indices.to_numpy()]
        pairs[marked, 1] = self._slots(ends, np.zeros(len(ends), bool))[marks.indices.to_numpy()]
        # Number -1 is the empty entry behind the last one.
        sizes = np.append(self.words.sizes(), 0)[pairs]
        ids = self.words.ids[_stretches(self.words.ends[pairs.ravel()], sizes.ravel())]
        long = np.flatnonzero(pc.utf8_length(coded.dictionary).to_numpy() > LONG_WORD)
        for k in [*(names[i] for i in long), *(k for k in ends if len(k) > LONG_WORD)]:
            self.words.at.pop(k, None)
        if len(self.words.ends) > self.limit or len(self.words.ids) > 16 * self.limit:
            self.words, self.old = Words(), self.words
        return ids, sizes.sum(axis=1)

    def texts(self, texts: pa.Array) -> list[memoryview]:
        """Ids of each text (null: none).  Arrow splits the texts and numbers the distinct words."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ARROW_RUN)
        plain = pc.and_(pc.invert(odd), pc.not_equal(texts, ""))
        # As ``words`` does; the first word's mark comes before the text.
        marked = pc.binary_join_element_wise("\t", pc.replace_substring(texts.filter(plain), "\n", " \n"), "")
        split = pc.split_pattern(marked, " ")
        strange = [words(t) for t in texts.filter(odd).to_pylist()]
        n_words = np.zeros(len(texts), np.int64)
        n_words[np.flatnonzero(plain)] = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        n_words[np.flatnonzero(odd)] = [len(k) for k in strange]
        flat = pa.concat_arrays([split.flatten(), pa.array([k for ks in strange for k in ks], pa.string())])
        coded = flat.dictionary_encode()
        pool, sizes = self._ids(coded.dictionary)
        at = coded.indices.to_numpy()
        take = sizes[at]
        ends = np.cumsum(take)
        ids = memoryview(pool[_stretches((np.cumsum(sizes) - sizes)[at], take)].tobytes())
        # The plain texts come first, then the odd ones.
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(odd)])
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_words[order])])].tolist()
        out = [ids[:0]] * len(texts)
        for i, a, b in zip(order.tolist(), cuts, cuts[1:], strict=False):
            out[i] = ids[4 * a:4 * b]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker: its words stay known for the worker's next tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def stable(df: DataFrame) -> DataFrame:
    """``df`` if it only reads files (same partitions each time), else a pinned copy."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    plain = "Scan parquet" in plan and not re.search("Exchange|Join|Aggregate|Sample|Limit|Python|Arrow|RDD", plan)
    return df if plain else pinned(df, "stable")


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, list, list]]:
    """(block id, doc ids, texts) of about ``limit`` text bytes; ids are unique within the table."""
    base, n = TaskContext.get().partitionId() << 24, 0
    ids, texts, size = [], [], 0
    for b in slices(batches, "text", limit):
        ids += b.column("doc_id").to_pylist()
        texts += b.column("text").to_pylist()
        size += b.column("text").nbytes
        if size >= limit:
            yield base + n, ids, texts
            n, ids, texts, size = n + 1, [], [], 0
    if ids:
        yield base + n, ids, texts


ROWS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])
ROW = "bucket int, block long, payload binary"
SLOTS = pa.schema([("block", pa.int64()), ("n_words", pa.int32()), ("doc_id", pa.list_(pa.int64())),
                   ("sizes", pa.list_(pa.int32())), ("slots", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                 ("decoded_sha256", pa.string())])


def frame(*arrays: np.ndarray) -> bytes:
    """Compressed arrays of one payload."""
    sizes = np.array([a.nbytes for a in arrays], dtype="<i8")
    return zstandard.ZstdCompressor(level=1).compress(b"".join([sizes.tobytes(), *(a.tobytes() for a in arrays)]))


def unframe(payload: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(payload)
    ends = np.cumsum(np.frombuffer(raw, "<i8", len(kinds))) + 8 * len(kinds)
    starts = [8 * len(kinds), *ends[:-1].tolist()]
    return [np.frombuffer(raw[a:b], kind) for a, b, kind in zip(starts, ends.tolist(), kinds, strict=True)]


def _distinct_words(n_buckets: int, limit: int):
    """Each block's distinct words by bucket: (slots, bytes per word, words)."""
    def run(batches):
        for block, _, texts in blocks(batches, limit):
            seen: dict[str, None] = {}
            for t in texts:
                if t:
                    seen.update(dict.fromkeys(words(t)))
            keys = [k.encode("utf-8", "surrogatepass") for k in seen]
            bucket = np.fromiter(map(zlib.crc32, keys), np.int64, len(keys)) % n_buckets
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1)).tolist()
            rows = []
            for k in range(n_buckets):
                own = order[cuts[k]:cuts[k + 1]]
                if len(own):
                    part = [keys[i] for i in own.tolist()]
                    rows.append((k, block, frame(own.astype("<i4"), np.array([len(w) for w in part], "<i4"),
                                                 np.frombuffer(b"".join(part), np.uint8))))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], f.type) for c, f in enumerate(ROWS)],
                                             schema=ROWS)
    return run


def _positions(limit: int):
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for block, ids, texts in blocks(batches, limit):
            slot = defaultdict(count().__next__)
            sizes, parts = [], []
            for t in texts:
                keys = words(t) if t else []
                sizes.append(len(keys))
                parts.append(np.fromiter(map(slot.__getitem__, keys), dtype=np.int32, count=len(keys)))
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            planes = flat.view(np.uint8).reshape(-1, 4).T.tobytes()
            yield pa.RecordBatch.from_pylist([{"block": block, "n_words": len(slot), "doc_id": ids,
                                               "sizes": sizes, "slots": pack.compress(planes)}], schema=SLOTS)
    return run


def _encode_words(path: str):
    """Rows sorted by bucket: encode each distinct word of a bucket once, answer every block."""
    def run(batches):
        enc, now, known = encoder(path), None, {}
        for b in batches:
            out = []
            for k, block, payload in zip(*(b.column(c).to_pylist() for c in ROWS.names), strict=True):
                if k != now:
                    now, known = k, {}
                slots, sizes, raw = unframe(payload, "<i4", "<i4", "u1")
                raw, ends = raw.tobytes(), np.cumsum(sizes).tolist()
                keys = [raw[e - n:e].decode("utf-8", "surrogatepass")
                        for e, n in zip(ends, sizes.tolist(), strict=True)]
                new = [w for w in keys if w not in known]
                known.update(zip(new, enc.encode(new), strict=True))
                ids = [known[w] for w in keys]
                out.append((k, block, frame(slots, np.array([len(i) // 4 for i in ids], "<i4"),
                                            np.frombuffer(b"".join(ids), "<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], f.type) for c, f in enumerate(ROWS)],
                                             schema=ROWS)
    return run


def _digest(pieces: list[bytes]):
    """One block: its position row (left) with the ids of its words (right) and their pieces."""
    numbers = [b"%d," % i for i in range(len(pieces))]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise RuntimeError("a block of words has no documents: the input changed between readings")
        row = left.to_pylist()[0]
        n_words = row["n_words"]
        ids, dec, counts = [b""] * n_words, [b""] * n_words, np.full(n_words, -1, dtype=np.int64)
        for payload in right.column("payload").to_pylist():
            slots, n, flat = unframe(payload, "<i4", "<i4", "<u4")
            counts[slots] = n
            text, piece = [numbers[i] for i in flat.tolist()], [pieces[i] for i in flat.tolist()]
            for slot, k, end in zip(slots.tolist(), n.tolist(), np.cumsum(n).tolist(), strict=True):
                ids[slot], dec[slot] = b"".join(text[end - k:end]), b"".join(piece[end - k:end])
        if n_words and counts.min() < 0:
            raise RuntimeError("the input changed between two readings of a block")
        total = sum(row["sizes"])
        planes = zstandard.ZstdDecompressor().decompress(row["slots"], max_output_size=max(1, 4 * total))
        flat = np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()
        out, at = {n: [] for n in OUT.names}, 0
        for doc, n in zip(row["doc_id"], row["sizes"], strict=True):
            mine = flat[at:at + n]
            at += n
            slots = mine.tolist()
            text = b"".join(map(ids.__getitem__, slots))
            decoded = b"".join(map(dec.__getitem__, slots)).decode("utf-8", "replace")
            out["doc_id"].append(doc)
            out["n_tokens"].append(int(counts[mine].sum()) if n else 0)
            out["ids_sha256"].append(hashlib.sha256(text[:-1]).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
        return pa.Table.from_pydict(out, schema=OUT)
    return run


def piece_table(path: str) -> list[bytes]:
    """The bytes of each id, by id: bounded by the vocabulary, not by the data."""
    from tokenizers import Tokenizer

    # Byte-level BPE writes bytes as characters: printable Latin-1 as themselves, the rest from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    tok = Tokenizer.from_file(path)
    special = set(tok.get_added_tokens_decoder())
    vocab = tok.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for t, i in vocab.items():
        out[i] = t.encode() if i in special else bytes(byte[c] for c in t)
    return out


def round_trip(df: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Encode every text and decode it again: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    spark, path = df.sparkSession, tokenizer or default_tokenizer()
    ship_package(spark)
    docs = stable(keyed_text(df, id_col, text_col))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = arrow_map(docs, _distinct_words(n, block_bytes), ROW)
    encoded = arrow_map(listed.repartition("bucket").sortWithinPartitions("bucket"), _encode_words(path), ROW)
    positions = arrow_map(docs, _positions(block_bytes),
                          "block long, n_words int, doc_id array<long>, sizes array<int>, slots binary")
    return positions.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(
        _digest(piece_table(path)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
