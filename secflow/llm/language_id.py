"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram is bound from its letters' vectors,
each permuted (rotated) by its place: rot2(a) * rot1(b) * c.  A document's profile bundles (adds)
its trigram vectors; a language's prototype bundles the unit profiles of its training documents.
The prediction is the prototype with the highest cosine.

Letters are lower-cased; every run of other characters is one word border.  Letter vectors are
kept for ``SYMBOLS`` symbols: a-z and the letters of Latin-1 have their own, other letters share
the remaining ones by code point.

Training sums are taken over integers (unit profiles scaled by 2**20), so prototypes do not depend
on the partitioning.  Only prototypes (languages x dimensions) reach the driver.

Defined cases: null text, or text without a letter, gives ``und`` with score 0; without training
data every row is ``und``; an exact tie goes to the alphabetically first language; repeated rows
are each predicted; a null id is kept and counts as not held out.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm.common import arrow_map, slices, table

DIM = 1024
SYMBOLS = 128
SCALE = 1 << 20
SLICE_BYTES = 1 << 20
KNOWN_GRAMS = 40_000


class Profiler:
    """Turns texts into profiles; keeps the vectors of the trigrams it has met."""

    def __init__(self, dim: int = DIM, seed: int = 11):
        rng = np.random.default_rng(seed)
        letters = rng.choice(np.array([-1, 1], dtype=np.int8), size=(SYMBOLS, dim))
        self.first, self.second, self.third = np.roll(letters, 2, 1), np.roll(letters, 1, 1), letters
        self.symbol = np.zeros(0x110000, dtype=np.uint8)
        own = 1
        for cp in range(0x110000):
            if unicodedata.category(chr(cp))[0] == "L":
                if cp < 256 and chr(cp).lower() == chr(cp):
                    self.symbol[cp] = own
                    own += 1
                else:
                    self.symbol[cp] = 70 + cp % (SYMBOLS - 70)
        self.slot = np.full(SYMBOLS ** 3, -1, dtype=np.int32)
        self.vectors = np.zeros((1024, dim), dtype=np.int8)
        self.met = 0
        self.kinds = 0                                     # different trigrams of the last profile

    def _learn(self, grams: np.ndarray) -> None:
        if self.met + len(grams) > KNOWN_GRAMS:
            self.slot[:] = -1
            self.met = 0
        need = self.met + len(grams)
        if need > len(self.vectors):
            grown = np.zeros((2 * need, self.vectors.shape[1]), dtype=np.int8)
            grown[:self.met] = self.vectors[:self.met]
            self.vectors = grown
        a, b, c = grams >> 14, grams >> 7 & 127, grams & 127
        self.vectors[self.met:need] = self.first[a] * self.second[b] * self.third[c]
        self.slot[grams] = np.arange(self.met, need)
        self.met = need

    def profiles(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        """The bundle (float32) of each text; None without a letter."""
        low = [" " + t.lower() if t else " " for t in texts]
        ends = np.cumsum([len(t) for t in low])
        codes = np.frombuffer("".join([*low, " "]).encode("utf-32-le", "replace"), dtype=np.uint32)
        symbols = self.symbol[codes]
        keep = symbols > 0
        keep[1:] |= symbols[:-1] > 0
        starts = np.concatenate([[0], ends[:-1]])
        keep[starts] = True
        at = np.concatenate([[0], np.cumsum(keep)])
        symbols = symbols[keep].astype(np.int32)
        if len(symbols) > 2:
            grams = symbols[:-2] << 14 | symbols[1:-1] << 7 | symbols[2:]
        else:
            grams = np.zeros(0, np.int32)
        lo, hi = at[starts], at[ends]
        for i in range(len(texts)):
            # From the border before the first letter to the border after the last one.
            own = grams[lo[i]:max(lo[i], min(hi[i], len(symbols)) - 1)]
            own = own[(own >> 7 & 127) + (own & 127) > 0]
            if not len(own):
                yield None
                continue
            slots = self.slot[own]
            if slots.min() < 0:
                new = np.unique(own[slots < 0])
                if self.met + len(new) > KNOWN_GRAMS:
                    new = np.unique(own)
                if len(new) > KNOWN_GRAMS:
                    self.kinds = len(new)
                    yield self._direct(own)
                    continue
                self._learn(new)
                slots = self.slot[own]
            n = np.bincount(slots)
            used = np.flatnonzero(n)
            self.kinds = len(used)
            yield n[used].astype(np.float32) @ self.vectors[used].astype(np.float32)

    def _direct(self, grams: np.ndarray) -> np.ndarray:
        total = np.zeros(self.first.shape[1], dtype=np.float64)
        kinds, n = np.unique(grams, return_counts=True)
        for lo in range(0, len(kinds), 4096):
            g = kinds[lo:lo + 4096]
            v = self.first[g >> 14] * self.second[g >> 7 & 127] * self.third[g & 127]
            total += n[lo:lo + 4096].astype(np.float64) @ v
        return total.astype(np.float32)


_PROFILERS: dict[int, Profiler] = {}


def profiler(dim: int) -> Profiler:
    if dim not in _PROFILERS:
        _PROFILERS[dim] = Profiler(dim)
    return _PROFILERS[dim]


SUMS = pa.schema([("lang", pa.string()), ("total", pa.list_(pa.int64()))])


def _bundles(dim: int):
    def run(batches):
        p, sums = profiler(dim), {}
        for b in slices(batches, "text", SLICE_BYTES):
            for lang, v in zip(b.column("lang").to_pylist(), p.profiles(b.column("text").to_pylist()), strict=True):
                if v is None:
                    continue
                unit = np.rint(v.astype(np.float64) / np.sqrt(float(v @ v)) * SCALE).astype(np.int64)
                if lang in sums:
                    sums[lang] += unit
                else:
                    sums[lang] = unit
            if len(sums) > 1000:
                yield pa.RecordBatch.from_pydict({"lang": list(sums), "total": list(sums.values())}, schema=SUMS)
                sums = {}
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "total": list(sums.values())}, schema=SUMS)
    return run


def train(df: DataFrame, dim: int = DIM) -> dict[str, np.ndarray]:
    """Unit prototypes from rows (text, lang); rows without lang teach nothing."""
    parts = arrow_map(df.select("text", "lang").filter(F.col("lang").isNotNull()), _bundles(dim),
                      "lang string, total array<long>")
    sums = (parts.select("lang", F.posexplode("total").alias("at", "v"))
            .groupBy("lang", "at").agg(F.sum("v").alias("v"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("total"))
            .select("lang", F.col("total.v").alias("total")))
    out = {}
    for r in sums.collect():                      # languages x dimensions
        v = np.array(r["total"], dtype=np.float64)
        if norm := float(np.sqrt(v @ v)):
            out[r["lang"]] = v / norm
    return out


def _predictor(prototypes: dict[str, np.ndarray], dim: int, columns: list[str]):
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]).astype(np.float64) if names else None

    def run(batches):
        p = profiler(dim)
        for b in slices(batches, "text", SLICE_BYTES):
            langs, scores, kinds = [], [], []
            for v in p.profiles(b.column("text").to_pylist()):
                if v is None or matrix is None:
                    langs.append("und")
                    scores.append(0.0)
                    kinds.append(0 if v is None else p.kinds)
                    continue
                kinds.append(p.kinds)
                cos = matrix @ v.astype(np.float64)
                norm = float(np.sqrt(v.astype(np.float64) @ v.astype(np.float64)))
                best = int(cos.argmax())
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cos[best]) / norm)) if norm else 0.0)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in columns] + [pa.array(langs, pa.string()),
                                                                              pa.array(scores, pa.float64()),
                                                                              pa.array(kinds, pa.int32())],
                                             names=[*columns, "lang_pred", "score", "trigrams"])
    return run


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str], dim: int = DIM) -> DataFrame:
    """``keep`` columns of ``df`` with lang_pred, score and the number of different trigrams, from column ``text`` alone."""
    src = df.select(*[F.col(f"`{c}`") for c in keep if c != "text"], F.col("text").cast("string").alias("text"))
    kept = [c for c in src.columns if c in keep]
    schema = ", ".join(f"`{c}` {t}" for c, t in src.dtypes if c in keep)
    return arrow_map(src, _predictor(prototypes, dim, kept), f"{schema}, lang_pred string, score double, trigrams int")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Train on the rows that are not held out, predict all rows."""
    prototypes = train(docs.filter(~held_out()))
    return predict(docs, prototypes, keep)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
