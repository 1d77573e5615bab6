"""License scans: MinHash bands over overlapping windows, verified by exact shingle containment.

Texts and templates are lower-cased words (runs of ASCII letters and digits and of non-ASCII
characters).  Templates of about the same number of shingles form a class.  A text is cut into
blocks of half the class size; a window is three neighbouring blocks, so each occurrence lies
inside a window.  A template that keeps 80 % of its shingles then has a known least Jaccard
similarity J with its window, and the class gets as many bands (one MinHash sample each) as make a
miss, (1 - J)^bands, less probable than ``MISS``.  Retrieved windows are verified exactly: the share of the
template's shingles found must reach the threshold.  Overlapping verified windows are one match.

Templates shorter than a shingle use their whole sequence as one shingle of their own length.
Templates are a parameter (a bounded list; by default ``TEMPLATES``, short notices and whole licence
texts and headers, of which a few changed words leave more than the threshold); texts are scanned
where they lie, without a shuffle.

Defined cases: null or empty text has no match and no row; repeated rows match alike; a null id is
kept; equal templates under two names both match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from secflow.llm.common import arrow_map, keyed_text, slices, table
from secflow.llm.license_texts import BODIES
from secflow.llm.shingles import shingle_hashes, word_hashes

SHINGLE, CONTAINMENT, MISS = 5, 0.8, 1e-7
SLICE_BYTES = 1 << 20

# Short notices by which texts name their licence.
NOTICES = [
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("All-Rights-Reserved", "All rights reserved."),
]
#: The default: the notices, other usual words of them, and the licences' own texts and headers.
TEMPLATES = [*NOTICES, *BODIES,
             ("MIT", "Released under the terms of the MIT License."), ("MIT", "Licensed under the MIT License."),
             ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.")]

MATCH = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start_word", pa.int64()),
                   ("n_words", pa.int64()), ("containment", pa.float64())])

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([t.encode("utf-8", "replace") for t in texts], _BETWEEN)


class Group:
    """Templates of one shingle length and size class, with each band's samples."""

    def __init__(self, span: int, members: list[tuple[str, np.ndarray, int]], threshold: float):
        self.span = span
        self.names = [m[0] for m in members]
        self.sets = [m[1] for m in members]
        longest = max(m[2] for m in members)
        self.stride = max(1, -(-longest // 2))
        self.blocks = 1 if longest == 1 else 3
        width = self.stride * self.blocks
        least = min(self._jaccard(len(s), width, threshold) for s in self.sets)
        bands = 1 if least >= 1 else math.ceil(math.log(MISS) / math.log(1 - least))
        rng = np.random.default_rng(5)
        self.factors = rng.integers(0, 1 << 63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.samples = np.stack([(s[:, None] * self.factors).min(0) for s in self.sets])

    @staticmethod
    def _jaccard(n: int, width: int, threshold: float) -> float:
        kept = math.ceil(threshold * n)
        return kept / (n + width - kept)

    def windows(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, window start, window end) of the windows that agree on some band.

        ``first`` has each text's first shingle and the total; no window crosses texts.
        """
        n = np.diff(first)
        count = -(-n // self.stride)
        of = np.repeat(np.arange(len(n)), count)
        start = first[of] + (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * self.stride
        if not len(start):
            return
        hit = np.zeros((len(self.sets), len(start)), dtype=bool)
        for k, factor in enumerate(self.factors):
            low = np.minimum.reduceat(h * factor, start)
            window = low.copy()
            for d in range(1, self.blocks):
                np.minimum(window[:-d], np.where(of[d:] == of[:-d], low[d:], window[:-d]), out=window[:-d])
            for t in range(len(self.sets)):
                np.logical_or(hit[t], window == self.samples[t, k], out=hit[t])
        for t in range(len(self.sets)):
            for w in np.flatnonzero(hit[t]).tolist():
                yield t, int(start[w]), int(min(start[w] + self.stride * self.blocks, first[of[w] + 1]))


def groups(notices: list[tuple[str, str]], size: int, threshold: float) -> list[Group]:
    by_class: dict[tuple[int, int], list] = {}
    for name, text in notices:
        words, _ = hashes([text])
        if len(words):
            span = min(size, len(words))
            n = len(words) - span + 1
            by_class.setdefault((span, (n - 1).bit_length()), []).append(
                (name, np.unique(shingle_hashes(words, span)), n))
    return [Group(span, members, threshold) for (span, _), members in by_class.items()]


def find(words: np.ndarray, first: np.ndarray, classes: list[Group], threshold: float) -> list[tuple]:
    """(text number, first word, name, number of words, containment) of the matches, in order."""
    out = []
    for g in classes:
        counts = np.maximum(np.diff(first) - g.span + 1, 0)
        at = np.concatenate([[0], np.cumsum(counts)])
        every = shingle_hashes(words, g.span) if len(words) >= g.span else words[:0]
        # A text's shingles start at its words but for the last ones, which reach into the next text.
        inside = np.repeat(first[:-1] - at[:-1], counts) + np.arange(at[-1])
        h = every[inside]
        ranges: dict[tuple[int, int], list[list[int]]] = {}
        for t, lo, hi in g.windows(h, at):
            own, wanted = h[lo:hi], g.sets[t]
            found = np.flatnonzero(np.isin(own, wanted))
            if len(np.unique(own[found])) >= threshold * len(wanted):
                a, b = lo + int(found[0]), lo + int(found[-1])
                text = int(np.searchsorted(at, a, "right")) - 1
                spans = ranges.setdefault((t, text), [])
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(b, spans[-1][1])
                else:
                    spans.append([a, b])
        for (t, text), spans in ranges.items():
            for a, b in spans:
                share = len(np.intersect1d(h[a:b + 1], g.sets[t])) / len(g.sets[t])
                out.append((text, a - int(at[text]), g.names[t], b - a + g.span, share))
    return sorted(out)


def _scanner(notices, size: int, threshold: float):
    def run(batches):
        classes = groups(notices, size, threshold)
        for b in slices(batches, "text", SLICE_BYTES):
            words, first = hashes([t or "" for t in b.column("text").to_pylist()])
            found = find(words, first, classes, threshold)
            ids = b.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": [ids[f[0]] for f in found], "license": [f[2] for f in found],
                "start_word": [f[1] for f in found], "n_words": [f[3] for f in found],
                "containment": [f[4] for f in found]}, schema=MATCH)
    return run


def scan(df: DataFrame, notices: list[tuple[str, str]] = TEMPLATES, size: int = SHINGLE,
         threshold: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, start_word, n_words, containment): one row per match."""
    return arrow_map(keyed_text(df, id_col, text_col), _scanner(notices, size, threshold),
                     "doc_id long, license string, start_word long, n_words long, containment double")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
