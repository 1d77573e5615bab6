"""Text operators against brute force on a small table with every odd case."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from secflow.llm import bpe, language_id, licenses, near_dup, packing, suffix_dedup


def _rows():
    """(doc_id, text, lang): nulls, empty and long texts, copies, near copies, shared passages."""
    rnd = random.Random(3)
    syllables = {"en": "the and ing tion er wh th st on ed".split(), "de": "sch ung keit der ein ü ß zu ch ver".split()}

    def sentence(lang, n):
        return " ".join("".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))

    rows, passage = [], sentence("en", 60)
    for i in range(60):
        lang = "en" if i % 3 else "de"
        rows.append((i, sentence(lang, rnd.randint(8, 120)) + ".\n" + sentence(lang, 20), lang))
    for i in range(60, 75):
        rows.append((i, sentence("en", 30) + " " + passage + " " + sentence("en", 30), "en"))
    base = sentence("en", 150).split()
    for i in range(75, 90):
        w = list(base)
        w[rnd.randrange(150)] = "changed"
        rows.append((i, " ".join(w), "en"))
    rows += [(90, rows[5][1], "en"), (91, rows[5][1], "en"), (92, None, "en"), (93, "", None), (94, "  \n ", "de"),
             (95, "123 !!", "en"), (96, "one two", None), (97, "a b c  d\t\te <|endoftext|> f", "en"),
             (98, sentence("en", 6000), "en"), (99, "ab " * 400, "en"), (99, "ab " * 400, "en"),
             (None, rows[7][1], None), (100, "x" * 700, "en"), (101, "Ünïcödé ßtraße 日本語 😀 " * 5, None)]
    return rows


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, "kept", "block", 7) for i, t, lang in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, node string, block string, word int")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_suffix_array_and_prefixes(monkeypatch):
    from secflow.llm import sais

    rng = np.random.default_rng(1)
    for direct in (1 << 17, 4):                     # 4: the recursion goes all the way down
        monkeypatch.setattr(sais, "DIRECT", direct)
        for n, k in [(1, 1), (2, 1), (40, 1), (50, 2), (300, 3), (5000, 4), (3000, 60)]:
            t = rng.integers(0, k, n).astype(np.uint8)
            if n == 5000:
                t = np.tile(t[:70], 72)[:n]
            raw = t.tobytes()
            sa = sais.suffix_array(t, 256)
            assert sa.tolist() == sorted(range(n), key=lambda i, raw=raw: raw[i:])
            common = sais.permuted_lcp(t, sa, 100)
            for r in range(1, n, 1 + n // 50):
                i, j = int(sa[r - 1]), int(sa[r])
                same = 0
                while same < 100 and max(i, j) + same < n and raw[i + same] == raw[j + same]:
                    same += 1
                assert common[j] == same


def _brute_cut(rows, length):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), collections.Counter()
    for k in order:
        raw = (rows[k][1] or "").encode()
        mask = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                mask[s:s + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(c for c, m in zip(raw, mask, strict=True) if not m)
        spans = len(re.findall(rb"\x01+", bytes(mask)))
        out[(rows[k][0], len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 4000, "buckets": 5}, {"hot": 2, "block_bytes": 9000}])
def test_suffix_dedup(docs, kw):
    got = collections.Counter(tuple(r) for r in suffix_dedup.deduplicate(docs, **kw).collect())
    assert got == _brute_cut(ROWS, 100)


def test_suffix_dedup_text_and_empty(docs, empty):
    r = {x.doc_id: x for x in suffix_dedup.deduplicate(docs, with_text=True).collect() if x.doc_id != 99}
    assert r[91].kept_text == "" and r[98].kept_text == ROWS[98][1]
    assert suffix_dedup.deduplicate(empty).collect() == []


def _sets(rows, size):
    fold = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    for _, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        yield set(zip(*[w[k:] for k in range(size)], strict=False)) if len(w) >= size else {tuple(w)} if w else set()


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(docs, size):
    sets = list(_sets(ROWS, size))
    parent = list(range(len(ROWS)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ROWS)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = collections.defaultdict(list)
    for i, r in enumerate(ROWS):
        ids[root(i)].append(r[0])
    want = collections.Counter()
    for i, r in enumerate(ROWS):
        known = [x for x in ids[root(i)] if x is not None]
        rep = min(known) if known else None
        want[(r[0], len(sets[i]), rep, r[0] == rep)] += 1
    got = collections.Counter(tuple(r) for r in near_dup.near_duplicates(docs, size=size).collect())
    assert got == want


def test_near_duplicates_empty(empty):
    assert near_dup.near_duplicates(empty).collect() == []


def _stages(spark, name, run) -> int:
    """Stages that a call starts, without those that were skipped."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    track = sc.statusTracker()
    ran = {s for j in track.getJobIdsForGroup(name) for s in track.getJobInfo(j).stageIds}
    return sum(1 for s in ran if (i := track.getStageInfo(s)) and i.numCompletedTasks)


def test_near_duplicates_take_few_stages(spark, docs):
    """Every stage starts as many tasks as there are shuffle partitions: their number is the cost of small tables."""
    n = _stages(spark, "near-stages", lambda: near_dup.near_duplicates(docs, size=4).collect())
    assert n <= 55


def test_components_take_two_shuffles_a_round(spark):
    from secflow.llm.components import components

    chain = spark.createDataFrame([(i, i + 1) for i in range(64)] * 2, "u long, v long")
    got = []
    n = _stages(spark, "star-stages", lambda: got.extend(components(chain, "t").collect()))
    assert sorted((r.node, r.label) for r in got) == [(i, 0) for i in range(65)]
    assert n <= 50


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(0)
    a, b = near_dup._params(near_dup.SAMPLES)
    limit = near_dup.most_odd_bits(0.8)
    far = near = 0
    for _ in range(200):
        common, own = rng.integers(0, 1 << 62, 900, dtype=np.uint64), rng.integers(0, 1 << 62, 400, dtype=np.uint64)
        x, y = np.append(common, own[:100]), np.append(common, own[100:200])          # 900 / 1100
        z = np.append(common[:300], own)                                              # about 300 / 1300
        sx, sy, sz = (near_dup.odd_sketch(near_dup.min_hashes(s, a, b)) for s in (x, y, z))
        count = [sum(int(v).bit_count() if v >= 0 else (int(v) + (1 << 64)).bit_count() for v in sx ^ o)
                 for o in (sy, sz)]
        near += count[0] <= limit
        far += count[1] > limit
    assert near == 200 and far > 190


def test_components(spark):
    from secflow.llm.components import components

    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [
        (rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(60)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    linked = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {x: root(x) for x in linked}


TOK = Tokenizer.from_file(bpe.default_tokenizer())


@pytest.mark.parametrize("kw", [{}, {"block_bytes": 5000}])
def test_bpe_round_trip(docs, kw):
    want = collections.Counter()
    for i, t, _ in ROWS:
        ids = TOK.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(TOK.decode(ids, skip_special_tokens=False).encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r) for r in bpe.round_trip(docs, **kw).collect()) == want


def test_bpe_empty(empty):
    assert bpe.round_trip(empty).collect() == []


def test_words_keep_the_tokenizers_ids():
    rnd = random.Random(9)
    enc = bpe.Encoder(bpe.default_tokenizer())
    alphabet = ["a", "Z", "é", "ß", "日", "7", "½", "'s", "'", "!", "_", " ", " ", "  ", "\n", "\t", "\r", "\x0b", "\x1c",
                "\x85", " ", "᠎", "​", " ", "　", "﻿", "<|endoftext|>", "😀", "́"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    texts += ["word, words. word's Über; Über... x-y", "a b", " a", "a ", "\na", "a\nb", "w" * 500 + " end."]
    for block in [texts[i:i + 7] + [None] for i in range(0, len(texts), 7)] + [texts, [], [None], [""]]:
        for t, ids in zip(block, enc.texts(pa.array(block, pa.string())), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == TOK.encode(t or "", add_special_tokens=False).ids, repr(t)
    small = bpe.Encoder(bpe.default_tokenizer(), limit=5)
    for t in texts:
        assert np.frombuffer(small.texts(pa.array([t]))[0], "<u4").tolist() == TOK.encode(t, add_special_tokens=False).ids


def test_packing(docs, empty):
    rows = packing.pack(docs).collect()
    by_sequence, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 1
    want = collections.defaultdict(list)
    for i, t, _ in ROWS:
        ids = np.array([*TOK.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)] if first < len(ids) else [0, len(ids)]
        want[i] += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in
                    enumerate(zip(cuts, cuts[1:], strict=False))]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(empty).collect() == []


def test_plan_uses_every_piece_and_fills_exactly():
    rnd = random.Random(2)
    for _ in range(30):
        cap = rnd.choice([10, 64, 2048])
        counts = collections.Counter(rnd.randint(1, cap) for _ in range(rnd.randint(1, 400)))
        used = collections.Counter()
        for pattern, k in packing.plan(counts, cap):
            assert k > 0 and sum(pattern) <= cap
            for p in pattern:
                used[p] += k
        assert used == counts
    # A pair and a triple that fill the gap exactly.
    assert sorted(packing.plan({7: 1, 2: 1, 1: 1}, 10)) == [((7, 2, 1), 1)]
    assert sorted(packing.plan({6: 2, 4: 2}, 10)) == [((6, 4), 2)]


def _plain_profile(text, p):
    """The bundle of a text's trigrams, letter by letter."""
    symbols = [0]
    for ch in (text or "").lower():
        n = int(p.symbol[ord(ch)])
        if n or symbols[-1]:                              # a run of other characters is one border
            symbols.append(n)
    total, kinds = np.zeros(p.third.shape[1]), set()
    for a, b, c in zip(symbols, symbols[1:], [*symbols[2:], 0], strict=False):
        if b or c:
            total += np.roll(p.third[a], 2).astype(float) * np.roll(p.third[b], 1) * p.third[c]
            kinds.add((a, b, c))
    return total if kinds else None, len(kinds)


def test_language_profiles_against_plain_ones(spark):
    rnd = random.Random(9)
    words = {"xx": ["alba", "lume", "stra", "perla"], "yy": ["kodo", "wüst", "straße", "ÄÖ"], "zz": ["été", "quoi", "l'an"]}
    rows = [(i, " ".join(rnd.choices(words[g], k=rnd.randrange(1, 12))) + rnd.choice(["", ".", " 12 ", "!?"]), g)
            for i, g in enumerate(rnd.choices(list(words), k=60))]
    rows += [(60, "alba kodo été", None), (61, "  7 ", "xx"), (62, None, "yy"), (63, "a", None), (64, "пока alba", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = language_id.profiler(language_id.DIM)
    sums = {}
    for i, text, g in rows:
        if g is None or zlib.crc32(str(i).encode()) % 3 == 1:
            continue
        v, _ = _plain_profile(text, p)
        if v is not None:
            sums[g] = sums.get(g, 0) + v / np.linalg.norm(v)
    prototypes = {g: v / np.linalg.norm(v) for g, v in sums.items()}
    trained = language_id.train(docs.filter(~language_id.held_out()))
    assert set(trained) == set(prototypes)
    assert all(np.abs(trained[g] - prototypes[g]).max() < 1e-5 for g in prototypes)
    got = {r.doc_id: r for r in language_id.identify(docs, ["doc_id"]).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        v, kinds = _plain_profile(text, p)
        if v is None:
            assert (got[i].lang_pred, got[i].score, got[i].trigrams) == ("und", 0.0, 0)
            continue
        cos = {g: float(v @ u / np.linalg.norm(v)) for g, u in prototypes.items()}
        best = max(cos.values())
        assert got[i].trigrams == kinds and abs(got[i].score - max(0.0, best)) < 1e-5
        assert cos[got[i].lang_pred] > best - 1e-6


def test_language_id(docs, empty):
    got = language_id.identify(docs, ["doc_id", "text", "lang"]).withColumn("held_out", language_id.held_out()).collect()
    assert len(got) == len(ROWS)
    right = n = 0
    for r in got:
        assert 0.0 <= r.score <= 1.0
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        letters = r.text and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters)
        if letters and r.held_out and r.doc_id < 90:
            n += 1
            right += r.lang_pred == r.lang
    assert n > 10 and right / n > 0.95
    assert language_id.identify(empty, ["doc_id"]).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled, ["doc_id"]).collect()} == {"und"}


def test_profiles_bundle_bound_trigrams():
    p = language_id.Profiler(dim=256)
    got = next(iter(p.profiles(["Ab, c"])))
    s = {c: p.symbol[ord(c)] for c in "abc"} | {" ": 0}
    want = np.zeros(256)
    for x, y, z in (" ab", "ab ", "b c", " c "):
        want += p.first[s[x]].astype(int) * p.second[s[y]] * p.third[s[z]]
    assert np.array_equal(got, want)
    assert list(p.profiles(["", None, "12 !"])) == [None, None, None]


def test_license_scan(spark, empty):
    text = " ".join(["word%d" % i for i in range(40)])
    notice = dict(licenses.NOTICES)
    rows = [(1, f"{text} {notice['GPL-3.0']} {text}"), (2, notice["MIT"].upper()), (3, None), (4, ""),
            (5, f"{notice['Apache-2.0']} {text} {notice['Apache-2.0']}"), (6, text),
            (7, text + " All rights reserved. " + notice["CC-BY-NC-4.0"]),
            (8, notice["CC-BY-SA-4.0"].replace("International ", "") + " " + text), (None, notice["MIT"])]
    got = sorted((tuple(r) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()),
                 key=str)
    names = collections.Counter((g[0], g[1]) for g in got)
    assert names[(1, "GPL-3.0")] == 1 and names[(2, "MIT")] == 1 and names[(5, "Apache-2.0")] == 2
    assert names[(7, "All-Rights-Reserved")] == 1 and names[(7, "CC-BY-NC-4.0")] == 1 and names[(None, "MIT")] == 1
    assert not [k for k in names if k[0] in (3, 4, 6)]
    assert (1, "GPL-3.0", 40, 12, 1.0) in got
    assert licenses.scan(empty).collect() == []


def test_license_bodies(spark):
    lead, rows = " ".join("w%d" % k for k in range(37)), []
    for k, (_, body) in enumerate(licenses.BODIES):
        words = body.split()
        near = words[:len(words) // 2] + ["changed"] + words[len(words) // 2 + 1:]
        rows += [(2 * k, f"{lead} {body} {lead}"), (2 * k + 1, " ".join([lead, *near, lead]))]
    rows += [(900, lead), (901, f"{lead} Released under the terms of the MIT License. {lead}")]
    got = {(r.doc_id, r.license) for r in licenses.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (name, _) in enumerate(licenses.BODIES):
        assert (2 * k, name) in got and (2 * k + 1, name) in got
    assert (901, "MIT") in got and 900 not in {i for i, _ in got}


def test_license_windows_miss_nothing():
    """Every verified occurrence that an exhaustive scan finds, at any place in the text."""
    rnd = random.Random(4)
    classes = licenses.groups(licenses.NOTICES, 5, 0.8)
    for name, text in licenses.NOTICES:
        for lead in range(0, 30):
            words = ["w%d" % rnd.randrange(10 ** 6) for _ in range(lead)] + [text] + ["z%d" % k for k in range(9)]
            w, first = licenses.hashes([" ".join(words)])
            assert (name, lead) in [(m[2], m[1]) for m in licenses.find(w, first, classes, 0.8)]
