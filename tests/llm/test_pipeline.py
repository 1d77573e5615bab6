"""The corpus pipeline, stage by stage, against brute force on the small table."""

import collections
import random
import string

import corpus_pipeline
from secflow.llm import language_id
from tests.llm.test_text_operators import ROWS, _sets


def _cut(rows, length=100):
    """Remaining text of each row; rows in id order, nulls last."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), {}
    for k in order:
        raw = rows[k][1].encode()
        mask = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                mask[s:s + length] = b"\1" * length
            else:
                seen.add(w)
        out[k] = bytes(c for c, m in zip(raw, mask, strict=True) if not m).decode("utf-8", "ignore")
    return out


def test_stages(spark, tmp_path):
    rows = [(i, t, lang, "s%d" % ((i or 0) % 3), len(t) if t is not None else None, "x")
            for i, t, lang in ROWS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, label string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs, results = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        results.append(docs)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == corpus_pipeline.COLUMNS
    known, single, cut, packed = ([tuple(r) for r in d.collect()] for d in results)

    scores = {(r.doc_id, r.text): r.score for r in language_id.identify(
        spark.read.parquet(str(tmp_path / "documents.parquet")), ["doc_id", "text"]).collect()}
    letters = collections.Counter((i, t) for i, t, _ in ROWS if t and any(c.isalpha() for c in t) and (
        scores[i, t] > 0 or sum(c.isalpha() for c in t) < 100))
    assert (96, "one two") in letters and (95, "123 !!") not in letters
    assert collections.Counter(r[:2] for r in known) == letters and all(r[2] for r in known)

    sets = list(_sets([(r[0], r[1], None) for r in known], 5))
    parent = list(range(len(known)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(known)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, r in enumerate(known):
        least[root(i)].append(r[0])
    want = collections.Counter(
        r for i, r in enumerate(known)
        if r[0] == min((x for x in least[root(i)] if x is not None), default=None))
    assert collections.Counter(single) == want and len(single) < len(known)

    left = _cut(single)
    assert collections.Counter((r[0], r[1], r[4]) for r in cut) == collections.Counter(
        (single[k][0], t, len(t)) for k, t in left.items())
    assert {(r[0], r[2], r[3]) for r in cut} == {(r[0], r[2], r[3]) for r in single}
    assert {r[0] for r in packed} == {r[0] for r in cut}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)


def test_unknown_languages_are_dropped(spark, tmp_path):
    rnd = random.Random(4)

    def words(syllables, n):
        return " ".join("".join(rnd.choices(syllables, k=rnd.randint(1, 3))) for _ in range(n))

    english, german = ["the", "ing", "er", "st", "and", "wh", "ed", "on"], ["der", "ein", "sch", "ver", "zu", "ung", "ü"]
    clean = [(k, words(s, n), lang) for k, (s, n, lang) in enumerate(
        [(english, 200, "en"), (german, 200, "de")] * 40 + [(english, 6, "en"), (german, 6, "de"), (english, 25, None),
                                                           (german, 25, None)] * 10)]
    clean += [(200, "one two", "en"), (201, "the the the " * 50, "en")]
    greek, cyrillic = [chr(c) for c in range(0x3b1, 0x3ca)], [chr(c) for c in range(0x430, 0x450)]
    planted = [(300 + 10 * k + j, t, None) for k in range(20) for j, t in enumerate([
        words(greek, 100), words(cyrillic, 300), "".join(chr(rnd.randrange(0x4e00, 0x9fff)) for _ in range(400)),
        "".join(rnd.choices(string.ascii_lowercase + "     ", k=90)),
        "".join(rnd.choices(string.ascii_lowercase + "     ", k=3000)),
        words(["ki", "vat", "jo", "szo", "gye", "mub", "lyu", "nok"], 200)])]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in clean + planted],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, str(tmp_path)).collect()}
    assert got == {i for i, _, _ in clean}
