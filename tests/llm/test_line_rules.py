"""Line rules against a plain Python form: counts on random texts, verdicts on planted lines."""

import random
import re
from collections import Counter

from secflow.llm import line_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, kept string, n_words string, _words string"


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def fails(line):
    words, n = WORD.findall(line), len(WORD.findall(line))
    return (line.rstrip(rules.BLANKS + rules.CLOSING)[-1:] not in rules.SENTENCE_MARKS
            or 100 * sum(w[-2:] in rules.SHOUTS for w in words) > 30 * n
            or 100 * sum(c in "#*$%&|<>" for c in line) > 30 * n
            or 2 <= sum(w in rules.SEPARATORS for w in words) >= 0.2 * n
            or (len(line) < 40 and line.strip(rules.BLANKS + ".:!?").lower() in rules.CONTROLS)
            or any(p in line.lower() for p in rules.PHRASES))


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in enumerate(texts)], SCHEMA)
    return sorted(rules.clean(df).collect(), key=lambda r: r.doc_id)


def check(spark, texts):
    got = run(spark, texts)
    for text, r in zip(texts, got, strict=True):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text), text
        lines = (text or "").split("\n")
        stay = [x for x in lines if not WORD.search(x) or not fails(x)]
        left = sum(len(WORD.findall(x)) for x in stay)
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert (r.base_failed, r.words_kept) == (failed, left), text
        assert r.kept == (not failed and 100 * left >= 50 * r.n_words)
        assert r.clean_text == (None if text is None else "\n".join(stay))
    return got


def test_random_texts_with_repeats_symbols_and_odd_spaces(spark):
    rng = random.Random(2)
    words = ["a", "be", "sea.", "dé", "#x", "**", "|", "GO!!", "home", " ", "x y", "😀"]
    texts = [None, "", " \n\t", "\n\n", "Home", "word", "a " * 7, "a " * 8, "a " * 9]
    for _ in range(150):
        pool = rng.sample(words, rng.choice([1, 2, 5, 12]))
        texts.append("".join(rng.choice(pool) + rng.choice([" ", " ", " ", "\n", ".\n", "\t", "\x0b", "  ", "\r\n"])
                             for _ in range(rng.randrange(120))))
    # Repeats of whole passages, overlapping and apart.
    passage = " ".join(f"w{i}" for i in range(11))
    texts += [f"{passage} {passage}", f"{passage} x {passage}. y {passage}", " ".join(["one two three"] * 30)]
    check(spark, texts)


def test_clean_prose_is_kept_and_junk_goes(spark):
    prose = "\n".join(f"Sentence number {i} tells something of its own about thing {i * i}." for i in range(10))
    junk = ["\n".join(["Home | News | Sport | Weather | Shop | About us | Help | Contact | Jobs | Login |"] * 3),
            "\n".join(f"menu entry {i} without an end" for i in range(9)),
            " ".join(f"word{i}***" for i in range(40)) + ".", " ".join(f"LOUD{i}!!" for i in range(40)),
            "\n".join(f"var x{i} = {{ a: {i} }} or enable javascript please." for i in range(9))]
    mixed = prose + "\nHome | News | Sport | Help\nPlease read our privacy policy.\nLogin"
    got = check(spark, [prose, mixed, *junk, "Too short."])
    assert [r.kept for r in got] == [True, True] + [False] * 6
    assert got[1].clean_text == prose and got[0].words_kept == got[0].n_words


def test_very_long_text(spark):
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(50)}" + rng.choice(["", "", "", "."]) for _ in range(60_000)) + ". " + "x" * 300_000
    check(spark, [text, text + "\n" + text])


def test_empty_table_and_repeated_rows(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(None, "One line.", "", "", "")] * 3, SCHEMA)
    assert [tuple(r) for r in rules.clean(df).select("doc_id", "n_words", "kept").collect()] == [(None, 2, False)] * 3


def test_plan_has_no_python_and_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "", "", "")], SCHEMA)
    plan = rules.clean(df.repartition(2)).select("doc_id", "kept")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowToRow", "") and plan.count("Exchange ") <= 1
