"""Line-first quality rules: clean a text line by line, then reject it if too much was lost.

A line with words fails if one of these rules holds for it:

* punctuation: it does not end in a sentence mark (closing quotes and brackets may follow), or more than
  ``MAX_SHOUTS`` per cent of its words end in repeated exclamation or question marks, or it has more than
  ``MAX_SYMBOLS`` symbols to a hundred words;
* navigation: at least two separators stand alone and make up ``MIN_SEPARATORS`` per cent of its words, or all of it names
  a page control;
* boilerplate: it has a phrase of scripts, cookie notices, placeholders or legal footers, or a curly bracket.

Failing lines go.  A document is rejected if the base rules reject its whole text, or if the lines that stay hold
less than ``MIN_KEPT`` per cent of its words.  Everything is a DataFrame expression of one row: no shuffle and no Python;
8-word windows are compared by a pair of 32- and 64-bit hashes, for rows with equal window hashes only.

Defined cases: null text has no words and is rejected; ``clean_text`` of a null text is null; lines without words are
neither rules' failures nor words lost, and stay; repeated rows and null ids are each returned; extra or clashing
columns never reach the operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm.common import keyed_text, table

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED = 30       # per cent of the words that lie in repeated windows
MIN_KEPT = 50           # per cent of the words that the kept lines must hold
MAX_SHOUTS = 30         # per cent of a line's words
MAX_SYMBOLS = 30        # to a hundred words
MIN_SEPARATORS = 20     # per cent of a line's words
MAX_CONTROL = 40        # characters of a line that only names a page control

# White space of the contract, symbols, sentence marks, separators, page controls and phrases.
SPACE = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CLOSING = "\"'”’»)]"
SENTENCE_MARKS = (".", "!", "?", "…", "。", "！", "？", ":", ";")
SHOUTS = ("!!", "??", "!?", "?!")
SEPARATORS = ("|", ">", "»", "›", "·", "•", "/", "–", "—", "-")
CONTROLS = ("home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next", "previous", "back",
            "top", "back to top", "share", "print", "read more", "more", "contact", "contact us", "about", "about us",
            "help", "faq", "sitemap", "subscribe")
PHRASES = ("{", "}", "javascript", "lorem ipsum", "cookie policy", "uses cookies", "use cookies",
           "accept all cookies", "privacy policy", "terms of use", "terms of service", "terms and conditions",
           "all rights reserved", "subscribe to our newsletter", "powered by", "click here")


def _any(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def _words(col: Column) -> Column:
    trimmed = F.btrim(col, F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, rf"[{SPACE}]+")).otherwise(F.array())


def _holds(col: Column, parts: tuple[str, ...]) -> Column:
    return _any([F.contains(col, F.lit(p)) for p in parts])


def gates(text: Column, lower: Column) -> Column:
    """Bits for what a whole text must hold for a rule to fail any of its lines: most texts skip most rules.

    One number for all four, so that the optimizer sees several uses and does not move the test of the
    whole text into the test of each line.
    """
    tests = (_holds(text, SHOUTS), text.rlike(f"[{SYMBOLS}]"), _holds(text, SEPARATORS), _holds(lower, PHRASES))
    return sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))


def line_fails(line: Column, may: Column) -> Column:
    """True if a punctuation, navigation or boilerplate rule rejects the line (which has a word)."""
    shouting, symbolic, separated, phrased = (may.bitwiseAND(1 << i) != 0 for i in range(4))
    words = _words(line)
    n = F.size(words)
    shouts = F.size(F.filter(words, lambda w: F.right(w, F.lit(2)).isin(*SHOUTS)))
    bars = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
    symbols = F.regexp_count(line, F.lit(f"[{SYMBOLS}]"))
    punctuation = (~F.right(F.rtrim(line, F.lit(BLANKS + CLOSING)), F.lit(1)).isin(*SENTENCE_MARKS)
                   | (shouting & (100 * shouts > MAX_SHOUTS * n))
                   | (symbolic & (100 * symbols > MAX_SYMBOLS * n)))
    navigation = ((separated & _holds(line, SEPARATORS) & (bars >= 2) & (100 * bars >= MIN_SEPARATORS * n))
                  | ((F.char_length(line) < MAX_CONTROL)
                     & F.lower(F.btrim(line, F.lit(BLANKS + ".:!?"))).isin(*CONTROLS)))
    return punctuation | navigation | (phrased & _holds(F.lower(line), PHRASES))


def _repeated(spots: Column) -> Column:
    """Starts of the windows whose hash occurs again; ``spots`` is sorted by hash, then start."""
    at = lambda i: F.get(spots, i).getField("h")
    return F.sort_array(F.transform(
        F.filter(spots, lambda x, i: (x["h"] == at(i - 1)).eqNullSafe(True) | (x["h"] == at(i + 1)).eqNullSafe(True)),
        lambda x: x["i"]))


def base_counts(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of its text column."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(rf"[^{SPACE}]"))
    one = df.withColumn("_words", _words(whole)).withColumn("_lines", lines)
    two = (one.withColumn("_hashes", F.transform("_words", lambda x: F.xxhash64(x)))
           .withColumn("n_words", F.size("_words").cast("long"))
           .withColumn("word_chars", F.char_length(F.array_join("_words", "")).cast("long"))
           .withColumn("n_symbols", F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long"))
           .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
           .drop("_lines"))
    # Window hashes by doubling: two words, then four, then eight.
    span = 1
    while span < window:
        two = two.withColumn("_hashes", _beside("_hashes", span))
        span *= 2
    three = two.withColumn("_windows", F.slice("_hashes", F.lit(1), F.greatest(F.lit(0), F.size("_hashes") - (span - 1))))
    # Only a text with two equal window hashes compares windows.
    again = F.size(F.array_distinct("_windows")) < F.size("_windows")
    spots = F.transform("_windows", lambda h, i: F.struct(
        F.struct(h.alias("wide"), F.hash(F.slice("_words", i + 1, span)).alias("narrow")).alias("h"), i.alias("i")))
    four = three.withColumn("_spots", F.when(again, F.sort_array(spots))).drop("_words", "_hashes", "_windows")
    five = four.withColumn("_starts", _repeated(F.col("_spots"))).drop("_spots")
    covered = F.aggregate(F.transform("_starts", lambda x, i: F.least(
        F.lit(span), F.coalesce(F.get("_starts", i + 1) - x, F.lit(span))).cast("long")),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return five.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_starts")


def _beside(hashes: str, span: int) -> Column:
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(F.col(hashes), i + span)))


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_kept: int = MIN_KEPT) -> DataFrame:
    """Every row with its base counts, ``clean_text`` (the lines that pass), ``words_kept`` and the verdict ``kept``."""
    lower = base_counts(keyed_text(df, id_col, text_col)).withColumn("_lower", F.lower("text"))
    counted = lower.withColumn("_may", gates(F.col("text"), F.col("_lower"))).drop("_lower")
    passing = F.filter(F.split("text", "\n"),
                       lambda x: F.when(x.rlike(rf"[^{SPACE}]"), ~line_fails(x, F.col("_may"))).otherwise(True))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    whole = F.col("clean_text") == F.col("text")
    judged = (counted.withColumn("clean_text", F.array_join(passing, "\n"))
              .withColumn("words_kept", F.when(whole, F.col("n_words"))
                          .otherwise(F.size(_words(F.coalesce("clean_text", F.lit(""))))).cast("long"))
              .drop("text", "_may").withColumn("base_failed", base))
    return judged.withColumn("kept", ~F.col("base_failed") & (100 * F.col("words_kept") >= min_kept * F.col("n_words")))


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "words_kept")
