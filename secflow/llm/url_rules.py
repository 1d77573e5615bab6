"""URL filtering with listed host rules first and mined association rules for the rest.

Labelled URLs become transactions of URL tokens plus their class.  Spark's FP-growth mines the
frequent token combinations; combinations that imply the blocked class with enough support and
confidence are kept, minimal ones only.  Matching uses an inverted index: a rule is filed under
its rarest token, the distinct token sets of the URLs are looked up by token, and the rest of the
combination is checked.  Every step is DataFrame / SQL (and Spark's own FP-growth); no Python runs
on the executors.

Defined cases: a null URL, or one without ``://``, has empty host and path and no tokens, fits no
listed rule, and is allowed by the mined rules.  Repeated rows are judged alike and all returned.
Without labels no rule is mined and everything unlisted is allowed.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm.common import pinned, table

# The listed rules (verdict, host, path) of the contract.
LISTED = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
          ("allow", "com", "/fr/"), ("block", "com", "/de/")]

MIN_SUPPORT, MIN_ROWS = 0.01, 10        # a combination is on this share of the labelled URLs, and on so many
MIN_CONFIDENCE = 0.5
SALTS = 16
DOMAIN_CHARS = 253                      # fixed value: the longest domain name
BLOCK = "class=block"


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(_url, locate('://', _url) + 3)")).otherwise(F.lit(""))


def split_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``_url``, ``host`` and ``path`` (contract: A-Z of the host lower-cased, no query or fragment)."""
    df = df.withColumn("_url", F.col(url_col).cast("string"))
    rest = F.coalesce(_after_scheme(F.col("_url")), F.lit(""))
    df = df.withColumn("_rest", rest)
    host = F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (df.withColumn("host", host)
            .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)))


def listed_rule(rules: list[tuple[str, str, str]]) -> Column:
    """Struct (n, rule, verdict) of the longest listed rule that fits ``host`` and ``path``, or null."""
    if not rules:
        return F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    fits = [F.when(((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p),
                   F.struct(F.lit(len(h) + len(p)).alias("n"), F.lit(h + p).alias("rule"),
                            F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array(*fits))


def _domains() -> Column:
    """The host and the domains above it.  A domain name has at most ``DOMAIN_CHARS`` characters, so a host of any length
    gives a bounded number of bounded tokens: of a longer one, the domains within its end."""
    host = F.col("host")
    end = F.expr(f"right(host, {DOMAIN_CHARS + 1})")
    # Behind a dot of the end starts a whole label; without a dot there is no domain short enough.
    whole = F.when(F.length(host) <= DOMAIN_CHARS, host).when(
        F.instr(end, ".") > 0, F.regexp_replace(end, r"^[^.]*\.", ""))
    labels = F.split(whole, r"\.")
    return F.coalesce(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(
        F.lit("domain="), F.array_join(F.slice(labels, i, F.size(labels)), "."))), F.array().cast("array<string>"))


def url_tokens() -> Column:
    """Sorted distinct tokens: host, its suffix domains, host words, path words, query keys, fragment."""
    labels, suffixes = F.split(F.col("host"), r"\."), _domains()
    words = F.transform(F.flatten(F.transform(labels, lambda x: F.split(x, "-"))),
                        lambda x: F.concat(F.lit("host="), x))
    path = F.transform(F.filter(F.split(F.lower("path"), r"[^\p{L}]+"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("path="), x))
    query = F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""),
                       lambda x: F.concat(F.lit("query="), F.regexp_extract(x, r"^([^=]*)", 1)))
    part = F.when(F.col("_rest").contains("#"), F.array(F.lit("fragment"))).otherwise(
        F.array().cast("array<string>"))
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(
        F.array_sort(F.array_distinct(F.concat(suffixes, words, path, keys, part))))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_rows: int = MIN_ROWS) -> DataFrame:
    """Rules (antecedent array, confidence, support) that imply the blocked class.

    ``labelled`` has ``tokens`` and ``blocked`` (boolean).  A rule whose antecedent contains that
    of another kept rule is dropped: the shorter one already matches whatever it matches.  The
    number of rules is bounded by the support threshold, not by the number of URLs.
    """
    items = labelled.select(F.when(F.col("blocked"), F.concat("tokens", F.array(F.lit(BLOCK))))
                            .otherwise(F.col("tokens")).alias("items")).filter(F.size("items") > 0)
    total = items.count()
    least = max(min_rows, math.ceil(Fraction(str(min_support)) * total))
    # FP-growth takes a share and rounds share * total up: half a row less gives exactly ``least``.
    share = min(1.0, (least - 0.5) / max(1, total))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(items)
    rules = (model.associationRules.filter(F.element_at("consequent", 1) == BLOCK)
             .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support"))
    rules = pinned(rules if total >= least else rules.limit(0), "url-rules")
    # A shorter rule inside a longer one: it shares the longer one's tokens, so look it up by token.
    part = rules.select(F.col("antecedent").alias("short"), F.explode("antecedent").alias("token"))
    inner = (rules.select(F.col("antecedent"), F.explode("antecedent").alias("token"))
             .join(part, "token")
             .filter((F.size("short") < F.size("antecedent"))
                     & (F.size(F.array_except("short", "antecedent")) == 0))
             .select("antecedent").distinct())
    return rules.join(inner, "antecedent", "left_anti")


def inverted_index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """(token, antecedents): each rule under its rarest token, by row counts in ``tokens``."""
    counts = (tokens.select(F.explode("tokens").alias("token"), "n")
              .groupBy("token").agg(F.sum("n").alias("n")))
    filed = (rules.select("antecedent", F.explode("antecedent").alias("token"))
             .join(counts, "token", "left")
             .groupBy("antecedent")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("key")))
    return filed.groupBy(F.col("key.token").alias("token")).agg(F.collect_list("antecedent").alias("rules"))


def judge(pages: DataFrame, labelled_urls: DataFrame, listed=LISTED, id_col: str = "page_id",
          url_col: str = "url", min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Verdict for every row of ``pages``; ``labelled_urls`` has (url, blocked).

    Returns (id, host, path, rule, verdict, mined): ``rule`` is the listed rule or null, ``mined``
    tells whether a mined rule matches.
    """
    urls = (split_url(pages.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url_col}`").alias("_in")),
                      "_in")
            .withColumn("listed", listed_rule(listed)).withColumn("tokens", url_tokens()))
    train = (split_url(labelled_urls.filter(F.col("blocked").isNotNull())
                       .select(F.col("url").alias("_in"), "blocked"), "_in")
             .withColumn("tokens", url_tokens()))
    rules = mine_rules(train.select("tokens", "blocked"), min_support, min_confidence)
    sets = urls.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"))
    hits = (sets.select("tokens", F.explode("tokens").alias("token"))
            .join(inverted_index(rules, sets), "token")
            .filter(F.exists("rules", lambda r: F.size(F.array_except(r, F.col("tokens"))) == 0))
            .select("tokens").distinct().withColumn("mined", F.lit(True)))
    # A common token set is on any share of the pages: its pages are dealt to SALTS tasks, the matched sets to each.
    hits = hits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = urls.withColumn("_salt", F.pmod(F.xxhash64(id_col, "_in"), F.lit(SALTS)).cast("int"))
    out = salted.join(hits, ["tokens", "_salt"], "left")
    mined = F.coalesce("mined", F.lit(False))
    return out.select(id_col, "host", "path", F.col("listed.rule").alias("rule"),
                      F.coalesce("listed.verdict", F.when(mined, F.lit("block")).otherwise(F.lit("allow")))
                      .alias("verdict"), mined.alias("mined"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' labels, carried by the document number in a page's path, train the rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    labelled = (pages.select("url", F.expr("try_cast(nullif(regexp_extract(url, "
                                           "'://[^/?#]*/[^?#]*?([0-9]+)', 1), '') AS bigint)").alias("doc_id"))
                .join(labels, "doc_id").select("url", "blocked"))
    return judge(pages, labelled).select("page_id", "host", "path", "rule", "verdict", "mined")
