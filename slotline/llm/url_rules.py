"""URL filters by association rules.

FP-growth mines combinations of URL tokens that go with a verdict, from labelled URLs.
Rules are pruned by support and confidence, and those that say no more than a shorter one are
dropped. An inverted index from tokens to rules finds the rules of each URL: a rule fits if as
many of its tokens were found as it has. Given host and path rules go first.

Built-in functions and the library's FP-growth only. All of a URL's tokens as ``tokens`` defines them count; rules have
``LONGEST_RULE`` tokens at most, as longer ones say little more and are many. A token in a rule is in at
least ``min_support`` of the labelled URLs; rarer ones are dropped before mining, which bounds the number of tokens
in rules by the tokens of a URL over ``min_support``, whatever the corpus. Tokens that are in exactly the same labelled
URLs are mined as one and written out again in the rules: a rule with two of them says no more than one with one.

A null URL, or one without ``://``, has an empty host and path and no tokens: the default verdict.
Rows with equal ``page_id`` are judged each by its own URL; repeated rows give repeated results.
Without labelled URLs no rules are mined. An empty table gives an empty result. Only ``page_id``
and ``url`` are read. Among fitting rules the one with the highest confidence wins, then the one
with more tokens, more support, and ``block``.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
LONGEST_RULE = 3
COPIES = 1000
DEFAULT = "allow"

#: The given rules: what they are written as and their verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    part = lambda pattern: F.coalesce(F.regexp_extract("url", pattern, 1), F.lit(""))
    return pages.select(
        "page_id",
        "url",
        F.translate(part(r"://([^/?#]*)"), UPPER, LOWER).alias("host"),
        part(r"://[^/?#]*([^?#]*)").alias("path"),
    )


def given(rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest given rule that fits, and its verdict; null if none does."""

    def fits(written: str) -> Column:
        host, slash, rest = written.partition("/")
        at_host = (F.col("host") == host) | F.col("host").endswith("." + host)
        return at_host & F.col("path").startswith(slash + rest)

    longest = sorted(rules, key=lambda x: (-len(x[0]), x[0]))
    first = lambda value: F.coalesce(*[F.when(fits(x[0]), F.lit(value(x))) for x in longest])
    return first(lambda x: x[0]), first(lambda x: x[1])


def tokens() -> Column:
    """The distinct tokens of a URL: host labels by their place from the right, words of the host's
    labels of three letters and more, path parts without a digit, file endings of two to five letters, names
    in the query. Parts with a digit are mostly numbers of pages and say nothing of others."""
    labels = F.reverse(F.filter(F.split("host", r"\."), lambda x: x != ""))
    by_place = F.transform(labels, lambda x, i: F.concat(F.lit("h"), F.least(i, F.lit(3)).cast("string"), F.lit(":"), x))
    words = F.transform(F.filter(F.split("host", r"[.\-]"), lambda x: F.length(x) > 2), lambda x: F.concat(F.lit("w:"), x))
    segments = F.filter(F.split("path", "/"), lambda x: (x != "") & ~x.rlike("[0-9]"))
    ending = F.regexp_extract("path", r"\.([a-zA-Z]{2,5})$", 1)
    names = F.filter(
        F.transform(F.split(F.regexp_extract("url", r"\?([^#]*)", 1), "&"), lambda x: F.split(x, "=")[0]), lambda x: x != ""
    )
    prefixed = lambda kind, array: F.transform(array, lambda x: F.concat(F.lit(kind), x))
    every = F.concat(
        by_place, words, prefixed("p:", segments), F.when(ending != "", F.array(F.concat(F.lit("x:"), ending))).otherwise(F.array()),
        prefixed("q:", names),
    )
    return F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def _alike(lists: DataFrame, min_support: float) -> DataFrame:
    """token and ``standing``, of the tokens with enough support: the first of those in the same rows.

    Rows are summed up by two hashes of what they hold, since equal rows have equal tokens.
    """
    least = math.ceil(min_support * lists.agg(F.sum("times")).first()[0])
    rows = lists.select("*", F.xxhash64("tokens", "verdict").alias("one"), F.xxhash64("verdict", "tokens", F.lit(1)).alias("two"))
    sums = rows.select(F.explode("tokens").alias("token"), "times", "one", "two").groupBy("token").agg(
        F.sum("times").alias("count"), *[F.sum(F.col(x).cast("decimal(20,0)")).alias(x) for x in ("one", "two")]
    )
    usual = sums.filter(F.col("count") >= least)
    standing = usual.groupBy("count", "one", "two").agg(F.min("token").alias("standing"))
    return usual.join(standing, ["count", "one", "two"]).select("token", "standing")


def _items(lists: DataFrame, stood: DataFrame) -> DataFrame:
    """A row of ``items`` for each labelled URL: the tokens that stand for its own, and its verdict."""
    row = lists.select("*", F.xxhash64("tokens", "verdict").alias("row"))
    held = (
        row.select("row", F.explode("tokens").alias("token")).join(stood.filter("token = standing"), "token")
        .groupBy("row").agg(F.collect_list("token").alias("held"))
    )
    items = F.concat(F.coalesce("held", F.array().cast("array<string>")), F.array(F.concat(F.lit("="), "verdict")))
    # Copies of a common URL are dealt over tasks, some at a time.
    some = row.join(held, "row", "left").select(
        "row", "times", items.alias("items"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(COPIES).cast("long"))).alias("nth")
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("times") - F.col("nth"))))
    tasks = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return some.repartition(tasks, F.xxhash64("row", "nth")).select("items", each.alias("copy")).select("items")


def mined(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
          longest: int = LONGEST_RULE) -> DataFrame:
    """Rules from rows of ``tokens`` and ``verdict``: rule_id, antecedent, verdict, confidence, support."""
    spark = labelled.sparkSession
    empty = "rule_id long, antecedent array<string>, verdict string, confidence double, support double"
    if labelled.isEmpty():
        return spark.createDataFrame([], empty)
    lists = staged(labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("times")), "url-token-lists")
    stood = staged(_alike(lists, min_support), "url-tokens")
    items = _items(lists, stood)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = staged(
        model.associationRules.filter(
            F.col("consequent")[0].startswith("=") & (F.size("antecedent") <= longest)
            & ~F.exists("antecedent", lambda x: x.startswith("="))
        ).select(
            F.xxhash64(F.array_sort("antecedent"), "consequent").alias("rule_id"),
            F.array_sort("antecedent").alias("antecedent"),
            F.substring(F.col("consequent")[0], 2, 100).alias("verdict"),
            F.round("confidence", 9).alias("confidence"),
            "support",
        ),
        "url-rules-all",
    )
    # A rule says nothing new if part of its tokens alone give the verdict as surely.
    index = indexed(found)
    longer = found.select(
        F.col("rule_id").alias("long_id"), F.col("verdict").alias("long_verdict"), F.col("confidence").alias("long_confidence"),
        F.size("antecedent").alias("long_size"), F.explode("antecedent").alias("token"),
    )
    needless = (
        longer.join(index, "token")
        .filter((F.col("verdict") == F.col("long_verdict")) & (F.col("size") < F.col("long_size"))
                & (F.col("confidence") >= F.col("long_confidence")))
        .groupBy("long_id", "rule_id", "size").agg(F.count(F.lit(1)).alias("had"))
        .filter("had = size").select(F.col("long_id").alias("rule_id")).distinct()
    )
    kept = found.join(needless, "rule_id", "left_anti")
    # Each token that stands for others gives way to each of them in turn.
    for place in range(longest):
        members = stood.select(F.col("standing").alias(f"standing_{place}"), F.col("token").alias(f"token_{place}"))
        kept = kept.join(members, F.get("antecedent", F.lit(place)) == F.col(f"standing_{place}"), "left")
    written = F.array_sort(F.array_compact(F.array(*[F.col(f"token_{place}") for place in range(longest)])))
    rules = kept.select(
        F.xxhash64(written, F.array(F.concat(F.lit("="), "verdict"))).alias("rule_id"), written.alias("antecedent"),
        "verdict", "confidence", "support",
    )
    return staged(rules, "url-rules")


def indexed(rules: DataFrame) -> DataFrame:
    """The inverted index: a row for each token of each rule."""
    return rules.select(
        F.explode("antecedent").alias("token"), "rule_id", F.size("antecedent").alias("size"), "verdict", "confidence", "support"
    )


def matched(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct token list that a mined rule fits: ``tokens`` and the best rule's ``mined`` verdict."""
    distinct = rows.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
    hits = (
        distinct.join(indexed(rules), "token")
        .groupBy("tokens", "rule_id", "size", "verdict", "confidence", "support").agg(F.count(F.lit(1)).alias("had"))
        .filter("had = size")
    )
    rank = F.struct("confidence", "size", "support", "verdict", "rule_id")
    return hits.groupBy("tokens").agg(F.max_by("verdict", rank).alias("mined"))


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; mined rules speak where no given one does."""
    rule, verdict = given(rules)
    rows = parts(pages).withColumns({"rule": rule, "given": verdict, "tokens": tokens()})
    found = mined(rows.filter("given is not null").select("tokens", F.col("given").alias("verdict")))
    open_ = rows.filter("given is null")
    # Stored: few rows, whose size the planner then knows; URLs of one site share their tokens.
    best = staged(matched(open_, found), "url-verdicts")
    judged = rows.join(best, (rows["tokens"] == best["tokens"]) & rows["given"].isNull(), "left")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("given", "mined", F.lit(default)).alias("verdict"),
        F.when(F.col("given").isNull(), F.col("mined")).alias("mined"),
    )
