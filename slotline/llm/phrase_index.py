"""Benchmark decontamination by a positional inverted index, in built-in functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A to Z. A phrase is a run of
``width`` consecutive words of an item, or the whole item where it is shorter. The terms of phrases
are counted over all documents. Each phrase is looked up by its two rarest terms: the index stores a posting
(document and position, and for the rarest the words around) for each place where such a term stands in a
document. Phrases of an item that have the same two terms are looked up together: the postings of both
terms are moved by the terms' distance and intersected, and the places that both lists have are compared word
for word, phrase by phrase.

The index holds only the rarest terms of phrases, which is what keeps it far smaller than the text;
every place of a phrase has all of its terms, so nothing is missed. Places are grouped by document and place,
never by term or phrase, so that a word or passage that a third of all documents share is spread over all
tasks; rows never pair documents with one another.

``proximity`` finds pairs of terms that stand near each other, with an index of just the terms asked for, and ``items_near``
does so for the two rarest terms of each item. They serve searches of their own: ``find``, ``report`` and ``clean`` match exact phrases.

Null and empty texts, and such without words, have no words and no hits; null or word-free items have no
phrases and never occur. An item without an id counts as id ``""``. Rows are told apart by doc_id and
a hash of the text: repeated rows give repeated results. Empty tables give no hits or no rows. Only
``doc_id``, ``item_id`` and ``text`` are read. Words are compared in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import staged
from slotline.llm.url_rules import LOWER, UPPER

WIDTH = 10
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    """The words of a text in order; none for null."""
    cut = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), _GAPS)
    return F.filter(cut, lambda x: x != "")


def phrases(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each phrase: item_id, its first position in the item (from 0), and its words."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words().alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    # Rows that repeat an item are one; rows that share an id but not the words are told apart.
    rows = rows.filter(F.size("words") > 0).distinct().withColumn("item", F.monotonically_increasing_id())
    return rows.select("item", "item_id", "words", F.explode(starts).alias("start")).withColumn(
        "phrase", F.slice("words", F.col("start") + 1, width)
    )


def term_counts(tokenised: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each term of the phrases how often it stands in the documents."""
    terms = wanted.select(F.explode("phrase").alias("term")).distinct()
    held = tokenised.select(F.explode("words").alias("term")).join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    return terms.join(held, "term", "left").select("term", F.coalesce("held", F.lit(0)).alias("held"))


def lookups(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases of an item with the same two rarest terms, as one row: group, item_id, run (the words that the
    phrases cover), size (words of a phrase), rarest and second (terms), before (words of the run before the rarest)
    and distance (from the rarest to the second; null for phrases of one word)."""
    each = wanted.select("item", "start", F.posexplode("phrase").alias("offset", "term")).join(counts, "term")
    place = F.struct("held", "term", (F.col("start") + F.col("offset")).alias("at"))
    least = each.groupBy("item", "start").agg(F.slice(F.sort_array(F.collect_list(place)), 1, 2).alias("least"))
    rows = wanted.join(least, ["item", "start"])
    grouped = rows.groupBy("item", "item_id", "least").agg(
        F.min("start").alias("first"), F.max("start").alias("last"), F.first(F.size("phrase")).alias("size"),
        F.first("words").alias("words"),
    )
    one, two = F.col("least")[0], F.get("least", F.lit(1))
    return grouped.select(
        F.monotonically_increasing_id().alias("group"), "item_id", "size",
        F.slice("words", F.col("first") + 1, F.col("last") - F.col("first") + F.col("size")).alias("run"),
        one["term"].alias("rarest"), two["term"].alias("second"),
        (one["at"] - F.col("first")).alias("before"), (two["at"] - one["at"]).alias("distance"),
    )


def postings(tokenised: DataFrame, terms: DataFrame, width: int = WIDTH) -> DataFrame:
    """The index: term, doc, at (position from 0) and, for terms ``wide``, the words up to ``width - 1`` away."""
    around = F.slice(
        F.col("words"), F.greatest(F.col("at") - (width - 2), F.lit(1)),
        F.least(F.col("at"), F.lit(width - 1)) + width,
    )
    return (
        tokenised.select("doc", "words", F.posexplode("words").alias("at", "term")).join(terms, "term")
        .select("term", "doc", "at", F.when(F.col("wide"), around).alias("around"))
    )


def occurrences(index: DataFrame, groups: DataFrame, width: int = WIDTH) -> DataFrame:
    """Where phrases occur: doc, item_id and ``hit``, the positions (from 0) that a group's phrases cover there."""
    lists = groups.select("group", F.col("rarest").alias("term"), F.lit(0).alias("shift"), F.lit(1).alias("bit"),
                          F.when(F.col("second").isNull(), 1).otherwise(3).alias("bits"))
    second = groups.filter("second is not null").select(
        "group", F.col("second").alias("term"), F.col("distance").alias("shift"), F.lit(2).alias("bit"), F.lit(3).alias("bits")
    )
    moved = index.join(lists.unionByName(second), "term").withColumn("place", F.col("at") - F.col("shift"))
    met = (
        moved.groupBy("doc", "place", "group", "bits")
        .agg(F.bit_or("bit").alias("had"), F.max(F.when(F.col("bit") == 1, F.col("around"))).alias("around"))
        .filter("had = bits").join(groups.select("group", "item_id", "size", "run", "before"), "group")
    )
    # Where the run would begin in the document, and among the words around the rarest term.
    begin = F.col("place") - F.col("before")
    shift = begin - F.greatest(F.col("place") - (width - 1), F.lit(0))
    same = F.transform("run", lambda word, i: F.coalesce(F.get("around", F.col("shift") + i) == word, F.lit(False)))
    covered = F.transform(
        F.filter(
            F.sequence(F.lit(0), F.size("run") - F.col("size")),
            lambda at: F.forall(F.slice("same", at + 1, F.col("size")), lambda x: x),
        ),
        lambda at: F.sequence(F.col("begin") + at, F.col("begin") + at + F.col("size") - 1),
    )
    rows = met.withColumns({"begin": begin, "shift": shift}).withColumn("same", same)
    return rows.select("doc", "item_id", F.array_distinct(F.flatten(covered)).alias("hit")).filter(F.size("hit") > 0)


def near(index: DataFrame, first: str, second: str, within: int) -> DataFrame:
    """Places where two terms of the index stand at most so many words apart: doc, first_at, second_at.

    An index holds the terms it was made with only; ``proximity`` makes one for the terms asked for.
    """
    pair = index.sparkSession.range(1).select(F.lit("").alias("pair"), F.lit(first).alias("first"), F.lit(second).alias("second"))
    return _pairs_near(index, pair, within).drop("pair")


def _pairs_near(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """Positions are put into bands of ``within``, and a term's band meets its neighbours: an equi-join by document, pair
    and band, so that no long document and no frequent term is one task's."""
    if within < 1:
        raise ValueError("terms are at least one word apart")
    band = lambda name: F.floor(F.col(name) / within)
    placed = index.select("doc", "term", "at")
    one = placed.join(pairs.select("pair", F.col("first").alias("term")), "term").withColumnRenamed("at", "first_at")
    one = one.withColumn("band", F.explode(F.array(*[band("first_at") + x for x in (-1, 0, 1)])))
    two = placed.join(pairs.select("pair", F.col("second").alias("term")), "term").withColumnRenamed("at", "second_at")
    two = two.withColumn("band", band("second_at"))
    apart = F.abs(F.col("first_at") - F.col("second_at"))
    met = one.drop("term").join(two.drop("term"), ["doc", "pair", "band"]).filter((apart <= within) & (apart > 0))
    return met.select("doc", "pair", "first_at", "second_at")


def proximity(documents: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """Where the terms of each of the ``pairs`` (pair, first, second; terms in lower case) stand at most ``within`` words
    apart, in either order: doc_id, pair, first_at and second_at (positions from 0).

    The index is made for the terms asked for, so a term that is missing here is in no document. A pair of one
    term twice gives its different positions. Pairs of one name are told apart by their terms. Repeated documents give each place once; pairs with nulls give none.
    """
    wanted = staged(pairs.select("pair", "first", "second").filter("first is not null and second is not null").distinct(), "pairs")
    terms = wanted.select(F.col("first").alias("term")).union(wanted.select("second")).distinct().withColumn("wide", F.lit(False))
    tokenised = documents.select(_key().alias("doc"), words().alias("words")).dropDuplicates(["doc"])
    index = staged(postings(tokenised, terms), "near-postings")
    return _pairs_near(index, wanted.withColumn("pair", F.struct("pair", "first", "second")), within).select(
        F.col("doc.doc_id").alias("doc_id"), F.col("pair.pair").alias("pair"), "first_at", "second_at"
    )


def rare_pairs(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The two different terms of each item that are rarest in the documents (ties: least as text), as pairs named by the item_id.

    Terms that no document has are left out; an item with fewer than two others has no pair.
    """
    each = items.select(F.coalesce("item_id", F.lit("")).alias("pair"), words().alias("words"))
    each = staged(each.select("pair", F.xxhash64("words").alias("item"), F.explode("words").alias("term")).distinct(), "item-terms")
    every = documents.select(F.explode(words()).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    counted = each.join(every, "term")
    least = counted.groupBy("pair", "item").agg(F.slice(F.sort_array(F.collect_list(F.struct("held", "term"))), 1, 2).alias("least"))
    return least.filter(F.size("least") == 2).select(
        "pair", F.col("least")[0]["term"].alias("first"), F.col("least")[1]["term"].alias("second")
    ).distinct()


def items_near(documents: DataFrame, items: DataFrame, within: int) -> DataFrame:
    """Proximity matches of items: doc_id, item_id and where its two rarest terms stand at most ``within`` words apart."""
    return proximity(documents, rare_pairs(documents, items), within).withColumnRenamed("pair", "item_id")


def _key() -> Column:
    return F.struct(F.col("doc_id"), F.xxhash64("text").alias("text"))


def find(documents: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Occurrences of the items' phrases in the documents, stored."""
    tokenised = documents.select(_key().alias("doc"), words().alias("words"))
    wanted = staged(phrases(items, width), "phrases")
    counts = staged(term_counts(tokenised, wanted), "term-counts")
    groups = staged(lookups(wanted, counts), "lookups")
    terms = groups.select(F.col("rarest").alias("term"), F.lit(True).alias("wide")).unionByName(
        groups.filter("second is not null").select(F.col("second").alias("term"), F.lit(False).alias("wide"))
    )
    terms = staged(terms.groupBy("term").agg(F.bool_or("wide").alias("wide")), "indexed-terms")
    index = staged(postings(tokenised, terms, width), "postings")
    return staged(occurrences(index, groups, width), "occurrences")


def clean(documents: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents in which no phrase of the items occurs, with all their columns."""
    found = find(documents, items, width)
    hits = staged(found.select(F.col("doc.doc_id").alias("hit_id"), F.col("doc.text").alias("hit_text")).distinct(), "hit-documents")
    here = F.equal_null(F.col("own.doc_id"), F.col("found.hit_id")) & (F.xxhash64("own.text") == F.col("found.hit_text"))
    return documents.alias("own").join(hits.alias("found"), here, "left_anti")


def report(documents: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every document."""
    found = find(documents, items, width)
    # A document's hits are gathered, as they are no more than its words and the items that share them.
    by_document = found.groupBy(F.col("doc").alias("hit_doc")).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    hits = staged(by_document, "document-hits")
    rows = documents.select("doc_id", _key().alias("doc"), F.size(words()).cast("long").alias("n_words"))
    same = F.equal_null(F.col("doc.doc_id"), F.col("hit_doc.doc_id")) & (F.col("doc.text") == F.col("hit_doc.text"))
    number = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.join(hits, same, "left").select(
        "doc_id", "n_words", number.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (number > 0).alias("contaminated"),
    )
