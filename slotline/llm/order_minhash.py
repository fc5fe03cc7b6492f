"""Near copies by Order MinHash.

Words are ``[^\\x20\\x09-\\x0D]+``; a text's k-mers are its runs of ``SHINGLE`` words (all its words
where there are fewer), each labelled with how often it occurred before. A sketch takes the ``TAKEN`` k-mers
that are least under a hash and keeps them in text order, so that texts share a sketch the more readily
the closer they are by edits. ``SKETCHES`` hashes give as many sketches; texts that share one are candidates.

A candidate pair is verified by a banded alignment of the two texts' words: the longest common subsequence
within the band that the similarity leaves. With m words aligned, the similarity is ``m / (a + b - m)``;
``SIMILARITY`` or more is a link, and linked texts are one class. (Some 10 % of the words may be replaced, where
five-word runs compared at the same limit would allow some 2 %.)

Groups may be large, so pairs within a group are never listed. Texts of equal words are one node from the
start. In each bucket (texts with a common sketch) a few representatives, first the member that meets
most others, then the least by a hash that changes by the round, are compared with the members that aren't yet of their
class; classes grow together, and rounds go on while representatives double. What is then still apart in a common bucket is settled by
k-mers: texts of which ``SIMILARITY`` of the k-mers agree must share one of their rarest (the prefix rule: as many as could be
unmatched, and one), so those that differ in class and share such a k-mer are compared, unless too few k-mers
follow it. Last, texts that are still of different classes and share a bucket are compared. Where at most ``FEW`` members are outside of
the bucket's largest class, these meet all others. Elsewhere they do as well, or those meet that share one of their rarest words (by the
same rule: texts with that many words aligned have as many in common), whichever is fewer in that bucket. Of those that meet, a pair
is aligned unless the parities of its words (``PARITIES`` bits a text, each whether an odd number of words fall on it) differ in more
places than a link leaves words unlike. No bucket, partner or candidate is capped, and a link is lost only if the pair shares no sketch.

Null texts, and texts without words, are classes of their own. Texts that share fewer than ``TAKEN`` k-mers, as those of fewer
than ``SHINGLE`` words, are near copies only if their words are equal. Very long texts are aligned whole, in memory that grows with
their length alone. Repeated rows are of one class. A class is named
by its least doc_id, null if it has none. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import small_batches, staged
from slotline.llm.textstats import mixed, shingle_hashes, span_hashes, words

SHINGLE = 5
TAKEN = 2
SKETCHES = 20
SIMILARITY = 0.8
#: Representatives of a bucket, by the round.
ROUNDS = (1, 2, 4)
#: Members outside of a bucket's largest class that meet all others, at the end, without a look at their rarest words.
FEW = 32
PARITIES = 1024
_SEEDS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(text: str) -> tuple[bytes, np.ndarray]:
    """A digest of the text's words, and a hash of each in order."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    hashes = span_hashes(data, *words(data)) if len(data) else np.zeros(0, np.uint64)
    return hashlib.md5(b" ".join(raw.split())).digest(), hashes


def labelled_kmers(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """The labelled k-mers of words in order."""
    if not len(hashes):
        return hashes
    hashes = shingle_hashes(hashes, width)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    if not new.all():
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        before = np.empty(len(order), np.uint64)
        before[order] = np.arange(len(order)) - first
        hashes = mixed(hashes + before * np.uint64(0xD6E8FEB86659FD93))
    return hashes


def kmers(text: str, width: int = SHINGLE) -> tuple[bytes, np.ndarray]:
    """A digest of the text's words, and its labelled k-mers in order."""
    digest, hashes = word_hashes(text)
    return digest, labelled_kmers(hashes, width)


def sketches(labelled: np.ndarray, count: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """For each hash the least k-mers in text order, as one number; the hash's own number is part of it."""
    out = np.empty(count, np.uint64)
    take = min(taken, len(labelled))
    for at in range(count):
        values = labelled * _SEEDS[at]
        values ^= values >> np.uint64(32)
        values *= _SEEDS[at + count]
        least = np.sort(np.argpartition(values, take - 1)[:take]) if take < len(labelled) else np.arange(take)
        out[at] = shingle_hashes(labelled[least], taken)[0] + np.uint64(at)
    return mixed(out)


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of ``PARITIES`` places whether an odd number of words fall on it, as bits of longs."""
    places = (hashes >> np.uint64(24)) & np.uint64(PARITIES - 1)
    return np.packbits(np.bincount(places.astype(np.int64), minlength=PARITIES).astype(np.uint8) & 1).view(np.int64)


def alignment(one: np.ndarray, two: np.ndarray, least: float = SIMILARITY) -> int:
    """How many words the best alignment matches, within the band outside of which none reaches ``least``;
    where even the words in common, in any order, are too few, only the ends in common count."""
    shorter = min(len(one), len(two))
    apart = np.flatnonzero(one[:shorter] != two[:shorter])
    if not len(apart):
        return shorter
    start = int(apart[0])
    unlike = np.flatnonzero(one[len(one) - shorter :] != two[len(two) - shorter :])
    end = min(shorter - 1 - int(unlike[-1]) if len(unlike) else shorter, shorter - start)
    left, right = one[start : len(one) - end], two[start : len(two) - end]
    names, symbols = np.unique(np.concatenate([left, right]), return_inverse=True)
    left, right = symbols[: len(left)], symbols[len(left) :]
    common = np.minimum(np.bincount(left, minlength=len(names)), np.bincount(right, minlength=len(names)))
    if start + end + common.sum() < least * (len(one) + len(two)) / (1 + least) - 1e-6:
        return start + end
    band = int((len(one) + len(two)) * (1 - least) / (1 + least)) + 1
    return start + end + _common_run(left, right, common > 0, band)


def _common_run(one: np.ndarray, two: np.ndarray, shared: np.ndarray, band: int, block: int = 256) -> int:
    """Length of the longest common subsequence of pairs of places at most ``band`` apart (a few further ones may
    count). A row of the table is one integer whose bit is 0 where the row's value grows, and holds the band's bits only."""
    at_one, at_two = np.flatnonzero(shared[one]), np.flatnonzero(shared[two])
    if not len(at_one):
        return 0
    order = np.argsort(one[at_one], kind="stable")
    sorted_symbols, listed = one[at_one][order], order.tolist()
    found = row = low = high = 0
    for begin in range(0, len(at_two), block):
        places = at_two[begin : begin + block]
        new_low = max(low, int(np.searchsorted(at_one, places[0] - band)))
        new_high = max(high, new_low, int(np.searchsorted(at_one, places[-1] + band, side="right")))
        row |= ((1 << (new_high - high)) - 1) << (high - low)
        left_behind = new_low - low
        found += left_behind - (row & ((1 << left_behind) - 1)).bit_count()
        row >>= left_behind
        low, high = new_low, new_high
        ones = (1 << (high - low)) - 1
        masks = {}
        wanted = two[places]
        distinct = np.unique(wanted)
        bounds = (np.searchsorted(sorted_symbols, distinct, side=side).tolist() for side in ("left", "right"))
        for symbol, first, last in zip(distinct.tolist(), *bounds):
            if last - first <= 16:
                masks[symbol] = sum(1 << at - low for at in listed[first:last] if low <= at < high)
                continue
            held = order[first:last]
            bits = np.zeros(high - low, np.uint8)
            bits[held[(held >= low) & (held < high)] - low] = 1
            masks[symbol] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        for symbol in wanted.tolist():
            met = row & masks[symbol]
            row = ((row + met) | (row - met)) & ones
    return found + (high - low) - row.bit_count()


def similarity(one: np.ndarray, two: np.ndarray, least: float = SIMILARITY) -> float:
    """Of two texts' words, as hashes; 0 where they share fewer than ``TAKEN`` k-mers."""
    shorter, longer = sorted((len(one), len(two)))
    if not shorter or shorter < least * longer:
        return 0.0
    matched = alignment(one, two, least)
    found = matched / (shorter + longer - matched)
    if found >= least and len(np.intersect1d(labelled_kmers(one), labelled_kmers(two), assume_unique=True)) < TAKEN:
        return 1.0 if np.array_equal(one, two) else 0.0
    return found


def sketched(documents: DataFrame) -> DataFrame:
    """doc_id, node (a digest of the words; null without words), size (words) and sketches."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, found = [], [], []
            for text in batch.column("text").to_pylist():
                digest, hashes = word_hashes(text or "")
                some = len(hashes) > 0
                node.append(digest if some else None)
                size.append(len(hashes))
                found.append(sketches(labelled_kmers(hashes)).view(np.int64) if some else np.zeros(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            values = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(node, pa.binary()), pa.array(size, pa.int32()), pa.ListArray.from_arrays(ends, values)],
                names=["doc_id", "node", "size", "sketches"],
            )

    small_batches(documents.sparkSession, 500)
    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(sketch, "doc_id long, node binary, size int, sketches array<long>")


def components(edges: DataFrame) -> DataFrame:
    """node and comp (the least node it is connected with) for the nodes of edges ``a``, ``b``."""
    both = staged(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    label = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("comp"))
    label = staged(label, "labels")
    while True:
        # The least label around, then that label's own label.
        near = both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("comp").alias("around"))
        nearer = staged(
            label.join(near, label["node"] == near["a"]).select(
                "node", F.least("comp", "around").alias("comp"), (F.col("around") < F.col("comp")).alias("moved")
            ),
            "labels",
        )
        step = nearer.select(F.col("node").alias("at"), F.col("comp").alias("further"))
        label = staged(nearer.join(step, nearer["comp"] == step["at"]).select("node", F.col("further").alias("comp")), "labels")
        if nearer.filter("moved").isEmpty():
            return label


class Classes:
    """The classes of nodes as links come in."""

    def __init__(self, nodes: DataFrame):
        self.of = nodes.select("node", F.col("node").alias("comp"))

    def join(self, links: DataFrame) -> None:
        """Make one class of the classes that links ``a``, ``b`` connect."""
        left = self.of.select(F.col("node").alias("a"), F.col("comp").alias("a_comp"))
        right = self.of.select(F.col("node").alias("b"), F.col("comp").alias("b_comp"))
        between = links.join(left, "a").join(right, "b").filter("a_comp <> b_comp")
        between = staged(between.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")).distinct(), "class-links")
        if between.isEmpty():
            return
        merged = components(between).select(F.col("node").alias("old"), F.col("comp").alias("new"))
        found = self.of.join(merged, self.of["comp"] == merged["old"], "left")
        self.of = staged(found.select("node", F.coalesce("new", "comp").alias("comp")), "classes")


def verified(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts (node, words as bytes) are similar enough, stored."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            view = lambda x: np.frombuffer(x, np.uint64)
            kept = [similarity(view(x), view(y), least) >= least for x, y in zip(batch["one"], batch["two"])]
            yield batch.loc[kept, ["a", "b"]]

    one = texts.select(F.col("node").alias("a"), F.col("words").alias("one"))
    two = texts.select(F.col("node").alias("b"), F.col("words").alias("two"))
    small_batches(pairs.sparkSession, 200)
    return staged(pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two").mapInPandas(check, "a binary, b binary"), "links")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs with the lesser node first, each once, sizes within the similarity's reach."""
    reach = F.least("a_size", "b_size") >= SIMILARITY * F.greatest("a_size", "b_size")
    return pairs.filter(reach & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(documents: DataFrame) -> DataFrame:
    """doc_id and class_id (the least doc_id of its class) for every document."""
    rows = staged(sketched(documents), "sketched")
    nodes = staged(
        rows.filter("node is not null").groupBy("node")
        .agg(F.first("size").alias("size"), F.first("sketches").alias("sketches"), F.min("doc_id").alias("least_id")),
        "nodes",
    )
    every = nodes.select("node", "size", F.explode("sketches").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    met = staged(every.join(shared, "bucket"), "shared-buckets")
    # The members of a node's buckets: the more, the nearer the node is to what its group was copied from.
    partners = staged(met.groupBy("node").agg(F.first("size").alias("size"), F.sum("held").alias("central")), "partners")
    buckets = staged(met.select("bucket", "node", "size").join(partners.select("node", "central"), "node"), "buckets")
    texts = staged(_texts(documents, nodes.join(partners.select("node"), "node")), "texts")

    found = Classes(partners)
    tested = None
    for number, count in enumerate(ROUNDS):
        pairs = _star(buckets, found.of, number, count)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found.join(verified(pairs, texts))
    for rest in (_rest, _rest_by_words):
        pairs = staged(rest(buckets, found.of, texts).join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        found.join(verified(pairs, texts))

    least = nodes.select("node", "least_id").join(found.of, "node", "left")
    least = least.select("node", "least_id", F.coalesce("comp", "node").alias("comp"))
    named = least.groupBy("comp").agg(F.min("least_id").alias("class_id"))
    by_node = staged(least.join(named, "comp").select("node", "class_id"), "node-classes")
    return rows.select("doc_id", "node").join(by_node, "node", "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


def without_copies(documents: DataFrame) -> DataFrame:
    """The documents with one of each class: the one that names it; of repeated rows one.

    Rows without a doc_id stay where no other row of their class has one.
    """
    found = classes(documents).filter(F.equal_null("doc_id", "class_id")).select(F.col("doc_id").alias("kept_id")).distinct()
    here = F.equal_null(F.col("own.doc_id").cast("long"), F.col("found.kept_id"))
    return documents.alias("own").join(found.alias("found"), here, "left_semi").dropDuplicates(["doc_id", "text"])


def _texts(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, odd (the parities of its words) and words (hashes, as bytes) of the given nodes, from the texts of their least documents."""
    wanted = nodes.select(F.col("least_id"), "node")

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(node, word_hashes(text)) for node, text in zip(batch["node"], batch["text"])]
            # Rows that only share the doc_id have another digest.
            own = [(node, parities(hashes), hashes.tobytes()) for node, (digest, hashes) in found if digest == bytes(node)]
            yield pd.DataFrame(own, columns=["node", "odd", "words"])

    read = documents.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small_batches(documents.sparkSession, 500)
    rows = read.join(wanted, F.equal_null("doc_id", "least_id")).select("node", "text")
    return rows.mapInPandas(label, "node binary, odd array<long>, words binary").dropDuplicates(["node"])


def _star(buckets: DataFrame, of: DataFrame, number: int, count: int) -> DataFrame:
    """Pairs of each bucket's representatives of a round with its members of other classes."""
    rows = buckets.join(of, "node")
    apart = rows.groupBy("bucket").agg(
        F.min("comp").alias("first"), F.max("comp").alias("last"),
        F.array(*[
            F.min(F.struct(
                (-F.col("central") if not number else F.lit(0)).alias("far"),
                F.xxhash64("node", F.lit(number * 1000 + at)).alias("rank"), "node", "size", "comp",
            ))
            for at in range(count)
        ]).alias("chosen"),
    ).filter("first <> last")
    chosen = apart.select("bucket", F.explode(F.array_distinct(F.transform("chosen", lambda x: F.struct(
        x["node"].alias("b"), x["size"].alias("b_size"), x["comp"].alias("b_comp"))))).alias("chosen")).select("bucket", "chosen.*")
    met = rows.select("bucket", F.col("node").alias("a"), F.col("size").alias("a_size"), "comp").join(chosen, "bucket")
    return _ordered(met.filter("comp <> b_comp"))


def _open(buckets: DataFrame, of: DataFrame) -> DataFrame:
    """The members, with their classes, of buckets that hold more than one class, and the bucket's own (see ``_main``)."""
    rows = buckets.select("bucket", "node", "size").join(of, "node")
    return rows.join(_main(rows, ["bucket"]), "bucket")


def _main(rows: DataFrame, keys: list[str]) -> DataFrame:
    """For equal ``keys`` of more than one class the largest class (``main``), all ``members`` and those ``outside`` of it."""
    by_class = rows.groupBy(*keys, "comp").agg(F.count(F.lit(1)).alias("held"))
    return by_class.groupBy(*keys).agg(
        F.max_by("comp", F.struct("held", "comp")).alias("main"), F.sum("held").alias("members"),
        (F.sum("held") - F.max("held")).alias("outside"),
    ).filter("outside > 0")


def _rest(buckets: DataFrame, of: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of different classes, met in a bucket, that share one of their rarest k-mers."""
    held = F.greatest(F.col("size") - (SHINGLE - 1), F.lit(1)).alias("size")
    left = staged(_open(buckets, of).select("node", "comp", held).distinct(), "unsettled")
    return _sharing(_rarest(left, texts, SHINGLE), ["kmer"])


def _rest_by_words(buckets: DataFrame, of: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of different classes that meet in a bucket: all of them or, where these are fewer, those that share one of
    their rarest words, as texts that are similar enough must."""
    rows = staged(_open(buckets, of), "open-buckets")
    many = rows.filter(F.col("outside") > FEW)
    prefix = _rarest(staged(many.select("node", "comp", "size").distinct(), "unsettled"), texts, 1)
    placed = staged(prefix.join(many.select("bucket", "node"), "node"), "rarest-words")
    keys = ["bucket", "kmer"]
    mains = staged(_main(placed, keys), "rarest-mains")
    met = mains.groupBy("bucket").agg(F.sum(F.col("outside") * F.col("members")).alias("met"))
    whole = many.groupBy("bucket").agg(F.first(F.col("outside") * F.col("members")).alias("whole"))
    by_words = staged(whole.join(met, "bucket", "left").filter(F.coalesce("met", F.lit(0)) < F.col("whole")).select("bucket"), "by-words")
    odd = texts.select("node", "odd")
    direct = staged(rows.join(by_words, "bucket", "left_anti"), "direct")
    # A pair counts in the least bucket that both have.
    own = direct.groupBy("node").agg(F.collect_set("bucket").alias("own"))
    return (
        _across(direct.join(own, "node").join(odd, "node"), ["bucket"])
        .unionByName(_sharing(placed, keys, mains.join(by_words, "bucket"), odd))
        .distinct()
    )


def _rarest(left: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """node, comp, size and the rarest k-mers of ``width`` words of each node that several classes have, with the number of
    such that are ``left`` from each on.

    As many as its best partner may lack, and one: texts that have ``SIMILARITY`` in common share one of them.
    """

    def list_kmers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [labelled_kmers(np.frombuffer(held, np.uint64), width).view(np.int64) for held in batch["words"]]
            out = batch[["node", "comp", "size"]].loc[batch.index.repeat([len(x) for x in found])]
            yield out.assign(kmer=np.concatenate(found))

    small_batches(left.sparkSession, 200)
    listed = staged(
        left.join(texts, "node").select("node", "comp", "size", "words")
        .mapInPandas(list_kmers, "node binary, comp binary, size int, kmer long"),
        "kmers",
    )
    # Those that one class alone has come first and meet no other class, so only their number matters.
    one = F.xxhash64("comp")
    common = listed.groupBy("kmer").agg(F.count(F.lit(1)).alias("held"), F.min(one).alias("first"), F.max(one).alias("last"))
    common = common.filter("first <> last").select("kmer", "held")
    ranked = listed.join(common, "kmer")
    alone = ranked.groupBy("node").agg(F.count(F.lit(1)).alias("met"), F.sort_array(F.collect_list(F.struct("held", "kmer"))).alias("kmers"))
    size = left.select("node", "comp", "size")
    spare = F.floor(F.col("size") * (1 - SIMILARITY) + 1e-9) + 1 - (F.col("size") - F.col("met"))
    return staged(
        alone.join(size, "node").filter(spare > 0)
        .select("node", "comp", "size", "met", F.posexplode(F.slice("kmers", F.lit(1), spare.cast("int"))).alias("at", "x"))
        .select("node", "comp", "size", (F.col("met") - F.col("at")).alias("left"), F.col("x.kmer").alias("kmer")),
        "rarest-kmers",
    )


def _sharing(prefix: DataFrame, keys: list[str], mains: DataFrame | None = None, odd: DataFrame | None = None) -> DataFrame:
    """Pairs of different classes with equal ``keys``, of those whose remaining k-mers are enough; with ``odd`` whose parities agree as well."""
    spread = prefix.join((_main(prefix, keys) if mains is None else mains).select(*keys, "main"), keys)
    # At the rarest k-mer that two texts share, each has to have as many left as they must have in common.
    common_least = (F.col("a_size") + F.col("b_size")) * (SIMILARITY / (1 + SIMILARITY)) - 1e-6
    return _across(spread if odd is None else spread.join(odd, "node"), keys, F.least("a_left", "b_left") >= common_least)


def _across(rows: DataFrame, keys: list[str], possible: Column | None = None) -> DataFrame:
    """Pairs of the rows outside of the main class of their keys and all that aren't of theirs, as far as sizes and parities let them link."""
    side = lambda held, name: held.select(*keys, *[F.col(x).alias(f"{name}_{x}") for x in held.columns if x not in (*keys, "main")])
    kept = [x for x in ("node", "size", "comp", "left", "odd", "own") if x in rows.columns]
    inner, outer = side(rows.select(*keys, *kept), "a"), side(rows.filter("comp <> main").select(*keys, *kept), "b")
    met = (F.col("a_comp") != F.col("b_comp")) & (F.least("a_size", "b_size") >= SIMILARITY * F.greatest("a_size", "b_size"))
    if possible is not None:
        met &= possible
    if "odd" in kept:
        unlike = sum((F.bit_count(F.col("a_odd")[at].bitwiseXOR(F.col("b_odd")[at])) for at in range(PARITIES // 64)), F.lit(0))
        met &= unlike <= (F.col("a_size") + F.col("b_size")) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6
    if "own" in kept:
        met &= F.array_min(F.array_intersect("a_own", "b_own")) == F.col("bucket")
    pairs = inner.join(outer, keys).filter(met)
    return _ordered(pairs.withColumnsRenamed({"a_node": "a", "b_node": "b"}))
