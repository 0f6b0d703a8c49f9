"""N-gram Jaccard join by prefix filters under several global orders.

A document's set holds the 64-bit hashes of its distinct shingles of ``size`` words (A-Z lower-cased);
a shorter text is one shingle. Two sets link when their Jaccard similarity is at least ``per_cent``.

1. Sets of equal content are one class and one node. Of each class the n - ceil(t n) + l(n) least
   hashes form an extended prefix; two sets that link share at least min(l) of these tokens. Classes
   with fewer tokens there that any other class has are done. These counts are exact.
2. Of the classes left, all tokens are counted. A set shares ceil(t n) of its tokens with any that it
   links to, so sets with fewer tokens that occur twice are done.
3. The usual prefix filter follows under three global orders, all with rare tokens first, ties by
   different bits of the hash: candidates share a token of the first order's prefix and must share
   one under each of the others before the whole sets are compared. The rank of a token bounds what
   sets that meet in it can share (positional filter). Frequent passages come last in all orders.

Null, empty and blank texts have an empty set and link with nothing; each is a component of its own.
Repeated rows get a row each. A null doc_id never names a component of rows that have an id. A very long
text is one array of hashes in its row. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.llm.graph import linked_components
from contest_analytics.llm.simhash import bitmap_column, in_bitmap
from contest_analytics.llm.text import SHINGLE_WORDS, let, lower_ascii, shingle_hashes, words
from contest_analytics.session import cut_lineage, scratch_scope

PER_CENT = 75
EXTRA = 16  # one token in so many extends the prefix
ROTATIONS = (21, 42)


def shingle_set(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """The distinct shingle hashes of a text in ascending order."""
    return F.sort_array(F.array_distinct(shingle_hashes(words(lower_ascii(F.coalesce(text, F.lit("")))), size)))


def _least_overlap(n: Column, per_cent: int) -> Column:
    """ceil(n * per_cent / 100): what a set of n tokens shares at least with one that it links to."""
    return F.floor((n * per_cent + 99) / 100).cast("int")


def _extra(n: Column) -> Column:
    return F.floor(n / EXTRA).cast("int") + 1


def _rotated(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def row_key(docs: DataFrame) -> Column:
    """A 64-bit hash of a row's doc_id and text; rows of equal ids and texts share it."""
    return F.xxhash64(F.col("doc_id").isNull(), F.coalesce(F.col("doc_id"), F.lit(0)), F.col("text").isNull(), F.coalesce("text", F.lit("")))


def _heads(docs: DataFrame, size: int, per_cent: int) -> DataFrame:
    """``doc_id``, ``row``, the class ``k``, the number of tokens ``n`` and the extended prefix ``head`` of every row."""

    def head(s: Column) -> Column:
        n = F.size(s)
        length = n - _least_overlap(n, per_cent) + _extra(n)
        return F.struct(F.xxhash64(s).alias("k"), n.alias("n"), F.slice(s, 1, F.least(length, n)).alias("head"))

    sets = let(shingle_set(F.col("text"), size), head)
    return docs.select("doc_id", row_key(docs).alias("row"), sets.alias("h")).select("doc_id", "row", "h.*")


def _possible(heads: DataFrame, per_cent: int) -> DataFrame:
    """Classes ``k`` that share enough of their extended prefix with others, and a ``row`` of each."""
    # Copies meet in the map-side step.
    heads = cut_lineage(heads.where("n > 0").groupBy("k", "n").agg(F.first("head").alias("head"), F.min("row").alias("row")))
    tokens = heads.select("k", "n", F.explode("head").alias("x"))
    frequent = tokens.groupBy("x").agg(F.count("*").alias("df")).where("df > 1").select("x")
    shared = tokens.join(frequent, "x").groupBy("k", "n").agg(F.count("*").alias("shared"))
    must = _extra(_least_overlap(F.col("n"), per_cent))  # the least l(n) of a partner
    return shared.where(F.col("shared") >= must).select("k").join(heads.select("k", "row"), "k")


def _nodes(sets: DataFrame, per_cent: int) -> DataFrame:
    """Sets (k, s) that may link to another: ``k, n, c, weight`` and a prefix ``p0, p1, p2`` for each order.

    ``c`` is the number of its tokens that other sets have.
    """
    tokens = sets.select("k", F.size("s").alias("n"), F.explode("s").alias("x"))
    frequent = tokens.groupBy("x").agg(F.count("*").alias("df")).where("df > 1")
    by_class = tokens.join(frequent, "x").groupBy("k", "n").agg(F.collect_list(F.struct("df", "x")).alias("shared"))
    # Tokens that occur once come first in every order and meet nobody; ``take`` is what is left of the prefix.
    take = (F.size("shared") - _least_overlap(F.col("n"), per_cent) + 1).alias("take")
    enough = by_class.select("k", "n", "shared", take, F.size("shared").alias("c")).where("take > 0")

    def prefix(rank) -> Column:
        ordered = F.sort_array(F.transform("shared", lambda t: F.struct(*rank(t), t["x"].alias("x"))))
        return F.transform(F.slice(ordered, F.lit(1), F.col("take")), lambda t: t["x"])

    orders = [prefix(lambda t: [t["df"].alias("df")])]
    for bits in ROTATIONS:
        orders.append(
            prefix(lambda t, bits=bits: [F.floor(F.log2(t["df"].cast("double"))).alias("df"), _rotated(t["x"], bits).alias("r")])
        )
    weight = F.aggregate("shared", F.lit(0.0), lambda total, t: total + F.log2(t["df"].cast("double"))) / F.col("n")
    return enough.select("k", "n", "c", weight.alias("weight"), *(p.alias(f"p{i}") for i, p in enumerate(orders)))


def _grouped(docs: DataFrame, size: int, per_cent: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row, k, n`` of every row, and (node, component) of the classes that link to others."""
    with scratch_scope(docs.sparkSession) as scope:
        heads = cut_lineage(_heads(docs, size, per_cent))  # the one pass that shingles all texts
        ids = scope.keep(heads.select("doc_id", "row", "k", "n"))
        possible = cut_lineage(_possible(heads, per_cent))
        scope.drop(heads)

        # The whole sets of possible partners only, from one row of each class. A bitmap of fixed size
        # keeps most other rows from being shingled again.
        wanted = possible.select(F.col("row").alias("x"))
        rows = docs.select("text", row_key(docs).alias("row")).where(in_bitmap(bitmap_column(wanted), F.col("row")))
        sets = rows.select("row", shingle_set(F.col("text"), size).alias("s")).where("size(s) > 0")
        sets = sets.join(possible.select("row"), "row", "left_semi").select(F.xxhash64("s").alias("k"), "s")
        sets = cut_lineage(sets.groupBy("k").agg(F.first("s").alias("s")))
        return ids, scope.keep(_linked(sets, per_cent))


def _linked(sets: DataFrame, per_cent: int) -> DataFrame:
    """(node, component) of the sets (k, s) that link to others."""
    nodes = cut_lineage(_nodes(sets, per_cent))
    # If the first token that two sets share has this rank, they share no more than the tokens from it
    # on; that bounds the sum of their sizes. The pair's first common token passes the bound.
    keys = nodes.select(F.posexplode("p0").alias("rank", "key"), F.col("k").alias("node"), "weight", "n", "c")
    most = F.floor((F.col("c") - F.col("rank")) * (100 + per_cent) / per_cent).cast("int").alias("most")
    keys = keys.select("key", "node", "weight", F.struct("n", most).alias("info"))

    def may(one: Column, other: Column) -> Column:
        both, less, more = one["n"] + other["n"], F.least(one["n"], other["n"]), F.greatest(one["n"], other["n"])
        return (both <= F.least(one["most"], other["most"])) & (less * 100 >= more * per_cent)

    def verify(pairs: DataFrame) -> DataFrame:
        def side(name: str) -> DataFrame:
            return nodes.select(F.col("k").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("p1", "p2")))

        met = pairs.join(side("a"), "a").join(side("b"), "b")
        met = met.where(F.arrays_overlap("p1_a", "p1_b") & F.arrays_overlap("p2_a", "p2_b")).select("a", "b")
        whole = met.join(sets.select(F.col("k").alias("a"), F.col("s").alias("u")), "a")
        whole = whole.join(sets.select(F.col("k").alias("b"), F.col("s").alias("v")), "b")
        shared = F.size(F.array_intersect("u", "v"))
        return whole.where(shared * 100 >= (F.size("u") + F.size("v") - shared) * per_cent)

    return linked_components(keys, verify, may)


def jaccard_components(docs: DataFrame, size: int = SHINGLE_WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the least doc_id reachable by links, of every row."""
    ids, linked = _grouped(docs, size, per_cent)
    least = ids.groupBy("k").agg(F.min("doc_id").alias("least"))
    grouped = linked.join(least, F.col("node") == F.col("k"))
    roots = grouped.groupBy("component").agg(F.min("least").alias("root"))
    root_of = grouped.join(roots, "component").select("k", "root")
    named = least.join(root_of, "k", "left").select("k", F.coalesce("root", "least").alias("root"))
    return ids.join(named, "k").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, size: int = SHINGLE_WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """One row of each component, that of least doc_id, nulls last, then of least hash; texts without words all stay.

    Of rows of equal doc_id and text one stays. Rows are told apart by doc_id and text, so a row goes only
    for a text that it links to.
    """
    ids, linked = _grouped(docs, size, per_cent)
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    of_class = ids.where("n > 0").groupBy("k").agg(F.min(first).alias("first"))  # copies meet in the map-side step
    placed = of_class.join(linked, F.col("k") == F.col("node"), "left")
    stays = placed.groupBy(F.coalesce("component", "k").alias("c")).agg(F.min("first").alias("first"))
    stays = stays.select(F.col("first.row").alias("_row"))
    blank = ~F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    with_words = docs.where(~blank).withColumn("_row", row_key(docs)).dropDuplicates(["_row"])
    return with_words.join(stays, "_row", "left_semi").drop("_row").unionByName(docs.where(blank))
