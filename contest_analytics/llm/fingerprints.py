"""One-permutation MinHash fingerprints with optimal densification and packed low-order bits.

The hashes of a text's distinct 5-word shingles are dealt once into bins by their high bits; a bin
keeps its least hash. An empty bin takes the value of another: it tries ``PROBES`` bins at random and
then all filled bins in a random order of its own, so every empty bin has one fixed sequence of bins
that all texts share (optimal densification), and the search always ends. Of each bin the low-order
bits of a hash of (value, bin number) are kept. Two different values agree in b bits by chance with
probability 2^-b; the likeness takes that out. That needs chance to be independent from bin to bin, which
copies of one value would not be: a text of one shingle has one value in all bins. With the bin number
hashed in, copies in different bins differ, and equal texts still agree.

A text with fewer than five words is one shingle; a very long text is one array of hashes in its row. A
null, empty or blank text has no shingles and the empty fingerprint; it is like itself and unlike all
others. Equal texts have equal fingerprints, so repeated rows do. An empty table gives an empty result;
columns are taken and added by the caller's names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contest_analytics.llm.text import let, shingle_hashes, words
from contest_analytics.session import cut_lineage

BINS, BITS, PROBES = 256, 4, 8
VALUE_BITS = 64 - (BINS.bit_length() - 1)
NEIGHBOUR_ROWS = 5_000


def bin_values(text: Column) -> Column:
    """For each bin the least hash that falls in it, or null; an empty array for a text without words."""
    most = (1 << VALUE_BITS) - 1
    signed = [b - BINS if b >= BINS // 2 else b for b in range(BINS)]
    # Hash of every bin that is above all others in it, so that each bin has a first entry when sorted.
    guards = F.array(*(F.lit((b << VALUE_BITS) | most) for b in signed))

    def firsts(hashes: Column) -> Column:
        in_order = F.sort_array(F.concat(hashes, guards))
        heads = let(
            in_order,
            lambda h: F.filter(
                h, lambda x, i: F.coalesce(F.shiftrightunsigned(x.bitwiseXOR(F.get(h, i - 1)), VALUE_BITS) != 0, F.lit(True))
            ),
        )
        values = F.transform(heads, lambda x: F.when(x.bitwiseAND(F.lit(most)) != most, x.bitwiseAND(F.lit(most))))
        return F.when(F.size(hashes) > 0, values).otherwise(F.array().cast("array<bigint>"))

    return let(shingle_hashes(words(text)), firsts)


def densify(values: Column) -> Column:
    """Fill the empty bins from filled ones."""

    def probed(bins: Column) -> Column:
        def probe(i: Column, attempt: int) -> Column:
            return F.get(bins, F.pmod(F.xxhash64(i, F.lit(attempt)), F.lit(BINS)).cast("int"))

        return F.transform(bins, lambda v, i: F.coalesce(v, *(probe(i, attempt) for attempt in range(PROBES))))

    def rest(bins: Column, half: Column) -> Column:
        numbered = F.filter(
            F.transform(bins, lambda v, i: F.struct(i.alias("no"), v.alias("value"))), lambda f: f["value"].isNotNull()
        )

        def nearest(filled: Column, i: Column) -> Column:
            """Of the filled bins the first in bin i's own order."""
            own_order = lambda f: F.struct(F.xxhash64(i, f["no"], F.lit(PROBES)), f["value"].alias("value"))
            return F.array_min(F.transform(filled, own_order))["value"]

        return let(numbered, lambda filled: F.transform(half, lambda v, i: F.coalesce(v, nearest(filled, i))))

    def fill(bins: Column) -> Column:
        return let(probed(bins), lambda half: F.when(F.exists(half, F.isnull), rest(bins, half)).otherwise(half))

    return let(values, fill)


def fingerprint(text: Column) -> Column:
    """The low-order bits of every bin's hashed value, packed: one hexadecimal digit a bin; empty without words."""
    low = F.lit((1 << BITS) - 1)
    digits = F.transform(densify(bin_values(text)), lambda v, i: F.hex(F.xxhash64(v, i).bitwiseAND(low)))
    return F.lower(F.array_join(digits, ""))


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets of two fingerprints, from 0 to 1."""
    equal = F.length(F.replace(F.array_join(F.transform(
        F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.when(one.substr(i, F.lit(1)) == other.substr(i, F.lit(1)), "1").otherwise("0")
    ), ""), F.lit("0"), F.lit("")))
    chance = 1.0 / (1 << BITS)
    estimate = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when(one == other, 1.0).when((one == "") | (other == ""), 0.0).otherwise(estimate)


def with_next(docs: DataFrame, added: dict[str, Callable[[Column], Column]], text: str = "text") -> DataFrame:
    """The columns ``doc_id``, ``text`` and ``added`` (made of the text) of every row, and all but the id as
    ``next_<column>`` of the next document by descending doc_id; after the last comes the first.

    Rows are dealt by ranges of doc_id, null ids (which come last) by ranges of the text's hash. Each
    range also gets a copy of the first row of the next one, so that every row's next is in its range.
    Ties are ordered by the hash of the text. Columns are added after the rows were dealt, once a row.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = docs.count()
    ranges = max(1, min(-(-n // NEIGHBOUR_ROWS), 4 * parts))
    ids = docs.select(F.col("doc_id").cast("double").alias("_id"))
    cuts = sorted(set(ids.approxQuantile("_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges))) if ranges > 1 else []
    # Numbers of ranges rise with the order: falling ids first, then null ids by hash.
    narrow = docs.select("doc_id", F.col(text).alias("text"))
    narrow = narrow.withColumn("_neg", -F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    of_id = F.lit(0)
    if cuts:
        splits = [-float("inf"), *(-c for c in reversed(cuts)), float("inf")]
        narrow = Bucketizer(splits=splits, inputCol="_neg", outputCol="_bucket").transform(narrow)
        of_id = F.col("_bucket").cast("int")
    share = F.shiftrightunsigned(F.xxhash64("text").bitwiseXOR(F.lit(-(2**63))), 32) * F.lit(ranges)
    of_null = F.lit(len(cuts) + 1) + F.shiftright(share, 32).cast("int")
    narrow = narrow.withColumn("_range", F.when(F.col("doc_id").isNull(), of_null).otherwise(of_id))
    order = F.struct(F.col("doc_id").isNull(), -F.coalesce("doc_id", F.lit(0)), F.xxhash64("text"))
    rows = narrow.select("doc_id", "text", "_range", order.alias("_order"))

    # A row per range, without texts; then the texts of these few rows.
    heads = cut_lineage(rows.groupBy("_range").agg(F.min("_order").alias("_head")))
    around = Window.orderBy("_range")
    ring = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_range").over(around), F.last("_range").over(ring)).alias("_before")
    heads = heads.select("_range", "_head", before)
    found = rows.join(F.broadcast(heads), "_range").where("_order = _head")
    found = found.groupBy("_before").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    guests = found.select("doc_id", "text", F.col("_before").alias("_range"), order.alias("_order"), F.lit(True).alias("_guest"))

    dealt = rows.withColumn("_guest", F.lit(False)).unionByName(guests)
    dealt = dealt.repartitionByRange(len(cuts) + 1 + ranges, "_range")
    filled = dealt.select("*", *(make(F.col("text")).alias(name) for name, make in added.items()))
    record = F.struct("text", *added)
    led = filled.withColumn("_next", F.lead(record).over(Window.partitionBy("_range").orderBy("_guest", "_order")))
    names = ["text", *added]
    return led.where("NOT _guest").select("doc_id", *names, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in names))


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as many first code points of the following text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third))
