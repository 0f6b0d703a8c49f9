"""Find benchmark items in documents: exact similarity of the weighted word shingles of item-sized windows.

Texts are lower-cased and lose everything but letters, digits and blanks. A window is a run of as
many 5-word shingles as an item has; its similarity to the item is the sum of least over the sum of
greatest shingle weights, a shingle weighing its number of occurrences. A Bloom bitmap of fixed size,
built from all items, keeps positions that no item shares out of the shuffle, and an exact join gives
the places of a document that it shares with an item. Every window counts, in whatever order the
shared shingles stand: one can move right to its next shared place, or to the last window, without
losing any, so only windows that begin there are looked at. Of them those with fewer shared places
than the threshold needs are left out, which loses none, and all others are compared exactly. The
``start`` is that of the first best window among these. The SimHash ``distance`` is reported and
decides nothing: windows at the threshold lie beyond any radius that still selects.
``hamming_pairs`` finds fingerprints within a radius where only fingerprints are at hand: they are cut
into blocks, and two within ``radius`` differ in some block by at most radius / blocks bits, so the
items' blocks are indexed with all such changes and none within the radius is missed.

A null, empty or blank text has no shingles and contains nothing. A text or item of fewer than five
words is one shingle, which only an equal whole text has. A document shorter than an item is one
window. Rows of equal doc_id count as one document; repeated items are found alike, and items
without item_id are ignored. Very long texts
are one array of hashes in their row. Other columns are ignored. Without documents or items the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.llm.simhash import bitmap_column, hamming, in_bitmap, simhash
from contest_analytics.llm.text import let, shingle_hashes, words
from contest_analytics.session import cut_lineage

BLOCKS, BLOCK_BITS = 4, 16
PER_CENT = 75


def normal_shingles(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+", "")
    return shingle_hashes(words(plain))


def _blocks(fingerprint: Column) -> Column:
    """(block number, block value) of a fingerprint."""
    mask = F.lit((1 << BLOCK_BITS) - 1)
    return F.array(
        *(
            F.struct(
                F.lit(b).alias("block"),
                F.shiftrightunsigned(fingerprint, b * BLOCK_BITS).bitwiseAND(mask).cast("int").alias("value"),
            )
            for b in range(BLOCKS)
        )
    )


def hamming_pairs(windows: DataFrame, items: DataFrame, radius: int) -> DataFrame:
    """All (w, item_id, distance) with fingerprints within ``radius``; windows (w, f), items (item_id, f)."""
    changes = F.expr(f"filter(sequence(0, {(1 << BLOCK_BITS) - 1}), m -> bit_count(m) <= {radius // BLOCKS})")
    index = (
        items.select("item_id", F.col("f").alias("g"), F.explode(_blocks(F.col("f"))).alias("b"))
        .select("item_id", "g", "b", F.explode(changes).alias("change"))
        .select("item_id", "g", "b.block", F.col("b.value").bitwiseXOR(F.col("change")).alias("value"))
    )
    probes = windows.select("w", "f", F.explode(_blocks(F.col("f"))).alias("b")).select("w", "f", "b.*")
    distance = hamming(F.col("f"), F.col("g"))
    near = probes.join(index, ["block", "value"]).where(distance <= radius)
    return near.select("w", "item_id", distance.alias("distance")).distinct()


def shared_weight(one: Column, other: Column) -> Column:
    """Sum over the common hashes of the lesser number of occurrences."""

    def count(hashes: Column, x: Column) -> Column:
        return F.size(F.filter(hashes, lambda y: y == x))

    return F.aggregate(
        F.array_intersect(one, other), F.lit(0), lambda total, x: total + F.least(count(one, x), count(other, x))
    )


def find_leaks(docs: DataFrame, items: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """A row for each document and item that it contains.

    ``doc_id, item_id``; ``similarity`` of the best window, its SimHash ``distance``, first word
    ``start`` and number of ``words``.
    """
    benchmark = cut_lineage(items.select("item_id", normal_shingles(F.col("text")).alias("v")).where("item_id IS NOT NULL AND size(v) > 0"))
    named = benchmark.select("item_id", F.xxhash64("v").alias("q"))
    contents = benchmark.groupBy(F.xxhash64("v").alias("q")).agg(F.first("v").alias("u"))
    contents = cut_lineage(contents.select("q", "u", simhash(F.col("u")).alias("g")))
    marks = contents.select("q", F.size("u").alias("m"), F.explode(F.array_distinct("u")).alias("x"))
    bitmap = bitmap_column(marks.select("x").distinct())

    def hit_row(h: Column) -> Column:
        hits = F.array_compact(F.transform(h, lambda x, i: F.when(in_bitmap(bitmap, x), i)))
        return let(hits, lambda at: F.when(F.size(at) > 0, F.array(F.struct(h.alias("h"), at.alias("hits")))))

    # explode_outer, so that the expression is not evaluated again in a filter below it
    rows = docs.select("doc_id", F.explode_outer(let(normal_shingles(F.col("text")), hit_row)).alias("r"))
    found = rows.where("r IS NOT NULL").select("doc_id", F.xxhash64("r.h").alias("k"), "r.h", "r.hits")
    found = cut_lineage(found)

    texts = found.groupBy("k").agg(F.first("h").alias("h"), F.first("hits").alias("hits"))
    seeds = texts.select("k", F.size("h").alias("length"), F.posexplode("hits").alias("_", "at"), "h")
    seeds = seeds.select("k", "length", "at", F.get("h", F.col("at")).alias("x"))
    shared = seeds.join(marks, "x").groupBy("k", "q", "length", "m").agg(F.sort_array(F.collect_list("at")).alias("at"))
    n = F.least("m", "length")
    need = F.ceil((n + F.col("m")) * per_cent / (100 + per_cent)).cast("int")  # shared weight at the threshold
    spots = shared.withColumn("n", n).withColumn("need", need)
    # A shared place opens a window if as many shared places as are needed lie in it; near the end, the last window.
    starts = F.transform(
        "at",
        lambda place, i: F.when(
            F.get(F.col("at"), i + F.col("need") - 1) < place + F.col("n"), F.least(place, F.col("length") - F.col("n"))
        ),
    )
    spots = spots.where("size(at) >= need").select("k", "q", "n", F.array_distinct(F.array_compact(starts)).alias("starts"))
    cuts = F.transform(
        "starts", lambda start: F.struct(start.alias("start"), F.slice(F.col("h"), start + 1, F.col("n")).alias("v"))
    )
    windows = spots.where("size(starts) > 0").join(texts.select("k", "h"), "k").select("k", "q", "n", F.explode(cuts).alias("c"))
    windows = cut_lineage(windows.select("k", "q", "n", "c.*", F.xxhash64("c.v").alias("w")))

    pairs = windows.groupBy("w", "q").agg(F.first("v").alias("v")).join(contents, "q")
    both = F.size("v") + F.size("u")
    pairs = pairs.select("w", "q", "v", "g", both.alias("both"), shared_weight(F.col("v"), F.col("u")).alias("shared"))
    pairs = cut_lineage(pairs).where(F.col("shared") * 100 >= (F.col("both") - F.col("shared")) * per_cent)
    similarity = F.round(F.col("shared") / (F.col("both") - F.col("shared")), 6)
    pairs = pairs.select("w", "q", similarity.alias("similarity"), hamming(simhash(F.col("v")), F.col("g")).alias("distance"))

    spotted = windows.select("w", "q", "k", "start", "n").join(pairs, ["w", "q"])
    best = F.max(F.struct("similarity", (-F.col("start")).alias("first"), (-F.col("distance")).alias("near"), "n"))
    by_text = spotted.groupBy("k", "q").agg(best.alias("b")).join(named, "q")
    by_doc = found.select("doc_id", "k").join(by_text, "k").groupBy("doc_id", "item_id").agg(F.max("b").alias("b"))
    return by_doc.select(
        "doc_id",
        "item_id",
        "b.similarity",
        (-F.col("b.near")).alias("distance"),
        (-F.col("b.first")).alias("start"),
        (F.col("b.n") + 4).alias("words"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item; rows without doc_id stay."""
    leaks = find_leaks(docs, items, **options).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, F.col("doc_id") == F.col("_leak"), "left_anti")
