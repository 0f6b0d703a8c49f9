"""64-bit SimHash and bitmaps of hashes as built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.llm.text import let

BITMAP_BITS = 22  # 2^22 bits are 512 kB, whatever the number of hashes


def _lane_simhash(hashes: Column, width: int) -> Column:
    """SimHash with the counts of 64 / width bits in lanes of one 64-bit sum; up to 2^width - 1 hashes."""
    lanes = range(0, 64, width)
    ones = sum(1 << lane for lane in lanes)
    mask = F.lit(ones if ones < 1 << 63 else ones - (1 << 64))
    zero = F.struct(*(F.lit(0).cast("bigint").alias(f"s{j}") for j in range(width)))

    def add(sums: Column, x: Column) -> Column:
        return F.struct(
            *((sums[f"s{j}"] + F.shiftrightunsigned(x, j).bitwiseAND(mask)).alias(f"s{j}") for j in range(width))
        )

    def bits(sums: Column) -> Column:
        out, none = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
        for j in range(width):
            for lane in lanes:
                count = F.shiftrightunsigned(sums[f"s{j}"], lane).bitwiseAND(F.lit((1 << width) - 1))
                value = 1 << (j + lane) if j + lane < 63 else -(1 << 63)
                out = out.bitwiseOR(F.when(count * 2 > F.size(hashes), F.lit(value)).otherwise(none))
        return out

    return let(F.aggregate(hashes, zero, add), bits)


def simhash(hashes: Column) -> Column:
    """SimHash of an array of 64-bit hashes; repeats add weight. Few hashes take the narrow lanes."""

    def fitting(h: Column) -> Column:
        return F.when(F.size(h) < 128, _lane_simhash(h, 8)).otherwise(_lane_simhash(h, 32))

    return let(hashes, fitting)


def _adder(one: str, two: str, three: str, total: str, carry: str) -> list[Column]:
    """Sum and carry of three bits in each of 64 places."""
    a, b, c = F.col(one), F.col(two), F.col(three)
    half = a.bitwiseXOR(b)
    return [half.bitwiseXOR(c).alias(total), a.bitwiseAND(b).bitwiseOR(c.bitwiseAND(half)).alias(carry)]


def simhash_words(rows: DataFrame, words: str) -> DataFrame:
    """The rows with the SimHash ``f`` of the words in place of the array ``words``, which has one at least.

    What ``simhash`` makes of the words' hashes, in compiled code: seven words become one row of three bit planes,
    and the planes' bits are summed in lanes of 32. Rows equal in all other columns become one, with the
    same SimHash; together they may have 2^30 words.
    """
    keys = [c for c in rows.columns if c != words]
    size, at, none = F.size(words), F.col("_at"), F.lit(0).cast("bigint")
    seven = rows.select("*", F.explode(F.sequence(F.lit(0), size - 1, F.lit(7))).alias("_at"))
    hashes = [F.when(at + i < size, F.xxhash64(F.get(words, at + i))).otherwise(none).alias(f"_x{i}") for i in range(7)]
    # One step at a time: a column that is used twice would be computed twice in a step of its own.
    planes = seven.select(*keys, F.least(size - at, F.lit(7)).alias("_n"), *hashes)
    planes = planes.select(*keys, "_n", "_x6", *_adder("_x0", "_x1", "_x2", "_u", "_c0"), *_adder("_x3", "_x4", "_x5", "_v", "_c1"))
    planes = planes.select(*keys, "_n", "_c0", "_c1", *_adder("_u", "_v", "_x6", "_p0", "_c2"))
    planes = planes.select(*keys, "_n", "_p0", *_adder("_c0", "_c1", "_c2", "_p1", "_p2"))
    ones = F.lit((1 << 32) + 1)  # the lowest bit of both lanes

    def lane_sum(j: int) -> Column:
        bits = [F.shiftleft(F.shiftrightunsigned(f"_p{k}", j).bitwiseAND(ones), k) for k in range(3)]
        return F.sum(bits[0] + bits[1] + bits[2]).alias(f"_s{j}")

    sums = planes.groupBy(*keys).agg(F.sum("_n").alias("_n"), *(lane_sum(j) for j in range(32)))
    # Bit 30 of a lane is set where more than half of the words have the bit.
    sums = sums.withColumn("_bias", (F.lit((1 << 30) - 1) - F.shiftright("_n", 1)) * ones)
    set_bits = [F.shiftleft(F.shiftrightunsigned(F.col(f"_s{j}") + F.col("_bias"), 30).bitwiseAND(ones), j) for j in range(32)]
    return sums.select(*keys, reduce(Column.bitwiseOR, set_bits).alias("f"))


def hamming(one: Column, other: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(other))


def _places(x: Column) -> list[Column]:
    """The bit positions of a hash in the bitmap."""
    mask = F.lit((1 << BITMAP_BITS) - 1)
    return [x.bitwiseAND(mask), F.shiftrightunsigned(x, BITMAP_BITS).bitwiseAND(mask)]


def bitmap_column(hashes: DataFrame) -> Column:
    """The bitmap of the column ``x`` as a literal array of 64-bit words; its size is fixed."""
    place = hashes.select(F.explode(F.array(*_places(F.col("x")))).alias("p"))
    set_words = place.groupBy(F.shiftright("p", 6).cast("int").alias("no")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word")
    )
    word_of = {row.no: row.word for row in set_words.collect()}  # at most 2^16 rows
    listed = ",".join(str(word_of.get(no, 0)) for no in range(1 << (BITMAP_BITS - 6)))
    return F.split(F.lit(listed), ",").cast("array<bigint>")


def in_bitmap(bitmap: Column, x: Column) -> Column:
    """Whether the bitmap may hold a hash; a hash that it holds always passes."""

    def bit(p: Column) -> Column:
        return F.getbit(F.get(bitmap, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1

    first, second = _places(x)
    return bit(first) & bit(second)
