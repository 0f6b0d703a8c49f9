"""Words and word shingles as built-in column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
BLANKS = " \t\n\x0b\f\r"
OTHER_UPPER = "[[\\p{IsUppercase}\\p{Lt}\\p{Cn}]&&[^\\x00-\\x7F]]"  # with what the pattern's tables do not know yet
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, also where a lambda repeats it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case. ``lower`` is faster, and the same where no other letter has a lower case."""
    return F.when(text.rlike(OTHER_UPPER), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    """Maximal runs of anything but the six ASCII blanks; null and blank texts have none.

    Splitting at a plain space is several times as fast as at a pattern, so other blanks become
    spaces first and empty parts go only where two blanks meet.
    """
    spaced = F.coalesce(text, F.lit(""))
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))

    def parts(plain: Column) -> Column:
        every = F.split(plain, " ")
        dense = F.when(plain.contains("  "), F.filter(every, lambda word: word != "")).otherwise(every)
        return F.when(plain == "", F.array().cast("array<string>")).otherwise(dense)

    return let(F.trim(spaced), parts)


def shingle_hashes(tokens: Column, size: int = SHINGLE_WORDS) -> Column:
    """One 64-bit hash per run of ``size`` words, in order and with repeats.

    Fewer words form one shingle; no words form none.
    """

    def hashes(w: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(size))),
        )
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= size, several).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(none)

    return let(tokens, hashes)
