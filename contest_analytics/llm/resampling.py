"""Draw documents whose n-grams are likely under a target: importance weights over hashed n-gram
buckets, interned in an open-addressed NumPy table, and a Gumbel top-k draw.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased; features are all runs
of 1 to ``grams`` consecutive words, joined by one space, with repeats. A feature's bucket is the CRC-32
of its UTF-8 bytes modulo ``buckets``. A bucket's gain is the floored, scaled log ratio of its smoothed
shares in the target and in the documents; a document weighs the sum of its features' gains.

In a task, texts are taken in batches of bounded bytes (long texts in pieces, cut between words). A
batch's features are interned in one table of arrays: an occurrence probes from its xxhash64 on; an
empty slot is claimed, a slot of equal hash whose first occurrence has the same bytes is its own, any
other is passed. Each slot stores the bucket and the count of its feature. The first pass adds the
counts up by bucket, so a task sends ``buckets`` rows at most; the second gathers every occurrence's
gain by its slot.

The documents are ranked by range: rows are range-partitioned by score, written, counted by partition
and numbered within it, so no task and no driver sees all of them. Scores get Gumbel noise from a hash
of ``seed:doc_id``, which makes the best k a draw without replacement; reruns agree.

A null text has no words and a text without words weighs 0. A null doc_id is hashed as an empty string
and ranks after others of its score. Repeated rows count, weigh and rank as rows of their own. Without
documents the result is empty; without target texts the gains follow from the smoothing alone. Other
columns may be kept; ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contest_analytics.session import cut_lineage

GRAMS, BUCKETS, LEAST_WORDS, SHARE, SEED = 1, 10_000, 20, (10, 100), 2024
CHUNK_BYTES = 4 << 20
ADDED = ("n_words", "n_features", "weight")

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")


# --- features of a batch ----------------------------------------------------------------


def pieces_of(body: bytes, grams: int, most: int) -> Iterator[tuple[bytes, int]]:
    """A lower-cased text in pieces cut between words, and how many words a piece repeats from the last one."""
    at, carried = 0, []
    while True:
        cut = NO_WORD.search(body, at + most) if at + most < len(body) else None
        piece = b" ".join([*carried, body[at : cut.start() if cut else len(body)]])
        yield piece, len(carried)
        if cut is None:
            return
        at = cut.start()
        carried = WORD.findall(piece)[1 - grams :] if grams > 1 else []


def batches_of(texts: Sequence[bytes | None], grams: int, most: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """Pieces (row, bytes, words repeated) of all texts, about ``most`` bytes at a time."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for piece, again in pieces_of((text or b"").translate(LOWER), grams, most):
            held.append((row, piece, again))
            size += len(piece)
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


class Features:
    """All features of some pieces: places [start, end) in ``data``, the row, and the rows' words."""

    def __init__(self, pieces: Sequence[tuple[int, bytes, int]], grams: int) -> None:
        raw = np.frombuffer(b"\n".join([p for _, p, _ in pieces]) + b"\n", np.uint8)
        word = IS_WORD[raw]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], word]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]  # the last byte is no word, so every word ends
        bounds = np.cumsum([len(p) + 1 for _, p, _ in pieces])
        piece = np.searchsorted(bounds, starts, "right")
        first = np.searchsorted(piece, np.arange(len(pieces)))
        place = np.arange(len(starts)) - first[piece]  # number of the word in its piece
        row = np.array([r for r, _, _ in pieces], np.int64)
        again = np.array([a for _, _, a in pieces], np.int64)

        # Words end to end with one space between them, so that an n-gram is one run of bytes.
        spaced, keep = raw.copy(), word
        spaced[ends], keep[ends] = 32, True
        sizes = ends - starts
        self.data = np.concatenate([spaced[keep], np.zeros(8, np.uint8)])
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        stop = begin + sizes
        parts = []
        for k in range(1, grams + 1):
            n = max(0, len(starts) - k + 1)
            last = slice(k - 1, k - 1 + n)
            new = (piece[:n] == piece[last]) & (place[last] >= again[piece[last]])
            parts.append((begin[:n][new], stop[last][new], row[piece[:n][new]]))
        self.start, self.end, self.row = (np.concatenate(c) for c in zip(*parts))
        self.words = row[piece[place >= again[piece]]]  # the row of every word

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


# The multipliers of XXH64.
P1, P2, P3, P4, P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _wide(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number, as a view; ``data`` ends with eight spare bytes."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))


def hashes_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of many runs of bytes; runs of one length at once, long ones by the library."""
    out, size, wide = np.empty(len(start), np.uint64), end - start, _wide(data)
    for n in np.unique(size).tolist():
        own = np.flatnonzero(size == n)
        at = start[own]
        if n >= 32:
            out[own] = [xxhash.xxh64_intdigest(data[a : a + n]) for a in at.tolist()]
            continue
        h = np.full(len(own), P5 + np.uint64(n))
        done = 0
        while n - done >= 8:
            h = _turned(h ^ (_turned(wide[at + done] * P2, 31) * P1), 27) * P1 + P4
            done += 8
        if n - done >= 4:
            h = _turned(h ^ ((wide[at + done] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
            done += 4
        for j in range(done, n):
            h = _turned(h ^ (data[at + j].astype(np.uint64) * P5), 11) * P1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        out[own] = h ^ (h >> np.uint64(32))
    return out


def same_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from the places ``one`` and ``other`` are equal."""
    wide, equal = _wide(data), np.ones(len(one), bool)
    open_, done = np.flatnonzero(one != other), 0
    while len(open_):
        left = size[open_] - done
        differ = wide[one[open_] + done] ^ wide[other[open_] + done]
        differ = np.where(left < 8, differ << (8 * np.clip(8 - left, 0, 7)).astype(np.uint64), differ)
        equal[open_[differ != 0]] = False
        open_, done = open_[(differ == 0) & (left > 8)], done + 8
    return equal


class GramTable:
    """The distinct features of a batch in an open-addressed table.

    ``slot`` is every occurrence's slot; a slot in use has the hash ``key``, its first ``occurrence``,
    ``bucket`` and ``count``.
    """

    def __init__(self, features: Features, buckets: int, hashes: np.ndarray | None = None) -> None:
        n = len(features.start)
        hashes = hashes_of(features.data, features.start, features.end) if hashes is None else hashes
        capacity = 1 << max(4, (2 * n).bit_length())  # at most half full
        self.key, self.occurrence = np.zeros(capacity, np.uint64), np.full(capacity, -1, np.int64)
        self.slot = (hashes & np.uint64(capacity - 1)).astype(np.int64)
        size, waiting = features.end - features.start, np.arange(n)
        while len(waiting):
            at = self.slot[waiting]
            claims = waiting[self.occurrence[at] < 0]
            self.occurrence[self.slot[claims]] = claims  # one of those that claim a slot gets it
            self.key[self.slot[claims]] = hashes[self.occurrence[self.slot[claims]]]
            holder = self.occurrence[at]
            own = (self.key[at] == hashes[waiting]) & (size[holder] == size[waiting])
            like = np.flatnonzero(own)
            own[like] = same_bytes(
                features.data, features.start[waiting[like]], features.start[holder[like]], size[waiting[like]]
            )
            waiting = waiting[~own]
            self.slot[waiting] = (self.slot[waiting] + 1) & (capacity - 1)
        self.used = np.flatnonzero(self.occurrence >= 0)
        self.count = np.bincount(self.slot, minlength=capacity)
        self.bucket = np.zeros(capacity, np.int64)
        self.bucket[self.used] = [zlib.crc32(features.bytes_of(i)) % buckets for i in self.occurrence[self.used].tolist()]

    def by_bucket(self, buckets: int) -> np.ndarray:
        """The number of occurrences in each bucket."""
        return np.bincount(self.bucket[self.used], self.count[self.used], buckets).astype(np.int64)


# --- passes -----------------------------------------------------------------------------


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and the number ``n`` of features that all texts (column ``text``) have in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            texts_ = batch.column("text").cast(pa.binary()).to_pylist()
            for pieces in batches_of(texts_, grams, CHUNK_BYTES):
                total += GramTable(Features(pieces, grams), buckets).by_bucket(buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * log ratio) of every bucket; ``buckets`` numbers, whatever the tables' size."""
    counts = []
    for table in (target, docs):
        own = np.zeros(buckets, np.int64)
        for row in bucket_counts(table, grams, buckets).collect():  # at most ``buckets`` rows
            own[row.bucket] = row.n
        counts.append(own.tolist())
    t_all, s_all = (float(sum(c) + buckets) for c in counts)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for t, s in zip(*counts)], np.int64)


def weigh(
    docs: DataFrame, gain: np.ndarray, grams: int = GRAMS, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` of every row with ``n_words``, ``n_features`` and ``weight``."""
    keep = [c for c in keep if c not in ADDED]
    fields = [docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in ADDED]

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((len(ADDED), batch.num_rows), np.int64)
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            for pieces in batches_of(texts, grams, CHUNK_BYTES):
                features = Features(pieces, grams)
                table = GramTable(features, len(gain))
                of_slot = gain[table.bucket]
                for line, (rows, values) in zip(
                    out, [(features.words, None), (features.row, None), (features.row, of_slot[table.slot])]
                ):
                    line += np.bincount(rows, values, batch.num_rows).astype(np.int64)
            columns = batch.columns[:-1] + [pa.array(line) for line in out]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *ADDED])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(weighed, T.StructType(fields))


def ranked(rows: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """Rows numbered 1, 2, 3, ... by ``order``, which has to be a strict one, without one task for all.

    The rows are dealt by range and written; a partition's numbers follow from those before it.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = dealt.withColumn("_at", number).join(F.broadcast(before), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    grams: int = GRAMS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    share: tuple[int, int] = SHARE,
    seed: int = SEED,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Every document with ``n_words``, ``n_features``, ``weight``, ``score`` and its ``rank`` in the draw, or null.

    Drawn are ``share`` (numerator, denominator) of the documents with ``least_words`` words at least.
    ``keep`` are the columns to carry (default all).
    """
    keep = docs.columns if keep is None else keep
    keep = [c for c in keep if c not in ("score", "rank")]
    weighed = weigh(docs, gains(docs, target, grams, buckets), grams, [*keep, *([] if "doc_id" in keep else ["doc_id"])])
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    scored = cut_lineage(scored.withColumn("_row", F.monotonically_increasing_id()))
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * share[0] // share[1]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    numbered = ranked(scored.where(enough), order)
    in_draw = numbered.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    columns = [*(c for c in keep if c not in ADDED), *ADDED, "score", "rank"]
    return in_draw.select(*columns).unionByName(rest.select(*columns))
