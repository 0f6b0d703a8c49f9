"""Remove passages that occur more than once, by suffix arrays over shared neighbourhoods.

A byte goes when some string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same
or another document; strings never cross documents and are judged on the input.

1. Every string ("window") has a least 64-byte hash, its minimizer; consecutive windows with one
   minimizer position make a run of at most 337 windows. Equal windows have equal minimizers, so only
   runs of one minimizer need comparing. Runs are counted by minimizer and content over all documents:
   the windows of a content that occurs twice are repeated, and a minimizer with one content is done.
2. A window that two contents share reaches ``SIDE`` bytes beyond the minimizer's gram on one side at
   least. So a content that has neither its left nor its right side with its gram in common with another
   content of its minimizer is done, too: most of those that only share a short line are.
3. The other contents are cut from one text each and dealt by minimizer. Each such bin becomes one text,
   whose suffix array is built by Lyndon grouping (module ``lyndon``); neighbours in it that share
   ``LENGTH`` bytes, compared byte for byte, are repeated windows.
4. A minimizer with more than ``BIN_BYTES`` of such content, such as the edge of a very common passage,
   is not gathered in one task: its windows are counted by a 128-bit hash instead, over all tasks.

Runs of a content that holds more than a thousandth of all runs are placed by a broadcast, of which there
are at most a thousand; the others by a join. Documents of equal content (64-bit hash and length) have
their passages repeated by definition.

A null text is empty. Texts below ``LENGTH`` bytes stay whole. Repeated rows remove each other where
they are long enough. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contest_analytics.llm.lyndon import suffix_arrays
from contest_analytics.llm.simhash import bitmap_column, in_bitmap
from contest_analytics.llm.text import let
from contest_analytics.session import Scope, cut_lineage, scratch_scope

LENGTH, GRAM = 400, 64
PLACE_BITS = 20
SIDE = (LENGTH - GRAM) // 2
PIECE_BYTES = (1 << PLACE_BITS) - 512  # with LENGTH more bytes its places fit in PLACE_BITS
# The suffix arrays of a batch take about a hundred times its bytes.
BIN_BYTES, BATCH_BYTES, HELD_BYTES = 32_768, 1 << 19, 8 << 20
OUT_BYTES = 4 << 20  # a record batch on its way out of a task
HOT_SHARE = 1000  # a hot content has more than one in so many runs
RUNS = "k bigint, start bigint, n int, m bigint, d binary, hl bigint, hr bigint"
WINDOWS = "m bigint, d binary, w binary, lo int"
REPEATED = "m bigint, d binary, lo int, hi int"
KEPT = "doc_id bigint, n_bytes bigint, spans array<struct<lo:bigint,hi:bigint>>, kept binary"


# --- runs -------------------------------------------------------------------------------


def minimizer_keys(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For every window the least hash of its grams, high bits only, and below it the gram's place.

    Of equal grams the leftmost counts, so windows of one run have their grams at one place, and a
    window that recurs within a periodic passage does so in another run.
    """
    mix = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64)  # a code for each byte
    h, m = mix[data], 1
    while m < gram:  # from hashes of m bytes to hashes of 2 m bytes
        h = h[:-m] * np.uint64(pow(0x9E3779B97F4A7C15, m, 1 << 64)) + h[m:]
        m *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    key = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    width, m = length - gram + 1, 1
    while 2 * m <= width:
        key = np.minimum(key[:-m], key[m:])
        m *= 2
    return np.minimum(key[: len(key) - (width - m)], key[width - m :])


def runs_of(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, bytes, int | None, int | None]]:
    """(start, number of windows, minimizer, bytes, hashes of both sides) of the runs of one text.

    A side is the gram with ``SIDE`` bytes before or after it, where the run's bytes have so many. Long
    texts go in pieces.
    """
    mask = (1 << PLACE_BITS) - 1
    for at in range(0, len(data) - length + 1, PIECE_BYTES):
        piece = data[at : at + PIECE_BYTES + length - 1]
        keys = minimizer_keys(np.frombuffer(piece, np.uint8), length)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts = np.append(0, cuts).tolist()
        ends = np.append(cuts, len(keys)).tolist()
        for a, b, key in zip(starts, ends, keys[starts].tolist()):
            g, end = key & mask, b + length - 1
            left = side_key(piece[g - SIDE : g + GRAM]) if g - a >= SIDE else None
            right = side_key(piece[g : g + GRAM + SIDE]) if end - g - GRAM >= SIDE else None
            yield at + a, b - a, key >> PLACE_BITS, piece[a:end], left, right


def side_key(side: bytes) -> int:
    return xxhash.xxh3_64_intdigest(side) - (1 << 63)


def content_key(content: bytes) -> bytes:
    return xxhash.xxh3_128_digest(content)


def _arrow(schema: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def _emit(rows: Iterator[tuple], schema: str, most: int = 20_000, bytes_most: int = OUT_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= most or size >= bytes_most:
            yield _arrow(schema, [list(c) for c in zip(*held)])
            held, size = [], 0
    if held:
        yield _arrow(schema, [list(c) for c in zip(*held)])


def find_runs(texts: DataFrame) -> DataFrame:
    """The runs of all texts (k, text). Of copies in one task two are reported, which tells that they repeat."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for k, text in zip(batch.column("k").to_pylist(), batch.column("text").cast(pa.binary())):
                    seen[k] = seen.get(k, 0) + 1
                    if seen[k] <= 2:
                        for start, n, m, content, left, right in runs_of(text.as_py()):
                            yield k, start, n, m, content_key(content), left, right

        yield from _emit(rows(), RUNS)

    return texts.select("k", "text").mapInArrow(scan, RUNS)


def undecided(counts: DataFrame) -> DataFrame:
    """The contents (m, d, n, k, start) that may share a window with another one of their minimizer."""
    by_m = counts.groupBy("m").agg(F.count("*").alias("contents")).where("contents > 1").select("m")
    several = cut_lineage(counts.join(by_m, "m", "left_semi").select("m", "d", "n", "k", "start", "hl", "hr"))
    sides = several.select("m", "d", F.posexplode(F.array("hl", "hr")).alias("side", "h")).where("h IS NOT NULL")
    common = sides.groupBy("m", "side", "h").agg(F.count("*").alias("c")).where("c > 1").select("m", "side", "h")
    meet = sides.join(common, ["m", "side", "h"], "left_semi").select("m", "d").distinct()
    return several.join(meet, ["m", "d"], "left_semi").select("m", "d", "n", "k", "start")


def find_contents(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(m, d, content, large) of the contents ``wanted``, each cut from one text that has it."""
    of_bin = wanted.groupBy("m").agg((F.sum(F.col("n") + LENGTH - 1) > BIN_BYTES).alias("large"))
    by_text = wanted.join(of_bin, "m").groupBy("k").agg(F.collect_list(F.struct("m", "d", "start", "n", "large")).alias("runs"))
    by_text = cut_lineage(by_text)
    bitmap = bitmap_column(by_text.select(F.col("k").alias("x")))
    held = texts.select("k", "text").where(in_bitmap(bitmap, F.col("k"))).groupBy("k").agg(F.first("text").alias("text"))

    def cuts(body: Column) -> Column:
        def cut(r: Column) -> Column:
            content = F.substring(body, (r["start"] + 1).cast("int"), r["n"] + F.lit(LENGTH - 1))
            return F.struct(r["m"].alias("m"), r["d"].alias("d"), content.alias("content"), r["large"].alias("large"))

        return F.transform("runs", cut)

    parts = held.join(by_text, "k").select(let(F.col("text").cast("binary"), cuts).alias("parts"))
    return parts.select(F.explode("parts").alias("p")).select("p.*")


def window_keys(contents: DataFrame) -> DataFrame:
    """The hash and offset of every window of the contents of large minimizers, each content once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for m, d, content in zip(*(batch.column(c).to_pylist() for c in ("m", "d", "content"))):
                    for i in range(len(content) - LENGTH + 1):
                        yield m, d, content_key(content[i : i + LENGTH]), i

        yield from _emit(rows(), WINDOWS)

    once = contents.where("large").groupBy("m", "d").agg(F.first("content").alias("content"))
    return once.mapInArrow(scan, WINDOWS)


# --- suffix arrays ----------------------------------------------------------------------


def repeated_windows(texts: list[list[bytes]], length: int = LENGTH) -> list[list[np.ndarray]]:
    """For each bin of distinct contents, and each content, which of its windows another place of the bin has."""
    sizes = [[len(c) for c in contents] for contents in texts]
    joined = b"\0".join(b"\0".join(contents) for contents in texts) + b"\0"
    data = np.frombuffer(joined, np.uint8)
    symbols = data.astype(np.int64) + 1
    starts = np.cumsum([0] + [n + 1 for own in sizes for n in own])
    symbols[starts[1:] - 1] = 0  # below all bytes
    bounds = np.cumsum([0] + [sum(own) + len(own) for own in sizes])
    order = suffix_arrays(symbols, bounds)

    room = np.zeros(len(data), np.int64)  # bytes from a place to the end of its content
    for a, b in zip(starts[:-1], starts[1:]):
        room[a:b] = np.arange(b - a - 1, -1, -1)
    one, two = order[:-1], order[1:]
    same_bin = np.ones(len(one), bool)
    same_bin[bounds[1:-1] - 1] = False
    pair = np.flatnonzero(same_bin & (room[one] >= length) & (room[two] >= length))
    words = np.zeros(len(data), np.uint64)
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    for j in range(8):
        words |= padded[j : j + len(data)] << np.uint64(8 * j)
    for step in [*range(0, length - 7, 8), length - 8]:  # eight bytes at a time
        pair = pair[words[one[pair] + step] == words[two[pair] + step]]
    found = np.zeros(len(data), bool)
    found[one[pair]] = found[two[pair]] = True
    out, at = [], iter(starts[:-1].tolist())
    for own in sizes:  # own goes first, so that no start is lost at its end
        out.append([found[a : a + n - length + 1] for n, a in zip(own, at)])
    return out


def spans_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def solve_bins(bins: list[tuple[int, list[tuple[bytes, bytes]]]]) -> Iterator[tuple[int, bytes, int, int]]:
    """The repeated windows of bins of (d, content), a batch of ``BATCH_BYTES`` at a time."""
    bins.sort(key=lambda b: sum(len(c) for _, c in b[1]))  # bins of like size take like many steps
    part, size = [], 0
    for i, (m, own) in enumerate(bins):
        part.append((m, own))
        size += sum(len(c) for _, c in own)
        if size >= BATCH_BYTES or i == len(bins) - 1:
            flags = repeated_windows([[c for _, c in own] for _, own in part])
            for (m_, own_), found in zip(part, flags):
                for (d, _), f in zip(own_, found):
                    for lo, hi in spans_of(f):
                        yield m_, d, lo, hi
            part, size = [], 0


def decide_bins(contents: DataFrame) -> DataFrame:
    """Repeated windows of the contents of each minimizer, as ranges [lo, hi) of window offsets."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            held, size, m_now, own = [], 0, None, []
            for batch in batches:
                for m, d, content in zip(*(batch.column(c).to_pylist() for c in ("m", "d", "content"))):
                    if m != m_now:
                        if len(own) > 1:
                            held.append((m_now, own))
                            size += sum(len(c) for _, c in own)
                        m_now, own = m, []
                        if size >= HELD_BYTES:
                            yield from solve_bins(held)
                            held, size = [], 0
                    if not own or own[-1][0] != d:
                        own.append((d, content))
            if len(own) > 1:
                held.append((m_now, own))
            if held:
                yield from solve_bins(held)

        yield from _emit(rows(), REPEATED)

    tasks = int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contents.where("NOT large").select("m", "d", "content").repartition(tasks, "m")
    return dealt.sortWithinPartitions("m", "d").mapInArrow(decide, REPEATED)


# --- documents --------------------------------------------------------------------------


def removed_spans(texts: DataFrame) -> DataFrame:
    """``k`` and ``spans``, byte ranges that may overlap, of the texts (k, text) that lose bytes."""
    with scratch_scope(texts.sparkSession) as scope:
        return scope.keep(_removed_spans(texts, scope))


def _removed_spans(texts: DataFrame, scope: Scope) -> DataFrame:
    runs = cut_lineage(find_runs(texts))
    place = F.min(F.struct("k", "start")).alias("at")
    sides = [F.first(c).alias(c) for c in ("n", "hl", "hr")]
    counts = runs.groupBy("m", "d").agg(F.count("*").alias("times"), place, *sides)
    counts = cut_lineage(counts.select("m", "d", "times", "n", "at.k", "at.start", "hl", "hr"))
    wanted = cut_lineage(undecided(counts))
    contents = cut_lineage(find_contents(texts, wanted))
    windows = cut_lineage(window_keys(contents))
    often = windows.groupBy("w").agg(F.count("*").alias("c")).where("c > 1").select("w")
    counted = windows.join(often, "w", "left_semi").select("m", "d", "lo", (F.col("lo") + 1).alias("hi"))
    whole = counts.where("times > 1").select("m", "d", F.lit(0).alias("lo"), F.col("n").alias("hi"))
    repeated = whole.union(decide_bins(contents)).union(counted)
    repeated = cut_lineage(repeated.groupBy("m", "d").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")))
    for done in (contents, windows, wanted):
        scope.drop(done)

    least = runs.count() // HOT_SHARE
    hot = cut_lineage(counts.where(F.col("times") > least).select("m", "d"))
    hot_ranges = repeated.join(F.broadcast(hot), ["m", "d"], "left_semi")
    places = runs.select("k", "start", "m", "d")
    often_placed = places.join(F.broadcast(hot_ranges), ["m", "d"])
    rest = places.join(F.broadcast(hot), ["m", "d"], "left_anti").join(repeated, ["m", "d"])
    placed = often_placed.unionByName(rest).select("k", "start", F.explode("ranges").alias("r"))
    spans = placed.select(
        "k", (F.col("start") + F.col("r.lo")).alias("lo"), (F.col("start") + F.col("r.hi") + LENGTH - 1).alias("hi")
    )
    return spans.groupBy("k").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges covered by ranges."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as in ``KEPT`` of (doc_id, text, spans), in record batches of bounded size."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.binary()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "spans", "kept"])

    for batch in batches:
        rows, size = [], 0
        for doc_id, body, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("spans")):
            data = body.as_py()
            gone = merged([(s["lo"], s["hi"]) for s in spans.as_py() or []])
            edges = [0, *(e for span in gone for e in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            rows.append((doc_id, len(data), [{"lo": a, "hi": b} for a, b in gone], kept))
            size += len(kept)
            if size >= OUT_BYTES:
                yield made(rows)
                rows, size = [], 0
        yield made(rows)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, the text's ``n_bytes``, its removed byte ranges ``spans`` and ``kept`` bytes, of every row."""
    text = F.coalesce("text", F.lit(""))
    # Equal texts, and only they, have equal keys but for a chance of 2^-64 a pair.
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text, F.octet_length(text)).alias("k"))
    long = texts.where(F.octet_length("text") >= LENGTH)
    joined = texts.join(removed_spans(long), "k", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut_spans, KEPT)
