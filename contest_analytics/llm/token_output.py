"""Token ids in a bit-packed file format.

Documents are sorted by doc_id over range partitions. Each task encodes its documents and writes
files of bounded size below a shared folder, through any file system that pyarrow opens by URI. A
file gets a name of its own in every attempt; the manifest, a Parquet table that Spark commits, names
exactly one file per part, so what a lost or repeated attempt leaves is never read.

File layout, little-endian: magic ``BPK1``; uint32 bits per id, ids per block, documents, blocks;
uint64 ids; then per document its id (int64, the least value for null) and the end of its ids
(int64); per block its byte offset in the payload (int64); then the payload. A block holds its ids in
fixed width, low bits first, padded to whole 64-bit words, so any range of ids unpacks from the
blocks that cover it.

A null or empty text has only the end id. Documents of equal doc_id are sorted by a hash of their
text. Other columns are ignored. An empty table gives files of no document, or no file.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contest_analytics.llm.resampling import hashes_of, same_bytes
from contest_analytics.session import scratch_path

MAGIC, HEADER = b"BPK1", "<4sIIIIQ"
NO_ID = np.iinfo(np.int64).min
BLOCK_IDS = 4096
FILE_IDS = 1 << 20
CHUNK_CHARS = 3 << 20
KNOWN_PIECES, NEW_PIECES = 600_000, 10_000  # some 200 bytes each
MANIFEST = "part int, file_no int, path string, first_doc bigint, docs bigint, ids bigint, bytes bigint"


# --- packing ----------------------------------------------------------------------------


def bits_for(vocabulary: int) -> int:
    """The least width that holds every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> np.ndarray:
    """The ids in ``bits`` bits each, low bits first, as little-endian 64-bit words.

    64 ids fill exactly ``bits`` words, so the places of the j-th of each 64 are the same.
    """
    groups = -(-len(ids) // 64)
    table = np.zeros((groups, 64), np.uint64)
    table.reshape(-1)[: len(ids)] = ids
    out = np.zeros((groups, bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= table[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= table[:, j] >> np.uint64(64 - shift)
    return out.reshape(-1)[: -(-len(ids) * bits // 64)].astype("<u8")


def unpack_bits(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed words."""
    groups = -(-n // 64)
    table = np.zeros((groups, bits), np.uint64)
    table.reshape(-1)[: len(words)] = words[: groups * bits]
    out = np.empty((groups, 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = table[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (table[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = value & mask
    return out.reshape(-1)[:n]


def to_file(doc_ids: np.ndarray, ends: np.ndarray, ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """One file of the format; ``ends`` are the ends of the documents in ``ids``."""
    blocks = [pack_bits(ids[at : at + block_ids], bits) for at in range(0, len(ids), block_ids)]
    offsets = np.cumsum([0] + [b.nbytes for b in blocks])[:-1] if blocks else np.zeros(0)
    head = struct.pack(HEADER, MAGIC, bits, block_ids, len(doc_ids), len(blocks), len(ids))
    tables = (np.asarray(x, "<i8").tobytes() for x in (doc_ids, ends, offsets))
    return b"".join([head, *tables, *(b.tobytes() for b in blocks)])


class PackedFile:
    """Reads documents or ranges of ids from one file's bytes (or a memory map of it)."""

    def __init__(self, data: bytes | memoryview) -> None:
        magic, self.bits, self.block_ids, docs, blocks, self.n_ids = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a file of packed token ids")
        at, tables = struct.calcsize(HEADER), []
        for n in (docs, docs, blocks):
            tables.append(np.frombuffer(data, "<i8", n, at))
            at += 8 * n
        self.doc_ids, self.ends, self.offsets = tables
        self._data, self._payload = data, at

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to before ``stop``; reads only the blocks that cover them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        parts = [self._block(b) for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block_ids : stop - first * self.block_ids]

    def _block(self, b: int) -> np.ndarray:
        n = min(self.block_ids, self.n_ids - b * self.block_ids)
        words = np.frombuffer(self._data, "<u8", -(-n * self.bits // 64), self._payload + int(self.offsets[b]))
        return unpack_bits(words, self.bits, n)

    def document(self, index: int) -> np.ndarray:
        return self.ids(int(self.ends[index - 1]) if index else 0, int(self.ends[index]))


# --- encoding ---------------------------------------------------------------------------


# What lives as long as a worker process; this package's own modules travel with each task.
PROCESS = "_packed_token_encoders"
OTHER, LETTER, NUMBER, SPACE = range(4)


def char_kinds() -> np.ndarray:
    """Whether a code point is a letter, a number, a space or something else."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            kinds[[ord(c) for c in found[0]]] = kind
    return kinds


def piece_starts(codes: np.ndarray, texts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the pieces of byte-level tokenizers begin in the code points of some texts laid end to end.

    ``texts`` are the first places of the texts that are not empty. The published pattern is
    ``'(?:[sdmt]|ll|ve|re)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``: runs of one kind, of which
    a run that follows spaces takes the last one if it is a plain space, and any other last space is a
    piece. An apostrophe that begins a piece by itself takes the ending of a contraction.
    """
    n, kind = len(codes), kinds[codes]
    first = np.zeros(n + 1, bool)
    first[texts] = first[n] = True
    begins = first.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(begins)
    start, end = runs[:-1], runs[1:]
    # Spaces before something else in the same text.
    ahead = end[(kind[start] == SPACE) & ~first[end]]
    begins[ahead - 1] = True
    begins[ahead[codes[ahead - 1] == 32]] = False
    # Apostrophes by themselves before letters.
    alone = start[(codes[start] == 39) & (end - start == 1) & begins[start] & ~first[end]]
    alone = alone[kind[alone + 1] == LETTER]
    padded = np.append(codes, np.zeros(2, codes.dtype))
    one, two = padded[alone + 1], padded[alone + 2]
    short = np.isin(one, [ord(c) for c in "sdmt"])
    long = np.zeros(len(alone), bool)
    for a, b in ("ll", "ve", "re"):
        long |= (one == ord(a)) & (two == ord(b))
    long &= ~first[np.minimum(alone + 2, n)]
    begins[alone[short | long] + 1] = False
    begins[alone[short] + 2] = begins[alone[long] + 3] = True
    return np.flatnonzero(begins[:n])


class TextEncoder:
    """Encodes texts as the tokenizers library does, each distinct piece only once.

    A byte-level tokenizer splits a text into pieces and encodes each on its own. Pieces of many texts
    are found and told apart in arrays; distinct ones are looked up, and what is new goes through the
    library. A text with the string of a special token goes through the library whole, and so do all
    texts of a tokenizer of another make.
    """

    def __init__(self, tokenizer_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pre = self.tokenizer.pre_tokenizer
        plain = isinstance(pre, pre_tokenizers.ByteLevel) and getattr(pre, "use_regex", True) and not pre.add_prefix_space
        self.by_piece = plain and self.tokenizer.normalizer is None
        self.kinds = char_kinds() if self.by_piece else None
        self.known: dict[bytes, bytes] = {}

    @classmethod
    def of_process(cls, tokenizer_path: str) -> TextEncoder:
        """The process's encoder, with what it has learnt in earlier tasks."""
        held = sys.modules.setdefault(PROCESS, types.ModuleType(PROCESS)).__dict__
        if tokenizer_path not in held:
            held[tokenizer_path] = cls(tokenizer_path)
        return held[tokenizer_path]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of every text."""
        apart = [not self.by_piece or any(s in text for s in self.special) for text in texts]
        parts: list[list[np.ndarray]] = [[self.whole(text)] if alone else [] for text, alone in zip(texts, apart)]
        held, size = [], 0
        for i, (text, alone) in enumerate(zip(texts, apart)):
            for section in [] if alone else sections_of(text):
                held.append((i, section))
                size += len(section)
                if size >= CHUNK_CHARS:
                    self._encode(held, parts)
                    held, size = [], 0
        self._encode(held, parts)
        none = np.zeros(0, "<u4")
        return [p[0] if len(p) == 1 else np.concatenate([none, *p]) for p in parts]

    def _encode(self, held: Sequence[tuple[int, str]], parts: list[list[np.ndarray]]) -> None:
        sections = [s for _, s in held]
        sizes = np.array([len(s) for s in sections], np.int64)
        joined = "".join(sections)
        if not joined:
            return
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        bounds = np.cumsum(sizes) - sizes
        starts = piece_starts(codes, bounds[sizes > 0], self.kinds)
        data = joined.encode()
        at = starts
        if len(data) > len(joined):
            width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
            at = (np.cumsum(width, dtype=np.int64) - width)[starts]
        data = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
        ends = np.append(at[1:], len(data) - 8)

        hashes = hashes_of(data, at, ends)
        _, chosen, number = np.unique(hashes, return_index=True, return_inverse=True)
        same = ends - at == (ends - at)[chosen][number]
        same[same] = same_bytes(data, at[same], at[chosen[number[same]]], (ends - at)[same])
        odd = np.flatnonzero(~same)  # another piece with the hash of an earlier one
        number[odd] = len(chosen) + np.arange(len(odd))
        chosen = np.append(chosen, odd)
        ids = self._ids([data[a:b].tobytes() for a, b in zip(at[chosen].tolist(), ends[chosen].tolist())])

        counts = np.array([len(x) // 4 for x in ids], np.int64)
        flat, offset = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(counts) - counts
        own = counts[number]
        before = np.cumsum(own) - own
        total = int(own.sum())
        stream = flat[np.arange(total) + np.repeat(offset[number] - before, own)]
        cuts = np.append(before, total)[np.searchsorted(starts, np.append(bounds, len(joined)))]
        for (i, _), a, b in zip(held, cuts[:-1].tolist(), cuts[1:].tolist()):
            parts[i].append(stream[a:b])

    def _ids(self, pieces: Sequence[bytes]) -> list[bytes]:
        """The packed ids of distinct pieces; the library sees only those that are not known yet."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > KNOWN_PIECES:
            self.known = {p: self.known[p] for p in pieces if p in self.known}
        for at in range(0, len(new), NEW_PIECES):
            part = new[at : at + NEW_PIECES]
            found = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            self.known.update(zip(part, [array("I", e.ids).tobytes() for e in found]))
        return [self.known[p] for p in pieces]


CUT = re.compile(r"(?<=\S)\s")


def sections_of(text: str) -> Iterator[str]:
    """A long text cut before a space that follows something else, where a piece ends in any case."""
    at = 0
    while len(text) - at > CHUNK_CHARS:
        cut = CUT.search(text, at + CHUNK_CHARS)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


# --- writing and reading ----------------------------------------------------------------


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI; without a scheme it lies on Hadoop's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/(?!/)", "file:///", uri)


def encoded(batch: pa.RecordBatch, encoder: TextEncoder) -> Iterator[tuple[int | None, np.ndarray]]:
    """The doc_id and ids of a batch's rows, encoded together up to a bound of characters."""
    doc_ids = batch.column("doc_id").to_pylist()
    held, size, done = [], 0, 0
    for text in batch.column("text"):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= CHUNK_CHARS or done + len(held) == len(doc_ids):
            yield from zip(doc_ids[done : done + len(held)], encoder.encode(held))
            done += len(held)
            held, size = [], 0


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, parts: int | None = None) -> DataFrame:
    """Encode, append ``end_id`` to each document and write the files; returns the manifest.

    ``folder`` is a URI that all executors reach. Files come in ascending doc_id order by
    (part, file_no); a null doc_id comes first.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    location = qualified(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = TextEncoder.of_process(tokenizer_path)
        bits, part, file_no = bits_for(max(end_id + 1, encoder.vocabulary)), TaskContext.get().partitionId(), 0
        store, base = fs.FileSystem.from_uri(location)
        store.create_dir(base, recursive=True)
        doc_ids: list[int] = []
        held: list[np.ndarray] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal n_held, file_no
            data = to_file(doc_ids, np.cumsum([len(x) for x in held]), np.concatenate(held), bits)
            path = f"{base}/{part:06d}-{file_no:04d}-{uuid.uuid4().hex}.bpk"
            with store.open_output_stream(path) as out:
                out.write(data)
            row = (part, file_no, f"{location.rstrip('/')}/{path.rsplit('/', 1)[1]}", doc_ids[0], len(doc_ids), n_held, len(data))
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            doc_ids.clear(), held.clear()
            n_held, file_no = 0, file_no + 1
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for doc_id, ids in (row for batch in batches for row in encoded(batch, encoder)):
            ids = np.append(ids, np.uint32(end_id))
            if held and n_held + len(ids) > FILE_IDS:
                yield flush()
            doc_ids.append(NO_ID if doc_id is None else doc_id)
            held.append(ids)
            n_held += len(ids)
        if held:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("_text_hash")]
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("_text_hash"))
    written = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest_path = f"{folder}/manifest"
    written.mapInArrow(write, MANIFEST).write.parquet(manifest_path)
    return spark.read.schema(MANIFEST).parquet(manifest_path)


def read_tokens(manifest: DataFrame, map_files: Callable[[PackedFile, int], pd.DataFrame], schema: str) -> DataFrame:
    """``map_files(file, ids before it)`` for every file of the manifest, one file at a time in a task."""
    spark = manifest.sparkSession
    # One row per file; bounded by the number of files, not of documents.
    in_order = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("ids").over(in_order), F.lit(0)))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, before in zip(batch["path"], batch["before"]):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    yield map_files(PackedFile(file.read()), int(before))

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.select("path", "before").repartition(tasks, "path").mapInPandas(read, schema)


def document_digests(file: PackedFile, before: int) -> pd.DataFrame:
    """A row per document of a file: its place in the whole stream and the checksum of its ids."""
    ids, starts = file.ids(0, file.n_ids).astype("<u4"), np.concatenate([[0], file.ends[:-1]])
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if d == NO_ID else int(d) for d in file.doc_ids], "Int64"),
            "start": before + starts,
            "n_tokens": file.ends - starts,
            "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, file.ends)],
        }
    )


DIGESTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def token_digests(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write the documents below the scratch folder and read every file back."""
    manifest = write_tokens(docs, scratch_path(docs.sparkSession, "tokens"), tokenizer_path, end_id)
    return read_tokens(manifest, document_digests, DIGESTS)
