"""Find secrets: fixed patterns, and incompressible strings in a sensitive context.

The patterns give spans of the kinds assign, access and hex. Besides, a string of code characters
that follows a sensitive word closely is a candidate; its novelty is the
number of bytes that it adds to the zstandard-compressed surroundings, for each of its own bytes,
with a dictionary of identifiers loaded into the compressor. What neither the surroundings nor the
dictionary explain is reported as a span of the kind novel; of letters or digits alone only what hardly
compresses at all, since long words are such strings. The word has to start within ``NEAR`` code points
before the string, and ``AROUND`` code points on either side are its surroundings.

Offsets count code points, ends are exclusive. Null and empty texts have no spans. A candidate that
overlaps a pattern's span is not reported again. Repeated rows give the same spans each. Very long texts
are scanned whole. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
SPANS = "array<struct<start:bigint,kind_no:int,kind:string,end:bigint,novelty:double>>"

SPAN_TYPE = pa.list_(
    pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("kind", pa.string()), ("end", pa.int64()), ("novelty", pa.float64())])
)

# The patterns of the base kinds and the least lengths of their matches.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # the matches of HEX that are long enough
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

CONTEXT = re.compile(
    r"passphrase|passw|pwd|secret|token|key|auth|bearer|credential|private|signature|session|cookie|jwt|dsn", re.I | re.A
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_~=-]{16,}")
DIGIT, LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
NEAR, AROUND, LEAST_NOVELTY = 64, 512, 0.7
LEAST_OF_ONE_KIND = 0.9  # of letters or digits alone, such as long words

IDENTIFIERS = " ".join(
    f"{a}{b}"
    for a in (
        "get_ set_ is_ has_ to_ from_ read_ write_ open_ close_ load_ save_ create_ update_ delete_ find_ parse_ format_ "
        "client_ server_ user_ access_ refresh_ session_ request_ response_ config_ database_ connection_ default_ "
        "self. this. os.environ. process.env. System.getenv. import. return. public. private. static. const. string."
    ).split()
    for b in (
        "password secret token api_key access_key secret_key private_key client_id user_name email address host port url "
        "path file name value index count length list map string bytes buffer stream session request response error "
        "message timestamp version 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ example localhost"
    ).split()
)


def base_spans(text: str) -> list[tuple[int, int, str, int, float | None]]:
    """The spans of the fixed patterns, leftmost first and without overlap within a kind."""
    found = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append((m.start(), 0, "assign", m.end(), None))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                found.append((m.start(), 1, "access", m.end(), None))
    found += [(m.start(), 2, "hex", m.end(), None) for m in LONG_HEX.finditer(text)]
    return found


class NoveltyMeter:
    """Bytes that a string adds to its compressed surroundings, for each of its bytes."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 9) -> None:
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._size = lambda data: len(
            zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_dict_id=False).compress(data)
        )

    def __call__(self, text: str, start: int, end: int) -> float:
        before = text[max(0, start - AROUND) : start].encode()
        after = text[end : end + AROUND].encode()
        own = text[start:end].encode()
        return (self._size(before + after + own) - self._size(before + after)) / len(own)


def novel_spans(
    text: str, known: list[tuple[int, int, str, int, float | None]], meter: NoveltyMeter, least: float = LEAST_NOVELTY
) -> list[tuple[int, int, str, int, float | None]]:
    """Incompressible candidates that start within ``NEAR`` code points after a sensitive word."""
    found, taken, reach = [], sorted((s, e) for s, _, _, e, _ in known), -1
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, e in taken):
            continue
        if CONTEXT.search(text, max(0, start - NEAR), start) and start >= reach:
            novelty = meter(text, start, end)
            if novelty >= (least if DIGIT.search(m[0]) and LETTER.search(m[0]) else max(least, LEAST_OF_ONE_KIND)):
                found.append((start, 3, "novel", end, round(novelty, 4)))
                reach = end
    return found


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``, sorted by start and kind, of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = NoveltyMeter()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                spans = base_spans(text or "")
                rows.append(sorted(spans + novel_spans(text or "", spans, meter)) if text else [])
            names = ("start", "kind_no", "kind", "end", "novelty")
            out = [[dict(zip(names, span)) for span in spans] for spans in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, SPAN_TYPE)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, f"doc_id bigint, spans {SPANS}")


def joined_spans(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
