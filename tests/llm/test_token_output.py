"""Packed token files: exact round trips, random access and the contract's digests."""

import random
import zlib

import numpy as np
import pytest
from conftest import SMALL
from hard_cases import hard_docs, no_docs  # noqa: F401

from contest_analytics.llm import queries, token_output as T


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 16, 17, 31, 32])
@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_pack_round_trip(bits, n):
    ids = np.random.default_rng(bits * n).integers(0, 1 << bits, n, dtype=np.uint64)
    packed = T.pack_bits(ids, bits)
    assert packed.nbytes == -(-n * bits // 64) * 8
    assert (T.unpack_bits(packed, bits, n) == ids).all()


def test_file_random_access():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_257, n, dtype=np.uint32) for n in (1, 5, 0, 700, 3)]
    data = T.to_file(np.arange(5), np.cumsum([len(d) for d in docs]), np.concatenate(docs), T.bits_for(50_257), 64)
    file = T.PackedFile(data)
    assert file.bits == 16
    for i, doc in enumerate(docs):
        assert (file.document(i) == doc).all()
    whole = np.concatenate(docs)
    for a, b in ((0, 0), (0, 1), (63, 65), (100, 500), (0, len(whole))):
        assert (file.ids(a, b) == whole[a:b]).all()
    with pytest.raises(ValueError):
        T.PackedFile(b"x" * 100)


def plain(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    start, out = 0, []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_equal_to_the_library(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = sorted(tuple(r) for r in queries.op10_token_files(spark, SMALL).collect())
    assert found == plain([tuple(r) for r in docs])


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_odd_pieces_equal_the_library():
    encoder, tokenizer = T.TextEncoder(queries.tokenizer_path()), library()
    assert encoder.vocabulary == 50_257
    texts = ["", " ", "  a   b\n\n c\t", "it's we'LL they're 'x", "é漢字😀 12³ ½ a1b2", "x<|endoftext|>y", "   z ", "a" * 3000]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode([]) == []


def test_pieces_follow_the_published_pattern():
    import regex

    pattern = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    kinds, rng = T.char_kinds(), random.Random(5)
    parts = ["'", "'", "s", "t", "ll", "ve", "re", "d", " ", "  ", "\n", "\t", " ", "é", "漢", "😀", "1", "٣", "!", "a", "Z", "'ll"]
    for _ in range(3000):
        texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(rng.randint(1, 3))]
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        firsts = np.cumsum([0] + [len(t) for t in texts])
        want = [at + m.start() for at, t in zip(firsts, texts) for m in pattern.finditer(t)]
        assert T.piece_starts(codes, firsts[:-1], kinds).tolist() == want


def test_bounds_change_nothing(spark, monkeypatch):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(30).collect()]
    texts += ["no-cut" * 500, "", "tail   \n" * 200]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    for known, chars, new in ((20, 3 << 20, 7), (10**6, 50, 10_000), (300, 1000, 100)):
        monkeypatch.setattr(T, "KNOWN_PIECES", known)
        monkeypatch.setattr(T, "CHUNK_CHARS", chars)
        monkeypatch.setattr(T, "NEW_PIECES", new)
        encoder = T.TextEncoder(queries.tokenizer_path())
        for _ in range(2):
            assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(T, "hashes_of", lambda data, start, end: np.zeros(len(start), np.uint64))
    texts = ["some words and some more", "", "other words"]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in T.TextEncoder(queries.tokenizer_path()).encode(texts)] == want


def test_folders_become_uris(spark, tmp_path):
    assert T.qualified(spark, f"{tmp_path}/x") == f"file://{tmp_path}/x"
    assert T.qualified(spark, f"file:{tmp_path}/x") == f"file://{tmp_path}/x"


def test_hard_rows(hard_docs, no_docs):
    found = T.token_digests(hard_docs, queries.tokenizer_path()).orderBy("start").collect()
    assert len(found) == hard_docs.count()
    assert found[0].doc_id is None and [r.doc_id for r in found[1:]] == sorted(r.doc_id for r in found[1:])
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))
    assert [r.n_tokens for r in found if r.doc_id in (0, 3)] == [1, 1]
    assert T.token_digests(no_docs, queries.tokenizer_path()).count() == 0


def test_many_files(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole = sorted(tuple(r) for r in T.token_digests(docs, queries.tokenizer_path()).collect())
    monkeypatch.setattr(T, "FILE_IDS", 2000)
    assert sorted(tuple(r) for r in T.token_digests(docs, queries.tokenizer_path()).collect()) == whole
