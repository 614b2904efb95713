"""Packing: exact ids per piece, gapless sequences, first-fit decreasing."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from gamelake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check(pieces, rows, tokenizer):
    """``rows``: (doc_id, text), distinct doc_ids."""
    by = {}
    for p in pieces:
        by.setdefault(p["doc_id"], []).append(p)
    assert set(by) == {d for d, _ in rows}
    for d, text in rows:
        ids = np.asarray(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(by[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at: at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for part in sequences.values():
        at = 0
        for p in sorted(part, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= packing.LENGTH
    return sequences


def test_whole_documents(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    sequences = check(packing.pack(docs, PATH).collect(), rows, tokenizer)
    fill = [sum(p["length"] for p in s) for s in sequences.values()]
    assert sum(fill) / (packing.LENGTH * len(fill)) > 0.98


def test_edge_rows(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, "a  b \n\n　c <|endoftext|> 's it's"), (4, "word " * 60000), (5, "x" * 9000),
            (6, "\n\n\n  \t lead and trail \r\n "), (7, "é" * 10)]
    df = spark.createDataFrame([(i, t, 3, 9) for i, t in rows], "doc_id long, text string, group int, start int")
    check(packing.pack(df, PATH).collect(), rows, tokenizer)
    assert packing.pack(df.limit(0), PATH).count() == 0
    twice = packing.pack(df.unionByName(df).filter("doc_id = 7"), PATH).collect()
    assert len(twice) == 2 and sorted(p["offset"] for p in twice)[0] == 0


def test_full_cache_starts_anew(monkeypatch, tokenizer):
    import pyarrow as pa

    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    words = packing.WordIds(PATH)
    for text in ("one two three four", "four five six seven eight nine", "one two ten"):
        [(block)] = list(packing.blocks.text_blocks(pa.array([text])))
        assert words.block(block)[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_as_in_a_default_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer

    default = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "no token here", "a<|endoftext|>b<|endoftext|>", "half <|endof", "text|> half", "x\u3000y <|endoftext|>", ""]
    got = [ids.tolist() for _, ids in packing.token_rows(pa.array(texts), PATH, added=True)]
    assert got == [default.encode(t, add_special_tokens=False).ids + [packing.END_ID] for t in texts]
    assert 50256 in got[0] and 50256 not in list(packing.token_rows(pa.array(texts), PATH))[0][1]


def test_first_fit_decreasing_equals_plain_first_fit():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 500):
        sizes = np.sort(rng.integers(1, 2049, n))[::-1]
        room, plain = [], []
        for s in sizes:
            at = next((i for i, r in enumerate(room) if r >= s), len(room))
            if at == len(room):
                room.append(2048)
            room[at] -= s
            plain.append(at)
        assert packing.first_fit_decreasing(sizes).tolist() == plain
