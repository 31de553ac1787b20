from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from llm_helpers import awkward, by_id, documents, nothing

from obsgrid.llm import bpe
from obsgrid.llm.queries import QUERIES

RANKS = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
    )


def expected(library, text):
    data = (text or "").encode()
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(data).hexdigest()


def test_query(spark, sf_dir, library):
    got = by_id(QUERIES["op8_byte_bpe"](spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        row = got[d["doc_id"]]
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == expected(library, d["text"])


def test_awkward_texts_and_the_way_back(spark, library):
    rng = random.Random(5)
    texts = ["".join(chr(rng.choice([*range(1, 600), 0x4E2D, 0x1F600, 0x200D, 0xA0])) for _ in range(80)) for _ in range(60)]
    texts += ["aaaaaaaaaaaaaaaaaaaaaaaaaa", "<|endoftext|>", "a\r\n\r\n  b   ", "it's we'll I'D", None, ""]
    encoded = bpe.encode(documents(spark, texts))
    got = by_id(encoded)
    for i, text in enumerate(texts):
        assert got[i]["ids"] == library.encode_ordinary(text or "")
    back = by_id(bpe.decode(encoded))
    assert [back[i]["text"] for i in range(len(texts))] == [t or "" for t in texts]
    rows = bpe.encode(awkward(spark)).collect()
    assert len(rows) == 8
    for r, d in zip(sorted(rows, key=lambda r: r["doc_id"]), sorted(awkward(spark).collect(), key=lambda r: r["doc_id"])):
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(library, d["text"])
    assert bpe.encode(nothing(spark)).count() == 0
    assert bpe.decode(nothing(spark).selectExpr("doc_id", "cast(null as array<int>) ids")).count() == 0


def test_small_blocks_and_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 7)
    monkeypatch.setattr(bpe, "MERGED_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 10)
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 40)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    texts = [" ".join(f"word{i * j % 13}é" for i in range(j)) for j in range(1, 40, 5)] + ["", "x"]
    ids, data = [[] for _ in texts], [b""] * len(texts)
    for doc, words in codec.pieces(texts):
        found, counts = codec.encode(words)
        of_id = np.repeat(doc, counts)
        for number, part in codec.decode(of_id, found).items():
            data[number] += part
        for number, i in zip(of_id.tolist(), found.tolist()):
            ids[number].append(i)
    assert ids == [library.encode_ordinary(t) for t in texts]
    assert data == [t.encode() for t in texts]


def test_a_rank_table_of_one_s_own(spark, tmp_path):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"abab": 259}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + f" {r}\n".encode() for t, r in ranks.items()))
    own = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["abc", "bcabab", "ababab", "abbc", "cab abc"]
    got = by_id(bpe.encode(documents(spark, texts), path=str(path)))
    assert [got[i]["ids"] for i in range(len(texts))] == [own.encode_ordinary(t) for t in texts]


def test_long_words_merge_in_rounds(library, monkeypatch):
    assert bpe.reachable(RANKS)
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(n)) for n in (3, 64, 65, 300, 900)]
    words += ["a" * 501, "ab" * 200, "é" * 100, "aab" * 99, "x"]
    want = [library.encode_ordinary(w) for w in words]
    for rows in (bpe.LONG_ROWS, 9000):
        monkeypatch.setattr(bpe, "LONG_ROWS", rows)
        for every in (True, False):
            ids, counts = bpe.Codec(RANKS, public_tokenizers.PATTERN, every).encode(words)
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_ranks_below_those_of_their_parts(spark, tmp_path):
    """A merge may make a pair of lower rank here, so one place at a time is merged."""
    ranks = {bytes([i]): i for i in range(256)} | {b"xyz": 256, b"yz": 257, b"zx": 258, b"xyzx": 259, b"yzy": 260}
    assert not bpe.reachable(ranks)
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + f" {r}\n".encode() for t, r in ranks.items()))
    own = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["xyz" * 40, *("".join(rng.choice("xyz") for _ in range(150)) for _ in range(20))]
    got = by_id(bpe.encode(documents(spark, texts), path=str(path)))
    assert [got[i]["ids"] for i in range(len(texts))] == [own.encode_ordinary(t) for t in texts]
