from __future__ import annotations

import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import awkward, documents, nothing
from obsgrid.llm import packing
from obsgrid.llm.queries import QUERIES
from tokenizers import Tokenizer

PATH = public_tokenizers.path(packing.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return packing.Coder(open(PATH, encoding="utf-8").read())


def whole(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def padding(length):
    return 0 if length & (length - 1) == 0 else 2048 - length


def check(rows, ids_of):
    """Every id in one piece, sequences without gaps; returns the share of padding."""
    docs, sequences = {}, {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert docs.keys() == ids_of.keys()
    for doc_id, pieces in docs.items():
        ids, at = ids_of[doc_id], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            at += r["length"]
            part = np.array(ids[r["start"] : at], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
        assert at == len(ids)
    pad = total = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        pad, total = pad + padding(at), total + at
    return pad / max(1, total)


def test_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op12_packing"](spark, sf_dir).collect()
    assert check(rows, {d["doc_id"]: whole(library, d["text"]) for d in docs}) < 0.01


def test_chunks_give_the_ids_of_whole_texts(library, coder, monkeypatch):
    rng = random.Random(8)
    signs = [*range(32, 127), *range(0xA0, 0x250), *range(0x300, 0x310), 9, 10, 0x1C, 0x85, 0x2003, 0x3A3, 0x4E2D, 0x1E9E, 0xAC00, 0x1F600, 0x130]
    for limit in (10, 400_000):
        monkeypatch.setattr(packing, "KNOWN", limit)
        monkeypatch.setattr(packing, "SLICE", 40)
        for _ in range(400):
            weights = [6 if 97 <= s < 123 or s == 32 else 1 for s in signs]
            text = "".join(map(chr, rng.choices(signs, weights, k=rng.randint(0, 90))))
            ids, ends = coder.encode(text)
            assert np.frombuffer(ids, "<u4").tolist() == whole(library, text)[:-1], text
            assert len(ids) // 4 == ends[-1]
    for text in ("a<|endoftext|>b. C", "<|ENDOFTEXT|> x", "It's we'LL. I'd, \"so.\" 3.14!?", "Σας ΣΑΣ."):
        assert np.frombuffer(coder.encode(text)[0], "<u4").tolist() == whole(library, text)[:-1]


def cheapest(at, penalty, window):
    best = {0: 0}
    for j in range(1, len(at)):
        costs = []
        for i in range(j):
            n = at[j] - at[i]
            if n <= window:
                pad = 0 if n & (n - 1) == 0 else window - n
                costs.append(best[i] + pad + penalty[j] + packing.SEQUENCE)
        best[j] = min(costs)
    return best[len(at) - 1]


def test_the_windows_are_the_cheapest():
    rng = random.Random(6)
    for _ in range(200):
        at = [0]
        for _ in range(rng.randint(1, 60)):
            at.append(at[-1] + rng.randint(1, 9))
        penalty = [0, *(rng.choice([0, 2, 24]) for _ in at[1:])]
        chosen = packing.cuts(at, penalty, 32)
        assert chosen[-1] == len(at) - 1
        cost, last = 0, 0
        for j in chosen:
            n = at[j] - at[last]
            assert n <= 32
            cost += (0 if n & (n - 1) == 0 else 32 - n) + penalty[j] + packing.SEQUENCE
            last = j
        assert cost == cheapest(at, penalty, 32)


def test_horizons_and_long_texts(spark, library, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["one", "two.", "drei", "x!"]) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    texts += [" ".join(["word"] * 30_000), "y" * 9_000]
    packer = packing.Packer(0, True)
    monkeypatch.setattr(packing, "HORIZON", 12_000)
    coder = packing.Coder(open(PATH, encoding="utf-8").read())
    end, rows = np.array([1], "<u4").tobytes(), []
    for i, text in enumerate(texts):
        ids, ends = coder.encode(text)
        for some in packer.add(i, ids + end, ends):
            rows += some
    rows += packer.finish()
    ids_of = {i: whole(library, t) for i, t in enumerate(texts)}
    named = [dict(zip(packer.COLUMNS, r)) for r in rows]
    assert check(named, ids_of) < 0.01
    assert all(r["ids"].tolist() == ids_of[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in named)


def test_awkward_tables(spark, library):
    rows = awkward(spark).dropDuplicates(["doc_id"]).coalesce(1)
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    got = packing.pack(rows).collect()
    check(got, {i: whole(library, t) for i, t in texts.items()})
    assert all(r["ids"] == whole(library, texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]] for r in got)
    twice = packing.pack(awkward(spark).coalesce(1), with_ids=False)
    assert sum(r["length"] for r in twice.collect()) == sum(len(whole(library, r["text"])) for r in awkward(spark).collect())
    assert "ids" not in twice.columns
    assert packing.pack(nothing(spark)).count() == 0
    none = packing.pack(documents(spark, ["a b", None]).selectExpr("cast(null as long) doc_id", "text"))
    assert {(r["doc_id"], r["doc_tokens"]) for r in none.collect()} == {(None, 3), (None, 1)}


def test_speed(coder):
    began = time.time()
    at = list(range(0, 400_000, 4))
    packing.cuts(at, [0, *[2] * (len(at) - 1)])
    assert time.time() - began < 10


def test_texts_of_a_slice_are_encoded_as_alone(library, coder, monkeypatch):
    rng = random.Random(4)
    words = ["Mañana.", "the", 'said."', "x?!", "...", "中文。", "\x85b", "\xa0", "e\u0301", "don't", "(a)", "\ud800", "\x00"]
    texts = ["", " \n\t", "one", " . ", "tail\x0b", "\x0chead. "]
    texts += [rng.choice(" \n\r").join(rng.choices(words, k=rng.randrange(40))) for _ in range(200)]
    special = next(iter(library.get_added_tokens_decoder().values())).content
    for known in (packing.KNOWN, 7):
        monkeypatch.setattr(packing, "KNOWN", known)
        for some in (texts, [*texts[:20], f"a {special} b."], [""], ["a", ""]):
            for text, (ids, ends) in zip(some, coder.encode_all(some), strict=True):
                alone, own = coder.encode(text)
                assert ids == alone and ends.tolist() == own.tolist()
                want = text.encode("utf-8", "replace").decode()
                assert np.frombuffer(ids, "<u4").tolist() == library.encode(want, add_special_tokens=False).ids


def test_plain_words_pass_by_the_normalizer_with_the_same_ids(library, monkeypatch):
    whole_way = []
    learn = packing.Coder._learn_cores

    def counting(self, cores):
        whole_way.extend(cores)
        return learn(self, cores)

    monkeypatch.setattr(packing.Coder, "_learn_cores", counting)
    rng = random.Random(9)
    coder = packing.Coder(open(PATH, encoding="utf-8").read())
    letters = [*map(chr, range(97, 123)), *map(chr, range(65, 91)), *(chr(i) for i in range(0xC0, 0x100) if i not in (0xD7, 0xF7))]
    marks = ["", "", ".", ",\"", "$$$", "?!)", "-", "<|"]
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) + rng.choice(marks) for _ in range(60)) for _ in range(50)]
    for text, (ids, _) in zip(texts, coder.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert {*whole_way} <= {m.encode() for m in marks}
    whole_way.clear()
    odd = ["it's. x'", "a\xd7b. 3\xbd,", "éé! İÀ.", "a1b2. é́.", "x-y. é.é."]
    for text, (ids, _) in zip(odd, coder.encode_all(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert b"it's" in whole_way


def test_places_of_many_documents_are_those_of_each():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 300, 200)
    sizes[:9] = 1
    own = [np.unique(rng.integers(0, size, rng.integers(0, 9))) for size in sizes]
    base = np.cumsum(sizes) - sizes
    want = [packing.places(size, ends) for size, ends in zip(sizes, own)]
    at, penalty = packing.all_places(np.cumsum(sizes), np.concatenate([o + b for o, b in zip(own, base)]))
    assert at.tolist() == np.concatenate([a + b for (a, _), b in zip(want, base)]).tolist()
    assert penalty.tolist() == np.concatenate([p for _, p in want]).tolist()
