from __future__ import annotations

import itertools
import zlib

import numpy as np
from llm_helpers import awkward, nothing

from obsgrid.llm import langid
from obsgrid.llm.queries import QUERIES


def field(k=3, seed=1):
    rng = np.random.default_rng(seed)
    return langid.Field(list("abc")[:k], np.zeros((1, k)), rng.normal(size=(k, k)), rng.normal(size=k))


def test_marginals_against_all_labellings():
    model, rng = field(), np.random.default_rng(2)
    sizes = np.array([3, 5, 1])
    scores = rng.normal(size=(sizes.sum(), 3))
    got, _, _ = model.marginals(scores, sizes)
    at = 0
    for n in sizes:
        part, want = scores[at : at + n], np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.exp(
                model.first[path[0]]
                + sum(part[i, c] for i, c in enumerate(path))
                + sum(model.moves[a, b] for a, b in zip(path, path[1:]))
            )
            for i, c in enumerate(path):
                want[i, c] += weight
        np.testing.assert_allclose(got[at : at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_messages_carry_over_a_cut():
    model, scores = field(), np.random.default_rng(3).normal(size=(8, 3))
    _, whole, _ = model.marginals(scores, np.array([8]))
    _, first, _ = model.marginals(scores[:5], np.array([5]))
    _, second, _ = model.marginals(scores[5:], np.array([3]), first)
    np.testing.assert_allclose(second, whole)


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op4_langid"](spark, sf_dir)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_words_of_a_mixed_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learn(docs)
    parts = {"en": "the and of that thing with", "de": "der die und ungkeit von schlich"}
    text = " ".join(parts.values())
    row = langid.label_words(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert row["words"] == text.split()
    assert row["langs"] == [lang for lang, words in parts.items() for _ in words.split()]


def test_awkward_rows(spark):
    docs = awkward(spark)
    model = langid.learn(docs)
    rows = langid.predict(docs, model).collect()
    assert len(rows) == 8
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert all(r["lang_pred"] in model.labels for r in rows if r["doc_id"] > 3)
    unlearned = langid.predict(docs, langid.learn(nothing(spark))).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}
    assert langid.predict(nothing(spark), model).count() == 0
