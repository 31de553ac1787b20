from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import pandas as pd
from llm_helpers import awkward, documents, nothing

from obsgrid.llm import toxicity
from obsgrid.llm.queries import QUERIES

PLAIN = "the river runs along the old road and nobody minds the quiet morning there".split()


def sentence(i, *more):
    rng = random.Random(i)
    words = [rng.choice(PLAIN) + rng.choice("abcdefgh") for _ in range(12)]
    return " ".join([*words[:6], *more, *words[6:]])


def labelled(spark, n=300):
    texts = [
        sentence(i, "grumbleface") if i % 3 == 0
        else sentence(i, "grumbleface", "tulip") if i % 24 == 1
        else sentence(i)
        for i in range(n)
    ]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")
    return documents(spark, texts), labels


def test_folding():
    assert toxicity.fold("Grуmbl3​f@ce, NOW!") == " grymbleface now "
    assert toxicity.fold("1D10T $tays réeux") == " idiot tays réeux "
    assert toxicity.fold(None) == "  " == toxicity.fold("... 12 ") .replace("i", "").replace("2", "")


def test_learns_words_disguises_and_exceptions(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels)
    assert any("grumb" in e for e in model.weights)
    assert " grumbleface tulip " in model.exceptions
    assert model.score(sentence(5, "grumbleface")) >= 0.5
    assert model.score(sentence(5, "GRUM8LEFACE".replace("8", "b"))) >= 0.5
    assert model.score(sentence(5, "grуmbl3f@c3".replace("у", "u"))) >= 0.5
    assert model.score(sentence(5, "grumbleface", "tulip")) < 0.5
    assert model.score(sentence(5)) < 0.5 and model.score("") < 0.5 and model.score(None) < 0.5


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = QUERIES["op2_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    caught = [r["predicted"] for r in rows if r["toxic"]]
    wrong = [r["predicted"] for r in rows if not r["toxic"]]
    assert right > 0.97 and sum(caught) / len(caught) > 0.85 and sum(wrong) / len(wrong) < 0.01
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_folds_and_unknown_labels(spark):
    docs, labels = labelled(spark, 30)
    got = toxicity.score_documents(docs, toxicity.Model()).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(r["predicted"] == 0 for r in got)
    empty = labels.where("false")
    assert toxicity.learn(docs, empty).weights == {}
    assert toxicity.learn(docs, labels.selectExpr("doc_id", "cast(null as int) as toxic")).weights == {}
    assert toxicity.learn(nothing(spark), labels).weights == {}


def test_awkward_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels)
    rows = toxicity.score_documents(awkward(spark), model).collect()
    assert len(rows) == 8 and all(r["predicted"] == 0 for r in rows)
    assert toxicity.score_documents(nothing(spark), model).count() == 0


def occurrences(text, part):
    return [i for i in range(len(text)) if text.startswith(part, i)]


def plain_features(model, text):
    """Weights by looking for every entry and phrase at every place of the folded text."""
    folded = toxicity.fold(text)
    best = {}
    for entry, weight in model.weights.items():
        for at in occurrences(folded, entry):
            best[at] = max(weight, best.get(at, 0.0))
    for phrase in model.exceptions:
        for at in occurrences(folded, phrase):
            best = {s: w for s, w in best.items() if not at <= s < at + len(phrase) - 1}
    total = sum(best.values())
    return math.log1p(total), math.log1p(100.0 * total / max(1, len(folded.split())))


def test_matches_a_plain_search_of_every_entry_and_exception():
    rng = random.Random(6)
    for _ in range(150):
        entries = {" " + "".join(rng.choice("ab") for _ in range(rng.randint(1, 3))) + rng.choice(["", " "]) for _ in range(5)}
        weights = {e: rng.randint(1, 20) / 4 for e in entries}
        phrases = {f" {rng.choice(['a', 'ab', 'b'])} {rng.choice(['a', 'ba', 'c'])} " for _ in range(2)} - entries
        model = toxicity.Model(weights=weights, exceptions=sorted(phrases))
        for _ in range(10):
            text = " ".join("".join(rng.choice("abAc4") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 12)))
            got, want = model.features(text), plain_features(model, text)
            assert all(abs(a - b) < 1e-9 for a, b in zip(got, want)), (model, text)


def test_counts_are_passed_on_in_parts(monkeypatch):
    rows = pd.DataFrame({"text": [sentence(i) for i in range(40)], "toxic": [i % 2 for i in range(40)]})
    whole = next(toxicity._count_patterns(iter([rows])))
    monkeypatch.setattr(toxicity, "COUNTED", 50)
    parts = list(toxicity._count_patterns(iter([rows])))
    assert len(parts) > 4 and max(map(len, parts)) < 120
    got = Counter()
    for pattern, toxic, clean in pd.concat(parts).itertuples(index=False):
        got.update({(pattern, 1): toxic, (pattern, 0): clean})
    want = {(p, k): n for p, *counts in whole.itertuples(index=False) for k, n in zip((1, 0), counts)}
    assert got == want
