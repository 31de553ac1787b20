from __future__ import annotations

import re

from llm_helpers import awkward, by_id, documents, nothing

from obsgrid.llm import licenses
from obsgrid.llm.licenses import PASSAGES, PHRASES
from obsgrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, t.label) for t in PHRASES for i in range(len(words))
        if words[i : i + len(t.words)] == t.words
    ]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


def base(row):
    return tuple(row[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels"))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = by_id(QUERIES["op9_licenses"](spark, sf_dir))
    assert len(got) == len(docs)
    assert all(base(got[d["doc_id"]]) == brute(d["text"]) for d in docs)
    assert sum(r["n_base"] > 0 for r in got.values()) > 5
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""} for r in got.values())


def test_phrases_in_odd_texts(spark):
    texts = [
        "Under the MIT license, CC-BY-NC! under THE mit license", "under the mıt license", "apache license, version 2.0",
        "apache license version 2x", "mit license under the", "CC BY NC cc by nc cc", "under the mit license" * 2,
        "under the mit licenſe", "the KK cc\nby\tnc", "under the mİt license",
    ]
    got = by_id(licenses.scan(documents(spark, texts)))
    for i, text in enumerate(texts):
        assert base(got[i]) == brute(text)
    assert got[0]["n_base"] == 3 and got[0]["score"] == 1.0


def longer(template):
    """The passage with two more words somewhere outside its key phrases."""
    words = template.words
    tries = (" ".join([*words[:i], "so", "to say", *words[i:]]) for i in range(len(words) // 2, len(words)))
    return next(t for t in tries if all(k in t for k in template.keys))


def test_passages_whole_changed_and_missing(spark):
    filler = "Some words come before it. " * 30
    whole = [f"{filler}{t.text.capitalize()}. {filler}" for t in PASSAGES]
    changed = [f"{filler}{longer(t)} {filler}" for t in PASSAGES]
    lacking = [f"{filler}{t.text.replace(t.keys[0], 'here')} {filler}" for t in PASSAGES]
    shuffled = [" ".join(sorted(t.words)) for t in PASSAGES]
    got = by_id(licenses.scan(documents(spark, whole + changed + lacking + shuffled + [filler])))
    n = len(PASSAGES)
    for i, t in enumerate(PASSAGES):
        assert t.label in got[i]["labels"].split(","), t
        assert t.label in got[n + i]["labels"].split(","), t
        assert {p["start"] for p in got[i]["places"] if p["label"] == t.label and not p["exact"]} == {150}
        for k in (2 * n + i, 3 * n + i):
            assert t.label not in got[k]["labels"].split(",") or got[k]["n_base"], t
    assert got[4 * n]["labels"] == "" and got[4 * n]["score"] == 0.0


def test_common_licence_words_are_no_obstacle(spark):
    texts = ["license mit apache nc " * 20] * 30 + ["under the mit license"]
    got = by_id(licenses.scan(documents(spark, texts)))
    assert all(base(got[i]) == brute(t) for i, t in enumerate(texts))


def test_no_python_on_the_executors(spark, sf_dir):
    plan = QUERIES["op9_licenses"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = licenses.scan(docs).collect()
    assert sorted(map(base, rows), key=str) == sorted((brute(d["text"]) for d in docs.collect()), key=str)
    assert licenses.scan(nothing(spark)).count() == 0
