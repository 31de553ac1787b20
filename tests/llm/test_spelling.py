from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from llm_helpers import awkward, documents, nothing
from obsgrid.llm import spelling
from obsgrid.llm.queries import QUERIES


def neighbours(word, alphabet):
    out = set()
    for i in range(len(word) + 1):
        out.update(word[:i] + c + word[i:] for c in alphabet)
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out.update(word[:i] + c + word[i + 1 :] for c in alphabet)
    return out - {word}


def brute(counts):
    """Every near word by trying all edits."""
    alphabet = {c for w in counts for c in w}
    near = {w: {x for x in neighbours(w, alphabet) if x in counts} for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def of_documents(docs, slip=True):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if slip and doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def rows_of(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(QUERIES["op13_spelling"](spark, sf_dir)) == brute(of_documents(docs))


def test_near_words_however_crowded(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(5, 8))) for _ in range(1500)}
    words |= {"zzzzz", "zzzzzz", "zzzzzzz", "zzzzzzzz", "zzzzézz", "abcab" * 9, "abcab" * 9 + "c"}
    counts = {w: rng.randint(3, 40) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    expected = brute(counts)
    for crowd in (0, 3, 1000):
        assert rows_of(spelling.variants(table, crowd)) == expected


def test_pivots_are_the_lightest_disjoint_pair():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 8)))
        weights = [rng.randint(1, 9) for _ in places]
        pairs = [
            weights[a] + weights[b]
            for a in range(len(places))
            for b in range(a)
            if places[a] - places[b] >= 2
        ]
        chosen = spelling.pivots_of(places, weights)
        assert chosen[1] - chosen[0] >= 2
        assert sum(weights[places.index(p)] for p in chosen) == min(pairs)


def test_chains_of_forms_and_ties(spark):
    counts = {"lettre": 100, "letre": 40, "letré": 20, "lettr": 9, "maison": 5, "maisan": 5, "maisen": 10, "maisin": 10}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows_of(spelling.variants(table))
    assert got == brute(counts)
    assert got["letré"][1] == "lettre" and got["maison"][0] == "maisen"


def test_awkward_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    got = rows_of(spelling.spelling_variants(awkward(spark)))
    assert got == brute(of_documents(docs, slip=False))
    assert spelling.spelling_variants(nothing(spark)).count() == 0
    texts = [None, "", "Haus Häuser HÄUSER häuser Häuser", "häuser häusers häusers häusers ×÷×÷×"]
    docs = documents(spark, texts).selectExpr("nullif(doc_id, 3) as doc_id", "text")
    expected = brute(of_documents([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert rows_of(spelling.spelling_variants(docs, word_of=spelling.slipped)) == expected
