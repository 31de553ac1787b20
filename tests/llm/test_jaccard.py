from __future__ import annotations

import itertools
import random

from llm_helpers import WORD, awkward, documents, nothing, reachable

from obsgrid.llm import jaccard, simhash


def brute_set(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Component of each id by comparing all pairs, and the linked pairs."""
    sets = [(i, brute_set(t)) for i, t in rows]
    linked = [
        (a, b) for (a, x), (b, y) in itertools.combinations(sets, 2)
        if x == y or 5 * len(x & y) >= 4 * len(x | y) > 0
    ]
    return reachable({i for i, _ in sets}, linked), linked


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return words


def planted():
    """Texts with copies on both sides of 0.8, a chain, a crowd of near copies and a common passage."""
    rng = random.Random(3)
    texts, passage = [], [f"pass{i}" for i in range(60)]
    for k in range(40):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(4, 300))]
        texts.append(base)
        texts += [edited(base, n, rng) for n in range(1, 2 + len(base) // 25)]
        texts.append(passage + base[:30])
    base = [f"c{i}" for i in range(150)]
    texts += [edited(base, 1 + i % 4, rng) for i in range(60)]
    for _ in range(12):
        base = edited(base, 2, rng)
        texts.append(base)
    out = [" ".join(t) for t in texts]
    return out + [out[0].upper(), "", " \n", "one two", "One  two", "one two three"]


def found(df):
    return {r["doc_id"]: r["component_id"] for r in df.collect()}


def test_components_are_those_of_all_pairs(spark):
    texts = planted()
    want, linked = brute(list(enumerate(texts)))
    assert found(jaccard.similar_documents(documents(spark, texts))) == want
    prints = [simhash.fingerprint(t) for t in texts]
    missed = [(a, b) for a, b in linked if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() > 3]
    assert len(missed) > 100


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = found(jaccard.similar_documents(docs))
    assert got == brute({(r["doc_id"], r["text"]) for r in docs.collect()})[0]
    assert jaccard.similar_documents(docs).count() == 8
    assert jaccard.similar_documents(nothing(spark)).count() == 0
