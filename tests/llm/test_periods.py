from __future__ import annotations

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
from llm_helpers import WORD, awkward, by_id, documents, nothing
from obsgrid.llm import periods
from obsgrid.llm.queries import QUERIES


def brute(words):
    """All runs by comparing the words at every distance."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            first = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i + q - first
            part = words[first : first + length]
            smaller = any(
                all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q)
            )
            if length >= max(24, 3 * q) and not smaller:
                found.append((first, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def looped(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()) & 0xFFFFFFFF, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(words):
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return {
        "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": hashlib.sha256(text.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(
            " ".join(w for i, w in enumerate(words) if i not in gone).encode()
        ).hexdigest(),
    }


def runs_of(words):
    return periods.word_runs([[str(w).encode() for w in words]])[0]


def test_query(spark, sf_dir):
    got = by_id(QUERIES["op11_periodic_runs"](spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    compared = 0
    for d in docs:
        words = looped(d["doc_id"], WORD.findall(d["text"] or ""))
        if len(words) <= 700:
            assert got[d["doc_id"]] == {"doc_id": d["doc_id"], **expected(words)}
            compared += got[d["doc_id"]]["n_runs"] > 0
    assert compared > 5


def test_all_runs_of_nested_and_touching_repeats():
    rng = random.Random(2)
    for _ in range(250):
        words = []
        for _ in range(rng.randint(1, 5)):
            unit = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randint(1, 30))]
            if rng.random() < 0.3:
                unit = unit * 4 + ["x"]
            words += (unit * rng.randint(1, 7))[: rng.randint(5, 160)]
            words += [str(rng.random())] * rng.randint(0, 2)
        assert runs_of(words) == brute(words)


def test_texts_looked_at_together_stay_apart():
    rng = random.Random(4)
    texts = [[str(rng.randint(0, 2)).encode() for _ in range(rng.choice([0, 5, 23, 24, 80, 200]))] for _ in range(60)]
    texts += [[b"a"] * 30, [b"a"] * 40, [b"a"] * 11]
    assert periods.word_runs(texts) == [brute(t) for t in texts]


def test_the_convolution_is_exact():
    rng = np.random.default_rng(1)
    for block, shift in ((8, 0), (8, 8), (32, 32), (256, 256)):
        ids = rng.integers(0, 2, 3 * block + 5)
        ids = np.concatenate([ids, ids, ids])
        starts, distances = periods.zero_distances(ids, block, shift)
        got = set(zip(starts.tolist(), distances.tolist()))
        want = {
            (a, d)
            for a in range(0, len(ids), block)
            for d in range(shift, shift + block)
            if a + d + block <= len(ids) and (ids[a : a + block] == ids[a + d : a + d + block]).all()
        }
        assert got >= want
        assert all(a + d + block > len(ids) or (a, d) in want or d == 0 for a, d in got)


def test_long_texts():
    began = time.time()
    assert runs_of(["w"] * 100_000) == [(0, 100_000, 1)]
    unit = [str(i) for i in range(30_001)]
    assert runs_of(["x", *unit * 4, "y"]) == [(1, 120_004, 30_001)]
    assert time.time() - began < 60


def test_awkward_tables(spark):
    rows = awkward(spark).collect()
    got = periods.periodic_runs(awkward(spark)).drop("collapsed").collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(d["text"] for d in rows if d["doc_id"] == r["doc_id"])
        words = WORD.findall(text or "")
        if len(words) < 1000:
            assert r.asDict() == {"doc_id": r["doc_id"], **expected(words)}
        else:
            assert (r["n_runs"], r["start"], r["length"], r["period"]) == (1, 0, 60_000, 977)
    assert periods.periodic_runs(nothing(spark)).count() == 0
    docs = documents(spark, [" ".join(["ä b"] * 20), None]).selectExpr("cast(null as long) doc_id", "text")
    first = periods.periodic_runs(docs).collect()
    assert sorted((r["doc_id"], r["n_runs"], r["collapsed"]) for r in first) == [(None, 0, ""), (None, 1, "ä b")]
