from __future__ import annotations

import itertools
import random

import pytest
import xxhash
from llm_helpers import WORD, awkward, by_id, documents, nothing, reachable
from pyspark.sql import functions as F

from obsgrid.llm import simhash
from obsgrid.llm.components import components
from obsgrid.llm.queries import QUERIES


def brute_fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b])


def brute(rows):
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    linked = [(a, b) for (a, x), (b, y) in itertools.combinations(prints, 2) if (x ^ y).bit_count() <= 3]
    groups = reachable({i for i, _ in prints}, linked)
    return sorted((i, f"{p:016x}", groups[i]) for i, p in prints)


def plain(df):
    return sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert plain(QUERIES["op5_simhash"](spark, sf_dir)) == brute(map(tuple, docs))


def test_hash_is_spark_s_own(spark):
    text = "Ab cd é"
    value = spark.range(1).select(F.xxhash64(F.lit("ab cd é"))).first()[0]
    assert xxhash.xxh64_intdigest("ab cd é".encode(), 42) == value % (1 << 64)
    assert simhash.fingerprint(text) == value


def prints_around(n, seed):
    """A crowd of fingerprints that share a segment, some within three bits and some not."""
    rng = random.Random(seed)
    out, high = set(), rng.getrandbits(32)
    while len(out) < n:
        low = rng.getrandbits(32) if rng.random() < 0.3 else (rng.choice(sorted(out)) if out else 0) & 0xFFFFFFFF
        for _ in range(rng.randrange(5)):
            low ^= 1 << rng.randrange(32)
        moved = high ^ (1 << rng.randrange(32)) if rng.random() < 0.2 else high
        out.add(moved << 32 | low)
    return [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(sorted(out))]


@pytest.mark.parametrize("crowd", [2, 20, 1000])
def test_crowded_segments_give_the_same_components(spark, crowd):
    rows = prints_around(120, crowd)
    df = spark.createDataFrame(rows, "node long, fp long")
    linked = [
        (a, b) for (a, x), (b, y) in itertools.combinations(rows, 2)
        if ((x ^ y) & (1 << 64) - 1).bit_count() <= 3
    ]
    found = [(r["a"], r["b"]) for r in simhash.links(df, crowd).collect()]
    assert {tuple(sorted(x)) for x in found} <= set(linked)
    if crowd == 1000:
        assert {tuple(sorted(x)) for x in found} == set(linked)
    nodes = {i for i, _ in rows}
    assert reachable(nodes, found) == reachable(nodes, linked)


def exchanges(df):
    """Rows of every broadcast of the plan that ran."""
    df.collect()
    seen, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "BroadcastExchange":
            seen.append(plan.metrics().apply("numOutputRows").value())
        inner = {"AdaptiveSparkPlan": "executedPlan"}.get(plan.nodeName())
        inner = inner or ("plan" if plan.nodeName().endswith("QueryStage") else None)
        children = plan.children()
        plans += [getattr(plan, inner)()] if inner else [children.apply(i) for i in range(children.size())]
    return seen


@pytest.mark.parametrize("crowd", [2, 1000])
def test_no_ball_is_broadcast(spark, crowd):
    """Balls have 33 rows and more for each segment, which Spark's sizes don't count."""
    df = spark.createDataFrame(prints_around(400, 3), "node long, fp long")
    assert all(rows <= 2 * 400 for rows in exchanges(simhash.links(df, crowd)))


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = plain(simhash.near_duplicates(docs))
    assert sorted(set(got)) == brute(set(rows))
    assert [x for x in got if x[0] in (1, 2, 3)] == [(i, "0" * 16, 1) for i in (1, 2, 3)]
    assert len(got) == 8 and dict((x[0], x[2]) for x in got)[6] == 5
    assert simhash.near_duplicates(nothing(spark)).count() == 0


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(7, i) for i in range(200, 260)]
    rows = chain + hub + [(5, 5), (139, 100)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    nodes = {x for row in chain + hub for x in row}
    assert got == reachable(nodes, chain + hub)
    assert components(df.where("false")).count() == 0


def test_groups_of_copies(spark):
    texts = ["alpha beta gamma delta"] * 50 + ["something else entirely here"] * 3
    got = by_id(simhash.near_duplicates(documents(spark, texts)))
    assert {r["component_id"] for i, r in got.items() if i < 50} == {0}
    assert {r["component_id"] for i, r in got.items() if i >= 50} == {50}
