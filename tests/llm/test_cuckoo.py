from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from compare import connect, differences, spark_rows, sql_rows
from llm_helpers import awkward, documents, nothing

from obsgrid.llm import cuckoo
from obsgrid.llm.cuckoo import CuckooFilter, CuckooIndex
from obsgrid.llm.queries import ORACLES, QUERIES


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_forgets_only_what_is_deleted():
    cells = CuckooFilter(1 << 10)
    assert all(cells.insert(digest(i)) for i in range(3000))
    assert all(cells.contains(digest(i)) for i in range(3000))
    assert sum(cells.contains(digest(i)) for i in range(3000, 13000)) < 20
    assert all(cells.delete(digest(i)) for i in range(1500))
    assert all(cells.contains(digest(i)) for i in range(1500, 3000))
    assert sum(cells.contains(digest(i)) for i in range(1500)) < 10


def test_index_against_a_dictionary_through_resizes():
    rng, index, live = random.Random(4), CuckooIndex(), {}
    for _ in range(30_000):
        i = rng.randrange(9000)
        if rng.random() < 0.75:
            assert index.add(digest(i), i) == (i not in live)
            live[i] = live.get(i, 0) + 1
        else:
            assert index.remove(digest(i)) == (live.pop(i, None) is not None)
    assert index.resizes > 0 and len(index) == len(live)
    assert all(index.contains(digest(i)) == (i in live) for i in range(9000))
    assert {k: n for k, n in zip(index.frame()["keep_id"], index.frame()["copies"])} == live


def test_query_matches_sql(spark, sf_dir):
    found = spark_rows(QUERIES["op7_exact_dedup"](spark, sf_dir))
    assert differences(found, sql_rows(connect(sf_dir), ORACLES["op7_exact_dedup"])) == []


def test_folding_in_pieces_gives_the_same(spark, monkeypatch):
    docs = documents(spark, [f"text {i % 37}" for i in range(500)] + ["hot"] * 300).repartition(5)
    want = {tuple(r) for r in cuckoo.exact_duplicates(docs).collect()}
    monkeypatch.setattr(cuckoo, "FLUSH", 5)
    assert {tuple(r) for r in cuckoo.exact_duplicates(docs).collect()} == want
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r["text"]].append(r["doc_id"])
    assert want == {
        (i, max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items() for i in ids
    }


def test_insertion_and_deletion(spark):
    first = cuckoo.build(cuckoo.digests(documents(spark, ["a", "b", "a"])))
    both = cuckoo.insert(first, cuckoo.digests(documents(spark, ["a", "c"], start=10)))
    keys = {bytes(r["digest"]): (r["keep_id"], r["copies"]) for r in both.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    assert keys == {sha("a"): (10, 3), sha("b"): (1, 1), sha("c"): (11, 1)}
    gone = spark.createDataFrame([(sha("a"),), (sha("zzz"),)], "digest binary")
    left = {bytes(r["digest"]) for r in cuckoo.delete(both, gone, shards=2).collect()}
    assert left == {sha("b"), sha("c")}
    again = cuckoo.insert(cuckoo.delete(both, gone), cuckoo.digests(documents(spark, ["a"], start=20)))
    assert {r["keep_id"] for r in again.collect() if bytes(r["digest"]) == sha("a")} == {20}


def test_awkward_rows(spark):
    got = sorted(tuple(r)[:4] for r in cuckoo.exact_duplicates(awkward(spark)).collect())
    assert got == [
        (1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True), (5, 6, 3, False),
        (6, 6, 3, True), (6, 6, 3, True), (7, 7, 1, True),
    ]
    assert cuckoo.exact_duplicates(nothing(spark)).count() == 0
