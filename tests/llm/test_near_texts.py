from __future__ import annotations

import random

import numpy as np
import corpus_pipeline
from llm_helpers import awkward, documents, nothing
from test_jaccard import brute, brute_set, edited, planted

from pyspark.sql import functions as F

from obsgrid.llm import jaccard, near_texts


def groups(df):
    return {r["doc_id"]: r["component_id"] for r in df.collect()}


def met(got, linked):
    """Share of the linked pairs whose members are in one component."""
    return sum(got[a] == got[b] for a, b in linked) / len(linked)


def crowded(members, seed=5):
    """A large group of near copies, a common passage, and copies of copies."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    texts = [edited(base, rng.randint(1, 5), rng) for _ in range(members)]
    texts += [edited(texts[i], 1, rng) for i in range(0, members, 10)]
    passage = [f"p{i}" for i in range(60)]
    texts += [passage + [f"o{rng.randrange(5000)}" for _ in range(rng.randint(5, 200))] for _ in range(80)]
    for k in range(40):
        own = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(30, 300))]
        texts += [own, edited(own, 1 + len(own) // 60, rng)]
    return [" ".join(t) for t in texts]


def test_only_true_links_and_nearly_all(spark):
    texts = planted()
    want, linked = brute(list(enumerate(texts)))
    got = groups(near_texts.near_texts(documents(spark, texts)))
    assert all(want[i] == want[c] for i, c in got.items())
    assert met(got, linked) >= 0.95


def test_crowded_values_lose_few_links_and_make_few_pairs(spark, monkeypatch):
    checked = []
    verify = near_texts.Search.verify

    def counting(self, pairs):
        checked.append(pairs.count())
        return verify(self, pairs)

    monkeypatch.setattr(near_texts.Search, "verify", counting)
    for members in (200, 800):
        texts = crowded(members)
        exact = groups(jaccard.similar_documents(documents(spark, texts)))
        sets = [brute_set(t) for t in texts]
        rng = random.Random(1)
        linked = []
        for _ in range(60_000):
            a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
            if a != b and exact[a] == exact[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                linked.append((a, b))
        linked += [(i, members + i // 10) for i in range(0, members, 10)]
        linked = [(a, b) for a, b in linked if exact[a] == exact[b]]
        checked.clear()
        got = groups(near_texts.near_texts(documents(spark, texts), crowd=16))
        assert all(exact[i] == exact[c] for i, c in got.items())
        assert met(got, linked) >= 0.95
        # A fixed number for each text, however many there are.
        assert sum(checked) < 120 * len(texts)


def test_texts_nearly_similar_to_a_crowd_make_few_pairs(spark, monkeypatch):
    """Most of a common passage and some words of one's own: near each other, but not at 0.8."""
    checked, starred = [], []
    verify, stars = near_texts.Search.verify, near_texts.components

    def counting(self, pairs):
        checked.append(pairs.count())
        return verify(self, pairs)

    def joining(links):
        starred.append(links.count())
        return stars(links)

    monkeypatch.setattr(near_texts.Search, "verify", counting)
    monkeypatch.setattr(near_texts, "components", joining)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    apart = [edited(base, rng.randint(2, 3), rng) for _ in range(300)]
    copies = [edited(base, 1, rng) for _ in range(200)]
    texts = [" ".join(t) for t in apart + copies]
    want, linked = brute(list(enumerate(texts)))
    got = groups(near_texts.near_texts(documents(spark, texts), crowd=16))
    assert all(want[i] == want[c] for i, c in got.items()) and met(got, linked) >= 0.95
    assert sum(checked) < 30 * len(texts) and sum(starred) < 25 * len(texts)


def test_pairs_apart_from_every_leader_are_found_in_crowds(spark, monkeypatch):
    """All texts have one print in common and twins no other segment, so only a crowd holds them."""
    rng = random.Random(8)
    texts, prints = [], {}
    for k in range(60):
        one = [f"w{k}-{i}" for i in range(100)]
        own = [0, *(rng.getrandbits(63) for _ in range(near_texts.PRINTS - 1))]
        for words, apart in ((one, 0), (edited(one, 2, rng), 0x0003000300030003)):
            texts.append(" ".join(words))
            prints[near_texts.Shingles().of(texts[-1]).tobytes()] = [own[0], *(p ^ apart for p in own[1:])]
    monkeypatch.setattr(near_texts, "prints_of", lambda hashes, n: prints[hashes.tobytes()])
    want, linked = brute(list(enumerate(texts)))
    assert len(linked) == 60
    for cell in ({}, {"cell": 7}):
        assert groups(near_texts.near_texts(documents(spark, texts), crowd=4, **cell)) == want


def test_parities_differ_no_more_than_sets():
    rng = random.Random(3)
    for _ in range(40):
        both = [rng.getrandbits(64) for _ in range(rng.randrange(300))]
        a, b = (set(both + [rng.getrandbits(64) for _ in range(rng.randrange(300))]) for _ in range(2))
        x, y = (near_texts.parities_of(np.array(sorted(s), np.uint64)) for s in (a, b))
        assert sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x, y)) <= len(a ^ b)


def test_fingerprints_differ_by_the_angle_between_sets():
    rng = random.Random(2)
    gaps = []
    for _ in range(60):
        both = [rng.getrandbits(64) for _ in range(160)]
        a, b = (np.unique(np.array(both + [rng.getrandbits(64) for _ in range(20)], np.uint64)) for _ in range(2))
        prints = [near_texts.prints_of(x) for x in (a, b)]
        gaps.append(sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(*prints)))
    assert 40 < np.mean(gaps) < 57 and max(gaps) <= near_texts.DISTANCE


def test_wider_segments_and_balls_of_two(spark, monkeypatch):
    monkeypatch.setattr(near_texts, "width_for", lambda nodes: (2, 2))
    texts = planted()[:120]
    want, linked = brute(list(enumerate(texts)))
    got = groups(near_texts.near_texts(documents(spark, texts), prints=8))
    assert all(want[i] == want[c] for i, c in got.items()) and met(got, linked) >= 0.9


def test_stage_keeps_one_of_each_group(spark, tmp_path):
    texts = [t for t in planted() if len(t.split()) > 30]
    kept = corpus_pipeline.without_near_copies(spark, documents(spark, texts), str(tmp_path))
    got = groups(near_texts.near_texts(documents(spark, texts)))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    got = near_texts.near_texts(docs).collect()
    assert len(got) == 8
    want = brute({(r["doc_id"], r["text"]) for r in docs.collect()})[0]
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert near_texts.near_texts(nothing(spark)).count() == 0
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(None, base), (None, base + " x"), (5, base + " y"), (5, "another text of six words"), (None, "quite alone here"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_texts.near_texts(docs).collect()]
    assert sorted(got, key=repr) == sorted(
        [(None, 5, False), (None, 5, False), (5, 5, True), (5, 5, True), (None, None, True), (None, None, True)], key=repr
    )
    kept = corpus_pipeline.without_near_copies(spark, docs, str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(rows[2:], key=repr)




def at_the_threshold(count, seed=12):
    """Pairs of texts whose sets are at 0.8 or a little above."""
    rng, texts = random.Random(seed), []
    for k in range(count):
        one = [f"w{k}-{i}" for i in range(rng.randint(60, 200))]
        other, best = list(one), list(one)
        for at in rng.sample(range(len(one)), len(one)):
            other[at] = f"o{k}-{at}"
            a, b = brute_set(" ".join(one)), brute_set(" ".join(other))
            if 5 * len(a & b) < 4 * len(a | b):
                other = list(best)
            best = list(other)
        texts += [" ".join(one), " ".join(best)]
    return texts


def test_pairs_at_the_threshold_are_all_found(spark):
    """A segment of every twelfth such pair or so doesn't meet; their shingles do."""
    texts = at_the_threshold(120)
    want, linked = brute(list(enumerate(texts)))
    assert len(linked) == 120
    assert groups(near_texts.near_texts(documents(spark, texts))) == want


def test_frequent_shingles_come_last(spark, monkeypatch):
    """A passage in all texts decides for no pair, and the components are those of all pairs."""
    monkeypatch.setattr(near_texts, "SAMPLE", 1)
    kept = []
    first = near_texts._frequent
    monkeypatch.setattr(near_texts, "_frequent", lambda texts: kept.append(first(texts)) or kept[-1])
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [f"{passage} {t}" for t in at_the_threshold(20, 3)]
    want, _ = brute(list(enumerate(texts)))
    assert groups(near_texts.near_texts(documents(spark, texts))) == want
    common = near_texts.Shingles().of(passage)
    assert set(common) <= set(kept[0][0]) and set(kept[0][1]) == {40}
    one = near_texts.Shingles().of(texts[0])
    assert not set(near_texts.first_fifth(one, *kept[0])) & set(common)


def test_many_nodes_get_no_wider_balls():
    for nodes in (2**19 + 1, 2**22, 2**24, 2**27):
        assert near_texts.width_for(nodes)[1] == 1


def test_large_sets_are_told_apart_by_wide_parities(spark, monkeypatch):
    """Equal at the segments, but with half of their shingles apart: no set is compared."""
    compared = []
    monkeypatch.setattr(near_texts, "LARGE", 200)
    monkeypatch.setattr(near_texts, "prints_of", lambda hashes, n: [0] * n)
    monkeypatch.setattr(near_texts, "_like_parities", lambda a, b, longs=0: F.lit(True))
    store = near_texts.written
    monkeypatch.setattr(
        near_texts, "written", lambda df, label: compared.append(df.count()) or store(df, label) if label == "near-pairs" else store(df, label)
    )
    shared = [f"s{i}" for i in range(200)]
    texts = [" ".join(shared + [f"o{k}-{i}" for i in range(200)]) for k in range(12)]
    texts.append(texts[0] + " end")
    want, linked = brute(list(enumerate(texts)))
    assert {tuple(sorted(x)) for x in linked} == {(0, 12)}
    assert groups(near_texts.near_texts(documents(spark, texts))) == want
    assert sum(compared) == 1
