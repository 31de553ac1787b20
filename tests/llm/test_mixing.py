from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import WORD, awkward, by_id, documents, nothing

from obsgrid.llm import mixing
from obsgrid.llm.queries import QUERIES


def poured(sizes, weights=(5, 2, 1)):
    """Targets by dealing the excess out again and again, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            out |= {s: weight[s] * level for s in open_}
            break
        out |= {s: Fraction(3 * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def nearest_gap(rows, budget):
    """Distance of the best sum, each length n times with up to three copies."""
    sums = {0}
    for length, n in rows:
        sums = {s + length * k for s in sums for k in range(3 * n + 1)}
    return min(abs(s - budget) for s in sums)


def filled(rows, budget):
    lengths, counts = (np.array(x) for x in zip(*sorted(rows)))
    take = mixing.fill(lengths, counts, budget)
    assert (take >= 0).all() and (take <= 3 * counts).all()
    return int((take * lengths).sum())


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 300), st.integers(1, 4)), min_size=1, max_size=5, unique_by=lambda x: x[0]),
    st.integers(0, 2000),
)
def test_fill_comes_as_near_as_any_choice_of_copies(rows, budget):
    assert abs(filled(rows, budget) - budget) == nearest_gap(rows, budget)


def test_a_source_of_one_long_text_and_some_short_ones():
    assert filled([(12, 4), (14, 1), (421, 1)], 800) == 842
    assert filled([(7, 1)], 5) == 7 and filled([(7, 1)], 3) == 0


def test_whole_passes_come_first():
    lengths, counts = np.array([3, 5, 50]), np.array([4, 4, 1])
    assert mixing.fill(lengths, counts, 2 * 82).tolist() == [8, 8, 2]


def test_fill_of_a_large_budget_is_exact():
    lengths, counts = np.arange(1, 3000, 7), np.full(429, 5000)
    budget = 1_234_567_891
    assert (mixing.fill(lengths, counts, budget) * lengths).sum() == budget


def test_query(spark, sf_dir):
    got = QUERIES["op1_mixing"](spark, sf_dir).collect()
    texts = by_id(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sizes, taken, source_sizes = defaultdict(int), defaultdict(int), {}
    subsets = defaultdict(lambda: 1)  # bit n: copies of the source's documents have n words
    assert len(got) == len(texts)
    for r in got:
        size = len(WORD.findall(texts[r["doc_id"]]["text"] or ""))
        assert r["size"] == size and r["taken"] in (0, size, 2 * size, 3 * size)
        source = texts[r["doc_id"]]["source"]
        sizes[source] += size
        taken[source] += r["taken"]
        for _ in range(3):
            subsets[source] |= subsets[source] << size
        source_sizes[source] = (r["source_size"], r["target"])
    want = poured(sizes)
    for source, (size, target) in source_sizes.items():
        assert size == sizes[source] and target == pytest.approx(float(want[source]))
        goal = round(target)
        gaps = (d for d in range(goal + 1) if subsets[source] >> (goal - d) & 1 or subsets[source] >> (goal + d) & 1)
        assert abs(taken[source] - goal) == next(gaps)
    again = QUERIES["op1_mixing"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_targets_stop_at_three_sizes_and_null_sources_come_last(spark):
    docs = documents(spark, ["a " * 90, "b " * 10, "c " * 4, "d " * 60], ["x", None, "w", "y"])
    got = by_id(mixing.mix(docs))
    want = poured({"x": 90, None: 10, "w": 4, "y": 60})
    for i, source in enumerate(["x", None, "w", "y"]):
        assert got[i]["target"] == pytest.approx(float(want[source]))
    assert got[2]["target"] == 12.0 and got[2]["taken"] == 12


def test_copies_of_one_length_are_taken_by_number(spark):
    docs = documents(spark, ["w " * 10] * 400 + ["v " * 7] * 40, ["a"] * 400 + ["b"] * 40)
    rows = mixing.mix(docs).collect()
    a = sum(r["taken"] for r in rows if r["size"] == 10)
    target = next(r["target"] for r in rows if r["size"] == 10)
    assert abs(a - target) <= 10 and len(rows) == 440


def test_awkward_rows(spark):
    rows = mixing.mix(awkward(spark)).collect()
    assert len(rows) == 8
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(nothing(spark)).count() == 0


@settings(max_examples=40, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(65_537, 140_000), st.integers(1, 3)), min_size=1, max_size=6, unique_by=lambda x: x[0]
    ),
    st.integers(0, 1_000_000),
)
def test_fill_takes_lengths_above_the_residual(rows, budget):
    assert abs(filled(rows, budget) - budget) == nearest_gap(rows, budget)


def test_long_texts_that_fit_exactly_are_taken():
    assert mixing.fill(np.array([70_000]), np.array([3]), 140_000).tolist() == [2]
    lengths, counts = np.array([10, 70_000]), np.array([100_000, 40])
    assert (mixing.fill(lengths, counts, 2_100_010) * lengths).sum() == 2_100_010


def test_rows_without_an_id_are_taken_too(spark):
    docs = documents(spark, ["a b c", "d e", "f"], ["x", "x", "y"]).selectExpr("nullif(doc_id, 1) doc_id", "text", "source")
    rows = mixing.mix(docs).collect()
    assert sorted((r["size"], r["source_size"]) for r in rows) == [(1, 1), (2, 5), (3, 5)]
