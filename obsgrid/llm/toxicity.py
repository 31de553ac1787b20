"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, replaces look-alike letters of other scripts, full-width forms, digits and
signs that stand for letters, drops invisible characters, and turns all else that is no letter
into one space. Accents stay, since they tell words of different languages apart.

The lexicon is learned: its entries are word beginnings and whole words that mark toxic
documents, each weighted by its log-odds; two-word phrases around an entry that occur in clean
documents only become exceptions, inside which the entry doesn't count. The sum of the weights
in a document, alone and per word, is turned into a score by a logistic fit.

Fitting takes a bounded sample, ``TOXIC_DOCS`` and ``CLEAN_DOCS`` documents by hash order of
their id; of it only counts of candidate patterns, lists of the ``CANDIDATES`` best ones per
sampled document, and two numbers per sampled document reach the driver.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import fold_remainder, table, text_or_empty, written
from obsgrid.llm.registry import query

#: Bounds of the sample that the classifier is fitted on.
TOXIC_DOCS = 2000
CLEAN_DOCS = 6000
#: Bounds of the candidates that are looked at and of the lexicon.
CANDIDATES = 3000
ENTRIES = 500
EXCEPTIONS = 500
#: A candidate needs so many toxic documents, and so many times their share of the clean ones.
SUPPORT = 3
LIFT = 8.0
#: So many entries explain a toxic document in full.
COVER = 6
#: Candidates that a task counts before it passes the counts on.
COUNTED = 50_000
#: Lengths of word beginnings.
PREFIXES = (3, 4, 5, 6)
FOLDS = 5

# Letters of other scripts that look like Latin ones, and signs used for letters.
LOOKALIKES = (
    "аa вb сc еe нh кk мm оo рp тt хx уy іi јj ѕs ԁd ԛq ԝw αa βb εe ιi κk νv οo ρp τt υu χx "
    "ɑa ɡg ıi ʟl ɴn ʀr 0o 1i 3e 4a 5s 7t"
).split()
_INVISIBLE = "­​‌‍⁠﻿"
_SIGN = re.compile(r"(?<=\w)[@$](?=\w)")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_FOLD = {ord(a): b for a, b in LOOKALIKES} | {ord(c): None for c in _INVISIBLE}
_WIDE = re.compile("[^\x00-\xff]")


def fold(text: str | None) -> str:
    """The words of a text as they are matched, with one space around each."""
    text = text or ""
    if _WIDE.search(text):
        text = unicodedata.normalize("NFKC", text)
    text = text.lower().translate(_FOLD)
    if "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return f" {_NOT_LETTER.sub(' ', text).strip()} "


def patterns(word: str) -> list[str]:
    """Candidate entries of a word: its beginnings, and the word as a whole."""
    return [f" {word[:n]}" for n in PREFIXES if len(word) >= n] + [f" {word} "]


@dataclass
class Model:
    """Entries with weights, exceptions, and the logistic fit of a document's two numbers."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    fit: tuple[float, float, float] = (-30.0, 0.0, 0.0)
    automaton: object = None

    def matcher(self):
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self.automaton.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                self.automaton.add_word(phrase, (len(phrase), 0.0))
            if len(self.automaton):
                self.automaton.make_automaton()
        return self.automaton

    def __getstate__(self):
        return self.__dict__ | {"automaton": None}

    def features(self, text: str | None) -> tuple[float, float]:
        """The summed weight, and the weight per hundred words, both as logarithms."""
        matcher, folded = self.matcher(), fold(text)
        if not len(matcher):
            return 0.0, 0.0
        best: dict[int, float] = {}
        excepted: list[tuple[int, int]] = []
        for end, (length, weight) in matcher.iter(folded):
            start = end - length + 1
            if weight:
                best[start] = max(weight, best.get(start, 0.0))
            else:
                excepted.append((start, end))
        for start, end in excepted:
            for at in [a for a in best if start <= a < end]:
                del best[at]
        total = sum(best.values())
        return math.log1p(total), math.log1p(100.0 * total / max(1, folded.count(" ") - 1))

    def score(self, text: str | None) -> float:
        total, density = self.features(text)
        z = self.fit[0] + self.fit[1] * total + self.fit[2] * density
        return round(1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z)))), 9)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    ridge = np.diag([1e-3, 1e-1, 1e-1])
    b = np.zeros(3)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ b
        )
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in b)


def _sample(labels: DataFrame) -> DataFrame:
    """At most TOXIC_DOCS + CLEAN_DOCS labelled ids outside the held-out fold."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(fold_remainder("doc_id", FOLDS) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max("toxic").cast("int").alias("_toxic"))
    )
    order = [F.xxhash64("_id"), F.col("_id")]
    some = [
        known.where(F.col("_toxic") == kind).orderBy(*order).limit(bound)
        for kind, bound in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))
    ]
    return some[0].union(some[1])


def _count_patterns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In how many toxic and clean documents each candidate occurs, in parts that add up."""
    columns = ["pattern", "toxic", "clean"]
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for rows in batches:
        for text, toxic in zip(rows["text"], rows["toxic"]):
            for pattern in {p for w in set(fold(text).split()) for p in patterns(w)}:
                counts[pattern][toxic] += 1
            if len(counts) >= COUNTED:
                yield pd.DataFrame([(p, t, c) for p, (c, t) in counts.items()], columns=columns)
                counts.clear()
    yield pd.DataFrame([(p, t, c) for p, (c, t) in counts.items()], columns=columns)


def _weight(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def _hits(candidates: list[str]):
    matcher = ahocorasick.Automaton()
    for i, entry in enumerate(candidates):
        matcher.add_word(entry, i)
    matcher.make_automaton()
    state = {"matcher": matcher}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [sorted({i for _, i in state["matcher"].iter(fold(t))}) for t in rows["text"]]
            yield pd.DataFrame({"toxic": rows["toxic"], "found": found})

    return run


def _choose(
    documents: list[tuple[int, list[int]]], weights: list[float], candidates: list[str]
) -> list[int]:
    """Greedy cover: each entry in turn is the one with the most weight in toxic documents that
    fewer than COVER entries explain so far. What only copies of one document share explains
    nothing new, so it stays out; an entry that explains fewer than SUPPORT documents is chance."""
    toxic = defaultdict(list)
    for row, (label, found) in enumerate(documents):
        if label:
            for i in found:
                toxic[i].append(row)
    # Of beginnings of one word that occur in the same documents the longest is enough.
    longest = {}
    for i in sorted(toxic, key=lambda i: len(candidates[i])):
        longest[tuple(toxic[i]), weights[i]] = i
    toxic = {i: toxic[i] for i in longest.values()}
    chosen, explained = [], Counter()
    while len(chosen) < ENTRIES:
        gain = {i: sum(explained[r] < COVER for r in rows) for i, rows in toxic.items()}
        toxic = {i: rows for i, rows in toxic.items() if gain[i] >= SUPPORT}
        if not toxic:
            break
        best = max(toxic, key=lambda i: (gain[i] * weights[i], i))
        chosen.append(best)
        explained.update(toxic.pop(best))
    return chosen


def _phrases(entries: list[str]):
    """Two-word phrases around entries, with the document's label."""
    starts = tuple(e[1:] for e in entries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for text, toxic in zip(rows["text"], rows["toxic"]):
                words = fold(text).split()
                at = [i for i, w in enumerate(words) if (w + " ").startswith(starts)]
                pairs = {(i - 1, i) for i in at if i} | {(i, i + 1) for i in at if i + 1 < len(words)}
                out += {(f" {words[i]} {words[j]} ", toxic) for i, j in pairs}
            yield pd.DataFrame(out, columns=["phrase", "toxic"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from documents (doc_id, text) and labels (doc_id, toxic).

    Labels other than 0 and 1, and those of unknown or null ids, teach nothing. Without both
    a toxic and a clean document the model finds nothing toxic.
    """
    sample = _sample(labels)
    known = written(
        docs.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("_id"), text_or_empty().alias("text"))
        # Bounded by TOXIC_DOCS + CLEAN_DOCS rows of two numbers.
        .join(F.broadcast(sample), "_id")
        .select("text", F.col("_toxic").alias("toxic"))
        .distinct(),
        "toxicity-sample",
    )
    sizes = dict(known.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()
    lift = (F.col("toxic") + 0.5) * (n_clean + 1) / ((F.col("clean") + 0.5) * (n_toxic + 1))
    best = (
        known.mapInPandas(_count_patterns, "pattern string, toxic long, clean long")
        .groupBy("pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= SUPPORT)
        .where(lift >= LIFT)
        .orderBy(F.desc(F.col("toxic") * F.log(lift)), "pattern")
        .limit(CANDIDATES)
        .collect()
    )
    if not best:
        return Model()
    counts = {r["pattern"]: (r["toxic"], r["clean"]) for r in best}
    candidates = sorted(counts)
    documents = [
        (r["toxic"], r["found"])
        for r in known.mapInPandas(_hits(candidates), "toxic int, found array<int>").collect()
    ]
    weights = [_weight(*counts[c], n_toxic, n_clean) for c in candidates]
    chosen = [candidates[i] for i in _choose(documents, weights, candidates)]
    if not chosen:
        return Model()
    exceptions = (
        known.mapInPandas(_phrases(chosen), "phrase string, toxic int")
        .groupBy("phrase")
        .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .where((F.col("toxic") == 0) & (F.col("n") >= SUPPORT))
        .orderBy(F.desc("n"), "phrase")
        .limit(EXCEPTIONS)
        .collect()
    )
    model = Model(
        {e: _weight(*counts[e], n_toxic, n_clean) for e in chosen}, [r["phrase"] for r in exceptions]
    )

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            xs = [model.features(t) for t in rows["text"]]
            yield pd.DataFrame({"toxic": rows["toxic"], "x": [x[0] for x in xs], "y": [x[1] for x in xs]})

    seen = known.mapInPandas(measure, "toxic int, x double, y double").toPandas()
    seen = seen.sort_values(["toxic", "x", "y"])
    model.fit = _logistic(seen[["x", "y"]].to_numpy(), seen["toxic"].to_numpy(float))
    return model


def toxicity(model: Model, text: Column) -> Column:
    """The score of a text column, 0 to 1; null and empty texts have no hits."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, with ids as they come: a null id
    gives a null held_out, repeated ids repeat. An empty table gives no rows; other columns
    are not looked at."""
    return (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .select(
            "doc_id",
            (fold_remainder("doc_id", FOLDS) == 0).alias("held_out"),
            toxicity(model, F.col("text")).alias("score"),
        )
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))
