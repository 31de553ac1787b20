"""Language of words and texts by a linear-chain conditional random field.

Every word has a score per language from its features: character n-grams up to four with marks
at both ends, so that affixes are features of their own, and the word itself as a lexicon
entry, all hashed into one weight table. Learned transitions tie neighbouring words together,
and forward-backward gives each word's probabilities in the whole text, which may change its
language on the way. A text's language is the one with the largest mean probability.

Documents carry one language each. For the fit, windows of a bounded sample of documents
(``PER_LANGUAGE`` of each language, ``WINDOW`` words at a seeded place) are spliced into
sequences that switch language about every ``WINDOW`` words, which is what the transitions learn.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsgrid.llm.common import fold_remainder, table, text_or_empty
from obsgrid.llm.registry import query

#: Bounds of the sample that the field is fitted on.
PER_LANGUAGE = 400
WINDOW = 48
SPLICED = 3
FOLDS, HELD_OUT = 4, 2
ORDERS = (1, 2, 3, 4)
BITS = 16
EPOCHS = 6
#: Characters labelled at a time, but for a longer text; bounds a task's memory.
BLOCK_CHARS = 1 << 21
#: A longer text is labelled in pieces of so many words: what was learned before the cut is
#: carried over it, what comes after it is not.
PIECE_WORDS = 1 << 17

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def _hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words in a row, and where each word's features start."""
    data = [b"\x02" + w.encode("utf-8") + b"\x03" for w in words]
    sizes = np.array([len(d) for d in data], np.int64)
    ends = np.cumsum(sizes)
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    left = np.repeat(ends, sizes) - np.arange(len(flat))  # bytes up to the word's end
    parts, owners = [], []
    rolling = np.zeros(len(flat), np.uint64)
    owner = np.repeat(np.arange(len(data)), sizes)
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros_like(flat)
        shifted[: len(flat) - order + 1] = flat[order - 1 :]
        rolling = rolling * np.uint64(1_000_003) + shifted + np.uint64(1)
        fits = left >= order
        parts.append(_mix(rolling[fits] + np.uint64(order)))
        owners.append(owner[fits])
    # The word as a whole: a sum over its bytes, each mixed with its place.
    place = np.arange(len(flat), dtype=np.uint64) - np.repeat(ends - sizes, sizes).astype(np.uint64)
    whole = np.add.reduceat(_mix64(flat * np.uint64(2_654_435_761) + place * np.uint64(97)), ends - sizes)
    parts.append(_mix(whole))
    owners.append(np.arange(len(data)))
    features, owners = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(data)))[:-1]])
    return features[order], starts


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _mix(x: np.ndarray) -> np.ndarray:
    return (_mix64(x) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Field:
    """Labels in order, feature weights, transition scores and start scores."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        features, starts = _hashed(words)
        return np.add.reduceat(self.weights[features], starts, axis=0)

    def marginals(
        self, scores: np.ndarray, sizes: np.ndarray, before: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of every word of texts that follow each other in ``scores``, all of
        them at least one word long, the messages that leave their ends, and those at every
        word. ``before`` are messages that enter them."""
        order = np.argsort(-sizes, kind="stable")
        at = (np.cumsum(sizes) - sizes)[order]
        longest = int(sizes.max())
        active = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
        likely = np.exp(scores - scores.max(axis=1, keepdims=True))
        step = np.exp(self.moves)
        alpha = np.empty_like(likely)
        enter = np.exp(self.first)[None] if before is None else before[order] @ step
        state = enter * likely[at]
        state /= state.sum(axis=1, keepdims=True)
        alpha[at] = state
        for t in range(1, longest):
            n = active[t]
            state = (state[:n] @ step) * likely[at[:n] + t]
            state /= state.sum(axis=1, keepdims=True)
            alpha[at[:n] + t] = state
        out = np.empty_like(likely)
        back = np.ones((0, scores.shape[1]))
        for t in range(longest - 1, -1, -1):
            n = active[t]
            if t + 1 < longest and len(back):
                m = active[t + 1]
                carried = (likely[at[:m] + t + 1] * back) @ step.T
                carried /= carried.sum(axis=1, keepdims=True)
                back = np.concatenate([carried, np.ones((n - m, scores.shape[1]))])
            else:
                back = np.ones((n, scores.shape[1]))
            out[at[:n] + t] = alpha[at[:n] + t] * back
        out /= out.sum(axis=1, keepdims=True)
        leaving = alpha[np.cumsum(sizes) - 1]
        return out, leaving, alpha


def fit(rows: list[tuple[str, list[str]]], seed: int = 11) -> Field:
    """The field from (language, words) windows, by likelihood gradients (Adam)."""
    labels = sorted({lang for lang, _ in rows})
    number = {lang: i for i, lang in enumerate(labels)}
    k = len(labels)
    rng = np.random.default_rng(seed)
    field = Field(labels, np.zeros((1 << BITS, k)), np.zeros((k, k)), np.zeros(k))
    if k < 2 or not rows:
        return field
    vocabulary = sorted({w for _, words in rows for w in words})
    index = {w: i for i, w in enumerate(vocabulary)}
    features, starts = _hashed(vocabulary)
    counts = np.diff(np.append(starts, len(features)))
    params = [field.weights, field.moves, field.first]
    first_moment = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    turn = 0
    for _ in range(EPOCHS):
        deck = rng.permutation(len(rows))
        for at in range(0, len(deck), 32 * SPLICED):
            batch = [deck[i : i + SPLICED] for i in range(at, min(len(deck), at + 32 * SPLICED), SPLICED)]
            words = [np.array([index[w] for r in s for w in rows[r][1]]) for s in batch]
            truth = [np.array([number[rows[r][0]] for r in s for _ in rows[r][1]]) for s in batch]
            sizes = np.array([len(w) for w in words])
            flat, gold = np.concatenate(words), np.concatenate(truth)
            used, inverse = np.unique(flat, return_inverse=True)
            pick = np.repeat(starts[used] - np.concatenate([[0], np.cumsum(counts[used])[:-1]]), counts[used])
            own = features[pick + np.arange(counts[used].sum())]
            cut_at = np.concatenate([[0], np.cumsum(counts[used])[:-1]])
            scores = np.add.reduceat(field.weights[own], cut_at, axis=0)[inverse]
            probs, _, alpha = field.marginals(scores, sizes)
            gap = -probs
            gap[np.arange(len(gold)), gold] += 1.0
            of_word = np.stack([np.bincount(inverse, gap[:, c], len(used)) for c in range(k)], axis=1)
            spread = np.repeat(of_word, counts[used], axis=0)
            grad_w = np.stack([np.bincount(own, spread[:, c], 1 << BITS) for c in range(k)], axis=1)
            inner = np.ones(len(gold), bool)
            inner[np.cumsum(sizes) - 1] = False
            i = np.flatnonzero(inner)
            # What the next word and all after it say: its probability without the words before.
            later = probs[i + 1] / np.maximum(alpha[i + 1], 1e-300)
            later *= np.exp(scores[i + 1] - scores[i + 1].max(axis=1, keepdims=True))
            pair = alpha[i][:, :, None] * np.exp(field.moves)[None] * later[:, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[i], gold[i + 1]), 1.0)
            heads = np.cumsum(sizes) - sizes
            grads = [grad_w, seen - pair.sum(axis=0), gap[heads].sum(axis=0)]
            turn += 1
            for p, g, m, v in zip(params, grads, first_moment, second):
                g = g / len(sizes) - 1e-4 * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += 0.05 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-6)
    field.weights = field.weights.astype(np.float32)
    return field


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Field:
    """The field from the documents outside the held-out fold. Rows with a null id, language or
    text, and texts without letters, teach nothing; without any row there are no labels."""
    known = docs.where(
        F.col(doc_id).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull()
    ).where(fold_remainder(doc_id, FOLDS) != HELD_OUT)
    ids = known.select(F.col(doc_id).cast("long").alias("_id"), F.col(lang).alias("_lang")).distinct()
    turn = F.row_number().over(Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    some = ids.withColumn("_turn", turn).where(F.col("_turn") <= PER_LANGUAGE).drop("_turn")

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for lang_, text_, id_ in zip(rows["_lang"], rows["_text"], rows["_id"]):
                words = words_of(text_)
                start = (id_ * 2_654_435_761 % 1_000_003) % max(1, len(words) - WINDOW + 1)
                out.append((lang_, id_, words[start : start + WINDOW]))
            yield pd.DataFrame(out, columns=["lang", "id", "words"])

    sample = (
        known.select(F.col(doc_id).cast("long").alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
        # PER_LANGUAGE ids of each language.
        .join(F.broadcast(some), ["_id", "_lang"])
        .mapInPandas(windows, "lang string, id long, words array<string>")
    )
    rows = sorted((r["lang"], r["id"], r["words"]) for r in sample.collect())
    return fit([(lang_, words) for lang_, _, words in rows if words])


def _blocks(texts: list[str]) -> Iterator[list[int]]:
    """Numbers of texts, longest first, in blocks of about BLOCK_CHARS characters."""
    block, held = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        block.append(i)
        held += len(texts[i])
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


def _probabilities(model: Field, texts: list[str]) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """(number of the text, some of its words, their probabilities), in the words' order."""
    for block in _blocks(texts):
        words = {i: w for i in block if (w := words_of(texts[i]))}
        message: dict[int, np.ndarray] = {}
        for at in range(0, max(map(len, words.values()), default=0), PIECE_WORDS):
            now = [i for i, w in words.items() if len(w) > at]
            parts = [words[i][at : at + PIECE_WORDS] for i in now]
            sizes = np.array([len(p) for p in parts])
            coded = pa.array([w for p in parts for w in p], pa.string()).dictionary_encode()
            scores = model.scores(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            before = np.stack([message[i] for i in now]) if at else None
            probs, leaving, _ = model.marginals(scores, sizes, before)
            message = dict(zip(now, leaving))
            yield from zip(now, parts, np.split(probs, np.cumsum(sizes)[:-1]))


def predict(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    A text that is null or has no letters is ``und`` with score 0, as is every text if nothing
    was learned. Ids come as they are, null and repeated ones too. An empty table gives no rows;
    other columns are not looked at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts = rows["_text"].tolist() if model.labels else []
            sums = np.zeros((len(rows), max(1, len(model.labels))))
            counts = np.zeros(len(rows), np.int64)
            for i, words, probs in _probabilities(model, texts):
                sums[i] += probs.sum(axis=0)
                counts[i] += len(words)
            best = sums.argmax(axis=1)
            share = sums.max(axis=1) / np.maximum(1, counts)
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"],
                    "held_out": rows["held_out"],
                    "lang_pred": [model.labels[b] if n else "und" for b, n in zip(best, counts)],
                    "score": np.round(np.minimum(share, 1.0), 6),
                }
            )

    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (fold_remainder(doc_id, FOLDS) == HELD_OUT).alias("held_out"),
        text_or_empty(text).alias("_text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def label_words(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, words, langs): every word of every row and its most probable language; none if
    nothing was learned."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found: list[list[str]] = [[] for _ in range(len(rows))]
            langs: list[list[str]] = [[] for _ in range(len(rows))]
            if model.labels:
                for i, words, probs in _probabilities(model, rows["_text"].tolist()):
                    found[i] += words
                    langs[i] += [model.labels[b] for b in probs.argmax(axis=1)]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "words": found, "langs": langs})

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, words array<string>, langs array<string>")


@query()
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
