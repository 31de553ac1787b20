"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q, at least ``REPEATS`` periods and ``LEAST``
words long, that neither neighbour extends. At each dyadic scale B the words are cut into blocks
of B words. A run of period q in [B, 2B) holds a whole block and its copy q words on, so the sum
of squared differences of their word numbers is zero. These sums, for every block and all
distances of the scale, are one convolution, taken exactly as a number theoretic transform modulo
a prime. A zero gives a distance whose stretch is compared word by word and extended to both
sides; that also drops zeros that are only zero modulo the prime.

Distances come in ascending order, and those that are multiples of a known run's period and lie
inside it are passed over: such a stretch is that run again. So a text of one word repeated costs
one extension. Many texts share one convolution, with a number of its own between them; a text as
long as they come is cut into blocks like any other. The work is n log(n)^2 in a text's words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import table, text_or_empty
from obsgrid.llm.registry import query

#: Fewest periods and words of a run.
REPEATS = 3
LEAST = 24
#: Blocks of the smallest scale, which also finds all shorter periods. A run has to hold a block
#: and its copy: LEAST - (BASE - 1) words hold 2 * BASE - 1.
BASE = 8
#: 15 * 2^27 + 1, with 31 as a generator of its units.
PRIME = np.uint64(2013265921)
GENERATOR = 31
#: Words of the texts that are looked at together, and numbers transformed at once.
TOGETHER = 1 << 16
GRID = 1 << 17

_roots: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}


def _mod(x: np.ndarray) -> np.ndarray:
    return x - (x // PRIME) * PRIME


def _powers(root: int, count: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, _mod(out * np.uint64(pow(root, len(out), int(PRIME))))])
    return out[:count]


def _twiddles(size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Powers of the roots of unity for halves of size / 2 down to 1, and of their inverses."""
    if size not in _roots:
        prime, halves = int(PRIME), [size >> k for k in range(1, size.bit_length())]
        bases = [pow(GENERATOR, (prime - 1) // (2 * h), prime) for h in halves]
        _roots[size] = tuple(
            [_powers(b, h)[:, None] for b, h in zip(side, halves)]
            for side in (bases, [pow(b, -1, prime) for b in bases])
        )
    return _roots[size]


def _forward(a: np.ndarray) -> np.ndarray:
    """Transforms of the columns, in bit-reversed order."""
    for w in _twiddles(len(a))[0]:
        pairs = a.reshape(-1, 2, len(w), a.shape[1])
        u, v = pairs[:, 0], pairs[:, 1]
        total, gap = u + v, u - v
        pairs[:, 1] = _mod(np.minimum(gap, gap + PRIME) * w)
        pairs[:, 0] = np.minimum(total, total - PRIME)
    return a


def _backward(a: np.ndarray) -> np.ndarray:
    """The inverse of ``_forward``, but for the factor of the length."""
    for w in reversed(_twiddles(len(a))[1]):
        pairs = a.reshape(-1, 2, len(w), a.shape[1])
        u, v = pairs[:, 0], _mod(pairs[:, 1] * w)
        total, gap = u + v, u - v
        pairs[:, 1] = np.minimum(gap, gap + PRIME)
        pairs[:, 0] = np.minimum(total, total - PRIME)
    return a


def zero_distances(ids: np.ndarray, block: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks and distances in [shift, shift + block) at which the words of a block are
    those of its copy, as far as the sums modulo the prime tell."""
    size = 2 * block
    count = -(-len(ids) // block)
    fresh = int(ids.max(initial=0)) + 1
    padded = np.concatenate([ids, np.arange(fresh, fresh + shift + 3 * size)]).astype(np.uint64)
    squares = _mod(padded * padded)
    step, at, starts, distances = max(1, GRID // size), 0, [], []
    while at < count:
        many = min(step, count - at)

        def view(values: np.ndarray, first: int, rows: int) -> np.ndarray:
            part = values[at * block + first :]
            strides = (part.strides[0], part.strides[0] * block)
            return np.lib.stride_tricks.as_strided(part, (rows, many), strides, writeable=False)

        own = np.zeros((size, many), np.uint64)
        own[:block] = view(padded, 0, block)[::-1]
        window = np.zeros((size, many), np.uint64)
        window[:-1] = view(padded, shift, size - 1)
        products = _backward(_mod(_forward(own) * _forward(window)))[block - 1 : size - 1]
        sums = np.zeros((size, many), np.uint64)
        np.cumsum(view(squares, shift, size - 1), axis=0, out=sums[1:])
        both = _mod(sums[block:] - sums[:block] + view(squares, 0, block).sum(axis=0, dtype=np.uint64))
        distance, column = np.nonzero(_mod(both * np.uint64(size)) == _mod(products * np.uint64(2)))
        starts.append((column + at) * block)
        distances.append(distance + shift)
        at += many
    return np.concatenate(starts), np.concatenate(distances)


def _agree(ids: np.ndarray, at: int, distance: int) -> tuple[int, int]:
    """The stretch [first, last) around ``at`` whose words equal those ``distance`` further on."""
    last, step, end = at, 64, len(ids) - distance
    while last < end:
        stop = min(last + step, end)
        differ = ids[last:stop] != ids[last + distance : stop + distance]
        if differ.any():
            last += int(differ.argmax())
            break
        last, step = stop, 2 * step
    first, step = at, 64
    while first > 0:
        stop = max(first - step, 0)
        differ = (ids[stop:first] != ids[stop + distance : first + distance])[::-1]
        if differ.any():
            first -= int(differ.argmax())
            break
        first, step = stop, 2 * step
    return first, last


def _inside(starts: np.ndarray, reach: int, known: list[tuple[int, int]]) -> np.ndarray:
    """Which of [start, start + reach) lie in one of the runs, which ascend."""
    bounds = np.array(known)
    at = np.searchsorted(bounds[:, 0], starts, "right") - 1
    return (at >= 0) & (starts + reach <= bounds[np.maximum(at, 0), 1])


def find_runs(ids: np.ndarray, sizes: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, in no order.

    ``sizes`` are the lengths of texts that stand in it one after the other, longest first, so a
    scale that only long texts have periods for stops at the last of those.
    """
    sizes = [len(ids)] if sizes is None else sizes
    ends = np.cumsum(sizes)
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    block = BASE
    while True:
        fits = sum(1 for s in sizes if s >= max(LEAST, REPEATS * (block if block > BASE else 1)))
        if not fits:
            break
        part = ids[: ends[fits - 1]]
        for shift in (0, block) if block == BASE else (block,):
            starts, distances = zero_distances(part, block, shift)
            order = np.lexsort((starts, distances))
            starts, distances = starts[order], distances[order]
            cuts = np.flatnonzero(np.diff(distances)) + 1
            for group in np.split(np.arange(len(starts)), cuts) if len(starts) else []:
                distance = int(distances[group[0]])
                if distance == 0:
                    continue
                seeds = starts[group]
                periods = np.fromiter(runs, np.int64, len(runs))
                for q in periods[distance % periods == 0].tolist() if len(periods) else []:
                    seeds = seeds[~_inside(seeds, block + distance, runs[q])]
                done = 0
                for seed in seeds.tolist():
                    if seed < done:
                        continue
                    first, last = _agree(part, seed, distance)
                    if last < seed + block:
                        continue
                    done = last
                    length = last + distance - first
                    if length >= max(LEAST, REPEATS * distance):
                        runs[distance].append((first, first + length))
        block *= 2
    return [(a, b - a, q) for q, found in runs.items() for a, b in found]


def word_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    number: dict[bytes, int] = {}
    parts: list[int] = []
    starts = []
    for turn, i in enumerate(order):
        starts.append(len(parts))
        parts += [number.setdefault(w, len(number)) for w in texts[i]]
        parts.append(-1 - turn)
    ids = np.array(parts, np.int64)
    # Separators differ from each other and from all words.
    ids = np.where(ids < 0, len(number) - 1 - ids, ids)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = np.array(starts)
    for start, length, period in find_runs(ids, [len(texts[i]) + 1 for i in order]):
        turn = int(np.searchsorted(owner, start, "right")) - 1
        out[order[turn]].append((start - int(owner[turn]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those of a run after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    listing = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
    return (
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listing.encode()).hexdigest(),
        b" ".join(collapsed(words, runs)),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed"]


def as_written(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    return words


def _in_tasks(words_of):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(ids: list, texts: list[list[bytes]]) -> pd.DataFrame:
            rows = [_summary(*x) for x in zip(texts, word_runs(texts))]
            out = pd.DataFrame(rows, columns=COLUMNS)
            out["collapsed_sha256"] = [hashlib.sha256(x).hexdigest() for x in out["collapsed"]]
            out["collapsed"] = [x.decode("utf-8") for x in out["collapsed"]]
            out.insert(0, "doc_id", pd.array(ids, "Int64"))
            whole = ["n_runs", "start", "length", "period", "exponent_milli"]
            return out.astype({c: "Int64" for c in whole})

        for rows in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                doc_id = None if doc_id is None else int(doc_id)
                words = words_of(doc_id, text.encode("utf-8", "replace").split())
                ids.append(doc_id)
                texts.append(words)
                held += len(words) + 1
                if held >= TOGETHER:
                    yield found(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield found(ids, texts)

    return run


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_of=as_written
) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed,
    collapsed_sha256) of every row; start to exponent_milli are those of the run with the most
    periods and null where there is none.

    ``words_of`` turns a document's id and words into the words to look at. Null texts are empty;
    ids come as they are, null and repeated ones too. An empty table gives no rows; other columns
    are not looked at.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").cast("string").alias("doc_id"), text_or_empty(text).alias("text")
    )
    return rows.mapInPandas(
        _in_tasks(words_of),
        "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed string, collapsed_sha256 string",
    )


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's words: by its id's hash, one text in ten goes on from some word by repeating
    what stands there. A text without an id stays as written."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), words_of=looped).drop("collapsed")
