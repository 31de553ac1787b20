"""Packing documents into training sequences by order-preserving dynamic programming.

The documents of a partition are one stream of token ids in the order in which they are stored.
Windows of at most ``WINDOW`` ids follow each other in it; where they end is chosen by dynamic
programming over the ends of documents and sentences. A window costs its padding (none if its
length is a power of two), a constant, and a penalty for the document that its end cuts:
``SENTENCE`` after a sentence, ``BREAK`` inside one. Places inside sentences are only offered where
a sentence runs on for more than ``STRIDE`` ids, and in the last windows of a partition. The best
predecessor among all windows that need padding is the least of (cost + place) over the places in
reach, which a monotone queue holds, so a place costs a constant number of steps.

The programme runs over ``HORIZON`` ids at a time and settles all windows but the last few, whose
ids stay for its next run. Nothing is shuffled; a partition's tail is the only loss to its bounds.

Ids come from the tokenizer library. It drops white space and never merges across it, so Arrow splits
and numbers the chunks between white space of several texts at a time, and the library encodes each
distinct one, without its case and last punctuation, once; its ids are looked up after that. Words of
plain letters go to the library's model without its normalizer and patterns, which leave them whole.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from obsgrid.llm.common import table, text_or_empty
from obsgrid.llm.registry import query

VOCABULARY = "word_bpe_49k.json"
#: Longest sequence, and the id that ends a document.
WINDOW = 2048
END = 1
#: Costs in ids of padding: of a sequence, of a cut after a sentence, of a cut inside one.
SEQUENCE = 8
SENTENCE = 2
BREAK = 24
#: Places inside a sentence are offered once in so many ids.
STRIDE = 32
#: Ids that the dynamic programming looks at together, and those it leaves to its next run.
HORIZON = 1 << 18
MARGIN = 4 * WINDOW
#: Words that a worker keeps, and bytes of text that are split at a time.
KNOWN = 1_500_000
SLICE = 8 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: All signs of ASCII but the apostrophe, after which the library may part a word.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters that the library's normalizer at most lower-cases.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: By byte: those that end a sentence, those that may close it after them, letters and digits, and the
#: second bytes of the letters above.
_STOPS, _CLOSERS, _ALNUM, _SECOND = (
    np.isin(np.arange(256), list(x))
    for x in (
        b".!?",
        b"\"')]",
        b"abcdefghijklmnopqrstuvwxyz0123456789",
        [*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)],
    )
)
#: The patterns by which letters are words of their own.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SUFFIX = "</w>"


def _letters_of_bytes() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte; blanks stay."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}, 32: " "}


class Coder:
    """Encodes texts chunk by chunk with a tokenizer of the library."""

    def __init__(self, vocabulary: str):
        self.library = Tokenizer.from_str(vocabulary)
        # Texts that hold one of these are left to the library whole.
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.cores: dict[bytes, bytes] = {}
        self.model = self._bare(vocabulary)

    def _bare(self, vocabulary: str) -> Tokenizer | None:
        """The tokenizer for words of plain letters; none if the vocabulary treats them otherwise."""
        spec = json.loads(vocabulary)
        split, byte_level = [*(spec["pre_tokenizer"] or {}).get("pretokenizers", []), {}, {}][:2]
        if (
            spec["model"].get("end_of_word_suffix") != _SUFFIX
            or split.get("pattern") != {"Regex": _WORDS}
            or byte_level.get("type") != "ByteLevel"
            or byte_level.get("add_prefix_space")
            or {"type": "Lowercase"} not in (spec["normalizer"] or {}).get("normalizers", [])
        ):
            return None
        bare = Tokenizer.from_str(vocabulary)
        bare.normalizer = normalizers.Sequence([])
        bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        ids = bare.get_vocab()
        self.letters = _letters_of_bytes()
        self.final = np.zeros(max(ids.values()) + 1, bool)
        self.final[[i for token, i in ids.items() if token.endswith(_SUFFIX)]] = True
        return bare

    def _whole(self, chunk: bytes) -> np.ndarray:
        found = self.library.encode(chunk.decode("utf-8"), add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def _learn_cores(self, cores: list[bytes]) -> None:
        """Cores go to the library many at a time; the place of an id's first character tells
        whose it is."""
        for at in range(0, len(cores), 1000):
            some = cores[at : at + 1000]
            line = b" ".join(some).decode("utf-8")
            found = self.library.encode(line, add_special_tokens=False)
            texts = some if line.isascii() else line.split(" ")
            starts = np.cumsum([0, *map(len, texts)]) + np.arange(len(texts) + 1)
            firsts = [first for first, _ in found.offsets]
            cuts = (4 * np.searchsorted(np.array(firsts, np.int64), starts)).tolist()
            data = np.array(found.ids, "<u4").tobytes()
            self.cores.update(zip(some, map(data.__getitem__, map(slice, cuts, cuts[1:]))))

    def _learn_words(self, words: list[bytes]) -> None:
        """The same for words of plain letters, each of which has one id that ends a word."""
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            line = b" ".join(some).decode("utf-8").lower().encode("utf-8").decode("latin-1")
            ids = np.array(self.model.encode(line.translate(self.letters), add_special_tokens=False).ids, "<u4")
            cuts = [0, *(4 * np.flatnonzero(self.final[ids]) + 4).tolist()]
            self.cores.update(zip(some, map(ids.tobytes().__getitem__, map(slice, cuts, cuts[1:])), strict=True))

    def _ids_of(self, cores: pa.Array) -> pa.Array:
        """The ids of each of the lower-cased chunks."""
        found = cores.dictionary_encode()
        own = found.dictionary.cast(pa.binary()).to_pylist()
        fresh = list(itertools.filterfalse(self.cores.__contains__, own))
        if len(self.cores) + len(fresh) > KNOWN:
            self.cores, fresh = {}, own
        # Alike words meet in the library's own cache.
        fresh = sorted(filter(None, fresh))
        plain = _LETTERS.fullmatch if self.model else lambda core: None
        self._learn_words([core for core in fresh if plain(core)])
        self._learn_cores([core for core in fresh if not plain(core)])
        self.cores[b""] = b""
        return pa.array(list(map(self.cores.__getitem__, own)), pa.binary()).take(found.indices)

    def _ids_of_chunks(self, chunks: pa.Array) -> pa.Array:
        """The ids of each of the chunks. The library lower-cases too; punctuation after a letter or
        digit is a word of its own."""
        low = pc.ascii_lower(chunks)
        core = pc.ascii_rtrim(low, characters=_MARKS)
        text, stops = _bytes_of(core)
        final, before = text[stops - 1], text[stops - 2]
        sizes = np.diff(stops, prepend=2)
        apart = _ALNUM[final] | ((before == 0xC3) & _SECOND[final])
        apart &= (sizes > 0) & (sizes < np.diff(_bytes_of(low)[1], prepend=2))
        at = pa.array(np.flatnonzero(apart))
        marks = [m[k:] for m, k in zip(low.take(at).cast(pa.binary()).to_pylist(), sizes[apart].tolist())]
        ids = self._ids_of(pc.if_else(pa.array(apart), core, low))
        if not marks:
            return ids
        both = pc.binary_join_element_wise(ids.take(at), self._ids_of(pa.array(marks, pa.string())), b"")
        return pc.replace_with_mask(ids, pa.array(apart), both)

    def _coded(self, texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts together: the ids, how many stand before the end of each text, and of each
        sentence, and the number of sentences that end before the end of each text."""
        lists = pc.ascii_split_whitespace(texts)
        chunks = lists.flatten().dictionary_encode()
        turns = lists.offsets.to_numpy()
        distinct = chunks.dictionary
        found = self._ids_of_chunks(distinct).take(chunks.indices)
        ids, stops = _bytes_of(found)
        ids, stops = ids[2:].tobytes(), np.append(0, (stops - 2) // 4)
        ending = np.flatnonzero(_ends_sentence(distinct)[chunks.indices.to_numpy()]) + 1
        return ids, stops[turns[1:]], stops[ending], np.searchsorted(ending, turns[1:], "right")

    def _slices(self, data: bytes) -> Iterator[bytes]:
        at = 0
        while len(data) - at > SLICE:
            space = _SPACE.search(data, at + SLICE)
            if not space:
                break
            yield data[at : space.start()]
            at = space.end()
        yield data[at:]

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """The ids as little-endian 32-bit numbers, and how many ids stand before the end of each
        sentence."""
        data = text.encode("utf-8", "replace")
        if any(s in data.lower() for s in self.special):
            ids = self._whole(data)
            return ids.tobytes(), np.array([len(ids)])
        out, ends, before = [], [], 0
        for part in self._slices(data):
            found, bounds, sentences, _ = self._coded(pa.array([part], pa.string()))
            out.append(found)
            ends.append(sentences + before)
            before += int(bounds[-1])
        return b"".join(out), np.concatenate([*ends, [before]])

    def encode_together(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts together: the ids, how many stand before the end of each text, and of each
        sentence, and the number of sentences that end before the end of each text."""
        parts = [t.encode("utf-8", "replace") for t in texts]
        low = b"\n".join(parts).lower()
        if not any(s in low for s in self.special):
            return self._coded(pa.array(parts, pa.string()))
        alone = [self.encode(t) for t in texts]
        bounds = np.cumsum([len(ids) // 4 for ids, _ in alone])
        before = [0, *bounds.tolist()]
        sentences = np.concatenate([ends[:-1] + b for (_, ends), b in zip(alone, before)])
        turns = np.cumsum([len(ends) - 1 for _, ends in alone])
        return b"".join(ids for ids, _ in alone), bounds, sentences, turns

    def encode_all(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """What ``encode`` gives for each of several texts, which are encoded together."""
        ids, bounds, sentences, turns = self.encode_together(texts)
        bounds, turns = [0, *bounds.tolist()], [0, *turns.tolist()]
        for a, b, i, j in zip(bounds, bounds[1:], turns, turns[1:]):
            yield ids[4 * a : 4 * b], np.append(sentences[i:j], b) - a


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts after two blanks, and where each text ends in them."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return np.concatenate([np.full(2, 32, np.uint8), text]), offsets[1:] - offsets[0] + 2


def _ends_sentence(chunks: pa.Array) -> np.ndarray:
    """Whether a sentence ends with the chunk."""
    text, stops = _bytes_of(chunks)
    sizes = np.diff(stops, prepend=2)
    final = text[stops - 1]
    return (sizes > 0) & (_STOPS[final] | ((sizes > 1) & _CLOSERS[final] & _STOPS[text[stops - 2]]))


def _coder(vocabulary: str) -> Coder:
    """The worker process's coder for this vocabulary, kept between its tasks."""
    store = sys.modules.setdefault("obsgrid_worker_coders", types.ModuleType("obsgrid_worker_coders"))
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if not hasattr(store, key):
        setattr(store, key, Coder(vocabulary))
    return getattr(store, key)


def places(size: int, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a document of so many ids may be cut, its end included, and the penalties."""
    return all_places(np.array([size]), sentences[(sentences > 0) & (sentences < size)])


def all_places(lasts: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for documents that follow each other, by where they and their sentences end."""
    ends = np.concatenate([lasts, sentences])
    # A document's end comes before a sentence that ends there.
    order = np.argsort(ends, kind="stable")
    ends, final = ends[order], order < len(lasts)
    gaps = np.diff(ends, prepend=0)
    kept = gaps > 0
    ends, gaps, final = ends[kept], gaps[kept], final[kept]
    more = (gaps - 1) // STRIDE
    penalty = np.where(final, 0, SENTENCE)
    if not more.any():
        return ends, penalty
    # Each end after the places inside its sentence.
    turn = np.arange(len(ends) + more.sum()) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    inside = turn < np.repeat(more, more + 1)
    at = np.where(inside, np.repeat(ends - gaps, more + 1) + (turn + 1) * STRIDE, np.repeat(ends, more + 1))
    return at, np.where(inside, BREAK, np.repeat(penalty, more + 1))


def _unpadded(at: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """Pairs of places (later, earlier) that are a power of two apart, later ones ascending."""
    later, earlier = [], []
    for power in (1 << k for k in range(window.bit_length())):
        found = np.minimum(np.searchsorted(at, at - power), len(at) - 1)
        hit = np.flatnonzero(at[found] == at - power)
        later.append(hit)
        earlier.append(found[hit])
    later, earlier = np.concatenate(later), np.concatenate(earlier)
    order = np.argsort(later, kind="stable")
    return later[order].tolist(), earlier[order].tolist()


def cuts(at: list[int], penalty: list[int], window: int = WINDOW) -> list[int]:
    """Indices of the places at which the cheapest windows end, the last place included. The
    places ascend from 0, which is the start, in steps of at most a window; the window is a power
    of two."""
    later, earlier = _unpadded(np.array(at), window)
    later.append(len(at))
    best, came, hit = [0] * len(at), [0] * len(at), 0
    # The queue: places in reach by ascending (cost + place), each earlier than the ones after it.
    waiting, values, head = [], [], 0
    for j in range(1, len(at)):
        place, value = at[j], best[j - 1] + at[j - 1]
        while len(values) > head and values[-1] >= value:
            values.pop()
            waiting.pop()
        values.append(value)
        waiting.append(j - 1)
        while at[waiting[head]] < place - window:
            head += 1
        cost, source = values[head] + window - place, waiting[head]
        while later[hit] == j:
            i = earlier[hit]
            if best[i] < cost:
                cost, source = best[i], i
            hit += 1
        best[j], came[j] = cost + penalty[j] + SEQUENCE, source
    out, j = [], len(at) - 1
    while j:
        out.append(j)
        j = came[j]
    return out[::-1]


class Packer:
    """Takes documents one by one and gives the pieces of settled windows."""

    COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def __init__(self, first: int, with_ids: bool, window: int = WINDOW):
        self.sequence, self.with_ids, self.window = first, with_ids, window
        #: Documents not wholly settled: id, ids, number of ids, where they begin in the stream.
        self.docs: list[tuple] = []
        self.at: list[np.ndarray] = []
        self.penalty: list[np.ndarray] = []
        self.settled = self.end = 0

    def add(self, doc_id, ids: bytes, sentences: np.ndarray) -> Iterator[list[tuple]]:
        return self.add_all([doc_id], [ids], *places(len(ids) // 4, sentences))

    def add_all(self, doc_ids: list, ids: list[bytes], at: np.ndarray, penalty: np.ndarray) -> Iterator[list[tuple]]:
        """Documents that follow each other, and the places where they may be cut."""
        self.at.append(at + self.end)
        self.penalty.append(penalty)
        for doc_id, own in zip(doc_ids, ids):
            size = len(own) // 4
            self.docs.append((doc_id, own, size, self.end))
            self.end += size
        if self.end - self.settled >= HORIZON:
            at, penalty = np.concatenate(self.at), np.concatenate(self.penalty)
            while self.end - self.settled >= HORIZON:
                first, stop = np.searchsorted(at, [self.settled, self.settled + HORIZON], "right")
                chosen = self._cuts(at[first:stop], penalty[first:stop])
                yield self._pieces([c for c in chosen if c <= at[stop - 1] - MARGIN])
            rest = at > self.settled
            self.at, self.penalty = [at[rest]], [penalty[rest]]

    def finish(self) -> list[tuple]:
        """The pieces of all that is left; its last two windows may be cut anywhere."""
        if self.end == self.settled:
            return []
        at, penalty = np.concatenate(self.at), np.concatenate(self.penalty)
        anywhere = np.setdiff1d(np.arange(max(self.settled + 1, self.end - 2 * self.window), self.end), at)
        at = np.concatenate([at, anywhere])
        order = np.argsort(at)
        penalty = np.concatenate([penalty, np.full(len(anywhere), BREAK)])
        return self._pieces(self._cuts(at[order], penalty[order]))

    def _cuts(self, at: np.ndarray, penalty: np.ndarray) -> list[int]:
        places = [self.settled, *at.tolist()]
        return [places[i] for i in cuts([p - self.settled for p in places], [0, *penalty.tolist()], self.window)]

    def _pieces(self, stops: list[int]) -> list[tuple]:
        out, turn = [], 0
        for stop in stops:
            begin = self.settled
            while self.settled < stop:
                doc_id, ids, size, base = self.docs[turn]
                a, b = self.settled - base, min(stop - base, size)
                part = memoryview(ids)[4 * a : 4 * b]
                kept = np.frombuffer(part, "<u4") if self.with_ids else None
                row = (doc_id, a, b - a, zlib.crc32(part), size, self.sequence, self.settled - begin, kept)
                out.append(row)
                self.settled = base + b
                turn += b == size
            self.sequence += 1
        del self.docs[:turn]
        return out


def _in_tasks(vocabulary: str, with_ids: bool, end_id: int, window: int):
    end = np.array([end_id], "<u4").tobytes()

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=Packer.COLUMNS)
        out["doc_id"] = pd.array(out["doc_id"].tolist(), "Int64")
        return out if with_ids else out.drop(columns="ids")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _coder(vocabulary)
        packer = Packer(TaskContext.get().partitionId() << 40, with_ids, window)
        for rows in batches:
            sizes = rows["text"].str.len()
            # A slice's worth of texts are encoded together; a longer text is alone.
            turn = (sizes.cumsum() // SLICE).where(sizes <= SLICE, -1 - np.arange(len(rows)))
            for _, some in rows.groupby((turn != turn.shift()).cumsum()):
                texts = some["text"].tolist()
                doc_ids = [None if i is None else int(i) for i in some["doc_id"].tolist()]
                if len(texts) == 1 and len(texts[0]) > SLICE:
                    ids, sentences = coder.encode(texts[0])
                    yield from map(frame, packer.add(doc_ids[0], ids + end, sentences))
                    continue
                ids, bounds, sentences, turns = coder.encode_together(texts)
                own = [ids[4 * a : 4 * b] + end for a, b in zip([0, *bounds.tolist()], bounds.tolist())]
                # Each after the end ids of the documents before; a text's end is one of a sentence.
                before = np.arange(len(texts))
                sentences = sentences + np.repeat(before, np.diff(turns, prepend=0))
                found = all_places(bounds + before + 1, np.concatenate([sentences, bounds + before]))
                yield from map(frame, packer.add_all(doc_ids, own, *found))
        yield frame(packer.finish())

    return run


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    end_id: int = END,
    window: int = WINDOW,
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of every piece.

    Every row is a document and ends with ``end_id``; a null or empty text has that id alone. Ids
    of documents come as they are, null and repeated ones too. Sequences are numbered within their
    partition, whose number makes the upper bits; a task that runs again gives the same ones. An
    empty table gives no rows; other columns are not looked at.
    """
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        vocabulary = file.read()
    rows = docs.select(
        F.col(doc_id).cast("long").cast("string").alias("doc_id"), text_or_empty(text).alias("text")
    )
    return rows.mapInPandas(
        _in_tasks(vocabulary, with_ids, end_id, window),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long" + (", ids array<long>" if with_ids else ""),
    )


@query()
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
