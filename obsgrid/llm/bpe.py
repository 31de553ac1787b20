"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside each partition.

A task splits its texts with the tokenizer's pattern. The words it has not met before become
token-position rows, one per byte, and a recursive query contracts them: each round joins the
neighbouring tokens of every unfinished word with the merge table and merges the word's leftmost
pair of minimum rank, until no pair of the word is in the table. Decoding joins token rows with
the vocabulary and aggregates their bytes in order of position.

Words above ``LONG_BYTES`` merge all places of their minimum rank in a round, so that rounds follow
the ranks in use and not the word's length. That gives the same ids where no merge makes a pair
of lower rank than its own, which holds if every token can be reached by the merges below it
(``reachable``); for other rank files only the leftmost place is merged there too.

A worker keeps the encodings of at most ``CACHED_WORDS`` words between its tasks, and works on
at most ``BLOCK_WORDS`` words at a time, so its memory doesn't grow with the texts. The rank file
is read once on the driver; its size is that of the vocabulary, whatever the data.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import sys
import types
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import table, text_or_empty
from obsgrid.llm.registry import query

RANKS = "byte_bpe_50k.tiktoken"
#: Words that a worker encodes and decodes at a time, those that one query merges, and those
#: whose encodings it keeps.
BLOCK_WORDS = 1 << 17
MERGED_WORDS = 1 << 14
CACHED_WORDS = 3 << 17
#: Bytes above which a word merges all places of its minimum rank at once, and the rows that one
#: query on such words may pass through before they are written and the next one goes on.
LONG_BYTES = 64
LONG_ROWS = 1 << 21
#: Characters of texts that are encoded and passed on at a time, but for a longer text.
BLOCK_CHARS = 1 << 21
#: A text up to so many characters is split in one go.
SPLIT_CHARS = 1 << 20
#: Limit of DuckDB's own memory in a worker.
MEMORY = "200MB"

# Positions count through all words, so one ordering serves every word of a round.
MERGE_SQL = """
WITH RECURSIVE tokens(word, pos, id, live) AS (
  SELECT word, pos, id, TRUE FROM symbols
  UNION ALL (
    WITH pairs AS (
      SELECT word, pos, id,
        CASE WHEN lead(word) OVER line = word THEN lead(id) OVER line END AS next_id,
        CASE WHEN lag(word) OVER line = word THEN lag(pos) OVER line END AS before
      FROM tokens WHERE live WINDOW line AS (ORDER BY pos)),
    best AS (
      SELECT word, min((CAST(rank AS BIGINT) << 32) | pos) AS pick
      FROM pairs JOIN merges ON left_id = id AND right_id = next_id GROUP BY word)
    SELECT p.word, p.pos,
      CASE WHEN p.pos = (pick & 4294967295) THEN CAST(pick >> 32 AS INTEGER) ELSE p.id END,
      pick IS NOT NULL
    FROM pairs p LEFT JOIN best USING (word)
    WHERE pick IS NULL OR before IS NULL OR before <> (pick & 4294967295)))
SELECT word, id FROM tokens WHERE NOT live ORDER BY pos
"""

# Places of the word's minimum rank that follow each other overlap: every other one is merged.
LONG_SQL = """
WITH RECURSIVE tokens(word, pos, id, live, round) AS (
  SELECT word, pos, id, TRUE, 0 FROM symbols
  UNION ALL (
    WITH pairs AS (
      SELECT word, pos, id, round,
        CASE WHEN lead(word) OVER line = word THEN lead(id) OVER line END AS next_id,
        CASE WHEN lead(word) OVER line = word THEN lead(pos) OVER line END AS next_pos
      FROM tokens WHERE live AND round < $rounds WINDOW line AS (ORDER BY pos)),
    ranked AS (
      SELECT word, pos, next_pos, rank
      FROM pairs JOIN merges ON left_id = id AND right_id = next_id),
    best AS (SELECT word, min(rank) AS pick FROM ranked GROUP BY word),
    places AS (
      SELECT word, pos, next_pos, rank, row_number() OVER line AS n,
        coalesce(lag(next_pos) OVER line = pos, FALSE) AS follows
      FROM ranked JOIN best USING (word) WHERE rank = pick WINDOW line AS (ORDER BY pos)),
    runs AS (
      SELECT *, n - max(CASE WHEN NOT follows THEN n END) OVER (ORDER BY pos) AS turn,
        row_number() OVER (PARTITION BY word ORDER BY pos) = 1 AS leftmost
      FROM places),
    taken AS (SELECT pos, next_pos, rank FROM runs WHERE turn % 2 = 0 AND (leftmost OR $every))
    SELECT p.word, p.pos, coalesce(t.rank, p.id), pick IS NOT NULL, p.round + 1
    FROM pairs p LEFT JOIN best USING (word) LEFT JOIN taken t ON t.pos = p.pos
    WHERE p.pos NOT IN (SELECT next_pos FROM taken)))
SELECT word, pos, id, live FROM tokens WHERE NOT live OR round = $rounds
"""

DECODE_SQL = """
SELECT doc, string_agg(bytes, '' ORDER BY pos) AS bytes
FROM ids JOIN vocabulary USING (id) GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def reachable(ranks: dict[bytes, int]) -> bool:
    """Whether merges of lower rank alone turn every token's bytes into two tokens that make it."""

    def halves(token: bytes) -> bool:
        parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
        while len(parts) > 2:
            found = [ranks.get(a + b, own) for a, b in itertools.pairwise(parts)]
            least = min(found)
            if least >= own:
                return False
            at = found.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    return all(halves(token) for token in ranks if len(token) > 2)


class Codec:
    """Encodes and decodes with one rank table; ``every`` tells whether it is ``reachable``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, every: bool = False):
        self.every = every
        self.split = regex.compile(pattern)
        self.of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        pairs = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        left, right, rank = (pa.array(x, pa.int32()) for x in zip(*pairs)) if pairs else [pa.array([], pa.int32())] * 3
        self._table("merges", left_id=left, right_id=right, rank=rank)
        # Bytes travel as the characters of the same number.
        self._table(
            "vocabulary",
            id=pa.array(list(ranks.values()), pa.int32()),
            bytes=pa.array([t.decode("latin-1") for t in ranks]),
        )
        self.forget()

    def _table(self, name: str, **columns) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def _symbols(self, data: list[bytes]) -> dict[str, np.ndarray]:
        """One row per byte of the words."""
        sizes = np.array([len(b) for b in data], np.int64)
        word = np.repeat(np.arange(len(data), dtype=np.int32), sizes)
        ids = self.of_byte[np.frombuffer(b"".join(data), np.uint8)]
        return {"word": word, "pos": np.arange(len(word)), "id": ids}

    def _merged(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of the word and the id of every token, in order."""
        self._table("symbols", **self._symbols(data))
        found = self.db.sql(MERGE_SQL).to_arrow_table()
        return found["word"].to_numpy(), found["id"].to_numpy()

    def _merged_long(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for long words, a bounded number of rounds at a time."""
        rows, done = self._symbols(data), []
        while len(rows["pos"]):
            self._table("symbols", **rows)
            rounds = max(1, min(256, LONG_ROWS // len(rows["pos"])))
            found = self.db.sql(LONG_SQL, params={"rounds": rounds, "every": self.every}).to_arrow_table()
            live = found["live"].to_numpy()
            columns = {name: found[name].to_numpy() for name in rows}
            done.append({name: x[~live] for name, x in columns.items()})
            rows = {name: x[live] for name, x in columns.items()}
        word, pos, ids = (np.concatenate([d[name] for d in done]) for name in ("word", "pos", "id"))
        order = np.argsort(pos)
        return word[order], ids[order]

    def _learn(self, words: list[str]) -> None:
        words = sorted(words, key=lambda w: len(w.encode("utf-8")) > LONG_BYTES)
        data = [w.encode("utf-8") for w in words]
        short = sum(len(b) <= LONG_BYTES for b in data)
        for some, merged in ((data[:short], self._merged), (data[short:], self._merged_long)):
            if some:
                word, ids = merged(some)
                counts = np.bincount(word, minlength=len(some))
                self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
                self.tokens = np.concatenate([self.tokens, ids.astype(np.int32)])
        at = len(self.known)
        self.known.update(zip(words, range(at, at + len(words))))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and the number of ids of each word."""
        fresh = set(words).difference(self.known)
        if fresh and len(self.known) + len(fresh) > CACHED_WORDS:
            self.forget()
            fresh = set(words)
        fresh = sorted(fresh)
        for i in range(0, len(fresh), MERGED_WORDS):
            self._learn(fresh[i : i + MERGED_WORDS])
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        counts = self.starts[at + 1] - self.starts[at]
        moves = np.repeat(self.starts[at] - (np.cumsum(counts) - counts), counts)
        return self.tokens[moves + np.arange(len(moves))], counts

    def decode(self, doc: np.ndarray, ids: np.ndarray) -> dict[int, bytes]:
        """The bytes of the ids of each number in ``doc``; ids without any give no entry."""
        self._table("ids", doc=doc, pos=np.arange(len(ids)), id=ids)
        found = self.db.sql(DECODE_SQL).to_arrow_table()
        return {
            d: b.encode("latin-1") for d, b in zip(found["doc"].to_pylist(), found["bytes"].to_pylist())
        }

    def pieces(self, texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
        """(document of each word, words) in blocks; a long text is spread over several."""
        docs: list[tuple[int, int]] = []
        words: list[str] = []
        for number, text in enumerate(texts):
            if len(text) <= SPLIT_CHARS:
                parts = [self.split.findall(text)]
            else:
                matches = (m[0] for m in self.split.finditer(text))
                parts = iter(lambda: list(itertools.islice(matches, BLOCK_WORDS)), [])
            for part in parts:
                docs.append((number, len(part)))
                words += part
                if len(words) >= BLOCK_WORDS:
                    yield np.repeat(*map(np.array, zip(*docs))), words
                    docs, words = [], []
        if words:
            yield np.repeat(*map(np.array, zip(*docs))), words


def _codec(ranks: dict[bytes, int], pattern: str, every: bool = False) -> Codec:
    """The worker process's codec for these ranks, kept between its tasks."""
    store = sys.modules.setdefault("obsgrid_worker_codecs", types.ModuleType("obsgrid_worker_codecs"))
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern, every)).encode()).hexdigest()
    if not hasattr(store, key):
        setattr(store, key, Codec(ranks, pattern, every))
    return getattr(store, key)


def _parts(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Consecutive rows of about BLOCK_CHARS characters; an empty batch is one part."""
    turn = batch["text"].str.len().cumsum() // BLOCK_CHARS
    return (part for _, part in batch.groupby(turn, sort=False)) if len(batch) else iter([batch])


def _coder(ranks: dict[bytes, int], pattern: str, kept: list[str]):
    every = reachable(ranks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(ranks, pattern, every)
        for rows in (part for batch in batches for part in _parts(batch)):
            texts = rows["text"].tolist()
            ids = [[np.zeros(0, np.int32)] for _ in texts]
            decoded = [hashlib.sha256() for _ in texts]
            for doc, words in codec.pieces(texts):
                found, counts = codec.encode(words)
                of_id = np.repeat(doc, counts)
                for number, data in codec.decode(of_id, found).items():
                    decoded[number].update(data)
                numbers, firsts = np.unique(of_id, return_index=True)
                for number, part in zip(numbers, np.split(found, firsts[1:])):
                    ids[number].append(part)
            out = rows[kept].reset_index(drop=True)
            whole = [np.concatenate(x) for x in ids]
            out["n_tokens"] = [len(x) for x in whole]
            out["ids"] = whole
            out["ids_sha256"] = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in whole]
            out["decoded_sha256"] = [d.hexdigest() for d in decoded]
            yield out

    return run


def encode(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every row.

    A null or empty text has no ids. Ids come as they are, null and repeated ones too. An empty
    table gives no rows; other columns are not looked at.
    """
    ranks = read_ranks(path or public_tokenizers.path(RANKS))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInPandas(
        _coder(ranks, pattern, ["doc_id"]),
        "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string",
    )


def decode(
    encoded: DataFrame,
    doc_id: str = "doc_id",
    ids: str = "ids",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """(doc_id, text) of rows with an array of ids; a null array is empty. Bytes that are no
    UTF-8 become replacement characters; an id that isn't in the vocabulary fails."""
    ranks = read_ranks(path or public_tokenizers.path(RANKS))
    known = set(ranks.values())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(ranks, pattern)
        for rows in batches:
            lists = [np.asarray([] if x is None else x, np.int32) for x in rows["ids"]]
            for x in lists:
                if not known.issuperset(x.tolist()):
                    raise ValueError("an id is not in the vocabulary")
            doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            flat = np.concatenate([np.zeros(0, np.int32), *lists])
            found = codec.decode(doc, flat) if len(flat) else {}
            yield pd.DataFrame(
                {"doc_id": rows["doc_id"], "text": [found.get(i, b"").decode("utf-8", "replace") for i in range(len(lists))]}
            )

    rows = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInPandas(run, "doc_id long, text string")


@query()
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents")).drop("ids")
