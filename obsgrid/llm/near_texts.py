"""Near duplicates at a Jaccard similarity of 0.8 on five-word shingles, found by SimHash and
multi-index hashing, and the rest by shared shingles.

A text is the set of its runs of five words. Equal sets are folded to one node first. A node has
``PRINTS`` SimHash fingerprints of 64 bits, cut into segments whose width follows the number of
nodes, so that few unrelated nodes share one. Every segment is a table; a node looks up the Hamming
ball around each of its segments, candidates are held against the print next to it, and those
that may be similar by their sizes and parities are compared exactly, set with set. At a similarity
of 0.8 a bit differs with a chance of 0.15, so one of the segments meets with a chance of 0.78, and more
often above.

What no segment shows is found by shingles: two sets at 0.8 or more share one of their first fifth in
any order that is the same for all sets. The order puts shingles that are frequent in a sample last; it
decides how many pairs meet, never which ones link. Under each such shingle nodes of different
components are held against each other by sizes and by the shingles behind it, then by parities, and
what these allow, set with set. So the components are those of all pairs at 0.8 or more.

A segment value with more than ``CROWD`` nodes is no set of unrelated nodes: they are copies of
each other, or nearly. The lookups of such values and of those around them are first compared with a
few leaders, one of which is the node whose segments are the most common, so the middle of the group;
that joins most of a crowd to one component. All that is then left is compared in full: every lookup
outside the crowd's largest component with every other one in another component, in cells of at most
about ``CELL`` by ``CELL`` rows, by whole fingerprints, sizes and parities: bits of which two sets
differ in no more than they have elements apart, so none is dropped that would link. So no pair of a crowd is left out;
rows grow with the nodes where the leaders join them, and a crowd that they leave apart costs
comparisons by the square, but no large group or task. Every link was counted on the whole sets.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsgrid.llm.common import batches_of, dropped, written
from obsgrid.llm.components import components

SHINGLE = 5
SEED = 42
#: Fingerprints of 64 bits each.
PRINTS = 5
#: Those that a search uses: what the segments of few miss is found by shingles, which cost less.
SEARCHED = 3
#: Of 64 * PRINTS bits 48 differ at a similarity of 0.8, give or take 6, and half in unrelated texts.
DISTANCE = 72
#: The same for the print that travels with a lookup: 10, give or take 3, of 64.
SKETCH_DISTANCE = 21
#: Longs that hold a set's parities.
PARITY = 16
#: Longs that hold those of a set of ``LARGE`` shingles or more besides, whose many elements apart fill
#: the others.
WIDE = 128
LARGE = 1024
#: Longs of the parities, folded, that travel with the lookups of nodes of crowds.
FOLDED = 4
#: Nodes of one segment value from which leaders come before all pairs.
CROWD = 32
#: Leaders of a crowded value besides its middle.
TURNS = 2
#: Rows of a crowded value on either side that one task compares at a time.
CELL = 4096
#: Texts whose sets a worker holds at a time.
TEXTS = 500
#: One in so many texts is looked at for frequent shingles.
SAMPLE = 16
#: Sampled texts from which a shingle is frequent, and how many frequent ones are kept.
FREQUENT = 4
FREQUENT_KEPT = 100_000

_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the numbers spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashes of texts' shingles; words are hashed once."""

    KNOWN = 150_000

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        """The distinct shingles' hashes, ascending. Fewer than five words are one shingle."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        fresh = set(words).difference(self.words)
        if len(self.words) + len(fresh) > self.KNOWN:
            self.words, fresh = {}, set(words)
        self.words.update((w, xxhash.xxh64_intdigest(w, SEED)) for w in fresh)
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        total = max(1, len(words) - SHINGLE + 1)
        out = np.full(total, len(words) if total == 1 else SHINGLE, np.uint64)
        for i in range(min(SHINGLE, len(words))):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + total])
        return np.unique(out)


def prints_of(hashes: np.ndarray, prints: int = PRINTS) -> list[int]:
    """SimHash fingerprints. Shingles weigh a little differently, so no bit is a tie."""
    weights = (np.float32(1) + (hashes >> np.uint64(54)).astype(np.float32) / np.float32(4096))
    sums = np.zeros(64 * prints, np.float32)
    steps = np.arange(1, prints + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    for at in range(0, len(hashes), 4096):
        rows = _mixed(hashes[at : at + 4096, None] + steps[None, :]).astype(">u8")
        bits = np.unpackbits(rows.view(np.uint8), axis=1).astype(np.float32)
        sums += weights[at : at + 4096] @ bits
    return np.packbits(2 * sums > weights.sum(dtype=np.float64)).view(">i8").astype(np.int64).tolist()


def parities_of(hashes: np.ndarray, longs: int = PARITY) -> list[int]:
    """Of each of so many bits whether an odd number of shingles falls on it."""
    places = np.bincount((hashes % np.uint64(64 * longs)).view(np.int64), minlength=64 * longs)
    return np.packbits((places & 1).astype(np.uint8)).view(np.int64).tolist()


def first_fifth(hashes: np.ndarray, frequent: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The first shingles, rare ones before the frequent: two sets at 0.8 or more have one of them in
    common, since each has at most a fifth of its own apart from the other."""
    size = len(hashes)
    if size and len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        rank = np.where(frequent[at] == hashes, numbers[at], 0)
        if rank.any():
            hashes = hashes[np.lexsort((hashes, rank))]
    return hashes[: size - (4 * size + 4) // 5 + 1 if size else 0]


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in the sample, ascending, and their numbers of texts."""

    def shingles_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for rows in batches:
            sets = [shingles.of(t) for t in rows["text"]]
            keys, numbers = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]), return_counts=True)
            yield pd.DataFrame({"key": keys.view(np.int64), "n": numbers.astype(np.int64)})

    sample = texts.where(F.pmod(F.xxhash64("digest"), F.lit(SAMPLE)) == 0).select("text")
    counts = written(
        sample.mapInPandas(shingles_of, "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT),
        "near-frequent",
    )
    # Whole powers of two from above, as many as may be kept.
    levels = counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count(F.lit(1)).alias("held"))
    least, held = None, 0
    for row in sorted(levels.collect(), reverse=True):
        held += row["held"]
        if held > FREQUENT_KEPT:
            break
        least = int(row["level"])
    kept = [] if least is None else counts.where(F.col("n") >= 2**least).collect()
    dropped(counts)
    keys = np.array([r["key"] for r in kept], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r["n"] for r in kept], np.int64)[order]


def _signed(x: int) -> int:
    return x - (x >> 63 << 64)


def _marked(rows: DataFrame, prints: int) -> DataFrame:
    """(doc_id, digest, first, second, size, prints, parities, wide, keys): 128 bits of hash of the set,
    wide parities of large ones, and 32 bits each of its first shingles."""

    columns = ["doc_id", "digest", "first", "second", "size", "prints", "parities", "wide", "keys"]
    common = rows.sparkSession.sparkContext.broadcast(_frequent(rows))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for batch in batches:
            out = []
            for i, digest, text in zip(batch["doc_id"], batch["digest"], batch["text"]):
                hashes = shingles.of(text)
                whole = xxhash.xxh3_128_intdigest(hashes.tobytes(), SEED)
                pair = _signed(whole >> 64), _signed(whole & _MASK)
                wide = parities_of(hashes, WIDE) if len(hashes) >= LARGE else None
                marks = prints_of(hashes, prints), parities_of(hashes), wide
                keys = first_fifth(hashes, *common.value).astype(np.uint32).view(np.int32)
                out.append((i, digest, *pair, len(hashes), *marks, keys))
            frame = pd.DataFrame(out, columns=columns)
            yield frame.astype({"doc_id": object})

    return rows.mapInPandas(
        mark,
        "doc_id string, digest binary, first long, second long, size long, prints array<long>, "
        "parities array<long>, wide array<long>, keys array<int>",
    ).withColumn("doc_id", F.col("doc_id").cast("long"))


def width_for(nodes: int) -> tuple[int, int]:
    """(segments of a print, radius of the balls). Of 2**24 nodes, a node meets some 800 unrelated
    ones in nine segments of 21 bits, which cost less than the rows of wider balls."""
    bits = math.log2(max(2, nodes)) + 2
    return (4, 1) if bits <= 16 else (3, 1) if bits <= 26 else (2, 1)


def _segments(prints: int, per_print: int) -> list[tuple[int, int, int]]:
    """(number, print, lowest bit) of every segment."""
    wide = 64 // per_print
    return [
        (p * per_print + k, p, k * wide) for p in range(prints) for k in range(per_print)
    ]


def _key(number: int, value: Column) -> Column:
    return value.bitwiseOR(F.lit(number << 32))


def _members(nodes: DataFrame, prints: int, per_print: int) -> DataFrame:
    """(node, number, key, sketch): a row per segment; the sketch is another print."""
    mask = (1 << 64 // per_print) - 1
    rows = [
        F.struct(
            F.lit(number).alias("number"),
            _key(number, F.shiftrightunsigned(F.col("prints")[p], low).bitwiseAND(F.lit(mask))).alias("key"),
            F.col("prints")[(p + 1) % prints].alias("sketch"),
        )
        for number, p, low in _segments(prints, per_print)
    ]
    return nodes.select("node", F.inline(F.array(*rows)))


def _lookups(members: DataFrame, per_print: int, radius: int) -> DataFrame:
    """The ball around each segment. Of two values that differ in one bit just one has a 0
    there, so only flips from 0 to 1 are looked up; of two bits, any but two from 1 to 0."""
    wide = 64 // per_print
    key = F.col("key")
    off = lambda i: key.bitwiseAND(F.lit(1 << i)) == 0
    ball = [F.when(off(i), key.bitwiseXOR(F.lit(1 << i))) for i in range(wide)]
    if radius == 2:
        ball += [
            F.when(off(i) | off(j), key.bitwiseXOR(F.lit(1 << i | 1 << j)))
            for i in range(wide)
            for j in range(i)
        ]
    keys = F.array_compact(F.array(key, *ball))
    kept = [c for c in members.columns if c not in ("number", "key")]
    # The node's own value comes first.
    return members.select(*kept, F.posexplode(keys).alias("turn", "key")).select(
        *kept, "key", (F.col("turn") == 0).alias("own")
    )


def _near_sketch(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= SKETCH_DISTANCE


def _like_size(a: str, b: str) -> Column:
    """Sizes of sets that can be at 0.8 or more."""
    return F.least(a, b) * 5 >= F.greatest(a, b) * 4


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _folded(parities: str) -> Column:
    """The parities of as many fewer bits: those of places that are equal modulo their number."""
    folds = [[F.col(parities)[i] for i in range(k, PARITY, FOLDED)] for k in range(FOLDED)]
    return F.array(*[functools.reduce(Column.bitwiseXOR, fold) for fold in folds])


def _like_parities(a: str, b: str, longs: int = PARITY) -> Column:
    """Whether sets can be at 0.8 or more: then at most a ninth of all their elements is in one of
    them only, and only those make parities differ. Columns are named with the prefixes."""
    apart = sum(F.bit_count(F.col(f"{a}parities")[i].bitwiseXOR(F.col(f"{b}parities")[i])) for i in range(longs))
    return apart * 9 <= F.col(f"{a}size") + F.col(f"{b}size")


def _like_wide(a: str, b: str) -> Column:
    """The same by the wide parities, if both sets have them."""
    bits = F.zip_with(f"{a}wide", f"{b}wide", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    return F.coalesce(apart * 9 <= F.col(f"{a}size") + F.col(f"{b}size"), F.lit(True))


class Search:
    """The links between nodes of one table; rows are (node, size, prints, parities, wide, keys,
    digest)."""

    def __init__(self, nodes: DataFrame, texts: DataFrame, prints: int):
        self.nodes, self.texts, self.prints = nodes, texts, prints
        self.groups: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> None:
        """Keep those of the pairs (a, b) whose sets are at 0.8 or more, and the components that
        they make with the links found before."""
        ends = self.nodes.select("node", "size", "parities", "wide", "digest")
        both = pairs
        for end in ("a", "b"):
            both = both.join(ends.toDF(end, *[f"{end}_{c}" for c in ends.columns[1:]]), end)
        close = written(
            both.where(_like_size("a_size", "b_size"))
            .where(_like_parities("a_", "b_"))
            .where(_like_wide("a_", "b_"))
            .select("a", "b", "a_digest", "b_digest", (F.col("a_size") + F.col("b_size")).alias("sizes")),
            "near-pairs",
        )

        def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingles = Shingles()
            for rows in batches:
                sets = [shingles.of(t).view(np.int64) for t in rows["text"]]
                yield pd.DataFrame({"digest": rows["digest"], "set": sets})

        wanted = close.select(F.explode(F.array("a_digest", "b_digest")).alias("digest")).distinct()
        sets = written(
            self.texts.join(wanted, "digest")
            .groupBy("digest")
            .agg(F.first("text").alias("text"))
            .mapInPandas(sets_of, "digest binary, set array<long>"),
            "near-sets",
        )
        common = F.size(F.array_intersect("a_set", "b_set"))
        found = written(
            close.join(sets.toDF("b_digest", "b_set"), "b_digest")
            .join(sets.toDF("a_digest", "a_set"), "a_digest")
            .where(common * 9 >= F.col("sizes") * 4)
            .select("a", "b"),
            "near-links",
        )
        dropped(close)
        dropped(sets)
        before = self.groups
        if before is not None:
            # A component's star stands for all links that made it.
            found = found.union(before.toDF("a", "b"))
        self.groups = written(components(found), "near-groups")
        if before is not None:
            dropped(before)

    def grouped(self, rows: DataFrame) -> DataFrame:
        """With the component of each node."""
        if self.groups is None:
            return rows.withColumn("component", F.col("node"))
        return rows.join(self.groups, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )

    def with_leaders(self, members: DataFrame, lookups: DataFrame, order: Column) -> DataFrame:
        """Pairs of each lookup with the least member of its key in the given order."""
        lead = self.grouped(members).groupBy("key").agg(
            F.min(F.struct(order.alias("turn"), "node", "component", "sketch")).alias("lead")
        )
        return (
            self.grouped(lookups)
            .join(lead, "key")
            .where("component != lead.component")
            .where(_near_sketch("sketch", "lead.sketch"))
            .select(*_pair("node", "lead.node"))
        )

    def in_pairs(self, members: DataFrame, lookups: DataFrame, near: Column) -> DataFrame:
        """Pairs of each lookup with every member of its key in another component, if it is near;
        the member's columns have an underscore before their names."""
        other = self.grouped(members)
        other = other.select("key", *[F.col(c).alias(f"_{c}") for c in other.columns if c != "key"])
        return (
            self.grouped(lookups)
            .hint("merge")
            .join(other, "key")
            .where(F.col("component") != F.col("_component"))
            .where(near)
            .select(*_pair("node", "_node"))
        )

    def in_cells(self, lookups: DataFrame, cell: int, exact: bool = False) -> DataFrame:
        """All near pairs of different components among the lookups (node, key, own) of a key of
        which one at least has the key as its own; those near by their prints, unless ``exact``.

        Those of a key's largest component need no comparison with each other, so all others, its
        rest, are held against all. Both sides are dealt to blocks of about ``cell`` rows.
        """
        rows = written(self.grouped(lookups), "near-grouped")
        held = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
        keys = (
            held.groupBy("key")
            .agg(F.max(F.struct("held", "component")).alias("main"), F.sum("held").alias("all"))
            .where(F.col("all") > F.col("main.held"))
            .select(
                "key",
                F.col("main.component").alias("main"),
                F.ceil((F.col("all") - F.col("main.held")) / cell).alias("rests"),
                F.ceil(F.col("all") / cell).alias("wholes"),
            )
        )
        ends = self.nodes.select("node", "size", "prints", "parities")
        rows = rows.join(keys, "key").join(ends, "node")
        block = lambda of: F.pmod(F.xxhash64(F.lit(of), "node"), F.col(of))
        each = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
        columns = ["node", "component", "own", "size", "prints", "parities"]
        rest = rows.where(F.col("component") != F.col("main")).select(
            "key", block("rests").alias("i"), each("wholes").alias("j"), *columns
        )
        whole = rows.select(
            "key", each("rests").alias("i"), block("wholes").alias("j"), *[F.col(c).alias(f"_{c}") for c in columns]
        )
        return (
            rest.hint("merge").join(whole, ["key", "i", "j"])
            .where(F.col("component") != F.col("_component"))
            .where(F.col("own") | F.col("_own"))
            .where(_like_size("size", "_size"))
            .where(F.lit(True) if exact else self.near("prints", "_prints"))
            .where(_like_parities("", "_"))
            .select(*_pair("node", "_node"))
        )

    def in_shingles(self, cell: int) -> DataFrame:
        """All pairs of different components that share one of their first shingles, unless their sizes
        and the shingles behind it are too few for 0.8. Of such a pair the smaller set has one of
        them in its first ninth. Shingles of more than ``cell`` nodes are compared in cells."""
        of_key = Window.partitionBy("key")
        rows = (
            self.grouped(self.nodes.select("node", "size", "keys"))
            .select("node", "component", F.col("size").cast("int").alias("size"), F.posexplode("keys").alias("turn", "key"))
            .withColumn("behind", F.col("size") - F.col("turn"))
        )
        early = F.col("behind") * 9 >= F.col("size") * 8
        shared = written(
            rows.select(
                "key",
                "node",
                "component",
                "size",
                "behind",
                early.alias("early"),
                F.min("component").over(of_key).alias("_least"),
                F.max("component").over(of_key).alias("_most"),
                F.count(F.lit(1)).over(of_key).alias("held"),
            )
            .where("_least < _most")
            .drop("_least", "_most"),
            "near-shared",
        )
        few = shared.where(F.col("held") <= cell).drop("held")
        larger = few.drop("early").toDF("key", "_node", "_component", "_size", "_behind")
        pairs = (
            few.where("early")
            .hint("merge")
            .join(larger, "key")
            .where(F.col("component") != F.col("_component"))
            .where("size < _size or size = _size and node < _node")
            .where(_like_size("size", "_size"))
            .where(F.least("behind", "_behind") * 9 >= (F.col("size") + F.col("_size")) * 4)
            .select(*_pair("node", "_node"))
        )
        many = shared.where(F.col("held") > cell).select("node", "key", F.lit(True).alias("own"))
        return pairs if many.isEmpty() else pairs.union(self.in_cells(many, cell, exact=True))

    def near(self, a: str, b: str) -> Column:
        """Whether two columns of prints differ in no more bits than those of similar sets."""
        apart = sum(F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(self.prints))
        return apart <= DISTANCE * self.prints // PRINTS


def _sized(members: DataFrame) -> DataFrame:
    return members.groupBy("key").agg(F.count(F.lit(1)).alias("held"))


def _around(crowds: DataFrame, per_print: int, radius: int) -> DataFrame:
    """The crowded values and all within the radius: the crowd looks those up too."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(64 // per_print)])
    keys = crowds.select("key")
    for _ in range(radius):
        keys = keys.select(F.explode(flips).alias("_flip"), "key").select(
            F.col("key").bitwiseXOR(F.col("_flip")).alias("key")
        )
    return keys.distinct()


def _search(search: Search, per_print: int, radius: int, crowd: int, cell: int) -> None:
    members = written(_members(search.nodes, search.prints, per_print), "near-members")
    sizes = written(_sized(members).where("held > 1"), "near-keys")
    crowds = written(_around(sizes.where(F.col("held") > crowd), per_print, radius), "near-crowds")
    lookups = _lookups(members, per_print, radius)
    near = _near_sketch("sketch", "_sketch")
    scratch, pairs, left = [sizes, crowds, members], [], members
    if not crowds.isEmpty():
        hot = written(members.join(crowds, "key").join(sizes, "key", "left"), "near-hot")
        hot_lookups = written(lookups.join(crowds, "key"), "near-hot-lookups")
        # How many nodes have each of a node's values: the middle of a group has the most.
        middle = written(
            hot.groupBy("node").agg(F.sum(F.coalesce("held", F.lit(1))).alias("middling")), "near-middles"
        )
        leaders = hot.where(F.col("held") > crowd).join(middle, "node")
        orders = [-F.col("middling"), *[F.xxhash64(F.lit(turn), "key", "node") for turn in range(TURNS)]]
        # Whom the middle has joined is held against no further leader of its component.
        for some in (orders[:1], orders[1:]):
            led = [search.with_leaders(leaders, hot_lookups, order) for order in some]
            search.verify(functools.reduce(DataFrame.union, led).distinct())
        pairs.append(search.in_cells(hot_lookups.select("node", "key", "own"), cell))
        scratch += [hot, hot_lookups, middle]
        # Nearly similar texts abound around a crowd, and every segment that a pair shares brings
        # the print next to it for a sketch: two such nodes are held to their whole prints, sizes and
        # folded parities before they make a pair.
        ends = search.nodes.select("node", "size", "prints", _folded("parities").alias("parities"))
        warm = hot.select("node").distinct().join(ends, "node")
        flagged = members.join(warm, "node", "left")
        lookups = _lookups(flagged, per_print, radius)
        left = flagged.join(crowds, "key", "left_anti")
        whole = search.near("prints", "_prints") & _like_size("size", "_size") & _like_parities("", "_", FOLDED)
        cold = F.col("prints").isNull() | F.col("_prints").isNull()
        near = F.when(cold, near).otherwise(whole)
    pairs.append(search.in_pairs(left, lookups, near))
    search.verify(functools.reduce(DataFrame.union, pairs).distinct())
    for old in scratch:
        dropped(old)
    # All that shares no segment.
    search.verify(search.in_shingles(cell).distinct())


def near_texts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    prints: int = SEARCHED,
    crowd: int = CROWD,
    cell: int = CELL,
) -> DataFrame:
    """(doc_id, digest, component_id, kept) of every row; the digest is the text's SHA-256.

    Null texts and texts without words are equal to each other and to nothing else. The component
    is named by its smallest doc_id, null if none has one. Of each component the rows of one doc_id
    and text are kept, those of the smallest id (none comes last), then of the least digest. Rows
    that repeat an id with another text are documents of their own; an empty table gives no rows;
    other columns are not looked at.
    """
    texts = docs.select(
        F.col(doc_id).cast("long").cast("string").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    with batches_of(docs.sparkSession, TEXTS):
        marked = written(_marked(texts, prints), "near-marks")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    folded = marked.groupBy("first", "second", "size").agg(
        F.min(order).alias("least"),
        F.min("digest").alias("digest"),
        F.min("prints").alias("prints"),
        F.min("parities").alias("parities"),
        F.first("wide").alias("wide"),
        F.first("keys").alias("keys"),
    )
    nodes = written(folded.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    worded = nodes.where("size > 0")
    per_print, radius = width_for(worded.count())
    search = Search(worded, texts.select("digest", "text"), prints)
    with batches_of(docs.sparkSession, TEXTS):
        _search(search, per_print, radius, crowd, cell)
    of_node = written(
        search.grouped(nodes.select("node", "first", "second", "size", "least")), "near-components"
    )
    least = of_node.groupBy("component").agg(F.min("least").alias("_kept"))
    named = of_node.join(least, "component").select("first", "second", "size", "_kept")
    out = marked.drop("prints", "parities", "wide", "keys").join(named, ["first", "second", "size"]).select(
        "doc_id",
        "digest",
        F.col("_kept.doc_id").alias("component_id"),
        (F.col("_kept.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_kept.digest") == F.col("digest"))).alias("kept"),
    )
    return out
