"""Grouping spelling variants by pivotal grams.

Words are near if one inserted, deleted or replaced code point turns one into the other. A word's
prefix holds its rarest bigrams by corpus frequency: one edit harms at most two of the first three,
and bigrams as frequent as the third are in it as well. Two disjoint ones of the prefix, whose
index lists are shortest in sum, are the pivots. One edit leaves one pivot whole, and that one
stands in the other word's prefix if the other's prefix reaches as far in the order of bigrams; of
two near words one reaches as far as the other. So each word looks its pivots up in the index of
all prefixes, at places that differ by what the edit can move.

The edit lies on one side of a pivot that is left whole, so the other side has to be equal; it is
part of the index key, with place and length. A key that many prefixes share (``CROWD``) isn't
joined with its lookups: there the side with the edit is indexed by what is left of it without one
code point, which only near words share. No group is paired with itself.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import dropped, table, written
from obsgrid.llm.registry import query

#: A run of Latin letters, with the signs that stand among them in Latin-1.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form occurs so many times as often as its variant, at least.
DOMINANCE = 2
EDITS = 1
GRAM = 2
#: Prefix entries under one key from which the edited side is indexed too.
CROWD = 24
#: Distinct words that a task counts before it passes them on.
FLUSH = 200_000

_RUN = re.compile(RUN)


def as_written(doc_id: int | None, run: str) -> str:
    return run


def _counted(word_of, least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()

        def out() -> pd.DataFrame:
            frame = pd.DataFrame({"word": list(total), "n": list(total.values())})
            total.clear()
            return frame.astype({"word": object, "n": "int64"})

        for rows in batches:
            for doc_id, text in zip(rows["doc_id"], rows["text"]):
                # Bytes are lower-cased, which leaves all but A-Z alone.
                lowered = (text or "").encode("utf-8", "replace").lower().decode("utf-8")
                own = Counter(m[0] for m in _RUN.finditer(lowered))
                for word, n in own.items():
                    word = word_of(None if pd.isna(doc_id) else doc_id, word)
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= FLUSH:
                    yield out()
        yield out()

    return run


def vocabulary(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    word_of=as_written,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n) of all words of a least length and count. ``word_of`` makes a word from a
    document's id and a run with A-Z lower-cased; it gets each distinct run of a text once."""
    rows = docs.select(
        F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return (
        rows.mapInPandas(_counted(word_of, least_length), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Occurrences of each bigram in the words. There are no more than the square of the alphabet
    of ``RUN``, some eight thousand."""
    at = F.explode(F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1)))
    grams = words.where(F.char_length("word") >= GRAM).select("word", at.alias("at"))
    counts = grams.groupBy(F.expr(f"substring(word, at, {GRAM})").alias("gram")).count()
    return {r["gram"]: r["count"] for r in counts.collect()}


def prefix_of(ranks: list[int]) -> list[int]:
    """Places of the rarest grams, ascending: the first GRAM * EDITS + 1 and all that tie with
    the last of them."""
    reach = sorted(ranks)[min(GRAM * EDITS, len(ranks) - 1)]
    return [i for i, r in enumerate(ranks) if r <= reach]


def pivots_of(places: list[int], weights: list[int]) -> list[int]:
    """EDITS + 1 disjoint ones of the ascending places with the least sum of weights.

    best[j] holds the least sum of j disjoint grams among those seen so far, with its places; a
    gram extends the best choices among the grams that end before it.
    """
    seen: list[list[tuple[int, tuple[int, ...]] | None]] = []
    best: list[tuple[int, tuple[int, ...]] | None] = [(0, ())] + [None] * (EDITS + 1)
    free, before = 0, list(best)
    for place, weight in zip(places, weights):
        while free < len(seen) and places[free] + GRAM <= place:
            before = seen[free]
            free += 1
        now = list(best)
        for j in range(1, EDITS + 2):
            if before[j - 1] is not None:
                sums = (before[j - 1][0] + weight, (*before[j - 1][1], place))
                if now[j] is None or sums < now[j]:
                    now[j] = sums
        best = now
        seen.append(now)
    return list(best[EDITS + 1][1]) if best[EDITS + 1] else []


def signatures(words: DataFrame, counts: dict[str, int]) -> DataFrame:
    """(word, size, reach, prefix, pivots): rank of the last gram of the prefix, and grams as
    their rank in the upper and their place in the lower 32 bits."""
    order = sorted(counts, key=lambda g: (counts[g], g))
    rank = {g: i for i, g in enumerate(order)}
    weight = [counts[g] for g in order]

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for word in rows["word"]:
                ranks = [rank[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
                places = prefix_of(ranks)
                pivots = pivots_of(places, [weight[ranks[i]] for i in places])
                codes = {i: ranks[i] << 32 | i for i in places}
                reach = max(ranks[i] for i in places)
                out.append((word, len(word), reach, list(codes.values()), [codes[i] for i in pivots]))
            yield pd.DataFrame(out, columns=["word", "size", "reach", "prefix", "pivots"])

    return words.select("word").mapInPandas(
        sign, "word string, size int, reach int, prefix array<long>, pivots array<long>"
    )


def _before() -> Column:
    return F.expr("substring(word, 1, place)")


def _after() -> Column:
    return F.expr(f"substring(word, place + {GRAM} + 1)")


def _key(place: Column, size: Column, side: str, same: Column) -> Column:
    return F.xxhash64(F.shiftright("code", 32), place, size, F.lit(side), same)


def _placed(signed: DataFrame, grams: str) -> DataFrame:
    rows = signed.select("word", "size", "reach", F.explode(grams).alias("code"))
    return rows.withColumn("place", F.col("code").bitwiseAND(0xFFFFFFFF).cast("int"))


def _index(signed: DataFrame) -> DataFrame:
    """(key, word, reach, other): two rows per gram of a prefix, for an equal left and an equal
    right side; other is the side that may hold the edit."""
    place, size = F.col("place"), F.col("size")
    sides = F.array(
        F.struct(_key(place, size, "l", _before()).alias("key"), _after().alias("other")),
        F.struct(_key(place, size, "r", _after()).alias("key"), _before().alias("other")),
    )
    return _placed(signed, "prefix").select("word", "reach", F.inline(sides))


def _lookups(signed: DataFrame) -> DataFrame:
    """(key, word, reach, other, longer): six rows per pivot. longer is by how many code points
    the word that is looked for is longer; an edit on the left moves the pivot by as much."""
    rows = []
    for longer in (0, 1, -1):
        size = F.col("size") + longer
        still, moved = F.col("place"), F.col("place") + longer
        rows += [
            F.struct(_key(still, size, "l", _before()).alias("key"), _after().alias("other"), F.lit(longer).alias("longer")),
            F.struct(_key(moved, size, "r", _after()).alias("key"), _before().alias("other"), F.lit(longer).alias("longer")),
        ]
    return _placed(signed, "pivots").select("word", "reach", F.inline(F.array(*rows)))


def _without_one() -> Column:
    """What is left of other without each of its code points, with that one's place."""
    places = F.when(F.char_length("other") > 0, F.sequence(F.lit(1), F.char_length("other")))
    return F.transform(
        F.coalesce(places, F.array().cast("array<int>")),
        lambda i: F.struct(
            i.alias("i"),
            F.concat(
                F.substring(F.col("other"), F.lit(1), i - 1),
                F.substring(F.col("other"), i + 1, F.char_length("other")),
            ).alias("left"),
        ),
    )


def _crowded(index: DataFrame, lookups: DataFrame) -> DataFrame:
    """Pairs under crowded keys. Sides of equal length are near if they are equal without the code
    point at one place; a longer one is near if it equals the shorter without one of its own."""

    def mark(longer: int, i: Column, left: Column) -> Column:
        return F.xxhash64("key", F.lit(longer), i, left)

    whole = lambda longer: F.array(mark(longer, F.lit(0), F.col("other")))
    each = lambda longer, placed: F.transform(
        _without_one(), lambda x: mark(longer, x["i"] if placed else F.lit(0), x["left"])
    )
    held = F.explode(F.array_distinct(F.concat(each(0, True), each(1, False), whole(-1))))
    wanted = F.explode(
        F.array_distinct(
            F.when(F.col("longer") == 0, each(0, True))
            .when(F.col("longer") == 1, whole(1))
            .otherwise(each(-1, False))
        )
    )
    left = lookups.select(F.col("word").alias("a"), F.col("reach").alias("_reach"), wanted.alias("mark"))
    return left.join(index.select("word", "reach", held.alias("mark")), "mark")


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b) of all near words, a < b, each pair once. Words have at least four code points and
    occur once in the table."""
    signed = written(signatures(words, gram_counts(words)), "spelling-signatures")
    index = _index(signed)
    sizes = written(index.groupBy("key").agg(F.count(F.lit(1)).alias("held")), "spelling-keys")
    lookups = written(_lookups(signed).join(sizes, "key"), "spelling-lookups")
    crowds = sizes.where(F.col("held") > crowd).select("key")
    few = lookups.where(F.col("held") <= crowd).select(
        "key", F.col("word").alias("a"), F.col("reach").alias("_reach")
    )
    candidates = few.join(index, "key").select("a", "word", "_reach", "reach").union(
        _crowded(
            index.join(crowds, "key", "left_semi"), lookups.where(F.col("held") > crowd)
        ).select("a", "word", "_reach", "reach")
    )
    found = written(
        candidates.where("_reach <= reach and a != word")
        .where(F.levenshtein("a", "word", EDITS) == EDITS)
        .select(F.least("a", "word").alias("a"), F.greatest("a", "word").alias("b"))
        .distinct(),
        "spelling-pairs",
    )
    for scratch in (signed, sizes, lookups):
        dropped(scratch)
    return found


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words that have a form: every round doubles the steps followed."""
    reached = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = written(
            reached.join(onward, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "spelling-roots",
        )
        dropped(reached)
        reached = stepped.select("word", "root")
        reached._written_path = stepped._written_path
        if stepped.where("moved").isEmpty():
            return reached


def variants(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n).

    The form is the near word that occurs most often (ties: the smallest in code-point order) if
    it occurs ``DOMINANCE`` times as often; root is the last of the forms that follow each other.
    """
    words = written(words, "spelling-words")
    pairs = near_pairs(words, crowd)
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # The least of these is the most frequent near word.
    order = F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))
    best = both.join(counts, "near").groupBy("word").agg(
        F.min(order).alias("best"), F.count(F.lit(1)).alias("n_near")
    )
    dominant = -F.col("best.n") >= DOMINANCE * F.col("n")
    formed = written(
        words.join(best, "word", "left").select(
            "word",
            F.when(dominant, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(dominant, -F.col("best.n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    dropped(pairs)
    dropped(words)
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", word_of=as_written
) -> DataFrame:
    """Variants of all words of the documents; see ``vocabulary`` and ``variants``.

    Null and empty texts have no words. Ids only go to ``word_of``: null ones as None, repeated
    ones are documents of their own. An empty table gives no rows; other columns are not looked at.
    """
    return variants(vocabulary(docs, doc_id, text, word_of))


def slipped(doc_id: str | None, run: str) -> str:
    """The query's words: one run in 97 by the hash of id and run loses a code point. Those of a
    document without an id stay as written."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]


@query()
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), word_of=slipped)
