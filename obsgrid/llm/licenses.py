"""License scans over a positional index of rare words, in DataFrame functions only.

Templates are short phrases, which must be found word for word, and longer passages. The index
lists, for each template's words of highest inverse document frequency in the scanned corpus,
their positions in it. A file looks its own occurrences of those words up: every posting names
the word at which the template would start. A place stands if enough of the template's rare
words are found at their positions relative to that start and all its key phrases occur there;
for a phrase, if all words are there.

One pass counts documents per template word (at most the templates' words reach the driver), a
second one scans. Nothing but those counts is shuffled, so hot files or words meet in no task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsgrid.llm.common import table, text_or_empty
from obsgrid.llm.registry import query

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rare words of a passage in the index, and the part of them that must be in place.
RARE = 12
IN_PLACE = 0.4
#: Words by which key phrases may be off, and the share of a passage's words that must be near.
DRIFT = 20
COVERAGE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Phrases that must occur; none for a phrase that is searched as a whole.
    keys: tuple[str, ...] = ()

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def exact(self) -> bool:
        return not self.keys


# The phrases of the contract.
PHRASES = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)

# Sentences of well-known public licences, as words in lower case.
PASSAGES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
        ("with or without fee is hereby granted", "appear in all copies"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met redistributions of source "
        "code must retain the above copyright notice this list of conditions and the following "
        "disclaimer",
        ("redistribution and use in source and binary forms", "conditions are met"),
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license you may obtain a copy of the license at",
        ("apache license version 2 0", "in compliance with the license"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
        "copy of the mpl was not distributed with this file you can obtain one at",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "cc-by",
        "this work is licensed under the creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "cc-by-nc",
        "this work is licensed under the creative commons attribution noncommercial 4 0 "
        "international license",
        ("creative commons attribution noncommercial",),
    ),
)


def words_of(text: str) -> Column:
    """A text's words after A-Z are lower-cased. The Kelvin sign is the one letter outside ASCII
    that would become an ASCII word's letter on the way; another letter takes its place."""
    plain = F.replace(text_or_empty(text), F.lit("K"), F.lit("ĸ"))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORDS), F.lit(0))


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> tuple[int, dict[str, int]]:
    """Number of documents, and in how many of them each template word occurs."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = docs.select(F.array_intersect(words_of(text), _texts(vocabulary)).alias("held"))
    counts = (
        held.select(F.explode(F.array_append("held", F.lit(""))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most one row per template word
    )
    found = {r["word"]: r["n"] for r in counts}
    return found.pop("", 0), found


def _rare(template: Template, total: int, frequency: dict[str, int]) -> list[tuple[str, int]]:
    """The words of highest inverse document frequency with their positions; of a phrase that
    must be complete the first one is enough."""
    idf = {w: math.log((total + 1) / (frequency.get(w, 0) + 1)) for w in template.words}
    best = sorted(idf, key=lambda w: (-idf[w], w))[: 1 if template.exact else RARE]
    return [(w, i) for i, w in enumerate(template.words) if w in best]


def _templates(templates, rare) -> Column:
    """The templates as an array of constants."""
    return F.array(
        *[
            F.struct(
                F.lit(t.label).alias("label"),
                F.lit(t.exact).alias("exact"),
                _texts(t.words).alias("words"),
                _texts([f" {k} " for k in t.keys]).alias("keys"),
                F.array(
                    *[F.struct(F.lit(w).alias("word"), F.lit(i).alias("pos")) for w, i in r]
                ).alias("rare"),
            )
            for t, r in zip(templates, rare)
        ]
    )


def _stands(words: Column, place: Column, known: Column) -> Column:
    """Whether the template stands at the place, and how complete it is there (0: it doesn't)."""
    t = F.element_at(known, place["t"] + 1)
    start, length = place["start"], F.size(t["words"])
    there = F.slice(words, F.greatest(start, F.lit(0)) + 1, length)
    from_word = F.greatest(start - DRIFT, F.lit(0))
    near = F.slice(words, from_word + 1, F.greatest(start + length + DRIFT - from_word, F.lit(1)))
    line = F.concat(F.lit(" "), F.array_join(near, " "), F.lit(" "))
    in_place = F.size(
        F.filter(t["rare"], lambda r: F.get(words, start + r["pos"]) == r["word"])
    ) / F.size(t["rare"])
    share = F.size(F.array_intersect(t["words"], near)) / F.size(F.array_distinct(t["words"]))
    passage = (
        (in_place >= IN_PLACE)
        & (share >= COVERAGE)
        & F.forall(t["keys"], lambda k: F.contains(line, k))
    )
    return F.when(t["exact"], ((start >= 0) & (there == t["words"])).cast("double")).otherwise(
        F.when(passage, share).otherwise(0.0)
    )


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: tuple[Template, ...] = PHRASES,
    passages: tuple[Template, ...] = PASSAGES,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places).

    places lists label, start and score of all that was found; the base columns are about the
    phrases. Null and empty texts have no words. Ids come as they are, null and repeated ones
    too. An empty table gives no rows; other columns are not looked at.
    """
    templates = phrases + passages
    total, frequency = document_frequencies(docs, templates, text)
    rare = [_rare(t, total, frequency) for t in templates]
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, positions in enumerate(rare):
        for word, pos in positions:
            postings.setdefault(word, []).append((number, pos))
    index = F.create_map(
        *[
            x
            for word, entries in postings.items()
            for x in (
                F.lit(word),
                F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("pos")) for t, p in entries]),
            )
        ]
    )
    listed = _texts(sorted(postings))
    known = _templates(templates, rare)
    words = F.col("words")
    occurrences = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda o: F.array_contains(listed, o["word"]),
    )
    started = F.array_distinct(
        F.flatten(
            F.transform(
                F.col("occurrences"),
                lambda o: F.transform(
                    F.element_at(index, o["word"]),
                    lambda p: F.struct(p["t"].alias("t"), (o["at"] - p["pos"]).alias("start")),
                ),
            )
        )
    )
    # Postings of a passage that stands at one start agree; a start with few of them is dropped
    # by the share of rare words in place.
    judged = F.transform(
        started,
        lambda p: F.struct(
            F.element_at(known, p["t"] + 1)["label"].alias("label"),
            F.element_at(known, p["t"] + 1)["exact"].alias("exact"),
            p["start"].cast("long").alias("start"),
            _stands(words, p, known).alias("score"),
        ),
    )
    empty = F.array().cast("array<struct<word:string,at:int>>")
    found = (
        docs.select(F.col(doc_id).alias("doc_id"), words_of(text).alias("words"))
        .withColumn(
            "occurrences",
            F.when(F.arrays_overlap(words, listed), occurrences).otherwise(empty),
        )
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.filter(judged, lambda p: p["score"] > 0).alias("places"),
        )
        .withColumn("base", F.filter("places", lambda p: p["exact"]))
    )
    label_line = lambda places: F.array_join(
        F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ","
    )
    starts = F.transform("base", lambda p: p["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        label_line("base").alias("base_labels"),
        label_line("places").alias("labels"),
        F.coalesce(
            F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)
        ).alias("score"),
        "places",
    )


@query()
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("places")
