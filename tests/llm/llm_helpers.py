"""Small tables and brute-force versions for the training-data operators."""

from __future__ import annotations

import re

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Extra columns whose names operators use inside.
CLASHING = "fp long, node long, key string, component_id long, score double, digest string, size long, words string, _id long, v string"


def documents(spark, texts, sources=None, langs=None, start=0):
    sources = sources or [f"src{i % 3}" for i in range(len(texts))]
    langs = langs or ["en"] * len(texts)
    rows = [(start + i, t, langs[i], sources[i], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark):
    """Null, empty and very long texts, repeats, and columns with clashing names."""
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "  \n", "en", "a"), (4, long_text, "en", "b"),
        (5, "one two three four", "en", None), (6, "one two three four", "de", "a"),
        (6, "one two three four", "de", "a"), (7, "Ünïcödé — ſt K 中文 😀", "fr", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for part in CLASHING.split(", "):
        name, kind = part.split(" ")
        df = df.selectExpr("*", f"cast(null as {kind}) as {name}")
    return df


def nothing(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def reachable(nodes, linked):
    """Smallest node reachable from each, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in linked:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n not in out:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = n
                    todo += near[x] - out.keys()
    return out


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)
