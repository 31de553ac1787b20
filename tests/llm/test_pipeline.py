from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
import tiktoken
from llm_helpers import CLASHING, awkward, nothing
from test_jaccard import brute as near_copies
from test_mixing import poured
from test_toxicity import labelled

import public_tokenizers
from obsgrid.llm import bpe, toxicity
from obsgrid.llm.common import written
from obsgrid.llm.mixing import WORD


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The rows after each stage, on documents with toxic ones, copies and near copies."""
    sf_dir = str(tmp_path_factory.mktemp("tables"))
    docs, labels = labelled(spark, 240)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    more = [(1000 + i, texts[i % 40]) for i in range(60)]
    more += [(2000 + i, f"{texts[1]} " * 30 + f"tail{i}") for i in range(6)]
    extra = spark.createDataFrame(
        [(i, t, "en", f"src{i % 4}" if i % 5 else None, len(t)) for i, t in more], docs.schema
    )
    docs.union(extra).write.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    frames, docs = {}, spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
        frames[name] = docs
    return sf_dir, frames


def rows(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_columns(staged):
    _, frames = staged
    names = list(frames)
    assert [n for n, _ in corpus_pipeline.STAGES] == names[1:]
    for name in names[:-1]:
        assert frames[name].columns == frames["documents"].columns


def test_toxic_documents_go(spark, staged):
    sf_dir, frames = staged
    docs = frames["documents"]
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = {i for i, t in rows(docs).items() if model.score(t) < 0.5}
    kept = set(rows(frames["toxicity"]))
    assert kept == want and 0 < len(kept) < docs.count()
    assert all(i % 3 for i in kept if i < 1000) and sum(i < 1000 for i in kept) == 160


def test_one_of_each_copy_stays(staged):
    _, frames = staged
    last = {}
    for i, text in sorted(rows(frames["toxicity"]).items()):
        last[text] = i
    assert set(rows(frames["exact dedup"])) == set(last.values())


def test_one_of_each_near_copy_stays(staged):
    _, frames = staged
    before = rows(frames["exact dedup"])
    want, linked = near_copies(sorted(before.items()))
    kept = set(rows(frames["simhash near-dedup"]))
    # One of each group stays; a link that the index misses may leave one more.
    assert kept >= {i for i, group in want.items() if i == group} and len(kept) < len(before)
    assert len(before) - len(kept) >= 0.9 * (len(before) - len(set(want.values())))
    assert sum(i >= 2000 for i in before) == 6 and sum(i >= 2000 for i in kept) <= 1


def test_the_mix_is_written_out(staged):
    _, frames = staged
    before = {r["doc_id"]: r for r in frames["simhash near-dedup"].collect()}
    after = Counter(r["doc_id"] for r in frames["mixing to target weights"].collect())
    size = {i: len(WORD_FINDER(r["text"])) for i, r in before.items()}
    sources, words = Counter(), Counter()
    for i, r in before.items():
        sources[r["source"]] += size[i]
        words[r["source"]] += size[i] * after[i]
    want = poured(sources)
    assert set(after) <= set(before) and max(after.values()) <= 3
    assert any(n > 1 for n in after.values()) and set(after) != set(before)
    assert all(abs(words[s] - want[s]) <= 12 for s in sources)


def WORD_FINDER(text):
    import re

    return re.findall(WORD, text or "")


def test_tokens(staged):
    _, frames = staged
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANKS)),
        special_tokens={},
    )
    mixed = frames["mixing to target weights"].collect()
    want = Counter((r["doc_id"], tuple(library.encode_ordinary(r["text"]))) for r in mixed)
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in frames["byte-level bpe"].collect())
    assert got == want


def test_run(spark, staged):
    sf_dir, frames = staged
    columns = frames["byte-level bpe"].columns
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == columns
    key = lambda df: Counter((r["doc_id"], r["ids_sha256"]) for r in df.collect())
    assert key(got) == key(frames["byte-level bpe"])


def test_rows_go_by_id_and_text(spark, staged):
    sf_dir, _ = staged
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    texts = ["one two three four", "five six seven eight", "nine ten eleven twelve"]
    ids = [(5, 0), (5, 1), (7, 1), (None, 2), (None, 0), (None, 2)]
    docs = spark.createDataFrame([(i, texts[t], "en", "a", 9) for i, t in ids], schema)
    deduplicated = written(corpus_pipeline.without_copies(spark, docs, sf_dir), "stage")
    kept = [(5, texts[0]), (7, texts[1]), (None, texts[2])]
    key = lambda df: Counter((r["doc_id"], r["text"]) for r in df.collect())
    assert key(deduplicated) == Counter(kept)
    assert key(corpus_pipeline.without_near_copies(spark, docs, sf_dir)) == Counter([(5, texts[0]), (5, texts[1]), (None, texts[2])])
    mixed = key(corpus_pipeline.mixed(spark, docs, sf_dir))
    assert sum(mixed.values()) == 6 and set(mixed) <= {(i, texts[t]) for i, t in ids}
    assert key(corpus_pipeline.without_toxic(spark, docs, sf_dir)) == Counter((i, texts[t]) for i, t in ids)


def test_awkward_documents(spark, staged, tmp_path):
    sf_dir, _ = staged
    docs = awkward(spark).drop(*[c.split(" ")[0] for c in CLASHING.split(", ")])
    docs = docs.selectExpr("*", "cast(length(text) as long) as n_chars", "doc_id as times", "1 as rows", "2 as turn")
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), "awkward")
        if name != "byte-level bpe":
            assert out.columns == docs.columns, name
            if name == "exact dedup":
                assert sorted(r["doc_id"] for r in out.collect()) == [2, 3, 4, 6, 7]
            docs = out
    empty = nothing(spark)
    for _, stage in corpus_pipeline.STAGES:
        empty_out = written(stage(spark, empty, sf_dir), "empty")
        assert empty_out.count() == 0
