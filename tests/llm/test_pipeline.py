"""The pipeline against a brute-force version of its stages."""

import struct
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import FOLDER
from tidegauge.llm import mixing, quality_rules


@pytest.fixture(scope="module")
def kept(spark, corpus):
    """The documents after each stage, as the pipeline computes them, with the texts before them."""
    steps, docs = [], corpus
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        steps.append(docs)
    return steps


def _rows(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


def test_stages_in_order(spark, corpus, kept):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(kept) == 5
    for frame in kept[:-1]:
        assert frame.columns == corpus.columns
    start = _rows(corpus)
    entries = {r["doc_id"]: r["failed"] for r in quality_rules.ledger(corpus).collect()}
    mask = quality_rules.policy_mask(quality_rules.POLICY)
    good = _rows(kept[0])
    assert good == {i: t for i, t in start.items() if not entries[i] & mask}
    assert all(not brute.quality(t)["base_failed"] for t in good.values())

    largest = {}
    for i, t in good.items():
        largest[t] = max(i, largest.get(t, i))
    exact = _rows(kept[1])
    assert exact == {i: t for t, i in largest.items()}

    groups = brute.near_components(exact.items())
    near = _rows(kept[2])
    assert near == {i: t for i, t in exact.items() if groups[i][1] == i}

    mix = {r["doc_id"]: r for r in mixing.mix_sources(kept[2]).collect()}
    times = Counter(r["doc_id"] for r in kept[3].select("doc_id").collect())
    assert times == Counter({i: -(-r["taken"] // r["size"]) for i, r in mix.items() if r["taken"]})
    assert set(_rows(kept[3])) <= set(near)


def test_the_end_is_encoded(kept):
    tiktoken = pytest.importorskip("tiktoken")
    import base64

    from tidegauge.llm.queries import tokenizer

    path, pattern = tokenizer()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = kept[4].collect()
    assert len(rows) == kept[3].count()
    for r in rows:
        ids = own.encode_ordinary(r["text"])
        assert bytes(r["ids"]) == struct.pack(f"<{len(ids)}I", *ids) and r["n_tokens"] == len(ids)


def test_run_gives_the_same_rows(spark, kept):
    got = corpus_pipeline.run(spark, FOLDER)
    key = F.xxhash64("doc_id", "text", "ids")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in kept[4].select(key).collect())


def test_odd_rows_and_an_empty_table(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        frame = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            frame = stage(spark, frame, FOLDER)
            assert frame.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() == 0
