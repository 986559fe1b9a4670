"""Exact and near duplicates, and mixing, against plain definitions."""

import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import EDGES, FOLDER
from tidegauge.llm import exact_dedup, mixing, near_dup, queries


def test_exact_groups(spark, texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[t].append(i)
    for r in queries.op2_exact_dedup(spark, FOLDER).collect():
        own = groups[texts[r["doc_id"]]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(own), len(own), r["doc_id"] == max(own))
        assert r["text_sha256"] == brute.sha(texts[r["doc_id"]])


@pytest.mark.parametrize("min_copies", [2, 32, 10**9])
def test_exact_groups_with_and_without_heavy_hitters(spark, min_copies):
    rows = [(i, "common" if i % 3 else f"text {i % 7}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = exact_dedup.exact_groups(docs, capacity=4, min_copies=min_copies).collect()
    sizes = defaultdict(int)
    for _, t in rows:
        sizes[t] += 1
    assert len(got) == 600
    for r in got:
        assert r["group_size"] == sizes[rows[r["doc_id"]][1]]
        assert r["kept"] == (r["doc_id"] == max(i for i, t in rows if t == rows[r["doc_id"]][1]))


def test_exact_odd_rows(edge_docs, no_docs):
    got = exact_dedup.exact_groups(edge_docs).collect()
    assert len(got) == len(EDGES)
    empty = [r for r in got if r["text_sha256"] == brute.sha("")]
    assert {r["doc_id"] for r in empty} == {None, 1, 2} and {r["keep_id"] for r in empty} == {2}
    assert [r["doc_id"] for r in empty if r["kept"]] == [2]
    kept = exact_dedup.drop_exact_copies(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted({i or -1 for i, _ in EDGES} - {1})
    assert exact_dedup.exact_groups(no_docs).count() == exact_dedup.drop_exact_copies(no_docs).count() == 0


def test_near_components(spark, texts):
    want = brute.near_components(texts.items())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op6_near_dup(spark, FOLDER).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_near_odd_rows(edge_docs, no_docs):
    got = near_dup.near_groups(edge_docs).collect()
    assert len(got) == len(EDGES)
    sizes = {(r["doc_id"], r["n_shingles"]) for r in got}
    assert sizes == {(i, len(brute.shingle_set(t))) for i, t in EDGES}
    found = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert found[5] == found[6] == 5 and found[4] == 4 and found[1] == 1 and found[2] == 2 and found[3] == 3
    assert near_dup.drop_near_copies(edge_docs).columns == edge_docs.columns
    assert near_dup.near_groups(no_docs).count() == near_dup.drop_near_copies(no_docs).count() == 0


@pytest.mark.parametrize("direct", [near_dup._MEMBERS, 0])
def test_near_group_with_chains_and_a_shared_passage(spark, monkeypatch, direct):
    """With no bucket compared directly, all that is left goes through the prefixes."""
    monkeypatch.setattr(near_dup, "_MEMBERS", direct)
    rng = np.random.default_rng(5)
    word = lambda n: " ".join(f"w{x}" for x in rng.integers(10**6, size=n))
    passage = word(60)
    rows, base = [], word(200).split()
    for i in range(60):  # each differs a little from the one before, so the ends are linked by steps only
        base[(7 * i) % 200] = f"new{i}"
        rows.append((i, " ".join(base)))
    rows += [(100 + i, passage + " " + word(90)) for i in range(60)]
    rows += [(300 + i, "same text here for all of them " * 3) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_groups(docs).collect()}
    assert got == brute.near_components(rows)
    assert got[59][1] == 0 and got[159][1] == 159 and got[499][1] == 300


def test_strangers_are_compared_in_blocks():
    """Links between different components only, as many as join them."""
    base = [f"w{i}" for i in range(60)]
    text = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(base)).encode()
    frame = lambda *rows: pd.DataFrame(rows, columns=["node", "label", "text"])
    members = frame((1, 1, text()), (2, 1, text(5)), (3, 3, b"something else of five words here"))
    strangers = frame((7, 7, text(9)), (8, 8, text(9)), (9, 9, b"alone " * 9))
    got = near_dup._block_links((0, 0, 0), strangers, members)
    assert got["a"].tolist() == [7, 8] and set(got["b"]) <= {1, 2}
    among = near_dup._block_links((0, 0, 0), strangers, strangers)
    assert len(among) == 1 and set(among.iloc[0]) == {7, 8}
    assert near_dup._block_links((0, 0, 0), strangers.iloc[2:], members).empty


def test_sketch_is_filled_and_close_to_the_similarity():
    rng = np.random.default_rng(3)
    for size, share in ((3, 1.0), (40, 0.5), (1000, 0.75), (5000, 0.9)):
        both = rng.integers(2**63, size=2 * size, dtype=np.uint64)
        shared = int(size * share)
        a, b = np.unique(both[:size]), np.unique(np.concatenate((both[:shared], both[size : 2 * size - shared])))
        x, y = near_dup.sketch(a), near_dup.sketch(b)
        assert (x != np.iinfo(np.uint64).max).all()
        true = shared / (2 * size - shared)
        assert abs((x == y).mean() - true) < 5 * math.sqrt(true * (1 - true) / near_dup.COORDS) + 1e-9


def test_components_of_a_long_chain(spark):
    nodes = spark.range(300).select(F.col("id").alias("node"), F.col("id").alias("label"))
    links = spark.range(299).select(F.col("id").alias("b"), (F.col("id") + 1).alias("a")).where("a != 150")
    labels = near_dup.components(nodes, links)
    assert labels.count() == 300
    sides = labels.groupBy("label").agg(F.min("node"), F.max("node"), F.count("*")).collect()
    assert sorted(tuple(r)[1:] for r in sides) == [(0, 149, 150), (150, 299, 150)]


def _targets(sizes, weights=(5, 2, 1), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, whole = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = whole - sum(epochs * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > epochs * sizes[s]}
        if not over:
            return target | {s: epochs * sizes[s] for s in capped}
        capped |= over


def _check_mix(rows):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = _targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2 * mixing.BLOCK_WORDS, 0.02 * want[s])


def test_mix_of_the_corpus(spark, texts):
    rows = queries.op1_mixing(spark, FOLDER).collect()
    assert {r["doc_id"]: r["size"] for r in rows} == {i: len(brute.words(t)) for i, t in texts.items()}
    _check_mix(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op1_mixing(spark, FOLDER).collect()))


def test_mix_with_capped_and_null_sources(spark):
    rows = [(i, "w " * (1 + i % 50), None if i % 11 == 0 else "abc"[min(2, i % 20)]) for i in range(3000)]
    rows += [(None, None, "a"), (9000, "", "empty"), (1, "w w", "b"), (1, "w w", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_sources(docs, shard_docs=100).collect()
    assert len(got) == len(rows)
    _check_mix(got)


def test_mix_odd_rows(edge_docs, no_docs):
    got = mixing.mix_sources(edge_docs).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((i or -1, len(brute.words(t))) for i, t in EDGES)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mix_sources(no_docs).count() == 0
    assert mixing.mixed_documents(edge_docs).columns == edge_docs.columns
    assert mixing.mixed_documents(no_docs).count() == 0
    nothing = mixing.mix_sources(edge_docs.where("doc_id in (1, 2, 3)")).collect()
    assert [(r["target"], r["taken"]) for r in nothing] == [(0.0, 0)] * 3


def test_apportionment_is_by_highest_quotients(spark):
    rng = np.random.default_rng(1)
    weights = [float(w) for w in (*rng.integers(1, 10_000, size=40), 0, 500_000, 500_000)]
    for seats in (0, 1, 17, 1000):
        rows = spark.createDataFrame([(1, i, w, seats) for i, w in enumerate(weights)], "p int, k int, w double, seats bigint")
        got = {r["k"]: r["quota"] for r in mixing.apportion(rows, ["p"], "k", "w", "seats").collect()}
        want = dict.fromkeys(range(len(weights)), 0)
        for _ in range(seats):
            best = max(want, key=lambda k: (weights[k] / (2 * want[k] + 1), -k))
            want[best] += 1
        assert got == want
