"""Language identification, tokens and language model scores."""

import base64
import math
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import EDGES, FOLDER
from tidegauge.llm import bpe, language, maxent, queries


def _fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path(queries.TOKENIZER), public.PATTERN


@pytest.fixture(scope="module")
def reference(tokenizer):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = tokenizer
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_languages_held_out(spark, corpus):
    labels = {r["doc_id"]: r["lang"] for r in corpus.select("doc_id", "lang").collect()}
    got = queries.op3_language(spark, FOLDER).collect()
    assert {r["doc_id"] for r in got} == set(labels) and len(got) == len(labels)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in labels if _fold(i, 5) == 0}
    assert sum(r["lang_pred"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_rows(edge_docs, no_docs):
    net = language.train(edge_docs)
    got = language.identify(edge_docs.withColumn("score", F.lit("x")), net)
    assert len(got.columns) == len(set(got.columns)) == len(edge_docs.columns) + 2
    for r in got.collect():
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered) and 0 <= r["score"] <= 1
    nothing = language.train(no_docs)
    assert {r["lang_pred"] for r in language.identify(edge_docs, nothing).collect()} == {"und"}
    assert language.identify(no_docs, net).count() == 0


def _plain_language(net, text):
    """Label and probability of a text, byte by byte in double precision."""
    data = text.encode()
    total = np.zeros(len(net.languages))
    for at in range(0, len(data), language.WINDOW):
        window = data[at : at + language.WINDOW]
        states = []
        for side in (0, 1):
            h, seen = np.zeros(language.HIDDEN), {}
            for t in range(len(window)) if side == 0 else reversed(range(len(window))):
                x = net.table[side][window[t]].astype(float)
                gate = np.clip((h @ net.recur_gate[side] + x[: language.HIDDEN]) / 4 + 0.5, 0, 1)
                new = np.clip((gate * h) @ net.recur_new[side] + x[language.HIDDEN :], -1, 1)
                h = seen[t] = (1 - gate) * h + gate * new
            states.append(seen)
        for t in range(len(window)):
            e = np.exp(np.concatenate((states[0][t], states[1][t])) @ net.out + net.bias)
            total += e / e.sum()
    return total / len(data)


def test_predictions_equal_plain_ones(spark, corpus, edge_docs):
    rng = np.random.default_rng(5)
    net = language._start(["a", "b", "c"], rng)
    sizes = (1, 2, 127, 128, 129, 700)
    texts = ["".join(rng.choice(list("abé日 z"), size=n)) for n in sizes] + ["x" * 9000]
    texts += [r["text"] for r in corpus.orderBy("doc_id").limit(60).collect() if r["text"]]
    texts += [t for _, t in EDGES if t and any(c.isalpha() for c in t) and len(t) < 20_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in language.identify(frame, net).collect():
        means = _plain_language(net, r["text"])
        if not any(c.isalpha() for c in r["text"]):
            continue
        assert r["score"] == pytest.approx(means.max(), abs=1e-4)
        assert means[net.languages.index(r["lang_pred"])] == pytest.approx(means.max(), abs=1e-4)


def test_many_languages_are_joined_without_a_broadcast(edge_docs, monkeypatch):
    usual = language.train(edge_docs)
    monkeypatch.setattr(language, "FEW_LANGUAGES", 1)
    other = language.train(edge_docs)
    assert usual.languages == other.languages == ["de", "en"]
    assert all(np.array_equal(getattr(usual, n), getattr(other, n)) for n in ("table", "recur_gate", "out"))


def test_gradients_of_the_network():
    rng = np.random.default_rng(2)
    net = language._start(["a", "b"], rng)
    ids, labels = rng.integers(256, size=(7, 3)), np.array([0, 1, 1])
    ids[5:, 1] = language._PAD
    def loss():
        p = language._positions(net, ids)[labels, :, np.arange(3)].T
        return -np.log(p)[ids != language._PAD].mean()
    grads = language._gradients(net, ids, labels)
    for name, at in (("out", (3, 1)), ("recur_gate", (0, 2, 5)), ("recur_new", (1, 4, 4)), ("table", (0, ids[2, 0], 20))):
        array = getattr(net, name)
        kept, step = array[at], 1e-2
        array[at] = kept + step
        up = loss()
        array[at] = kept - step
        down = loss()
        array[at] = kept
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_tokens_of_the_corpus(spark, texts, reference):
    for r in queries.op4_bpe(spark, FOLDER).collect():
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == brute.sha(struct.pack(f"<{len(ids)}I", *ids))
        assert r["decoded_sha256"] == brute.sha(texts[r["doc_id"]])


def test_tokens_of_odd_rows(edge_docs, no_docs, tokenizer, reference):
    got = bpe.tokenize(edge_docs, *tokenizer)
    assert got.columns == [*edge_docs.columns, "n_tokens"]
    for r in got.withColumn("back", bpe.decoded(F.col("ids"), *tokenizer)).collect():
        assert _ids(r["ids"]) == reference.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]).decode() == (r["text"] or "")
    assert bpe.tokenize(no_docs, *tokenizer).count() == 0


def test_trees_give_what_plain_merging_gives(tokenizer, reference):
    own, rng = bpe.encoder(*tokenizer), random.Random(4)
    alphabets = ["a", "ab", "thing ", "0123456789", "aé日本語", "\x00\x85\xa0 \n\t", "!?-=_", "😀👍🏽"]
    for _ in range(1500):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 150)))
        assert _ids(own.encode(text)) == reference.encode_ordinary(text)
        data = "".join(rng.choice(alphabets[1:3]) for _ in range(3)).encode() * rng.randint(1, 30)
        whole = own._merge_long(data)
        assert own.tree(data) == whole
        cut = rng.randint(1, len(data))
        assert own.join(own.tree(data[:cut]), own.tree(data[cut:])) == whole
    long = "a" * 30_000
    assert own.decode(own.encode(long)) == long.encode()


def _plain_scores(rows):
    """doc_id -> (tokens, known, N, base score) with the end token as None."""
    toks = {i: [*brute.words(brute.lowered(t)), None] for i, t in rows}
    counts = Counter(x for i in toks if _fold(i, 7) != 2 for x in toks[i])
    total, distinct = sum(counts.values()), len(counts)
    return {
        i: (len(ts), sum(counts[x] > 0 for x in ts), total,
            sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in ts)) for i, ts in toks.items()}


def test_scores_of_the_corpus(spark, texts):
    want = _plain_scores(texts.items())
    got = queries.op9_maxent(spark, FOLDER).collect()
    assert {r["doc_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][:3]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][3], rel=1e-9)
        assert r["held_out"] == (_fold(r["doc_id"], 7) == 2)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def _learnt(docs):
    return docs.select(F.encode("text", "UTF-8").alias("text"), F.lit(0).alias("part"))


@pytest.mark.parametrize("head", [0, 50])
def test_scores_do_not_depend_on_what_is_broadcast(spark, texts, head):
    docs = spark.createDataFrame([(i, t) for i, t in texts.items() if i < 40], "doc_id bigint, text string")
    whole = maxent.count_words(_learnt(docs).select("text"), 10**6)
    model = maxent.train(_learnt(docs), whole, 1)
    small = maxent.count_words(_learnt(docs).select("text"), head)
    assert len(small.keys) <= head < len(whole.keys)
    # Words outside the head share leaves; with the frequent ones in it nothing else differs.
    plain = [
        {r["doc_id"]: tuple(r)[1:5] for r in maxent.apply(docs, v, model).collect()} for v in (whole, small)]
    for i, (n, known, total, base) in plain[0].items():
        assert plain[1][i][:3] == (n, known, total) and plain[1][i][3] == pytest.approx(base)
    if head >= 50:
        return
    leaves = dict(zip(whole.keys.tolist(), whole.leaves.tolist()))
    rest = {r["key"]: r["n"] for r in small.rest.collect()}
    assert rest == dict(zip(whole.keys.tolist(), whole.counts.tolist())) and set(leaves) == set(rest)


def test_probabilities_sum_to_one(spark, texts):
    """Of classes, of leaves in each class, and of the words of a leaf with one unseen word."""
    docs = spark.createDataFrame([(i, t) for i, t in texts.items() if i < 60], "doc_id bigint, text string")
    words = maxent.count_words(_learnt(docs).select("text"))
    model = maxent.train(_learnt(docs), words, 1)
    assert np.abs(model.weights).sum() > 0
    leaf = np.arange(maxent.LEAVES)
    after = 12345  # what stands before
    shares = []
    for each in leaf:
        codes = np.array([777, after, each << maxent._WORD_BITS | 5], np.int64)
        shares.append(model.log_shares(codes, np.array([0]))[2])
    assert np.exp(shares).sum() == pytest.approx(1, abs=1e-4)
    room = words.leaf_total + words.leaf_distinct + 1
    inside = np.zeros(maxent.LEAVES)
    np.add.at(inside, words.leaves, words.counts + 1)
    assert np.allclose(inside + 1, room) and words.leaf_total.sum() == words.total


def test_scores_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a c b a"), (2, "b a d a"), (3, "zz a")], "doc_id bigint, text string")
    learnt = docs.where("doc_id < 3")
    words = maxent.count_words(_learnt(learnt).select("text"))
    model = maxent.train(_learnt(learnt), words, 1)
    place = dict(zip(words.keys.tolist(), range(len(words.keys))))
    room = words.leaf_total + words.leaf_distinct + 1
    got = {r["doc_id"]: r["score"] for r in maxent.apply(docs, words, model).collect()}
    for r in docs.collect():
        coder = maxent._Coder(words.keys, words.leaves)
        toks = maxent.tokens(r["text"].encode())
        codes = np.array([coder[w] for w in toks])
        want = model.log_shares(codes, np.array([0])).sum() / math.log(10)
        for w in toks:
            at = place.get(maxent._key(w))
            n, leaf = (0, maxent._shared_leaf(w)) if at is None else (words.counts[at], words.leaves[at])
            want += math.log10((n + 1) / room[leaf])
        assert got[r["doc_id"]] == pytest.approx(want, rel=1e-6)


def test_features_start_anew_with_each_text():
    codes = np.array([3, 4, 5, 3, 4, 5], np.int64)
    rows = maxent._features(codes, np.array([0, 3]), 4096)
    assert (rows[:, :, :3] == rows[:, :, 3:]).all()
    other = maxent._features(np.array([9, 4, 5, 3, 4, 5], np.int64), np.array([0, 3]), 4096)
    assert (rows[:, :, 3:] == other[:, :, 3:]).all() and (rows[0, :, 1] != other[0, :, 1]).sum() == 2
    for level in range(2):
        for kind in range(maxent.FEATURES):
            assert (rows[level, kind] // 4096 == level * maxent.FEATURES + kind).all()


def test_context_tells_words_apart(spark):
    rows = [(i, f"x{i % 50} " + ("red" if i % 50 < 25 else "blue")) for i in range(4000)]
    rows += [(10_000 + k, f"x{k} {w}") for k in (3, 40) for w in ["red"]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in maxent.score(docs, F.col("doc_id") < 10_000).collect()}
    assert len(got) == len(rows) and got[10_003] > got[10_040] + 0.5


def test_rounds_and_buckets_grow_with_the_corpus():
    def sizes(total):
        none = np.zeros(0, np.int64)
        words = maxent.Vocabulary(none, none, none, total, 0, none, none, None)
        return words.rounds, words.buckets

    assert sizes(0) == (2, 4096) and sizes(100_000_000) == (2, 16384)
    grown = [sizes(t) for t in (10**6, 4 * 10**6, 10**8, 10**9, 10**12)]
    assert grown == sorted(grown) and grown[-1][0] > grown[3][0] > 2 and grown[-1][1] == maxent.MOST_BUCKETS


def test_scores_of_odd_rows(edge_docs, no_docs):
    got = maxent.score(edge_docs, F.col("doc_id").isNotNull()).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == sorted(
        (i or -1, len(brute.words(brute.lowered(t))) + 1) for i, t in EDGES)
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    untrained = maxent.score(edge_docs, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in untrained)
    assert maxent.score(no_docs, F.lit(True)).count() == 0


def test_a_step_against_plain_sums_and_pieces_hashed_once(monkeypatch):
    rng = np.random.default_rng(5)
    n, buckets, width = 5000, 1024, maxent.CLASSES  # more tokens than are held in the cache, fewer than a last full part
    rows = np.stack([rng.integers(0, buckets, n) + i * buckets for i in range(maxent.FEATURES)]).astype(np.int32)
    wanted, kind = rng.integers(0, width, n), rng.integers(0, width, n)
    bias = rng.normal(size=(width, width)).astype(np.float32)
    weights = rng.normal(size=(maxent.FEATURES * buckets, width)).astype(np.float32)
    seen = np.zeros(len(weights), np.float32)
    z = weights[rows].astype(float).sum(axis=0) + bias[kind]
    slope = np.eye(width)[wanted] - np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    sums, count = np.zeros(weights.shape), np.bincount(rows.ravel(), minlength=len(weights))
    for feature in rows:
        np.add.at(sums, feature, slope)
    plain = weights + maxent.STEP * sums / np.maximum(count, 1)[:, None]
    maxent._descend(weights, bias, rows, wanted, seen, buckets, kind)
    assert np.allclose(weights, plain, atol=1e-3) and (seen == count).all()

    asked, plain_hash = [], maxent.xxhash.xxh32_intdigest
    words = [b"wordy%05dly." % i for i in range(200)]
    leaves = [
        (maxent.FREQUENT + plain_hash(w.strip(b".")[-3:]) % (maxent.CLASSES - maxent.FREQUENT)) * maxent.CLASSES
        + plain_hash(w[:2]) % maxent.CLASSES for w in words]
    monkeypatch.setattr(maxent.xxhash, "xxh32_intdigest", lambda piece: asked.append(piece) or plain_hash(piece))
    assert [maxent._shared_leaf(w) for w in words] == leaves and len(asked) <= 11  # ten endings and a beginning


def test_tokens_of_a_batch_as_one_by_one(monkeypatch):
    rng = random.Random(7)
    odd = [None, b"", b" ", b"\n\n a", b"((()))", b"'x'.", b"A\xc3\x84Z \x00\xff \x1c\x85\x0b", b"a" * 31, b"b" * 32 + b" " + b"c" * 33]
    odd += [bytes(rng.choices(range(256), k=rng.randrange(60))) for _ in range(300)]
    odd += [bytes(rng.choices(b"aB.(' \n", k=rng.randrange(90))) for _ in range(300)]
    plain = [maxent.tokens(t) for t in odd]
    found, words = maxent._Tokens(odd), [w for each in plain for w in each]
    assert np.diff(np.append(found.starts, len(found.keys))).tolist() == [len(each) for each in plain]
    assert found.keys.tolist() == [maxent._key(w) for w in words]
    assert found.shared_leaves(np.arange(len(words))).tolist() == [maxent._shared_leaf(w) for w in words]

    head = sorted({maxent._key(w) for w in words[::2]})
    coder = maxent._Coder(np.array(head, np.int64), np.arange(len(head)) % maxent.LEAVES)
    codes, starts, keys = maxent._coded(coder, odd)
    place = {key: i + 1 for i, key in enumerate(head)}
    assert maxent._place_of(codes).tolist() == [place.get(maxent._key(w), 0) for w in words]
    leaves = [(place[maxent._key(w)] - 1) % maxent.LEAVES if maxent._key(w) in place else maxent._shared_leaf(w) for w in words]
    assert maxent._leaf_of(codes).tolist() == leaves
    short = [1 + (maxent._key(w) % 2**64 >> 20) % ((1 << maxent._WORD_BITS) - 1) for w in words]
    assert (codes & (1 << maxent._WORD_BITS) - 1).tolist() == short
    assert (starts == found.starts).all() and (keys == found.keys).all() and not len(maxent._coded(coder, [])[0])

    counted = {}
    for rows in maxent._count_rows(iter([pd.DataFrame({"text": odd}), pd.DataFrame({"text": []}), pd.DataFrame({"text": odd})])):
        for key, leaf, n in rows.itertuples(index=False):
            assert leaf == counted.get(key, (leaf, 0))[0]
            counted[key] = leaf, counted.get(key, (leaf, 0))[1] + n
    tally = Counter(words)
    assert counted == {maxent._key(w): (maxent._shared_leaf(w), 2 * n) for w, n in tally.items()}

    # Words are hashed by the batch, not by a call for each.
    asked, plain_hash = [], maxent.xxhash.xxh64_intdigest
    monkeypatch.setattr(maxent.xxhash, "xxh64_intdigest", lambda word: asked.append(word) or plain_hash(word))
    texts = [b" ".join(b"word%06d" % (i * 50 + j) for j in range(50)) for i in range(40)]
    list(maxent._count_rows(iter([pd.DataFrame({"text": texts})])))
    maxent._coded(coder, texts)
    assert not asked
