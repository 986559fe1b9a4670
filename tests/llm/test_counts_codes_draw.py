"""Token counts against the library on whole texts, vector codes and draws against plain definitions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tidegauge.llm import queries, resampling, token_counts, vector_codes
from tests.llm.conftest import FOLDER

pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path(queries.COUNTED_BY)


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    return lambda text: len(own.encode(text, add_special_tokens=False))


# Token counts

ODD = [
    "", " ", "a <|endoftext|> b<|endoftext|>c", "<|endoftext|>", "< |endoftext|>", "x  y \n z \x1c \x85 w",
    "it's  we'll\n\n\nI'd 12a b34 's 's", "日本、語。本 当。 ok", "a\r\n b\t c\x0b d", "😀 é́ ß", "word. \"The\" (end) ]",
]


def test_odd_texts_are_counted_as_the_library_does(path, library):
    own = token_counts.Counter(path)
    assert own.cuts
    assert own.count(ODD) == [library(t) for t in ODD]
    assert own.count(ODD + ODD) == 2 * [library(t) for t in ODD]  # from memory


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\t\x1c ab1'.,\"])é日。、<|>_", max_size=40))
def test_cut_pieces_are_encoded_apart(text):
    import public_tokenizers

    own = token_counts.counter(public_tokenizers.path(queries.COUNTED_BY))
    whole = own.lengths([text])[0]
    assert own.count([text]) == [whole]


def test_long_texts_with_and_without_safe_boundaries(path, library):
    many = "Some words, and more of them.\n" * 20_000
    texts = [many, "a" * 300_000, " " * 200_000 + "x" + "\n" * 200_000, "日本語" * 60_000, None, "é!" * 100_000]
    assert token_counts.Counter(path).count([t or "" for t in texts]) == [library(t or "") for t in texts]
    assert len(list(token_counts._stretches(many))) > 4 and "".join(token_counts._stretches(many)) == many


def test_memory_is_bounded(path, monkeypatch, library):
    monkeypatch.setattr(token_counts, "_KNOWN", 5)
    monkeypatch.setattr(token_counts, "_BATCH", 20)
    texts = [f"w{i} of {i * 7} and more" for i in range(50)]
    own = token_counts.Counter(path)
    assert own.count(texts) == [library(t) for t in texts] and len(own.known) <= 30


def test_other_tokenizers_get_whole_texts(spark, edge_docs):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    words, pieces = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "piece_bpe_32k.model"))
    texts = ["Hello  world", " a b", "", "x " * 100]
    for file, count in (
        (words, lambda t, own=Tokenizer.from_file(words): len(own.encode(t, add_special_tokens=False))),
        (pieces, lambda t, own=sentencepiece.SentencePieceProcessor(model_file=pieces): len(own.encode(t))),
    ):
        own = token_counts.Counter(file)
        assert not own.cuts and own.count(texts) == [count(t) for t in texts]


def test_counts_of_the_table(spark, corpus, path, library):
    rows = queries.op11_token_counts(spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in corpus.collect()}
    assert len(rows) == corpus.count()
    for r in rows:
        text = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), library(text))
        assert r["over_limit"] == (r["n_tokens"] > 1024)


def test_counts_of_odd_rows(spark, edge_docs, no_docs, path, library):
    shown = token_counts.count_tokens(edge_docs.withColumn("N_Tokens", F.lit("x")), path, 3)
    assert shown.columns[-3:] == ["n_bytes", "n_tokens", "over_limit"] and "N_Tokens" not in shown.columns
    got = sorted((r["text"] or "", r["n_tokens"], r["over_limit"]) for r in shown.collect())
    want = sorted((t := r["text"] or "", n := library(t), n > 3) for r in edge_docs.collect())
    assert got == want
    assert token_counts.count_tokens(no_docs, path, 3).count() == 0


# Vector codes

def _nearest(part, entries):
    far = [sum((int(a) - int(b)) ** 2 for a, b in zip(part, e)) for e in entries]
    return far.index(min(far)), min(far)


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8])
def test_walsh_rows_are_ordered_by_changes_of_sign(width):
    n = vector_codes._padded(width)
    rows = vector_codes.walsh(np.eye(n, dtype=np.int64)).T  # row s: coefficient s of each unit vector
    assert [int((np.diff(r) != 0).sum()) for r in rows] == list(range(n))
    assert (rows @ rows.T == n * np.eye(n)).all()


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_nearest_is_exact_with_ties(data):
    width = data.draw(st.integers(1, 6))
    size = data.draw(st.sampled_from([3, 1000, 2**40, 2**150]))
    row = st.lists(st.integers(-size, size), min_size=width, max_size=width)
    parts = data.draw(st.lists(row, min_size=1, max_size=12))
    entries = data.draw(st.lists(row, min_size=1, max_size=6))
    entries += entries[:1]
    entry, far = vector_codes.nearest(np.array(parts, dtype=object), np.array(entries, dtype=object))
    assert [(int(e), int(f)) for e, f in zip(entry, far)] == [_nearest(p, entries) for p in parts]


def _codes(rows, width):
    """[(id, label, vector)] -> {id: (code, error)} and the books, in plain Python."""
    kept = [(i, l, [math.floor(4096 * x) for x in v] + [0] * (8 * width - len(v))) for i, l, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, _, v in kept[:16]] for p in range(8)]
    for _ in range(6):
        for p in range(8):
            groups = defaultdict(list)
            for _, _, v in kept:
                groups[_nearest(part(v, p), books[p])[0]].append(part(v, p))
            for e, own in groups.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out = []
    for i, l, v in kept:
        found = [_nearest(part(v, p), books[p]) for p in range(8)]
        out.append((i, l, "".join(f"{e:02x}" for e, _ in found), sum(f for _, f in found)))
    labels = Counter()
    for _, l, _, error in out:
        labels[l] += error
    shown = ",".join(str(x) for book in books for e in book for x in e)
    return sorted([(i, l, c, e, labels[l]) for i, l, c, e in out], key=str), hashlib.sha256(shown.encode()).hexdigest()


SCHEMA = "vec_id bigint, embedding array<double>, label int, code string, error int"


def _compressed(spark, rows):
    frame = spark.createDataFrame([(i, v, l, "x", 1) for i, l, v in rows], SCHEMA)
    got, books = vector_codes.compress(frame)
    return sorted(map(tuple, got.collect()), key=str), books.sha256()


def test_codes_of_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(k, None if k % 5 == 0 else k % 2, [rng.gauss(0, 1) for _ in range(16)]) for k in range(60)]
    rows += [(7, 1, [0.0] * 16), (8, 1, rows[8][2]), (None, None, [1.0] * 16), (100, 3, None), (101, 3, [None] + [0.5] * 15),
             (102, 3, [float("nan")] * 16), (103, 3, [float("inf")] + [0.0] * 15), (104, 0, []), (105, 0, [0.25] * 13)]
    assert _compressed(spark, rows) == _codes(rows, 2)


def test_codes_of_huge_components_and_few_rows(spark):
    rows = [(1, 0, [3e7, -2e9] + [0.0] * 14), (2, 0, [2.5e7] * 16), (3, None, [-1e-9] * 16)]
    assert _compressed(spark, rows) == _codes(rows, 2)
    rows += [(4, 1, [1e300] + [0.0] * 15)] + [(k, 1, [float(k)] * 16) for k in range(5, 20)] + [(20, 2, [9e299] * 16)]
    got, digest = _compressed(spark, rows)
    want, expected = _codes(rows, 2)
    fits = [(i, l, c, e if e < 2**63 else None) for i, l, c, e, _ in want]
    assert digest == expected and [r[:4] for r in got] == fits


def test_codes_of_an_empty_table_and_of_the_whole_one(spark):
    got, _ = vector_codes.compress(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns == ["vec_id", "label", "code", "error", "label_error"]
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    assert queries.op12_vector_codes(spark, FOLDER).count() == rows.count()


# Resampling

def _words(text):
    out, word = [], ""
    for c in brute.lowered(text) + " ":
        if c.isascii() and not c.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def _runs(text, longest):
    w = _words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def _drawn(docs, target, buckets=10_000, longest=1, min_words=20, percent=10):
    """[(id, text)] -> sorted rows (id, n_features, weight, score, rank)."""
    own, aim = Counter(), Counter()
    for _, t in docs:
        own.update(b % buckets for b in _runs(t, longest))
    for t in target:
        aim.update(b % buckets for b in _runs(t, longest))
    total, goal = sum(own.values()) + buckets, sum(aim.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * total / ((own[b] + 1) * goal)))
    rows = []
    for i, t in docs:
        f = [b % buckets for b in _runs(t, longest)]
        weight = math.floor(sum(map(gain, f)) / len(f)) if f else 0
        h = int(brute.sha(f"2024:{'' if i is None else i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([i, len(f), weight, score, None, len(_words(t)) >= min_words])
    fit = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0], r[2], r[1]))
    for place, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = place + 1
    return sorted([tuple(r[:5]) for r in rows], key=str)


def _rows(frame):
    return sorted([tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()], key=str)


def test_draw_of_the_table(spark, corpus):
    target = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = _drawn([(r["doc_id"], r["text"]) for r in corpus.collect()], target)
    assert _rows(queries.op13_resampling(spark, FOLDER)) == want


def test_runs_of_words_are_hashed_by_their_text():
    texts = ["One two three two three", None, "", "é日x-é日x é日x", "a", "One two", "x" * 3000 + " y" * 3000]
    for longest in (1, 2, 3):
        got = Counter()
        for owner, bucket in resampling.features(pa.array(texts), 10_007, longest):
            assert (np.diff(owner) >= 0).all()
            got.update(zip(owner.tolist(), bucket.tolist()))
        want = Counter((i, b % 10_007) for i, t in enumerate(texts) for b in _runs(t, longest))
        assert got == want


def test_draw_of_odd_rows(spark, edge_docs, no_docs, monkeypatch):
    target = spark.createDataFrame([("one word word",), (None,), ("the a 3 é",)], "text string")
    aim = [r["text"] for r in target.collect()]
    docs = edge_docs.withColumns({"weight": F.lit("w"), "Rank": F.lit("r")})
    plain = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    monkeypatch.setattr(resampling, "_BLOCK", 3)
    for longest, low in ((1, 1), (2, 2)):
        found = resampling.weighted(docs, target, buckets=50, longest=longest)
        got = resampling.draw(found.drop("text"), min_words=low, percent=40)
        assert _rows(got) == _drawn(plain, aim, 50, longest, low, 40)
    nothing = resampling.weighted(no_docs, target)
    assert resampling.draw(nothing).count() == 0
    empty = resampling.weighted(docs, target.limit(0))
    assert _rows(resampling.draw(empty)) == _drawn(plain, [])


def test_ties_are_drawn_by_id(spark):
    rows = [(i, 30, 30, w) for i, w in [(5, 1)] * 4 + [(9, 1), (2, 1), (None, 1), (3, 1)]]
    frame = spark.createDataFrame(rows, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
    monkey = resampling.noise
    try:
        resampling.noise = lambda key, seed: F.lit(0).cast("long")
        got = resampling.draw(frame, percent=70).collect()
    finally:
        resampling.noise = monkey
    drawn = sorted((r["rank"], r["doc_id"]) for r in got if r["rank"])
    assert drawn == [(1, 2), (2, 3), (3, 5), (4, 5), (5, 5)] and len(got) == 8


def test_resampled_documents_come_whole(spark, corpus):
    target = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = resampling.resample(corpus, target)
    drawn = queries.op13_resampling(spark, FOLDER).where("rank is not null")
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in drawn.collect())
    assert set(corpus.columns) <= set(got.columns)
