"""Language model scores from a hashed maximum-entropy model.

A word's probability has three factors: its class and its leaf in the class, both given the words before it,
and the word in its leaf. Classes and leaves come from the vocabulary: each of the most frequent words is a leaf of
its own, all others share leaves by their endings (class) and beginnings (leaf). The first two factors are
softmaxes over hashed features: the last word (an n-gram feature), the last but one (a skip), and both together;
for the leaf, each of them with the class.

Weights are trained by distributed gradient updates. Each synchronised round takes its own part of the documents;
tasks walk their documents in small batches from the current weights, and their updates are averaged per feature,
weighted by how often each task saw it. The number of rounds and the number of hash buckets grow with the corpus;
a task's update is a fixed share of the text that it has read, so that all rounds together send in proportion to the corpus.

Counts of words cover the whole training corpus and stay a table. The most frequent words, at most `HEAD`, are
broadcast with their counts; all others meet the table in a join. The last factor and the plain scores need them.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidegauge.llm.common import quoted, small_batches, stored

END = b"\n"  # no word has white space
HEAD = 200_000  # words that are broadcast at most
CLASSES = 32  # and as many leaves in each
FREQUENT = 8  # classes whose leaves are single words
LEAVES = CLASSES * CLASSES
FEATURES = 3  # kinds, for each of the two softmaxes
LEAST_BUCKETS, MOST_BUCKETS = 4096, 16384  # of each kind of feature
_TOKENS_A_BUCKET = 512
_TOKENS_A_ROUND = 50_000_000
_TOKENS_A_TASK = 2_500_000
STEP = 1.5
_CHUNK = 32_768  # tokens of a gradient step
_CACHED = 2_048  # tokens whose logits stay in a core's cache
_TURNED = 512  # buckets whose sums are turned into rows at once
_ENDS = 100_000  # beginnings or endings of words whose hash a worker remembers
_AT_ONCE = 65_536  # tokens that are hashed at once
_BLOCKS = 64  # parts in which updates are averaged
_WORD_BITS = 24  # of a word's hash in its code; 0 stands for nothing before
_MARKS = b".,;:!?|\"'()"
_STRIPPED = np.isin(np.arange(256), list(_MARKS))
# Of xxh64 and xxh32 as published.
_PRIMES_64 = tuple(map(np.uint64, (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)))
_PRIMES_32 = tuple(map(np.uint32, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x165667B1)))


def _key(word: bytes) -> int:
    """Signed 64-bit hash, the identity of a word."""
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


class _Remembered(dict):
    """A function of few short pieces of words, called once for each."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, piece: bytes) -> int:
        if len(self) >= _ENDS:
            self.clear()
        value = self[piece] = self.of(piece)
        return value


_OF_ENDING = _Remembered(lambda piece: (FREQUENT + xxhash.xxh32_intdigest(piece) % (CLASSES - FREQUENT)) * CLASSES)
_OF_BEGINNING = _Remembered(lambda piece: xxhash.xxh32_intdigest(piece) % CLASSES)


def _shared_leaf(word: bytes) -> int:
    """The leaf of a word that has none of its own: class by ending, leaf by beginning; `_Tokens` finds those of a batch."""
    word = word.strip(_MARKS)
    return _OF_ENDING[word[-3:]] + _OF_BEGINNING[word[:2]]


def tokens(text: bytes | None) -> list[bytes]:
    """The tokens of one text; `_Tokens` finds those of a batch."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    bits = 8 * x.itemsize
    return x << x.dtype.type(by) | x >> x.dtype.type(bits - by)


class _Tokens:
    """All tokens of a batch of texts, as places in one array of lower-case bytes in which each text is followed by
    its end token. `keys` are their `_key`s, `starts` the first token of each text."""

    def __init__(self, texts):
        texts = [t or b"" for t in texts]
        joined = (END.join(texts) + END * bool(texts)).lower()
        self.bytes = np.frombuffer(joined + b" " * (24 - len(joined) % 8), np.uint8)
        self.lanes = self.bytes.view("<u8")
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(END)
        ends = np.cumsum(sizes) - 1
        text = self.bytes[: len(joined)]
        space = (text - np.uint8(9) < 5) | (text == 32)
        after = np.concatenate([[True], space])
        begins = ~space & after[:-1]
        begins[ends] = True
        self.at = np.flatnonzero(begins)
        last = np.searchsorted(self.at, ends)
        words = np.ones(len(self.at), bool)
        words[last] = False
        self.size = np.ones(len(self.at), np.int64)
        self.size[words] = np.flatnonzero(space & ~after[:-1]) - self.at[words]
        self.starts = np.concatenate([[0], last[:-1] + 1]) if texts else last
        self.keys = np.empty(len(self.at), np.int64)
        for a in range(0, len(self.at), _AT_ONCE):
            part = slice(a, a + _AT_ONCE)
            self.keys[part] = self._hashes(self.at[part], self.size[part]).view(np.int64)
        for i in np.flatnonzero(self.size >= 32):
            self.keys[i] = _key(self.bytes[self.at[i] : self.at[i] + self.size[i]].tobytes())

    def _lane(self, at: np.ndarray) -> np.ndarray:
        """Eight bytes from each place on; a shift by all 64 bits leaves none."""
        own, bits = at >> 3, (at.astype(np.uint64) & np.uint64(7)) << np.uint64(3)
        return self.lanes[own] >> bits | self.lanes[own + 1] << np.uint64(64) - bits

    def _hashes(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """xxh64 of runs of less than 32 bytes."""
        p1, p2, p3, p4, p5 = _PRIMES_64
        h = size.astype(np.uint64) + p5
        for done in (0, 8, 16):
            some = np.flatnonzero(size >= done + 8)
            lane = _rotated(self._lane(at[some] + done) * p2, 31) * p1
            h[some] = _rotated(h[some] ^ lane, 27) * p1 + p4
        some = np.flatnonzero(size & 4)
        half = self._lane(at[some] + (size[some] & ~7)) & np.uint64(0xFFFFFFFF)
        h[some] = _rotated(h[some] ^ half * p1, 23) * p2 + p3
        for done in range(3):
            some = np.flatnonzero(size & 3 > done)
            byte = self.bytes[at[some] + (size[some] & ~3) + done].astype(np.uint64)
            h[some] = _rotated(h[some] ^ byte * p5, 11) * p1
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        return h ^ h >> np.uint64(32)

    def _short_hashes(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """xxh32 of runs of less than 4 bytes."""
        p1, p2, p3, p5 = _PRIMES_32
        h = size.astype(np.uint32) + p5
        for done in range(3):
            some = np.flatnonzero(size > done)
            h[some] = _rotated(h[some] + self.bytes[at[some] + done] * p5, 11) * p1
        h = (h ^ h >> np.uint32(15)) * p2
        h = (h ^ h >> np.uint32(13)) * p3
        return h ^ h >> np.uint32(16)

    def shared_leaves(self, which: np.ndarray) -> np.ndarray:
        """`_shared_leaf` of some tokens."""
        first, end = self.at[which], self.at[which] + self.size[which]
        some = np.flatnonzero(_STRIPPED[self.bytes[end - 1]])
        while len(some):
            end[some] -= 1
            some = some[end[some] > first[some]]
            some = some[_STRIPPED[self.bytes[end[some] - 1]]]
        some = np.flatnonzero((end > first) & _STRIPPED[self.bytes[first]])
        while len(some):
            first[some] += 1
            some = some[_STRIPPED[self.bytes[first[some]]]]
        ending, beginning = np.minimum(end - first, 3), np.minimum(end - first, 2)
        kind = FREQUENT + self._short_hashes(end - ending, ending).astype(np.int64) % (CLASSES - FREQUENT)
        return kind * CLASSES + self._short_hashes(first, beginning).astype(np.int64) % CLASSES


@dataclasses.dataclass
class Vocabulary:
    """Sorted broadcast part and the totals; `rest` is the table of all other counts."""

    keys: np.ndarray
    counts: np.ndarray
    leaves: np.ndarray
    total: int
    distinct: int
    leaf_total: np.ndarray
    leaf_distinct: np.ndarray
    rest: DataFrame

    @property
    def buckets(self) -> int:
        wanted = 1 << max(self.total // _TOKENS_A_BUCKET, 1).bit_length()
        return min(max(wanted, LEAST_BUCKETS), MOST_BUCKETS)

    @property
    def rounds(self) -> int:
        """Two, and one more for each doubling of the corpus from two rounds' tokens on."""
        return 2 + max(0, int(math.log2(max(self.total, 1) / (2 * _TOKENS_A_ROUND))) + 1 if self.total > 2 * _TOKENS_A_ROUND else 0)


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = _Tokens(batch["text"])
        order = np.argsort(found.keys)
        keys = found.keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        yield pd.DataFrame({
            "key": keys[first], "leaf": found.shared_leaves(order[first]).astype(np.int32),
            "n": np.diff(np.append(first, len(keys)))})


def count_words(texts: DataFrame, head: int = HEAD) -> Vocabulary:
    """Counts all words of `texts` (column text, binary). The head takes whole bands of counts from the top
    as long as they fit, so that it is bounded whatever the corpus."""
    counts = stored(texts.mapInPandas(_count_rows, "key bigint, leaf int, n bigint").groupBy("key").agg(
        F.min("leaf").alias("leaf"), F.sum("n").alias("n")), "words")
    band = F.floor(F.log2("n") * 16).cast("int")
    bands = {r["band"]: r for r in counts.groupBy(band.alias("band")).agg(
        F.count("*").alias("words"), F.sum("n").alias("n")).collect()}
    room, lowest = head, None
    for b in sorted(bands, reverse=True):
        room -= bands[b]["words"]
        if room < 0:
            break
        lowest = b
    table = (counts.where(band >= lowest) if lowest is not None else counts.where("false")).toArrow()
    keys, n, leaves = (table[c].to_numpy() for c in ("key", "n", "leaf"))
    order = np.argsort(keys, kind="stable")
    keys, n, leaves = keys[order], n[order], leaves[order].astype(np.int64)
    # Frequent words are dealt to the classes in turn, so that none of them holds the bulk of the corpus.
    single = np.lexsort((keys, -n))[: FREQUENT * CLASSES]
    place = np.arange(len(single))
    own = place % FREQUENT * CLASSES + place // FREQUENT
    shared = leaves[single].copy()
    leaves[single] = own
    leaf_total, leaf_distinct = np.zeros(LEAVES, np.int64), np.zeros(LEAVES, np.int64)
    for r in counts.groupBy("leaf").agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect():
        leaf_total[r["leaf"]], leaf_distinct[r["leaf"]] = r["n"], r["words"]
    for i, was, now in zip(single, shared, own):
        leaf_total[was] -= n[i]
        leaf_distinct[was] -= 1
        leaf_total[now] += n[i]
        leaf_distinct[now] += 1
    rest = counts.where(band < lowest) if lowest is not None else counts
    return Vocabulary(
        keys, n, leaves, int(leaf_total.sum()), int(leaf_distinct.sum()), leaf_total, leaf_distinct, rest.select("key", "n"))


class _Coder:
    """Tokens to numbers with their hash, leaf and place in the head plus 1. A word of the head is found from the
    first one with the same leading bits, of which there are few."""

    def __init__(self, keys: np.ndarray, leaves: np.ndarray):
        plain = keys.view(np.uint64)
        order = np.argsort(plain)
        bits = max(len(keys), 1).bit_length()
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(plain[order], np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.keys = np.append(plain[order], np.uint64(2**64 - 1))
        codes = self._short(plain) | leaves << _WORD_BITS | np.arange(1, len(keys) + 1) << _WORD_BITS + 10
        self.codes = np.append(codes[order], 0)

    def __getitem__(self, word: bytes) -> int:
        return int(self.coded(_Tokens([word]))[0])

    @staticmethod
    def _short(keys: np.ndarray) -> np.ndarray:
        return 1 + ((keys >> np.uint64(20)) % np.uint64((1 << _WORD_BITS) - 1)).astype(np.int64)

    def coded(self, found: _Tokens) -> np.ndarray:
        keys = found.keys.view(np.uint64)
        codes = np.empty(len(keys), np.int64)
        for a in range(0, len(keys), _AT_ONCE):
            part = keys[a : a + _AT_ONCE]
            place = self.first[part >> self.shift]
            some = np.flatnonzero(self.keys[place] < part)
            while len(some):
                place[some] += 1
                some = some[self.keys[place[some]] < part[some]]
            codes[a : a + _AT_ONCE] = np.where(self.keys[place] == part, self.codes[place], 0)
        rest = np.flatnonzero(codes == 0)
        codes[rest] = self._short(keys[rest]) | found.shared_leaves(rest) << _WORD_BITS
        return codes


def _leaf_of(codes: np.ndarray) -> np.ndarray:
    return codes >> _WORD_BITS & LEAVES - 1


def _place_of(codes: np.ndarray) -> np.ndarray:
    return codes >> _WORD_BITS + 10


def _features(codes: np.ndarray, starts: np.ndarray, buckets: int) -> np.ndarray:
    """(2, FEATURES, tokens): rows of the weights for the class, and for the leaf in the token's class."""
    word = codes & (1 << _WORD_BITS) - 1
    one, two = np.zeros_like(word), np.zeros_like(word)
    one[1:], two[2:] = word[:-1], word[:-2]
    one[starts] = 0
    two[starts] = 0
    second = starts + 1
    two[second[second < len(two)]] = 0
    kind = (_leaf_of(codes) // CLASSES + 1) * 0x2545F4914F6CDD1D
    out = np.empty((2, FEATURES, len(codes)), np.int32)
    for i, context in enumerate((one, two, one * 0x9E3779B1 + two + (1 << 60))):
        hashed = (context + i) * -0x61C8864680B583EB
        for level, h in enumerate((hashed, hashed + kind)):
            h = (h ^ h >> 29 & 0x7FFFFFFFF) * 0x1CE4E5B9
            out[level, i] = (h >> 31 & buckets - 1) + (level * FEATURES + i) * buckets
    return out


def _logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Unnormalised log weights, one row per token; `bias` is one row, or one per token."""
    z = np.take(weights, rows[0], axis=0)
    for feature in rows[1:]:
        z += np.take(weights, feature, axis=0)
    z += bias
    return np.clip(z, -30, 30, out=z)


def _log_share(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log probability of each token's wanted column."""
    z = _logits(weights, bias, rows)
    own = z[np.arange(len(wanted)), wanted]
    np.exp(z, out=z)
    return own - np.log(z.sum(axis=1))


def _coded(coder: _Coder, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, the first token of each text, and keys."""
    found = _Tokens(texts)
    return coder.coded(found), found.starts, found.keys


@dataclasses.dataclass
class Model:
    """Weights of both softmaxes, rows of the class first; their biases are the plain shares."""

    weights: np.ndarray
    class_bias: np.ndarray
    leaf_bias: np.ndarray

    @classmethod
    def untrained(cls, vocabulary: Vocabulary) -> Model:
        leaf = vocabulary.leaf_total.reshape(CLASSES, CLASSES) + 1.0
        kind = leaf.sum(axis=1)
        return cls(
            np.zeros((2 * FEATURES * vocabulary.buckets, CLASSES), np.float32),
            np.log(kind / kind.sum()).astype(np.float32), np.log(leaf / kind[:, None]).astype(np.float32))

    @property
    def buckets(self) -> int:
        return len(self.weights) // (2 * FEATURES)

    def log_shares(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log probability of each token's leaf."""
        rows, leaf, out = _features(codes, starts, self.buckets), _leaf_of(codes), np.empty(len(codes))
        for at in range(0, len(codes), _CACHED):
            part = slice(at, at + _CACHED)
            kind, place = leaf[part] // CLASSES, leaf[part] % CLASSES
            out[part] = _log_share(self.weights, self.class_bias, rows[0, :, part], kind)
            out[part] += _log_share(self.weights, self.leaf_bias[kind], rows[1, :, part], place)
        return out

    def learn(self, codes: np.ndarray, starts: np.ndarray, seen: np.ndarray) -> None:
        rows, leaf = _features(codes, starts, self.buckets), _leaf_of(codes)
        for at in range(0, len(codes), _CHUNK):
            part = slice(at, at + _CHUNK)
            kind, place = leaf[part] // CLASSES, leaf[part] % CLASSES
            _descend(self.weights, self.class_bias, rows[0, :, part], kind, seen, self.buckets)
            _descend(self.weights, self.leaf_bias, rows[1, :, part], place, seen, self.buckets, kind)


def _descend(
    weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, wanted: np.ndarray, seen: np.ndarray, buckets: int,
    kind: np.ndarray | None = None,
) -> None:
    """One gradient step on a batch; the step of a feature shrinks with the square root of its count. Each of the
    `rows` falls in one block of `buckets` weights, which is summed column by column. `bias` is one row, or with `kind`
    the rows to choose from. The slopes are made in parts that stay in the cache, and widened once for all sums."""
    columns = np.empty((bias.shape[-1], len(wanted)))
    for at in range(0, len(wanted), _CACHED):
        part = slice(at, at + _CACHED)
        slope = _logits(weights, bias if kind is None else bias[kind[part]], rows[:, part])
        np.exp(slope, out=slope)
        slope *= (-1 / slope.sum(axis=1))[:, None]
        slope[np.arange(len(slope)), wanted[part]] += 1
        columns[:, part] = slope.T
    for feature in rows:
        first = int(feature[0]) // buckets * buckets
        block, bucket = slice(first, first + buckets), feature.astype(np.int64) - first
        count = np.bincount(bucket, minlength=buckets).astype(np.float32)
        seen[block] += count
        step = STEP / np.sqrt(np.maximum(seen[block] * count, 1))
        sums = np.empty((len(columns), buckets), np.float32)
        for out, column in zip(sums, columns):
            out[:] = np.bincount(bucket, column, buckets)
        for at in range(0, buckets, _TURNED):
            some = slice(at, at + _TURNED)
            weights[first + at : first + at + _TURNED] += (sums[:, some] * step[some]).T


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int) -> Model:
    """The model after all rounds. `texts` has columns text (binary) and part, the round that uses the row. What
    comes to the driver in a round is one average of the weights, a fixed size."""
    spark = texts.sparkSession
    model = Model.untrained(vocabulary)
    per_block = len(model.weights) // _BLOCKS
    tasks = 1 + int(vocabulary.total / rounds / _TOKENS_A_TASK)
    coded = spark.sparkContext.broadcast((vocabulary.keys, vocabulary.leaves))
    for turn in range(rounds):
        now = spark.sparkContext.broadcast(model)

        def updates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            coder, start = _Coder(*coded.value), now.value
            own = dataclasses.replace(start, weights=start.weights.copy())
            seen = np.zeros(len(own.weights), np.float32)
            for batch in batches:
                codes, starts, _ = _coded(coder, batch["text"])
                if len(codes):
                    own.learn(codes, starts, seen)
            for b in range(_BLOCKS if seen.any() else 0):
                part = slice(b * per_block, (b + 1) * per_block)
                change = (own.weights[part] - start.weights[part]).astype(np.float16)
                yield pd.DataFrame({"block": [b], "change": [change.tobytes()], "seen": [seen[part].tobytes()]})

        def mean(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, weight = np.zeros((per_block, CLASSES)), np.zeros(per_block)
            block = None
            for batch in rows:
                for b, change, seen in zip(batch["block"], batch["change"], batch["seen"]):
                    n = np.frombuffer(seen, np.float32)
                    total += np.frombuffer(change, np.float16).reshape(per_block, CLASSES) * n[:, None]
                    weight += n
                    block = b
            mixed = (total / np.maximum(weight, 1)[:, None]).astype(np.float32)
            yield pd.DataFrame({"block": [block], "change": [mixed.tobytes()]})

        parts = texts.where(F.col("part") == turn).select("text").coalesce(tasks).mapInPandas(
            updates, "block int, change binary, seen binary")
        averaged = parts.groupBy("block").applyInPandas(mean, "block int, change binary")
        weights = model.weights.copy()
        for r in averaged.collect():
            weights[r["block"] * per_block : (r["block"] + 1) * per_block] += np.frombuffer(
                r["change"], np.float32).reshape(per_block, CLASSES)
        model = dataclasses.replace(model, weights=weights)
    return model


def score(docs: DataFrame, train_rows, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None) -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score and score, both log10.

    `train_rows` is a condition (column) on the documents that the model learns from. Words are runs
    without ASCII white space, A-Z lower-cased; each text ends with one end token. A null text counts as
    empty and has that token only. Words are told apart by 64-bit hashes. Every row gives a row, repeated ones too.
    """
    small_batches(docs.sparkSession)
    text = F.encode(F.coalesce(quoted(text_col).cast("string"), F.lit("")), "UTF-8")
    learn = docs.where(train_rows)
    vocabulary = count_words(learn.select(text.alias("text")))
    turns = rounds or vocabulary.rounds
    part = F.pmod(F.xxhash64(text, quoted(id_col)), F.lit(turns))
    return apply(docs, vocabulary, train(learn.select(text.alias("text"), part.alias("part")), vocabulary, turns), id_col, text_col)


def apply(docs: DataFrame, vocabulary: Vocabulary, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores documents: head words where they are read, all others by a join with the counts."""
    spark = docs.sparkSession
    total, distinct = vocabulary.total, vocabulary.distinct
    room = (vocabulary.leaf_total + vocabulary.leaf_distinct + 1).astype(float)
    in_leaf = np.log10((vocabulary.counts + 1) / room[vocabulary.leaves])
    base = np.log10((vocabulary.counts + 1) / (total + distinct + 1))
    sent = spark.sparkContext.broadcast((vocabulary.keys, vocabulary.leaves, in_leaf, base, model))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, leaves, in_leaf, base, model = sent.value
        coder = _Coder(keys, leaves)
        for batch in batches:
            codes, starts, word_keys = _coded(coder, batch["text"])
            if not len(codes):
                continue
            leaf, place, plain = _leaf_of(codes), _place_of(codes), np.zeros(len(codes))
            shares = model.log_shares(codes, starts) / np.log(10)
            known = place > 0
            shares[known] += in_leaf[place[known] - 1]
            plain[known] = base[place[known] - 1]
            sizes = np.diff(np.append(starts, len(codes)))
            rest = [np.flatnonzero(~known[a : a + s]) for a, s in zip(starts, sizes)]
            yield pd.DataFrame({
                "id": batch["id"], "n_tokens": sizes, "head_known": np.add.reduceat(known.astype(np.int64), starts),
                "head_base": np.add.reduceat(plain, starts), "head_score": np.add.reduceat(shares, starts),
                "rest": [word_keys[a + r] for a, r in zip(starts, rest)],
                "rest_leaf": [leaf[a + r].astype(np.int16) for a, r in zip(starts, rest)]})

    small_batches(docs.sparkSession)
    text = F.encode(F.coalesce(quoted(text_col).cast("string"), F.lit("")), "UTF-8")
    inputs = docs.select(quoted(id_col).alias("id"), text.alias("text"))
    seen = inputs.mapInPandas(
        rows, f"id {dict(inputs.dtypes)['id']}, n_tokens bigint, head_known bigint, head_base double, head_score double, "
              "rest array<bigint>, rest_leaf array<smallint>")
    seen = stored(seen.withColumn("row", F.monotonically_increasing_id()), "scored")
    pairs = F.arrays_zip(F.col("rest").alias("key"), F.col("rest_leaf").alias("leaf"))
    each = seen.where(F.size("rest") > 0).select("row", F.explode(pairs).alias("t")).select("row", "t.key", "t.leaf")
    rooms = F.array(*[F.lit(float(r)) for r in room])
    met = each.join(vocabulary.rest.withColumnRenamed("n", "_n"), "key", "left")
    n = F.coalesce("_n", F.lit(0)) + 1
    sums = met.groupBy("row").agg(
        F.count("_n").alias("known"), F.sum(F.log10(n / F.lit(float(total + distinct + 1)))).alias("base"),
        F.sum(F.log10(n / F.element_at(rooms, F.col("leaf") + 1))).alias("model"))
    whole = seen.drop("rest", "rest_leaf").join(sums, "row", "left")
    return whole.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("head_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("base", F.lit(0.0))).alias("base_score"),
        (F.col("head_score") + F.coalesce("model", F.lit(0.0))).alias("score"))
