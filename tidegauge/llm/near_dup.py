"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct five-word shingles. Documents with one set form a class, and
everything below works on classes. A sketch (Dahlgaard, Knudsen and Thorup, 2017) throws the whole set into
its coordinates round after round, the value being the round and a hash; a coordinate still empty after as
many rounds as there are coordinates is filled by a round of its own. So every coordinate is filled, the
work is near the size of the set, and the share of equal coordinates is concentrated around the similarity.

Classes that agree on all coordinates of a band meet in a bucket. A bucket links its members to its
smallest one, not to each other; links are confirmed on the full sets, and confirmed links are contracted.
Only buckets that then still hold several components compare members across these (see `_rest_links`),
the large ones in blocks or after prefix filtering, which lose no pair either.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidegauge.llm.common import fresh, quoted, small_batches, stored

SHINGLE = 5
SIMILAR = 75  # per cent of the union
ROWS = 6  # coordinates of a band
BANDS = 48
COORDS = ROWS * BANDS
# With these, two sets of similarity 0.75 miss all bands once in 12,000 pairs, of 0.8 once in 2 million.

_WORDS = 300_000  # words whose hash a worker remembers
_MEMBERS = 16  # of a bucket that compares its members directly
_BLOCK = 128  # members, or strangers, that are compared in one group
_FREQUENT = 20_000  # shingles that are put last in the order of prefixes
_HASH_WORD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHash()


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or b"").lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
    each = np.fromiter(map(_hashes.__getitem__, words), np.uint64, n)
    rows = each[: n - SHINGLE + 1].copy()
    for i in range(1, SHINGLE):
        rows *= np.uint64(_HASH_WORD)
        rows += each[i : n - SHINGLE + 1 + i]
        rows ^= rows >> np.uint64(29)
    return np.unique(_mix(rows))


@functools.cache
def _salts(t: int) -> np.ndarray:
    return _mix(np.arange(1, 2 * t + 1, dtype=np.uint64) * np.uint64(_HASH_WORD))


def sketch(values: np.ndarray, t: int = COORDS) -> np.ndarray:
    """The t coordinates of a non-empty set: round and hash of the smallest value of each."""
    salts, n = _salts(t), len(values)
    out = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    done, at_once = 0, max(1, -(-8 * t // n))
    while done < t and (out == np.iinfo(np.uint64).max).any():
        stop = min(t, done + at_once)
        thrown = _mix(values[None, :] ^ salts[done:stop, None])
        place = ((thrown >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        key = (np.arange(done, stop, dtype=np.uint64)[:, None] << np.uint64(32)) | (thrown & np.uint64(0xFFFFFFFF))
        key |= place << np.uint64(48)
        key = np.sort(key, axis=None)
        place = (key >> np.uint64(48)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        new = first[out[place[first]] == np.iinfo(np.uint64).max]
        out[place[new]] = key[new] & np.uint64((1 << 48) - 1)
        done = stop
    for j in np.flatnonzero(out == np.iinfo(np.uint64).max):
        out[j] = (np.uint64(t + j) << np.uint64(32)) | (_mix(values ^ salts[t + j]).min() >> np.uint64(32))
    return out


def band_keys(coords: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different bands apart."""
    bands = coords.reshape(-1, rows)
    keys = np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(_HASH_WORD)
    for i in range(rows):
        keys = _mix(keys ^ bands[:, i]) * np.uint64(_HASH_WORD)
    return _mix(keys)


def similar(a: np.ndarray, b: np.ndarray, per_cent: int = SIMILAR) -> bool:
    """100 * intersection >= per_cent * union, both sets non-empty and sorted."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < per_cent * large:
        return False
    both = np.concatenate((a, b))
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= per_cent * (small + large - shared)


def _sketch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes, classes, bands = [], [], []
        for text in batch["text"]:
            values = shingles(text)
            sizes.append(len(values))
            classes.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
            bands.append(band_keys(sketch(values)).view(np.int64) if len(values) else None)
        yield pd.DataFrame({
            "id": batch["id"], "text_key": batch["text_key"], "n_shingles": sizes, "class": classes, "bands": bands})


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last: tuple[bytes | None, np.ndarray] = (None, np.empty(0, np.uint64))
    for batch in batches:
        kept = []
        for mine, hub in zip(batch["text_a"], batch["text_b"]):
            if hub != last[0]:
                last = hub, shingles(hub)
            kept.append(similar(shingles(mine), last[1]))
        yield batch.loc[kept, ["a", "b"]]


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those that are similar by their full sets."""
    mine = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    hubs = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(mine, "a").join(hubs, "b")
    return both.mapInPandas(_verified, "a bigint, b bigint")


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) of `labels` after more links between nodes: what they connect shares a label. Links
    are turned into links between labels first, so that only these are contracted. Each round every
    label joins its smallest neighbour; from the second round on, smallest is by a hash of the round, which
    shortens chains by a constant factor. Links that are left are written each round."""
    links = stored(_between(links, labels).select(
        F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(), "links")
    if links.isEmpty():
        return labels
    turn, left = 0, True
    while left:
        order = F.col("v") if turn == 0 else F.xxhash64(F.lit(turn), F.col("v"))
        ends = links.select("a", F.col("b").alias("v")).unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("v")))
        ends = ends.unionAll(ends.select("a", F.col("a").alias("v")))
        joined = stored(ends.groupBy("a").agg(F.min(F.struct(order.alias("o"), F.col("v"))).alias("m")).select(
            F.col("a").alias("old"), F.col("m.v").alias("new")), "joined")
        labels = labels.join(joined, F.col("label") == F.col("old"), "left").select(
            "node", F.coalesce("new", "label").alias("label"))
        of_a, of_b = (joined.select(F.col("old").alias(k), F.col("new").alias(f"new_{k}")) for k in "ab")
        links = links.join(of_a, "a").join(of_b, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
        links = stored(links.where("a != b").distinct(), "links")
        turn, left = turn + 1, not links.isEmpty()
    return stored(labels, "labels")


def _between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) whose nodes have different labels, with these."""
    a, b = (labels.select(F.col("node").alias(k), F.col("label").alias(f"label_{k}")) for k in "ab")
    return pairs.select("a", "b").join(a, "a").join(b, "b").where("label_a != label_b")


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share a key and differ in their label, from rows (key, node, label)."""
    left = rows.select("key", F.col("node").alias("a"), F.col("label").alias("label_a"))
    right = rows.select("key", F.col("node").alias("b"), F.col("label").alias("label_b"))
    return left.join(right, "key").where("a > b and label_a != label_b").select("a", "b").distinct()


def _block_links(key, strangers: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """Confirmed links of strangers to members, as many as join different components: a pair whose
    components are joined by now needs no look."""
    root: dict[int, int] = {}

    def find(label: int) -> int:
        while root.setdefault(label, label) != label:
            label = root[label]
        return label

    sets = [shingles(text) for text in members["text"]]
    found = []
    for node, label, text in zip(strangers["node"], strangers["label"], strangers["text"]):
        own = shingles(text)
        for other, its, values in zip(members["node"], members["label"], sets):
            a, b = find(label), find(its)
            if a != b and similar(own, values):
                found.append((node, other))
                root[a] = b
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _across(strangers: DataFrame, members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between strangers and members of the same group in different components, from rows (group,
    node, label). Members lie in blocks and strangers in chunks of bounded size, every chunk meets every
    block of its group, and the full sets are compared there: no row is made for a pair."""
    asked = strangers.groupBy("group").agg(F.count("*").alias("asking"))
    sizes = members.groupBy("group").agg(F.count("*").alias("n")).join(asked, "group")
    sizes = stored(sizes.select(
        "group", F.ceil(F.col("n") / _BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("asking") / _BLOCK).cast("int").alias("chunks")), "group_sizes")

    def dealt(nodes: DataFrame, own: str, all_of: str) -> DataFrame:
        place = F.pmod(F.xxhash64("node"), F.col(own + "s")).cast("int")
        spread = nodes.join(sizes, "group").withColumn(own, place).withColumn(
            all_of, F.explode(F.sequence(F.lit(0), F.col(all_of + "s") - 1)))
        # Both sides of the cogroup need columns of their own.
        own_texts = texts.select(F.col("node").alias("node"), F.col("text").alias("text"))
        return spread.join(own_texts, "node").select(
            *[F.col(c).alias(c) for c in ("group", "block", "chunk", "node", "label", "text")])

    keys = ["group", "block", "chunk"]
    return dealt(strangers, "chunk", "block").groupBy(*keys).cogroup(
        dealt(members, "block", "chunk").groupBy(*keys)).applyInPandas(_block_links, "a bigint, b bigint")


def _frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shingles found more than once in a batch, with their counts."""
    for batch in batches:
        found = [shingles(text) for text in batch["text"]]
        values, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64),) * 2
        yield pd.DataFrame({"key": values[n > 1].view(np.int64), "n": n[n > 1].astype(np.int64)})


def _prefixes(texts: DataFrame) -> DataFrame:
    """(key, node, label) for a part of each set of `texts` (node, label, text) in which two similar sets
    always meet: of n shingles in an order that is the same for all sets, the first n - ceil(0.75 n) + 1.
    The order puts frequent shingles last. Any order gives the same pairs in the end, so that the list
    of frequent ones may be cut to a size that can be broadcast."""
    counts = texts.mapInPandas(_frequent, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= _MEMBERS).orderBy(F.desc("n"), "key").limit(_FREQUENT).collect()
    frequent = texts.sparkSession.sparkContext.broadcast(np.array(sorted(r["key"] for r in top), np.int64).view(np.uint64))

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, sizes = [], []
            for text in batch["text"]:
                values = shingles(text)
                common = np.isin(values, frequent.value)
                size = len(values) - -(-SIMILAR * len(values) // 100) + 1
                keys.append(np.concatenate((values[~common], values[common]))[:size])
                sizes.append(size)
            yield pd.DataFrame({
                "key": np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64),
                "node": np.repeat(batch["node"].to_numpy(), sizes), "label": np.repeat(batch["label"].to_numpy(), sizes)})

    return texts.mapInPandas(first, "key bigint, node bigint, label bigint")


def _rest_links(members: DataFrame, labels: DataFrame, texts: DataFrame, tried: DataFrame) -> DataFrame:
    """Links between bucket members that are still in different components; `tried` pairs are known.

    Small buckets compare all such members. In a large bucket in which most members are one component
    already, the others are compared with that component, and with each other if they are many, in blocks.
    A large bucket without such a component, as a passage that many documents share makes it, passes a
    finer sieve first: the prefixes of the full sets, in which no similar pair is missed.
    """
    named = members.join(labels, "node").select(F.col("bucket").alias("key"), "node", "label")
    sizes = named.groupBy("key", "label").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("key").agg(
        F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("m"), F.count("*").alias("k")).where("k > 1")
    mixed = mixed.select(
        "key", "size", F.col("m.label").alias("main"), (F.col("size") - F.col("m.n")).alias("others"),
        (2 * F.col("m.n") >= F.col("size")).alias("led"))
    open_ = stored(named.join(mixed, "key"), "open")
    large, few = F.col("size") > _MEMBERS, F.col("others") <= _MEMBERS
    strangers = open_.where(large & F.col("led") & (F.col("label") != F.col("main")))
    led = stored(strangers.select(F.col("main").alias("group"), "node", "label").distinct(), "strangers")
    own = labels.join(led.select(F.col("group").alias("label")).distinct(), "label")
    with_main = _across(led, own.select(F.col("label").alias("group"), "node", "label"), texts)
    many = stored(strangers.where(~few).select(F.col("key").alias("group"), "node", "label"), "many")
    among = _across(many, many, texts)
    sieve = texts.join(open_.where(large & ~F.col("led")).select("node", "label").distinct(), "node")
    sieved = _cross_pairs(stored(_prefixes(stored(sieve, "sieve")), "prefixes"))
    direct = open_.where(~large).unionAll(strangers.where(few)).select("key", "node", "label")
    pairs = stored(_cross_pairs(direct).unionAll(sieved).distinct(), "pairs")
    tested = _confirm(pairs.join(tried, ["a", "b"], "left_anti"), texts)
    return with_main.unionAll(among).unionAll(tested)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links) and kept.

    Words are runs without ASCII white space, A-Z lower-cased; with fewer than five, the whole sequence is
    the one shingle. A document without words, or with a null text, links with nothing and is its own
    component. Rows that repeat a text share a component; null ids lose against any other, and a component
    of null ids keeps its rows. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    text = quoted(text_col).cast("string")
    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.encode(text, "UTF-8").alias("text"))
    kind = dict(rows.dtypes)["id"]
    seen = stored(rows.mapInPandas(
        _sketch_rows, f"id {kind}, text_key bigint, n_shingles bigint, class binary, bands array<bigint>"), "sketches")
    classes = seen.where("class is not null").groupBy("class").agg(
        F.min("id").alias("first_id"), F.min(F.struct("id", "text_key")).alias("one"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    spread = classes.select("node", F.explode("bands").alias("bucket"))
    hubs = spread.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    members = stored(spread.join(hubs.select("bucket", "hub"), "bucket"), "members")
    stars = stored(members.where("node != hub").groupBy(F.col("node").alias("a"), F.col("hub").alias("b")).agg(
        F.count("*").alias("shared")), "stars")
    wanted = members.select("node").distinct().join(classes.select("node", "one"), "node").select(
        "node", F.col("one.id").alias("_id"), F.col("one.text_key").alias("_key"))
    texts = rows.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("node", "text")
    texts = stored(texts.dropDuplicates(["node"]), "texts")

    # First each class with the hub it shares most bands with, then the hubs that are still apart.
    best = stars.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    best = stored(best, "best")
    labels = components(classes.select("node", F.col("node").alias("label")), _confirm(best, texts))
    other = _between(stars.select("a", "b").join(best, ["a", "b"], "left_anti"), labels)
    labels = components(labels, _confirm(other, texts))
    rest = _rest_links(members.select("bucket", "node"), labels, texts, stars.select("a", "b"))
    labels = components(labels, rest)

    lowest = labels.join(classes.select("node", "first_id"), "node")
    lowest = lowest.groupBy("label").agg(F.min("first_id").alias("component_id"))
    of_class = labels.join(lowest, "label").join(classes.select("node", "class"), "node").select("class", "component_id")
    result = seen.select("id", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return result.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one of each component, with all their columns. Ids name documents: rows that share
    an id stay together if one of them stays, also where their texts differ."""
    other = fresh(docs, "keep_id")
    stay = near_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias(other)).distinct()
    return docs.join(stay, F.col(other).eqNullSafe(quoted(id_col)), "left_semi")
