"""Language identification by a bidirectional gated recurrent network over bytes.

A minimal gated unit reads the UTF-8 bytes of a window in both directions; every position is labelled from
the two states that meet there, and a document's probabilities are the means over all its positions. Long
texts are read in windows of fixed length, so memory does not depend on them. Training is in numpy by
backpropagation through time, on a bounded sample of labelled documents that comes to the driver.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from tidegauge.llm.common import fresh, quoted, small_batches

WINDOW = 128  # bytes read as one sequence
SAMPLE_PER_LANGUAGE = 400  # documents; the bound of the training sample
FEW_LANGUAGES = 4096  # up to here the counts by language are broadcast, beyond they are joined by a shuffle
TRAIN_BYTES = 96  # of a sampled document that are trained on
HIDDEN = 16
STEPS = 220
BATCH = 96
RATE = 0.02
SEED = 7
UNKNOWN = "und"

_PAD = 256
_AT_ONCE = 512


@dataclasses.dataclass
class Network:
    """table: per direction and byte the inputs of gate and candidate; recur_*: per direction."""

    languages: list[str]
    table: np.ndarray  # 2, 257, 2 * HIDDEN
    recur_gate: np.ndarray  # 2, HIDDEN, HIDDEN
    recur_new: np.ndarray
    out: np.ndarray  # 2 * HIDDEN, languages
    bias: np.ndarray


def _run(net: Network, side: int, ids: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each step of one direction; ids are (time, sequences). Padding leaves the state.

    The gate is (h W + x) / 4 + 1/2, cut to [0, 1]; its scale and offset are put into the weights first. Every step
    works in the same few arrays, unless they are kept for the way back."""
    steps, n = ids.shape
    quarter, half, one = np.float32(0.25), np.float32(0.5), np.float32(1)
    gate_x = net.table[side][:, :HIDDEN] * quarter + half
    new_x = np.ascontiguousarray(net.table[side][:, HIDDEN:])
    gate_w, new_w = net.recur_gate[side] * quarter, net.recur_new[side]
    states = np.empty((steps, n, HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    x, gate, mixed, new, step = (np.empty((n, HIDDEN), np.float32) for _ in range(5))
    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        if keep is not None:
            gate, mixed, new = (np.empty((n, HIDDEN), np.float32) for _ in range(3))
        np.matmul(h, gate_w, out=gate)
        gate += gate_x.take(ids[t], axis=0, out=x, mode="clip")
        np.minimum(gate, one, out=gate)
        np.maximum(gate, np.float32(0), out=gate)
        np.multiply(gate, h, out=mixed)
        np.matmul(mixed, new_w, out=new)
        new += new_x.take(ids[t], axis=0, out=x, mode="clip")
        np.minimum(new, one, out=new)
        np.maximum(new, -one, out=new)
        if keep is not None:
            keep.append((t, h, gate, new, mixed))
        np.subtract(new, h, out=step)
        step *= gate
        h = np.add(h, step, out=states[t])
    return states


def _positions(net: Network, ids: np.ndarray) -> np.ndarray:
    """Probabilities of every language at every position: (languages, time, sequences)."""
    logits = net.bias[:, None]
    for side, weights in enumerate((net.out[:HIDDEN], net.out[HIDDEN:])):
        logits = logits + weights.T @ _run(net, side, ids).reshape(-1, HIDDEN).T
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits.reshape(-1, *ids.shape)


def _start(languages: list[str], rng: np.random.Generator) -> Network:
    def small(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = Network(
        languages, small(2, 257, 2 * HIDDEN, scale=0.3), small(2, HIDDEN, HIDDEN, scale=0.2),
        small(2, HIDDEN, HIDDEN, scale=0.25), small(2 * HIDDEN, len(languages), scale=0.1),
        np.zeros(len(languages), np.float32))
    _close_padding(net)
    return net


def _close_padding(net: Network) -> None:
    net.table[:, _PAD, :HIDDEN] = -1e6  # the gate is shut whatever the state
    net.table[:, _PAD, HIDDEN:] = 0


def _gradients(net: Network, ids: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy over all positions, by backpropagation through time."""
    kept: list[list] = [[], []]
    states = [_run(net, side, ids, kept[side]) for side in (0, 1)]
    both = np.concatenate(states, axis=2)
    logits = both @ net.out + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    p[:, np.arange(ids.shape[1]), labels] -= 1
    real = (ids != _PAD)[:, :, None]
    p *= real / np.float32(max(1, real.sum()))
    flat = both.reshape(-1, both.shape[2])
    grads = {"out": flat.T @ p.reshape(-1, p.shape[2]), "bias": p.sum(axis=(0, 1))}
    back = p @ net.out.T
    table, gate_g, new_g = (np.zeros_like(a) for a in (net.table, net.recur_gate, net.recur_new))
    for side in (0, 1):
        dh = np.zeros((ids.shape[1], HIDDEN), np.float32)
        for t, h, gate, new, mixed in reversed(kept[side]):
            dh = dh + back[t, :, side * HIDDEN : (side + 1) * HIDDEN]
            dnew = dh * gate * ((new > -1) & (new < 1))
            dmixed = dnew @ net.recur_new[side].T
            dgate = (dh * (new - h) + dmixed * h) * ((gate > 0) & (gate < 1)) * np.float32(0.25)
            gate_g[side] += h.T @ dgate
            new_g[side] += mixed.T @ dnew
            np.add.at(table[side], ids[t], np.concatenate((dgate, dnew), axis=1))
            dh = dh * (1 - gate) + dmixed * gate + dgate @ net.recur_gate[side].T
    return grads | {"table": table, "recur_gate": gate_g, "recur_new": new_g}


def fit(windows: list[bytes], labels: list[str], steps: int = STEPS, seed: int = SEED) -> Network:
    """Trains on byte windows, every position labelled with its document's language (Adam)."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    net = _start(languages, rng)
    if len(languages) < 2:
        return net
    by_label = [[w for w, l in zip(windows, labels) if l == name] for name in languages]
    names = ("table", "recur_gate", "recur_new", "out", "bias")
    first, second = ({n: np.zeros_like(getattr(net, n)) for n in names} for _ in range(2))
    for step in range(1, steps + 1):
        y = rng.integers(len(languages), size=BATCH)
        chosen = []
        for label in y:
            w = by_label[label][rng.integers(len(by_label[label]))]
            length = int(rng.integers(8, TRAIN_BYTES + 1))
            at = int(rng.integers(max(1, len(w) - length + 1)))
            chosen.append(w[at : at + length])
        grads = _gradients(net, _matrix(chosen, TRAIN_BYTES), y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for n in names:
            g = grads[n] * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.98 * second[n] + 0.02 * g * g
            move = (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.98**step)) + 1e-8)
            setattr(net, n, (getattr(net, n) - rate * move).astype(np.float32))
        _close_padding(net)
    return net


def _matrix(pieces: list[bytes], width: int) -> np.ndarray:
    """(time, sequences) of byte numbers, padded at the end."""
    out = np.full((len(pieces), width), _PAD, np.int64)
    for i, piece in enumerate(pieces):
        out[i, : len(piece)] = np.frombuffer(piece, np.uint8)
    return np.ascontiguousarray(out.T)


def predict(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its probability, the mean over all positions, of non-empty texts."""
    totals = np.zeros((len(texts), len(net.languages)))
    pieces: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        ids = _matrix(pieces, min(WINDOW, max(map(len, pieces))))
        p = _positions(net, ids)
        p *= ids != _PAD
        np.add.at(totals, owners, p.sum(axis=1).T)
        pieces.clear()
        owners.clear()

    for i in sorted(range(len(texts)), key=lambda j: len(texts[j])):
        for at in range(0, len(texts[i]), WINDOW):
            pieces.append(texts[i][at : at + WINDOW])
            owners.append(i)
            if len(pieces) == _AT_ONCE:
                flush()
    if pieces:
        flush()
    means = totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-12)
    best = means.argmax(axis=1)
    return best, np.minimum(means[np.arange(len(texts)), best], 1.0)


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Network:
    """A network from the rows with a text and a language. At most `per_language` documents per language,
    drawn by a hash of the key, and at most 1024 bytes of each come to the driver."""
    text, lang, key = (quoted(c) for c in (text_col, lang_col, key_col))
    known = docs.where(text.isNotNull() & lang.isNotNull() & (F.length(text) > 0))
    counts = known.groupBy(lang.cast("string").alias("_lang")).agg(F.count("*").alias("_n"))
    draw = F.pmod(F.xxhash64(F.lit(SEED), key), F.lit(1 << 30))
    rows = known.select(lang.cast("string").alias("_lang"), draw.alias("_draw"), F.encode(text.cast("string"), "UTF-8").alias("_b"))
    few = counts.limit(FEW_LANGUAGES + 1).collect()
    if len(few) <= FEW_LANGUAGES:
        counts = F.broadcast(docs.sparkSession.createDataFrame(few, counts.schema))
    likely = rows.join(counts, "_lang").where(
        F.col("_draw") < F.lit(2.0 * per_language * (1 << 30)) / F.col("_n"))
    size = F.length("_b")
    at = F.pmod(F.col("_draw"), F.greatest(size - 1023, F.lit(1))).cast("int") + 1
    cut = likely.select("_lang", "_draw", F.substring("_b", at, F.lit(1024)).alias("_b"))
    first = W.partitionBy("_lang").orderBy("_draw", "_b")
    sample = cut.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= per_language)
    found = sample.orderBy("_lang", "_at").collect()
    return fit([bytes(r["_b"]) for r in found], [r["_lang"] for r in found])


def identify(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """The documents with `lang_pred` and `score`. A null text, or one without a letter, is `und` with score
    0; so is every text if no language was learned. No row is added or removed; columns of these names are
    replaced."""
    small_batches(docs.sparkSession)
    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = np.full(len(batch), UNKNOWN, dtype=object)
            scores = np.zeros(len(batch))
            real = [i for i, t in enumerate(batch) if t]
            if real and net.languages:
                best, p = predict(net, [batch.iloc[i] for i in real])
                names[real] = [net.languages[b] for b in best]
                scores[real] = p
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    text = quoted(text_col).cast("string")
    lettered = F.when(text.rlike(r"\p{L}"), F.encode(text, "UTF-8"))
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    both = fresh(docs, "label")
    marked = docs.withColumn(both, label(lettered))
    return marked.select(*[quoted(c) for c in names], F.col(f"{both}.lang_pred"), F.col(f"{both}.score"))
