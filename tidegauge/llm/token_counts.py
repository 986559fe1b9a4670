"""Token counts: texts go to Python in Arrow batches, the tokenizer's own library encodes them in batches of
balanced bytes, and only lengths come back.

A tokenizer that works on the bytes of the text as it is (byte-level, no normaliser) splits a text into matches
of a fixed pattern before it merges anything, and no match runs from a letter, a digit or a closing mark into a
space or a line end. Such a place is a safe boundary: what stands on its two sides is encoded apart. Long texts
are cut there into stretches, and stretches into short pieces; a piece that a worker has seen is not encoded
again, its length is remembered in a memory of bounded size. A run without any safe boundary stays whole, however
long it is. Other tokenizers (with a normaliser, with word pieces) get whole texts.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegauge.llm.common import quoted, small_batches

_CUT = re.compile(r"""(?<=[\w.,;:!?)"'\]])(?=[ \n])""")
_STRETCH = 65_536  # characters after which a long text is cut at the next safe boundary
_BATCH = 1_000_000  # characters that the library gets at once
_SHORT = 48  # characters up to which the length of a piece is remembered
_KNOWN = 400_000  # pieces that a worker remembers


def _stretches(text: str) -> Iterator[str]:
    """A text in stretches of bounded size, cut at safe boundaries; longer ones only where there is none."""
    at = 0
    while len(text) - at > 2 * _STRETCH:
        cut = _CUT.search(text, at + _STRETCH)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Counter:
    """Numbers of tokens of texts, by one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
        self.lengths, self.cuts = _library(path)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        """One number a text, in order. Batches of unknown pieces are closed by their size, not their number."""
        totals = [0] * len(texts)
        waiting: dict[str, list[int]] = {}
        size = 0
        for i, text in enumerate(texts):
            for piece in self._pieces(text):
                n = self.known.get(piece)
                if n is not None:
                    totals[i] += n
                elif piece in waiting:
                    waiting[piece].append(i)
                else:
                    waiting[piece] = [i]
                    size += len(piece)
            if size >= _BATCH:
                self._settle(waiting, totals)
                waiting, size = {}, 0
        self._settle(waiting, totals)
        return totals

    def _pieces(self, text: str) -> Iterator[str]:
        if not self.cuts:
            yield text
            return
        for stretch in _stretches(text):
            yield from _CUT.split(stretch)

    def _settle(self, waiting: dict[str, list[int]], totals: list[int]) -> None:
        pieces = list(waiting)
        at = 0
        while at < len(pieces):
            stop, size = at, 0
            while stop < len(pieces) and (stop == at or size + len(pieces[stop]) <= _BATCH):
                size += len(pieces[stop])
                stop += 1
            for piece, n in zip(pieces[at:stop], self.lengths(pieces[at:stop])):
                for i in waiting[piece]:
                    totals[i] += n
                if len(piece) <= _SHORT:
                    self.known[piece] = n
            at = stop
        if len(self.known) > _KNOWN:
            self.known.clear()


def _library(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """A function from texts to numbers of tokens, and whether texts may be cut at safe boundaries."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)], False
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return lambda texts: [len(e) for e in own.encode_batch_fast(texts, add_special_tokens=False)], _cuts_are_safe(path)


def _cuts_are_safe(path: str) -> bool:
    """Whether a tokenizer file takes texts as they are, splits them by the byte-level pattern, and has no
    added token that a cut could fall into or that takes the spaces around it."""
    with open(path, encoding="utf-8") as file:
        layout = json.load(file)
    split = layout.get("pre_tokenizer") or {}
    return (
        layout.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space", True)
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"[ \n]", t["content"])
                    for t in layout.get("added_tokens") or []))


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def n_tokens(text: Column, path: str) -> Column:
    """Numbers of tokens of a text column, without begin, end or added special tokens; strings of special
    tokens inside a text are what the library takes them for by default. Null counts as empty."""
    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for batch in batches:
            yield pa.array(own.count([t or "" for t in batch.to_pylist()]), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, path: str, limit: int, text_col: str = "text") -> DataFrame:
    """The documents with `n_bytes` (of the text in UTF-8), `n_tokens` and `over_limit` (more tokens than
    `limit`). `path` is a tokenizer file that executors have at the same place: `.json` of tokenizers, `.model` of
    sentencepiece.

    Nothing is shuffled; no row is added or removed, repeated rows stay. Null and empty texts have no bytes and no
    tokens. Columns that have one of the three names already are replaced."""
    small_batches(docs.sparkSession)
    text = quoted(text_col).cast("string")
    made = docs.select(
        *[quoted(c) for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")],
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), n_tokens(text, path).alias("n_tokens"))
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
