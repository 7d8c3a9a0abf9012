"""Byte-level BPE of a whole corpus by batched numpy merge rounds.

The distinct new words of a batch lie in one flat array of symbols. Each round finds the lowest-ranked pair of every word at
once (binary search of pair keys in the sorted key table, a segmented minimum), merges it wherever it stands in its word, and
looks up only the pairs that changed. Words that are done leave the array.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from tarn.session import spread

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern by which this family of vocabularies cuts text into words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NONE = np.int32(2**31 - 1)
#: Words kept with their ids in a worker, and symbols in one flat array.
KNOWN_WORDS, FLAT = 400_000, 300_000


def _byte_letters() -> dict[str, int]:
    """The printable character that the vocabulary file writes for each byte: itself if printable, else counted from 256."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Sorted keys of mergeable pairs with rank and merged id, and the id of each byte."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        self.byte_id = np.zeros(256, np.int64)
        for letter, byte in _byte_letters().items():
            self.byte_id[byte] = vocabulary[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.arange(len(pairs), dtype=np.int32)[order]
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)  # by rank
        self._forget()
        self.cut = regex.compile(PATTERN)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word (not empty)."""
        raw = [w.encode("utf8", "surrogatepass") for w in words]
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(raw[i]))  # words of about one length are done in about one round
        start = 0
        while start < len(order):
            end, size = start, 0
            while end < len(order) and (size == 0 or size + len(raw[order[end]]) <= FLAT):
                size += len(raw[order[end]])
                end += 1
            self._rounds([raw[i] for i in order[start:end]], order[start:end], out)
            start = end
        return out

    def _rounds(self, raw: list[bytes], names: list[int], out: list) -> None:
        symbols = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        length = np.array([len(w) for w in raw])
        name = np.array(names)
        rank = np.full(len(symbols), NONE, np.int32)
        if len(symbols) > 1:
            rank[:-1] = self.rank(symbols[:-1], symbols[1:])
        rank[np.cumsum(length) - 1] = NONE
        while len(length):
            start = np.cumsum(length) - length
            least = np.minimum.reduceat(rank, start)
            done = least == NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[name[i]] = symbols[start[i] : start[i] + length[i]].astype(np.int32)
                keep = np.repeat(~done, length)
                symbols, rank, length, name, least = symbols[keep], rank[keep], length[~done], name[~done], least[~done]
                if not len(length):
                    return
            at = np.flatnonzero(rank == np.repeat(least, length))
            touching = np.diff(at, prepend=-2) == 1
            if touching.any():  # a pair of equal symbols in a row: every second place, from the left
                first = np.maximum.accumulate(np.where(touching, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            word = np.searchsorted(np.cumsum(length), at, side="right")
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            length = length - np.bincount(word, minlength=len(length))
            new = at - np.arange(len(at))
            symbols, rank = symbols[keep], rank[keep]
            last = np.zeros(len(symbols), bool)
            last[np.cumsum(length) - 1] = True
            changed = np.concatenate([new, new - 1])
            changed = changed[changed >= 0]
            inner = changed[~last[changed]]
            rank[changed] = NONE
            rank[inner] = self.rank(symbols[inner], symbols[inner + 1])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offset of each text): the ids of a text are those of its words; none for null and empty texts."""
        cut = [self.cut.findall(t) if t else [] for t in texts]
        if len(self.words) > KNOWN_WORDS:
            self._forget()
        known = self.words
        words = list(chain.from_iterable(cut))
        if new := [w for w in dict.fromkeys(words) if w not in known]:
            ids = self.encode_words(new)
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.pool = np.concatenate([self.pool, *ids])
            self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum([len(i) for i in ids])]
        word = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        size = self.starts[word + 1] - self.starts[word]
        ends = np.r_[0, np.cumsum(size)]
        at = np.repeat(self.starts[word] - ends[:-1], size) + np.arange(ends[-1])
        return self.pool[at], ends[np.r_[0, np.cumsum([len(c) for c in cut], dtype=np.int64)]]

    def _forget(self) -> None:
        self.words: dict[str, int] = {}  # word to its place in starts
        self.pool, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)


@lru_cache(2)
def merges(path: str) -> Merges:
    return Merges(path)


def encoded(df: DataFrame, key: str, text: str, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(key, ids array<int>) of every row, without special tokens.

    Null and empty texts have an empty list, never null; blank ones the ids of their blanks. The text of a special token is
    ordinary text. Rows stay as often as they stand in df; null keys too. The vocabulary file is sent to the executors.
    """
    df.sparkSession.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)
    rows = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text")))
    kind = dict(rows.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(SparkFiles.get(name))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                ids, offsets = model.encode(part["text"].to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part["key"], lists], ["key", "ids"])

    return rows.mapInArrow(run, f"key {kind}, ids array<int>").withColumnRenamed("key", key)
