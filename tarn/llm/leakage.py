"""Evaluation passages in training text, by Wu-Manber multi-pattern search.

Texts are compared by letters and digits only, after NFKC and lower-casing. Any passage of PASSAGE characters of an item holds
one of the item's blocks of half that length that start at its multiples; those blocks are the patterns. A table over hashed
blocks of three characters tells how far the search may shift; where it may not, the suffix-hash bucket gives the patterns to
compare directly, and a pattern found is extended both ways to see if the whole passage is there. Many cursors of one flat
text advance together, and hits are compared as matrices, each distinct block once.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from tarn.session import cut_lineage, spread

PASSAGE = 50
TABLE_BITS = 20
STRETCH = 128
#: Stands between items; no text has it. Between texts stands 0, which no item has.
BETWEEN = 0xFFFFFFFF
#: Pairs of a place in a text and one in an item that are compared at once.
AT_ONCE = 20_000
#: Characters of items in one block of patterns (about 60 bytes of tables each); more items are searched in further blocks.
BLOCK_CHARACTERS = 4_000_000
KEEP = regex.compile(r"[^\p{L}\p{N}]+")


def letters_and_digits(text: str) -> str:
    return KEEP.sub("", unicodedata.normalize("NFKC", text).lower())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hash(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hash of blocks of three characters, for the shift table and the suffix buckets."""
    h = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77) ^ c * np.uint32(0xC2B2AE3D)
    return (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - TABLE_BITS)


class Patterns:
    """Shift table and suffix buckets of the half-passage blocks of items."""

    def __init__(self, items: list[tuple], passage: int = PASSAGE) -> None:
        self.passage, self.m = passage, passage // 2
        m = self.m
        self.keys, parts, places, owner = [], [np.full(passage, BETWEEN, np.uint32)], [], []
        size = passage
        for key, text in items:
            points = _points(letters_and_digits(text))
            if len(points) < passage:
                continue
            starts = size + np.arange(0, len(points) - m + 1, m)
            places.append(starts)
            owner += [len(self.keys)] * len(starts)
            self.keys.append(key)
            parts += [points, np.full(passage, BETWEEN, np.uint32)]
            size += len(points) + passage
        self.flat = np.concatenate(parts)  # all items, apart by a mark that no text has
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        rows = self.flat[place[:, None] + np.arange(m)]
        # each distinct block once, with the places (of items) it stands at
        self.rows, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        by_row = np.argsort(which, kind="stable")
        self.place, self.owner = place[by_row], np.array(owner, np.int64)[by_row]
        self.first = np.searchsorted(which[by_row], np.arange(len(self.rows) + 1))
        self.shift = np.full(1 << TABLE_BITS, m - 2, np.int32)
        for end in range(2, m):
            np.minimum.at(self.shift, _hash(*(self.rows[:, end - k] for k in (2, 1, 0))), m - 1 - end)
        suffix = _hash(*(self.rows[:, m - 1 - k] for k in (2, 1, 0))).astype(np.int64)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]

    def search(self, texts: list[str]) -> list[set]:
        """Keys of the items of which each normalised text holds a passage."""
        if not len(self.rows):
            return [set() for _ in texts]
        points = [_points(t) for t in texts]
        length = np.array([len(p) + 1 for p in points])
        start = self.passage + np.cumsum(length) - length
        flat = np.zeros(int(length.sum()) + 2 * self.passage, np.uint32)
        for s, p in zip(start, points):
            flat[s : s + len(p)] = p
        m = self.m
        cursor = np.arange(m - 1, len(flat), STRETCH)
        stop = np.minimum(cursor + STRETCH, len(flat))
        ends, buckets = [], []
        while len(cursor):
            h = _hash(flat[cursor - 2], flat[cursor - 1], flat[cursor])
            step = self.shift[h]
            ends.append(cursor[step == 0])
            buckets.append(h[step == 0])
            cursor = cursor + np.maximum(step, 1)
            live = cursor < stop
            cursor, stop = cursor[live], stop[live]
        found: set[int] = set()
        ends, buckets = np.concatenate(ends), np.concatenate(buckets)
        for begin, row in _expanded(ends - m + 1, *np.searchsorted(self.suffix, (buckets, buckets + 1))):
            row = self.order[row]
            same = self.rows[row, 0] == flat[begin]
            begin, row = begin[same], row[same]
            same = (self.rows[row] == flat[begin[:, None] + np.arange(m)]).all(1)
            self._extend(flat, begin[same], row[same], start, found)
        out: list[set] = [set() for _ in texts]
        for pair in found:
            out[pair // len(self.keys)].add(self.keys[pair % len(self.keys)])
        return out

    def _extend(self, flat: np.ndarray, begin: np.ndarray, row: np.ndarray, start: np.ndarray, found: set[int]) -> None:
        """Adds text * items + item of those places of blocks found round which the whole passage stands."""
        need, m = self.passage - self.m, self.m
        back, on = -1 - np.arange(need), m + np.arange(need)
        for begin, at in _expanded(begin, self.first[row], self.first[row + 1]):
            pair = (np.searchsorted(start, begin, side="right") - 1) * len(self.keys) + self.owner[at]
            new = ~np.isin(pair, np.fromiter(found, np.int64, len(found)))
            begin, place, pair = begin[new], self.place[at[new]], pair[new]
            left = _equal(flat[begin[:, None] + back], self.flat[place[:, None] + back])
            right = _equal(flat[begin[:, None] + on], self.flat[place[:, None] + on])
            found.update(pair[left + right >= need].tolist())


def _expanded(value: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each value with every number from low to high, in parts of about AT_ONCE."""
    count = high - low
    value, low, count = value[count > 0], low[count > 0], count[count > 0]
    total = np.cumsum(count)
    for at in range(0, int(total[-1]) if len(total) else 0, AT_ONCE):
        k = np.arange(at, min(at + AT_ONCE, int(total[-1])))
        i = np.searchsorted(total, k, side="right")
        yield value[i], low[i] + k - (total[i] - count[i])


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of the rows of two matrices."""
    return np.logical_and.accumulate(a == b, axis=1).sum(1)


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple]]:
    """Items in blocks of bounded size; the driver holds one at a time."""
    block, size = [], 0
    for k, t in items.select(key, text).where(F.col(key).isNotNull() & F.col(text).isNotNull()).distinct().orderBy(key).toLocalIterator():
        block.append((k, t))
        size += len(t)
        if size >= BLOCK_CHARACTERS:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(documents: DataFrame, doc: str, text: str, items: DataFrame, item: str, item_text: str, passage: int = PASSAGE) -> DataFrame:
    """Distinct (doc, item) where the document holds at least passage letters and digits in a row of the item's text.

    Null and empty texts and null keys match nothing, items of fewer letters and digits neither; repeated rows count once;
    either table may be empty; texts are searched whole. Items go to the executors in blocks of bounded size, and all
    documents are searched once for each block.
    """
    rows = documents.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where(F.col("doc").isNotNull() & (F.length("text") >= 1))
    rows = spread(rows)
    kinds = dict(rows.dtypes)["doc"], dict(items.dtypes)[item]

    def run(block: list[tuple]):
        def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            patterns = None
            for batch in batches:
                patterns = patterns or Patterns(block, passage)
                out = []
                for at in range(0, len(batch), 4000):
                    part = batch.iloc[at : at + 4000]
                    hits = patterns.search([letters_and_digits(t) for t in part["text"]])
                    out += [(d, i) for d, found in zip(part["doc"], hits) for i in found]
                yield pd.DataFrame(out, columns=["doc", "item"])

        return searched

    schema = f"doc {kinds[0]}, item {kinds[1]}"
    source = _blocks(items, item, item_text)
    first, second = next(source, []), next(source, None)
    if second is None:
        out = rows.mapInPandas(run(first), schema)
    else:
        out = None
        for block in chain((first, second), source):  # each is searched, and what it gives is written, before the driver takes the next
            part = cut_lineage(rows.mapInPandas(run(block), schema))
            out = part if out is None else out.unionByName(part)
    return out.distinct().withColumnsRenamed({"doc": doc, "item": item})
