"""Free-entered names mapped to a reference list.

A trie holds every reference entry with its alias paths (variant characters, other or no class ending, kana, Latin letters);
a Levenshtein automaton with transpositions walks it and returns all entries within a distance that depends on the length.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tarn.llm.automaton import automaton
from tarn.llm.spelling import fold, hiragana, latin, romaji
from tarn.operators.packed import tokenize
from tarn.session import cut_lineage, scatter

#: Endings for kinds of mountains with their readings, words that typists add to a name.
ENDINGS = {"山": "やま", "森": "もり", "峰": "みね", "岳": "だけ", "塚": "つか", "丸": "まる"}
READINGS = ("やま", "さん", "ざん", "もり", "みね", "だけ", "たけ", "つか", "づか", "まる")
BEFORE = ("紅葉の", "久しぶりの", "新緑の", "雨上がりの", "早朝の", "残雪の", "初冬の", "初夏の", "真夏の", "晩秋の", "雪の", "夜の", "朝の", "春の", "夏の", "秋の", "冬の", "祝", "mt.", "mount", "mt")
AFTER = (
    "三角点", "登山口", "登山", "縦走", "頂上", "山頂", "ソロ", "リベンジ", "往復", "周回", "ピストン", "ハイキング", "ハイク", "トレッキング", "トレラン", "日帰り", "下見", "単独", "まで", "から",
    "へ", "にて",
)
COUNT = re.compile(r"(?:第?\d+(?:日目|回目|座目|回|日)|day\d+|#\d+)")
DATE = re.compile(r"(?:\d{4}|'\d{2})[-./年]\d{1,2}[-./月]\d{1,2}日?")
REMARK = re.compile(r"[(\[{【〔〈《]([^()\[\]{}【】〔〕〈〉《》]*)[)\]}】〕〉》]")
KANJI = re.compile(r"[一-鿿々]")

#: The most reference rows that one trie holds; longer lists are searched in blocks.
BLOCK = 20_000


def allowed(form: str) -> int:
    """Edits allowed for a form: none below three characters, one up to eleven, two from twelve."""
    return 0 if len(form) < 3 else 1 if len(form) < 12 else 2


class Trie:
    """Forms with payloads (entry: most edits, whether it is the entry's own form); search by Levenshtein automaton."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, form: str, entry: int, edits: int, own: bool = False) -> None:
        node = self.root
        for c in form:
            node = node.setdefault(c, {})
        known = node.setdefault("", {}).get(entry, (0, False))
        node[""][entry] = max(edits, known[0]), own or known[1]

    def search(self, text: str, edits: int) -> dict[int, int]:
        """Entry to distance, of all entries with a form within edits of text (and within the form's own limit)."""
        found: dict[int, int] = {}
        machine = automaton(edits)
        step, window = machine.step, machine.window
        places: dict[str, int] = {}
        for j, c in enumerate(text):
            places[c] = places.get(c, 0) | 1 << j
        stack = [(self.root, machine.start, 0)]
        while stack:
            node, state, base = stack.pop()
            for c, child in node.items():
                if not c:
                    d = machine.distance(state, len(text) - base)
                    if d is not None:
                        for entry, (limit, _) in child.items():
                            if d <= limit and d < found.get(entry, 99):
                                found[entry] = d
                    continue
                new, shift = step(state, places.get(c, 0) >> base & window)
                if new >= 0:
                    stack.append((child, new, base + shift))
        return found

    def exact(self, text: str) -> dict[int, bool]:
        """Entries with a form that equals text, with whether it is their own: one path."""
        node = self.root
        for c in text:
            if (node := node.get(c)) is None:
                return {}
        return {e: own for e, (_, own) in node.get("", {}).items()}

    def within(self, text: str) -> list[tuple[int, int, list[int]]]:
        """(start, end, entries), for each start, of the longest form with at least one edit allowed (so no short one) that text holds there."""
        out = []
        for i in range(len(text)):
            node, best = self.root, None
            for j in range(i, len(text)):
                if (node := node.get(text[j])) is None:
                    break
                if "" in node and (full := [e for e, (limit, _) in node[""].items() if limit]):
                    best = (i, j + 1, full)
            if best:
                out.append(best)
        return out


def _script(form: str) -> str:
    """The trie a form belongs to: a name has forms in each script, and a typed name is in one."""
    return "kanji" if KANJI.search(form) else "latin" if form.isascii() else "kana"


class NameList:
    """A reference list (number, name, reading, district) with the search for the names that a text holds."""

    def __init__(self, rows: list[tuple]) -> None:
        self.tries = {script: Trie() for script in ("kanji", "kana", "latin")}
        entries: dict[str, int] = {}
        self.names: list[str] = []
        self.numbers: list[list[tuple[int, str]]] = []
        for number, name, reading, district in sorted(rows, key=lambda r: r[0]):
            if not name or not name.strip():
                continue
            name = fold(name)
            if name not in entries:
                entries[name] = len(entries)
                self.names.append(name)
                self.numbers.append([])
            entry = entries[name]
            self.numbers[entry].append((number, fold(district or "")))
            self._add(name, reading, entry)

    def _add(self, name: str, reading: str | None, entry: int) -> None:

        def add(form: str, entry: int, edits: int, own: bool = False) -> None:
            self.tries[_script(form)].add(form, entry, edits, own)

        add(name, entry, allowed(name), True)
        if name[-1] in ENDINGS and len(name) > 2:
            stem = name[:-1]
            for ending in ENDINGS:
                add(stem + ending, entry, 0 if stem + ending != name else allowed(name))
            add(stem, entry, 0)
            if stem[-1] in "ヶノ" and len(stem) > 2:
                add(stem[:-1], entry, 0)
        if reading:
            kana = hiragana(re.sub(r"\s", "", unicodedata.normalize("NFKC", reading)))
            stem = next((kana[: -len(r)] for r in READINGS if kana.endswith(r) and len(kana) > len(r) + 2), None)
            forms = {kana: 2}
            if stem:
                forms |= {stem: 0} | {stem[:-1]: 0 for _ in "x" if stem[-1] in "がの" and len(stem) > 3}
                forms |= {stem + r: 0 for r in ENDINGS.values() if stem + r != kana}
            for form, edits in forms.items():
                add(form, entry, min(edits, allowed(form)), form == kana)
                latin_form = latin(romaji(form))
                add(latin_form, entry, min(edits, allowed(latin_form)))

    @staticmethod
    def cores(text: str) -> list[str]:
        """Folded forms of a text without remarks, dates, counts and added words; the fullest first."""
        text = unicodedata.normalize("NFKC", text)
        bare = REMARK.sub("", text)
        if not bare.strip():
            bare = "".join(REMARK.findall(text)) or text
        bare = re.sub(r"\s+", "", bare).lower()
        out = [bare]
        now = DATE.sub("", bare)
        while True:
            was = now
            out.append(now)
            for word in BEFORE:
                if now.startswith(word) and len(now) > len(word) + 1:
                    now = now[len(word) :]
                    break
            for word in AFTER:
                if now.endswith(word) and len(now) > len(word) + 1 and not (word == "山頂" and len(now) < 3):
                    now = now[: -len(word)]
                    break
            now = COUNT.sub("", now)
            now = now.strip("-.・:!?!?~〜 ")
            if now == was:
                break
        return list(dict.fromkeys(out))

    @lru_cache(50_000)  # noqa: B019
    def candidates(self, item: str, every: bool = False) -> tuple[tuple[int, int, int, int, int], ...]:
        """(rank, distance, start, end, entry) of the entries that an item may name. Lower ranks are better readings of the item.

        A core that equals a form (an entry's own before aliases, the barest core first), then all entries within the distance
        that the barest core's length allows, then the longest forms that the fullest core contains. All of the first of these
        three that there are come out; with every, those that are equal and those within the distance.
        """
        keyed = []
        for core in self.cores(item)[::-1]:
            if KANJI.search(core):
                keyed.append(fold(core))
            elif re.search("[ぁ-んァ-ヶ]", core):
                keyed.append(hiragana(core))
            elif re.search("[a-z]", core):
                keyed.append(latin(core))
        equal: tuple = ()
        for rank, key in enumerate(keyed):
            if found := self.tries[_script(key)].exact(key):
                equal = tuple((2 * rank + (not own), 0, 0, 0, e) for e, own in found.items())
                break
        if equal and not every:
            return equal
        for key in keyed[:1]:
            if (edits := allowed(key)) and (found := self.tries[_script(key)].search(key, edits)):
                return (*equal, *((NEAR, d, 0, 0, e) for e, d in found.items()))
        if every:
            return equal
        for key in keyed[-1:]:
            if found := self.tries[_script(key)].within(key):
                return tuple((HELD, 0, start, end, e) for start, end, es in found for e in es)
        return ()

    def described(self, text: str, every: bool = False) -> list[list[tuple]]:
        """Candidates of each item of a text, with (name, [(number, district)]) for the entry: as they may be told from those of other lists."""
        return [[(*c[:4], self.names[c[4]], self.numbers[c[4]]) for c in self.candidates(item, every)] for item in tokenize(text)]

    def resolve(self, text: str) -> list[tuple[int, int]]:
        """(number, distance) of all entries that a text of several items names."""
        return decided(text, self.described(text))


NEAR, HELD = 1000, 1001


def chosen(found: list[tuple]) -> list[tuple]:
    """Of candidates of an item those it names: all of the best rank, but of near ones the nearest, none if several are.

    Of forms that the item holds, the first and longest counts, and so on behind its end.
    """
    best = [c for c in found if c[0] == min(f[0] for f in found)]
    if best and best[0][0] == NEAR:
        least = min(c[1] for c in best)
        best = [c for c in best if c[1] == least]
        return best if len({c[4] for c in best}) == 1 else []
    if best and best[0][0] == HELD:
        kept, end = set(), -1
        for a, b in sorted({c[2:4] for c in best}, key=lambda span: (span[0], -span[1])):
            if a >= end:
                kept.add((a, b))
                end = b
        best = [c for c in best if c[2:4] in kept]
    return best


def decided(text: str, items: list[list[tuple]]) -> list[tuple[int, int]]:
    """(number, distance) of a text, of the described candidates of its items, whichever lists they are from."""
    out: dict[int, int] = {}
    whole = None
    for item, found in zip(tokenize(text), items):
        options: dict[str, list] = {}
        for _, distance, _, _, name, numbers in chosen(found):
            options.setdefault(name, []).extend((*n, distance) for n in numbers)
        for entries in options.values():
            if len(entries) > 1:
                near = _meant(entries, fold(item))
                if not near:
                    whole = whole or fold(text)
                    near = _meant(entries, whole)
                entries = near or entries
            for number, _, distance in entries:
                out[number] = min(distance, out.get(number, 99))
    return sorted(out.items())


def _meant(options: list[tuple], text: str) -> list[tuple]:
    """Entries whose district stands in the folded text, with or without its ending (one of a single character as a remark)."""
    remarks = REMARK.findall(text)
    return [o for o in options if o[1] and (o[1] in text or (len(o[1]) > 2 and o[1][:-1] in text) or o[1][:-1] in remarks)]


def blocks_of(names: DataFrame, number: str, name: str, reading: str, district: str) -> Iterator[list[tuple]]:
    """The reference list in blocks of at most BLOCK rows, ordered by number; the driver holds one at a time."""
    rows = names.select(*(F.col(c) for c in (number, name, reading, district))).where(F.col(number).isNotNull()).distinct().orderBy(number)
    block: list[tuple] = []
    for row in rows.toLocalIterator():
        block.append(tuple(row))
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block


#: What becomes of a text with the described candidates of its items.
RowsOf = Callable[[str, list[list[tuple]]], list[tuple]]


def over_candidates(texts: DataFrame, blocks: Iterable[list[tuple]], rows_of: RowsOf, schema: str, every: bool = False) -> DataFrame:
    """rows_of(text, candidates) of all texts, a column of distinct ones; schema begins with text string.

    A list of one block is searched where rows_of runs. Of more blocks each goes to the executors in a plan of its own, whose
    result is written before the driver takes the next; candidates of all blocks are put together before anything is chosen,
    so no choice depends on how the list is cut.
    """
    columns = re.findall(r"(?:^|, )(\w+) ", schema)

    def search(block: list[tuple]):
        def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = _name_list(block)
            for batch in batches:
                yield pd.DataFrame({"text": batch["text"], "items": [json.dumps(names.described(t, every)) for t in batch["text"]]})

        return found

    def whole(block: list[tuple]):
        def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = _name_list(block)
            for batch in batches:
                yield pd.DataFrame([r for t in batch["text"] for r in rows_of(t, names.described(t, every))], columns=columns)

        return found

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = lambda c: (*c[:5], [tuple(n) for n in c[5]])
        for batch in batches:
            items = [[[read(c) for part in parts for c in part] for parts in zip(*map(json.loads, blocks))] for blocks in batch["all"]]
            yield pd.DataFrame([r for t, i in zip(batch["text"], items) for r in rows_of(t, i)], columns=columns)

    source = iter(blocks)
    first, second = next(source, []), next(source, None)
    if second is None:
        return texts.mapInPandas(whole(first), schema)
    found = None
    for block in chain((first, second), source):
        part = cut_lineage(texts.mapInPandas(search(block), "text string, items string"))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("text").agg(F.collect_list("items").alias("all")).mapInPandas(merged, schema)  # one row of each block


def resolve_names(df: DataFrame, key: str, text: str, blocks: Iterable[list[tuple]]) -> DataFrame:
    """(key, number, distance): for each row with text one row per entry it names, or number 0 if it names none.

    Null and blank texts, and null keys, give no row; re-delivered rows count once; a name that two entries share is told by
    the district in the text and gives all of them if the text has none; an item as close to several names gives none.
    Texts of any length are read whole, each distinct one once. An empty list gives 0 for every text.
    """
    rows_of = lambda t, items: [(t, n, d) for n, d in decided(t, items) or [(0, 0)]] if t.strip() else []
    return _by_key(df, key, text, blocks, rows_of, "number int, distance int")


def all_within(df: DataFrame, key: str, text: str, blocks: Iterable[list[tuple]]) -> DataFrame:
    """(key, item_pos, number, distance): all entries within the distance that an item's length allows, ties too; equal forms are at 0.

    Items count from 1; rows and texts as in resolve_names; texts without such an entry give none.
    """

    def rows_of(text: str, items: list[list[tuple]]) -> list[tuple]:
        least: dict[tuple[int, int], int] = {}
        for pos, found in enumerate(items, 1):
            for _, distance, *_, numbers in found:
                for number, _ in numbers:
                    least[pos, number] = min(distance, least.get((pos, number), distance))
        return [(text, *at, distance) for at, distance in least.items()]

    return _by_key(df, key, text, blocks, rows_of, "item_pos int, number int, distance int", True)


def _by_key(df: DataFrame, key: str, text: str, blocks: Iterable[list[tuple]], rows_of: RowsOf, schema: str, every: bool = False) -> DataFrame:
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("_text")).where("key is not null and _text is not null").distinct()
    found = over_candidates(scatter(rows.select(F.col("_text").alias("text")).distinct()), blocks, rows_of, f"text string, {schema}", every)
    named = rows.join(found, F.col("_text") == F.col("text")).drop("_text", "text")
    return named.distinct().withColumnRenamed("key", key)


_LISTS: dict[int, NameList] = {}


def _name_list(block: list[tuple]) -> NameList:
    """The trie of a block, built once in a worker."""
    at = hash(tuple(block))
    if at not in _LISTS:
        _LISTS.clear()
        _LISTS[at] = NameList(block)
    return _LISTS[at]
