"""Keyword-stuffed and link-list pages.

A text is cut into units (lines, long lines at sentence ends and separators). Each unit gives one symbol for what it looks
like; a hidden Markov model labels the units as prose, link list, tag list or menu (repeated keywords, names with selling
words), and a page is filler if units other than prose hold over half of its characters.

Both the words that sell and the chances of the model are learned from all texts of the corpus, without labels: a first
model over repetition and layout alone tells units that are no prose, words far more usual there than in prose are the selling
words, and a second model is fitted with these. Repetition counts against a page only where it repeats such words: refrains,
glossaries and lists of species are prose.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tarn.session import cut_lineage, spread

#: Distinct words or sequences that a task counts before it hands them on, and sequences that run side by side.
HELD, SIDE_BY_SIDE = 200_000, 2000
STATES = ("prose", "links", "tags", "menu")
SYMBOLS = "SQHOLUTRKM"
#: What the chances are fitted from, worth PRIOR units: of each symbol in each state. S sentence, Q link named as a source, H
#: heading, O other short line, L plain list, U link, T tags, R keyword repeated within a unit, K short line like many others,
#: M list of recurring items.
PRIOR = 100.0
EMISSION = {
    "prose": {"S": 0.74, "Q": 0.05, "H": 0.06, "O": 0.07, "L": 0.05, "U": 0.01, "T": 0.008, "R": 0.004, "K": 0.004, "M": 0.004},
    "links": {"S": 0.01, "Q": 0.01, "H": 0.01, "O": 0.04, "L": 0.01, "U": 0.88, "T": 0.01, "R": 0.01, "K": 0.01, "M": 0.01},
    "tags": {"S": 0.01, "Q": 0.001, "H": 0.01, "O": 0.04, "L": 0.02, "U": 0.01, "T": 0.88, "R": 0.01, "K": 0.01, "M": 0.01},
    "menu": {"S": 0.03, "Q": 0.001, "H": 0.01, "O": 0.1, "L": 0.04, "U": 0.01, "T": 0.01, "R": 0.4, "K": 0.2, "M": 0.2},
}
STAY = 0.85
#: A selling word stands in so many units of other states, of so many pages, and is so many times as usual there as in prose.
SOLD_PAGES, SOLD_TIMES = 4, 12.0

LINK = re.compile(r"https?://\S+|www\.\S+")
MARKUP = re.compile(r"</?[a-z][^>]*>|\[/?url[^\]]*\]|\[[^\]\n]{1,60}\]\([^)\s]*\)")
TAG = re.compile(r"#[^\s#、。,.|]+")
LINES = re.compile(r"[\r\n\x0b\x0c\x85  ]+")
SENTENCE = re.compile(r"(?<=[。.！？!?])(?![」』）)])(?:(?<=。)|(?<=[！？])|\s+|(?<=[!?])(?=[^\x00-\x7f]))\s*")
SEPARATOR = re.compile(r"[|・,、/;\t→»>]| {2,}|(?<=[^\x00-\x7f]) (?=[^\x00-\x7f])")
END = re.compile(r"[。.!?…」』”\"]\s*$")
SOURCE = re.compile(r"^\W*(?:参考|出典|参照|引用|リンク|sources?|references?|links?|see also)\W*(?:\W|$)")
HEADING = re.compile(r"^\s*(?:#{1,6} |[■□◆●◇▼▲<【\[*]).{0,40}$|^.{1,20}:$")
WORD = re.compile(r"[ァ-ヶー]{2,}|[a-z][a-z'-]{2,}|[一-鿿々〆ヶ]+|[ぁ-ん]{4,}")
GLUED = re.compile(r"[a-z0-9]{40,}")
LONG = 110


def plain(text: str) -> str:
    """NFKC and lower case; lines that a mark of quotation cuts at one width are put together again."""
    text = (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()
    return WRAPPED.sub(_unwrapped, text) if "\n>" in text or text.startswith(">") else text


WRAPPED = re.compile(r"(?:^> ?[^\n]*(?:\n|$)){3,}", re.MULTILINE)


def _unwrapped(found: re.Match) -> str:
    lines = [x.removeprefix(">").removeprefix(" ") for x in found[0].rstrip("\n").split("\n")]
    sizes = {len(x) for x in lines[:-1]}
    return ("".join(lines) if len(sizes) <= 2 and max(sizes) - min(sizes) <= 1 else "\n".join(lines)) + "\n"


def units(text: str) -> list[str]:
    """Lines; those longer than LONG cut at sentence ends, and what is then longer still at white space or separators."""
    out = []
    for line in LINES.split(text):
        if not line or line.isspace():
            continue
        for part in SENTENCE.split(line) if len(line) > 40 else (line,):
            while len(part) > 2 * LONG:
                cut = max(part.rfind(c, LONG // 2, LONG) for c in " |、,・#/")
                cut = cut if cut > 0 else LONG
                out.append(part[:cut])
                part = part[cut:]
            if part and not part.isspace():
                out.append(part)
    return out


def words_of(unit: str) -> list[str]:
    """Words of a unit: katakana and Latin words, hiragana runs, and each pair of neighbours of a kanji run; one written twice in a row is two."""
    out = []
    for w in WORD.findall(unit):
        if len(w) > 2 and "一" <= w[0] <= "鿿":
            out += [w[i : i + 2] for i in range(len(w) - 1)]
        elif len(w) > 3 and w == w[: len(w) // 2] * 2:
            out += [w[: len(w) // 2]] * 2
        else:
            out.append(w)
    return out


@dataclass(frozen=True)
class Model:
    """Selling words (None: not known yet, any word may be one) and the logarithms of the chances of start, change and symbols."""

    sold: frozenset[str] | None = None
    start: np.ndarray = field(default_factory=lambda: np.log([0.5] + [0.5 / 3] * 3))
    change: np.ndarray = field(default_factory=lambda: np.log(np.where(np.eye(4) > 0, STAY, (1 - STAY) / 3)))
    emission: np.ndarray = field(default_factory=lambda: np.log([[EMISSION[s][x] for x in SYMBOLS] for s in STATES]))


def symbols(parts: list[str], sold: frozenset[str] | None, words: list[list[str]] | None = None) -> str:
    """One of SYMBOLS for each unit."""
    words = words or [words_of(p) for p in parts]
    bare = [(LINK.sub("", p) if "//" in p or "www." in p else p).strip() for p in parts]
    ended = [END.search(p) is not None for p in bare]
    short = [len(p) <= 40 and not e for p, e in zip(bare, ended)]
    many = len(parts) > 3
    lines = Counter(p for p, s in zip(bare, short) if s) if many else {}
    endings = Counter(p[-3:] for p, s in zip(bare, short) if s and len(p) > 4 and not p[-1].isdigit()) if many else {}
    last = Counter(p[-6:] for p in {p for p, s in zip(bare, short) if s and p.isascii()}) if many else {}
    shared = max(5, 0.6 * sum(short))  # so many different lines with one last word are a menu whatever the word
    usual = Counter(w for ws, e in zip(words, ended) if not e for w in {*ws}) if many else {}
    items = [[] if e else [x for i in SEPARATOR.split(p) if (x := i.strip())] for p, e in zip(bare, ended)]
    recurring = Counter(i for x in items if len(x) > 3 for i in x)
    out, source = [], False
    for part, text, item, word, is_short, end in zip(parts, bare, items, words, short, ended):
        size = len(part.strip())
        link = size - len(text)
        marked = sum(map(len, MARKUP.findall(part))) if "<" in part or "[" in part else 0
        if link > 3 or marked:
            heavy = max(link, marked) >= 0.4 * size
            source = source or SOURCE.match(text) is not None
            out.append(("Q" if source and not marked else "U") if heavy else "S" if end or len(text) > 40 else "O")
            continue
        hits = word if sold is None else [w for w in word if w in sold]
        source = (len(text) < 30 and SOURCE.match(text) is not None) or (source and is_short and not (sold and hits))
        tags = TAG.findall(text) if "#" in text else []
        if len(tags) > 1 and sum(map(len, tags)) >= 0.5 * size:
            out.append("T")
        elif _repeats(text, word, hits, sold is not None):
            out.append("R")
        elif not end and hits and len(word) > 2 and sum(usual[w] > 4 for w in word) >= 0.6 * len(word) if many else False:
            out.append("K" if is_short else "M")
        elif not end and sold and len(hits) >= 0.5 * len(word) > 0:
            out.append("K" if is_short else "M")
        elif not end and len(item) > 3 and sum(map(len, item)) / len(item) < 25:
            common = word and max(Counter(word).values()) >= max(4, 0.6 * len(item))  # most items hold one same word
            out.append("M" if common or (hits and (sum(recurring[i] > 2 for i in item) >= 0.4 * len(item) or (sold and len(hits) > 1))) else "L")
        elif is_short and many and ((hits and (lines[text] > 2 or (len(text) > 4 and endings[text[-3:]] > 4))) or last[text[-6:]] >= shared):
            out.append("K")
        elif HEADING.match(text):
            out.append("H")
        elif end or len(text) > 40:
            out.append("S")
        else:
            out.append("O")
    return "".join(out)


def _repeats(text: str, words: list[str], hits: list[str], known: bool) -> bool:
    """Whether a unit is one of keywords: a word three times or more (for each stretch of LONG characters; one that doesn't sell also a quarter of all words), mostly selling words, or words glued together."""
    need = max(3, -(-3 * len(text) // (2 * LONG)))
    if len(words) >= need and max(Counter(words).values()) >= max(need, 0.25 * len(words)):
        return True
    if len(hits) >= need and (max(Counter(hits).values()) >= need or (known and len(hits) >= 0.5 * len(words) and len(hits) > 3)):
        return True
    return len(text) >= 40 and GLUED.search(text) is not None


def weighed(parts: list[str], signs: str) -> tuple[str, list[float]]:
    """(symbols, sizes) with the symbol of a unit once for each LONG / 2 characters, so that long units tell more; sizes without blanks."""
    out, sizes = [], []
    for part, sign in zip(parts, signs):
        k = max(1, round(2 * len(part) / LONG))
        out.append(sign * k)
        sizes += [len("".join(part.split())) / k] * k
    return "".join(out), sizes


def label(signs: str, model: Model = Model()) -> list[str]:
    """Most likely states of units, by Viterbi."""
    if not signs:
        return []
    step, emission = model.change.tolist(), model.emission.T.tolist()
    score = [a + b for a, b in zip(model.start.tolist(), emission[SYMBOLS.index(signs[0])])]
    back = []
    for sign in signs[1:]:
        seen = emission[SYMBOLS.index(sign)]
        origin = [max(range(4), key=lambda i: score[i] + step[i][j]) for j in range(4)]  # noqa: B023
        score = [score[i] + step[i][j] + seen[j] for j, i in enumerate(origin)]
        back.append(origin)
    state = score.index(max(score))
    out = [state]
    for origin in reversed(back):
        out.append(state := origin[state])
    return [STATES[s] for s in out[::-1]]


def posteriors(sequences: list[str], model: Model, at_once: int = 200, times: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Expected counts of starts, changes and symbols by state, and the chances of states of each sequence (forward and backward).

    Sequences of like length run side by side; longer ones than at_once go in parts. times: how often each sequence counts.
    """
    cut = [(n, s[i : i + at_once]) for n, s in enumerate(sequences) for i in range(0, len(s), at_once)]
    alike: dict[int, list[int]] = {}
    for i, (_, part) in enumerate(cut):
        alike.setdefault(len(part).bit_length(), []).append(i)
    start, moves, counts = np.zeros(4), np.zeros((4, 4)), np.zeros((4, len(SYMBOLS)))
    states: list[np.ndarray] = [np.zeros((0, 4))] * len(cut)
    for group in alike.values():
        parts = [cut[i][1] for i in group]
        first, moved, seen, chance = _side_by_side(parts, model, np.array([times[cut[i][0]] for i in group], float) if times else np.ones(len(group)))
        start, moves, counts = start + first, moves + moved, counts + seen
        for k, i in enumerate(group):
            states[i] = chance[: len(parts[k]), k]
    whole: list[list[np.ndarray]] = [[np.zeros((0, 4))] for _ in sequences]
    for (n, _), chance in zip(cut, states):
        whole[n].append(chance)
    return start, moves, counts, [np.concatenate(w) for w in whole]


PLACE = np.zeros(128, np.int64)
PLACE[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))


def _side_by_side(parts: list[str], model: Model, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in parts])
    signs = PLACE[np.frombuffer("".join(p.ljust(size.max(), SYMBOLS[0]) for p in parts).encode(), np.uint8)].reshape(len(parts), -1)
    start, change, seen = np.exp(model.start), np.exp(model.change), np.exp(model.emission)[:, signs].transpose(2, 1, 0)
    live = np.arange(size.max())[:, None] < size
    forward, backward = np.zeros_like(seen), np.ones_like(seen)
    forward[0] = start * seen[0]
    forward[0] /= forward[0].sum(1, keepdims=True)
    scale = np.ones(seen.shape[:2])
    for t in range(1, len(seen)):
        now = forward[t - 1] @ change * seen[t]
        scale[t] = now.sum(1)
        forward[t] = now / scale[t][:, None]
    for t in range(len(seen) - 2, -1, -1):
        before = (seen[t + 1] * backward[t + 1]) @ change.T / scale[t + 1][:, None]
        backward[t] = np.where(live[t + 1][:, None], before, 1.0)
    chance = forward * backward
    chance /= chance.sum(2, keepdims=True)
    chance *= live[:, :, None]
    moves = np.zeros((4, 4))
    for t in range(1, len(seen)):
        both = (forward[t - 1] * (live[t] * times / scale[t])[:, None]).T @ (seen[t] * backward[t] * live[t][:, None])
        moves += both * change
    counted = chance * times[:, None]
    counts = np.stack([counted[signs.T == k].sum(0) if (signs.T == k).any() else np.zeros(4) for k in range(len(SYMBOLS))], 1)
    return counted[0].sum(0), moves, counts, chance


def fitted(sequences: list[str], sold: frozenset[str] | None, gain: float = 1e-3) -> Model:
    """Model of sequences, see maximised."""
    sequences = [s for s in sequences if s]
    return maximised(lambda model: posteriors(sequences, model)[:3], sold, gain) if sequences else Model(sold)


def maximised(expected: Callable[[Model], tuple[np.ndarray, np.ndarray, np.ndarray]], sold: frozenset[str] | None, gain: float = 1e-3) -> Model:
    """Model by expectation and maximisation until no chance moves by more than gain, from the prior chances, which stay in as counts."""
    prior = Model(sold)
    model = prior
    moved = 1.0
    while moved >= gain:
        start, moves, counts = expected(model)
        share = lambda c: np.log(c / c.sum(-1, keepdims=True))
        new = Model(sold, share(start + PRIOR * np.exp(prior.start)), share(moves + PRIOR * np.exp(prior.change)), share(counts + PRIOR * np.exp(prior.emission)))
        moved = max(np.abs(np.exp(a) - np.exp(b)).max() for a, b in ((new.start, model.start), (new.change, model.change), (new.emission, model.emission)))
        model = new
    return model


class Count:
    """Units that hold each word, in other states than prose and in prose, and pages that hold it in others; all units of both kinds."""

    def __init__(self) -> None:
        self.other, self.prose, self.pages = Counter(), Counter(), Counter()
        self.all_other = self.all_prose = 0

    def add(self, signs: list[str], words: list[list[list[str]]], model: Model) -> None:
        known = {}
        distinct = list(dict.fromkeys(s for s in signs if s))
        for i in range(0, len(distinct), SIDE_BY_SIDE):
            some = distinct[i : i + SIDE_BY_SIDE]
            known |= {s: (c[:, 0] < 0.5).tolist() for s, c in zip(some, posteriors(some, model)[3])}
        for sign, page in zip(signs, words):
            here = set()
            for is_other, unit in zip(known.get(sign, ()), page):
                kinds = set(unit)
                if is_other:
                    self.other.update(kinds)
                    here |= kinds
                    self.all_other += 1
                else:
                    self.prose.update(kinds)
                    self.all_prose += 1
            self.pages.update(here)


def sells(other: float, prose: float, pages: float, all_other: float, all_prose: float) -> bool:
    """Whether a word of these counts (see Count) is a selling word; both totals count one unit more. Also for columns."""
    return (pages >= SOLD_PAGES) & (other / (all_other + 1) >= SOLD_TIMES * (prose + 1) / (all_prose + 1))


def learned(texts: list[str]) -> Model:
    """Selling words and model of texts that fit into memory; filler has the same for a table. Without texts, or without other units than prose, the prior model with no words."""
    pages = [units(plain(t)) for t in texts]
    words = [[words_of(p) for p in page] for page in pages]
    signs = [symbols(page, None, w) for page, w in zip(pages, words)]
    first = fitted(signs, None)
    count = Count()
    count.add(signs, words, first)
    sold = frozenset(w for w, n in count.other.items() if sells(n, count.prose[w], count.pages[w], count.all_other, count.all_prose))
    return fitted([weighed(page, symbols(page, sold, w))[0] for page, w in zip(pages, words)], sold)


#: Symbols that tell against prose; without any a page is prose.
EVIDENCE = frozenset("UTRKM")


def other_share(text: str, model: Model) -> float:
    """Share of a text's characters, blanks aside, that stand in units other than prose."""
    parts = units(plain(text))
    signs = symbols(parts, model.sold)
    if EVIDENCE.isdisjoint(signs):
        return 0.0
    return share_of(*weighed(parts, signs), model)


def share_of(signs: str, sizes: list[float], model: Model) -> float:
    """Share of the sizes of weighed units that are not labelled prose."""
    total = sum(sizes)
    return sum(n for n, s in zip(sizes, label(signs, model)) if s != "prose") / total if total else 0.0


def _sequences(rows: DataFrame, sign: str, times: Column) -> DataFrame:
    """(signs, times) of distinct sequences."""
    return cut_lineage(rows.where(F.length(sign) > 0).groupBy(F.col(sign).alias("signs")).agg(F.sum(times).alias("times")))


def _expected(sequences: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over all sequences: 60 numbers of each task go to the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(4 + 16 + 4 * len(SYMBOLS))
        for batch in batches:
            for i in range(0, len(batch), SIDE_BY_SIDE):
                part = batch.iloc[i : i + SIDE_BY_SIDE]
                total += np.concatenate([c.ravel() for c in posteriors(part["signs"].tolist(), model, times=part["times"].tolist())[:3]])
        yield pd.DataFrame({"n": [total.tolist()]})

    n = np.sum([r[0] for r in sequences.mapInPandas(run, "n array<double>").collect()], axis=0)
    return n[:4], n[4:20].reshape(4, 4), n[20:].reshape(4, -1)


def _fitted_to(sequences: DataFrame, sold: frozenset[str] | None) -> Model:
    return Model(sold) if sequences.isEmpty() else maximised(lambda model: _expected(sequences, model), sold)


def _read(texts: pd.Series) -> tuple[list[list[str]], list[list[list[str]]]]:
    pages = [units(plain(t)) for t in texts]
    return pages, [[words_of(p) for p in page] for page in pages]


def _first_signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found = Counter()
    for batch in batches:
        found.update(symbols(page, None, words) for page, words in zip(*_read(batch["text"])))
        if len(found) > HELD:
            yield pd.DataFrame({"signs": list(found), "times": list(found.values())})
            found = Counter()
    if found:
        yield pd.DataFrame({"signs": list(found), "times": list(found.values())})


def _selling(rows: DataFrame, first: Model) -> frozenset[str]:
    """Selling words of all texts."""

    def table(count: Count) -> pd.DataFrame:
        words: list[str | None] = [None, *(count.other.keys() | count.prose.keys())]
        return pd.DataFrame({"word": words, "other": [count.all_other, *(count.other[w] for w in words[1:])], "prose": [count.all_prose, *(count.prose[w] for w in words[1:])], "pages": [0, *(count.pages[w] for w in words[1:])]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = Count()
        for batch in batches:
            pages, words = _read(batch["text"])
            count.add([symbols(page, None, w) for page, w in zip(pages, words)], words, first)
            if len(count.prose) > HELD:
                yield table(count)
                count = Count()
        yield table(count)

    found = rows.mapInPandas(run, "word string, other long, prose long, pages long")
    counts = cut_lineage(found.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("other", "prose", "pages"))))
    total = counts.where("word is null").first()
    if total is None:
        return frozenset()
    of = counts.where("word is not null and other > 0")
    return frozenset(r[0] for r in of.where(sells(F.col("other"), F.col("prose"), F.col("pages"), F.lit(total.other), F.lit(total.prose))).select("word").collect())


def _weighed_rows(sold: frozenset[str]):
    """(key, signs, sizes, times): rows with evidence against prose one by one, others as counts of sequences without a key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            plain_ones, out = Counter(), []
            for key, page, words in zip(batch["key"], *_read(batch["text"])):
                signs = symbols(page, sold, words)
                weights, sizes = weighed(page, signs)
                if EVIDENCE.isdisjoint(signs):
                    plain_ones[weights] += 1
                else:
                    out.append((key, weights, sizes, 1))
            out += [(None, signs, None, n) for signs, n in plain_ones.items()]
            if out:
                yield pd.DataFrame({name: pd.Series(c, dtype=object) for name, c in zip(("key", "signs", "sizes", "times"), zip(*out))})

    return run


def filler(documents: DataFrame, key: str, text: str, least: float = 0.5) -> DataFrame:
    """(key, share) of documents of which more than least (0 at least) of the characters are no prose.

    Null, empty and blank texts are none; texts are read whole; repeated rows stay repeated; null keys are passed over. The
    model is fitted on all these rows. The texts are read three times: for the first model, for the selling words and for
    the symbols with these; the models need distinct sequences of symbols only. The driver gets sums and selling words.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull() & (F.length("text") >= 1))
    kind = dict(rows.dtypes)["key"]
    rows = spread(rows)
    first = _fitted_to(_sequences(rows.select("text").mapInPandas(_first_signs, "signs string, times long"), "signs", F.col("times")), None)
    sold = _selling(rows.select("text"), first)
    weights = cut_lineage(rows.mapInPandas(_weighed_rows(sold), f"key {kind}, signs string, sizes array<double>, times long"))
    model = _fitted_to(_sequences(weights, "signs", F.col("times")), sold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            share = [share_of(signs, sizes, model) for signs, sizes in zip(batch["signs"], batch["sizes"])]
            out = pd.DataFrame({"key": batch["key"], "share": share})
            yield out[out["share"] > least]

    return weights.where("key is not null").select("key", "signs", "sizes").mapInPandas(run, f"key {kind}, share double").withColumnRenamed("key", key)
