"""Several values packed in one field: a quote-aware finite-state tokenizer that keeps positions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tarn.session import scatter

#: Quotes and brackets with their closing marks, characters that stay inside an item.
QUOTES = {'"': '"', "“": "”", "„": "”", "「": "」", "『": "』", "«": "»", "＂": "＂", "'": "'", "‘": "’"}
BRACKETS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "｛": "｝", "【": "】", "〔": "〕", "〈": "〉", "《": "》", "〖": "〗", "<": ">", "＜": "＞"}
INSIDE = "-‐‑－﹣._'’ʼ＇．＿\\"
LINE_BREAKS = "\n\r\v\f\x85\u2028\u2029"

ARROW = r"[-=~－＝]+[>＞]|[<＜][-=~－＝]+"
MARK = regex.compile(rf"{ARROW}|[\p{{P}}\p{{S}}{LINE_BREAKS}\\]")
APOSTROPHES = "'‘"
CLOSERS = frozenset({*BRACKETS.values(), *QUOTES.values(), *QUOTES} - {">", "＞"})
BRACKET = regex.compile("[" + regex.escape("".join(c for pair in BRACKETS.items() if pair[0] not in "<＜" for c in pair)) + "]")
BLANKS = regex.compile(r"\s*")
REST = regex.compile("[ \t　\xa0]*")
NEXT = {c: regex.compile(rf"\\.|{regex.escape(c)}", regex.DOTALL) for c in QUOTES.values()}


def _closing_quote(text: str, start: int, close: str) -> int:
    """Place of the mark that ends the quote whose inside starts at start; -1 if none. Doubled and escaped marks don't end it."""
    at = start
    while found := NEXT[close].search(text, at):
        if found[0] == close:
            if close in "\"'＂" and text[found.end() : found.end() + 1] == close:
                at = found.end() + 1
                continue
            return found.start()
        at = found.end()
    return -1


def _closing_brackets(text: str) -> dict[int, int]:
    """Place of each bracket that is closed to that of its closing mark, in one pass."""
    stack: list[int] = []
    pairs: dict[int, int] = {}
    for found in BRACKET.finditer(text):
        c, i = found[0], found.start()
        if c in BRACKETS:
            stack.append(i)
        elif stack and c == BRACKETS[text[stack[-1]]]:
            pairs[stack.pop()] = i
    return pairs


def _item(text: str, a: int, b: int, quote: tuple[int, int] | None) -> str:
    raw = text[a:b]
    left = a + len(raw) - len(raw.lstrip())
    right = b - len(raw) + len(raw.rstrip())
    if quote and quote == (left, right - 1):
        inner, close = text[left + 1 : right - 1], text[right - 1]
        inner = regex.sub(rf"\\([\\\"'{regex.escape(close)}])", r"\1", inner)
        return inner.replace(close * 2, close) if close in "\"'＂" else inner
    return raw.strip()


def tokenize(text: str | None) -> list[str]:
    """Items of a field, in order; empty items are left out, repeated ones stay.

    States: between items, in an item, in a quote, in a bracket. A quote or bracket that never closes is ordinary text. A
    field that one pair of square brackets encloses is a list literal and is read without them.
    """
    if not text:
        return []
    text = text.strip()
    if text[:1] == "[" and text[-1:] == "]" and _closing_list(text) == len(text) - 1:
        text = text[1:-1]
    items, start, at, quote = [], 0, 0, None
    filled, brackets, never = BLANKS.match(text).end(), None, set()
    while found := MARK.search(text, at):
        mark, i = found[0], found.start()
        at = found.end()
        if mark == "\\":
            at += 1
            continue
        if mark in QUOTES and (mark not in APOSTROPHES or filled >= i):
            end = -1 if QUOTES[mark] in never else _closing_quote(text, at, QUOTES[mark])
            if end < 0 and mark != QUOTES[mark]:
                never.add(QUOTES[mark])  # nor from any later mark on
            if end >= 0 and (mark not in APOSTROPHES or _ends_item(text, end + 1)):
                if quote is None:
                    quote = (i, end)
                at = end + 1
                continue
            if mark not in APOSTROPHES:
                continue
        if mark in BRACKETS and mark not in "<＜":
            brackets = _closing_brackets(text) if brackets is None else brackets
            at = brackets.get(i, i) + 1
            continue
        if len(mark) == 1 and (mark in INSIDE or mark in CLOSERS):
            continue
        items.append(_item(text, start, i, quote))
        start, quote, filled = at, None, BLANKS.match(text, at).end()
    items.append(_item(text, start, len(text), quote))
    return [x for x in items if x.strip()]


def _ends_item(text: str, at: int) -> bool:
    """Whether only white space comes between at and the next separator or the end."""
    at = REST.match(text, at).end()
    return at == len(text) or bool((found := MARK.match(text, at)) and found[0] not in INSIDE)


def _closing_list(text: str) -> int:
    """Place of the square bracket that closes the list literal at 0; those in quotes don't count."""
    depth, at, last = 0, 0, ""
    while at < len(text):
        c = text[at]
        if c in "\"'" and last and last in "[,":
            end = _closing_quote(text, at + 1, c)
            if end >= 0:
                at = end
        elif c == "[":
            depth += 1
        elif c == "]":
            depth -= 1
            if not depth:
                return at
        if not c.isspace():
            last = c
        at += 1
    return -1


def items_of(value: Column) -> Column:
    """Array of the items of a packed column (see tokenize); null and blank give an empty array."""

    @F.pandas_udf("array<string>")
    def split(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in values:
            known = {v: tokenize(v) for v in batch.dropna().unique()}
            yield batch.map(lambda v: known.get(v, []))

    return split(value)


def explode_packed(df: DataFrame, key: str, field: str) -> DataFrame:
    """(field_name, row_id, item_pos, item): one row per item, positions from 1, one set of rows per key and value.

    Re-delivered rows count once; null keys, null and blank fields give no row; an empty table gives an empty result. Other
    columns, also ones named like those of the result, are not read.
    """
    rows = df.select(F.col(key).cast("bigint").alias("row_id"), F.col(field).alias("_value")).where("row_id is not null and _value is not null").distinct()
    exploded = scatter(rows).select("row_id", F.posexplode(items_of(F.col("_value"))).alias("_pos", "item"))
    return exploded.select(F.lit(field).alias("field_name"), "row_id", (F.col("_pos") + 1).cast("int").alias("item_pos"), "item").distinct()
