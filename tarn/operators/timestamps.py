"""Mixed timestamp notations to UTC instants and calendar dates.

Each value is reduced to a shape mask of the same length (digits become 9, words a letter for their class), each distinct
mask is mapped to a parser once, and all values of one mask are converted together: they are equally long, so every field
is a column slice of one matrix of code points. Zones come from versioned transition tables.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tarn.functions.zones import ABBREVIATIONS, database_version, local_to_utc, utc_to_local
from tarn.session import spread

#: Month and weekday names, eras with the year before their first.
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
LONG_MONTHS = {m: i + 1 for i, m in enumerate("january february march april may june july august september october november december".split())}
DAYS = {"mon", "tue", "wed", "thu", "fri", "sat", "sun", "tues", "thur", "thurs"} | {d + "day" for d in ("mon", "tues", "wednes", "thurs", "fri", "satur", "sun")}
ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "平成": 1988, "令和": 2018, "M": 1867, "T": 1911, "S": 1925, "H": 1988, "R": 2018}

DIGITS = str.maketrans("0123456789", "9999999999")
WORD = re.compile(r"[A-Za-z]+(?:/[A-Za-z_]+(?:[-+]\d+)?)+|[A-Za-z]+")
DATE = (
    r"(?P<Y>9{4})(?P<s1>[-/._])(?P<m>9{1,2})(?P=s1)(?P<d>9{1,2})",
    r"(?P<Y>9{4}) ?年 ?(?P<m>9{1,2}) ?月 ?(?P<d>9{1,2}) ?日?",
    r"(?P<Y>9{4})(?P<m>99)(?P<d>99)",
    r"'?(?P<y>99)(?P<s2>[-/.])(?P<m>9{1,2})(?P=s2)(?P<d>9{1,2})",
    r"'?(?P<y>99) ?年 ?(?P<m>9{1,2}) ?月 ?(?P<d>9{1,2}) ?日?",
    r"(?P<y>99)(?P<m>99)(?P<d>99)",
    r"(?P<era>明治|大正|昭和|平成|令和|[E]) ?\.?(?P<g>9{1,2}|元) ?(?:年|[-/.]) ?(?P<m>9{1,2}) ?(?:月|[-/.]) ?(?P<d>9{1,2}) ?日?",
    r"(?P<d>9{1,2})(?:th)?[ -]?(?P<b>M+)\.?,?[ -]?(?P<Y>9{4})",
    r"(?P<b>M+)\.? ?(?P<d>9{1,2}),? (?P<Y>9{4})",
    r"(?P<Y>9{4})[ -](?P<b>M+)[ -](?P<d>9{1,2})",
)
WEEKDAY = r"(?:,? ?[(\[]?(?:[日月火水木金土](?:曜日?)?|W+)[)\]]?,?)?"
TIME = (
    r"(?P<p>午前|午後)?(?P<H>9{1,2}) ?[:_.時-] ?(?P<M>99) ?分?(?:[:_.-]? ?(?P<S>99)秒?(?:[.,](?P<f>9+))?)?(?: ?(?P<q>P+))?",
    r"(?P<H>99)(?P<M>99)(?:(?P<S>99)(?:[.,](?P<f>9+))?)?",
)
ZONE = r"(?: ?\[?(?P<z>Z+|R+)\]?| ?(?:Z+)?(?P<o>[-+−](?P<oh>99):?(?P<om>99)?))?(?: ?[(\[](?:Z+|R+)[)\]])?"
PARSERS = [re.compile(r"(?:x+_)?(?:W+\.?,? )?" + d + WEEKDAY + rf"(?:[T _,]*{t}{ZONE})?(?:\.x+)?") for d in DATE for t in TIME]
EPOCH = re.compile(r"(?P<e>9{10}|9{13}|9{16})")


def _word(match: re.Match) -> str:
    word = match[0]
    low = word.lower()
    if "/" in word:
        kind = "R"
    elif low in MONTHS or low in LONG_MONTHS or low == "sept":
        kind = "M"
    elif low in DAYS:
        kind = "W"
    elif low in ("am", "pm"):
        kind = "P"
    elif word in ("T", "t"):
        kind = "T"
    elif word in ("H", "R", "S"):
        kind = "E"
    elif word.upper() in ABBREVIATIONS:
        kind = "Z"
    else:
        kind = "x"
    return kind * len(word)


def shape_mask(text: str) -> str:
    """Mask of the length of text: 9 for digits, one letter per word class, all else as it is."""
    return WORD.sub(_word, text).translate(DIGITS)


@lru_cache(100_000)
def parser_of(mask: str) -> dict[str, tuple[int, int]] | None:
    """Field name to slice; None for a mask that is no time."""
    if found := EPOCH.fullmatch(mask):
        return {"e": found.span("e")}
    for parser in PARSERS:
        if found := parser.fullmatch(mask):
            return {k: found.span(k) for k, v in found.groupdict().items() if v is not None and k[0] != "s"}
    if mask[:1] == "T":  # T as the letter of an era
        return parser_of("E" + mask[1:])
    return None


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970-01-01 and whether the date exists."""
    ok = (m >= 1) & (m <= 12) & (d >= 1) & (y >= 1)
    month = np.where(ok, (y - 1970) * 12 + m - 1, 0).astype("datetime64[M]")
    length = ((month + 1).astype("datetime64[D]") - month.astype("datetime64[D]")).astype(np.int64)
    return month.astype("datetime64[D]").astype(np.int64) + d - 1, ok & (d <= length)


def convert(texts: list[str], mask: str, default_zone: str, version: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(local day, epoch second, state) of texts of one mask; state 0 none, 1 date, 2 date and time, 3 with a zone of its own."""
    n, fields = len(texts), parser_of(mask)
    none = np.zeros(n, np.int64)
    if fields is None:
        return none, none, none
    points = np.array(texts, f"U{len(mask)}").view(np.uint32).reshape(n, len(mask)).astype(np.int64)

    def number(key: str) -> np.ndarray:
        if key not in fields:
            return none
        a, b = fields[key]
        return (points[:, a:b] - 48) @ (10 ** np.arange(b - a - 1, -1, -1))

    def words(key: str) -> list[str]:
        a, b = fields[key]
        return [t[a:b] for t in texts]

    if "e" in fields:
        a, b = fields["e"]
        second = number("e") // 10 ** (b - a - 10)
        return second // 86400, second, none + 3
    if "era" in fields:
        first = np.array([x == "元" for x in words("g")])
        year = np.array([ERAS[x] for x in words("era")]) + np.where(first, 1, number("g"))
    else:
        year = number("Y") if "Y" in fields else 2000 + number("y")
    month = np.array([MONTHS[x[:3].lower()] for x in words("b")]) if "b" in fields else number("m")
    day, ok = _days(year, month, number("d"))
    if "H" not in fields:
        return day, none, ok.astype(np.int64)
    hour, minute, second = number("H"), number("M"), number("S")
    half = words("q") if "q" in fields else words("p") if "p" in fields else None
    if half is not None:
        late = np.array([x.lower() in ("pm", "午後") for x in half])
        ok &= (hour >= 0) & (hour <= 12)
        hour = hour % 12 + 12 * late
    ok &= (hour < 24) & (minute < 60) & (second < 60)
    local = day * 86400 + hour * 3600 + minute * 60 + second
    if "o" in fields:
        sign = np.array([1 if x[0] == "+" else -1 for x in words("o")])
        ok &= (number("oh") < 15) & (number("om") < 60)
        return day, local - sign * (number("oh") * 3600 + number("om") * 60), 3 * ok
    out, state = none.copy(), 3 * ok
    names = np.array(words("z") if "z" in fields else [default_zone] * n)
    for name in np.unique(names):
        at = names == name
        if name.upper() in ABBREVIATIONS:
            out[at] = local[at] - int(ABBREVIATIONS[name.upper()] * 3600)
        elif (utc := local_to_utc(local[at], str(name), version)) is not None:
            out[at] = utc
        else:
            state[at] = 0
    return day, out, state if "z" in fields else np.minimum(state, 2)


def normalise_values(values: pd.Series, default_zone: str, as_date: bool, version: str) -> pd.Series:
    """yyyy-MM-ddTHH:mm:ssZ, or yyyy-MM-dd as written (in default_zone, if the value has a zone); null where there is none."""
    texts = [unicodedata.normalize("NFKC", v).strip() if v else "" for v in values]
    codes, masks = pd.factorize(np.array([shape_mask(t) for t in texts], object))
    out = np.full(len(texts), None, object)
    for k, mask in enumerate(masks):
        if not mask:
            continue
        at = np.flatnonzero(codes == k)
        day, second, state = convert([texts[i] for i in at], mask, default_zone, version)
        if as_date:
            day = np.where(state == 3, utc_to_local(second, default_zone, version) // 86400, day)
            text, ok = day.astype("datetime64[D]").astype(str), state > 0
        else:
            text, ok = np.char.add(second.astype("datetime64[s]").astype(str), "Z"), state > 1
        out[at[ok]] = text[ok]
    return pd.Series(out, dtype=object)


def normalised(value: Column, default_zone: str, as_date: bool = False) -> Column:
    """Column of the normal form of a column of notations (see normalise_values)."""
    version = database_version()

    @F.pandas_udf("string")
    def norm(values: pd.Series) -> pd.Series:
        return normalise_values(values, default_zone, as_date, version)

    return norm(value)


def normalise_fields(df: DataFrame, key: str, instants: dict[str, str], dates: dict[str, str]) -> DataFrame:
    """(key, field_name, value_norm): one distinct row for each field that holds a real time or date.

    instants and dates map column names to the zone of values that name none. Null, blank, unreadable and impossible values
    give no row, repeated rows one; an empty table gives an empty result. Columns beside those named are not read.
    """
    forms = [F.struct(F.lit(c).alias("field_name"), normalised(F.col(c), zone, as_date).alias("value_norm")) for group, as_date in ((instants, False), (dates, True)) for c, zone in group.items()]
    rows = spread(df.select(key, *instants, *dates)).select(F.col(key), F.explode(F.array(*forms)).alias("_form")).select(key, "_form.field_name", "_form.value_norm")
    return rows.where(F.col("value_norm").isNotNull() & F.col(key).isNotNull()).distinct()
