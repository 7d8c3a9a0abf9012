"""Text functions: normal forms, tokens, name tests, similarity, as Columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F

#: White space that counts, separators of titles and tokens, endings of mountain names and of places.
BLANK = r"[ \t\r\n\f\x0B\u00A0\u3000]+"
TITLE_PARTS = r"[・/／〜～→,、]"
TOKEN_PARTS = r"[・/／,，、 \t\r\n\f\x0B\u00A0\u3000\-－〜~()（）+＋_]+"
NAME_ENDINGS = ("山", "岳", "峯", "峰", "山頂", "山脈", "森", "峠", "寺", "島")
PLACE_ENDING = r"[市町村郡島]$"


def nfkc(text: Column) -> Column:
    """NFKC; null stays null."""

    @F.pandas_udf("string")
    def form(values: pd.Series) -> pd.Series:
        return values.map(lambda t: unicodedata.normalize("NFKC", t) if t is not None else None)

    return form(text)


def squeezed(text: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(text, BLANK, "")


def collapsed(text: Column) -> Column:
    """White space as single blanks, trimmed; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " "))


def title_form(text: Column) -> Column:
    """Form in which titles are linked: NFKC without white space."""
    return squeezed(nfkc(text))


def name_form(text: Column) -> Column:
    """Form in which names are compared: NFKC, single blanks, lower case."""
    return F.lower(collapsed(nfkc(text)))


def place_forms(text: Column) -> Column:
    """Forms in which places are compared: collapsed, and without its ending."""
    plain = collapsed(nfkc(text))
    return F.array_distinct(F.array(plain, F.regexp_replace(plain, PLACE_ENDING, "")))


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), TOKEN_PARTS), lambda t: F.trim(t) != "")


def title_parts(text: Column) -> Column:
    """Number of parts of a title; none for null and empty."""
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(F.size(F.filter(F.split(text, TITLE_PARTS), lambda t: collapsed(t) != "")))


def is_traverse(text: Column) -> Column:
    """Whether a track name has a separator of several mountains; false for null."""
    return F.coalesce(text.rlike(r"[・/／+＋]"), F.lit(False))


def names_match(name: Column, text: Column) -> Column:
    """Whether text names name: it holds it, and a name of one or two characters is a token of its own or with an ending.

    name and text are in one form; null and empty match nothing.
    """
    spelled = F.array(name, *(F.concat(name, F.lit(e)) for e in NAME_ENDINGS), *(F.concat(F.lit(e), name) for e in NAME_ENDINGS))
    held = F.contains(text, name) & ((F.char_length(name) > 2) | F.arrays_overlap(tokens(text), spelled))
    return F.coalesce((name != "") & (text != "") & held, F.lit(False))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common tokens among all of two arrays; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def written_date(text: Column) -> Column:
    """yyyy-MM-dd out of a date with four, two and two digits; other text as it is."""
    dashed = F.replace(text, F.lit("/"), F.lit("-"))
    pattern = r"([0-9]{4})[-年]([0-9]{2})[-月]([0-9]{2})日?"
    part = lambda i: F.regexp_extract(dashed, pattern, i)
    return F.when(part(1) != "", F.concat_ws("-", part(1), part(2), part(3))).otherwise(dashed)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]+$", 0)


def number(text: Column) -> Column:
    """Double out of text with thousands commas; null if it is none."""
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("double")


def marked(text: Column) -> Column:
    """True for a circle as a mark, false else; null is false."""
    return F.coalesce(F.trim(text).isin("〇", "○", "◯"), F.lit(False))


def content_id(prefix: str, *parts: Column) -> Column:
    """prefix: and the first 16 hexadecimal digits of the SHA-256 of the parts."""
    return F.concat(F.lit(prefix + ":"), F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 16))


def is_alias(names: Column) -> Column:
    """Whether an array holds exactly two distinct names and one is within the other; null is false."""
    own = F.array_distinct(F.filter(names, lambda n: n.isNotNull()))
    a, b = F.get(own, F.lit(0)), F.get(own, F.lit(1))
    return F.coalesce((F.size(own) == 2) & (F.contains(a, b) | F.contains(b, a)), F.lit(False))


def title_list(best: Column, titles: Column) -> Column:
    """The best title, then the others once each, in order; null and empty ones are left out."""
    every = F.concat(F.array(best), F.coalesce(titles, F.array().cast("array<string>")))
    return F.array_distinct(F.filter(every, lambda t: t.isNotNull() & (t != "")))


def name_score(name: Column, track: Column, best: Column, titles: Column) -> Column:
    """The best of: 1 if track holds name, the token similarity of the best title, that of any title; nothing known is 0."""
    like = lambda t: jaccard(F.array_distinct(tokens(name)), F.array_distinct(tokens(t)))
    held = F.when(F.coalesce(F.contains(track, name) & (name != ""), F.lit(False)), 1.0).otherwise(0.0)
    return F.greatest(held, F.coalesce(like(best), F.lit(0.0)), F.coalesce(F.array_max(F.transform(titles, like)), F.lit(0.0)))


def seconds_into_day(local: Column, date: Column) -> Column:
    """Whole seconds from the midnight of a date to a zone-less local time of the same zone; negative before it; null if either can't be read."""
    day = F.unix_date(date.try_cast("date")).cast("bigint") * 86_400
    return (F.floor(local.cast("timestamp_ntz").cast("timestamp").cast("double")).cast("bigint") - day).cast("bigint")


def time_forms(utc: Column) -> Column:
    """struct(minute, utc, jst) of an instant, the session in UTC: yyyy-MM-dd HH:mm, with Z, and in Japan with +0900."""
    full = "yyyy-MM-dd'T'HH:mm:ss"
    japan = utc + F.expr("INTERVAL 9 HOURS")
    return F.struct(F.date_format(utc, "yyyy-MM-dd HH:mm").alias("minute"), F.concat(F.date_format(utc, full), F.lit("Z")).alias("utc"), F.concat(F.date_format(japan, full), F.lit("+0900")).alias("jst"))


def lat_lon(text: Column) -> Column:
    """struct(lat, lon) of 'lat, lon' or 'Nlat Elon' in degrees; null for other text and for what is out of range."""
    pattern = r"^\s*[Nn]?\s*(-?[0-9]+(?:\.[0-9]+)?)\s*[,\s]\s*[Ee]?\s*(-?[0-9]+(?:\.[0-9]+)?)\s*$"
    part = lambda i: F.regexp_extract(text, pattern, i).try_cast("double")
    return F.when(part(1).between(-90, 90) & part(2).between(-180, 180), F.struct(part(1).alias("lat"), part(2).alias("lon")))


def place_parts(text: Column) -> Column:
    """struct(municipality, island) of a place: it is an island if it ends with the sign for one."""
    plain = F.nullif(F.trim(text), F.lit(""))
    return F.struct(F.when(~plain.endswith("島"), plain).alias("municipality"), F.when(plain.endswith("島"), plain).alias("island"))


def plain_markup(text: Column, prefix: str = "") -> Column:
    """Text behind a prefix (all, if it doesn't begin so), without backticks, trimmed, and escaped for HTML."""
    rest = F.when(F.startswith(text, F.lit(prefix)), F.substring(text, len(prefix) + 1, 2_000_000_000)).otherwise(text)
    out = F.trim(F.replace(rest, F.lit("`"), F.lit("")))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def one_of(value: Column, default: str, *allowed: str) -> Column:
    """Whether a value, null as the default, is among those allowed."""
    return F.coalesce(value, F.lit(default)).isin(*allowed)


def flags(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, in order; null does not hold."""
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in conditions.items())), lambda f: f.isNotNull())
