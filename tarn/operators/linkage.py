"""Links between tracks and activities by date and title, name containment, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.functions.text import names_match


def last_wins(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the last by order. Aggregated before the shuffle."""
    last = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(F.col(key).alias("_key")).agg(last.alias("_last")).select("_last.*")


def link_by_date_and_title(tracks: DataFrame, activities: DataFrame) -> DataFrame:
    """(track, activity, match_status, notes) of tracks (track, t_date, t_title) and activities (activity, a_date, a_title).

    Same date and title: plausible; one such is single_high_confidence_candidate, several multiple_candidates. Else every
    activity of the same date, or of the same title and one day off, needs_review; else the track stays as no_candidate.
    Null and empty titles and dates match nothing.
    """
    t, a = tracks.where("t_title <> ''"), activities.where("a_title <> ''")
    plausible = t.join(a, (F.col("t_date") == F.col("a_date")) & (F.col("t_title") == F.col("a_title"))).select("track", "activity")
    open_ = tracks.join(plausible.select("track").distinct(), "track", "left_anti")
    same_day = open_.join(activities, F.col("t_date") == F.col("a_date")).select("track", "activity", F.lit("date match, title mismatch").alias("notes"))
    beside = a.withColumn("_day", F.explode(F.transform(F.array(F.lit(-1), F.lit(1)), lambda k: F.date_add(F.col("a_date").try_cast("date"), k))))
    off = open_.where("t_title <> ''").join(beside, (F.col("t_title") == F.col("a_title")) & (F.col("t_date").try_cast("date") == F.col("_day"))).select("track", "activity", F.lit("title match, date off by 1 day").alias("notes"))
    review = same_day.unionByName(off).withColumn("match_status", F.lit("needs_review"))
    count = F.count("*").over(Window.partitionBy("track"))
    sure = plausible.withColumns({"match_status": F.when(count == 1, "single_high_confidence_candidate").otherwise("multiple_candidates"), "notes": F.lit(None).cast("string")})
    some = sure.unionByName(review)
    rest = tracks.join(some.select("track").distinct(), "track", "left_anti").select("track", F.lit(None).cast(dict(activities.dtypes)["activity"]).alias("activity"), F.lit("no_candidate").alias("match_status"), F.lit(None).cast("string").alias("notes"))
    return some.unionByName(rest)


def dates_both_ways(written: Column) -> Column:
    """Distinct dates of a zone-less time read as local time and as UTC shown in Japan; two of them: sensitive to the zone."""
    return F.array_distinct(F.array(F.to_date(written), F.to_date(written + F.expr("INTERVAL 9 HOURS"))))


def names_in_texts(names: DataFrame, texts: DataFrame, longest: int = 40) -> DataFrame:
    """(number, id) of names (number, name) that texts (id, text) name, both in one form (see names_match).

    An equi-join on substrings: each text gives its substrings of the lengths that names have, so no pair is compared that
    shares none. Names longer than longest characters are joined by their first longest characters.
    """
    named = names.where("name <> ''").withColumns({"_k": F.substring("name", 1, longest), "_n": F.least(F.char_length("name"), F.lit(longest))})
    lengths = sorted(r[0] for r in named.select("_n").distinct().collect())  # at most longest values
    if not lengths:
        return texts.join(names, F.lit(False)).select("number", "id")
    long = texts.where("text <> ''")

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.char_length("text") - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substr(F.col("text"), i, F.lit(n)))

    pieces = F.array_distinct(F.flatten(F.array(*map(of_length, lengths))))
    keyed = long.withColumn("_piece", F.explode(pieces))
    return keyed.join(named, F.col("_piece") == F.col("_k")).where(names_match(F.col("name"), F.col("text"))).select("number", "id").distinct()


def indexed(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """rows with place (from 1, in order within their key) and n (rows of the key); rows of a null key are passed over. Order should have no ties."""
    own = Window.partitionBy(key)
    return rows.where(F.col(key).isNotNull()).withColumns({"place": F.row_number().over(own.orderBy(*order)), "n": F.count("*").over(own)})


def looked_up(rows: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows joined to the one row that known has of their key, rows whose key is null or not known). Together they are all rows."""
    return rows.join(known, key), rows.join(known.select(key), key, "left_anti")
