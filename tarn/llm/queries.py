"""The pN_ queries of the problems tagged llm, and their SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarn.llm.canonical import all_within, blocks_of, resolve_names
from tarn.llm.fillers import filler
from tarn.llm.leakage import leaks
from tarn.llm.matching import kilometres, linked, minutes, tokens_of
from tarn.llm.tokenizer import encoded
from tarn.operators.timestamps import normalised
from tarn.plans.evidence import nfkc_sql
from tarn.session import cut_lineage, scatter, table


def _mountains(spark: SparkSession, folder: str) -> Iterator[list[tuple]]:
    rows = table(spark, folder, "ehime_mountain_source_rows").select("mountain_no", "mountain_name", "mountain_kana", F.coalesce("location.municipality", "location.municipality_or_island").alias("district"))
    return blocks_of(rows, "mountain_no", "mountain_name", "mountain_kana", "district")


def _day(text: Column) -> Column:
    """Days since 1970 of a date or of the Japanese day of an instant, as written."""
    return F.unix_date(normalised(text, "Asia/Tokyo", as_date=True).try_cast("date"))


def p1_pairs(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "gpx_yamap_activity_link_candidates").where("link_id is not null")
    once = lambda status, *columns: scatter(links.where(F.col("match_status") == status).select("link_id", *columns).dropDuplicates(["link_id"]))
    gpx = once("no_candidate", "gpx_track_name", "gpx_first_time_jst", "gpx_first_time_utc", "gpx_filename_timestamp", "gpx_distance_km", "gpx_duration_min")
    utc = normalised(F.col("gpx_first_time_utc"), "UTC")
    left = gpx.select(
        F.col("link_id").alias("id"), F.col("gpx_track_name").alias("text"), F.coalesce(F.unix_date(F.substring("gpx_first_time_jst", 1, 10).try_cast("date")), _day(utc), _day(F.col("gpx_filename_timestamp"))).alias("day"),
        F.col("gpx_distance_km").alias("km"), F.col("gpx_duration_min").cast("double").alias("minutes"),
    )
    diary = once("unlinked_activity", "yamap_title", "yamap_date", "yamap_distance", "yamap_time")
    written = F.nullif(F.regexp_extract("yamap_title", r"[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}", 0), F.lit(""))
    right = diary.select(F.col("link_id").alias("id"), F.col("yamap_title").alias("text"), F.coalesce(_day(F.col("yamap_date")), _day(written)).alias("day"), kilometres(F.col("yamap_distance")).alias("km"), minutes(F.col("yamap_time")).alias("minutes"))
    texts = links.where("match_status = 'no_candidate'").select(F.col("gpx_track_name").alias("text")).union(links.where("match_status = 'unlinked_activity'").select("yamap_title"))
    tokens = cut_lineage(tokens_of(scatter(texts.where("text is not null").distinct()), _mountains(spark, folder)))
    named = lambda df: df.join(tokens, "text", "left").select("id", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"), F.coalesce("named", F.lit(False)).alias("named"), "day", "km", "minutes")
    return linked(named(left), named(right))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = p1_pairs(spark, folder)
    return pairs.select(F.least("id_a", "id_b").alias("link_id_a"), F.greatest("id_a", "id_b").alias("link_id_b")).distinct()


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "gpx_yamap_activity_link_candidates")
    found = resolve_names(links, "link_id", "gpx_track_name", _mountains(spark, folder))
    return found.select("link_id", F.col("number").alias("mountain_no")).distinct()


def p3_near(spark: SparkSession, folder: str) -> DataFrame:
    """All entries within the distance of each item's length."""
    return all_within(table(spark, folder, "gpx_yamap_activity_link_candidates"), "link_id", "gpx_track_name", _mountains(spark, folder)).withColumnRenamed("number", "mountain_no")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "heldout_items"), "item_id", "text")


def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    return filler(table(spark, folder, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_shares(spark, folder).select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p1_found, p1_pairs, p3_found, p3_near, p8_ids, p9_found, p10_found, p10_shares)}
_LETTERS = lambda c: f"regexp_replace(lower({nfkc_sql(c)}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_WINDOWS = lambda key, name: f"SELECT DISTINCT {key}, substr(t, i, 50) AS w FROM (SELECT {key}, t, unnest(range(1, length(t) - 48)) AS i FROM (SELECT {key}, {_LETTERS('text')} AS t FROM {name} WHERE text IS NOT NULL))"
ORACLES: dict[str, str] = {
    "p9_found": f"SELECT DISTINCT doc_id, item_id FROM ({_WINDOWS('doc_id', 'documents')}) d JOIN ({_WINDOWS('item_id', 'heldout_items')}) h USING (w)",
}
