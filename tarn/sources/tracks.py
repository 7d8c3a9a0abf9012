"""Track files (GPX 1.1), with positions of every point made explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarn.functions.text import basename

#: The elements of GPX, the file names of tracks and the address of an activity.
FILE_TIME = r"^yamap_(\d{4}-\d{2}-\d{2}_\d{2}_\d{2})\.gpx"
ACTIVITY = r"yamap\.com/activities/(\d+)"
POINT = "_lat: DOUBLE, _lon: DOUBLE, ele: STRING, time: STRING"
SCHEMA = f"""_creator STRING, metadata STRUCT<name: STRING, bounds: STRUCT<_minlat: DOUBLE, _minlon: DOUBLE, _maxlat: DOUBLE, _maxlon: DOUBLE>>,
    wpt ARRAY<STRUCT<{POINT}, name: STRING, desc: STRING>>, trk ARRAY<STRUCT<name: STRING, number: INT, trkseg: ARRAY<STRUCT<trkpt: ARRAY<STRUCT<{POINT}>>>>>>, _corrupt STRING"""


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: gpx_path, creator, name, metadata, wpt, trk, error (true where the XML can't be read), notes (what stands there then).

    name is the first non-empty name in document order: of the metadata, a waypoint, a track.
    """
    files = spark.read.format("xml").option("rowTag", "gpx").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(SCHEMA).load(path)
    names = F.concat(F.array("metadata.name"), F.coalesce(F.transform("wpt", lambda w: w["name"]), F.array().cast("array<string>")), F.coalesce(F.transform("trk", lambda t: t["name"]), F.array().cast("array<string>")))
    first = F.get(F.filter(names, lambda n: F.coalesce(F.trim(n), F.lit("")) != ""), F.lit(0))
    return files.select(F.col("_metadata.file_path").alias("gpx_path"), F.col("_creator").alias("creator"), F.coalesce(first, F.lit("")).alias("name"), "metadata", "wpt", "trk", F.col("_corrupt").isNotNull().alias("error"), F.when(F.col("_corrupt").isNotNull(), F.concat(F.lit("Parse error: "), F.substring("_corrupt", 1, 80))).alias("notes"))


def trackpoints(tracks: DataFrame) -> DataFrame:
    """One row per point, in document order by (trk_idx, seg_idx, pt_idx); missing positions are 0, unreadable elevations null."""
    rows = tracks.select("gpx_path", F.posexplode("trk").alias("trk_idx", "t"))
    rows = rows.select("gpx_path", "trk_idx", F.posexplode("t.trkseg").alias("seg_idx", "s"))
    rows = rows.select("gpx_path", "trk_idx", "seg_idx", F.posexplode("s.trkpt").alias("pt_idx", "p"))
    return rows.select("gpx_path", "trk_idx", "seg_idx", "pt_idx", F.coalesce("p._lat", F.lit(0.0)).alias("lat"), F.coalesce("p._lon", F.lit(0.0)).alias("lon"), F.col("p.ele").try_cast("double").alias("ele"), F.col("p.time").alias("time"))


def waypoints(tracks: DataFrame) -> DataFrame:
    """Candidates of annotated files: one row per waypoint with its number from 1; candidate_id is its name, or made of the number."""
    rows = tracks.select("gpx_path", F.posexplode("wpt").alias("pos", "w"))
    return rows.select("gpx_path", (F.col("pos") + 1).alias("candidate_index"), F.coalesce(F.nullif(F.trim("w.name"), F.lit("")), F.format_string("candidate %d", F.col("pos") + 1)).alias("candidate_id"), F.col("w._lat").alias("lat"), F.col("w._lon").alias("lon"), F.col("w.ele").try_cast("double").alias("ele"), F.col("w.name").alias("name"), F.col("w.desc").alias("desc"))


def header(tracks: DataFrame, points: DataFrame) -> DataFrame:
    """Per file: creator, name, points, first and last written time, and the time in its name."""
    at = F.struct("trk_idx", "seg_idx", "pt_idx")
    own = points.groupBy("gpx_path").agg(F.count("*").alias("points"), F.min_by("time", at).alias("first_time"), F.max_by("time", at).alias("last_time"))
    return tracks.select("gpx_path", "creator", "name", "error", "notes").join(own, "gpx_path", "left").withColumns({"points": F.coalesce("points", F.lit(0)), "filename_timestamp": filename_time(F.col("gpx_path"))})


def filename_time(path: Column) -> Column:
    """Zone-less time in a name like yamap_2022-02-15_10_36.gpx; null if there is none."""
    written = F.regexp_extract(basename(path), FILE_TIME, 1)
    return F.try_to_timestamp(written, F.lit("yyyy-MM-dd_HH_mm"))


def point_time(text: Column) -> Column:
    """UTC instant of a written time: with Z only without fraction, else any ISO time; null for others."""
    plain = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$") | (~text.endswith("Z") & text.rlike(r"^\d{4}-\d{2}-\d{2}"))
    return F.when(plain, text.try_cast("timestamp"))


def activity_links(spark: SparkSession, path: str) -> DataFrame:
    """(gpx_path, activity_id, has_site): links to activities anywhere in the text of files."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("gpx_path"), "value")
    return files.select("gpx_path", F.nullif(F.regexp_extract("value", ACTIVITY, 1), F.lit("")).alias("activity_id"), F.contains("value", F.lit("yamap.com")).alias("has_site"))
