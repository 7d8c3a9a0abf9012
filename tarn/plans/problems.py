"""The pN_ queries of the general problems, over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarn.operators.nearby import within_radius
from tarn.operators.packed import explode_packed
from tarn.operators.spikes import implausible
from tarn.operators.stays import segments
from tarn.operators.timestamps import normalise_fields
from tarn.session import table

RADIUS_M = 300.0


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    stays = segments(table(spark, folder, "trkpt")).where("kind = 'stay'")
    return stays.select("gpx_path", F.floor((F.col("start_s") + F.col("end_s")) / 2 / 1800).alias("stop_slot")).distinct()


def p2_segments(spark: SparkSession, folder: str) -> DataFrame:
    return segments(table(spark, folder, "trkpt"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return implausible(table(spark, folder, "trkpt"), table(spark, folder, "summit_candidate_detection_baseline_summary")).distinct()


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "gpx_yamap_activity_link_candidates")
    return normalise_fields(links, "link_id", {"gpx_filename_timestamp": "Asia/Tokyo", "gpx_first_time_utc": "UTC"}, {"yamap_date": "Asia/Tokyo"})


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    codes = explode_packed(table(spark, folder, "proposed_summit_assignments"), "assignment_id", "review_reason_codes")
    return codes.unionByName(explode_packed(table(spark, folder, "gpx_yamap_activity_link_candidates"), "link_id", "gpx_track_name"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    mountains = table(spark, folder, "ehime_mountain_source_rows").select(F.col("mountain_no").alias("region"), "coordinates.lat", "coordinates.lon")
    points = table(spark, folder, "summit_candidates").select("summit_candidate_id", "lat", "lon").where("summit_candidate_id is not null")
    found = within_radius(mountains.where("region is not null"), points, RADIUS_M)
    return found.select(F.col("region").alias("mountain_no"), "summit_candidate_id").distinct()


QUERIES = {f.__name__: f for f in (p2_found, p2_segments, p4_found, p5_found, p6_found, p7_found)}

ORACLES = {
    "p7_found": """
        SELECT DISTINCT m.mountain_no, s.summit_candidate_id
        FROM ehime_mountain_source_rows m JOIN summit_candidates s
          ON s.lat IS NOT NULL AND s.lon IS NOT NULL AND NOT isnan(s.lat) AND NOT isnan(s.lon)
         AND 2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(s.lat - m.coordinates.lat) / 2), 2)
             + cos(radians(m.coordinates.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - m.coordinates.lon) / 2), 2)))) <= 300
        WHERE m.coordinates.lat IS NOT NULL AND m.coordinates.lon IS NOT NULL""",
}
