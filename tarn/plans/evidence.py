"""Queries of links by several kinds of evidence, of text functions around them, and of checks between tables, with the same in SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarn.functions.text import flags, is_alias, lat_lon, name_form, name_score, one_of, place_parts, plain_markup, seconds_into_day, squeezed, time_forms, title_form, title_list, written_date
from tarn.operators import evidence, linkage, profile, quality, ranking, summary
from tarn.plans.places import _A, _C, _D, _candidates, _mountains
from tarn.plans.reference import _RANKED, _SIDES, _SQ, _TOK, _sides, names_sql, rank_links
from tarn.session import table


def _assignments(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.last_wins(table(spark, folder, "proposed_summit_assignments"), "assignment_id", "loaded_at")


def link_direct_first(spark: SparkSession, folder: str) -> DataFrame:
    """Tracks that name an activity's id are linked by it; only the others are linked by date and title."""
    tracks, activities = _sides(spark, folder)
    links = table(spark, folder, "gpx_yamap_activity_link_candidates").where("gpx_path is not null and match_status = 'direct_id_match'")
    direct = links.groupBy(F.col("gpx_path").alias("track")).agg(F.min("candidate_yamap_activity_id").alias("direct"))
    found, rest = evidence.direct_first(tracks.join(direct, "track", "left"), activities)
    sure = found.select("track", "activity", F.lit("direct_id_match").alias("match_status"), F.lit(None).cast("string").alias("notes"))
    return sure.unionByName(linkage.link_by_date_and_title(rest, activities))


def link_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Mountains and candidates that a name, 10 m of height or 300 m of distance links."""
    regions = _mountains(spark, folder).select(F.col("mountain_no").alias("region"), squeezed(F.col("mountain_name")).alias("name"), F.col("elevation_m").alias("height"), F.col("m_lat").alias("lat"), F.col("m_lon").alias("lon"))
    points = _candidates(spark, folder).select(F.col("summit_candidate_id").alias("id"), squeezed(F.col("track_name")).alias("text"), F.col("ele_m").alias("height"), "lat", "lon")
    return evidence.evidence_links(regions, points, 10.0, 300.0)


def link_lookups(spark: SparkSession, folder: str) -> DataFrame:
    """Each assignment with what other tables know of its mountain, candidate and track."""
    rows = _assignments(spark, folder).select("assignment_id", "mountain_no", F.col("proposed_summit_candidate_id").alias("summit_candidate_id"), F.col("source_gpx_path").alias("gpx_path"))
    mountains = table(spark, folder, "ehime_mountain_source_rows").select("mountain_no", F.col("mountain_name").alias("listed_name"), "elevation_m", "source_row_no")
    candidates = _candidates(spark, folder).select("summit_candidate_id", "ele_m", F.col("source_gpx_path").alias("_order"))
    tracks = table(spark, folder, "summit_candidate_detection_baseline_summary").select("gpx_path", "trackpoint_count", F.col("first_time_utc").alias("_order"))
    links = table(spark, folder, "gpx_yamap_activity_link_candidates").where("gpx_path is not null").groupBy("gpx_path").agg(F.countDistinct("link_id").alias("links"), F.lit(0).alias("_order"))
    return evidence.with_lookups(rows, (mountains, "mountain_no", "source_row_no"), (candidates, "summit_candidate_id", "_order"), (tracks, "gpx_path", "_order"), (links, "gpx_path", "_order"))


def text_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of the activities linked to a track, the best first, and how well they and the track's name name an assigned mountain."""
    links = table(spark, folder, "gpx_yamap_activity_link_candidates").where("gpx_path is not null").select("gpx_path", "gpx_track_name", "yamap_title", "match_status")
    known = links.groupBy("gpx_path").agg(
        F.min("gpx_track_name").alias("track"), F.min(F.when(F.col("match_status") == "single_high_confidence_candidate", F.col("yamap_title"))).alias("best"), F.array_sort(F.collect_set("yamap_title")).alias("titles")
    )
    rows = _assignments(spark, folder).select("assignment_id", F.col("source_gpx_path").alias("gpx_path"), "mountain_name").join(known, "gpx_path")
    score = name_score(F.col("mountain_name"), F.col("track"), F.col("best"), F.col("titles"))
    return rows.select("assignment_id", F.concat_ws(";", title_list(F.col("best"), F.col("titles"))).alias("titles"), F.round(score, 6).alias("score"), is_alias(F.array("mountain_name", "track")).alias("alias"))


def text_times(spark: SparkSession, folder: str) -> DataFrame:
    """Seconds from an activity's day to the first fix, and the written forms of that instant."""
    rows = table(spark, folder, "gpx_yamap_activity_link_candidates").where("gpx_first_time_jst is not null").select("link_id", "gpx_first_time_jst", "yamap_date").distinct()
    local = F.substring("gpx_first_time_jst", 1, 19).try_cast("timestamp_ntz")
    forms = time_forms(F.substring("gpx_first_time_jst", 1, 19).try_cast("timestamp") - F.expr("INTERVAL 9 HOURS"))
    return rows.select("link_id", seconds_into_day(local, written_date(F.col("yamap_date"))).alias("time_delta_seconds"), forms.alias("f")).select("link_id", "time_delta_seconds", "f.*").distinct()


def text_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    """Written coordinates and places of the list, taken apart."""
    rows = table(spark, folder, "ehime_mountain_source_rows").select("mountain_no", lat_lon(F.col("coordinates.raw")).alias("c"), place_parts(F.col("location.municipality_or_island")).alias("p"))
    return rows.select("mountain_no", "c.lat", "c.lon", "p.municipality", "p.island")


def text_markup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").where("text is not null").select("doc_id", F.split("text", "\n")[0].alias("line"))
    return rows.select("doc_id", plain_markup(F.col("line"), "# ").alias("line"))


def text_forms(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "summit_candidate_detection_baseline_summary").select("gpx_path", "track_name").distinct()
    return rows.select("gpx_path", title_form(F.col("track_name")).alias("title_form"), name_form(F.col("track_name")).alias("name_form"))


def rows_flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Tracks with any of several marks of an outlier."""
    rows = table(spark, folder, "summit_candidate_detection_baseline_summary").distinct()
    marks = flags({"no candidates": F.col("candidate_count_default") == 0, "many candidates": F.col("candidate_count_default") >= 5, "few points": F.col("trackpoint_count") < 100, "flat": F.col("elevation_range") < 50, "missing elevation": F.col("has_missing_elevation")})
    return rows.select("gpx_path", marks.alias("m")).where(F.size("m") > 0).select("gpx_path", F.concat_ws("|", "m").alias("flags")).distinct()


def rows_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Assignments of some categories, a missing category counting as one of them."""
    return _assignments(spark, folder).where(one_of(F.col("review_category"), "none", "none", "full_review")).select("assignment_id", "review_category")


def rank_review(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.in_review(rank_links(spark, folder), "mountain_no", 0.05).select("mountain_no", "proposed_summit_candidate_id", "rank_left")


def check_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Fixes and tracks against the counts that the summary states."""
    fixes = profile.once(table(spark, folder, "trkpt").select("gpx_path", "trk_idx", "seg_idx", "pt_idx"), "gpx_path", "trk_idx", "seg_idx", "pt_idx")
    heads = table(spark, folder, "summit_candidate_detection_baseline_summary").select("gpx_path", "trackpoint_count").distinct()
    stated = heads.agg(F.sum("trackpoint_count").alias("fixes"), F.countDistinct("gpx_path").alias("tracks")).select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("stated")) for n in ("fixes", "tracks")))).alias("s")).select("s.*")
    return quality.counts_match({"fixes": fixes, "tracks": fixes.select("gpx_path").distinct()}, stated)


def check_split(spark: SparkSession, folder: str) -> DataFrame:
    """Assignments that need review and those that don't: together all, none twice."""
    rows = _assignments(spark, folder).select("assignment_id", "needs_human_review")
    need = F.coalesce(F.col("needs_human_review"), F.lit(True))
    return evidence.split_covers(rows, rows.where(need), rows.where(~need))


def summary_compared(spark: SparkSession, folder: str) -> DataFrame:
    """Categories of all assignments and of those of high confidence."""
    rows = _assignments(spark, folder)
    return evidence.compared(rows, rows.where("confidence >= 0.5"), "review_category")


def link_index(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of each track in the order of their numbers."""
    rows = profile.once(table(spark, folder, "summit_candidates").select("summit_candidate_id", "candidate_index_in_gpx", F.col("source_gpx_path").alias("gpx_path")), "summit_candidate_id")
    return linkage.indexed(rows, "gpx_path", "candidate_index_in_gpx", "summit_candidate_id")


def link_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Assignments whose candidate is known, with its height, and those whose is not."""
    rows = _assignments(spark, folder).select("assignment_id", F.col("proposed_summit_candidate_id").alias("summit_candidate_id"))
    found, missing = linkage.looked_up(rows, _candidates(spark, folder).select("summit_candidate_id", "ele_m"), "summit_candidate_id")
    return found.withColumn("known", F.lit(True)).unionByName(missing.withColumns({"ele_m": F.lit(None).cast("double"), "known": F.lit(False)}))


def summary_passes(spark: SparkSession, folder: str) -> DataFrame:
    near, like = F.col("distance_csv_to_proposed_m"), F.abs("elevation_diff_csv_to_proposed_m")
    return summary.pass_counts(_assignments(spark, folder), {"within 300 m": near <= 300, "within 50 m of height": like <= 50, "both": (near <= 300) & (like <= 50), "no review": ~F.col("needs_human_review")})


QUERIES = {f.__name__: f for f in (
    link_direct_first, link_evidence, link_lookups, text_titles, text_times, text_coordinates, text_markup, text_forms, rows_flagged, rows_categories, rank_review, check_counts, check_split, summary_compared, link_index, link_missing, summary_passes,
)}


def nfkc_sql(c: str) -> str:
    """NFKC in SQL: compatibility characters of one character by translate, half-width kana with their marks before, longer ones by replace, then NFC."""
    halves = "".join(chr(x) for x in range(0xFF66, 0xFF9E))
    for half in halves:
        for mark in "ﾞﾟ":
            if len(whole := unicodedata.normalize("NFKC", half + mark)) == 1:
                c = f"replace({c}, '{half}{mark}', '{whole}')"
    single = [(chr(x), unicodedata.normalize("NFKC", chr(x))) for x in range(0xA0, 0xFFFF) if not 0xD800 <= x < 0xE000]
    longer = [(a, b) for a, b in single if len(b) > 1 and 0x3000 <= ord(a) < 0x3400]
    single = [(a, b) for a, b in single if len(b) == 1 and a != b and b != "'"]
    for a, b in longer:
        if 0x3380 <= ord(a) < 0x33E0:  # the square units
            c = f"replace({c}, '{a}', '{b}')"
    return f"nfc_normalize(translate({c}, '{''.join(a for a, _ in single)}', '{''.join(b for _, b in single)}'))"


_L = "gpx_yamap_activity_link_candidates"
_LINK_M = "SELECT mountain_no AS region, " + _SQ("mountain_name") + " AS name, elevation_m, coordinates.lat AS lat, coordinates.lon AS lon FROM ehime_mountain_source_rows"
_LINK_C = "SELECT DISTINCT summit_candidate_id AS id, " + _SQ("track_name") + " AS text, ele_m, lat, lon FROM summit_candidates"
_DAY = lambda c: f"CASE WHEN regexp_matches({c}, '[0-9]{{4}}[-年][0-9]{{2}}[-月][0-9]{{2}}') THEN regexp_replace(regexp_extract({c}, '[0-9]{{4}}[-年][0-9]{{2}}[-月][0-9]{{2}}'), '[年月]', '-', 'g') ELSE {c} END"
_LIKE = lambda t: f"CASE WHEN len(list_distinct({_TOK('mountain_name')} || {_TOK(t)})) = 0 THEN 0 ELSE len(list_intersect({_TOK('mountain_name')}, {_TOK(t)})) / len(list_distinct({_TOK('mountain_name')} || {_TOK(t)})) END"

ORACLES = {
    "link_direct_first": f"""WITH d AS (SELECT gpx_path AS track, min(candidate_yamap_activity_id) AS activity FROM {_L} WHERE gpx_path IS NOT NULL AND match_status = 'direct_id_match' GROUP BY 1 HAVING min(candidate_yamap_activity_id) IS NOT NULL),
        {_SIDES.replace("WHERE gpx_path IS NOT NULL", "WHERE gpx_path IS NOT NULL AND gpx_path NOT IN (SELECT track FROM d)")} SELECT track, activity, match_status, notes FROM linked UNION ALL SELECT track, activity, 'direct_id_match', NULL FROM d""",
    "link_evidence": f"""SELECT * FROM (SELECT region, id, coalesce(name <> '' AND text <> '' AND {names_sql('name', 'text')}, false) AS by_name, coalesce(abs(m.elevation_m - c.ele_m) <= 10, false) AS by_height,
        coalesce(abs(c.lat - m.lat) < 0.01 AND {_D('m', 'c')} <= 300, false) AS by_place FROM ({_LINK_M}) m, ({_LINK_C}) c) WHERE by_name OR by_height OR by_place""",
    "link_lookups": f"""SELECT a.assignment_id, a.mountain_no, a.proposed_summit_candidate_id AS summit_candidate_id, a.source_gpx_path AS gpx_path, m.mountain_name AS listed_name, m.elevation_m, c.ele_m, t.trackpoint_count, l.links FROM ({_A}) a LEFT JOIN ehime_mountain_source_rows m USING (mountain_no)
        LEFT JOIN ({_C}) c ON c.summit_candidate_id = a.proposed_summit_candidate_id LEFT JOIN (SELECT DISTINCT gpx_path, trackpoint_count FROM summit_candidate_detection_baseline_summary) t ON t.gpx_path = a.source_gpx_path
        LEFT JOIN (SELECT gpx_path, count(DISTINCT link_id) AS links FROM {_L} WHERE gpx_path IS NOT NULL GROUP BY 1) l ON l.gpx_path = a.source_gpx_path""",
    "text_titles": f"""WITH k AS (SELECT gpx_path, min(gpx_track_name) AS track, min(yamap_title) FILTER (WHERE match_status = 'single_high_confidence_candidate') AS best, coalesce(list(DISTINCT yamap_title ORDER BY yamap_title) FILTER (WHERE yamap_title IS NOT NULL), []) AS titles FROM {_L} WHERE gpx_path IS NOT NULL GROUP BY 1),
        r AS (SELECT assignment_id, mountain_name, k.* FROM ({_A}) a JOIN k ON k.gpx_path = a.source_gpx_path), u AS (SELECT assignment_id, max({_LIKE('title')}) AS best_of FROM (SELECT assignment_id, mountain_name, unnest(titles) AS title FROM r) GROUP BY 1)
        SELECT assignment_id, array_to_string(list_filter(CASE WHEN best IS NULL THEN titles ELSE [best] || list_filter(titles, lambda t: t <> best) END, lambda t: t <> ''), ';') AS titles,
        round(greatest(CASE WHEN coalesce(contains(track, mountain_name) AND mountain_name <> '', false) THEN 1.0 ELSE 0.0 END, coalesce({_LIKE("coalesce(best, '')")}, 0.0), coalesce(best_of, 0.0)), 6) AS score,
        coalesce(track <> mountain_name AND (contains(track, mountain_name) OR contains(mountain_name, track)), false) AS alias FROM r LEFT JOIN u USING (assignment_id)""",
    "text_times": f"""SELECT DISTINCT link_id, CAST(epoch(try_cast(substr(gpx_first_time_jst, 1, 19) AS TIMESTAMP)) - epoch(CAST(try_cast({_DAY("replace(yamap_date, '/', '-')")} AS DATE) AS TIMESTAMP)) AS BIGINT) AS time_delta_seconds, strftime(j - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS minute,
        strftime(j - INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS utc, strftime(j, '%Y-%m-%dT%H:%M:%S+0900') AS jst FROM (SELECT *, try_cast(substr(gpx_first_time_jst, 1, 19) AS TIMESTAMP) AS j FROM {_L} WHERE gpx_first_time_jst IS NOT NULL)""",
    "text_coordinates": """SELECT mountain_no, CASE WHEN ok THEN CAST(regexp_extract(raw, p, 1) AS DOUBLE) END AS lat, CASE WHEN ok THEN CAST(regexp_extract(raw, p, 2) AS DOUBLE) END AS lon, CASE WHEN NOT ends_with(place, '島') THEN place END AS municipality, CASE WHEN ends_with(place, '島') THEN place END AS island
        FROM (SELECT *, coalesce(regexp_matches(raw, p) AND try_cast(regexp_extract(raw, p, 1) AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(regexp_extract(raw, p, 2) AS DOUBLE) BETWEEN -180 AND 180, false) AS ok
        FROM (SELECT mountain_no, coordinates.raw AS raw, nullif(trim(location.municipality_or_island), '') AS place, '^\\s*[Nn]?\\s*(-?[0-9]+(?:\\.[0-9]+)?)\\s*[,\\s]\\s*[Ee]?\\s*(-?[0-9]+(?:\\.[0-9]+)?)\\s*$' AS p FROM ehime_mountain_source_rows))""",
    "text_markup": """SELECT doc_id, replace(replace(replace(replace(trim(replace(CASE WHEN starts_with(line, '# ') THEN substr(line, 3) ELSE line END, '`', '')), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS line FROM (SELECT doc_id, string_split(text, chr(10))[1] AS line FROM documents WHERE text IS NOT NULL)""",
    "text_forms": f"""SELECT gpx_path, {_SQ('n')} AS title_form, lower(trim(regexp_replace(coalesce(n, ''), '[ \\t\\r\\n\\f\\x0B\\x{{00A0}}\\x{{3000}}]+', ' ', 'g'))) AS name_form FROM (SELECT DISTINCT gpx_path, {nfkc_sql('track_name')} AS n FROM summit_candidate_detection_baseline_summary)""",
    "rows_flagged": """SELECT DISTINCT gpx_path, array_to_string(m, '|') AS flags FROM (SELECT gpx_path, list_filter([CASE WHEN candidate_count_default = 0 THEN 'no candidates' END, CASE WHEN candidate_count_default >= 5 THEN 'many candidates' END, CASE WHEN trackpoint_count < 100 THEN 'few points' END,
        CASE WHEN elevation_range < 50 THEN 'flat' END, CASE WHEN has_missing_elevation THEN 'missing elevation' END], lambda x: x IS NOT NULL) AS m FROM summit_candidate_detection_baseline_summary) WHERE len(m) > 0""",
    "rows_categories": f"SELECT assignment_id, review_category FROM ({_A}) WHERE coalesce(review_category, 'none') IN ('none', 'full_review')",
    "link_index": """SELECT *, CAST(row_number() OVER (PARTITION BY gpx_path ORDER BY candidate_index_in_gpx, summit_candidate_id) AS INT) AS place, count(*) OVER (PARTITION BY gpx_path) AS n
        FROM (SELECT DISTINCT summit_candidate_id, candidate_index_in_gpx, source_gpx_path AS gpx_path FROM summit_candidates) WHERE gpx_path IS NOT NULL""",
    "link_missing": f"SELECT assignment_id, proposed_summit_candidate_id AS summit_candidate_id, c.ele_m, c.summit_candidate_id IS NOT NULL AS known FROM ({_A}) a LEFT JOIN ({_C}) c ON c.summit_candidate_id = a.proposed_summit_candidate_id",
    "summary_passes": f"""WITH a AS ({_A}), p AS (SELECT 'within 300 m' AS rule, count(*) FILTER (WHERE distance_csv_to_proposed_m <= 300) AS passed FROM a UNION ALL SELECT 'within 50 m of height', count(*) FILTER (WHERE abs(elevation_diff_csv_to_proposed_m) <= 50) FROM a
        UNION ALL SELECT 'both', count(*) FILTER (WHERE distance_csv_to_proposed_m <= 300 AND abs(elevation_diff_csv_to_proposed_m) <= 50) FROM a UNION ALL SELECT 'no review', count(*) FILTER (WHERE NOT needs_human_review) FROM a) SELECT *, round(passed * 100.0 / (SELECT count(*) FROM a), 2) AS pct FROM p""",
    "rank_review": f"SELECT mountain_no, proposed_summit_candidate_id, CAST(rank_left AS INT) AS rank_left FROM ({_RANKED}) WHERE rank_left = 1 OR (rank_left <= 3 AND gap_top <= 0.05)",
    "check_counts": """WITH f AS (SELECT DISTINCT gpx_path, trk_idx, seg_idx, pt_idx FROM trkpt), h AS (SELECT DISTINCT gpx_path, trackpoint_count FROM summit_candidate_detection_baseline_summary)
        SELECT *, stated = actual AS passed FROM (SELECT 'fixes' AS name, (SELECT CAST(sum(trackpoint_count) AS BIGINT) FROM h) AS stated, (SELECT count(*) FROM f) AS actual UNION ALL SELECT 'tracks', (SELECT count(DISTINCT gpx_path) FROM h), (SELECT count(DISTINCT gpx_path) FROM f))""",
    "check_split": f"SELECT count(*) AS rows, count(*) AS in_parts, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS too_many, true AS passed FROM ({_A})",
    "summary_compared": f"""SELECT 'review_category' AS dimension, coalesce(review_category, '') AS value, count(*) AS before, count(*) FILTER (WHERE confidence >= 0.5) AS after, count(*) FILTER (WHERE confidence >= 0.5) - count(*) AS change FROM ({_A}) GROUP BY 2""",
}
