"""Queries of the reference's own operators over the tables of a folder, with the same in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarn.functions.geo import finite
from tarn.functions.text import BLANK, NAME_ENDINGS, content_id, is_traverse, jaccard, squeezed, title_parts, tokens, written_date
from tarn.operators import linkage, profile, quality, ranking, summary
from tarn.session import table

POINT = ["trk_idx", "seg_idx", "pt_idx"]
#: The same white space in the SQL's regular expressions.
SQL_BLANK = r"[ \t\r\n\f\x0B\x{00A0}\x{3000}]+"


def _points(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "trkpt").select("gpx_path", *POINT, "lat", "lon", "ele", "time")
    return profile.once(rows, "gpx_path", *POINT)


def _assignments(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.last_wins(table(spark, folder, "proposed_summit_assignments"), "assignment_id", "loaded_at")


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "summit_candidates").select("summit_candidate_id", "source_gpx_path", "lat", "lon", "ele_m", "track_name")
    return profile.once(rows, "summit_candidate_id")


def _mountains(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ehime_mountain_source_rows")
    return rows.select("mountain_no", "csv_no", "source_row_no", "mountain_name", "elevation_m", F.col("location.municipality").alias("municipality"), F.col("coordinates.lat").alias("m_lat"), F.col("coordinates.lon").alias("m_lon"))


# Profiles and peaks


def profile_tracks(spark: SparkSession, folder: str) -> DataFrame:
    return profile.track_profile(_points(spark, folder), "gpx_path", POINT)


def profile_smoothed(spark: SparkSession, folder: str) -> DataFrame:
    rows = profile.smoothed(profile.valid_points(_points(spark, folder), "gpx_path", POINT, "ele"), "gpx_path", "ele", 5)
    return rows.select("gpx_path", "i", F.round("s", 4).alias("smoothed_ele"))


def peaks_raw(spark: SparkSession, folder: str) -> DataFrame:
    peaks = profile.raw_peaks(_points(spark, folder), "gpx_path", POINT, "ele", 5, 10)
    return peaks.select("gpx_path", "i", F.round("s", 4).alias("smoothed_ele"), F.round("prominence", 4).alias("prominence"))


def peaks_detect(spark: SparkSession, folder: str) -> DataFrame:
    peaks = profile.detect_peaks(_points(spark, folder), "gpx_path", POINT, "ele")
    return peaks.select("gpx_path", "i", "lat", "lon", "ele", "time", F.round("s", 6).alias("smoothed_ele"), F.round("prominence", 6).alias("prominence"), content_id("peak", F.col("gpx_path"), F.col("i")).alias("peak_id"))


def peaks_sensitivity(spark: SparkSession, folder: str) -> DataFrame:
    return profile.sweep(_points(spark, folder), "gpx_path", POINT, "ele")


def peaks_near_anchors(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder).where(finite(F.col("lat")) & finite(F.col("lon")) & finite(F.col("ele")))
    anchors = _candidates(spark, folder).where("lat is not null and lon is not null").select(F.col("summit_candidate_id").alias("anchor"), F.col("source_gpx_path").alias("gpx_path"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"))
    found = profile.around_nearest(points, anchors, "gpx_path")
    return found.withColumns({c: F.round(c, 4) for c in ("distance_m", "local_range", "peak_like")})


def corpus_statistics(spark: SparkSession, folder: str) -> DataFrame:
    per = _points(spark, folder).groupBy("gpx_path").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("tracks"), F.sum("n").alias("points"), F.min("n").alias("least"), F.max("n").alias("most"), F.median("n").alias("median"), F.round(F.avg("n"), 4).alias("mean"))


# Links by text and date


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    links = table(spark, folder, "gpx_yamap_activity_link_candidates")
    tracks = links.where("gpx_path is not null").groupBy(F.col("gpx_path").alias("track")).agg(F.min(F.substring("gpx_first_time_jst", 1, 10)).alias("t_date"), F.min(squeezed(F.col("gpx_track_name"))).alias("t_title"))
    activities = links.where("candidate_yamap_activity_id is not null").groupBy(F.col("candidate_yamap_activity_id").alias("activity")).agg(F.min(written_date(F.col("yamap_date"))).alias("a_date"), F.min(squeezed(F.col("yamap_title"))).alias("a_title"))
    return tracks, activities


def link_date_title(spark: SparkSession, folder: str) -> DataFrame:
    return linkage.link_by_date_and_title(*_sides(spark, folder))


def link_status_tally(spark: SparkSession, folder: str) -> DataFrame:
    return link_date_title(spark, folder).groupBy("match_status").agg(F.countDistinct("track").alias("tracks"))


def link_title_similarity(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "gpx_yamap_activity_link_candidates").where("gpx_track_name is not null and yamap_title is not null").select("link_id", "gpx_track_name", "yamap_title").distinct()
    a, b = F.array_distinct(tokens(F.col("gpx_track_name"))), F.array_distinct(tokens(F.col("yamap_title")))
    return links.select("link_id", F.size(F.array_intersect(a, b)).alias("shared"), F.size(F.array_except(a, b)).alias("only_track"), F.round(jaccard(a, b), 6).alias("score"))


def link_dates_both_ways(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "gpx_yamap_activity_link_candidates").select("link_id", "gpx_filename_timestamp").where("gpx_filename_timestamp is not null").distinct()
    written = F.try_to_timestamp(F.regexp_extract("gpx_filename_timestamp", r"^yamap_(\d{4}-\d{2}-\d{2}_\d{2}_\d{2})\.gpx", 1), F.lit("yyyy-MM-dd_HH_mm"))
    dates = linkage.dates_both_ways(written)
    return links.where(written.isNotNull()).select("link_id", F.explode(dates.cast("array<string>")).alias("activity_date"), (F.size(dates) > 1).alias("timezone_sensitive"))


def names_in_track_names(spark: SparkSession, folder: str) -> DataFrame:
    names = _mountains(spark, folder).select(F.col("mountain_no").alias("number"), squeezed(F.col("mountain_name")).alias("name"))
    texts = table(spark, folder, "summit_candidate_detection_baseline_summary").where("track_name is not null").select(F.col("gpx_path").alias("id"), squeezed(F.col("track_name")).alias("text")).distinct()
    return linkage.names_in_texts(names, texts).select(F.col("number").alias("mountain_no"), F.col("id").alias("gpx_path"))


def text_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "summit_candidate_detection_baseline_summary").select("gpx_path", "track_name").distinct()
    return rows.select("gpx_path", title_parts(F.col("track_name")).alias("parts"), F.size(tokens(F.col("track_name"))).alias("tokens"), is_traverse(F.col("track_name")).alias("traverse"))


def text_sections(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    heads = docs.withColumn("heading", F.when(F.col("line").rlike("^#{1,3} "), F.regexp_replace("line", "^#{1,3} ", "")))
    return ranking.carried_heading(heads, "doc_id", "line_no", "heading").where("section is not null").groupBy("doc_id", "section").agg(F.count("*").alias("lines"))


def text_copies(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("text is not null").select("doc_id", "text")
    rank = docs.groupBy(F.sha2("text", 256).alias("sha256")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))
    return rank.where("copies > 1")


# Summaries


def summary_stacked(spark: SparkSession, folder: str) -> DataFrame:
    rows = _assignments(spark, folder)
    return summary.stacked_counts(rows, {c: F.col(c) for c in ("run_id", "review_category", "proposed_coordinate_source", "needs_human_review")})


def summary_reason_codes(spark: SparkSession, folder: str) -> DataFrame:
    items = F.filter(F.transform(F.split(F.coalesce("review_reason_codes", F.lit("")), ";"), lambda x: F.regexp_replace(x, f"^{BLANK}|{BLANK}$", "")), lambda x: x != "")
    return summary.exploded_counts(_assignments(spark, folder), items)


def summary_shared(spark: SparkSession, folder: str) -> DataFrame:
    rows = _assignments(spark, folder).where("proposed_coordinate_source = 'gpx_summit_candidate'")
    return summary.shared(rows, "proposed_summit_candidate_id", "assignment_id", {"mountain_nos": "mountain_no", "assignments": "assignment_id"}, "distance_csv_to_proposed_m")


def summary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = _assignments(spark, folder)
    return summary.metrics(
        rows, rows=F.count("*"), with_candidate=F.count_if(F.coalesce(F.col("proposed_summit_candidate_id"), F.lit("")) != ""), candidates=F.countDistinct("proposed_summit_candidate_id"),
        review=F.count_if("needs_human_review"), median_distance=F.median("distance_csv_to_proposed_m"),
    )


def summary_examples(spark: SparkSession, folder: str) -> DataFrame:
    rows = _assignments(spark, folder).where("review_category is not null").select("review_category", "assignment_id")
    return summary.first_examples(rows, "review_category", "assignment_id")


def summary_json_keys(spark: SparkSession, folder: str) -> DataFrame:
    return summary.json_keys(table(spark, folder, "events"), "props")


def coverage_semi_anti(spark: SparkSession, folder: str) -> DataFrame:
    tracks = table(spark, folder, "summit_candidate_detection_baseline_summary").select("gpx_path").distinct()
    linked = table(spark, folder, "gpx_yamap_activity_link_candidates").where("gpx_path is not null").select("gpx_path").distinct()
    with_, without = tracks.join(linked, "gpx_path", "left_semi"), tracks.join(linked, "gpx_path", "left_anti")
    return with_.withColumn("linked", F.lit(True)).unionByName(without.withColumn("linked", F.lit(False)))


# Ranks


def rank_links(spark: SparkSession, folder: str) -> DataFrame:
    rows = _assignments(spark, folder).where("proposed_summit_candidate_id <> '' and confidence is not null and mountain_no is not null")
    links = rows.groupBy("mountain_no", "proposed_summit_candidate_id").agg(F.max("confidence").alias("confidence"))
    return ranking.ranked_links(links, "mountain_no", "proposed_summit_candidate_id", "confidence")


def rank_top3(spark: SparkSession, folder: str) -> DataFrame:
    rows = _assignments(spark, folder).where("mountain_no is not null").select("mountain_no", "assignment_id", "confidence")
    return ranking.top_links(rows, "mountain_no", "assignment_id", "confidence", 3)


def rank_overview(spark: SparkSession, folder: str) -> DataFrame:
    links = rank_links(spark, folder)
    return links.groupBy("proposed_summit_candidate_id").agg(F.count("*").alias("mountains"), F.count_if(F.col("rank_left") == 1).alias("tops"), F.max("confidence").alias("best"), F.round(F.max("confidence") - F.min("confidence"), 6).alias("spread"))


def fill_numbers(spark: SparkSession, folder: str) -> DataFrame:
    rows = _mountains(spark, folder).select("mountain_no", "csv_no", "source_row_no")
    return ranking.filled_sequence(rows, "csv_no", "source_row_no")


# Checks


def check_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.checks(_candidates(spark, folder), {
        "id present": F.col("summit_candidate_id").startswith("summit-candidate:"), "latitude in range": F.col("lat").between(32.0, 34.5), "longitude in range": F.col("lon").between(132.0, 133.8), "elevation present": F.col("ele_m").isNotNull(),
    })


def check_contiguous(spark: SparkSession, folder: str) -> DataFrame:
    return quality.contiguous(_mountains(spark, folder), "mountain_no")


def check_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicates(table(spark, folder, "summit_candidates"), "summit_candidate_id")


QUERIES = {f.__name__: f for f in (
    profile_tracks, profile_smoothed, peaks_raw, peaks_detect, peaks_sensitivity, peaks_near_anchors, corpus_statistics, link_date_title, link_status_tally, link_title_similarity, link_dates_both_ways, names_in_track_names,
    text_parts, text_sections, text_copies, summary_stacked, summary_reason_codes, summary_shared, summary_metrics, summary_examples, summary_json_keys, coverage_semi_anti, rank_links, rank_top3,
    rank_overview, fill_numbers, check_rules, check_contiguous, check_duplicates,
)}

_P = "SELECT DISTINCT gpx_path, trk_idx, seg_idx, pt_idx, lat, lon, ele, time FROM trkpt"
_V = f"SELECT *, row_number() OVER (PARTITION BY gpx_path ORDER BY trk_idx, seg_idx, pt_idx) - 1 AS i, count(*) OVER (PARTITION BY gpx_path) AS n FROM ({_P}) WHERE ele IS NOT NULL AND NOT isnan(ele)"
_S = f"SELECT *, avg(ele) OVER (PARTITION BY gpx_path ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS s FROM ({_V})"
_A = "SELECT DISTINCT ON (assignment_id) * FROM proposed_summit_assignments ORDER BY assignment_id, loaded_at DESC"
_C = "SELECT DISTINCT summit_candidate_id, source_gpx_path, lat, lon, ele_m, track_name FROM summit_candidates"
_SQ = lambda c: f"regexp_replace({c}, '{SQL_BLANK}', '', 'g')"
_SIDES = f"""t AS (SELECT gpx_path AS track, min(substr(gpx_first_time_jst, 1, 10)) AS t_date, min({_SQ('gpx_track_name')}) AS t_title FROM gpx_yamap_activity_link_candidates WHERE gpx_path IS NOT NULL GROUP BY 1),
    a AS (SELECT candidate_yamap_activity_id AS activity, min(CASE WHEN regexp_matches(d, '[0-9]{{4}}[-年][0-9]{{2}}[-月][0-9]{{2}}') THEN regexp_extract(d, '([0-9]{{4}})[-年]([0-9]{{2}})[-月]([0-9]{{2}})', 1) || '-' ||
        regexp_extract(d, '([0-9]{{4}})[-年]([0-9]{{2}})[-月]([0-9]{{2}})', 2) || '-' || regexp_extract(d, '([0-9]{{4}})[-年]([0-9]{{2}})[-月]([0-9]{{2}})', 3) ELSE d END) AS a_date, min({_SQ('yamap_title')}) AS a_title
      FROM (SELECT *, replace(yamap_date, '/', '-') AS d FROM gpx_yamap_activity_link_candidates) WHERE candidate_yamap_activity_id IS NOT NULL GROUP BY 1),
    sure AS (SELECT track, activity FROM t JOIN a ON t_date = a_date AND t_title = a_title AND t_title <> ''),
    open_ AS (SELECT * FROM t WHERE track NOT IN (SELECT track FROM sure)),
    review AS (SELECT track, activity, 'date match, title mismatch' AS notes FROM open_ JOIN a ON t_date = a_date UNION ALL
      SELECT track, activity, 'title match, date off by 1 day' FROM open_ JOIN a ON t_title = a_title AND t_title <> '' AND abs(date_diff('day', try_cast(t_date AS date), try_cast(a_date AS date))) = 1),
    linked AS (SELECT track, activity, CASE WHEN count(*) OVER (PARTITION BY track) = 1 THEN 'single_high_confidence_candidate' ELSE 'multiple_candidates' END AS match_status, NULL AS notes FROM sure UNION ALL
      SELECT track, activity, 'needs_review', notes FROM review UNION ALL
      SELECT track, NULL, 'no_candidate', NULL FROM t WHERE track NOT IN (SELECT track FROM sure) AND track NOT IN (SELECT track FROM review))"""
_TOK = lambda c: f"list_distinct(list_filter(regexp_split_to_array({c}, '[・/／,，、 \\t\\r\\n\\f\\x0B\\x{{00A0}}\\x{{3000}}\\-－〜~()（）+＋_]+'), lambda x: trim(x) <> ''))"


def names_sql(name: str, text: str) -> str:
    """names_match in SQL."""
    near = ", ".join([name, *(f"{name} || '{e}'" for e in NAME_ENDINGS), *(f"'{e}' || {name}" for e in NAME_ENDINGS)])
    return f"(contains({text}, {name}) AND (length({name}) > 2 OR list_has_any({_TOK(text)}, [{near}])))"


_LINKS = f"""SELECT mountain_no, proposed_summit_candidate_id, max(confidence) AS confidence FROM ({_A}) WHERE proposed_summit_candidate_id <> '' AND confidence IS NOT NULL AND mountain_no IS NOT NULL GROUP BY 1, 2"""
_RANKED = f"""SELECT *, row_number() OVER l AS rank_left, round(confidence - lead(confidence) OVER l, 6) AS gap_next, round(first(confidence) OVER l - confidence, 6) AS gap_top, row_number() OVER r AS rank_right FROM ({_LINKS})
    WINDOW l AS (PARTITION BY mountain_no ORDER BY confidence DESC, proposed_summit_candidate_id), r AS (PARTITION BY proposed_summit_candidate_id ORDER BY confidence DESC, mountain_no)"""

_HAV = lambda a, b: f"2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
_RAW = f"""s AS MATERIALIZED ({_S}), r AS (SELECT *, least(10, n // 3) AS r FROM s WHERE n >= 3),
        m AS (SELECT p.gpx_path, p.i, p.s, p.r, p.i >= p.r AND p.i < p.n - p.r AND min(CASE WHEN q.s < p.s THEN 1 ELSE 0 END) = 1 AS is_max FROM r p JOIN s q ON q.gpx_path = p.gpx_path AND q.i <> p.i AND abs(q.i - p.i) <= p.r GROUP BY p.gpx_path, p.i, p.s, p.r, p.n),
        t AS (SELECT gpx_path, min(i) AS top FROM (SELECT gpx_path, i FROM s QUALIFY rank() OVER (PARTITION BY gpx_path ORDER BY s DESC) = 1) GROUP BY 1),
        near AS (SELECT DISTINCT m.gpx_path FROM m JOIN t USING (gpx_path) WHERE is_max AND abs(i - top) < r),
        c AS (SELECT m.* FROM m JOIN t USING (gpx_path) WHERE is_max OR (i = top AND gpx_path NOT IN (SELECT gpx_path FROM near))),
        w AS (SELECT c.gpx_path, c.i, c.s, coalesce(max(CASE WHEN h.i < c.i THEN h.i END), -1) AS lo, coalesce(min(CASE WHEN h.i > c.i THEN h.i END), 1000000000) AS hi FROM c LEFT JOIN s h ON h.gpx_path = c.gpx_path AND h.s > c.s GROUP BY c.gpx_path, c.i, c.s),
        raw AS MATERIALIZED (SELECT x.*, o.lat, o.lon, o.ele, o.time FROM (SELECT w.gpx_path, w.i, w.s, w.s - greatest(min(CASE WHEN q.i <= w.i THEN q.s END), min(CASE WHEN q.i >= w.i THEN q.s END)) AS prominence
            FROM w JOIN s q ON q.gpx_path = w.gpx_path AND q.i > w.lo AND q.i < w.hi GROUP BY w.gpx_path, w.i, w.s) x JOIN s o ON o.gpx_path = x.gpx_path AND o.i = x.i)"""
#: Greedy suppression: peaks by height, each kept if none kept is near.
_RANKED_PEAKS = """v AS (SELECT * FROM {variants} v(variant_id, least_, near_m)), k AS MATERIALIZED (SELECT v.variant_id, v.near_m, raw.*, row_number() OVER (PARTITION BY v.variant_id, gpx_path ORDER BY ele DESC, i) AS n FROM raw, v WHERE prominence >= v.least_),
        g(variant_id, gpx_path, n, kept) AS (SELECT variant_id, gpx_path, n, [{{'i': i, 'lat': lat, 'lon': lon}}] FROM k WHERE n = 1 UNION ALL
            SELECT k.variant_id, k.gpx_path, k.n, CASE WHEN len(list_filter(g.kept, lambda o: """ + _HAV("o", "k") + """ < k.near_m)) > 0 THEN g.kept ELSE list_append(g.kept, {{'i': k.i, 'lat': k.lat, 'lon': k.lon}}) END FROM g JOIN k ON k.variant_id = g.variant_id AND k.gpx_path = g.gpx_path AND k.n = g.n + 1),
        last_ AS (SELECT variant_id, gpx_path, arg_max(kept, n) AS kept FROM g GROUP BY 1, 2)"""

ORACLES = {
    "profile_tracks": f"""SELECT gpx_path, count(*) AS trackpoint_count, count(e) AS valid_elevation_point_count, arg_min(time, k) FILTER (WHERE time IS NOT NULL) AS first_time, arg_max(time, k) FILTER (WHERE time IS NOT NULL) AS last_time,
        round(max(e), 2) AS max_elevation, round(min(e), 2) + 0.0 AS min_elevation, round(max(e) - min(e), 2) AS elevation_range, count(e) < count(*) AS has_missing_elevation
        FROM (SELECT *, CASE WHEN NOT isnan(ele) THEN ele END AS e, trk_idx * 1000000000 + seg_idx * 10000000 + pt_idx AS k FROM ({_P})) GROUP BY 1""",
    "profile_smoothed": f"SELECT gpx_path, CAST(i AS INT) AS i, round(s, 4) AS smoothed_ele FROM ({_S})",
    "peaks_raw": f"WITH {_RAW} SELECT gpx_path, CAST(i AS INT) AS i, round(s, 4) AS smoothed_ele, round(prominence, 4) AS prominence FROM raw",
    "peaks_detect": f"""WITH RECURSIVE {_RAW}, {_RANKED_PEAKS.format(variants="(VALUES ('baseline', 30.0, 100.0))")}
        SELECT gpx_path, CAST(k.i AS INT) AS i, r.lat, r.lon, r.ele, r.time, round(r.s, 6) AS smoothed_ele, round(r.prominence, 6) AS prominence, 'peak:' || substr(sha256(gpx_path || chr(31) || CAST(k.i AS VARCHAR)), 1, 16) AS peak_id
        FROM (SELECT gpx_path, unnest(kept) AS k FROM last_) JOIN raw r USING (gpx_path) WHERE r.i = k.i""",
    "peaks_sensitivity": f"""WITH RECURSIVE {_RAW}, {_RANKED_PEAKS.format(variants="(VALUES ('baseline', 30.0, 100.0), ('lower_prominence', 20.0, 100.0), ('higher_prominence', 50.0, 100.0), ('smaller_merge', 30.0, 50.0), ('larger_merge', 30.0, 200.0))")},
        per AS (SELECT v.variant_id, t.gpx_path, coalesce(len(l.kept), 0) AS c FROM (SELECT DISTINCT gpx_path FROM trkpt) t CROSS JOIN v LEFT JOIN last_ l ON l.gpx_path = t.gpx_path AND l.variant_id = v.variant_id)
        SELECT variant_id, count(*) AS gpx_files_scanned, CAST(sum(c) AS BIGINT) AS total_candidates, count(*) FILTER (WHERE c = 0) AS files_with_zero_candidates, count(*) FILTER (WHERE c = 1) AS files_with_one_candidate, count(*) FILTER (WHERE c > 1) AS files_with_multiple_candidates,
        median(c) AS median_candidates_per_file, max(c) AS max_candidates_per_file FROM per GROUP BY 1""",
    "peaks_near_anchors": f"""WITH p AS (SELECT DISTINCT gpx_path, trk_idx, seg_idx, pt_idx, lat, lon, ele FROM trkpt WHERE isfinite(lat) AND isfinite(lon) AND isfinite(ele)), a AS (SELECT DISTINCT summit_candidate_id AS anchor, source_gpx_path AS gpx_path, lat, lon FROM summit_candidates WHERE lat IS NOT NULL AND lon IS NOT NULL),
        b AS (SELECT * FROM (SELECT a.anchor, p.*, {_HAV('a', 'p')} AS d FROM a JOIN p USING (gpx_path)) QUALIFY row_number() OVER (PARTITION BY anchor, gpx_path ORDER BY d, trk_idx, seg_idx, pt_idx) = 1),
        n AS (SELECT b.anchor, b.gpx_path, b.trk_idx, b.seg_idx, b.pt_idx, b.d, b.ele AS own, q.ele FROM b JOIN p q ON q.gpx_path = b.gpx_path AND q.trk_idx = b.trk_idx AND q.seg_idx = b.seg_idx AND abs(q.pt_idx - b.pt_idx) <= 10 WHERE b.d <= 300 AND {_HAV('q', 'b')} <= 100)
        SELECT anchor, gpx_path, trk_idx, seg_idx, pt_idx, round(d, 4) AS distance_m, count(*) AS points, round(max(ele) - min(ele), 4) AS local_range, round(CASE WHEN max(ele) > min(ele) THEN least(greatest(1 - (max(ele) - own) / (max(ele) - min(ele)), 0.0), 1.0) ELSE 1.0 END, 4) AS peak_like
        FROM n GROUP BY anchor, gpx_path, trk_idx, seg_idx, pt_idx, d, own""",
    "link_dates_both_ways": """SELECT link_id, CAST(unnest(list_distinct([CAST(w AS DATE), CAST(w + INTERVAL 9 HOUR AS DATE)])) AS VARCHAR) AS activity_date, CAST(w AS DATE) <> CAST(w + INTERVAL 9 HOUR AS DATE) AS timezone_sensitive
        FROM (SELECT DISTINCT link_id, gpx_filename_timestamp, try_strptime(regexp_extract(gpx_filename_timestamp, '^yamap_([0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{2}_[0-9]{2})\\.gpx', 1), '%Y-%m-%d_%H_%M') AS w FROM gpx_yamap_activity_link_candidates) WHERE w IS NOT NULL""",
    "corpus_statistics": f"SELECT count(*) AS tracks, CAST(sum(n) AS BIGINT) AS points, min(n) AS least, max(n) AS most, median(n) AS median, round(avg(n), 4) AS mean FROM (SELECT count(*) AS n FROM ({_P}) GROUP BY gpx_path)",
    "link_date_title": f"WITH {_SIDES} SELECT * FROM linked",
    "link_status_tally": f"WITH {_SIDES} SELECT match_status, count(DISTINCT track) AS tracks FROM linked GROUP BY 1",
    "link_title_similarity": f"""SELECT link_id, CAST(len(list_intersect(a, b)) AS INT) AS shared, CAST(len(a) - len(list_intersect(a, b)) AS INT) AS only_track,
        round(CASE WHEN len(a) + len(b) > 0 THEN len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) ELSE 0 END, 6) AS score FROM (SELECT link_id, {_TOK('gpx_track_name')} AS a, {_TOK('yamap_title')} AS b
        FROM (SELECT DISTINCT link_id, gpx_track_name, yamap_title FROM gpx_yamap_activity_link_candidates WHERE gpx_track_name IS NOT NULL AND yamap_title IS NOT NULL))""",
    "names_in_track_names": f"""SELECT DISTINCT mountain_no, gpx_path FROM (SELECT mountain_no, {_SQ('mountain_name')} AS name FROM ehime_mountain_source_rows) JOIN (SELECT DISTINCT gpx_path, {_SQ('track_name')} AS text
        FROM summit_candidate_detection_baseline_summary WHERE track_name IS NOT NULL) ON {names_sql('name', 'text')} AND name <> ''""",
    "text_parts": f"""SELECT gpx_path, CAST(CASE WHEN coalesce(track_name, '') = '' THEN 0 ELSE len(list_filter(regexp_split_to_array(track_name, '[・/／〜～→,、]'), lambda x: {_SQ('x')} <> '')) END AS INT) AS parts,
        CAST(len(list_filter(regexp_split_to_array(coalesce(track_name, ''), '[・/／,，、 \\t\\r\\n\\f\\x0B\\x{{00A0}}\\x{{3000}}\\-－〜~()（）+＋_]+'), lambda x: trim(x) <> '')) AS INT) AS tokens,
        coalesce(regexp_matches(track_name, '[・/／+＋]'), false) AS traverse FROM (SELECT DISTINCT gpx_path, track_name FROM summit_candidate_detection_baseline_summary)""",
    "text_sections": """SELECT doc_id, section, count(*) AS lines FROM (SELECT doc_id, last_value(CASE WHEN regexp_matches(line, '^#{1,3} ') THEN regexp_replace(line, '^#{1,3} ', '') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n) AS section
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents WHERE text IS NOT NULL)) WHERE section IS NOT NULL GROUP BY 1, 2""",
    "text_copies": "SELECT sha256(text) AS sha256, min(doc_id) AS first_doc, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "summary_stacked": f"""WITH a AS ({_A}) SELECT dimension, value, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM a), 2) AS pct FROM (SELECT 'run_id' AS dimension, coalesce(run_id, '') AS value FROM a UNION ALL
        SELECT 'review_category', coalesce(review_category, '') FROM a UNION ALL SELECT 'proposed_coordinate_source', coalesce(proposed_coordinate_source, '') FROM a UNION ALL
        SELECT 'needs_human_review', coalesce(CAST(needs_human_review AS VARCHAR), '') FROM a) GROUP BY 1, 2""",
    "summary_reason_codes": f"""WITH a AS ({_A}), l AS (SELECT list_filter(list_transform(string_split(coalesce(review_reason_codes, ''), ';'), lambda x: regexp_replace(x, '^{SQL_BLANK}|{SQL_BLANK}$', '', 'g')), lambda x: x <> '') AS items FROM a)
        SELECT value, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM a), 2) AS pct FROM (SELECT unnest(CASE WHEN len(items) > 0 THEN items ELSE ['none'] END) AS value FROM l) GROUP BY 1""",
    "summary_shared": f"""SELECT proposed_summit_candidate_id, count(*) AS shared_count, coalesce(string_agg(CAST(mountain_no AS VARCHAR), ';' ORDER BY assignment_id), '') AS mountain_nos, string_agg(CAST(assignment_id AS VARCHAR), ';' ORDER BY assignment_id) AS assignments,
        coalesce(min(distance_csv_to_proposed_m), 0.0) AS min_distance, coalesce(max(distance_csv_to_proposed_m), 0.0) AS max_distance FROM ({_A}) WHERE proposed_coordinate_source = 'gpx_summit_candidate' AND proposed_summit_candidate_id <> '' GROUP BY 1 HAVING count(*) > 1""",
    "summary_metrics": f"""WITH a AS ({_A}) SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM a UNION ALL SELECT 'with_candidate', count(*) FILTER (WHERE coalesce(proposed_summit_candidate_id, '') <> '') FROM a UNION ALL
        SELECT 'candidates', count(DISTINCT proposed_summit_candidate_id) FROM a UNION ALL SELECT 'review', count(*) FILTER (WHERE needs_human_review) FROM a UNION ALL SELECT 'median_distance', median(distance_csv_to_proposed_m) FROM a""",
    "summary_examples": f"SELECT review_category, assignment_id, CAST(e AS INT) AS example FROM (SELECT review_category, assignment_id, row_number() OVER (PARTITION BY review_category ORDER BY assignment_id) AS e FROM ({_A}) WHERE review_category IS NOT NULL) WHERE e <= 5",
    "summary_json_keys": "SELECT key, count(*) AS rows FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1",
    "coverage_semi_anti": "SELECT DISTINCT gpx_path, gpx_path IN (SELECT gpx_path FROM gpx_yamap_activity_link_candidates WHERE gpx_path IS NOT NULL) AS linked FROM summit_candidate_detection_baseline_summary",
    "rank_links": f"""SELECT mountain_no, proposed_summit_candidate_id, confidence, CAST(rank_left AS INT) AS rank_left, gap_next, gap_top, CAST(rank_right AS INT) AS rank_right, rank_left = 1 AND rank_right = 1 AS mutual_top1, rank_left <= 3 AND rank_right <= 3 AS mutual_top3,
        count(*) FILTER (WHERE rank_left = 1) OVER (PARTITION BY proposed_summit_candidate_id) > 1 AS shared_top FROM ({_RANKED})""",
    "rank_top3": f"SELECT mountain_no, assignment_id, confidence, CAST(r AS INT) AS rank FROM (SELECT mountain_no, assignment_id, confidence, row_number() OVER (PARTITION BY mountain_no ORDER BY confidence DESC NULLS LAST, assignment_id) AS r FROM ({_A}) WHERE mountain_no IS NOT NULL) WHERE r <= 3",
    "rank_overview": f"SELECT proposed_summit_candidate_id, count(*) AS mountains, count(*) FILTER (WHERE rank_left = 1) AS tops, max(confidence) AS best, round(max(confidence) - min(confidence), 6) AS spread FROM ({_RANKED}) GROUP BY 1",
    "fill_numbers": """SELECT mountain_no, CAST(coalesce(csv_no, (SELECT max(csv_no) FROM ehime_mountain_source_rows) + row_number() OVER (PARTITION BY csv_no IS NULL ORDER BY source_row_no)) AS INT) AS csv_no, source_row_no, csv_no IS NULL AS filled FROM ehime_mountain_source_rows""",
    "check_rules": f"""WITH c AS ({_C}) SELECT *, bad = 0 AS passed FROM (SELECT 'id present' AS "check", count(*) FILTER (WHERE NOT coalesce(starts_with(summit_candidate_id, 'summit-candidate:'), false)) AS bad FROM c UNION ALL
        SELECT 'latitude in range', count(*) FILTER (WHERE NOT coalesce(lat BETWEEN 32.0 AND 34.5, false)) FROM c UNION ALL SELECT 'longitude in range', count(*) FILTER (WHERE NOT coalesce(lon BETWEEN 132.0 AND 133.8, false)) FROM c UNION ALL
        SELECT 'elevation present', count(*) FILTER (WHERE ele_m IS NULL) FROM c)""",
    "check_contiguous": """SELECT *, rows = "distinct" AND least = 1 AND most = rows AS passed FROM (SELECT count(*) AS rows, count(DISTINCT mountain_no) AS "distinct", min(mountain_no) AS least, max(mountain_no) AS most FROM ehime_mountain_source_rows)""",
    "check_duplicates": "SELECT summit_candidate_id, count(*) AS rows FROM summit_candidates GROUP BY 1 HAVING count(*) > 1",
}
