"""Outputs: CSV with fixed columns, reports, manifests, annotated tracks, one file per group."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.session import cut_lineage


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV of fixed columns with a header; null as empty, truth values in lower case; an existing path is an error."""
    text = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns))
    text.write.mode("errorifexists").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def markdown_table(df: DataFrame, limit: int = 1000) -> str:
    """A Markdown table of a small result, for reports; more rows than limit, the bound of what the driver takes, are an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a table of more than {limit} rows")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, rows)]) + "\n"


def manifest(name: str, created: str, parameters: dict, files: DataFrame, revision: str | None = None, counts: dict[str, int] | None = None) -> str:
    """JSON with parameters, the revision of the code, counts and, per file of (path, content), size and SHA-256, which executors compute."""
    rows = files.select("path", F.length("content").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("path")
    return json.dumps({"namespace": name, "created_at": created, "revision": revision, "parameters": parameters, "counts": counts or {}, "outputs": [r.asDict() for r in rows.toLocalIterator()]}, ensure_ascii=False, indent=2)


def group_files(df: DataFrame, key: str, line: Column, order: str, heading: Column) -> DataFrame:
    """(key, content): per group a heading and one line for each row in order. Groups must fit a row."""
    rows = df.select(F.col(key), heading.alias("_h"), F.struct(F.col(order).alias("o"), line.alias("l")).alias("_r"))
    return rows.groupBy(key).agg(F.first("_h").alias("_h"), F.array_sort(F.collect_list("_r")).alias("_l")).select(key, F.concat_ws("\n", F.array("_h"), F.transform("_l", lambda r: r["l"])).alias("content"))


GPX = '<?xml version="1.0" encoding="UTF-8"?><gpx version="1.1" creator="tarn" xmlns="http://www.topografix.com/GPX/1/1" xmlns:x="urn:tarn:peak">'


def _tag(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))).otherwise("")


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def track_elements(points: DataFrame, names: DataFrame) -> DataFrame:
    """(gpx_path, trk) of points gpx_path, trk_idx, seg_idx, pt_idx, lat, lon, ele, time, in order, and names (gpx_path, name). A track must fit a row."""
    number = lambda c: F.col(c).cast("string")
    point = F.concat(F.lit('<trkpt lat="'), number("lat"), F.lit('" lon="'), number("lon"), F.lit('">'), _tag("ele", number("ele")), _tag("time", F.col("time")), F.lit("</trkpt>"))
    segments = points.groupBy("gpx_path", "trk_idx", "seg_idx").agg(F.array_sort(F.collect_list(F.struct("pt_idx", point.alias("x")))).alias("p"))
    text = F.concat(F.lit("<trkseg>"), F.concat_ws("", F.transform("p", lambda p: p["x"])), F.lit("</trkseg>"))
    tracks = segments.groupBy("gpx_path").agg(F.array_sort(F.collect_list(F.struct("trk_idx", "seg_idx", text.alias("x")))).alias("s"))
    body = F.concat(F.lit("<trk><name>"), _escaped(F.coalesce("name", F.lit(""))), F.lit("</name>"), F.concat_ws("", F.transform("s", lambda s: s["x"])), F.lit("</trk>"))
    return tracks.join(names, "gpx_path", "left").select("gpx_path", body.alias("trk"))


def annotated_tracks(points: DataFrame, peaks: DataFrame, names: DataFrame) -> DataFrame:
    """(gpx_path, content): GPX with the points of each track and a waypoint for each of its peaks; tracks without peaks too.

    points and names as in track_elements; peaks: gpx_path, i, lat, lon, ele, prominence, which a waypoint also holds as extensions.
    """
    number = lambda c: F.col(c).cast("string")
    more = F.concat(F.lit("<extensions>"), _tag("x:valid_index", number("i")), _tag("x:prominence", number("prominence")), F.lit("</extensions>"))
    mark = F.concat(F.lit('<wpt lat="'), number("lat"), F.lit('" lon="'), number("lon"), F.lit('">'), _tag("ele", number("ele")), F.lit("<desc>prominence "), F.round("prominence", 1).cast("string"), F.lit("</desc>"), more, F.lit("</wpt>"))
    marks = peaks.groupBy("gpx_path").agg(F.array_sort(F.collect_list(F.struct("i", mark.alias("x")))).alias("w"))
    waypoints = F.concat_ws("", F.transform(F.coalesce("w", F.array().cast("array<struct<i: int, x: string>>")), lambda w: w["x"]))
    return track_elements(points, names).join(marks, "gpx_path", "left").select("gpx_path", F.concat(F.lit(GPX), waypoints, F.col("trk"), F.lit("</gpx>")).alias("content"))


def yearly_tracks(points: DataFrame, names: DataFrame, first_time: DataFrame, per_file: int = 500) -> DataFrame:
    """(name, content): the tracks of each year (of their first time, gpx_path and year) put together, at most per_file to a file, in order of path.

    Tracks without a year are not among them; points are written unchanged and once.
    """
    order = Window.partitionBy("year").orderBy("gpx_path")
    tracks = track_elements(points, names).join(first_time.where("year is not null").select("gpx_path", "year"), "gpx_path")
    parted = tracks.withColumn("part", F.floor((F.row_number().over(order) - 1) / per_file))
    own = parted.groupBy("year", "part").agg(F.array_sort(F.collect_list(F.struct("gpx_path", "trk"))).alias("t"))
    return own.select(F.format_string("%d-%03d", F.col("year").cast("int"), F.col("part")).alias("name"), F.concat(F.lit(GPX), F.concat_ws("", F.transform("t", lambda t: t["trk"])), F.lit("</gpx>")).alias("content"))


def waypoint_file(waypoints: DataFrame, group: str) -> DataFrame:
    """(group, content): GPX of named waypoints (name, lat, lon, ele) per group, by name."""
    mark = F.concat(F.lit('<wpt lat="'), F.col("lat").cast("string"), F.lit('" lon="'), F.col("lon").cast("string"), F.lit('">'), _tag("ele", F.col("ele").cast("string")), _tag("name", _escaped(F.col("name"))), F.lit("</wpt>"))
    own = waypoints.where("lat is not null and lon is not null").groupBy(group).agg(F.array_sort(F.collect_list(F.struct("name", mark.alias("x")))).alias("w"))
    return own.select(group, F.concat(F.lit(GPX), F.concat_ws("", F.transform("w", lambda w: w["x"])), F.lit("</gpx>")).alias("content"))


def graph_lines(edges: DataFrame, kind: str) -> DataFrame:
    """(place, line) of a graph of edges (source, target, label): dot or graphml. Lines sort by place; head and foot are the first and the last."""
    known = edges.where("source is not null and target is not null").select("source", "target", F.coalesce("label", F.lit("")).alias("label")).distinct()
    nodes = known.select(F.col("source").alias("n")).union(known.select("target")).distinct()
    if kind == "dot":
        quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
        head, foot = "digraph lineage {", "}"
        node, edge = F.concat(quoted("n"), F.lit(";")), F.concat(quoted("source"), F.lit(" -> "), quoted("target"), F.lit(" [label="), quoted("label"), F.lit("];"))
    elif kind == "graphml":
        safe = lambda c: F.replace(_escaped(F.col(c).cast("string")), F.lit('"'), F.lit("&quot;"))
        head, foot = '<graphml xmlns="http://graphml.graphdrawing.org/xmlns"><key id="label" for="edge" attr.name="label" attr.type="string"/><graph edgedefault="directed">', "</graph></graphml>"
        node = F.concat(F.lit('<node id="'), safe("n"), F.lit('"/>'))
        edge = F.concat(F.lit('<edge source="'), safe("source"), F.lit('" target="'), safe("target"), F.lit('"><data key="label">'), safe("label"), F.lit("</data></edge>"))
    else:
        raise ValueError(kind)
    ends = edges.sparkSession.createDataFrame([("0", head), ("9", foot)], "place string, line string")
    return ends.unionByName(nodes.select(F.concat(F.lit("1"), F.col("n").cast("string")).alias("place"), node.alias("line"))).unionByName(known.select(F.concat_ws("\x1f", F.concat(F.lit("2"), F.col("source").cast("string")), F.col("target").cast("string"), "label").alias("place"), edge.alias("line")))


def write_files(df: DataFrame, folder: str, name: str, content: str, ending: str) -> DataFrame:
    """Writes one file per row into a new folder, all or nothing, and returns (name, file, bytes).

    folder is a path or URI that all executors reach. An existing folder, a null or a repeated name are errors. Executors write
    into a folder beside it, which takes its name when all is written; a repeated task writes the same again. Names are
    escaped like those of URLs, so that different names never give one file.
    """
    rows = df.select(F.col(name).cast("string").alias("name"), F.col(content).alias("content"))
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(conf)
    if files.exists(target):
        raise FileExistsError(folder)
    if not rows.groupBy("name").count().where("name is null or count > 1").isEmpty():
        raise ValueError("names must be given and differ")
    staging = f"{folder.rstrip('/')}.{uuid.uuid4().hex}.part"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, place = fs.FileSystem.from_uri(staging if "://" in staging else os.path.abspath(staging))
        system.create_dir(place)
        for batch in batches:
            names, sizes = [quote(n, safe="") + ending for n in batch["name"]], []
            for file, text in zip(names, batch["content"]):
                data = (text or "").encode()
                part = f"{place}/{file}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(data)
                system.move(part, f"{place}/{file}")
                sizes.append(len(data))
            yield pd.DataFrame({"name": batch["name"], "file": names, "bytes": sizes})

    written = cut_lineage(rows.mapInPandas(run, "name string, file string, bytes long"))
    made = jvm.org.apache.hadoop.fs.Path(staging)
    files.mkdirs(made)
    if files.exists(target) or not files.rename(made, target):
        raise FileExistsError(folder)
    return written
