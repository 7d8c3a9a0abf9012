"""Activity notes, CSV, JSON and archives."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tarn.functions.text import basename

#: The keys of activity notes.
NOTE_KEYS = {"Title": "title", "Date": "date", "Distance": "distance", "Time": "time", "Elevation Gain": "elevation_gain", "Elevation Loss": "elevation_loss", "Link": "link"}


def read_activities(spark: SparkSession, path: str) -> DataFrame:
    """One row per note: filepath, activity_id, and the last value of each key in lines like '- **Title**: value', else ''."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("filepath"), F.transform(F.split("value", "\n"), lambda x: F.trim(F.replace(x, F.lit("\r"), F.lit("")))).alias("lines"))

    def last(key: str):
        prefix = f"- **{key}**:"
        found = F.filter("lines", lambda x: F.startswith(x, F.lit(prefix)))
        return F.coalesce(F.trim(F.substring(F.try_element_at(found, F.lit(-1)), len(prefix) + 1, 1_000_000)), F.lit(""))

    activity = F.regexp_replace(basename(F.col("filepath")), r"\.md$", "")
    return lines.select("filepath", activity.alias("activity_id"), *(last(k).alias(v) for k, v in NOTE_KEYS.items()))


def read_csv(spark: SparkSession, path: str, casts: dict[str, tuple[str, object]], columns: list[str]) -> DataFrame:
    """CSV with a header, all text; casts maps a column to (type, value for what can't be read)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')
    return df.select(*(F.coalesce(F.trim(c).try_cast(casts[c][0]), F.lit(casts[c][1])).alias(c) if c in casts else F.col(c) for c in columns))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object per line; blank lines are passed over."""
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold an array of objects or one object, with the file and the place in it."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.sha2("value", 256).alias("sha256"), F.when(F.ltrim("value").startswith("["), F.from_json("value", f"array<struct<{schema}>>")).otherwise(F.array(F.from_json("value", f"struct<{schema}>"))).alias("rows"))
    return rows.select("path", "sha256", F.posexplode("rows").alias("pos", "row")).select("path", "sha256", "pos", "row.*")


def read_polygons(spark: SparkSession, path: str, name: str, having: tuple[str, str] | None = None) -> DataFrame:
    """(region, rings) of a GeoJSON collection of polygons and multipolygons; name is the property that names a region, having a property and the value it must have."""
    coordinates = "array<array<array<array<double>>>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json(F.get_json_object("value", "$.features"), "array<string>")).alias("f"))
    if having:
        rows = rows.where(F.get_json_object("f", f"$.properties.{having[0]}") == having[1])
    shape = F.get_json_object("f", "$.geometry.coordinates")
    many = F.when(F.get_json_object("f", "$.geometry.type") == "MultiPolygon", F.from_json(shape, coordinates)).otherwise(F.array(F.from_json(shape, coordinates[6:-1])))
    rings = F.transform(F.flatten(many), lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return rows.select(F.get_json_object("f", f"$.properties.{name}").alias("region"), rings.alias("rings"))


def missing_inputs(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that don't exist; a plan is built only if there are none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return [p for p in paths if not place(p).getFileSystem(conf).exists(place(p))]


def read_archive(spark: SparkSession, path: str, ending: str = ".gpx") -> DataFrame:
    """(archive, member, name, content) of the files of ZIP archives that end so; folders in member names are left out of name."""
    schema = "archive string, member string, name string, content binary"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        if not info.is_dir() and info.filename.lower().endswith(ending):
                            yield pd.DataFrame([(place, info.filename, info.filename.rsplit("/", 1)[-1], archive.read(info))], columns=["archive", "member", "name", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def archive_collisions(members: DataFrame) -> DataFrame:
    """Names that stand more than once in archives; an intake goes on only if there are none."""
    return members.groupBy("name").agg(F.count("*").alias("members")).where("members > 1")


def checked_archive(members: DataFrame) -> DataFrame:
    """members, or an error if a name stands more than once: nothing of an archive is taken in then."""
    if names := [r.name for r in archive_collisions(members).orderBy("name").limit(5).collect()]:
        raise ValueError(f"names stand more than once, such as {names}")
    return members


def stated_total(spark: SparkSession, path: str) -> DataFrame:
    """(path, total_records) of manifests with summary.total_records; null if one has none."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.get_json_object("value", "$.summary.total_records").try_cast("bigint").alias("total_records"))


def bullets(lines: DataFrame, doc: str, line_no: str, line: str) -> DataFrame:
    """(doc, section, key, value) of bullets like '- **Key**: value' or '- key: value' below the headings of documents given line by line; of equal keys the last."""
    section = F.when(F.col(line).rlike("^#{1,6} "), F.trim(F.regexp_replace(line, "^#+ ", "")))
    before = Window.partitionBy(doc).orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    pattern = r"^\s*[-*] (?:\*\*)?([^:*]+?)(?:\*\*)?\s*[:：]\s*(.*)$"
    found = lines.withColumn("section", F.last(section, ignorenulls=True).over(before)).where(F.col(line).rlike(pattern))
    rows = found.select(doc, "section", F.regexp_extract(line, pattern, 1).alias("key"), F.struct(F.col(line_no).alias("n"), F.trim(F.regexp_extract(line, pattern, 2)).alias("value")).alias("v"))
    return rows.groupBy(doc, "section", "key").agg(F.max_by("v.value", "v.n").alias("value"))


def table_rows(lines: DataFrame, doc: str, line_no: str, line: str) -> DataFrame:
    """(doc, line_no, cells) of the rows of Markdown tables, without the rulers below their heads."""
    inner = F.regexp_replace(F.trim(line), r"^\||\|$", "")
    rows = lines.where(F.trim(line).rlike(r"^\|.*\|$") & ~F.trim(line).rlike(r"^\|[\s:|-]+\|$"))
    return rows.select(doc, line_no, F.transform(F.split(inner, r"(?<!\\)\|"), lambda c: F.replace(F.trim(c), F.lit("\\|"), F.lit("|"))).alias("cells"))


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """(workbook, sheet, row_no, cells) of all sheets of XLSX files: the written rows, cells as text by their columns, blank ones as ''."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    link = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for place, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    strings = [] if "xl/sharedStrings.xml" not in book.namelist() else ["".join(t.text or "" for t in i.iter(space + "t")) for i in ElementTree.parse(book.open("xl/sharedStrings.xml")).iter(space + "si")]
                    files = {r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/") for r in ElementTree.parse(book.open("xl/_rels/workbook.xml.rels")).getroot()}
                    for sheet in ElementTree.parse(book.open("xl/workbook.xml")).iter(space + "sheet"):
                        rows = []
                        for _, row in ElementTree.iterparse(book.open("xl/" + files[sheet.get(link)])):
                            if row.tag != space + "row":
                                continue
                            cells: list[str] = []
                            for cell in row.iter(space + "c"):
                                at = 0
                                for letter in re.match("[A-Z]*", cell.get("r", ""))[0]:
                                    at = at * 26 + ord(letter) - 64
                                cells += [""] * (max(at, len(cells) + 1) - len(cells))
                                value = cell.findtext(space + "v") or ""
                                if cell.get("t") == "s":
                                    value = strings[int(value)]
                                elif cell.get("t") == "inlineStr":
                                    value = "".join(t.text or "" for t in cell.iter(space + "t"))
                                elif cell.get("t") == "b":
                                    value = "true" if value == "1" else "false"
                                cells[max(at, 1) - 1] = value
                            rows.append((place, sheet.get("name"), int(row.get("r", len(rows) + 1)), cells))
                            row.clear()
                        yield pd.DataFrame(rows, columns=["workbook", "sheet", "row_no", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "workbook string, sheet string, row_no int, cells array<string>")


def geocoded(rows: DataFrame) -> DataFrame:
    """rows with address (a map of address parts) with prefecture and local: the first known of their usual names."""
    first = lambda *keys: F.coalesce(*(F.nullif(F.trim(F.try_element_at("address", F.lit(k))), F.lit("")) for k in keys))
    return rows.withColumns({"prefecture": first("province", "state", "prefecture"), "local": first("suburb", "road", "neighbourhood", "hamlet", "quarter")})
