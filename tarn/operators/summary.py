"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def stacked_counts(df: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """(dimension, value, count, pct) of several one-dimensional groupings, in one pass; null values as empty text."""
    total = df.count()
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), F.coalesce(c.cast("string"), F.lit("")).alias("value")) for d, c in dimensions.items()))
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("count"))
    return counts.withColumn("pct", F.round(F.col("count") * 100.0 / max(total, 1), 2))


def exploded_counts(df: DataFrame, items: Column, none: str = "none") -> DataFrame:
    """(value, count, pct) of the items of arrays, an empty array counting as none; pct of rows, not of items."""
    total = df.count()
    one = F.when(F.size(items) > 0, items).otherwise(F.array(F.lit(none)))
    return df.select(F.explode(one).alias("value")).groupBy("value").agg(F.count("*").alias("count")).withColumn("pct", F.round(F.col("count") * 100.0 / max(total, 1), 2))


def shared(df: DataFrame, key: str, order: str, joined: dict[str, str], distance: str) -> DataFrame:
    """Per key that several rows share: their number, columns joined by ; in order, least and greatest distance (0 if none)."""

    def in_order(c: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(c).alias("v"))))
        return F.concat_ws(";", F.transform(pairs, lambda x: x["v"].cast("string")))

    lists = {name: in_order(c) for name, c in joined.items()}
    grouped = df.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(
        F.count("*").alias("shared_count"), *(v.alias(k) for k, v in lists.items()), F.coalesce(F.min(distance), F.lit(0.0)).alias("min_distance"), F.coalesce(F.max(distance), F.lit(0.0)).alias("max_distance")
    )
    return grouped.where("shared_count > 1")


def metrics(df: DataFrame, **values: Column) -> DataFrame:
    """(metric, value) rows of scalar aggregates."""
    row = df.agg(*(v.cast("double").alias(k) for k, v in values.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in values))).alias("m")).select("m.*")


def first_examples(df: DataFrame, category: str, order: str, k: int = 5) -> DataFrame:
    """The first k rows of each category; the feature is the cut."""
    return df.withColumn("example", F.row_number().over(Window.partitionBy(category).orderBy(order))).where(F.col("example") <= k)


def json_keys(df: DataFrame, column: str) -> DataFrame:
    """Distinct top-level keys of JSON objects, with how many rows have them."""
    return df.select(F.explode(F.json_object_keys(column)).alias("key")).groupBy("key").agg(F.count("*").alias("rows"))


def spread_of(df: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    """Per key: points and the diagonal in metres of the box round them, a bound of their greatest distance."""
    high, low = lambda c: F.max(c), lambda c: F.min(c)
    dy, dx = (high(lat) - low(lat)) * 111_320.0, (high(lon) - low(lon)) * 111_320.0 * F.cos(F.radians(F.avg(lat)))
    return df.groupBy(key).agg(F.count(lat).alias("points"), F.round(F.hypot(dx, dy), 1).alias("extent_m"))


def pass_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, passed, pct) of rows for which each rule holds, in one pass; null does not hold, no rows are 0 per cent."""
    row = df.agg(F.count("*").alias("_n"), *(F.count_if(rule).alias(name) for name, rule in rules.items()))
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("passed")) for n in rules)))
    return row.select("_n", each.alias("r")).select("r.*", F.round(F.col("r.passed") * 100.0 / F.greatest("_n", F.lit(1)), 2).alias("pct"))
