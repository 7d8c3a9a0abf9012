"""Checks of tables, as rows (check, bad, passed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def checks(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """For each rule the rows that break it (null counts as broken), in one pass."""
    row = df.agg(*(F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("bad")) for n in rules))).alias("c")).select("c.*", (F.col("c.bad") == 0).alias("passed"))


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that stand more than once, with their number."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def contiguous(df: DataFrame, number: str) -> DataFrame:
    """One row: whether number runs from 1 to its maximum without gap or repetition."""
    row = df.agg(F.count("*").alias("rows"), F.countDistinct(number).alias("distinct"), F.min(number).alias("least"), F.max(number).alias("most"))
    return row.withColumn("passed", (F.col("rows") == F.col("distinct")) & (F.col("least") == 1) & (F.col("most") == F.col("rows")))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that stand more often in one than in the other, with side; none if the tables are equal as bags."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def newest_content(df: DataFrame, content: str, name: str) -> DataFrame:
    """One row per content (SHA-256): names without a copy number in brackets first, then by name."""
    rank = F.struct(F.col(name).rlike(r" \(\d+\)").alias("copy"), F.col(name).alias("name"))
    return df.groupBy(F.sha2(content, 256).alias("sha256")).agg(F.min_by(F.struct(*df.columns), rank).alias("_r"), F.count("*").alias("copies")).select("_r.*", "sha256", "copies")


def counts_match(actual: dict[str, DataFrame], stated: DataFrame) -> DataFrame:
    """(name, stated, actual, passed) of tables against stated (name, stated) counts, as of a manifest; no statement or no table is null and not passed."""
    parts = [df.agg(F.count("*").alias("actual")).select(F.lit(n).alias("name"), "actual") for n, df in actual.items()]
    both = reduce(DataFrame.unionByName, parts).join(stated, "name", "full")
    return both.select("name", "stated", "actual", F.coalesce(F.col("stated") == F.col("actual"), F.lit(False)).alias("passed"))
