"""Ranks, gaps, mutual tops, sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tarn.session import cut_lineage


def ranked_links(links: DataFrame, left: str, right: str, score: str) -> DataFrame:
    """With rank_left and rank_right (score descending, ties by the other id), gap to the next and from the top, mutual tops.

    shared_top: the right entity is the top of several left ones.
    """
    l, r = Window.partitionBy(left).orderBy(F.desc_nulls_last(score), right), Window.partitionBy(right).orderBy(F.desc_nulls_last(score), left)
    rows = links.withColumns({
        "rank_left": F.row_number().over(l), "gap_next": F.round(F.col(score) - F.lead(score).over(l), 6), "gap_top": F.round(F.first(score).over(l) - F.col(score), 6), "rank_right": F.row_number().over(r),
    })
    tops = F.count_if(F.col("rank_left") == 1).over(Window.partitionBy(right))
    return rows.withColumns({"mutual_top1": (F.col("rank_left") == 1) & (F.col("rank_right") == 1), "mutual_top3": (F.col("rank_left") <= 3) & (F.col("rank_right") <= 3), "shared_top": tops > 1})


def top_links(links: DataFrame, left: str, right: str, score: str, k: int) -> DataFrame:
    """The k best right entities of each left one; the feature is the cut."""
    order = Window.partitionBy(left).orderBy(F.desc_nulls_last(score), right)
    return links.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def filled_sequence(df: DataFrame, number: str, order: str) -> DataFrame:
    """number with blanks filled from its maximum on, in order; filled says which.

    Blanks are put in order by ranges, numbered in each range and shifted by the counts of the ranges before, so no task has all.
    """
    top = df.agg(F.max(number)).first()[0] or 0
    known = df.where(F.col(number).isNotNull()).withColumn("filled", F.lit(False))
    blank = cut_lineage(df.where(F.col(number).isNull()).repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blank.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))  # a row for each range
    placed = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    filled = blank.join(F.broadcast(shifts), "_range").withColumn(number, (F.lit(top) + F.col("_shift") + placed).cast(dict(df.dtypes)[number]))
    return known.unionByName(filled.drop("_range", "_shift").withColumn("filled", F.lit(True)))


def in_review(links: DataFrame, left: str, gap: float, k: int = 3) -> DataFrame:
    """Rows of ranked_links that are a top, or among the first k and no more than gap below it."""
    return links.where((F.col("rank_left") == 1) | ((F.col("rank_left") <= k) & (F.col("gap_top") <= gap)))


def carried_heading(lines: DataFrame, doc: str, line_no: str, heading: str) -> DataFrame:
    """With section: the last heading that is not null up to each line."""
    before = Window.partitionBy(doc).orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.last(heading, ignorenulls=True).over(before))
