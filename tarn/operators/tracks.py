"""Tracks in time order: one shuffle by track, then a stream of whole tracks in each task.

Tracks are handed over one at a time, so a task holds one track and one Arrow batch. Tracks of more than HOT_FIXES rows go
another way, by pieces or blocks that are spread over tasks; it gives the same result, HOT_FIXES decides only where the work
is done.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.session import tasks

HOT_FIXES = 1_000_000
#: Hot tracks, the largest first, that are told from the others by their names in the plan; the rest hold at most a
#: LISTED-th of all rows each and are told by a join.
LISTED = 1000


def seconds_of(time: Column) -> Column:
    """Epoch seconds, with fraction, of a written time with offset; null for blank and unreadable ones."""
    return F.trim(time).try_cast("timestamp").cast("double")


def hot_tracks(source: DataFrame, key: str) -> DataFrame | None:
    """(key) of tracks of more than HOT_FIXES rows of source, None if there are none. Reads the key column only."""
    hot = source.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > HOT_FIXES)
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary tracks, rows of those in hot, the result of hot_tracks)."""
    named = [r[0] for r in hot.orderBy(F.desc("count"), key).limit(LISTED + 1).collect()]
    largest, more = F.coalesce(F.col(key).isin(named[:LISTED]), F.lit(False)), len(named) > LISTED
    usual, own = df.where(~largest), df.where(largest)
    if more:
        rest = hot.where(~F.col(key).isin(named[:LISTED])).select(key)
        usual, own = usual.join(rest, key, "left_anti"), own.unionByName(usual.join(rest, key, "left_semi"))
    return usual, own


def with_slab(hot: DataFrame, key: str, second: str, slab_s: float, halo_s: float) -> DataFrame:
    """Rows of hot tracks with own (the slab of slab_s seconds they lie in), slab (where they are looked at) and halo.

    Rows near an edge also go to the next slab that has rows, as halo. Silence takes nothing from a halo: it is the last row
    before an edge and the first behind it, however far they are, and what lies within halo_s of these.
    """
    hot = hot.withColumn("own", F.floor(F.col(second) / slab_s))
    order = Window.partitionBy(key).orderBy("own")
    slabs = hot.groupBy(key, "own").agg(F.min(second).alias("_min"), F.max(second).alias("_max"))
    slabs = slabs.withColumns({"_before": F.lag("own").over(order), "_after": F.lead("own").over(order)})
    at = F.col(second)
    before, after = F.when(at <= F.col("_min") + halo_s, F.col("_before")), F.when(at >= F.col("_max") - halo_s, F.col("_after"))
    rows = hot.join(slabs, [key, "own"]).withColumn("slab", F.explode(F.array_compact(F.array("own", before, after))))
    return rows.withColumn("halo", F.col("slab") != F.col("own")).drop("_min", "_max", "_before", "_after")


def in_track_order(df: DataFrame, *keys: str, order: tuple[str, ...]) -> DataFrame:
    """Rows shuffled once by keys, in order, in a number of partitions that is not cut down for few bytes: what follows costs more than bytes tell."""
    spark = df.sparkSession
    return df.repartition(max(tasks(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys).sortWithinPartitions(*keys, *order)


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of equal keys out of batches that are sorted by them; keys without nulls."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        new = np.zeros(len(table), bool)
        for key in keys:
            column = table[key].combine_chunks()
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            if held and held[0][key][0].as_py() != column[0].as_py():
                new[0] = True
        cuts = [0, *np.flatnonzero(new), len(table)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b or a == b == 0:
                if new[a] and held:
                    yield pa.concat_tables(held)
                    held = []
                if a < b:
                    held.append(table.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)


def numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns as float arrays, null as NaN."""
    return [table[name].cast(pa.float64()).to_numpy(zero_copy_only=False) for name in names]


def over_blocks(rows: DataFrame, track: str, block: str, order: tuple[str, ...], lag: dict[str, str] = {}, lead: dict[str, str] = {}, last: dict[str, str] = {}, total: dict[str, Column] = {}) -> DataFrame:  # noqa: B006
    """Window functions over whole tracks, computed block by block: rows with the columns named by the keys, of the columns or values given.

    block numbers the blocks of a track in order; order has no ties within one. lag and lead are of the row before and after,
    last is the last value that is not null up to each row, total the sum up to each row. What crosses the edges of blocks goes
    through a table of one row per block, so no task sorts a whole track.
    """
    at = F.struct(*order)
    values = {f"_t{i}": v for i, v in enumerate(total.values())}
    rows = rows.withColumns(values)
    edge = {f"_lag{i}": F.max_by(c, at) for i, c in enumerate(lag.values())} | {f"_lead{i}": F.min_by(c, at) for i, c in enumerate(lead.values())}
    edge |= {f"_last{i}": F.max_by(c, F.when(F.col(c).isNotNull(), at)) for i, c in enumerate(last.values())} | {f"_sum{i}": F.sum(c) for i, c in enumerate(values)}
    along = Window.partitionBy(track).orderBy(block)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    edges = rows.groupBy(track, block).agg(F.count("*").alias("_rows"), *(v.alias(k) for k, v in edge.items()))
    kinds = {"_lag": lambda c: F.lag(c).over(along), "_lead": lambda c: F.lead(c).over(along), "_last": lambda c: F.last(c, ignorenulls=True).over(before), "_sum": lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))}
    edges = edges.withColumns({c: kinds[c.rstrip("0123456789")](c) for c in edge})
    own = Window.partitionBy(track, block).orderBy(*order)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(edges, [track, block]).withColumn("_row", F.row_number().over(own))
    found = {k: F.when(F.col("_row") == 1, F.col(f"_lag{i}")).otherwise(F.lag(c).over(own)) for i, (k, c) in enumerate(lag.items())}
    found |= {k: F.when(F.col("_row") == F.col("_rows"), F.col(f"_lead{i}")).otherwise(F.lead(c).over(own)) for i, (k, c) in enumerate(lead.items())}
    found |= {k: F.coalesce(F.last(c, ignorenulls=True).over(upto), F.col(f"_last{i}")) for i, (k, c) in enumerate(last.items())}
    found |= {k: F.col(f"_sum{i}") + F.sum(f"_t{i}").over(upto) for i, k in enumerate(total)}
    return out.withColumns(found).drop("_row", "_rows", *edge, *values)
