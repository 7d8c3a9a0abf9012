"""Session helpers shared by all operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tarn")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it from there.

    The folder is the one the cluster names in spark.checkpoint.dir. A session without one gets a folder of this machine if
    it runs in this process alone (a test), and is an error else.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("a cluster must name a shared folder in spark.checkpoint.dir")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tarn-checkpoint-"))
    return df.checkpoint(eager=True)


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether df has at most max_rows rows; looks at max_rows + 1 of them at most."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """df marked for broadcast if it has at most max_rows rows, else df for a shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def tasks(spark: SparkSession, per_core: int = 4) -> int:
    return per_core * spark.sparkContext.defaultParallelism


def spread(scan: DataFrame) -> DataFrame:
    """Rows of a scan in enough partitions for costly work by row; inputs with many splits stay as they are."""
    wanted = tasks(scan.sparkSession)
    return scan if scan.rdd.getNumPartitions() >= wanted else scan.repartition(wanted)


def scatter(df: DataFrame) -> DataFrame:
    """Rows of a result of few bytes, which would else be put into few partitions, spread for costly work by row."""
    spark = df.sparkSession
    return df.repartition(max(tasks(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))))
