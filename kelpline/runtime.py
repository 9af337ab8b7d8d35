"""Session-level helpers: reading tables, shared scratch tables, size-checked broadcasts."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if its size is known from statistics (file sizes, by the share of the columns read) and at most this.
BROADCAST_BYTES = 12 << 20
#: A key that holds this part of the rows is hot. There are at most so many of them, so their rows on the other side may be broadcast.
HOT = 1_000

_scratch: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a local one only where none is set and the master is local."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="kelpline-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def materialize(df: DataFrame, label: str = "t", partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder (in folders by ``partition_by``) and read it back.

    This cuts the lineage and survives the loss of executors, since the files lie in storage all of them share.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{shared_dir(spark)}/kelpline-{label}-{uuid.uuid4().hex}")
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, path: str) -> str:
    """``path``, to be deleted when the program ends."""
    _scratch.append((spark, path))
    return path


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialize` that nothing will read again."""
    for path in {m.group() for f in df.inputFiles() if (m := re.match(r".*/kelpline-[a-z]+-[0-9a-f]{32}(?=/)", f))}:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@atexit.register
def _clean() -> None:
    for spark, path in _scratch:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone
            return


def fits(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the estimated size of ``df`` is at most ``max_bytes`` (``BROADCAST_BYTES``); no job runs.

    The estimate comes from the optimizer's statistics: for tables, what their files hold of the columns read; for joins, an
    upper bound.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it :func:`fits`, else unmarked: shuffled unless adaptive execution finds it small at run time."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right``, whose ``key`` is unique and, as in ``left``, never null; ``how``: ``inner`` or ``left``.

    Keys with 1/``HOT`` of all left rows or more are told by a combined count. Their rows meet the right rows by a broadcast
    of at most ``HOT`` rows; only the others are shuffled, so no key makes a large task. ``left`` is read three times.
    """
    least = max(left.count() / HOT, 100)
    hot = materialize(left.groupBy(key).agg(F.count(F.lit(1)).alias("hot_n")).filter(F.col("hot_n") >= least).select(key), "hot")
    if not hot.limit(1).count():
        return left.join(right, key, how)
    hot = F.broadcast(hot)
    top = left.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, how)
    return top.unionByName(left.join(hot, key, "left_anti").join(right, key, how))
