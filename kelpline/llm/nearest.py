"""Nearest-time matching: right-hand times become intervals in which they are nearest; left-hand times fall into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Width of a time bucket, the unit of distribution, in tolerances, so a right-hand row lies in two buckets at most.
WIDTH = 16
#: Seconds that a long counts in nanoseconds.
REPRESENTABLE = 9.2e9


def nearest_intervals(right: DataFrame, entity: str, stream: str, at: str, row: str, tolerance_ns: int, bucket_ns: int | None = None) -> DataFrame:
    """``entity, bucket, stream, row, lo, hi``: where, in doubled nanoseconds, a row is the nearest of its stream.

    A row of time t owns the doubled times from the midpoint with its predecessor (exclusive unless its ``row`` is the
    smaller, which wins ties) to that with its successor, cut at the tolerance and at its bucket. A row goes to every
    bucket that it can be matched in, with all its rivals there, so buckets need not know each other; a hot entity or
    stream is spread over its buckets. Rows of equal time count as the one with the smallest ``row``. A bucket is
    ``WIDTH`` tolerances wide, or ``bucket_ns``; streams that are dense against the tolerance ask for narrower ones.
    """
    bucket_ns = bucket_ns or max(WIDTH * tolerance_ns, 1)
    keys = [F.col(entity).alias("entity"), F.col(stream).alias("stream"), F.col(at).alias("t")]
    one = right.filter(F.col(entity).isNotNull() & F.col(stream).isNotNull() & F.col(at).isNotNull() & F.col(row).isNotNull()).groupBy(*keys).agg(F.min(row).alias("row"))
    b = lambda shift: F.floor((F.col("t") + F.lit(shift)) / bucket_ns)
    each = one.withColumn("bucket", F.explode(F.sequence(b(-tolerance_ns), b(tolerance_ns))))
    w = Window.partitionBy("entity", "bucket").orderBy("stream", "t")

    def other(c: str, f) -> Column:
        return F.when(f("stream").over(w) == F.col("stream"), f(c).over(w))

    near = each.select("*", *[other(c, f).alias(f"{n}_{c}") for n, f in (("prev", F.lag), ("next", F.lead)) for c in ("t", "row")])
    late = lambda side: F.when(F.col("row") < F.col(f"{side}_row"), 0).otherwise(1)
    lo = F.greatest(2 * (F.col("t") - tolerance_ns), F.col("prev_t") + F.col("t") + late("prev"))
    hi = F.least(2 * (F.col("t") + tolerance_ns), F.col("next_t") + F.col("t") - late("next"))
    return near.select("entity", "bucket", "stream", "row", lo.alias("lo"), hi.alias("hi")).filter("lo <= hi")


def match_nearest(left: DataFrame, right: DataFrame, entity: str, at: str, stream: str, row: str, tolerance_ns: int, bucket_ns: int | None = None) -> DataFrame:
    """``left`` joined to ``stream`` and ``row`` of the nearest right-hand row of each stream, if within the tolerance.

    ``at`` is integer nanoseconds on both sides. The tolerance is inclusive; ties go to the smallest ``row``. Left
    rows with a null key or time, or without a near row, have no result; repeated left rows are kept. Only the columns
    named are read on the right, so others may clash.
    """
    bucket_ns = bucket_ns or max(WIDTH * tolerance_ns, 1)
    index = nearest_intervals(right, entity, stream, at, row, tolerance_ns, bucket_ns)
    l = left.filter(F.col(entity).isNotNull() & F.col(at).isNotNull()).withColumn("nearest_bucket", F.floor(F.col(at) / bucket_ns))
    index = index.select(F.col("entity").alias("nearest_entity"), F.col("bucket").alias("nearest_b"), F.col("stream").alias("nearest_stream"), F.col("row").alias("nearest_row"), F.col("lo").alias("nearest_lo"), F.col("hi").alias("nearest_hi"))
    on = (F.col(entity) == F.col("nearest_entity")) & (F.col("nearest_bucket") == F.col("nearest_b")) & (2 * F.col(at)).between(F.col("nearest_lo"), F.col("nearest_hi"))
    return l.join(index, on).drop("nearest_bucket", "nearest_entity", "nearest_b", "nearest_lo", "nearest_hi")


def frame_times(frames: DataFrame) -> DataFrame:
    """``episode_idx, frame_index, at``: distinct frames with a usable timestamp, in nanoseconds."""
    ok = F.col("timestamp").isNotNull() & ~F.isnan("timestamp") & (F.abs("timestamp") < REPRESENTABLE)
    return frames.filter(ok & F.col("frame_index").isNotNull()).select("episode_idx", "frame_index", F.round(F.col("timestamp") * 1e9).cast("long").alias("at")).distinct()


def packet_times(packets: DataFrame) -> DataFrame:
    """``episode_idx, topic, packet_id, at``: packets with a usable capture time; a null time base means nanoseconds."""
    base = F.coalesce("time_base", F.lit(1_000_000_000))
    seconds = F.col("pts") / F.when(base > 0, base)
    return packets.filter(F.abs(seconds) < REPRESENTABLE).select(F.col("episode_index").alias("episode_idx"), "topic", "packet_id", F.round(seconds * 1e9).cast("long").alias("at"))


def match_packets(frames: DataFrame, packets: DataFrame, tolerance_ns: int = 15_000_000) -> DataFrame:
    """``episode_idx, frame_index, topic, packet_id``: of each camera, the packet nearest to each frame."""
    found = match_nearest(frame_times(frames), packet_times(packets), "episode_idx", "at", "topic", "packet_id", tolerance_ns)
    return found.select("episode_idx", "frame_index", F.col("nearest_stream").alias("topic"), F.col("nearest_row").alias("packet_id"))
