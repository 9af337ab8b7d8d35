"""Camera packets: keyframes, picture groups, the packets an episode needs, and the packet each frame shows."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kelpline.operators.order import asof_join
from kelpline.operators.segment import in_episodes, log_block
from kelpline.runtime import materialize

#: Packets of each camera that are kept ahead of a start.
KEPT = 60


#: A start code and the byte that holds the unit's type in its bits 1 to 6.
_UNIT = re.compile(rb"\x00\x00\x01(.)", re.DOTALL)


def first_picture_type(data: bytes | None) -> int | None:
    """Type of the first picture unit (type under 32) of a packet, or None."""
    kinds = (u[0] // 2 % 64 for u in _UNIT.findall(data or b""))
    return next((k for k in kinds if k < 32), None)


def first_picture_types(data: pa.Array) -> np.ndarray:
    """:func:`first_picture_type` of a whole batch in one pass over its bytes; -1 for none."""
    data = data.cast(pa.large_binary())
    out = np.full(len(data), -1, np.int64)
    if not len(data):
        return out
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    bytes_ = np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    at = np.flatnonzero((bytes_[:-3] == 0) & (bytes_[1:-2] == 0) & (bytes_[2:-1] == 1)) if len(bytes_) > 3 else np.empty(0, np.int64)
    kind = (bytes_[at + 3] >> 1) & 63
    row = np.searchsorted(ends, at, "right") - 1
    ok = (kind < 32) & (at + 3 < ends[row + 1])
    row, first = np.unique(row[ok], return_index=True)
    out[row] = kind[ok][first]
    out[data.is_null().to_numpy(zero_copy_only=False)] = -1
    return out


@F.arrow_udf(T.BooleanType())
def is_keyframe(data: pa.Array) -> pa.Array:
    """Whether the first picture unit is of type 19 or 20; null and empty packets are not."""
    return pa.array(np.isin(first_picture_types(data), (19, 20)))


def picture_groups(packets: DataFrame, keyframe: str = "keyframe", keys: tuple[str, ...] = ("bag", "topic")) -> DataFrame:
    """``gop``: number of keyframes so far (0 before the first), and ``tail_from``: the ``seq`` of the last keyframe among the latest ``KEPT`` packets.

    Both are counted block by block of a log and then carried over the blocks, as is ``nr``, the packet's number.
    """
    p = packets.withColumns({"scan_key": F.struct(*keys), "scan_block": log_block()})
    w = Window.partitionBy("scan_key", "scan_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumns({"nr": F.count(F.lit(1)).over(w), "gop": F.count_if(F.coalesce(F.col(keyframe), F.lit(False))).over(w)})
    p = p.withColumn("gop_key", F.last(F.when(F.col(keyframe), F.struct("seq", "nr")), ignorenulls=True).over(w))
    totals = p.groupBy("scan_key", "scan_block").agg(F.max("nr").alias("n"), F.max("gop").alias("g"), F.max("gop_key").alias("key"))
    earlier = Window.partitionBy("scan_key").orderBy("scan_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    totals = totals.withColumns({"n0": F.coalesce(F.sum("n").over(earlier), zero), "g0": F.coalesce(F.sum("g").over(earlier), zero)})
    totals = totals.withColumn("key", F.when(F.col("key").isNotNull(), F.struct(F.col("key.seq").alias("seq"), (F.col("key.nr") + F.col("n0")).alias("nr"))))
    totals = totals.select("scan_key", "scan_block", "n0", "g0", F.last("key", ignorenulls=True).over(earlier).alias("key0"))
    j = p.join(totals, ["scan_key", "scan_block"])  # the packets stay where they are
    own = F.when(F.col("gop_key").isNotNull(), F.struct(F.col("gop_key.seq").alias("seq"), (F.col("gop_key.nr") + F.col("n0")).alias("nr")))
    j = j.withColumns({"nr": F.col("nr") + F.col("n0"), "gop": F.col("gop") + F.col("g0"), "gop_key": F.coalesce(own, "key0")})
    return j.withColumn("tail_from", F.when(F.col("nr") - F.col("gop_key.nr") < KEPT, F.col("gop_key.seq"))).drop("scan_key", "scan_block", "n0", "g0", "key0", "gop_key")


def episode_packets(packets: DataFrame, found: DataFrame, keyframe: str = "keyframe") -> DataFrame:
    """``bag, x_seq, topic, seq``: the packets of each episode and camera.

    These are all from its start up to its stop and, ahead of the start, those since the last keyframe among the
    latest ``KEPT`` packets (none if there is no keyframe among them). The packets ahead are numbered, so they are
    found by an equality join of at most ``KEPT`` numbers an episode and camera.
    """
    p = materialize(picture_groups(packets, keyframe).select("bag", "topic", "seq", "tail_from", "nr"), "packets")
    ep = found.select("bag", "x_seq", "y_seq", F.lit(None).cast("long").alias("t_start"))
    cams = p.select("bag", "topic").distinct()
    starts = ep.join(cams, "bag").select("bag", "topic", "x_seq", (F.col("x_seq") - 1).alias("seq"))
    last = asof_join(starts, p, ["bag", "topic"], "seq", ["nr", "tail_from"], tie="nr", block=log_block())
    ahead = last.filter("asof_tail_from is not null").select("bag", "topic", "x_seq", F.col("asof_tail_from").alias("tail"), F.explode(F.sequence(F.greatest(F.col("asof_nr") - (KEPT - 1), F.lit(1)), F.col("asof_nr"))).alias("nr"))
    ahead = ahead.join(p.select("bag", "topic", "nr", "seq"), ["bag", "topic", "nr"]).filter("seq >= tail").select("bag", "x_seq", "topic", "seq")
    return ahead.unionByName(in_episodes(p.select("bag", "topic", "seq"), ep).select("bag", "x_seq", "topic", "seq"))


def shown_packets(ticks: DataFrame, packets: DataFrame, keys: list[str], at: str = "t", take: tuple[str, ...] = ("seq", "t")) -> DataFrame:
    """Each tick with the latest packet at or before its time (null if none yet); the last packet repeats beyond the end."""
    return asof_join(ticks, packets.withColumn("packet_t", F.col(at)), keys, at, [*[c for c in take if c != at], "packet_t"], tie="seq")


def needed_packets(packets: DataFrame, shown: DataFrame, keys: tuple[str, ...] = ("bag", "topic"), seq: str = "asof_seq") -> DataFrame:
    """The packets that some tick of ``shown`` (see :func:`shown_packets`) shows; only these need be decoded to pictures."""
    n = shown.filter(F.col(seq).isNotNull()).select(*keys, F.col(seq).alias("seq")).distinct()
    return packets.join(n, [*keys, "seq"], "left_semi")


def repair_pts(packets: DataFrame, raw: str, keys: tuple[str, ...] = ("bag", "topic"), out: str = "pts") -> DataFrame:
    """Strictly increasing repair of ``raw`` along ``seq``: each is at least one more than the repaired one before.

    In closed form the i-th is i plus the greatest ``raw`` minus its own number so far; both number and greatest are taken
    block by block of a log and carried over the blocks.
    """
    p = packets.withColumns({"scan_key": F.struct(*keys), "scan_block": log_block()})
    w = Window.partitionBy("scan_key", "scan_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("mono_i", F.count(F.lit(1)).over(w)).withColumn("mono_m", F.max(F.col(raw) - F.col("mono_i")).over(w))
    totals = p.groupBy("scan_key", "scan_block").agg(F.max("mono_i").alias("n"), F.max("mono_m").alias("m"))
    earlier = Window.partitionBy("scan_key").orderBy("scan_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("n0", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    totals = totals.withColumn("m0", F.max(F.col("m") - F.col("n0")).over(earlier)).select("scan_key", "scan_block", "n0", "m0")
    j = p.join(totals, ["scan_key", "scan_block"])  # the packets stay where they are
    value = F.col("mono_i") + F.col("n0") + F.greatest(F.col("mono_m") - F.col("n0"), F.col("m0"))
    return j.withColumn(out, value.cast("long")).drop("scan_key", "scan_block", "mono_i", "mono_m", "n0", "m0")


def clock_ticks(ns: Column, base_ns: Column, rate: int = 90_000) -> Column:
    """Ticks since the base, rounded half to even."""
    return F.bround((ns - base_ns) / F.lit(1e9) * rate).cast("long")
