"""Fixed-rate grid sampling of asynchronous messages: one state and one action message per tick, in exact integers.

Tick k spans S_k = start + (k+1) D to A_k = S_k + O. Its state is the first message in [S_k, A_k] while k is pending,
its action the first message after A_k, which also makes the next tick pending: the first k with A_k beyond that
message. A message exactly on A_k leaves k pending if it was, else moves past it; along consecutive such hits the two
outcomes alternate, which gives a closed form over windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EPISODE = ("bag", "x_seq")


def pending_ticks(messages: DataFrame, period: int, offset: int, time: str = "t", keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """``messages`` with ``pending``: the tick pending before each message. Times must not decrease along ``seq``.

    ``period`` and ``offset`` (less than the period) are integers in the unit of ``time`` and ``t_start``.
    """
    if not 0 < offset < period:
        raise ValueError(f"the offset {offset} must lie between 0 and the period {period}")
    w = Window.partitionBy(*keys).orderBy("seq")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    since = F.col(time) - F.col("t_start") - (period + offset)
    m = messages.withColumn("g_k", F.floor(since / period).cast("long")).withColumn("g_k", F.when(F.col("g_k") * period > since, F.col("g_k") - 1).when((F.col("g_k") + 1) * period <= since, F.col("g_k") + 1).otherwise(F.col("g_k")))
    m = m.withColumns({"g_hit": (F.col("g_k") >= 0) & (F.col("g_k") * period == since), "g_next": F.greatest(F.lit(0), F.col("g_k") + 1)})
    m = m.withColumns({"g_ph": F.lag("g_hit", 1, False).over(w), "g_pk": F.lag("g_k").over(w), "g_pn": F.lag("g_next", 1, 0).over(w)})
    chained = F.col("g_ph") & (F.col("g_k") - F.col("g_pk")).between(0, 1)
    begins = F.col("g_hit") & ~F.coalesce(chained, F.lit(False))
    moved = F.when(F.col("g_ph") | (F.col("g_pn") != F.col("g_k")), 1).otherwise(0)
    head = F.last(F.when(begins, F.struct(F.col("g_k").alias("k"), moved.alias("s"))), ignorenulls=True).over(upto)
    m = m.withColumn("g_head", head)
    after = F.when(F.col("g_hit"), F.col("g_k") + F.pmod(F.col("g_head.s") + F.col("g_k") - F.col("g_head.k"), F.lit(2))).otherwise(F.col("g_next"))
    m = m.withColumn("g_after", after).withColumn("pending", F.lag("g_after", 1, 0).over(w).cast("long"))
    return m.drop("g_k", "g_hit", "g_next", "g_ph", "g_pk", "g_pn", "g_head", "g_after")


def grid_rows(messages: DataFrame, period: int, offset: int, payload: list[str], time: str = "t", keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """One row per kept tick: ``keys, tick, t_start, state_seq, action_seq`` and ``payload`` as ``state_*`` and ``action_*``.

    Ticks without a state or without a later message are dropped. The two picks are one aggregation with partial sums.
    """
    m = pending_ticks(messages, period, offset, time, keys)
    s = F.col("t_start") + (F.col("pending") + 1) * period
    a = s + offset
    row = F.struct("seq", *payload)
    state, action = F.when(F.col(time).between(s, a), row), F.when(F.col(time) > a, row)
    g = m.groupBy(*keys, "t_start", F.col("pending").alias("tick")).agg(F.min_by(state, F.when(state.isNotNull(), F.col("seq"))).alias("s"), F.min_by(action, F.when(action.isNotNull(), F.col("seq"))).alias("a"))
    g = g.filter("s is not null and a is not null")
    return g.select(*keys, "t_start", "tick", F.col("s.seq").alias("state_seq"), F.col("a.seq").alias("action_seq"), *[F.col(f"s.{c}").alias(f"state_{c}") for c in payload], *[F.col(f"a.{c}").alias(f"action_{c}") for c in payload])


def frames(rows: DataFrame, seconds_per_tick: float, min_rows: int = 30, keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """Grid rows of episodes with at least ``min_rows``, with ``frame_index`` and the contiguous ``timestamp`` frame_index * period."""
    whole = Window.partitionBy(*keys)
    r = rows.withColumns({"frame_index": (F.row_number().over(whole.orderBy("tick")) - 1).cast("long"), "n_rows": F.count("*").over(whole)})
    return r.filter(F.col("n_rows") >= min_rows).withColumn("timestamp", F.col("frame_index") * seconds_per_tick)


def time_gaps(rows: DataFrame, ratio: int, seconds_per_tick: float, keys: tuple[str, ...] = EPISODE) -> DataFrame:
    """Per episode: ``n_rows``, ``n_time_gaps`` (steps of ``ratio`` periods or more between kept ticks) and ``max_time_gap_s`` (of those, else 0)."""
    w = Window.partitionBy(*keys).orderBy("tick")
    g = rows.select(*keys, (F.col("tick") - F.lag("tick").over(w)).alias("step"))
    big = F.when(F.col("step") >= ratio, F.col("step"))
    return g.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count(big).alias("n_time_gaps"), F.coalesce(F.max(big) * seconds_per_tick, F.lit(0.0)).alias("max_time_gap_s"))
