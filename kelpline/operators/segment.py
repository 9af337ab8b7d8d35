"""Episodes cut from logs by operator buttons: rising edges, pairing of start and stop, counts and summaries.

A log has ``bag`` and an explicit order ``seq`` within it. A start while recording discards what was recorded and starts
anew; a stop while idle is ignored; start and stop in one message give an episode without rows; an episode still open
when the log ends is discarded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kelpline.operators.order import previous

#: Positions of the start and stop buttons; shorter button lists are ignored.
START, STOP = 2, 3
#: Message numbers of a log that one task handles.
BLOCK = 1 << 17


def log_block(seq: str = "seq") -> Column:
    """The stretch of a log that a message lies in; logs are spread over their stretches."""
    return F.floor(F.col(seq) / BLOCK)


def edges(presses: DataFrame, start: str, stop: str, keys: tuple[str, ...] = ("bag",)) -> DataFrame:
    """``presses`` with ``x`` and ``y``: the rising edges of the 0/1 columns ``start`` and ``stop``, 0 in the message before and 1 now.

    The first message of a log never fires. The message before is carried over the blocks of a log.
    """
    p = previous(presses, list(keys), ["seq"], [start, stop], log_block(), "edge_before")
    rising = lambda c: F.coalesce((F.col(f"edge_before.{c}") == 0) & (F.col(c) == 1), F.lit(False))
    return p.withColumns({"x": rising(start), "y": rising(stop)}).drop("edge_before")


def button_edges(joystick: DataFrame, buttons: str = "buttons") -> DataFrame:
    """Edges of a button array; messages with a null or short array count for nothing, not even as the message before."""
    ok = joystick.filter(F.size(buttons) > max(START, STOP))
    return edges(ok.withColumns({"b_start": F.col(buttons)[START], "b_stop": F.col(buttons)[STOP]}), "b_start", "b_stop").drop("b_start", "b_stop")


def episodes(marked: DataFrame, time: str = "t", keys: tuple[str, ...] = ("bag",)) -> DataFrame:
    """One row per closed episode: ``keys, x_seq, y_seq, t_start, t_stop`` from rows with edges ``x`` and ``y``.

    Only edge rows are kept before the window, which reduces its input to the few messages that matter.
    """
    e = marked.filter("x or y")
    w = Window.partitionBy(*keys).orderBy("seq")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    started = F.last(F.when(F.col("x"), F.struct("seq", time)), ignorenulls=True).over(upto)
    e = e.withColumns({"started": started, "stopped": F.last(F.when(F.col("y"), F.col("seq")), ignorenulls=True).over(before)})
    closed = F.col("y") & F.col("started").isNotNull() & (F.col("stopped").isNull() | (F.col("started.seq") > F.col("stopped")))
    return e.filter(closed).select(*keys, F.col("started.seq").alias("x_seq"), F.col("seq").alias("y_seq"), F.col(f"started.{time}").alias("t_start"), F.col(time).alias("t_stop"))


def in_episodes(messages: DataFrame, found: DataFrame, keys: tuple[str, ...] = ("bag",)) -> DataFrame:
    """Messages from the start (inclusive) to the stop (exclusive) of their episode, with ``x_seq`` and ``t_start``.

    Episodes must not overlap; one without a stop holds nothing. The boundaries, repeated at the head of each block of
    ``BLOCK`` numbers that an episode spans, go among the messages, and a window hands the latest on: messages are
    shuffled once, there is no join, and a log with a third of all messages is many tasks.
    """
    e = found.filter("x_seq < y_seq").select(*keys, "x_seq", "y_seq", "t_start")
    heads = e.select("*", F.explode(F.sequence(log_block("x_seq"), log_block("y_seq"))).alias("seg_block"))
    heads = heads.select(*keys, F.greatest("x_seq", F.col("seg_block") * BLOCK).cast("long").alias("seq"), F.struct("x_seq", "y_seq", "t_start").alias("seg"), "seg_block").filter("seq < seg.y_seq")
    m = messages.drop("x_seq", "t_start").withColumns({"seg_side": F.lit(1), "seg_block": log_block().cast("long")})
    both = m.unionByName(heads.withColumn("seg_side", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "seg_block").orderBy("seq", "seg_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("seg", F.last("seg", ignorenulls=True).over(w)).filter("seg_side = 1 and seq < seg.y_seq")
    return both.withColumns({"x_seq": F.col("seg.x_seq"), "t_start": F.col("seg.t_start")}).drop("seg", "seg_side", "seg_block")


def bag_summary(found: DataFrame, bags: DataFrame, seconds: Column, fps: float, min_rows: int) -> DataFrame:
    """Per bag: pairs, valid pairs (``floor(duration * fps) >= min_rows``, an estimate) and their durations, ascending by stop."""
    e = found.withColumn("duration_s", seconds).withColumn("valid", F.floor(F.col("duration_s") * fps) >= min_rows)
    n = e.groupBy("bag").agg(F.count("*").alias("n_pairs"), F.count_if("valid").alias("n_valid"), F.sum(F.when(F.col("valid"), F.col("duration_s"))).alias("valid_s"))
    zero = F.lit(0).cast("long")
    return bags.join(n, "bag", "left").withColumns({"n_pairs": F.coalesce("n_pairs", zero), "n_valid": F.coalesce("n_valid", zero), "valid_s": F.coalesce("valid_s", F.lit(0.0))})


def duration_stats(found: DataFrame, seconds: Column, fps: float, min_rows: int) -> DataFrame:
    """One row over all valid episodes: mean, population variance and deviation, min, max and sum; zeros if there are none."""
    d = F.when(F.floor(seconds * fps) >= min_rows, seconds)
    stats = {"dur_mean": F.avg(d), "dur_var": F.var_pop(d), "dur_std": F.stddev_pop(d), "dur_min": F.min(d), "dur_max": F.max(d), "dur_total": F.sum(d)}
    ratio = F.when(F.count("*") > 0, F.count(d) * 100.0 / F.count("*")).otherwise(0.0)
    return found.agg(F.count("*").alias("n_pairs"), F.count(d).alias("n_valid"), ratio.alias("valid_percent"), *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in stats.items()])


def conversion_summary(found: DataFrame, rows: DataFrame, fps: float, keys: tuple[str, ...] = ("bag", "x_seq")) -> DataFrame:
    """One row: ``n_pairs``, ``n_saved`` (pairs with rows), ``n_rows``, ``seconds`` (rows / fps) and ``valid_percent`` (0 without pairs)."""
    kept = rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count("*").alias("n_saved"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.lit(1).alias("one"))
    pairs = found.agg(F.count("*").alias("n_pairs"), F.lit(1).alias("one"))
    percent = F.when(F.col("n_pairs") > 0, F.col("n_saved") * 100.0 / F.col("n_pairs")).otherwise(0.0)
    return pairs.join(kept, "one").select("n_pairs", "n_saved", "n_rows", (F.col("n_rows") / F.lit(float(fps))).alias("seconds"), percent.alias("valid_percent"))


def whole_bags(messages: DataFrame, keyframe: Column, cameras: list[str], keys: tuple[str, ...] = ("bag",)) -> DataFrame:
    """Whole-log mode: ``x_seq, t_start`` where every camera has had a keyframe, ``y_seq`` the number after the log's last; none if one never has."""
    m = messages.withColumn("whole_first", F.when(keyframe & F.col("topic").isin(cameras), F.struct("seq", "t")))
    each = m.groupBy(*keys, "topic").agg(F.min("whole_first").alias("first"), F.max("seq").alias("last"))
    out = each.groupBy(*keys).agg(F.count("first").alias("n"), F.max("first").alias("first"), F.max("last").alias("last")).filter(F.col("n") == len(cameras))
    return out.select(*keys, F.col("first.seq").alias("x_seq"), F.col("first.t").alias("t_start"), (F.col("last") + 1).alias("y_seq"))


def topics(messages: DataFrame, *keys: str) -> DataFrame:
    """``keys, topics``: the sorted topics of each bag, or without keys those of all; distinct before they are gathered."""
    return messages.select(*keys, "topic").distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("topic")).alias("topics"))
