"""Queries over event logs: a user's events are a log, event types its topics, and half a day the sampling period."""

from __future__ import annotations

import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions.formats import codec
from kelpline.operators import convert, datasets, order, sample, segment, steps, video
from kelpline.runtime import materialize, read, scratch_path, shared_dir
from kelpline.streaming import live

#: Sampling period and offset in microseconds, and the period in seconds.
PERIOD, OFFSET, SECONDS = 43_200_000_000, 21_600_000_000, 43_200.0
TOPICS = ("view", "click", "error")
CAMERAS = ["view", "click"]


def events(spark: SparkSession, d: str) -> DataFrame:
    """``bag, topic, t, value, k, event_id``."""
    t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    return read(spark, d, "events").select(F.col("user_id").alias("bag"), F.col("event_type").alias("topic"), t.alias("t"), "value", F.get_json_object("props", "$.k").try_cast("long").alias("k"), "event_id")


def messages(spark: SparkSession, d: str) -> DataFrame:
    """:func:`events` with ``seq``; the explicit order is that of time, then id."""
    return order.number_within(events(spark, d), ["bag"], ["t", "event_id"], F.floor(F.col("t") / (30 * 86_400_000_000)), "seq")


def log(spark: SparkSession, d: str) -> DataFrame:
    """:func:`messages`, numbered once, for queries that read them more than once."""
    return materialize(messages(spark, d), "log")


def joystick(m: DataFrame) -> DataFrame:
    """A button array per message: errors have a short one, sign-ups start and purchases stop."""
    press = lambda x: (F.col("topic") == x).cast("int")
    return m.withColumn("buttons", F.when(F.col("topic") == "error", F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(0), press("signup"), press("purchase"))))


def edge_detect(spark, d):
    return segment.button_edges(joystick(messages(spark, d))).filter("x or y").select("bag", "seq", "x", "y")


def _episodes(m: DataFrame) -> DataFrame:
    return segment.episodes(segment.button_edges(joystick(m)))


def episode_segments(spark, d):
    return _episodes(messages(spark, d))



def _seconds():
    return (F.col("t_stop") - F.col("t_start")) / F.lit(1e6)


def episode_validate_bags(spark, d):
    m = log(spark, d)
    s = segment.bag_summary(_episodes(m), m.select("bag").distinct(), _seconds(), 1 / SECONDS, 1)
    return s.withColumn("valid_s", F.round("valid_s", 3))


def episode_validate_stats(spark, d):
    s = segment.duration_stats(_episodes(messages(spark, d)), _seconds(), 1 / SECONDS, 1)
    return s.select(*[F.round(c, 3).alias(c) if c.startswith(("dur", "valid_p")) else c for c in s.columns])


def _inside(spark, d):
    m = log(spark, d)
    return segment.in_episodes(m, _episodes(m))


def messages_in_episodes(spark, d):
    return _inside(spark, d).groupBy("bag", "x_seq").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def grid_ticks(spark, d):
    return sample.grid_rows(_inside(spark, d), PERIOD, OFFSET, []).select("bag", "x_seq", "tick", "state_seq", "action_seq")


def _rows(spark, d):
    """Grid rows with the latest value of each topic since the start, at the state and at the action message."""
    m = order.fill_forward(_inside(spark, d), ["bag", "x_seq"], ["seq"], {t: F.when(F.col("topic") == t, F.col("value")) for t in TOPICS})
    return sample.grid_rows(m, PERIOD, OFFSET, list(TOPICS))


def episode_frames(spark, d):
    r = sample.frames(_rows(spark, d), SECONDS, 1)
    vector = lambda side: F.array(*[F.coalesce(F.col(f"{side}_{t}"), F.lit(0.0)) for t in TOPICS])
    return r.select("bag", "x_seq", "frame_index", "tick", "timestamp", "state_seq", "action_seq", vector("state").alias("state"), vector("action").alias("action"))


def episode_numbers(spark, d):
    """Kept episodes numbered densely over all logs, in the order of log and stop, with their rows and start frames."""
    r = sample.grid_rows(_inside(spark, d), PERIOD, OFFSET, []).groupBy("bag", "x_seq").agg(F.count("*").alias("n_rows"))
    return order.number_rows(r, "bag", "x_seq", index="episode_index", sums={"start_frame": "n_rows"})


def conversion_summary(spark, d):
    m = log(spark, d)
    found = _episodes(m)
    s = segment.conversion_summary(found, sample.grid_rows(segment.in_episodes(m, found), PERIOD, OFFSET, []), 1 / SECONDS)
    return s.select("n_pairs", "n_saved", "n_rows", *[F.round(c, 3).alias(c) for c in ("seconds", "valid_percent")])


def time_gaps(spark, d):
    return sample.time_gaps(sample.grid_rows(_inside(spark, d), PERIOD, OFFSET, []), 3, SECONDS)


def asof_latest(spark, d):
    """Each purchase with the latest view before it; logs are split by days, so that no log is one task. No order of messages is needed."""
    m = events(spark, d)
    left = m.filter("topic = 'purchase'").select("bag", "t", "event_id")
    right = m.filter("topic = 'view'").select("bag", "t", "event_id", "value")
    day = F.floor(F.col("t") / 86_400_000_000)
    j = order.asof_join(left, right, ["bag"], "t", ["event_id", "value", "t"], tie="event_id", block=day)
    return j.select("event_id", "bag", "asof_event_id", "asof_value", (F.col("t") - F.col("asof_t")).alias("staleness_us"))


def gop_islands(spark, d):
    m = messages(spark, d).filter(F.col("topic").isin(CAMERAS)).withColumn("keyframe", F.col("k") % 10 == 0)
    return video.picture_groups(m).select("bag", "topic", "seq", "gop", "tail_from")


def episode_packets(spark, d):
    m = log(spark, d)
    p = m.filter(F.col("topic").isin(CAMERAS)).withColumn("keyframe", F.coalesce(F.col("k") % 10 == 0, F.lit(False)))
    return video.episode_packets(p.select("bag", "topic", "seq", "keyframe"), _episodes(m))


def _shown(spark, d):
    inside = materialize(_inside(spark, d), "inside")
    rows = sample.grid_rows(inside, PERIOD, OFFSET, [])
    cams = F.explode(F.array(*map(F.lit, CAMERAS)))
    ticks = rows.select("bag", "x_seq", "tick", (F.col("t_start") + (F.col("tick") + 1) * PERIOD).alias("t"), cams.alias("topic"))
    inside = inside.filter(F.col("topic").isin(CAMERAS)).select("bag", "x_seq", "topic", "seq", "t")
    return inside, video.shown_packets(ticks, inside, ["bag", "x_seq", "topic"])


def shown_packets(spark, d):
    """Which packet of each camera every kept tick shows: the latest at or before the tick's time."""
    return _shown(spark, d)[1].select("bag", "x_seq", "tick", "topic", F.col("asof_seq").alias("packet_seq"), (F.col("t") - F.col("asof_packet_t")).alias("staleness_us"))


def needed_packets(spark, d):
    """The packets that must be decoded, as some kept tick shows them."""
    inside, shown = _shown(spark, d)
    return video.needed_packets(inside, shown).select("bag", "x_seq", "topic", "seq")


#: What the converted log makes of the event types: topic, message type.
ROLES = {
    "view": (convert.STATE["left_arm"], "sensor_msgs/msg/JointState"), "click": (convert.ACTION["left_arm"], "sensor_msgs/msg/JointState"), "error": (convert.STATE["right_gripper"], "sensor_msgs/msg/JointState"),
    "signup": (convert.MARKERS, "sensor_msgs/msg/Joy"), "purchase": (convert.MARKERS, "sensor_msgs/msg/Joy"),
}


def _payloads(parts):
    """Events as message bytes: joint states of position and velocity, and joystick messages of four buttons."""

    def padded(body: bytes, code: str, *v) -> bytes:
        body += b"\0" * (-len(body) % struct.calcsize(code))
        return body + struct.pack(f"<{len(v)}{code}", *v)

    def numbers(body: bytes, code: str, v: list) -> bytes:
        body = padded(body, "I", len(v))
        return padded(body, code, *v) if v else body

    head = struct.pack("<III", 0, 0, 1) + b"\0"
    for p in parts:
        out = []
        for topic, value, k in zip(p["topic"], p["value"].fillna(0.0), p["k"].fillna(0)):
            if topic in ("signup", "purchase"):
                body = numbers(numbers(head, "f", []), "i", [0, 0, int(topic == "signup"), int(topic == "purchase")])
            else:
                position = {"view": [value, float(k), 1.0], "click": [value], "error": [value]}[topic]
                body = numbers(head, "I", [])
                for v in (position, [float(k)] if topic == "error" else [], []):
                    body = numbers(body, "d", v)
            out.append(b"\0\1\0\0" + body)
        yield p.assign(data=out)[["bag", "seq", "event", "ts_ns", "data"]]


def converted_frames(spark, d):
    """The whole conversion - episodes, grid, late decoding, vectors, least length - of a log of message bytes made from the events."""
    m = log(spark, d).select("bag", "seq", "topic", "value", "k", F.expr("t div 1944").alias("ts_ns"))
    m = m.withColumn("event", F.col("topic")).mapInPandas(_payloads, "bag long, seq long, event string, ts_ns long, data binary")
    role = lambda i: F.coalesce(*[F.when(F.col("event") == e, r[i]) for e, r in ROLES.items()])
    m = materialize(m.select("bag", "seq", role(0).alias("topic"), role(1).alias("msg_type"), "ts_ns", "data"), "messages")
    f = convert.frames(m, 45, 90, min_rows=2)
    return f.select("bag", "x_seq", "frame_index", "tick", F.round("timestamp", 9).alias("timestamp"), "state", "action", "chassis_state", "chassis_action")


def camera_sizes(spark, d):
    """The size of each packet's pictures: its own, else that of a calibration that every third has, else a default."""
    p = read(spark, d, "packets")
    third = F.col("packet_id") % 3 == 0
    size = steps.camera_size(F.when(F.col("packet_id") % 2 == 0, F.col("width")), F.col("height"), F.when(third, 1280), F.when(third, (F.col("packet_id") % 5 * 144).cast("int")), (640, 480))
    return p.select("packet_id", size["width"].alias("width"), size["height"].alias("height"))


def crop_boxes(spark, d):
    box = steps.crop_box(F.col("width"), F.col("height"), F.col("topic").contains("xr_video"))
    return read(spark, d, "packets").select("packet_id", *[box[c].alias(c) for c in ("x", "y", "width", "height", "side")])


def camera_topics(spark, d):
    return read(spark, d, "packets").groupBy("topic", convert.camera_key(F.col("topic")).alias("camera")).agg(F.count("*").alias("n"))


def camera_defaults(spark, d):
    """Every camera of every log with its first calibration, or with none."""
    e = messages(spark, d).filter("topic in ('view', 'click') and k > 50")
    heard = e.select("bag", F.col("topic").alias("camera"), "seq", F.array(F.col("value")).alias("K"), F.col("k").cast("int").alias("width"), F.col("k").cast("int").alias("height"), F.col("topic").alias("distortion_model"))
    every = events(spark, d).select("bag").distinct().withColumn("camera", F.explode(F.array(*map(F.lit, (*CAMERAS, "none")))))
    return steps.with_calibration(every, steps.first_calibration(heard)).select("bag", "camera", "found", F.size("K").alias("n_k"), "width", "height", "distortion_model")


def pts_monotone(spark, d):
    p = messages(spark, d).filter("value is not null").withColumn("raw", F.floor("value").cast("long"))
    return video.repair_pts(p, "raw", ("bag",)).select("bag", "seq", "raw", "pts")


def pts_clock(spark, d):
    e = events(spark, d)
    base = e.groupBy("bag").agg(F.min("t").alias("base"))
    return e.join(base, "bag").select("event_id", video.clock_ticks(F.col("t") * 1000, F.col("base") * 1000, 9).alias("pts"))


def keyframes(spark, d):
    p = read(spark, d, "packets").select("topic", video.is_keyframe("data").alias("keyframe"), codec(F.col("encoding")).alias("codec"))
    return p.groupBy("topic", "codec").agg(F.count("*").alias("n"), F.count_if("keyframe").alias("n_keyframes"))


def rlds_steps(spark, d):
    f = read(spark, d, "hdf5_frames").select("episode_idx", "frame_index").distinct()
    return steps.steps(f, 45.0, F.lit("task description")).withColumn("step_time", F.round("step_time", 9)).drop("n_steps")


def rlds_nested(spark, d):
    f = read(spark, d, "hdf5_frames").select("episode_idx", "frame_index").distinct()
    n = steps.nested(steps.steps(f, 45.0, F.lit("t")), ["frame_index", "reward", "is_last"])
    return n.select("episode_idx", "n_steps", F.col("steps.frame_index").alias("frame_indexes"), F.aggregate("steps", F.lit(0.0), lambda a, s: a + s["reward"]).alias("total_reward"), F.try_element_at("steps", F.lit(-1))["is_last"].alias("ends"))


def topic_catalog(spark, d):
    return segment.topics(events(spark, d), "bag")


def topic_union(spark, d):
    return segment.topics(events(spark, d))


def require_topics(spark, d):
    return convert.with_cameras(events(spark, d), {"left": "view", "right": "click", "head": "signup"}).select("bag").distinct()


def _streamed(spark: SparkSession, batch: DataFrame, run, mode: str = "append") -> DataFrame:
    """The result of a streaming plan over ``batch``, written as files and read as a stream to its end."""
    top = scratch_path(spark, f"{shared_dir(spark)}/kelpline-live-{uuid.uuid4().hex}")
    batch.write.parquet(f"{top}/in")
    out = run(spark.readStream.schema(batch.schema).parquet(f"{top}/in"))
    sink = out.writeStream.outputMode(mode).option("checkpointLocation", f"{top}/state").trigger(availableNow=True)
    if mode == "append":
        q = sink.format("parquet").option("path", f"{top}/out").start()
    else:
        q = sink.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{top}/out")).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{top}/out")


def _live(spark, d):
    m = joystick(messages(spark, d))
    return m.select(F.col("bag").cast("string").alias("bag"), "seq", "t", "topic", "value", "k", "buttons")


def live_segments(spark, d):
    """Episodes as a stream closes them."""
    return _streamed(spark, _live(spark, d), live.live_episodes).drop("n_late")


def live_ticks(spark, d):
    """Grid rows as a stream gives them when their episode stops."""
    return _streamed(spark, _live(spark, d), lambda m: live.live_grid(m, PERIOD, OFFSET, 1))


def live_buffers(spark, d):
    """The packets of each episode out of a stream's rings and buffers."""
    m = _live(spark, d).withColumn("keyframe", F.when(F.col("topic").isin(CAMERAS), F.coalesce(F.col("k") % 10 == 0, F.lit(False))))
    return _streamed(spark, m, live.live_packets)


def live_values(spark, d):
    """The latest value of every topic of every log at a stream's end."""
    return _streamed(spark, _live(spark, d).select("bag", "topic", "seq", "value"), lambda m: live.live_latest(m, "value"), "complete")


def first_calibration(spark, d):
    return steps.first_calibration(messages(spark, d).select("bag", F.col("topic").alias("camera"), "seq", "value", "k"))


def dedupe_first(spark, d):
    return datasets.keep_first(messages(spark, d).select("bag", "topic", "event_id", "t"), ["bag"], "t", "event_id")


def whole_bag(spark, d):
    return segment.whole_bags(messages(spark, d), F.coalesce(F.col("k") % 3 == 0, F.lit(False)), ["view", "click", "purchase"]).select("bag", "x_seq", "t_start")


def change_events(spark, d):
    """Events whose value differs from the one before in their log; the first is a change."""
    m = events(spark, d).withColumns({"level": F.floor(F.col("value") / 50).cast("long")})
    return order.changes(m, ["bag"], ["t", "event_id"], "level", F.floor(F.col("t") / (30 * 86_400_000_000))).select("event_id", "level", "before")


QUERIES = {f.__name__: f for f in (
    episode_frames, edge_detect, episode_segments, episode_validate_bags, episode_validate_stats, messages_in_episodes, grid_ticks, episode_numbers, conversion_summary, time_gaps, asof_latest, gop_islands, episode_packets,
    live_segments, live_ticks, live_buffers, live_values, shown_packets, needed_packets, converted_frames, camera_sizes, crop_boxes, camera_topics, camera_defaults, pts_monotone, pts_clock, keyframes, rlds_steps, rlds_nested, topic_catalog, topic_union, require_topics, first_calibration, dedupe_first, whole_bag, change_events,
)}

_M = """
with m as (
  select user_id as bag, event_type as topic, epoch_us(ts) as t, value, try_cast(json_extract_string(props, '$.k') as bigint) as k, event_id,
         row_number() over (partition by user_id order by ts, event_id) as seq from events
), j as (
  select bag, seq, t, (topic = 'signup')::int as bx, (topic = 'purchase')::int as by_ from m where topic <> 'error'
), e as (
  select bag, seq, t, coalesce(lag(bx) over w = 0 and bx = 1, false) as x, coalesce(lag(by_) over w = 0 and by_ = 1, false) as y from j window w as (partition by bag order by seq)
), c as (
  select *, max(case when x then seq end) over (partition by bag order by seq rows unbounded preceding) as x_seq,
         max(case when y then seq end) over (partition by bag order by seq rows between unbounded preceding and 1 preceding) as y_before
  from e where x or y
), ep as (
  select c.bag, c.x_seq, c.seq as y_seq, m.t as t_start, c.t as t_stop from c join m on m.bag = c.bag and m.seq = c.x_seq
  where c.y and c.x_seq is not null and (c.y_before is null or c.x_seq > c.y_before)
), i as (
  select m.*, ep.x_seq, ep.t_start from m join ep on m.bag = ep.bag and m.seq >= ep.x_seq and m.seq < ep.y_seq
), p as (
  select *, coalesce(lag(case when t < t_start + 64800000000 then 0 else (t - t_start - 64800000000) // 43200000000 + 1 end) over (partition by bag, x_seq order by seq), 0) as pending from i
), g as (
  select bag, x_seq, t_start, pending as tick,
         min(case when t between t_start + (pending + 1) * 43200000000 and t_start + (pending + 1) * 43200000000 + 21600000000 then seq end) as state_seq,
         min(case when t > t_start + (pending + 1) * 43200000000 + 21600000000 then seq end) as action_seq
  from p group by all having state_seq is not null and action_seq is not null
)
"""
_FILL = ", ".join(f"coalesce(last_value(case when topic = '{t}' then value end ignore nulls) over (partition by bag, x_seq order by seq rows unbounded preceding), 0.0)" for t in TOPICS)

ORACLE = {
    "edge_detect": _M + "select bag, seq, x, y from e where x or y",
    "episode_segments": _M + "select * from ep",
    "episode_validate_bags": _M + """
select b.bag, count(ep.bag) as n_pairs, count(case when floor((t_stop - t_start) / 1e6 * (1 / 43200.0::double)) >= 1 then 1 end) as n_valid,
       round(coalesce(sum(case when floor((t_stop - t_start) / 1e6 * (1 / 43200.0::double)) >= 1 then (t_stop - t_start) / 1e6 end), 0), 3) as valid_s
from (select distinct bag from m) b left join ep on b.bag = ep.bag group by b.bag""",
    "episode_validate_stats": _M + """
, v as (select case when floor((t_stop - t_start) / 1e6 * (1 / 43200.0::double)) >= 1 then (t_stop - t_start) / 1e6 end as s from ep)
select count(*) as n_pairs, count(s) as n_valid, round(case when count(*) > 0 then count(s) * 100.0::double / count(*) else 0 end, 3) as valid_percent, round(coalesce(avg(s), 0), 3) as dur_mean, round(coalesce(var_pop(s), 0), 3) as dur_var,
       round(coalesce(stddev_pop(s), 0), 3) as dur_std, round(coalesce(min(s), 0), 3) as dur_min, round(coalesce(max(s), 0), 3) as dur_max, round(coalesce(sum(s), 0), 3) as dur_total from v""",
    "messages_in_episodes": _M + "select bag, x_seq, count(*) as n, min(seq) as first_seq, max(seq) as last_seq from i group by all",
    "grid_ticks": _M + "select bag, x_seq, tick, state_seq, action_seq from g",
    "episode_frames": _M + f"""
, f as (select bag, x_seq, seq, [{_FILL}] as vec from i)
select g.bag, g.x_seq, row_number() over (partition by g.bag, g.x_seq order by tick) - 1 as frame_index, tick, (row_number() over (partition by g.bag, g.x_seq order by tick) - 1) * 43200.0::double as timestamp,
       state_seq, action_seq, s.vec as state, a.vec as action
from g join f s on s.bag = g.bag and s.x_seq = g.x_seq and s.seq = g.state_seq join f a on a.bag = g.bag and a.x_seq = g.x_seq and a.seq = g.action_seq""",
    "episode_numbers": _M + """
, r as (select bag, x_seq, count(*) as n_rows from g group by all)
select bag, x_seq, n_rows, row_number() over (order by bag, x_seq) - 1 as episode_index, coalesce(sum(n_rows) over (order by bag, x_seq rows between unbounded preceding and 1 preceding), 0)::bigint as start_frame from r""",
    "conversion_summary": _M + """
, a as (select count(*) as n_pairs from ep), b as (select count(distinct (bag, x_seq)) as n_saved, count(*) as n_rows from g)
select n_pairs, n_saved, n_rows, round(n_rows / (1 / 43200.0::double), 3) as seconds, round(n_saved * 100.0::double / n_pairs, 3) as valid_percent from a, b""",
    "time_gaps": _M + """
, s as (select bag, x_seq, tick - lag(tick) over (partition by bag, x_seq order by tick) as step from g)
select bag, x_seq, count(*) as n_rows, count(case when step >= 3 then 1 end) as n_time_gaps, coalesce(max(case when step >= 3 then step end) * 43200.0::double, 0) as max_time_gap_s from s group by all""",
    "asof_latest": _M + """
select l.event_id, l.bag, r.event_id as asof_event_id, r.value as asof_value, l.t - r.t as staleness_us
from (select * from m where topic = 'purchase') l asof left join (select * from m where topic = 'view') r on l.bag = r.bag and l.t >= r.t""",
    "gop_islands": _M + """
select bag, topic, seq, count(case when k % 10 = 0 then 1 end) over (partition by bag, topic order by seq rows unbounded preceding) as gop,
       max(case when k % 10 = 0 then seq end) over (partition by bag, topic order by seq rows between 59 preceding and current row) as tail_from
from m where topic in ('view', 'click')""",
    "episode_packets": _M + """
, q as (select bag, topic, seq, k % 10 = 0 as keyframe, row_number() over (partition by bag, topic order by seq) as nr from m where topic in ('view', 'click')),
z as (select ep.bag, ep.x_seq, q.topic, max(q.nr) as last_nr from ep join q on ep.bag = q.bag and q.seq < ep.x_seq group by all),
y as (select z.*, (select max(q.seq) from q where q.bag = z.bag and q.topic = z.topic and q.keyframe and q.nr between z.last_nr - 59 and z.last_nr) as tail from z)
select ep.bag, ep.x_seq, q.topic, q.seq from ep join q on ep.bag = q.bag and q.seq >= ep.x_seq and q.seq < ep.y_seq
union all
select y.bag, y.x_seq, q.topic, q.seq from y join q on q.bag = y.bag and q.topic = y.topic and q.seq >= y.tail and q.seq < y.x_seq""",
    "live_buffers": _M + """
, q as (select bag, topic, seq, k % 10 = 0 as keyframe, row_number() over (partition by bag, topic order by seq) as nr from m where topic in ('view', 'click')),
z as (select ep.bag, ep.x_seq, q.topic, max(q.nr) as last_nr from ep join q on ep.bag = q.bag and q.seq < ep.x_seq group by all),
y as (select z.*, (select max(q.seq) from q where q.bag = z.bag and q.topic = z.topic and q.keyframe and q.nr between z.last_nr - 59 and z.last_nr) as tail from z)
select ep.bag::varchar as bag, ep.x_seq, q.topic, q.seq from ep join q on ep.bag = q.bag and q.seq >= ep.x_seq and q.seq < ep.y_seq
union all
select y.bag::varchar, y.x_seq, q.topic, q.seq from y join q on q.bag = y.bag and q.topic = y.topic and q.seq >= y.tail and q.seq < y.x_seq""",
    "shown_packets": _M + """
, k as (select bag, x_seq, tick, t_start + (tick + 1) * 43200000000 as t, topic from g, (select unnest(['view', 'click']) as topic))
select k.bag, k.x_seq, k.tick, k.topic, i.seq as packet_seq, k.t - i.t as staleness_us
from k asof left join (select * from i where topic in ('view', 'click')) i on k.bag = i.bag and k.x_seq = i.x_seq and k.topic = i.topic and k.t >= i.t""",
    "live_segments": _M + "select bag::varchar as bag, x_seq, y_seq, t_start, t_stop from ep",
    "live_ticks": _M + "select bag::varchar as bag, x_seq, tick, state_seq, action_seq from g",
    "live_values": _M + "select bag::varchar as bag, topic, max(seq) as seq, arg_max_null(value, seq) as value from m group by 1, 2",
    "needed_packets": _M + """
, k as (select bag, x_seq, tick, t_start + (tick + 1) * 43200000000 as t, topic from g, (select unnest(['view', 'click']) as topic))
select distinct k.bag, k.x_seq, k.topic, i.seq
from k asof join (select * from i where topic in ('view', 'click')) i on k.bag = i.bag and k.x_seq = i.x_seq and k.topic = i.topic and k.t >= i.t""",
    "converted_frames": """
with m as (
  select user_id as bag, event_type as topic, epoch_us(ts) // 1944 as ns, coalesce(value, 0) as value, coalesce(try_cast(json_extract_string(props, '$.k') as bigint), 0) as k,
         row_number() over (partition by user_id order by ts, event_id) as seq from events
), e as (
  select bag, seq, ns, coalesce(lag(topic) over w = 'purchase' and topic = 'signup', false) as x, coalesce(lag(topic) over w = 'signup' and topic = 'purchase', false) as y
  from m where topic in ('signup', 'purchase') window w as (partition by bag order by seq)
), c as (
  select *, max(case when x then seq end) over (partition by bag order by seq rows unbounded preceding) as x_seq,
         max(case when y then seq end) over (partition by bag order by seq rows between unbounded preceding and 1 preceding) as y_before
  from e where x or y
), ep as (
  select c.bag, c.x_seq, c.seq as y_seq, m.ns as start_ns from c join m on m.bag = c.bag and m.seq = c.x_seq where c.y and c.x_seq is not null and (c.y_before is null or c.x_seq > c.y_before)
), i as (
  select m.*, ep.x_seq, (m.ns - ep.start_ns) * 4050 as u,
         max(case when topic = 'view' then m.seq end) over h as view_seq, max(case when topic = 'click' then m.seq end) over h as click_seq, max(case when topic = 'error' then m.seq end) over h as error_seq
  from m join ep on m.bag = ep.bag and m.seq >= ep.x_seq and m.seq < ep.y_seq window h as (partition by m.bag, ep.x_seq order by m.seq rows unbounded preceding)
), p as (
  select *, coalesce(lag(case when u < 135000000000 then 0 else (u - 135000000000) // 90000000000 + 1 end) over (partition by bag, x_seq order by seq), 0) as pending from i
), g as (
  select bag, x_seq, pending as tick, min(case when u between (pending + 1) * 90000000000 and (pending + 1) * 90000000000 + 45000000000 then seq end) as state_seq,
         min(case when u > (pending + 1) * 90000000000 + 45000000000 then seq end) as action_seq
  from p group by all having state_seq is not null and action_seq is not null
), r as (select *, row_number() over (partition by bag, x_seq order by tick) - 1 as frame_index, count(*) over (partition by bag, x_seq) as n from g),
z as (select [0, 0, 0, 0, 0, 0, 0]::float[] as z7)
select r.bag, r.x_seq, r.frame_index, r.tick, round(r.frame_index * (1 / 45.0::double), 9) as timestamp,
       list_concat(list_concat([coalesce(v.value, 0), coalesce(v.k, 0), case when v.seq is null then 0 else 1 end, 0, 0, 0, 0, 0]::float[], z7), list_concat([coalesce(f.value, 0)]::float[], list_concat(z7, [0]::float[])),
                   list_concat(z7, [coalesce(f.k, 0)]::float[]), list_concat(list_concat(z7, z7), list_concat(z7, z7)), [0, 0]::float[]) as state,
       list_concat([coalesce(a.value, 0)]::float[], list_concat(list_concat(z7, z7), list_concat(z7, z7)), list_concat(list_concat(z7, z7), list_concat(z7, z7)), [0, 0, 0, 0, 0]::float[]) as action,
       [0, 0, 0, 0, 0, 0, 0, 0, 0]::float[] as chassis_state, [0, 0, 0, 0, 0, 0, 0, 0, 0]::float[] as chassis_action
from r join i s on s.bag = r.bag and s.x_seq = r.x_seq and s.seq = r.state_seq join i b on b.bag = r.bag and b.x_seq = r.x_seq and b.seq = r.action_seq
left join m v on v.bag = r.bag and v.seq = s.view_seq left join m f on f.bag = r.bag and f.seq = s.error_seq left join m a on a.bag = r.bag and a.seq = b.click_seq, z
where r.n >= 2""",
    "camera_sizes": """select packet_id, case when packet_id % 2 = 0 and width is not null and height is not null then width when packet_id % 3 = 0 and packet_id % 5 > 0 then 1280 else 640 end as width,
 case when packet_id % 2 = 0 and width is not null and height is not null then height when packet_id % 3 = 0 and packet_id % 5 > 0 then (packet_id % 5 * 144)::int else 480 end as height from packets""",
    "crop_boxes": "select packet_id, 0 as x, 0 as y, case when topic like '%xr_video%' then width // 2 else width end as width, height, 224 as side from packets",
    "camera_topics": """select topic, case topic when '/left/color/image_raw/ffmpeg' then 'left_color' when '/right/color/image_raw/ffmpeg' then 'right_color' when '/xr_video_topic/ffmpeg' then 'head_camera' end as camera, count(*) as n
from packets group by 1, 2""",
    "camera_defaults": _M + """
, f as (select bag, topic, arg_min(k, seq) as k from m where topic in ('view', 'click') and k > 50 group by 1, 2), b as (select distinct bag from m)
select b.bag, c.camera, f.bag is not null as found, case when f.bag is not null then 1 else 9 end as n_k, coalesce(f.k, 0)::int as width, coalesce(f.k, 0)::int as height, coalesce(f.topic, '') as distortion_model
from b cross join (select unnest(['view', 'click', 'none']) as camera) c left join f on f.bag = b.bag and f.topic = c.camera""",
    "pts_monotone": _M + """
, r as (select bag, seq, floor(value)::bigint as raw, row_number() over (partition by bag order by seq) as n from m where value is not null)
select bag, seq, raw, n + max(raw - n) over (partition by bag order by seq rows unbounded preceding) as pts from r""",
    "pts_clock": _M + "select event_id, round_even((t * 1000 - min(t) over (partition by bag) * 1000) / 1e9 * 9, 0)::bigint as pts from m",
    "keyframes": """
select topic, case when lower(encoding) like '%hevc%' or lower(encoding) like '%h265%' or lower(encoding) like '%x265%' then 'hevc'
  when lower(encoding) like '%h264%' or lower(encoding) like '%avc%' or lower(encoding) like '%x264%' then 'h264' else encoding end as codec,
  count(*) as n, count(case when substr(hex(data), 1, 6) = '000001' and (('0x' || substr(hex(data), 7, 2))::int >> 1) & 63 in (19, 20) then 1 end) as n_keyframes
from packets group by all""",
    "rlds_steps": """
with f as (select distinct episode_idx, frame_index from hdf5_frames),
s as (select *, row_number() over (partition by episode_idx order by frame_index) - 1 as step, count(*) over (partition by episode_idx) as n from f)
select episode_idx, frame_index, step, step = 0 as is_first, step = n - 1 as is_last, step = n - 1 as is_terminal, case when step = n - 1 then 1.0::double else 0.0 end as reward,
       case when step = n - 1 then 0.0::double else 1.0 end as discount, round(step / 45.0::double, 9) as step_time, 'task description' as language_instruction from s""",
    "rlds_nested": """
with f as (select distinct episode_idx, frame_index from hdf5_frames)
select episode_idx, count(*) as n_steps, list(frame_index order by frame_index) as frame_indexes, 1.0::double as total_reward, true as ends from f group by 1""",
    "topic_catalog": _M + "select bag, list_sort(list(distinct topic)) as topics from m group by 1",
    "topic_union": _M + "select list_sort(list(distinct topic)) as topics from m",
    "require_topics": _M + "select bag from m where topic in ('view', 'click', 'signup') group by 1 having count(distinct topic) = 3",
    "first_calibration": _M + "select bag, topic as camera, arg_min_null(value, seq) as value, arg_min_null(k, seq) as k from m group by 1, 2",
    "dedupe_first": _M + "select bag, topic, event_id, t from m where seq = 1",
    "whole_bag": _M + """
, f as (select bag, topic, min(seq) as seq from m where topic in ('view', 'click', 'purchase') and k % 3 = 0 group by 1, 2),
w as (select bag, max(seq) as x_seq from f group by 1 having count(*) = 3)
select w.bag, w.x_seq, m.t as t_start from w join m on m.bag = w.bag and m.seq = w.x_seq""",
    "change_events": _M + """
, l as (select event_id, seq, floor(value / 50)::bigint as level, lag(floor(value / 50)::bigint) over (partition by bag order by seq) as before from m)
select event_id, level, before from l where level is distinct from before or seq = 1""",
}
