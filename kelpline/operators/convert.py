"""From logs to episode datasets: segmentation, grid sampling and as-of vectors composed into one plan.

Payloads are decoded late: the plan first finds which message each frame needs of each topic, by its number alone, and
decodes only those messages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.functions import vectors
from kelpline.operators import order, sample, segment, steps, video
from kelpline.runtime import materialize
from kelpline.sources.bags import decode

#: Topics by what they carry.
MARKERS = "/xr/left_hand_inputs"
CAMERAS = {"left_color": "/left/color/image_raw/ffmpeg", "right_color": "/right/color/image_raw/ffmpeg", "head_camera": "/xr_video_topic/ffmpeg"}
CAMERA_INFO = {"left_color": "/left/color/camera_info", "right_color": "/right/color/camera_info"}
STATE = {
    "left_arm": "/left_arm/joint_states", "left_gripper": "/left_gripper/joint_states", "right_arm": "/right_arm/joint_states", "right_gripper": "/right_gripper/joint_states",
    "left_pose": "/left_arm/current_ee_pose", "right_pose": "/right_arm/current_ee_pose", "chassis": "/chassis/joint_states", "lift": "/kinco/actual_velocity",
}
ACTION = {
    "left_arm": "/left_arm/joint_cmd", "left_gripper": "/left_gripper/joint_cmd", "right_arm": "/right_arm/joint_cmd", "right_gripper": "/right_gripper/joint_cmd",
    "left_pose": "/left_arm/target_ee_pose", "right_pose": "/right_arm/target_ee_pose", "chassis": "/chassis/joint_cmd", "lift": "/kinco/cmd_velocity",
}
KINDS = {"left_arm": "JointState", "right_arm": "JointState", "left_gripper": "JointState", "right_gripper": "JointState", "chassis": "JointState", "left_pose": "Pose", "right_pose": "Pose", "lift": "Float64"}


def with_cameras(messages: DataFrame, cameras: dict[str, str] = CAMERAS) -> DataFrame:
    """Messages of the bags that have every camera's topic."""
    n = messages.filter(F.col("topic").isin(*cameras.values())).select("bag", "topic").distinct().groupBy("bag").agg(F.count("*").alias("n")).filter(F.col("n") == len(cameras))
    return messages.join(n.select("bag"), "bag", "left_semi")


def episodes(messages: DataFrame) -> DataFrame:
    """Closed episodes of the logs: ``bag, x_seq, y_seq, t_start, t_stop`` in nanoseconds."""
    joy = decode(messages.filter(F.col("topic") == MARKERS), "Joy").select("bag", "seq", F.col("ts_ns").alias("t"), F.col("payload.buttons").alias("buttons"))
    return segment.episodes(segment.button_edges(joy))


def _values(messages: DataFrame, needed: DataFrame) -> DataFrame:
    """``bag, seq, part, vector``: the flattened payload of each needed message, decoded once."""
    raw = needed.select("bag", "seq", "part").distinct().join(messages.select("bag", "seq", "msg_type", "data"), ["bag", "seq"])
    out = []
    for kind in ("JointState", "Pose", "Float64"):
        d = decode(raw.filter(F.col("part").isin(*[p for p, k in KINDS.items() if k == kind])), kind)
        p = F.col("payload")
        if kind == "JointState":
            three = (p["position"], p["velocity"], p["effort"])
            v = F.when(F.col("part").endswith("gripper"), vectors.flatten_gripper(*three)).when(F.col("part") == "chassis", vectors.flatten(*three, 3)).otherwise(vectors.flatten(*three, 7))
        else:
            v = vectors.flatten_pose(p) if kind == "Pose" else F.array(p["data"].cast("float"))
        out.append(d.select("bag", "seq", "part", v.alias("vector")))
    return reduce(DataFrame.unionByName, out)


def frames(messages: DataFrame, fps: int = 45, offset_hz: int = 90, min_rows: int = 30, lift: bool = False, found: DataFrame | None = None, reset: bool = True) -> DataFrame:
    """``bag, x_seq, frame_index, tick, timestamp, state, action`` and, without ``lift``, ``chassis_state, chassis_action``.

    Time is counted from the episode's start in units of 1/(offset_hz * fps) ns, exact integers. Values are those
    latest at the state's and at the action's message since the start (``reset``; else since the log's begin); a topic
    not heard is zeros. With ``lift`` chassis and lift are part of 72-slot vectors. ``found`` replaces the episodes cut
    by the markers.
    """
    marks = episodes(messages) if found is None else found
    wanted = [*CAMERAS.values(), MARKERS, *[t for k, t in (*STATE.items(), *ACTION.items()) if lift or k != "lift"]]
    m = messages.filter(F.col("topic").isin(*wanted)).select("bag", "seq", "topic", "ts_ns")
    parts = {f"{side}_{k}": t for side, group in (("s", STATE), ("a", ACTION)) for k, t in group.items() if lift or k != "lift"}
    fill = {n: F.when(F.col("topic") == t, F.col("seq")) for n, t in parts.items()}
    if not reset:
        m = order.fill_forward(m, ["bag"], ["seq"], fill, segment.log_block())
    inside = segment.in_episodes(m, marks)
    if reset:
        inside = order.fill_forward(inside, ["bag", "x_seq"], ["seq"], fill)
    inside = inside.withColumns({"t": (F.col("ts_ns") - F.col("t_start")) * (offset_hz * fps), "t_start": F.lit(0).cast("long")})
    rows = sample.grid_rows(inside, 1_000_000_000 * offset_hz, 1_000_000_000 * fps, list(parts))
    kept = sample.frames(rows, 1 / fps, min_rows)
    picks = F.array(*[F.struct(F.lit(n[0]).alias("side"), F.lit(n[2:]).alias("part"), F.col(f"{'state' if n[0] == 's' else 'action'}_{n}").alias("seq")) for n in parts])
    needed = kept.select("bag", "x_seq", "frame_index", F.explode(picks).alias("p")).select("bag", "x_seq", "frame_index", "p.*").filter("seq is not null")
    v = needed.join(_values(messages, needed), ["bag", "seq", "part"])
    names = {n: F.first(F.when((F.col("side") == n[0]) & (F.col("part") == n[2:]), F.col("vector")), ignorenulls=True).alias(n) for n in parts}
    wide = kept.select("bag", "x_seq", "frame_index", "tick", "timestamp", "n_rows").join(v.groupBy("bag", "x_seq", "frame_index").agg(*names.values()), ["bag", "x_seq", "frame_index"], "left")
    body = ("left_arm", "left_gripper", "right_arm", "right_gripper", "left_pose", "right_pose")
    build = lambda s: vectors.assemble(*[F.col(f"{s}_{k}") for k in body], *([F.col(f"{s}_chassis"), F.col(f"{s}_lift")] if lift else []))
    out = [build("s").alias("state"), build("a").alias("action")]
    if not lift:
        out += [vectors.pad(F.col(f"{s}_chassis"), 9).cast("array<float>").alias(f"chassis_{n}") for s, n in (("s", "state"), ("a", "action"))]
    return wide.select("bag", "x_seq", "frame_index", "tick", "timestamp", *out)


def number_episodes(frames_: DataFrame, start: int = 0) -> DataFrame:
    """``bag, x_seq, episode_index, length``: kept episodes numbered over all logs in the order of log and start."""
    e = frames_.groupBy("bag", "x_seq").agg(F.count("*").alias("length"))
    return order.number_rows(e, "bag", "x_seq", index="episode_index", start=start)


def _camera_packets(messages: DataFrame) -> DataFrame:
    """``bag, seq, ts_ns, topic, payload, keyframe`` of the cameras' packets; broken ones are left out."""
    p = decode(messages.filter(F.col("topic").isin(*CAMERAS.values())), "FFMPEGPacket").filter("payload is not null")
    return p.select("bag", "seq", "ts_ns", "topic", "payload", video.is_keyframe(F.col("payload.data")).alias("keyframe"))


def episode_pictures(messages: DataFrame, found: DataFrame) -> DataFrame:
    """``bag, x_seq, camera, seq, ts_ns, pts, width, height, encoding, keyframe, data``: the packets that each episode's pictures
    need, from the last keyframe ahead of it on, with their time stamps made increasing."""
    p = materialize(_camera_packets(messages), "packets")
    need = video.episode_packets(p.select("bag", "topic", "seq", "keyframe"), found)
    each = p.join(need, ["bag", "topic", "seq"]).withColumn("raw_pts", F.col("payload.pts"))
    each = video.repair_pts(each, "raw_pts", ("bag", "x_seq", "topic"))
    return each.select("bag", "x_seq", camera_key(F.col("topic")).alias("camera"), "seq", "ts_ns", "pts", "payload.width", "payload.height", "payload.encoding", "keyframe", "payload.data")


def pictures(messages: DataFrame, found: DataFrame, frames_: DataFrame, fps: int) -> DataFrame:
    """``bag, x_seq, frame_index`` and, per camera, the packet that the frame shows: the latest of its episode at the tick's time, null if none yet.

    Packets are passed on as they are; pictures are not decoded.
    """
    marks = found.select("bag", "x_seq", F.col("t_start").alias("began"))
    ticks = frames_.select("bag", "x_seq", "frame_index", "tick").join(marks, ["bag", "x_seq"])
    at = F.col("began") + F.floor((F.col("tick") + 1) * 1_000_000_000 / F.lit(fps))
    ticks = ticks.withColumn("ts_ns", at.cast("long")).withColumn("topic", F.explode(F.array(*map(F.lit, CAMERAS.values())))).select("bag", "x_seq", "topic", "frame_index", "ts_ns")
    p = materialize(_camera_packets(messages), "packets")
    inside = segment.in_episodes(p.select("bag", "seq", "ts_ns", "topic"), found)
    shown = video.shown_packets(ticks, inside.select("bag", "x_seq", "topic", "seq", "ts_ns"), ["bag", "x_seq", "topic"], "ts_ns", ("seq",))
    data = shown.join(p.select("bag", "topic", F.col("seq").alias("asof_seq"), F.col("payload.data").alias("data")), ["bag", "topic", "asof_seq"], "left")
    return data.groupBy("bag", "x_seq", "frame_index").agg(*[F.first(F.when(F.col("topic") == t, F.col("data")), ignorenulls=True).alias(k) for k, t in CAMERAS.items()])


def rlds(frames_: DataFrame, found: DataFrame, fps: int, task: str, cameras: DataFrame | None = None, pictures_: DataFrame | None = None) -> DataFrame:
    """One row per episode: nested ``steps`` and ``episode_metadata``.

    With ``pictures_`` (see :func:`pictures`) a step's observation has the packet each camera shows; with ``cameras`` (see
    :func:`calibrations`) the metadata have every camera's calibration. Names of slots, cameras and topics are in the metadata.
    """
    f = frames_ if pictures_ is None else frames_.join(pictures_, ["bag", "x_seq", "frame_index"], "left")
    s = steps.steps(f, float(fps), F.lit(task), ("bag", "x_seq"))
    obs = F.struct("state", "chassis_state", *(CAMERAS if pictures_ is not None else []))
    s = s.withColumns({"observation": obs, "timestamp": F.col("step_time")})
    cols = ["observation", "action", "chassis_action", "timestamp", "discount", "reward", "is_first", "is_last", "is_terminal", "language_instruction"]
    n = steps.nested(s, cols, ("bag", "x_seq"))
    e = number_episodes(frames_)
    clock = F.date_format(F.timestamp_micros(F.expr("t_start div 1000")), "yyyy-MM-dd HH:mm:ss")
    j = n.join(e, ["bag", "x_seq"]).join(found.select("bag", "x_seq", "t_start"), ["bag", "x_seq"])
    texts = lambda v: F.array(*map(F.lit, v))
    meta = [
        F.col("episode_index").alias("episode_idx"), F.col("n_steps").cast("int").alias("n_steps"), F.lit(fps).alias("fps"), F.lit(task).alias("task"), F.col("bag").alias("source_bag"), clock.alias("recording_time"),
        texts(vectors.names(vectors.LAYOUT)).alias("feature_names_state_action"), texts(vectors.names(vectors.CHASSIS)).alias("feature_names_chassis"), texts(CAMERAS).alias("camera_keys"), texts(CAMERAS.values()).alias("camera_topics"),
    ]
    if cameras is not None:
        each = cameras.groupBy("bag").agg(*[F.first(F.when(F.col("camera") == k, F.struct("found", "K", "D", "P", "width", "height", "distortion_model")), ignorenulls=True).alias(f"cal_{k}") for k in CAMERAS])
        j = j.join(each, "bag", "left")
        head = F.col("cal_head_camera")
        meta += [head["height"].alias("image_height"), head["width"].alias("image_width"), F.struct(*[F.col(f"cal_{k}").alias(k) for k in CAMERAS]).alias("cameras")]
    return j.select("steps", F.struct(*meta).alias("episode_metadata"))


def camera_key(topic: Column) -> Column:
    """The camera that a topic of pictures or of calibrations belongs to; null for others."""
    return F.coalesce(*[F.when(topic == t, k) for group in (CAMERAS, CAMERA_INFO) for k, t in group.items()])


def calibrations(messages: DataFrame) -> DataFrame:
    """Calibration of every camera of every bag: the first heard, or none found."""
    heard = decode(messages.filter(F.col("topic").isin(*CAMERA_INFO.values())), "CameraInfo").filter("payload is not null")
    heard = heard.select("bag", camera_key(F.col("topic")).alias("camera"), "seq", F.col("payload.k").alias("K"), F.col("payload.d").alias("D"), F.col("payload.p").alias("P"), "payload.width", "payload.height", "payload.distortion_model")
    every = messages.select("bag").distinct().withColumn("camera", F.explode(F.array(*map(F.lit, CAMERAS))))
    return steps.with_calibration(every, steps.first_calibration(heard))


def example_order(rows: DataFrame, key: str, salt: str | None = None) -> DataFrame:
    """Examples in key order, or, with a salt, in the order of a salted hash."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(salt)), key) if salt is not None else rows.orderBy(key)
