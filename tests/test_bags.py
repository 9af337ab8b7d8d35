"""Bags written here, found, replayed, decoded and converted; datasets managed on disk."""

import json
import os
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from kelpline import cli
from kelpline.operators import convert
from kelpline.sources import bags, folders
from tests.conftest import rows


class W:
    """Writes little-endian CDR."""

    def __init__(self):
        self.b = bytearray(b"\0\1\0\0")

    def put(self, code, *v):
        if v:
            while (len(self.b) - 4) % struct.calcsize(code):
                self.b += b"\0"
            self.b += struct.pack(f"<{len(v)}{code}", *v)
        return self

    def seq(self, code, v):
        return self.put("I", len(v)).put(code, *v)

    def text(self, s):
        self.put("I", len(s.encode()) + 1)
        self.b += s.encode() + b"\0"
        return self

    def head(self):
        return self.put("I", 1, 2).text("frame")


def joy(buttons):
    return bytes(W().head().seq("f", [0.5]).seq("i", buttons).b)


def joint(p, v, e):
    w = W().head().put("I", 1).text("j1")
    return bytes(w.seq("d", p).seq("d", v).seq("d", e).b)


def pose(*v):
    return bytes(W().put("d", *v).b)


def packet(data, pts):
    w = W().head().put("i", 2, 3).text("hevc").put("Q", pts).put("B", 0, 0).put("I", len(data))
    return bytes(w.b) + data


def camera():
    return bytes(W().head().put("I", 10, 20).text("plumb").seq("d", [0.1]).put("d", *range(9)).put("d", *range(9)).put("d", *range(12)).b)


TYPES = {convert.MARKERS: "sensor_msgs/msg/Joy", **{t: "ffmpeg_image_transport_msgs/msg/FFMPEGPacket" for t in convert.CAMERAS.values()}, **{t: "sensor_msgs/msg/CameraInfo" for t in convert.CAMERA_INFO.values()}}
for group in (convert.STATE, convert.ACTION):
    for part, topic in group.items():
        TYPES[topic] = {"JointState": "sensor_msgs/msg/JointState", "Pose": "geometry_msgs/msg/Pose", "Float64": "std_msgs/msg/Float64"}[convert.KINDS[part]]


def write_bag(folder, parts, yaml="rosbag2_bagfile_information:\n  duration:\n    nanoseconds: 5000000000\n"):
    os.makedirs(folder)
    (folder / "metadata.yaml").write_text(yaml)
    for k, messages in enumerate(parts):
        with sqlite3.connect(folder / f"x_{k}.db3") as db:
            db.execute("create table topics(id integer primary key, name text, type text, serialization_format text)")
            db.execute("create table messages(id integer primary key, topic_id integer, timestamp integer, data blob)")
            ids = {t: i for i, t in enumerate(sorted({m[0] for m in messages}))}
            db.executemany("insert into topics values (?, ?, ?, 'cdr')", [(i, t, TYPES[t]) for t, i in ids.items()])
            db.executemany("insert into messages(topic_id, timestamp, data) values (?, ?, ?)", [(ids[t], when, data) for t, when, data in messages])


BASE = 1_700_000_000_000_000_000


def log(n=60, step=20_000_000, cameras=True):
    """A start, ``n`` joint messages every 20 ms, a stop."""
    out = [(convert.MARKERS, BASE, joy([0, 0, 0, 0])), (convert.MARKERS, BASE + 1_000_000, joy([0, 0, 1, 0]))]
    for i in range(n):
        t = BASE + 2_000_000 + i * step
        out.append((convert.STATE["left_arm"], t, joint([i + j / 10 for j in range(8)], [i], [])))
        out.append((convert.ACTION["left_gripper"], t + 3_000_000, joint([i * 2.0], [], [7.0])))
        out.append((convert.STATE["chassis"], t + 4_000_000, joint([1, 2, 3], [4, 5, 6], [7, 8, 9])))
        if cameras:
            for c in convert.CAMERAS.values():
                out.append((c, t + 5_000_000, packet(b"\0\0\1\x26ab" if i % 10 == 0 else b"\0\0\1\x02ab", i)))
    out.append((convert.STATE["left_pose"], BASE + 3_000_000, pose(1, 2, 3, 4, 5, 6, 7)))
    out.append((convert.CAMERA_INFO["left_color"], BASE, camera()))
    end = BASE + 2_000_000 + n * step
    return sorted(out, key=lambda m: m[1]) + [(convert.MARKERS, end, joy([0, 0, 0, 0])), (convert.MARKERS, end + 1, joy([0, 0, 0, 1]))]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    r = tmp_path_factory.mktemp("bags")
    one = log()
    write_bag(r / "a" / "bag1", [one[:50], one[50:]])
    write_bag(r / "bag2", [log(40)])
    write_bag(r / "bag1x" / "inner", [log(5)])
    (r / "bag2" / "deeper").mkdir()
    (r / "bag2" / "deeper" / "y.db3").write_bytes(b"1234")
    (r / "bag2" / "deeper" / "y.yml").write_text("")
    (r / "no").mkdir()
    (r / "no" / "z.db3").write_bytes(b"")
    return r


def test_discovery(spark, root):
    got = bags.discover(spark, str(root)).collect()
    assert [(r["name"], os.path.relpath(r["bag_file"], root), r["storage"]) for r in got] == [("bag1", "a/bag1/x_0.db3", "sqlite3"), ("inner", "bag1x/inner/x_0.db3", "sqlite3"), ("bag2", "bag2/x_0.db3", "sqlite3")]
    want = sum(f.stat().st_size for f in (root / "bag2").rglob("*") if f.is_file())
    assert got[2]["n_bytes"] == want
    assert bags.discover(spark, str(root), per_file=True).count() == 4


def test_replay_decode_and_topics(spark, root):
    bags.register(spark)
    m = spark.read.format("bag").load(str(root))
    assert m.filter("bag = 'bag1'").count() == len(log())
    assert [r["seq"] for r in m.filter("bag = 'bag1'").orderBy("seq").collect()] == list(range(1, len(log()) + 1))
    few = spark.read.format("bag").option("topics", convert.MARKERS).load(str(root))
    assert rows(few.select("topic").distinct()) == [(convert.MARKERS,)]
    c = rows(convert.calibrations(m).filter("bag = 'bag2'").select("camera", "found", "width", "height", F.size("P")))
    assert c == [("head_camera", False, 0, 0, 12), ("left_color", True, 20, 10, 12), ("right_color", False, 0, 0, 12)]
    bad = m.filter(F.col("topic") == convert.MARKERS).withColumn("data", F.lit(b"\0\1\0\0\1"))
    assert bags.decode(bad, "Joy").filter("payload is not null").count() == 0
    p = bags.decode(m.filter(F.col("topic") == convert.CAMERAS["head_camera"]), "FFMPEGPacket").select("payload.*").first()
    assert (p["width"], p["height"], p["encoding"], p["pts"], bytes(p["data"])) == (2, 3, "hevc", 0, b"\0\0\1\x26ab")


def test_mcap(spark, tmp_path):
    def rec(op, body):
        return struct.pack("<BQ", op, len(body)) + body

    def text(s):
        return struct.pack("<I", len(s)) + s.encode()

    import zstandard

    schema = rec(3, struct.pack("<H", 1) + text("sensor_msgs/msg/Joy") + text("ros2msg") + struct.pack("<I", 0))
    channel = rec(4, struct.pack("<HH", 5, 1) + text(convert.MARKERS) + text("cdr") + struct.pack("<I", 0))
    messages = b"".join(rec(5, struct.pack("<HIQQ", 5, i, 100 + i, 100 + i) + joy([i, 0, 0, 0])) for i in range(3))
    inner = schema + channel + messages
    z = zstandard.ZstdCompressor().compress(inner)
    chunk = rec(6, struct.pack("<QQQI", 100, 102, len(inner), 0) + text("zstd") + struct.pack("<Q", len(z)) + z)
    d = tmp_path / "m" / "bag"
    d.mkdir(parents=True)
    (d / "a.mcap").write_bytes(b"\x89MCAP0\r\n" + rec(1, text("") + text("")) + chunk + rec(15, struct.pack("<I", 0)) + b"\x89MCAP0\r\n")
    (d / "metadata.yaml").write_text("")
    bags.register(spark)
    m = spark.read.format("bag").load(str(tmp_path))
    got = bags.decode(m, "Joy").select("ts_ns", "payload.buttons")
    assert rows(got) == [(100, [0, 0, 0, 0]), (101, [1, 0, 0, 0]), (102, [2, 0, 0, 0])]


def test_permissive_keeps_what_was_read(spark, tmp_path):
    write_bag(tmp_path / "b", [log(3)])
    (tmp_path / "b" / "x_1.db3").write_bytes(b"no database at all" * 100)
    bags.register(spark)
    assert spark.read.format("bag").option("mode", "PERMISSIVE").load(str(tmp_path)).count() == len(log(3))
    with pytest.raises(Exception):
        spark.read.format("bag").load(str(tmp_path)).count()


def model(n, fps=45):
    """Frames of :func:`log`, by the sequential rules, in exact integers."""
    unit, start = 90 * fps, BASE + 1_000_000
    period, offset = 90 * 10**9, fps * 10**9
    s, adding, out, cache, state = period, False, [], {}, None
    for topic, when, _ in log(n):
        if when < start or when > BASE + 2_000_000 + n * 20_000_000:
            continue
        t = (when - start) * unit
        k = (when - BASE - 2_000_000) // 20_000_000
        if topic == convert.STATE["left_arm"]:
            cache["arm"] = k
        if topic == convert.ACTION["left_gripper"]:
            cache["grip"] = k
        if t >= s:
            a = s + offset
            if t <= a and not adding:
                adding, state = True, dict(cache)
            elif t > a:
                if adding:
                    out.append((state.get("arm"), cache.get("grip")))
                s += ((t - a) // period + 1) * period
                adding = False
    return out


def test_conversion_matches_sequential_rules(spark, root):
    bags.register(spark)
    m = spark.read.format("bag").load(str(root))
    f = convert.frames(convert.with_cameras(m), min_rows=5)
    got = f.filter("bag = 'bag1'").orderBy("frame_index").collect()
    want = model(60)
    assert len(got) == len(want) > 30
    for r, (arm, grip) in zip(got, want):
        assert r["state"][:7] == pytest.approx([arm + j / 10 for j in range(7)])
        assert r["state"][16] == arm and r["state"][17] == 0 and len(r["state"]) == 62
        assert r["action"][7] == grip * 2 and r["action"][39] == 7
        assert r["chassis_state"] == [1, 2, 3, 4, 5, 6, 7, 8, 9] and r["chassis_action"] == [0] * 9
        assert r["state"][48:55] == [1, 2, 3, 4, 5, 6, 7]
    assert [r["timestamp"] for r in got[:3]] == pytest.approx([0, 1 / 45, 2 / 45])
    wide = convert.frames(m, min_rows=5, lift=True).filter("bag = 'bag1'").orderBy("frame_index").first()
    assert len(wide["state"]) == 72 and wide["state"][62:71] == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    n = convert.rlds(f, convert.episodes(m), 45, "t").orderBy("episode_metadata.source_bag").first()
    assert n["episode_metadata"]["recording_time"] == "2023-11-14 22:13:20" and n["episode_metadata"]["n_steps"] == len(want)
    meta = n["episode_metadata"]
    assert len(meta["feature_names_state_action"]) == 62 and meta["camera_keys"] == list(convert.CAMERAS)
    found = convert.episodes(m)
    full = convert.rlds(f, found, 45, "t", convert.calibrations(m), convert.pictures(m, found, f, 45)).orderBy("episode_metadata.source_bag").first()
    assert full["episode_metadata"]["cameras"]["left_color"]["found"] in (True, False) and "head_camera" in full["steps"][0]["observation"]
    assert any(x["observation"]["left_color"] for x in full["steps"])
    assert n["steps"][0]["is_first"] and n["steps"][-1]["reward"] == 1.0 and not n["steps"][-2]["is_last"]


def test_validation(spark, root):
    per, total = cli.validate(spark, str(root), min_rows=30)
    got = {r["bag"]: (r["n_pairs"], r["n_valid"], r["duration_s"], len(r["topics"])) for r in per.collect()}
    assert got["bag1"][:3] == (1, 1, 5.0) and got["inner"][:2] == (1, 0)
    assert total.first()["n_pairs"] == 3 and total.first()["n_valid"] == 2
    text = cli.report(per, total)
    assert text[0].startswith("bag1: ") and "1 pairs, 1 valid" in text[0] and text[-2].startswith("all: 3 pairs, 2 valid")


@pytest.fixture(scope="module")
def dataset(spark, root, tmp_path_factory):
    t = tmp_path_factory.mktemp("out") / "set"
    cli.convert_bags(spark, str(root), str(t), min_rows=5)
    return t


def counts(folder):
    return [json.loads(x) for x in (folder / "meta" / "episodes.jsonl").read_text().splitlines()]


def test_dataset_folder(spark, dataset):
    e = counts(dataset)
    assert [x["episode_index"] for x in e] == list(range(len(e)))
    f = folders.read_frames(spark, str(dataset))
    assert f.count() == sum(x["length"] for x in e)
    assert (dataset / "data/chunk-000/episode_000000.parquet").exists()
    with pytest.raises(FileExistsError):
        folders.check_start(str(dataset), 0)
    assert folders.next_index(str(dataset)) == len(e)
    info = json.loads((dataset / "meta/info.json").read_text())
    assert info["features"]["state"]["shape"] == [72] and info["features"]["state"]["names"][62] == "chassis_0" and info["features"]["timestamp"]["shape"] == [1]
    stats = [json.loads(x) for x in (dataset / "meta/episodes_stats.jsonl").read_text().splitlines()]
    assert [x["episode_index"] for x in stats] == list(range(len(e)))
    first = f.filter("episode_index = 0").select(F.min(F.col("state")[0]).cast("double"), F.count("*")).first()
    assert stats[0]["stats"]["state"]["min"][0] == pytest.approx(first[0]) and stats[0]["stats"]["state"]["count"] == [first[1]] == [e[0]["length"]]
    cameras = [json.loads(x) for x in (dataset / "meta/cameras.jsonl").read_text().splitlines()]
    assert len(cameras) == 3 * len(e)
    packets = spark.read.parquet(str(dataset / "packets"))
    assert packets.filter("episode_index is null or data is null").count() == 0 and packets.count() > 0


def test_delete_split_unify_merge(spark, dataset, tmp_path):
    n = counts(dataset)
    d = cli.delete_episodes(spark, str(dataset), str(tmp_path / "del"), [0])
    assert d["total_episodes"] == len(n) - 1 and [x["length"] for x in counts(tmp_path / "del")] == [x["length"] for x in n[1:]]
    with pytest.raises(ValueError, match="99"):
        cli.delete_episodes(spark, str(dataset), str(tmp_path / "bad"), [99])
    s = cli.split_dataset(spark, str(dataset), 1)
    assert [x["total_episodes"] for x in s] == [1, len(n) - 1]
    m = cli.merge_folders(spark, [f"{dataset}_train", f"{dataset}_test", str(tmp_path)], str(tmp_path / "all"))
    assert m["total_episodes"] == len(n) and m["total_frames"] == sum(x["length"] for x in n) and m["total_tasks"] == 1
    assert sorted(x["length"] for x in counts(tmp_path / "all")) == sorted(x["length"] for x in n)
    (dataset / "videos/chunk-000/cam").mkdir(parents=True)
    (dataset / "videos/chunk-000/cam/episode_000001.mp4").write_bytes(b"film")
    (dataset / "notes.txt").write_text("kept")
    info = json.loads((dataset / "meta/info.json").read_text())
    info["features"]["cam"] = {"dtype": "video", "shape": [1], "names": None}
    (dataset / "meta/info.json").write_text(json.dumps(info | {"video_path": "films/{video_key}/{episode_index:06d}.mp4", "total_videos": 7}))
    cli.delete_episodes(spark, str(dataset), str(tmp_path / "del2"), [0])
    assert (tmp_path / "del2/films/cam/000000.mp4").read_bytes() == b"film"  # found below videos, stored by the template
    w = cli.merge_folders(spark, [str(dataset), str(tmp_path / "del2")], str(tmp_path / "two"))
    assert w["total_videos"] == 7 + len(n) - 1 and len(list((tmp_path / "two/films/cam").iterdir())) == 2
    u = cli.unify_tasks(spark, str(dataset), str(tmp_path / "uni"), "pick")
    assert (tmp_path / "uni/videos/chunk-000/cam/episode_000001.mp4").read_bytes() == b"film" and (tmp_path / "uni/notes.txt").read_text() == "kept"
    plan = folders.tree_plan(spark, str(tmp_path / "uni/videos"), str(tmp_path / "moved"))
    assert folders.run_copies(plan, move=True).filter("copied").count() == 1 and folders.files_below(str(tmp_path / "uni/videos")) == []
    assert u["total_tasks"] == 1 and counts(tmp_path / "uni")[0]["tasks"] == ["pick"]


def test_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"task_index": 0, "task": "ä"}\n\n{"task_index": 1, "task": null},\n{"task_index": \n')
    assert rows(folders.read_lines(spark, str(p), folders.TASKS, strict=False)) == [(0, "ä"), (1, None)]
    with pytest.raises(Exception):
        folders.read_lines(spark, str(p), folders.TASKS).collect()
    p.write_text('[{"task_index": 0, "task": "a"}, {"task_index": 1, "task": "b"}]')
    assert rows(folders.read_lines(spark, str(p), folders.TASKS, strict=False)) == [(0, "a"), (1, "b")]
    assert folders.read_lines(spark, str(tmp_path / "none"), folders.TASKS).count() == 0
    out = tmp_path / "y.jsonl"
    folders.write_lines(spark.createDataFrame([(1, "b"), (0, "ä")], folders.TASKS), str(out), "task_index", ascii_only=True)
    assert out.read_text() == '{"task_index": 0, "task": "\\u00e4"}\n{"task_index": 1, "task": "b"}\n'
    (tmp_path / "episode_000001.hdf5.tmp").write_text("")
    assert folders.clear_unfinished(str(tmp_path)) == 1


def test_shards(spark, tmp_path):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    folders.write_shards(df, str(tmp_path / "s"), "k", 7, "salt")
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert sum(sizes) == 100 and max(sizes) <= 7


def test_keyframes():
    import random

    import pyarrow as pa

    from kelpline.operators.video import first_picture_type, first_picture_types

    assert first_picture_type(b"\0\0\1\x26x") == 19 and first_picture_type(b"\0\0\0\1\x40\0\0\1\x02") == 1
    assert first_picture_type(None) is None and first_picture_type(b"") is None and first_picture_type(b"\0\0\1") is None and first_picture_type(b"\0\0\1\x40") is None
    rnd = random.Random(3)
    data = [None if rnd.random() < 0.1 else bytes(rnd.choice([0, 0, 0, 1, 1, 0x26, 0x28, 0x42, 0x02]) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    for batch in (pa.array(data, pa.binary()), pa.array(data, pa.binary()).slice(100, 2000), pa.array([], pa.binary()), pa.array([None, b""], pa.binary())):
        assert [None if k < 0 else k for k in first_picture_types(batch)] == [first_picture_type(x) for x in batch.to_pylist()]
