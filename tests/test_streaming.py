"""Live segmentation over several micro-batches equals that of the whole log."""

import random

import pandas as pd
from pyspark.sql import functions as F

from kelpline.operators import sample, segment, video
from kelpline.streaming import live
from kelpline.streaming.live import live_episodes, live_grid, live_latest, live_packets
from tests.conftest import rows


def test_live_equals_batch(spark, tmp_path):
    rnd = random.Random(9)
    log = [(b, i, i * 100 + rnd.randint(0, 9), rnd.choice([[0, 0, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1], [0, 0, 1, 1], [1], None])) for b in "pq" for i in range(120)]
    schema = "bag string, seq long, t long, buttons array<int>"
    df = spark.createDataFrame(log, schema)
    for k in range(3):
        df.filter(F.floor(F.col("seq") / 40) == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = live_episodes(stream).writeStream.format("memory").queryName("live").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    want = segment.episodes(segment.button_edges(df))
    got = spark.sql("select * from live")
    assert rows(got.select("bag", "x_seq", "y_seq", "t_start", "t_stop")) == rows(want.select("bag", "x_seq", "y_seq", "t_start", "t_stop"))
    assert want.count() > 10


def test_live_grid_equals_batch(spark, tmp_path):
    rnd = random.Random(11)
    log = []
    for b in "pq":
        t = 0
        for i in range(300):
            t += rnd.choice([0, 5, 10, 20])
            log.append((b, i, t, rnd.choice([[0, 0, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]) if rnd.random() < 0.2 else None))
    schema = "bag string, seq long, t long, buttons array<int>"
    df = spark.createDataFrame(log, schema)
    for k in range(3):
        df.filter(F.floor(F.col("seq") / 100) == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = live_grid(stream, 20, 10, 1).writeStream.format("memory").queryName("grid").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    found = segment.episodes(segment.button_edges(df))
    want = sample.grid_rows(segment.in_episodes(df, found), 20, 10, []).select("bag", "x_seq", "tick", "state_seq", "action_seq")
    assert rows(spark.sql("select * from grid")) == rows(want)
    assert want.count() > 20


def test_live_packets_and_latest_equal_batch(spark, tmp_path):
    rnd = random.Random(12)
    log = []
    for b in "pq":
        for i in range(900):
            buttons = rnd.choice([[0, 0, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]) if rnd.random() < 0.05 else None
            topic = "joy" if buttons else rnd.choice(["left", "right", "other"])
            log.append((b, i, i, topic, buttons, rnd.random() < 0.02 if topic in ("left", "right") else None))
    schema = "bag string, seq long, t long, topic string, buttons array<int>, keyframe boolean"
    df = spark.createDataFrame(log, schema)
    for k in range(3):
        df.filter(F.floor(F.col("seq") / 300) == k).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    df.filter("seq = 20 and bag = 'p'").coalesce(1).write.parquet(str(tmp_path / "in" / "9"))  # sent again, late
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = live_packets(stream()).writeStream.format("memory").queryName("packets").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    found = segment.episodes(segment.button_edges(df))
    want = video.episode_packets(df.filter("keyframe is not null").select("bag", "topic", "seq", "keyframe"), found)
    assert rows(spark.sql("select bag, x_seq, topic, seq from packets")) == rows(want.select("bag", "x_seq", "topic", "seq"))
    assert want.count() > 100
    q = live_latest(stream(), "t").writeStream.format("memory").queryName("latest").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck2")).start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.sql("select bag, topic, seq from latest")) == rows(df.groupBy("bag", "topic").agg(F.max("seq").alias("seq")))


def test_idle_logs_are_dropped():
    class State:
        hasTimedOut, exists, gone, wait = True, True, False, None
        get = (3, 0, 0, 2, 0, 0)

        def remove(self):
            self.gone = True

        def update(self, v):
            self.get = v

        def setTimeoutDuration(self, ms):
            self.wait = ms

    step, kind = live._with_idle(live._cut, 1.5, live._names(live.FOUND))
    s = State()
    assert [len(x) for x in step(("p",), iter([]), s)] == [0] and s.gone and kind == "ProcessingTimeTimeout"
    s = State()
    s.hasTimedOut = False
    out = list(step(("p",), iter([pd.DataFrame({"bag": ["p"], "seq": [7], "t": [7], "buttons": [[0, 0, 0, 1]]})]), s))
    assert out[0]["y_seq"].tolist() == [7] and s.wait == 1500 and not s.gone
    late = pd.DataFrame({"bag": "p", "seq": [6, 9, 8, 8], "t": [6, 9, 8, 8], "buttons": [[0, 0, 0, 0], [0, 0, 0, 1], [0, 0, 1, 0], [0, 0, 1, 0]]})
    out = list(step(("p",), iter([late]), s))
    assert out[0][["x_seq", "y_seq", "n_late"]].values.tolist() == [[8, 9, 2]]  # one behind the last, one sent twice
