"""Orphan references, spikes and archives: planted cases, brute force and odd inputs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpline import cli, runtime
from kelpline.operators import archive, orphans, spikes
from tests.conftest import rows

T = dt.datetime


def test_bloom_proves_and_never_loses(spark):
    parents = spark.range(0, 5000).select((F.col("id") * 7).cast("string").alias("key"))
    refs = spark.range(0, 20000).select(F.col("id").cast("string").alias("key")).unionByName(spark.createDataFrame([(None,)], "key string"))
    r = orphans.bloom_split(refs, parents, "key").join(parents.withColumn("there", F.lit(True)), "key", "left")
    assert r.filter("there and not maybe").count() == 0
    false = r.filter("there is null and maybe").count()
    assert false < 0.03 * 15000
    assert orphans.bloom_split(refs, parents.filter("false"), "key").filter("maybe").count() == 0
    parts = orphans.bloom_split(refs.withColumn("arrived", F.lit("clash")), parents, "key", max_blocks=50)  # five filters instead of one
    assert parts.count() == 20001 and set(parts.columns) == {"key", "arrived", "maybe"}
    p = parts.join(parents.withColumn("there", F.lit(True)), "key", "left")
    assert p.filter("there and not maybe").count() == 0 and p.filter("there is null and maybe").count() < 0.03 * 15000


def test_causes(spark):
    parents = spark.createDataFrame([("a", T(2024, 1, 5), False), ("b", T(2024, 1, 1), True), ("c", None, False)], "key string, arrived timestamp_ntz, gone boolean")
    refs = spark.createDataFrame([("a", T(2024, 1, 4)), ("a", T(2024, 1, 6)), ("a", None), ("b", T(2024, 2, 1)), ("c", T(2024, 1, 1)), ("x", None), (None, T(2024, 1, 1)), ("x", None)], "key string, at timestamp_ntz")
    got = sorted(orphans.orphan_causes(refs, parents, "key", "at").select("key", "cause").collect())
    assert [tuple(r) for r in got] == [("a", "late"), ("b", "deleted"), ("x", "missing"), ("x", "missing")]


def test_what_the_filter_rejects_meets_no_parent(spark, monkeypatch):
    parents = spark.range(0, 300).select(F.col("id").cast("string").alias("key"), F.lit(None).cast("timestamp_ntz").alias("arrived"), F.lit(False).alias("gone"))
    refs = spark.range(0, 600).select(F.col("id").cast("string").alias("key"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lit("clash").alias("arrived"))
    got = orphans.orphan_causes(refs, parents, "key", "at")
    assert got.count() == 300 and set(got.columns) == {"key", "at", "arrived", "cause"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.split("Join ")[1:]]
    assert joins and all("maybe" in x for x in joins)
    rejecting = lambda refs, *_: refs.withColumn("maybe", F.lit(False))
    monkeypatch.setattr(orphans, "bloom_split", rejecting)
    assert orphans.orphan_causes(refs, parents, "key", "at").count() == 600  # a filter that rejects all leaves nothing to the join
    monkeypatch.setattr(orphans, "bloom_split", lambda refs, *_: refs.withColumn("maybe", F.lit(True)))
    assert orphans.orphan_causes(refs, parents, "key", "at").count() == 300


def test_hot_keys_are_joined_alike(spark, monkeypatch):
    monkeypatch.setattr(runtime, "HOT", 5)
    left = spark.range(0, 4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), F.col("id"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k7", 3), ("other", 4)], "k string, v int")
    for how in ("inner", "left"):
        j = runtime.join_unique(left, right, "k", how)
        assert rows(j) == rows(left.join(right, "k", how))
    assert "Union" in j._jdf.queryExecution().optimizedPlan().toString()


SCHEMA = "file_id long, episode_idx long, frame_index long, task_index long, robot string, timestamp double, state array<float>, chassis_state array<float>, action array<float>, note string"


def frames(spark, cells):
    return spark.createDataFrame(cells, SCHEMA)


@pytest.fixture(scope="module")
def readings(spark):
    rng = np.random.default_rng(5)
    cells, planted = [], set()
    for e in range(240):
        n = 45
        base = np.sin(np.arange(n)[:, None] / 9 + rng.uniform(0, 6, 3)) + rng.normal(0, 0.01, (n, 3))
        x = base.round(4)
        if e % 40 == 0:
            x[20:22, 1] += 1.5
            planted |= {(e, 20, 1), (e, 21, 1)}
        if e % 40 == 1:
            x[5:20, 2] = x[5, 2]
            planted |= {(e, f, 2) for f in range(6, 20)}
        if e % 40 == 2:
            x[0, 0] = np.nan
            x[44, 1] = np.inf
            planted |= {(e, 0, 0), (e, 44, 1)}
        if e % 40 == 3:
            x[25:, 0] += 2  # a lasting move
        if e % 40 == 4:
            x[:, 1] = 0  # zero throughout
        if e % 40 == 5:
            x[10:16, 2] = 3e8
            planted |= {(e, f, 2) for f in range(10, 16)}
        for f in rng.permutation(n):
            row = (e, e, int(f), 0, "hot" if e % 3 else None, 0.0, [float(v) for v in x[f]], None, None, "x")
            cells += [row] * (2 if f % 10 == 0 else 1)
    return frames(spark, cells), planted


def test_spikes_are_found_and_nothing_else(readings):
    df, planted = readings
    got = {(r["episode_idx"], r["frame_index"], r["slot"]) for r in spikes.find_implausible(df, grippers={}).filter("field = 'state'").collect()}
    assert planted <= got
    extra = {g for g in got - planted}
    assert len(extra) <= 6, extra  # at most frames beside the lasting runs beyond reach


def test_blocks_of_long_episodes_agree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    n = 3 * spikes.BLOCK // 2
    x = (np.sin(np.arange(n) / 30) + rng.normal(0, 0.01, n)).round(4)
    at = [3, 100, spikes.BLOCK - 1, spikes.BLOCK, spikes.BLOCK + 1, n - 50]
    x[at] += 2
    x[spikes.BLOCK - 8 : spikes.BLOCK - 8 + 5] = 0.123
    df = frames(spark, [(1, 1, i, 0, "r", 0.0, [float(v)], None, None, "") for i, v in enumerate(x)])
    got = {r["frame_index"] for r in spikes.find_implausible(df).collect()}
    assert set(at) <= got and len(got) <= len(at) + 6


def test_spikes_on_odd_inputs(spark):
    none = frames(spark, [])
    assert spikes.find_implausible(none).count() == 0
    odd = frames(spark, [(1, 1, 0, 0, "r", 0.0, None, None, None, ""), (1, 1, 1, 0, "r", 0.0, [], [1.0], [float("nan"), None], ""), (1, 1, 2, 0, None, 0.0, [1.0, 2.0], [1.0, 2.0, 3.0], [1.0], ""), (None, None, 3, 0, "r", 0.0, [float("inf")], None, None, "")])
    assert rows(spikes.find_implausible(odd)) == [(1, 1, "action", 0, "bad")]


def test_cutoffs():
    x = spikes.bin_top(np.arange(40, 60))
    n = np.maximum(1e6 * 0.5 ** np.arange(20), 1)
    q99 = x[np.searchsorted(np.cumsum(n), 0.99 * n.sum())]
    assert q99 < spikes.pareto_cutoff(x, n, 1e-4) < spikes.pareto_cutoff(x, n, 1e-6) < spikes.pareto_cutoff(x, n)
    assert np.isnan(spikes.pareto_cutoff(np.array([0.0]), np.array([100.0])))
    assert spikes.pareto_cutoff(np.array([0.0, 1.0]), np.array([10_000.0, 3.0])) == 0  # at rest but for a few
    rest = np.concatenate([[0.0], x])
    assert 0 < spikes.pareto_cutoff(rest, np.concatenate([[300 * n.sum()], n])) < np.inf
    runs = np.array([1, 2, 3, 12]), np.array([9000.0, 900.0, 90.0, 50.0])
    assert spikes.run_cutoff(*runs) == np.ceil(1 + np.log(1e-7) / np.log((900 + 180 + 1) / (9000 + 1800 + 270 + 2)))
    assert spikes.run_cutoff(*runs, 1e-12) > 12 and spikes.run_cutoff(*runs, 1e-3) == 4


def test_fit_decides_and_lasting_moves_are_no_spikes(spark):
    rng = np.random.default_rng(11)
    cells, planted = [], {(300, 20, 0), (301, 1, 0)}
    for e in range(320):
        x = rng.laplace(0, 0.01, 45).round(5)
        if e == 300:
            x[20] = 0.19  # 4.2 times the 99 % quantile
        if e == 301:
            x[1] = 0.4
        if e >= 310:
            x[8:22] = x[8] - 0.3  # stuck, then a jump into a slope
            x[22:] += 0.05 * np.arange(23)
        cells += [(e, e, i, 0, f"r{e % 2}", 0.0, [float(v)], None, None, "") for i, v in enumerate(x)]
    got = {(r["episode_idx"], r["frame_index"], r["slot"]) for r in spikes.find_implausible(frames(spark, cells)).filter("reason = 'spike'").collect()}
    assert got == planted
    strict = spikes.find_implausible(frames(spark, cells), risk=1e-30).filter("reason = 'spike'").count()
    loose = spikes.find_implausible(frames(spark, cells), risk=1e-3).filter("reason = 'spike'").count()
    assert strict < len(planted) < loose  # the risk decides
    m = spikes.measure(frames(spark, cells))
    h = m.filter("n is not null and kind = 'inner' and field = 'state' and source = 'r0'").groupBy("x").agg(F.sum("n").alias("n")).orderBy("x").collect()
    law = spikes.pareto_cutoff(spikes.bin_top(np.array([int(r["x"]) for r in h])), np.array([float(r["n"]) for r in h]))
    assert spikes.cutoffs(m).filter("kind = 'inner' and field = 'state' and source = 'r0'").first()["cutoff"] == law  # and nothing overrules the fit
    x = spikes.bin_top(np.arange(1, 116))
    tail = np.exp(-np.concatenate([[0], x]) / 0.01)
    n = 1e6 * (tail[:-1] - tail[1:])
    law = spikes.pareto_cutoff(x, n)
    assert abs(law - 0.01 * np.log(1e7)) < 0.015  # what an exponential law exceeds with a chance of 1e-7
    spiky = n.copy()
    spiky[100] += 500  # one peak in a hundred
    assert abs(spikes.pareto_cutoff(x, spiky) - law) < 0.15 * law  # spikes among the peaks hardly move it


FILES = "file_id long, dataset string, path string, kind string, episode_idx long, n_bytes long, dataset_note string"


def test_archive_is_lossless_and_counts_once(spark):
    cells = [(f, e, i, 1, "r", 0.1 * i, [float(i), None], None, [1.0], "ü") for f, e, r in ((1, 0, range(5)), (2, 0, range(5, 9)), (3, 0, range(3, 6)), (4, 7, range(2)), (5, 7, range(2)), (6, 7, range(1))) for i in r]
    cells += [cells[0], (None, 3, 1, 1, "r", 0.0, None, None, None, None), (9, None, None, 1, "r", None, None, None, None, None)]
    df = frames(spark, cells)
    files = spark.createDataFrame([(i, "d" if i < 4 else None, f"./p//f{i}.hdf5", "hdf5", 0 if i < 6 else None, 50, "") for i in range(1, 8)], FILES)
    info = spark.createDataFrame([("d", 2), ("d", 2), (None, 1)], "dataset string, chunks_size long")
    store = archive.pack_rows(df, files, info, target_bytes=9000, block_bytes=64)
    back = archive.unpack_rows(store, df)
    assert sorted(map(str, rows(back))) == sorted(map(str, rows(df)))
    assert rows(archive.overlapping_files(store.index)) == [(1, 3), (2, 3), (4, 5), (4, 6), (5, 6)]
    one = archive.distinct_records(back)
    assert one.count() == len({(c[1], c[2]) for c in cells if c[1] is not None})
    assert {r["file_id"] for r in one.filter("episode_idx = 7").collect()} == {4}
    assert archive.unpack_rows(store, df, ["p/f2.hdf5"]).count() == 4 and archive.unpack_rows(store, df, ["no"]).count() == 0
    empty = archive.pack_rows(df.filter("false"), files, info)
    assert archive.overlapping_files(empty.index).count() == archive.unpack_rows(empty, df).count() == 0
    broken = archive.Store(store.path, store.index, store.blocks.withColumn("members", F.transform("members", lambda m: m.withField("crc32", m["crc32"] + 1))))
    with pytest.raises(Exception, match="checksum"):
        archive.unpack_rows(broken, df).count()


def test_containers_are_files_of_the_target_size(spark, tmp_path, monkeypatch):
    cells = [(f, f // 2, i, 1, "r", 0.0, [float(i)] * 40, None, None, "") for f in range(900) for i in range(4)]
    df = frames(spark, cells)
    files = spark.createDataFrame([(f, ("big", "mid", "tiny")[(f > 500) + (f > 895)], f"f{f}", "hdf5", f // 2 if f % 9 else None, None if f % 7 else 10**9, "") for f in range(900)], FILES)
    info = spark.createDataFrame([("big", 20), ("mid", 1), ("tiny", 1000)], "dataset string, chunks_size long")
    for rows_sent in (runtime.BROADCAST_BYTES, 0):  # with the plan broadcast, and with it shuffled
        monkeypatch.setattr(runtime, "BROADCAST_BYTES", rows_sent)
        store = archive.pack_rows(df, files, info, f"{tmp_path}/store{rows_sent}", target_bytes=256 << 10, block_bytes=32 << 10)
        held = archive.container_files(store).collect()
        assert {r["files"] for r in held} == {1} and len(held) > 6
        sizes = [r["n_bytes"] for r in held]
        assert sum(s for s in sizes if 128 << 10 <= s <= 512 << 10) > 0.95 * sum(sizes)
        assert sorted(map(str, rows(archive.unpack_rows(archive.open_store(spark, store.path), df)))) == sorted(map(str, rows(df)))
        spread = store.index.groupBy("container").agg(F.countDistinct("dataset").alias("n")).filter("n > 1").count()
        assert spread == 0
    assert sum("/containers/" in f for f in archive._wanted(store, ["f3"]).inputFiles()) == 1 and archive.unpack_rows(store, df, ["f3"]).count() == 4
    with pytest.raises(Exception):
        archive.pack_rows(df, files, info, store.path)  # never over another store
    monkeypatch.setattr(archive, "TASKS", 3)  # more containers than tasks
    few = archive.pack_rows(df, files, info, target_bytes=256 << 10, block_bytes=32 << 10)
    assert {r["files"] for r in archive.container_files(few).collect()} == {1} and few.index.select("container").distinct().count() > 6
    assert sorted(map(str, rows(archive.unpack_rows(few, df)))) == sorted(map(str, rows(df))) and archive.unpack_rows(few, df, ["f3"]).count() == 4


def test_original_bytes_come_back(spark, tmp_path):
    want = {f"{d}/e{i}.hdf5": bytes([i % 256]) * (i * 37 % 5000) for i, d in enumerate(["a", "b", "a/deep"] * 40)}
    want["top.hdf5"] = b""
    for name, data in want.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(data)
    store = archive.pack_files(spark, f"{tmp_path}/in", f"{tmp_path}/store", target_bytes=100_000, block_bytes=20_000)
    assert {r["path"]: bytes(r["content"]) for r in archive.read_files(store).collect()} == want
    assert [bytes(r["content"]) for r in archive.read_files(store, ["b/e1.hdf5"]).collect()] == [want["b/e1.hdf5"]]
    assert archive.container_files(store).count() < 12
    assert archive.extract_files(archive.open_store(spark, store.path), f"{tmp_path}/out") == len(want)
    assert all((tmp_path / "out" / n).read_bytes() == b for n, b in want.items())
    with pytest.raises(Exception):
        archive.open_store(spark, f"{tmp_path}/in").index.count()
    assert cli.pack_folder(spark, f"{tmp_path}/in", f"{tmp_path}/packed", target_bytes=10**9)["files"] == len(want)
    assert cli.unpack_store(spark, f"{tmp_path}/packed", f"{tmp_path}/some", ["b/e1.hdf5"]) == {"files": 1}


def test_long_files_come_back_from_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(archive, "MEMBER_ROWS", 8)
    long = [(1, 0, i, 1, "r", 0.0, [float(i)], None, None, "") for i in range(200)]
    flat = [(2, e, i, 1, "r", 0.0, [float(e)], None, None, "") for e in range(30) for i in range(3)]  # many rows, small frame_index
    lone = [(None, 5, i, 1, "r", 0.0, None, None, None, "") for i in range(40)]
    short = [(3, 4, i, 1, "r", 0.0, None, None, None, "") for i in range(3)]
    df = frames(spark, [*long, *flat, *lone, *short])
    files = spark.createDataFrame([(i, "d", f"f{i}", "hdf5", 0, 50, "") for i in (1, 2, 3)], FILES)
    info = spark.createDataFrame([("d", 10)], "dataset string, chunks_size long")
    store = archive.pack_rows(df, files, info, target_bytes=6000, block_bytes=512)
    assert store.blocks.groupBy("container", "block").count().filter("count > 1").count() == 0
    assert store.index.agg(F.max("n_rows")).first()[0] <= 8
    assert store.index.filter("file_id = 1").select("container").distinct().count() > 2
    assert sorted(map(str, rows(archive.unpack_rows(store, df)))) == sorted(map(str, rows(df)))


def test_archive_ignores_clashing_columns(spark):
    df = frames(spark, [(1, 0, 0, 1, "r", 0.0, None, None, None, "")]).withColumns({"dataset": F.lit("mine"), "container": F.lit(5), "path": F.lit("q"), "first": F.lit(1)})
    files = spark.createDataFrame([(1, "d", "f", "hdf5", 0, None, "")], FILES)
    back = archive.unpack_rows(archive.pack_rows(df, files, spark.createDataFrame([("d", 10)], "dataset string, chunks_size long")), df)
    assert rows(back.select("dataset", "container", "path", "first")) == [("mine", 5, "q", 1)]
