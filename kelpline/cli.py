"""Command lines over the operators: ``python -m kelpline.cli COMMAND --help``."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions.formats import duration_text, size_text
from kelpline.functions.vectors import CHASSIS, LAYOUT, WIDE, names, stats_json
from kelpline.operators import archive, convert, datasets, segment
from kelpline.runtime import materialize
from kelpline.sources import bags, folders


def _session() -> SparkSession:
    return SparkSession.builder.appName("kelpline").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _messages(spark: SparkSession, root: str, mode: str = "FAILFAST") -> DataFrame:
    bags.register(spark)
    return spark.read.format("bag").option("mode", mode).load(root)


def validate(spark: SparkSession, root: str, fps: float = 45, min_rows: int = 30) -> tuple[DataFrame, DataFrame]:
    """Per bag: size, duration, pairs and valid pairs; and the statistics of all valid durations in one row."""
    found = bags.discover(spark, root)
    m = _messages(spark, root)
    e = convert.episodes(m)
    seconds = (F.col("t_stop") - F.col("t_start")) / F.lit(1e9)
    per = segment.bag_summary(e, found.select(F.col("name").alias("bag"), "n_bytes"), seconds, fps, min_rows).join(bags.duration_s(spark, root, found, m), "bag", "left")
    topics = m.groupBy("bag").agg(F.array_sort(F.collect_set("topic")).alias("topics"))
    per = per.join(topics, "bag", "left").withColumns({"size": size_text(F.col("n_bytes")), "duration": duration_text(F.col("duration_s"))})
    return per, segment.duration_stats(e, seconds, fps, min_rows)


def report(per: DataFrame, total: DataFrame) -> list[str]:
    """The summaries of :func:`validate` as lines of text, a bag after the other."""
    line = F.format_string("%s: %s, %s, %d pairs, %d valid, %.1f s", "bag", F.coalesce("size", F.lit("-")), F.coalesce("duration", F.lit("-")), "n_pairs", "n_valid", "valid_s")
    lines = [r[0] for r in per.orderBy("bag").select(line).toLocalIterator()]
    t = total.first()
    return [*lines, f"all: {t['n_pairs']} pairs, {t['n_valid']} valid ({t['valid_percent']:.1f} %)", f"durations: mean {t['dur_mean']:.2f} s, deviation {t['dur_std']:.2f} s, from {t['dur_min']:.2f} to {t['dur_max']:.2f} s, {t['dur_total']:.1f} s in all"]


def convert_bags(spark: SparkSession, root: str, target: str, fps: int = 45, task: str = "task description", kind: str = "wide", min_rows: int = 30, start: int = 0, overwrite: bool = False, max_episodes: int | None = None) -> dict:
    """Convert the bags below ``root`` into a dataset folder (``wide`` with chassis and lift in 72 slots, or ``frames`` with 62 and 9) or nested episodes (``rlds``); returns totals."""
    folders.check_start(target, start, overwrite)
    clock = Stages()
    m = convert.with_cameras(_messages(spark, root, "FAILFAST" if kind == "wide" else "PERMISSIVE"))
    found = convert.episodes(m)
    if kind == "rlds":
        f = convert.frames(m, fps, min_rows=min_rows)
        rows = convert.rlds(f, found, fps, task, convert.calibrations(m), convert.pictures(m, found, f, fps))
        rows.write.mode("overwrite" if overwrite else "errorifexists").parquet(f"{target}/episodes")
        return {"target": f"{target}/episodes", "seconds": clock.done("episodes")}
    f = materialize(convert.frames(m, fps, min_rows=min_rows, lift=kind == "wide"), "frames")
    clock.done("frames")
    e = convert.number_episodes(f, start)
    if max_episodes is not None:
        e = e.filter(F.col("episode_index") < start + max_episodes)
    e = materialize(e, "episodes")
    f = f.join(e.select("bag", "x_seq", "episode_index"), ["bag", "x_seq"]).withColumn("task_index", F.lit(0).cast("long")).drop("bag", "x_seq", "tick")
    columns = [c for c in ("state", "action", "chassis_state", "chassis_action") if c in f.columns]
    layouts = {"state": WIDE if kind == "wide" else LAYOUT, "action": WIDE if kind == "wide" else LAYOUT, "chassis_state": CHASSIS, "chassis_action": CHASSIS}
    features = {c: {"dtype": "float32", "shape": [len(names(layouts[c]))], "names": names(layouts[c])} for c in columns}
    features |= {c: {"dtype": t, "shape": [1], "names": None} for c, t in (("timestamp", "float64"), ("frame_index", "int64"), ("episode_index", "int64"), ("task_index", "int64"))}
    info = {"chunks_size": 1000, "fps": fps, "data_path": "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet", "video_path": None, "features": features}
    folders.write_frames(f, target, info, overwrite=overwrite).write.format("noop").mode("overwrite").save()
    clock.done("files")
    packets = convert.episode_pictures(m, found).join(e.select("bag", "x_seq", "episode_index"), ["bag", "x_seq"]).drop("bag", "x_seq")
    packets.write.mode("overwrite" if overwrite else "append").partitionBy("camera").parquet(f"{target}/packets")
    clock.done("packets")
    meta = e.select("episode_index", F.array(F.lit(task)).alias("tasks"), "length")
    folders.write_lines(meta, f"{target}/meta/episodes.jsonl", "episode_index")
    folders.write_lines(spark.createDataFrame([(0, task)], folders.TASKS), f"{target}/meta/tasks.jsonl", "task_index")
    _write_stats(stats_json(f, [*columns, "timestamp", "task_index"], "episode_index"), target)
    seen = convert.calibrations(m).join(e.select("bag", "episode_index"), "bag").drop("bag")
    folders.write_lines(seen, f"{target}/meta/cameras.jsonl", "episode_index")
    t = datasets.totals(meta, 1, 1000, 0).first().asDict()
    folders.write_info(target, info | t | {"splits": {"train": f"0:{t['total_episodes']}"}})
    return t | {"seconds": clock.done("meta")}


class Stages:
    """Wall seconds by stage."""

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}
        self.at = time.perf_counter()

    def done(self, stage: str) -> dict[str, float]:
        """Count the time since the last stage to ``stage``; returns all so far."""
        now = time.perf_counter()
        self.seconds[stage] = round(self.seconds.get(stage, 0.0) + now - self.at, 3)
        self.at = now
        return self.seconds


def _write_stats(stats: DataFrame, target: str) -> None:
    lines = stats.orderBy("episode_index").select(F.concat(F.lit('{"episode_index": '), F.col("episode_index").cast("string"), F.lit(', "stats": '), F.coalesce("stats", F.lit("null")), F.lit("}")).alias("line"))
    folders.write_texts(lines, f"{target}/meta/episodes_stats.jsonl")


def _load(spark: SparkSession, root: str) -> datasets.Dataset:
    meta = f"{root}/meta"
    stats = folders.read_lines(spark, f"{meta}/episodes_stats.jsonl", "episode_index long, stats string", strict=False)
    return datasets.Dataset(folders.read_lines(spark, f"{meta}/episodes.jsonl", folders.EPISODES), folders.read_frames(spark, root), folders.read_lines(spark, f"{meta}/tasks.jsonl", folders.TASKS), stats)


#: What a store writes anew; the rest of a folder is copied as it is.
WRITTEN = r"data/.*\.parquet$|meta/(episodes|episodes_stats|tasks)\.jsonl$|meta/info\.json$"


def _store(d: datasets.Dataset, source: str, target: str, label: str = "train", declared_videos: int | None = None) -> dict:
    """Write a dataset; renumbered episodes take their videos along, else everything else of the source is copied."""
    info = folders.read_info(source)
    folders.write_frames(d.frames, target, info).write.format("noop").mode("overwrite").save()
    renumbered = "old_index" in d.episodes.columns
    plan = folders.copy_plan(d.episodes, info, source, target) if renumbered else folders.tree_plan(d.episodes.sparkSession, source, target, WRITTEN)
    if declared_videos is None:
        folders.run_copies(plan).write.format("noop").mode("overwrite").save()
    folders.write_lines(d.episodes.select("episode_index", "tasks", "length"), f"{target}/meta/episodes.jsonl", "episode_index")
    folders.write_lines(d.tasks, f"{target}/meta/tasks.jsonl", "task_index")
    if d.stats is not None:
        _write_stats(d.stats, target)
    t = datasets.totals(d.episodes, d.tasks.count(), info["chunks_size"], len(folders.video_keys(info))).first().asDict()
    if declared_videos is not None:
        t["total_videos"] = declared_videos
    folders.write_info(target, info | t | {"splits": {label: f"0:{t['total_episodes']}"}})
    return t


def delete_episodes(spark: SparkSession, root: str, target: str, ids: list[int]) -> dict:
    """A copy of the dataset without some episodes. It is written anew, so a run that breaks off spoils nothing."""
    return _store(datasets.delete(_load(spark, root), spark.createDataFrame([(i,) for i in ids], "episode_index long")), root, target)


def split_dataset(spark: SparkSession, root: str, n_train: int) -> list[dict]:
    """``<root>_train`` with the first episodes and ``<root>_test`` with the rest, if there are more."""
    train, test = datasets.split(_load(spark, root), n_train)
    out = [_store(train, root, f"{root}_train", "train")]
    if test.episodes.limit(1).count():
        out.append(_store(test, root, f"{root}_test", "test"))
    return out


def unify_tasks(spark: SparkSession, root: str, target: str, task: str) -> dict:
    return _store(datasets.unify(_load(spark, root), task), root, target)


def merge_folders(spark: SparkSession, roots: list[str], target: str) -> dict:
    """One dataset of several, taken in the order of their paths; folders without info or episodes are skipped.

    The number of videos is the sum of what the sources declare, as sources may differ in their cameras.
    """
    good = sorted(r for r in roots if folders.exists(f"{r}/meta/info.json") and folders.exists(f"{r}/meta/episodes.jsonl"))
    if not good:
        raise ValueError("none of the folders is a dataset")
    parts = [_load(spark, r) for r in good]
    tag = lambda df, r: df.withColumn("source", F.lit(r))
    union = lambda pick: _union([tag(pick(p), r) for p, r in zip(parts, good)])
    d = datasets.Dataset(union(lambda p: p.episodes), union(lambda p: p.frames), union(lambda p: p.tasks), union(lambda p: p.stats))
    merged = datasets.merge(d, "source", "episode_index")
    for r in good:
        part = merged.episodes.filter(F.col("source") == r)
        folders.run_copies(folders.copy_plan(part, folders.read_info(r), r, target)).write.format("noop").mode("overwrite").save()
    flat = datasets.Dataset(merged.episodes.drop("old_index"), merged.frames.drop("source"), merged.tasks, merged.stats)
    return _store(flat, good[0], target, declared_videos=sum(folders.read_info(r).get("total_videos") or 0 for r in good))


def pack_folder(spark: SparkSession, root: str, store: str, pattern: str = "*", target_bytes: int = archive.TARGET) -> dict:
    """Pack the small files below ``root`` into containers below ``store``."""
    made = archive.container_files(archive.pack_files(spark, root, store, pattern, target_bytes))
    return made.agg(F.count(F.lit(1)).alias("containers"), F.sum("n_members").alias("files"), F.sum("n_bytes").alias("n_bytes")).first().asDict()


def unpack_store(spark: SparkSession, store: str, target: str, paths: list[str]) -> dict:
    """Write the files of a store, or those named, below ``target``."""
    return {"files": archive.extract_files(archive.open_store(spark, store), target, paths or None)}


def _union(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for x in dfs[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="kelpline", description="Episode datasets from logs, and their management")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str, **options) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for x in positional:
            c.add_argument(x)
        for k, v in options.items():
            c.add_argument(f"--{k}", **({"action": "store_true"} if v is False else {"type": type(v), "default": v} if v is not None else {"type": int, "default": None}))
        return c

    command("validate", "root", fps=45.0, min_rows=30, text=False)
    command("convert", "root", "target", fps=45, task="task description", kind="wide", min_rows=30, start=0, overwrite=False, max_episodes=None)
    command("delete", "root", "target").add_argument("ids", type=int, nargs="+")
    command("split", "root").add_argument("n_train", type=int)
    command("unify", "root", "target", "task")
    command("merge", "target").add_argument("roots", nargs="+")
    command("pack", "root", "store", pattern="*", target_bytes=archive.TARGET)
    command("unpack", "store", "target").add_argument("paths", nargs="*")
    a = vars(p.parse_args(args))
    spark, name = _session(), a.pop("command")
    if name == "validate":
        text = a.pop("text")
        per, total = validate(spark, **a)
        if text:
            print("\n".join(report(per, total)))
        else:
            for r in per.orderBy("bag").toLocalIterator():
                print(json.dumps(r.asDict(), default=str))
            print(json.dumps(total.first().asDict()))
    else:
        run = {"convert": convert_bags, "delete": delete_episodes, "split": split_dataset, "unify": unify_tasks, "merge": merge_folders, "pack": pack_folder, "unpack": unpack_store}[name]
        print(json.dumps(run(spark, **a)))


if __name__ == "__main__":
    main()
