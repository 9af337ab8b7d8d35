"""Dataset folders: metadata as JSON lines, frames as one Parquet file per episode, one ``info.json``."""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.operators import locate


def _at(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a local path or of a URI that pyarrow knows; used on the driver and on executors alike."""
    return fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    system, p = _at(path)
    return system.get_file_info(p).type != fs.FileType.NotFound


def files_below(root: str) -> list[str]:
    """Paths of all files below a folder, from it on, sorted; none if it does not exist."""
    system, p = _at(root)
    found = system.get_file_info(fs.FileSelector(p, recursive=True, allow_not_found=True))
    return sorted(f.path[len(p.rstrip("/")) + 1 :] for f in found if f.type == fs.FileType.File)


def _put(path: str, write) -> None:
    """Let ``write`` fill a file beside ``path`` and move it there, so that a file is whole or not there."""
    system, p = _at(path)
    system.create_dir(p.rsplit("/", 1)[0], recursive=True)
    tmp = f"{p}.{uuid.uuid4().hex[:8]}.tmp"
    with system.open_output_stream(tmp) as out:
        write(out)
    system.move(tmp, p)


def read_text(path: str) -> str:
    system, p = _at(path)
    with system.open_input_stream(p) as f:
        return f.read().decode("utf-8")


EPISODES = "episode_index long, tasks array<string>, length long"
TASKS = "task_index long, task string"


def read_lines(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped, a missing file gives no rows.

    ``strict`` fails on a broken line; else broken lines are dropped, and the file may also be a JSON array or objects
    joined by commas.
    """
    if not exists(path):
        return spark.createDataFrame([], schema)
    if strict:
        return _strict(spark, path, schema)
    head = spark.read.text(path, wholetext=True).select(F.ltrim("value").startswith("[").alias("array")).first()
    if head and head["array"]:
        return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)
    lines = spark.read.text(path).select(F.regexp_replace("value", r",\s*$", "").alias("value")).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r"), "value").filter(F.try_parse_json("value").isNotNull()).select("r.*")


def _strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def write_lines(df: DataFrame, path: str, order: str, ascii_only: bool = False) -> None:
    """One JSON object per line in ``order``, in one file; rows stream to the driver partition by partition.

    With ``ascii_only`` other characters are escaped. The file is written beside its place and then moved there.
    """
    rows = df.orderBy(order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j"))
    write_texts(rows.select(F.col("j")), path, (lambda j: json.dumps(json.loads(j))) if ascii_only else None)


def write_texts(rows: DataFrame, path: str, change=None) -> None:
    """One line per row of a single text column, in the rows' order."""

    def write(out) -> None:
        for r in rows.toLocalIterator():
            out.write(((change(r[0]) if change else r[0]) + "\n").encode("utf-8"))

    _put(path, write)


def read_info(root: str) -> dict:
    return json.loads(read_text(f"{root}/meta/info.json"))


def write_info(root: str, info: dict, ascii_only: bool = False) -> None:
    _put(f"{root}/meta/info.json", lambda out: out.write(json.dumps(info, indent=4, ensure_ascii=ascii_only).encode("utf-8")))


def video_keys(info: dict) -> list[str]:
    return [k for k, v in info.get("features", {}).items() if v.get("dtype") == "video"]


def episode_path(info: dict, index: int, key: str | None = None) -> str:
    chunk = index // info["chunks_size"]
    if key is None:
        return info["data_path"].format(episode_chunk=chunk, episode_index=index)
    return info["video_path"].format(episode_chunk=chunk, episode_index=index, video_key=key)


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    """All frames of a dataset, with ``source_file``."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{root}/data").withColumn("source_file", F.col("_metadata.file_path"))


def write_frames(frames: DataFrame, root: str, info: dict, order: str = "frame_index", overwrite: bool = False, episode: str = "episode_index") -> DataFrame:
    """Write one Parquet file per episode under the name that ``data_path`` gives; returns ``episode, path, n_rows``.

    Each is written beside its place and moved, so a repeated task leaves whole files. Files that exist are an error
    unless ``overwrite``. The result must be read for anything to be written.
    """
    keep = [c for c in frames.columns if c != "source_file"]

    def write(key, table):  # without type hints, which Spark would read
        index = key[0].as_py()
        path = f"{root}/{episode_path(info, index)}"
        if exists(path) and not overwrite:
            raise FileExistsError(path)
        _put(path, lambda out: pq.write_table(table.sort_by(order), out))
        return pa.table({"episode": pa.array([index], pa.int64()), "path": [path], "n_rows": pa.array([table.num_rows], pa.int64())})

    return frames.select(*keep).groupBy(episode).applyInArrow(write, "episode long, path string, n_rows long")


def write_shards(rows: DataFrame, path: str, key: str, per_shard: int, salt: str | None = None) -> None:
    """Parquet shards of at most ``per_shard`` rows in the order of ``key``, or of a salted hash of it; ranges are written in parallel."""
    order = F.col(key) if salt is None else F.xxhash64(F.col(key), F.lit(salt))
    rows.repartitionByRange(order, F.col(key)).sortWithinPartitions(order, key).write.option("maxRecordsPerFile", per_shard).parquet(path)


def copy_plan(mapping: DataFrame, info: dict, source: str, target: str) -> DataFrame:
    """``src, dst`` of the videos of episodes that move from ``old_index`` to ``episode_index``.

    Videos are looked up among the source's files by template and by the usual other places; missing ones have no row.
    """
    from kelpline.functions.paths import fill_template

    spark = mapping.sparkSession
    if not info.get("video_path") or not video_keys(info):
        return spark.createDataFrame([], "src string, dst string")
    size = info["chunks_size"]
    stored = spark.createDataFrame([("", p) for p in files_below(source)], "dataset string, path string")
    keys = spark.createDataFrame([("", info["video_path"], k, size) for k in video_keys(info)], "dataset string, video_path string, video_key string, chunks_size long")
    found = locate.video_files(mapping.select(F.lit("").alias("dataset"), F.col("old_index").alias("episode_index")), keys, stored).filter("path is not null")
    found = found.select(F.col("episode_index").alias("old_index"), "video_key", "path").join(mapping.select("old_index", "episode_index"), "old_index")
    dst = fill_template(F.lit(info["video_path"]), F.expr(f"episode_index div {size}"), F.col("episode_index"), F.col("video_key"))
    return found.select(F.concat(F.lit(f"{source}/"), "path").alias("src"), F.concat(F.lit(f"{target}/"), dst).alias("dst"))


def tree_plan(spark: SparkSession, source: str, target: str, exclude: str = "") -> DataFrame:
    """``src, dst`` of every file below ``source`` whose path from there does not match ``exclude`` from its start."""
    kept = [p for p in files_below(source) if not exclude or not re.match(exclude, p)]
    return spark.createDataFrame([(f"{source}/{p}", f"{target}/{p}") for p in kept], "src string, dst string")


def run_copies(plan: DataFrame, move: bool = False) -> DataFrame:
    """Copy (or ``move``) the files of a plan, in parallel; returns ``src, dst, copied`` (false where the source is missing)."""

    def copy(parts):
        for p in parts:
            done = []
            for s, t in zip(p["src"], p["dst"]):
                ok = exists(s)
                if ok and s != t:
                    system, at = _at(s)
                    with system.open_input_stream(at) as f:

                        def write(out, f=f):
                            while chunk := f.read(1 << 22):
                                out.write(chunk)

                        _put(t, write)
                    if move:
                        system.delete_file(at)
                done.append(ok)
            yield pd.DataFrame({"src": p["src"], "dst": p["dst"], "copied": done})

    return plan.mapInPandas(copy, "src string, dst string, copied boolean")


def next_index(root: str) -> int:
    """One more than the highest number of an episode file below ``root``; 0 if there is none."""
    found = [int(m[1]) for p in files_below(root) if (m := re.match(r"episode_(\d+)\.", p.rsplit("/", 1)[-1]))]
    return max(found, default=-1) + 1


def check_start(root: str, start: int, overwrite: bool = False) -> None:
    """Refuse to write episodes from ``start`` over ones that exist."""
    if not overwrite and start < next_index(root):
        raise FileExistsError(f"{root} has episodes up to {next_index(root) - 1}; {start} would overwrite")


def clear_unfinished(root: str) -> int:
    """Delete temporary files of runs that broke off; returns how many."""
    system, top = _at(root)
    left = [p for p in files_below(root) if p.endswith((".tmp", ".tmp.hdf5"))]
    for p in left:
        system.delete_file(f"{top.rstrip('/')}/{p}")
    return len(left)
