"""Queries of dataset algebra, paths and formats over the episode tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions import formats, paths, vectors
from kelpline.operators import datasets, locate
from kelpline.runtime import read, small

#: Episodes of the training part of the prefix split, and the one task of the unified dataset.
N_TRAIN, TASK = 300, "task description"


def _episodes(spark: SparkSession, d: str) -> DataFrame:
    """One row per episode, as first delivered."""
    e = read(spark, d, "episodes").select("episode_index", "dataset", "tasks", "length", "ingested_at", "deleted_at")
    e = datasets.keep_first(e, ["episode_index"], "ingested_at", "length", "deleted_at")
    return e.withColumn("length", F.when(F.col("length").between(1, 1_000_000), F.col("length")))


def _frames(spark: SparkSession, d: str) -> DataFrame:
    f = read(spark, d, "hdf5_frames").select("episode_idx", "frame_index", "task_index", "file_id", "robot", "timestamp", "chassis_action")
    return datasets.keep_first(f, ["episode_idx", "frame_index"], "file_id").withColumn("index", F.lit(0).cast("long"))


def _stats(spark: SparkSession, d: str) -> DataFrame:
    return datasets.last_stats(read(spark, d, "episodes_stats").filter("episode_index is not null"), ["episode_index"], "written_at")


def _tasks(spark: SparkSession, d: str) -> DataFrame:
    """Every dataset's own tasks: the texts its episodes name, under the number of the episode that names them."""
    return _episodes(spark, d).select("dataset", F.col("episode_index").alias("task_index"), F.explode("tasks").alias("task"))


def _merged(spark: SparkSession, d: str, *parts: str) -> datasets.Dataset:
    """The merged datasets, with only those of their tables that ``parts`` names besides the episodes."""
    e = _episodes(spark, d)
    source = small(e.select(F.col("episode_index").alias("e"), "dataset"))
    f = _frames(spark, d).join(source, F.col("episode_idx") == F.col("e")).drop("e").withColumn("task_index", F.col("episode_idx")) if "frames" in parts else None
    s = _stats(spark, d).join(source, F.col("episode_index") == F.col("e")).drop("e") if "stats" in parts else None
    return datasets.merge(datasets.Dataset(e, f, _tasks(spark, d) if "tasks" in parts else None, s), "dataset", "episode_index", frame_episode="episode_idx")


def merge_episodes(spark, d):
    return _merged(spark, d).episodes.select("dataset", "old_index", "episode_index", "start_frame", "length")


def merge_frames(spark, d):
    return _merged(spark, d, "frames", "tasks").frames.select("episode_idx", "frame_index", "index", "task_index", "file_id")


def merge_tasks(spark, d):
    return datasets.task_dictionary(_tasks(spark, d), "dataset", "task_index")


def merge_stats(spark, d):
    return _merged(spark, d, "stats").stats.select("dataset", "episode_index", "written_at")


def _whole(spark, d, *parts: str):
    return datasets.Dataset(_episodes(spark, d), _frames(spark, d) if "frames" in parts else None, None, _stats(spark, d) if "stats" in parts else None)


def _gone(spark, d):
    return read(spark, d, "episodes").filter("deleted_at is not null and episode_index is not null").select("episode_index")


def delete_episodes(spark, d):
    return datasets.delete(_whole(spark, d), _gone(spark, d), "episode_idx").episodes.select("episode_index", "old_index", "start_frame")


def delete_frames(spark, d):
    return datasets.delete(_whole(spark, d, "frames"), _gone(spark, d), "episode_idx").frames.drop("task_index")


def delete_stats(spark, d):
    return datasets.delete(_whole(spark, d, "stats"), _gone(spark, d), "episode_idx").stats.select("episode_index", "written_at")


def delete_missing(spark, d):
    """Episodes that frames belong to and that do not exist: a deletion of them would fail."""
    return datasets.missing_episodes(_episodes(spark, d), read(spark, d, "hdf5_frames").select(F.col("episode_idx").alias("episode_index")))


def split_train(spark, d):
    return datasets.split(_whole(spark, d), N_TRAIN, "episode_idx")[0].episodes.select("episode_index", "old_index", "start_frame")


def split_test(spark, d):
    return datasets.split(_whole(spark, d, "frames"), N_TRAIN, "episode_idx")[1].frames.select("episode_idx", "frame_index", "index", "file_id")


def unify_frames(spark, d):
    return datasets.unify(_whole(spark, d, "frames"), TASK).frames.groupBy("episode_idx").agg(F.count("*").alias("n"), F.min("task_index").alias("task_index"))


def unify_stats(spark, d):
    """Statistics with those of the feature ``timestamp`` zeroed, as a task number's would be."""
    s = datasets.zero_task_stats(_stats(spark, d), _episodes(spark, d), "timestamp").filter(F.from_json("stats", "map<string,string>").isNotNull())
    at = lambda p: F.get_json_object("stats", f"$.{p}")
    return s.select("episode_index", at("timestamp.max").alias("t_max"), at("timestamp.count").alias("t_count"), at("action.mean[0]").try_cast("double").alias("a_mean"))


def dataset_totals(spark, d):
    return datasets.totals(_episodes(spark, d), None, 1000, 3, ["dataset"]).drop("total_tasks")


def dataset_info(spark, d):
    """Declared totals beside those counted; the videos of a dataset are its episodes times its video features."""
    keys = F.size(F.filter(F.map_values("features"), lambda f: f["dtype"] == "video"))
    i = read(spark, d, "info").select("dataset", "chunks_size", keys.alias("n_cameras"), F.col("total_episodes").alias("declared_episodes"))
    n = _episodes(spark, d).groupBy("dataset").agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("frames"))
    j = i.join(small(n), "dataset", "left")
    n_ = F.coalesce("n", F.lit(0))
    return j.select("dataset", "declared_episodes", n_.alias("total_episodes"), F.coalesce("frames", F.lit(0)).alias("total_frames"), F.ceil(n_ / F.col("chunks_size")).cast("long").alias("total_chunks"), (n_ * F.col("n_cameras")).alias("total_videos"))


def chunk_ntile(spark, d):
    return datasets.balanced_parts(read(spark, d, "supplier").select("s_suppkey"), "s_suppkey", 4, 40).select("s_suppkey", "batch", "part")


def path_render(spark, d):
    e = _episodes(spark, d).join(small(read(spark, d, "info").select("dataset", "data_path", "chunks_size")), "dataset")
    return e.select("episode_index", paths.fill_template(F.col("data_path"), F.expr("episode_index div chunks_size"), F.col("episode_index")).alias("path"))


def path_parse_max(spark, d):
    """The highest episode number in stored file names, per dataset: an append must start beyond it."""
    return read(spark, d, "files").groupBy("dataset").agg(F.max(paths.index_in_name(F.col("path"))).alias("max_index"), F.count("*").alias("n"))


def path_parts(spark, d):
    p = paths.clean_path(F.col("path"))
    return read(spark, d, "files").select("file_id", p.alias("path"), paths.parent(p).alias("dir"), paths.stem(p).alias("stem"), paths.suffix(p).alias("suffix"))


def video_resolution(spark, d):
    """The stored file of each expected video, by falling priority (null if there is none)."""
    keys = F.transform(F.filter(F.map_entries("features"), lambda x: x["value"]["dtype"] == "video"), lambda x: x["key"])
    t = read(spark, d, "info").filter("video_path is not null").select("dataset", "video_path", "chunks_size", F.explode(keys).alias("video_key"))
    have = read(spark, d, "files").filter("deleted_at is null")
    return locate.video_files(_episodes(spark, d), t, have).select("episode_index", "video_key", "path", F.col("how").cast("long").alias("how"))


def parquet_resolution(spark, d):
    """The same for frame files, taking every stored part file for a Parquet file of its episode."""
    have = read(spark, d, "files").filter("kind = 'hdf5'").select("dataset", F.regexp_replace(F.regexp_replace("path", r"\.part\d+\.hdf5$", ".parquet"), "hdf5/chunk-000", "data/chunk-000").alias("path"))
    return locate.parquet_files(_episodes(spark, d), read(spark, d, "info"), have).select("episode_index", "path", F.col("how").cast("long").alias("how"))


def fmt_duration(spark, d):
    s = F.expr("coalesce(length, 0)")
    return _episodes(spark, d).select("episode_index", formats.duration_text(s).alias("text"), formats.duration_text(s, hours=False).alias("minutes"))


def fmt_size(spark, d):
    return read(spark, d, "files").select("file_id", formats.size_text(F.col("n_bytes")).alias("text"))


def json_permissive(spark, d):
    """Readable statistics per month; broken lines are dropped."""
    s = read(spark, d, "episodes_stats").select("episode_index", F.date_format("written_at", "yyyy-MM").alias("month"), F.from_json("stats", "map<string,string>").alias("m"))
    return s.filter("m is not null").groupBy("month").agg(F.count("*").alias("n"), F.sum(F.size("m")).alias("n_features"))


def vector_assemble(spark, d):
    e = F.col("embedding")
    v = vectors.assemble(F.slice(e, 1, 21), F.slice(e, 22, 3), F.slice(e, 25, 20), F.slice(e, 45, 2), F.slice(e, 47, 7), F.slice(e, 54, 5))
    return read(spark, d, "embeddings").select("vec_id", v.alias("vector"))


def ee_pose(spark, d):
    e = F.col("embedding")
    part = lambda names, first: F.struct(*[e[first + i].alias(n) for i, n in enumerate(names)])
    return read(spark, d, "embeddings").select("vec_id", vectors.flatten_pose(F.struct(part("xyz", 0).alias("position"), part("xyzw", 3).alias("orientation"))).alias("pose"))


def vector_place(spark, d):
    return read(spark, d, "embeddings").select("vec_id", vectors.place(F.col("embedding"), F.slice("embedding", 10, 2), 3, 4).alias("vector"))


def vector_names(spark, d):
    rows = [(k, i, n) for k, layout in (("body", vectors.LAYOUT), ("chassis", vectors.CHASSIS), ("wide", vectors.WIDE)) for i, n in enumerate(vectors.names(layout))]
    return spark.createDataFrame(rows, "layout string, slot int, name string")


def number_lists(spark, d):
    return read(spark, d, "embeddings").select("vec_id", formats.number_list(F.slice("embedding", 1, 3), 2).alias("text"))


def episode_stats(spark, d):
    """Statistics of each episode's chassis slots, without readings that are none."""
    f = read(spark, d, "hdf5_frames").filter("chassis_state is not null and episode_idx is not null").select("episode_idx", "frame_index", F.transform("chassis_state", lambda x: F.when(F.abs(x) < 100, x)).alias("v"))
    f = datasets.keep_first(f, ["episode_idx", "frame_index"], "v")
    return vectors.vector_stats(f, "v", "episode_idx").select("episode_idx", "slot", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")], "count")


def merge_totals(spark, d):
    """Totals of all datasets in one: episodes and frames are counted, the videos are those that the sources declare."""
    return datasets.merged_totals(_episodes(spark, d), read(spark, d, "info"), 1000)


def example_numbers(spark, d):
    """Episodes as examples in the order of their number."""
    return datasets.number_examples(_episodes(spark, d).select("episode_index", "dataset"), "episode_index").select("episode_index", "example")


def example_head(spark, d):
    """At most twenty examples of each dataset, the first by number."""
    return datasets.first_examples(_episodes(spark, d).select("episode_index", "dataset"), "dataset", "episode_index", 20)


def vector_pad(spark, d):
    return read(spark, d, "embeddings").select("vec_id", vectors.pad(F.slice("embedding", 1, 5), 7).alias("padded"), F.size(vectors.pad(F.col("embedding"), 70)).alias("n"))


def vector_flatten(spark, d):
    e = F.col("embedding")
    return read(spark, d, "embeddings").select("vec_id", vectors.flatten(F.slice(e, 1, 2), F.slice(e, 3, 5), F.slice(e, 8, 0), 3).alias("chassis"), vectors.flatten_gripper(F.slice(e, 1, 2), F.slice(e, 1, 0), F.slice(e, 9, 1)).alias("gripper"))


def vector_stats(spark, d):
    s = vectors.vector_stats(read(spark, d, "embeddings"), "embedding")
    return s.select("slot", *[F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")], "count")


def zip_lists(spark, d):
    """Lists of unlike length side by side, cut to the shorter."""
    z = vectors.zip_shortest(a=F.slice("embedding", 1, 5), b=F.slice("embedding", 6, 3))
    return read(spark, d, "embeddings").select("vec_id", F.transform(z, lambda x: x["a"].cast("double") * x["b"].cast("double")).alias("products"))


QUERIES = {f.__name__: f for f in (
    merge_episodes, merge_frames, merge_tasks, merge_stats, delete_episodes, delete_frames, delete_stats, delete_missing, split_train, split_test, unify_frames, unify_stats, dataset_totals, dataset_info, chunk_ntile,
    path_render, path_parse_max, path_parts, video_resolution, parquet_resolution, fmt_duration, fmt_size, json_permissive, vector_assemble, ee_pose, vector_place, vector_names, number_lists, episode_stats,
    merge_totals, example_numbers, example_head, vector_pad, vector_flatten, vector_stats, zip_lists,
)}

_E = """
with e as (
  select episode_index, dataset, tasks, case when length between 1 and 1000000 then length end as length, ingested_at, deleted_at
  from (select *, row_number() over (partition by episode_index order by ingested_at nulls first, length nulls first, deleted_at nulls first) as nr from episodes) where nr = 1
), f as (select episode_idx, frame_index, min(file_id) as file_id from hdf5_frames group by 1, 2),
s as (select * from (select *, row_number() over (partition by episode_index order by written_at desc nulls last, stats desc nulls last) as nr from episodes_stats where episode_index is not null) where nr = 1),
"""
_NEW = lambda where, by: f"row_number() over (order by {by}) - 1 as episode_index, coalesce(sum(coalesce(length, 0)) over (order by {by} rows between unbounded preceding and 1 preceding), 0)::bigint as start_frame, * exclude (episode_index), episode_index as old_index from e {where}"
_KEPT = f"n as (select {_NEW('where episode_index not in (select episode_index from episodes where deleted_at is not null)', 'episode_index')})"
_FRAMES = "select n.episode_index as episode_idx, f.frame_index, (n.start_frame + row_number() over (partition by n.episode_index order by f.frame_index) - 1)::bigint as \"index\", f.file_id"

ORACLE = {
    "merge_episodes": _E + f"n as (select {_NEW('', 'dataset nulls first, episode_index')}) select dataset, old_index, episode_index, start_frame, length from n",
    "merge_frames": _E + f"""n as (select {_NEW('', 'dataset nulls first, episode_index')}),
t as (select dataset, episode_index, unnest(tasks) as task from e), first_ as (select task, min((dataset, episode_index)) as seen from t where task is not null group by 1),
dict as (select task, row_number() over (order by seen, task) - 1 as task_index from first_),
one as (select dataset, episode_index, min(task) as task from t group by 1, 2)
{_FRAMES}, coalesce(dict.task_index, f.episode_idx)::bigint as task_index from f join n on f.episode_idx = n.old_index left join one on one.episode_index = n.old_index left join dict using (task)""",
    "merge_tasks": _E + """t as (select dataset, episode_index, unnest(tasks) as task from e), first_ as (select task, min((dataset, episode_index)) as seen from t where task is not null group by 1)
select task, row_number() over (order by seen, task) - 1 as task_index from first_""",
    "merge_stats": _E + f"n as (select {_NEW('', 'dataset nulls first, episode_index')}) select n.dataset, n.episode_index, s.written_at from s join n on s.episode_index = n.old_index",
    "delete_episodes": _E + _KEPT + " select episode_index, old_index, start_frame from n",
    "delete_frames": _E.replace("select episode_idx, frame_index, min(file_id) as file_id from hdf5_frames group by 1, 2", "select * from hdf5_frames qualify row_number() over (partition by episode_idx, frame_index order by file_id) = 1") + _KEPT + f" {_FRAMES}, f.robot, f.timestamp, f.chassis_action from f join n on f.episode_idx = n.old_index",
    "delete_stats": _E + _KEPT + " select n.episode_index, s.written_at from s join n on s.episode_index = n.old_index",
    "delete_missing": "select distinct episode_idx as episode_index from hdf5_frames where episode_idx is not null and episode_idx not in (select episode_index from episodes where episode_index is not null)",
    "split_train": _E + f"n as (select {_NEW('', 'episode_index')}) select episode_index, old_index, start_frame from n where episode_index < {N_TRAIN}",
    "split_test": _E + f"r as (select * from (select *, row_number() over (order by episode_index) - 1 as rank from e) where rank >= {N_TRAIN}), n as (select {_NEW('', 'episode_index').replace('from e ', 'from r ')}) {_FRAMES} from f join n on f.episode_idx = n.old_index",
    "unify_frames": "select episode_idx, count(distinct frame_index) as n, 0::bigint as task_index from hdf5_frames group by 1",
    "unify_stats": _E + """v as (select s.episode_index, s.stats, e.length from s left join e on s.episode_index = e.episode_index where json_valid(s.stats))
select episode_index, case when json_exists(stats, '$.timestamp.max') then '[0.0]' end as t_max,
       case json_type(stats, '$.timestamp.count') when 'ARRAY' then '[' || coalesce(length, 0) || ']' when null then null else case when json_exists(stats, '$.timestamp.count') then coalesce(length, 0)::varchar end end as t_count,
       try_cast(json_extract_string(stats, '$.action.mean[0]') as double) as a_mean from v""",
    "dataset_totals": _E + "z as (select 1) select dataset, count(*) as total_episodes, coalesce(sum(length), 0)::bigint as total_frames, ceil(count(*) / 1000.0)::bigint as total_chunks, count(*) * 3 as total_videos from e group by 1",
    "dataset_info": _E + """n as (select dataset, count(*) as n, coalesce(sum(length), 0)::bigint as frames from e group by 1)
select i.dataset, i.total_episodes as declared_episodes, coalesce(n.n, 0) as total_episodes, coalesce(n.frames, 0) as total_frames, ceil(coalesce(n.n, 0) / i.chunks_size)::bigint as total_chunks,
       coalesce(n.n, 0) * len(list_filter(map_values(i.features), lambda f: f.dtype = 'video')) as total_videos from info i left join n using (dataset)""",
    "chunk_ntile": """with i as (select s_suppkey, row_number() over (order by s_suppkey) - 1 as item from supplier)
select s_suppkey, item // 40 as batch, ntile(4) over (partition by item // 40 order by item) - 1 as part from i""",
    "path_render": _E + """z as (select 1) select e.episode_index, replace(replace(i.data_path, '{episode_chunk:03d}', lpad((e.episode_index // i.chunks_size)::varchar, greatest(3, length((e.episode_index // i.chunks_size)::varchar))::int, '0')),
 '{episode_index:06d}', lpad(e.episode_index::varchar, greatest(6, length(e.episode_index::varchar))::int, '0')) as path from e join info i using (dataset)""",
    "path_parse_max": "select dataset, max(try_cast(regexp_extract(regexp_replace(path, '^.*/', ''), 'episode_(\\d+)', 1) as bigint)) as max_index, count(*) as n from files group by 1",
    "path_parts": r"""with p as (select file_id, regexp_replace(regexp_replace(path, '/(\./|/)+', '/', 'g'), '^(\./|/)+', '') as path from files), b as (select *, regexp_replace(path, '^.*/', '') as base from p)
select file_id, path, case when path like '%/%' then regexp_replace(path, '/[^/]*$', '') when path is null then null else '' end as dir, regexp_replace(base, '(.)\.[^.]*$', '\1') as stem, lower(case when base like '_%.%' then '.' || regexp_extract(base, '^.+\.([^.]*)$', 1) when base is null then null else '' end) as suffix from b""",
    "video_resolution": _E + r"""i as (select dataset, video_path, chunks_size, features, unnest(map_keys(features)) as video_key from info where video_path is not null),
w as (select distinct e.episode_index, e.dataset, i.video_key, i.video_path, e.episode_index // i.chunks_size as chunk from e join i using (dataset) where i.features[i.video_key].dtype = 'video' and e.episode_index is not null),
c as (select w.*, how, case how when 0 then chunk else 0 end as c from w, (select unnest([0, 1]) as how)),
x as (select episode_index, dataset, video_key, how, replace(replace(replace(replace(replace(video_path, '{video_key}', video_key), '{episode_chunk:03d}', lpad(c::varchar, greatest(3, length(c::varchar))::int, '0')), '{episode_chunk:05d}', lpad(c::varchar, greatest(5, length(c::varchar))::int, '0')),
 '{episode_index:06d}', lpad(episode_index::varchar, greatest(6, length(episode_index::varchar))::int, '0')), '{episode_index:07d}', lpad(episode_index::varchar, greatest(7, length(episode_index::varchar))::int, '0')) as path from c
 union all select episode_index, dataset, video_key, 2, 'videos/chunk-' || lpad(chunk::varchar, 3, '0') || '/' || video_key || '/episode_' || episode_index || '.mp4' from w
 union all select episode_index, dataset, video_key, 3, 'videos/chunk-' || lpad(chunk::varchar, 3, '0') || '/' || video_key || '/episode_' || lpad(episode_index::varchar, 6, '0') || '.mp4' from w),
h as (select distinct dataset, regexp_replace(regexp_replace(path, '/(\./|/)+', '/', 'g'), '^(\./|/)+', '') as path from files where deleted_at is null),
y as (select episode_index, video_key, how, path from x join h using (dataset, path)
 union all select w.episode_index, w.video_key, 4, h.path from w join h on w.dataset = h.dataset and h.path like 'videos/%.mp4' and list_contains(string_split(regexp_replace(h.path, '/[^/]*$', ''), '/'), w.video_key)
 and contains(regexp_replace(h.path, '^.*/', ''), lpad(w.episode_index::varchar, 6, '0'))),
z as (select episode_index, video_key, min((how, path)) as best from y group by 1, 2)
select w.episode_index, w.video_key, best[2] as path, best[1]::bigint as how from w left join z using (episode_index, video_key)""",
    "parquet_resolution": _E + r"""w as (select distinct e.episode_index, e.dataset, e.episode_index // i.chunks_size as chunk, 'episode_' || lpad(e.episode_index::varchar, 6, '0') || '.parquet' as name from e join info i using (dataset) where e.episode_index is not null),
h as (select distinct dataset, regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '\.part\d+\.hdf5$', '.parquet'), 'hdf5/chunk-000', 'data/chunk-000', 'g'), '/(\./|/)+', '/', 'g'), '^(\./|/)+', '') as path from files where kind = 'hdf5'),
x as (select episode_index, dataset, 0 as how, 'data/chunk-' || lpad(chunk::varchar, 3, '0') || '/' || name as path from w union all select episode_index, dataset, 1, 'parquet/' || name from w union all select episode_index, dataset, 2, 'data/' || name from w),
y as (select episode_index, how, path from x join h using (dataset, path) union all select w.episode_index, 3, h.path from w join h on w.dataset = h.dataset and regexp_replace(h.path, '^.*/', '') = w.name),
z as (select episode_index, min((how, path)) as best from y group by 1)
select w.episode_index, best[2] as path, best[1]::bigint as how from w left join z using (episode_index)""",
    "ee_pose": "select vec_id, embedding[1:7] as pose from embeddings",
    "vector_place": "select vec_id, list_concat(list_concat(embedding[1:3], embedding[10:11]), list_concat([0, 0]::float[], embedding[8:64])) as vector from embeddings",
    "vector_names": """with p(layout, nr, name, size) as (values
 ('body', 1, 'left_arm_pos', 7), ('body', 2, 'left_gripper_pos', 1), ('body', 3, 'right_arm_pos', 7), ('body', 4, 'right_gripper_pos', 1), ('body', 5, 'left_arm_vel', 7), ('body', 6, 'left_gripper_vel', 1), ('body', 7, 'right_arm_vel', 7),
 ('body', 8, 'right_gripper_vel', 1), ('body', 9, 'left_arm_effort', 7), ('body', 10, 'left_gripper_effort', 1), ('body', 11, 'right_arm_effort', 7), ('body', 12, 'right_gripper_effort', 1), ('body', 13, 'left_ee_pose', 7), ('body', 14, 'right_ee_pose', 7),
 ('chassis', 1, 'chassis_pos', 3), ('chassis', 2, 'chassis_vel', 3), ('chassis', 3, 'chassis_effort', 3)
), q as (select * from p union all select 'wide', nr, name, size from p where layout = 'body' union all values ('wide', 15, 'chassis', 9), ('wide', 16, 'lift_vel', 1)),
r as (select layout, nr, name, size, unnest(range(size)) as i from q)
select layout, (row_number() over (partition by layout order by nr, i) - 1)::int as slot, case when size > 1 then name || '_' || i else name end as name from r""",
    "number_lists": "select vec_id, '[' || array_to_string(list_transform(embedding[1:3], lambda x: printf('%.2f', x::double)), ', ') || ']' as text from embeddings",
    "episode_stats": """with f as (select distinct episode_idx, frame_index, chassis_state from hdf5_frames where chassis_state is not null and episode_idx is not null),
v as (select episode_idx, unnest(range(len(chassis_state)))::int as slot, unnest(chassis_state)::double as v from f), w as (select episode_idx, slot, case when abs(v) < 100 then v end as v from v)
select episode_idx, slot, round(min(v), 6) as min, round(max(v), 6) as max, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std, count(v) as count from w group by 1, 2""",
    "merge_totals": _E + """z as (select 1) select count(*) as total_episodes, coalesce(sum(length), 0)::bigint as total_frames, ceil(count(*) / 1000.0)::bigint as total_chunks,
 (select coalesce(sum(total_videos), 0)::bigint from info) as total_videos from e""",
    "example_numbers": _E + "z as (select 1) select episode_index, row_number() over (order by episode_index nulls first) - 1 as example from e",
    "example_head": _E + "z as (select 1) select episode_index, dataset from e qualify row_number() over (partition by dataset order by episode_index nulls first) <= 20",
    "fmt_duration": _E + """t as (select episode_index, coalesce(length, 0) as s from e) select episode_index,
 case when s >= 3600 then printf('%dh %dm %ds', s // 3600, s % 3600 // 60, s % 60) when s >= 60 then printf('%dm %ds', s // 60, s % 60) else printf('%ds', s) end as text,
 case when s >= 60 then printf('%dm %ds', s // 60, s % 60) else printf('%ds', s) end as minutes from t""",
    "fmt_size": "select file_id, case when n_bytes >= 1000000000 then printf('%.2f GB', n_bytes / 1e9) when n_bytes is not null then printf('%.2f MB', n_bytes / 1e6) end as text from files",
    "json_permissive": "select strftime(written_at, '%Y-%m') as month, count(*) as n, sum(len(json_keys(stats)))::bigint as n_features from episodes_stats where json_valid(stats) group by 1",
    "vector_pad": "select vec_id, list_transform(list_concat(embedding[1:5], [0, 0]::float[]), lambda x: x::double) as padded, 70 as n from embeddings",
    "vector_flatten": "select vec_id, [embedding[1], embedding[2], 0, embedding[3], embedding[4], embedding[5], 0, 0, 0]::float[] as chassis, [embedding[1], 0, embedding[9]]::float[] as gripper from embeddings",
    "vector_stats": """with v as (select unnest(embedding)::double as v, unnest(range(len(embedding)))::int as slot from embeddings)
select slot, round(min(v), 6) as min, round(max(v), 6) as max, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std, count(v) as count from v group by 1""",
    "zip_lists": "select vec_id, [embedding[i]::double * embedding[i + 5]::double for i in [1, 2, 3]] as products from embeddings",
    "vector_assemble": """with v as (select vec_id, list_concat(
  list_concat(list_concat(embedding[1:7], embedding[22:22]), list_concat(embedding[25:31], embedding[45:45])),
  list_concat(list_concat(embedding[8:14], embedding[23:23]), list_concat(embedding[32:38], embedding[46:46])),
  list_concat(list_concat(embedding[15:21], embedding[24:24]), list_concat(embedding[39:44], [0, 0]::float[])),
  embedding[47:53], list_concat(embedding[54:58], [0, 0]::float[])) as v from embeddings)
select vec_id, v as vector from v""",
}
