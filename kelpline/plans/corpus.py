"""Queries of the general corpus problems (1, 5, 6) over the tables of a data directory, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.operators import archive, orphans, spikes
from kelpline.runtime import read


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.find_orphans(*[read(spark, d, t) for t in ("episodes", "episodes_stats", "tasks", "info", "hdf5_frames", "packets", "files")])


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(p1_found(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.find_implausible(read(spark, d, "hdf5_frames")).select("episode_idx", "frame_index", "field", "slot").distinct()


def p5_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    return spikes.cutoffs(spikes.measure(read(spark, d, "hdf5_frames")))


def _store(spark: SparkSession, d: str) -> archive.Store:
    return archive.pack_rows(read(spark, d, "hdf5_frames"), read(spark, d, "files").filter("kind = 'hdf5'"), read(spark, d, "info"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return archive.packed_overlaps(read(spark, d, "hdf5_frames"), read(spark, d, "files").filter("kind = 'hdf5'"), read(spark, d, "info"))


def p6_index(spark: SparkSession, d: str) -> DataFrame:
    """What the index says of every packed file, and whether its members lie within one dataset's containers, end to end in their blocks."""
    i = _store(spark, d).index
    block = i.groupBy("container", "block").agg((F.sum("length") == F.max(F.col("offset") + F.col("length"))).alias("tight"))
    mixed = i.groupBy("container").agg((F.countDistinct("dataset") == 1).alias("pure"))
    j = i.join(block, ["container", "block"]).join(mixed, "container")
    return j.groupBy("file_id", "dataset", "chunk", "path").agg(F.sum("n_rows").alias("n_rows"), F.min(F.col("tight") & F.col("pure")).alias("sound"))


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """The containers' physical files and sizes."""
    return archive.container_files(_store(spark, d))


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    """Every record once, with all its columns, out of the containers."""
    frames = read(spark, d, "hdf5_frames")
    rows = archive.distinct_records(archive.unpack_rows(_store(spark, d), frames))
    return rows.withColumns({c: F.col(c).cast("array<double>") for c in ("state", "chassis_state", "action", "chassis_action")})


QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p5_found": p5_found, "p5_cutoffs": p5_cutoffs, "p6_found": p6_found, "p6_index": p6_index, "p6_containers": p6_containers, "p6_records": p6_records}

_ORPHANS = r"""
with ep as (
  select episode_index, min(ingested_at) as arrived, bool_or(deleted_at is not null) as gone,
         arg_min(dataset, (dataset is null, ingested_at, dataset)) as dataset
  from episodes where episode_index is not null group by 1
), tk as (
  select task_index, min(created_at) as arrived, bool_or(deleted_at is not null) as gone
  from tasks where task_index is not null group by 1
), fl as (
  select dataset, regexp_replace(regexp_replace(path, '/(\./|/)+', '/', 'g'), '^(\./|/)+', '') as path,
         min(written_at) filter (deleted_at is null) as arrived, bool_and(deleted_at is not null) as gone
  from files where dataset is not null and path is not null group by 1, 2
), refs as (
  select 'episodes_stats' as src_table, s.episode_index, 'episode_index' as ref_field, cast(s.episode_index as varchar) as ref_key,
         strftime(s.written_at, '%Y-%m') as period, s.written_at as seen_at, e.episode_index is null as missing, e.gone, e.arrived
  from episodes_stats s left join ep e on s.episode_index = e.episode_index where s.episode_index is not null
  union all
  select 'hdf5_frames', f.episode_idx, 'episode_idx', cast(f.episode_idx as varchar), strftime(f.written_at, '%Y-%m'), f.written_at,
         e.episode_index is null, e.gone, e.arrived
  from hdf5_frames f left join ep e on f.episode_idx = e.episode_index where f.episode_idx is not null
  union all
  select 'packets', p.episode_index, 'episode_index', cast(p.episode_index as varchar), strftime(p.loaded_at, '%Y-%m'), p.loaded_at,
         e.episode_index is null, e.gone, e.arrived
  from packets p left join ep e on p.episode_index = e.episode_index where p.episode_index is not null
  union all
  select 'hdf5_frames', f.episode_idx, 'task_index', cast(f.task_index as varchar), strftime(f.written_at, '%Y-%m'), f.written_at,
         t.task_index is null, t.gone, t.arrived
  from hdf5_frames f left join tk t on f.task_index = t.task_index where f.task_index is not null
  union all
  select 'info', v.episode_index, 'video_path', v.ref_key, strftime(v.seen_at, '%Y-%m'), v.seen_at, fl.path is null, fl.gone, fl.arrived
  from (
    select e.episode_index, e.dataset, e.arrived as seen_at,
           replace(replace(replace(replace(replace(i.video_path, '{video_key}', i.video_key),
             '{episode_chunk:03d}', lpad(cast(e.episode_index // i.chunks_size as varchar), greatest(3, length(cast(e.episode_index // i.chunks_size as varchar)))::int, '0')),
             '{episode_chunk:05d}', lpad(cast(e.episode_index // i.chunks_size as varchar), greatest(5, length(cast(e.episode_index // i.chunks_size as varchar)))::int, '0')),
             '{episode_index:06d}', lpad(cast(e.episode_index as varchar), greatest(6, length(cast(e.episode_index as varchar)))::int, '0')),
             '{episode_index:07d}', lpad(cast(e.episode_index as varchar), greatest(7, length(cast(e.episode_index as varchar)))::int, '0')) as ref_key
    from ep e join (
      select * from (select dataset, video_path, chunks_size, features, unnest(map_keys(features)) as video_key from info where video_path is not null)
      where features[video_key].dtype = 'video'
    ) i on e.dataset = i.dataset where not e.gone
  ) v left join fl on v.dataset = fl.dataset and v.ref_key = fl.path
), found as (
  select distinct src_table, episode_index, ref_field, ref_key, period,
         case when missing then 'missing' when gone then 'deleted' when arrived > seen_at then 'late' end as cause
  from refs where missing or gone or arrived > seen_at
)
"""

ORACLE = {
    "p1_found": _ORPHANS + "select * from found",
    "p1_report": _ORPHANS + "select src_table, ref_field, period, cause, count(*) as n_refs, count(distinct episode_index) as n_episodes from found group by all",
    "p6_found": """
select distinct a.file_id as file_id_a, b.file_id as file_id_b from hdf5_frames a join hdf5_frames b
on a.episode_idx = b.episode_idx and a.frame_index = b.frame_index and a.file_id < b.file_id""",
    "p6_index": r"""
select r.file_id, coalesce(f.dataset, '') as dataset,
       coalesce(case when f.episode_idx >= 0 and i.chunks_size > 0 then f.episode_idx // i.chunks_size end, -1) as chunk,
       regexp_replace(regexp_replace(f.path, '/(\./|/)+', '/', 'g'), '^(\./|/)+', '') as path, r.n_rows, true as sound
from (select file_id, count(*) as n_rows from hdf5_frames group by 1) r
left join (select * from files where kind = 'hdf5') f on r.file_id = f.file_id left join info i on f.dataset = i.dataset""",
    "p6_records": """
select episode_idx, frame_index, file_id, task_index, robot, timestamp, state::double[] as state, chassis_state::double[] as chassis_state,
       action::double[] as action, chassis_action::double[] as chassis_action, written_at
from (select *, row_number() over (partition by episode_idx, frame_index order by file_id nulls last) as nr
      from hdf5_frames where episode_idx is not null and frame_index is not null) where nr = 1""",
}
