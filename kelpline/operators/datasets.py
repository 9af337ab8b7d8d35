"""Datasets of episodes: merge, delete, split, unify and total, with dense new numbers and start frames.

A dataset is five tables: ``episodes`` (``episode_index, length, tasks`` and others), ``frames`` (``episode_index`` or as
named, an order, and optionally ``index`` and ``task_index``), ``tasks`` (``task_index, task``), ``stats``
(``episode_index, stats``) and ``info`` (one row). Columns a rule does not name pass through; optional ones are
rewritten only where they exist.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kelpline.operators.order import number_rows
from kelpline.runtime import materialize, small


@dataclass(frozen=True)
class Dataset:
    episodes: DataFrame
    frames: DataFrame | None = None
    tasks: DataFrame | None = None
    stats: DataFrame | None = None
    order: str = "frame_index"


def last_stats(stats: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key; of repeated rows the last by ``order`` (nulls first) wins."""
    rest = [c for c in stats.columns if c not in keys]
    return stats.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(order).isNotNull(), F.col(order), F.to_json(F.struct(*rest)))).alias("r")).select(*keys, "r.*")


def renumber(episodes: DataFrame, *order: str, keep: str = "old_index") -> DataFrame:
    """Episodes numbered densely from 0 in ``order``: ``episode_index``, the old one in ``keep``, and ``start_frame``, the frames before."""
    e = episodes.withColumn(keep, F.col("episode_index")).withColumn("length_or_0", F.coalesce("length", F.lit(0)).cast("long"))
    return number_rows(e, *order, index="new_index", sums={"start_frame": "length_or_0"}).withColumn("episode_index", F.col("new_index")).drop("new_index", "length_or_0")


def rewrite_frames(frames: DataFrame, mapping: DataFrame, keys: dict[str, str], order: str, episode: str = "episode_index") -> DataFrame:
    """Frames of the mapped episodes with new ``episode`` and, where it exists, global ``index`` = start frame + position.

    ``mapping``: the columns ``keys`` leads to (frame column to mapping column), ``episode_index`` and ``start_frame``.
    """
    m = mapping.select(*[F.col(v).alias(f"map_{k}") for k, v in keys.items()], F.col("episode_index").alias("map_to"), F.col("start_frame").alias("map_start"))
    f = frames.join(small(m), [F.col(k) == F.col(f"map_{k}") for k in keys])
    if "index" in frames.columns:
        w = Window.partitionBy("map_to").orderBy(order)
        f = f.withColumn("index", (F.col("map_start") + F.row_number().over(w) - 1).cast("long"))
    return f.withColumn(episode, F.col("map_to").cast(dict(frames.dtypes)[episode])).drop("map_to", "map_start", *[f"map_{k}" for k in keys])


def task_dictionary(tasks: DataFrame, *order: str) -> DataFrame:
    """Distinct task texts numbered in the order they are first seen: ``task_index, task``. Null texts are no tasks."""
    first = tasks.filter("task is not null").groupBy("task").agg(F.min(F.struct(*order)).alias("seen"))
    return number_rows(first, "seen", "task", index="task_index").select("task_index", "task")


def merge(sources: Dataset, source: str, episode_order: str, task_order: str = "task_index", frame_episode: str = "episode_index") -> Dataset:
    """All sources in one dataset; every table has a ``source`` column, whose values are taken in ascending order.

    Episodes keep their order within the source. Tasks are merged by text. The frames of an episode get the new number
    of the task of its first frame; tasks without a text keep their number, of a number's several texts the first in the alphabet counts. Statistics follow their episodes.
    """
    e = renumber(sources.episodes, source, episode_order)
    tasks, frames, stats = sources.tasks, sources.frames, sources.stats
    if tasks is not None:
        dictionary = task_dictionary(tasks, source, task_order)
    if frames is not None:
        if tasks is not None and "task_index" in frames.columns:
            to = tasks.groupBy(F.col(source).alias("t_source"), F.col("task_index").alias("t_old")).agg(F.min("task").alias("task")).join(dictionary.withColumnRenamed("task_index", "t_new"), "task").drop("task")
            first = F.first(F.col("task_index")).over(Window.partitionBy(source, frame_episode).orderBy(sources.order))
            frames = frames.withColumn("first_task", first).join(small(to), (F.col(source) == F.col("t_source")) & (F.col("first_task") == F.col("t_old")), "left")
            kind = dict(sources.frames.dtypes)["task_index"]
            frames = frames.withColumn("task_index", F.coalesce("t_new", "task_index").cast(kind)).drop("first_task", "t_source", "t_old", "t_new")
        frames = rewrite_frames(frames, e, {source: source, frame_episode: "old_index"}, sources.order, frame_episode)
    if stats is not None:
        to = e.select(F.col(source).alias("m_source"), F.col("old_index").alias("m_old"), F.col("episode_index").alias("m_new"))
        stats = stats.join(to, (F.col(source) == F.col("m_source")) & (F.col("episode_index") == F.col("m_old"))).withColumn("episode_index", F.col("m_new")).drop("m_source", "m_old", "m_new")
    return Dataset(e, frames, None if tasks is None else dictionary, stats, sources.order)


def missing_episodes(episodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Distinct ``episode_index`` of ``wanted`` that no episode has."""
    return wanted.select("episode_index").distinct().join(episodes.select("episode_index"), "episode_index", "left_anti")


def _follow(d: Dataset, e: DataFrame, frame_episode: str) -> Dataset:
    """The tables that go with renumbered episodes ``e``."""
    frames = None if d.frames is None else rewrite_frames(d.frames, e, {frame_episode: "old_index"}, d.order, frame_episode)
    to = e.select(F.col("old_index").alias("m_old"), F.col("episode_index").alias("m_new"))
    stats = None if d.stats is None else d.stats.join(small(to), F.col("episode_index") == F.col("m_old")).withColumn("episode_index", F.col("m_new")).drop("m_old", "m_new")
    return Dataset(e, frames, d.tasks, stats, d.order)


def delete(d: Dataset, ids: DataFrame, frame_episode: str = "episode_index", check: bool = True) -> Dataset:
    """Without the listed episodes, renumbered by old number; tasks stay. Listed episodes that do not exist are an error."""
    if check:
        lost = [r[0] for r in missing_episodes(d.episodes, ids).orderBy("episode_index").limit(20).collect()]
        if lost:
            raise ValueError(f"no such episodes: {lost}")
    kept = d.episodes.join(small(ids.select("episode_index").distinct()), "episode_index", "left_anti")
    return _follow(d, renumber(kept, "episode_index"), frame_episode)


def split(d: Dataset, n_train: int, frame_episode: str = "episode_index") -> tuple[Dataset, Dataset]:
    """The first ``n_train`` episodes by number and the rest, each renumbered from 0 with all tasks; the rest is empty if there are no more."""
    if n_train <= 0:
        raise ValueError("the training split must have at least one episode")
    e = materialize(renumber(d.episodes, "episode_index"), "split")
    rest = e.filter(F.col("episode_index") >= n_train)
    ahead = rest.agg(F.coalesce(F.min("start_frame"), F.lit(0)).alias("n")).first()["n"]
    rest = rest.withColumns({"episode_index": F.col("episode_index") - n_train, "start_frame": F.col("start_frame") - ahead})
    return _follow(d, e.filter(F.col("episode_index") < n_train), frame_episode), _follow(d, rest, frame_episode)


def unify(d: Dataset, task: str) -> Dataset:
    """One task for all: ``tasks`` of episodes, ``task_index`` 0 in its old type, statistics of the task number zeroed."""
    spark = d.episodes.sparkSession
    frames = d.frames
    if frames is not None and "task_index" in frames.columns:
        frames = frames.withColumn("task_index", F.lit(0).cast(dict(frames.dtypes)["task_index"]))
    e = d.episodes.withColumn("tasks", F.array(F.lit(task)))
    stats = None if d.stats is None else zero_task_stats(d.stats, e)
    return replace(d, episodes=e, frames=frames, tasks=spark.createDataFrame([(0, task)], "task_index long, task string"), stats=stats)


def zero_task_stats(stats: DataFrame, episodes: DataFrame, feature: str = "task_index") -> DataFrame:
    """``stats`` (JSON text) with min, max, mean and std of ``feature`` set to [0.0] and its count to the episode's length (0 if unknown).

    The count stays a list or a number as it was; other features and keys are kept. Texts without the feature are unchanged.
    """
    n = episodes.groupBy(F.col("episode_index").alias("z_ep")).agg(F.max("length").alias("z_n"))
    s = stats.join(n, F.col("episode_index") == F.col("z_ep"), "left").withColumn("z_map", F.from_json("stats", "map<string,string>"))
    f = F.from_json(F.try_element_at("z_map", F.lit(feature)), "map<string,string>")
    count = F.coalesce("z_n", F.lit(0)).cast("string")
    value = lambda k, v: F.when(k.isin("min", "max", "mean", "std"), F.lit("[0.0]")).when((k == "count") & F.trim(v).startswith("["), F.concat(F.lit("["), count, F.lit("]"))).when(k == "count", count).otherwise(v)
    pairs = lambda m: F.array_join(F.transform(F.map_entries(m), lambda x: F.concat(F.to_json(F.array(x["key"])).substr(F.lit(2), F.length(F.to_json(F.array(x["key"]))) - 2), F.lit(": "), x["value"])), ", ")
    inner = F.concat(F.lit("{"), pairs(F.transform_values(f, value)), F.lit("}"))
    whole = F.concat(F.lit("{"), pairs(F.transform_values("z_map", lambda k, v: F.when(k == feature, inner).otherwise(v))), F.lit("}"))
    return s.withColumn("stats", F.when(f.isNotNull(), whole).otherwise(F.col("stats"))).drop("z_ep", "z_n", "z_map")


def totals(episodes: DataFrame, n_tasks: int | None, chunk: int, n_videos: int, by: list[str] | None = None) -> DataFrame:
    """Totals of a dataset (or of each group ``by``): episodes, frames, chunks, and videos as episodes times cameras."""
    n = F.count("*")
    return episodes.groupBy(*(by or [])).agg(n.alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("total_frames"), F.ceil(n / chunk).cast("long").alias("total_chunks"), (n * n_videos).alias("total_videos")).withColumn("total_tasks", F.lit(n_tasks).cast("long"))


def merged_totals(episodes: DataFrame, infos: DataFrame, chunk: int) -> DataFrame:
    """Totals of datasets merged into one. Episodes, frames and chunks are counted; videos are those the sources declare (null counts 0)."""
    declared = infos.agg(F.coalesce(F.sum("total_videos"), F.lit(0)).cast("long").alias("n")).first()["n"]
    return totals(episodes, None, chunk, 0).drop("total_tasks").withColumn("total_videos", F.lit(declared).cast("long"))


def number_examples(rows: DataFrame, key: str, salt: str | None = None) -> DataFrame:
    """``rows`` with ``example``: their number in the order of ``key`` or, with a salt, of a salted hash of it."""
    return number_rows(rows, *([] if salt is None else [F.xxhash64(F.col(key), F.lit(salt))]), key, index="example")


def first_examples(rows: DataFrame, split: str, key: str, most: int, salt: str | None = None) -> DataFrame:
    """At most ``most`` rows of each ``split``, the first in the order of :func:`number_examples`; a null split is a split."""
    order = [] if salt is None else [F.xxhash64(F.col(key), F.lit(salt))]
    n = number_rows(rows, split, *order, key, index="example")
    first = n.groupBy(F.col(split).alias("first_split")).agg(F.min("example").alias("first_example"))
    return n.join(small(first), F.col(split).eqNullSafe(F.col("first_split"))).filter(F.col("example") < F.col("first_example") + most).select(*rows.columns)


def balanced_parts(items: DataFrame, order: str, parts: int, batch: int) -> DataFrame:
    """``batch`` and ``part`` (from 0) of each item: batches of ``batch`` items in order, each in ``parts`` runs whose sizes differ by one at most."""
    n = number_rows(items, order, index="item").withColumn("batch", F.expr(f"item div {batch}"))
    return n.withColumn("part", F.ntile(parts).over(Window.partitionBy("batch").orderBy("item")) - 1)


def keep_first(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key by ``order``, in one aggregation."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*").select(*rows.columns)
