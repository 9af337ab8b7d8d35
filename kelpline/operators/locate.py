"""Where the files of an episode lie: candidates by falling priority, then a search by name.

``stored`` has ``dataset`` and ``path`` (from the dataset's root, in any spelling) of every file that exists. Paths are
met by equality joins, of a few candidates an episode; files found by no candidate are searched by the number in their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.functions.paths import base_name, clean_path, fill_template, parent, zero_pad
from kelpline.runtime import small

#: Digits of an episode's number in a file name.
DIGITS = 6


def _first(wanted: DataFrame, stored: DataFrame, keys: list[str], paths: list[Column], found_by: DataFrame) -> DataFrame:
    """``wanted`` with ``path`` and ``how``: the first candidate that exists, else the least path that the search found, else null."""
    tries = wanted.select(*keys, F.posexplode(F.array(*paths)).alias("how", "path")).filter("path is not null")
    hits = tries.join(stored, ["dataset", "path"]).select(*keys, "how", "path").unionByName(found_by.select(*keys, F.lit(len(paths)).alias("how"), "path"))
    best = hits.groupBy(*keys).agg(F.min(F.struct("how", "path")).alias("best"))
    return wanted.join(best, keys, "left").withColumns({"path": F.col("best.path"), "how": F.col("best.how")}).drop("best")


def _stored(stored: DataFrame) -> DataFrame:
    return stored.filter("dataset is not null and path is not null").select("dataset", clean_path(F.col("path")).alias("path")).distinct()


def parquet_files(episodes: DataFrame, info: DataFrame, stored: DataFrame) -> DataFrame:
    """``dataset, episode_index`` with ``path`` and ``how`` (0 to 3, null if there is none).

    In this order: ``data/chunk-CCC/``, ``parquet/``, ``data/``, and then wherever a file of the episode's name lies.
    """
    e = episodes.select("dataset", "episode_index").filter("dataset is not null and episode_index is not null").distinct()
    e = e.join(small(info.filter("dataset is not null").groupBy("dataset").agg(F.max("chunks_size").alias("chunks_size"))), "dataset")
    name = F.concat(F.lit("episode_"), zero_pad(F.col("episode_index"), DIGITS), F.lit(".parquet"))
    chunk = F.concat(F.lit("data/chunk-"), zero_pad(F.expr("episode_index div chunks_size"), 3), F.lit("/"), name)
    have = _stored(stored)
    found = e.withColumn("name", name).join(have.withColumn("name", base_name(F.col("path"))), ["dataset", "name"])
    return _first(e, have, ["dataset", "episode_index"], [chunk, F.concat(F.lit("parquet/"), name), F.concat(F.lit("data/"), name)], found).drop("chunks_size")


def video_files(episodes: DataFrame, templates: DataFrame, stored: DataFrame) -> DataFrame:
    """``dataset, episode_index, video_key`` with ``path`` and ``how`` (0 to 4, null if there is none).

    ``templates``: ``dataset, video_path, video_key, chunks_size``. In this order: the template; the template with chunk 0;
    ``videos/chunk-CCC/KEY/episode_N.mp4`` with the plain number and with six digits; and then any ``.mp4`` below
    ``videos`` with the key among its folders and the six digits in its name.
    """
    e = episodes.select("dataset", "episode_index").filter("dataset is not null and episode_index is not null").distinct()
    e = e.join(small(templates.select("dataset", "video_path", "video_key", "chunks_size").distinct()), "dataset")
    chunk, index, key = F.expr("episode_index div chunks_size"), F.col("episode_index"), F.col("video_key")
    spell = lambda c: fill_template(F.col("video_path"), c, index, key)
    folder = F.concat(F.lit("videos/chunk-"), zero_pad(chunk, 3), F.lit("/"), key, F.lit("/episode_"))
    plain = [F.concat(folder, n, F.lit(".mp4")) for n in (index.cast("string"), zero_pad(index, DIGITS))]
    have = _stored(stored)
    windows = F.array_distinct(F.regexp_extract_all(base_name(F.col("path")), F.lit(rf"(?=(\d{{{DIGITS}}}))"), F.lit(1)))
    named = have.filter(F.col("path").startswith("videos/") & F.col("path").endswith(".mp4")).select("dataset", "path", F.explode(windows).alias("digits"), F.split(parent(F.col("path")), "/").alias("folders"))
    keys = ["dataset", "episode_index", "video_key"]
    found = e.withColumn("digits", zero_pad(index, DIGITS)).join(named, ["dataset", "digits"]).filter(F.array_contains("folders", key))
    return _first(e, have, keys, [spell(chunk), spell(F.lit(0)), *plain], found).drop("video_path", "chunks_size")
