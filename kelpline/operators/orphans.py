"""References that lead to no record, found with a broadcast Bloom filter of the parent keys.

The filter is a split-block one: a key's hash chooses one block of eight 32-bit words and sets one bit in each word, so
it is built by eight ``bit_or`` aggregates and read by one broadcast join, all in generated code. Keys it rejects are
definite orphans and meet no parent any more; only the others are shuffled into the exact join. Parents too many for
one filter of bounded size are split by hash into several, each read by the references of its own part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline.functions.paths import clean_path, fill, read_template
from kelpline.runtime import join_unique, materialize, small

WORDS = 8
#: The odd multipliers of the public split-block filter, one for each word, that draw its bit from the key's second hash.
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)


def _bits(key: Column) -> list[Column]:
    h = F.hash(key).cast("long").bitwiseAND(F.lit(0x7FFFFFFF))
    return [F.shiftright((h * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int") for s in SALTS]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter's non-empty blocks: ``bloom_block`` and eight words. Null keys are not entered."""
    k = F.col(key)
    ones = [F.bit_or(F.call_function("shiftleft", F.lit(1), b)).alias(f"bloom_w{i}") for i, b in enumerate(_bits(k))]
    return keys.filter(k.isNotNull()).groupBy(_block(k, blocks).alias("bloom_block")).agg(*ones)


def bloom_split(refs: DataFrame, parents: DataFrame, key: str, bits_per_key: int = 12, max_blocks: int = 1 << 20) -> DataFrame:
    """``refs`` with ``maybe``: false means that no parent has the key; true means that an exact join must tell.

    The filter has ``bits_per_key`` bits a parent row, whatever their number: beyond ``max_blocks`` blocks of 44 bytes,
    the bound of what is broadcast at once, keys are split by another hash into parts with a filter each. References
    are then written once by part, and each part is read with its own filter. Null keys get ``maybe`` false; an empty
    parent table makes all of them false.
    """
    blocks = parents.count() * bits_per_key // (32 * WORDS) + 1
    parts = -(-blocks // max_blocks)
    words = [f"bloom_w{i}" for i in range(WORDS)]
    hit = reduce(lambda a, b: a & b, [F.call_function("shiftright", F.col(w), b).bitwiseAND(F.lit(1)) == 1 for w, b in zip(words, _bits(F.col(key)))])

    def probe(r: DataFrame, p: DataFrame, n: int) -> DataFrame:
        seen = r.withColumn("bloom_block", _block(F.col(key), n)).join(F.broadcast(bloom_blocks(p, key, n)), "bloom_block", "left")
        return seen.withColumn("maybe", F.col(key).isNotNull() & F.coalesce(hit, F.lit(False))).drop("bloom_block", *words)

    if parts == 1:
        return probe(refs, parents, blocks)
    part = F.coalesce(F.pmod(F.xxhash64(F.lit("part"), F.col(key)), F.lit(parts)), F.lit(0)).cast("int")
    split = materialize(refs.withColumn("bloom_part", part), "refs", ("bloom_part",))
    each = [materialize(probe(split.filter(F.col("bloom_part") == i).drop("bloom_part"), parents.filter(part == i), -(-blocks // parts)), "part") for i in range(parts)]
    return reduce(DataFrame.unionByName, each)


def orphan_causes(refs: DataFrame, parents: DataFrame, key: str, at: str) -> DataFrame:
    """``refs`` that lead to no record, with their ``cause``.

    ``parents``: unique ``key``, ``arrived`` (timestamp) and ``gone`` (boolean). The first cause that applies: ``missing``
    (no parent), ``deleted`` (``gone``), ``late`` (``arrived`` after ``at``). References with a null key are no cases;
    a null ``at`` or ``arrived`` is never late. Keys may repeat in ``refs``; a hot key is joined by a broadcast of its parent.

    References that the filter rejects are ``missing`` at once. They are written apart from the others, which alone are
    read by the exact join.
    """
    seen = materialize(bloom_split(refs.filter(F.col(key).isNotNull()), parents, key), "seen", ("maybe",))
    never = seen.filter("not maybe").drop("maybe").withColumn("cause", F.lit("missing"))
    there = parents.select(F.col(key), F.struct("arrived", "gone").alias("orphan_parent"))
    found = join_unique(seen.filter("maybe").drop("maybe"), there, key, "left")
    arrived, gone = F.col("orphan_parent.arrived"), F.col("orphan_parent.gone")
    cause = F.when(F.col("orphan_parent").isNull(), "missing").when(gone, "deleted").when(arrived > F.col(at), "late")
    return never.unionByName(found.withColumn("cause", cause).filter("cause is not null").drop("orphan_parent"))


def _key(kind: str, *parts: Column) -> Column:
    return F.concat_ws("\u0001", F.lit(kind), *[p.cast("string") for p in parts])


def episode_references(episodes: DataFrame, stats: DataFrame, tasks: DataFrame, info: DataFrame, frames: DataFrame, packets: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All references and all parents of an episode corpus, keyed alike by kind and key.

    Rows that refer to the same key from the same episode in the same month count once, by their earliest time; this
    is combined before the shuffle, so a hot episode or source is no hot task. A null time has a null period.
    """
    month = lambda c: F.date_format(c, "yyyy-MM")
    ep = episodes.groupBy("episode_index").agg(
        F.min("ingested_at").alias("arrived"), F.coalesce(F.bool_or(F.col("deleted_at").isNotNull()), F.lit(False)).alias("gone"),
        F.min_by("dataset", F.struct(F.col("dataset").isNull(), F.col("ingested_at"), F.col("dataset"))).alias("dataset"),
    ).filter("episode_index is not null")
    tk = tasks.filter("task_index is not null").groupBy("task_index").agg(F.min("created_at").alias("arrived"), F.coalesce(F.bool_or(F.col("deleted_at").isNotNull()), F.lit(False)).alias("gone"))
    live = F.col("deleted_at").isNull()
    fl = files.filter("dataset is not null and path is not null").groupBy("dataset", clean_path(F.col("path")).alias("path")).agg(F.min(F.when(live, F.col("written_at"))).alias("arrived"), (~F.bool_or(live)).alias("gone"))
    parents = (
        ep.select(_key("e", F.col("episode_index")).alias("key"), "arrived", "gone")
        .unionByName(tk.select(_key("t", F.col("task_index")).alias("key"), "arrived", "gone"))
        .unionByName(fl.select(_key("v", F.col("dataset"), F.col("path")).alias("key"), "arrived", "gone"))
    )

    def rows(df: DataFrame, table: str, field: str, episode: str, at: str, kind: str, key: str) -> DataFrame:
        return df.select(F.lit(table).alias("src_table"), F.col(episode).alias("episode_index"), F.lit(field).alias("ref_field"), F.col(key).cast("string").alias("ref_key"), month(F.col(at)).alias("period"), F.col(at).alias("at"), _key(kind, F.col(key)).alias("key")).filter("ref_key is not null")

    per_month = lambda df, at, *keys: df.groupBy(*keys, F.trunc(F.col(at), "month").alias("m")).agg(F.min(at).alias("at")).drop("m")
    fr = per_month(frames, "written_at", "episode_idx", "task_index")
    pk = per_month(packets, "loaded_at", "episode_index")
    st = per_month(stats, "written_at", "episode_index")

    keys = F.transform(F.filter(F.map_entries("features"), lambda x: x["value"]["dtype"] == "video"), lambda x: x["key"])
    templates = info.filter("video_path is not null").select("dataset", "video_path", "chunks_size", F.explode(keys).alias("video_key")).distinct()
    templates = small(templates.select("dataset", "chunks_size", read_template(F.col("video_path"), F.col("video_key")).alias("parts")))
    video = ep.filter("not gone").join(templates, "dataset")
    video = video.withColumn("ref_key", fill(F.col("parts"), F.expr("episode_index div chunks_size"), F.col("episode_index"))).filter("ref_key is not null")
    vd = video.select(F.lit("info").alias("src_table"), "episode_index", F.lit("video_path").alias("ref_field"), "ref_key", month(F.col("arrived")).alias("period"), F.col("arrived").alias("at"), _key("v", F.col("dataset"), clean_path(F.col("ref_key"))).alias("key"))
    refs = reduce(DataFrame.unionByName, [
        rows(st, "episodes_stats", "episode_index", "episode_index", "at", "e", "episode_index"),
        rows(fr, "hdf5_frames", "episode_idx", "episode_idx", "at", "e", "episode_idx"),
        rows(pk, "packets", "episode_index", "episode_index", "at", "e", "episode_index"),
        rows(fr, "hdf5_frames", "task_index", "episode_idx", "at", "t", "task_index"),
        vd,
    ])
    return refs, parents


def find_orphans(*tables: DataFrame) -> DataFrame:
    """Distinct orphan references: ``src_table, episode_index, ref_field, ref_key, period, cause`` (see :func:`episode_references`)."""
    refs, parents = episode_references(*tables)
    return orphan_causes(refs, materialize(parents, "parents"), "key", "at").select("src_table", "episode_index", "ref_field", "ref_key", "period", "cause").distinct()


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans counted per table, field, month and cause; ``episodes`` counts the distinct referring episodes."""
    return orphans.groupBy("src_table", "ref_field", "period", "cause").agg(F.count("*").alias("n_refs"), F.countDistinct("episode_index").alias("n_episodes"))
