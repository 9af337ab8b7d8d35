"""Splits that never part related records: connected components, then stratified assignment of whole groups.

Components come from minimum labels passed over the bipartite graph of records and entities. A first pass contracts
each entity to its smallest record, so that an entity with a third of all records is one vertex afterwards; the
contracted graph then converges in few rounds, as each round also jumps to the label of the label.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kelpline.runtime import drop_scratch, join_unique, materialize, small

#: A recording's name ends with its date and time; a number after that is a segment of the same recording.
RECORDING = r"^(.*?(?:19|20)\d{2}[-_]?\d{2}[-_]?\d{2}[-_tT ]?\d{2}[-_:]?\d{2}[-_:]?\d{2})(?:_\d+)?$"
#: Groups of at least 1/LARGE of all records, at most LARGE of them, are assigned one by one, by the counts of the labels that
#: have 1/LARGE of all records, at most LARGE of them, and of the others taken together.
LARGE = 500
#: Small groups of a stratum are dealt out in so many buckets.
BUCKETS = 1024


def recordings(source_bag: Column) -> Column:
    """The names of the recordings that a free-form value names, an array (empty for null and useless values).

    Several values are separated by ``, ; + |``. Case, outer blanks, folders, drive letters, ``metadata.yaml``, storage
    and compression suffixes, trailing slashes and segment numbers do not matter; ``episode_NNN`` names no recording.
    """
    path = lambda s: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(s)), r"\\", "/"), r"[/\s]+$", ""), r"/metadata\.ya?ml$", "")
    base = lambda s: F.substring_index(path(s), "/", -1)
    bare = lambda s: F.regexp_replace(base(s), r"(\.(db3|mcap|zstd|zst|lz4|gz|bag|ya?ml))+$", "")
    name = lambda s: F.when(bare(s).rlike(RECORDING), F.regexp_extract(bare(s), RECORDING, 1)).when(base(s) != bare(s), F.regexp_replace(bare(s), r"(?<=.)_\d+$", "")).otherwise(bare(s))
    names = F.transform(F.split(F.coalesce(source_bag, F.lit("")), r"[,;+|\n]"), name)
    useless = lambda s: s.rlike(r"^episode_?\d*$") | s.isin("", ".", "..", "-", "?", "null", "none", "nan", "n/a", "na", "unknown", "tbd", "rosbags", "bags", "data")
    return F.array_distinct(F.filter(names, lambda s: ~useless(s)))


def episode_entities(episodes: DataFrame) -> DataFrame:
    """``record, entity``: the entities of each episode - its recordings, and the episode it was cut from, if there is one."""
    e = episodes.filter("episode_index is not null")
    by_bag = e.select(F.col("episode_index").alias("record"), F.explode(recordings(F.col("source_bag"))).alias("name")).select("record", F.concat(F.lit("r/"), "name").alias("entity"))
    known = e.select(F.col("episode_index").alias("recut_of")).distinct()
    cut = e.filter("recut_of is not null").select("episode_index", "recut_of").distinct().join(known, "recut_of", "left_semi")
    links = cut.select(F.explode(F.array("episode_index", "recut_of")).alias("record"), F.concat(F.lit("e/"), F.col("recut_of").cast("string")).alias("entity"))
    return by_bag.unionByName(links).distinct()


def components(links: DataFrame, record: str = "record", entity: str = "entity", max_rounds: int = 200) -> DataFrame:
    """``record, component``: for every record with an entity, the smallest record it hangs together with.

    ``links`` may repeat and be empty; rows with a null on either side link nothing.
    """
    links = materialize(links.filter(F.col(record).isNotNull() & F.col(entity).isNotNull()).select(F.col(record).alias("record"), F.col(entity).alias("entity")).distinct(), "links")
    head = links.groupBy("entity").agg(F.min("record").alias("head"))
    heads = materialize(join_unique(links, head, "entity").select("record", "head").distinct(), "heads")
    star = materialize(heads.groupBy("record").agg(F.min("head").alias("low"), F.count("*").alias("n")), "star")
    edges = heads.join(star.filter("n > 1").select("record", "low"), "record").select("low", "head").filter("low <> head")
    edges = materialize(edges.select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("head").alias("b")), F.struct(F.col("head").alias("a"), F.col("low").alias("b")))).alias("x")).select("x.a", "x.b").distinct(), "edges")
    labels = materialize(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("label")), "labels")
    for _ in range(max_rounds):
        near = edges.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("seen"))
        step = labels.join(near, F.col("v") == F.col("a")).select("v", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("v").alias("to"), F.col("label").alias("far"))
        new = materialize(step.join(jump, F.col("label") == F.col("to")).select("v", "old", F.least("label", "far").alias("label")), "labels")
        changed = new.filter("label <> old").limit(1).count()
        drop_scratch(labels)
        labels = new.select("v", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"labels still change after {max_rounds} rounds")
    return star.join(labels, F.col("low") == F.col("v"), "left").select("record", F.coalesce("label", "low").alias("component"))


def episode_components(episodes: DataFrame) -> DataFrame:
    """``episode_index, component`` of every distinct episode; one without any entity is a component of its own."""
    found = components(episode_entities(episodes))
    all_ = episodes.filter("episode_index is not null").select("episode_index").distinct()
    return all_.join(found.withColumnRenamed("record", "episode_index"), "episode_index", "left").select("episode_index", F.coalesce("component", "episode_index").alias("component"))


def deal_groups(records: DataFrame, record: str, group: str, label: str, splits: dict[str, float]) -> DataFrame:
    """``record, group, split``: whole groups dealt out to ``splits`` (name to share, summing to 1).

    Every group goes to one split. Large groups (``LARGE`` at most) are assigned in descending size to the split where they
    least raise the summed squared deviation of the label counts from their targets. The rest are dealt out stratum by
    stratum, the stratum being a group's most frequent label, whatever the number of labels: buckets of groups in hash
    order are laid end to end from a place that the label's hash tells, and cut where the shares stand open that the large
    groups left. So a stratum of many groups comes within a bucket of its shares, and strata of one group each do not all
    fall to the largest split. A null label is a label. Records are expected to be unique; null groups are dealt out record
    by record.
    """
    names, shares = list(splits), np.array([splits[k] for k in splits])
    spark, other = records.sparkSession, "\u0000"
    r = records.select(F.col(record).alias("record"), F.coalesce(F.col(group).cast("string"), F.concat(F.lit("\u0000"), F.col(record).cast("string"))).alias("grp"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("lab"))
    cells = materialize(r.groupBy("grp", "lab").agg(F.count("*").alias("n")), "cells")
    groups = materialize(cells.groupBy("grp").agg(F.sum("n").alias("size"), F.max_by("lab", F.struct("n", "lab")).alias("stratum")), "groups")
    totals = materialize(cells.groupBy("lab").agg(F.sum("n").alias("total")), "totals")
    whole = totals.agg(F.sum("total").alias("n")).first()["n"] or 0
    large = groups.filter(F.col("size") * LARGE >= whole).select("grp")
    frequent = totals.filter(F.col("total") * LARGE >= whole)
    target_of = {x["lab"]: x["total"] for x in frequent.collect()}
    of_large = cells.join(F.broadcast(large), "grp").join(F.broadcast(frequent), "lab", "left").groupBy("grp", F.when(F.col("total").isNull(), other).otherwise(F.col("lab")).alias("lab")).agg(F.sum("n").alias("n"))
    vectors: dict[str, dict[str, int]] = {}
    for x in of_large.collect():  # at most LARGE times LARGE + 1 cells
        vectors.setdefault(x["grp"], {})[x["lab"]] = x["n"]
    target_of[other] = whole - sum(target_of.values())
    labs = {k: i for i, k in enumerate(target_of)}
    target = np.array(list(target_of.values()), float)[:, None] * shares
    got, chosen = np.zeros_like(target), {}
    weight = 1 / np.maximum(target.sum(1, keepdims=True), 1)
    for grp in sorted(vectors, key=lambda g: (-sum(vectors[g].values()), g)):
        at = np.array([labs[k] for k in vectors[grp]])
        n = np.array(list(vectors[grp].values()), float)[:, None]
        gap = got[at] - target[at]
        rise = (((gap + n) ** 2 - gap**2) * weight[at]).sum(0) + ((got.sum(0) + n.sum() - target.sum(0)) ** 2 - (got.sum(0) - target.sum(0)) ** 2) / max(whole, 1)
        s = int(np.argmin(rise))
        got[at, s] += n[:, 0]
        chosen[grp] = names[s]
    fixed = F.broadcast(spark.createDataFrame(list(chosen.items()), "grp string, split string"))
    # what each label, frequent or not, still lacks in each split
    has = [F.coalesce(F.sum(F.when(F.col("split") == k, F.col("n"))), F.lit(0)).alias(f"has_{i}") for i, k in enumerate(names)]
    lacks = totals.join(cells.join(fixed, "grp").groupBy("lab").agg(*has), "lab", "left")
    open_ = [F.greatest(F.col("total") * F.lit(float(x)) - F.coalesce(F.col(f"has_{i}"), F.lit(0)), F.lit(0.0)) for i, x in enumerate(shares)]
    all_open = sum(open_[1:], open_[0])
    ends = F.array(*[F.when(all_open > 0, sum(open_[1 : i + 1], open_[0]) / all_open).otherwise(F.lit(float(shares[: i + 1].sum()))) for i in range(len(names))])
    bounds = lacks.select(F.col("lab").alias("stratum"), ends.alias("ends"))
    rest = groups.join(fixed, "grp", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(BUCKETS)))
    sizes = rest.groupBy("stratum", "bucket").agg(F.sum("size").alias("n"))
    w = Window.partitionBy("stratum").orderBy("bucket")
    start = F.pmod(F.xxhash64(F.lit("start"), F.col("stratum")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    middle = (F.sum("n").over(w) - F.col("n") / 2) / F.sum("n").over(Window.partitionBy("stratum")) + start
    at = sizes.withColumn("middle", middle - F.floor(middle)).join(small(bounds), "stratum")
    at = at.withColumn("nr", F.least(F.size(F.filter("ends", lambda e: e <= F.col("middle"))), F.lit(len(names) - 1))).select("stratum", "bucket", "nr")
    dealt = rest.join(small(at), ["stratum", "bucket"]).select("grp", F.element_at(F.array(*map(F.lit, names)), F.col("nr") + 1).alias("split"))
    out = r.join(fixed, "grp").unionByName(r.join(fixed, "grp", "left_anti").join(dealt, "grp"))
    return out.select(F.col("record").alias(record), F.col("grp").alias(group), "split")


def split_report(assigned: DataFrame, records: DataFrame, record: str, label: str) -> DataFrame:
    """``label, split, n, share``: the share of each label's records that each split got."""
    n = assigned.join(records.select(record, label), record).groupBy(label, "split").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(label)), 6))
