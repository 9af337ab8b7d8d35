"""Queries of the training-data problems (2, 3, 4, 7, 8, 9) over the tables of a data directory, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kelpline.llm import mixture, nearest, percentiles, splits, subjects, tokens
from kelpline.runtime import materialize, read

SPLITS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    c = splits.episode_components(read(spark, d, "episodes"))
    return c.filter("component < episode_index").select(F.col("component").alias("first_episode"), "episode_index")


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """One row per episode: its component, and its dataset as it first arrived."""
    e = read(spark, d, "episodes")
    one = e.filter("episode_index is not null").groupBy("episode_index").agg(F.min_by("dataset", F.struct("ingested_at", "dataset")).alias("dataset"))
    return materialize(one.join(splits.episode_components(e), "episode_index"), "labelled")


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.deal_groups(_labelled(spark, d), "episode_index", "component", "dataset", SPLITS)


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    r = _labelled(spark, d)
    return splits.split_report(splits.deal_groups(r, "episode_index", "component", "dataset", SPLITS), r, "episode_index", "dataset")


def p2_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every group of two or more episodes, with the number of splits it lies in."""
    s = p2_splits(spark, d).groupBy(F.col("component").cast("long").alias("component")).agg(F.count("*").alias("n_episodes"), F.countDistinct("split").alias("n_splits"))
    return s.filter("n_episodes > 1")


def p2_shares(spark: SparkSession, d: str) -> DataFrame:
    """Every split, and whether its share is within 2 % of what is wanted, or within one largest group."""
    s = materialize(p2_splits(spark, d), "splits")
    n = s.count()
    most = s.groupBy("component").count().agg(F.max("count").alias("c")).first()["c"] or 0
    want = F.create_map(*[F.lit(x) for kv in SPLITS.items() for x in kv])
    return s.groupBy("split").count().select("split", want[F.col("split")].alias("wanted"), (F.abs(F.col("count") - want[F.col("split")] * n) <= max(0.02 * n, most)).alias("near"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nearest.match_packets(read(spark, d, "hdf5_frames"), read(spark, d, "packets")).select("episode_idx", "frame_index", "packet_id").distinct()


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(read(spark, d, "documents").select("doc_id", "text"))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return tokens.round_trip(read(spark, d, "documents").select("doc_id", "text"))


GROUPS = ["metric", "dataset", "robot", "month"]
#: What is usable in the tables' statistics: lengths up to this, numbers up to this size.
USABLE = {"max_length": 100_000_000, "max_size": 1e9}


def _numbers(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.episode_numbers(read(spark, d, "episodes"), read(spark, d, "episodes_stats"), **USABLE)


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Exact percentiles of each dataset, robot and month, and, with a null month, of all months."""
    return percentiles.percentiles(percentiles.with_totals(_numbers(spark, d)), GROUPS, "value")


def p4_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Exact percentiles of each metric over everything: few and large groups."""
    return percentiles.percentiles(_numbers(spark, d), ["metric"], "value", (10, 250, 500, 750, 990))


def p4_combined(spark: SparkSession, d: str) -> DataFrame:
    """The percentiles of each dataset and robot, exact, and whether the bounds from the added histograms of single months hold them."""
    numbers = materialize(_numbers(spark, d), "numbers")
    rest = ["metric", "dataset", "robot"]
    bounds = percentiles.from_histogram(percentiles.combine(percentiles.histogram(numbers, GROUPS, "value"), rest), rest)
    exact = percentiles.percentiles(numbers, rest, "value").withColumnsRenamed({"n": "n_exact", "permille": "p"})
    same = [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in rest] + [F.col("permille") == F.col("p")]
    j = bounds.join(exact.withColumnsRenamed({c: f"e_{c}" for c in rest}), same, "full")
    near = (F.col("value").between(F.col("lo"), F.col("hi"))) & (F.col("hi") - F.col("lo") <= 0.004 * F.abs("value")) & (F.col("n") == F.col("n_exact"))
    return j.select(*rest, "permille", "n", "value", F.coalesce(near, F.lit(False)).alias("holds"))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return tokens.count_tokens(read(spark, d, "documents").select("doc_id", "source", "text"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(_sizes(spark, d), read(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix_report(p8_mix(spark, d), read(spark, d, "mix_targets"))


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """Every target: whether its share is within half a largest document of its weight, and no document over its repeats."""
    sizes = materialize(_sizes(spark, d), "tokens")
    r = mixture.mix_report(mixture.mix(sizes, read(spark, d, "mix_targets")), read(spark, d, "mix_targets"))
    largest = sizes.agg(F.max("n_tokens").alias("n")).first()["n"] or 0
    near = F.abs(F.col("share") - F.col("weight")) <= F.lit(largest) / F.sum("tokens").over(Window.partitionBy()) + 1e-6
    return r.select("source", "weight", "max_repeats", near.alias("near"), (F.col("most_copies") <= F.col("max_repeats")).alias("capped"))


def _classified(spark: SparkSession, d: str):
    return subjects.classify(read(spark, d, "documents"), read(spark, d, "subject_labels"), read(spark, d, "subjects"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d)[0].select("doc_id", "subject_id")


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """Documents and characters by source and subject; a document with several subjects counts under each, one with none under null."""
    docs = read(spark, d, "documents").select("doc_id", mixture.clean_source(F.col("source")).alias("source"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    found = docs.join(_classified(spark, d)[0].select("doc_id", "subject_id"), "doc_id", "left")
    return found.groupBy("source", "subject_id").agg(F.count("*").alias("n_docs"), F.sum("chars").alias("n_chars"))


def p9_leaves(spark: SparkSession, d: str) -> DataFrame:
    """The leaves of the tree: label, purity, closest terms, and the passages of all documents in each."""
    docs = read(spark, d, "documents")
    tree = _classified(spark, d)[1]
    rows = [(i, int(s), float(m.max()), t) for i, (s, m, t) in enumerate(zip(tree.labels, tree.mixture, tree.terms))]
    leaves = spark.createDataFrame(rows, "leaf int, subject_id long, share double, terms array<string>")
    if tree.empty:
        return leaves.withColumn("n_passages", F.lit(0).cast("long"))
    held = subjects.document_leaves(docs, tree).groupBy("leaf").agg(F.sum("n").alias("n_passages"))
    return leaves.join(held, "leaf", "left").fillna(0, ["n_passages"])


QUERIES = {
    "p2_found": p2_found, "p2_splits": p2_splits, "p2_report": p2_report, "p2_whole": p2_whole, "p2_shares": p2_shares, "p3_found": p3_found, "p4_percentiles": p4_percentiles, "p4_metrics": p4_metrics, "p4_combined": p4_combined,
    "p7_ids": p7_ids, "p7_round_trip": p7_round_trip, "p8_mix": p8_mix, "p8_shares": p8_shares, "p8_kept": p8_kept, "p9_found": p9_found, "p9_composition": p9_composition, "p9_leaves": p9_leaves,
}

_NUMBERS = r"""
with e as (
  select episode_index, arg_max(struct_pack(dataset := dataset, robot := robot, length := length), (ingested_at, length, dataset, robot)) as r,
         bool_or(deleted_at is not null) as gone, min(ingested_at) as arrived
  from episodes where episode_index is not null group by 1
), live as (select episode_index, r.dataset as dataset, r.robot as robot, r.length as length, arrived from e where not gone
), s as (
  select * from (select *, row_number() over (partition by episode_index order by written_at desc, stats desc) as nr
    from episodes_stats where episode_index is not null and json_valid(stats)) where nr = 1
), f as (select episode_index, written_at, stats, unnest(json_keys(stats)) as feature from s
), g as (select episode_index, written_at, feature, json_extract(stats, '$."' || feature || '"') as o from f
), h as (select episode_index, written_at, feature, o, unnest(json_keys(o)) as stat from g
), t as (select episode_index, written_at, feature || '/' || stat as metric, unnest(string_split(regexp_replace(cast(json_extract(o, '$."' || stat || '"') as varchar), '[\[\]\s"]', '', 'g'), ',')) as x from h
), numbers as (
  select 'length' as metric, dataset, robot, strftime(arrived, '%Y-%m') as month, cast(length as double) as value from live where length between 1 and 100000000
  union all
  select metric, dataset, robot, strftime(written_at, '%Y-%m'), try_cast(x as double) from t join live using (episode_index)
  where abs(try_cast(x as double)) <= 1e9 and not isnan(try_cast(x as double))
)
"""

_REACH = r"""
with recursive name as (
  select distinct episode_index, unnest(regexp_extract_all(lower(source_bag), 'rosbag2_\d{4}_\d\d_\d\d-\d\d_\d\d_\d\d|session-\d{4}-\d\d-\d\d-\d{6}|take_\d{8}_\d{6}|xr_run\d{8}t\d{6}')) as rec from episodes
), link as (
  select distinct a.episode_index as x, b.episode_index as y from name a join name b on a.rec = b.rec
  union select episode_index, recut_of from episodes where recut_of in (select episode_index from episodes)
  union select recut_of, episode_index from episodes where recut_of in (select episode_index from episodes)
), reach as (
  select x, y from link union select r.x, l.y from reach r join link l on r.y = l.x
)
"""

ORACLE = {
    "p4_percentiles": _NUMBERS + """
, both_ as (select * from numbers union all select metric, dataset, robot, null, value from numbers),
ranked as (select *, row_number() over (partition by metric, dataset, robot, month order by value) as nr, count(*) over (partition by metric, dataset, robot, month) as n from both_)
select metric, dataset, robot, month, permille, n, value from ranked, (select unnest([500, 900, 990])::int as permille)
where nr = greatest(1, (n * permille + 999) // 1000)""",
    "p4_combined": _NUMBERS + """
, ranked as (select *, row_number() over (partition by metric, dataset, robot order by value) as nr, count(*) over (partition by metric, dataset, robot) as n from numbers)
select metric, dataset, robot, permille, n, value, true as holds from ranked, (select unnest([500, 900, 990])::int as permille)
where nr = greatest(1, (n * permille + 999) // 1000)""",
    "p4_metrics": _NUMBERS + """
, ranked as (select *, row_number() over (partition by metric order by value) as nr, count(*) over (partition by metric) as n from numbers)
select metric, permille, n, value from ranked, (select unnest([10, 250, 500, 750, 990])::int as permille) where nr = greatest(1, (n * permille + 999) // 1000)""",
    "p2_found": _REACH + """
select min(y) as first_episode, x as episode_index from reach group by x having min(y) < x""",
    "p2_whole": _REACH + """
select component, count(*) as n_episodes, 1::bigint as n_splits from (select x, min(y) as component from reach group by x) group by 1 having count(*) > 1""",
    "p2_shares": "select split, wanted, true as near from (values ('train', 0.8::double), ('validation', 0.1::double), ('test', 0.1::double)) t(split, wanted)",
    "p8_kept": "select source, weight, max_repeats, true as near, true as capped from mix_targets where source is not null",
    "p7_round_trip": "select doc_id, true as same, length(coalesce(text, ''))::int as n_chars from documents",
    "p3_found": """
with f as (
  select distinct episode_idx, frame_index, cast(round(timestamp * 1e9) as bigint) as at_ns from hdf5_frames where timestamp is not null
), p as (
  select episode_index, topic, cast(round(pts / coalesce(time_base, 1000000000) * 1e9) as bigint) as at_ns, packet_id
  from packets where pts is not null and episode_index is not null and topic is not null
)
select distinct episode_idx, frame_index, packet_id from (
  select f.episode_idx, f.frame_index, p.packet_id,
         row_number() over (partition by f.episode_idx, f.frame_index, f.at_ns, p.topic order by abs(p.at_ns - f.at_ns), p.packet_id) as nr
  from f join p on f.episode_idx = p.episode_index and abs(p.at_ns - f.at_ns) <= 15000000
) where nr = 1""",
}
