"""Mixing sources to target weights: whole copies first, then a Pareto order sample of the remainder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kelpline.runtime import materialize, small

#: Ranks are first counted in so many buckets; only the bucket in which a source's target falls is sorted.
BUCKETS = 4096


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) drawn by hash: the same for the same key and seed, wherever it is computed."""
    return (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def clean_source(source: Column) -> Column:
    return F.lower(F.trim(source))


def inclusion(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``mix_source, cut, rate, rest``: rows larger than ``cut`` are certain, the others included with ``rate`` times their size.

    The rate is the one at which the expected size of the sample is exactly what the source has ``left``; ``rest`` is what
    remains of it after the certain rows. ``cut`` is the largest size that needs no certainty; it is found in the running
    sums over a source's distinct sizes, which are as many as the largest size at most.
    """
    sizes = rows.groupBy("mix_source", "size").agg(F.count(F.lit(1)).alias("m")).join(F.broadcast(plan.select("mix_source", "left")), "mix_source")
    up = Window.partitionBy("mix_source").orderBy("size")
    s = F.col("size").cast("double")
    c = sizes.withColumns({"certain": F.sum(s * F.col("m")).over(Window.partitionBy("mix_source")) - F.sum(s * F.col("m")).over(up), "squares": F.sum(s * s * F.col("m")).over(up)})
    c = c.withColumn("rest", F.col("left") - F.col("certain")).withColumn("rate", F.col("rest") / F.col("squares"))
    fits = (F.col("rate") * F.col("size") <= 1) & (F.col("rest") >= 0)
    return c.filter(fits).groupBy("mix_source").agg(F.max(F.struct("size", "rate", "rest")).alias("x")).select("mix_source", F.col("x.size").alias("cut"), F.col("x.rate").alias("rate"), F.col("x.rest").alias("rest"))


def mix(sizes: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", size: str = "n_tokens", total: int | None = None, seed: int = 0) -> DataFrame:
    """``key, source, size, copies`` of every drawn row (``copies`` at least 1).

    ``targets``: ``source``, ``weight``, ``max_repeats``, one row per source. A source's budget is its weight of
    ``total``; by default ``total`` is the largest of which every source can give its share within its repeats. A
    source of budget/size c gives every row floor(c) whole copies, and a sample of its rows one more. Inclusion in it is
    proportional to size, with one factor per source (:func:`inclusion`); rows that it would include more than once are
    certain. The others are ranked by the odds of a uniform number over the odds of their inclusion, and taken as long as
    more than half of a row fits into the remainder of the budget, so a source misses its budget by at most half a row
    that is not certain, and large rows are not passed over more often than small ones.

    Sources are compared in lower case without outer blanks. Rows of a null or unlisted source, of null keys, or of
    null or zero size are not drawn; targets without such rows get nothing and do not bound ``total``. Null or
    negative weights and repeats count as 0. A row that is repeated in ``sizes`` is as many rows, drawn alike.
    """
    t = targets.filter(F.col("source").isNotNull()).select(clean_source(F.col("source")).alias("mix_source"), F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"), F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0)).alias("max_repeats"))
    t = t.groupBy("mix_source").agg(F.max("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"))
    rows = sizes.filter(F.col(key).isNotNull() & (F.col(size) > 0)).select(F.col(key).alias("k"), clean_source(F.col(source)).alias("mix_source"), F.col(size).cast("long").alias("size"))
    rows = materialize(rows, "sizes")
    have = rows.groupBy("mix_source").agg(F.sum("size").alias("have"), F.count("*").alias("rows"))
    plan = materialize(t.join(have, "mix_source"), "plan")  # one row per target, so it may be broadcast
    if total is None:
        total = plan.filter("weight > 0").agg(F.floor(F.min(F.col("max_repeats") * F.col("have") / F.col("weight"))).alias("t")).first()["t"] or 0
    budget = F.least(F.col("weight") * F.lit(float(total)), (F.col("max_repeats") * F.col("have")).cast("double"))
    plan = plan.withColumn("budget", budget).withColumn("whole", F.floor(F.col("budget") / F.col("have"))).withColumn("left", F.col("budget") - F.col("whole") * F.col("have"))
    plan = materialize(plan.select("mix_source", "whole", "left"), "plan")  # one row per target
    rates = materialize(plan.join(inclusion(rows, plan), "mix_source"), "rates")
    r = rows.join(small(rates), "mix_source")
    certain = r.filter(F.col("size") > F.col("cut"))
    r = r.filter(F.col("size") <= F.col("cut")).withColumn("left", F.col("rest"))
    u = uniform(F.col("k"), seed)
    p = F.least(F.greatest(F.col("rate") * F.col("size"), F.lit(1e-12)), F.lit(1 - 1e-12))
    q = u / (1 - u) * (1 - p) / p
    r = r.withColumn("q", q).withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * BUCKETS).cast("int"))
    sums = materialize(r.groupBy("mix_source", "bucket").agg(F.sum("size").alias("s")), "buckets")
    before = F.coalesce(F.sum("s").over(Window.partitionBy("mix_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = small(materialize(sums.select("mix_source", "bucket", before.alias("before"), F.col("s").alias("bucket_size")), "buckets"))
    r = r.join(at, ["mix_source", "bucket"]).withColumn("sub", F.pmod(F.floor(F.col("q") / (1 + F.col("q")) * BUCKETS * 64), F.lit(64)))
    # of the bucket in which the budget ends, 64 parts are summed alike, and only rows of the last part are sorted
    edge = (F.col("before") < F.col("left")) & (F.col("before") + F.col("bucket_size") > F.col("left"))
    r = r.withColumn("edge", edge)
    parts = r.filter("edge").groupBy("mix_source", "sub").agg(F.sum("size").alias("s"))
    ahead = F.coalesce(F.sum("s").over(Window.partitionBy("mix_source").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = small(materialize(parts.select("mix_source", "sub", ahead.alias("ahead"), F.col("s").alias("sub_size")), "parts"))
    e = r.filter("edge").join(parts, ["mix_source", "sub"]).withColumn("start", F.col("before") + F.col("ahead"))
    sort = (F.col("start") < F.col("left")) & (F.col("start") + F.col("sub_size") > F.col("left"))
    upto = F.col("start") + F.sum("size").over(Window.partitionBy("mix_source").orderBy("q", "k").rowsBetween(Window.unboundedPreceding, 0))
    cols = ["k", "mix_source", "size", "whole"]
    drawn = (
        r.filter(~F.col("edge")).select(*cols, (F.col("before") < F.col("left")).alias("more"))
        .unionByName(e.filter(~sort).select(*cols, (F.col("start") < F.col("left")).alias("more")))
        .unionByName(e.filter(sort).select(*cols, (upto - F.col("size") / 2 <= F.col("left")).alias("more")))
        .unionByName(certain.select(*cols, F.lit(True).alias("more")))
    )
    copies = (F.col("whole") + F.col("more").cast("int")).cast("int")
    return drawn.select(F.col("k").alias(key), F.col("mix_source").alias(source), F.col("size").alias(size), copies.alias("copies")).filter("copies > 0")


def mix_report(mixed: DataFrame, targets: DataFrame, source: str = "source", size: str = "n_tokens") -> DataFrame:
    """``source, weight, max_repeats, n_rows, n_copies, tokens, share, most_copies``: what each target got; zeros if nothing."""
    got = mixed.groupBy(F.col(source).alias("s")).agg(F.count("*").alias("n_rows"), F.sum("copies").alias("n_copies"), F.sum(F.col(size) * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    j = targets.filter(F.col("source").isNotNull()).join(got, clean_source(F.col("source")) == F.col("s"), "left").drop("s")
    j = j.fillna(0, ["n_rows", "n_copies", "tokens", "most_copies"])
    return j.withColumn("share", F.round(F.col("tokens") / F.sum("tokens").over(Window.partitionBy()), 6))
