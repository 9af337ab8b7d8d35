"""Exact percentiles of very many groups by bisection, and mergeable histograms with a bounded error.

For every group and percentile an interval of values is kept that holds the target rank. A pass cuts each interval into
``fanout`` parts (2 is plain bisection), counts the rows of each and takes the part with the rank, drawn in to the
smallest and largest value that occur there. Only rows inside an interval still open are read by the next pass. Counts
of parts add up, so those of months combine to that of all. All of it is plain arithmetic in generated code.
A percentile p of n values is the one of rank ceil(p n), at least 1 (the lower one, a value that occurs).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kelpline import runtime
from kelpline.runtime import drop_scratch, materialize

#: An interval with at most so many rows is resolved by listing them.
FINISH = 256
#: The largest finite double, and what makes the logarithm of every positive double positive.
LARGEST, SHIFT = 1.7976931348623157e308, 745.0
#: Bins a unit of the logarithm that a histogram has: bins are under 0.4 % wide.
GRAIN = 256


def _log(x: Column) -> Column:
    """A measure of the same order as ``x`` that is logarithmic on either side of zero; finite for finite ``x``."""
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.ln(F.abs(x)) + SHIFT))


def _part(x: Column, lo: Column, hi: Column, fanout: int) -> Column:
    """Which part of [``lo``, ``hi``] holds ``x``, from 0 on in the order of ``x``; infinities are parts of their own.

    An interval within a factor of four is cut evenly, any other by the logarithm, so few passes reach neighbouring
    doubles. Rounding is monotone, so parts never overlap; ``lo`` and ``hi`` always come into different ones.
    """
    low, high = F.greatest(lo, F.lit(-LARGEST)), F.least(hi, F.lit(LARGEST))
    near = ((low > 0) & (high / 4 <= low)) | ((high < 0) & (low / 4 >= high))
    even = (x - low) / (high - low)
    far = (_log(x) - _log(low)) / (_log(high) - _log(low))
    part = F.least(F.floor(F.when(near, even).otherwise(far) * fanout), F.lit(fanout - 1)) + 1
    return F.when(x < low, 0).when(x > high, fanout + 1).otherwise(F.when(low < high, part).otherwise(1)).cast("int")


def _meet(rows: DataFrame, key: str, table: DataFrame, hot: DataFrame, within: Column | None = None) -> DataFrame:
    """``rows`` joined to ``table`` on ``key``, ``within`` being a further condition; hot keys by a broadcast of bounded size."""
    t = table.withColumnRenamed(key, "meet_key")
    on = F.col(key) == F.col("meet_key")
    on = on if within is None else on & within
    if runtime.fits(t):
        return rows.join(F.broadcast(t), on).drop("meet_key")
    hot = F.broadcast(hot)
    of = lambda how: t.join(hot.withColumnRenamed(key, "meet_key"), "meet_key", how)
    return rows.join(F.broadcast(of("left_semi")), on).unionByName(rows.join(hot, key, "left_anti").join(of("left_anti"), on)).drop("meet_key")


def percentiles(values: DataFrame, groups: list[str], value: str, permille: tuple[int, ...] = (500, 900, 990), fanout: int = 16) -> DataFrame:
    """``groups, permille, n, value``: exact percentiles of each group, without null and NaN values.

    Null group keys form groups; keys may be of any type that can be grouped by. Groups of any size are counted in
    partial sums; no group is gathered in one place, and one with many rows meets its intervals by broadcast.
    A group without usable values has no rows. Ties and repeated rows count each; both zeros are alike.
    """
    x = F.col(value).cast("double")
    rows = materialize(values.select(F.struct(*groups).alias("grp"), (x + F.lit(0.0)).alias("x")).filter("x is not null and not isnan(x)"), "values")
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    # groups go by a number from here on; it is written, so it stays
    first = materialize(sizes.withColumn("gid", F.monotonically_increasing_id()), "groups")
    total = first.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = first.filter((F.col("n") * runtime.HOT >= total) & (F.col("n") > FINISH))  # at most HOT groups
    keyed = materialize(_meet(rows, "grp", first.select("grp", "gid", "n"), hot.select("grp")).select("gid", "n", "x"), "values")
    drop_scratch(rows)
    hot = hot.select("gid")
    rank = F.greatest(F.lit(1).cast("long"), F.expr("(n * permille + 999) div 1000"))
    asked = F.explode(F.array(*map(F.lit, permille))).alias("permille")
    inside_ = F.col("x").between(F.col("lo"), F.col("hi"))
    small = keyed.filter(F.col("n") <= FINISH).groupBy("gid").agg(F.array_sort(F.collect_list("x")).alias("xs"), F.first("n").alias("n")).select("gid", "n", "xs", asked)
    done = [materialize(small.select("gid", "permille", F.element_at("xs", rank.cast("int")).alias("value")), "listed")]
    state = first.filter(F.col("n") > FINISH).select("gid", "n", "lo", "hi", asked).select("gid", "permille", rank.alias("rank"), "lo", "hi", F.col("n").alias("inside"))
    rows_in, old = keyed.filter(F.col("n") > FINISH).select("gid", "x"), None
    for _ in range(100):
        if not state.limit(1).count():
            break
        done.append(state.filter("lo = hi").select("gid", "permille", F.col("lo").alias("value")))
        few, many = state.filter(f"lo < hi and inside <= {FINISH}"), state.filter(f"lo < hi and inside > {FINISH}")
        listed = _meet(rows_in, "gid", few.select("gid", "lo", "hi").distinct(), hot, inside_).groupBy("gid", "lo").agg(F.array_sort(F.collect_list("x")).alias("xs"))
        done.append(materialize(few.join(listed, ["gid", "lo"]).select("gid", "permille", F.element_at("xs", F.col("rank").cast("int")).alias("value")), "listed"))
        inside = materialize(_meet(rows_in, "gid", many.select("gid", "lo", "hi").distinct(), hot, inside_), "inside")
        counts = inside.groupBy("gid", "lo", _part(F.col("x"), F.col("lo"), F.col("hi"), fanout).alias("part")).agg(F.count(F.lit(1)).alias("m"), F.min("x").alias("least"), F.max("x").alias("most"))
        parts = counts.groupBy("gid", "lo").agg(F.array_sort(F.collect_list(F.struct("part", "m", "least", "most"))).alias("parts"))  # at most fanout + 2
        zero = F.struct(F.lit(0).cast("long").alias("below"), F.lit(None).cast("double").alias("least"), F.lit(None).cast("double").alias("most"), F.lit(0).cast("long").alias("m"))
        take = lambda a, p: (
            F.when(a["least"].isNotNull(), a)
            .when(a["below"] + p["m"] >= F.col("rank"), F.struct(a["below"].alias("below"), p["least"].alias("least"), p["most"].alias("most"), p["m"].alias("m")))
            .otherwise(F.struct((a["below"] + p["m"]).alias("below"), a["least"].alias("least"), a["most"].alias("most"), a["m"].alias("m")))
        )
        j = many.join(parts, ["gid", "lo"]).withColumn("to", F.aggregate("parts", zero, take))
        state = materialize(j.select("gid", "permille", (F.col("rank") - F.col("to.below")).alias("rank"), F.col("to.least").alias("lo"), F.col("to.most").alias("hi"), F.col("to.m").alias("inside")), "state")
        if old is not None:
            drop_scratch(old)
        old, rows_in = inside, inside.select("gid", "x")
    else:
        raise RuntimeError("intervals are still open after 100 passes")
    found = reduce(DataFrame.unionByName, done).join(runtime.small(first.select("gid", "grp", "n")), "gid")
    return found.select(*[F.col(f"grp.{c}").alias(c) for c in groups], "permille", "n", "value")


def histogram(values: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``groups, bin, n``: a mergeable state of each group; states of parts are combined by adding ``n``. Null and NaN count nowhere."""
    x = F.col(value).cast("double")
    finite = F.when(x == 0, 0).otherwise((F.signum(x) * (F.floor(_log(F.abs(x)) * GRAIN) + 1)).cast("int"))
    b = F.when(F.abs(x) <= LARGEST, finite).otherwise(F.signum(x).cast("int") * (1 << 30))
    return values.withColumn("bin", F.when(~F.isnan(x), b)).filter("bin is not null").groupBy(*groups, "bin").agg(F.count("*").alias("n"))


def combine(states: DataFrame, groups: list[str]) -> DataFrame:
    return states.groupBy(*groups, "bin").agg(F.sum("n").alias("n"))


def from_histogram(states: DataFrame, groups: list[str], permille: tuple[int, ...] = (500, 900, 990)) -> DataFrame:
    """``groups, permille, n, lo, hi``: bounds that hold the exact percentile; they differ by under 0.4 % of it.

    A group has at most as many bins as all doubles, about 750,000; they are summed in order, not gathered.
    """
    w = Window.partitionBy(*groups).orderBy("bin")
    c = states.select(*groups, "bin", F.col("n").alias("m"), F.sum("n").over(w).alias("upto"), F.sum("n").over(Window.partitionBy(*groups)).alias("n"))
    c = c.withColumn("permille", F.explode(F.array(*map(F.lit, permille)))).withColumn("rank", F.greatest(F.lit(1).cast("long"), F.expr("(n * permille + 999) div 1000")))
    c = c.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("m") < F.col("rank")))
    size, sign = F.abs("bin"), F.signum("bin")
    # the logarithm's last digits must not put a value at an edge outside
    near, far = F.exp((size - 1) / F.lit(float(GRAIN)) - SHIFT) * (1 - 1e-12), F.exp(size / F.lit(float(GRAIN)) - SHIFT) * (1 + 1e-12)
    near, far = (F.when(size == 0, 0.0).when(size == 1 << 30, float("inf")).otherwise(e) for e in (near, far))
    return c.select(*groups, "permille", "n", F.when(sign < 0, -far).otherwise(near).alias("lo"), F.when(sign < 0, -near).otherwise(far).alias("hi"))


def episode_numbers(episodes: DataFrame, stats: DataFrame, max_length: float = LARGEST, max_size: float = LARGEST) -> DataFrame:
    """``metric, dataset, robot, month, value``: ``length`` and every number of ``stats`` (``feature/statistic``), long form.

    An episode counts once: its length as last delivered (and not deleted), the last of its statistics that can be
    read. Left out are lengths under 1 or over ``max_length``, broken JSON, texts that are no finite numbers and numbers
    of size over ``max_size`` (by default every finite number is kept). ``count`` may be a number or a list. The month is
    that of arrival or writing.
    """
    last = lambda df, c, *by: df.groupBy("episode_index").agg(F.max_by(c, F.struct(*by)).alias("r")).select("episode_index", "r.*")
    e = episodes.filter("episode_index is not null")
    gone = e.groupBy("episode_index").agg(F.bool_or(F.col("deleted_at").isNotNull()).alias("gone"), F.min("ingested_at").alias("arrived"))
    e = last(e, F.struct("dataset", "robot", "length"), F.col("ingested_at"), F.col("length"), F.col("dataset"), F.col("robot")).join(gone, "episode_index").filter("not gone")
    month = lambda c: F.date_format(c, "yyyy-MM")
    lengths = e.filter(F.col("length").between(1, max_length)).select(F.lit("length").alias("metric"), "dataset", "robot", month("arrived").alias("month"), F.col("length").cast("double").alias("value"))
    parsed = F.from_json("stats", "map<string,map<string,string>>")
    s = stats.filter("episode_index is not null").select("episode_index", "stats", "written_at", parsed.alias("p")).filter("p is not null")
    s = last(s, F.struct("p", "written_at"), F.col("written_at"), F.col("stats"))
    s = s.select("episode_index", "written_at", F.explode("p").alias("feature", "q")).select("episode_index", "written_at", "feature", F.explode("q").alias("stat", "text"))
    numbers = F.explode(F.split(F.regexp_replace("text", r"[\[\]\s]", ""), ","))
    s = s.select("episode_index", "written_at", F.concat_ws("/", "feature", "stat").alias("metric"), numbers.alias("x")).withColumn("value", F.col("x").try_cast("double"))
    s = s.filter(F.abs("value") <= max_size).filter(~F.isnan("value"))
    return lengths.unionByName(s.join(e.select("episode_index", "dataset", "robot"), "episode_index").select("metric", "dataset", "robot", month("written_at").alias("month"), "value"))


def with_totals(numbers: DataFrame, part: str = "month") -> DataFrame:
    """Every row twice: in its own part and, with a null ``part``, in the whole."""
    return numbers.withColumn(part, F.explode(F.array(F.col(part), F.lit(None).cast("string"))))
