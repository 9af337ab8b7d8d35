"""Global order without a global task: dense numbers and prefix sums by range partitions, and forward fill by blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kelpline.runtime import materialize


def number_rows(df: DataFrame, *order: str | Column, index: str = "row_index", sums: dict[str, str] | None = None, start: int = 0) -> DataFrame:
    """``df`` with ``index`` (dense, from ``start``, in ``order``) and, for each ``name: column`` of ``sums``, the sum of all rows before.

    Rows are range-partitioned; only one row a partition, its count and sums, is ordered globally. Nulls come first
    and count as 0 in sums. The order should be total; equal rows are numbered arbitrarily but each once.
    """
    sums = sums or {}
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("range_id", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    within = Window.partitionBy("range_id").orderBy(*cols)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    heads = ranged.groupBy("range_id").agg(F.count("*").alias("range_n"), *[F.sum(c).alias(f"range_sum_{n}") for n, c in sums.items()])
    ahead = Window.partitionBy().orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("range_id", F.coalesce(F.sum("range_n").over(ahead), zero).alias("range_n"), *[F.coalesce(F.sum(f"range_sum_{n}").over(ahead), zero).alias(f"range_sum_{n}") for n in sums])
    out = ranged.join(F.broadcast(heads), "range_id")
    out = out.withColumns({index: (F.row_number().over(within) - 1 + F.col("range_n") + start).cast("long")} | {n: F.coalesce(F.sum(c).over(before), zero) + F.col(f"range_sum_{n}") for n, c in sums.items()})
    return out.drop("range_id", "range_n", *[f"range_sum_{n}" for n in sums])


#: What a scan is spread by.
_BLOCK = ("scan_key", "scan_block")


def _blocked(df: DataFrame, keys: list[str], block: Column) -> DataFrame:
    """``df`` with ``scan_key`` and ``scan_block``, neither ever null: what the work of a scan is spread by."""
    return df.withColumns({"scan_key": F.struct(*keys), "scan_block": F.coalesce(block.cast("long"), F.lit(-(1 << 62)))})


def _carry(totals: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``scan_key, scan_block`` and what ``values`` (over the window of all earlier blocks, one row each) carry into a block."""
    return totals.select("scan_key", "scan_block", *[v.alias(n) for n, v in values.items()])


def _earlier():
    return Window.partitionBy("scan_key").orderBy("scan_block").rowsBetween(Window.unboundedPreceding, -1)


def _after_carry(b: DataFrame, carried: DataFrame, order: list[str]) -> tuple[DataFrame, object]:
    """Rows and, ahead of those of each block, the row carried into it; and the window over both."""
    both = b.withColumn("scan_side", F.lit(1)).unionByName(carried.withColumn("scan_side", F.lit(0)), allowMissingColumns=True)
    return both, Window.partitionBy(*_BLOCK).orderBy("scan_side", *order)


def fill_forward(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], block: Column | None = None) -> DataFrame:
    """``df`` with ``values``: for each name the latest non-null value of its column at or before the row, within ``keys``.

    With ``block``, a coarse ascending function of the order (a time bucket, say), the work of a key is spread over its
    blocks: only the last value of each block is carried over the blocks, as one more row ahead of the block's, so a key
    with a third of all rows is no single task and rows are shuffled once. Without it one key is one task.
    """
    if block is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.last(c, ignorenulls=True).over(w) for n, c in values.items()})
    b = _blocked(df, keys, block).withColumns({f"fill_{n}": c for n, c in values.items()})
    latest = b.groupBy(*_BLOCK).agg(*[F.max_by(F.col(f"fill_{n}"), F.when(F.col(f"fill_{n}").isNotNull(), F.struct(*order))).alias(f"fill_{n}") for n in values])
    carried = _carry(latest, {f"fill_{n}": F.last(f"fill_{n}", ignorenulls=True).over(_earlier()) for n in values})
    both, w = _after_carry(b, carried.filter(reduce(lambda a, c: a | c, [F.col(f"fill_{n}").isNotNull() for n in values])), order)
    w = w.rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumns({n: F.last(f"fill_{n}", ignorenulls=True).over(w) for n in values})
    return out.filter("scan_side = 1").drop("scan_side", *_BLOCK, *[f"fill_{n}" for n in values])


def previous(df: DataFrame, keys: list[str], order: list[str], columns: list[str], block: Column, out: str = "previous") -> DataFrame:
    """``df`` with ``out``: ``columns`` of the row before, within ``keys``, as a struct; null for a key's first row. Work is spread by blocks."""
    b = _blocked(df, keys, block).withColumn(out, F.struct(*columns))
    latest = b.groupBy(*_BLOCK).agg(F.max_by(out, F.struct(*order)).alias(out))
    both, w = _after_carry(b, _carry(latest, {out: F.last(out, ignorenulls=True).over(_earlier())}), order)
    return both.withColumn(out, F.lag(out).over(w)).filter("scan_side = 1").drop("scan_side", *_BLOCK)


def number_within(df: DataFrame, keys: list[str], order: list[str], block: Column, index: str) -> DataFrame:
    """``df`` with ``index``: its number from 1 within ``keys``, in a total ``order``. Work is spread by blocks."""
    b = _blocked(df, keys, block).withColumn("scan_nr", F.row_number().over(Window.partitionBy(*_BLOCK).orderBy(*order)))
    totals = b.groupBy(*_BLOCK).agg(F.max("scan_nr").alias("n"))
    carried = _carry(totals, {"scan_n": F.coalesce(F.sum("n").over(_earlier()), F.lit(0))})
    j = b.join(carried, list(_BLOCK))  # the rows stay where they are
    return j.withColumn(index, (F.col("scan_nr") + F.col("scan_n")).cast("long")).drop("scan_nr", "scan_n", *_BLOCK)


def changes(df: DataFrame, keys: list[str], order: list[str], column: str, block: Column, before: str = "before") -> DataFrame:
    """Rows whose ``column`` differs from that of the row before in their key (nulls are alike), with ``before``; a key's first row is a change."""
    p = previous(df, keys, order, [column], block, "scan_previous")
    out = p.filter(F.col("scan_previous").isNull() | ~F.col(column).eqNullSafe(F.col(f"scan_previous.{column}")))
    return out.withColumn(before, F.col(f"scan_previous.{column}")).drop("scan_previous")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, take: list[str], tie: str | None = None, block: Column | None = None) -> DataFrame:
    """``left`` with ``take`` (prefixed ``asof_``) of the latest ``right`` row at or before ``at`` of the same ``keys``.

    Both sides are merged by time and filled forward - one shuffle and no row pairs. Right rows of the same time
    come before left rows; among them the one with the largest ``tie`` is taken. Without such a row the values are
    null. ``block`` (over the columns ``keys`` and ``at``) splits hot keys, as in :func:`fill_forward`.
    """
    side = F.struct(*take)
    l = left.select(F.struct(*left.columns).alias("asof_row"), *keys, at, F.lit(1).alias("asof_side"), F.lit(None).cast("string").alias("asof_tie"))
    r = right.select(side.alias("asof_value"), *keys, at, F.lit(0).alias("asof_side"), (F.lpad(F.col(tie).cast("string"), 20, "0") if tie else F.lit(None).cast("string")).alias("asof_tie"))
    both = l.unionByName(r, allowMissingColumns=True)
    filled = fill_forward(both, keys, [at, "asof_side", "asof_tie"], {"asof_found": F.col("asof_value")}, block)
    return filled.filter("asof_side = 1").select("asof_row.*", *[F.col(f"asof_found.{c}").alias(f"asof_{c}") for c in take])
