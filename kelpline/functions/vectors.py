"""Column functions for fixed-length vectors: pad and cut, flatten messages, place in slices, layouts by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Slices of the state/action vector as (name, first slot, length), in order.
ARM = 7
LAYOUT = (
    ("left_arm_pos", 0, 7), ("left_gripper_pos", 7, 1), ("right_arm_pos", 8, 7), ("right_gripper_pos", 15, 1),
    ("left_arm_vel", 16, 7), ("left_gripper_vel", 23, 1), ("right_arm_vel", 24, 7), ("right_gripper_vel", 31, 1),
    ("left_arm_effort", 32, 7), ("left_gripper_effort", 39, 1), ("right_arm_effort", 40, 7), ("right_gripper_effort", 47, 1),
    ("left_ee_pose", 48, 7), ("right_ee_pose", 55, 7),
)
CHASSIS = (("chassis_pos", 0, 3), ("chassis_vel", 3, 3), ("chassis_effort", 6, 3))
WIDE = (*LAYOUT, ("chassis", 62, 9), ("lift_vel", 71, 1))


def pad(a: Column, n: int, fill: float = 0.0) -> Column:
    """The first ``n`` elements, with ``fill`` at the right if there are fewer; a null array counts as empty, null elements as ``fill``."""
    a = F.coalesce(a.cast("array<double>"), F.array().cast("array<double>"))
    cut = F.slice(a, 1, n)
    return F.transform(F.concat(cut, F.array_repeat(F.lit(float(fill)), n - F.size(cut))), lambda x: F.coalesce(x, F.lit(float(fill))))


def flatten(position: Column, velocity: Column, effort: Column, n: int) -> Column:
    """Position, velocity and effort of ``n`` joints as one float vector: n = 7 for arms, 3 for the chassis."""
    return F.concat(*[pad(x, n) for x in (position, velocity, effort)]).cast("array<float>")


def flatten_gripper(position: Column, velocity: Column, effort: Column) -> Column:
    return F.array(*[F.coalesce(F.try_element_at(x, F.lit(1)).cast("double"), F.lit(0.0)) for x in (position, velocity, effort)]).cast("array<float>")


def flatten_pose(pose: Column) -> Column:
    p, q = pose["position"], pose["orientation"]
    return F.array(*[v.cast("double") for v in (p["x"], p["y"], p["z"], q["x"], q["y"], q["z"], q["w"])]).cast("array<float>")


def assemble(left_arm: Column, left_gripper: Column, right_arm: Column, right_gripper: Column, left_pose: Column, right_pose: Column, chassis: Column | None = None, lift: Column | None = None) -> Column:
    """The 62-slot vector (72 with chassis and lift) from flattened parts; a part never seen is zeros.

    Parts: 21 for an arm, 3 for a gripper, 7 for a pose, 9 for the chassis, 1 for the lift.
    """
    la, ra = pad(left_arm, 3 * ARM), pad(right_arm, 3 * ARM)
    lg, rg = pad(left_gripper, 3), pad(right_gripper, 3)
    out = [x for i in range(3) for x in (F.slice(la, i * ARM + 1, ARM), F.slice(lg, i + 1, 1), F.slice(ra, i * ARM + 1, ARM), F.slice(rg, i + 1, 1))]
    out += [pad(left_pose, 7), pad(right_pose, 7)]
    if chassis is not None:
        out += [pad(chassis, 9), pad(lift if lift is not None else F.lit(None).cast("array<double>"), 1)]
    return F.concat(*out).cast("array<float>")


def place(vector: Column, part: Column, first: int, length: int) -> Column:
    """``vector`` with the slots from ``first`` replaced by ``part``, padded to ``length``."""
    return F.concat(F.slice(vector, 1, first), pad(part, length).cast("array<float>"), F.slice(vector, first + length + 1, 100_000))


def names(layout: tuple[tuple[str, int, int], ...] = LAYOUT) -> list[str]:
    return [f"{n}_{i}" if size > 1 else n for n, _, size in layout for i in range(size)]


def zip_shortest(**arrays: Column) -> Column:
    """An array of structs from arrays by position, as long as the shortest."""
    n = F.array_min(F.array(*[F.size(a) for a in arrays.values()]))
    return F.arrays_zip(*[F.slice(a, 1, n).alias(k) for k, a in arrays.items()])


def vector_stats(vectors, column: str, *keys: str):
    """Per slot (from 0), within ``keys``: ``min, max, mean, std`` (population) and ``count`` over all rows, nulls left out."""
    e = vectors.select(*keys, F.posexplode(column).alias("slot", "v"))
    v = F.col("v").cast("double")
    return e.groupBy(*keys, "slot").agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.count(v).alias("count"))


def stats_json(frames, columns: list[str], key: str):
    """``key, stats``: JSON of feature -> min, max, mean, std (a list of slots) and count, of the vector or number ``columns`` of each ``key``."""
    kinds = dict(frames.dtypes)
    part = lambda n: F.transform("s", lambda x: x[n])
    out = None
    for c in columns:
        s = vector_stats(frames.withColumn(c, F.col(c) if kinds[c].startswith("array") else F.array(c)), c, key)
        slots = F.array_sort(F.collect_list(F.struct("slot", "min", "max", "mean", "std", "count")))  # one entry a slot
        each = s.groupBy(key).agg(slots.alias("s")).select(key, F.lit(c).alias("feature"), F.struct(*[part(n).alias(n) for n in ("min", "max", "mean", "std")], F.array(F.array_max(part("count"))).alias("count")).alias("stat"))
        out = each if out is None else out.unionByName(each)
    return out.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "stat"))))).alias("stats"))
