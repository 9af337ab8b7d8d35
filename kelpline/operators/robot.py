"""Robot models as tables: parsing, joint limits, mimic joints, the link tree and forward kinematics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions.formats import number_tuple
from kelpline.functions.rotations import compose, from_axis_angle, from_rpy, rotate, unit
from kelpline.runtime import small

_GEOMETRY = "geometry: struct<box: struct<_size: string>, sphere: struct<_radius: string>, cylinder: struct<_radius: string, _length: string>, mesh: struct<_filename: string, _scale: string>>"
_ORIGIN = "origin: struct<_xyz: string, _rpy: string>"
_MATERIAL = "material: struct<_name: string, color: struct<_rgba: string>, texture: struct<_filename: string>>"
_PART = f"struct<_name: string, {_ORIGIN}, {_GEOMETRY}, {_MATERIAL}>"
#: Schema of a robot description.
ROBOT = (
    f"_name string, link array<struct<_name: string, visual: array<{_PART}>, collision: array<{_PART}>>>, "
    f"joint array<struct<_name: string, _type: string, {_ORIGIN}, parent: struct<_link: string>, child: struct<_link: string>, axis: struct<_xyz: string>, "
    "limit: struct<_lower: string, _upper: string>, mimic: struct<_joint: string, _multiplier: string, _offset: string>>>, "
    "material array<struct<_name: string, color: struct<_rgba: string>, texture: struct<_filename: string>>>"
)
#: Components of a joint's value by its type.
VALUES = {"fixed": 0, "continuous": 1, "revolute": 1, "prismatic": 1, "planar": 3, "floating": 6}


def parse(descriptions: DataFrame, xml: str = "xml") -> DataFrame:
    """``descriptions`` with ``robot``, a struct after :data:`ROBOT`; null where the text is no XML."""
    return descriptions.withColumn("robot", F.from_xml(F.col(xml), ROBOT))


def links(parsed: DataFrame) -> DataFrame:
    """``robot, ord, link``."""
    r = parsed.select(F.col("robot._name").alias("robot"), F.posexplode("robot.link").alias("ord", "l"))
    return r.select("robot", "ord", F.col("l._name").alias("link"))


def joints(parsed: DataFrame) -> DataFrame:
    """``robot, ord, joint, type, parent, child, axis, xyz, rpy, lower, upper, mimic_joint, multiplier, offset, n_values`` with the defaults filled in.

    The axis has length 1, (1, 0, 0) by default and (0, 0, 1) for planar joints without one; limits default to 0, mimics to 1 and 0.
    """
    r = parsed.select(F.col("robot._name").alias("robot"), F.posexplode("robot.joint").alias("ord", "j"))
    kind = F.col("j._type")
    default = F.when(kind == "planar", F.array(*map(F.lit, (0.0, 0.0, 1.0)))).otherwise(F.array(*map(F.lit, (1.0, 0.0, 0.0))))
    number = lambda c, d: F.coalesce(F.col(c).try_cast("double"), F.lit(d))
    has = F.col("j.mimic._joint").isNotNull()
    return r.select(
        "robot", "ord", F.col("j._name").alias("joint"), kind.alias("type"), F.col("j.parent._link").alias("parent"), F.col("j.child._link").alias("child"),
        F.when(F.col("j.axis._xyz").isNull(), default).otherwise(unit(number_tuple(F.col("j.axis._xyz")))).alias("axis"),
        number_tuple(F.col("j.origin._xyz")).alias("xyz"), number_tuple(F.col("j.origin._rpy")).alias("rpy"), number("j.limit._lower", 0.0).alias("lower"), number("j.limit._upper", 0.0).alias("upper"),
        F.col("j.mimic._joint").alias("mimic_joint"), F.when(has, number("j.mimic._multiplier", 1.0)).alias("multiplier"), F.when(has, number("j.mimic._offset", 0.0)).alias("offset"),
        F.coalesce(*[F.when(kind == k, n) for k, n in VALUES.items()], F.lit(0)).alias("n_values"),
    )


def shapes(parsed: DataFrame) -> DataFrame:
    """Visuals and collisions: ``robot, link, role, ord, name, shape, size, radius, length, filename, scale, xyz, rpy, rgba, texture``.

    A material given by name only is looked up in the robot's; one given inline wins. Without any the colour is null.
    """
    r = parsed.select(F.col("robot._name").alias("robot"), F.coalesce("robot.material", F.array()).alias("ms"), F.explode("robot.link").alias("l"))
    tagged = lambda c: F.transform(F.coalesce(F.col(f"l.{c}"), F.array()), lambda p: F.struct(F.lit(c).alias("role"), p.alias("p")))
    both = F.concat(tagged("visual"), tagged("collision"))
    r = r.select("robot", "ms", F.col("l._name").alias("link"), F.posexplode(both).alias("ord", "x"))
    g, m = "x.p.geometry", F.col("x.p.material")
    known = F.try_element_at(F.filter("ms", lambda k: k["_name"] == F.col("x.p.material._name")), F.lit(-1))
    shape = F.coalesce(*[F.when(F.col(f"{g}.{k}").isNotNull(), k) for k in ("box", "sphere", "cylinder", "mesh")])
    num = lambda *cs: F.coalesce(*[F.col(c).try_cast("double") for c in cs])
    return r.select(
        "robot", "link", F.col("x.role").alias("role"), "ord", F.col("x.p._name").alias("name"), shape.alias("shape"), F.when(shape == "box", number_tuple(F.col(f"{g}.box._size"))).alias("size"),
        num(f"{g}.sphere._radius", f"{g}.cylinder._radius").alias("radius"), num(f"{g}.cylinder._length").alias("length"), F.col(f"{g}.mesh._filename").alias("filename"),
        F.when(F.col(f"{g}.mesh._scale").isNotNull(), number_tuple(F.col(f"{g}.mesh._scale"))).alias("scale"), number_tuple(F.col("x.p.origin._xyz")).alias("xyz"), number_tuple(F.col("x.p.origin._rpy")).alias("rpy"),
        number_or_null(F.coalesce(m["color"]["_rgba"], known["color"]["_rgba"])).alias("rgba"), F.coalesce(m["texture"]["_filename"], known["texture"]["_filename"]).alias("texture"),
    )


def number_or_null(text: Column) -> Column:
    return F.when(text.isNotNull(), number_tuple(text))


def root_links(links_: DataFrame, joints_: DataFrame) -> DataFrame:
    """Links that are no joint's child."""
    return links_.join(joints_.select("robot", F.col("child").alias("link")), ["robot", "link"], "left_anti")


def clamp(value: Column, kind: Column, lower: Column, upper: Column, ignore_limits: bool = False) -> Column:
    """Revolute and prismatic values within their limits; the lower limit wins where the limits cross."""
    return value if ignore_limits else F.when(kind.isin("revolute", "prismatic"), F.greatest(lower, F.least(upper, value))).otherwise(value)


def _recursive(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """A recursive query over temporary views of unique names."""
    names = {k: f"{k}_{uuid.uuid4().hex[:12]}" for k in views}
    for k, df in views.items():
        df.createOrReplaceTempView(names[k])
    return spark.sql(sql.format(**names))


def mimic_cycles(joints_: DataFrame) -> DataFrame:
    """``robot, joint`` of every joint that mimics itself through others."""
    return _recursive(joints_.sparkSession, """
        with recursive chain(robot, joint, at, path) as (
          select robot, joint, mimic_joint, array(joint) from {j} where mimic_joint is not null
          union all
          select c.robot, c.joint, j.mimic_joint, array_append(c.path, c.at)
          from chain c join {j} j on c.robot = j.robot and c.at = j.joint
          where j.mimic_joint is not null and not array_contains(c.path, c.at)
        ) select distinct robot, joint from chain where at = joint""", j=joints_.select("robot", "joint", "mimic_joint"))  # fmt: skip


def require_no_cycles(joints_: DataFrame) -> DataFrame:
    """``joints_``, failing when it is read if joints mimic each other in a circle."""
    bad = small(mimic_cycles(joints_).withColumn("in_cycle", F.lit(True)))
    ok = F.when(F.col("in_cycle").isNull(), True).otherwise(F.raise_error(F.lit("mimic joints form a cycle")).cast("boolean"))
    return joints_.join(bad, ["robot", "joint"], "left").filter(ok).drop("in_cycle")


def set_values(joints_: DataFrame, requests: DataFrame, current: DataFrame | None = None, ignore_limits: bool = False) -> DataFrame:
    """``robot, joint, requested, value, changed`` of one-value joints after ``requests`` (``robot, joint, value``).

    A joint passes the value asked of it, before its own limits, on to the joints that mimic it: times multiplier plus
    offset, where a null passes on the offset. Each clamps by its own limits. A null request changes nothing, nor does
    a fixed joint. Chains of any length are followed; each joint once. ``current`` (``robot, joint, value``) defaults to zeros. Of several requests that reach a joint the
    one over the most steps holds.
    """
    j = joints_.select("robot", "joint", "type", "lower", "upper", "mimic_joint", "multiplier", "offset")
    asked = _recursive(joints_.sparkSession, """
        with recursive asked(robot, joint, requested, path) as (
          select r.robot, r.joint, cast(r.value as double), array(r.joint) from {r} r
          union all
          select j.robot, j.joint, coalesce(a.requested * j.multiplier, 0D) + j.offset, array_append(a.path, j.joint)
          from asked a join {j} j on a.robot = j.robot and a.joint = j.mimic_joint where not array_contains(a.path, j.joint)
        ) select robot, joint, max_by(requested, size(path)) as requested from asked group by robot, joint""", r=requests.select("robot", "joint", "value"), j=j)  # fmt: skip
    out = j.join(asked, ["robot", "joint"])
    now = F.lit(0.0)
    if current is not None:
        out = out.join(current.select("robot", "joint", F.col("value").alias("before")), ["robot", "joint"], "left")
        now = F.coalesce("before", now)
    moved = F.col("requested").isNotNull() & (F.col("type") != "fixed")
    value = F.when(moved, clamp(F.col("requested"), F.col("type"), F.col("lower"), F.col("upper"), ignore_limits)).otherwise(now)
    return out.select("robot", "joint", "requested", value.alias("value"), (value != now).alias("changed"))


def reapply(joints_: DataFrame, current: DataFrame, ignore_limits: bool = False) -> DataFrame:
    """Values after limits are switched on or off: ``current`` (``robot, joint, value``) asked for again; ``changed`` where it moves."""
    own = joints_.withColumns({"mimic_joint": F.lit(None).cast("string")})
    return set_values(own, current, current, ignore_limits)


def clone(source: str, target: str, *tables: DataFrame) -> tuple[DataFrame, ...]:
    """Copies of a robot's tables under another name. Mimic joints follow the copy's masters, as tables refer by name within a robot.

    A mimic joint whose master the robot lacks mimics nothing in the copy.
    """
    out = []
    for t in tables:
        c = t.filter(F.col("robot") == source).withColumn("robot", F.lit(target))
        if "mimic_joint" in t.columns:
            known = c.select(F.col("joint").alias("clone_joint")).distinct()
            c = c.join(small(known), F.col("mimic_joint") == F.col("clone_joint"), "left").withColumn("mimic_joint", F.col("clone_joint")).drop("clone_joint")
        out.append(c)
    return tuple(out)


def merge_values(current: Column, values: Column) -> Column:
    """Value of a planar or floating joint after a request: null components keep what was."""
    return F.zip_with(current, values, lambda a, b: F.coalesce(b, a))


def tree(links_: DataFrame, joints_: DataFrame) -> DataFrame:
    """``robot, link, depth, path``: every link below a root, with the joints that lead to it in order."""
    return _recursive(joints_.sparkSession, """
        with recursive walk(robot, link, depth, path) as (
          select robot, link, 0, cast(array() as array<string>) from {roots}
          union all
          select j.robot, j.child, w.depth + 1, array_append(w.path, j.joint) from walk w join {j} j on w.robot = j.robot and w.link = j.parent
        ) select * from walk""", roots=root_links(links_, joints_), j=joints_.select("robot", "joint", "parent", "child"))  # fmt: skip


def movable_ancestor(links_: DataFrame, joints_: DataFrame) -> DataFrame:
    """``robot, link, joint``: the nearest joint above each link that is not fixed, null if there is none."""
    up = tree(links_, joints_).select("robot", "link", F.posexplode_outer("path").alias("step", "joint"))
    kinds = joints_.select("robot", "joint", "type")
    step = up.join(kinds, ["robot", "joint"], "left")
    return step.groupBy("robot", "link").agg(F.max_by("joint", F.when(F.col("type") != "fixed", F.col("step"))).alias("joint"))


def rigid_group(links_: DataFrame, joints_: DataFrame) -> DataFrame:
    """``robot, joint, link``: the links that move with each movable joint, down to the next movable joint."""
    return movable_ancestor(links_, joints_).filter("joint is not null").select("robot", "joint", "link")


def poses(links_: DataFrame, joints_: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """Forward kinematics: ``robot, link, pos, rot`` of each link in its root's frame, for ``values`` (``robot, joint, value``; else 0)."""
    j = joints_.select("robot", "joint", "type", "axis", "xyz", from_rpy(F.col("rpy")).alias("rot0"))
    v = F.lit(0.0)
    if values is not None:
        j = j.join(values.select("robot", "joint", "value"), ["robot", "joint"], "left")
        v = F.coalesce("value", v)
    j = j.withColumn("v", v)
    turned = compose(F.col("xyz"), F.col("rot0"), F.array(*[F.lit(0.0)] * 3), from_axis_angle(F.col("axis"), F.col("v")))
    slid = F.struct(F.zip_with("xyz", rotate(F.col("rot0"), F.transform("axis", lambda a: a * F.col("v"))), lambda a, b: a + b).alias("pos"), F.col("rot0").alias("rot"))
    still = F.struct(F.col("xyz").alias("pos"), F.col("rot0").alias("rot"))
    j = j.select("robot", "joint", F.when(F.col("type").isin("revolute", "continuous"), turned).when(F.col("type") == "prismatic", slid).otherwise(still).alias("m"))
    steps = tree(links_, joints_).select("robot", "link", F.posexplode_outer("path").alias("step", "joint")).join(j, ["robot", "joint"], "left")
    ordered = steps.groupBy("robot", "link").agg(F.array_sort(F.collect_list(F.when(F.col("m").isNotNull(), F.struct("step", "m")))).alias("ms"))
    start = F.struct(F.array(*[F.lit(0.0)] * 3).alias("pos"), F.array(*map(F.lit, (0.0, 0.0, 0.0, 1.0))).alias("rot"))
    p = ordered.select("robot", "link", F.aggregate("ms", start, lambda a, s: compose(a["pos"], a["rot"], s["m"]["pos"], s["m"]["rot"])).alias("p"))
    return p.select("robot", "link", "p.pos", "p.rot")


def frames_by_name(links_: DataFrame, joints_: DataFrame, shapes_: DataFrame) -> DataFrame:
    """``robot, frame, role``: what a name stands for; joints come before links, visuals and collisions of the same name."""
    rank = {"joint": 0, "link": 1, "visual": 2, "collision": 3}
    named = joints_.select("robot", F.col("joint").alias("frame"), F.lit("joint").alias("role")).unionByName(links_.select("robot", F.col("link").alias("frame"), F.lit("link").alias("role"))).unionByName(shapes_.select("robot", F.col("name").alias("frame"), "role"))
    order = F.coalesce(*[F.when(F.col("role") == k, v) for k, v in rank.items()])
    return named.filter("frame is not null").groupBy("robot", "frame").agg(F.min_by("role", order).alias("role"))


def joint_values(joints_: DataFrame, scalars: DataFrame, arrays: DataFrame | None = None) -> DataFrame:
    """``robot, joint, values``: every joint's value as an array of ``n_values``, zeros where none is given.

    ``scalars``: ``robot, joint, value``; ``arrays``: ``robot, joint, value`` with an array, for planar and floating joints.
    """
    j = joints_.select("robot", "joint", "n_values").join(scalars.select("robot", "joint", F.array("value").alias("one")), ["robot", "joint"], "left")
    given = F.when(F.col("n_values") == 1, F.col("one"))
    if arrays is not None:
        j = j.join(arrays.select("robot", "joint", F.col("value").cast("array<double>").alias("many")), ["robot", "joint"], "left")
        given = F.coalesce(given, F.when(F.size("many") == F.col("n_values"), F.col("many")))
    return j.select("robot", "joint", F.coalesce(given, F.array_repeat(F.lit(0.0), F.col("n_values").cast("int"))).alias("values"))


def values_json(values: DataFrame) -> DataFrame:
    """``robot, joint_values``: JSON of all joints by name, a number for joints with one value, else a list."""
    text = F.when(F.size("values") == 1, F.to_json(F.col("values")).substr(F.lit(2), F.length(F.to_json("values")) - 2)).otherwise(F.to_json("values"))
    entry = F.concat(F.to_json(F.array("joint")).substr(F.lit(2), F.length(F.to_json(F.array("joint"))) - 2), F.lit(": "), text)
    return values.groupBy("robot").agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ", "), F.lit("}")).alias("joint_values"))


def state_joints(frames: DataFrame, joints_: DataFrame, state: str = "state", first: tuple[str, ...] = ("l_joint", "r_joint"), per_side: int = 8) -> DataFrame:
    """Long form of the first slots of ``state``: the joints ``l_joint1``.. and ``r_joint1``.. in order, with their limits."""
    order = F.array(*[F.lit(f"{p}{i}") for p in first for i in range(1, per_side + 1)])
    e = frames.select("episode_idx", "frame_index", F.posexplode(F.slice(state, 1, per_side * len(first))).alias("slot", "value")).withColumn("joint", F.element_at(order, F.col("slot") + 1))
    return e.join(small(joints_.select("joint", "lower", "upper")), "joint", "left")
