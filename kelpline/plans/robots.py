"""Queries of robot models, over one small description and the reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions import formats, rotations
from kelpline.operators import robot
from kelpline.runtime import read

#: A two-armed model of our own: a fixed body, a revolute chain with mimic joints, a slide and a wheel.
MODEL = """<robot name="demo">
<material name="grey"><color rgba="0.5 0.5 0.5 1"/></material>
<link name="base"><visual name="hull"><origin xyz="0 0 0.1"/><geometry><box size="0.4 0.3 0.2"/></geometry><material name="grey"/></visual></link>
<link name="body"/><link name="upper"><collision><geometry><cylinder radius="0.05" length="0.3"/></geometry></collision></link>
<link name="lower"/><link name="hand"/><link name="finger2"/><link name="finger10"/><link name="rail"/><link name="wheel"><visual><geometry><sphere radius="0.1"/></geometry></visual></link>
<joint name="body_fixed" type="fixed"><parent link="base"/><child link="body"/><origin xyz="0 0 0.5" rpy="0 0 1.5707963267948966"/></joint>
<joint name="joint1" type="revolute"><parent link="body"/><child link="upper"/><origin xyz="0.2 0 0"/><axis xyz="0 0 2"/><limit lower="-1.8" upper="1.8"/></joint>
<joint name="joint2" type="revolute"><parent link="upper"/><child link="lower"/><origin xyz="0.3 0 0"/><axis xyz="0 1 0"/><limit lower="0.25" upper="1.9"/></joint>
<joint name="joint10" type="continuous"><parent link="lower"/><child link="hand"/><origin xyz="0.25 0 0"/><limit lower="-1" upper="1"/></joint>
<joint name="finger_2" type="prismatic"><parent link="hand"/><child link="finger2"/><axis xyz="0 1 0"/><limit lower="0" upper="0.04"/></joint>
<joint name="finger_10" type="prismatic"><parent link="hand"/><child link="finger10"/><axis xyz="0 1 0"/><limit lower="-0.04" upper="0"/><mimic joint="finger_2" multiplier="-1"/></joint>
<joint name="slide" type="planar"><parent link="base"/><child link="rail"/></joint>
<joint name="wheel" type="continuous"><parent link="rail"/><child link="wheel"/><mimic joint="finger_10" multiplier="23" offset="-5"/></joint>
</robot>"""
#: Values asked of its joints.
ASKED = [("joint1", 2.5), ("joint2", 0.1), ("joint10", 1.5), ("finger_2", 0.1), ("body_fixed", 1.0)]
#: Mimic joints in a circle, and beside it.
CIRCLE = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", None)]


def _model(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = robot.parse(spark.createDataFrame([(MODEL,)], "xml string"))
    return p, robot.links(p), robot.joints(p)


def _asked(spark):
    return spark.createDataFrame([("demo", j, v) for j, v in ASKED], "robot string, joint string, value double")


def joint_defaults(spark, d):
    return _model(spark)[2].select("joint", "type", "parent", "child", "axis", "lower", "upper", "mimic_joint", "multiplier", "offset", F.col("n_values").cast("int").alias("n_values"))


def joint_clamp(spark, d):
    """State readings of the first joint held within its limits."""
    f = read(spark, d, "hdf5_frames").select("episode_idx", "frame_index", F.try_element_at("state", F.lit(2)).cast("double").alias("v")).distinct()
    return f.filter("v is not null and not isnan(v)").withColumn("clamped", robot.clamp(F.col("v"), F.lit("revolute"), F.lit(-0.25), F.lit(0.5)))


def mimic_propagate(spark, d):
    _, _, j = _model(spark)
    return robot.set_values(robot.require_no_cycles(j), _asked(spark)).select("joint", F.round("requested", 9).alias("requested"), F.round("value", 9).alias("value"), "changed")


def mimic_cycle(spark, d):
    j = spark.createDataFrame([("r", *x) for x in CIRCLE], "robot string, joint string, mimic_joint string")
    return robot.mimic_cycles(j)


def root_links(spark, d):
    _, l, j = _model(spark)
    return robot.root_links(l, j).select("link")


def tree_depth(spark, d):
    _, l, j = _model(spark)
    return robot.tree(l, j).select("link", "depth", F.array_join("path", "/").alias("path"))


def movable_ancestor(spark, d):
    _, l, j = _model(spark)
    return robot.movable_ancestor(l, j).select("link", "joint")


def link_poses(spark, d):
    _, l, j = _model(spark)
    v = robot.set_values(j, _asked(spark)).select("robot", "joint", "value")
    p = robot.poses(l, j, v)
    return p.select("link", *[(F.round(F.col("pos")[i], 6) + 0.0).alias(c) for i, c in enumerate("xyz")], F.round(F.abs(F.col("rot")[3]), 6).alias("w"))


def model_shapes(spark, d):
    return robot.shapes(_model(spark)[0]).select("link", "role", "name", "shape", "size", "radius", "length", "rgba", "xyz")


def _values(spark):
    _, _, j = _model(spark)
    return robot.set_values(j, _asked(spark)).select("robot", "joint", "value")


def joint_values(spark, d):
    _, _, j = _model(spark)
    many = spark.createDataFrame([("demo", "slide", [1.0, None, 3.0])], "robot string, joint string, value array<double>")
    many = many.withColumn("value", robot.merge_values(F.array(*map(F.lit, (7.0, 8.0, 9.0))), F.col("value")))
    return robot.joint_values(j, _values(spark), many).select("joint", "values")


def limits_again(spark, d):
    """Values set without limits, and again with them."""
    _, _, j = _model(spark)
    free = robot.set_values(j, _asked(spark), ignore_limits=True)
    return robot.reapply(j, free.select("robot", "joint", "value")).select("joint", F.round("requested", 9).alias("free"), F.round("value", 9).alias("held"), "changed")


def cloned_values(spark, d):
    """A copy of the model answers to its own requests."""
    _, l, j = _model(spark)
    l2, j2 = robot.clone("demo", "twin", l, j)
    v = robot.set_values(j2.unionByName(j), _asked(spark).withColumn("robot", F.lit("twin")))
    return v.select("robot", "joint", F.round("value", 9).alias("value"))


def frame_names(spark, d):
    p, l, j = _model(spark)
    return robot.frames_by_name(l, j, robot.shapes(p)).select("frame", "role")


def rigid_groups(spark, d):
    _, l, j = _model(spark)
    return robot.rigid_group(l, j).select("joint", "link")


def joint_degrees(spark, d):
    """The limits of turning joints in degrees, of the model and as read from the tables' first joint."""
    j = _model(spark)[2].filter(F.col("type").isin("revolute", "continuous"))
    return j.select("joint", *[F.round(F.degrees(c), 6).alias(c) for c in ("lower", "upper")])


def natural_sort(spark, d):
    """Joints in natural order, numbered."""
    from pyspark.sql.window import Window

    j = _model(spark)[2].select("joint")
    return j.withColumn("nr", F.row_number().over(Window.partitionBy().orderBy(*formats.natural_key(F.col("joint")))))


def state_joints(spark, d):
    """Readings of sixteen joints in long form, summed up per joint."""
    f = read(spark, d, "hdf5_frames").filter("state is not null").select("episode_idx", "frame_index", "state")
    e = robot.state_joints(f, spark.createDataFrame([], "joint string, lower double, upper double"))
    return e.groupBy("joint").agg(F.count("*").alias("n"), F.min("value").cast("double").alias("lowest"))


def drag_angles(spark, d):
    """Turn about z and slide along z between neighbouring parts of an embedding."""
    v = lambda i: F.transform(F.slice("embedding", i, 3), lambda x: x.cast("double"))
    z = F.array(*map(F.lit, (0.0, 0.0, 1.0)))
    return read(spark, d, "embeddings").select("vec_id", F.round(rotations.turn_between(v(1), v(4), z), 6).alias("turn"), F.round(rotations.slide_between(v(1), v(4), z), 6).alias("slide"))


def option_words(spark, d):
    """Flags and integer options as they are read from text."""
    t = spark.createDataFrame([(" Yes",), ("off",), ("TRUE",), ("maybe",), ("12",), ("-3",), (None,)], "word string")
    return t.select("word", formats.flag(F.col("word")).alias("flag"), formats.at_least(F.col("word"), 4, 1).alias("number"))


def mesh_addresses(spark, d):
    p = spark.createDataFrame([("package://arm/meshes/a.stl",), ("package://leg/b.stl",), ("c.stl",)], "path string")
    m = formats.package_map(F.lit("arm: /opt/arm, foot: /opt/foot"))
    return p.select("path", formats.resolve_resource(F.col("path"), m, None, F.lit("/work/")).alias("mapped"), formats.resolve_resource(F.col("path"), None, F.lit("/opt/arm"), F.lit("/work/")).alias("single"))


QUERIES = {f.__name__: f for f in (
    joint_defaults, joint_clamp, mimic_propagate, mimic_cycle, root_links, tree_depth, movable_ancestor, link_poses, model_shapes, joint_values, limits_again, cloned_values, frame_names, rigid_groups, joint_degrees, natural_sort, state_joints, drag_angles, option_words, mesh_addresses,
)}

_J = """
with recursive j(ord, joint, type, parent, child, axis, lower, upper, mimic_joint, multiplier, "offset", n_values) as (values
 (0, 'body_fixed', 'fixed', 'base', 'body', [1.0, 0, 0]::double[], 0.0::double, 0.0::double, null::varchar, null::double, null::double, 0),
 (1, 'joint1', 'revolute', 'body', 'upper', [0, 0, 1.0], -1.8, 1.8, null, null, null, 1), (2, 'joint2', 'revolute', 'upper', 'lower', [0, 1.0, 0], 0.25, 1.9, null, null, null, 1),
 (3, 'joint10', 'continuous', 'lower', 'hand', [1.0, 0, 0], -1, 1, null, null, null, 1), (4, 'finger_2', 'prismatic', 'hand', 'finger2', [0, 1.0, 0], 0, 0.04, null, null, null, 1),
 (5, 'finger_10', 'prismatic', 'hand', 'finger10', [0, 1.0, 0], -0.04, 0, 'finger_2', -1, 0, 1), (6, 'slide', 'planar', 'base', 'rail', [0, 0, 1.0], 0, 0, null, null, null, 3),
 (7, 'wheel', 'continuous', 'rail', 'wheel', [1.0, 0, 0], 0, 0, 'finger_10', 23, -5, 1)
), l(link) as (values ('base'), ('body'), ('upper'), ('lower'), ('hand'), ('finger2'), ('finger10'), ('rail'), ('wheel')),
t(link, depth, path, mover) as (
  select link, 0, []::varchar[], null::varchar from l where link not in (select child from j)
  union all select j.child, t.depth + 1, list_append(t.path, j.joint), case when j.type <> 'fixed' then j.joint else t.mover end from t join j on j.parent = t.link
)
"""
ORACLE = {
    "joint_defaults": _J + 'select joint, type, parent, child, axis, lower, upper, mimic_joint, multiplier, "offset", n_values from j',
    "joint_clamp": """with f as (select distinct episode_idx, frame_index, state[2]::double as v from hdf5_frames)
select *, greatest(-0.25, least(0.5, v)) as clamped from f where v is not null and not isnan(v)""",
    "mimic_propagate": _J + """, a(joint, requested) as (
  select * from (values ('joint1', 2.5::double), ('joint2', 0.1), ('joint10', 1.5), ('finger_2', 0.1), ('body_fixed', 1.0)) v
  union all select j.joint, a.requested * j.multiplier + j."offset" from a join j on j.mimic_joint = a.joint
), v as (select a.joint, a.requested, case when j.type = 'fixed' then 0 when j.type in ('revolute', 'prismatic') then greatest(lower, least(upper, a.requested)) else a.requested end as value from a join j using (joint))
select joint, round(requested, 9) as requested, round(value, 9) as value, value <> 0 as changed from v""",
    "joint_values": _J + """, v(joint, value) as (values ('joint1', 1.8::double), ('joint2', 0.25), ('joint10', 1.5), ('finger_2', 0.04), ('finger_10', -0.04), ('body_fixed', 0), ('wheel', 23 * (-1 * 0.1::double) - 5))
select j.joint, case n_values when 0 then []::double[] when 1 then [v.value] else [1, 8, 3]::double[] end as values from j left join v using (joint)""",
    "limits_again": _J + """, v(joint, free) as (values ('joint1', 2.5::double), ('joint2', 0.1), ('joint10', 1.5), ('finger_2', 0.1), ('finger_10', -0.1), ('body_fixed', 0), ('wheel', 23 * (-1 * 0.1::double) - 5)),
w as (select joint, free, case when type in ('revolute', 'prismatic') then greatest(lower, least(upper, free)) when type = 'fixed' then free else free end as held from v join j using (joint))
select joint, round(free, 9) as free, round(held, 9) as held, free <> held as changed from w""",
    "cloned_values": """select 'twin' as robot, joint, round(value, 9) as value from (values ('joint1', 1.8::double), ('joint2', 0.25), ('joint10', 1.5), ('finger_2', 0.04), ('finger_10', -0.04), ('body_fixed', 0), ('wheel', -7.3)) v(joint, value)""",
    "frame_names": _J + "select joint as frame, 'joint' as role from j union all select link, 'link' from l where link not in (select joint from j) union all select 'hull', 'visual'",
    "rigid_groups": _J + "select mover as joint, link from t where mover is not null",
    "joint_degrees": _J + "select joint, round(degrees(lower), 6) as lower, round(degrees(upper), 6) as upper from j where type in ('revolute', 'continuous')",
    "model_shapes": """select * from (values
 ('base', 'visual', 'hull', 'box', [0.4, 0.3, 0.2]::double[], null::double, null::double, [0.5, 0.5, 0.5, 1]::double[], [0, 0, 0.1]::double[]),
 ('upper', 'collision', null, 'cylinder', null, 0.05, 0.3, null, [0, 0, 0]::double[]),
 ('wheel', 'visual', null, 'sphere', null, 0.1, null, null, [0, 0, 0]::double[])) v(link, role, name, shape, size, radius, length, rgba, xyz)""",
    "link_poses": _J.replace("t(link, depth", """o(joint, x, y, z, yaw, v) as (values ('body_fixed', 0.0::double, 0.0::double, 0.5::double, 1.5707963267948966::double, 0.0::double), ('joint1', 0.2, 0, 0, 0, 1.8), ('joint2', 0.3, 0, 0, 0, 0.25), ('joint10', 0.25, 0, 0, 0, 1.5),
 ('finger_2', 0, 0, 0, 0, 0.04), ('finger_10', 0, 0, 0, 0, -0.04), ('slide', 0, 0, 0, 0, 0), ('wheel', 0, 0, 0, 0, 23 * (-1 * 0.1::double) - 5)),
-- each joint as a turn (quaternion a, b, c, w) and a shift
m as (select parent, child, case when type = 'prismatic' then x + axis[1] * v else x end as x, case when type = 'prismatic' then y + axis[2] * v else y end as y, case when type = 'prismatic' then z + axis[3] * v else z end as z,
  case when type in ('revolute', 'continuous') then axis[1] * sin(v / 2) else 0 end as a, case when type in ('revolute', 'continuous') then axis[2] * sin(v / 2) else 0 end as b,
  case when type in ('revolute', 'continuous') then axis[3] * sin(v / 2) else sin(yaw / 2) end as c, case when type in ('revolute', 'continuous') then cos(v / 2) else cos(yaw / 2) end as w from j join o using (joint)),
k(link, x, y, z, a, b, c, w) as (
  select 'base', 0.0::double, 0.0::double, 0.0::double, 0.0::double, 0.0::double, 0.0::double, 1.0::double
  union all select m.child,
    k.x + (1 - 2 * (k.b * k.b + k.c * k.c)) * m.x + 2 * (k.a * k.b - k.c * k.w) * m.y + 2 * (k.a * k.c + k.b * k.w) * m.z,
    k.y + 2 * (k.a * k.b + k.c * k.w) * m.x + (1 - 2 * (k.a * k.a + k.c * k.c)) * m.y + 2 * (k.b * k.c - k.a * k.w) * m.z,
    k.z + 2 * (k.a * k.c - k.b * k.w) * m.x + 2 * (k.b * k.c + k.a * k.w) * m.y + (1 - 2 * (k.a * k.a + k.b * k.b)) * m.z,
    k.w * m.a + k.a * m.w + k.b * m.c - k.c * m.b, k.w * m.b - k.a * m.c + k.b * m.w + k.c * m.a, k.w * m.c + k.a * m.b - k.b * m.a + k.c * m.w, k.w * m.w - k.a * m.a - k.b * m.b - k.c * m.c
  from k join m on m.parent = k.link
),
t(link, depth""") + " select link, round(x, 6) + 0.0 as x, round(y, 6) + 0.0 as y, round(z, 6) + 0.0 as z, round(abs(w), 6) as w from k",
    "mimic_cycle": "select 'r' as robot, unnest(['a', 'b', 'c']) as joint",
    "root_links": _J + "select link from t where depth = 0",
    "tree_depth": _J + "select link, depth, array_to_string(path, '/') as path from t",
    "movable_ancestor": _J + "select link, mover as joint from t",
    "natural_sort": _J + r"select joint, row_number() over (order by try_cast(nullif(regexp_extract(joint, '(\d+)\D*$', 1), '') as double) nulls last, joint) as nr from j",
    "state_joints": """select case when i <= 8 then 'l_joint' || i else 'r_joint' || (i - 8) end as joint, count(*) as n, min(state[i])::double as lowest
from hdf5_frames, (select unnest(range(1, 17)) as i) where state is not null group by 1""",
    "drag_angles": """select vec_id, round(atan2(embedding[1]::double * embedding[5]::double - embedding[2]::double * embedding[4]::double, embedding[1]::double * embedding[4]::double + embedding[2]::double * embedding[5]::double), 6) as turn,
 round(embedding[6]::double - embedding[3]::double, 6) as slide from embeddings""",
    "option_words": "select * from (values (' Yes', true, 4), ('off', false, 4), ('TRUE', true, 4), ('maybe', null, 4), ('12', null, 12), ('-3', null, 1), (null, null, 4)) v(word, flag, number)",
    "mesh_addresses": """select * from (values ('package://arm/meshes/a.stl', '/opt/arm/meshes/a.stl', '/opt/arm/meshes/a.stl'), ('package://leg/b.stl', null, '/opt/arm/leg/b.stl'),
 ('c.stl', '/work/c.stl', '/work/c.stl')) v(path, mapped, single)""",
}
