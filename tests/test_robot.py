"""Robot models: defaults, limits, mimics, cycles, trees and kinematics."""

import math

import pytest
from pyspark.sql import functions as F

from kelpline.operators import robot
from kelpline.plans.robots import MODEL
from tests.conftest import rows

J = "robot string, joint string, type string, parent string, child string, lower double, upper double, mimic_joint string, multiplier double, offset double"


def joints(spark, *more):
    return spark.createDataFrame([("r", *x) for x in more], J)


def one(spark, kind, value, lower=-1.0, upper=1.0, **how):
    j = joints(spark, ("j", kind, "a", "b", lower, upper, None, None, None))
    q = spark.createDataFrame([("r", "j", value)], "robot string, joint string, value double")
    r = robot.set_values(j, q, **how).first()
    return r["value"], r["changed"]


@pytest.mark.parametrize("kind, asked, got", [("revolute", 0.5, 0.5), ("revolute", 1.5, 1.0), ("prismatic", -1.5, -1.0), ("continuous", 1.5, 1.5), ("continuous", -1.5, -1.5), ("fixed", 1.0, 0.0)])
def test_limits(spark, kind, asked, got):
    assert one(spark, kind, asked) == (got, got != 0)


def test_ignored_limits_null_and_crossed_limits(spark):
    assert one(spark, "revolute", 1.5, ignore_limits=True) == (1.5, True)
    assert one(spark, "revolute", None) == (0.0, False)
    assert one(spark, "revolute", 0.0, lower=2.0, upper=1.0) == (2.0, True)


def test_repeat_is_no_change(spark):
    now = spark.createDataFrame([("r", "j", 0.5)], "robot string, joint string, value double")
    assert one(spark, "revolute", 0.5, current=now) == (0.5, False)
    assert one(spark, "revolute", 1.5, current=now) == (1.0, True)


def test_mimic_follows_the_request_before_its_limits(spark):
    j = joints(spark, ("a", "revolute", "x", "y", -1.0, 1.0, None, None, None), ("b", "continuous", "y", "z", 0.0, 0.0, "a", 23.0, -5.0), ("c", "revolute", "z", "w", -1.0, 1.0, "b", 1.0, 0.0))
    q = spark.createDataFrame([("r", "a", 2.0)], "robot string, joint string, value double")
    assert rows(robot.set_values(j, q).select("joint", "requested", "value")) == [("a", 2.0, 1.0), ("b", 41.0, 41.0), ("c", 41.0, 1.0)]


def test_mimic_circle_is_an_error(spark):
    j = joints(spark, ("a", "revolute", "x", "y", -1.0, 1.0, "b", 1.0, 0.0), ("b", "revolute", "y", "z", -1.0, 1.0, "a", 1.0, 0.0))
    assert rows(robot.mimic_cycles(j)) == [("r", "a"), ("r", "b")]
    with pytest.raises(Exception, match="cycle"):
        robot.require_no_cycles(j).collect()


def test_model_is_parsed_with_defaults(spark):
    p = robot.parse(spark.createDataFrame([(MODEL,)], "xml string"))
    l, j = robot.links(p), robot.joints(p)
    assert (l.count(), j.count()) == (9, 8)
    d = {r["joint"]: r for r in j.collect()}
    assert d["joint1"]["axis"] == [0.0, 0.0, 1.0] and d["slide"]["axis"] == [0.0, 0.0, 1.0] and d["body_fixed"]["axis"] == [1.0, 0.0, 0.0]
    assert (d["finger_10"]["multiplier"], d["finger_10"]["offset"]) == (-1.0, 0.0)
    assert [d[k]["n_values"] for k in ("body_fixed", "joint1", "slide")] == [0, 1, 3]
    s = rows(robot.shapes(p).select("link", "role", "shape", "rgba"))
    assert ("base", "visual", "box", [0.5, 0.5, 0.5, 1.0]) in s and ("wheel", "visual", "sphere", None) in s
    assert rows(robot.rigid_group(l, j).filter("joint = 'joint1'").select("link")) == [("upper",)]
    assert dict(rows(robot.frames_by_name(l, j, robot.shapes(p)).select("frame", "role")))["wheel"] == "joint"


def test_kinematics_of_a_planar_arm(spark):
    xml = """<robot name="arm"><link name="a"/><link name="b"/><link name="c"/>
    <joint name="j1" type="revolute"><parent link="a"/><child link="b"/><axis xyz="0 0 1"/><limit lower="-3" upper="3"/></joint>
    <joint name="j2" type="revolute"><parent link="b"/><child link="c"/><origin xyz="1 0 0"/><axis xyz="0 0 1"/><limit lower="-3" upper="3"/></joint></robot>"""
    p = robot.parse(spark.createDataFrame([(xml,)], "xml string"))
    v = spark.createDataFrame([("arm", "j1", math.pi / 2), ("arm", "j2", math.pi / 2)], "robot string, joint string, value double")
    got = {r["link"]: (r["pos"], r["rot"]) for r in robot.poses(robot.links(p), robot.joints(p), v).collect()}
    assert got["c"][0] == pytest.approx([0, 1, 0], abs=1e-9)
    assert got["c"][1] == pytest.approx([0, 0, 1, 0], abs=1e-9)
    assert got["a"][0] == [0, 0, 0]


def test_vendored_counts_style(spark):
    """A chain of 27 joints has 28 links, and one root."""
    n = 27
    xml = "<robot name='r'>" + "".join(f"<link name='l{i}'/>" for i in range(n + 1)) + "".join(f"<joint name='j{i}' type='fixed'><parent link='l{i}'/><child link='l{i + 1}'/></joint>" for i in range(n)) + "</robot>"
    p = robot.parse(spark.createDataFrame([(xml,)], "xml string"))
    l, j = robot.links(p), robot.joints(p)
    assert (l.count(), j.count(), robot.root_links(l, j).count(), robot.tree(l, j).agg(F.max("depth")).first()[0]) == (28, 27, 1, 27)
