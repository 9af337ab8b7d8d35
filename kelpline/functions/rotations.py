"""Quaternions and rigid motions as column expressions over ``array<double>``: quaternion x, y, z, w; vectors x, y, z."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit(axis: Column) -> Column:
    """The axis at length 1; a zero vector stays zero."""
    n = F.sqrt(F.aggregate(axis, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(n == 0, axis).otherwise(F.transform(axis, lambda x: x / n))


def from_rpy(rpy: Column) -> Column:
    """Roll, pitch and yaw about the fixed x, y and z axes, in this order."""
    r, p, y = (rpy[i] / 2 for i in range(3))
    cr, sr, cp, sp, cy, sy = F.cos(r), F.sin(r), F.cos(p), F.sin(p), F.cos(y), F.sin(y)
    return F.array(sr * cp * cy - cr * sp * sy, cr * sp * cy + sr * cp * sy, cr * cp * sy - sr * sp * cy, cr * cp * cy + sr * sp * sy)


def from_axis_angle(axis: Column, angle: Column) -> Column:
    s = F.sin(angle / 2)
    return F.array(axis[0] * s, axis[1] * s, axis[2] * s, F.cos(angle / 2))


def multiply(a: Column, b: Column) -> Column:
    """First ``b``, then ``a``."""
    ax, ay, az, aw = (a[i] for i in range(4))
    bx, by, bz, bw = (b[i] for i in range(4))
    return F.array(aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz)


def cross(a: Column, b: Column) -> Column:
    return F.array(a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def add(a: Column, b: Column, times: Column | float = 1.0) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y * times)


def rotate(q: Column, v: Column) -> Column:
    t = F.transform(cross(q, v), lambda x: 2 * x)
    return add(add(v, t, q[3]), cross(q, t))


def compose(pos_a: Column, rot_a: Column, pos_b: Column, rot_b: Column) -> Column:
    """The motion b inside the frame a, as a struct ``pos, rot``."""
    return F.struct(add(pos_a, rotate(rot_a, pos_b)).alias("pos"), multiply(rot_a, rot_b).alias("rot"))


def turn_between(start: Column, end: Column, axis: Column) -> Column:
    """Signed angle about ``axis`` from ``start`` to ``end``, both projected on the plane across it."""
    flat = lambda v: add(v, axis, -dot(v, axis))
    a, b = flat(start), flat(end)
    return F.atan2(dot(cross(a, b), axis), dot(a, b))


def slide_between(start: Column, end: Column, axis: Column) -> Column:
    """Way from ``start`` to ``end`` along ``axis``."""
    return dot(add(end, start, -1.0), axis)
