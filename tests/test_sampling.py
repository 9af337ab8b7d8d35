"""Segmentation and grid sampling against a sequential model and the worked cases."""

import random

import pytest
from pyspark.sql import functions as F

from kelpline.operators import sample, segment
from tests.conftest import rows

CODES = {"o": [0, 0, 0, 0], "X": [0, 0, 1, 0], "Y": [0, 0, 0, 1], "XY": [0, 0, 1, 1], "1": [1], "s": [0, 0, 0], "n": None}


@pytest.mark.parametrize("log, want", [
    ("X o Y", []), ("o X o Y", [(1, 3)]), ("o X o X o Y", [(3, 5)]), ("o Y o X o Y", [(3, 5)]), ("o XY o Y", [(1, 1)]), ("o X o XY", [(3, 3)]),
    ("o 1 X s X o Y", [(2, 6)]), ("o X o", []), ("o X X X Y", [(1, 4)]), ("o n X o Y", [(2, 4)]), ("", []),
])
def test_segmentation_cases(spark, log, want):
    m = spark.createDataFrame([("b", i, i * 10, CODES[c]) for i, c in enumerate(log.split())], "bag string, seq long, t long, buttons array<int>")
    found = segment.episodes(segment.button_edges(m))
    assert rows(found.select("x_seq", "y_seq")) == want


def model(times, start, period, offset):
    """The sequential rules, message by message."""
    out, s, adding, state, tick = [], start + period, False, None, 0
    for i, t in enumerate(times):
        a = s + offset
        if t < s:
            continue
        if t <= a:
            if not adding:
                state, adding, tick = i, True, (s - start) // period - 1
        else:
            if adding:
                out.append((tick, state, i))
            s += ((t - a) // period + 1) * period
            adding = False
    return out


CASES = [
    (list(range(0, 101, 5)), [(0, 4, 7), (1, 8, 11), (2, 12, 15), (3, 16, 19)]),
    ([5, 15, 22, 28, 35, 42, 130, 141, 152, 163], [(0, 2, 4), (1, 5, 6), (6, 7, 8)]),
    ([21, 33, 45, 51, 63], [(0, 0, 1), (1, 2, 3)]),
    ([25, 30, 31, 45, 55, 60, 71], [(0, 0, 2), (1, 3, 4), (2, 5, 6)]),
    ([22, 30], []), ([35, 55, 75, 95], []),
]


def grid(spark, logs):
    m = spark.createDataFrame([(str(k), 0, i, t, 0) for k, ts in enumerate(logs) for i, t in enumerate(ts)], "bag string, x_seq long, seq long, t long, t_start long")
    got = {}
    for r in sample.grid_rows(m, 20, 10, []).collect():
        got.setdefault(int(r["bag"]), []).append((r["tick"], r["state_seq"], r["action_seq"]))
    return [sorted(got.get(k, [])) for k in range(len(logs))]


def test_grid_cases(spark):
    assert grid(spark, [c for c, _ in CASES]) == [w for _, w in CASES]
    assert [model(c, 0, 20, 10) for c, _ in CASES] == [w for _, w in CASES]


def test_grid_matches_sequential_rules_on_boundaries(spark):
    rnd = random.Random(3)
    logs = []
    for k in range(600):
        t, ts = 0, []
        for _ in range(rnd.randint(1, 40)):
            t += rnd.choice([0, 1, 5, 10, 20, 25, 70]) if k % 2 else rnd.choice([0, 10, 20, 30])
            ts.append(t)
        logs.append(ts)
    assert grid(spark, logs) == [model(ts, 0, 20, 10) for ts in logs]


def test_gaps_frames_and_bad_offset(spark):
    r = spark.createDataFrame([("b", 0, t) for t in (0, 1, 6, 9)] + [("c", 0, 0)], "bag string, x_seq long, tick long")
    assert rows(sample.time_gaps(r, 3, 0.5)) == [("b", 0, 4, 2, 2.5), ("c", 0, 1, 0, 0.0)]
    assert rows(sample.frames(r, 0.5, 2).select("tick", "frame_index", "timestamp")) == [(0, 0, 0.0), (1, 1, 0.5), (6, 2, 1.0), (9, 3, 1.5)]
    with pytest.raises(ValueError):
        sample.pending_ticks(r.withColumns({"t": F.lit(0), "t_start": F.lit(0), "seq": F.lit(0)}), 10, 10)


def test_stats_of_nothing_are_zeros(spark):
    e = spark.createDataFrame([], "bag string, x_seq long, y_seq long, t_start long, t_stop long")
    assert rows(segment.duration_stats(e, F.col("t_stop") - F.col("t_start") + F.lit(0.0), 1.0, 1)) == [(0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]
