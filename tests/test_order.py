"""Dense numbers, forward fill by blocks and as-of joins against brute force."""

import random

from pyspark.sql import functions as F

from kelpline.operators import order
from tests.conftest import rows


def test_numbers_are_dense_and_sums_exclusive(spark):
    rnd = random.Random(1)
    data = [(rnd.randint(0, 40), i, rnd.choice([None, 1, 5, 9])) for i in range(400)]
    df = spark.createDataFrame(data, "a int, b int, n long").repartition(7)
    got = [tuple(r) for r in order.number_rows(df, "a", "b", index="i", sums={"before": "n"}, start=10).orderBy("i").select("a", "b", "i", "before").collect()]
    total, want = 0, []
    for k, (a, b, n) in enumerate(sorted(data, key=lambda r: r[:2])):
        want.append((a, b, k + 10, total))
        total += n or 0
    assert got == want
    assert order.number_rows(df.filter("false"), "a").count() == 0


def test_blocks_change_nothing(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.choice("ab"), i, rnd.choice([None, None, i])) for i in range(300)], "k string, t long, v long")
    plain = order.fill_forward(df, ["k"], ["t"], {"f": F.col("v")})
    split = order.fill_forward(df, ["k"], ["t"], {"f": F.col("v")}, F.floor(F.col("t") / 7))
    assert rows(plain) == rows(split.select(*plain.columns))


def test_asof_takes_the_latest_at_or_before(spark):
    rnd = random.Random(4)
    left = [(rnd.choice("ab"), rnd.randint(0, 60), i) for i in range(80)]
    right = [(rnd.choice("ab"), rnd.randint(0, 60), i, f"v{i}") for i in range(50)]
    l = spark.createDataFrame(left, "k string, t long, id int")
    r = spark.createDataFrame(right, "k string, t long, n int, v string")
    want = []
    for k, t, i in left:
        best = max(((x[1], x[2], x[3]) for x in right if x[0] == k and x[1] <= t), default=None)
        want.append((i, best and best[2]))
    for block in (None, F.floor(F.col("t") / 9)):
        got = order.asof_join(l, r, ["k"], "t", ["v"], tie="n", block=block)
        assert sorted(tuple(x) for x in got.select("id", "asof_v").collect()) == sorted(want)
    assert order.asof_join(l, r.filter("false"), ["k"], "t", ["v"]).filter("asof_v is null").count() == len(left)


def test_scans_by_blocks(spark, monkeypatch):
    rnd = random.Random(9)
    data = [(rnd.choice(["a", "b", None]), t, rnd.choice([None, 1, 2, 2]), rnd.randint(0, 9) < 3) for t in range(300)]
    df = spark.createDataFrame(data, "k string, t int, v int, keyframe boolean").withColumn("seq", F.col("t").cast("long"))
    last, n, want, changed = {}, {}, {}, set()
    for k, t, v, _ in data:
        n[k] = n.get(k, 0) + 1
        want[t] = (n[k], last.get(k, "none"))
        if last.get(k, "none") != v:
            changed.add(t)
        last[k] = v
    for width in (7, 1000):
        block = F.floor(F.col("t") / width)
        got = order.number_within(order.previous(df, ["k"], ["t"], ["v"], block), ["k"], ["t"], block, "nr").collect()
        assert {r["t"]: (r["nr"], "none" if r["previous"] is None else r["previous"]["v"]) for r in got} == want
        assert {r["t"] for r in order.changes(df, ["k"], ["t"], "v", block).collect()} == changed
    from kelpline.operators import segment, video

    groups = {}
    for size in (11, 1 << 17):
        monkeypatch.setattr(segment, "BLOCK", size)
        monkeypatch.setattr(video, "KEPT", 4)
        g = video.picture_groups(df, keys=("k",)).collect()
        p = video.repair_pts(df.withColumn("raw", F.coalesce(F.col("v") * 20, F.lit(0))), "raw", ("k",)).collect()
        e = segment.edges(df.withColumns({"s": (F.col("v") == 1).cast("int"), "e": (F.col("v") == 2).cast("int")}), "s", "e", ("k",)).collect()
        found = spark.createDataFrame([("a", 5, 40, 0), ("a", 44, 44, 1), ("a", 60, 290, 2), ("b", 1, 12, 3)], "k string, x_seq long, y_seq long, t_start long")
        inside = segment.in_episodes(df, found, ("k",)).collect()
        groups[size] = [sorted(map(str, x)) for x in (g, p, e, inside)]
        kept = [t for k, t, _, key in data if k == "a"]
        for r in g:
            if r["k"] == "a":
                tail = [t for t in kept if t <= r["t"]][-4:]
                keys = [t for t in tail if data[t][3]]
                assert r["tail_from"] == (keys[-1] if keys else None)
        assert {r["t"]: r["x_seq"] for r in inside} == {t: x for k, t, _, _ in data for kk, x, y in (("a", 5, 40), ("a", 60, 290), ("b", 1, 12)) if k == kk and x <= t < y}
    assert groups[11] == groups[1 << 17]
