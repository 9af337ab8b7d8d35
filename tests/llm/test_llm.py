"""Operators of the subpackage llm against brute force, round trips and held-out accuracy, and on odd inputs."""

import collections
import datetime as dt
import pickle
import random

import pytest
from pyspark.sql import functions as F

from kelpline.llm import mixture, nearest, percentiles, queries, splits, subjects, tokens
from tests.conftest import rows
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, data, name):
    if name in queries.ORACLE:
        same(spark, data, queries.QUERIES[name], queries.ORACLE[name])
    else:
        queries.QUERIES[name](spark, data).count()


BAGS = [
    ("rosbag2_2024_01_04-09_36_55", ["rosbag2_2024_01_04-09_36_55"]), (" ./rosbags/Take_20240101_012850/ ", ["take_20240101_012850"]), ("D:\\bags\\session-2024-01-02-114526\\", ["session-2024-01-02-114526"]),
    ("xr_run20240102T012712/xr_run20240102T012712_8.db3", ["xr_run20240102t012712"]), ("/mnt/cold//take_20240101_012850/take_20240101_012850_4.db3.zstd", ["take_20240101_012850"]), ("rosbags/take_20240101_012850/metadata.yaml", ["take_20240101_012850"]),
    ("rosbag2_2024_01_04-09_36_55_11.mcap; take_20240101_012850.mcap", ["rosbag2_2024_01_04-09_36_55", "take_20240101_012850"]), ("a_b + c|d, a_b", ["a_b", "c", "d"]), ("own_7.mcap", ["own"]), ("own_7", ["own_7"]),
    ("take_20240109_152832_10.mcap", ["take_20240109_152832"]), ("take_20240816_121425/take_20240816_121425_12.db3", ["take_20240816_121425"]), ("rosbag2_2024_01_04-09_36_55", ["rosbag2_2024_01_04-09_36_55"]),
    ("episode_014", []), ("./EPISODE_000/", []), ("", []), ("  ", []), (None, []), ("unknown", []),
]


def test_recordings(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BAGS)], "i int, source_bag string")
    got = [r["r"] for r in df.select("i", splits.recordings(F.col("source_bag")).alias("r")).orderBy("i").collect()]
    assert got == [w for _, w in BAGS]


def brute_components(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    first = {}
    for r, e in links:
        if r is None or e is None:
            continue
        find(r)
        if e in first:
            a, b = find(first[e]), find(r)
            up[max(a, b)] = min(a, b)
        else:
            first[e] = r
    return {r: find(r) for r, e in links if r is not None and e is not None}


def test_components(spark):
    rnd = random.Random(1)
    chain = [(i, f"c{j}") for i in range(100, 160) for j in (i, i + 1)]  # a long path
    hot = [(i, "hot") for i in range(200, 400)]
    rest = [(rnd.randint(500, 900), f"e{rnd.randint(0, 300)}") for _ in range(300)]
    links = chain + hot + rest + rest[:50] + [(None, "x"), (1, None)]
    df = spark.createDataFrame(links, "record long, entity string")
    assert dict(rows(splits.components(df))) == brute_components(links)
    assert splits.components(df.filter("false")).count() == 0


def test_deal_keeps_groups_whole_and_shares_near(spark):
    rnd = random.Random(2)
    records, i = [], 0
    for g in range(900):
        for _ in range(300 if g == 0 else min(40, int(rnd.paretovariate(1.2)))):
            records.append((i, g, rnd.choice("aabc") if g % 5 else None))
            i += 1
    df = spark.createDataFrame(records, "id long, grp long, lab string")
    got = splits.deal_groups(df, "id", "grp", "lab", queries.SPLITS)
    out = {r["id"]: (r["grp"], r["split"]) for r in got.collect()}
    assert len(out) == len(records) == got.count()
    by = collections.defaultdict(set)
    for g, s in out.values():
        by[g].add(s)
    assert all(len(s) == 1 for s in by.values())
    share = collections.Counter(s for _, s in out.values())
    for name, want in queries.SPLITS.items():
        assert abs(share[name] / len(records) - want) < 0.03
    assert splits.deal_groups(df.filter("false"), "id", "grp", "lab", queries.SPLITS).count() == 0


def test_deal_with_very_many_labels(spark):
    df = spark.createDataFrame([(i, i // 3, f"l{i // 3 if i < 3003 else i % 2}") for i in range(9000)], "id long, grp long, lab string")
    got = splits.deal_groups(df, "id", "grp", "lab", queries.SPLITS)  # 1,001 labels have one group each
    n = {(r["rare"], r["split"]): r["count"] for r in got.groupBy((F.col("id") < 3003).alias("rare"), "split").count().collect()}
    for rare, whole in ((True, 3003), (False, 5997)):
        for name, want in queries.SPLITS.items():
            assert abs(n[rare, name] - want * whole) < 0.04 * whole, (rare, name, n)


def test_nearest_against_brute_force(spark):
    rnd = random.Random(3)
    left = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(0, 4000, 7)]), i) for i in range(400)]
    right = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y", None]), rnd.choice([None, *range(0, 4000, 14)]), i, "clash") for i in range(500)]
    right += right[:60]
    l = spark.createDataFrame([(*r, "clash") for r in left], "entity string, at long, id int, bucket string")
    r = spark.createDataFrame(right, "entity string, stream string, at long, row int, bucket string")
    want = set()
    for e, t, i in left:
        for s in "xy":
            near = [(abs(x[2] - t), x[3]) for x in right if x[0] == e and x[1] == s and x[2] is not None and abs(x[2] - t) <= 20] if e is not None and t is not None else []
            if near:
                want.add((i, s, min(near)[1]))
    for bucket in (50, 1000, 10**9):
        got = nearest.match_nearest(l, r, "entity", "at", "stream", "row", 20, bucket)
        assert sorted(tuple(x) for x in got.select("id", "nearest_stream", "nearest_row").collect()) == sorted(want)
    assert nearest.match_nearest(l, r.filter("false"), "entity", "at", "stream", "row", 20).count() == 0


def test_percentiles_against_sorting(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["a", "b", None]), rnd.choice(["1", "2", "3"]), rnd.choice([rnd.gauss(0, 1), rnd.gauss(0, 1) * 1e12, 0.0, -0.0, 5.0, None, float("nan"), float("inf"), 1e-300])) for _ in range(4000)]
    data += [("hot", "1", 1.5)] * 3000 + [("hot", "2", 2.5)] * 10 + [("none", "1", None)]
    df = spark.createDataFrame(data, "g string, part string, v double").withColumn("grp", F.lit("clash"))
    for groups, fanout in ((["g"], 16), (["g", "part"], 2)):
        values = collections.defaultdict(list)
        for g, p, v in data:
            if v is not None and v == v:
                values[(g,) if len(groups) == 1 else (g, p)].append(v)
        want = {(*k, p, len(v), sorted(v)[max(1, -(-len(v) * p // 1000)) - 1] + 0.0) for k, v in values.items() for p in (1, 500, 999)}
        got = {tuple(r) for r in percentiles.percentiles(df, groups, "v", (1, 500, 999), fanout).collect()}
        assert got == want
    assert percentiles.percentiles(df.filter("false"), ["g"], "v").count() == 0


def test_months_combine_within_bounds(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(rnd.choice("ab"), rnd.choice("123"), rnd.lognormvariate(0, 3) * rnd.choice([1, -1])) for _ in range(3000)], "g string, month string, v double")
    exact = {(r["g"], r["permille"]): (r["n"], r["value"]) for r in percentiles.percentiles(df, ["g"], "v").collect()}
    added = percentiles.from_histogram(percentiles.combine(percentiles.histogram(df, ["g", "month"], "v"), ["g"]), ["g"]).collect()
    assert len(added) == len(exact)
    for r in added:
        n, v = exact[r["g"], r["permille"]]
        assert n == r["n"] and r["lo"] <= v <= r["hi"] and r["hi"] - r["lo"] <= 0.004 * abs(v)


TEXTS = [None, "", "  ", "hello world", "<|endoftext|> is text", "ünï 中文 🤖👩‍👩‍👧", "a\u0000b\r\n\t", "x" * 200_000, "word " * 60_000, "\ufffd broken"]


def test_tokens_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").withColumns({"ids": F.lit("clash"), "n_tokens": F.lit(1)})
    e = tokens.encode(df, offsets=True)
    got = {r["doc_id"]: r for r in e.collect()}
    assert got[0]["ids"] == got[1]["ids"] == [] and got[2]["ids"] != [] and got[3]["ids"] == [31373, 995] and got[3]["ids_in"] == "clash"
    assert 50256 not in got[4]["ids"]
    assert [TEXTS[3][o["start"] : o["end"]] for o in got[3]["offsets"]] == ["hello", " world"]
    back = {r["doc_id"]: r["text"] for r in tokens.decode(e).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert tokens.round_trip(df.select("doc_id", "text")).filter("not same").count() == 0
    n = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(df).collect()}
    assert n == {i: len(r["ids"]) for i, r in got.items()}
    assert tokens.encode(df.filter("false")).count() == 0
    cut = spark.createDataFrame([(got[5]["ids"][:-1],), (None,)], "ids array<int>")
    assert {r["text"] is None for r in tokens.decode(cut).collect()} == {True, False}


def test_tokens_agree_with_another_library(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb"))}
    enc = tiktoken.Encoding("own", pat_str=r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode(docs).collect()}
    assert got == {r["doc_id"]: enc.encode_ordinary(r["text"] or "") for r in docs.collect()}


def test_mixture_shares_and_caps(spark):
    rnd = random.Random(6)
    sizes = [(i, rnd.choice([" Big ", "big", "BIG", "mid", "small"]) if i % 50 else "tiny", rnd.randint(1, 60)) for i in range(6000)] + [(9001, None, 5), (9002, "other", 5), (None, "big", 5), (9003, "big", 0), (9004, "big", None)]
    df = spark.createDataFrame(sizes, "doc_id long, source string, n_tokens long").withColumn("q", F.lit(1))
    targets = spark.createDataFrame([("big", 0.4, 2), ("MID", 0.3, 1), ("small", 0.2, 3), ("tiny", 0.1, 4), ("gone", 0.0, 9), (None, 0.1, 1)], "source string, weight double, max_repeats int")
    got = mixture.mix(df, targets).collect()
    assert len({r["doc_id"] for r in got}) == len(got)
    cap = {"big": 2, "mid": 1, "small": 3, "tiny": 4}
    assert all(r["copies"] <= cap[r["source"]] for r in got)
    total = collections.Counter()
    for r in got:
        total[r["source"]] += r["copies"] * r["n_tokens"]
    whole = sum(total.values())
    for s, w in (("big", 0.4), ("mid", 0.3), ("small", 0.2), ("tiny", 0.1)):
        assert abs(total[s] / whole - w) < 0.003
    again = {(r["doc_id"], r["copies"]) for r in mixture.mix(df.repartition(7), targets).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in got}
    report = {r["source"]: r for r in mixture.mix_report(mixture.mix(df, targets), targets).collect()}
    assert report["gone"]["tokens"] == 0 and abs(report["MID"]["share"] - 0.3) < 0.003
    few = {r["source"]: r["tokens"] for r in mixture.mix_report(mixture.mix(df, targets, total=1000), targets).collect()}
    assert 370 <= few["big"] <= 430
    assert mixture.mix(df.filter("false"), targets).count() == 0


def test_inclusion_is_proportional_to_size(spark):
    rnd = random.Random(8)
    sizes = [100] + [rnd.randint(5, 15) for _ in range(60)] + [900]  # one of ten times the mean, one certain
    part = sum(sizes[:-1]) * 0.15
    df = spark.createDataFrame([(s * 100 + i, f"s{s}", n) for s in range(1000) for i, n in enumerate(sizes)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([(f"s{s}", 0.001, 1) for s in range(1000)], "source string, weight double, max_repeats int")
    got = mixture.mix(df, targets, total=int(1000 * (900 + part)))
    n = {r["i"]: r["count"] for r in got.groupBy((F.col("doc_id") % 100).alias("i")).count().collect()}
    assert n[61] == 1000
    rate = part / sum(x * x for x in sizes[:-1])
    for i, x in enumerate(sizes[:-1]):
        assert abs(n.get(i, 0) - 1000 * rate * x) < 60, (i, x, n.get(i, 0), 1000 * rate * x)


WORDS = {1: ["kettle", "spoon", "oven", "dough", "soup"], 2: ["verdict", "lawsuit", "clause", "court", "judge"], 3: ["violin", "concert", "choir", "tuning", "drum"]}


def make(n, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for d in range(n):
        about = set(rnd.sample([1, 2, 3], rnd.choice([0, 1, 1, 2])))
        s = ["The frame rate stayed at 30."] * rnd.randint(1, 3)
        for a in about:
            s += [f"The {rnd.choice(WORDS[a])} had to be checked before the {rnd.choice(WORDS[a])}." for _ in range(rnd.randint(2, 4))]
        other = sorted({1, 2, 3} - about)
        if other and rnd.random() < 0.5:
            s.append(f"A {rnd.choice(WORDS[rnd.choice(other)])} was visible for a moment.")
        rnd.shuffle(s)
        docs.append((d, " ".join(s)))
        labels += [(d, a) for a in about] or [(d, None)]
    return docs, labels


def test_subjects_held_out(spark):
    docs, labels = make(900, 7)
    df = spark.createDataFrame([*docs, (-1, None), (-2, ""), (None, "x")], "doc_id long, text string").withColumn("v", F.lit("clash"))
    lab = spark.createDataFrame([x for x in labels if x[0] < 450], "doc_id long, subject_id long")
    sub = spark.createDataFrame([(i, f"s{i}", "") for i in (1, 2, 3)], "subject_id long, subject string, description string")
    found, tree = subjects.classify(df, lab, sub)
    got = {(r["doc_id"], r["subject_id"]) for r in found.collect() if r["doc_id"] >= 450}
    want = {(d, s) for d, s in labels if d >= 450 and s is not None}
    assert len(got & want) / len(got) > 0.97 and len(got & want) / len(want) > 0.97
    assert set(tree.labels) == {1, 2, 3}
    # the tree decides: with a single leaf, or with the mixtures of other leaves, the subjects are lost
    off = {(r["doc_id"], r["subject_id"]) for r in subjects.classify(df, lab, sub, leaves=1)[0].collect() if r["doc_id"] >= 450}
    assert len(off & want) < 0.7 * len(want) or len(off & want) < 0.7 * len(off)
    assert b"kelpline" not in pickle.dumps(subjects.learn(df, lab, [1, 2, 3]).plain())  # workers need not have the package
    few = subjects.classify(df, lab, sub, max_labelled=200, max_chars=20_000)[0].count()  # a smaller sample, all documents
    assert few > 0.9 * len({(r["doc_id"], r["subject_id"]) for r in found.collect()})
    none, tree = subjects.classify(df, lab.filter("false"), sub)
    assert tree.empty and none.count() == 0


def test_passages():
    assert subjects.passages(None) == subjects.passages(" \n ") == []
    assert subjects.passages("One 12. (Two.) <b>Three</b>\n- four；没有。好的") == ["one #", "two", "three", "four;没有", "好的"]
    assert subjects.terms("compiler") == subjects.terms("complier") and "心机" in subjects.terms("离心机")


def test_too_many_subjects_are_an_error(spark):
    many = spark.range(subjects.SUBJECTS + 1).select(F.col("id").alias("subject_id"))
    none = spark.createDataFrame([], "doc_id long, text string, subject_id long")
    with pytest.raises(ValueError, match="subjects"):
        subjects.classify(none, none, many)
