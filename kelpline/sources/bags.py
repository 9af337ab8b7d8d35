"""Logs on disk: discovery of bag folders, a data source that replays them, and decoding of their messages."""

from __future__ import annotations

import os
import sqlite3
import struct
from collections.abc import Generator, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MESSAGES = "bag string, seq long, topic string, msg_type string, ts_ns long, data binary"
STORES = (".db3", ".mcap")


def discover(spark: SparkSession, root: str, per_file: bool = False) -> DataFrame:
    """``name, path, bag_file, storage, n_bytes`` of every bag below ``root``, without reading contents.

    A folder is a bag if it has a store (``.db3`` or ``.mcap``) and a ``.yaml`` or ``.yml`` file; folders inside a bag are
    none. ``.db3`` stores win over ``.mcap``; ``bag_file`` is the first store by name. ``n_bytes`` counts all files
    below the folder. With ``per_file`` there is a row per store instead.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.regexp_replace("path", r"^file:/*", "/").alias("file"), "length")
    files = files.withColumns({"dir": F.regexp_extract("file", r"^(.*)/[^/]*$", 1), "ext": F.lower(F.regexp_extract("file", r"(\.[^./]*)$", 1))})
    dirs = files.groupBy("dir").agg(F.bool_or(F.col("ext").isin(*STORES)).alias("store"), F.bool_or(F.col("ext").isin(".yaml", ".yml")).alias("yaml")).filter("store and yaml").select("dir")
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("up")).join(dirs.select(F.col("dir").alias("up")), "up").select("dir")
    bags = dirs.join(above, "dir", "left_anti")
    stores = files.filter(F.col("ext").isin(*STORES)).join(bags, "dir")
    kind = F.when(F.col("ext") == ".db3", 0).otherwise(1)
    below = files.select("length", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))).alias("bag"))
    size = below.join(bags.select(F.col("dir").alias("bag")), "bag").groupBy("bag").agg(F.sum("length").alias("n_bytes"))
    best = stores.groupBy("dir").agg(F.min(F.struct(kind.alias("k"), "file")).alias("first"))
    chosen = best.select("dir", "first.k", F.col("first.file").alias("bag_file"))
    if per_file:
        chosen = stores.join(best.select("dir", "first.k"), "dir").filter(kind == F.col("k")).select("dir", "k", F.col("file").alias("bag_file"))
    out = chosen.join(size, F.col("dir") == F.col("bag"))
    return out.select(F.regexp_extract("dir", r"([^/]*)$", 1).alias("name"), F.col("dir").alias("path"), "bag_file", F.when(F.col("k") == 0, "sqlite3").otherwise("mcap").alias("storage"), "n_bytes").orderBy("path", "bag_file")


def duration_s(spark: SparkSession, root: str, bags: DataFrame, messages: DataFrame) -> DataFrame:
    """``bag, duration_s``: as the bag's ``metadata.yaml`` below ``root`` tells, else from the first to the last message, 0 if there is none."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.y*ml").text(root, wholetext=True)
    folder = F.regexp_replace(F.regexp_extract(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")), r"^(.*)/[^/]*$", 1), r"^file:/*", "/")
    meta = text.select(folder.alias("path"), F.regexp_extract("value", r"duration:\s*\n?\s*nanoseconds:\s*(\d+)", 1).try_cast("long").alias("ns"))
    meta = bags.join(meta.groupBy("path").agg(F.max("ns").alias("ns")), "path").select(F.col("name").alias("bag"), "ns")
    span = messages.groupBy("bag").agg((F.max("ts_ns") - F.min("ts_ns")).alias("span"))
    j = bags.select(F.col("name").alias("bag")).join(meta, "bag", "left").join(span, "bag", "left")
    return j.select("bag", (F.coalesce("ns", "span", F.lit(0)) / 1e9).alias("duration_s"))


Row = tuple[str, int, str, str, int, bytes]


def read_sqlite(path: str, bag: str, base: int, topics: set[str] | None) -> Generator[Row, None, int]:
    """Messages of a ``.db3`` store in log order, numbered from ``base`` + 1; returns the last number.

    The database selects the topics; numbers count all messages, so they are the same whatever is selected.
    """
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        where, args = "", []
        if topics is not None:
            where, args = f"where t.name in ({','.join('?' * len(topics))})", sorted(topics)
        numbered = "select id, topic_id, timestamp, row_number() over (order by timestamp, id) as nr from messages"
        for nr, topic, kind, when, data in db.execute(f"select n.nr, t.name, t.type, n.timestamp, m.data from ({numbered}) n join messages m on m.id = n.id join topics t on n.topic_id = t.id {where} order by n.nr", args):
            yield bag, base + nr, topic, kind, when, data
        return base + db.execute("select count(*) from messages").fetchone()[0]


def _text(b: memoryview, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", b, at)
    return bytes(b[at + 4 : at + 4 + n]).decode(), at + 4 + n


def read_mcap(path: str, bag: str, base: int, topics: set[str] | None) -> Generator[Row, None, int]:
    """The same of an ``.mcap`` store, in the order of the file; chunks may be plain or zstd."""
    nr = base
    schemas: dict[int, str] = {}
    channels: dict[int, tuple[str, str]] = {}

    def records(b: memoryview) -> Iterator[Row]:
        nonlocal nr
        at = 0
        while at + 9 <= len(b):
            op, n = struct.unpack_from("<BQ", b, at)
            body, at = b[at + 9 : at + 9 + n], at + 9 + n
            if op == 3:
                schemas[struct.unpack_from("<H", body)[0]] = _text(body, 2)[0]
            elif op == 4:
                cid, sid = struct.unpack_from("<HH", body)
                channels[cid] = (_text(body, 4)[0], schemas.get(sid, ""))
            elif op == 5:
                cid, _, when = struct.unpack_from("<HIQ", body)
                topic, kind = channels[cid]
                nr += 1
                if topics is None or topic in topics:
                    yield bag, nr, topic, kind, when, bytes(body[22:])
            elif op == 6:
                name, p = _text(body, 28)
                (m,) = struct.unpack_from("<Q", body, p)
                data = body[p + 8 : p + 8 + m]
                if name == "zstd":
                    import zstandard

                    data = memoryview(zstandard.ZstdDecompressor().decompress(bytes(data), max_output_size=struct.unpack_from("<Q", body, 16)[0]))
                elif name:
                    raise ValueError(f"chunks of {path} are compressed by {name}")
                yield from records(data)
            elif op == 15:
                return

    with open(path, "rb") as f:
        b = memoryview(f.read())
    if bytes(b[:8]) != b"\x89MCAP0\r\n":
        raise ValueError(f"{path} is no MCAP file")
    yield from records(b[8:])
    return nr


class _Bag(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.permissive = options["path"], options.get("mode", "FAILFAST").upper() == "PERMISSIVE"
        self.topics = set(filter(None, options.get("topics", "").split(","))) or None

    def partitions(self):
        found = []
        for here, dirs, files in os.walk(self.root):
            ext = {os.path.splitext(x)[1].lower() for x in files}
            if ext & set(STORES) and ext & {".yaml", ".yml"}:
                found.append(here)
                dirs.clear()
        return [_Bag(p) for p in sorted(found)] or [_Bag("")]

    def read(self, part):
        if not part.path:
            return
        names = sorted(os.listdir(part.path))
        stores = [x for x in names if x.endswith(".db3")] or [x for x in names if x.endswith(".mcap")]
        last, bag = 0, os.path.basename(part.path)
        try:
            for x in stores:
                last = yield from (read_sqlite if x.endswith(".db3") else read_mcap)(os.path.join(part.path, x), bag, last, self.topics)
        except (sqlite3.Error, ValueError, struct.error):
            if not self.permissive:
                raise


class BagSource(DataSource):
    """``spark.read.format("bag").load(folder)``: one partition per bag, all its stores replayed in order.

    Options: ``topics``, separated by commas, which the stores select themselves (filters are not pushed down: with two
    scans of one DataFrame the source would see the first scan's filters in the second); ``mode`` - ``FAILFAST`` (default) or ``PERMISSIVE``, which ends a bag at
    the first message that cannot be read and keeps what came before. ``seq`` numbers all messages of a bag from 1, whichever
    topics are read.
    """

    @classmethod
    def name(cls):
        return "bag"

    def schema(self):
        return MESSAGES

    def reader(self, schema):
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the source known to a session."""
    spark.dataSource.register(BagSource)


class Cdr:
    """Reads little- or big-endian CDR: values are aligned to their size, counted from behind the four-byte header."""

    def __init__(self, data: bytes):
        self.b, self.at, self.e = data, 4, "<" if data[1] & 1 else ">"

    def many(self, code: str, n: int) -> list:
        size = struct.calcsize(code)
        if n and size > 1:
            self.at += -(self.at - 4) % size
        out = list(struct.unpack_from(f"{self.e}{n}{code}", self.b, self.at))
        self.at += n * size
        return out

    def one(self, code: str):
        return self.many(code, 1)[0]

    def list(self, code: str) -> list:
        return self.many(code, self.one("I"))

    def text(self) -> str:
        n = self.one("I")
        self.at += n
        return self.b[self.at - n : self.at - 1].decode("utf-8", "replace")

    def raw(self) -> bytes:
        n = self.one("I")
        self.at += n
        return self.b[self.at - n : self.at]

    def head(self) -> None:
        self.many("I", 2)
        self.text()


def _joy(c: Cdr) -> dict:
    c.head()
    return {"axes": c.list("f"), "buttons": c.list("i")}


def _joints(c: Cdr) -> dict:
    c.head()
    names = [c.text() for _ in range(c.one("I"))]
    return {"name": names, "position": c.list("d"), "velocity": c.list("d"), "effort": c.list("d")}


def _pose(c: Cdr) -> dict:
    v = c.many("d", 7)
    return {"position": dict(zip("xyz", v[:3])), "orientation": dict(zip("xyzw", v[3:]))}


def _camera(c: Cdr) -> dict:
    c.head()
    height, width = c.many("I", 2)
    model, d, k = c.text(), c.list("d"), c.many("d", 9)
    c.many("d", 9)
    return {"k": k, "d": d, "p": c.many("d", 12), "width": width, "height": height, "distortion_model": model}


def _packet(c: Cdr) -> dict:
    c.head()
    width, height = c.many("i", 2)
    encoding, pts = c.text(), c.one("Q")
    c.many("B", 2)
    return {"data": c.raw(), "pts": pts, "width": width, "height": height, "encoding": encoding}


#: Message types by name: schema and reader of the payload.
DECODERS = {
    "Joy": ("axes array<float>, buttons array<int>", _joy),
    "JointState": ("name array<string>, position array<double>, velocity array<double>, effort array<double>", _joints),
    "Pose": ("position struct<x:double,y:double,z:double>, orientation struct<x:double,y:double,z:double,w:double>", _pose),
    "CameraInfo": ("k array<double>, d array<double>, p array<double>, width int, height int, distortion_model string", _camera),
    "FFMPEGPacket": ("data binary, pts long, width int, height int, encoding string", _packet),
    "Float64": ("data double", lambda c: {"data": c.one("d")}),
}


def decode(messages: DataFrame, kind: str) -> DataFrame:
    """Messages whose type ends in ``kind``, with ``payload``; null where the bytes do not fit the type.

    Select the messages that are needed first: decoding is the only step that runs in Python.
    """
    schema, read = DECODERS[kind]

    def run(data: pd.Series) -> pd.DataFrame:
        rows = []
        for d in data:
            try:
                rows.append(read(Cdr(d)))
            except (struct.error, IndexError, TypeError, UnicodeDecodeError):
                rows.append(None)
        names = [x.strip().split(" ")[0] for x in _fields(schema)]
        return pd.DataFrame([[None if r is None else r[n] for n in names] for r in rows], columns=names)

    udf = F.pandas_udf(run, schema)
    m = messages.filter(F.col("msg_type").endswith(f"/{kind}") | (F.col("msg_type") == kind))
    p = m.withColumn("payload", udf("data"))
    any_ = [F.col(f"payload.{x.strip().split(' ')[0]}").isNotNull() for x in _fields(schema)]
    ok = any_[0]
    for a in any_[1:]:
        ok = ok | a
    return p.withColumn("payload", F.when(ok, F.col("payload")))


def _fields(schema: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(schema[at:i])
            at = i + 1
    return [*out, schema[at:]]
