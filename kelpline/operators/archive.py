"""Many tiny files packed into few containers of a target size, byte for byte, with an index, and read back in parallel.

A store is a folder: ``containers/`` holds one file per container, and ``index/``, written last, one row per member: path,
file, container, block, offset, length, CRC-32, rows and the key ranges of its records. A container is a run of
blocks, each with a payload, the concatenation of its members' original bytes, and the members' list, so a container can
be read without the index. Both are written by Spark's committer, which moves files into place; lists are read
without the payload, and a lookup by path reads only the containers and blocks it needs.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kelpline import runtime
from kelpline.functions.paths import clean_path
from kelpline.operators.order import number_rows

#: Most rows of one file that make one member; a longer file becomes several members.
MEMBER_ROWS = 65_536
#: Bytes of a container, of a block, and what a member takes besides its rows.
TARGET, BLOCK_BYTES, MEMBER_BYTES = 128 << 20, 4 << 20, 2_048
#: The width of a row is measured on so many rows. Only the containers' sizes depend on it.
WIDTH_ROWS = 1_000
#: Most tasks of the shuffle that packs; beyond it a task makes several containers, one after the other.
TASKS = 20_000

RANGE = T.ArrayType(T.StructType([T.StructField("episode_idx", T.LongType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
MEMBER = T.StructType([
    T.StructField("file_id", T.LongType()), T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("crc32", T.LongType()), T.StructField("n_rows", T.LongType()), T.StructField("records", RANGE),
])
BLOCKS = T.StructType([T.StructField("container", T.IntegerType()), T.StructField("block", T.LongType()), T.StructField("members", T.ArrayType(MEMBER)), T.StructField("payload", T.BinaryType())])
_RANGE = pa.list_(pa.struct([("episode_idx", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))
_MEMBER = pa.struct([("file_id", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("crc32", pa.int64()), ("n_rows", pa.int64()), ("records", _RANGE)])
_BLOCKS = pa.schema([("container", pa.int32()), ("block", pa.int64()), ("members", pa.list_(_MEMBER)), ("payload", pa.binary())])


@dataclass
class Store:
    """A written store: ``path`` of its folder, ``index`` and ``blocks`` as DataFrames."""

    path: str
    index: DataFrame
    blocks: DataFrame


def lay_out(members: DataFrame, scope: str, order: list[str], size: str, target_bytes: int) -> tuple[DataFrame, int]:
    """``members`` with ``first`` and ``span``, the containers each goes to, and the number of containers.

    Members of one ``scope`` are laid end to end in ``order`` and cut into containers of equal size, as many as come
    nearest to ``target_bytes`` each. A member goes to the container that holds its middle; one larger than a container
    is spread over the ``span`` containers it covers. Positions come from range partitions, not from one sorted task.
    """
    laid = runtime.materialize(number_rows(members, scope, *order, sums={"before": size}), "laid")
    each = laid.groupBy(scope).agg(F.min("before").alias("start"), F.sum(size).alias("total"))
    each = each.withColumn("k", F.greatest(F.lit(1), F.round(F.col("total") / target_bytes)).cast("long"))
    # one row per scope
    offset = F.coalesce(F.sum("k").over(Window.partitionBy().orderBy(scope).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = runtime.materialize(each.withColumn("offset", offset).select(F.col(scope).alias("lay_scope"), "start", "total", "k", "offset"), "scopes")
    n = each.agg(F.sum("k").alias("n")).first()["n"] or 0
    j = laid.join(runtime.small(each), F.col(scope) == F.col("lay_scope")).withColumn("step", F.col("total") / F.col("k"))
    at = lambda x: F.least(F.floor(x / F.col("step")), F.col("k") - 1)
    from_, middle, last = F.col("before") - F.col("start"), F.col("before") - F.col("start") + F.col(size) / 2, F.col("before") - F.col("start") + F.col(size) - 1
    large = F.col(size) > F.col("step")
    first = F.when(large, at(from_)).otherwise(at(middle))
    out = j.withColumn("first", (F.col("offset") + first).cast("int")).withColumn("span", F.when(large, at(last) - at(from_) + 1).otherwise(F.lit(1)).cast("int"))
    return out.drop("lay_scope", "start", "total", "k", "offset", "step", "before", "row_index"), int(n)


def container_plan(counted: DataFrame, files: DataFrame, info: DataFrame, row_bytes: float, target_bytes: int) -> tuple[DataFrame, int]:
    """``file_id, n, dataset, chunk, path, first, span``: the containers of every file that ``counted`` (``file_id, n``) has rows of.

    Files lie in the order of dataset, chunk (``episode_idx div chunks_size``), episode and path. Sizes are counted rows
    times ``row_bytes``, so a wrong or missing ``n_bytes`` makes no large container. Rows whose file is unknown, or null,
    lie under dataset ``''``; files without an episode or chunk size lie before the others of their dataset.
    """
    sizes = runtime.small(info.filter("dataset is not null").groupBy("dataset").agg(F.max("chunks_size").alias("chunks_size")))
    one = files.filter("file_id is not null").groupBy("file_id").agg(F.min_by(F.struct("dataset", "path", "episode_idx"), F.struct("dataset", "path", "episode_idx")).alias("f")).select("file_id", "f.*")
    f = counted.join(one, "file_id", "left").join(sizes, "dataset", "left")
    chunk = F.coalesce(F.expr("case when episode_idx >= 0 and chunks_size > 0 then episode_idx div chunks_size end"), F.lit(-1))
    size = (F.col("n") * F.lit(float(row_bytes)) + MEMBER_BYTES).cast("long")
    f = f.select("file_id", "n", F.coalesce("dataset", F.lit("")).alias("dataset"), chunk.alias("chunk"), clean_path(F.col("path")).alias("path"), "episode_idx", size.alias("size"))
    plan, n = lay_out(f, "dataset", ["chunk", "episode_idx", "path", "file_id"], "size", target_bytes)
    return runtime.materialize(plan.drop("episode_idx", "size"), "plan"), n


def _ranges(episodes: list, frames: list) -> list[dict]:
    out: list[dict] = []
    for e, f in sorted({(e, f) for e, f in zip(episodes, frames) if e is not None and f is not None}):
        if out and out[-1]["episode_idx"] == e and out[-1]["last"] + 1 == f:
            out[-1]["last"] = f
        else:
            out.append({"episode_idx": e, "first": f, "last": f})
    return out


def _row_members(columns: list[str], member_rows: int):
    """Members of batches sorted by container and file: (container, entry, bytes); the bytes are the rows as an Arrow stream."""

    def encode(rows: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        body = rows.select(columns).combine_chunks()
        with pa.ipc.new_stream(sink, body.schema) as w:
            w.write_table(body)
        return sink.getvalue().to_pybytes()

    def done(key: tuple, held: list[pa.RecordBatch]) -> tuple[int, dict, bytes]:
        rows = pa.Table.from_batches(held)
        return key[0], {"file_id": key[1], "n_rows": rows.num_rows, "records": _ranges(rows.column("episode_idx").to_pylist(), rows.column("frame_index").to_pylist())}, encode(rows)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, bytes]]:
        held, key, count = [], None, 0
        for b in batches:
            ids = list(zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in ("pack_container", "file_id")]))
            start = 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or ids[i] != ids[start]:
                    if key is not None and ids[start] != key:
                        if held:
                            yield done(key, held)
                        held, count = [], 0
                    key = ids[start]
                    while start < i:
                        step = min(i - start, member_rows - count)
                        held.append(b.slice(start, step))
                        start, count = start + step, count + step
                        if count == member_rows:
                            yield done(key, held)
                            held, count = [], 0
        if held:
            yield done(key, held)

    return members


def _file_members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, bytes]]:
    for b in batches:
        for row in b.to_pylist():
            yield row["pack_container"], {"path": row["path"]}, row["content"]


def _packer(members: Callable, block_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block, entries, parts, size = None, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal entries, parts, size, block
            out = pa.RecordBatch.from_pylist([{"container": at, "block": block, "members": entries, "payload": b"".join(parts)}], schema=_BLOCKS)
            entries, parts, size, block = [], [], 0, block + 1
            return out

        for container, entry, data in members(batches):
            if entries and (container != at or size >= block_bytes):
                yield flush()
            if container != at:
                at, block = container, 0
            entries.append({**entry, "offset": size, "length": len(data), "crc32": zlib.crc32(data)})
            parts.append(data)
            size += len(data)
        if entries:
            yield flush()

    return pack


def _write(rows: DataFrame, n: int, order: list[str], members: Callable, block_bytes: int, path: str) -> DataFrame:
    """Write the containers of ``rows`` (with ``pack_container``): all rows of one meet in one task, so each is one file.

    Up to ``TASKS`` containers, a task is a container and its output file needs no further sorting.
    """
    tasks = max(1, min(n, TASKS))
    spread = rows.repartitionById(tasks, F.col("pack_container")).sortWithinPartitions("pack_container", *order)
    blocks = spread.mapInArrow(_packer(members, block_bytes), BLOCKS)
    # row groups of a few blocks, checked at every block, so that a container is written with little memory and read by several tasks
    sizes = {"parquet.block.size": 4 * block_bytes, "parquet.page.size": block_bytes, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
    w = blocks.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").options(**{k: str(v) for k, v in sizes.items()})
    (w if n <= TASKS else w.partitionBy("container")).parquet(f"{path}/containers")
    return _blocks(rows.sparkSession, path)


def _blocks(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """The blocks of a store, of ``files`` only if given, with the ``file`` they lie in, from the containers' folder on."""
    top = f"{path}/containers"
    if files == [] or not _exists(spark, top):
        return spark.createDataFrame([], BLOCKS).withColumn("file", F.lit(None).cast("string"))
    b = spark.read.schema(BLOCKS).option("basePath", top).parquet(*([top] if files is None else [f"{top}/{f}" for f in files]))
    return b.withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), r"/containers/((?:container=\d+/)?[^/]+)$", 1))


def _place(frames: DataFrame, plan: DataFrame) -> DataFrame:
    """``frames`` with ``pack_container``. The plan is broadcast if small; else rows are shuffled by file, but not those of hot files."""
    lone = plan.filter("file_id is null").select("first", "span").first()
    p = plan.filter("file_id is not null").select("file_id", F.struct("first", "span").alias("pack_to"))
    if runtime.fits(p):
        placed = frames.join(F.broadcast(p), "file_id", "left")
    else:
        n = plan.agg(F.sum("n").alias("n")).first()["n"] or 0
        hot = p.join(plan.filter((F.col("n") * runtime.HOT >= n) & F.col("file_id").isNotNull()).select("file_id"), "file_id", "left_semi")
        hot = F.broadcast(runtime.materialize(hot, "hot"))  # at most HOT files
        known = frames.filter("file_id is not null")
        placed = known.join(hot, "file_id").unionByName(known.join(hot, "file_id", "left_anti").join(p, "file_id")).unionByName(frames.filter("file_id is null").withColumn("pack_to", F.lit(None).cast(p.schema["pack_to"].dataType)))
    first, span = F.col("pack_to.first"), F.col("pack_to.span")
    if lone:
        first, span = F.coalesce(first, F.lit(lone["first"])), F.coalesce(span, F.lit(lone["span"]))
    stretch = F.coalesce(F.expr(f"frame_index div {MEMBER_ROWS}"), F.lit(0))
    to = first + F.when(span > 1, F.pmod(F.xxhash64("episode_idx", stretch), span)).otherwise(F.lit(0))
    return placed.withColumn("pack_container", to.cast("int")).select(*frames.columns, "pack_container")


def _new(spark: SparkSession, path: str | None) -> str:
    return path.rstrip("/") if path else runtime.scratch_path(spark, f"{runtime.shared_dir(spark)}/kelpline-store-{uuid.uuid4().hex}")


def pack_rows(frames: DataFrame, files: DataFrame, info: DataFrame, path: str | None = None, target_bytes: int = TARGET, block_bytes: int = BLOCK_BYTES) -> Store:
    """Pack the rows of every stored file into containers below ``path`` (a scratch folder if not given), which must not exist.

    All rows are kept, repeats and copies included, with all their columns. A member is at most ``MEMBER_ROWS`` rows of a
    file, as an Arrow stream. No task holds more than one block and one member besides what Spark sorts, the rows of one
    container, whose size is counted; rows of a file larger than a container are spread by episode and stretch of frames.
    An empty table gives an empty store. Columns beyond those named may have any name but ``pack_to`` and ``pack_container``.
    """
    path = _new(frames.sparkSession, path)
    seen = frames.limit(WIDTH_ROWS).toArrow()
    counted = frames.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))
    plan, n = container_plan(counted, files, info, seen.nbytes / max(seen.num_rows, 1), target_bytes)
    blocks = _write(_place(frames, plan), n, ["file_id", "episode_idx", "frame_index"], _row_members(frames.columns, MEMBER_ROWS), block_bytes, path)
    names = plan.filter("file_id is not null").select("file_id", "dataset", "chunk", "path")
    index = blocks.select("file", "container", "block", F.explode("members").alias("m")).select("file", "container", "block", "m.file_id", "m.offset", "m.length", "m.crc32", "m.n_rows", "m.records").join(names, "file_id", "left")
    return _commit(index.fillna("", ["dataset"]), path)


def pack_files(spark: SparkSession, root: str, path: str | None = None, pattern: str = "*", target_bytes: int = TARGET, block_bytes: int = BLOCK_BYTES) -> Store:
    """Pack the files below ``root`` whose names match ``pattern``, byte for byte; their paths in the store start at ``root``.

    Sizes are listed without reading; then every file is read once; empty files are members too. ``dataset`` is the folder below the root, ``chunk``,
    ``file_id``, rows and records are null.
    """
    path = _new(spark, path)
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    top = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    name = F.substring(F.col("path"), len(top) + 2, 1 << 30)
    # a scan skips empty files; they are told by the listing, which Spark holds on the driver anyway
    every = spark.createDataFrame([(unquote(p).replace("file:///", "file:/", 1),) for p in found.inputFiles()], "path string")
    empty = runtime.materialize(every.join(found.select("path"), "path", "left_anti").withColumns({"length": F.lit(0).cast("long"), "content": F.lit(b"")}), "empty")
    found = found.select("path", "length", "content").unionByName(empty)
    listed = found.select(name.alias("path"), F.when(name.contains("/"), F.substring_index(name, "/", 1)).otherwise("").alias("dataset"), (F.col("length") + MEMBER_BYTES).alias("size"))
    plan, n = lay_out(listed, "dataset", ["path"], "size", target_bytes)
    plan = runtime.materialize(plan.select("path", "dataset", F.col("first").alias("pack_container")), "plan")
    rows = found.select(name.alias("path"), "content").join(runtime.small(plan.select("path", "pack_container")), "path")
    blocks = _write(rows, n, ["path"], _file_members, block_bytes, path)
    index = blocks.select("file", "container", "block", F.explode("members").alias("m")).select("file", "container", "block", "m.*").join(plan.select("path", "dataset"), "path")
    return _commit(index.withColumn("chunk", F.lit(None).cast("long")), path)


INDEX = ["file", "container", "block", "file_id", "dataset", "chunk", "path", "offset", "length", "crc32", "n_rows", "records"]


def _commit(index: DataFrame, path: str) -> Store:
    index.select(*INDEX).write.parquet(f"{path}/index")
    return open_store(index.sparkSession, path)


def open_store(spark: SparkSession, path: str) -> Store:
    """A store written before; one without an index was not finished and is an error."""
    path = path.rstrip("/")
    kinds = [T.StructField(c, {"file": T.StringType(), "container": T.IntegerType(), "dataset": T.StringType(), "path": T.StringType(), "records": RANGE}.get(c, T.LongType())) for c in INDEX]
    return Store(path, spark.read.schema(T.StructType(kinds)).parquet(f"{path}/index"), _blocks(spark, path))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(not s.getPath().getName().startswith("_") for s in fs.listStatus(p))


def container_files(store: Store) -> DataFrame:
    """``container, files, n_members, n_bytes, stored_bytes``: the physical files of each container and what they hold."""
    spark = store.blocks.sparkSession
    held = store.index.groupBy("container").agg(F.countDistinct("file").alias("files"), F.count(F.lit(1)).alias("n_members"), F.sum("length").alias("n_bytes"))
    if not _exists(spark, f"{store.path}/containers"):
        return held.withColumn("stored_bytes", F.lit(0).cast("long"))
    disk = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{store.path}/containers")
    disk = disk.select(F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("stored"))
    names = store.index.select("container", F.substring_index("file", "/", -1).alias("name")).distinct()
    return held.join(names.join(disk, "name").groupBy("container").agg(F.sum("stored").alias("stored_bytes")), "container", "left")


def _wanted(store: Store, paths: list[str] | None) -> DataFrame:
    """The blocks of a store, or those that hold a member of ``paths``, with ``keep``, the offsets wanted (null: all)."""
    if paths is None:
        return store.blocks.withColumn("keep", F.lit(None).cast("array<long>"))
    hits = store.index.filter(F.col("path").isin([p for p in paths])).select("file", "container", "block", "offset")
    files = [r["file"] for r in hits.select("file").distinct().collect()]  # only these are opened; as many as paths and their members
    keep = hits.groupBy("container", "block").agg(F.collect_list("offset").alias("keep"))
    return _blocks(store.blocks.sparkSession, store.path, files).join(runtime.small(keep), ["container", "block"])


def _reader(columns: list[str], schema: pa.Schema):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(b.schema.get_field_index(c))[i].as_py() for c in ("container", "block", "members", "keep")}
                payload = b.column(b.schema.get_field_index("payload"))[i].as_buffer()
                for m in row["members"]:
                    if row["keep"] is not None and m["offset"] not in row["keep"]:
                        continue
                    data = payload.slice(m["offset"], m["length"])
                    if zlib.crc32(data) != m["crc32"]:
                        raise ValueError(f"checksum of file {m['file_id']} in container {row['container']}, block {row['block']} differs")
                    with pa.ipc.open_stream(data) as r:
                        for x in r:
                            if x.num_rows:
                                yield from pa.Table.from_batches([x]).select(columns).cast(schema).to_batches()

    return unpack


def unpack_rows(store: Store, columns: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """The rows of the members (of ``paths`` only, if given), verified against their checksums, without a shuffle.

    ``columns``: a DataFrame with the columns wanted, for its schema. Blocks are decoded independently of each other.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    return _wanted(store, paths).mapInArrow(_reader(columns.columns, to_arrow_schema(columns.schema)), columns.schema)


def read_files(store: Store, paths: list[str] | None = None) -> DataFrame:
    """``path, content``: the original bytes of packed files (of ``paths`` only, if given); a wrong checksum is an error."""
    each = _wanted(store, paths).select("payload", "keep", F.explode("members").alias("m")).filter(F.col("keep").isNull() | F.array_contains("keep", F.col("m.offset")))
    data = F.substring("payload", F.col("m.offset").cast("int") + 1, F.col("m.length").cast("int"))
    each = each.select(F.col("m.path").alias("path"), F.col("m.crc32").alias("crc"), data.alias("content"))
    return each.select("path", F.when(F.crc32("content") == F.col("crc"), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("checksum differs: "), F.col("path")))).alias("content"))


def extract_files(store: Store, target: str, paths: list[str] | None = None) -> int:
    """Write packed files below ``target`` (a path or URI that pyarrow's file systems know); returns their number."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(target)
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                to = f"{root.rstrip('/')}/{path}"
                system.create_dir(to.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(f"{to}.part") as out:
                    out.write(content.as_buffer())
                system.move(f"{to}.part", to)
            yield pa.RecordBatch.from_arrays([b.column(0)], ["path"])

    return read_files(store, paths).mapInArrow(put, "path string").count()


def records_of(index: DataFrame) -> DataFrame:
    """``episode_idx, frame_index, file_id``: every record key of every member, from the index alone."""
    r = index.select("file_id", F.explode("records").alias("r"))
    return r.select(F.col("r.episode_idx").alias("episode_idx"), F.explode(F.sequence("r.first", "r.last")).alias("frame_index"), "file_id")


def record_copies(index: DataFrame) -> DataFrame:
    """``episode_idx, frame_index, first_file, last_file, n_files``: records that several files hold, with the smallest and largest."""
    rec = records_of(index).filter("file_id is not null").groupBy("episode_idx", "frame_index")
    return rec.agg(F.min("file_id").alias("first_file"), F.max("file_id").alias("last_file"), F.countDistinct("file_id").alias("n_files")).filter("n_files > 1")


def overlapping_files(index: DataFrame) -> DataFrame:
    """Pairs ``file_id_a < file_id_b`` of files that hold at least one same record: :func:`record_copies` written out.

    Records in just two files, the rule, give their pair straight from the smallest and largest, combined before the
    shuffle; only records in three or more files are looked up again.
    """
    key = ["episode_idx", "frame_index"]
    many = record_copies(index)
    two = many.filter("n_files = 2").select(F.col("first_file").alias("file_id_a"), F.col("last_file").alias("file_id_b"))
    more = records_of(index).filter("file_id is not null").join(many.filter("n_files > 2").select(*key), key).distinct()
    pairs = more.withColumnRenamed("file_id", "file_id_a").join(more.withColumnRenamed("file_id", "file_id_b"), key).filter("file_id_a < file_id_b")
    return two.unionByName(pairs.select("file_id_a", "file_id_b")).distinct()


def distinct_records(rows: DataFrame) -> DataFrame:
    """Each (``episode_idx``, ``frame_index``) once, from the smallest ``file_id`` that holds it, without null keys."""
    rest = [c for c in rows.columns if c not in ("episode_idx", "frame_index")]
    first = F.min_by(F.struct(*rest), F.struct(F.col("file_id").isNull(), F.col("file_id"))).alias("r")
    return rows.filter("episode_idx is not null and frame_index is not null").groupBy("episode_idx", "frame_index").agg(first).select("episode_idx", "frame_index", *[f"r.{c}" for c in rest])


def packed_overlaps(frames: DataFrame, files: DataFrame, info: DataFrame, **how) -> DataFrame:
    """Pack, then tell from the written index which files hold a same record."""
    return overlapping_files(pack_rows(frames, files, info, **how).index)
