"""Token ids of whole texts by a public tokenizer, and back.

Texts go through Arrow batches into the ``tokenizers`` library. Null and empty texts have no ids; blanks are text.
Bytes that are no valid UTF-8 are read as U+FFFD. Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the public vocabulary files; a parameter of every operator here.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
DEFAULT = "byte_bpe_50k.json"
#: Texts are handed over in groups of about so many characters, which bounds a worker's memory.
GROUP_CHARS = 1 << 20


def byte_table() -> dict[int, str]:
    """Byte to character of byte-level vocabularies: printable Latin-1 stands for itself, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def _texts(col: pa.Array) -> list[str | None]:
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    return [None if x is None else x.decode("utf-8", "replace") for x in col.to_pylist()]


def _encoder(path: str, text_at: int, offsets: bool, count_only: bool, group: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _load(path)
        for b in batches:
            texts = _texts(b.column(text_at))
            keep = [i for i in range(b.num_columns) if i != text_at]
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop] or "") <= group):
                    chars += len(texts[stop] or "")
                    stop += 1
                part = texts[start:stop]
                enc = t.encode_batch([x or "" for x in part], add_special_tokens=False)
                rest = [b.column(i).slice(start, stop - start) for i in keep]
                names = [b.schema.names[i] for i in keep]
                if count_only:
                    rest.append(pa.array([len(e) for e in enc], pa.int64()))
                    names.append("n_tokens")
                else:
                    rest.append(pa.array([e.ids for e in enc], pa.list_(pa.int32())))
                    names.append("ids")
                    if offsets:
                        rest.append(pa.array([[{"start": p, "end": q} for p, q in e.offsets] for e in enc], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
                        names.append("offsets")
                yield pa.RecordBatch.from_arrays(rest, names)
                start = stop

    return run


def _run(df: DataFrame, text: str, add: list[T.StructField], tokenizer: str, folder: str, offsets: bool, count_only: bool) -> DataFrame:
    clash = {f.name for f in add} & set(df.columns)
    if clash:
        df = df.withColumnsRenamed({c: f"{c}_in" for c in clash})
        text = f"{text}_in" if text in clash else text
    schema = T.StructType([f for f in df.schema.fields if f.name != text] + add)
    return df.mapInArrow(_encoder(f"{folder}/{tokenizer}", df.columns.index(text), offsets, count_only, GROUP_CHARS), schema)


def encode(df: DataFrame, text: str = "text", tokenizer: str = DEFAULT, folder: str = TOKENIZERS, offsets: bool = False) -> DataFrame:
    """``df`` with ``ids`` (and ``offsets``, in characters of the text) in place of ``text``; a clashing column gets the suffix ``_in``."""
    add = [T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if offsets:
        add.append(T.StructField("offsets", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))))
    return _run(df, text, add, tokenizer, folder, offsets, False)


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str = DEFAULT, folder: str = TOKENIZERS) -> DataFrame:
    """``df`` with ``n_tokens`` (long) in place of ``text``."""
    return _run(df, text, [T.StructField("n_tokens", T.LongType())], tokenizer, folder, False, True)


def _decoder(path: str, ids_at: int, schema_names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = {c: b for b, c in byte_table().items()}
        t = _load(path)
        table = {i: bytes(back[c] for c in s) if all(c in back for c in s) else s.encode() for s, i in t.get_vocab(True).items()}
        for b in batches:
            out = [None if ids is None else b"".join(table[i] for i in ids).decode("utf-8", "replace") for ids in b.column(ids_at).to_pylist()]
            cols = [b.column(i) for i in range(b.num_columns) if i != ids_at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.string())], schema_names)

    return run


def decode(df: DataFrame, ids: str = "ids", tokenizer: str = DEFAULT, folder: str = TOKENIZERS) -> DataFrame:
    """``df`` with ``text`` in place of ``ids``, for byte-level tokenizers.

    The bytes of all ids are joined before they are read as UTF-8, so characters split over ids come out whole; a list
    cut inside a character ends in U+FFFD. Null ids give null, no ids the empty text.
    """
    if "text" in df.columns:
        df = df.withColumnRenamed("text", "text_in")
    rest = [f for f in df.schema.fields if f.name != ids]
    return df.mapInArrow(_decoder(f"{folder}/{tokenizer}", df.columns.index(ids), [*[f.name for f in rest], "text"]), T.StructType([*rest, T.StructField("text", T.StringType())]))


def round_trip(df: DataFrame, text: str = "text", **how) -> DataFrame:
    """``df`` with ``n_tokens`` and ``same``: whether decoding the ids gives the text again (null and empty alike)."""
    kept = df.withColumn("kept", F.coalesce(F.col(text), F.lit("")))
    back = decode(encode(kept, text, **how), "ids", **{k: v for k, v in how.items() if k != "offsets"})
    return back.select(*[c for c in df.columns if c != text], (F.col("text") == F.col("kept")).alias("same"), F.length("kept").alias("n_chars"))
