"""Column functions for paths, path templates and padded names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_path(path: Column) -> Column:
    """One spelling per file: single slashes, no ``./`` and no leading slash."""
    once = F.regexp_replace(path, "/(\\./|/)+", "/")
    return F.regexp_replace(once, "^(\\./|/)+", "")


def zero_pad(number: Column, width: Column | int) -> Column:
    """Decimal text of at least ``width`` digits; longer numbers are not cut."""
    text = number.cast("string")
    width = F.lit(width) if isinstance(width, int) else width
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def _field(template: Column, name: str) -> Column:
    return F.regexp_extract(template, r"(\{" + name + r"(:[^}]*)?\})", 1)


def _put(template: Column, field: Column, value: Column) -> Column:
    return F.when(field == "", template).otherwise(F.replace(template, field, value))


def read_template(template: Column, video_key: Column | None = None) -> Column:
    """A template such as ``{episode_chunk:03d}/{video_key}/{episode_index:06d}.mp4`` taken apart once, for :func:`fill`.

    The video key, if given, is put in; fields that do not occur are empty texts.
    """
    if video_key is not None:
        template = _put(template, _field(template, "video_key"), video_key)
    width = lambda name: F.coalesce(F.regexp_extract(template, r"\{" + name + r":0?(\d+)d?\}", 1).try_cast("int"), F.lit(1))
    parts = {"text": template} | {f"{k}_field": _field(template, f"episode_{k}") for k in ("chunk", "index")} | {f"{k}_width": width(f"episode_{k}") for k in ("chunk", "index")}
    return F.struct(*[v.alias(k) for k, v in parts.items()])


def fill(parts: Column, chunk: Column, index: Column) -> Column:
    """The path of an episode from a template taken apart by :func:`read_template`; null if any part is null."""
    out = _put(parts["text"], parts["chunk_field"], zero_pad(chunk, parts["chunk_width"]))
    return _put(out, parts["index_field"], zero_pad(index, parts["index_width"]))


def fill_template(template: Column, chunk: Column, index: Column, video_key: Column | None = None) -> Column:
    """:func:`read_template` and :func:`fill` in one. Where rows share few templates, take these apart before joining."""
    return fill(read_template(template, video_key), chunk, index)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(base_name(path), r"(?<=.)(\.[^.]*)$", 1))


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def index_in_name(path: Column) -> Column:
    """The number after ``episode_`` in a file name, null if there is none."""
    return F.regexp_extract(base_name(path), r"episode_(\d+)", 1).try_cast("long")
