"""Column functions for text: readable durations and sizes, flags, tuples, resource addresses, natural order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of a flag.
TRUE_WORDS = ("1", "true", "t", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "f", "no", "n", "off")


def duration_text(seconds: Column, hours: bool = True) -> Column:
    """``1h 2m 3s``, ``2m 3s`` or ``3s`` of whole seconds; without ``hours`` minutes may exceed 59."""
    s = seconds.cast("long")
    m, h = F.floor(s / 60), F.floor(s / 3600)
    short = F.when(m > 0, F.format_string("%dm %ds", m, F.pmod(s, F.lit(60)))).otherwise(F.format_string("%ds", s))
    if not hours:
        return short
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))).otherwise(short)


def size_text(size: Column) -> Column:
    """Decimal GB from 1e9 bytes, else MB, with two digits."""
    return F.when(size >= 1_000_000_000, F.format_string("%.2f GB", size / 1e9)).otherwise(F.format_string("%.2f MB", size / 1e6))


def flag(text: Column) -> Column:
    """Boolean of a flag's word in any case, null for other words."""
    t = F.lower(F.trim(text))
    return F.when(t.isin(*TRUE_WORDS), True).when(t.isin(*FALSE_WORDS), False)


def at_least(text: Column, default: int, least: int) -> Column:
    """An integer option: the default if it is no integer, raised to ``least``."""
    return F.greatest(F.coalesce(F.trim(text).try_cast("int"), F.lit(default)), F.lit(least))


def number_tuple(text: Column, n: int = 3) -> Column:
    """``"x y z"`` as doubles; null or blank gives zeros, words that are no numbers null."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t == "", F.array_repeat(F.lit(0.0), n)).otherwise(F.transform(F.split(t, r"\s+"), lambda x: x.try_cast("double")))


def number_list(numbers: Column, digits: int, separator: str = ", ") -> Column:
    """Numbers with ``digits`` decimals as ``[a, b]``; null elements are left out."""
    texts = F.transform(F.filter(numbers, lambda x: x.isNotNull()), lambda x: F.format_string(f"%.{digits}f", x.cast("double")))
    return F.when(numbers.isNotNull(), F.concat(F.lit("["), F.array_join(texts, separator), F.lit("]")))


def package_map(text: Column) -> Column:
    """``a: path, b: path`` as a map, null where the text is a single path or address instead."""
    pairs = F.transform(F.filter(F.split(text, ","), lambda x: F.trim(x) != ""), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("key"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))
    return F.when(text.rlike(r"^\s*[^:/\s]+\s*:(?!//)"), F.map_from_entries(pairs))


def resolve_resource(path: Column, packages: Column | Callable[[Column], Column] | None, root: Column | None, working: Column) -> Column:
    """Address of a mesh. ``package://name/rest`` goes by ``packages``, a map or a function of the name (null for
    unknown names) or, with a single ``root``, below it - which is the package itself if it ends in the name, else its parent; other paths follow ``working``."""
    name = F.regexp_extract(path, r"^package://([^/]+)/?(.*)$", 1)
    rest = F.regexp_extract(path, r"^package://([^/]+)/?(.*)$", 2)
    bare = F.regexp_replace(root, "/+$", "") if root is not None else F.lit(None).cast("string")
    single = F.when(bare.endswith(name), F.concat_ws("/", bare, rest)).otherwise(F.concat_ws("/", bare, name, rest))
    at = packages(name) if callable(packages) and not isinstance(packages, Column) else None if packages is None else F.try_element_at(packages, name)
    known = single if at is None else F.when(at.isNotNull(), F.concat_ws("/", at, rest))
    return F.when(path.startswith("package://"), known).otherwise(F.concat(F.coalesce(working, F.lit("")), path))


def natural_key(name: Column) -> list[Column]:
    """Sort by the last number in a name, then by the name; names without one come last."""
    n = F.try_element_at(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), F.lit(-1)).cast("double")
    return [n.asc_nulls_last(), name.asc()]


def codec(name: Column) -> Column:
    """``hevc`` or ``h264`` for the usual names of these codecs, others unchanged."""
    n = F.lower(name)
    has = lambda *words: F.greatest(*[n.contains(w) for w in words]) if len(words) > 1 else n.contains(words[0])
    return F.when(has("hevc", "h265", "x265"), "hevc").when(has("h264", "avc", "x264"), "h264").otherwise(name)
