"""Episodes as reinforcement-learning steps, flat and nested."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Schema of a camera's calibration.
CALIBRATION = "struct<found:boolean,K:array<double>,D:array<double>,P:array<double>,width:int,height:int,distortion_model:string>"


def steps(frames: DataFrame, fps: Column | float, instruction: Column, keys: tuple[str, ...] = ("episode_idx",), order: str = "frame_index") -> DataFrame:
    """``frames`` with ``step``, ``is_first``, ``is_last``, ``is_terminal``, ``reward``, ``discount``, ``step_time`` and ``language_instruction``.

    Only the last step is terminal, with reward 1 and discount 0. Number and count share one sort per episode.
    """
    w = Window.partitionBy(*keys)
    f = frames.withColumns({"step": (F.row_number().over(w.orderBy(order)) - 1).cast("long"), "n_steps": F.count("*").over(w)})
    last = F.col("step") == F.col("n_steps") - 1
    return f.withColumns({
        "is_first": F.col("step") == 0, "is_last": last, "is_terminal": last, "reward": F.when(last, 1.0).otherwise(0.0), "discount": F.when(last, 0.0).otherwise(1.0),
        "step_time": F.col("step") / fps, "language_instruction": instruction,
    })


def nested(stepped: DataFrame, columns: list[str], keys: tuple[str, ...] = ("episode_idx",)) -> DataFrame:
    """One row per episode with its ``steps`` in order, an array of structs, and ``n_steps``. An episode is one row by definition."""
    return stepped.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("step", *columns))), lambda s: F.struct(*[s[c].alias(c) for c in columns])).alias("steps"), F.count("*").alias("n_steps"))


def first_calibration(infos: DataFrame, camera: str = "camera", order: str = "seq") -> DataFrame:
    """The first calibration of each bag and camera."""
    rest = [c for c in infos.columns if c not in ("bag", camera, order)]
    return infos.groupBy("bag", camera).agg(F.min_by(F.struct(*rest), order).alias("c")).select("bag", camera, "c.*")


def with_calibration(cameras: DataFrame, infos: DataFrame, camera: str = "camera") -> DataFrame:
    """Every wanted camera with its calibration, or with ``found`` false, zeros and an empty model."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    j = cameras.join(infos.withColumn("found", F.lit(True)), ["bag", camera], "left")
    fill = {"found": F.lit(False), "K": zeros(9), "D": zeros(0).cast("array<double>"), "P": zeros(12), "width": F.lit(0), "height": F.lit(0), "distortion_model": F.lit("")}
    return j.withColumns({c: F.coalesce(F.col(c), v) for c, v in fill.items() if c in j.columns})


def camera_size(packet_w: Column, packet_h: Column, info_w: Column, info_h: Column, default: tuple[int, int]) -> Column:
    """Width and height: of the packets, else of a calibration whose both are positive, else the default."""
    pair = lambda w, h: F.struct(w.cast("int").alias("width"), h.cast("int").alias("height"))
    return F.coalesce(F.when(packet_w.isNotNull() & packet_h.isNotNull(), pair(packet_w, packet_h)), F.when((info_w > 0) & (info_h > 0), pair(info_w, info_h)), pair(F.lit(default[0]), F.lit(default[1])))


def crop_box(width: Column, height: Column, left_half: Column, side: int = 224) -> Column:
    """What of a picture is kept before it is scaled to ``side`` squared: the left half of stereo pictures, else all."""
    return F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.when(left_half, F.floor(width / 2)).otherwise(width).cast("int").alias("width"), height.cast("int").alias("height"), F.lit(side).alias("side"))


def images_by_row(frames: DataFrame, images: Column, keys: tuple[str, ...] = ("episode_idx",), order: str = "frame_index") -> DataFrame:
    """``image`` of each frame from its episode's array of images, by position; null beyond its end."""
    w = Window.partitionBy(*keys).orderBy(order)
    return frames.withColumn("image", F.try_element_at(images, F.row_number().over(w)))
