"""Detection training records from image files and box annotations.

Image bytes are read by the ``binaryFile`` source only for the rows that
survive the join; width/height come from the annotation sidecar, so no pixel
decoding is needed. Box arithmetic is array higher-order functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mlframe.functions.hashing import hash_uniform


def normalise_box(bbox, width, height) -> Column:
    """[x, y, w, h] in pixels -> [xmin, ymin, xmax, ymax] in [0, 1]."""
    b = F.col(bbox) if isinstance(bbox, str) else bbox
    w = F.col(width).cast("double") if isinstance(width, str) else width
    h = F.col(height).cast("double") if isinstance(height, str) else height
    return F.array(b[0] / w, b[1] / h, (b[0] + b[2]) / w, (b[1] + b[3]) / h)


def pad_to(arr, n: int, fill) -> Column:
    """Cut an array to ``n`` elements or pad it with ``fill``."""
    a = F.col(arr) if isinstance(arr, str) else arr
    cut = F.slice(a, 1, n)
    return F.concat(cut, F.array_repeat(fill, F.greatest(F.lit(0), F.lit(n) - F.size(cut))))


def detection_records(images: DataFrame, annotations: DataFrame, max_objects: int = 30,
                      val_frac: float = 0.2) -> DataFrame:
    """``images``: binaryFile rows (path, content); ``annotations``: one row
    per image with file_name, width, height and objects array<struct<bbox,
    category>>. Joined on the file's base name; categories shifted by +1 so
    0 is padding; boxes padded/cut to ``max_objects``; hash split."""
    img = images.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "content")
    ann = annotations.select(
        "file_name", "width", "height",
        F.transform("objects", lambda o: normalise_box(o["bbox"], F.col("width"), F.col("height"))).alias("boxes"),
        F.transform("objects", lambda o: o["category"] + 1).alias("categories"),
        F.size("objects").alias("n_objects"))
    j = img.join(ann, "file_name")
    zero_box = F.array(*[F.lit(0.0)] * 4)
    return j.select(
        "file_name", "content", "width", "height", F.least("n_objects", F.lit(max_objects)).alias("n_objects"),
        pad_to("boxes", max_objects, zero_box).alias("boxes"),
        pad_to("categories", max_objects, F.lit(0)).alias("categories"),
        F.when(hash_uniform("file_name", lane="val") < val_frac, "val").otherwise("train").alias("split"))


def write_records(df: DataFrame, path: str, shards: int = 8) -> str:
    """Sharded write, one folder per split."""
    df.repartition(shards, "split").write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_images(spark: SparkSession, path: str, glob: str = "*.png") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
