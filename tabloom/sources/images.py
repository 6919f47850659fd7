"""Image folders: listing with a date from the name, size and mode audit."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.functions.scalar import basename


def image_dates(files: DataFrame) -> DataFrame:
    """(path, file, date) of paths whose file name starts with ``yyyy_MM_dd``."""
    name = basename("path")
    date = F.try_to_date(F.substring(name, 1, 10), "yyyy_MM_dd")
    return files.select("path", name.alias("file"), date.alias("date"))


def list_images(spark: SparkSession, path: str) -> DataFrame:
    """The same for a folder; only its listing is read."""
    return image_dates(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Size and channels of every image: (file, width, height, channels)."""
    img = spark.read.format("image").option("dropInvalid", False).load(path)
    return img.select(basename("image.origin").alias("file"), F.col("image.width").alias("width"),
                      F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"))


def audit_images(images: DataFrame) -> DataFrame:
    """Images that differ in size from the base, or are not square RGB.

    The base is the first square three-channel image by name.
    """
    good = (F.col("channels") == 3) & (F.col("width") == F.col("height"))
    base = images.filter(good).agg(F.min_by("width", "file")).scalar()
    problem = (
        F.when(F.col("channels") != 3, F.lit("mode"))
        .when(F.col("width") != F.col("height"), F.lit("not square"))
        .when(F.col("width") != base, F.lit("size"))
    )
    return images.select("file", problem.alias("problem")).filter("problem is not null")


def detect(images: DataFrame, fn: Callable[[bytes], list[tuple]], columns: str) -> DataFrame:
    """Run a caller's detector on each image (path, content): one row per detection.

    ``fn`` gets the bytes of one image and returns tuples that match ``columns``.
    """
    names = [c.strip().split(" ")[0] for c in columns.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, *found) for path, content in zip(batch["path"], batch["content"])
                    for found in fn(content)]
            yield pd.DataFrame(rows, columns=["path", *names])

    return images.select("path", "content").mapInPandas(run, f"path string, {columns}")
