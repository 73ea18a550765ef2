"""Kernels over rows of images: (image_id, height, width, pixels as little-endian f32), one image in memory at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CANDIDATES = "image_id long, x int, y int, w int, h int, fill double, score double, scale int"


def assembled(cells: DataFrame, key: str) -> DataFrame:
    """Images of dense cells (key, y, x, v): one row each, pixels row by row."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("y", "x", "v"))), lambda c: c["v"].cast("float"))
    g = cells.groupBy(F.col(key).cast("long").alias("image_id")).agg(ordered.alias("values"), (F.max("y") + 1).cast("int").alias("height"), (F.max("x") + 1).cast("int").alias("width"))
    return g


def array_of(row) -> np.ndarray:
    v = row.pixels if hasattr(row, "pixels") else row.values_
    a = np.frombuffer(v, "<f4") if isinstance(v, bytes) else np.asarray(v, np.float32)
    return a.reshape(row.height, row.width).astype(np.float64)


def per_image(images: DataFrame, kernel: Callable[[np.ndarray], list[dict]], schema: str) -> DataFrame:
    """Rows that ``kernel`` makes of each image, with its image_id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.rename(columns={"values": "values_"}).itertuples():
                made = kernel(array_of(row))
                if made:
                    yield pd.DataFrame(made).assign(image_id=row.image_id)

    return images.mapInPandas(run, schema)
