"""Grey images from files: portable grey maps, PNG, raw 32-bit floats. Headers give sizes without decoding pixels."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

PNG = b"\x89PNG\r\n\x1a\n"
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def size_of(data: bytes) -> tuple[int, int] | None:
    """(height, width) from a header; None if it is none of the known ones."""
    if data.startswith(PNG):
        wide, high = struct.unpack(">II", data[16:24])
        return high, wide
    if m := re.match(rb"P5\s+(?:#[^\n]*\s+)*(\d+)\s+(\d+)\s+(\d+)\s", data):
        return int(m[2]), int(m[1])
    return None


def decode(data: bytes) -> np.ndarray:
    """[y, x] as float64; colours become their mean, transparency is dropped. ValueError for what isn't known."""
    size = size_of(data)
    if data.startswith(PNG):
        return _png(data, size)
    if size:
        m = re.match(rb"P5\s+(?:#[^\n]*\s+)*(\d+)\s+(\d+)\s+(\d+)\s", data)
        return np.frombuffer(data, ">u2" if int(m[3]) > 255 else np.uint8, size[0] * size[1], m.end()).reshape(size).astype(np.float64)
    raise ValueError("not an image of a known kind")


def _png(data: bytes, size: tuple[int, int]) -> np.ndarray:
    high, wide = size
    depth, color, _, _, interlaced = data[24:29]
    if depth not in (8, 16) or interlaced or color not in _CHANNELS:
        raise ValueError("only 8 or 16 bits, not interlaced")
    at, packed, palette = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        packed += data[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        palette = np.frombuffer(data[at + 8 : at + 8 + n], np.uint8).reshape(-1, 3) if kind == b"PLTE" else palette
        at += 12 + n
    step = _CHANNELS[color] * depth // 8
    rows = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(high, 1 + wide * step)
    out, up = np.zeros((high, wide * step), np.uint8), np.zeros(wide * step, np.int64)
    for y in range(high):
        up = _unfiltered(int(rows[y, 0]), rows[y, 1:].astype(np.int64), up, step)
        out[y] = up
    v = out.view(">u2").astype(np.float64) if depth == 16 else out.astype(np.float64)
    v = v.reshape(high, wide, _CHANNELS[color])
    if color == 3:
        return palette[v[..., 0].astype(int)].mean(axis=2)
    return v[..., : 3 if _CHANNELS[color] >= 3 else 1].mean(axis=2)


def _unfiltered(kind: int, line: np.ndarray, up: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return (line + up) & 255
    if kind == 1:
        return np.cumsum(line.reshape(-1, step), axis=0).ravel() & 255
    out = np.zeros(len(line) + step, np.int64)
    corner = np.concatenate([np.zeros(step, np.int64), up])
    for i in range(len(line)):
        a, b, c = out[i], up[i], corner[i]
        if kind == 3:
            guess = (a + b) // 2
        else:
            p = a + b - c
            guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        out[i + step] = (line[i] + guess) & 255
    return out[step:]


def read_images(spark: SparkSession, path: str, glob: str = "*", pixels: bool = True) -> DataFrame:
    """path, bytes, height, width, pixels (f32, row by row, or null) of a folder's images, searched recursively.

    Without ``pixels`` only headers are decoded. What isn't an image has null size.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for data in f["content"]:
                size = size_of(bytes(data[:64]))
                try:
                    rows.append((*size, decode(bytes(data)).astype("<f4").tobytes() if pixels else None) if size else (None, None, None))
                except ValueError:
                    rows.append((None, None, None))
            yield pd.DataFrame({"path": f["path"], "bytes": f["length"], "height": pd.array([r[0] for r in rows], "Int32"), "width": pd.array([r[1] for r in rows], "Int32"), "pixels": [r[2] for r in rows]})

    return files.select("path", "length", "content").mapInPandas(run, "path string, bytes long, height int, width int, pixels binary")
