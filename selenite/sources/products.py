"""Image products band by band: labels are read by themselves, and of the pixels only the bands that are asked for.

``labels`` lists a folder with Spark and reads no more of a file than its label takes. ``read_bands`` deals the wanted (file, band)
pairs out over tasks, each of which seeks its band: one run of bytes where bands follow one another, a run a line where lines
alternate between bands. Where bands alternate from pixel to pixel the lines are read in blocks and the other bands dropped.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pds

#: Bytes of a file that a label may take, and that are read at once while it is looked for.
LONGEST, PIECE = 1 << 20, 1 << 14
#: Bytes of pixel-interleaved lines that are in memory at once.
BLOCK = 1 << 24
LABELS = "path string, problem string, height int, width int, bands int, fields map<string,string>, place string, read long"
BANDS = "path string, problem string, height int, width int, bands int, fields map<string,string>, band int, pixels binary, read long"


def opened(path: str):
    """A file of whatever store Spark listed it from, for seeking."""
    store, at = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return store.open_input_file(at)


def label_text(f) -> tuple[str, int, int]:
    """(label, bytes that it takes, bytes read): up to the END of a text label or the closing tag of an XML one; "" if there is none."""
    data = b""
    while len(data) < LONGEST:
        piece = f.read_at(PIECE, len(data))
        data += piece
        end = re.search(rb"\nEND[ \t]*(\r?\n|\Z)", data) or re.search(rb"</Product_\w+>", data)
        if end:
            return data[: end.end()].decode("latin-1"), end.start() + 4 if b"END" in end.group() else end.end(), len(data)
        if len(piece) < PIECE:
            break
    return "", 0, len(data)


def beside(path: str, name: str) -> str:
    return f"{path.rpartition('/')[0]}/{name}"


def text_place(path: str, label: dict, taken: int) -> dict:
    """Where and how the pixels of a text label lie. A pointer names a file, a file and a record, or a record of the label's own
    file; records of fixed length count from 0. Without a usable pointer the pixels follow the label."""
    lines, samples, bands, kind, storage, prefix, suffix = pds.layout(label)
    pointer = next((v for k, v in label.items() if k.rpartition(" > ")[2] in ("^IMAGE", "^DATA")), None)
    name, record = pointer[:2] if isinstance(pointer, tuple) and len(pointer) > 1 else (pointer, None) if isinstance(pointer, str) else (None, pointer)
    size = int(pds.leaf(label, "RECORD_BYTES", 0) or 0)
    if name is not None:
        path, offset = beside(path, str(name)), record * size if isinstance(record, int) else 0
    elif isinstance(record, int) and size and str(pds.leaf(label, "RECORD_TYPE", "")).upper() == "FIXED_LENGTH":
        offset = record * size
    else:
        offset = pds.pixel_offset(label, taken)
    table = next((v for k, v in label.items() if k.rpartition(" > ")[2] in ("LUT_DATA", "LUT_VALUE") and isinstance(v, tuple)), None)
    return {"file": path, "offset": offset, "lines": lines, "samples": samples, "bands": bands, "kind": kind.str, "storage": storage, "prefix": prefix, "suffix": suffix, "table": table}


def xml_place(path: str, text: str) -> dict:
    """The same of the first array of two or three axes in an XML label; of three the first is the band."""
    name = lambda e: e.tag.rpartition("}")[2].lower()
    root = ET.fromstring(text)
    first = lambda e, *names: next((x.text.strip() for x in e.iter() if name(x) in names and x.text), None)
    array = next(e for e in root.iter() if name(e).startswith(("array_2d", "array_3d")))
    axes = [a for a in array.iter() if name(a) == "axis_array"]
    axes.sort(key=lambda a: int(first(a, "sequence_number") or 0))
    shape = [int(first(a, "elements", "axis_size")) for a in axes]
    streams = [e.attrib["offset"] for e in root.iter() if name(e) == "byte_stream" and "offset" in e.attrib]
    offset = int(first(array, "offset") or (streams[-1] if streams else 0))
    bands, lines, samples = shape if len(shape) == 3 else (1, *shape)
    return {"file": beside(path, first(root, "file_name") or path.rpartition("/")[2]), "offset": offset, "lines": lines, "samples": samples, "bands": bands, "kind": np.dtype(pds.ARRAYS[first(array, "data_type")]).str, "storage": "BAND_SEQUENTIAL", "prefix": 0, "suffix": 0, "table": None}


def band_of(f, p: dict, band: int) -> tuple[np.ndarray, int]:
    """(lines x samples of one band, bytes read); too short a file raises ValueError."""
    kind, lines, samples, bands = np.dtype(p["kind"]), p["lines"], p["samples"], p["bands"]
    own = samples * kind.itemsize
    read = 0

    def take(at: int, n: int) -> np.ndarray:
        nonlocal read
        data = f.read_at(n, p["offset"] + at)
        read += len(data)
        if len(data) < n:
            raise ValueError(f"{len(data)} bytes of {n}")
        return np.frombuffer(data, np.uint8)

    if p["storage"] == "LINE_INTERLEAVED":
        step = p["prefix"] + bands * own + p["suffix"]
        raw = np.concatenate([take(i * step + p["prefix"] + band * own, own) for i in range(lines)])
        return raw.view(kind).reshape(lines, samples), read
    if p["storage"] == "SAMPLE_INTERLEAVED":
        step = p["prefix"] + bands * own + p["suffix"]
        each = max(1, BLOCK // step)
        parts = []
        for i in range(0, lines, each):
            n = min(each, lines - i)
            block = take(i * step, n * step).reshape(n, step)[:, p["prefix"] : p["prefix"] + bands * own]
            parts.append(np.ascontiguousarray(block).view(kind).reshape(n, samples, bands)[:, :, band].copy())
        return np.concatenate(parts), read
    step = p["prefix"] + own + p["suffix"]
    raw = take(band * lines * step, lines * step).reshape(lines, step)[:, p["prefix"] : p["prefix"] + own]
    return np.ascontiguousarray(raw).view(kind), read


def labels(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, problem, height, width, bands, fields, place (JSON, where the pixels lie), read (bytes) of every file under ``path``.

    Spark lists the files; of each only the label is read. Files without a usable label say why in problem and have no size.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame["path"]:
                row = dict.fromkeys(("problem", "height", "width", "bands", "fields", "place", "read")) | {"path": path}
                with opened(path) as f:
                    text, taken, row["read"] = label_text(f)
                try:
                    if not text:
                        raise ValueError("no label")
                    fields = pds.parse_label(text)
                    row["fields"] = {k: str(v) for k, v in fields.items()}
                    place = xml_place(path, text) if re.match(r"\s*(<\?xml|<Product)", text) else text_place(path, fields, taken)
                    row |= {"height": place["lines"], "width": place["samples"], "bands": place["bands"], "place": json.dumps(place)}
                except (KeyError, StopIteration, TypeError, ValueError, ET.ParseError) as e:
                    row["problem"] = f"{type(e).__name__}: {e}"
                rows.append(row)
            yield pd.DataFrame(rows).astype({c: "Int32" for c in ("height", "width", "bands")})[[c.split()[0] for c in LABELS.split(", ")]]

    return files.mapInPandas(run, LABELS)


def read_bands(spark: SparkSession, path: str, bands: list[int] | None = None, glob: str = "*", raw: bool = False) -> DataFrame:
    """path, problem, height, width, bands, fields, band, pixels (32-bit floats, line by line), read (bytes of pixels read).

    ``bands`` counts from 0, None is all; bands that a product doesn't have give no row. Masked bits, missing and invalid values
    are settled as the label says, the latter as NaN; ``raw`` keeps all numbers and applies the label's lookup table instead.
    A file that is too short has null pixels and says so in problem. A task holds one band at a time.
    """
    found = labels(spark, path, glob).filter("place IS NOT NULL").drop("read")
    pairs = found.withColumn("band", F.explode(F.sequence(F.lit(0), F.col("bands") - 1)))
    if bands is not None:
        pairs = pairs.filter(F.col("band").isin(list(bands)))
    columns = [c.split()[0] for c in BANDS.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                place, pixels, read, problem = json.loads(row["place"]), None, 0, None
                try:
                    with opened(place["file"]) as f:
                        values, read = band_of(f, place, row["band"])
                    if raw:
                        table = place["table"]
                        values = np.asarray(table)[np.clip(values, 0, len(table) - 1)] if table else values
                    else:
                        values = pds.calibrated({k: pds.value_of(v) for k, v in dict(row["fields"]).items()}, values)
                    pixels = values.astype("<f4").tobytes()
                except (OSError, ValueError) as e:
                    problem = f"{type(e).__name__}: {e}"
                yield pd.DataFrame([row | {"pixels": pixels, "read": read, "problem": problem}])[columns]

    return pairs.repartition("path", "band").mapInPandas(run, BANDS)
