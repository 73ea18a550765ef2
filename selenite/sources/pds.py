"""Image products with labels: nested text labels, XML labels and the pixel cubes that they describe.

``read_products`` reads files as bytes and decodes them by rows; only the header is decoded where pixels aren't asked for.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: Sample types of labels: (byte order, kind). Fixed values.
SAMPLES = {
    "MSB_UNSIGNED_INTEGER": ">u", "UNSIGNED_INTEGER": ">u", "SUN_UNSIGNED_INTEGER": ">u", "MAC_UNSIGNED_INTEGER": ">u",
    "MSB_INTEGER": ">i", "INTEGER": ">i", "SUN_INTEGER": ">i", "MAC_INTEGER": ">i",
    "LSB_UNSIGNED_INTEGER": "<u", "PC_UNSIGNED_INTEGER": "<u", "VAX_UNSIGNED_INTEGER": "<u",
    "LSB_INTEGER": "<i", "PC_INTEGER": "<i", "VAX_INTEGER": "<i",
    "IEEE_REAL": ">f", "FLOAT": ">f", "REAL": ">f", "SUN_REAL": ">f", "MAC_REAL": ">f", "PC_REAL": "<f",
}
ARRAYS = {"UnsignedByte": "u1", "SignedByte": "i1", "UnsignedMSB2": ">u2", "UnsignedLSB2": "<u2", "SignedMSB2": ">i2", "SignedLSB2": "<i2", "SignedMSB4": ">i4", "SignedLSB4": "<i4", "UnsignedMSB4": ">u4", "UnsignedLSB4": "<u4", "IEEE754MSBSingle": ">f4", "IEEE754LSBSingle": "<f4", "IEEE754MSBDouble": ">f8", "IEEE754LSBDouble": "<f8"}
HEADER = 1 << 20


def value_of(text: str):
    """int, float, tuple or text of a label's value; units go, quotes go, ``2#101#`` is a number of that base."""
    t = text.strip()
    if t[:1] in "({" and t[-1:] in ")}":
        return tuple(value_of(x) for x in re.findall(r'"[^"]*"|[^,]+', t[1:-1]) if x.strip())
    if len(t) > 1 and t[0] == t[-1] and t[0] in "\"'":
        return t[1:-1]
    if m := re.fullmatch(r"(\d+)#([0-9A-Za-z]+)#", t):
        return int(m[2], int(m[1]))
    t = re.sub(r"\s*<[^>]*>\s*$", "", t)
    for kind in (int, float):
        try:
            return kind(t)
        except ValueError:
            pass
    return t


def parse_text_label(text: str) -> dict:
    """Flat fields; those of objects under ``OBJECT > KEY``. A value goes on over lines while a quote or bracket is open."""
    out, stack, held = {}, [], ""
    for line in text.replace("\r", "").split("\n"):
        line = re.sub(r"/\*.*?\*/", "", line).rstrip()
        if not held and line.strip() == "END":
            break
        held = f"{held} {line.strip()}" if held else line
        if held.count('"') % 2 or held.count("(") > held.count(")") or held.count("{") > held.count("}"):
            continue
        key, eq, value = held.partition("=")
        key, held = key.strip(), ""
        if not eq:
            if key in ("END_OBJECT", "END_GROUP") and stack:
                stack.pop()
        elif key in ("OBJECT", "GROUP"):
            stack.append(value.strip())
        elif key in ("END_OBJECT", "END_GROUP"):
            stack and stack.pop()
        elif key:
            out[" > ".join([*stack, key])] = value_of(value)
    return out


def parse_xml_label(text: str) -> dict:
    """Tags without namespace; the first of a name wins. Broken XML: no fields."""
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return {}
    out: dict = {}
    for el in root.iter():
        if el.text and el.text.strip():
            out.setdefault(el.tag.rpartition("}")[2], value_of(el.text))
    return out


def parse_label(text: str) -> dict:
    return parse_xml_label(text) if re.match(r"\s*(<\?xml|<Product)", text) else parse_text_label(text)


def leaf(label: dict, key: str, default=None):
    """The last field whose last part is ``key``."""
    found = [v for k, v in label.items() if k.rpartition(" > ")[2] == key]
    return found[-1] if found else default


def layout(label: dict) -> tuple[int, int, int, np.dtype, str, int, int]:
    """(lines, samples, bands, type, storage, prefix bytes, suffix bytes) of an image."""
    bits = int(leaf(label, "SAMPLE_BITS", 8))
    kind = SAMPLES.get(str(leaf(label, "SAMPLE_TYPE", "MSB_UNSIGNED_INTEGER")), ">u")
    return int(leaf(label, "LINES")), int(leaf(label, "LINE_SAMPLES")), int(leaf(label, "BANDS", 1)), np.dtype(f"{kind}{bits // 8}"), str(leaf(label, "BAND_STORAGE_TYPE", "BAND_SEQUENTIAL")), int(leaf(label, "LINE_PREFIX_BYTES", 0)), int(leaf(label, "LINE_SUFFIX_BYTES", 0))


def decode(label: dict, data: bytes, offset: int, band: int | None = None) -> np.ndarray:
    """[band, line, sample] of the pixels at ``offset``, or one band of it; a file that is too short raises ValueError."""
    lines, samples, bands, kind, storage, prefix, suffix = layout(label)
    by_line = {"LINE_INTERLEAVED": (lines, bands), "SAMPLE_INTERLEAVED": (lines,)}.get(storage, (bands, lines))
    wide = samples * (bands if storage == "SAMPLE_INTERLEAVED" else 1) * kind.itemsize
    rows, step = int(np.prod(by_line)), prefix + wide + suffix
    if len(data) - offset < rows * step:
        raise ValueError(f"{len(data) - offset} bytes of {rows * step}")
    raw = np.frombuffer(data, np.uint8, rows * step, offset).reshape(rows, step)[:, prefix : prefix + wide]
    a = np.ascontiguousarray(raw).view(kind)
    if storage == "SAMPLE_INTERLEAVED":
        cube = a.reshape(lines, samples, bands).transpose(2, 0, 1)
    elif storage == "LINE_INTERLEAVED":
        cube = a.reshape(lines, bands, samples).transpose(1, 0, 2)
    else:
        cube = a.reshape(bands, lines, samples)
    return cube if band is None else cube[band : band + 1]


def calibrated(label: dict, cube: np.ndarray) -> np.ndarray:
    """Masked and shifted by SAMPLE_BIT_MASK, float64, MISSING_CONSTANT and values outside VALID_* as NaN."""
    mask = leaf(label, "SAMPLE_BIT_MASK")
    if isinstance(mask, int) and mask and cube.dtype.kind in "iu":
        cube = (cube.astype(np.int64) & mask) >> ((mask & -mask).bit_length() - 1)
    v = cube.astype(np.float64)
    bad = np.zeros(v.shape, bool)
    for key, test in (("MISSING_CONSTANT", np.equal), ("VALID_MINIMUM", np.less), ("VALID_MAXIMUM", np.greater)):
        if isinstance(leaf(label, key), (int, float)):
            bad |= test(v, leaf(label, key))
    return np.where(bad, np.nan, v)


def pixel_offset(label: dict, header: int) -> int:
    """Where an attached image starts: a record number or bytes of ^IMAGE, else what the label takes."""
    p = label.get("^IMAGE", leaf(label, "^IMAGE"))
    p = next((x for x in p if isinstance(x, int)), None) if isinstance(p, tuple) else p
    return (p - 1) * int(leaf(label, "RECORD_BYTES", 1)) if isinstance(p, int) else header


def decode_xml(text: str, data: bytes) -> np.ndarray:
    """[band, line, sample] of the first two- or three-dimensional array that an XML label describes."""
    plain = re.sub(r'\sxmlns(:\w+)?="[^"]*"', "", text)
    root = ET.fromstring(re.sub(r"<(/?)\w+:", r"<\1", plain))
    array = next(e for e in root.iter() if e.tag.startswith(("Array_2D", "Array_3D")))
    shape = [int(a.findtext("elements")) for a in sorted(array.findall("Axis_Array"), key=lambda a: int(a.findtext("sequence_number")))]
    kind = np.dtype(ARRAYS[array.findtext("Element_Array/data_type")])
    a = np.frombuffer(data, kind, int(np.prod(shape)), int(array.findtext("offset") or 0)).reshape(shape)
    return a if a.ndim == 3 else a[None]


def read_products(spark: SparkSession, path: str, pixels: bool = True, glob: str = "*") -> DataFrame:
    """Products with attached labels: path, height, width, bands, fields (map), pixels (f32 of band 0) or null.

    Files are split over tasks as whole files; each is decoded by itself. A file without a label or too short has null size.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for p, data in zip(f["path"], f["content"], strict=True):
                head = bytes(data[:HEADER]).split(b"\nEND", 1)
                label = parse_label(head[0].decode("latin-1") + "\nEND") if len(head) > 1 else {}
                row = {"path": p, "height": None, "width": None, "bands": None, "fields": {k: str(v) for k, v in label.items()}, "pixels": None}
                try:
                    lines, samples, bands, *_ = layout(label)
                    if pixels:
                        row["pixels"] = calibrated(label, decode(label, data, pixel_offset(label, len(head[0]) + 4), 0))[0].astype("<f4").tobytes()
                    row |= {"height": lines, "width": samples, "bands": bands}
                except (TypeError, ValueError):
                    pass
                rows.append(row)
            yield pd.DataFrame(rows).astype({c: "Int32" for c in ("height", "width", "bands")})

    return files.select("path", "content").mapInPandas(run, "path string, height int, width int, bands int, fields map<string,string>, pixels binary")
