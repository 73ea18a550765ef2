"""Products band by band: layouts, pointers, tables, XML arrays, and how many bytes are read."""

import numpy as np
import pytest

from selenite.sources import products

LINES, SAMPLES, BANDS = 40, 50, 4
CUBE = (np.arange(BANDS * LINES * SAMPLES) % 60000).astype(">u2").reshape(BANDS, LINES, SAMPLES)
ORDER = {"BAND_SEQUENTIAL": (0, 1, 2), "LINE_INTERLEAVED": (1, 0, 2), "SAMPLE_INTERLEAVED": (1, 2, 0)}


def label(storage, pointer="1", more="", prefix=0, table=""):
    fields = f"LINES = {LINES}\r\n LINE_SAMPLES = {SAMPLES}\r\n BANDS = {BANDS}\r\n SAMPLE_TYPE = MSB_UNSIGNED_INTEGER\r\n SAMPLE_BITS = 16\r\n BAND_STORAGE_TYPE = {storage}\r\n LINE_PREFIX_BYTES = {prefix}\r\n{more}"
    return f"PDS_VERSION_ID = PDS3\r\nRECORD_TYPE = FIXED_LENGTH\r\nRECORD_BYTES = 4096\r\n^IMAGE = {pointer}\r\nOBJECT = IMAGE\r\n {fields}END_OBJECT = IMAGE\r\n{table}END\r\n".encode()


def pixels(storage, prefix=0):
    a = np.ascontiguousarray(CUBE.transpose(ORDER[storage]))
    rows = a.reshape(BANDS * LINES if storage == "BAND_SEQUENTIAL" else LINES, -1).view(np.uint8)
    return np.concatenate([np.full((len(rows), prefix), 0xEE, np.uint8), rows], axis=1).tobytes()


def got(row):
    return np.frombuffer(row["pixels"], "<f4").reshape(row["height"], row["width"])


@pytest.mark.parametrize("storage", sorted(ORDER))
@pytest.mark.parametrize("prefix", [0, 6])
def test_layouts(spark, tmp_path, storage, prefix):
    """Every band is the cube's; what is read grows with the bands asked for, unless they alternate from pixel to pixel."""
    (tmp_path / "a.img").write_bytes(label(storage, prefix=prefix).ljust(4096) + pixels(storage, prefix))
    rows = {r["band"]: r for r in products.read_bands(spark, str(tmp_path)).collect()}
    assert sorted(rows) == list(range(BANDS)) and all(np.array_equal(got(r), CUBE[b].astype("f4")) for b, r in rows.items())
    one = products.read_bands(spark, str(tmp_path), [2, 9]).collect()
    assert [r["band"] for r in one] == [2] and np.array_equal(got(one[0]), CUBE[2].astype("f4"))
    band, whole = LINES * SAMPLES * 2, len(pixels(storage, prefix))
    assert one[0]["read"] == {"BAND_SEQUENTIAL": band + LINES * prefix, "LINE_INTERLEAVED": band, "SAMPLE_INTERLEAVED": whole}[storage]


def test_labels_read_no_pixels(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.img").write_bytes(label("BAND_SEQUENTIAL").ljust(4096) + b"\0" * 2_000_000)
    (tmp_path / "none.img").write_bytes(b"nothing here")
    rows = products.labels(spark, str(tmp_path)).collect()
    assert sum(r["read"] for r in rows) <= 4 * products.PIECE
    assert sorted((r["width"], r["problem"]) for r in rows if r["width"]) == [(SAMPLES, None)] * 3
    assert [r["problem"] for r in rows if not r["width"]] == ["ValueError: no label"]


@pytest.mark.parametrize("pointer, before", [('"A.DAT"', 0), ('("A.DAT", 2)', 8192)])
def test_detached(spark, tmp_path, pointer, before):
    (tmp_path / "a.lbl").write_bytes(label("BAND_SEQUENTIAL", pointer))
    (tmp_path / "A.DAT").write_bytes(b"\1" * before + pixels("BAND_SEQUENTIAL"))
    rows = products.read_bands(spark, str(tmp_path), [1, 3], "*.lbl").collect()
    assert sorted(r["band"] for r in rows) == [1, 3] and all(np.array_equal(got(r), CUBE[r["band"]].astype("f4")) for r in rows)


def test_values(spark, tmp_path):
    more = " MISSING_CONSTANT = 3\r\n VALID_MAXIMUM = 1500\r\n"
    table = "OBJECT = LUT\r\n LUT_DATA = (10, 20, 30, 40)\r\nEND_OBJECT = LUT\r\n"
    (tmp_path / "a.img").write_bytes(label("BAND_SEQUENTIAL", more=more, table=table).ljust(4096) + pixels("BAND_SEQUENTIAL"))
    band = got(products.read_bands(spark, str(tmp_path), [0]).first())
    want = np.where((CUBE[0] == 3) | (CUBE[0] > 1500), np.nan, CUBE[0].astype("f4"))
    assert np.array_equal(band, want, equal_nan=True)
    assert np.array_equal(got(products.read_bands(spark, str(tmp_path), [0], raw=True).first()), np.array([10, 20, 30, 40])[np.clip(CUBE[0], 0, 3)])


def test_too_short(spark, tmp_path):
    (tmp_path / "a.img").write_bytes((label("BAND_SEQUENTIAL").ljust(4096) + pixels("BAND_SEQUENTIAL"))[:-40])
    (tmp_path / "b.lbl").write_bytes(label("BAND_SEQUENTIAL", '"GONE.DAT"'))
    rows = {(r["path"][-5:], r["band"]): r for r in products.read_bands(spark, str(tmp_path)).collect()}
    assert rows["a.img", 3]["pixels"] is None and "ValueError" in rows["a.img", 3]["problem"]
    assert np.array_equal(got(rows["a.img", 2]), CUBE[2].astype("f4")) and "FileNotFoundError" in rows["b.lbl", 0]["problem"]


@pytest.mark.parametrize("axes, shape", [(("Line", "Sample"), (40, 50)), (("Band", "Line", "Sample"), (4, 40, 50))])
def test_xml_arrays(spark, tmp_path, axes, shape):
    listed = "".join(f"<Axis_Array><axis_name>{a}</axis_name><elements>{n}</elements><sequence_number>{k}</sequence_number></Axis_Array>" for k, (a, n) in reversed(list(enumerate(zip(axes, shape, strict=True), 1))))
    array = f"<Array_{len(axes)}D_Image><offset unit='byte'>16</offset>{listed}<Element_Array><data_type>UnsignedMSB2</data_type></Element_Array></Array_{len(axes)}D_Image>"
    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?>\n<Product_Observational xmlns='http://x/y'><File><file_name>a.dat</file_name></File>{array}</Product_Observational>")
    data = CUBE[: shape[0]] if len(shape) == 3 else CUBE[0]
    (tmp_path / "a.dat").write_bytes(b"\0" * 16 + data.tobytes())
    rows = products.read_bands(spark, str(tmp_path), glob="*.xml").collect()
    assert all(np.array_equal(got(r), CUBE[r["band"]].astype("f4")) for r in rows) and len(rows) == (shape[0] if len(shape) == 3 else 1)
