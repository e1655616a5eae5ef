"""Band files written here by hand, read back; projections; the command line."""

import math
import struct
import zlib

import numpy as np
import pytest

from strandline import __main__ as cli
from strandline.functions import projection
from strandline.plans import preprocess
from strandline.sources import raster, vector


def lzw(raw):
    """Codes as the format has them: a clear code first, widths one early, cleared before 4,094 words."""
    bits, count, table, width, word = 0, 0, {bytes([i]): i for i in range(256)}, 9, b""

    def put(code):
        nonlocal bits, count
        bits, count = bits << width | code, count + width

    put(256)
    for byte in raw:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        put(table[word])
        table[longer] = len(table) + 2
        if len(table) + 2 == 1 << width:  # entry 511 is in: ten bits from here
            width += 1
        if len(table) + 2 >= 4094:
            put(256)
            table, width = {bytes([i]): i for i in range(256)}, 9
        word = bytes([byte])
    if word:
        put(table[word])
    put(257)
    return (bits << -count % 8).to_bytes((count + 7) // 8, "big")


def tiff(bands, order="<", tile=None, packed=False, apart=False, rows=3, epsg=32610, predictor=1, big=False, holes=()):
    """A file of rows x columns x bands: in strips of some rows or in square tiles."""
    h, w, n = bands.shape
    kind, fmt = bands.dtype.newbyteorder(order), {"u": 1, "i": 2, "f": 3}[bands.dtype.kind]
    grids = [bands[:, :, i : i + 1] for i in range(n)] if apart else [bands]
    parts = []
    for g in grids:
        for r in range(0, h, tile or rows):
            for c in range(0, w, tile or w):
                x = g[r : r + (tile or rows), c : c + (tile or w)]
                if tile:
                    x = np.pad(x, ((0, tile - x.shape[0]), (0, tile - x.shape[1]), (0, 0)))
                if predictor == 2:
                    x = np.concatenate([x[:, :1], np.diff(x, axis=1)], axis=1)
                raw = np.ascontiguousarray(x).astype(kind).tobytes()
                if predictor == 3:
                    lines = np.ascontiguousarray(x).astype(bands.dtype.newbyteorder(">")).view(np.uint8).reshape(x.shape[0], -1, bands.dtype.itemsize)
                    lines = lines.transpose(0, 2, 1).reshape(x.shape[0], -1, x.shape[2])
                    raw = np.concatenate([lines[:, :1], np.diff(lines, axis=1)], axis=1).tobytes()
                parts.append(b"" if len(parts) in holes else lzw(raw) if packed == "lzw" else zlib.compress(raw) if packed else raw)
    tags = [(256, "I", (w,)), (257, "I", (h,)), (258, "H", (bands.dtype.itemsize * 8,) * n), (259, "H", (5 if packed == "lzw" else 8 if packed else 1,)), (277, "H", (n,)), (284, "H", (2 if apart else 1,)), (317, "H", (predictor,)), (339, "H", (fmt,) * n)]
    tags += [(33550, "d", (10.0, 10.0, 0.0)), (33922, "d", (0.0, 0.0, 0.0, 500_000.0, 4_000_000.0, 0.0)), (34735, "H", (1, 1, 0, 1, 3072, 0, 1, epsg))]
    sizes = ("I", tuple(map(len, parts)))
    tags += [(322, "I", (tile,)), (323, "I", (tile,)), (325, *sizes)] if tile else [(278, "I", (rows,)), (279, *sizes)]
    offsets = 324 if tile else 273
    body = 16 if big else 8
    starts = []
    for p in parts:
        starts.append(body)
        body += len(p)
    tags = sorted([*tags, (offsets, "I", tuple(starts))])
    codes = {"H": 3, "I": 4, "d": 12}
    point, many, inline = ("Q", "Q", 8) if big else ("I", "H", 4)
    size = struct.calcsize(order + many)
    extra, entries, at = b"", b"", body + size + (4 + 2 * inline) * len(tags) + inline
    for tag, code, values in tags:
        raw = struct.pack(f"{order}{len(values)}{code}", *values)
        entries += struct.pack(order + "HH" + point, tag, codes[code], len(values))
        if len(raw) > inline:
            entries += struct.pack(order + point, at + len(extra))
            extra += raw
        else:
            entries += raw.ljust(inline, b"\0")
    head = b"II" if order == "<" else b"MM"
    head += struct.pack(order + "HHHQ", 43, 8, 0, body) if big else struct.pack(order + "HI", 42, body)
    return head + b"".join(parts) + struct.pack(order + many, len(tags)) + entries + b"\0" * inline + extra


@pytest.mark.parametrize("how", [{}, {"order": ">", "packed": True}, {"tile": 16, "packed": True}, {"tile": 16, "apart": True}, {"apart": True, "rows": 4}, {"packed": True, "predictor": 2}, {"packed": "lzw", "rows": 21}, {"packed": "lzw", "tile": 16, "apart": True, "order": ">"}, {"big": True, "tile": 16}, {"big": True, "packed": "lzw", "predictor": 2}])
def test_pixels_and_georeference(spark, tmp_path, how):
    bands = np.random.default_rng(1).integers(0, 9000, (21, 35, 3)).astype(np.uint16)
    (tmp_path / "scene one.tif").write_bytes(tiff(bands, **how))
    rows = raster.read_pixels(spark, str(tmp_path), ["b", "g", "r"], 1 / 10_000).collect()
    assert len(rows) == 21 * 35
    assert all(np.allclose((x.b, x.g, x.r), bands[x.row, x.col] / 10_000) for x in rows)
    g = raster.read_georeferences(spark, str(tmp_path)).first()
    assert (g.height, g.width, g.xtr, g.xscale, g.ytr, g.yscale, g.epsg) == (21, 35, 500_000.0, 10.0, 4_000_000.0, -10.0, 32610)


def test_odd_files(spark, tmp_path):
    x = np.array([[[1.5], [np.nan]]], np.float32)
    (tmp_path / "a.tif").write_bytes(tiff(x))
    assert [r.b for r in raster.read_pixels(spark, str(tmp_path), ["b"]).orderBy("col").collect()] == [1.5, None]
    with pytest.raises(ValueError):
        raster.layout(lambda at, n: b"GIF89a.."[at : at + n])


@pytest.mark.parametrize("how", [{"packed": True}, {"packed": "lzw", "tile": 16}, {"packed": True, "order": ">", "apart": True}])
@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_real_numbers_with_predictor(spark, tmp_path, how, kind):
    x = np.random.default_rng(3).normal(0, 1e3, (19, 23, 2)).astype(kind)
    (tmp_path / "a.tif").write_bytes(tiff(x, predictor=3, **how))
    rows = raster.read_pixels(spark, str(tmp_path), ["b", "g"]).collect()
    assert len(rows) == 19 * 23 and all((r.b, r.g) == tuple(x[r.row, r.col].astype(float)) for r in rows)


def test_lzw_round_trip():
    rng = np.random.default_rng(4)
    for raw in (b"", b"a", b"aaaaaaaa", bytes(rng.integers(0, 4, 90_000, np.uint8)), bytes(rng.integers(0, 256, 30_000, np.uint8))):
        assert raster.unpack_lzw(lzw(raw)) == raw
    with pytest.raises(ValueError):
        raster.unpack_lzw((256 << 23 | 97 << 14 | 400 << 5).to_bytes(4, "big"))


@pytest.mark.parametrize("how", [{"apart": True, "tile": 16}, {"tile": 16}, {"rows": 21}, {"apart": True, "rows": 5, "packed": True}])
def test_window_and_bands(spark, tmp_path, how, monkeypatch):
    bands = np.random.default_rng(5).integers(0, 9000, (21, 35, 4)).astype(np.int16)
    (tmp_path / "a.tif").write_bytes(tiff(bands, **how))
    monkeypatch.setattr(raster, "RUN_BYTES", 2 * 35 * 2)  # rows of a strip are read in runs
    got = raster.read_pixels(spark, str(tmp_path), ["nir", "g"], picked=[3, 1], window=(3, 17, 9, 30)).collect()
    assert sorted((r.row, r.col) for r in got) == [(r, c) for r in range(3, 9) for c in range(17, 30)]
    assert all((r.nir, r.g) == (bands[r.row, r.col, 3], bands[r.row, r.col, 1]) for r in got)
    with pytest.raises(Exception, match="fewer than 5 bands"):
        raster.read_pixels(spark, str(tmp_path), ["x"], picked=[4]).collect()


def test_blocks_are_read_by_ranges(spark, tmp_path):
    """A window's blocks and bands alone: what else is damaged or left out doesn't matter."""
    bands = np.full((32, 48, 2), 7, np.uint16)
    whole = tiff(bands, tile=16, apart=True, packed=True, holes=(4,))
    (tmp_path / "a.tif").write_bytes(whole)
    found = raster.read_blocks(spark, str(tmp_path), [1]).orderBy("row", "col").collect()
    assert [(b.row, b.col) for b in found] == [(r, c) for r in (0, 16) for c in (0, 16, 32)] and all(len(b.places) == 1 for b in found)
    rows = raster.read_pixels(spark, str(tmp_path), ["a"]).collect()
    assert len(rows) == 32 * 48 and all(r.a == (0 if r.row >= 16 and 16 <= r.col < 32 else 7) for r in rows)
    x = raster.layout_of(str(tmp_path / "a.tif"))
    at = x.tags[raster.TILE_OFFSETS][0]
    (tmp_path / "a.tif").write_bytes(whole[:at] + b"\xff\xff" + whole[at + 2 :])
    assert raster.read_pixels(spark, str(tmp_path), ["b"], picked=[1]).count() == 32 * 48
    assert raster.read_pixels(spark, str(tmp_path), ["a"], window=(16, 0, 32, 48)).count() == 16 * 48
    with pytest.raises(Exception, match="header"):
        raster.read_pixels(spark, str(tmp_path), ["a"]).count()


def test_preprocess(spark, tmp_path):
    rng = np.random.default_rng(2)
    bands = rng.integers(500, 4000, (12, 14, 6)).astype(np.uint16)
    bands[:, :, 5] = 0
    bands[0, :, :5] = 0  # nodata
    bands[4:11, 0:6, 5] = 1024  # cloud
    bands[2, 12, 5] = 1024  # too small for one
    (tmp_path / "s.tif").write_bytes(tiff(bands))
    pixels, scenes = preprocess.load(spark, str(tmp_path), "S2")
    got = {(r.row, r.col): r for r in pixels.collect()}
    assert not got[2, 12].cloud and got[5, 3].cloud and not got[5, 3].nodata and got[0, 4].nodata and got[0, 4].cloud and got[0, 4].g is None
    assert abs(got[7, 7].nir - bands[7, 7, 3] / 10_000) < 1e-12 and not got[7, 7].cloud
    line = spark.createDataFrame([(500_000.0, 3_999_945.0, 500_140.0, 3_999_945.0)], "x0 double, y0 double, x1 double, y1 double")
    near = {(r.row, r.col) for r in preprocess.buffered(pixels, scenes, line, 11.0).where("in_buffer").collect()}
    assert near == {(r, c) for r in (5, 6) for c in range(14)}
    points = scenes.selectExpr("scene_id", "explode(array(0, 5, 12, 14)) AS row").selectExpr("scene_id", "row", "3 AS col")
    assert [r.row for r in preprocess.cropped(points, scenes).collect()] == [5]


def test_reprojection(spark):
    df = spark.createDataFrame([(-123.1, 49.2), (2.35, 48.85), (151.2, -33.9)], "x double, y double")
    web = [tuple(r) for r in vector.reprojected(df, 4326, 3857).collect()]
    for (x, y), (lon, lat) in zip(web, [tuple(r) for r in df.collect()], strict=True):
        assert abs(x - 6_378_137 * math.radians(lon)) < 1e-6 and abs(y - 6_378_137 * math.asinh(math.tan(math.radians(lat)))) < 1e-6
    for code, one in ((32610, -123.1), (25831, 2.35), (32756, 151.2), (3857, 2.35)):
        there = vector.reprojected(df.where(f"x = {one}"), 4326, code)
        x, y = vector.reprojected(there, code, 4326).first()
        assert abs(x - one) < 1e-9
        via = vector.reprojected(vector.reprojected(there, code, 3857), 3857, code).first()
        assert all(abs(a - b) < 1e-4 for a, b in zip(via, there.first(), strict=True))
    south = vector.reprojected(df.where("y < 0"), 4326, 32756).first()
    assert 6_200_000 < south.y < 6_300_000 and 300_000 < south.x < 350_000
    with pytest.raises(ValueError):
        projection.zone_of(2193)


def test_point_and_clipped_features(spark, tmp_path):
    (tmp_path / "p.geojson").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1.5, -2.5]}}]}')
    assert tuple(vector.read_point(spark, str(tmp_path / "p.geojson")).first()) == (1.5, -2.5)
    lines = spark.createDataFrame([(-5.0, 0.0, 5.0, 0.0), (20.0, 20.0, 30.0, 30.0)], "x0 double, y0 double, x1 double, y1 double")
    out = vector.clip_lines(lines, -1.0, -1.0, 2.0, 2.0)
    assert [tuple(r) for r in out.collect()] == [(-1.0, 0.0, 2.0, 0.0)]
    assert '"coordinates":[[-1.0,0.0],[2.0,0.0]]' in vector.line_features(out).first().value


def test_command_line(capsys):
    cli.main(["stages"])
    assert capsys.readouterr().out.split() == ["clean", "intersect", "slopes", "correct", "summarise"]
    with pytest.raises(SystemExit):
        cli.main(["run"])
