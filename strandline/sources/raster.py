"""Band files (GeoTIFF) as pixel rows, read on the executors by byte ranges.

A file's directory gives a table of its blocks (strips, tiles, or rows of an
uncompressed strip), which Spark filters by window and deals to tasks; a task
reads the bytes of one block after another. So neither a file of any size nor a
directory of any number of files is one task's or the driver's.

Read are TIFF and BigTIFF files in strips or tiles, uncompressed, deflated or by
LZW, with whole or real numbers of 8 to 64 bits, the predictors of both, and their
affine georeference and EPSG code. Files are opened by Arrow: local or mounted
paths, hdfs, s3, gs, abfs.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The format's tags and the sizes of its field types.
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
PIXEL_SCALE, TIEPOINT, TRANSFORM, GEO_KEYS = 33550, 33922, 34264, 34735
PROJECTED, GEOGRAPHIC = 3072, 2048
_TYPES = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
PLAIN, LZW, DEFLATE = (1,), (5,), (8, 32946)
LZW_CLEAR, LZW_END, LZW_WIDEST = 256, 257, 12

#: An uncompressed strip is read in runs of rows of at most this many bytes.
RUN_BYTES = 4 << 20
#: Pixels a record batch holds at most (one row of a block at least).
BATCH_PIXELS = 1 << 18
#: Bytes of files for each task that reads blocks.
TASK_BYTES = 32 << 20

Reader = Callable[[int, int], bytes]


def opened(path: str) -> pa.NativeFile:
    """The file of a path as Spark names it, open for reads at any place."""
    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme:
        return fs.LocalFileSystem().open_input_file(path)
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, place = fs.FileSystem.from_uri(quote(path.replace("s3a:", "s3:", 1), safe=":/@"))
    return system.open_input_file(place)


@dataclass
class Layout:
    """What a file's directory says."""

    order: str
    tags: dict[int, tuple]

    def one(self, tag: int, default: int | None = None) -> int:
        if tag not in self.tags and default is None:
            raise ValueError(f"the file has no tag {tag}")
        return self.tags.get(tag, (default,))[0]


def layout(read: Reader) -> Layout:
    """The first directory, by read(place, bytes)."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2], "")
    version = struct.unpack_from(order + "H", head, 2)[0] if order and len(head) >= 8 else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    # a big file counts and points in 8 bytes
    big = version == 43
    many, point, inline = ("Q", "Q", 8) if big else ("H", "I", 4)
    step, first = 4 + 2 * inline, 8 if big else 4
    (at,) = struct.unpack_from(order + point, head, first)
    start = at + struct.calcsize(many)
    (n,) = struct.unpack(order + many, read(at, start - at))
    entries = read(start, step * n)
    tags = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HH{point}", entries, step * k)
        code = _TYPES.get(kind)
        if code:
            size = struct.calcsize(order + code) * count
            value = entries[step * k + 4 + inline : step * (k + 1)]
            if size > inline:
                value = read(struct.unpack(order + point, value)[0], size)
            tags[tag] = struct.unpack_from(f"{order}{count}{code}", value)
    return Layout(order, tags)


def layout_of(path: str) -> Layout:
    with opened(path) as f:
        return layout(lambda at, n: f.read_at(n, at))


def georeference(x: Layout) -> tuple[float, float, float, float, float, float, int | None]:
    """xtr, xscale, xshear, ytr, yshear, yscale and the EPSG code."""
    if TRANSFORM in x.tags:
        m = x.tags[TRANSFORM]
        g = (m[3], m[0], m[1], m[7], m[4], m[5])
    elif PIXEL_SCALE in x.tags and TIEPOINT in x.tags:
        sx, sy, tie = x.tags[PIXEL_SCALE][0], x.tags[PIXEL_SCALE][1], x.tags[TIEPOINT]
        g = (tie[3] - tie[0] * sx, sx, 0.0, tie[4] + tie[1] * sy, 0.0, -sy)
    else:
        g = (0.0, 1.0, 0.0, 0.0, 0.0, 1.0)
    keys = x.tags.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4)}
    return (*map(float, g), codes.get(PROJECTED, codes.get(GEOGRAPHIC)))


def unpack_lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, highest bit first; a code is widened one early, as the format has it."""
    singles = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, held, n, last, out = singles[:], 9, 0, 0, b"", []
    for byte in raw:
        held, n = held << 8 | byte, n + 8
        if n < width:
            continue
        n -= width
        code, held = held >> n, held & (1 << n) - 1
        if code == LZW_END:
            break
        if code == LZW_CLEAR:
            table, width, last = singles[:], 9, b""
            continue
        if code > len(table) or (code == len(table) and not last):
            raise ValueError("damaged LZW data")
        word = table[code] if code < len(table) else last + last[:1]
        if last:
            table.append(last + word[:1])
            if len(table) == (1 << width) - 1 and width < LZW_WIDEST:
                width += 1
        out.append(word)
        last = word
    return b"".join(out)


def unpacked(raw: bytes, compression: int) -> bytes:
    if compression in PLAIN:
        return raw
    if compression in DEFLATE:
        return zlib.decompress(raw)
    if compression in LZW:
        return unpack_lzw(raw)
    raise ValueError(f"compression {compression} isn't read")


def grid_of(raw: bytes, number: np.dtype, rows: int, cols: int, deep: int, predictor: int) -> np.ndarray:
    """rows x columns x bands of a block's unpacked bytes, differences summed up."""
    if predictor == 3:
        # a row's bytes are differences, its numbers' highest bytes first, then the next ones
        size = number.itemsize
        flat = np.frombuffer(raw, np.uint8, rows * cols * deep * size).reshape(rows, size * cols, deep)
        planes = np.cumsum(flat, axis=1, dtype=np.uint8).reshape(rows, size, cols * deep)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(number.newbyteorder(">")).reshape(rows, cols, deep)
    grid = np.frombuffer(raw, number, rows * cols * deep).reshape(rows, cols, deep)
    if predictor == 2:
        return np.cumsum(grid, axis=1, dtype=number.newbyteorder("="))
    if predictor != 1:
        raise ValueError("this predictor isn't read")
    return grid


#: A block of a file: where it lies in the image, how it is stored, and the byte
#: ranges of its bands (one range where the bands lie pixel by pixel).
BLOCK = "filename string, row int, col int, rows int, cols int, used_rows int, used_cols int, number string, deep int, compression int, predictor int, places array<long>, sizes array<long>"


def blocks(filename: str, x: Layout, picked: list[int]) -> Iterator[tuple]:
    """The blocks of a file with the byte ranges that the picked bands need."""
    height, width, bands = x.one(HEIGHT), x.one(WIDTH), x.one(SAMPLES, 1)
    if max(picked) >= bands:
        raise ValueError(f"{filename} has fewer than {max(picked) + 1} bands")
    tiled = TILE_OFFSETS in x.tags
    h, w = (x.one(TILE_HEIGHT), x.one(TILE_WIDTH)) if tiled else (min(x.one(ROWS, height), height), width)
    across, apart = -(-width // w), x.one(PLANAR, 1) == 2
    count = -(-height // h) * across
    kind = {1: "u", 2: "i", 3: "f"}[x.one(FORMAT, 1)]
    number = np.dtype(f"{x.order}{kind}{x.one(BITS, 1) // 8}")
    deep = 1 if apart else bands
    offsets, counts = x.tags[TILE_OFFSETS if tiled else OFFSETS], x.tags[TILE_COUNTS if tiled else COUNTS]
    compression, predictor = x.one(COMPRESSION, 1), x.one(PREDICTOR, 1)
    line = w * deep * number.itemsize
    for place in range(count):
        r, c = place // across * h, place % across * w
        ks = [b * count + place for b in picked] if apart else [place]
        stored, used = (h, min(h, height - r)) if tiled else (min(h, height - r),) * 2
        step = max(1, RUN_BYTES // line) if compression in PLAIN else stored
        for a in range(0, used, step):
            rows = min(step, stored - a)
            plain = compression in PLAIN
            sizes = [(rows * line if plain and counts[k] else counts[k]) for k in ks]
            yield (filename, r + a, c, rows, w, min(rows, used - a), min(w, width - c), number.str, deep, compression, predictor, [offsets[k] + (a * line if plain else 0) for k in ks], sizes)


def files(spark: SparkSession, path: str) -> DataFrame:
    """filename and length of the files of a path; their content isn't read."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("filename"), "length")


def read_georeferences(spark: SparkSession, path: str) -> DataFrame:
    """filename, height, width, xtr, xscale, xshear, ytr, yshear, yscale, epsg of each file."""
    schema = "filename string, height int, width int, xtr double, xscale double, xshear double, ytr double, yshear double, yscale double, epsg int"
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 6, pa.int32()]
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(name, layout_of(name)) for name in batch.column(0).to_pylist()]
            rows = [(name, x.one(HEIGHT), x.one(WIDTH), *georeference(x)) for name, x in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return files(spark, path).select("filename").mapInArrow(run, schema)


def read_blocks(spark: SparkSession, path: str, picked: list[int]) -> DataFrame:
    """The table of blocks (see BLOCK) of all files of a path; only directories are read."""
    names = [part.split()[0] for part in BLOCK.split(", ")]
    kinds = [pa.string(), *[pa.int32()] * 6, pa.string(), *[pa.int32()] * 3, pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                found = list(blocks(name, layout_of(name), picked))
                yield pa.RecordBatch.from_arrays([pa.array([b[i] for b in found], k) for i, k in enumerate(kinds)], names)

    return files(spark, path).select("filename").mapInArrow(run, BLOCK)


def read_pixels(
    spark: SparkSession, path: str, bands: list[str], scale: float = 1.0, picked: list[int] | None = None, window: tuple[int, int, int, int] | None = None
) -> DataFrame:
    """filename, row, col and the bands by name (times scale; NaN as NULL): a row a pixel.

    scale: 1 / 10000 for Sentinel-2, 1 / 2048 or 1 / 16384 for 11- and 14-bit imagery.
    picked: the bands' places in the file, from 0 (the first ones, if not given); where
    bands are stored one by one, the others' bytes aren't read.
    window: first row, first column, and the row and column after the last; blocks
    outside aren't read. Blocks that a file leaves out are zeros.
    """
    picked = list(range(len(bands))) if picked is None else picked
    if len(picked) != len(bands) or not bands:
        raise ValueError("bands and their places don't agree")
    top, left, bottom, right = window or (0, 0, 2**31 - 1, 2**31 - 1)
    found = read_blocks(spark, path, picked)
    inside = (F.col("row") < bottom) & (F.col("row") + F.col("used_rows") > top) & (F.col("col") < right) & (F.col("col") + F.col("used_cols") > left)
    total = files(spark, path).agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = found.where(inside).repartition(int(tasks), "filename", "row", "col")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                number, shape = np.dtype(b["number"]), (b["rows"], b["cols"], b["deep"])
                grids = []
                with opened(b["filename"]) as f:
                    for at, size in zip(b["places"], b["sizes"], strict=True):
                        if size:
                            grids.append(grid_of(unpacked(f.read_at(size, at), b["compression"]), number, *shape, b["predictor"]))
                        else:
                            grids.append(np.zeros(shape, number))
                planes = [g[:, :, 0] for g in grids] if len(grids) == len(picked) and b["deep"] == 1 else [grids[0][:, :, k] for k in picked]
                r0, r1 = max(top, b["row"]), min(bottom, b["row"] + b["used_rows"])
                c0, c1 = max(left, b["col"]), min(right, b["col"] + b["used_cols"])
                step = max(1, BATCH_PIXELS // (c1 - c0))
                for r in range(r0, r1, step):
                    end = min(r + step, r1)
                    rows, cols = (i.ravel().astype(np.int32) for i in np.mgrid[r:end, c0:c1])
                    cut = [p[r - b["row"] : end - b["row"], c0 - b["col"] : c1 - b["col"]].astype(np.float64) * scale for p in planes]
                    name = pa.repeat(b["filename"], len(rows))
                    yield pa.RecordBatch.from_arrays([name, pa.array(rows), pa.array(cols), *(pa.array(p.ravel(), from_pandas=True) for p in cut)], ["filename", "row", "col", *bands])

    return dealt.mapInArrow(run, "filename string, row int, col int, " + ", ".join(f"`{b}` double" for b in bands))


def scene_of(filename: Column) -> Column:
    """A file's name without folder and suffix."""
    return F.regexp_extract(filename, r"([^/]+?)(?:\.tiff?)?$", 1)
