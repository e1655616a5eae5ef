"""From band files to the pixels that extraction reads: one call a mission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import inside_image
from ..functions.geometry import pixel_to_world
from ..operators import raster
from ..operators.joins import near_segments
from ..sources import raster as files

FIVE = ["b", "g", "r", "nir", "swir1"]
SIX = [*FIVE, "swir2"]
#: Fixed value: what Sentinel-2 reflectances are divided by.
S2_SCALE = 10_000.0


#: The smallest cloud by the quality band, in pixels, and the same with the opening of a doubtful band; squares of the openings.
SMALLEST_CLOUD, SMALLEST_DOUBTFUL = 40, 100
DOUBTFUL_SQUARE, PROBABLE_SQUARE = 8, 6


def quality_clouds(pixels: DataFrame, satname: str, qa: str = "qa", doubtful: bool = False) -> DataFrame:
    """scene_id, row, col, cloud by the quality band, without small objects, which are beach or surf.

    doubtful: where the band takes sand for cloud, each of its values is opened by
    a square and cleaned of larger objects by itself.
    """
    flagged = pixels.select(*raster.KEY, F.col(qa).cast("long").alias("_qa"), F.coalesce(raster.qa_cloud(F.col(qa).cast("long"), F.lit(satname)), F.lit(False)).alias("cloud"))
    if not doubtful:
        return raster.drop_small_objects(flagged, "cloud", SMALLEST_CLOUD)
    # a value of a scene is a layer of its own, with all of the scene's pixels
    values = flagged.where("cloud").select("scene_id", F.col("_qa").alias("_value")).distinct()
    layer = F.struct("scene_id", "_value")
    layers = flagged.join(values, "scene_id").select(layer.alias("scene_id"), "row", "col", (F.col("_qa") == F.col("_value")).alias("cloud"))
    clean = raster.drop_small_objects(raster.open_square(layers, "cloud", DOUBTFUL_SQUARE), "cloud", SMALLEST_DOUBTFUL)
    kept = clean.where("cloud").select(F.col("scene_id.scene_id").alias("scene_id"), "row", "col", F.lit(True).alias("_kept")).distinct()
    return flagged.join(kept, raster.KEY, "left").select(*raster.KEY, F.coalesce("_kept", F.lit(False)).alias("cloud"))


def masked(pixels: DataFrame, satname: str, bands: list[str], qa: str = "qa", probability: str | None = None, most: float = 40.0, doubtful: bool = False) -> DataFrame:
    """pixels (scene_id, row, col, bands, qa) plus cloud and nodata; bands NULL at nodata.

    Clouds are those of the quality band without small objects, and those of a
    cloud probability over `most`, opened by a square; nodata counts as cloud.
    """
    cloud = quality_clouds(pixels, satname, qa, doubtful)
    if probability:
        likely = pixels.select(*raster.KEY, F.coalesce(F.col(probability) > most, F.lit(False)).alias("_likely"))
        cloud = cloud.join(raster.open_square(likely, "_likely", PROBABLE_SQUARE), raster.KEY).select(*raster.KEY, (F.col("cloud") | F.col("_likely")).alias("cloud"))
    out = pixels.drop("cloud", "nodata").join(cloud, raster.KEY).withColumn("nodata", raster.nodata(bands)).withColumn("cloud", F.col("cloud") | F.col("nodata"))
    return out.withColumns({b: F.when(~F.col("nodata"), F.col(b)) for b in bands})


def load(spark: SparkSession, path: str, satname: str, bands: list[str] | None = None, qa: str = "qa", pan: str | None = None, scale: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(pixels, scenes) of files whose bands are `bands`, then the quality band, then maybe the panchromatic one.

    pixels: scene_id, row, col, bands, cloud, nodata; sharpened where pan is named.
    scenes: scene_id, georeference and size.
    """
    bands = bands or FIVE
    names = [*bands, qa, *([pan] if pan else [])]
    scale = scale if scale is not None else 1 / S2_SCALE if satname == "S2" else 1.0
    scene = F.xxhash64(files.scene_of(F.col("filename")))
    read = files.read_pixels(spark, path, names).withColumn("scene_id", scene).drop("filename")
    scaled = read.withColumns({b: F.col(b) * scale for b in [*bands, *([pan] if pan else [])]})
    pixels = masked(scaled, satname, bands, qa).drop(qa)
    if pan:
        pixels = raster.pansharpen(pixels, bands, pan).drop(pan)
    return pixels, files.read_georeferences(spark, path).withColumn("scene_id", scene)


def buffered(pixels: DataFrame, scenes: DataFrame, segments: DataFrame, metres: float) -> DataFrame:
    """pixels plus in_buffer: the pixel's place is at most `metres` from a segment (x0, y0, x1, y1) of the reference line."""
    g = {k: F.col(k) for k in ("xtr", "xscale", "xshear", "ytr", "yshear", "yscale")}
    x, y = pixel_to_world(F.col("row"), F.col("col"), g)
    placed = pixels.select("scene_id", "row", "col").join(scenes, "scene_id").select("scene_id", "row", "col", x.alias("x"), y.alias("y"))
    near = near_segments(placed, segments, metres).select("scene_id", "row", "col", F.lit(True).alias("_near"))
    return pixels.join(near, ["scene_id", "row", "col"], "left").withColumn("in_buffer", F.coalesce("_near", F.lit(False))).drop("_near")


def cropped(points: DataFrame, scenes: DataFrame, row: str = "row", col: str = "col") -> DataFrame:
    """Points (scene_id, row, col) strictly inside their image."""
    inside: Column = inside_image(F.col(row), F.col(col), F.col("height"), F.col("width"))
    return points.join(scenes.select("scene_id", "height", "width"), "scene_id").where(inside).drop("height", "width")
