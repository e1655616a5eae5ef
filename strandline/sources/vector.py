"""KML and GeoJSON, read as text or JSON by Spark and parsed by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.boxes import box_of, clipped
from ..functions.projection import reproject

POINT = "array<struct<x:double,y:double>>"
GEOJSON = "type string, crs struct<properties:struct<name:string>>, features array<struct<type:string, properties:map<string,string>, geometry:struct<type:string, coordinates:string>>>"


def coordinates(text: Column) -> Column:
    """Points of the first <coordinates> element of a KML text: lon,lat[,alt] parted by white space."""
    inside = F.regexp_extract(text, r"(?s)<coordinates>(.*?)</coordinates>", 1)
    tokens = F.filter(F.split(F.trim(F.regexp_replace(inside, r"\s+", " ")), " "), lambda t: t != "")
    return F.transform(tokens, lambda t: F.struct(F.split(t, ",").getItem(0).try_cast("double").alias("x"), F.split(t, ",").getItem(1).try_cast("double").alias("y")))


def all_coordinates(text: Column) -> Column:
    """Points of all coordinate elements, bad numbers skipped, the ring closed when it has three or more."""
    inside = F.regexp_extract_all(text, F.lit(r"(?s)<(?:\w+:)?coordinates>(.*?)</(?:\w+:)?coordinates>"), 1)
    tokens = F.filter(F.flatten(F.transform(inside, lambda s: F.split(F.trim(F.regexp_replace(s, r"\s+", " ")), " "))), lambda t: t.contains(","))
    points = F.transform(tokens, lambda t: F.struct(F.split(t, ",").getItem(0).try_cast("double").alias("x"), F.split(t, ",").getItem(1).try_cast("double").alias("y")))
    good = F.filter(points, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    return close_ring(good)


def close_ring(points: Column) -> Column:
    closed = F.concat(points, F.slice(points, 1, 1))
    return F.when((F.size(points) >= 3) & (F.element_at(points, 1) != F.element_at(points, -1)), closed).otherwise(points)


def read_kml(spark: SparkSession, path: str, every: bool = False) -> DataFrame:
    """file, ring of each KML file; an error where a file has no polygon of four points."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    if every:
        return raw.select("file", all_coordinates(F.col("value")).alias("ring"))
    ring = coordinates(F.col("value"))
    bad = F.raise_error(F.concat(F.lit("no polygon of four points in "), F.col("file")))
    return raw.select("file", F.when(F.size(ring) >= 4, ring).otherwise(bad).alias("ring"))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """file, place (of the feature, from 0), properties, kind, coordinates (JSON text)."""
    raw = spark.read.schema(GEOJSON).option("multiLine", True).json(path)
    f = raw.select(F.input_file_name().alias("file"), F.posexplode("features").alias("place", "f"))
    return f.select("file", "place", F.col("f.properties").alias("properties"), F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("coordinates"))


def _line(text: Column) -> Column:
    return F.transform(F.from_json(text, "array<array<double>>"), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def read_polygon(spark: SparkSession, path: str) -> DataFrame:
    """file, ring: the outer ring of each file's first feature."""
    rings = F.from_json(F.col("coordinates"), "array<array<array<double>>>")
    ring = F.transform(rings[0], lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return read_geojson(spark, path).where("place = 0").select("file", ring.alias("ring"))


def read_aoi(spark: SparkSession, path: str) -> DataFrame:
    """A polygon by the path's suffix: kml, geojson or json."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "kml":
        return read_kml(spark, path, every=True)
    if suffix in ("geojson", "json"):
        return read_polygon(spark, path)
    raise ValueError(f"no reader for {path}")


def read_transects(spark: SparkSession, path: str) -> DataFrame:
    """transect_id, x0, y0, x1, y1: first and last vertex; of repeated names the last feature."""
    f = read_geojson(spark, path).where("kind = 'LineString'").select(F.col("properties")["name"].alias("transect_id"), "place", _line(F.col("coordinates")).alias("l"))
    last = f.groupBy("transect_id").agg(F.max_by("l", "place").alias("l"))
    a, b = F.element_at("l", 1), F.element_at("l", -1)
    return last.select("transect_id", a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """place, part, points: each LineString, and each part of a MultiLineString; other kinds are left out."""
    f = read_geojson(spark, path)
    one = f.where("kind = 'LineString'").select("place", F.lit(0).alias("part"), _line(F.col("coordinates")).alias("points"))
    parts = F.from_json(F.col("coordinates"), "array<array<array<double>>>")
    many = f.where("kind = 'MultiLineString'").select("place", F.posexplode(parts).alias("part", "p"))
    many = many.select("place", "part", F.transform("p", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("points"))
    return one.unionByName(many)


def segments(lines: DataFrame) -> DataFrame:
    """place, part, pt_idx, x0, y0, x1, y1 of each pair of neighbouring points."""
    n = F.size("points")
    pairs = F.zip_with(F.slice("points", 1, F.greatest(n - 1, F.lit(0))), F.slice("points", 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))
    return lines.select("place", "part", F.posexplode(pairs).alias("pt_idx", "s")).select("place", "part", "pt_idx", "s.*")


def feature(kind: str, coords: Column, properties: dict[str, Column]) -> Column:
    """A GeoJSON feature as text."""
    geometry = F.struct(F.lit(kind).alias("type"), coords.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*(c.alias(n) for n, c in properties.items())).alias("properties"), geometry.alias("geometry")), {"ignoreNullFields": "false"})


def shoreline_features(points: DataFrame, scenes: DataFrame, kind: str = "lines") -> DataFrame:
    """One feature a scene with two points or more: `lines` or `points`, with date, satname, geoaccuracy, cloud_cover."""
    if kind not in ("lines", "points"):
        raise ValueError(f"no such geometry: {kind}")
    ordered = points.groupBy("scene_id").agg(F.sort_array(F.collect_list(F.struct("pt_idx", "x", "y"))).alias("p")).where(F.size("p") > 1)
    coords = F.transform("p", lambda p: F.array(p["x"], p["y"]))
    names = ("date", "satname", "geoaccuracy", "cloud_cover")
    joined = ordered.join(scenes.withColumn("date", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), "scene_id")
    return joined.select("scene_id", feature("LineString" if kind == "lines" else "MultiPoint", coords, {n: F.col(n) for n in names}).alias("value"))


def transect_features(transects: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One LineString feature a transect, with its name and the columns asked for (trends, for instance)."""
    coords = F.array(F.array("x0", "y0"), F.array("x1", "y1"))
    return transects.select(feature("LineString", coords, {"name": F.col("transect_id"), **{n: F.col(n) for n in names or []}}).alias("value"))


def write_features(features: DataFrame, path: str) -> None:
    """A GeoJSON sequence: a feature a line, in part files, so that no task holds them all."""
    features.select("value").write.mode("overwrite").text(path)


def reprojected(points: DataFrame, source: int, target: int, x: str = "x", y: str = "y") -> DataFrame:
    """points with x and y under another EPSG code."""
    u, v = reproject(F.col(x), F.col(y), source, target)
    return points.withColumns({x: u, y: v})


def read_point(spark: SparkSession, path: str) -> DataFrame:
    """x, y of a file's first Point feature."""
    f = read_geojson(spark, path).where("kind = 'Point'").orderBy("place").limit(1)
    return f.select(F.from_json(F.col("coordinates"), "array<double>").alias("c")).select(F.col("c")[0].alias("x"), F.col("c")[1].alias("y"))


def clip_lines(segments: DataFrame, x_min: float, y_min: float, x_max: float, y_max: float) -> DataFrame:
    """Segments (x0, y0, x1, y1, and others) cut to a rectangle; those outside go."""
    part = clipped(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), box_of(*map(F.lit, (x_min, y_min, x_max, y_max))))
    out = segments.withColumn("_part", part).where("_part IS NOT NULL")
    return out.withColumns({c: F.col("_part")[c] for c in ("x0", "y0", "x1", "y1")}).drop("_part")


def line_features(segments: DataFrame) -> DataFrame:
    """One LineString feature a segment: a clipped reference line for write_features."""
    return segments.select(feature("LineString", F.array(F.array("x0", "y0"), F.array("x1", "y1")), {}).alias("value"))
