"""Block-group polygons: Parquet ``bg_id, ring`` or a GeoJSON
FeatureCollection, normalised to ``bg_id string, rings array<array<struct<x,y>>>``.
Coordinates must be lon/lat of WGS84 (or NAD83, taken as equal); a collection that
names another reference system is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Reference systems whose coordinates are taken as they are.
LON_LAT = ("CRS84", "4326", "4269", "CRS83")
#: Features begin with their type; the text between two such marks is one feature's.
FEATURE = '"Feature"'


class ReferenceSystemError(ValueError):
    pass


def read_polygons(spark: SparkSession, path: str, id_field: str = "GEOID") -> DataFrame:
    if path.endswith(".json") or path.endswith(".geojson"):
        return read_geojson(spark, path, id_field)
    df = spark.read.parquet(path)
    if "rings" in df.columns:
        return df.select(F.col("bg_id").cast("string"), "rings")
    return df.select(F.col("bg_id").cast("string"), F.array(F.col("ring")).alias("rings"))


def read_geojson(spark: SparkSession, path: str, id_field: str = "GEOID") -> DataFrame:
    """Polygon and MultiPolygon features; every ring of a multi-polygon is kept
    (the even-odd test handles holes and parts alike).

    The file is read in parts by several tasks: each feature is the text from its
    ``"type": "Feature"`` to the next one's, so that member must be a feature's
    first (a collection written otherwise is an error). Features without a
    geometry or an id are left out."""
    text = spark.read.option("lineSep", FEATURE).text(path)
    _check_system(text)
    schema = "properties map<string, string>, geometry struct<type: string, coordinates: string>"
    # A feature's text opens after its type; what follows its closing brace is not read.
    parsed = text.where(F.btrim("value").startswith(",")).select(
        F.from_json(F.concat(F.lit('{"type":"Feature"'), F.col("value")), schema).alias("f"))
    f = parsed.select(F.col("f.properties")[id_field].alias("bg_id"), F.col("f.geometry.type").alias("type"),
                      F.col("f.geometry.coordinates").alias("coords"))
    poly = F.from_json("coords", "array<array<array<double>>>")
    multi = F.flatten(F.from_json("coords", "array<array<array<array<double>>>>"))
    rings = F.when(F.col("type") == "Polygon", poly).when(F.col("type") == "MultiPolygon", multi)
    return f.select("bg_id", F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(
        F.element_at(p, 1).alias("x"), F.element_at(p, 2).alias("y")))).alias("rings")) \
        .filter(F.col("rings").isNotNull() & F.col("bg_id").isNotNull())


def _check_system(text: DataFrame) -> None:
    """One look at the text: the reference system it names, and whether features
    begin as they must."""
    name = F.regexp_extract("value", r'"crs"\s*:\s*\{.*?"name"\s*:\s*"([^"]*)"', 1)
    # every part but the last must end where the next feature begins, right before its type
    loose = F.sum((~F.col("value").rlike(r'\{\s*"type"\s*:\s*$')).cast("int"))
    r = text.agg(F.max(F.when(name != "", name)).alias("system"), loose.alias("loose")).first()
    if r["system"] and not r["system"].rstrip().endswith(LON_LAT):
        raise ReferenceSystemError(f"coordinates are in {r['system']}; convert them to longitude and latitude first")
    if (r["loose"] or 0) > 1:
        raise ValueError('"type" must be the first member of every feature')
