"""Side inputs: the weekly rate series (S7, P9) and district boundaries
from GeoJSON (S8, G11, F23)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT = "array<double>"


def read_rate_csv(spark: SparkSession, path: str) -> DataFrame:
    """S7 + P9: ``observation_date, MORTGAGE30US`` -> ``date, rate_30yr_fixed``."""
    df = (spark.read.option("header", True)
          .schema("observation_date date, MORTGAGE30US double").csv(path))
    return df.toDF("date", "rate_30yr_fixed")


def read_geojson_polygons(spark: SparkSession, path: str, reproject_from_3857: bool = False) -> DataFrame:
    """One row per feature with ``DistrictName, DistrictType, rings``.

    Coordinates are declared as raw JSON text (inference would collapse the
    mixed Polygon / MultiPolygon nesting) and parsed per geometry type;
    multipolygon parts are flattened into rings, which even-odd parity
    treats correctly together with holes. The rings' coordinate system is the
    file's ``crs`` member, else EPSG:3857 if they are to be reprojected, else
    EPSG:4326; it is kept as column metadata."""
    from parcelflow.operators.spatial import GEOGRAPHIC, MERCATOR, reproject_rings, with_crs
    schema = T.StructType([T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.StructType([
            T.StructField("DistrictName", T.StringType()),
            T.StructField("DistrictType", T.StringType())])),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType())]))]))),
        T.StructField("crs", T.StructType([T.StructField("properties", T.StructType([T.StructField("name", T.StringType())]))]))])
    body = spark.read.schema(schema).option("multiLine", True).json(path)
    # one name for each file
    named = [r[0] for r in body.select(F.col("crs.properties.name")).where("name IS NOT NULL").distinct().collect()]
    systems = {GEOGRAPHIC if n.endswith("CRS84") else "EPSG:" + n.rsplit(":", 1)[-1] for n in named}
    if len(systems) > 1:
        raise ValueError(f"several coordinate systems in {path}: {sorted(systems)}")
    crs = next(iter(systems), MERCATOR if reproject_from_3857 else GEOGRAPHIC)
    feats = body.select(F.explode("features").alias("f"))
    gtype, coords = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    poly = F.from_json(coords, f"array<array<{_POINT}>>")
    multi = F.flatten(F.from_json(coords, f"array<array<array<{_POINT}>>>"))
    rings = F.when(gtype == "Polygon", poly).when(gtype == "MultiPolygon", multi)
    to_xy = lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    out = feats.select(F.col("f.properties.DistrictName").alias("DistrictName"),
                       F.col("f.properties.DistrictType").alias("DistrictType"),
                       F.transform(rings, to_xy).alias("rings"))
    out = with_crs(out, crs)
    return reproject_rings(out) if reproject_from_3857 and crs != GEOGRAPHIC else out
