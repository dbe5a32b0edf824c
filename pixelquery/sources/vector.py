"""Polygon and region layers as GeoJSON (SRC9, SNK2, SNK7)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelquery.functions.geodesy import point
from pixelquery.schema import POLYGON_SCHEMA

_PROPERTIES = ("class", "class_id", "desc", "width_m", "height_m")
_FEATURE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "properties", T.StructType([POLYGON_SCHEMA[name] for name in _PROPERTIES])
        ),
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("coordinates", T.StringType()),  # nested as the type says
                ]
            ),
        ),
    ]
)
_RINGS = "array<array<array<double>>>"


def to_geojson(polygons: DataFrame) -> DataFrame:
    """One Feature text per polygon row; every column but the ring becomes a property."""
    properties = [c for c in polygons.columns if c != "ring"]
    ring = F.transform(F.col("ring"), lambda p: F.array(p["x"], p["y"]))
    return polygons.select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                F.struct(*properties).alias("properties"),
                F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias(
                    "geometry"
                ),
            )
        ).alias("value")
    )


def _one_ring(rings: Column) -> Column:
    """All rings of a shape, closed, as one: each further ring is visited from the very first point.

    The way there and back cancels out in an even-odd test, so holes are outside and all parts inside.
    """
    origin = F.slice(F.get(rings, F.lit(0)), 1, 1)
    further = F.slice(rings, 2, F.greatest(F.size(rings), F.lit(1)))
    return F.concat(
        F.get(rings, F.lit(0)), F.flatten(F.transform(further, lambda ring: F.concat(ring, origin)))
    )


def _polygon_columns(feature: str) -> list[Column]:
    coordinates = F.col(f"{feature}.geometry.coordinates")
    rings = F.when(
        F.col(f"{feature}.geometry.type") == "MultiPolygon",
        F.flatten(F.from_json(coordinates, f"array<{_RINGS}>")),
    ).otherwise(F.from_json(coordinates, _RINGS))
    ring = F.transform(_one_ring(rings), lambda c: point(F.get(c, F.lit(0)), F.get(c, F.lit(1))))
    return [F.col(f"{feature}.properties.{n}").alias(n) for n in _PROPERTIES] + [ring.alias("ring")]


def from_geojson(lines: DataFrame, column: str = "value") -> DataFrame:
    """Feature texts, one per row, to polygon rows; holes and several parts go into one even-odd ring."""
    parsed = lines.select(F.from_json(column, _FEATURE).alias("f"))
    return parsed.select(*_polygon_columns("f"))


def write_geojson(polygons: DataFrame, path: str) -> None:
    """Line-delimited features, so that reading splits like any text file."""
    to_geojson(polygons).write.text(path)


def read_geojson_lines(spark: SparkSession, path: str) -> DataFrame:
    return from_geojson(spark.read.text(path))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """A FeatureCollection document.  JSON documents do not split; large layers use lines."""
    collection = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
    documents = spark.read.schema(collection).json(path, multiLine=True)
    return documents.select(F.explode("features").alias("f")).select(*_polygon_columns("f"))


def write_feature_collections(features: DataFrame, path: str) -> None:
    """Feature texts (``value``) as FeatureCollection documents, one for each task."""

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = '{"type": "FeatureCollection", "features": ['
        for batch in batches:
            lines = []
            for text in batch.column(0).to_pylist():
                lines.append(before + text)
                before = ", "
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        if before == ", ":
            yield pa.RecordBatch.from_arrays([pa.array(["]}"])], ["value"])

    features.select("value").mapInArrow(documents, "value STRING").write.text(path)


def scan_geojson(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection documents of any size, read in parts.

    The text reader splits files at the mark that every feature has and a collection has not, so a document
    is scanned by as many tasks as it has blocks.  What follows a mark up to the next one holds one feature;
    its ``type`` must be its first member, as writers put it, and no other text may be the bare word
    "Feature" in quotes: otherwise this is an error, and ``read_geojson`` reads the document in one task.
    """
    records = spark.read.option("lineSep", '"Feature"').text(path)
    rest = F.ltrim(F.regexp_replace("value", r"^\s+", ""))
    feature = F.from_json(F.concat(F.lit('{"type": "Feature"'), rest), _FEATURE)
    before_any = rest.startswith("{") | (rest == "")
    # filters may be evaluated in any order, so the head of a document is told apart here as well
    checked = F.when(before_any, F.lit(None).cast(_FEATURE)).when(feature["geometry"].isNotNull(), feature).otherwise(
        F.raise_error(F.lit("a feature does not start with its type")).cast(_FEATURE)
    )
    features = records.where(~before_any).select(checked.alias("f"))
    return features.select(*_polygon_columns("f"))


def lines_to_geojson(lines: DataFrame) -> DataFrame:
    """Boundary lines (``points``) as LineString features, one per row."""
    properties = [c for c in lines.columns if c != "points"]
    points = F.transform(F.col("points"), lambda p: F.array(p["x"], p["y"]))
    return lines.select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                F.struct(*properties).alias("properties"),
                F.struct(F.lit("LineString").alias("type"), points.alias("coordinates")).alias(
                    "geometry"
                ),
            )
        ).alias("value")
    )
