"""Country borders: rings of vertices, one row per ring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POLYGON_SCHEMA = "name string, iso3 string, ring_id int, vertices array<struct<lon: double, lat: double>>"


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """Rings from JSON lines (``*.json``, ``*.jsonl``) or Parquet."""
    if path.endswith((".json", ".jsonl")):
        return spark.read.schema(POLYGON_SCHEMA).json(path)
    return spark.read.parquet(path).select("name", "iso3", "ring_id", "vertices")


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """Border segments (name, iso3, ring_id, edge, x1, y1, x2, y2); rings close by themselves."""
    following = F.concat(F.slice("vertices", 2, F.size("vertices")), F.slice("vertices", 1, 1))
    segment = F.posexplode(F.arrays_zip(F.col("vertices").alias("a"), following.alias("b")))
    return (
        polygons.where(F.size("vertices") > 0)
        .select("name", "iso3", "ring_id", segment.alias("edge", "s"))
        .select(
            "name",
            "iso3",
            "ring_id",
            "edge",
            F.col("s.a.lon").alias("x1"),
            F.col("s.a.lat").alias("y1"),
            F.col("s.b.lon").alias("x2"),
            F.col("s.b.lat").alias("y2"),
        )
        .where("x1 <> x2 OR y1 <> y2")
    )
