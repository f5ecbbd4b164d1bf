"""Places of ranges of IPv4 and IPv6 addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveysieve.operators.ip_prefixes import ip_number

RANGE_SCHEMA = "start_ip bigint, end_ip bigint, lat double, lon double, country string, state string, city string"


def read_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Ranges from Parquet, or from CSV with a header.

    Parquet may hold the ends as numbers (of IPv4 addresses), as text or as 16 bytes. CSV may
    hold numbers and addresses as text; ends stay text if any is an IPv6 address, else they
    become numbers.
    """
    if not path.endswith(".csv"):
        return spark.read.parquet(path).select(*[f.split()[0] for f in RANGE_SCHEMA.split(", ")])
    text = RANGE_SCHEMA.replace("_ip bigint", "_ip string")
    ranges = spark.read.schema(text).csv(path, header=True)
    ends = {c: F.coalesce(F.col(c).try_cast("bigint"), ip_number(F.col(c))) for c in ("start_ip", "end_ip")}
    if ranges.where(F.col("start_ip").contains(":") | F.col("end_ip").contains(":")).isEmpty():
        return ranges.withColumns(ends)
    octets = [F.shiftright("number", shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)]
    for name, number in ends.items():
        dotted = ranges.withColumn("number", number).withColumn("dotted", F.concat_ws(".", *octets))
        shown = F.when(F.col("number").isNull(), F.col(name)).otherwise(F.col("dotted"))
        ranges = dotted.withColumn(name, shown).drop("number", "dotted")
    return ranges
