"""Place of an IP address: an as-of join with a table of address ranges."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.functions.columns import col_
from surveysieve.operators import ip_prefixes
from surveysieve.operators.skew import HOT_ROWS, join_per_key

# Output columns of the lookup, with the range column behind each.
PLACE = {
    "IPLatitude": "lat",
    "IPLongitude": "lon",
    "IPCountry": "country",
    "IPState": "state",
    "IPCity": "city",
}
REGION_LEVELS = {"country": "IPCountry", "state": "IPState", "city": "IPCity"}

_BLOCK_BITS = 16
NO_ADDRESS = ("missing", "error")


def flat_ranges(ranges: DataFrame) -> DataFrame:
    """The ranges cut at blocks of 65,536 addresses, and into pieces that do not overlap: block, start, end, place.

    Of several ranges that cover an address, the innermost one holds there: the
    one that starts last, of these the one that ends first, of equal ones the
    one whose place comes first.
    """
    block = 1 << _BLOCK_BITS
    place = F.struct(*[F.col(c) for c in PLACE.values()])
    cut = ranges.select(
        F.explode(
            F.sequence(F.shiftright("start_ip", _BLOCK_BITS), F.shiftright("end_ip", _BLOCK_BITS))
        ).alias("block"),
        "start_ip",
        "end_ip",
        place.alias("place"),
    ).select(
        "block",
        F.greatest("start_ip", F.col("block") * block).alias("start"),
        F.least("end_ip", F.col("block") * block + (block - 1)).alias("end"),
        F.struct((-F.col("start_ip")).alias("from"), F.col("end_ip").alias("to"), "place").alias("rank"),
    )
    # Equal pieces of a block are settled first, so a block holds at most one for each pair of its addresses.
    settled = cut.groupBy("block", "start", "end").agg(F.min("rank").alias("rank"))
    named = settled.select("block", "start", "end", "rank.from", "rank.to", F.to_json("rank.place").alias("order"), "rank.place")
    grouped = named.repartition("block").sortWithinPartitions("block", "start", "from", "to", "order")
    return grouped.drop("order").mapInArrow(_disjoint, _pieces_schema(ranges))


def _pieces_schema(ranges: DataFrame) -> str:
    kinds = dict(ranges.dtypes)
    place = ", ".join(f"{c}: {kinds[c]}" for c in PLACE.values())
    return f"block long, start long, `end` long, place struct<{place}>"


def _disjoint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces without overlap from the sorted ranges of each block."""
    schema, current, held = None, None, []
    for batch in batches:
        schema = batch.schema
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[0] != current and held:
                yield _pieces(current, held, schema)
                held = []
            current = row[0]
            held.append(row[1:])
    if held:
        yield _pieces(current, held, schema)


def _pieces(block: int, ranges: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Sweeps over the borders of a block's ranges and keeps the innermost open range on top of a heap."""
    borders = sorted({row[0] for row in ranges} | {row[1] + 1 for row in ranges})
    open_ranges: list[tuple] = []
    found: list[list] = []
    following = 0
    for start, after in zip(borders, [*borders[1:], borders[-1]]):
        while following < len(ranges) and ranges[following][0] == start:
            _, end, negative_start, full_end, _ = ranges[following]
            heapq.heappush(open_ranges, (negative_start, full_end, following, end))
            following += 1
        while open_ranges and open_ranges[0][3] < start:
            heapq.heappop(open_ranges)
        if open_ranges:
            number = open_ranges[0][2]
            if found and found[-1][2] == number and found[-1][1] == start - 1:
                found[-1][1] = after - 1
            else:
                found.append([start, after - 1, number])
    places = pa.array([ranges[number][4] for *_, number in found], schema.field("place").type)
    starts, ends = (pa.array([row[i] for row in found], pa.int64()) for i in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array([block] * len(found), pa.int64()), starts, ends, places], ["block", "start", "end", "place"])


def locate_ips(ips: DataFrame, ranges: DataFrame, no_address: str = "missing") -> DataFrame:
    """Place of each distinct address in ``ips.ip``, if a range covers it.

    ``ranges`` holds (start_ip, end_ip, lat, lon, country, state, city); they may
    nest or overlap: the innermost one holds (see ``flat_ranges``). Ends that are numbers
    are IPv4 addresses, and all addresses of other ranges have no place there; ends may also be
    texts or 16 bytes, of IPv4 and IPv6 addresses. An IPv4 address and the IPv6 address mapped to it are the same.

    What is no address at all has no place, or is an error if ``no_address`` is "error".
    """
    if no_address not in NO_ADDRESS:
        raise ValueError(f"no_address must be one of {NO_ADDRESS}, not '{no_address}'")
    digits = ip_prefixes.address_hex(F.col("ip"))
    if no_address == "error":
        refused = F.raise_error(F.concat(F.lit("this is no address: "), "ip")).cast("string")
        digits = F.when(F.col("ip").isNotNull() & digits.isNull(), refused).otherwise(digits)
    known = ips.select("ip", digits.alias("digits"))
    if dict(ranges.dtypes)["start_ip"] in ("string", "binary"):
        place = F.struct(*[F.col(c) for c in PLACE.values()])
        found = ip_prefixes.locate(known, ranges, place)
    else:
        found = _locate_numbers(known, ranges)
    return found.select("ip", *[F.col(f"place.{source}").alias(name) for name, source in PLACE.items()])


def _locate_numbers(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """(ip, place) of IPv4 addresses by ranges of numbers.

    Within a block of 65,536 neighbouring addresses, addresses and the starts of the
    pieces are sorted together and each address takes the last piece that started. A block holds at most
    that many addresses and pieces, so no task grows with the data and no pairs are tried.
    """
    starts = flat_ranges(ranges).select(
        "block", F.col("start").alias("at"), F.lit(None).cast("string").alias("ip"), F.struct("end", "place.*").alias("place")
    )
    high, low = ip_prefixes.halves(F.col("digits"))
    first = 0xFFFF << 32
    addresses = (
        ips.select("ip", F.when((high == 0) & low.between(first, first + 2**32 - 1), low - first).alias("at"))
        .where("at IS NOT NULL")
        .select(F.shiftright("at", _BLOCK_BITS).alias("block"), "at", "ip")
    )
    merged = starts.unionByName(addresses, allowMissingColumns=True)
    so_far = (
        Window.partitionBy("block")
        .orderBy("at", F.col("ip").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = merged.withColumn("place", F.last("place", ignorenulls=True).over(so_far))
    return found.where(F.col("ip").isNotNull() & (F.col("at") <= F.col("place.end")))


def ip_places(
    df: DataFrame, key: str, column_ip: str, ranges: DataFrame, hot_rows: int = HOT_ROWS, no_address: str = "missing"
) -> DataFrame:
    """(key, IPLatitude .. IPCity) of the responses whose address is in a range."""
    rows = df.select(col_(key).alias(key), col_(column_ip).cast("string").alias("ip")).where("ip IS NOT NULL")
    sizes = rows.groupBy("ip").agg(F.count("*").alias("__rows"))
    # Always true; with the count in use, the plan aggregates once for both uses.
    located = locate_ips(sizes.where("__rows > 0"), ranges, no_address)
    return join_per_key(rows, located, ["ip"], "__rows", F.col(key), hot_rows, sizes=sizes).select(key, *PLACE)
