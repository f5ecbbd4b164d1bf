"""Places of IPv4 and IPv6 addresses by nested prefixes of 128 bits.

An address is a number of 128 bits, held as two of 64; an IPv4 address is the one mapped to
``::ffff:0:0/96``. Each range is cut into the fewest prefixes that cover it, at most 254. An
address looks its own prefixes up, one for each length that occurs, and of
the ranges behind those that exist the innermost one holds. Nothing grows with the number
of addresses that a range covers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveysieve.operators.skew import join_per_key
from surveysieve.sources.sinks import stage_table

BITS = 128
_HALF = 64
_MASK = (1 << _HALF) - 1
# Fixed value: where IPv4 addresses lie among those of 128 bits.
_MAPPED = "00000000000000000000FFFF"
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|0*[0-9]{1,2})"
IPV4 = rf"{_OCTET}(\.{_OCTET}){{3}}"
_GROUP = "[0-9A-Fa-f]{1,4}"


def ip_number(ip: Column) -> Column:
    """Dotted IPv4 text as a number; NULL for anything else."""
    octets = [
        F.substring_index(F.substring_index(ip, ".", i), ".", -1).try_cast("int").cast("long") for i in range(1, 5)
    ]
    number = ((octets[0] * 256 + octets[1]) * 256 + octets[2]) * 256 + octets[3]
    return F.when(ip.rlike(f"^{IPV4}$"), number)


def _hex_of(number: Column, digits: int) -> Column:
    return F.lpad(F.hex(number), digits, "0")


def address_hex(ip: Column) -> Column:
    """The 32 hexadecimal digits of an IPv4 or IPv6 address; NULL for anything else.

    Groups of zeros may be left out once (``::``), the last 32 bits may be written as
    IPv4, and a zone (``%eth0``) is ignored.
    """
    address = F.regexp_replace(ip, "%[^%]*$", "")
    # An IPv4 ending stands for the last two groups.
    ending = _hex_of(ip_number(F.regexp_extract(address, f":({IPV4})$", 1)), 8)
    plain = F.when(
        address.rlike(f":{IPV4}$"),
        F.concat(
            F.regexp_replace(address, f"{IPV4}$", ""), F.substring(ending, 1, 4), F.lit(":"), F.substring(ending, 5, 4)
        ),
    ).otherwise(address)
    shortened = plain.contains("::")

    def groups(text: Column) -> Column:
        return F.filter(F.split(text, ":"), lambda g: g != "")

    left = groups(F.substring_index(plain, "::", 1))
    right = F.when(shortened, groups(F.substring_index(plain, "::", -1))).otherwise(F.array().cast("array<string>"))
    count = F.size(left) + F.size(right)
    written = rf"^(({_GROUP}:){{7}}{_GROUP}|({_GROUP}(:{_GROUP})*)?::({_GROUP}(:{_GROUP})*)?)$"
    valid = plain.rlike(written) & F.when(shortened, count <= 7).otherwise(count == 8)
    digits = F.concat(
        F.array_join(F.transform(left, lambda g: F.lpad(g, 4, "0")), ""),
        F.repeat(F.lit("0000"), (8 - count).cast("int")),
        F.array_join(F.transform(right, lambda g: F.lpad(g, 4, "0")), ""),
    )
    mapped = F.concat(F.lit(_MAPPED), _hex_of(ip_number(ip), 8))
    return F.coalesce(mapped, F.when(valid, F.upper(digits)))


def halves(digits: Column) -> tuple[Column, Column]:
    """The two signed numbers of 64 bits that 32 hexadecimal digits make."""
    return tuple(F.conv(F.substring(digits, first, 16), 16, -10).cast("long") for first in (1, 17))


def key_hex(column: Column, kind: str) -> Column:
    """Hexadecimal digits of an end of a range: a text, 16 bytes, or the number of an IPv4 address."""
    if kind == "binary":
        return F.when(F.octet_length(column) == 16, F.hex(column))
    if kind == "string":
        return address_hex(column)
    return F.concat(F.lit(_MAPPED), _hex_of(column.cast("long"), 8))


def prefixes(ranges: DataFrame, place: Column) -> DataFrame:
    """(bits, high, low, rank) of the prefixes that cover the ranges (start_ip, end_ip, ...), one row per prefix.

    The least rank belongs to the innermost range: the one that starts last, of these the one that
    ends first, of equal ones the one whose place comes first. A range with an end that is no
    address is an error.
    """
    kinds = dict(ranges.dtypes)
    ends = [key_hex(F.col(name), kinds[name]) for name in ("start_ip", "end_ip")]
    refused = F.raise_error(F.lit("a range of addresses does not begin and end with an address")).cast("string")
    known = [F.when(end.isNull(), refused).otherwise(end) for end in ends]
    rows = ranges.select(known[0].alias("start"), known[1].alias("end"), place.alias("place"))
    schema = f"bits int, high long, low long, inverse_start string, `end` string, place {rows.schema['place'].dataType.simpleString()}"
    cut = rows.mapInArrow(_covered, schema)
    return cut.groupBy("bits", "high", "low").agg(F.min(F.struct("inverse_start", "end", "place")).alias("rank"))


def _signed(value: int) -> int:
    return value - (1 << _HALF) if value >> (_HALF - 1) else value


def _covered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(start, end, place) -> a row per prefix."""
    for batch in batches:
        found, rows = [], []
        for row, (start, end) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True)):
            inverse = f"{(1 << BITS) - 1 - int(start, 16):032X}"
            for bits, first in cover(int(start, 16), int(end, 16)):
                found.append((bits, _signed(first >> _HALF), _signed(first & _MASK), inverse, end))
                rows.append(row)
        if rows:
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*columns, batch.column(2).take(pa.array(rows))], ["bits", "high", "low", "inverse_start", "end", "place"]
            )


def cover(start: int, end: int) -> Iterator[tuple[int, int]]:
    """(length, first address) of the fewest prefixes that make up all addresses from ``start`` to ``end``."""
    while start <= end:
        # As large as the beginning's trailing zeros and the rest of the range allow.
        size = min(start & -start or 1 << BITS, 1 << ((end - start + 1).bit_length() - 1))
        yield BITS - size.bit_length() + 1, start
        start += size


def locate(ips: DataFrame, ranges: DataFrame, place: Column) -> DataFrame:
    """(ip, place) of the distinct addresses ``ips`` (ip, digits) that a range covers."""
    table = stage_table(prefixes(ranges, place), "prefixes")
    # Texts become numbers once, not for each length and step that uses them.
    ips = stage_table(ips.select("ip", "digits"), "addresses")
    # At most one row per length.
    lengths = sorted(row["bits"] for row in table.select("bits").distinct().collect())
    high, low = halves(F.col("digits"))
    known = ips.where("digits IS NOT NULL").select("ip", high.alias("high"), low.alias("low"))

    def masked(bits: int) -> Column:
        mask = ((1 << BITS) - 1) ^ ((1 << (BITS - bits)) - 1)
        parts = (_signed(mask >> _HALF), _signed(mask & _MASK))
        return F.struct(
            F.lit(bits).alias("bits"),
            F.col("high").bitwiseAND(F.lit(parts[0]).cast("long")).alias("high"),
            F.col("low").bitwiseAND(F.lit(parts[1]).cast("long")).alias("low"),
        )

    kind = "array<struct<bits: int, high: bigint, low: bigint>>"
    asked = known.select("ip", F.inline(F.array(*map(masked, lengths)).cast(kind)))
    sizes = asked.groupBy("bits", "high", "low").agg(F.count("*").alias("addresses"))
    found = join_per_key(asked, table, ["bits", "high", "low"], "addresses", F.col("ip"), sizes=sizes)
    return found.groupBy("ip").agg(F.min("rank").alias("rank")).select("ip", F.col("rank.place").alias("place"))
