"""What must not be lost or changed on the way in and out, and what is refused."""

import ipaddress
import math
import os
import random
import sys
import time

import pyarrow as pa
import pytest
from pyspark.accumulators import AccumulatorParam
from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from surveysieve.config import Config, Flag, config_from_tables
from surveysieve.operators import bursts, descriptives, geo_location, ip_location, ip_prefixes, similarity
from surveysieve.operators.skew import join_per_key
from surveysieve.plans.flagging import apply_flags
from surveysieve.plans.manual import merge_labels
from surveysieve.sources import responses, sinks
from surveysieve.sources.ip_ranges import read_ip_ranges
from surveysieve.sources.polygons import POLYGON_SCHEMA, polygon_edges

# Errors in tasks, as they reach the driver.
REFUSED = (PySparkException, Py4JJavaError)
TEXT = "response_id long, text string, other string"


def test_line_breaks_need_their_option(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w", encoding="utf-8", newline="") as file:
        file.write('response_id,text,other\n1,"first\nsecond",x\n2,plain,y\n')
    with pytest.raises(REFUSED):
        responses.read_csv(spark, path, TEXT, "response_id").collect()
    with pytest.raises(REFUSED):
        responses.read_csv(spark, path, TEXT, "response_id").select("response_id").collect()
    rows = responses.read_csv(spark, path, TEXT, "response_id", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, "first\nsecond", "x"), (2, "plain", "y")]


def test_values_of_another_type_are_refused(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("response_id,n\n1,2\n2,two\n")
    with pytest.raises(REFUSED):
        responses.read_csv(spark, str(path), "response_id long, n int", "response_id").collect()


def test_white_space_at_the_ends_stays(spark, tmp_path):
    rows = [(1, "  lead", "a"), (2, "trail \t", " "), (3, ' "both" ', "\t"), (4, None, None), (5, 'a "b", c', "x\\y")]
    df = spark.createDataFrame(rows, TEXT)
    sinks.write_csv(df, str(tmp_path / "c"))
    back = responses.read_csv(spark, str(tmp_path / "c"), responses.review_schema(df), "response_id")
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_conflicting_labels_are_refused(spark):
    df = spark.createDataFrame([(1,), (2,)], "response_id long")
    schema = "response_id long, MANUAL_FLAG string, MANUAL_COMMENT string"
    agreed = spark.createDataFrame([(1, "FRAUD", None), (1, "FRAUD", None)], schema)
    assert merge_labels(df, agreed, "response_id").count() == 2
    for rows in ([(1, "FRAUD", None), (1, "VALID", None)], [(None, "FRAUD", None)], [(1, "FRAUD", "a"), (1, "FRAUD", None)]):
        with pytest.raises(ValueError, match="manual labels"):
            merge_labels(df, spark.createDataFrame(rows, schema), "response_id")


DUPLICATES = Flag("F_D", "check_DuplicatedText", None, {"list_of_columns": "text", "min_length": 1, "max_length": 99})


@pytest.mark.parametrize("keys", [[1, 1, 2], [1, None, 2]])
def test_missing_and_repeated_keys_are_refused(spark, keys):
    df = spark.createDataFrame([(k, "same") for k in keys], "response_id long, text string")
    with pytest.raises(ValueError, match="key"):
        apply_flags(df, [DUPLICATES], "response_id")
    assert apply_flags(df.where("response_id = 2"), [DUPLICATES], "response_id").count() == 1


def test_flags_see_what_earlier_flags_made(spark):
    df = spark.createDataFrame([(i, i % 3, i > 2) for i in range(6)], "response_id long, n int, F_A boolean")
    flags = [
        Flag("F_Before", "check_CustomCondition", None, {"condition": "F_A"}),
        Flag("F_A", "check_ValueInRange", None, {"column_name": "n", "lower_threshold": 1, "upper_threshold": 1}),
        Flag("F_After", "check_CustomCondition", None, {"condition": "F_A"}),
        Flag("F_Number", "check_CustomCondition", None, {"condition": "n"}),
        Flag("F_Repeated", "check_DuplicatedText", None, {"list_of_columns": "F_After", "min_length": 5, "max_length": 9}),
        Flag("F_Letter", "check_SuspiciousCharacter", None, {"list_of_columns": ["F_Repeated"], "list_of_chars": ["tr"]}),
    ]
    got = apply_flags(df, flags, "response_id")
    assert got.columns == ["response_id", "n", "F_Before", "F_A", "F_After", "F_Number", "F_Repeated", "F_Letter"]
    for row in got.collect():
        ones = row.n == 1
        assert (row.F_Before, row.F_A, row.F_After, row.F_Number) == (row.response_id > 2, ones, ones, row.n != 0)
        assert row.F_Repeated == row.F_Letter == (not ones)


def test_terminate_columns_are_not_borrowed(spark):
    df = spark.createDataFrame([(1, "1.2.3.4", None, "s")], "response_id long, ip string, ok string, stop string")
    common = {"column_ip": "ip", "column_success": "ok", "num_attempts_lower": 1}
    failed = Flag("F_F", "check_MultipleIPAttempts", None, {**common, "attempt_type": "failed", "column_terminate": "stop"})
    bare = Flag("F_I", "check_MultipleIPAttempts", None, {**common, "attempt_type": "incomplete"})
    total = Flag("F_T", "check_MultipleIPAttempts", None, {**common, "attempt_type": "all"})
    with pytest.raises(ValueError, match="column_terminate"):
        apply_flags(df, [failed, bare], "response_id")
    row = apply_flags(df, [total, failed], "response_id").first()
    assert (row.num_attempts_all, row.num_attempts_failed) == (1, 1)


def test_plan_reads_the_input_seldom(spark, tmp_path):
    rows = [(i, f"1.2.{i % 3}.4", str(i), "2024-01-01 10:00:00", float(i), "text") for i in range(30)]
    schema = "response_id long, ip string, ok string, started string, d double, text string"
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.parquet(path)
    flags = [
        Flag("F_1", "check_MultipleIPAttempts", None, {"column_ip": "ip", "column_success": "ok", "num_attempts_lower": 2}),
        Flag("F_2", "check_BurstResponses", None, {
            "column_start_time": "started", "column_duration": "d",
            "max_start_time_difference": 5, "max_duration_difference": 2,
        }),
        DUPLICATES,
    ]
    plan = apply_flags(spark.read.parquet(path), flags, "response_id")._jdf.queryExecution().optimizedPlan()
    assert str(plan.collectLeaves().mkString("\n")).count("Relation") >= 3
    files = apply_flags(spark.read.parquet(path), flags, "response_id")._jdf.queryExecution().executedPlan().toString()
    assert files.count(os.path.basename(str(tmp_path)) + "/in") <= 3


# Ranges of addresses


def brute_place(ranges, number):
    covering = [r for r in ranges if r[0] <= number <= r[1]]
    return max(covering, key=lambda r: (r[0], -r[1]))[4] if covering else None


def test_nested_and_overlapping_ranges(spark):
    generator, base = random.Random(6), 10 << 24
    ranges = [(base, base + (1 << 18), 0.0, 0.0, "all", None, None), (base + 1000, base + 1000, 0.0, 0.0, "one", None, None)]
    for number in range(120):
        start = base + generator.randrange(1 << 18)
        ranges.append((start, start + generator.choice([0, 5, 300, 70_000, 150_000]), 0.0, 0.0, f"r{number}", None, None))
    unique = {(r[0], r[1]): r for r in ranges}
    ranges = list(unique.values())
    numbers = [base + generator.randrange((1 << 18) + 100_000) for _ in range(800)] + [base + 999, base + 1000, base + 1001, base - 1]
    ips = spark.createDataFrame([(str(ipaddress.IPv4Address(n)),) for n in set(numbers)], "ip string")
    table = spark.createDataFrame(ranges, "start_ip long, end_ip long, lat double, lon double, country string, state string, city string")
    found = {r.ip: r.IPCountry for r in ip_location.locate_ips(ips, table).collect()}
    for number in numbers:
        assert found.get(str(ipaddress.IPv4Address(number))) == brute_place(ranges, number)


def test_what_is_no_address_has_no_place_or_is_refused(spark):
    ips = spark.createDataFrame([("1.2.3.4",), ("2001:db8::1",), ("::ffff:1.2.3.4",), ("not an address",), (None,)], "ip string")
    table = spark.createDataFrame([(0, 2**32 - 1, 0.0, 0.0, "X", None, None)], "start_ip long, end_ip long, lat double, lon double, country string, state string, city string")
    with pytest.raises(REFUSED, match="no address: not an"):
        ip_location.locate_ips(ips, table, no_address="error").collect()
    assert sorted(r.ip for r in ip_location.locate_ips(ips, table).collect()) == ["1.2.3.4", "::ffff:1.2.3.4"]
    with pytest.raises(ValueError):
        ip_location.locate_ips(ips, table, no_address="x")


ODD_ADDRESSES = [
    "::", "::1", "1::", "2001:db8::1", "2001:DB8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
    "fe80::1%eth0", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33", "1:2:3:4:5:6:1.2.3.4", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff",
    "1.2.3.4", "255.255.255.255", "0.0.0.0", "8000::", "::8000:0:0:0",
    "", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7:8::", "12345::", "g::", "1.2.3", "1.2.3.256",
    "::1.2.3", "1.2.3.4::", ":1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:", "1.2.3.4:1::", "::1.2.3.400", "1:2:3:4:5:6:7:1.2.3.4", " ::1",
]


def python_address(text):
    try:
        address = ipaddress.ip_address(text.split("%")[0])
    except ValueError:
        return None
    return int(address) + (0xFFFF << 32 if address.version == 4 else 0)


def test_addresses_are_read_as_python_reads_them(spark):
    df = spark.createDataFrame([(a,) for a in ODD_ADDRESSES], "ip string")
    digits = ip_prefixes.address_hex(F.col("ip"))
    for row in df.select("ip", digits.alias("digits")).collect():
        expected = python_address(row.ip)
        assert row.digits == (None if expected is None else f"{expected:032X}"), row.ip


def test_prefixes_cover_a_range_exactly():
    generator = random.Random(4)
    for _ in range(300):
        start = generator.randrange(2 ** generator.choice([4, 20, 127]))
        end = min(start + generator.randrange(2 ** generator.choice([1, 9, 64, 127])), 2**128 - 1)
        following, count = start, 0
        for bits, first in ip_prefixes.cover(start, end):
            assert first == following and first % (1 << (128 - bits)) == 0
            following, count = first + (1 << (128 - bits)), count + 1
        assert following == end + 1 and count <= 254
    assert list(ip_prefixes.cover(0, 2**128 - 1)) == [(0, 0)] and list(ip_prefixes.cover(5, 4)) == []


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_innermost_range_of_ipv6_addresses(spark, kind):
    generator = random.Random(9)
    base = 0x20010DB8 << 96
    numbers, ranges = [], [(0, 2**128 - 1, "all"), (0xFFFF << 32, (0xFFFF << 32) + 2**31, "v4")]
    for n in range(60):
        start = base + generator.randrange(40) * 2**generator.choice([3, 64, 80]) + generator.randrange(9)
        ranges.append((start, start + generator.randrange(2 ** generator.choice([2, 50, 82])), f"r{n}"))
    ranges += [(*ranges[5][:2], "same"), (*ranges[5][:2], "also")]
    for start, end, _ in ranges:
        numbers += [start, end, max(start - 1, 0), min(end + 1, 2**128 - 1), (start + end) // 2]
    # Mapped addresses are written both ways.
    texts = {str(ipaddress.IPv6Address(n)): n for n in numbers} | {"127.255.255.255": (0xFFFF << 32) + 2**31 - 1}
    ips = spark.createDataFrame([(t,) for t in texts], "ip string")
    shown = {"string": lambda n: str(ipaddress.IPv6Address(n)), "binary": lambda n: n.to_bytes(16, "big")}[kind]
    rows = [(shown(a), shown(b), 0.0, 0.0, name, None, None) for a, b, name in ranges]
    table = spark.createDataFrame(rows, f"start_ip {kind}, end_ip {kind}, lat double, lon double, country string, state string, city string")
    found = {r.ip: r.IPCountry for r in ip_location.locate_ips(ips, table).collect()}
    for text, number in texts.items():
        best = min(((-a, b, name) for a, b, name in ranges if a <= number <= b), default=(0, 0, None))
        assert found.get(text) == best[2], text


def test_address_texts_are_read_once(spark):
    ips = spark.createDataFrame([("2001:db8::1",), ("1.2.3.4",), ("2001:db9::",)], "ip string")
    rows = [("2001:db8::", "2001:db8::ff", 0.0, 0.0, "A", None, None), ("1.2.3.0", "1.2.3.9", 0.0, 0.0, "B", None, None)]
    table = spark.createDataFrame(rows, "start_ip string, end_ip string, lat double, lon double, country string, state string, city string")
    found = ip_location.locate_ips(ips, table)
    # The steps use digits from a table, and do not take the texts apart.
    assert "rlike" not in found._jdf.queryExecution().toString().lower()
    assert {r.ip: r.IPCountry for r in found.collect()} == {"2001:db8::1": "A", "1.2.3.4": "B"}


def test_ranges_of_both_kinds_from_csv(spark, tmp_path):
    path = tmp_path / "ranges.csv"
    head = "start_ip,end_ip,lat,lon,country,state,city\n"
    path.write_text(head + "1.0.0.0,1.0.0.255,1,2,A,,\n16777472,16777500,1,2,B,,\n")
    assert dict(read_ip_ranges(spark, str(path)).dtypes)["start_ip"] == "bigint"
    path.write_text(head + "1.0.0.0,1.0.0.255,1,2,A,,\n16777472,16777500,1,2,B,,\n2001:db8::,2001:db8::ff,1,2,C,,\n")
    ips = spark.createDataFrame([("1.0.0.9",), ("1.0.1.3",), ("2001:db8::f",), ("2001:db8::fff",)], "ip string")
    found = ip_location.locate_ips(ips, read_ip_ranges(spark, str(path))).collect()
    assert {r.ip: r.IPCountry for r in found} == {"1.0.0.9": "A", "1.0.1.3": "B", "2001:db8::f": "C"}
    bad = spark.createDataFrame([("x", "1.2.3.4", 0.0, 0.0, "A", None, None)], "start_ip string, end_ip string, lat double, lon double, country string, state string, city string")
    with pytest.raises(REFUSED, match="range of addresses"):
        ip_location.locate_ips(ips, bad).collect()


# Start times


def test_start_times(spark):
    texts = {
        "2024-05-30 22:26:05": (22, 26, 5), "5/30/2024 10:26 PM": (22, 26, 0), "5/30/2024 22:26": (22, 26, 0),
        "5/30/2024 1:02:03 am": (1, 2, 3), " 2024-05-30T22:26:05 ": (22, 26, 5), "": None, "  ": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", bursts.wall_clock(df, "t").alias("at")).collect()
    assert {r.t: r.at and (r.at.hour, r.at.minute, r.at.second) for r in rows} == texts
    other = spark.createDataFrame([("30.05.2024 22h26",)], "t string")
    with pytest.raises(REFUSED, match="not a start time"):
        other.select(bursts.wall_clock(other, "t")).collect()
    assert other.select(bursts.wall_clock(other, "t", "dd.MM.yyyy HH'h'mm")).first()[0].minute == 26


# Lanes, members, matrix, stages


def test_lanes_follow_the_weight(spark):
    rows = spark.range(1_000).select(F.lit("hot").alias("k"), "id").unionByName(spark.createDataFrame([("cold", 5_000)], "k string, id long"))
    sizes = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = join_per_key(rows, sizes, ["k"], "n", F.col("id"), hot_rows=10)
    assert joined.count() == 1_001 and joined.where("n = 1000").count() == 1_000


def test_members_and_pairs_tell_everything(spark):
    texts = ["an answer here", "an answer here", "an answer there", "quite another text", "quite another text", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    members = {}
    for row in similarity.similar_members(df, "id", "text").collect():
        members.setdefault(row.representative, []).append(row.id)
    assert {k: sorted(v) for k, v in members.items()} == {0: [0, 1], 2: [2], 3: [3, 4], 5: [5]}
    counts = dict.fromkeys(range(6), 0)
    for pair in similarity.similar_pairs(df, "id", "text").collect():
        for a in members[pair.id_i]:
            for b in members[pair.id_j]:
                if a != b:
                    counts[a] += 1
                    counts[b] += pair.id_i != pair.id_j
    answers = similarity.similar_answers(df, "id", "text", list_name=None).collect()
    assert {r.id: r.similar_count for r in answers} == {k: n for k, n in counts.items() if n}


def test_matrix_counts_labels_that_no_rule_gives(spark):
    config = config_from_tables(
        {
            "flags": [{"flag_name": "F", "method_name": "m", "flag_group": "G", "use_flag": 1, "parameters": {}}],
            "final_classification_rules": [{"rule_num": "1", "condition_expr": True, "classification": "FRAUD", "use_rule": 1}],
        }
    )
    table = spark.createDataFrame([(True, 1, "FRAUD", 2), (True, 1, "typo", 3), (False, 0, None, 4)], "F boolean, G int, MANUAL_FLAG string, n long")
    rows = {r["label"]: r for r in descriptives.cooccurrence_matrix(table, config, ["MANUAL_FLAG"]).collect()}
    assert list(rows) == ["F", "(manual) FRAUD", "(manual) VALID", "(manual) other"]
    assert [rows["F"][c] for c in rows] == [5, 2, 0, 3]


def test_stages_end_with_their_block(spark, tmp_path):
    with sinks.stages(spark):
        kept = sinks.stage_table(spark.range(5), "some")
        path = kept.inputFiles()[0]
        assert kept.count() == 5
    time.sleep(0.1)
    assert not os.path.exists(path.removeprefix("file://"))


# Bursts


@pytest.mark.parametrize("rows", [400, 1_600])
def test_no_group_of_bursts_outgrows_its_bound(spark, monkeypatch, rows):
    """With few slices allowed, more points make more parts, not larger groups."""
    monkeypatch.setattr(bursts, "MAX_SLICES", 3)
    answer = bursts._answer
    generator = random.Random(3)
    points = [(i, generator.randrange(3_000), float(generator.randrange(40))) for i in range(rows)]
    points += [(rows + i, 77, 5.0 + i % 3) for i in range(rows // 3)]
    df = spark.createDataFrame(points, "response_id long, s long, d double").selectExpr(
        "response_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) AS t", "d"
    )
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    sizes = spark.sparkContext.accumulator(0, _Most())

    def watched(group):
        sizes.add(group.num_rows)
        return answer(group)

    monkeypatch.setattr(bursts, "_answer", watched)
    counts = bursts.burst_counts(df, "response_id", "t", "d", 200, 3.0, 20, 1.0, slice_rows=20)
    found = {r.response_id: r.burst_count for r in counts.collect()}
    for i, s, d in points:
        near = sum(abs(s - other) <= 200 and abs(d - e) <= 3 for _, other, e in points)
        near -= sum(abs(s - other) <= 20 and abs(d - e) <= 1 for _, other, e in points)
        assert found[i] == near
    assert 0 < sizes.value < 1_500


class _Most(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


# Cells


def test_cells_inside_a_country_have_no_segments(spark):
    corners = [{"lon": float(x), "lat": float(y)} for x, y in ((0.5, 0.5), (9.5, 0.5), (9.5, 9.5), (0.5, 9.5))]
    square = spark.createDataFrame([("A", "AAA", 1, corners)], POLYGON_SCHEMA)
    banded, covered = geo_location._grid(polygon_edges(square).selectExpr("1 AS country", "x1", "y1", "x2", "y2"), ["country"], 1.0)
    cells = {(r.cell_x, r.cell_y): r for r in geo_location.classified_cells(banded, covered, 1.0).collect()}
    inner = [cells[x, y] for x in range(1, 9) for y in range(1, 9)]
    assert all((r.parity, r.near, r.steps) == (1, [], []) for r in inner)
    assert all(cells[x, y].near for x, y in ((0, 3), (9, 3), (3, 0), (3, 9)))


# Publishing tables


def test_an_earlier_table_stays_until_the_new_one_is_whole(spark, tmp_path):
    folder = str(tmp_path / "reports")
    old = spark.range(5).toDF("n")
    failing = spark.range(0, 100, 1, 8).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("n"))
    csv = str(tmp_path / "table.csv")
    sinks.write_report(old, folder, "counts")
    sinks.write_csv(old, csv)
    for write in (lambda: sinks.write_report(failing, folder, "counts"), lambda: sinks.write_csv(failing, csv)):
        with pytest.raises(REFUSED):
            write()
    assert sorted(r.n for r in sinks.read_report(spark, folder, "counts").collect()) == list(range(5))
    assert spark.read.csv(csv, header=True).count() == 5
    # A table may be made from the one that it replaces.
    doubled = sinks.read_report(spark, folder, "counts").selectExpr("n * 2 AS n")
    sinks.write_report(doubled, folder, "counts")
    assert sorted(r.n for r in sinks.read_report(spark, folder, "counts").collect()) == [0, 2, 4, 6, 8]
    assert os.listdir(folder) == ["counts"] and sorted(os.listdir(tmp_path)) == ["reports", "table.csv"]


# Many flags


def test_cooccurrence_of_many_flags_shuffles_pairs_of_labels_only(spark):
    generator = random.Random(17)
    flags = [f"F_{i}" for i in range(60)]
    rows = [(*(generator.choice([True, False, None]) for _ in flags), generator.choice(["x", "y", None]), f"m{generator.randrange(9)}") for _ in range(800)]
    schema = ", ".join(f"{f} boolean" for f in flags) + ", AUTOMATED_FLAG string, MANUAL_FLAG string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    settings = Config(flags=tuple(Flag(f, "check_CustomCondition") for f in flags))
    table = descriptives.patterns(df, settings, ["AUTOMATED_FLAG", "MANUAL_FLAG"])
    expected = {}
    for row in rows:
        labels = [f for f, on in zip(flags, row, strict=False) if on]
        labels += [p + v for p, v in zip(("(auto) ", "(manual) "), row[60:], strict=True) if v is not None]
        for a in labels:
            for b in labels:
                expected[a, b] = expected.get((a, b), 0) + 1
    found = descriptives.cooccurrence(table, settings, ["AUTOMATED_FLAG", "MANUAL_FLAG"])
    assert {(r.label_a, r.label_b): r.n for r in found.collect()} == expected
    combined = table.groupBy(*[F.col(c) for c in table.columns if c != "n"]).agg(F.sum("n").alias("n"))
    again = descriptives.cooccurrence(combined, settings, ["AUTOMATED_FLAG", "MANUAL_FLAG"])
    assert {(r.label_a, r.label_b): r.n for r in again.collect()} == expected
    batches = [pa.RecordBatch.from_pylist([{"n": 2, "__a0": True, "__a1": k % 2 == 0} for k in range(1_000)]) for _ in range(20)]
    handed_on = list(descriptives._pair_counts(["a", "b"])(batches))
    assert sum(b.num_rows for b in handed_on) == 4 and handed_on[0].column(2).to_pylist()[0] == 40_000


# Dense borders


def test_cells_adapt_to_dense_borders(spark):
    """A border of many segments within two degrees: no cell holds more than the bound, and points are placed as by all segments."""
    n = 4_000
    ring = []
    for i in range(n):
        angle, radius = 2 * math.pi * i / n, 0.7 + 0.2 * (i % 2) * (i % 7) / 7
        ring.append((10.3 + radius * math.cos(angle), 5.4 + radius * math.sin(angle)))
    square = [(9.0, 4.0), (9.0, 7.5), (12.0, 7.5), (12.0, 4.0)]
    rows = [("Star", "ST", 0, ring), ("Zone", "ZN", 0, square), ("Zone", "ZN", 1, [(9.5, 4.5), (9.5, 4.6), (9.6, 4.6)])]
    polygons = spark.createDataFrame(rows, POLYGON_SCHEMA)
    edges = polygon_edges(polygons.where("name = 'Star'")).selectExpr("1 AS country", "x1", "y1", "x2", "y2")
    cells = geo_location.adaptive_cells(edges, 1.0, 64).select("level", F.size("near").alias("near")).collect()
    assert max(c.near for c in cells) <= 64 and len({c.level for c in cells}) > 2
    generator = random.Random(2)
    points = [(generator.uniform(3.9, 7.6), generator.uniform(8.9, 12.1)) for _ in range(400)] + [(5.4 + 0.7 * k / 100, 10.3) for k in range(130)]
    df = spark.createDataFrame(points, "lat double, lon double")

    def place(limit):
        return {(r.lat, r.lon): r.name for r in geo_location.locate_points(df, polygons, most_segments=limit).collect()}

    found = place(64)
    assert found == place(10**9) and {"Star", "Zone"} <= set(found.values())
