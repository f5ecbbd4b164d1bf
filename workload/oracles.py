"""The same results in plain SQL for DuckDB, by nested joins and windows."""

from __future__ import annotations

from surveysieve.functions.text import WHITE_SPACE
from workload.tables import COUNTRY_RINGS

ORACLES: dict[str, str] = {}

_QUESTIONS = ", ".join(
    f"CASE WHEN event_id % 13 = {a} THEN -99 WHEN event_id % 17 = {a} THEN NULL "
    f"ELSE (event_id * {p} + user_id) % 7 + 1 END AS q{a}"
    for a, p in ((1, 3), (2, 5), (3, 11), (4, 19))
)

RESPONSES = f"""resp AS (
  SELECT event_id AS response_id, epoch_us(ts) AS t, value AS duration, event_type,
    concat('10.', user_id % 50, '.', event_id % 8, '.', event_id % 200) AS ip,
    concat('10.', user_id % 50, '.', event_id % 8) AS net,
    (10::BIGINT * 16777216) + (user_id % 50) * 65536 + (event_id % 8) * 256 + event_id % 200 AS ip_number,
    CASE WHEN event_type = 'purchase' THEN value END AS success,
    CASE WHEN event_type = 'error' THEN 'Screened' END AS terminate,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS progress,
    {_QUESTIONS},
    CASE WHEN event_id % 9 != 0 THEN event_id % 5 + 1 END AS instructed,
    CASE WHEN event_id % 19 != 0 THEN (event_id * 37 % 1700) / 10.0::DOUBLE - 85.0::DOUBLE END AS latitude,
    CASE WHEN event_id % 19 != 0 THEN (event_id * 91 % 3590) / 10.0::DOUBLE - 179.5::DOUBLE END AS longitude
  FROM events)"""


def _with(*tables: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(tables) + "\n"


def _mean(columns: list[str]) -> str:
    units = [
        f"CASE WHEN {c} BETWEEN 1 AND 7 THEN (2.0::DOUBLE * ({c}::DOUBLE - 1.0::DOUBLE)) / 6.0::DOUBLE - 1.0::DOUBLE END"
        for c in columns
    ]
    total = " + ".join(f"coalesce({u}, 0.0::DOUBLE)" for u in units)
    known = " + ".join(f"(({u}) IS NOT NULL)::INTEGER" for u in units)
    return f"(({total}) / nullif({known}, 0))"


def _contradiction(limit: float) -> str:
    return f"coalesce({_mean(['q1', 'q2'])} * {_mean(['q3', 'q4'])} >= {limit}::DOUBLE, false)"


_RANGES = """ranges AS (
  SELECT 167772160 + n_nationkey::BIGINT * 131072 + 768 AS start_ip,
    167772160 + n_nationkey::BIGINT * 131072 + 768 + 66560 AS end_ip,
    n_nationkey * 1.5::DOUBLE AS lat, n_nationkey * -2.0::DOUBLE AS lon, n_name AS country,
    concat('STATE_', n_regionkey) AS state,
    CASE WHEN n_nationkey % 6 != 0 THEN concat('CITY_', n_nationkey) END AS city
  FROM nation)"""

_CORNERS = ", ".join(
    f"({ring}, {i}, {x}, {y}, {corners[(i + 1) % len(corners)][0]}, {corners[(i + 1) % len(corners)][1]})"
    for ring, corners in COUNTRY_RINGS.items()
    for i, (x, y) in enumerate(corners)
)
_EDGES = f"""edges AS (
  SELECT n_name AS name, 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS iso3, ring_id::INTEGER AS ring_id, edge::INTEGER AS edge,
    (n_nationkey % 5 * 70 - 175 + x1)::DOUBLE AS x1, (n_nationkey // 5 * 32 - 80 + y1)::DOUBLE AS y1,
    (n_nationkey % 5 * 70 - 175 + x2)::DOUBLE AS x2, (n_nationkey // 5 * 32 - 80 + y2)::DOUBLE AS y2
  FROM nation, (VALUES {_CORNERS}) AS c(ring_id, edge, x1, y1, x2, y2))"""

_LOCATED = """points AS (SELECT DISTINCT latitude AS lat, longitude AS lon FROM resp WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
inside AS (
  SELECT lat, lon, name FROM points, edges GROUP BY lat, lon, name
  HAVING count(*) FILTER (
      WHERE (y1 > lat) != (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / nullif(y2 - y1, 0) + x1) % 2 = 1
    AND NOT bool_or((x2 - x1) * (lat - y1) = (y2 - y1) * (lon - x1)
      AND lon BETWEEN least(x1, x2) AND greatest(x1, x2) AND lat BETWEEN least(y1, y2) AND greatest(y1, y2))),
located AS (SELECT lat, lon, min(name) AS name FROM inside GROUP BY lat, lon)"""


def _near(name: str, seconds: int, duration: float) -> str:
    return f"""{name} AS (
  SELECT a.response_id, count(*) - 1 AS n FROM resp a JOIN resp b
    ON b.t BETWEEN a.t - {seconds * 1_000_000} AND a.t + {seconds * 1_000_000}
    AND abs(b.duration - a.duration) <= {duration}::DOUBLE
  GROUP BY a.response_id)"""


_FLAGS = ["F_ShortDuration", "F_ManyAttempts", "F_SomeAttempts", "F_FailedAttempts", "F_Incomplete", "F_Burst",
          "F_Instructed", "F_Contradiction", "F_Both"]
_GROUPS = {
    "FG_Speed": ["F_ShortDuration", "F_Burst"],
    "FG_Network": ["F_ManyAttempts", "F_SomeAttempts", "F_FailedAttempts"],
    "FG_Incomplete": ["F_Incomplete"],
    "FG_Answers": ["F_Instructed", "F_Contradiction"],
}


def _active(names: list[str], condition: str) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {condition.format(n)} THEN '{n}' END" for n in names) + ")"


_FLAGGED = f"""{RESPONSES},
{_near("near", 120, 2.0)},
counted AS (
  SELECT resp.*, near.n AS "FF_Burst_count",
    count(success) OVER w AS num_attempts_successful,
    count(*) FILTER (WHERE success IS NULL AND terminate IS NOT NULL) OVER w AS num_attempts_failed
  FROM resp LEFT JOIN near USING (response_id) WINDOW w AS (PARTITION BY net)),
single AS (
  SELECT *, coalesce(duration <= 5, false) AS "F_ShortDuration",
    num_attempts_successful >= 10 AS "F_ManyAttempts",
    num_attempts_successful BETWEEN 8 AND 9 AS "F_SomeAttempts",
    num_attempts_failed >= 9 AS "F_FailedAttempts",
    coalesce(progress BETWEEN 0 AND 19, false) AS "F_Incomplete",
    coalesce("FF_Burst_count" > 0, false) AS "F_Burst",
    instructed IS NOT NULL AND instructed != 2 AS "F_Instructed",
    {_contradiction(0.25)} AS "F_Contradiction"
  FROM counted),
both_flags AS (SELECT *, "F_Instructed" AND "F_Contradiction" AS "F_Both" FROM single),
grouped AS (
  SELECT *, {", ".join('(' + " + ".join(f'"{f}"::INTEGER' for f in fs) + f')::INTEGER AS "{g}"' for g, fs in sorted(_GROUPS.items()))}
  FROM both_flags),
flagged AS (
  SELECT *, {_active(_FLAGS, '"{}"')} AS "ActiveFlags", {_active(list(_GROUPS), '"{}" > 0')} AS "ActiveFlagGroups"
  FROM grouped),
decided AS (
  SELECT *, CASE WHEN "FG_Incomplete" > 0 THEN '1' WHEN "FG_Speed" > 1 OR "FG_Network" > 1 THEN '2.1'
      WHEN "FG_Network" > 0 AND "FG_Answers" > 0 THEN '2.2' WHEN "FG_Speed" > 0 OR "F_Both" THEN '4'
      WHEN "FG_Network" != 0 THEN '5' END AS "AUTOMATED_FLAG_RULE"
  FROM flagged),
automated AS (
  SELECT *, CASE WHEN "AUTOMATED_FLAG_RULE" = '1' THEN 'INCOMPLETE' WHEN "AUTOMATED_FLAG_RULE" LIKE '2%' THEN 'FRAUD'
      WHEN "AUTOMATED_FLAG_RULE" IS NULL THEN 'VALID' ELSE 'TBD' END AS "AUTOMATED_FLAG"
  FROM decided)"""

_FINAL = f"""{_FLAGGED},
labelled AS (
  SELECT *, CASE WHEN response_id % 100 = 0 THEN 'FRAUD' WHEN response_id % 50 = 0 THEN 'VALID' END AS "MANUAL_FLAG",
    CASE WHEN response_id % 50 = 0 THEN concat('seen as ', event_type) END AS "MANUAL_COMMENT"
  FROM automated),
final_rules AS (
  SELECT *, CASE WHEN "AUTOMATED_FLAG" = 'INCOMPLETE' THEN '1.1'
      WHEN "AUTOMATED_FLAG" = 'FRAUD' AND "MANUAL_FLAG" IS DISTINCT FROM 'VALID' THEN '2.1'
      WHEN "MANUAL_FLAG" = 'FRAUD' THEN '2.2' ELSE '5' END AS "FINAL_FLAG_RULE"
  FROM labelled),
final AS (
  SELECT *, CASE WHEN "FINAL_FLAG_RULE" = '1.1' THEN 'INCOMPLETE' WHEN "FINAL_FLAG_RULE" = '5' THEN 'VALID'
      ELSE 'FRAUD' END AS "FINAL_FLAG"
  FROM final_rules)"""

_FLAG_OUTPUT = """response_id, "F_ShortDuration", num_attempts_successful, "F_ManyAttempts", "F_SomeAttempts",
  num_attempts_failed, "F_FailedAttempts", "F_Incomplete", "FF_Burst_count", "F_Burst", "F_Instructed",
  "F_Contradiction", "F_Both", "FG_Answers", "FG_Incomplete", "FG_Network", "FG_Speed", "ActiveFlags", "ActiveFlagGroups\""""

# Within a response

_CSV = """row_number() OVER (ORDER BY response_id) - 1 AS response_id, response_id AS event_id, duration, ip, success,
  terminate, progress, instructed"""
ORACLES["scan_responses"] = _with(RESPONSES) + f"SELECT {_CSV} FROM resp"
ORACLES["csv_roundtrip"] = "SELECT doc_id AS response_id, text FROM documents"
ORACLES["polygon_edges"] = _with(_EDGES) + "SELECT * FROM edges"


def _row(name: str, condition: str) -> None:
    ORACLES[name] = _with(RESPONSES) + f"SELECT response_id, coalesce({condition}, false) AS flag FROM resp"


_row("flag_value_in_range", "duration BETWEEN 20 AND 60.5")
_row("flag_value_at_most", "success <= 30")
_row("flag_custom_condition", "instructed IS DISTINCT FROM 2 AND progress < 50")
_row("flag_reverse_coded", _contradiction(0.1))
ORACLES["flag_suspicious_character"] = """
SELECT page_id AS response_id, contains(coalesce(html, ''), '%%%') OR contains(coalesce(html, ''), '***')
  OR contains(coalesce(html, ''), chr(160)) OR contains(coalesce(url, ''), '%%%') OR contains(coalesce(url, ''), '***')
  OR contains(coalesce(url, ''), chr(160)) AS flag
FROM pages"""
ORACLES["flag_suspicious_name"] = r"""
SELECT a.p_partkey AS response_id, coalesce(list_has_any(
    regexp_extract_all(lower(a.p_name), '[\p{L}\p{N}_]{4,}'),
    regexp_extract_all(lower(b.p_name), '[\p{L}\p{N}_]{4,}')), false) AS flag
FROM part a LEFT JOIN part b ON b.p_partkey = a.p_partkey + 1"""

# Across responses

_COUNTED = {
    "successful": "success IS NOT NULL",
    "unsuccessful": "success IS NULL",
    "incomplete": "success IS NULL AND terminate IS NULL",
    "failed": "success IS NULL AND terminate IS NOT NULL",
    "all": "true",
}
for _type, _condition in _COUNTED.items():
    ORACLES[f"attempts_{_type}"] = _with(RESPONSES) + f"""
SELECT response_id, num_attempts_{_type}, num_attempts_{_type} BETWEEN 5 AND 20 AS "F_Attempts" FROM (
  SELECT response_id, count(*) FILTER (WHERE {_condition}) OVER (PARTITION BY net) AS num_attempts_{_type} FROM resp)"""

ORACLES["burst_responses"] = _with(RESPONSES, _near("near", 60, 1.0)) + """
SELECT response_id, n AS "FF_Burst_count", n > 0 AS "F_Burst" FROM near"""
ORACLES["burst_responses_unflag"] = _with(RESPONSES, _near("outer_near", 3600, 5.0), _near("inner_near", 600, 2.5)) + """
SELECT response_id, o.n - i.n AS "FF_Burst_count", o.n - i.n > 0 AS "F_Burst"
FROM outer_near o JOIN inner_near i USING (response_id)"""

_TRIM = "'" + WHITE_SPACE + "'"
_CELLS = f"""cells AS (
  SELECT doc_id AS response_id, 'text' AS c, trim(lower(text), {_TRIM}) AS v FROM documents
  UNION ALL
  SELECT doc_id, 'headline', trim(lower(split_part(text, chr(10), 1)), {_TRIM}) FROM documents)"""


def _duplicates(partition: str, columns: str, where: str = "true", longest: int = 1_000_000_000) -> str:
    return _with(_CELLS) + f"""
SELECT response_id, {columns} FROM (
  SELECT response_id, c, coalesce(length(v) BETWEEN 20 AND {longest} AND count(*) OVER (PARTITION BY {partition}) > 1, false) AS dup
  FROM cells WHERE {where})
GROUP BY response_id"""


ORACLES["duplicated_text_column"] = _duplicates("v", 'bool_or(dup) AS "F_Duplicate"', "c = 'text'", 5000)
ORACLES["duplicated_text_column_flags"] = _duplicates(
    "c, v",
    """bool_or(dup) AS "F_Duplicate", bool_or(dup AND c = 'text') AS "F_Duplicate_text",
  bool_or(dup AND c = 'headline') AS "F_Duplicate_headline\"""",
)
ORACLES["duplicated_text_all"] = _duplicates("v", 'bool_or(dup) AS "F_Duplicate"')


def _ip_location(level: str, target: str, missing: str) -> str:
    return _with(RESPONSES, _RANGES) + f"""
SELECT response_id, lat AS "IPLatitude", lon AS "IPLongitude", country AS "IPCountry", state AS "IPState",
  city AS "IPCity", {level} AS "IPLocation", coalesce({level} != '{target}', {missing}) AS "F_IP"
FROM resp LEFT JOIN ranges ON ip_number BETWEEN start_ip AND end_ip"""


ORACLES["ip_location_country"] = _ip_location("country", "NATION_7", "false")
ORACLES["ip_location_state"] = _ip_location("state", "STATE_2", "false")
ORACLES["ip_location_city_missing"] = _ip_location("city", "CITY_7", "true")
ORACLES["latlong_country"] = _with(RESPONSES, _EDGES, _LOCATED) + "SELECT lat, lon, name FROM located"
for _name, _missing in (("flag_latlong_location", "false"), ("flag_latlong_location_missing", "true")):
    ORACLES[_name] = _with(RESPONSES, _EDGES, _LOCATED) + f"""
SELECT response_id, name AS "LatLongLocation", coalesce(name != 'NATION_7', {_missing}) AS "F_Place"
FROM resp LEFT JOIN located ON lat = latitude AND lon = longitude"""

# Flags together, labels and rules

_NESTED = """nested AS (
  SELECT start_ip, end_ip, lat, lon, country, state, city, 1 AS depth FROM ranges
  UNION ALL SELECT start_ip + 1000, start_ip + 20000, lat, lon, concat('IN_', country), state, city, 2 FROM ranges
  UNION ALL SELECT start_ip + 1500, start_ip + 1700, lat, lon, concat('DEEP_', country), state, city, 3 FROM ranges)"""
ORACLES["ip_location_nested"] = _with(RESPONSES, _RANGES, _NESTED) + """
SELECT response_id, lat AS "IPLatitude", lon AS "IPLongitude", country AS "IPCountry", state AS "IPState", city AS "IPCity"
FROM resp JOIN nested ON ip_number BETWEEN start_ip AND end_ip
QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY depth DESC) = 1"""

# A missing answer does not count for the span of the others.
ORACLES["flag_batches"] = _with(RESPONSES) + """
SELECT response_id, coalesce(q1 = q2, false) AS "F_Same",
  coalesce(greatest(q1, q2, q3, q4) - least(q1, q2, q3, q4) >= 6, false) AS "F_Apart",
  coalesce(duration >= 0 AND duration <= 5, false) AS "F_Short"
FROM resp"""

# Addresses without their first 32 bits, which all have in common, as numbers.
_NET = "1208925819614629174706176::HUGEINT"
ORACLES["ip_location_v6"] = f"""
WITH resp AS (
  SELECT event_id AS response_id, (user_id % 50) * {_NET} + (event_id % 8) * 65536 + event_id % 200 AS address FROM events),
ranges AS (
  SELECT n.*, n_nationkey * 2 * {_NET} + s AS start_ip, n_nationkey * 2 * {_NET} + e AS end_ip, name, depth
  FROM nation n, (VALUES
    (0::HUGEINT, {_NET} + 3 * 65536 + 65535, '', 1),
    (65536 + 16, 6 * 65536, 'IN_', 2),
    (2 * 65536, 2 * 65536 + 128, 'DEEP_', 3)) AS nested(s, e, name, depth))
SELECT response_id, n_nationkey * 1.5::DOUBLE AS "IPLatitude", n_nationkey * -2.0::DOUBLE AS "IPLongitude",
  concat(name, n_name) AS "IPCountry", concat('STATE_', n_regionkey) AS "IPState", NULL::VARCHAR AS "IPCity"
FROM resp JOIN ranges ON address BETWEEN start_ip AND end_ip
QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY depth DESC) = 1"""

ORACLES["flag_rerun"] = """
SELECT event_id AS response_id, value AS duration, coalesce(value <= 5, false) AS "F_Short", coalesce(value <= 5, false) AS "F_Same"
FROM events"""
# Texts of a flag have four or five letters, and only "false" is long enough to count as a repeated answer.
ORACLES["flag_on_earlier_column"] = """
WITH answers AS (SELECT doc_id, lower(trim(split_part(text, chr(10), 1), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS line FROM documents),
first AS (SELECT doc_id, coalesce(length(line) >= 5 AND count(*) OVER (PARTITION BY line) > 1, false) AS dup FROM answers)
SELECT doc_id AS response_id, dup AS "F_First", dup AS "F_Digit",
  NOT dup AND count(*) OVER (PARTITION BY dup) > 1 AS "F_Again"
FROM first"""
ORACLES["flag_overwritten_count"] = _with(RESPONSES) + """
SELECT response_id, count(success) OVER w >= 5 AS "F_One", count(success) OVER w >= 5 AS "F_Between",
  count(terminate) OVER w >= 5 AS "F_Two", count(terminate) OVER w AS num_attempts_successful
FROM resp WINDOW w AS (PARTITION BY net)"""
ORACLES["burst_text_times"] = f"""WITH {RESPONSES},
named AS (SELECT response_id, t // 1000000 * 1000000 AS t, duration FROM resp WHERE response_id % 11 != 0)
SELECT a.response_id, count(*) - 1 AS burst_count
FROM named a JOIN named b ON b.t BETWEEN a.t - 60000000 AND a.t + 60000000 AND abs(b.duration - a.duration) <= 1.0::DOUBLE
GROUP BY a.response_id"""
ORACLES["similar_members"] = """
SELECT min(p_partkey) OVER (PARTITION BY coalesce(p_name, '')) AS representative, p_partkey FROM part"""

ORACLES["flag_responses"] = _with(_FLAGGED) + f"SELECT {_FLAG_OUTPUT} FROM flagged"
ORACLES["scan_flagged"] = _with(_FLAGGED) + f"""SELECT {_FLAG_OUTPUT.replace('"ActiveFlags", "ActiveFlagGroups"', "")}
  nullif("ActiveFlags", '') AS "ActiveFlags", nullif("ActiveFlagGroups", '') AS "ActiveFlagGroups" FROM flagged"""
ORACLES["flag_group_counts"] = _with(_FLAGGED) + """
SELECT response_id, "FG_Answers", "FG_Incomplete", "FG_Network", "FG_Speed" FROM flagged"""
ORACLES["active_flags"] = _with(_FLAGGED) + 'SELECT response_id, "ActiveFlags" FROM flagged'
ORACLES["active_flag_groups"] = _with(_FLAGGED) + 'SELECT response_id, "ActiveFlagGroups" FROM flagged'
ORACLES["placeholder_columns"] = _with(RESPONSES) + """
SELECT response_id, progress, NULL::VARCHAR AS "MANUAL_FLAG", NULL::VARCHAR AS "MANUAL_COMMENT" FROM resp"""
ORACLES["merge_manual_labels"] = _with(_FINAL) + """
SELECT response_id, progress, "MANUAL_FLAG", "MANUAL_COMMENT" FROM labelled"""
ORACLES["classify_initial"] = ORACLES["checkpoint_roundtrip"] = _with(_FLAGGED) + """
SELECT response_id, "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE" FROM automated"""
ORACLES["classify_final"] = _with(_FINAL) + 'SELECT response_id, "FINAL_FLAG", "FINAL_FLAG_RULE" FROM final'
ORACLES["initial_classification"] = _with(_FLAGGED) + f"""
SELECT {_FLAG_OUTPUT}, duration, ip, success, terminate, progress, q1, q2, q3, q4, instructed, latitude, longitude,
  "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE", NULL::VARCHAR AS "MANUAL_FLAG", NULL::VARCHAR AS "MANUAL_COMMENT"
FROM automated"""
ORACLES["final_classification"] = _with(_FINAL) + """
SELECT response_id, "AUTOMATED_FLAG", "AUTOMATED_FLAG_RULE", "MANUAL_FLAG", "MANUAL_COMMENT", "FINAL_FLAG",
  "FINAL_FLAG_RULE" FROM final"""

# Reports


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _flag_counts(table: str = "automated") -> str:
    return _union([f"SELECT '{f}' AS flag, count(*) FILTER (WHERE \"{f}\")::BIGINT AS \"Count\" FROM {table}" for f in _FLAGS])


def _group_totals(table: str = "automated") -> str:
    return _union(
        [f"SELECT '{g}' AS flag_group, coalesce(sum(\"{g}\"), 0)::BIGINT AS \"Count\" FROM {table}" for g in _GROUPS]
    )


def _crosstab(table: str = "automated") -> str:
    rows = [(f, f'"{f}"') for f in _FLAGS] + [("Total", "true")]
    return _union(
        [
            f"SELECT '{name}' AS flag, "
            + ", ".join(f'count(*) FILTER (WHERE {on} AND "{g}" > 0)::BIGINT AS "{g}"' for g in _GROUPS)
            + (", NULL::BIGINT" if name == "Total" else f", count(*) FILTER (WHERE {on})::BIGINT")
            + f' AS "Total" FROM {table}'
            for name, on in rows
        ]
    )


def _class_counts(column: str, table: str) -> str:
    return f"""SELECT "{column}" AS label, count(*)::BIGINT AS "Count" FROM {table} WHERE "{column}" IS NOT NULL GROUP BY 1"""


def _any_flag(table: str = "automated") -> str:
    on = " OR ".join(f'"{f}"' for f in _FLAGS)
    return f"SELECT count(*) FILTER (WHERE {on})::BIGINT AS flagged, count(*)::BIGINT AS responses FROM {table}"


_PREFIXES = {"AUTOMATED_FLAG": "(auto) ", "MANUAL_FLAG": "(manual) ", "FINAL_FLAG": "(final) "}


def _labels(use_groups: bool, classes: list[str], table: str) -> str:
    names = [(g, f'"{g}" > 0') for g in _GROUPS] if use_groups else [(f, f'"{f}"') for f in _FLAGS]
    parts = [f"SELECT response_id, '{n}' AS label FROM {table} WHERE {on}" for n, on in names]
    parts += [
        f"SELECT response_id, '{_PREFIXES[c]}' || \"{c}\" AS label FROM {table} WHERE \"{c}\" IS NOT NULL" for c in classes
    ]
    return _union(parts)


def _cooccurrence(use_groups: bool, classes: list[str], table: str = "automated") -> str:
    labels = _labels(use_groups, classes, table)
    return f"""SELECT a.label AS label_a, b.label AS label_b, count(*)::BIGINT AS n
FROM ({labels}) a JOIN ({labels}) b USING (response_id) GROUP BY 1, 2"""


_ALL_CLASSES = list(_PREFIXES)
ORACLES["flag_counts"] = _with(_FLAGGED) + _flag_counts()
ORACLES["flag_group_totals"] = _with(_FLAGGED) + _group_totals()
ORACLES["any_flag_count"] = _with(_FLAGGED) + _any_flag()
ORACLES["flag_group_crosstab"] = _with(_FLAGGED) + _crosstab()
ORACLES["classification_counts"] = _with(_FLAGGED) + _class_counts("AUTOMATED_FLAG", "automated")
ORACLES["cooccurrence_flags"] = _with(_FLAGGED) + _cooccurrence(False, ["AUTOMATED_FLAG"])
ORACLES["cooccurrence_groups"] = _with(_FLAGGED) + _cooccurrence(True, ["AUTOMATED_FLAG"])
_NAMED = _union([f"SELECT '{g}' AS label" for g in _GROUPS])
ORACLES["cooccurrence_matrix"] = _with(
    _FINAL,
    f"on_labels AS ({_labels(True, _ALL_CLASSES, 'final')})",
    f"names AS (SELECT DISTINCT label FROM (SELECT label FROM on_labels UNION ALL {_NAMED}))",
) + """
SELECT x.label AS label_a, y.label AS label_b, count(b.label)::BIGINT AS n
FROM names x CROSS JOIN names y LEFT JOIN on_labels a ON a.label = x.label
LEFT JOIN on_labels b ON b.response_id = a.response_id AND b.label = y.label GROUP BY 1, 2"""


def _as_rows(report: str, sql: str, label: str, columns: list[str]) -> str:
    return _union(
        [
            f"SELECT '{report}' AS report, {label} AS row_label, '{c}' AS column_label, \"{c}\"::BIGINT AS n FROM ({sql})"
            for c in columns
        ]
    )


_COUNT = ["Count"]
_FLAG_ROWS = _as_rows("02_flags", _flag_counts(), "flag", _COUNT)
_CLASS_ROWS = _as_rows("02_AUTOMATED_FLAG", _class_counts("AUTOMATED_FLAG", "automated"), "label", _COUNT)
ORACLES["descriptives_roundtrip"] = _with(_FLAGGED) + _union([_CLASS_ROWS, _FLAG_ROWS])


def _pair_rows(report: str, use_groups: bool, classes: list[str], table: str) -> str:
    sql = _cooccurrence(use_groups, classes, table)
    return f"SELECT '{report}' AS report, label_a AS row_label, label_b AS column_label, n FROM ({sql})"


ORACLES["initial_descriptives"] = _with(_FLAGGED) + _union(
    [
        _as_rows("02_filters", _crosstab(), "flag", [*_GROUPS, "Total"]),
        _as_rows("02_any_flag", _any_flag(), "'all'", ["flagged", "responses"]),
        _FLAG_ROWS,
        _as_rows("02_groups", _group_totals(), "flag_group", _COUNT),
        _CLASS_ROWS,
        _pair_rows("02_cooccurrence_flags", False, ["AUTOMATED_FLAG"], "automated"),
        _pair_rows("02_cooccurrence_groups", True, ["AUTOMATED_FLAG"], "automated"),
    ]
)
ORACLES["final_descriptives"] = _with(_FINAL) + _union(
    [
        *[_as_rows(f"05_{c}", _class_counts(c, "final"), "label", _COUNT) for c in _ALL_CLASSES],
        _pair_rows("05_cooccurrence_flags", False, _ALL_CLASSES, "final"),
        _pair_rows("05_cooccurrence_groups", True, _ALL_CLASSES, "final"),
    ]
)

# Similar texts: the LCS of short names bit by bit, one recursion step per character


def _texts(form: str, min_length: int) -> str:
    return f"""texts AS (
  SELECT p_name, min(p_partkey) AS first_id, max(p_partkey) AS last_id, count(*) AS copies,
    length(trim(p_name)) >= {min_length} AS long, {form} AS form
  FROM part GROUP BY p_name)"""


_SORTED = "array_to_string(list_sort(string_split_regex(trim(p_name), ' +')), ' ')"


def _scored(threshold: int) -> str:
    return f"""lcs AS (
  SELECT a.first_id AS id_i, b.first_id AS id_j, a.form AS a, b.form AS b, a.copies AS copies_i, b.copies AS copies_j,
    0 AS step, (1::BIGINT << length(a.form)) - 1 AS v
  FROM texts a JOIN texts b ON a.first_id < b.first_id AND (a.long OR b.long)
  UNION ALL
  SELECT id_i, id_j, a, b, copies_i, copies_j, step + 1,
    ((v + (v & m)) | (v - (v & m))) & ((1::BIGINT << length(a)) - 1)
  FROM (
    SELECT *, list_sum([CASE WHEN a[k] = b[step + 1] THEN 1::BIGINT << (k - 1) ELSE 0 END
      FOR k IN range(1, length(a) + 1)])::BIGINT AS m
    FROM lcs WHERE step < length(b))),
matches AS (
  SELECT * FROM (
    SELECT id_i, id_j, floor((1 - (length(a) + length(b) - 2 * (length(a) - bit_count(v)))::DOUBLE
      / (length(a) + length(b))) * 100)::INTEGER AS score, copies_i, copies_j
    FROM lcs WHERE step = length(b))
  WHERE score >= {threshold})"""


_PAIRS = """
SELECT id_i, id_j, score, copies_i, copies_j FROM matches
UNION ALL SELECT first_id, first_id, 100, copies, copies FROM texts WHERE copies > 1 AND long"""
ORACLES["similar_pairs"] = _with(_texts(_SORTED, 7), _scored(65)) + _PAIRS
ORACLES["similar_pairs_ratio"] = _with(_texts("p_name", 3), _scored(70)) + _PAIRS


# Token sets: the texts are what each name has of its own, beside the shared tokens.
_TOKENS = "list_distinct(string_split_regex(trim({}.p_name), ' +'))"
_TOKEN_SETS = f"""texts AS (
  SELECT p_name, min(p_partkey) AS first_id, count(*) AS copies, length(trim(p_name)) >= 7 AS long
  FROM part GROUP BY p_name),
sets AS (
  SELECT a.first_id AS id_i, b.first_id AS id_j, a.copies AS copies_i, b.copies AS copies_j,
    {_TOKENS.format('a')} AS ta, {_TOKENS.format('b')} AS tb
  FROM texts a JOIN texts b ON a.first_id < b.first_id AND (a.long OR b.long)),
parts AS (
  SELECT *, list_intersect(ta, tb) AS shared,
    array_to_string(list_sort([x FOR x IN ta IF NOT list_contains(tb, x)]), ' ') AS a,
    array_to_string(list_sort([x FOR x IN tb IF NOT list_contains(ta, x)]), ' ') AS b
  FROM sets),
lcs AS (
  SELECT id_i, id_j, copies_i, copies_j, a, b, length(array_to_string(shared, ' ')) AS s,
    (len(shared) > 0)::INTEGER AS j, 0 AS step, (1::BIGINT << length(a)) - 1 AS v FROM parts
  UNION ALL
  SELECT id_i, id_j, copies_i, copies_j, a, b, s, j, step + 1,
    ((v + (v & m)) | (v - (v & m))) & ((1::BIGINT << length(a)) - 1)
  FROM (
    SELECT *, coalesce(list_sum([CASE WHEN a[k] = b[step + 1] THEN 1::BIGINT << (k - 1) ELSE 0 END
      FOR k IN range(1, length(a) + 1)]), 0)::BIGINT AS m
    FROM lcs WHERE step < length(b))),
lengths AS (
  SELECT *, s + j + length(a) AS la, s + j + length(b) AS lb,
    length(a) + length(b) - 2 * (length(a) - bit_count(v)) AS edits
  FROM lcs WHERE step = length(b)),
matches AS (
  SELECT id_i, id_j, copies_i, copies_j, floor(CASE WHEN j = 1 AND (a = '' OR b = '') THEN 100.0::DOUBLE
      ELSE greatest(100 - 100 * edits::DOUBLE / (la + lb),
        CASE WHEN j = 1 THEN 100 - 100 * (j + length(a))::DOUBLE / (s + la) ELSE 0 END,
        CASE WHEN j = 1 THEN 100 - 100 * (j + length(b))::DOUBLE / (s + lb) ELSE 0 END) END)::INTEGER AS score
  FROM lengths)"""
ORACLES["similar_pairs_token_set"] = _with(_TOKEN_SETS) + """
SELECT id_i, id_j, score, copies_i, copies_j FROM matches WHERE score >= 80
UNION ALL SELECT first_id, first_id, 100, copies, copies FROM texts WHERE copies > 1 AND long"""


def _answers(threshold: int) -> str:
    return _with(
        _texts(_SORTED, 7),
        _scored(threshold),
        """sides AS (
  SELECT id_i AS first_id, id_j AS other, score, copies_j AS n FROM matches
  UNION ALL SELECT id_j, id_i, score, copies_i FROM matches),
listed AS (
  SELECT p_partkey, part.p_name, other, score, o.p_name AS shown, n
  FROM part JOIN texts USING (p_name) JOIN sides USING (first_id) JOIN texts o ON o.first_id = other
  UNION ALL
  SELECT p_partkey, part.p_name, CASE WHEN p_partkey = first_id THEN last_id ELSE first_id END, 100, part.p_name, copies - 1
  FROM part JOIN texts USING (p_name) WHERE copies > 1 AND long),
found AS (
  SELECT p_partkey, sum(n)::BIGINT AS n, string_agg(
    other || '. (' || score || ') "' || shown || '"' || CASE WHEN n > 1 THEN ' x' || n ELSE '' END, '; ' ORDER BY other) AS similar_list
  FROM listed GROUP BY p_partkey)""",
    )


ORACLES["similar_counts"] = _answers(65) + 'SELECT p_partkey, n AS "FZ_COUNT_p_name" FROM found'
ORACLES["similar_texts"] = _answers(75) + 'SELECT p_partkey, similar_list AS "FZ_SIMILAR_p_name" FROM found'
ORACLES["flag_similar_text"] = _answers(90) + """
SELECT p_partkey, coalesce(n, 0) AS "FZ_COUNT_p_name", n IS NOT NULL AS "F_Similar" FROM part LEFT JOIN found USING (p_partkey)"""
ORACLES["mark_similar"] = _answers(65) + """
SELECT p_partkey, p_name, coalesce(n, 0) AS "FZ_COUNT_p_name", similar_list AS "FZ_SIMILAR_p_name"
FROM part LEFT JOIN found USING (p_partkey)"""
