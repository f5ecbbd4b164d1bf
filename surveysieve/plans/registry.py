"""Flag methods by name, and how to add one's own."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveysieve.config import Flag
from surveysieve.functions.columns import col_, flag, is_bound, require_columns, truth
from surveysieve.operators import attempts, bursts, duplicates, geo_location, ip_location, row_flags, similarity


@dataclass(frozen=True)
class Setting:
    """What a method may use: the responses as they stand, their key, the flag's name, lookup tables, all flags.

    ``narrow`` gives columns of the input with the key, ``versions`` counts how often
    earlier flags have written a column.
    """

    df: DataFrame
    key: str
    flag_name: str
    lookups: Mapping[str, DataFrame] = field(default_factory=dict)
    flags: Sequence[Flag] = ()
    narrow: Callable[[Sequence[str]], DataFrame] | None = None
    versions: Mapping[str, int] = field(default_factory=dict)

    def rows(self, *columns: str) -> DataFrame:
        """Key and columns as they stand: from the input, unless an earlier flag wrote one of them."""
        if self.narrow is not None and not any(self.versions.get(c) for c in columns):
            return self.narrow(columns)
        return self.df.select(*[col_(c) for c in dict.fromkeys([self.key, *columns])])

    def identity(self, kind: str, columns: Sequence[str], *parts: Any) -> str:
        """Equal for methods that make the same table of the same state of the columns."""
        state = [(c, self.versions.get(c, 0)) for c in columns]
        return f"__{kind}_" + hashlib.sha256(json.dumps([kind, state, *parts], default=str).encode()).hexdigest()[:12]

    def lookup(self, name: str) -> DataFrame:
        if name not in self.lookups:
            raise KeyError(f"flag '{self.flag_name}' needs the lookup table '{name}'")
        return self.lookups[name]


@dataclass(frozen=True)
class Columns:
    """Columns a method adds, in order; the flag is among them.

    ``features`` makes a table with one row per response key at most, left joined
    before the columns are computed. Methods with equal ``features_id`` share it.
    """

    columns: Sequence[tuple[str, Column]]
    features_id: str | None = None
    features: Callable[[], DataFrame] | None = None


Method = Callable[..., Columns]
_METHODS: dict[str, Method] = {}


def register_flag(name: str, method: Callable[..., Column | Columns]) -> None:
    """Make ``method(setting, **parameters)`` available to configurations.

    It returns the Boolean column of the flag, or ``Columns``.
    """
    _METHODS[name] = method


def register_batch_flag(name: str, method: Callable[..., pa.Array | Sequence[bool | None]]) -> None:
    """Make ``method(batch, **parameters)`` available to configurations, which name the ``columns`` of its batches.

    It gets Arrow batches of these columns and returns whether each row is flagged. Flags of
    this kind that stand beside each other share one pass through Python.
    """

    def made(setting: Setting, columns: Sequence[str], **parameters: Any) -> Column:
        what = f"flag '{setting.flag_name}'"
        columns = [columns] if isinstance(columns, str) else list(columns)
        require_columns(setting.df, columns, what)
        try:
            inspect.signature(method).bind(None, **parameters)
        except TypeError as error:
            raise ValueError(f"{what}, method '{name}': {error}") from None

        def flagged(rows: pa.Array) -> pa.Array:
            found = method(pa.RecordBatch.from_struct_array(rows), **parameters)
            return found if isinstance(found, pa.Array) else pa.array(found, pa.bool_())

        return F.arrow_udf(flagged, "boolean")(F.struct(*map(col_, columns)))

    _METHODS[name] = made


def flag_columns(setting: Setting, method_name: str, parameters: Mapping[str, Any]) -> Columns:
    if method_name not in _METHODS:
        raise ValueError(f"flag '{setting.flag_name}': unknown method '{method_name}'")
    method = _METHODS[method_name]
    try:
        inspect.signature(method).bind(setting, **parameters)
    except TypeError as error:
        raise ValueError(f"flag '{setting.flag_name}', method '{method_name}': {error}") from None
    made = method(setting, **parameters)
    return made if isinstance(made, Columns) else Columns([(setting.flag_name, flag(made))])


def _value_in_range(setting, column_name, lower_threshold, upper_threshold):
    return row_flags.value_in_range(column_name, lower_threshold, upper_threshold)


def _custom_condition(setting, condition):
    return truth(setting.df, condition, f"flag '{setting.flag_name}'")


def _reverse_coded(setting, positive_columns, negative_columns, min_score, max_score, max_correlation=0):
    return row_flags.reverse_coded(positive_columns, negative_columns, min_score, max_score, max_correlation)


def _suspicious_character(setting, list_of_columns, list_of_chars=(row_flags.NON_BREAKING_SPACE,)):
    return row_flags.suspicious_character(setting.df.columns, list_of_columns, list_of_chars)


def _suspicious_name(setting, column_first_name, column_last_name, min_word_length=2):
    return row_flags.suspicious_name(column_first_name, column_last_name, min_word_length)


def _ip_location(setting, column_ip, target_region, flag_missing, region_level="country", no_address="missing"):
    if region_level not in ip_location.REGION_LEVELS:
        raise ValueError(f"region_level must be one of {sorted(ip_location.REGION_LEVELS)}, not '{region_level}'")
    require_columns(setting.df, [column_ip], f"flag '{setting.flag_name}'")
    identity = setting.identity("ip", [column_ip], no_address)
    region = ip_location.REGION_LEVELS[region_level]

    def features():
        ranges = setting.lookup("ip_ranges")
        places = ip_location.ip_places(setting.rows(column_ip), setting.key, column_ip, ranges, no_address=no_address)
        return places.select(setting.key, F.struct(*ip_location.PLACE).alias(identity))

    place = {name: F.col(identity)[name] for name in ip_location.PLACE}
    return Columns(
        [
            *place.items(),
            ("IPLocation", place[region]),
            (setting.flag_name, row_flags.outside_region(place[region], target_region, flag_missing)),
        ],
        identity,
        features,
    )


def _latlong_location(setting, column_latitude, column_longitude, target_country, flag_missing):
    require_columns(setting.df, [column_latitude, column_longitude], f"flag '{setting.flag_name}'")
    identity = setting.identity("country", [column_latitude, column_longitude])

    def features():
        polygons = setting.lookup("polygons")
        rows = setting.rows(column_latitude, column_longitude)
        return geo_location.countries(rows, setting.key, column_latitude, column_longitude, polygons, name=identity)

    country = F.col(identity)
    return Columns(
        [
            ("LatLongLocation", country),
            (setting.flag_name, row_flags.outside_region(country, target_country, flag_missing)),
        ],
        identity,
        features,
    )


def _multiple_attempts(
    setting,
    column_ip,
    column_success,
    num_attempts_lower,
    num_attempts_upper=float("inf"),
    attempt_type="successful",
    column_terminate=None,
):
    used = [column_ip, column_success, *([column_terminate] if column_terminate is not None else [])]
    require_columns(setting.df, used, f"flag '{setting.flag_name}'")
    types, terminate = _attempts_together(setting, column_ip, column_success, attempt_type, column_terminate)
    read = [column_ip, column_success, *([terminate] if terminate is not None else [])]
    identity = setting.identity("attempts", read, types)

    def features():
        counts = attempts.attempt_counts(setting.rows(*read), setting.key, column_ip, column_success, types, terminate)
        return counts.select(setting.key, F.struct(*types).alias(identity))

    number = F.col(identity)[attempt_type]
    enough = number >= F.lit(num_attempts_lower)
    if is_bound(num_attempts_upper, float("inf")):
        enough = enough & (number <= F.lit(num_attempts_upper))
    return Columns(
        [(f"num_attempts_{attempt_type}", number), (setting.flag_name, flag(enough))],
        identity,
        features,
    )


def _attempts_together(setting, column_ip, column_success, attempt_type, column_terminate):
    """Types and terminate column of all attempt flags that count in the same networks, for one aggregate.

    Each flag must be complete by itself: a type that depends on the terminate
    column is not counted by that of another flag.
    """
    if column_terminate is None and attempt_type in attempts.NEED_TERMINATE:
        raise ValueError(f"flag '{setting.flag_name}': attempt_type '{attempt_type}' needs column_terminate")
    alike = [
        f.parameters
        for f in setting.flags
        if f.method_name == "check_MultipleIPAttempts"
        and (f.parameters.get("column_ip"), f.parameters.get("column_success")) == (column_ip, column_success)
    ]
    stops = {p.get("column_terminate") for p in alike} - {None}
    terminate = column_terminate
    if terminate is None and len(stops) == 1 and stops <= set(setting.df.columns):
        # Counts that need no terminate column can join those with one.
        (terminate,) = stops
    types = {attempt_type}
    for parameters in alike:
        other = parameters.get("attempt_type", "successful")
        stop = parameters.get("column_terminate")
        if other in attempts.ATTEMPT_TYPES and (stop == terminate or (stop is None and other not in attempts.NEED_TERMINATE)):
            types.add(other)
    return sorted(types), terminate


def _burst_responses(
    setting,
    column_start_time,
    column_duration,
    max_start_time_difference,
    max_duration_difference,
    unflag_start_time_difference=None,
    unflag_duration_difference=None,
    start_time_format=None,
):
    require_columns(setting.df, [column_start_time, column_duration], f"flag '{setting.flag_name}'")
    radii = (
        max_start_time_difference,
        max_duration_difference,
        unflag_start_time_difference,
        unflag_duration_difference,
    )
    identity = setting.identity("bursts", [column_start_time, column_duration], *radii, start_time_format)

    def features():
        return bursts.burst_counts(
            setting.rows(column_start_time, column_duration), setting.key, column_start_time, column_duration, *radii,
            name=identity, start_time_format=start_time_format,
        )

    number = F.col(identity)
    return Columns(
        [(f"F{setting.flag_name}_count", number), (setting.flag_name, flag(number > 0))], identity, features
    )


def _duplicated_text(
    setting, list_of_columns, min_length, max_length, search_strategy="column", create_column_flag=False
):
    columns = [list_of_columns] if isinstance(list_of_columns, str) else list(list_of_columns)
    require_columns(setting.df, columns, f"flag '{setting.flag_name}'")
    identity = setting.identity("duplicates", columns, min_length, max_length, search_strategy)
    names = [f"{identity}_{i}" for i in range(len(columns))]

    def features():
        return duplicates.duplicated_text(
            setting.rows(*columns), setting.key, columns, min_length, max_length, search_strategy, names
        )

    made = [(setting.flag_name, duplicates.any_duplicate(names))]
    if create_column_flag and len(columns) > 1 and search_strategy == "column":
        made += [(f"{setting.flag_name}_{c}", flag(col_(n))) for c, n in zip(columns, names, strict=True)]
    return Columns(made, identity, features)


def _similar_text(
    setting,
    column_name,
    min_length=similarity.MIN_LENGTH,
    fuzz_func=similarity.SCORER,
    threshold=similarity.THRESHOLD,
):
    require_columns(setting.df, [column_name], f"flag '{setting.flag_name}'")
    identity = setting.identity("similar", [column_name], min_length, fuzz_func, threshold)

    def features():
        return similarity.similar_answers(
            setting.rows(column_name), setting.key, column_name, min_length, fuzz_func, threshold,
            count_name=identity, list_name=None,
        )

    number = F.coalesce(F.col(identity), F.lit(0).cast("long"))
    return Columns([(f"FZ_COUNT_{column_name}", number), (setting.flag_name, number > 0)], identity, features)


# Methods whose tables are read from the responses' columns that their parameters name.
ACROSS_RESPONSES = frozenset(
    {
        "check_IPLocation",
        "check_LatLongLocation",
        "check_MultipleIPAttempts",
        "check_BurstResponses",
        "check_DuplicatedText",
        "check_SimilarText",
    }
)

# The method names configurations use.
register_flag("check_ValueInRange", _value_in_range)
register_flag("check_CustomCondition", _custom_condition)
register_flag("check_ReverseCodedResponse", _reverse_coded)
register_flag("check_SuspiciousCharacter", _suspicious_character)
register_flag("check_SuspiciousName", _suspicious_name)
register_flag("check_IPLocation", _ip_location)
register_flag("check_LatLongLocation", _latlong_location)
register_flag("check_MultipleIPAttempts", _multiple_attempts)
register_flag("check_BurstResponses", _burst_responses)
register_flag("check_DuplicatedText", _duplicated_text)
register_flag("check_SimilarText", _similar_text)
