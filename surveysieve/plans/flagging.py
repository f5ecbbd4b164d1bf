"""All flags of a configuration in one plan."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveysieve.config import Config, Flag
from surveysieve.functions.columns import col_, require_columns
from surveysieve.plans.registry import ACROSS_RESPONSES, Setting, flag_columns
from surveysieve.sources.sinks import stage_table


def apply_flags(
    df: DataFrame, flags: Iterable[Flag], key: str, lookups: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The responses with the columns of every flag, in configuration order.

    Each flag sees the responses as they stand at its turn: columns of earlier
    flags are there, and one that is written again has its new value from then
    on. A column that several flags write keeps the place of the first.

    Checks across responses work on narrow tables and return one row per key.
    These are joined one after the other on the key, so the wide table is
    shuffled once. If several such checks read the input, the columns they name
    are staged once. A key that is missing or repeated is refused.
    """
    require_columns(df, [key], "responses")
    flags = list(flags)
    narrow = _Narrow(df, key, flags)
    current, joined = df, set()
    versions: dict[str, int] = {}
    for flag in flags:
        setting = Setting(current, key, flag.flag_name, lookups or {}, flags, narrow, dict(versions))
        result = flag_columns(setting, flag.method_name, flag.parameters)
        if result.features_id and result.features_id not in joined:
            narrow.require_unique_key()
            current = current.join(result.features(), key, "left")
            joined.add(result.features_id)
        made = dict(result.columns)
        kept = [col_(c) for c in current.columns if c not in made]
        current = current.select(*kept, *[column.alias(name) for name, column in made.items()])
        versions.update((name, versions.get(name, 0) + 1) for name in made)
    return current.select(*[col_(c) for c in df.columns if c not in versions], *map(col_, versions))


class _Narrow:
    """The input's columns that flags name, staged if several checks across responses read them."""

    def __init__(self, df: DataFrame, key: str, flags: list[Flag]):
        self._df, self._key = df, key
        across = [flag for flag in flags if flag.method_name in ACROSS_RESPONSES]
        named = {name for flag in across for name in _texts(flag.parameters.values())}
        self._columns = [c for c in df.columns if c in named and c != key] if len(across) > 1 else []
        self._staged: DataFrame | None = None
        self._checked = False

    def __call__(self, columns: Iterable[str]) -> DataFrame:
        wanted = list(dict.fromkeys(columns))
        if not self._columns or not set(wanted) <= {self._key, *self._columns}:
            return self._df.select(*[col_(c) for c in dict.fromkeys([self._key, *wanted])])
        if self._staged is None:
            self._staged = stage_table(self._df.select(*[col_(c) for c in [self._key, *self._columns]]), "responses")
        return self._staged.select(*[col_(c) for c in dict.fromkeys([self._key, *wanted])])

    def require_unique_key(self) -> None:
        if not self._checked:
            counts = self([self._key]).groupBy(col_(self._key).alias("key")).agg(F.count("*").alias("n"))
            refused = counts.where("n > 1 OR key IS NULL").take(5)
            if refused:
                raise ValueError(f"responses: the key '{self._key}' is missing or repeated: {[row.key for row in refused]}")
            self._checked = True


def _texts(values: Iterable[object]) -> Iterator[str]:
    for value in values:
        if isinstance(value, str):
            yield value
        elif isinstance(value, (list, tuple)):
            yield from _texts(value)


def group_counts(config: Config) -> dict[str, Column]:
    """Active flags per group, groups in byte order."""
    return {
        group: sum((col_(f).cast("int") for f in config.flags_of(group)), start=F.lit(0))
        for group in sorted(config.group_names)
    }


def active_names(names: Iterable[str], active: Iterable[Column]) -> Column:
    """Names whose column is true, joined by '; '."""
    shown = [F.when(condition, F.lit(name)) for name, condition in zip(names, active, strict=True)]
    if not shown:
        return F.lit("")
    return F.array_join(F.array_compact(F.array(*shown)), "; ")


def flag_responses(
    df: DataFrame,
    config: Config,
    key: str,
    lookups: Mapping[str, DataFrame] | None = None,
    add_string: bool = True,
) -> DataFrame:
    """Flags, flag counts per group, and the names of active flags and groups."""
    flagged = apply_flags(df, config.flags, key, lookups)
    groups = group_counts(config)
    grouped = flagged.select("*", *[column.alias(name) for name, column in groups.items()])
    if not add_string:
        return grouped
    flags, in_order = config.flag_names, config.group_names
    return grouped.select(
        "*",
        active_names(flags, [col_(f) for f in flags]).alias("ActiveFlags"),
        active_names(in_order, [col_(g) > 0 for g in in_order]).alias("ActiveFlagGroups"),
    )
