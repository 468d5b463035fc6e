"""Bronze strings to typed, deduplicated Silver rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.parsing import PARSERS
from ledgerlark.operators.newest import newest_per_key
from ledgerlark.schemas import SILVER, SILVER_RULES


def typed(bronze: DataFrame, table: str) -> DataFrame:
    """Bronze columns parsed to the Silver types, row by row."""
    return bronze.select(
        *[
            PARSERS[f.dataType.simpleString()](F.col(f.name)).alias(f.name)
            for f in SILVER[table].fields
            if f.name in bronze.columns
        ]
    )


def deciding(table: str, columns: Iterable[str]) -> list[str]:
    """Silver columns that decide the values of ``columns``: the key, and the order of versions up to
    the last one needed. Versions that are equal up to there have the same values."""
    rule, names = SILVER_RULES[table], SILVER[table].names
    order = [*rule.newest, *[c for c in names if c != rule.key and c not in rule.newest]]
    needed = {*columns, *rule.valid}
    last = max((i for i, c in enumerate(order) if c in needed), default=-1)
    return [c for c in names if c == rule.key or c in order[: last + 1]]


def to_silver(bronze: DataFrame, table: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Parse, drop null keys, keep the newest version, then drop invalid versions.

    Validity comes last: when the newest version of a key is malformed the key drops
    out, an older valid version does not take its place. With ``columns`` only these are
    worked out, the same values as without, and what cannot change them is not parsed.
    """
    rule = SILVER_RULES[table]
    with_keys = bronze
    for column in rule.required:
        with_keys = with_keys.where(F.col(column).isNotNull())
    if columns is not None:
        with_keys = with_keys.select(*deciding(table, columns))
    latest = newest_per_key(typed(with_keys, table), rule.key, rule.newest)
    for column in rule.valid:
        latest = latest.where(F.col(column).isNotNull())
    return latest if columns is None else latest.select(*columns)


def all_silver(
    bronze: dict[str, DataFrame], columns: Mapping[str, Iterable[str]] | None = None
) -> dict[str, DataFrame]:
    return {table: to_silver(bronze[table], table, columns and columns[table]) for table in SILVER}
