"""Projection and code decoding for the consumption layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from faremill.contracts import GOLD_COLUMNS, YELLOW_TRIPS, CodeMap
from faremill.functions.labels import decode

TRIP_CODES = YELLOW_TRIPS.code_maps


def project(df: DataFrame, columns: Sequence[str] = GOLD_COLUMNS) -> DataFrame:
    return df.select(*columns)


def preview(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """The first `n` rows by a key, the same on every run; no full sort takes place."""
    return df.orderBy(*by).limit(n)


def decode_codes(df: DataFrame, code_maps: Sequence[CodeMap] = TRIP_CODES) -> DataFrame:
    """Add the description column of every code map, all in one projection."""
    return df.withColumns({m.desc_col: decode(m) for m in code_maps})
