"""Scalar expressions: code decoding, labels and percentages. All are built-in Spark functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from faremill.contracts import MONTH_LABELS, CodeMap
from faremill.functions.text import sql_text

# --- fixed values: parts of the day, as (first hour, label) ---
DAYPARTS = (
    (0, "Madrugada (00–04)"),
    (5, "Manhã cedo (05–07)"),
    (8, "Dia e tarde (08–23)"),
)
# --- end of fixed values ---


def _case(value: str, texts: Mapping[int, str], otherwise: str = "NULL") -> Column:
    """`CASE value WHEN … END`, parsed in one go rather than built arm by arm."""
    arms = " ".join(f"WHEN {k} THEN {sql_text(v)}" for k, v in texts.items())
    return F.expr(f"CASE {value} {arms} ELSE {otherwise} END")


def decode(codes: CodeMap, numbered: bool = False) -> Column:
    """Description of a code; unknown codes get the fallback text, NULL stays NULL.

    With `numbered`, known codes read "4 - Dispute" instead of "Dispute".
    """
    texts = {k: f"{k} - {v}" if numbered else v for k, v in codes.entries.items()}
    code = f"`{codes.code_col}`"
    return _case(code, texts, otherwise=f"concat({sql_text(codes.unknown_prefix)}, CAST({code} AS STRING))")


def month_label(month: str) -> Column:
    """Short name of the month in column `month`; months without a label give NULL."""
    return _case(f"`{month}`", MONTH_LABELS)


def money_label(amount: Column, digits: int, suffix: str = "") -> Column:
    """Dollar text such as `$90.2M`; the number isn't padded with zeros."""
    return F.concat(F.lit("$"), F.round(amount, digits).cast("string"), F.lit(suffix))


def period_text(year: Column, month: Column, sep: str = "-") -> Column:
    return F.concat(year.cast("string"), F.lit(sep), F.lpad(month.cast("string"), 2, "0"))


def hour_label(hour: int) -> str:
    return f"{hour:02d}h"


def daypart(hour: Column) -> Column:
    """Part of the day an hour belongs to."""
    (start, text), *earlier = sorted(DAYPARTS, reverse=True)
    part = F.when(hour >= start, text)
    for start, text in earlier:
        part = part.when(hour >= start, text)
    return part


def share(part: Column, whole: Column, digits: int) -> Column:
    """Rounded percentage; NULL when the whole is zero."""
    return F.round(F.try_divide(part, whole) * 100, digits)
