"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(name: str) -> Column:
    """Column reference that is safe for dotted names (``metadata.json.startDate``).

    Flattened JSON fields arrive as top-level columns whose names contain
    dots; ``F.col`` would read them as struct access without back-ticks.
    """
    if "`" in name:
        return F.col(name)
    return F.col(f"`{name}`")


def as_col(x: str | Column) -> Column:
    return c(x) if isinstance(x, str) else x


# --- membership with R's NA rules -------------------------------------------

def in_values(col: str | Column, values: Iterable) -> Column:
    """``x %in% values``: never NULL; a NULL ``x`` matches only a NULL in the list."""
    vals = list(values)
    x = as_col(col)
    non_null = [v for v in vals if v is not None]
    hit = F.coalesce(x.isin(non_null), F.lit(False)) if non_null else F.lit(False)
    if any(v is None for v in vals):
        hit = hit | x.isNull()
    return hit


def not_in_values(col: str | Column, values: Iterable) -> Column:
    """``!x %in% values``: TRUE for a NULL ``x`` unless the list holds NULL."""
    return ~in_values(col, values)


def empty_or_null(col: str | Column) -> Column:
    x = as_col(col)
    return x.isNull() | (x == F.lit(""))


# --- text -------------------------------------------------------------------

def strip_json_punct(col: str | Column) -> Column:
    """Remove ``[``, ``]`` and ``"`` (turns a JSON array text into a CSV list)."""
    return F.regexp_replace(as_col(col), r'[\["\]]', "")


def json_string_array(col: str | Column) -> Column:
    """JSON array text to ``ARRAY<STRING>``; malformed text gives NULL."""
    return F.from_json(as_col(col), "array<string>")


def number_text(col: str | Column) -> Column:
    """Render a number as R prints it: ``170`` not ``170.0``."""
    return F.regexp_replace(as_col(col).cast("string"), r"\.0$", "")


# --- numbers ----------------------------------------------------------------

def to_number(col: str | Column) -> Column:
    """``as.numeric``: unparsable text becomes NULL instead of raising."""
    return as_col(col).try_cast("double")


def half_even(col: str | Column, digits: int = 0) -> Column:
    """R's ``round`` (IEC 60559 half-to-even)."""
    return F.bround(as_col(col), digits)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(as_col(num), as_col(den))


# --- time -------------------------------------------------------------------

def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since the epoch as DOUBLE; works for TIMESTAMP and TIMESTAMP_NTZ."""
    return F.unix_micros(as_col(ts).cast("timestamp")) / F.lit(1e6)


def start_of_day(day: str) -> Column:
    """Midnight of ``day`` as a timestamp literal comparable with NTZ columns."""
    return F.to_timestamp(F.lit(day))


def years_since(year_text: str | Column, as_of: str | Column | None = None) -> Column:
    """``year(as_of) - as.numeric(year)``; default ``as_of`` is today."""
    ref = F.current_date() if as_of is None else (F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of)
    return F.year(ref).cast("double") - to_number(year_text)


# --- rule tables ------------------------------------------------------------

def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """``case_when``: the first true condition wins; ``default`` otherwise."""
    out = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if out is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is not None:
        out = out.otherwise(default if isinstance(default, Column) else F.lit(default))
    return out


def content_handle(payload: str | Column) -> Column:
    """Deterministic attachment handle: SHA-256 of the payload."""
    return F.sha2(as_col(payload).cast("binary"), 256)
