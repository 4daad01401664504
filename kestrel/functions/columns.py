"""Column expressions used across the models (all built-in, JVM-side).

Every helper returns a ``Column`` so it stays inside whole-stage codegen; no
Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import EASTERN

MONEY = "decimal(18,4)"
RATE = "decimal(18,6)"
# Wide enough that ratios of money sums keep 10 decimals before rounding.
WIDE = "decimal(28,4)"
# Products of money and rates, and their sums, with all the digits they carry.
DIGITS = "decimal(30,8)"
PRODUCT = "decimal(24,8)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- money -----------------------------------------------------------------

def money(c) -> Column:
    """float -> exact decimal money."""
    return col(c).cast(MONEY)


def rate(c) -> Column:
    return col(c).cast(RATE)


def pct(num, den, scale: int = 2) -> Column:
    """round(num / den * 100, scale), NULL unless den > 0 (HALF_UP, exact)."""
    n, d = col(num), col(den)
    ratio = (n.cast(DIGITS) * F.lit(100)) / d.cast(WIDE)
    return F.when(F.coalesce(d, F.lit(0)) > 0, F.round(ratio, scale))


def exact_avg(c, scale: int = 6) -> Column:
    """avg of a decimal rounded HALF_UP to ``scale`` decimals, computed as decimal sum / count
    (Spark's avg(decimal) rounds to 4 extra digits first, which can double-round)."""
    x = col(c)
    return F.round(F.sum(x) / F.count(x).cast("decimal(20,0)"), scale)


# --- time ------------------------------------------------------------------

def to_date(c) -> Column:
    return F.to_date(col(c))


def trunc_date(c, unit: str) -> Column:
    """date_trunc(unit, ts)::date for day/week(Monday)/month/quarter/year."""
    d = F.to_date(col(c))
    return d if unit == "day" else F.trunc(d, unit)


def days_between(later, earlier) -> Column:
    """Calendar-day difference of two dates/timestamps (Postgres date - date)."""
    return F.datediff(F.to_date(col(later)), F.to_date(col(earlier)))


def utc_wall_to_eastern(c) -> Column:
    """A UTC wall-clock TIMESTAMP_NTZ -> Eastern wall clock (NTZ), DST-aware."""
    return F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), col(c))


def instant_to_utc_wall(c) -> Column:
    """A true instant (TIMESTAMP_LTZ) -> its UTC wall clock (NTZ); the engine
    pins the session zone to UTC."""
    return col(c).cast("timestamp_ntz")


def instant_to_eastern(c) -> Column:
    """A true instant (TIMESTAMP_LTZ) -> Eastern wall clock (NTZ)."""
    return utc_wall_to_eastern(instant_to_utc_wall(c))


def seconds_between(later, earlier) -> Column:
    """extract(epoch from later - earlier)::int: whole seconds, rounded half away from zero."""
    micros = F.timestamp_diff("MICROSECOND", col(earlier), col(later))
    return F.round(micros.cast("decimal(20,0)") / F.lit(1_000_000), 0).cast("int")


def iso_weekday(c) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(col(c)) + 1


# --- strings / json ----------------------------------------------------------

def json_has_key(c, key: str) -> Column:
    """Postgres ``jsonb ? key``: true even when the value is JSON null."""
    return F.array_contains(F.json_object_keys(col(c)), F.lit(key))


def json_text(c, key: str) -> Column:
    """Postgres ``jsonb ->> key``."""
    return F.get_json_object(col(c), f"$.{key}")


def parsed_json(c) -> Column:
    """A JSON text as VARIANT, for several reads of one payload; NULL if it is no JSON. Of a key
    named twice the last value counts, as in Postgres (``spark.sql.variant.allowDuplicateKeys``)."""
    return F.try_parse_json(col(c))


def variant_has_key(c, key: str) -> Column:
    """``json_has_key`` of a parsed payload: a JSON null is a VARIANT, not a NULL. NULL if there is no payload."""
    return F.when(col(c).isNotNull(), F.variant_get(col(c), f"$.{key}", "variant").isNotNull())


def variant_text(c, key: str) -> Column:
    """``json_text`` of a parsed payload: strings as they are, anything else as JSON."""
    value = F.try_variant_get(col(c), f"$.{key}", "variant")
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.try_variant_get(col(c), f"$.{key}", "string")).when(kind != "VOID", F.to_json(value))


def nullif_blank(c) -> Column:
    return F.nullif(F.trim(col(c)), F.lit(""))


def ilike_any(c, patterns: Iterable[str]) -> Column:
    x = col(c)
    out = None
    for p in patterns:
        term = x.ilike(p)
        out = term if out is None else (out | term)
    return out


def contains_any_upper(text: Column, tokens: Iterable[str]) -> Column:
    out = None
    for t in tokens:
        term = F.upper(text).like(f"%{t.upper()}%")
        out = term if out is None else (out | term)
    return out


# --- flags -------------------------------------------------------------------

def within_days(days_col, n: int) -> Column:
    """0/1 flag: milestone reached within n days (no lower bound; NULL -> 0)."""
    return F.when(col(days_col) <= n, 1).otherwise(0)


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def distinct_from(a, b) -> Column:
    """``a IS DISTINCT FROM b``."""
    return ~col(a).eqNullSafe(col(b))
