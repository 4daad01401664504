"""Scalar column functions (SC-01..SC-20) as built-in Spark expressions."""

from .columns import (  # noqa: F401
    DIGITS, MONEY, PRODUCT, RATE, WIDE, col, contains_any_upper, days_between,
    distinct_from, exact_avg, flag, ilike_any, instant_to_eastern, instant_to_utc_wall,
    iso_weekday, json_has_key, json_text, money, nullif_blank, parsed_json, pct, rate, seconds_between,
    to_date, trunc_date, utc_wall_to_eastern, variant_has_key, variant_text, within_days,
)
