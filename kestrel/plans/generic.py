"""Stand-alone queries for the generic operators (survey §2.1, §2.6-2.11) on
the driver's raw tables. Each names the operator IDs it exercises; the DuckDB
oracle for each lives in ``oracle/duck_generic.py``.

Money-like doubles are cast to exact decimals before any sum, so results do
not depend on the order Spark adds partial sums in.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    MONEY, days_between, distinct_from, exact_avg, flag, ilike_any, instant_to_eastern, iso_weekday,
    json_has_key, json_text, nullif_blank, pct, seconds_between, trunc_date, utc_wall_to_eastern, within_days,
)
from ..operators import (
    asof_both, asof_scan, distinct_bitmaps, earliest_by, first_in_group_rows, full_outer_merge, latest_by,
    left_join_spread_nulls, merged_counts,
)
from ..operators.quality import accepted_values, not_null, unique, unique_combination
from .registry import Build

c = F.col


@dataclass(frozen=True)
class GenericQuery:
    ids: tuple[str, ...]
    spark: Callable[[Build], DataFrame]


GENERIC_QUERIES: dict[str, GenericQuery] = {}


def generic(name: str, *ids: str):
    def register(fn):
        GENERIC_QUERIES[name] = GenericQuery(tuple(ids), fn)
        return fn
    return register


def raw(b: Build, name: str) -> DataFrame:
    return b.sources.raw(name)


def dec(x: str | Column) -> Column:
    return (c(x) if isinstance(x, str) else x).cast(MONEY)


def _calendar(d: Column) -> list[Column]:
    return [
        F.trunc(d, "week").alias("week_start"), F.trunc(d, "month").alias("month_start"),
        F.trunc(d, "quarter").alias("quarter_start"), F.trunc(d, "year").alias("year_start"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "yyyy-MM").alias("year_month"), F.dayofmonth(d).alias("day_of_month"),
        iso_weekday(d).alias("day_of_week"), F.date_format(d, "EEE").alias("day_name"),
        iso_weekday(d).isin(6, 7).alias("is_weekend"), (d == F.last_day(d)).alias("is_month_end"),
    ]


# --- sources / projections / filters ------------------------------------------

@generic("src20_date_spine", "SRC-20", "SC-14", "SC-16")
def src20_date_spine(b: Build):
    """A day spine over the orders' date range with calendar attributes. The
    spine is bounded by the calendar span, not by the row count."""
    o = raw(b, "orders").agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    days = o.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    return days.select("date_day", *_calendar(c("date_day")))


@generic("prj_select_cast", "PRJ-01", "PRJ-02", "PRJ-03")
def prj_select_cast(b: Build):
    o = raw(b, "orders").select(
        c("o_orderkey").alias("order_id"), c("o_custkey").alias("customer_id"), c("o_orderstatus").alias("status"),
        dec("o_totalprice").alias("total_price"), F.to_date("o_orderdate").alias("order_date"),
        c("o_orderpriority").alias("priority"))
    return o.select("*", (c("status") == "F").alias("is_filled"), c("priority").like("1-%").alias("is_urgent"))


@generic("flt_eq_in_null", "FLT-01", "FLT-02", "FLT-03", "FLT-04")
def flt_eq_in_null(b: Build):
    li = raw(b, "lineitem")
    kept = li.where((c("l_linestatus") == "F") & c("l_returnflag").isin("A", "R") & c("l_shipdate").isNotNull()
                    & ~c("l_quantity").isin(1.0, 2.0, 3.0) & ~(c("l_discount") > 0.09))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus",
                       "l_shipdate")


@generic("flt05_distinct_from", "FLT-05")
def flt05_distinct_from(b: Build):
    """Orders whose nullable priority bucket differs (NULL-safely) from their
    customer's nullable segment bucket."""
    o = raw(b, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    cu = raw(b, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    j = o.join(cu, o["o_custkey"] == cu["c_custkey"])
    left = F.when(c("o_orderpriority").like("1%"), F.lit("BUILDING"))
    right = F.when(c("c_acctbal") > 0, c("c_mktsegment"))
    return j.where(distinct_from(left, right)).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


@generic("flt06_like_ilike", "FLT-06", "SC-02")
def flt06_like_ilike(b: Build):
    p = raw(b, "part")
    bucket = (F.when(c("p_name").ilike("%GREEN%"), "green")
              .when(ilike_any("p_type", ["promo%", "%polished%"]), "promo_or_polished")
              .when(c("p_brand").like("Brand#1_"), "brand_1x")
              .otherwise("other"))
    return p.select("p_partkey", bucket.alias("bucket"))


@generic("flt08_not_and_time", "FLT-08")
def flt08_not_and_time(b: Build):
    """Lineitem without late returned lines: NOT (returned AND shipped >= 90
    days after the order), with SQL three-valued logic (a NULL flag drops a
    late line, keeps an early one)."""
    li = raw(b, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity", "l_shipdate")
    o = raw(b, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    returned = F.when(c("l_returnflag") == "R", F.lit(True)).when(c("l_returnflag") == "A", F.lit(None)) \
        .otherwise(F.lit(False))
    late = c("l_shipdate") >= c("o_orderdate") + F.expr("INTERVAL '90' DAY")
    kept = j.where(~(returned & late))
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(dec("l_quantity")).alias("sum_qty"))


# --- joins ---------------------------------------------------------------------

@generic("jn01_inner", "JN-01")
def jn01_inner(b: Build):
    o = raw(b, "orders").select("o_custkey", "o_totalprice")
    cu = raw(b, "customer").select("c_custkey", "c_nationkey")
    n = raw(b, "nation").select("n_nationkey", "n_name")
    j = o.join(cu, o["o_custkey"] == cu["c_custkey"]).join(n, c("c_nationkey") == n["n_nationkey"])
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_orders"),
                                   F.sum(dec("o_totalprice")).alias("revenue"))


@generic("jn03_left", "JN-03", "AGG-12")
def jn03_left(b: Build):
    per = raw(b, "orders").groupBy(c("o_custkey").alias("__ck")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(dec("o_totalprice")).alias("order_total"))
    cu = raw(b, "customer").select("c_custkey", "c_name")
    j = cu.join(per, cu["c_custkey"] == per["__ck"], "left")
    return j.select("c_custkey", "c_name", F.coalesce(c("n_orders"), F.lit(0)).alias("n_orders"),
                    F.coalesce(c("order_total"), F.lit(0).cast(MONEY)).alias("order_total"))


def _spine(b: Build, lo: str, hi: str) -> DataFrame:
    return b.spark.sql(f"SELECT explode(sequence(DATE '{lo}', DATE '{hi}', INTERVAL 1 DAY)) AS date_day")


@generic("jn02_spine", "JN-02")
def jn02_spine(b: Build):
    """Daily orders joined to a calendar spine over the orders' own date range."""
    daily = raw(b, "orders").groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    days = daily.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    spine = F.broadcast(days.select(  # bounded by the calendar
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_day")))
    j = daily.join(spine, daily["order_date"] == spine["date_day"])
    return j.select("date_day", F.trunc("date_day", "week").alias("week_start"), "n_orders")


@generic("jn04_full_outer", "JN-04")
def jn04_full_outer(b: Build):
    o = raw(b, "orders").groupBy(trunc_date("o_orderdate", "month").alias("month"),
                                 c("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n_orders"))
    li = raw(b, "lineitem").groupBy(trunc_date("l_shipdate", "month").alias("month"),
                                    c("l_linestatus").alias("status")).agg(F.count(F.lit(1)).alias("n_lines"))
    j = full_outer_merge([o, li], ["month", "status"])
    return j.select("month", "status", F.coalesce(c("n_orders"), F.lit(0)).alias("n_orders"),
                    F.coalesce(c("n_lines"), F.lit(0)).alias("n_lines"))


@generic("jn05_full_outer_chain", "JN-05")
def jn05_full_outer_chain(b: Build):
    o = raw(b, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))
    li = raw(b, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n_lines"))
    ev = raw(b, "events").groupBy(F.date_sub(F.to_date("ts"), 10000).alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"))
    j = full_outer_merge([o, li, ev], ["day"])
    return j.select("day", *[F.coalesce(c(x), F.lit(0)).alias(x) for x in ("n_orders", "n_lines", "n_events")])


@generic("jn06_range_residual", "JN-06")
def jn06_range_residual(b: Build):
    """Orders of a customer placed after the customer's first order: an equi
    join to a per-customer aggregate with a range residual (no pair explosion)."""
    o = raw(b, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    first = o.groupBy(c("o_custkey").alias("__ck")).agg(F.min("o_orderdate").alias("first_order_at"))
    j = o.join(first, (o["o_custkey"] == first["__ck"]) & (o["o_orderdate"] > first["first_order_at"]))
    return j.select("o_orderkey", "o_custkey", "o_orderdate", "first_order_at")


def _first_purchase(b: Build) -> DataFrame:
    e = raw(b, "events")
    return e.where(c("event_type") == "purchase").groupBy("user_id").agg(F.min("ts").alias("first_purchase_at"))


@generic("jn07_asof_backward", "JN-07", "WIN-03")
def jn07_asof_backward(b: Build):
    """For each user's first purchase: the last view strictly before it."""
    views = raw(b, "events").where(c("event_type") == "view")
    r = asof_both(_first_purchase(b), views, "user_id", "first_purchase_at", "ts", "event_id",
                  before_value="event_id", after_value="event_id",
                  before_alias="last_view_event_id", after_alias="__unused")
    return r.where(c("has_before")).select("user_id", "last_view_event_id")


@generic("jn07_asof_forward", "JN-07", "WIN-03")
def jn07_asof_forward(b: Build):
    """For each user's first purchase: the first error at or after it."""
    errors = raw(b, "events").where(c("event_type") == "error")
    r = asof_both(_first_purchase(b), errors, "user_id", "first_purchase_at", "ts", "event_id",
                  before_value="event_id", after_value="event_id",
                  before_alias="__unused", after_alias="first_error_event_id")
    return r.where(c("has_after")).select("user_id", "first_error_event_id")


@generic("jn07_asof_scan", "JN-07", "WIN-03")
def jn07_asof_scan(b: Build):
    """For every purchase: the user's last view strictly before it and first error
    at or after it. A user has many purchases; both logs are scanned in cells of time."""
    ev = raw(b, "events").select("event_id", "event_type", "user_id", "ts")
    bought = ev.where(c("event_type") == "purchase").select("event_id", "user_id", "ts")
    seen = asof_scan(bought, ev.where(c("event_type") == "view"), "user_id", "ts", "ts", "event_id", before_value="event_id",
                     after_value="event_id", before_alias="last_view_event_id", after_alias="__next_view") \
        .select("event_id", "user_id", "ts", "last_view_event_id")
    found = asof_scan(seen, ev.where(c("event_type") == "error"), "user_id", "ts", "ts", "event_id", before_value="event_id",
                      after_value="event_id", before_alias="__last_error", after_alias="first_error_event_id")
    return found.select("event_id", "user_id", "last_view_event_id", "first_error_event_id")


@generic("jn08_existence_flag", "JN-08")
def jn08_existence_flag(b: Build):
    urgent = raw(b, "orders").where(c("o_orderpriority") == "1-URGENT").groupBy(c("o_custkey").alias("__ck")) \
        .agg(F.count(F.lit(1)).alias("__n"))
    cu = raw(b, "customer").select("c_custkey")
    j = cu.join(urgent, cu["c_custkey"] == urgent["__ck"], "left")
    return j.select("c_custkey", c("__ck").isNotNull().alias("has_urgent_order"))


@generic("jn_left_null_keys", "JN-03")
def jn_left_null_keys(b: Build):
    """Left join on a mostly-NULL key (NULL-key rows spread over buckets)."""
    e = raw(b, "events").select("event_id", F.when(c("event_type") == "view", c("user_id")).alias("k"))
    cu = raw(b, "customer").select(c("c_custkey").alias("__ck"), "c_name")
    j = left_join_spread_nulls(e, cu, "k", "__ck", ["event_id"])
    return j.select("event_id", "k", "c_name")


# --- aggregations -------------------------------------------------------------

@generic("agg01_group_by", "AGG-01", "AGG-02", "AGG-04")
def agg01_group_by(b: Build):
    li = raw(b, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(dec("l_quantity")).alias("sum_qty"), F.sum(dec("l_extendedprice")).alias("sum_base_price"),
        F.count(F.lit(1)).alias("count_order"), F.count("l_shipdate").alias("count_shipped"))


@generic("agg03_count_distinct", "AGG-03")
def agg03_count_distinct(b: Build):
    e = raw(b, "events")
    return e.groupBy("user_id").agg(F.count_distinct("event_type").alias("n_event_types"),
                                    F.count_distinct(F.to_date("ts")).alias("n_active_days"))


@generic("agg03_distinct_bitmaps", "AGG-03", "AGG-07")
def agg03_distinct_bitmaps(b: Build):
    """Ordering customers per month, all, of finished and of urgent orders: daily bitmaps by
    status and priority, merged. The months' counts are not sums of the days'."""
    o = raw(b, "orders")
    daily = distinct_bitmaps(o, [F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority"], "o_custkey")
    return merged_counts(daily, [F.trunc("day", "month").alias("month_start")], {
        "n_customers": None, "n_finished": c("o_orderstatus") == "F", "n_urgent": c("o_orderpriority") == "1-URGENT"})


@generic("agg04_sum_flags", "AGG-04")
def agg04_sum_flags(b: Build):
    li = raw(b, "lineitem")
    return li.groupBy("l_partkey").agg(F.sum(dec("l_quantity")).alias("qty"),
                                       F.sum(flag(c("l_returnflag") == "R")).alias("n_returned"))


@generic("agg05_avg", "AGG-05")
def agg05_avg(b: Build):
    li = raw(b, "lineitem")
    return li.groupBy("l_suppkey").agg(exact_avg(dec("l_quantity")).alias("avg_qty"),
                                       exact_avg(dec("l_extendedprice")).alias("avg_price"))


@generic("agg06_min_max", "AGG-06")
def agg06_min_max(b: Build):
    e = raw(b, "events")
    return e.groupBy("user_id").agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"),
                                    F.min(dec("value")).alias("min_value"), F.max(dec("value")).alias("max_value"))


@generic("agg07_filter", "AGG-07")
def agg07_filter(b: Build):
    e = raw(b, "events")
    t = c("event_type")
    return e.groupBy("user_id").agg(
        F.count_if(t == "click").alias("clicks"),
        F.sum(F.when(t == "purchase", dec("value"))).alias("purchase_value"),
        F.min(F.when(t == "error", c("ts"))).alias("first_error_at"))


@generic("agg08_case_agg", "AGG-08")
def agg08_case_agg(b: Build):
    o = raw(b, "orders")
    return o.groupBy("o_orderstatus").agg(
        F.count(F.when(c("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1)).alias("high_priority"),
        F.sum(F.when(c("o_orderpriority") == "5-LOW", dec("o_totalprice"))).alias("low_priority_total"))


@generic("agg09_bool_or", "AGG-09")
def agg09_bool_or(b: Build):
    e = raw(b, "events")
    return e.groupBy("user_id").agg(F.bool_or(c("event_type") == "error").alias("had_error"),
                                    F.bool_and(c("value") > 1).alias("all_above_one"))


@generic("agg10_latest_value", "AGG-10", "SRT-02")
def agg10_latest_value(b: Build):
    """Latest event per user (ts, then id); a NULL value at the latest row is kept."""
    e = raw(b, "events").select("user_id", "ts", "event_id",
                                F.when(c("event_type") != "signup", c("event_type")).alias("kind"))
    return latest_by(e, ["user_id"], ["ts", "event_id"], ["kind", "ts"]).withColumnRenamed("ts", "latest_at")


@generic("agg11_dependent_attr", "AGG-11")
def agg11_dependent_attr(b: Build):
    o = raw(b, "orders").select("o_custkey", "o_totalprice")
    cu = raw(b, "customer").select("c_custkey", "c_nationkey")
    n = raw(b, "nation").select("n_nationkey", "n_name")
    j = o.join(cu, o["o_custkey"] == cu["c_custkey"]).join(n, c("c_nationkey") == n["n_nationkey"])
    return j.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"), F.max("n_name").alias("nation"))


@generic("agg12_preagg_join", "AGG-12")
def agg12_preagg_join(b: Build):
    cu = raw(b, "customer").select("c_custkey")
    o = raw(b, "orders").groupBy(c("o_custkey").alias("__o")).agg(F.count(F.lit(1)).alias("n_orders"))
    lo = raw(b, "orders").select("o_orderkey", "o_custkey")
    li = raw(b, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("__n"))
    lines = li.join(lo, li["l_orderkey"] == lo["o_orderkey"]).groupBy(c("o_custkey").alias("__l")) \
        .agg(F.sum("__n").alias("n_lines"))
    ev = raw(b, "events").groupBy(c("user_id").alias("__e")).agg(F.count(F.lit(1)).alias("n_events"))
    j = (cu.join(o, cu["c_custkey"] == o["__o"], "left").join(lines, cu["c_custkey"] == lines["__l"], "left")
           .join(ev, cu["c_custkey"] == ev["__e"], "left"))
    return j.select("c_custkey", *[F.coalesce(c(x), F.lit(0)).alias(x) for x in ("n_orders", "n_lines", "n_events")])


# --- windows / sorts / set ops ------------------------------------------------

@generic("win01_latest_per_key", "WIN-01", "FLT-07")
def win01_latest_per_key(b: Build):
    o = raw(b, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return latest_by(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate"])


@generic("win02_first_in_month", "WIN-02")
def win02_first_in_month(b: Build):
    """Distinct customers per month as an additive daily count: each customer
    counts once per month, on the day of its first order that month."""
    o = raw(b, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"), "o_orderdate")
    first = first_in_group_rows(o, ["o_custkey", F.trunc("d", "month")], ["o_orderdate", "o_orderkey"], ["d"])
    return first.groupBy(c("d").alias("order_date")).agg(F.count(F.lit(1)).alias("new_customers_in_month"))


@generic("win_earliest_per_key", "WIN-03")
def win_earliest_per_key(b: Build):
    e = raw(b, "events").select("user_id", "ts", "event_id", "event_type")
    return earliest_by(e, ["user_id"], ["ts", "event_id"], ["event_type", "event_id"])


@generic("srt01_order_nulls_first", "SRT-01")
def srt01_order_nulls_first(b: Build):
    """A sorted report: nation revenue with an optional bucket, DESC NULLS FIRST."""
    r = jn01_inner(b)
    total = r.agg(F.sum("n_orders").alias("all_orders"), F.count(F.lit(1)).alias("n_nations"))  # one row
    r = r.join(F.broadcast(total))
    bucket = F.when(c("n_orders") * c("n_nations") > c("all_orders"), F.lit("large"))
    return r.select("n_name", "revenue", bucket.alias("size_bucket")).orderBy(
        F.desc_nulls_first("size_bucket"), F.desc_nulls_first("revenue"), F.asc("n_name"))


@generic("set01_union_all", "SET-01")
def set01_union_all(b: Build):
    """Revenue rows and count rows of unlike shape, padded and grouped once."""
    money_rows = raw(b, "orders").select(F.to_date("o_orderdate").alias("day"),
                                         dec("o_totalprice").alias("amount"), F.lit(0).alias("n_lines"))
    count_rows = raw(b, "lineitem").select(F.to_date("l_shipdate").alias("day"),
                                           F.lit(0).cast(MONEY).alias("amount"), F.lit(1).alias("n_lines"))
    u = money_rows.unionByName(count_rows)
    return u.groupBy("day").agg(F.sum("amount").alias("amount"), F.sum("n_lines").alias("n_lines"))


# --- scalar functions ---------------------------------------------------------

@generic("sc01_sc04_strings", "SC-01", "SC-03", "SC-04", "SC-05")
def sc01_sc04_strings(b: Build):
    cu = raw(b, "customer")
    seg = F.when(c("c_custkey") % 7 != 0, c("c_mktsegment"))
    return cu.select(
        "c_custkey",
        nullif_blank(F.when(c("c_custkey") % 5 != 0, F.concat(F.lit("  "), c("c_name"), F.lit(" ")))
                     .otherwise(F.lit("   "))).alias("clean_name"),
        F.upper(F.trim(F.lower(c("c_name")))).alias("upper_name"),
        F.concat(c("c_name"), F.lit(" / "), seg).alias("name_and_segment"),
        F.coalesce(seg, F.lit("UNKNOWN")).alias("segment_or_default"),
    )


@generic("sc06_json_key", "SC-06")
def sc06_json_key(b: Build):
    e = raw(b, "events")
    p = F.when(c("event_type") != "signup", c("props"))
    return e.select("event_id", json_has_key(p, "k").alias("has_k"), json_has_key(p, "x").alias("has_x"))


@generic("sc07_json_text", "SC-07")
def sc07_json_text(b: Build):
    e = raw(b, "events")
    return e.select("event_id", json_text("props", "k").alias("k_text"))


@generic("sc08_date_trunc", "SC-08")
def sc08_date_trunc(b: Build):
    o = raw(b, "orders")
    return o.select("o_orderkey", *[trunc_date("o_orderdate", u).alias(f"{u}_start")
                                    for u in ("day", "week", "month", "quarter", "year")])


@generic("sc09_days_between", "SC-09")
def sc09_days_between(b: Build):
    li = raw(b, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = raw(b, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return j.select("l_orderkey", "l_linenumber", days_between("l_shipdate", "o_orderdate").alias("days_to_ship"))


@generic("sc10_interval_add", "SC-10")
def sc10_interval_add(b: Build):
    o = raw(b, "orders")
    snap = (F.trunc(F.to_date("o_orderdate"), "month").cast("timestamp_ntz") + F.expr("INTERVAL '1' MONTH")
            + F.expr("INTERVAL '5:05' HOUR TO MINUTE"))
    return o.select("o_orderkey", snap.alias("snapshot_at"),
                    (c("o_orderdate") + F.expr("INTERVAL '90' DAY")).alias("plus_90_days"))


@generic("sc11_utc_to_eastern", "SC-11")
def sc11_utc_to_eastern(b: Build):
    e = raw(b, "events")
    east = utc_wall_to_eastern("ts")
    return e.select("event_id", east.alias("eastern_at"), F.to_date(east).alias("eastern_date"),
                    F.to_date("ts").alias("utc_date"))


@generic("sc12_instant_to_eastern", "SC-12")
def sc12_instant_to_eastern(b: Build):
    e = raw(b, "events")
    instant = c("ts").cast("timestamp")  # the wall clock read as a UTC instant (session zone UTC)
    return e.select("event_id", instant_to_eastern(instant).alias("eastern_at"))


@generic("sc13_as_of_age", "SC-13")
def sc13_as_of_age(b: Build):
    as_of = b.cfg.as_of
    o = raw(b, "orders")
    age = F.datediff(F.lit(as_of), F.to_date("o_orderdate"))
    return o.select("o_orderkey", age.alias("age_days"),
                    *[flag(age >= n).alias(f"is_mature_d{n}") for n in (7, 30, 10000)])


@generic("sc15_seconds_between", "SC-15")
def sc15_seconds_between(b: Build):
    e = raw(b, "events")
    t = c("event_type")
    per = e.groupBy("user_id").agg(F.min(F.when(t == "view", c("ts"))).alias("first_view_at"),
                                   F.min(F.when(t == "purchase", c("ts"))).alias("first_purchase_at"))
    return per.select("user_id", seconds_between("first_purchase_at", "first_view_at").alias("seconds_to_purchase"))


@generic("sc17_pct", "SC-17", "SC-18")
def sc17_pct(b: Build):
    li = raw(b, "lineitem").select("l_partkey", "l_quantity", "l_returnflag")
    p = raw(b, "part").select("p_partkey", "p_brand")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    per = j.groupBy("p_brand").agg(F.sum(F.when(c("l_returnflag") == "R", dec("l_quantity"))).alias("returned_qty"),
                                   F.sum(dec("l_quantity")).alias("total_qty"))
    return per.select("p_brand", pct(F.coalesce(c("returned_qty"), F.lit(0)), c("total_qty")).alias("return_pct"),
                      (-c("total_qty")).alias("negated_total"))


@generic("sc19_bool_algebra", "SC-19", "SC-20")
def sc19_bool_algebra(b: Build):
    o = raw(b, "orders")
    big = F.when(c("o_orderkey") % 4 != 0, c("o_totalprice") > 100000)
    urgent = c("o_orderpriority") == "1-URGENT"
    return o.select("o_orderkey", big.alias("is_big"), (big & urgent).alias("big_and_urgent"),
                    (big | urgent).alias("big_or_urgent"), (~big).alias("not_big"),
                    F.coalesce(big, F.lit(False)).alias("is_big_or_false"))


@generic("sc_window_flags", "SC-02", "SC-09")
def sc_window_flags(b: Build):
    """0/1 cohort flags from day differences (no lower bound, NULL -> 0)."""
    li = raw(b, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = raw(b, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    d = days_between(F.when(c("l_linenumber") != 3, c("l_shipdate")), "o_orderdate")
    return j.select("l_orderkey", "l_linenumber", *[within_days(d, n).alias(f"d{n}") for n in (7, 30, 90)])


# --- data-quality operators on raw tables ------------------------------------

@generic("dq01_not_null", "DQ-01")
def dq01_not_null(b: Build):
    e = raw(b, "events").select(F.when(c("event_type") != "signup", c("props")).alias("props"), "event_id")
    return not_null(e, "props").agg(F.count(F.lit(1)).alias("failures"))


@generic("dq02_unique", "DQ-02")
def dq02_unique(b: Build):
    return unique(raw(b, "lineitem"), "l_orderkey").select("l_orderkey", "n_records")


@generic("dq03_accepted_values", "DQ-03")
def dq03_accepted_values(b: Build):
    bad = accepted_values(raw(b, "orders"), "o_orderstatus", ["F", "O"])
    return bad.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("failures"))


@generic("dq04_unique_combo", "DQ-04")
def dq04_unique_combo(b: Build):
    return unique_combination(raw(b, "lineitem"), ["l_orderkey", "l_linenumber"])



@generic("dq_model_checks", "DQ-01", "DQ-02", "DQ-03", "DQ-04", "DQ-05")
def dq_model_checks(b: Build):
    """All 119 declared data tests over the sources and every model."""
    from .quality_checks import model_checks
    return model_checks(b)
